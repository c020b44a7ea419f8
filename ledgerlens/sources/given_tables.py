"""Adapter from the given star-schema tables to the seven raw banking tables.

Everything is a deterministic projection or equi-join of the given parquet tables, so the raw tables
grow with them. Arithmetic is integer or DECIMAL, which keeps the values engine-independent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens import schemas as s

# how the event kinds of the given tables map to payment channels; the rest is ATM or Branch
EVENT_CHANNEL = {"view": "Mobile", "click": "Web", "signup": "API", "purchase": "POS"}


def _pick(values: Sequence[str], index: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({listed}), cast({index} as int) + 1)"


def _padded(prefix: str, number: str, width: int) -> str:
    digits = f"cast({number} as string)"  # numbers wider than the padding stay whole
    return f"concat('{prefix}', lpad({digits}, greatest({width}, length({digits})), '0'))"


def _money(column: str) -> str:
    return f"cast({column} as decimal(12,2))"


def _second(moment: str) -> str:
    """Text of a moment cut (not rounded) to whole seconds."""
    return f"substring(cast({moment} as string), 1, 19)"


def _plus_hours(moment: str, hours: str) -> str:
    return f"{moment} + make_dt_interval(0, cast({hours} as int), 0, 0)"


class GivenTables:
    """Raw tables by name over one folder of given parquet files."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._opened: dict[str, DataFrame] = {}

    def given(self, name: str) -> DataFrame:
        if name not in self._opened:  # opening reads the file footers, once is enough
            self._opened[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._opened[name]

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)()

    def all(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in s.TABLES}

    def _seconds(self) -> DataFrame:
        """Events with their time cut to whole seconds."""
        return self.given("events").withColumn("ts", F.date_trunc("second", "ts").cast("timestamp_ntz"))

    def customers(self) -> DataFrame:
        nation = self.given("nation").select("n_nationkey", "n_name")
        k = "c_custkey"
        return self.given("customer").join(nation, F.expr("c_nationkey = n_nationkey")).selectExpr(
            f"{_padded('CUST', k, 5)} as customer_id",
            "c_name as full_name",
            f"concat('customer_', {k}, '@example.com') as email",
            f"concat('+1-', 200 + {k} % 800, '-', 1000000 + {k}) as phone",
            "n_name as country",
            "c_mktsegment as segment",
            f"case when {k} % 20 < 14 then 'Verified' when {k} % 20 < 17 then 'Pending' "
            f"when {k} % 20 < 18 then 'Rejected' else 'Under Review' end as kyc_status",
            f"cast(cast(({_money('c_acctbal')} + 1000) * 0.009 as decimal(6,2)) as double) as risk_score",
            f"cast(date_add(date'2019-01-01', cast({k} % 2000 as int)) as string) as date_joined",
            f"{k} % 33 = 0 as is_pep",
            f"{k} % 100 = 0 as is_sanctioned",
        )

    def accounts(self) -> DataFrame:
        k = "c_custkey"
        typed = self.given("customer").withColumn("kind", F.expr(_pick(s.ACCOUNT_TYPES, f"{k} % 6")))
        return typed.selectExpr(
            f"{_padded('ACCT', k, 7)} as account_id",
            f"case when {k} % 401 <> 400 then {_padded('CUST', f'{k} div 2', 5)} end as customer_id",
            "kind as account_type",
            f"{_pick(s.CURRENCIES, f'{k} % 8')} as currency",
            f"cast({_money('c_acctbal')} * 50 as double) as balance",
            f"case when kind = 'Credit' then cast(1000 + {k} % 100 * 990 as double) end as credit_limit",
            f"case when {k} % 30 < 24 then 'Active' when {k} % 30 < 27 then 'Dormant' "
            f"when {k} % 30 < 29 then 'Suspended' else 'Closed' end as status",
            f"cast(date_add(date'2021-01-01', cast({k} % 1000 as int)) as string) as open_date",
            f"concat('BR', 100 + {k} % 900) as branch_code",
            f"{k} % 20 < 3 as is_joint",
        )

    def merchants(self) -> DataFrame:
        nation = self.given("nation").select("n_nationkey", "n_name")
        k = "s_suppkey"
        return self.given("supplier").join(nation, F.expr("s_nationkey = n_nationkey")).selectExpr(
            f"{_padded('MERCH', k, 5)} as merchant_id",
            "s_name as merchant_name",
            f"{_pick(s.MCC_CODES, f'{k} % 10')} as mcc_code",
            f"{_pick(s.MCC_LABELS, f'{k} % 10')} as mcc_description",
            "n_name as country",
            f"case when {k} % 20 < 10 then 'Low' when {k} % 20 < 16 then 'Medium' "
            f"when {k} % 20 < 19 then 'High' else 'Very High' end as risk_level",
            f"{k} % 50 = 0 as is_blacklisted",
            f"cast(abs({_money('s_acctbal')}) as double) as avg_txn_amount",
            f"cast(date_add(date'2018-01-01', cast({k} % 1500 as int)) as string) as registered_date",
        )

    def transactions(self, events: DataFrame | None = None) -> DataFrame:
        """Payments; every 53rd is delivered twice. ``events`` may be a stream of the given events."""
        e = "event_id"
        channel = " ".join(f"when event_type = '{kind}' then '{ch}'" for kind, ch in EVENT_CHANNEL.items())
        base = (events if events is not None else self.given("events")).withColumns({
            "k": F.get_json_object("props", "$.k").cast("int"),
            "copy": F.explode(F.expr(f"if({e} % 53 = 0, array(0, 1), array(0))")),
        })
        return base.selectExpr(
            f"{_padded('TXN', e, 8)} as transaction_id",
            f"case when {e} % 211 <> 210 then "
            f"{_padded('ACCT', f'if({e} % 11 = 0, 0, user_id)', 7)} end as account_id",
            f"case when {e} % 5 <> 0 then {_padded('MERCH', 'k', 5)} end as merchant_id",
            f"{_pick(s.TRANSACTION_TYPES, f'{e} % 10')} as transaction_type",
            f"case {channel} when user_id % 2 = 0 then 'ATM' else 'Branch' end as channel",
            f"cast(case when {e} % 101 = 100 then 0 when {e} % 7 = 0 then floor(value) * 100 "
            f"else {_money('value')} * 97 end as double) as amount",
            f"{_pick(s.CURRENCIES, 'user_id % 8')} as currency",
            f"{_second('ts')} as txn_datetime",
            "substring(cast(ts as string), 1, 10) as txn_date",
            "hour(ts) as txn_hour",
            f"{e} % 20 < 3 as is_international",
            f"case when {e} % 2 = 0 then {_padded('ACCT', 'k % 15', 7)} end as counterparty_id",
            "concat('10.', user_id % 256, '.', k, '.1') as ip_address",
            f"concat('DEV', 10000 + user_id * 31 + {e} % 4) as device_id",
            f"case when {e} % 97 = 96 then 'Unknown' "
            f"when event_type = 'error' and {e} % 3 = 0 then 'Declined' "
            f"when {e} % 50 = 1 then 'Pending' when {e} % 50 = 2 then 'Reversed' "
            "else 'Completed' end as status",
            f"{_pick(s.RESPONSE_CODES, f'{e} % 5')} as response_code",
        )

    def fraud_labels(self) -> DataFrame:
        """A label is a closed order (status F). Its payment has the order's number, and need not exist."""
        orders = self.given("orders").where("o_orderstatus = 'F'")
        joined = orders.join(self._seconds(), F.expr("o_orderkey = event_id"), "left").withColumn(
            "detected", F.expr(_plus_hours("coalesce(ts, timestamp_ntz'2024-01-15 00:00:00')", "o_orderkey % 72 + 1")))
        k = "o_orderkey"
        return joined.selectExpr(
            f"{_padded('FRD', k, 6)} as fraud_id",
            f"{_padded('TXN', k, 8)} as transaction_id",
            f"{_pick(s.FRAUD_TYPES, 'o_custkey % 9')} as fraud_type",
            f"case when {k} % 10 < 4 then 'Confirmed' when {k} % 10 < 7 then 'Under Investigation' "
            f"when {k} % 10 < 9 then 'False Positive' else 'Resolved' end as fraud_status",
            f"{_pick(s.REPORTERS, 'o_custkey % 6')} as reported_by",
            f"{_second('detected')} as detected_datetime",
            f"{_second(_plus_hours('detected', 'o_custkey % 72 + 1'))} as confirmed_datetime",
            f"cast(case when {k} % 199 = 0 then 0 "
            f"else cast({_money('o_totalprice')} * 0.1 as decimal(12,2)) end as double) as loss_amount",
            f"cast(cast({_money('o_totalprice')} * 0.001 * ({k} % 40) as decimal(12,2)) as double) "
            "as recovered_amount",
            "concat('INV', 100 + o_custkey % 100) as investigator_id",
            f"concat('rule R', 100 + {k} % 900) as notes",
        )

    def alerts(self) -> DataFrame:
        """An alert is a returned line of a closed order."""
        lines = self.given("lineitem").where("l_returnflag = 'R' and l_linestatus = 'F'")
        moments = self._seconds().select("event_id", "ts")
        joined = (
            lines.join(moments, F.expr("l_orderkey = event_id"), "left")
            .withColumns({
                "kind": F.expr(_pick(s.ALERT_TYPES, "l_partkey % 10")),
                "points": F.expr("cast(0.5 + cast(l_discount as decimal(12,2)) * 5 as decimal(6,4))"),
                "created": F.expr(_plus_hours(
                    "coalesce(ts, timestamp_ntz'2024-01-15 00:00:00')", "l_linenumber")),
            })
        )
        return joined.selectExpr(
            f"{_padded('ALT', 'l_orderkey * 10 + l_linenumber', 7)} as alert_id",
            f"{_padded('TXN', 'l_orderkey', 8)} as transaction_id",
            "concat('R', 100 + l_suppkey % 60) as rule_id",
            "kind as alert_type",
            "case when l_quantity % 10 < 3 then 'Low' when l_quantity % 10 < 7 then 'Medium' "
            "when l_quantity % 10 < 9 then 'High' else 'Critical' end as severity",
            "case when l_partkey % 20 < 4 then 'Open' when l_partkey % 20 < 9 then 'Reviewed' "
            "when l_partkey % 20 < 11 then 'Escalated' "
            "when l_partkey % 20 < 16 then 'Closed - True Positive' "
            "else 'Closed - False Positive' end as alert_status",
            "cast(points as double) as score",
            f"{_second('created')} as created_datetime",
            "case when l_partkey % 5 <> 0 then "
            f"{_second(_plus_hours('created', 'l_suppkey % 96 + 1'))} end as resolved_datetime",
            "concat('ANL', 200 + l_suppkey % 100) as analyst_id",
            "l_partkey % 20 < 7 as false_positive",
            "concat(kind, ': ', cast(points as string), ' points') as explanation",
        )

    def audit_logs(self) -> DataFrame:
        events = self.given("events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
        actor = _pick(s.AUDIT_ACTORS, "user_id % 6")
        return events.selectExpr(
            f"{_padded('LOG', 'event_id', 8)} as log_id",
            f"{_pick(s.ENTITY_TYPES, 'event_id % 4')} as entity_type",
            f"{_padded('ACCT', 'user_id', 7)} as entity_id",
            f"{_pick(s.AUDIT_ACTIONS, '(event_id div 5) % 12')} as action",
            f"{actor} as actor_type",
            "concat('USR', 1000 + user_id) as actor_id",
            f"{_second('ts')} as log_datetime",
            "concat('10.', user_id % 256, '.', k, '.1') as ip_address",
            "md5(cast(event_id as string)) as session_id",
            "case when k % 20 < 17 then 'Success' when k % 20 < 19 then 'Failure' "
            "else 'Warning' end as status",
            f"concat('Field updated by ', {actor}, ' on ', substring(cast(ts as string), 1, 10)) "
            "as change_summary",
            "k % 100 < 8 as compliance_flag",
        )
