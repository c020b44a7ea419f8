"""Row expectations: count violations, drop violating rows, or set them aside."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Expectation:
    """A named SQL predicate. A row meets it when the predicate is true (NULL does not count)."""

    name: str
    predicate: str
    action: str = "warn"  # or "drop"

    def met(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


# ---- fixed values: what is measured on the raw tables (rows are kept) --------------------------
MEASURED = {
    "customers": (
        Expectation("valid_customer_id", "customer_id IS NOT NULL"),
        Expectation("valid_risk_score", "risk_score BETWEEN 0 AND 100"),
    ),
    "accounts": (
        Expectation("valid_account_id", "account_id IS NOT NULL"),
        Expectation("valid_customer_id", "customer_id IS NOT NULL"),
    ),
    "merchants": (Expectation("valid_merchant_id", "merchant_id IS NOT NULL"),),
    "transactions": (
        Expectation("valid_transaction_id", "transaction_id IS NOT NULL"),
        Expectation("valid_amount", "amount > 0"),
        Expectation("valid_account_id", "account_id IS NOT NULL"),
    ),
    "fraud_labels": (
        Expectation("valid_fraud_id", "fraud_id IS NOT NULL"),
        Expectation("valid_transaction_id", "transaction_id IS NOT NULL"),
    ),
    "alerts": (Expectation("valid_alert_id", "alert_id IS NOT NULL"),),
    "audit_logs": (Expectation("valid_log_id", "log_id IS NOT NULL"),),
}

# ---- fixed values: what a row must meet to enter the silver layer of the rejecting profile -----
REQUIRED = {
    "customers": (Expectation("customer_id_present", "customer_id IS NOT NULL", "drop"),),
    "accounts": (
        Expectation("account_id_present", "account_id IS NOT NULL", "drop"),
        Expectation("customer_id_present", "customer_id IS NOT NULL", "drop"),
    ),
    "merchants": (Expectation("not_blacklisted", "NOT is_blacklisted", "drop"),),
    "transactions": (
        Expectation("transaction_id_present", "transaction_id IS NOT NULL", "drop"),
        Expectation("account_id_present", "account_id IS NOT NULL", "drop"),
        Expectation("amount_positive", "amount > 0", "drop"),
        Expectation("status_known", "status IN ('Completed', 'Pending', 'Declined', 'Reversed')", "drop"),
    ),
    "fraud_labels": (Expectation("transaction_id_present", "transaction_id IS NOT NULL", "drop"),),
    "alerts": (Expectation("transaction_id_present", "transaction_id IS NOT NULL", "drop"),),
    "audit_logs": (Expectation("log_id_present", "log_id IS NOT NULL", "drop"),),
}
# ------------------------------------------------------------------------------------------------


def accepted(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """Rows that meet every ``drop`` expectation; the others only measure."""
    drops = [e.met() for e in expectations if e.action == "drop"]
    return df.where(reduce(Column.__and__, drops)) if drops else df


def rejected(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """Rows that break an expectation, with the names of those they break."""
    broken = F.array_compact(F.array(*[F.when(~e.met(), F.lit(e.name)) for e in expectations]))
    return df.withColumn("violations", broken).where(F.size("violations") > 0)


def report(tables: Mapping[str, DataFrame], expectations: Mapping[str, Sequence[Expectation]]) -> DataFrame:
    """Violations per table and expectation: one aggregation pass per table."""
    parts = []
    for table, df in tables.items():
        checks = expectations[table]
        counts = df.agg(F.count(F.lit(1)).alias("total"),
                        *[F.count_if(~e.met()).alias(f"v{i}") for i, e in enumerate(checks)])
        rows = F.array(*[F.struct(F.lit(e.name).alias("expectation"), F.lit(e.action).alias("action"),
                                  F.col(f"v{i}").alias("violations")) for i, e in enumerate(checks)])
        parts.append(counts.select(F.lit(table).alias("table_name"), "total", F.inline(rows)))
    return reduce(DataFrame.unionByName, parts).select(
        "table_name", "expectation", "action", F.col("total").alias("total_rows"), "violations")


def orphans(tables: Mapping[str, DataFrame], references: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Per reference: child rows with a key, and those whose key has no parent.

    Child keys are counted before the join, so a hot key crosses the network as one row per task.
    """
    parts = []
    for child, fk, parent, pk in references:
        keys = tables[child].where(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("key")).agg(
            F.count(F.lit(1)).alias("n"))
        known = tables[parent].select(F.col(pk).alias("key")).where("key is not null").distinct().withColumn(
            "known", F.lit(True))
        parts.append(keys.join(known, "key", "left").agg(
            F.lit(child).alias("child_table"), F.lit(fk).alias("child_column"),
            F.lit(parent).alias("parent_table"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("referencing_rows"),
            F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n"))), F.lit(0)).alias("orphan_rows"),
            F.count_if(F.col("known").isNull()).alias("orphan_keys"),
        ))
    return reduce(DataFrame.unionByName, parts)


def duplicated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def content_marks(df: DataFrame) -> DataFrame:
    """One row: rows, a checksum of the columns that are no doubles, and the sum of the doubles to the cent. Two tables
    with equal marks hold the same rows, whatever their order and files."""
    doubles = [c for c, kind in df.dtypes if kind == "double"]
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in df.columns if c not in doubles])
    money = [F.coalesce(F.col(c).cast("decimal(18,2)"), F.lit(0).cast("decimal(18,2)")) for c in doubles]
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.sum(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")), F.lit(0)).alias("text_checksum"),
        F.sum(sum(money[1:], money[0]) if money else F.lit(0)).cast("double").alias("number_total"))
