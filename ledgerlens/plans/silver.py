"""Silver layer: raw rows deduplicated, rejected or kept, typed, and given derived flags.

One declaration per table (key, preferred copy, derived columns); ``refine`` applies it under a profile.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens import profiles as p
from ledgerlens import schemas
from ledgerlens.functions.measures import hours_between, ratio, rounded
from ledgerlens.functions.risk import risk_band
from ledgerlens.operators import quality
from ledgerlens.operators.dedup import keep_one
from ledgerlens.profiles import Profile

LOAD_STAMP = "_silver_load_ts"

_MOMENT = F.try_to_timestamp
_c = F.col


def _day(name: str) -> Column:
    """Text to date; unparsable text becomes NULL instead of failing the job."""
    return _c(name).try_cast("date")


@dataclass(frozen=True)
class Refinement:
    """How one raw table becomes its silver table."""

    derive: Callable[[Profile, Column], dict[str, Column]]
    prefer: tuple[str, ...] = field(default=())


def _customers(profile: Profile, as_of: Column) -> dict[str, Column]:
    score = _c("risk_score")
    return {
        "date_joined": _day("date_joined"),
        "risk_band": risk_band(score, profile.band_edges, profile.band_edge_included),
        "is_high_risk": _c("is_pep") | _c("is_sanctioned") | (score > profile.high_risk_above),
    }


def _accounts(profile: Profile, as_of: Column) -> dict[str, Column]:
    out = {
        "open_date": _day("open_date"),
        "balance": _c("balance").cast("double"),
        "is_overdrawn": _c("balance") < 0,
    }
    if profile.account_age:
        out["account_age_days"] = F.datediff(as_of, _day("open_date"))
    return out


def _merchants(profile: Profile, as_of: Column) -> dict[str, Column]:
    risky = _c("risk_level").isin(*p.HIGH_RISK_MERCHANT_LEVELS) | _c("is_blacklisted")
    out = {"is_high_risk_merchant": risky}
    if profile.reject_rows:
        out["registered_date"] = _day("registered_date")
    return out


def _transactions(profile: Profile, as_of: Column) -> dict[str, Column]:
    day = _day("txn_date")
    out = {
        "txn_datetime": _MOMENT("txn_datetime"),
        "txn_date": day,
        "amount": _c("amount").cast("double"),
        "is_high_value": _c("amount") > p.HIGH_VALUE_ABOVE,
        "is_odd_hour": _c("txn_hour").isin(*profile.odd_hours),
        "is_declined": _c("status") == "Declined",
    }
    if profile.calendar_columns:
        out |= {"week_of_year": F.weekofyear(day), "month": F.month(day)}
    return out


def _fraud_labels(profile: Profile, as_of: Column) -> dict[str, Column]:
    detected, confirmed = _MOMENT("detected_datetime"), _MOMENT("confirmed_datetime")
    recovered = ratio("recovered_amount", "loss_amount")
    if profile.rate_digits is None:
        recovered = F.when(_c("loss_amount") > 0, recovered)
    else:
        recovered = rounded(recovered, profile.rate_digits)
    return {
        "detected_datetime": detected,
        "confirmed_datetime": confirmed,
        "loss_amount": _c("loss_amount").cast("double"),
        "recovered_amount": _c("recovered_amount").cast("double"),
        "recovery_rate": recovered,
        "hours_to_confirm": hours_between(confirmed, detected),
        "is_resolved": _c("fraud_status").isin(*p.RESOLVED_LABEL_STATUSES),
    }


def _alerts(profile: Profile, as_of: Column) -> dict[str, Column]:
    created, resolved = _MOMENT("created_datetime"), _MOMENT("resolved_datetime")
    return {
        "created_datetime": created,
        "resolved_datetime": resolved,
        "score": _c("score").cast("double"),
        "resolution_hours": hours_between(resolved, created),
        "is_true_positive": _c("alert_status").contains("True Positive"),
    }


def _audit_logs(profile: Profile, as_of: Column) -> dict[str, Column]:
    logged = _MOMENT("log_datetime")
    out = {"log_datetime": logged, "is_failure": _c("status") == "Failure"}
    if profile.log_date:
        out["log_date"] = F.to_date(logged)
    return out


REFINEMENTS = {
    "customers": Refinement(_customers, prefer=("date_joined",)),
    "accounts": Refinement(_accounts, prefer=("open_date",)),
    "merchants": Refinement(_merchants, prefer=("registered_date",)),
    "transactions": Refinement(_transactions, prefer=("txn_datetime",)),
    "fraud_labels": Refinement(_fraud_labels, prefer=("detected_datetime",)),
    "alerts": Refinement(_alerts, prefer=("created_datetime",)),
    "audit_logs": Refinement(_audit_logs, prefer=("log_datetime",)),
}


def unique_rows(table: str, raw: DataFrame) -> DataFrame:
    """One raw row per primary key: the latest, any tie settled by the remaining columns."""
    return keep_one(raw, schemas.PRIMARY_KEY[table], REFINEMENTS[table].prefer)


def refine(table: str, raw: DataFrame, profile: Profile = p.BATCH, as_of: date | str | None = None,
           deduplicate: bool | None = None) -> DataFrame:
    """The silver table of one raw table.

    ``as_of`` fixes "today" for account ages. ``deduplicate=False`` leaves deduplication to the
    caller (a stream does it with a bound on lateness).
    """
    today = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    rows = raw
    if profile.deduplicate if deduplicate is None else deduplicate:
        rows = unique_rows(table, rows)
    if profile.reject_rows:
        rows = quality.accepted(rows, quality.REQUIRED[table])
    columns = REFINEMENTS[table].derive(profile, today)
    if profile.stamp_load:
        columns = columns | {LOAD_STAMP: F.current_timestamp()}
    return rows.withColumns(columns)


def quarantine(table: str, raw: DataFrame) -> DataFrame:
    """What the rejecting profile leaves out of a table, with the reasons."""
    return quality.rejected(unique_rows(table, raw), quality.REQUIRED[table])


def silver_layer(raw: Mapping[str, DataFrame], profile: Profile = p.BATCH,
                 as_of: date | str | None = None) -> dict[str, DataFrame]:
    return {name: refine(name, df, profile, as_of) for name, df in raw.items()}
