"""The two sets of business thresholds under which the layers can be built.

``BATCH`` rejects bad rows and deduplicates; ``DECLARATIVE`` keeps every row, only measures quality,
and uses other cut-offs. Which one applies is data, not code: every dataset function takes a profile.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Profile:
    name: str
    # rows
    deduplicate: bool
    reject_rows: bool
    stamp_load: bool
    # customers: upper edges of Low, Medium, High; everything else (also no score) is Critical
    band_edges: tuple[float, float, float]
    band_edge_included: bool
    high_risk_above: float
    # transactions
    odd_hours: tuple[int, ...]
    calendar_columns: bool
    # derived measures
    account_age: bool
    log_date: bool
    rate_digits: int | None
    # gold
    flags_as_int: bool
    zero_when_absent: bool


# ---- fixed values: the cut-offs of the two profiles --------------------------------------------
BATCH = Profile(
    name="batch",
    deduplicate=True,
    reject_rows=True,
    stamp_load=True,
    band_edges=(25, 50, 75),
    band_edge_included=False,
    high_risk_above=75,
    odd_hours=(0, 1, 2, 3, 4, 5),
    calendar_columns=True,
    account_age=True,
    log_date=True,
    rate_digits=4,
    flags_as_int=True,
    zero_when_absent=False,
)

DECLARATIVE = Profile(
    name="declarative",
    deduplicate=False,
    reject_rows=False,
    stamp_load=False,
    band_edges=(30, 60, 80),
    band_edge_included=True,
    high_risk_above=70,
    odd_hours=(0, 1, 2, 3, 4, 5, 23),
    calendar_columns=False,
    account_age=False,
    log_date=False,
    rate_digits=None,
    flags_as_int=False,
    zero_when_absent=True,
)

HIGH_VALUE_ABOVE = 10_000
HIGH_RISK_MERCHANT_LEVELS = ("High", "Very High")
RESOLVED_LABEL_STATUSES = ("Confirmed", "Resolved")
# ------------------------------------------------------------------------------------------------
