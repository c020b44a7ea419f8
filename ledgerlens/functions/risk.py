"""Ordered-threshold classifications."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: names and edges of the bands and tiers --------------------------------------
BANDS = ("Low", "Medium", "High", "Critical")
MODEL_TIER_EDGES = (0.3, 0.6, 0.85, 1.0)
POLICY_TIERS = (
    (0.8, "Critical", "Auto-block transaction + immediate investigation"),
    (0.6, "High", "Priority queue for analyst review"),
    (0.4, "Medium", "Standard review within 24h"),
    (None, "Low", "Log and monitor"),
)
CHANNEL_RISK = {"API": 3, "Web": 2, "Mobile": 1}
MERCHANT_RISK_RANK = {"Low": 0, "Medium": 1, "High": 2, "Very High": 3}
# ------------------------------------------------------------------------------------------------


def first_match(cases: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """The value of the first true condition."""
    out = None
    for condition, value in cases:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def risk_band(score: Column, edges: Sequence[float], edge_included: bool) -> Column:
    """Low / Medium / High below (or up to) the edges, Critical otherwise and for a missing score."""
    below = (lambda e: score <= e) if edge_included else (lambda e: score < e)
    return first_match([(below(e), name) for e, name in zip(edges, BANDS)], BANDS[-1])


def model_tier(probability: Column) -> Column:
    """Right-closed bins of a model probability; 0 and anything outside (0, 1] has no tier."""
    inside = (probability > 0) & (probability <= MODEL_TIER_EDGES[-1])
    tier = first_match([(probability <= e, name) for e, name in zip(MODEL_TIER_EDGES, BANDS)])
    return F.when(inside, tier)


def _policy(probability: Column, field: int) -> Column:
    *cut, last = POLICY_TIERS
    tiered = first_match([(probability >= row[0], row[field]) for row in cut], last[field])
    return F.when(probability.isNotNull(), tiered)


def policy_tier(probability: Column) -> Column:
    """Tier of the investigation policy (lower edge included)."""
    return _policy(probability, 1)


def policy_action(probability: Column) -> Column:
    """What the investigation policy does with a transaction of this probability."""
    return _policy(probability, 2)


def lookup(c: Column, table: dict[str, int], default: int | None) -> Column:
    return first_match([(c == key, value) for key, value in table.items()], default)
