"""Additive attributions of a boosted-tree model, for every row, inside Spark tasks.

Path-dependent Shapley values (Lundberg et al.), tabulated per leaf as in "Fast TreeSHAP" (Yang, 2021):
a leaf's contribution depends on a row only through *which* of the features on its path the row
satisfies, at most ``2^depth`` patterns. Neighbouring leaves of a tree share most of their comparisons, so their tables
are added up into one of a block, whose pattern says between which of the block's cuts each feature of a row lies: a row
takes one lookup a block of some eight leaves, and one a feature to find the pattern. The tables are built once from the
model, their size is bounded by the model's rounds and depth, and they are broadcast; a task looks up patterns for a few
thousand rows at a time.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from math import factorial, prod

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Leaf:
    """One leaf: its weighted output and, per feature on its path, bounds and share of training rows."""

    value: float
    features: tuple[int, ...]
    above: tuple[float, ...]  # satisfied when x > above ...
    upto: tuple[float, ...]  # ... and x <= upto
    shares: tuple[float, ...]


def read_leaves(spark: SparkSession, model: PipelineModel, path: str) -> list[Leaf]:
    """Leaves of the saved model's trees (its public parquet layout); outputs are in log-odds."""
    last = len(model.stages) - 1
    stage = f"{path}/stages/{str(last).zfill(len(str(len(model.stages))))}_{model.stages[last].uid}"
    # size bounded by the model: rounds x 2^(depth + 1) nodes
    weights = dict(spark.read.parquet(f"{stage}/treesMetadata").select("_1", "_3").collect())
    rows = spark.read.parquet(f"{stage}/data").selectExpr(
        "treeID", "nodeData.id", "nodeData.prediction", "nodeData.impurityStats[0] as cover",
        "nodeData.leftChild as low", "nodeData.rightChild as high", "nodeData.split.featureIndex as feature",
        "get(nodeData.split.leftCategoriesOrThreshold, 0) as threshold").collect()
    trees: dict[int, dict[int, object]] = {}
    for row in rows:
        trees.setdefault(row["treeID"], {})[row["id"]] = row
    leaves: list[Leaf] = []
    for tree, nodes in trees.items():
        # log-odds are twice MLlib's margin
        leaves += _leaves_of(nodes, 2.0 * weights[tree])
    return leaves


def _leaves_of(nodes: dict, weight: float) -> list[Leaf]:
    found = []
    todo = [(0, {})]
    while todo:
        at, path = todo.pop()
        node = nodes[at]
        if node["low"] < 0:
            order = sorted(path)
            found.append(Leaf(weight * node["prediction"], tuple(order), *(
                tuple(path[f][i] for f in order) for i in range(3))))
            continue
        f, cut = node["feature"], node["threshold"]
        above, upto, share = path.get(f, (-np.inf, np.inf, 1.0))
        low, high = (nodes[node[side]]["cover"] / node["cover"] for side in ("low", "high"))
        todo.append((node["low"], path | {f: (above, min(upto, cut), share * low)}))
        todo.append((node["high"], path | {f: (max(above, cut), upto, share * high)}))
    return found


def baseline(leaves: Sequence[Leaf]) -> float:
    """Expected output of the model: what contributions add to."""
    return float(sum(leaf.value * np.prod(leaf.shares) for leaf in leaves))


def _pattern_table(values: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """Contributions ``[leaf, pattern, feature]`` for leaves with the same number of path features.

    Bit ``k`` of a pattern says whether the row satisfies the leaf's ``k``-th feature.
    """
    leaves, d = shares.shape
    patterns = np.arange(1 << d)
    size = np.array([bin(p).count("1") for p in patterns])
    # product of the shares of the features outside each set
    outside = np.ones((leaves, 1 << d))
    for k in range(d):
        outside[:, (patterns >> k & 1) == 0] *= shares[:, k:k + 1]
    chance = np.array([factorial(n) * factorial(d - n - 1) / factorial(d) if n < d else 0.0 for n in range(d + 1)])
    table = np.empty((leaves, 1 << d, d))
    for i in range(d):
        without = (patterns >> i & 1) == 0
        reach = np.zeros((leaves, 1 << d))
        reach[:, without] = chance[size[without]] * outside[:, patterns[without] | (1 << i)]
        for k in range(d):  # sum over all subsets of the satisfied features
            if k != i:
                has = (patterns >> k & 1) == 1
                reach[:, has] += reach[:, patterns[has] ^ (1 << k)]
        satisfied = (patterns >> i & 1).astype(float)
        table[:, :, i] = values[:, None] * (satisfied - shares[:, i:i + 1]) * reach[:, patterns & ~(1 << i)]
    return table


@dataclass(frozen=True)
class Block:
    """Leaves looked up together. A pattern is a number with a digit for each of ``features``: how many of the block's
    cuts of that feature lie below the row. ``places`` has, a feature, the digit's share of the pattern by the row's
    place among the feature's cuts over the whole model; ``table`` the contributions ``[feature, pattern]``."""

    features: tuple[int, ...]
    places: tuple[np.ndarray, ...]
    table: np.ndarray


# Patterns of a block. A leaf with more has a block of its own.
BLOCK_PATTERNS = 1024
# Rows that a task places and looks up together.
ROWS_AT_ONCE = 4096


def _comparisons(leaf: Leaf) -> list[tuple[int, float]]:
    return sorted({(f, x) for f, a, u in zip(leaf.features, leaf.above, leaf.upto) for x in (a, u) if np.isfinite(x)})


def _patterns(compared: Iterable[tuple[int, float]]) -> int:
    """One more outcome a feature than it has cuts, and all combinations of them."""
    return prod(n + 1 for n in Counter(f for f, _ in compared).values())


def grouped(leaves: Sequence[Leaf], patterns: int = BLOCK_PATTERNS) -> list[tuple[list[int], list[tuple[int, float]]]]:
    """Runs of leaves whose comparisons together have no more than ``patterns`` outcomes, with these."""
    runs: list[tuple[list[int], list[tuple[int, float]]]] = []
    for k, leaf in enumerate(leaves):
        if not leaf.features:
            continue
        own = set(_comparisons(leaf))
        if runs and _patterns(own.union(runs[-1][1])) <= patterns:
            runs[-1] = (runs[-1][0] + [k], sorted(own.union(runs[-1][1])))
        else:
            runs.append(([k], sorted(own)))
    return runs


def thresholds(leaves: Sequence[Leaf], features: int) -> list[np.ndarray]:
    """Distinct cuts of each feature over the whole model, ascending."""
    cuts: list[set[float]] = [set() for _ in range(features)]
    for leaf in leaves:
        for f, x in _comparisons(leaf):
            cuts[f].add(x)
    return [np.array(sorted(c)) for c in cuts]


def blocks(leaves: Sequence[Leaf], runs: Sequence[tuple[list[int], list[tuple[int, float]]]],
           cuts: Sequence[np.ndarray]) -> list[Block]:
    """The lookup tables of all runs of leaves."""
    tables: dict[int, np.ndarray] = {}
    for d in sorted({len(leaf.features) for leaf in leaves} - {0}):
        same = [k for k, leaf in enumerate(leaves) if len(leaf.features) == d]
        made = _pattern_table(np.array([leaves[k].value for k in same]), np.array([leaves[k].shares for k in same]))
        tables |= dict(zip(same, made))
    found = []
    for members, compared in runs:
        features = sorted({f for f, _ in compared})
        own = {f: [x for g, x in compared if g == f] for f in features}
        outcomes, size, digits, places = np.arange(_patterns(compared)), 1, [], []
        for f in features:
            base = len(own[f]) + 1
            digits.append(outcomes // size % base)
            below = np.searchsorted(np.searchsorted(cuts[f], own[f]), np.arange(len(cuts[f]) + 1), "left")
            places.append(below.astype(np.intp) * size)
            size *= base
        row = {f: k for k, f in enumerate(features)}
        table = np.zeros((len(features), len(outcomes)))
        for k in members:
            leaf, pattern = leaves[k], np.zeros(len(outcomes), dtype=np.int64)
            for place, (f, low, high) in enumerate(zip(leaf.features, leaf.above, leaf.upto)):
                satisfied = np.ones(len(outcomes), dtype=bool)
                if np.isfinite(low):
                    satisfied &= digits[row[f]] > own[f].index(low)
                if np.isfinite(high):
                    satisfied &= digits[row[f]] <= own[f].index(high)
                pattern |= satisfied.astype(np.int64) << place
            for place, f in enumerate(leaf.features):
                table[row[f]] += tables[k][pattern, place]
        found.append(Block(tuple(features), tuple(places), table))
    return found


def contributions(inputs: np.ndarray, tables: Sequence[Block], cuts: Sequence[np.ndarray]) -> np.ndarray:
    """Contributions ``[feature, row]`` of rows ``[row, feature]``."""
    out = np.zeros(inputs.shape[::-1])
    for start in range(0, len(inputs), ROWS_AT_ONCE):
        some = inputs[start:start + ROWS_AT_ONCE].T
        at = [np.searchsorted(c, x, "left") for c, x in zip(cuts, some)]
        part = np.zeros(some.shape)
        pattern, share, value = np.empty(some.shape[1], np.intp), np.empty(some.shape[1], np.intp), np.empty(some.shape[1])
        for block in tables:
            pattern[:] = 0
            for f, places in zip(block.features, block.places):
                places.take(at[f], out=share, mode="clip")
                pattern += share
            for f, row in zip(block.features, block.table):
                row.take(pattern, out=value, mode="clip")
                part[f] += value
        out[:, start:start + ROWS_AT_ONCE] = part
    return out


# Largest lookup tables that are shipped to the tasks: 300 rounds of depth 6 take some 100 MB.
TABLE_BYTES = 512 << 20


def attribute(spark: SparkSession, rows: DataFrame, features: Sequence[str], leaves: Sequence[Leaf],
              keep: Sequence[str], table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The ``keep`` columns of every row and the contribution of each feature, under its name.

    Rows are placed among the model's distinct cuts once; a block of leaves then takes two small lookups a feature. Models whose tables would exceed ``table_bytes`` raise before anything is built."""
    runs = grouped(leaves)
    needed = sum(8 * len({f for f, _ in compared}) * _patterns(compared) for _, compared in runs)
    if needed > table_bytes:
        raise ValueError(f"lookup tables need {needed} bytes, more than table_bytes={table_bytes}: use shallower trees")
    cuts = thresholds(leaves, len(features))
    shared = spark.sparkContext.broadcast((blocks(leaves, runs, cuts), cuts))
    names, kept = list(features), list(keep)

    def attributed(batches):
        for batch in batches:
            result = batch[kept].copy()
            for name, values in zip(names, contributions(batch[names].to_numpy(dtype=float), *shared.value)):
                result[name] = values
            yield result

    types = dict(rows.dtypes)
    schema = ", ".join([f"{c} {types[c]}" for c in kept] + [f"{n} double" for n in names])
    return rows.select(*kept, *[n for n in names if n not in kept]).mapInPandas(attributed, schema)
