"""Margins of a boosted-tree model, for every row, inside Spark tasks.

MLlib walks the trees row by row from node to node. Here a task finds the place of a few thousand rows among the model's
distinct cuts of each input once, and then moves all of them down a tree a level at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, StructField, StructType

# Rows that a task moves down the trees together.
ROWS_AT_ONCE = 4096


@dataclass(frozen=True)
class Tree:
    """Nodes in arrays. Rows whose place among the cuts of ``feature`` is over ``place`` go from a node to the one after
    its child ``low``, others to ``low``; a leaf sends all rows to itself. ``value`` is weighted."""

    feature: np.ndarray
    place: np.ndarray
    low: np.ndarray
    value: np.ndarray
    depth: int


_SPLIT, _LEAF = re.compile(r"If \(feature (\d+) <= (\S+)\)"), re.compile(r"Predict: (\S+)")


def read_trees(model: GBTClassificationModel) -> tuple[list[Tree], list[np.ndarray]]:
    """The trees of a model from its text form, and the distinct cuts of each input, ascending."""
    splits: list[list[tuple]] = []  # (feature, cut, low, depth) or (None, value, -1, depth) a node
    for text in re.split(r"\n  Tree \d+ \(weight [^)]*\):\n", model.toDebugString)[1:]:
        nodes: list[list] = [[None] * 4]
        at = [(0, 0)]  # nodes to fill and their depth, the next one last
        for line in filter(None, map(str.strip, text.split("\n"))):
            if line.startswith("Else"):
                continue
            node, depth = at.pop()
            if found := _SPLIT.fullmatch(line):
                nodes[node] = [int(found[1]), float(found[2]), len(nodes), depth]
                at += [(len(nodes) + 1, depth + 1), (len(nodes), depth + 1)]
                nodes += [[None] * 4, [None] * 4]
            elif found := _LEAF.fullmatch(line):
                nodes[node] = [None, float(found[1]), node, depth]
            else:
                raise ValueError(f"not a split by a cut or a leaf: {line}")
        if at:
            raise ValueError("a tree ends before its leaves")
        splits.append([tuple(n) for n in nodes])
    if len(splits) != model.getNumTrees:
        raise ValueError(f"read {len(splits)} of {model.getNumTrees} trees")
    cuts = [np.array(sorted({c for nodes in splits for g, c, *_ in nodes if g == f})) for f in range(model.numFeatures)]
    trees = []
    for nodes, weight in zip(splits, model.treeWeights):
        inner = [f is not None for f, *_ in nodes]
        trees.append(Tree(
            np.array([f or 0 for f, *_ in nodes], np.intp),
            np.array([np.searchsorted(cuts[f], c) if f is not None else np.iinfo(np.intp).max for f, c, *_ in nodes], np.intp),
            np.array([low for *_, low, _ in nodes], np.intp),
            np.array([0.0 if is_inner else weight * c for is_inner, (_, c, *_) in zip(inner, nodes)]),
            max(depth for *_, depth in nodes)))
    return trees, cuts


def margins(inputs: Sequence[np.ndarray], trees: Sequence[Tree], cuts: Sequence[np.ndarray]) -> np.ndarray:
    """Weighted sum of the trees' values for rows ``[input][row]``."""
    out = np.zeros(len(inputs[0]))
    for start in range(0, len(out), ROWS_AT_ONCE):
        some = slice(start, start + ROWS_AT_ONCE)
        at = np.stack([np.searchsorted(c, x[some], "left") for c, x in zip(cuts, inputs)])
        rows = at.shape[1]
        flat, row = at.ravel(), np.arange(rows)
        for tree in trees:
            first = tree.feature * rows
            node = tree.low[0] + (at[tree.feature[0]] > tree.place[0])
            for _ in range(tree.depth - 1):
                own = flat.take(first.take(node) + row)
                node = tree.low.take(node) + (own > tree.place.take(node))
            out[some] += tree.value.take(node)
    return out


def with_probability(model: GBTClassificationModel, rows: DataFrame, inputs: Sequence[str], name: str) -> DataFrame:
    """All rows with the model's probability of class 1."""
    shared = rows.sparkSession.sparkContext.broadcast(read_trees(model))
    names = list(inputs)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [np.asarray(batch.column(n).to_numpy(zero_copy_only=False), float) for n in names]
            if any(np.isnan(v).any() for v in values):
                raise ValueError("rows to score have inputs that are NULL or not a number")
            with np.errstate(over="ignore"):
                p = 1 / (1 + np.exp(-2 * margins(values, *shared.value)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], [*batch.schema.names, name])

    kept = rows.drop(name) if name in rows.columns else rows
    return kept.mapInArrow(scored, StructType([*kept.schema.fields, StructField(name, DoubleType())]))
