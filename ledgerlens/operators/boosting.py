"""Boosted trees of MLlib's model class, grown from histograms by tasks that run side by side from the first round to
the last.

MLlib starts six jobs a round, each of which reads all rows again and takes every value through the JVM. Here the inputs
become bins of a byte once, a task keeps its share of the rows in numpy arrays, and one job trains all rounds: for each
level of a tree the tasks tell each other their histograms, and each picks the same splits from the sums. Of two sisters
only the smaller one is counted, the other is what remains of their parent.

The trees are MLlib's: logistic loss on labels of -1 and 1, the first tree on the labels, each other one on the gradient,
leaves of weighted means, splits by variance, columns drawn a node, rows drawn a round. Candidate cuts come from all rows
(MLlib: a sample of 10,000). Gradients are summed as whole multiples of 2^-24 and rows are drawn by a hash of their key,
so other partitionings and retried tasks give the same trees but for cuts of inputs with over ``SUMMARY`` distinct values.
"""

from __future__ import annotations

import base64
import json
import os
import pickle
import shutil
import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import partial
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import shared_folder

# Rows of a block of bins as it is moved, and rows that are worth a task of their own.
BLOCK_ROWS = 1 << 14
ROWS_A_TASK = 1 << 15
# Values that a task keeps of an input to place the cuts by; rows taken in before they are thinned to that.
SUMMARY = 4096
THINNED_AT = 1 << 18
# Rows that are counted together, few enough to stay in the cache of a core from input to input.
ROWS_AT_ONCE = 1 << 14
# Gradients (at most 4) and their squares are summed as whole multiples of one part in these.
SCALE, SQUARE_SCALE = float(1 << 24), float(1 << 20)
# Gains below it are rounding.
LEAST_GAIN = 1e-12


@dataclass(frozen=True)
class Growth:
    """What all tasks of a training know."""

    cuts: tuple[np.ndarray, ...]
    positive_weight: float
    rounds: int
    depth: int
    step: float
    row_share: float
    column_share: float
    seed: int
    stop_below: float | None
    folder: str | None


# ------------------------------------------------------------------------------- candidate cuts


def _thinned(values: np.ndarray, weights: np.ndarray, most: int = SUMMARY) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, ascending, with their weights; of more than ``most`` those at equal steps of weight, each with
    the weight up to it."""
    values, at = np.unique(values, return_inverse=True)
    weights = np.bincount(at, weights, len(values))
    if len(values) <= most:
        return values, weights
    upto = np.cumsum(weights)
    kept = np.searchsorted(upto, np.arange(1, most + 1) * (upto[-1] / most))
    kept = np.unique(np.minimum(kept, len(values) - 1))
    return values[kept], np.diff(upto[kept], prepend=0.0)


def placed_cuts(values: np.ndarray, weights: np.ndarray, bins: int) -> np.ndarray:
    """Cuts between distinct values, half way: all, or those at equal steps of weight if there are ``bins`` or more."""
    middles = values[:-1] / 2 + values[1:] / 2
    if len(values) > bins:
        step = weights.sum() / bins
        chosen, upto, target = [], float(weights[0]), float(step)
        for k in range(1, len(values)):
            before, upto = upto, upto + float(weights[k])
            if abs(before - target) < abs(upto - target):
                chosen.append(k - 1)
                target += step
        middles = middles[chosen]
    return middles[np.isfinite(middles)]


def _summaries(batches: Iterator[pa.RecordBatch], inputs: Sequence[str]) -> Iterator[pa.RecordBatch]:
    held = {f: (np.empty(0), np.empty(0)) for f in inputs}
    waiting, rows = [], 0

    def taken_in():
        weights = np.concatenate([b.column("weight").to_numpy() for b in waiting])
        for f in inputs:
            values = np.concatenate([b.column(f).to_numpy(zero_copy_only=False) for b in waiting])
            some = ~np.isnan(values)
            held[f] = _thinned(np.concatenate([held[f][0], values[some]]), np.concatenate([held[f][1], weights[some]]))

    for batch in batches:
        waiting.append(batch)
        rows += batch.num_rows
        if rows >= THINNED_AT:
            taken_in()
            waiting, rows = [], 0
    if waiting:
        taken_in()
    yield pa.RecordBatch.from_pydict({
        "input": pa.array(range(len(inputs)), pa.int32()),
        "vals": pa.array([held[f][0] for f in inputs], pa.list_(pa.float64())),
        "weights": pa.array([held[f][1] for f in inputs], pa.list_(pa.float64()))})


def _merged(bins: int, table: pa.Table) -> pa.Table:
    values, weights = (np.concatenate([np.asarray(v.as_py(), float) for v in table.column(c)]) for c in ("vals", "weights"))
    values, weights = _thinned(values, weights, len(values))
    cuts = placed_cuts(values, weights, bins) if len(values) else np.empty(0)
    return pa.table({"input": pa.array([table.column("input")[0].as_py()], pa.int32()),
                     "cuts": pa.array([cuts], pa.list_(pa.float64()))})


def candidate_cuts(rows: DataFrame, inputs: Sequence[str], bins: int) -> tuple[np.ndarray, ...]:
    """For each input fewer than ``bins`` cuts, ascending, by the weights of all rows."""
    summaries = rows.select(*inputs, "weight").mapInArrow(
        partial(_summaries, inputs=list(inputs)), "input int, vals array<double>, weights array<double>")

    def merged(table: pa.Table) -> pa.Table:
        return _merged(bins, table)

    placed = summaries.groupBy("input").applyInArrow(merged, "input int, cuts array<double>")
    found = {r["input"]: np.array(r["cuts"], float) for r in placed.collect()}  # a row an input
    return tuple(found.get(k, np.empty(0)) for k in range(len(inputs)))


# ------------------------------------------------------------------------------- rows as bins


def _bin_type(cuts: Sequence[np.ndarray]) -> type:
    return np.uint8 if max(map(len, cuts)) < 256 else np.uint16


def _blocks(batches: Iterator[pa.RecordBatch], inputs: Sequence[str], cuts: Sequence[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Blocks of rows: places among the cuts ``[input, row]``, label, mark and whether held back."""
    waiting, rows, kind = [], 0, _bin_type(cuts)

    def block():
        column = lambda name: np.concatenate([b.column(name).to_numpy(zero_copy_only=False) for b in waiting])
        values = [column(f) for f in inputs]
        if any(np.isnan(v).any() for v in values):
            raise ValueError("rows to train on have inputs that are NULL or not a number")
        bins = np.stack([np.searchsorted(c, v, "left").astype(kind) for c, v in zip(cuts, values)])
        parts = (bins, column("positive").astype(np.uint8), column("mark").astype(np.int64), column("aside").astype(np.uint8))
        return pa.RecordBatch.from_pydict(
            {n: pa.array([p.tobytes()], pa.binary()) for n, p in zip(("bins", "positive", "mark", "aside"), parts)})

    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_ROWS):
            some = batch.slice(start, BLOCK_ROWS)
            if rows + some.num_rows > BLOCK_ROWS and waiting:
                yield block()
                waiting, rows = [], 0
            waiting.append(some)
            rows += some.num_rows
    if rows:
        yield block()


class _Rows:
    """A task's share of the rows."""

    def __init__(self, batches: Iterator[pa.RecordBatch], cuts: Sequence[np.ndarray]):
        kind = _bin_type(cuts)
        bins, rest = [], {"positive": (np.uint8, []), "mark": (np.int64, []), "aside": (np.uint8, [])}
        for batch in batches:
            for k in range(batch.num_rows):
                bins.append(np.frombuffer(batch.column("bins")[k].as_buffer(), kind).reshape(len(cuts), -1))
                for name, (of, parts) in rest.items():
                    parts.append(np.frombuffer(batch.column(name)[k].as_buffer(), of))
        self.bins = np.concatenate([np.empty((len(cuts), 0), kind), *bins], axis=1)
        del bins
        whole = {name: np.concatenate([np.empty(0, of), *parts]) for name, (of, parts) in rest.items()}
        self.positive, self.aside = whole["positive"].astype(np.intp), whole["aside"].astype(bool)
        self.mark = whole["mark"].view(np.uint64)
        self.sign = self.positive * 2.0 - 1.0

    def drawn(self, seed: int, number: int, share: float) -> np.ndarray:
        """Whether each row takes part in a round, by a hash of its mark."""
        if share >= 1:
            return ~self.aside
        mixed = self.mark ^ np.random.default_rng([seed, number]).integers(0, 1 << 64, dtype=np.uint64, endpoint=False)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            mixed ^= mixed >> np.uint64(shift)
            mixed *= np.uint64(factor)
        mixed ^= mixed >> np.uint64(31)
        return (mixed < np.uint64(int(share * 2.0 ** 64))) & ~self.aside


# ------------------------------------------------------------------------------- what tasks tell each other


class _Exchange:
    """Messages of tasks that run side by side, each to all of them, in the order of the tasks.

    They go through the folder if all tasks see what the others write there, otherwise through the barrier of Spark,
    which takes a second a time.
    """

    def __init__(self, folder: str | None):
        self._context, self._step = BarrierTaskContext.get(), 0
        self._me, self._parts = self._context.partitionId(), len(self._context.getTaskInfos())
        self._folder = None
        if self._parts == 1:
            return
        run = self._context.allGather(str(self._context.taskAttemptId()))[0]  # another one in a retried stage
        at = f"{folder}/{run}" if folder else None
        seen = False
        if at:
            try:
                os.makedirs(at, exist_ok=True)
                open(f"{at}/here-{self._me}", "w").close()
                seen = True
            except OSError:
                pass
        self._context.barrier()
        seen = seen and all(os.path.exists(f"{at}/here-{k}") for k in range(self._parts))
        if all(json.loads(m) for m in self._context.allGather(json.dumps(seen))):
            self._folder = at

    def all(self, message: object) -> list:
        if self._parts == 1:
            return [message]
        packed = pickle.dumps(message, protocol=5)
        if self._folder is None:
            return [pickle.loads(base64.b64decode(m)) for m in self._context.allGather(base64.b64encode(packed).decode())]
        name = lambda step, k: f"{self._folder}/{step}-{k}"
        with open(f"{self._folder}/new-{self._me}", "wb") as f:
            f.write(packed)
        os.replace(f"{self._folder}/new-{self._me}", name(self._step, self._me))
        told = [message if k == self._me else pickle.loads(_awaited(name(self._step, k))) for k in range(self._parts)]
        if self._step:  # who has written this step has read the last one
            os.remove(name(self._step - 1, self._me))
        self._step += 1
        return told

    def sums(self, *arrays: np.ndarray) -> list[np.ndarray]:
        told = self.all(arrays)
        return [sum((t[k] for t in told[1:]), told[0][k]) for k in range(len(arrays))]


def _awaited(path: str) -> bytes:
    while True:
        try:
            with open(path, "rb") as f:
                return f.read()
        except FileNotFoundError:
            time.sleep(0.0005)


# ------------------------------------------------------------------------------- trees


@dataclass
class Node:
    """Rows and sums of targets by class, and once it is split the input, the place of its cut and the children."""

    counts: np.ndarray
    sums: np.ndarray
    squares: np.ndarray = field(default_factory=lambda: np.zeros(2))
    gain: float = -1.0
    feature: int = -1
    cut: int = -1
    low: Node | None = None
    high: Node | None = None

    def figures(self, positive_weight: float) -> tuple[float, float, float]:
        """Weight, weighted sum of the targets, and of their squares."""
        return (float(self.counts[0] + positive_weight * self.counts[1]),
                float(self.sums[0] + positive_weight * self.sums[1]) / SCALE,
                float(self.squares[0] + positive_weight * self.squares[1]) / SQUARE_SCALE)

    def mean(self, positive_weight: float) -> float:
        weight, total, _ = self.figures(positive_weight)
        return total / weight if weight > 0 else 0.0


class _Grower:
    def __init__(self, rows: _Rows, growth: Growth, exchange: _Exchange):
        self.rows, self.growth, self.exchange = rows, growth, exchange
        sizes = [len(c) + 1 for c in growth.cuts]
        self.width = max(sizes)
        # the used ones of ``width`` places an input
        self.used = np.concatenate([np.arange(n) + f * self.width for f, n in enumerate(sizes)])
        self.drawn_columns = int(np.ceil(len(sizes) * growth.column_share))

    def histograms(self, groups: Sequence[np.ndarray], target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts and sums of the target ``[group, class, place]`` over the rows of all tasks; each input has ``width``
        places."""
        rows, kinds = self.rows, 2 * len(groups)
        counts, sums = (np.zeros((len(self.growth.cuts), kinds * self.width), of) for of in (np.int64, float))
        chosen = np.concatenate(groups)
        group = np.repeat(np.arange(0, kinds * self.width, 2 * self.width), [len(g) for g in groups])
        for start in range(0, len(chosen), ROWS_AT_ONCE):
            some = chosen[start:start + ROWS_AT_ONCE]
            base = group[start:start + ROWS_AT_ONCE] + rows.positive.take(some) * self.width
            values = target.take(some)
            for f, bins in enumerate(rows.bins):
                at = base + bins.take(some)
                counts[f] += np.bincount(at, minlength=kinds * self.width)
                sums[f] += np.bincount(at, values, kinds * self.width)
        counts, sums = (part.reshape(len(self.growth.cuts), kinds, -1).swapaxes(0, 1) for part in (counts, sums))
        told = self.exchange.sums(counts.reshape(kinds, -1)[:, self.used], sums.reshape(kinds, -1)[:, self.used])
        whole = []
        for part in told:
            full = np.zeros((kinds, len(self.growth.cuts) * self.width), part.dtype)
            full[:, self.used] = part
            whole.append(full.reshape(len(groups), 2, -1))
        return whole[0], whole[1]

    def split(self, nodes: Sequence[Node], histograms: Sequence[tuple[np.ndarray, np.ndarray]],
              columns: np.ndarray) -> None:
        """Find the best cut of each node among its drawn columns, and give it children if there is one."""
        inputs, pw = len(self.growth.cuts), self.growth.positive_weight
        below = np.stack([h[0] for h in histograms]).reshape(len(nodes), 2, inputs, -1).cumsum(-1)
        low = np.stack([h[1] for h in histograms]).reshape(len(nodes), 2, inputs, -1).cumsum(-1)
        counts, sums = (np.stack([getattr(n, a) for n in nodes])[:, :, None, None] for a in ("counts", "sums"))
        both = lambda part: part[:, 0] + pw * part[:, 1]
        n_low, n_all, s_low, s_all = both(below), both(counts), both(low) / SCALE, both(sums) / SCALE
        n_high, s_high = n_all - n_low, s_all - s_low
        rows_low, rows_all = below.sum(1), counts.sum(1)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = (s_low ** 2 / n_low + s_high ** 2 / n_high - s_all ** 2 / n_all) / n_all
        allowed = (rows_low > 0) & (rows_low < rows_all) & (n_low > 0) & (n_high > 0) & columns[:, :, None]
        gain = np.where(allowed, gain, -np.inf).reshape(len(nodes), -1)
        for k, (node, best) in enumerate(zip(nodes, gain.argmax(1))):
            if gain[k, best] > LEAST_GAIN:
                node.gain = float(gain[k, best])
                node.feature, node.cut = divmod(int(best), self.width)
                first = (below[k, :, node.feature, node.cut], low[k, :, node.feature, node.cut])
                node.low = Node(*first)
                node.high = Node(node.counts - first[0], node.sums - first[1])

    def columns(self, number: int, level: int, nodes: int) -> np.ndarray:
        """The columns drawn for each node of a level."""
        draws = np.random.default_rng([self.growth.seed, number, level]).random((nodes, len(self.growth.cuts)))
        return draws.argsort(1).argsort(1) < self.drawn_columns

    def tree(self, number: int, target: np.ndarray) -> tuple[Node, list[tuple[Node, np.ndarray, np.ndarray]]]:
        """A tree on the drawn rows, and its leaves with the drawn and the other rows in them."""
        rows = self.rows
        drawn = rows.drawn(self.growth.seed, number, self.growth.row_share)
        inside, others = np.flatnonzero(drawn), np.flatnonzero(~drawn)
        counts, sums = self.histograms([inside], target)
        root = Node(counts[0][:, :self.width].sum(1), sums[0][:, :self.width].sum(1))
        level, leaves = [(root, inside, others, (counts[0], sums[0]))], []
        for depth in range(self.growth.depth):
            if not level:
                break
            self.split([n for n, *_ in level], [h for *_, h in level], self.columns(number, depth, len(level)))
            halves = []
            for node, inside, others, histogram in level:
                if node.low is None:
                    leaves.append((node, inside, others))
                    continue
                bins = rows.bins[node.feature]
                below, beside = bins.take(inside) <= node.cut, bins.take(others) <= node.cut
                low, high = ((inside.take(np.flatnonzero(a)), others.take(np.flatnonzero(b)))
                             for a, b in ((below, beside), (~below, ~beside)))
                halves.append(((node.low, *low), (node.high, *high), histogram))
            level = []
            if depth + 1 == self.growth.depth:
                leaves += [half for low, high, _ in halves for half in (low, high)]
            elif halves:
                smaller = [int(high[0].counts.sum() < low[0].counts.sum()) for low, high, _ in halves]
                counts, sums = self.histograms([pair[s][1] for pair, s in zip(halves, smaller)], target)
                for k, (pair, s) in enumerate(zip(halves, smaller)):
                    counted, whole = (counts[k], sums[k]), pair[2]
                    remaining = (whole[0] - counted[0], whole[1] - counted[1])
                    level += [(*pair[0], remaining if s else counted), (*pair[1], counted if s else remaining)]
        leaves += [(node, inside, others) for node, inside, others, _ in level]
        return root, leaves


def _squared(node: Node) -> np.ndarray:
    """Fill in the sums of squares of all nodes from those of the leaves."""
    if node.low is not None:
        node.squares = _squared(node.low) + _squared(node.high)
    return node.squares


def _train(rows: _Rows, growth: Growth, exchange: _Exchange) -> list[Node]:
    """The same trees in every task."""
    grower, trees = _Grower(rows, growth, exchange), []
    margin, gradient = np.zeros(len(rows.sign)), rows.sign
    weights = np.where(rows.positive == 1, growth.positive_weight, 1.0)[rows.aside]
    best, kept = np.inf, 1
    for number in range(growth.rounds):
        target = np.rint(gradient * SCALE)
        root, leaves = grower.tree(number, target)
        squares = np.zeros((len(leaves), 2))
        for k, (node, inside, others) in enumerate(leaves):
            parts = np.rint(gradient.take(inside) ** 2 * SQUARE_SCALE)
            squares[k] = np.bincount(rows.positive.take(inside), parts, 2)
            value = node.mean(growth.positive_weight) * (growth.step if number else 1.0)
            margin[inside] += value
            margin[others] += value
        loss = np.zeros(2)
        if growth.stop_below is not None:
            at = 2 * rows.sign[rows.aside] * margin[rows.aside]
            loss[:] = (weights * 2 * np.logaddexp(0, -at)).sum(), weights.sum()
        squares, loss = exchange.sums(squares, loss)
        for (node, *_), found in zip(leaves, squares):
            node.squares = found
        _squared(root)
        trees.append(root)
        if growth.stop_below is not None and loss[1] > 0:
            now = loss[0] / loss[1]
            if number and best - now < growth.stop_below * max(now, 0.01):
                break
            if now < best:
                best, kept = now, number + 1
        with np.errstate(over="ignore"):
            gradient = 4 * rows.sign / (1 + np.exp(2 * rows.sign * margin))
    return trees if growth.stop_below is None else trees[:kept]


# ------------------------------------------------------------------------------- the saved form of MLlib's model

_NODES = ("treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, "
          "rawCount: bigint, gain: double, leftChild: int, rightChild: int, "
          "split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>")
_ARROW_NODES = pa.schema([("treeID", pa.int32()), ("nodeData", pa.struct([
    ("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()),
    ("impurityStats", pa.list_(pa.float64())), ("rawCount", pa.int64()), ("gain", pa.float64()),
    ("leftChild", pa.int32()), ("rightChild", pa.int32()), ("split", pa.struct([
        ("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())),
        ("numCategories", pa.int32())]))]))])


def _pruned(node: Node, positive_weight: float) -> Node:
    """Sister leaves with one prediction become a leaf."""
    if node.low is not None:
        sisters = _pruned(node.low, positive_weight), _pruned(node.high, positive_weight)
        if all(s.low is None for s in sisters) and sisters[0].mean(positive_weight) == sisters[1].mean(positive_weight):
            node.low = node.high = None
    return node


def _listed(root: Node, growth: Growth) -> list[dict]:
    """The nodes of a tree, each before those below it."""
    found: list[dict] = []

    def add(node: Node) -> int:
        weight, total, squares = node.figures(growth.positive_weight)
        leaf, mean = node.low is None, node.mean(growth.positive_weight)
        row = {"id": len(found), "prediction": mean,
               "impurity": max(squares / weight - mean ** 2, 0.0) if weight > 0 else 0.0,
               "impurityStats": [weight, total, squares], "rawCount": int(node.counts.sum()),
               "gain": -1.0 if leaf else node.gain, "leftChild": -1, "rightChild": -1,
               "split": {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1} if leaf else {
                   "featureIndex": node.feature, "numCategories": -1,
                   "leftCategoriesOrThreshold": [float(growth.cuts[node.feature][node.cut])]}}
        found.append(row)
        if not leaf:
            row["leftChild"], row["rightChild"] = add(node.low), add(node.high)
        return row["id"]

    add(_pruned(root, growth.positive_weight))
    return found


def _grown(batches: Iterator[pa.RecordBatch], growth: Growth) -> Iterator[pa.RecordBatch]:
    """The nodes of all trees, from the first task."""
    rows = _Rows(batches, growth.cuts)
    trees = _train(rows, growth, _Exchange(growth.folder))
    if BarrierTaskContext.get().partitionId() == 0:
        for k, tree in enumerate(trees):
            yield pa.RecordBatch.from_pylist([{"treeID": k, "nodeData": n} for n in _listed(tree, growth)], _ARROW_NODES)


def _metadata(kind: str, trees: GBTClassifier | DecisionTreeRegressor, version: str, **more: object) -> str:
    named = lambda values: {p.name: v for p, v in values.items()}
    return json.dumps({"class": f"org.apache.spark.ml.{kind}", "timestamp": int(time.time() * 1000), "sparkVersion": version,
                       "uid": trees.uid, "paramMap": named(trees._paramMap), "defaultParamMap": named(trees._defaultParamMap),
                       **more})


def _shared_parameters(trees: GBTClassifier) -> DecisionTreeRegressor:
    one = DecisionTreeRegressor()
    for p, value in trees._paramMap.items():
        if one.hasParam(p.name):
            one._set(**{p.name: value})
    return one


# ------------------------------------------------------------------------------- training


def tasks_at_once(spark: SparkSession) -> int:
    """Tasks that can run side by side for as long as it takes; 0 if executors come and go."""
    if spark.conf.get("spark.dynamicAllocation.enabled", "false") == "true":
        return 0
    sc = spark.sparkContext._jsc.sc()
    return int(sc.maxNumConcurrentTasks(sc.resourceProfileManager().defaultResourceProfile()))


def fit(rows: DataFrame, inputs: Sequence[str], key: str, count: int, positive_weight: float,
        trees: GBTClassifier) -> GBTClassificationModel:
    """What ``trees.fit`` gives, for ``count`` rows with double inputs, a weight of 1 or, for positives, of
    ``positive_weight``, and a key by which rows are drawn."""
    spark, label = rows.sparkSession, trees.getLabelCol()
    followed = trees.isSet(trees.validationIndicatorCol)
    cuts = candidate_cuts(rows if not followed else rows.where(~F.col(trees.getValidationIndicatorCol())),
                          inputs, trees.getMaxBins())
    root = shared_folder(spark, "boosting")
    place = urlparse(root)
    folder = f"{place.path}/exchange" if place.scheme in ("", "file") else None
    growth = Growth(
        cuts, positive_weight, trees.getMaxIter(), trees.getMaxDepth(), trees.getStepSize(), trees.getSubsamplingRate(),
        float(trees.getFeatureSubsetStrategy()), trees.getSeed(), trees.getValidationTol() if followed else None, folder)
    blocks = rows.select(
        *inputs, (F.col(label) == 1).alias("positive"), F.xxhash64(key).alias("mark"),
        (F.col(trees.getValidationIndicatorCol()) if followed else F.lit(False)).alias("aside"),
    ).mapInArrow(partial(_blocks, inputs=list(inputs), cuts=cuts), "bins binary, positive binary, mark binary, aside binary")
    parts = max(1, min(tasks_at_once(spark), -(-count // ROWS_A_TASK)))
    grown = blocks.repartition(parts).mapInArrow(partial(_grown, growth=growth), _NODES, barrier=True)
    # Spark runs a failed barrier stage again if its result moves on to another one
    grown.repartition(1).write.parquet(f"{root}/model/data")
    if folder:
        shutil.rmtree(folder, ignore_errors=True)
    number = spark.read.parquet(f"{root}/model/data").agg(F.max("treeID") + 1).first()[0]
    version, one = spark.version, _shared_parameters(trees)
    spark.createDataFrame(
        [(k, _metadata("regression.DecisionTreeRegressionModel", one, version), growth.step if k else 1.0)
         for k in range(number)], "_1 int, _2 string, _3 double").write.parquet(f"{root}/model/treesMetadata")
    spark.createDataFrame(
        [(_metadata("classification.GBTClassificationModel", trees, version, numFeatures=len(inputs), numTrees=number),)],
        "value string").coalesce(1).write.text(f"{root}/model/metadata")
    return GBTClassificationModel.load(f"{root}/model")
