"""Near-duplicate vectors by Euclidean p-stable hashing and exact cosine checks.

1. Vectors with equal components form a class. Only classes go on, as vectors of length one.
2. A table of hashes has ``k`` random projections, shifted and cut into steps of ``WIDTH``; classes with equal steps
   share a bucket. ``k`` keeps the unrelated vectors in a bucket few (``strangers``), and there are as many tables as it
   takes for a pair at the very threshold to meet with probability ``recall``; closer pairs meet more surely.
3. Cells. In a bucket of ``crowd`` classes or more, those within half the threshold's angle of its first member may
   join that member's cell: all vectors of a cell are linked with one another, whatever their number, so groups of near
   copies are counted and not compared.
4. Buckets now hold cells. Cells that meet are compared by their centres, from vectors rounded to bytes whose error is
   known, in blocks of ``BLOCK``; pairs that may hold a link go on and are checked in double precision. By the centres'
   angle and the cells' radii, all of their vectors are linked, or none, or it depends: then each vector is held against
   the other centre in the same way, and what still depends is compared vector by vector, in blocks.

So every pair of cells is decided once and exactly, whichever of its vectors met; no pair below the threshold links.

Null and zero vectors and those with null or non-finite components link with nothing, nor do vectors of different
lengths. Each row is a vector: rows with equal ``vec_id`` are all returned. A null ``vec_id`` gets the component's
smallest number (null if none has one) and is never kept. An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.arrow import binaries, mix64
from ledgerlens.llm.graph import components

WIDTH = 3.0  # of a step, for vectors of length one: near the best ratio of the two collision probabilities
BLOCK = 1024
SLACK = 1e-7  # of angles, far above the error of double precision


def collision(distance: float, width: float = WIDTH) -> float:
    """Probability that two vectors at a distance fall into one step of a projection."""
    x = width / distance
    below = 0.5 * math.erfc(x / math.sqrt(2))
    return 1 - 2 * below - 2 / (math.sqrt(2 * math.pi) * x) * (1 - math.exp(-x * x / 2))


@dataclass(frozen=True)
class Tables:
    """Hash tables for vectors of length one."""

    tables: int
    projections: int
    seed: int = 13

    @staticmethod
    def planned(vectors: int, similarity: float, recall: float, strangers: float) -> Tables:
        k = max(4, math.ceil(math.log(max(vectors, 1) / strangers) / -math.log(collision(math.sqrt(2)))))
        meet = collision(math.sqrt(2 - 2 * similarity)) ** k
        return Tables(max(1, math.ceil(math.log(1 - recall) / math.log(1 - meet))), k)

    @lru_cache(maxsize=4)
    def _drawn(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng((self.seed, length))
        return (rng.standard_normal((length, self.tables * self.projections)),
                rng.uniform(0, WIDTH, self.tables * self.projections))

    def buckets(self, vectors: np.ndarray) -> np.ndarray:
        """64-bit bucket numbers, a row a vector and a column a table."""
        directions, shifts = self._drawn(vectors.shape[1])
        steps = np.floor((vectors @ directions + shifts) / WIDTH).astype(np.int64).astype(np.uint64)
        steps = steps.reshape(len(vectors), self.tables, self.projections)
        out = np.broadcast_to(mix64(np.arange(self.tables, dtype=np.uint64) * np.uint64(2654435761)
                                    + np.uint64(vectors.shape[1])), steps.shape[:2])
        for j in range(self.projections):
            out = mix64(out ^ mix64(steps[:, :, j] + np.uint64(j + 1)))
        return out.view(np.int64)


# ------------------------------------------------------------------------------------------- in tasks


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``rows, vectors`` of a column of doubles in bytes, for each length of vectors."""
    raw = [x.as_buffer() for x in column]
    sizes = np.array([len(x) for x in raw], dtype=np.int64)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield rows, np.frombuffer(b"".join([raw[k] for k in rows]), "<f8").reshape(len(rows), size // 8)


def _cosines(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Cosines of pairs of vectors of length one; -2 where their lengths differ."""
    out = np.full(len(a), -2.0)
    same = np.array([len(x.as_buffer()) == len(y.as_buffer()) for x, y in zip(a, b)], dtype=bool)
    places = np.flatnonzero(same)
    kept = pa.array(same)
    for (rows, x), (_, y) in zip(_by_length(a.filter(kept)), _by_length(b.filter(kept))):
        out[places[rows]] = np.einsum("ij,ij->i", x, y)
    return out


def _units(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("vector")
        sizes = np.diff(lists.offsets.to_numpy()) * lists.is_valid().to_numpy(zero_copy_only=False)
        keys, units = np.full(len(lists), None, object), np.full(len(lists), None, object)
        for size in np.unique(sizes[sizes > 0]):
            rows = np.flatnonzero(sizes == size)
            x = lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # null: NaN
            x = x.reshape(len(rows), size) + 0.0  # no negative zeros
            largest = np.abs(x).max(axis=1)
            good = np.isfinite(largest) & (largest > 0)
            rows, x = rows[good], x[good]
            scaled = x / largest[good, None]
            scaled = scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]
            keys[rows] = [hashlib.blake2b(v.tobytes(), digest_size=16).digest() for v in x]
            units[rows] = [v.tobytes() for v in scaled]
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(keys, pa.binary()),
                                          pa.array(units, pa.binary())], names=["vec_id", "key", "unit"])


def _rounded(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors as bytes: scale and error (four bytes each) and a byte a component."""
    scale = (np.abs(unit).max(axis=1) / 127).astype("<f4")
    steps = np.rint(unit / scale[:, None].astype(np.float64)).astype(np.int8)
    error = np.linalg.norm(unit - steps * scale[:, None].astype(np.float64), axis=1) * (1 + 1e-6) + 1e-7
    head = np.stack([scale, error.astype("<f4")], axis=1).view(np.uint8)
    return np.concatenate([head, steps.view(np.uint8)], axis=1), np.full(len(unit), unit.shape[1] + 8)


def _with_sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = np.empty(batch.num_rows, dtype=object)
        for rows, unit in _by_length(batch.column("unit")):
            values, counts = _rounded(unit)
            out[rows] = binaries(values.reshape(-1), counts).to_pylist()
        yield pa.RecordBatch.from_arrays([batch.column("cell"), batch.column("radius"), pa.array(out, pa.binary())],
                                         names=["cell", "radius", "sketch"])


def _groups(batches: Iterable[pa.RecordBatch], *key: str) -> Iterator[pa.RecordBatch]:
    """Runs of rows with equal keys in sorted batches, over batch bounds."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in key], axis=1)
        starts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        bounds = [0, *starts.tolist(), batch.num_rows]
        for begin, end in zip(bounds, bounds[1:]):
            now = keys[begin].tolist()
            if held and now != last:
                yield _joined(held)
                held = []
            held.append(batch.slice(begin, end - begin))
            last = now
    if held:
        yield _joined(held)


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def _meeting(limit: float):
    """Pairs of cells of a block, or of two, that may hold a link."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right, waiting = [], [], 0
        for group in _groups(batches, "bucket", "low", "high"):
            raw = [x.as_buffer() for x in group.column("sketch")]
            if len({len(x) for x in raw}) > 1:  # another length by an equal 64-bit hash
                size = max({len(x) for x in raw}, key=[len(x) for x in raw].count)
                group = group.filter(pa.array([len(x) == size for x in raw]))
                raw = [x for x in raw if len(x) == size]
            both = np.frombuffer(b"".join(raw), np.uint8).reshape(len(raw), -1)
            head = np.ascontiguousarray(both[:, :8]).view("<f4")
            x = np.ascontiguousarray(both[:, 8:]).view(np.int8).astype(np.float32) * head[:, :1]
            cells, radius = group.column("cell").to_numpy(), group.column("radius").to_numpy()
            high = group.column("upper").to_numpy(zero_copy_only=False).astype(bool)
            a, b = (np.flatnonzero(~high), np.flatnonzero(high)) if high.any() else (np.arange(len(x)),) * 2
            error = head[a, 1][:, None] + head[b, 1][None] + head[a, 1][:, None] * head[b, 1][None] + 1e-5
            least = np.cos(np.minimum(limit + radius[a][:, None] + radius[b][None], math.pi)) if radius.any() else (
                math.cos(limit))
            i, j = np.nonzero(x[a] @ x[b].T + error >= least)
            u, v = cells[a[i]], cells[b[j]]
            keep = u != v if high.any() else u < v
            left.append(np.minimum(u, v)[keep])
            right.append(np.maximum(u, v)[keep])
            waiting += len(left[-1])
            if waiting > 100_000:
                yield from _pairs(left, right)
                left, right, waiting = [], [], 0
        yield from _pairs(left, right)

    return run


def _pairs(left: list[np.ndarray], right: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    if left:
        found = np.unique(np.stack([np.concatenate(left), np.concatenate(right)], axis=1), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["u", "v"])


def _counted(similarity: float):
    """For each asking vector of a block, the linked rows among the members of another block."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, "cell", "low", "high"):
            asks = group.column("asks").to_numpy(zero_copy_only=False).astype(bool)
            sides = [group.filter(pa.array(asks)), group.filter(pa.array(~asks))]
            if not all(x.num_rows for x in sides):
                continue
            (_, x), (_, y) = (next(_by_length(s.column("unit"))) for s in sides)
            linked = (x @ y.T >= similarity) @ sides[1].column("n").to_numpy()
            yield pa.RecordBatch.from_arrays([sides[0].column("node"), group.column("cell").slice(0, len(x)),
                                              pa.array(linked.astype(np.int64))], names=["node", "cell", "more"])

    return run


def _compared(pairs: DataFrame) -> DataFrame:
    """With ``cosine`` of the vectors ``x`` and ``y``, which go."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [c for c in batch.schema.names if c not in ("x", "y")]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + [
                pa.array(_cosines(batch.column("x"), batch.column("y")))], names=[*kept, "cosine"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pairs.schema if f.name not in ("x", "y"))
    return pairs.mapInArrow(run, schema + ", cosine double")


# ------------------------------------------------------------------------------------------- the whole


def group(spark: SparkSession, vectors: DataFrame, folder: str, similarity: float = 0.9, recall: float = 0.999,
          strangers: float = 16.0, crowd: int = 64, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of each row. Intermediate tables go below ``folder``."""

    def kept(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    limit = math.acos(similarity)
    plain = vectors.select(F.col(vec_id).cast("long").alias("vec_id"),
                           F.col(embedding).cast("array<double>").alias("vector"))
    rows = kept(plain.mapInArrow(_units, "vec_id long, key binary, unit binary"), "rows")
    classes = kept(rows.where("key is not null").groupBy("key").agg(
        F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("n"), F.first("unit").alias("unit"))
        .withColumn("node", F.monotonically_increasing_id()), "classes")
    plan = Tables.planned(classes.count(), similarity, recall, strangers)

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column("node").to_numpy()
            for at, unit in _by_length(batch.column("unit")):
                for k in range(0, len(at), 500):
                    found = plan.buckets(unit[k: k + 500])
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(nodes[at[k: k + 500]], plan.tables)),
                                                      pa.array(found.reshape(-1))], names=["node", "bucket"])

    keys = kept(classes.select("node", "unit").mapInArrow(hashed, "node long, bucket long"), "keys")

    # cells: the first member by a hash leads a crowded bucket; of the leaders near enough a class takes the first
    first = lambda c: F.struct(F.xxhash64(c).alias("turn"), F.col(c).alias("of"))
    leaders = keys.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min(first("node")).alias("leader")).where(
        F.col("n") >= crowd).select("bucket", F.col("leader.of").alias("leader"))
    follow = keys.join(leaders, "bucket").where("node != leader").select("node", "leader").distinct()
    units = classes.select("node", "unit")
    near = _compared(follow.join(units.select("node", F.col("unit").alias("x")), "node")
                     .join(units.select(F.col("node").alias("leader"), F.col("unit").alias("y")), "leader"))
    inside = near.where(F.col("cosine") >= math.cos(limit / 2 - SLACK))
    chosen = inside.groupBy("node").agg(F.min(F.struct(first("leader").alias("at"), F.col("cosine"))).alias("c")).where(
        F.col("c.at.turn") < F.xxhash64("node"))  # else the class leads its own cell
    moved = kept(chosen.select("node", F.col("c.at.of").alias("cell"), F.col("c.cosine").alias("cosine")), "moved")
    angle = lambda c: F.when(c.isNotNull(), F.acos(F.least(F.greatest(c, F.lit(-1.0)), F.lit(1.0))))
    members = kept(classes.join(moved, "node", "left").select(
        "node", "id", "n", "unit", F.coalesce("cell", "node").alias("cell"),
        F.coalesce(angle(F.col("cosine")) + SLACK, F.lit(0.0)).alias("angle")), "members")
    cells = kept(members.groupBy("cell").agg(
        F.sum("n").alias("rows"), F.max("angle").alias("radius"), F.count(F.lit(1)).alias("size"), F.min("id").alias("id"))
        .join(units.withColumnRenamed("node", "cell"), "cell"), "cells")

    # pairs of cells that may hold a link
    light = keys.join(moved.select("node", "cell"), "node", "left").select(
        "bucket", F.coalesce("cell", "node").alias("cell")).distinct()
    shared = light.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(
        "bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("cell"), F.col("blocks")).cast("int")
    placed = (light.join(shared, "bucket").withColumn("own", own)
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("bucket", "cell", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
                      (F.col("own") > F.col("other")).alias("upper")))
    sketches = cells.select("cell", "radius", "unit").mapInArrow(_with_sketch, "cell long, radius double, sketch binary")
    dealt = placed.join(sketches, "cell").repartition("bucket", "low", "high").sortWithinPartitions(
        "bucket", "low", "high")
    meeting = dealt.mapInArrow(_meeting(limit), "u long, v long").distinct()

    # decided by the centres, or not
    side = lambda k, v: cells.select(F.col("cell").alias(k), F.col("unit").alias(v), F.col("rows").alias(f"rows_{k}"),
                                     F.col("radius").alias(f"radius_{k}"), F.col("size").alias(f"size_{k}"))
    between = F.col("radius_u") + F.col("radius_v")
    turn = angle(F.col("cosine"))
    decided = kept(_compared(meeting.join(side("u", "x"), "u").join(side("v", "y"), "v")).withColumn(
        "verdict", F.when((F.col("size_u") == 1) & (F.col("size_v") == 1), F.col("cosine") >= similarity)
        .when(turn + between <= limit - SLACK, F.lit(True)).when(turn - between > limit + SLACK, F.lit(False))).select(
        "u", "v", "verdict", "rows_u", "rows_v"), "decided")
    linked = decided.where("verdict")
    both = linked.select(F.col("u").alias("cell"), F.col("rows_v").alias("more")).union(
        linked.select(F.col("v").alias("cell"), F.col("rows_u").alias("more")))
    by_cell = both.groupBy("cell").agg(F.sum("more").alias("beside"))

    # decided by each vector and the other centre, or not
    open_pairs = decided.where("verdict is null").select("u", "v")
    asked = open_pairs.union(open_pairs.select("v", "u")).toDF("home", "cell")
    asking = (asked.join(members.select(F.col("cell").alias("home"), "node", F.col("unit").alias("x")), "home")
              .join(cells.select("cell", "rows", "radius", F.col("unit").alias("y")), "cell"))
    judged = kept(_compared(asking.withColumn("unit", F.col("x"))).withColumn(
        "verdict", F.when(turn + F.col("radius") <= limit - SLACK, F.lit(True))
        .when(turn - F.col("radius") > limit + SLACK, F.lit(False))), "judged")
    near_centre = judged.where("verdict").select("node", "home", "cell", F.col("rows").alias("more"))

    # vector by vector: both sides in blocks, each block of one with each of the other
    still = judged.where("verdict is null").select("cell", "node", "home", "unit")
    sizes = still.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("left")).join(
        cells.select("cell", F.ceil(F.col("size") / BLOCK).alias("right")), "cell")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n).cast("int") - 1))
    at = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    asks = still.join(sizes, "cell").select("cell", at("left").alias("low"), every("right").alias("high"), F.lit(
        True).alias("asks"), "node", "unit", F.lit(0).cast("long").alias("n"))
    answers = members.select("cell", "node", "unit", "n").join(sizes, "cell").select(
        "cell", every("left").alias("low"), at("right").alias("high"), F.lit(False).alias("asks"), "node", "unit", "n")
    blocks = asks.union(answers).repartition("cell", "low", "high").sortWithinPartitions("cell", "low", "high")
    counted = blocks.mapInArrow(_counted(similarity), "node long, cell long, more long").where("more > 0").join(
        still.select("node", "cell", "home"), ["node", "cell"])
    single = kept(near_centre.union(counted.select("node", "home", "cell", "more")), "single")
    by_node = single.groupBy("node").agg(F.sum("more").alias("apart"))

    # components of cells, their smallest numbers, and all back to the rows
    links = linked.select("u", "v").union(single.select("home", "cell").distinct())
    found = components(links).withColumnRenamed("node", "cell")
    whole = cells.select("cell", "id", "rows").join(found, "cell", "left").withColumn(
        "component", F.coalesce("component", "cell"))
    smallest = whole.groupBy("component").agg(F.min("id").alias("component_id"))
    of_cells = whole.join(smallest, "component").join(by_cell, "cell", "left").select(
        "cell", "component_id", (F.col("rows") - 1 + F.coalesce("beside", F.lit(0))).alias("links"))
    of_classes = members.select("node", "cell").join(of_cells, "cell").join(by_node, "node", "left").select(
        "node", "component_id", (F.col("links") + F.coalesce("apart", F.lit(0))).alias("links"))
    by_key = classes.select("key", "node").join(of_classes, "node").drop("node")
    component = F.coalesce("component_id", F.when(F.col("key").isNull(), F.col("vec_id")))
    return rows.select("vec_id", "key").join(by_key, "key", "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
