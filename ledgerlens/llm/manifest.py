"""A Merkle manifest of a table: digests of rows, subroots of groups of rows, one root, and a proof for every row.

Rows of one tree are numbered in order. While a tree has several nodes, every ``arity`` consecutive ones become their
digest (the last run may have fewer, even one). The subroots of all trees, in the trees' order, make one more tree.

The trees are worked through by time-forward processing. A node's label is the place of its last row and its level, so
that children come before their parents. Forward, a queue ordered by label holds the digests that children have sent;
when it comes to a parent's label, the parent takes them and sends its own digest on. Reversed, the queue runs from the
root down and delivers to every child the proof suffix of its parent, lengthened by the child's siblings. Within a
block of ``arity ** levels`` rows the queue is a heap in one task. Between blocks Spark's sorted exchange is the
external queue: a block's digest, then its proof suffix, travel as messages addressed to a block and arrive in label
order. A table of n rows takes log n / log block rounds, each over a table smaller by the factor of a block.

Every digest is the lower-case hex SHA-256 of its inputs one after the other, digests as hex text. A field is ``-`` if
null, else its length in UTF-8 bytes, ``:`` and its value. Rows with equal order columns are ordered by their digest;
equal rows are interchangeable, each gets a proof of its own place. Null order values and null trees come first. An
empty table has no rows and no root.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator, Sequence
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
LEVELS = 12  # of a block at arity 2: 4096 rows


def digest(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def encoded(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Iterable[Column]) -> Column:
    """The digest of a row of fields."""
    return F.sha2(F.concat(*map(encoded, values)), 256)


# ------------------------------------------------------------------------------------------- one block


def _levels(nodes: int, arity: int, most: int) -> int:
    """Levels above the rows until one node is left, ``most`` at most."""
    levels = 0
    while nodes > 1 and levels < most:
        nodes, levels = -(-nodes // arity), levels + 1
    return levels


def forward(leaves: Sequence[str], arity: int, levels: int) -> dict[tuple[int, int], str]:
    """Digests of all nodes of a block by ``(level, place)``, by time-forward processing."""
    last, nodes, queue = len(leaves) - 1, {}, []

    def send(level: int, place: int, value: str) -> None:
        nodes[level, place] = value
        if level < levels:
            parent = place // arity
            end = min((parent + 1) * arity ** (level + 1) - 1, last)
            heapq.heappush(queue, (end, level + 1, parent, place, value))

    for place, value in enumerate(leaves):
        send(0, place, value)
        while queue and queue[0][0] <= place:
            _, level, parent, _, value = heapq.heappop(queue)
            received = [value]
            while queue and queue[0][1:3] == (level, parent):
                received.append(heapq.heappop(queue)[4])
            send(level, parent, digest(*received))
    return nodes


def reverse(nodes: dict[tuple[int, int], str], arity: int, levels: int, suffix: list) -> Iterator[tuple[int, list]]:
    """``place, proof`` of every row of a block, last row first. A proof is a list of ``(before, after)``: the digests
    of the siblings on either side, level by level up to the root; ``suffix`` is the part above the block."""
    places = sorted(place for level, place in nodes if level == levels)
    last = max(place for level, place in nodes if level == 0)
    end = lambda level, place: min((place + 1) * arity ** level - 1, last)
    queue = [(-end(levels, place), -levels, -place, suffix) for place in places]
    heapq.heapify(queue)
    while queue:
        _, level, place, proof = heapq.heappop(queue)
        level, place = -level, -place
        if level == 0:
            yield place, proof
            continue
        children = [(k, nodes[level - 1, k]) for k in range(place * arity, (place + 1) * arity) if (level - 1, k) in nodes]
        for k, _ in children:
            beside = ("".join(d for j, d in children if j < k), "".join(d for j, d in children if j > k))
            heapq.heappush(queue, (-end(level - 1, k), 1 - level, -k, [beside, *proof]))


def fold(value: str, proof: Iterable[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings lead to."""
    for before, after in proof:
        value = digest(before, value, after)
    return value


# ------------------------------------------------------------------------------------------- all blocks


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Runs of rows with the same tree and block, over batch bounds."""
    key, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            now = row["tree"], row["block"]
            if now != key and held:
                yield held
                held = []
            key = now
            held.append(row)
    if held:
        yield held


def _exchange(nodes: DataFrame) -> DataFrame:
    """Rows at the task of their block, in label order."""
    return nodes.repartition("tree", "block").sortWithinPartitions("tree", "block", "place")


def _up(nodes: DataFrame, arity: int, levels: int) -> DataFrame:
    """One node for each block: ``tree, place, digest, nodes``."""
    size = arity ** levels

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _blocks(batches):
            first = rows[0]
            top = _levels(first["nodes"], arity, levels)
            done = forward([r["digest"] for r in rows], arity, top)
            yield pa.RecordBatch.from_pylist([{"tree": first["tree"], "place": first["block"], "digest": done[top, 0],
                                               "nodes": -(-first["nodes"] // size)}])

    blocks = nodes.select("tree", F.expr(f"place div {size}").alias("block"), "place", "digest", "nodes")
    return _exchange(blocks).mapInArrow(run, "tree long, place long, digest string, nodes long")


def _down(nodes: DataFrame, suffixes: DataFrame, arity: int, levels: int, emit, schema: str) -> DataFrame:
    """Deliver to the rows of every block its suffix (``tree, place, befores, afters, subroot``); ``emit`` makes a
    row's result of the row, its proof and the subroot."""
    size = arity ** levels

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for message, *rows in _blocks(batches):  # the message's label is before those of all rows
            top = _levels(rows[0]["nodes"], arity, levels)
            done = forward([r["digest"] for r in rows], arity, top)
            suffix = list(zip(message["befores"], message["afters"]))
            out = [emit(rows[k], proof, message["subroot"]) for k, proof in reverse(done, arity, top, suffix)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)],
                                             names=names)

    names, kinds = zip(*[(f.name, pa.list_(pa.string()) if f.dataType.typeName() == "array" else _ARROW[
        f.dataType.typeName()]) for f in StructType.fromDDL(schema)])
    own = [f for f in nodes.schema if f.name not in ("tree", "place")]
    blocks = nodes.withColumns({"block": F.expr(f"place div {size}"), "subroot": F.lit(None).cast("string"), **{
        c: F.lit(None).cast("array<string>") for c in ("befores", "afters")}})
    messages = suffixes.select("tree", F.col("place").alias("block"), F.lit(-1).cast("long").alias("place"),
                               "befores", "afters", "subroot", *[F.lit(None).cast(f.dataType).alias(f.name) for f in own])
    return _exchange(blocks.unionByName(messages)).mapInArrow(run, schema)


_ARROW = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
SUFFIX = "tree long, place long, befores array<string>, afters array<string>, subroot string"


def _suffix_row(row: dict, proof: list, subroot: str) -> tuple:
    return row["tree"], row["place"], [x for x, _ in proof], [x for _, x in proof], subroot


def ranked(rows: DataFrame, order: Sequence[str], folder: str) -> DataFrame:
    """The rows with their place in ascending order (nulls first) as ``rank``. Sorted partitions are written with
    places of their own; the totals of the partitions before are added. No task holds more than a partition."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        past = 0
        for batch in batches:
            yield batch.append_column("nth", pa.array(np.arange(past, past + batch.num_rows)))
            past += batch.num_rows

    spread = rows.withColumn("nth", F.monotonically_increasing_id()).repartitionByRange(*order, "nth")
    sorted_rows = spread.sortWithinPartitions(*order, "nth").drop("nth").withColumn("part", F.spark_partition_id())
    sorted_rows.mapInArrow(run, StructType([*sorted_rows.schema, StructField("nth", LongType())])).write.parquet(folder)
    spark = rows.sparkSession
    written = spark.read.parquet(folder)
    sizes = sorted((r["part"], r["n"]) for r in written.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect())
    before, starts = 0, []  # a number for each partition
    for part, n in sizes:
        starts.append((part, before))
        before += n
    offsets = spark.createDataFrame(starts, "part int, before long")
    return written.join(F.broadcast(offsets), "part").withColumn("rank", F.col("before") + F.col("nth")).drop(
        "part", "before", "nth")


class _Tree:
    """All trees of a table of nodes ``tree, place, digest, nodes``, round by round."""

    def __init__(self, nodes: DataFrame, folder: str, arity: int, levels: int):
        self.folder, self.arity, self.levels = folder, arity, levels
        self.rounds = [nodes]
        while (self.rounds[-1].agg(F.max("nodes")).first()[0] or 1) > 1:
            self.rounds.append(self._kept(_up(self.rounds[-1], arity, levels), f"up-{len(self.rounds)}"))

    def _kept(self, frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{self.folder}/{name}")
        return frame.sparkSession.read.parquet(f"{self.folder}/{name}")

    @property
    def roots(self) -> DataFrame:
        return self.rounds[-1]

    def deliver(self, suffixes: DataFrame, emit, schema: str) -> DataFrame:
        """What ``emit`` makes of every node of the table, given the suffixes of the roots."""
        for k in range(len(self.rounds) - 2, 0, -1):
            nodes = self.rounds[k].select("tree", "place", "digest", "nodes")
            suffixes = self._kept(_down(nodes, suffixes, self.arity, self.levels, _suffix_row, SUFFIX), f"down-{k}")
        # a table of single nodes has no round: each node is a block of its own
        return _down(self.rounds[0], suffixes, self.arity, self.levels, emit, schema)


def manifest(spark: SparkSession, rows: DataFrame, folder: str, tree: str = "lang", order: str = "doc_id",
             fields: Sequence[str] = FIELDS, claimed: Sequence[Column] | None = None, arity: int = 2,
             levels: int = LEVELS, with_proofs: bool = False) -> DataFrame:
    """``doc_id`` (the order column), ``leaf, subroot, root, proof_sha256, folded_root, verified`` of each row.

    ``folded_root`` is the root that the digest of the ``claimed`` values (by default the row's own) and the row's proof
    lead to. ``proof_sha256`` is the digest of the proof's siblings; ``with_proofs`` adds these (``befores, afters``,
    level by level). Intermediate tables go below ``folder``."""
    own = leaf(F.col(c) for c in fields)
    leaves = rows.select(F.col(tree).cast("string").alias("name"), F.col(order).cast("long").alias("doc_id"),
                         own.alias("digest"), (own if claimed is None else leaf(claimed)).alias("claim"))
    # an equal claim takes no room
    leaves.withColumn("claim", F.when(F.col("claim") != F.col("digest"), F.col("claim"))).write.parquet(f"{folder}/rows")
    placed = ranked(spark.read.parquet(f"{folder}/rows"), ["name", "doc_id", "digest"], f"{folder}/sorted")
    trees = placed.groupBy("name").agg(F.min("rank").alias("tree"), F.count(F.lit(1)).alias("nodes"))
    trees.write.parquet(f"{folder}/trees")
    trees = spark.read.parquet(f"{folder}/trees").withColumnRenamed("name", "_name")
    nodes = placed.join(trees, F.col("name").eqNullSafe(F.col("_name"))).select(
        "tree", (F.col("rank") - F.col("tree")).alias("place"), "digest", "nodes", "doc_id", "claim")
    forest = _Tree(nodes, f"{folder}/forest", arity, levels)
    subroots = ranked(forest.roots.select(F.col("tree").alias("start"), "digest"), ["start"], f"{folder}/subroots")
    count = subroots.count()
    crown = _Tree(subroots.select(F.lit(0).cast("long").alias("tree"), F.col("rank").alias("place"), "digest",
                                  F.lit(count).cast("long").alias("nodes"), "start"), f"{folder}/crown", arity, levels)
    top = crown.roots.select("digest").first()
    root = top["digest"] if top else None
    start = spark.createDataFrame([(0, 0, [], [], None)] if top else [], SUFFIX)

    def of_subroot(row: dict, proof: list, _: str | None) -> tuple:
        return row["start"], 0, [x for x, _ in proof], [x for _, x in proof], row["digest"]

    def of_row(row: dict, proof: list, subroot: str) -> tuple:
        folded = fold(row["claim"] or row["digest"], proof)
        siblings = digest(*(x + y for x, y in proof))
        out = row["doc_id"], row["digest"], subroot, root, siblings, folded, folded == root
        return (*out, [x for x, _ in proof], [x for _, x in proof]) if with_proofs else out

    crown.deliver(start, of_subroot, SUFFIX).write.parquet(f"{folder}/suffixes")
    schema = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
              "verified boolean" + ", befores array<string>, afters array<string>" * with_proofs)
    return forest.deliver(spark.read.parquet(f"{folder}/suffixes"), of_row, schema)
