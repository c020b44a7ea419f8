"""Near-duplicates by SuperMinHash signatures, banding, verification on full sets and connected components.

A document's set holds its distinct five-word shingles (lower-cased ASCII letters, words between ASCII white space); a
document with fewer words has its whole word sequence as the one shingle, one without words an empty set that links
with nothing. Documents link when the Jaccard similarity of their sets is at least ``similarity``.

1. Sketch. Every element draws a random permutation of the slots; in round ``j`` it offers the value ``j + r`` to the
   ``j``-th slot of its permutation, so one element never offers low values to two slots. A document stops as soon as
   all its slots hold values below the next round: long documents after one round.
2. Documents with equal sets form a class, represented by one of them. Only representatives go on.
3. Banding: representatives that agree on all values of a band share a bucket. In each bucket the members are compared
   with a leader, the member with the most company over all its buckets, and components are formed: a group of
   thousands of copies costs a star, not all pairs.
4. Members of a bucket that are still in different components are compared two by two, drawn by hash, which connects
   most of what can be. Those left meet in tasks, a large bucket as pairs of blocks. A task compares a pair only if this is the first band the two share and nothing connects them yet, and puts out only links
   that connect, fewer than it has members. So no link of a bucket is lost, and no pairs are written out.
5. Every link is confirmed on the full sets.

Shingles are told apart by 64-bit hashes. Rows without ``doc_id`` get the component of their class, or null; a repeated
``doc_id`` counts as one document with several texts. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.arrow import binaries, mix64, plain, slices, words
from ledgerlens.llm.graph import components
from ledgerlens.session import shared_folder

STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    """64 bands of 6 values find a pair of similarity 0.75 with probability 1 - 4e-6, one of 0.5 with 0.64."""

    shingle: int = 5
    similarity: int = 75  # percent
    bands: int = 64
    rows: int = 6
    block: int = 256  # members of one bucket that meet as many others in one task
    at_once: int = 1 << 15  # elements whose permutations a task holds


# ------------------------------------------------------------------------------------------------- sets and sketches


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """``elements, counts``: the distinct shingle hashes of the texts, ascending within each text."""
    found = words(pc.ascii_lower(texts))
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in found.vocabulary), dtype=np.uint64,
                         count=len(found.vocabulary))[found.codes] if len(found.codes) else np.zeros(0, np.uint64)
    n = len(hashes)
    left = np.repeat(found.starts + found.counts, found.counts) - np.arange(n)  # words up to the end of the text
    mixed = hashes.copy()
    for k in range(1, size):
        ahead = np.flatnonzero(left > k)
        mixed[ahead] = mix64(mixed[ahead] + STEP) ^ hashes[ahead + k]
    mixed = mix64(mixed)
    first = np.zeros(n, dtype=bool)
    first[found.starts[found.counts > 0]] = True
    whole = (left >= size) | (first & (left == np.repeat(found.counts, found.counts)))
    rows, elements = found.rows[whole], mixed[whole]
    order = np.lexsort((elements, rows))
    rows, elements = rows[order], elements[order]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:] != rows[:-1]) | (elements[1:] != elements[:-1])
    return elements[new], np.bincount(rows[new], minlength=len(texts)).astype(np.int64)


def signatures(elements: np.ndarray, counts: np.ndarray, slots: int, at_once: int = 1 << 15) -> np.ndarray:
    """SuperMinHash signatures, one row a text; texts without elements keep the largest value everywhere."""
    out = np.full((len(counts), slots), np.iinfo(np.uint64).max, dtype=np.uint64)
    ends = np.cumsum(counts)
    start = 0
    while start < len(counts):  # some texts at a time: a permutation takes two bytes a slot and element
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + at_once, "right")))
        rows = np.repeat(np.arange(stop - start), counts[start:stop])
        _offer(out[start:stop], elements[done: ends[stop - 1]], rows)
        start = stop
    return out


def _offer(out: np.ndarray, elements: np.ndarray, rows: np.ndarray) -> None:
    """Fill the signatures of some texts, round by round, as long as a text needs another round."""
    slots = out.shape[1]
    flat = out.reshape(-1)
    order: np.ndarray | None = None  # permutation state of the elements still in play
    low = np.uint64(0xFFFFFFFF)
    for level in range(slots):
        drawn = mix64(elements + np.uint64((level + 1) * int(STEP) % 2 ** 64))
        pick = level + ((drawn & low) * np.uint64(slots - level) >> np.uint64(32)).astype(np.int64)
        if order is None:
            slot = pick
        else:
            at = np.arange(len(pick))
            slot = order[at, pick].astype(np.int64)
            order[at, pick] = order[:, level]
        np.minimum.at(flat, rows * slots + slot, (np.uint64(level) << np.uint64(32)) | (drawn >> np.uint64(32)))
        full = (out >> np.uint64(32)).max(axis=1) <= np.uint64(level)
        stay = ~full[rows]
        if not stay.any():
            break
        if order is None:
            order = np.tile(np.arange(slots, dtype=np.uint16), (int(stay.sum()), 1))
            order[np.arange(len(order)), pick[stay]] = 0
        elif not stay.all():
            order = order[stay]
        elements, rows = elements[stay], rows[stay]


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    key = np.tile(np.arange(bands, dtype=np.uint64) * STEP, (len(signature), 1))
    parts = signature.reshape(len(signature), bands, rows)
    for k in range(rows):
        key = mix64(key ^ parts[:, :, k])
    return key


def sketches(docs: DataFrame, settings: Settings) -> DataFrame:
    """``doc_id, n_shingles, set_key, bands`` of each row; an empty set has no key and no bands."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            elements, counts = shingle_sets(batch.column("text"), settings.shingle)
            keys = band_keys(signatures(elements, counts, settings.bands * settings.rows, settings.at_once),
                             settings.bands, settings.rows).view(np.int64)
            ends = np.cumsum(counts)
            digests = [xxhash.xxh3_128_digest(elements[e - n: e].tobytes()) if n else None
                       for e, n in zip(ends.tolist(), counts.tolist())]
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(np.where(counts > 0, settings.bands, 0))]).astype(np.int32)),
                pa.array(keys[counts > 0].reshape(-1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts), pa.array(digests, pa.binary()), lists],
                ["doc_id", "n_shingles", "set_key", "bands"])

    return plain(docs).mapInArrow(run, "doc_id long, n_shingles long, set_key binary, bands array<long>")


def full_sets(docs: DataFrame, settings: Settings) -> DataFrame:
    """``set_key, elements`` of each row, the elements as ascending unsigned 64-bit numbers."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            elements, counts = shingle_sets(batch.column("text"), settings.shingle)
            column = binaries(elements, counts)
            keys = [xxhash.xxh3_128_digest(x) for x in column.to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), column], ["set_key", "elements"])

    return plain(docs).mapInArrow(run, "set_key binary, elements binary")


# ---------------------------------------------------------------------------------------------------- links


def confirmed(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs ``u, v`` whose sets (``node, elements``) are similar enough."""
    one = sets.select(F.col("node").alias("u"), F.col("elements").alias("one"))
    two = sets.select(F.col("node").alias("v"), F.col("elements").alias("two"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "two"):
            keep = [similar(np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64),
                            similarity) for a, b in zip(batch.column("one"), batch.column("two"))]
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")], ["u", "v"]).filter(pa.array(keep))

    return pairs.join(one, "u").join(two, "v").select("u", "v", "one", "two").mapInArrow(run, "u long, v long")


def _sized(similarity: int):
    """Sets whose sizes differ too much cannot be similar."""
    return 100 * F.least("n", "m") >= similarity * F.greatest("n", "m")


def _stars(members: DataFrame, similarity: int) -> DataFrame:
    """Each bucket's members with its leader: the most company, then the smallest number."""
    leader = members.groupBy("key").agg(F.max(F.struct("company", (-F.col("node")).alias("less"), "n")).alias("l"))
    leader = leader.select("key", (-F.col("l.less")).alias("v"), F.col("l.n").alias("m"))
    pairs = members.select("key", F.col("node").alias("u"), "n").join(leader, "key")
    return pairs.where((F.col("u") != F.col("v")) & _sized(similarity)).select(
        F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of buckets that still span more than one component, with their components."""
    labelled = members.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    spread = labelled.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b"))
    return labelled.join(spread.where("a != b").select("key"), "key", "left_semi")


def _draws(members: DataFrame, similarity: int) -> DataFrame:
    """Each bucket's members two by two, by hash: the smallest and the largest of about two that draw the same lot."""
    sizes = members.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / 2).alias("lots"))
    drawn = members.join(sizes, "key").withColumn("lot", F.pmod(F.xxhash64("node", "key"), "lots"))
    entry = F.struct("node", "n", "component")
    pairs = drawn.groupBy("key", "lot").agg(F.min(entry).alias("a"), F.max(entry).alias("b")).select(
        F.col("a.node").alias("u"), F.col("b.node").alias("v"), F.col("a.n").alias("n"), F.col("b.n").alias("m"),
        (F.col("a.component") != F.col("b.component")).alias("apart"))
    return pairs.where(F.col("apart") & _sized(similarity)).select("u", "v").distinct()


def connecting(table: pa.Table, similarity: int) -> list[tuple[int, int]]:
    """Links that connect members of two blocks of one bucket (or of one block, met by itself)."""
    band, same = table.column("band")[0].as_py(), table.column("i")[0].as_py() == table.column("j")[0].as_py()
    own = table.column("own").to_numpy()
    nodes, sizes = table.column("node").to_pylist(), table.column("n").to_numpy()
    bands = np.stack([x.values.to_numpy() for x in table.column("bands")])[:, :band]
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("elements")]
    parent = {c: c for c in table.column("component").to_pylist()}

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    components, out = table.column("component").to_pylist(), []
    for p in range(len(nodes) - 1):
        rest = slice(p + 1, None)
        meet = 100 * np.minimum(sizes[p], sizes[rest]) >= similarity * np.maximum(sizes[p], sizes[rest])
        if not same:
            meet &= own[rest] != own[p]
        meet &= ~(bands[rest] == bands[p]).any(axis=1)  # else they have met in an earlier band
        for q in (np.flatnonzero(meet) + p + 1).tolist():
            a, b = find(components[p]), find(components[q])
            if a != b and similar(sets[p], sets[q], similarity):
                parent[max(a, b)] = min(a, b)
                out.append((nodes[p], nodes[q]))
    return out


def similar(a: np.ndarray, b: np.ndarray, similarity: int) -> bool:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    shared = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * shared >= similarity * (len(a) + len(b) - shared)


def _rest(members: DataFrame, represented: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """Links between members of one bucket in different components (columns of ``_open``)."""
    sizes = members.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / settings.block).cast("int").alias("blocks"))
    dealt = members.join(sizes, "key").withColumn("own", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    dealt = dealt.select("key", "band", "node", "n", "component", "own", F.explode(
        F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    known = members.select("node").distinct().join(sets, "node").join(represented.select("node", "bands"), "node")
    met = dealt.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).drop("other").join(
        known, "node")

    def one(table: pa.Table) -> pa.Table:
        found = connecting(table, settings.similarity)
        return pa.table([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["u", "v"])

    return met.groupBy("key", "i", "j").applyInArrow(one, "u long, v long")


def numbered(named: DataFrame) -> DataFrame:
    """``set_key, first, node`` of each class: its smallest ``doc_id`` and a number of its own, which is that one unless
    another text of the same document has it; such classes have negative numbers."""
    firsts = named.groupBy("set_key").agg(F.min("doc_id").alias("first"))
    leads = firsts.groupBy("first").agg(F.min("set_key").alias("lead"))
    other = -F.shiftrightunsigned(F.xxhash64("set_key", "first"), 1) - 1
    return firsts.join(leads, "first").select("set_key", "first", F.when(
        F.col("set_key") == F.col("lead"), F.col("first")).otherwise(other).alias("node"))


def links(docs: DataFrame, sketch: DataFrame, folder: str, settings: Settings) -> DataFrame:
    """``node, component`` of the classes that have a link (``numbered``; the table goes below ``folder``). ``sketch`` is a
    written table."""
    spark = docs.sparkSession
    named = sketch.where("set_key is not null and doc_id is not null")
    numbered(named).write.parquet(f"{folder}/classes")
    classes = spark.read.parquet(f"{folder}/classes")
    own = named.select("set_key", "doc_id", "n_shingles", "bands")
    represented = own.join(classes, "set_key").where("doc_id = first").select(
        "node", F.col("n_shingles").alias("n"), "bands").dropDuplicates(["node"])
    # several texts of one document: its classes belong together
    several = named.groupBy("doc_id").agg(F.min("set_key").alias("lead"), F.max("set_key").alias("last")).where("lead != last")
    pairs = named.join(several, "doc_id").where("set_key != lead").select("lead", "set_key").distinct()
    number = classes.select("set_key", "node")
    same = pairs.join(number.toDF("lead", "u"), "lead").join(number.toDF("set_key", "v"), "set_key").select("u", "v").checkpoint()
    places = represented.select("node", "n", F.posexplode("bands").alias("band", "key"))
    company = places.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    places.join(company, "key").write.parquet(f"{folder}/places")
    places = spark.read.parquet(f"{folder}/places")
    score = places.groupBy("node").agg(F.sum("size").alias("company"))
    members = places.select("key", "band", "node", "n").join(score, "node")

    wanted = places.select("node").distinct().join(classes, "node")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        wanted.select(F.col("first").alias("doc_id")).distinct(), "doc_id", "left_semi")
    full_sets(texts, settings).join(wanted, "set_key").dropDuplicates(["node"]).select("node", "elements") \
        .write.parquet(f"{folder}/sets")
    sets = spark.read.parquet(f"{folder}/sets")

    stars = confirmed(_stars(members, settings.similarity), sets, settings.similarity).union(same).checkpoint()
    labels = components(stars).checkpoint()
    first = _open(places.select("key", "node", "n"), labels)
    drawn = confirmed(_draws(first, settings.similarity), sets, settings.similarity).checkpoint()
    stars = stars.union(drawn)
    labels = components(stars).checkpoint()
    _open(places.select("key", "band", "node", "n"), labels).write.parquet(f"{folder}/open")
    more = _rest(spark.read.parquet(f"{folder}/open"), represented, sets, settings).checkpoint()
    return labels if more.isEmpty() else components(stars.union(more)).checkpoint()


def group(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of each row."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "near-duplicates")
    sketches(docs, settings).write.parquet(f"{folder}/sketch")
    sketch = spark.read.parquet(f"{folder}/sketch")
    labels = links(docs, sketch, folder, settings)
    classes = spark.read.parquet(f"{folder}/classes")
    smallest = labels.join(classes, "node").groupBy("component").agg(F.min("first").alias("component_id"))
    linked = labels.join(smallest, "component").select("node", "component_id")
    classes = classes.join(linked, "node", "left").select("set_key", F.coalesce("component_id", "first").alias("component_id"))
    rows = sketch.select("doc_id", "n_shingles", "set_key").join(classes, "set_key", "left")
    component = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id"),
                       F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"))


def keep_one(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of the documents that are kept, with the columns they came with."""
    kept = group(docs, settings).where("kept").select("doc_id").distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["doc_id"]), "left_semi")
