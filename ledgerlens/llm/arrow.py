"""Small helpers for operators that work on Arrow batches inside Spark tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes of text that a task works on at a time. A single longer text is worked on alone.
SLICE_BYTES = 2 << 20
# Rows in one Arrow batch: what the JVM and a Python worker hold at once.
BATCH_ROWS = 2000


def small_batches(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches of a session to texts that fit beside each other."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def plain(docs: DataFrame, kind: str = "string", text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The two columns an operator reads, whatever else the table holds: ``doc_id`` as a long and ``text`` as text or
    as its UTF-8 bytes, empty where it is null."""
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).cast(kind).alias("text"))


def slices(batches: Iterable[pa.RecordBatch], column: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that each slice holds about ``limit`` bytes in ``column``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit integers (multiply and shift twice)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@dataclass(frozen=True)
class Words:
    """The words of some texts: ``codes`` in text order, ``counts`` by text, and the words that the codes stand for."""

    codes: np.ndarray
    counts: np.ndarray
    vocabulary: list[str]

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.counts) - self.counts


def words(texts: pa.Array, split=pc.ascii_split_whitespace, keep_empty: bool = False) -> Words:
    """Words between white space (the six ASCII characters, or what ``split`` takes for it)."""
    lists = split(texts)
    counts = np.diff(lists.offsets.to_numpy()).astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.int64)
    vocabulary = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    if not keep_empty and "" in vocabulary:
        full = codes != vocabulary.index("")
        counts = np.bincount(np.repeat(np.arange(len(counts)), counts), weights=full,
                             minlength=len(counts)).astype(np.int64)
        codes = codes[full]
    return Words(codes, counts, vocabulary)


def spread(codes: np.ndarray, values: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The values of the codes one after the other, as items of ``width`` bytes, and the number of items of each."""
    sizes = np.fromiter(map(len, values), dtype=np.int64, count=len(values)) // width
    pool = np.frombuffer(b"".join(values), dtype=f"<u{width}")
    return gather(codes, pool, sizes)


def gather(codes: np.ndarray, pool: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for values that stand one after the other in ``pool``, ``sizes`` items each."""
    begins = np.cumsum(sizes) - sizes
    each = sizes[codes]
    ends = np.cumsum(each)
    total = int(ends[-1]) if len(ends) else 0
    return pool[np.arange(total) + np.repeat(begins[codes] - (ends - each), each)], each


def binaries(items: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Runs of ``counts`` items as a binary column."""
    offsets = np.concatenate([[0], np.cumsum(counts * items.itemsize)])
    if offsets[-1] < 2 ** 31:
        return pa.Array.from_buffers(pa.binary(), len(counts), [
            None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(items))])
    raw = items.tobytes()
    return pa.array([raw[a:b] for a, b in zip(offsets, offsets[1:])], pa.binary())
