"""Repeated byte strings removed from a corpus, by a distributed merge sort of sampled suffixes.

Every byte goes that lies in a string of ``length`` bytes which also starts anywhere else, in the same document or in
another one. Suffixes of all positions are not needed to find these strings: in each string of ``length`` bytes the
``gram`` bytes with the smallest hash (the last of equals) mark an anchor, and equal strings have their anchor at the
same place. About one position in ``(length - gram) / 2`` is an anchor. Around an anchor its context reaches
``length - gram`` bytes to the left and ``length`` to the right, within the document; two anchors whose contexts agree
on ``l`` bytes to the left and ``r`` to the right share a string if ``l + r >= length``.

1. ``anchors``: places, hashes of the gram and of the context.
2. Grams that occur once in the corpus drop out. A context that occurs twice is repeated as a whole, nothing is left to
   compare. For grams that also have single contexts, the distinct contexts are compared:
3. ``runs``: each task sorts the suffixes at its anchors (gram hash first, so ranges of it are even) and writes them
   as front-coded runs, cut by range. The runs are exchanged by range.
4. ``merge``: a loser tree merges the runs of a range. Every entry knows the prefix it shares with the last suffix put
   out; of two entries the one that shares more comes first, and bytes are only looked at beyond a shared prefix.
   The merge gives sorted suffixes with their common-prefix lengths, from which the overlaps with others follow.
5. Grams with more than ``hot`` distinct contexts (a line that very many documents share, amid different text) do not
   meet in one task: their contexts are cut into their strings of ``length`` bytes, which are counted by hash.
6. The spans of a document's anchors are united and its remaining bytes put together.

Null and empty texts have nothing to remove. Rows are told apart by ``doc_id`` and a hash of the text; rows equal in
both repeat each other. Contexts and grams are told apart by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
import os
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.arrow import mix64, slices

NO_ID = -(2 ** 63)
PLACE_BITS = 24  # anchors are chosen in blocks of up to 2**23 bytes


@dataclass(frozen=True)
class Settings:
    length: int = 200
    gram: int = 32
    run: int = 1 << 15  # suffixes a sorted run
    range: int = 1 << 15  # suffixes merged by one task
    hot: int = 4096
    small: int = 24  # contexts of one gram that are compared in pairs

    @property
    def left(self) -> int:
        return self.length - self.gram


# ------------------------------------------------------------------------------------------------------ anchors


def _order(data: np.ndarray, gram: int) -> np.ndarray:
    """A pseudo-random order of the grams that begin at each byte; ``gram`` is a power of two."""
    h, size, base = data.astype(np.uint64) + np.uint64(1), 1, 0x9E3779B97F4A7C15
    while size < gram:
        h = h[:-size] * np.uint64(base) + h[size:]
        size, base = 2 * size, base * base % 2 ** 64
    return mix64(h)


def anchor_places(data: np.ndarray, settings: Settings) -> np.ndarray:
    """Places of the anchors of one text, ascending."""
    found = []
    windows = settings.length - settings.gram + 1
    block = 1 << (PLACE_BITS - 1)
    for begin in range(0, max(0, len(data) - settings.length + 1), block):
        part = data[begin: begin + block + settings.length - 1]
        order = _order(part, settings.gram)
        place = np.arange(len(order), dtype=np.uint64)
        low = np.uint64((1 << PLACE_BITS) - 1)
        best = (order & ~low) | (low - place)  # of equal grams the last
        size = 1
        while 2 * size <= windows:
            best = np.minimum(best[:-size], best[size:])
            size *= 2
        if size < windows:
            best = np.minimum(best[: len(best) - (windows - size)], best[windows - size:])
        chosen = (low - (best & low)).astype(np.int64)
        found.append(begin + chosen[np.concatenate([[True], chosen[1:] != chosen[:-1]])])
    return np.unique(np.concatenate(found)) if found else np.zeros(0, dtype=np.int64)


def _signed(x: int) -> int:
    return x - 2 ** 64 if x >= 2 ** 63 else x


def context_hash(text: memoryview, place: int, settings: Settings) -> int:
    """Hash of the context and of how far it reaches to either side."""
    low, high = max(0, place - settings.left), min(len(text), place + settings.length)
    return _signed(xxhash.xxh3_64_intdigest(text[low:high], seed=(place - low) * 1024 + high - place))


def _keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, doc, mark, text``: the row's number, never null, and a hash of its text tell rows apart."""
    raw = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    number = F.col("doc_id").cast("long")
    return docs.select(number.alias("doc_id"), F.coalesce(number, F.lit(NO_ID)).alias("doc"),
                       F.xxhash64(raw).alias("mark"), raw.alias("text"))


def anchors(docs: DataFrame, settings: Settings) -> DataFrame:
    """``doc, mark, place, gram, context`` of every anchor."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            column = batch.column("text")
            places, counts, grams, contexts = [], [], [], []
            for k in range(batch.num_rows):
                data = column[k].as_buffer()
                view = memoryview(data)
                found = anchor_places(np.frombuffer(data, np.uint8), settings)
                places.append(found)
                counts.append(len(found))
                for p in found.tolist():
                    grams.append(_signed(xxhash.xxh3_64_intdigest(view[p: p + settings.gram])))
                    contexts.append(context_hash(view, p, settings))
            rows = np.repeat(np.arange(batch.num_rows), counts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc").take(pa.array(rows)), batch.column("mark").take(pa.array(rows)),
                 pa.array(np.concatenate(places)), pa.array(grams, pa.int64()), pa.array(contexts, pa.int64())],
                ["doc", "mark", "place", "gram", "context"])

    return _keyed(docs).select("doc", "mark", "text").mapInArrow(
        run, "doc long, mark long, place long, gram long, context long")


# --------------------------------------------------------------------------------------------------- sorted runs

ENTRY = struct.Struct("<HHqH")  # shared prefix, rest of the key, context hash, left context


def _key(gram: int, right: bytes) -> bytes:
    return struct.pack(">Q", gram % 2 ** 64) + right


def front_coded(entries: list[tuple[bytes, int, bytes]]) -> bytes:
    """Sorted ``(key, context, left)`` entries with each key cut by what it shares with the one before."""
    out, last = [], b""
    for key, context, left in entries:
        shared = len(os.path.commonprefix([last, key]))
        out += [ENTRY.pack(shared, len(key) - shared, context, len(left)), key[shared:], left]
        last = key
    return b"".join(out)


def decoded(run: bytes) -> Iterator[tuple[int, bytes, int, bytes]]:
    """``shared, key, context, left`` of the entries of a run; ``shared`` is the prefix in common with the last key."""
    at, key = 0, b""
    while at < len(run):
        shared, rest, context, left = ENTRY.unpack_from(run, at)
        at += ENTRY.size
        key = key[:shared] + run[at: at + rest]
        at += rest
        yield shared, key, context, run[at: at + left]
        at += left


def shared_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes are known."""
    n = min(len(a), len(b)) - known
    if n <= 0:
        return known
    x = int.from_bytes(a[known: known + n]) ^ int.from_bytes(b[known: known + n])
    return known + n - (x.bit_length() + 7) // 8


class LoserTree:
    """Merge of front-coded runs. Each run's head has the length of the prefix it shares with the last key put out, or,
    for a loser resting in the tree, with the winner that beat it; the two agree along the winner's path."""

    def __init__(self, runs: list[bytes]):
        self._runs = [decoded(r) for r in runs]
        self._size = 1
        while self._size < max(1, len(runs)):
            self._size *= 2
        self._head = [next(r, None) for r in self._runs] + [None] * (self._size - len(runs))
        self._shared = [0] * self._size
        self._rest = [0] * self._size  # loser at each inner node
        self._winner = self._build(1)

    def _build(self, node: int) -> int:
        if node >= self._size:
            return node - self._size
        return self._play(self._build(2 * node), self._build(2 * node + 1), node)

    def _play(self, a: int, b: int, node: int) -> int:
        """The smaller head goes on, the other rests at the node with what it shares with the winner."""
        x, y = self._head[a], self._head[b]
        if x is None or y is None:
            win, lose = (b, a) if x is None else (a, b)
        elif self._shared[a] != self._shared[b]:  # more in common with the last key: smaller; bytes need no look
            win, lose = (a, b) if self._shared[a] > self._shared[b] else (b, a)
            self._shared[lose] = min(self._shared[a], self._shared[b])
        else:
            same = shared_prefix(x[1], y[1], self._shared[a])
            win, lose = (a, b) if (x[1][same:same + 1], a) <= (y[1][same:same + 1], b) else (b, a)
            self._shared[lose] = same
        self._rest[node] = lose
        return win

    def __iter__(self) -> Iterator[tuple[int, bytes, int, bytes]]:
        """``shared, key, context, left`` in order of the keys; ``shared`` with the key put out before."""
        while True:
            run = self._winner
            head = self._head[run]
            if head is None:
                return
            yield self._shared[run], *head[1:]
            self._head[run] = following = next(self._runs[run], None)
            self._shared[run] = following[0] if following else 0
            node = (run + self._size) // 2
            while node:
                run = self._play(run, self._rest[node], node)
                node //= 2
            self._winner = run


# ---------------------------------------------------------------------------------------------------- comparing


def reach(group: list[tuple[int, bytes, int, bytes]], settings: Settings) -> Iterator[tuple[int, int, int]]:
    """``context, left, right``: how far the strings reach that a context shares with another one of its gram. The
    group is sorted by key; the left contexts are written backwards."""
    n, skip, length = len(group), 8, settings.length
    most = [[0, 0] for _ in range(n)]
    if n <= settings.small:
        for i in range(n):
            right = length + skip
            for j in range(i + 1, n):
                right = min(right, group[j][0])
                if right - skip < settings.gram:
                    break
                left = shared_prefix(group[i][3], group[j][3])
                if left + right - skip >= length:
                    for k in (i, j):
                        most[k] = [max(most[k][0], left), max(most[k][1], right - skip)]
    else:
        strings = [list(strings_of(left[::-1], key[skip:], settings)) for _, key, _, left in group]
        counts: dict[int, int] = {}
        for some in strings:
            for _, value in some:
                counts[value] = counts.get(value, 0) + 1
        for k, some in enumerate(strings):
            for left, value in some:
                if counts[value] > 1:
                    most[k] = [max(most[k][0], left), max(most[k][1], length - left)]
    for (_, _, context, _), (left, right) in zip(group, most):
        if right:
            yield context, left, right


def strings_of(left: bytes, right: bytes, settings: Settings) -> Iterator[tuple[int, int]]:
    """``bytes left of the anchor, hash`` of the strings of ``length`` bytes around an anchor."""
    whole = memoryview(left + right)
    for before in range(max(0, settings.length - len(right)), len(left) + 1):
        at = len(left) - before
        yield before, xxhash.xxh3_64_intdigest(whole[at: at + settings.length], seed=before)


def merged(runs: list[bytes], settings: Settings) -> Iterator[tuple[int, int, int]]:
    """``context, left, right`` from the runs of one range."""
    group: list[tuple[int, bytes, int, bytes]] = []
    for entry in LoserTree(runs):
        if group and entry[0] < 8 + settings.gram:
            if len(group) > 1:
                yield from reach(group, settings)
            group = []
        group.append(entry)
    if len(group) > 1:
        yield from reach(group, settings)


# --------------------------------------------------------------------------------------------------- distributed


def runs(docs: DataFrame, compared: DataFrame, ranges: int, settings: Settings) -> DataFrame:
    """``range, kind, data``: front-coded runs (kind 0), and packed strings of hot grams (kind 1). ``compared`` has the
    anchors to fetch: ``doc, mark, place, gram, context, hot``."""
    wanted = compared.groupBy("doc", "mark").agg(
        F.collect_list(F.struct("place", "gram", "context", "hot")).alias("wanted"))
    rows = _keyed(docs).select("doc", "mark", "text").join(wanted, ["doc", "mark"]).select("text", "wanted")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[bytes, int, bytes]] = []
        for batch in slices(batches):
            for text, wanted in zip(batch.column("text"), batch.column("wanted").to_pylist()):
                raw = memoryview(text.as_buffer())
                for w in wanted:
                    place = w["place"]
                    left = bytes(raw[max(0, place - settings.left): place])
                    right = bytes(raw[place: place + settings.length])
                    if w["hot"]:
                        found = list(strings_of(left, right, settings))
                        packed = np.array([[v % 2 ** 64, w["context"] % 2 ** 64, b] for b, v in found], dtype="<u8")
                        yield _row(0, 1, packed.tobytes())
                    else:
                        held.append((_key(w["gram"], right), w["context"], left[::-1]))
                if len(held) >= settings.run:
                    yield from cut(held)
                    held = []
        yield from cut(held)

    def cut(entries: list[tuple[bytes, int, bytes]]) -> Iterator[pa.RecordBatch]:
        entries.sort()
        begin = 0
        of = lambda key: int.from_bytes(key[:8]) * ranges >> 64
        for k in range(1, len(entries) + 1):
            if k == len(entries) or of(entries[k][0]) != of(entries[begin][0]):
                yield _row(of(entries[begin][0]), 0, front_coded(entries[begin:k]))
                begin = k

    def _row(number: int, kind: int, data: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([kind], pa.int32()),
                                           pa.array([data], pa.binary())], ["range", "kind", "data"])

    return rows.mapInArrow(run, "range long, kind int, data binary")


REACH = "context long, left long, right long"


def merge(exchanged: DataFrame, settings: Settings) -> DataFrame:
    """How far the repeated strings of each compared context reach, from the runs by range."""

    def one(table: pa.Table) -> pa.Table:
        found = list(merged([x.as_py() for x in table.column("data")], settings))
        columns = list(zip(*found)) if found else [(), (), ()]
        return pa.table([pa.array(list(c), pa.int64()) for c in columns], names=["context", "left", "right"])

    return exchanged.where("kind = 0").select("range", "data").groupBy("range").applyInArrow(one, REACH)


def hot_strings(exchanged: DataFrame, settings: Settings) -> DataFrame:
    """The same for hot grams: strings that two contexts have, counted by hash."""

    def unpack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "data"):
            flat = np.frombuffer(b"".join(batch.column("data").to_pylist()), "<u8").reshape(-1, 3).astype("<i8")
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(flat[:, k])) for k in range(3)],
                                             ["string", "context", "before"])

    strings = exchanged.where("kind = 1").select("data").mapInArrow(unpack, "string long, context long, before long")
    often = strings.groupBy("string").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("string")
    return strings.join(often, "string").groupBy("context").agg(
        F.max("before").alias("left"), (settings.length - F.min("before")).alias("right"))


def cleaned(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int]:
    """The bytes outside the spans, and how many maximal runs went."""
    parts, at, runs_removed, end = [], 0, 0, -1
    for a, b in sorted(spans):
        if a > end:
            runs_removed += 1
            if a > at:
                parts.append(text[at:a])
        end = at = max(end, b)
    parts.append(text[at:])
    return b"".join(parts), runs_removed


def deduplicate(docs: DataFrame, folder: str, settings: Settings = Settings(), with_text: bool = True) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of each row and, if wanted, ``kept``, the bytes that stay
    (removal may cut a character, so they are bytes). ``folder`` is a shared one."""
    spark = docs.sparkSession

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.option("compression", "zstd").parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    found = kept(anchors(docs, settings), "anchors")
    often = found.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram")
    repeated = kept(found.join(often, "gram", "left_semi"), "repeated")
    contexts = kept(repeated.groupBy("gram", "context").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "mark", "place")).alias("at")), "contexts")
    grams = contexts.groupBy("gram").agg(F.count(F.lit(1)).alias("contexts"), F.min("n").alias("least"))
    mixed = grams.where("contexts > 1 and least = 1").select("gram", (F.col("contexts") > settings.hot).alias("hot"))
    compared = kept(contexts.join(mixed, "gram").select("at.*", "gram", "context", "hot"), "compared")
    ranges = max(1, -(-compared.count() // settings.range))
    exchanged = kept(runs(docs, compared, ranges, settings), "runs")
    reached = merge(exchanged, settings).unionByName(hot_strings(exchanged, settings))
    # A context that occurs twice is repeated as far as it reaches; others as far as the comparison says.
    whole = contexts.where("n > 1").select("context", F.lit(settings.left).cast("long").alias("left"),
                                           F.lit(settings.length).cast("long").alias("right"))
    single = reached.join(contexts.where("n = 1").select("context"), "context", "left_semi")
    spans = repeated.join(whole.unionByName(single), "context").select(
        "doc", "mark", F.struct((F.col("place") - F.col("left")).alias("a"),
                                (F.col("place") + F.col("right")).alias("b")).alias("span"))
    by_row = spans.groupBy("doc", "mark").agg(F.collect_list("span").alias("spans"))

    def remove(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: list[list] = [[], [], [], [], []]
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                bounds = [(max(0, s["a"]), min(len(text), s["b"])) for s in spans or []]
                rest, n = cleaned(text, bounds)
                for column, value in zip(out, (len(text), len(text) - len(rest), n,
                                               hashlib.sha256(rest).hexdigest(), rest)):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            columns = [pa.array(c, k) for c, k in zip(out, kinds)][: 4 + with_text]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns],
                                             ["doc_id", *names[: 4 + with_text]])

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    return _keyed(docs).join(by_row, ["doc", "mark"], "left").select("doc_id", "text", "spans").mapInArrow(
        remove, schema)
