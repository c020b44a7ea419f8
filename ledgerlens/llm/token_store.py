"""Token ids in compressed binary form: static range asymmetric numeral coding over one shared frequency table.

A store is a folder with

* ``table/``  – the shared table: one row a symbol with its count and its share of ``2**bits`` slots,
* ``blocks/`` – one row a block, files and rows in ascending document order. A block is a self-contained byte string
  of whole documents: header, document index, checkpoints, code words. It can be decoded alone, given the table.

Inside a block, ``lanes`` coders take the tokens in turn (token ``i`` belongs to lane ``i % lanes``) and share one word
stream. A checkpoint holds the lanes' states and the place in the word stream after every ``interval`` rows, so a
reader decodes the segments between checkpoints side by side. Every block carries the CRC-32 of its words and of its
tokens; a reader that finds another value raises.

Bounds: a task holds one batch of blocks (``batch_tokens``, or one document if that is longer). The table has at most
one row a symbol of the vocabulary, which is why it may be collected and shipped to the tasks.
"""

from __future__ import annotations

import struct
import unicodedata
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.arrow import SLICE_BYTES, binaries, gather, plain, slices, spread, words

LOW = np.uint64(1 << 31)  # states stay in [2**31, 2**63)
HALF = np.uint64(32)
MAGIC = b"LLRB"
HEADER = struct.Struct("<4sIIIIQQIII")  # magic, table check, lanes, interval, documents, tokens, words, 3 checks


# ---------------------------------------------------------------------------------------------- tokens of texts


class ChunkTokens(dict):
    """Token ids, as little-endian unsigned 32-bit bytes, of chunks without ASCII white space, apart from their closing
    punctuation.

    For tokenizers that lower-case, drop white space and never join pre-tokens across it, the ids of a text are those
    of its white-space chunks one after the other. Their parts repeat, so each is encoded once and kept; texts for which
    the shortcut does not hold are encoded whole.

    A worker holds the store beside what later stages need, so when there are ``LIMIT`` parts they become the older
    half of the store, and those of the half before that did not come again are forgotten: some 120 MB for both.
    """

    LIMIT = 300_000
    TAIL = ".,!?;:#*$%&|<>()"
    PLAIN = "^[a-z\u00df-\u00f6\u00f8-\u00ff]+$"  # lower-case letters that no normalizer touches

    def __init__(self, tokenizer):
        super().__init__()
        self._tokenizer, self._older = tokenizer, {}
        suffix = getattr(tokenizer.model, "end_of_word_suffix", None)
        size = tokenizer.get_vocab_size() if suffix else 0
        self._closing = np.array([tokenizer.id_to_token(k).endswith(suffix) for k in range(size)], dtype=bool)
        self._lean, self._bytes = self._without_rules(tokenizer)

    @staticmethod
    def _without_rules(tokenizer):
        """The tokenizer for plain words between spaces, without the normalizer and the splits that leave those as they
        are, and how their letters are written for it. The tokenizer itself if it treats a sample of such words in
        another way."""
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        lean, level = Tokenizer.from_str(tokenizer.to_str()), pre_tokenizers.ByteLevel(False, use_regex=False)
        lean.normalizer, lean.pre_tokenizer = normalizers.Sequence([]), pre_tokenizers.WhitespaceSplit()
        letters = [chr(k) for k in (*range(0x61, 0x7b), *range(0xdf, 0x100)) if k != 0xf7]
        written = {c: level.pre_tokenize_str(c)[0][0] for c in letters if not c.isascii()}
        sample = " ".join(a + b for a in letters for b in letters)
        same = (tokenizer.encode(sample, add_special_tokens=False).ids
                == lean.encode(_replaced(sample, written), add_special_tokens=False).ids)
        return (lean, written) if same else (tokenizer, {})

    def of(self, texts: pa.Array, close: bytes = b"") -> pa.Array:
        """Id strings of the texts, each followed by ``close``."""
        if len(self) > self.LIMIT:
            self._older = dict(self)
            self.clear()
        whole = self._whole(texts)
        easy = texts if whole is None else pc.if_else(pa.array(whole), pa.scalar(""), texts)
        found = words(pc.utf8_lower(easy))
        pool, sizes = self._ids(found.vocabulary)
        # one more code after the words of each text, for the close
        pool, sizes = np.concatenate([pool, np.frombuffer(close, "<u4")]), np.append(sizes, len(close) // 4)
        codes = np.full(len(found.codes) + len(texts), len(sizes) - 1, dtype=np.int64)
        codes[np.arange(len(found.codes)) + found.rows] = found.codes
        items, each = gather(codes, pool, sizes)
        ends = np.cumsum(each)[np.cumsum(found.counts + 1) - 1] if len(texts) else each
        out = binaries(items, np.diff(ends, prepend=0))
        if whole is not None:
            hard = [ids + close for ids in self._encode(texts.filter(pa.array(whole)).to_pylist())]
            places = np.where(whole, len(texts) + np.cumsum(whole) - 1, np.arange(len(texts)))
            out = pa.concat_arrays([out, pa.array(hard, pa.binary())]).take(pa.array(places))
        return out

    @staticmethod
    def _whole(texts: pa.Array) -> np.ndarray | None:
        """Which texts must be encoded whole; None if there are none."""
        hard = pc.match_substring_regex(texts, "<\\||[\\x1c-\\x1f\u0130\u03a3\u180e\u200b]").to_numpy(
            zero_copy_only=False).astype(bool)
        for k in np.flatnonzero(~pc.string_is_ascii(texts).to_numpy(zero_copy_only=False).astype(bool)):
            hard[k] = hard[k] or not unicodedata.is_normalized("NFC", texts[k].as_py())
        return hard if hard.any() else None

    def _ids(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunks one after the other, and how many each has. Closing punctuation after a letter or digit is
        a pre-token of its own, so the parts are looked up, not the chunks: fewer strings are distinct."""
        column = pa.array(chunks, pa.string())
        cores = pc.utf8_rtrim(column, characters=self.TAIL)
        # a core may end in a digit or letter only
        apart = pc.and_(pc.match_substring_regex(cores, "[\\pL\\pN]$"), pc.not_equal(cores, column))
        tails = [w[len(core):] for w, core in zip(_strings(column.filter(apart)), _strings(cores.filter(apart)))]
        coded = pa.concat_arrays([pc.if_else(apart, cores, column), pa.array(tails, pa.string())]).dictionary_encode()
        parts, values = coded.indices.to_numpy(), self._looked_up(_strings(coded.dictionary))
        two = apart.to_numpy(zero_copy_only=False)
        heads = np.arange(len(chunks)) + np.cumsum(two) - two
        order = np.empty(len(parts), dtype=np.int64)
        order[heads], order[heads[two] + 1] = parts[: len(chunks)], parts[len(chunks):]
        items, each = spread(order, values, 4)
        return items, np.add.reduceat(each, heads) if len(chunks) else each

    def _looked_up(self, parts: list[str]) -> list[bytes]:
        """Id strings of distinct parts; those of the older half move up, and what is new is encoded."""
        values = list(map(self.get, parts))
        missing = [k for k, value in enumerate(values) if value is None]
        wanted = [parts[k] for k in missing]
        if self._older:
            known = list(map(self._older.get, wanted))
            self.update((w, ids) for w, ids in zip(wanted, known) if ids is not None)
            self._learn_words([w for w, ids in zip(wanted, known) if ids is None])
        else:
            self._learn_words(wanted)
        for k, ids in zip(missing, map(self.__getitem__, wanted)):
            values[k] = ids
        return values

    def _learn_words(self, wanted: list[str]) -> None:
        """Words of letters alone are one pre-token each, so many are encoded as one text."""
        column = pa.array(wanted, pa.string())
        simple = pc.match_substring_regex(column, self.PLAIN)
        plain = column.filter(simple)
        ascii_only = pc.string_is_ascii(plain)
        self._learn_joined(self._lean, _strings(plain.filter(ascii_only)))
        self._learn_joined(self._lean, _strings(plain.filter(pc.invert(ascii_only))), self._bytes)
        others = _strings(column.filter(pc.invert(simple)))
        self._learn_joined(self._tokenizer, [w for w in others if w.isalpha()])
        others = [w for w in wanted if w not in self]
        self.update(zip(others, self._encode(others)))

    def _learn_joined(self, tokenizer, wanted: list[str], written: dict | None = None, at_once: int = 5000) -> None:
        """Words of one text are told apart by the tokens that end a word. Where the number of ends does not agree, the
        words are left to the plain way."""
        for begin in range(0, len(wanted), at_once):
            some = wanted[begin: begin + at_once]
            (found,) = tokenizer.encode_batch_fast([_replaced(" ".join(some), written or {})], add_special_tokens=False)
            ids = np.array(found.ids, dtype="<u4")
            ends = np.flatnonzero(self._closing[ids]) + 1 if len(self._closing) else ids[:0]
            if len(ends) == len(some):
                raw, stops = ids.tobytes(), (4 * ends).tolist()
                self.update(zip(some, (raw[a:b] for a, b in zip([0, *stops], stops))))

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False) if texts else []
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]


def _replaced(text: str, written: dict[str, str]) -> str:
    """The text with its characters written in another way; none of them occurs in what another one becomes."""
    for character, other in written.items():
        text = text.replace(character, other)
    return text


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


@lru_cache(maxsize=2)
def chunk_tokens(path: str) -> ChunkTokens:
    """One cache a worker process and vocabulary file. Texts are spread over tasks by Spark, so one thread is right."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return ChunkTokens(Tokenizer.from_file(path))


def token_ids(docs: DataFrame, vocabulary: str, end_id: int | None = None, width: int = 4) -> DataFrame:
    """``doc_id, ids``: token ids of whole texts as little-endian unsigned numbers of ``width`` bytes (2 will do for
    vocabularies of up to 65,536 entries), closed by ``end_id``."""
    close = b"" if end_id is None else struct.pack("<I", end_id)

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = chunk_tokens(vocabulary)
        for batch in slices(batches, limit=2 * SLICE_BYTES):  # a word is looked up once a slice
            ids = cache.of(batch.column("text"), close)
            if width == 2:
                ids = narrow(ids)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], ["doc_id", "ids"])

    return plain(docs).mapInArrow(encode, "doc_id long, ids binary")


def narrow(ids: pa.Array) -> pa.Array:
    """Id strings of 32-bit numbers as such of 16-bit numbers; larger ids raise."""
    items = np.frombuffer(b"".join(ids.to_pylist()), dtype="<u4")
    if len(items) and items.max() > 0xFFFF:
        raise ValueError("ids do not fit into two bytes")
    counts = pc.binary_length(ids).to_numpy(zero_copy_only=False).astype(np.int64) // 4
    return binaries(items.astype("<u2"), counts)


# ------------------------------------------------------------------------------------------------ shared table


@dataclass(frozen=True)
class Table:
    """Slots of each symbol; ``frequency`` sums to ``2**bits`` over symbols that occur."""

    bits: int
    frequency: np.ndarray

    @staticmethod
    def of(symbols: np.ndarray, counts: np.ndarray, bits: int | None = None) -> Table:
        """Every symbol that occurs gets one slot, the rest is dealt out in proportion."""
        size = int(symbols.max()) + 1 if len(symbols) else 1
        bits = bits or min(24, max(16, int(np.ceil(np.log2(max(2, len(symbols))))) + 4))
        frequency = np.zeros(size, dtype=np.uint64)
        if len(symbols):
            spare = (1 << bits) - len(symbols)
            share = 1 + np.floor(spare * (counts / counts.sum())).astype(np.int64)
            share[np.argmax(counts)] += (1 << bits) - int(share.sum())
            frequency[symbols] = share
        return Table(bits, frequency)

    @property
    def start(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.frequency)[:-1]]).astype(np.uint64)

    @property
    def slots(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.frequency), dtype=np.uint32), self.frequency.astype(np.int64))

    @property
    def check(self) -> int:
        return zlib.crc32(self.frequency.astype("<u8").tobytes() + bytes([self.bits]))


def symbol_counts(ids: DataFrame, width: int = 4) -> DataFrame:
    """``symbol, count`` over all id strings; each task sends one row a symbol it has seen."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, dtype=np.int64)
        for batch in batches:
            for value in batch.column("ids"):
                found = np.bincount(np.frombuffer(value.as_buffer(), f"<u{width}")) if value.is_valid else total[:0]
                if len(found) > len(total):
                    total = np.concatenate([total, np.zeros(len(found) - len(total), dtype=np.int64)])
                total[: len(found)] += found
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["symbol", "count"])

    return (ids.select("ids").mapInArrow(count, "symbol long, count long")
            .groupBy("symbol").agg(F.sum("count").alias("count")))


# ------------------------------------------------------------------------------------------------------ coding


def encode_blocks(blocks: list[np.ndarray], table: Table, lanes: int, interval: int) -> list[tuple]:
    """``(words, states, places)`` of each block; ``states`` has a row of lane states a checkpoint and ``places``
    where its words begin. All blocks advance row by row together, shorter ones join late (coding runs backwards)."""
    order = sorted(range(len(blocks)), key=lambda k: -len(blocks[k]))
    rows = np.array([-(-len(blocks[k]) // lanes) for k in order], dtype=np.int64)
    top = int(rows[0]) if len(rows) else 0
    filler = int(np.argmax(table.frequency))
    tokens = np.full((len(order), top, lanes), filler, dtype=np.uint32)
    for at, k in enumerate(order):
        tokens[at].reshape(-1)[: len(blocks[k])] = blocks[k]
    tokens = np.ascontiguousarray(tokens.transpose(1, 0, 2))
    frequency, start, bits = table.frequency, table.start, np.uint64(table.bits)
    room = np.uint64(63 - table.bits)
    state = np.full((len(order), lanes), LOW, dtype=np.uint64)
    words, counts = [], np.zeros((top, len(order)), dtype=np.int64)
    states = np.zeros((-(-top // interval), len(order), lanes), dtype=np.uint64)
    live = np.searchsorted(-rows, -np.arange(top), "left") if top else []  # blocks with more rows than the row's number
    for row in range(top - 1, -1, -1):
        n = int(live[row])
        x, f, c = state[:n], frequency[tokens[row, :n]], start[tokens[row, :n]]
        full = x >= (f << room)
        words.append(x[full].astype(np.uint32))
        counts[row, :n] = full.sum(axis=1)
        x = np.where(full, x >> HALF, x)
        q = x // f
        state[:n] = (q << bits) + (x - q * f) + c
        if row % interval == 0:
            states[row // interval, :n] = state[:n]
    words.reverse()
    stream = np.concatenate(words) if words else np.zeros(0, dtype=np.uint32)
    owner = np.repeat(np.tile(np.arange(len(order)), top), counts.reshape(-1))
    stream = stream[np.argsort(owner, kind="stable")]
    bounds = np.concatenate([[0], np.cumsum(counts.sum(axis=0))])
    before = np.cumsum(counts, axis=0) - counts
    out: list[tuple] = [()] * len(order)
    for at, k in enumerate(order):
        marks = np.arange(0, int(rows[at]), interval)
        out[k] = (stream[bounds[at]: bounds[at + 1]], states[: len(marks), at], before[marks, at])
    return out


def decode_blocks(coded: list[tuple], table: Table, lanes: int, interval: int) -> list[np.ndarray]:
    """Tokens of blocks given as ``(words, states, places, tokens)``; every checkpoint starts a segment of its own."""
    segments = []
    for k, (_, states, places, n) in enumerate(coded):
        rows = -(-n // lanes)
        segments += [(min(interval, rows - s * interval), k, s) for s in range(len(places))]
    segments.sort(key=lambda x: -x[0])
    base = np.concatenate([[0], np.cumsum([len(c[0]) for c in coded])])
    stream = np.concatenate([*(c[0] for c in coded), np.zeros(1, dtype=np.uint32)])
    slots, frequency, start, bits = table.slots, table.frequency, table.start, np.uint64(table.bits)
    low = np.uint64((1 << table.bits) - 1)
    lengths = np.array([x[0] for x in segments], dtype=np.int64)
    top = int(lengths[0]) if len(lengths) else 0
    state = (np.stack([coded[k][1][s] for _, k, s in segments]) if segments else np.zeros((0, lanes))).astype(np.uint64)
    place = np.array([base[k] + coded[k][2][s] for _, k, s in segments], dtype=np.int64)
    found = np.zeros((top, len(segments), lanes), dtype=np.uint32)
    live = np.searchsorted(-lengths, -np.arange(top), "left") if top else []
    for row in range(top):
        n = int(live[row])
        x = state[:n]
        slot = x & low
        symbol = slots[slot]
        found[row, :n] = symbol
        x = frequency[symbol] * (x >> bits) + slot - start[symbol]
        short = x < LOW
        ahead = np.cumsum(short, axis=1)
        at = np.minimum(place[:n, None] + ahead - 1, len(stream) - 1)
        state[:n] = np.where(short, (x << HALF) | stream[at], x)
        place[:n] += ahead[:, -1]
    out = [np.zeros(-(-c[3] // lanes) * lanes, dtype=np.uint32) for c in coded]
    for at, (rows, k, s) in enumerate(segments):
        begin = s * interval * lanes
        out[k][begin: begin + rows * lanes] = found[:rows, at].reshape(-1)
    return [tokens[: c[3]] for tokens, c in zip(out, coded)]


def pack(ids: np.ndarray, lengths: np.ndarray, tokens: np.ndarray, coded: tuple, check: int, lanes: int,
         interval: int) -> bytes:
    """One block as bytes. Document numbers are stored with a mask of those that are null."""
    words, states, places = coded
    null = np.array([x is None for x in ids], dtype=np.uint8)
    numbers = np.array([0 if x is None else x for x in ids], dtype="<i8")
    body = b"".join([null.tobytes(), numbers.tobytes(), lengths.astype("<u8").tobytes(),
                     places.astype("<u8").tobytes(), states.astype("<u8").tobytes()])
    payload = words.astype("<u4").tobytes()
    return HEADER.pack(MAGIC, check, lanes, interval, len(ids), len(tokens), len(words), zlib.crc32(body),
                       zlib.crc32(payload), zlib.crc32(tokens.astype("<u4").tobytes())) + body + payload


def unpack(block: bytes, check: int) -> tuple:
    """``(null mask, document numbers, lengths, coded, lanes, interval, token check)`` of a block."""
    magic, made_with, lanes, interval, docs, tokens, words, *checks = HEADER.unpack_from(block)
    if magic != MAGIC or made_with != check:
        raise ValueError("not a block of this store")
    marks = -(-(-(-tokens // lanes)) // interval)
    sizes = [docs, 8 * docs, 8 * docs, 8 * marks, 8 * marks * lanes]
    body = block[HEADER.size: HEADER.size + sum(sizes)]
    payload = block[HEADER.size + sum(sizes):]
    if zlib.crc32(body) != checks[0] or zlib.crc32(payload) != checks[1] or len(payload) != 4 * words:
        raise ValueError("a block is damaged")
    cuts = np.cumsum([0, *sizes])
    part = [body[a:b] for a, b in zip(cuts, cuts[1:])]
    coded = (np.frombuffer(payload, "<u4"), np.frombuffer(part[4], "<u8").reshape(marks, lanes),
             np.frombuffer(part[3], "<u8").astype(np.int64), tokens)
    return (np.frombuffer(part[0], np.uint8), np.frombuffer(part[1], "<i8"), np.frombuffer(part[2], "<u8"),
            coded, lanes, interval, checks[2])


# ----------------------------------------------------------------------------------------------- write and read

BLOCKS = "part int, number int, first long, docs int, tokens long, block binary"


def write(ids: DataFrame, folder: str, lanes: int = 64, interval: int = 512, block_tokens: int = 1 << 17,
          batch_tokens: int = 1 << 22, width: int = 4) -> None:
    """Write ``doc_id, ids`` (numbers of ``width`` bytes) as a store, in ascending order of ``doc_id`` (nulls first; repeated numbers in the order
    of their ids). ``ids`` is read three times, so pass a written table. An empty table gives an empty store."""
    spark = ids.sparkSession
    counts = symbol_counts(ids, width)
    found = counts.toPandas()  # at most one row a symbol of the vocabulary
    table = Table.of(found["symbol"].to_numpy(), found["count"].to_numpy())
    bits, share = table.bits, table.frequency
    rows = [(bits, int(s), int(c), int(share[s])) for s, c in found.sort_values("symbol").itertuples(index=False)]
    spark.createDataFrame(rows, "bits int, symbol long, count long, slots long").coalesce(1).write.parquet(
        f"{folder}/table")
    shared = spark.sparkContext.broadcast(table)

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, part, number, first = shared.value, TaskContext.get().partitionId(), 0, 0
        for blocks in _batches(_blocks(batches, block_tokens, width), batch_tokens):
            tokens = [np.concatenate(b[1]) for b in blocks]
            out = []
            for (docs, parts), t, coded in zip(blocks, tokens, encode_blocks(tokens, table, lanes, interval)):
                lengths = np.array([len(p) for p in parts], dtype=np.uint64)
                out.append((part, number, first, len(docs), len(t),
                            pack(docs, lengths, t, coded, table.check, lanes, interval)))
                number, first = number + 1, first + len(t)
            columns = [pa.array(list(c), kind) for c, kind in zip(zip(*out), (
                pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, ["part", "number", "first", "docs", "tokens", "block"])

    tie = F.xxhash64("ids")
    (ids.select("doc_id", "ids", tie.alias("tie")).repartitionByRange("doc_id", "tie")
     .sortWithinPartitions("doc_id", "tie").select("doc_id", "ids")
     .mapInArrow(encode, BLOCKS).write.parquet(f"{folder}/blocks"))


def _blocks(batches: Iterable[pa.RecordBatch], size: int, width: int) -> Iterator[tuple[list, list]]:
    """Runs of whole documents with about ``size`` tokens."""
    docs, parts, held = [], [], 0
    for batch in batches:
        for doc, value in zip(batch.column("doc_id").to_pylist(), batch.column("ids")):
            tokens = np.frombuffer(value.as_py() or b"", dtype=f"<u{width}")
            if docs and held + len(tokens) > size:
                yield docs, parts
                docs, parts, held = [], [], 0
            docs.append(doc)
            parts.append(tokens)
            held += len(tokens)
    if docs:
        yield docs, parts


def _batches(blocks: Iterator[tuple[list, list]], size: int) -> Iterator[list[tuple[list, list]]]:
    held, out = 0, []
    for block in blocks:
        out.append(block)
        held += sum(map(len, block[1]))
        if held >= size:
            yield out
            held, out = 0, []
    if out:
        yield out


def load_table(spark: SparkSession, folder: str) -> Table:
    """The shared table of a store: at most one row a symbol of the vocabulary."""
    found = spark.read.parquet(f"{folder}/table").toPandas()
    size = int(found["symbol"].max()) + 1 if len(found) else 1
    frequency = np.zeros(size, dtype=np.uint64)
    frequency[found["symbol"].to_numpy(dtype=np.int64)] = found["slots"].to_numpy()
    return Table(int(found["bits"].iloc[0]) if len(found) else 16, frequency)


def read(spark: SparkSession, folder: str, with_ids: bool = True, batch_tokens: int = 1 << 22) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` and, if wanted, ``ids`` of every document of a store. ``start`` counts
    the ids of all documents before it; blocks know their place in their file, and a running total over the files
    (one row each) gives the rest."""
    shared = spark.sparkContext.broadcast(load_table(spark, folder))
    blocks = spark.read.parquet(f"{folder}/blocks")

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in slices(batches, "block", limit=2 * batch_tokens):
            got = [unpack(b, table.check) for b in batch.column("block").to_pylist()]
            groups: dict[tuple[int, int], list[int]] = {}
            for k, g in enumerate(got):
                groups.setdefault((g[4], g[5]), []).append(k)
            tokens: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(got)
            for (lanes, interval), members in groups.items():
                for k, t in zip(members, decode_blocks([got[k][3] for k in members], table, lanes, interval)):
                    tokens[k] = t
            out: list[list] = [[], [], [], [], [], []]
            for part, first, (null, numbers, lengths, *_, check), t in zip(
                    batch.column("part").to_pylist(), batch.column("first").to_pylist(), got, tokens):
                raw = memoryview(t.astype("<u4").tobytes())
                if zlib.crc32(raw) != check:
                    raise ValueError("a block's tokens do not match their check")
                at = 0
                for missing, doc, n in zip(null.tolist(), numbers.tolist(), lengths.tolist()):
                    piece = raw[4 * at: 4 * (at + n)]
                    for column, value in zip(out, (part, None if missing else doc, first + at, n, zlib.crc32(piece),
                                                   bytes(piece) if with_ids else None)):
                        column.append(value)
                    at += n
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], [
                "part", "doc_id", "at", "n_tokens", "ids_crc32", "ids"])

    docs = blocks.select("part", "first", "block").mapInArrow(
        decode, "part int, doc_id long, at long, n_tokens long, ids_crc32 long, ids binary")
    sums = blocks.groupBy("part").agg(F.sum("tokens").alias("tokens"))
    running = F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sums.select("part", F.coalesce(running, F.lit(0)).alias("before"))
    found = docs.join(offsets, "part").select(
        "doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", "ids")
    return found if with_ids else found.drop("ids")
