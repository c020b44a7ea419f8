"""Alignment of two tokenizers on the same bytes: a byte-level one (A) and a SentencePiece one (B).

Both encode a space and the text. Where a token of A and a token of B end at the same byte, the text is cut; the tokens
between two cuts are a group, and every token of A in a group is linked with every token of B in it.

1. Coarse cuts come from the character offsets of the ``tokenizers`` encoding and the spans of the ``sentencepiece``
   proto. A token of A that shares a character with the next one and a byte piece that is not the last of its character
   end inside a character and give none.
2. A segment between coarse cuts in which both sides have such tokens is refined: their decoded bytes tell where both
   end at the same byte of a character. Every cut is held against the decoded bytes; where offsets and bytes disagree,
   the whole chunk is cut by bytes.
3. Both tokenizers begin a token at a space that follows no white space, so a text falls into chunks (white space and
   what follows) that are aligned apart, once a worker. Tokenizers for which this does not hold align whole texts.
4. A pair of ids counts the documents that hold it linked. Counts of the pairs that occur most (``frequent``) are
   shipped to the tasks; the others are joined. Which are frequent changes no result.

Null and empty texts have no tokens, nor have texts whose tokens do not give back a space and the text on either side
(such as texts with U+2581). Rows with equal or null ``doc_id`` are all returned and count one by one. Texts are taken
whole. Strings of special tokens inside a text are plain text.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import accumulate, chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.arrow import binaries, plain, slices, spread, words

# A text is cut before spaces that follow no white space. Where every space stands alone, before all of them.
BEFORE_SPACES = re.compile(r"(?<=\S)(?= )")
WHITE = r"[\s\p{Z}\x0b\x1c-\x1f\x85]"
NOT_ALONE = f"^ |  |{WHITE} (?:{WHITE}|$)"
# Pairs whose counts are shipped to the tasks: 12 bytes each.
FREQUENT = 1 << 18
PIECE = attrgetter("id", "begin", "end")
LEVELS = 8  # steps of the counts' logarithm that the frequent pairs are chosen by


def byte_alphabet() -> dict[str, int]:
    """The printable character that a byte-level vocabulary writes for each byte: itself where it is printable Latin-1,
    else the next free one from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


# What one chunk adds to a text: whether its tokens give it back; numbers of tokens of A, tokens of B, groups and links;
# pair codes, their links, groups as text. A plain tuple of plain values, which the garbage collector does not walk.
Chunk = tuple[bool, tuple[int, int, int, int], bytes, bytes, str]


class Aligner(dict):
    """Aligned chunks of one pair of tokenizers, worked out once a worker process. Beyond ``LIMIT`` those that only one
    slice of texts has had leave."""

    LIMIT, LONGEST = 300_000, 64

    def __init__(self, byte_level: str, piece_model: str):
        super().__init__()
        self.again: set[str] = set()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True
        self.b = sp = sentencepiece.SentencePieceProcessor(model_file=piece_model)
        alphabet = byte_alphabet()
        self.a_bytes = [bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
                        for token in map(self.a.id_to_token, range(self.a.get_vocab_size()))]
        self.is_byte = [sp.is_byte(k) for k in range(sp.get_piece_size())]
        self.b_bytes = [bytes([int(sp.id_to_piece(k)[3:5], 16)]) if self.is_byte[k]
                        else sp.id_to_piece(k).replace("▁", " ").encode() for k in range(sp.get_piece_size())]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        self.byte_flags = np.array(self.is_byte)
        most = max(len(self.a_bytes), len(self.b_bytes))
        self.texts = {mark: np.array([f"{k}{mark}" for k in range(most)], dtype=object) for mark in ",|;"}
        self.width = 4 if len(self.a_bytes) * len(self.b_bytes) <= 1 << 32 else 8
        self.by_chunk = self._separable(byte_level)

    def _separable(self, byte_level: str) -> bool:
        with open(byte_level) as f:
            settings = json.load(f)
        before = settings.get("pre_tokenizer") or {}
        own = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        inside = any("▁" in self.b.id_to_piece(k).lstrip("▁") for k in range(len(self.b_bytes)))
        probe = "Ａ  ½ é\tx "
        return bool(own and not settings.get("normalizer") and not settings.get("post_processor") and not inside
                    and not self.b.is_unknown(self.b.piece_to_id("▁"))
                    and self.b.decode(self.b.encode(probe)) == probe)

    def _pieces(self, text: str) -> list[tuple[int, int, int]]:
        """Ids and byte spans of B's pieces. A space that ends a text is a chunk ``" "``, whose rest the library would
        take for an empty text."""
        if not text:
            return [(self.b.piece_to_id("▁"), 0, 0)]
        return list(map(PIECE, self.b.encode(text, return_type="proto").pieces))

    def groups(self, text: str) -> list[tuple[list[int], list[int]]] | None:
        """The groups of a text that begins with a space; None if its tokens do not give it back."""
        encoded, pieces = self.a.encode(text, add_special_tokens=False), self._pieces(text[1:])
        a, b, spans = encoded.ids, [p[0] for p in pieces], encoded.offsets
        data = text.encode()
        if b"".join([self.a_bytes[k] for k in a]) != data or b"".join([self.b_bytes[k] for k in b]) != data:
            return None
        byte_of = range(len(data) + 1) if len(data) == len(text) else [
            0, *accumulate(len(c.encode()) for c in text)]
        inner_a = [begin < end for (_, end), (begin, _) in zip(spans, spans[1:])] + [False]
        inner_b = [self.is_byte[k] and begin == end for k, begin, end in pieces]
        ends_a = {byte_of[end]: k for k, ((_, end), inner) in enumerate(zip(spans, inner_a), 1) if not inner}
        ends_b = {end + 1: k for k, ((_, _, end), inner) in enumerate(zip(pieces, inner_b), 1) if not inner}
        cuts = [(ends_a[x], ends_b[x], x) for x in sorted(ends_a.keys() & ends_b.keys())]
        past_a = [0, *accumulate(len(self.a_bytes[k]) for k in a)]
        past_b = [0, *accumulate(len(self.b_bytes[k]) for k in b)]
        if any(past_a[i] != x or past_b[j] != x for i, j, x in cuts) or not cuts or cuts[-1][:2] != (len(a), len(b)):
            cuts, inner_a, inner_b = [(len(a), len(b), len(data))], [True] * len(a), [True] * len(b)
        found, i0, j0 = [], 0, 0
        for i1, j1, _ in cuts:
            if any(inner_a[i0:i1]) and any(inner_b[j0:j1]):
                places = {past_b[j]: j for j in range(j0 + 1, j1)}
                fine = [(i, places[past_a[i]]) for i in range(i0 + 1, i1) if past_a[i] in places]
            else:
                fine = []
            for i, j in (*fine, (i1, j1)):
                found.append((a[i0:i], b[j0:j]))
                i0, j0 = i, j
        return found

    def __missing__(self, text: str) -> Chunk:
        groups = self.groups(text) if text else []
        if groups is None:
            made = (False, (0, 0, 0, 0), b"", b"", "")
        else:
            base, links = len(self.b_bytes), Counter()
            for a, b in groups:
                if len(a) == 1 == len(b):
                    links[a[0] * base + b[0]] += 1
                else:
                    in_b = Counter(b)
                    for x, n in Counter(a).items():
                        for y, m in in_b.items():
                            links[x * base + y] += n * m
            made = (
                True, (sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), links.total()),
                np.fromiter(links, f"<u{self.width}", len(links)).tobytes(),
                np.fromiter(links.values(), "<u8", len(links)).tobytes(),
                ";".join([f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups]))
        if len(text) <= self.LONGEST:
            self[text] = made
        return made

    def make_room(self) -> None:
        """Beyond the limit, keep the chunks that came again, or none if they are too many."""
        if len(self) > self.LIMIT:
            kept = {c: self[c] for c in self.again} if 3 * len(self.again) <= 2 * self.LIMIT else {}
            self.clear()
            self.update(kept)
            self.again.clear()

    def learn(self, chunks: list[str], at_once: int = 2000) -> None:
        """Align new chunks many at a time, as one text: it is cut before each of them. Chunks that end with white
        space, and runs for which offsets and bytes disagree, are left to the plain way."""
        fresh = [c for c in chunks if c not in self and not c[-1].isspace()]
        for begin in range(0, len(fresh), at_once):
            self._learn_run(fresh[begin: begin + at_once])

    def _learn_run(self, chunks: list[str]) -> None:
        text = "".join(chunks)
        encoded, pieces = self.a.encode(text, add_special_tokens=False), self._pieces(text[1:])
        data = text.encode()
        ids_a = encoded.ids
        spans_b = np.fromiter(chain.from_iterable(pieces), np.int64, 3 * len(pieces)).reshape(-1, 3)
        if (b"".join([self.a_bytes[k] for k in ids_a]) != data
                or b"".join([self.b_bytes[k] for k in spans_b[:, 0].tolist()]) != data):
            return
        a, b, spans_b = np.array(ids_a, np.int64), spans_b[:, 0].copy(), spans_b[:, 1:] + 1
        past_a, past_b = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        spans_a = np.fromiter(chain.from_iterable(encoded.offsets), np.int64, 2 * len(a)).reshape(-1, 2)
        byte_of = np.arange(len(text) + 1)
        if len(data) != len(text):
            points = np.frombuffer(text.encode("utf-32-le"), "<u4")
            byte_of[1:] += np.cumsum((points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF))
        ends = byte_of[np.cumsum(np.fromiter(map(len, chunks), np.int64, len(chunks)))]
        inner_a = np.append(spans_a[1:, 0] < spans_a[:-1, 1], False)
        inner_b = self.byte_flags[b] & (spans_b[:, 0] == spans_b[:, 1])
        outer_a, outer_b = np.flatnonzero(~inner_a), np.flatnonzero(~inner_b)
        places, at_a, at_b = np.intersect1d(byte_of[spans_a[outer_a, 1]], spans_b[outer_b, 1], return_indices=True)
        cuts_a, cuts_b = outer_a[at_a] + 1, outer_b[at_b] + 1
        if (past_a[cuts_a - 1] != places).any() or (past_b[cuts_b - 1] != places).any():
            return
        if inner_a.any() and inner_b.any():  # both end inside a character somewhere: byte by byte in these segments
            segment = np.searchsorted(cuts_a, np.flatnonzero(inner_a), "right")
            both = np.intersect1d(segment, np.searchsorted(cuts_b, np.flatnonzero(inner_b), "right"))
            fine, in_a, in_b = np.intersect1d(past_a, past_b, return_indices=True)
            inside = np.isin(np.searchsorted(places, fine), both)
            more = np.unique(np.concatenate([places, fine[inside]]), return_index=True)[1]
            cuts_a = np.concatenate([cuts_a, in_a[inside] + 1])[more]
            cuts_b = np.concatenate([cuts_b, in_b[inside] + 1])[more]
            places = past_a[cuts_a - 1]
        last = np.searchsorted(places, ends)  # the group that each chunk ends with
        if last[-1] >= len(places) or (places[last] != ends).any():
            return
        in_a, in_b = np.diff(cuts_a, prepend=0), np.diff(cuts_b, prepend=0)
        times = in_a * in_b
        group = np.repeat(np.arange(len(times)), times)
        nth = np.arange(len(group)) - np.repeat(np.cumsum(times) - times, times)
        codes = (a[(cuts_a - in_a)[group] + nth // in_b[group]] * len(self.b_bytes)
                 + b[(cuts_b - in_b)[group] + nth % in_b[group]]).astype(f"<u{self.width}")
        words = np.empty(len(a) + len(b), dtype=object)
        place_a = np.arange(len(a)) + np.repeat(cuts_b - in_b, in_a)
        place_b = np.arange(len(b)) + np.repeat(cuts_a, in_b)
        words[place_a], words[place_b] = self.texts[","][a], self.texts[","][b]
        words[place_a[cuts_a - 1]], words[place_b[cuts_b - 1]] = self.texts["|"][a[cuts_a - 1]], self.texts[";"][b[cuts_b - 1]]
        words = words.tolist()
        ends = cuts_a[last], cuts_b[last], last + 1, np.cumsum(times)[last]
        numbers = zip(*[np.diff(x, prepend=0).tolist() for x in ends])
        raw, ones = codes.tobytes(), np.ones(len(codes), "<u8").tobytes()
        w0 = r0 = 0
        for chunk, n, w1, r1 in zip(chunks, numbers, (ends[0] + ends[1]).tolist(), (ends[3] * self.width).tolist()):
            self[chunk] = (True, n, raw[r0:r1], ones[:8 * n[3]], "".join(words[w0:w1])[:-1])
            w0, r0 = w1, r1

    def of(self, texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """``sizes, groups, counts, codes, links``: four numbers and the groups of each text, the number of its
        distinct pairs, and these with their links, sorted, one text after the other."""
        self.make_room()
        filled = pc.greater(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(bool)
        hard = filled & (~np.bool_(self.by_chunk)
                         | pc.match_substring_regex(texts, NOT_ALONE).to_numpy(zero_copy_only=False).astype(bool))
        found = words(pc.if_else(pa.array(hard), pa.scalar(""), texts), lambda x: pc.split_pattern(x, " "),
                      keep_empty=True)
        wanted = [" " + w for w in found.vocabulary]
        self.again.update(filter(self.__contains__, wanted))
        if self.by_chunk:
            self.learn([c for c in wanted if len(c) <= self.LONGEST])
        chunks = [self[c] for c in wanted]
        easy = (filled & ~hard)[found.rows]
        rows, codes = [found.rows[easy]], [found.codes[easy]]
        for k in np.flatnonzero(hard).tolist():
            text = " " + texts[k].as_py()
            own = [self[c] for c in (BEFORE_SPACES.split(text) if self.by_chunk else [text])]
            codes.append(np.arange(len(chunks), len(chunks) + len(own)))
            rows.append(np.full(len(own), k))
            chunks += own
        rows, codes = np.concatenate(rows), np.concatenate(codes)
        order = np.argsort(rows, kind="stable")
        rows, codes = rows[order], codes[order]
        fits, numbers, pairs, times, parts = zip(*chunks) if chunks else [()] * 5
        fits = np.array(fits, dtype=bool)
        bad = np.bincount(rows, weights=~fits[codes], minlength=len(texts)) > 0
        rows, codes = rows[~bad[rows]], codes[~bad[rows]]
        sizes = np.zeros((len(texts), 4), dtype=np.int64)
        np.add.at(sizes, rows, np.array(numbers, dtype=np.int64).reshape(-1, 4)[codes])
        parts = np.array(parts, dtype=object)[codes].tolist()
        stops = np.cumsum(np.bincount(rows, minlength=len(texts))).tolist()
        groups = [";".join(parts[a:b]) for a, b in zip([0, *stops], stops)]
        pairs, each = spread(codes, pairs, self.width)
        times, _ = spread(codes, times, 8)
        base = len(self.a_bytes) * len(self.b_bytes)
        keys, back = np.unique(np.repeat(rows, each) * base + pairs.astype(np.int64), return_inverse=True)
        links = np.zeros(len(keys), dtype=np.int64)
        np.add.at(links, back, times.astype(np.int64))
        return sizes, groups, np.bincount(keys // base, minlength=len(texts)), keys % base, links


@lru_cache(maxsize=2)
def aligner(byte_level: str, piece_model: str) -> Aligner:
    return Aligner(byte_level, piece_model)


def aligned(docs: DataFrame, byte_level: str, piece_model: str, with_groups: bool = False) -> DataFrame:
    """``row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256`` of each row, its distinct pairs (``pairs``: codes
    ``a * size of B + b``, ``links``: how often each, both as little-endian bytes) and, if wanted, ``groups`` as text.
    ``row`` numbers the rows of this result once it is written."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = aligner(byte_level, piece_model)
        for batch in slices(batches):
            sizes, groups, counts, codes, links = found.of(batch.column("text"))
            digests = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
            out = [batch.column("row"), batch.column("doc_id"), *(pa.array(x) for x in sizes.T), pa.array(digests),
                   binaries(codes.astype(f"<u{found.width}"), counts), binaries(links.astype("<u4"), counts)]
            yield pa.RecordBatch.from_arrays(out + [pa.array(groups)] * with_groups, names=names)

    schema = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
              "pairs binary, links binary" + ", groups string" * with_groups)
    names = [x.split()[0] for x in schema.split(", ")]
    return plain(docs).withColumn("row", F.monotonically_increasing_id()).mapInArrow(run, schema)


def _summed(held: Iterable[tuple[np.ndarray, np.ndarray]], limit: int = 1 << 21) -> Iterator[tuple]:
    """Sums by key of ``keys, numbers``, in runs of at most about ``limit`` keys."""
    keys, numbers, waiting = [], [], 0
    for k, n in held:
        keys.append(k)
        numbers.append(n)
        waiting += len(k)
        if waiting > 2 * limit:
            merged, back = np.unique(np.concatenate(keys), return_inverse=True)
            total = np.bincount(back, weights=np.concatenate(numbers), minlength=len(merged)).astype(np.int64)
            keys, numbers, waiting = [merged], [total], len(merged)
            if waiting > limit:
                yield merged, total
                keys, numbers, waiting = [], [], 0
    if waiting:
        merged, back = np.unique(np.concatenate(keys), return_inverse=True)
        yield merged, np.bincount(back, weights=np.concatenate(numbers), minlength=len(merged)).astype(np.int64)


def pair_counts(held: DataFrame, size_b: int, width: int) -> DataFrame:
    """``code, n, best``: the documents that hold each pair linked, and whether no pair of the same id of A has more."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def codes():
            for batch in batches:
                for value in batch.column("pairs"):
                    found = np.frombuffer(value.as_buffer(), f"<u{width}").astype(np.int64)
                    yield found, np.ones(len(found), np.int64)

        for keys, numbers in _summed(codes()):
            for k in range(0, len(keys), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(keys[k: k + (1 << 16)]),
                                                  pa.array(numbers[k: k + (1 << 16)])], names=["code", "n"])

    counts = held.select("pairs").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    a = F.floor(F.col("code") / F.lit(size_b)).alias("a")
    highest = counts.groupBy(a).agg(F.max("n").alias("most"))
    # a row an id of A: no more than its vocabulary
    return counts.withColumn("a", a).join(F.broadcast(highest), "a").select(
        "code", "n", (F.col("n") == F.col("most")).alias("best"))


def _frequent(counts: DataFrame, most: int) -> tuple[DataFrame, int]:
    """The pairs from the lowest level of counts on that still holds no more than ``most``, and that level."""
    level = F.floor(F.log2("n") * LEVELS).cast("int").alias("level")
    sizes = {r["level"]: r["count"] for r in counts.groupBy(level).count().collect()}  # a few hundred levels
    chosen, total = 64 * LEVELS, 0
    for k in sorted(sizes, reverse=True):
        total += sizes[k]
        if total > most:
            break
        chosen = k
    return counts.withColumn("level", level), chosen


def score(spark: SparkSession, docs: DataFrame, byte_level: str, piece_model: str, folder: str,
          frequent: int = FREQUENT, with_groups: bool = False) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` (and ``groups``) of each row.

    ``n_best`` are the links whose pair has the highest count of its id of A, ``count_sum`` is the counts' sum over the
    links. What each row holds is written below ``folder`` once, since both tokenizers cost more than reading it."""
    sizes = aligner(byte_level, piece_model)
    size_b, width = len(sizes.b_bytes), sizes.width
    aligned(docs, byte_level, piece_model, with_groups).write.option("compression", "zstd").parquet(f"{folder}/held")
    held = spark.read.parquet(f"{folder}/held")
    pair_counts(held, size_b, width).write.parquet(f"{folder}/counts")
    counts, level = _frequent(spark.read.parquet(f"{folder}/counts"), frequent)
    table = counts.where(F.col("level") >= level).select("code", "n", "best").toPandas().sort_values("code")
    shipped = spark.sparkContext.broadcast(tuple(table[c].to_numpy() for c in ("code", "n", "best")))

    def split(batch: pa.RecordBatch):
        """Which of the batch's pairs are frequent, their place in the table, and the rows, codes and links of all."""
        codes = [np.frombuffer(x.as_buffer(), f"<u{width}") for x in batch.column("pairs")]
        rows = np.repeat(np.arange(batch.num_rows), [len(x) for x in codes])
        joined = np.concatenate(codes).astype(np.int64)
        links = np.concatenate([np.frombuffer(x.as_buffer(), "<u4") for x in batch.column("links")]).astype(np.int64)
        known = shipped.value[0]
        place = np.minimum(np.searchsorted(known, joined), max(len(known) - 1, 0))
        return known[place] == joined if len(known) else np.zeros(len(joined), bool), place, rows, joined, links

    def heads(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "pairs"):
            known, place, rows, _, links = split(batch)
            _, n, best = shipped.value
            place, rows, links = place[known], rows[known], links[known]
            sums = np.zeros((2, batch.num_rows), dtype=np.int64)
            np.add.at(sums[0], rows, links * best[place])
            np.add.at(sums[1], rows, links * n[place])
            keep = [c for c in batch.schema.names if c not in ("pairs", "links")]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(x) for x in sums],
                                             names=[*keep, "n_best", "count_sum"])

    def tails(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "pairs"):
            known, _, rows, codes, links = split(batch)
            number = batch.column("row").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(number[rows[~known]]), pa.array(codes[~known]),
                                              pa.array(links[~known])], names=["row", "code", "links"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in held.schema if f.name not in ("pairs", "links"))
    rare = counts.where(F.col("level") < level).select("code", "n", "best")
    added = (held.select("row", "pairs", "links").mapInArrow(tails, "row long, code long, links long")
             .join(rare, "code").groupBy("row").agg(F.sum(F.col("links") * F.col("best").cast("long")).alias("more_best"),
                                                    F.sum(F.col("links") * F.col("n")).alias("more_sum")))
    added.write.parquet(f"{folder}/rare")
    scored = held.mapInArrow(heads, schema + ", n_best long, count_sum long").join(
        spark.read.parquet(f"{folder}/rare"), "row", "left")
    plus = lambda x, y: (F.col(x) + F.coalesce(F.col(y), F.lit(0))).alias(x)
    return scored.select("doc_id", "n_a", "n_b", "n_groups", "n_links", plus("n_best", "more_best"),
                         plus("count_sum", "more_sum"), "groups_sha256", *["groups"] * with_groups)
