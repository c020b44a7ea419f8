"""SentencePiece-style merge encoding by a table of last pieces, and decoding.

For each prefix of a chunk the table stores the one piece that the encoding of the prefix ends with. Candidates are the
vocabulary pieces that end there (found by an Aho-Corasick automaton over the vocabulary); a candidate holds if it is
compatible with the last piece of the prefix before it, i.e. if the two, merged from characters, come out as just these
two. Following the table backwards from the end gives the ids. Characters outside the vocabulary become byte pieces and
stop merging.

White space is written as U+2581 and only begins a piece, so a text falls into chunks (a run of such marks and what
follows up to the next one) that are encoded apart and kept, since they repeat.

A model qualifies if it is of merge type, leaves texts unnormalised, and has no piece with a mark inside; the
constructor raises otherwise. Null texts count as empty; an empty text has no ids and decodes to an empty text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from ledgerlens.llm.arrow import plain, slices, spread, words

MARK = "▁"
CHUNK = re.compile(f"{MARK}*[^{MARK}]*")


class PieceModel:
    """Vocabulary, automaton and merge priorities of a SentencePiece model file."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        special = [k for k in range(sp.get_piece_size()) if sp.is_control(k) or sp.is_unknown(k) or sp.is_byte(k)]
        plain_ids = sorted(set(range(sp.get_piece_size())).difference(special))
        self.pieces = {sp.id_to_piece(k): k for k in plain_ids if not sp.is_unused(k)}
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self._qualify()
        self.rank = {piece: -sp.get_score(k) for piece, k in self.pieces.items()}
        self.automaton = ahocorasick.Automaton()
        for piece in self.pieces:
            if len(piece) == 1 or self.merge(piece) == [piece]:  # others never come out of merging
                self.automaton.add_word(piece, piece)
        self.automaton.make_automaton()
        self._compatible: dict[tuple[str, str], bool] = {}

    def _qualify(self) -> None:
        sp = self.library
        if any(sp.is_unknown(b) for b in self.bytes):
            raise ValueError("the model has no byte pieces")
        if any(MARK in p.lstrip(MARK) for p in self.pieces):
            raise ValueError("a piece has white space inside")
        probe = "Ａ  ½ é\tx "
        if sp.decode(sp.encode(probe)) != probe:
            raise ValueError("the model normalises its input")
        merged = [p for p in self.pieces if len(p) > 1 and p.strip(MARK)]
        if len({sp.get_score(self.pieces[p]) for p in merged}) != len(merged):
            raise ValueError("merge priorities are not distinct")

    def merge(self, text: str) -> list[str]:
        """Plain merging of a short string: always the best pair, the leftmost of equals."""
        parts, rank = list(text), self.rank
        while True:
            best, at = None, 0
            for k in range(len(parts) - 1):
                found = rank.get(parts[k] + parts[k + 1])
                if found is not None and (best is None or found < best):
                    best, at = found, k
            if best is None:
                return parts
            parts[at: at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, left: str, right: str) -> bool:
        pair = (left, right)
        found = self._compatible.get(pair)
        if found is None:
            if len(self._compatible) > 1_000_000:
                self._compatible.clear()
            found = self._compatible[pair] = self.merge(left + right) == [left, right]
        return found

    def chunk(self, text: str) -> list[int]:
        """Ids of one chunk."""
        whole = self.pieces.get(text)
        if whole is not None and self.automaton.exists(text):
            return [whole]
        last: list[str | None] = [None] * (len(text) + 1)  # last piece of each prefix; None: a character outside
        ends: list[list[str]] = [[] for _ in text]
        for end, piece in self.automaton.iter(text):
            ends[end].append(piece)
        for end, candidates in enumerate(ends, 1):
            for piece in candidates:
                begin = end - len(piece)
                before = last[begin]
                if before is None:
                    if begin and text[begin - 1] in self.pieces:
                        raise AssertionError("a prefix without a last piece")
                    last[end] = piece
                    break
                if self.compatible(before, piece):
                    last[end] = piece
                    break
        ids: list[int] = []
        at = len(text)
        while at:
            piece = last[at]
            if piece is None:
                ids += [self.bytes[b] for b in reversed(text[at - 1].encode())]
                at -= 1
            else:
                ids.append(self.pieces[piece])
                at -= len(piece)
        return ids[::-1]


class ChunkIds(dict):
    """Ids of chunks as little-endian unsigned 32-bit bytes, each worked out once a worker process and kept until there
    are ``LIMIT`` of them: some 80 MB, which a worker holds beside what later stages need."""

    LIMIT = 400_000

    def __init__(self, model: PieceModel):
        super().__init__()
        self.model = model

    def __missing__(self, chunk: str) -> bytes:
        self[chunk] = found = np.array(self.model.chunk(chunk), dtype="<u4").tobytes()
        return found

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``ids, counts``: the ids of the texts one after the other, and how many each text has. The library puts a
        mark before a text and writes spaces as marks; single marks split a text into words, longer runs of them are
        looked at one text at a time."""
        if len(self) > self.LIMIT:
            self.clear()
        hard = pc.match_substring_regex(texts, f"^[ {MARK}]|[ {MARK}][ {MARK}]|{MARK}").to_numpy(zero_copy_only=False)
        hard = hard.astype(bool)
        easy = pc.if_else(pa.array(hard), pa.scalar(""), texts) if hard.any() else texts
        found = words(easy, lambda x: pc.split_pattern(x, " "), keep_empty=True)
        values = [self[MARK + w] for w in found.vocabulary]
        items, each = spread(found.codes, values, 4)
        counts = np.bincount(found.rows, weights=each, minlength=len(texts)).astype(np.int64)
        none = pc.equal(pc.binary_length(easy), 0).to_numpy(zero_copy_only=False).astype(bool)
        if not none.any():
            return items, counts
        runs = np.split(items, np.cumsum(counts)[:-1])
        for k in np.flatnonzero(none):  # an empty text splits into one empty word, which has no chunk here
            text = (MARK + texts[int(k)].as_py()).replace(" ", MARK) if hard[k] else ""
            chunks = [c for c in CHUNK.findall(text) if c]
            runs[k] = np.frombuffer(b"".join([self[c] for c in chunks]), dtype="<u4")
        return np.concatenate(runs), np.array([len(r) for r in runs], dtype=np.int64)


@lru_cache(maxsize=2)
def chunk_ids(path: str) -> ChunkIds:
    return ChunkIds(PieceModel(path))


def encode(text: str, path: str) -> list[int]:
    return chunk_ids(path).of(pa.array([text]))[0].tolist()


def encode_decode(docs: DataFrame, model: str, with_outputs: bool = True) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of each row and, if wanted, ``ids`` and ``decoded``.

    Rows with equal or null ``doc_id`` are all returned. Texts are taken whole.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = chunk_ids(model)
        decode = cache.model.library.decode
        names = np.array([str(k) for k in range(cache.model.library.get_piece_size())], dtype=object)
        for batch in slices(batches):
            items, counts = cache.of(batch.column("text"))
            ends = np.cumsum(counts)
            digests, texts, decoded_digests = [], [], []
            for begin, end in zip((ends - counts).tolist(), ends.tolist()):
                ids = items[begin:end]
                digests.append(hashlib.sha256(",".join(names[ids].tolist()).encode()).hexdigest())
                text = decode(ids.tolist())
                decoded_digests.append(hashlib.sha256(text.encode()).hexdigest())
                if with_outputs:
                    texts.append(text)
            columns = {"doc_id": batch.column("doc_id"), "n_tokens": pa.array(counts),
                       "ids_sha256": pa.array(digests), "decoded_sha256": pa.array(decoded_digests)}
            if with_outputs:
                columns["ids"] = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(items.astype(np.int32)))
                columns["decoded"] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return plain(docs).mapInArrow(run, schema + ", ids array<int>, decoded string" * with_outputs)
