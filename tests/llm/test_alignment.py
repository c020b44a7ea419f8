"""Alignment of the two tokenizers against cuts by decoded bytes alone."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict
from itertools import accumulate

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from cases import ODD
from ledgerlens.llm import alignment
from ledgerlens.session import shared_folder

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain():
    """Groups of a text by the bytes of its tokens; none where they do not give it back."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    letters = alignment.byte_alphabet()
    of_a = lambda k: bytes(letters[c] for c in a.id_to_token(k))
    of_b = lambda k: bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k) else (
        b.id_to_piece(k).replace("▁", " ").encode())

    def groups(text):
        if not text:
            return []
        data = (" " + text).encode()
        sides = [(k, of_a(k)) for k in a.encode(" " + text, add_special_tokens=False).ids], [
            (k, of_b(k)) for k in b.encode(text)]
        if any(b"".join(x for _, x in side) != data for side in sides):
            return []
        ends = [list(accumulate(len(x) for _, x in side)) for side in sides]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        found, last = [], 0
        for cut in cuts:
            found.append(tuple([k for (k, _), e in zip(side, end) if last < e <= cut] for side, end in zip(sides, ends)))
            last = cut
        return found

    return groups


def written(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


ALPHABET = "abcde   \n\t.,'é日本語テ😀🧿𐍈▀ 　\xa0\x0b\x1c\x85x12"


def texts_of(count, seed=1):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randrange(40))) for _ in range(count)] + [
        t or "" for _, t in ODD if len(t or "") < 1000] + [" ", "  ", "a ", " a", "\n", "\n ", "a \n b", "𐍈𐍈𐍈 🧿", "▁x y", "🧿🧿" * 40]


@pytest.mark.parametrize("by_chunk", [True, False])
def test_groups_equal_cuts_by_bytes(plain, by_chunk):
    found = alignment.Aligner(A, B)
    assert found.by_chunk
    found.by_chunk = by_chunk
    texts = texts_of(4000 if by_chunk else 1000)
    for _ in range(2):  # the second time from what is kept
        sizes, groups, *_ = found.of(pa.array(texts))
        for text, size, group in zip(texts, sizes.tolist(), groups):
            expected = plain(text)
            assert group == written(expected), text
            assert size == [sum(len(a) for a, _ in expected), sum(len(b) for _, b in expected), len(expected),
                            sum(len(a) * len(b) for a, b in expected)]


def test_chunks_that_come_again_stay(monkeypatch):
    """A full store of chunks is not emptied: what came again is not aligned anew."""
    found, asked = alignment.Aligner(A, B), []
    found.LIMIT = 80
    real = found._learn_run
    monkeypatch.setattr(found, "_learn_run", lambda chunks: (asked.append(chunks), real(chunks)))
    common = [f"word{k}" for k in range(10)]
    results = [found.of(pa.array([" ".join(common + [f"rare{k}x{n}" for n in range(25)])]))[1] for k in range(6)]
    learned = [c for run in asked for c in run]
    assert all(learned.count(f" {w}") == 1 for w in common) and learned.count(" rare5x0") == 1
    assert len(found) < 100 and all(len(r[0].split(";")) >= 35 for r in results)


def test_disagreeing_offsets_are_recut_by_bytes(plain, monkeypatch):
    found = alignment.Aligner(A, B)
    real = found._pieces
    monkeypatch.setattr(found, "_pieces", lambda text: [(k, 0, end + 1) for k, _, end in real(text)])
    for text in ("a few words", "日本 🧿"):
        assert found.groups(" " + text) == [(list(a), list(b)) for a, b in plain(text)]


@pytest.mark.parametrize("frequent", [0, 50, 1 << 18])
def test_scores_equal_counts(spark, make, plain, frequent):
    rnd = random.Random(3)
    lines = [" ".join(rnd.choice("the The cat cats Été don't 日本 🧿 x1y2 unhappily".split()) for _ in range(rnd.randrange(30)))
             for _ in range(60)] + [None, "", "▁ no", "the " * 500]
    rows = [(k % 50 or None, t) for k, t in enumerate(lines)]
    groups = [plain(t or "") for _, t in rows]
    linked = [Counter((a, b) for x, y in g for a in x for b in y) for g in groups]
    count = Counter(p for own in linked for p in own)
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    expected = sorted((str(r[0]), sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), own.total(),
                       sum(n for p, n in own.items() if count[p] == best[p[0]]),
                       sum(n * count[p] for p, n in own.items()),
                       hashlib.sha256(written(g).encode()).hexdigest() if g else "", written(g))
                      for r, g, own in zip(rows, groups, linked))
    found = alignment.score(spark, make(rows), A, B, shared_folder(spark, "alignment"), frequent, with_groups=True)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]
    assert sorted((str(r[0]), *r[1:]) for r in found.collect()) == expected


def test_odd_empty_and_clashing(spark, odd, empty, clashing):
    score = lambda docs: alignment.score(spark, docs, A, B, shared_folder(spark, "alignment")).collect()
    assert len(score(odd)) == len(ODD)
    assert score(empty) == []
    assert {r["doc_id"]: r["n_links"] > 0 for r in score(clashing)} == {1: True, 2: True, 3: False}
