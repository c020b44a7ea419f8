"""Token ids and their compressed store against the libraries."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from cases import ODD
from ledgerlens.llm import pieces, token_store
from ledgerlens.session import shared_folder

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def noise(alphabet, count, length, seed=1):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(length))) for _ in range(count)]


def test_pieces_equal_the_library():
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = [t or "" for _, t in ODD] + noise("abcdefght  \néñ.,-0123€▁", 1500, 80) + [
        " " * k + w + " " * (k // 3) for k in range(70) for w in ("", "a", "the cat", " é")]
    items, counts = pieces.chunk_ids(PIECES).of(pa.array(texts))
    ours = [x.tolist() for x in np.split(items, np.cumsum(counts)[:-1])]
    assert ours == library.encode(texts)


def test_encode_decode_round_trip(odd, empty):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = pieces.encode_decode(odd, PIECES).collect()
    assert len(rows) == len(ODD)
    texts = sorted((t or "") for _, t in ODD)
    assert sorted(r["decoded"] for r in rows) == sorted(library.decode(library.encode(t)) for t in texts)
    for r in rows:
        assert r["ids"] == library.encode(r["decoded"]) or "▁" in r["decoded"]
        assert r["n_tokens"] == len(r["ids"])
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, r["ids"])).encode()).hexdigest()
    assert pieces.encode_decode(empty, PIECES).count() == 0


def test_other_models_are_refused(tmp_path):
    with pytest.raises(Exception):
        pieces.PieceModel(WORDS)


def test_word_tokens_equal_the_library():
    library = Tokenizer.from_file(WORDS)
    texts = [t or "" for _, t in ODD] + noise("abst'., !?1é\n²Ⅷ'’İΣ", 1500, 60)
    ours = token_store.chunk_tokens(WORDS).of(pa.array(texts)).to_pylist()
    assert [np.frombuffer(x, "<u4").tolist() for x in ours] == [
        library.encode(t, add_special_tokens=False).ids for t in texts]


def test_the_chunk_store_stays_small_and_keeps_what_comes_again(monkeypatch):
    library = Tokenizer.from_file(WORDS)
    store = token_store.ChunkTokens(library)
    monkeypatch.setattr(store, "LIMIT", 200, raising=False)
    learned = []
    learn = store._learn_words
    monkeypatch.setattr(store, "_learn_words", lambda words, *rest: (learned.extend(words), learn(words, *rest))[1])
    for k in range(12):
        rare = noise("abcdefghijklé\xa0", 150, 9, seed=k)
        texts = ["the cat, été naïve. ñandú 12! " + w for w in rare]
        found = store.of(pa.array(texts)).to_pylist()
        assert [np.frombuffer(x, "<u4").tolist() for x in found] == [
            library.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(store) + len(store._older) <= 2 * (200 + 170)
    assert learned.count("cat") == learned.count("naïve") == 1
    assert 2 * token_store.ChunkTokens.LIMIT <= 600_000  # entries of some 200 bytes, in each of a machine's workers


def test_a_word_is_kept_once_whatever_closes_it():
    library = Tokenizer.from_file(WORDS)
    store = token_store.ChunkTokens(library)
    texts = ["cat, cat. cat!", "", "?! cat", "ñandú. 12! ...", "cat,"]
    found = store.of(pa.array(texts), b"\2\0\0\0").to_pylist()
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == [
        library.encode(t, add_special_tokens=False).ids + [2] for t in texts]
    assert sorted(w for w in store if w) == sorted(["cat", ",", ".", "!", "?!", "ñandú", "12", "..."])


@pytest.mark.parametrize("sizes", [[], [0], [1], [64], [65, 0, 1000], [5000, 4097, 63, 64, 1]])
def test_blocks_decode_to_what_was_encoded(sizes):
    rng = np.random.default_rng(3)
    blocks = [rng.zipf(1.3, n).clip(max=900).astype(np.uint32) for n in sizes]
    counted = np.bincount(np.concatenate([*blocks, [0]]))
    symbols = np.flatnonzero(counted)
    table = token_store.Table.of(symbols, counted[symbols])
    coded = token_store.encode_blocks(blocks, table, 64, 7)
    found = token_store.decode_blocks([(*c, len(b)) for c, b in zip(coded, blocks)], table, 64, 7)
    assert all(np.array_equal(a, b) for a, b in zip(found, blocks))


def test_store_round_trip(spark, odd, empty):
    library = Tokenizer.from_file(WORDS)
    for docs, rows in ((odd, ODD), (empty, [])):
        root = shared_folder(spark, "store-test")
        token_store.token_ids(docs, WORDS, 2, width=2).write.parquet(f"{root}/ids")
        token_store.write(spark.read.parquet(f"{root}/ids"), f"{root}/store", block_tokens=500, width=2)
        found = token_store.read(spark, f"{root}/store").orderBy("start").collect()
        assert len(found) == len(rows)
        numbers = [r["doc_id"] for r in found]
        assert numbers == sorted(numbers, key=lambda x: (x is not None, x))
        start = 0
        texts = {}
        for number, text in rows:
            texts.setdefault(number, []).append(library.encode(text or "", add_special_tokens=False).ids + [2])
        for r in found:
            ids = np.frombuffer(r["ids"], "<u4").tolist()
            assert ids in texts[r["doc_id"]] and r["start"] == start and r["n_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(r["ids"])
            start += len(ids)


def test_damage_is_noticed():
    table = token_store.Table.of(np.array([1, 2]), np.array([3, 5]))
    tokens = np.array([1, 2, 2, 1, 2], dtype=np.uint32)
    coded = token_store.encode_blocks([tokens], table, 4, 2)[0]
    block = token_store.pack([7], np.array([5]), tokens, coded, table.check, 4, 2)
    assert token_store.unpack(block, table.check)[1].tolist() == [7]
    with pytest.raises(ValueError):
        token_store.unpack(block[:-1] + bytes([block[-1] ^ 1]), table.check)
    with pytest.raises(ValueError):
        token_store.unpack(block, table.check ^ 1)
