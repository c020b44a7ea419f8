"""The stages one after the other, and each one's effect."""

from __future__ import annotations

import random

import pytest
import sentencepiece
import public_tokenizers

import __spark_entry__ as entry_point
import corpus_pipeline
from ledgerlens.llm import queries


@pytest.fixture(scope="module")
def corpus(tmp_path_factory, spark, make):
    rnd = random.Random(1)
    text = lambda n: " ".join(f"{rnd.choice('abcdefgh')}{rnd.randrange(10 ** 6)}" for _ in range(n))
    item, base = text(30), text(200)
    rows = {1: base, 2: base + " end", 3: text(200), 4: f"{text(60)} {item} {text(60)}", 5: "too short",
            6: f"{text(90)} password=q7Rt9ZkLm3X {text(30)}", 7: None, 8: " ".join(["again and"] * 80)}
    folder = str(tmp_path_factory.mktemp("corpus"))
    make(list(rows.items())).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item), (2, text(20))], "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet")
    return folder, rows


def test_stages_take_effect(spark, corpus):
    folder, rows = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept, seen = docs, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, folder)
        assert kept.columns == docs.columns
        seen.append({r["doc_id"] for r in kept.collect()})
    assert seen == [{1, 2, 3, 4, 6}, {1, 3, 4, 6}, {1, 3, 6}, {1, 3, 6}]
    masked = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert "q7Rt9ZkLm3X" not in masked[6] and "[SECRET]" in masked[6] and masked[3] == rows[3]
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    result = {r["doc_id"]: r["n_tokens"] for r in corpus_pipeline.run(spark, folder).collect()}
    assert result == {k: len(library.encode(t)) for k, t in masked.items()}


def test_queries_are_registered(folder):
    names = set(entry_point.queries())
    assert set(queries.QUERIES) | {"pipeline"} <= names
    assert {q.split("_")[0] for q in queries.QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_equals_sql(spark, folder, name):
    from compare import connect, difference

    assert difference(queries.QUERIES[name](spark, folder), connect(folder), queries.ORACLE_SQL[name]) is None


def test_extra_columns_with_clashing_names_change_nothing(spark, make, clashing):
    """Operators whose other tests do not cover them: the results are those of the rows without the extra columns."""
    from pyspark.sql import functions as F

    from ledgerlens.llm import language, markov_model, pieces, token_store
    from ledgerlens.session import shared_folder

    plain = clashing.select("doc_id", "text", "lang", "source", "n_chars")
    rows = lambda df: sorted(map(str, df.collect()))
    model, words = (public_tokenizers.path(f) for f in ("piece_bpe_32k.model", "word_bpe_49k.json"))

    def stored(docs):
        root = shared_folder(spark, "store")
        token_store.token_ids(docs, words, end_id=2, width=2).write.parquet(f"{root}/ids")
        token_store.write(spark.read.parquet(f"{root}/ids"), f"{root}/store", width=2)
        return token_store.read(spark, f"{root}/store", with_ids=False)

    settings = markov_model.Settings(states=2, heads=8, tails=4, iterations=2)
    for run in (lambda d: pieces.encode_decode(d, model), stored,
                lambda d: markov_model.fit_and_score(d, F.col("doc_id") == 2, shared_folder(spark, "hmm"), settings),
                lambda d: language.predict(d, language.fit(d.where("doc_id < 3").select("text", "lang"))).select(
                    "doc_id", "lang_pred")):
        assert rows(run(clashing)) == rows(run(plain))
