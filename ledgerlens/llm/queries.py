"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import (alignment, decontaminate, language, manifest, markov_model, near_duplicates, near_vectors, pieces, quality_rules,
                            secret_scan, suffix_dedup, surrogates, token_store)
from ledgerlens.llm.arrow import small_batches
from ledgerlens.session import configure, shared_folder

SURROGATE_KEY = "surrogates-1"


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    # Python workers import this package; from a checkout they need its path. A cluster installs it.
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    return small_batches(configure(spark)).read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def remainder(divisor: int) -> Column:
    """The documents' fold: CRC-32 of the number as text."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    root = shared_folder(spark, "suffix-dedup")
    return suffix_dedup.deduplicate(documents(spark, folder), root, with_text=False)


def op2_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.encode_decode(documents(spark, folder), model, with_outputs=False)


def op3_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.group(documents(spark, folder))


def op4_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    shared_folder(spark, "surrogates")  # sets the checkpoint folder
    return surrogates.replace(docs, SURROGATE_KEY)


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leaks(spark, documents(spark, folder), table(spark, folder, "benchmark"))


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judge(documents(spark, folder))


def op7_token_store(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    root = shared_folder(spark, "token-store")
    ids = token_store.token_ids(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, width=2)
    ids.write.option("compression", "zstd").parquet(f"{root}/ids")
    token_store.write(spark.read.parquet(f"{root}/ids"), f"{root}/store", width=2)
    return token_store.read(spark, f"{root}/store", with_ids=False)


def op8_markov_model(spark: SparkSession, folder: str) -> DataFrame:
    root = shared_folder(spark, "markov-model")
    return markov_model.fit_and_score(documents(spark, folder), remainder(7) == 2, root)


def op9_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.scan(documents(spark, folder))


def op10_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    fitted = language.fit(docs.where(remainder(5) != 0).select("text", "lang"))
    predicted = language.predict(docs, fitted)
    return predicted.select("doc_id", (remainder(5) == 0).alias("held_out"), "lang_pred", "score", "accepted")


def tampered_fields() -> list[Column]:
    """The fields of a document, with one added to ``n_chars`` where 7 divides the CRC-32 of the number as text."""
    length = F.col("n_chars").cast("decimal(20,0)")
    return [F.when(remainder(7) == 0, length + 1).otherwise(length) if c == "n_chars" else F.col(c)
            for c in manifest.FIELDS]


def op11_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return manifest.manifest(spark, docs, shared_folder(spark, "manifest"), claimed=tampered_fields())


def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return alignment.score(spark, docs, public_tokenizers.path("byte_bpe_50k.json"),
                           public_tokenizers.path("piece_bpe_32k.model"), shared_folder(spark, "alignment"))


def op13_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return near_vectors.group(spark, vectors, shared_folder(spark, "near-vectors"))


QUERIES = {f.__name__: f for f in (
    op1_suffix_dedup, op2_sentencepiece, op3_near_duplicates, op4_surrogates, op5_decontamination, op6_quality_rules, op7_token_store,
    op8_markov_model, op9_secret_scan, op10_language, op11_manifest, op12_alignment, op13_near_vectors)}

MANIFEST_SQL = """
WITH RECURSIVE
crc_table AS (SELECT list_transform(range(256), lambda c: list_reduce(list_prepend(c, range(8)),
    lambda a, i: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t),
rows_ AS (SELECT doc_id, lang, source, n_chars, text,
    n_chars + CASE WHEN n_chars IS NOT NULL AND xor(list_reduce(list_prepend(4294967295::BIGINT,
        list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
        lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 7 = 0 THEN 1 ELSE 0 END AS claimed
    FROM documents, crc_table),
parts AS (SELECT doc_id, lang, n_chars, claimed,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
        || coalesce(strlen(lang) || ':' || lang, '-') AS front,
    coalesce(strlen(text) || ':' || text, '-') AS back FROM rows_),
leaves AS (SELECT doc_id, lang, sha256(front || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || back) AS leaf,
    sha256(front || coalesce(strlen(claimed::VARCHAR) || ':' || claimed, '-') || back) AS claim FROM parts),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves),
nodes AS (
    SELECT 0 AS level, lang, place, leaf AS d, count(*) OVER (PARTITION BY lang) AS n FROM placed
    UNION ALL
    SELECT any_value(level) + 1, lang, place // 2, sha256(string_agg(d, '' ORDER BY place)),
        any_value((n + 1) // 2) FROM nodes WHERE n > 1 GROUP BY lang, place // 2),
subroots AS (SELECT lang, d, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS tree FROM nodes WHERE n = 1),
crown AS (
    SELECT 0 AS level, tree AS place, d, count(*) OVER () AS n FROM subroots
    UNION ALL
    SELECT any_value(level) + 1, place // 2, sha256(string_agg(d, '' ORDER BY place)), any_value((n + 1) // 2)
    FROM crown WHERE n > 1 GROUP BY place // 2),
steps AS (
    SELECT p.lang, p.place, a.level, a.place % 2 AS side, b.d FROM placed p
    JOIN nodes a ON a.lang IS NOT DISTINCT FROM p.lang AND a.n > 1 AND a.place = p.place >> a.level
    LEFT JOIN nodes b ON b.lang IS NOT DISTINCT FROM p.lang AND b.level = a.level AND b.place = xor(a.place, 1)
    UNION ALL
    SELECT p.lang, p.place, 1000 + a.level, a.place % 2, b.d FROM placed p
    JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang
    JOIN crown a ON a.n > 1 AND a.place = s.tree >> a.level
    LEFT JOIN crown b ON b.level = a.level AND b.place = xor(a.place, 1)),
proofs AS (SELECT lang, place, sha256(coalesce(string_agg(d, '' ORDER BY level), '')) AS proof_sha256,
    list((CASE WHEN d IS NULL THEN '-' WHEN side = 1 THEN 'L' ELSE 'R' END) || coalesce(d, '') ORDER BY level) AS path
    FROM steps GROUP BY lang, place),
folded AS (SELECT p.doc_id, p.leaf, s.d AS subroot, (SELECT d FROM crown WHERE n = 1) AS root,
    coalesce(q.proof_sha256, sha256('')) AS proof_sha256,
    list_reduce(list_prepend(p.claim, coalesce(q.path, []::VARCHAR[])), lambda a, x: sha256(
        CASE x[1] WHEN 'L' THEN x[2:] || a WHEN 'R' THEN a || x[2:] ELSE a END)) AS folded_root
    FROM placed p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang
    LEFT JOIN proofs q ON q.lang IS NOT DISTINCT FROM p.lang AND q.place = p.place)
SELECT *, folded_root = root AS verified FROM folded
"""

NEAR_VECTORS_SQL = """
WITH RECURSIVE
vectors AS (SELECT vec_id, row_number() OVER () AS r, CASE WHEN len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0 THEN embedding::DOUBLE[] END AS e FROM embeddings),
links AS (SELECT a.r AS u, b.r AS v FROM vectors a JOIN vectors b ON a.r <> b.r AND len(a.e) = len(b.e)
    AND CASE WHEN len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) ELSE 0 END >= 0.9),
reached AS (SELECT r AS u, r AS v FROM vectors UNION SELECT reached.u, links.v FROM reached JOIN links ON links.u = reached.v),
component AS (SELECT reached.u, min(vectors.vec_id) AS component_id FROM reached JOIN vectors ON vectors.r = reached.v GROUP BY reached.u),
degree AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, coalesce(vec_id = component_id, false) AS kept
FROM vectors JOIN component ON component.u = r LEFT JOIN degree ON degree.u = r
"""

ORACLE_SQL: dict[str, str] = {"op11_manifest": MANIFEST_SQL, "op13_near_vectors": NEAR_VECTORS_SQL}
