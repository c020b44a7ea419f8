"""Credentials in texts, told from copied examples by who owns them across the corpus. DataFrame functions only.

Base spans (assignments, access keys, long hexadecimal runs) are always reported. Further candidates are long tokens
that mix letters and digits in a way words do not; each is hashed, and the hashes are counted over distinct owners and
distinct repositories. A candidate that many owners hold (``example_owners``), or that many repositories hold even if
few owners do (``example_repositories``: a template that one large owner repeats), is a copied example and is left out;
one that few hold is taken for live and its span is added. ``report`` gives the ownership figures of every value.

The owner is the column ``source``; the repository is the document, which is the unit this table has. A null owner
counts as an owner of its own. Null and empty texts have no spans. Values are handled as hashes after extraction, and
counts are summed per (hash, owner) before they are summed per hash, so a value that a third of all rows hold moves as
a few rows. Rows with equal or null ``doc_id`` are kept apart by their text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.spans import found, gaps, starts

# Patterns of the base kinds, in their order, with the least length of a match (or of its value).
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
KINDS = {"assign": 0, "access": 1, "hex": 2, "generic": 3}
LEAST = {"assign": 6, "access": 20, "hex": 24}

# Added kind: a token of 20 or more characters with a digit and a letter of each case.
GENERIC = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z0-9+/_=-]*[0-9])(?=[A-Za-z0-9+/_=-]*[a-z])(?=[A-Za-z0-9+/_=-]*[A-Z])" \
          r"[A-Za-z0-9+/_=-]{20,}"

SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"


def _spans(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """Spans of one kind; the pattern is only tried in full where it occurs."""
    matches = found(text, pattern)
    places = starts(gaps(text, pattern), matches)
    zipped = F.arrays_zip(places.alias("at"), matches.alias("whole"), found(text, pattern, group).alias("value"))
    spans = F.transform(
        F.filter(zipped, lambda x: F.length(x["value"]) >= least),
        lambda x: F.struct(x["at"].alias("start"), F.lit(KINDS[kind]).alias("kind"),
                           (x["at"] + F.length(x["whole"])).alias("end"), x["value"].alias("value")))
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(SPAN)).cast(SPAN)


def _hash(value: Column) -> Column:
    return F.sha2(value, 256)


def _named(spans: Column) -> Column:
    name = lambda k: F.element_at(F.array(*[F.lit(n) for n in KINDS]), k + 1)
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["end"])))
    return F.concat_ws(",", F.transform(
        ordered, lambda s: F.concat_ws(":", name(s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))


def candidates(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_base`` and ``_more``: spans of the base kinds and of the added kind."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = F.concat(*[_spans(text, k, p, g, LEAST[k]) for k, p, g in (
        ("assign", ASSIGN, 2), ("access", ACCESS, 0), ("hex", HEX, 0))])
    more = _spans(text, "generic", GENERIC, 0, 20)
    # the added kind does not report what a base span already covers
    apart = F.filter(F.col("_all_more"), lambda m: ~F.exists(
        F.col("_base"), lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))
    return docs.withColumns({"_base": base, "_all_more": more}).withColumn("_more", apart).drop("_all_more")


def ownership(values: DataFrame) -> DataFrame:
    """``value_hash, owners, repositories`` from rows of ``value_hash, owner, repository``: distinct counts of both.
    Repositories belong to an owner, so they are counted per owner and summed."""
    per_owner = (values.groupBy("value_hash", "owner", "repository").agg(F.lit(1).alias("one"))
                 .groupBy("value_hash", "owner").agg(F.sum("one").alias("repositories")))
    return per_owner.groupBy("value_hash").agg(
        F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories"))


# A value is a copied example from so many distinct owners, or so many distinct repositories, on.
EXAMPLE_OWNERS, EXAMPLE_REPOSITORIES = 3, 25


def is_copied(owners: int, repositories: int) -> Column:
    return (F.col("owners") >= owners) | (F.col("repositories") >= repositories)


def _values(rows: DataFrame, spans: Column) -> DataFrame:
    return rows.select(F.col("source").cast("string").alias("owner"), F.col("doc_id").alias("repository"),
                       F.explode(spans).alias("s")).select(
        _hash(F.col("s.value")).alias("value_hash"), "owner", "repository")


def report(docs: DataFrame, example_owners: int = EXAMPLE_OWNERS,
           example_repositories: int = EXAMPLE_REPOSITORIES) -> DataFrame:
    """Every value's hash with its distinct owners and repositories and whether it is a copied example."""
    rows = candidates(docs.select("doc_id", "source", "text"))
    return ownership(_values(rows, F.concat("_base", "_more"))).withColumn(
        "copied_example", is_copied(example_owners, example_repositories))


def scan(docs: DataFrame, example_owners: int = EXAMPLE_OWNERS,
         example_repositories: int = EXAMPLE_REPOSITORIES) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_added`` of each row."""
    rows = candidates(docs.select("doc_id", "source", "text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("_text"), "source", "_base", "_more")
    count = lambda kind: F.size(F.filter("_base", lambda s: s["kind"] == KINDS[kind])).cast("long")
    # Only rows with an added candidate need the corpus counts; they leave, learn which are copied, and come back.
    exploded = rows.where(F.size("_more") > 0).select("doc_id", "_text", "source", F.explode("_more").alias("s"))
    values = exploded.select(_hash(F.col("s.value")).alias("value_hash"), F.col("source").cast("string").alias("owner"),
                             F.col("doc_id").alias("repository"), "doc_id", "_text", "s")
    rare = ownership(values).where(~is_copied(example_owners, example_repositories)).select("value_hash")
    live = values.join(rare, "value_hash", "left_semi").groupBy("doc_id", "_text").agg(
        F.array_distinct(F.collect_list("s")).alias("_added"))
    live = live.select(F.col("doc_id").alias("_id"), F.col("_text").alias("_key"), "_added")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("_text").eqNullSafe(F.col("_key"))
    joined = rows.join(live, same, "left")
    added = F.coalesce(F.col("_added"), F.array().cast(SPAN)).cast(SPAN)
    return joined.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(_named(F.col("_base")), 256).alias("base_sha256"),
        _named(F.concat("_base", added)).alias("spans"), F.size(added).cast("long").alias("n_added"))


def without_secrets(docs: DataFrame, example_owners: int = EXAMPLE_OWNERS, mask: str = "[SECRET]",
                    example_repositories: int = EXAMPLE_REPOSITORIES) -> DataFrame:
    """The rows with every value that few owners and few repositories hold replaced by ``mask``; copied examples
    stay. All columns stay; a text without secrets is not touched."""
    names = docs.columns
    own = [f"_c{k}" for k in range(len(names))]  # the columns under names that cannot clash
    at = lambda name: F.col(own[names.index(name)]).alias(name)
    rows = docs.toDF(*own).select(*own, at("doc_id"), at("source"), at("text"))
    rows = candidates(rows).withColumn("_key", F.xxhash64("text"))
    spans = F.concat("_base", "_more")
    values = rows.where(F.size(spans) > 0).select(
        F.col("doc_id").alias("repository"), F.col("source").cast("string").alias("owner"), "_key",
        F.explode(F.array_distinct(F.transform(spans, lambda s: s["value"]))).alias("value"))
    values = values.withColumn("value_hash", _hash(F.col("value")))
    rare = ownership(values).where(~is_copied(example_owners, example_repositories)).select("value_hash")
    live = values.join(rare, "value_hash", "left_semi").groupBy("repository", "_key").agg(
        F.collect_set("value").alias("_live")).withColumnRenamed("_key", "_text_key")
    same = F.col("doc_id").eqNullSafe(F.col("repository")) & F.col("_key").eqNullSafe(F.col("_text_key"))
    joined = rows.join(live, same, "left")
    hide = F.aggregate(F.array_sort("_live", lambda a, b: F.length(b) - F.length(a)), F.col("text"),
                       lambda text, value: F.replace(text, value, F.lit(mask)))
    masked = F.when(F.col("_live").isNull(), F.col("text")).otherwise(hide)
    return joined.withColumn("_masked", masked).select(
        *[(F.col("_masked") if n == "text" else F.col(c)).alias(n) for n, c in zip(names, own)])
