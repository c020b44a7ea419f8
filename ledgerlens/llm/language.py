"""Language identification by compression with per-language dictionaries.

Each language gets a raw-content dictionary of lower-cased sample text. A text belongs to the language whose dictionary
lets zstandard write it in the fewest bytes. Only letters are looked at, lower-cased, with single spaces between
words. A fast level decides; where its margin is narrow, a thorough level decides instead. ``score`` is the saving of the best over the second best, as a share of
the second best, and ``accepted`` is false where that margin is narrow.

The model is fitted on a bounded sample: of each language the distinct texts with the smallest hashes, until there are
``texts_per_language`` texts or ``bytes_per_language`` bytes of letters; a language with less is taken whole. Copies
count once, and a longer text is cut. Languages are labels, at most ``max_languages`` of them; more raise.
Texts are predicted whole. A null text, or one without a letter, is ``und`` with score 0. Without any labelled text all
are ``und``. Ties go to the language first in the alphabet, with score 0.
"""

from __future__ import annotations

import re
from bisect import insort
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.arrow import slices

UNDETERMINED = "und"
LETTER = re.compile(r"[^\W\d_]")


SAMPLE = "lang string, place long, text binary"


def fit(labelled: DataFrame, bytes_per_language: int = 96 << 10, texts_per_language: int = 400,
        max_languages: int = 500, salts: int = 64) -> dict[str, bytes]:
    """Dictionaries by language, from the columns ``text`` and ``lang``. Rows with a null in either are left out."""
    rows = labelled.select(F.col("lang").cast("string").alias("lang"), F.xxhash64(F.col("text").cast("string")).alias(
        "place"), F.col("text").cast("string").alias("text"))
    rows = rows.where("lang is not null and text is not null and length(trim(text)) > 0")
    found = rows.select("lang").distinct().limit(max_languages + 1).collect()
    if len(found) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    if not found:
        return {}
    bounds = (bytes_per_language, texts_per_language)
    # What a sample keeps, every sample of a part keeps too: tasks first, then salts (copies meet there), then languages.
    parts = rows.mapInArrow(_sampler(*bounds, raw=True), SAMPLE)
    parts = parts.repartition("lang", F.pmod("place", F.lit(salts))).mapInArrow(_sampler(*bounds), SAMPLE)
    chosen = parts.repartition("lang").mapInArrow(_sampler(*bounds), SAMPLE).collect()
    texts: dict[str, list[bytes]] = {}
    for r in sorted(chosen, key=lambda r: (r["lang"], r["place"])):
        texts.setdefault(r["lang"], []).append(bytes(r["text"]))
    return {lang: b"\n".join(parts)[:bytes_per_language] for lang, parts in texts.items()}


class Smallest:
    """The distinct texts of one language with the smallest hashes, until there are enough texts or bytes."""

    def __init__(self, most_bytes: int, most_texts: int):
        self.most_bytes, self.most_texts = most_bytes, most_texts
        self.kept: dict[int, bytes] = {}
        self.order: list[int] = []
        self.end: int | None = None  # the greatest hash kept, once there are enough

    def add(self, place: int, text: bytes) -> None:
        if place in self.kept or (self.end is not None and place > self.end):
            return
        self.kept[place] = text
        insort(self.order, place)
        size = 0
        for n, p in enumerate(self.order, 1):
            size += len(self.kept[p]) + 1
            if n >= self.most_texts or size > self.most_bytes:
                for over in self.order[n:]:
                    del self.kept[over]
                del self.order[n:]
                self.end = p
                break


def _sampler(most_bytes: int, most_texts: int, raw: bool = False):
    """A function for ``mapInArrow`` that keeps the sample of each language of a task. ``raw`` texts are reduced to
    their letters first; those without any are left out."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        samples: dict[str, Smallest] = {}
        for batch in batches:
            texts = batch.column("text")
            langs, places = batch.column("lang").to_pylist(), batch.column("place").to_pylist()
            for k, (lang, place) in enumerate(zip(langs, places)):
                sample = samples.get(lang)
                if sample is None:
                    sample = samples[lang] = Smallest(most_bytes, most_texts)
                if place in sample.kept or (sample.end is not None and place > sample.end):
                    continue
                if raw:
                    letters = letters_only(texts.slice(k, 1))[0]
                    if not LETTER.search(letters):
                        continue
                    text = letters.encode()[:most_bytes]
                else:
                    text = texts[k].as_py()
                sample.add(place, text)
        for lang, sample in samples.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(sample.order), pa.string()), pa.array(sample.order, pa.int64()),
                 pa.array([sample.kept[p] for p in sample.order], pa.binary())], ["lang", "place", "text"])

    return run


@lru_cache(maxsize=4)
def _compressors(dictionaries: tuple[tuple[str, bytes], ...], level: int) -> list[tuple[str, object]]:
    import zstandard

    out = []
    for lang, content in dictionaries:
        made = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        made.precompute_compress(level=level)
        out.append((lang, zstandard.ZstdCompressor(level=level, dict_data=made, write_content_size=False)))
    return out


def letters_only(texts: pa.Array) -> list[str | None]:
    """Lower-cased letters with one space for what stands between them."""
    return pc.replace_substring_regex(pc.utf8_lower(texts), r"[^\pL\pM]+", " ").to_pylist()


def classify(raw: bytes, compressors: list[tuple[str, object]]) -> tuple[str, float]:
    """The language that writes ``raw`` shortest and its saving over the second."""
    sizes = sorted((len(c.compress(raw)), lang) for lang, c in compressors)
    return sizes[0][1], (sizes[1][0] - sizes[0][0]) / sizes[1][0] if len(sizes) > 1 else 1.0


def predict(docs: DataFrame, dictionaries: dict[str, bytes], margin: float = 0.02, levels: tuple[int, int] = (3, 12),
            look_again: float = 0.05, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, lang_pred, score, accepted`` of each row; nothing but the text decides. Texts with a margin below
    ``look_again`` at the first level are compressed anew at the second."""
    shared = tuple(sorted(dictionaries.items()))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fast, thorough = _compressors(shared, levels[0]), _compressors(shared, levels[1])
        for batch in slices(batches):
            out: list[list] = [[], [], []]
            for value in letters_only(batch.column("text")):
                best, score = UNDETERMINED, 0.0
                if value is not None and fast and LETTER.search(value):
                    raw = value.encode()
                    best, score = classify(raw, fast)
                    if score < look_again:
                        best, score = classify(raw, thorough)
                for column, x in zip(out, (best, score, best != UNDETERMINED and score >= margin)):
                    column.append(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(out, (
                    pa.string(), pa.float64(), pa.bool_())))], ["doc_id", "lang_pred", "score", "accepted"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, accepted boolean")
