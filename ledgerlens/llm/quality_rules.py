"""Quality rules with in-document repetition from suffix arrays.

Words are the symbols. Prefix doubling ranks the suffixes of each document by their first 1, 2, 4, ... words; only
suffixes that share their first ``min_repeat`` words with another one stay in play, so clean text drops out early. For
those the longest-common-prefix values of neighbours in suffix order give the intervals of maximal repeated substrings;
their spans are united. A document is rejected when the spans cover more than ``max_covered`` of its words or when one
repeated substring is longer than ``max_longest`` words, besides the base rules (too few words, too many words in
repeated three-word windows).

Null and empty texts have no words and fail the base rules. Rows with equal or null ``doc_id`` are judged one by one.
Documents are worked on whole; a task holds a slice of them (4 MB of text, or one longer document).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.arrow import slices
from ledgerlens.llm.arrow import words as split_words

SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    max_repeat_share: int = 50  # percent of words in three-word windows that occur twice or more
    min_repeat: int = 8  # words of the shortest repeated substring that counts
    max_covered: float = 0.5
    max_longest: int = 200  # words


def _pairs(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Ranks of pairs of ranks, in the order of the pairs."""
    return np.unique(first * (int(second.max(initial=0)) + 1) + second, return_inverse=True)[1].astype(np.int64)


def _ahead(ranks: np.ndarray, by: int) -> np.ndarray:
    out = np.zeros_like(ranks)
    out[: max(0, len(ranks) - by)] = ranks[by:]
    return out


def _repeated(ranks: np.ndarray) -> np.ndarray:
    return np.bincount(ranks)[ranks] > 1 if len(ranks) else np.zeros(0, dtype=bool)


def _covered(size: int, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Which of ``size`` places lie in one of the spans."""
    change = np.zeros(size + 1, dtype=np.int64)
    np.add.at(change, begins, 1)
    np.add.at(change, begins + lengths, -1)
    return np.cumsum(change)[:size] > 0


def repeated_spans(levels: list[tuple[int, np.ndarray]], min_repeat: int) -> tuple[np.ndarray, np.ndarray]:
    """``begins, lengths`` of the substrings of at least ``min_repeat`` symbols that a suffix shares with a neighbour
    in suffix order. ``levels`` has the ranks by the first 1, 2, 4, ... symbols as far as they are known; doubling
    goes on here until all suffixes differ. Symbols of different documents differ."""
    levels = list(levels)
    while _repeated(levels[-1][1]).any():
        size, ranks = levels[-1]
        levels.append((2 * size, _pairs(ranks, _ahead(ranks, size))))
    order = np.argsort(levels[-1][1], kind="stable")
    i, j = order[:-1].copy(), order[1:].copy()
    begins, others, shared = i.copy(), j.copy(), np.zeros(len(i), dtype=np.int64)
    last = len(order) - 1
    for size, ranks in reversed(levels):
        same = ranks[np.minimum(i, last)] == ranks[np.minimum(j, last)]
        same &= (i <= last) & (j <= last)
        shared[same] += size
        i[same] += size
        j[same] += size
    long = shared >= min_repeat
    return np.concatenate([begins[long], others[long]]), np.concatenate([shared[long], shared[long]])


def measure(texts: pa.Array, rules: Rules) -> dict[str, np.ndarray]:
    """All figures of some texts, as columns."""
    found = split_words(texts)
    counts = found.counts
    # One closing symbol a document, so that no window runs into the next one; words are told apart by document.
    words = np.zeros(len(found.codes) + len(texts), dtype=np.int64)
    words[np.arange(len(found.codes)) + found.rows] = found.codes + 1
    doc = np.repeat(np.arange(len(texts)), counts + 1)
    inside = words > 0
    ranks = {1: _pairs(doc, words)}
    ranks[2] = _pairs(ranks[1], _ahead(ranks[1], 1))
    ranks[3] = _pairs(ranks[2], _ahead(ranks[1], 2))
    thrice = np.flatnonzero(_repeated(ranks[3]))
    again = _covered(len(words), thrice, np.full(len(thrice), 3))
    size = 2
    while size < rules.min_repeat:
        ranks[2 * size] = _pairs(ranks[size], _ahead(ranks[size], size))
        size *= 2
    busy = np.isin(doc, np.unique(doc[_repeated(ranks[size])]))  # documents with a repeat of that length
    covered, longest = np.zeros(len(words), dtype=bool), np.zeros(len(texts), dtype=np.int64)
    if busy.any():
        levels = [(n, np.unique(r[busy], return_inverse=True)[1]) for n, r in ranks.items() if n != 3]
        begins, lengths = repeated_spans(levels, rules.min_repeat)
        covered[busy] = _covered(int(busy.sum()), begins, lengths)
        np.maximum.at(longest, doc[busy][begins], lengths)
    total = lambda flags: np.bincount(doc, weights=flags & inside, minlength=len(texts)).astype(np.int64)
    raw = texts.cast(pa.binary()).to_pylist()
    lines = [[x for x in t.split(b"\n") if x.strip()] for t in raw]
    letters = np.array([len(w) for w in found.vocabulary], dtype=np.int64)
    out = {
        "n_words": counts,
        "word_chars": np.bincount(found.rows, weights=letters[found.codes], minlength=len(texts)).astype(np.int64),
        "n_symbols": np.array([len(t) - len(t.translate(None, SYMBOLS)) for t in raw], dtype=np.int64),
        "n_dup_lines": np.array([len(x) - len(set(x)) for x in lines], dtype=np.int64),
        "n_repeat_words": total(again),
        "covered_words": total(covered),
        "longest_repeat": longest,
    }
    out["base_failed"] = (counts < rules.min_words) | (
        100 * out["n_repeat_words"] > rules.max_repeat_share * counts)
    fraction = out["covered_words"] / np.maximum(counts, 1)
    out["kept"] = ~out["base_failed"] & (fraction <= rules.max_covered) & (longest <= rules.max_longest)
    return out


FIGURES = {"n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long",
           "n_repeat_words": "long", "covered_words": "long", "longest_repeat": "long", "base_failed": "boolean",
           "kept": "boolean"}


def judge(docs: DataFrame, rules: Rules = Rules(), carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``carry`` columns of each row with its figures and verdict."""
    if rules.min_repeat < 2 or rules.min_repeat & (rules.min_repeat - 1):
        raise ValueError("min_repeat is a power of two")
    rows = docs.select(*carry, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_whole"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "_whole"),
                        *(f"{n} {k}" for n, k in FIGURES.items())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_whole"):
            found = measure(batch.column("_whole"), rules)
            kept = [batch.column(k) for k in range(len(carry))]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array(found[n]) for n in FIGURES)], [*carry, *FIGURES])

    return rows.mapInArrow(run, schema)


def keep_good(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows that pass, with the columns they came with. Those columns may have any names."""
    names = [f"_c{k}" for k in range(len(docs.columns))]
    text = names[docs.columns.index("text")]
    flat = docs.toDF(*names).withColumn("text", F.col(text))
    passed = judge(flat, rules, carry=tuple(names)).where("kept")
    return passed.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)])
