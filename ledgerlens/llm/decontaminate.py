"""Benchmark passages in documents, found by latent semantic retrieval and checked word by word.

1. ``occurrences``: each document becomes the places of the words that the benchmark uses (one pass over the texts).
2. ``statistics``: in how many passages of ``passage`` words each of these words occurs, over the whole corpus.
3. ``latent_space``: a randomised singular value decomposition of the TF-IDF passages, of a fixed rank. One pass gives
   the rows of ``Aᵀ(A Ω)``, one a word, summed by word; a Nyström step gives the right singular vectors. The benchmark
   items are passages of their own, weighted so that the space holds them.
4. ``search``: windows of about an item's length are compared with the items by cosine in that space, but for those
   that the checks below could not confirm for want of words. Of each candidate
   the longest common subsequence of words with the item is computed in the window and its surroundings; it must reach
   ``min_lcs`` of the item's words. The answer must be there as well: the words of the item's ``answer`` if the
   benchmark has that column, else its rarest words, of which ``min_answer`` must be matched.

Words are lower-cased (ASCII) and stripped of punctuation at their ends. The benchmark is the query set: its words and
items go to every task, in blocks of at most ``block`` items and ``max_words`` distinct words; a single item with more
words raises. Null and empty texts match nothing; items without words are left out. Rows with equal or null ``doc_id`` are judged apart,
by a row number given when the places are written.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.arrow import binaries, slices, words
from ledgerlens.session import shared_folder

EDGES = ".,;:!?\"'()[]{}#*$%&|<>«»¿¡"


@dataclass(frozen=True)
class Settings:
    passage: int = 64
    common: float = 0.005  # words in more passages than this share do not steer retrieval
    rarest: int = 8  # words of an item that steer retrieval however common they are
    rank: int = 128  # dimensions of the latent space
    item_weight: float = 10.0  # of the items beside the corpus, in norm
    min_cosine: float = 0.4
    min_lcs: float = 0.7
    answer_words: int = 4
    min_answer: float = 0.5
    block: int = 400
    max_words: int = 200_000


@dataclass(frozen=True)
class Item:
    item_id: int
    words: np.ndarray  # codes in order
    answer: np.ndarray  # codes, empty if the benchmark names none
    window: int  # power of two that is at least its length


def normal(word: str) -> str:
    return word.strip(EDGES)


def _tokens(text: str | None) -> list[str]:
    lists = words(pc.ascii_lower(pa.array([text or ""])))
    return [w for w in (normal(lists.vocabulary[c]) for c in lists.codes) if w]


def benchmark_items(benchmark: DataFrame, settings: Settings) -> Iterator[tuple[dict[str, int], list[Item]]]:
    """Blocks of items with the codes of their words. The benchmark is small by nature; blocks bound what moves."""
    answer = F.col("answer") if "answer" in benchmark.columns else F.lit(None)
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"),
                            answer.cast("string").alias("answer")).orderBy("item_id", "text").toLocalIterator()
    vocabulary: dict[str, int] = {}
    items: list[Item] = []
    for row in rows:
        tokens = _tokens(row["text"])
        if not tokens:
            continue
        answer_tokens = _tokens(row["answer"])
        own = {*tokens, *answer_tokens}
        if len(own) > settings.max_words:
            raise ValueError("an item of the benchmark has too many distinct words")
        if items and len(vocabulary) + len(own - vocabulary.keys()) > settings.max_words:
            yield vocabulary, items
            vocabulary, items = {}, []
        codes = [vocabulary.setdefault(w, len(vocabulary)) for w in tokens]
        wanted = [vocabulary.setdefault(w, len(vocabulary)) for w in answer_tokens]
        window = 1 << max(3, int(np.ceil(np.log2(len(tokens)))))
        items.append(Item(row["item_id"], np.array(codes), np.array(wanted, dtype=np.int64), window))
        if len(items) == settings.block:
            yield vocabulary, items
            vocabulary, items = {}, []
    if items:
        yield vocabulary, items


# ------------------------------------------------------------------------------------------------ word places

PLACES = "row long, doc_id long, n_words long, places binary, codes binary"


def occurrences(docs: DataFrame, vocabulary: dict[str, int]) -> DataFrame:
    """Places (word numbers) and codes of the benchmark's words in every document."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, row = shared.value, TaskContext.get().partitionId() << 40
        for batch in slices(batches):
            found = words(pc.ascii_lower(batch.column("text")))
            code = np.fromiter((known.get(normal(w), -1) for w in found.vocabulary), dtype=np.int64,
                               count=len(found.vocabulary))[found.codes] if len(found.codes) else found.codes
            place = np.arange(len(code)) - np.repeat(found.starts, found.counts)
            hit = code >= 0
            counts = np.bincount(found.rows[hit], minlength=batch.num_rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + batch.num_rows)), batch.column("doc_id"), pa.array(found.counts),
                 binaries(place[hit].astype("<u4"), counts), binaries(code[hit].astype("<u4"), counts)],
                ["row", "doc_id", "n_words", "places", "codes"])
            row += batch.num_rows

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, PLACES)


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``document number in the batch, place, code`` of every occurrence."""
    sizes = pc.binary_length(batch.column("places")).to_numpy(zero_copy_only=False).astype(np.int64) // 4
    join = lambda name: np.frombuffer(b"".join(batch.column(name).to_pylist()), "<u4").astype(np.int64)
    return np.repeat(np.arange(batch.num_rows), sizes), join("places"), join("codes")


def _cells(doc: np.ndarray, place: np.ndarray, width: int) -> np.ndarray:
    """Numbers of the passages of ``width`` words, ascending, with a gap between documents."""
    top = int(place.max(initial=0)) // width + 8
    return doc * top + place // width


def statistics(places: DataFrame, size: int, width: int) -> tuple[np.ndarray, int]:
    """Passages that hold each word, and the number of passages. At most one row a benchmark word is collected."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in slices(batches, "places"):
            doc, place, code = _flat(batch)
            total += np.bincount(np.unique(_cells(doc, place, width) * size + code) % size, minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["code", "n"])

    rows = places.select("places", "codes").mapInArrow(run, "code long, n long")
    found = rows.groupBy("code").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(size, dtype=np.int64)
    out[found["code"].to_numpy(dtype=np.int64)] = found["n"].to_numpy()
    passages = places.agg(F.sum(F.ceil(F.col("n_words") / width))).first()[0]
    return out, int(passages or 0)


# ----------------------------------------------------------------------------------------------- latent space


@dataclass(frozen=True)
class Space:
    """Weight of each word (0: does not steer), its latent vector times its weight, and the items' latent vectors."""

    weight: np.ndarray
    vectors: np.ndarray
    items: np.ndarray


def weights(items: list[Item], occurring: np.ndarray, passages: int, settings: Settings) -> np.ndarray:
    """Inverse passage frequency of the words that steer retrieval."""
    idf = np.log((passages + 1) / (occurring + 0.5)).clip(0.01)
    steers = occurring <= settings.common * max(passages, 1)
    for item in items:
        own = np.unique(item.words)
        steers[own[np.argsort(-idf[own], kind="stable")[: settings.rarest]]] = True
    return np.where(steers, idf, 0.0)


def _sums(values: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct groups, ascending, and the sums of the rows of ``values`` in each; ``group`` is ascending."""
    begins = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else group
    return group[begins], np.add.reduceat(values, begins, axis=0) if len(begins) else values[:0]


def _spread_gram(cell: np.ndarray, code: np.ndarray, weight: np.ndarray, omega: np.ndarray) -> tuple:
    """The rows of ``Aᵀ(A Ω)`` that some passages touch: words, ascending, and their rows."""
    number = np.unique(cell, return_inverse=True)[1]
    sketch = _sums((omega * weight[:, None])[code], number)[1]
    order = np.argsort(code, kind="stable")
    which, rows = [], []
    for begin in range(0, len(order), 1 << 16):
        part = order[begin: begin + (1 << 16)]
        words_, sums = _sums(sketch[number[part]], code[part])
        which.append(words_)
        rows.append(sums * weight[words_][:, None])
    return np.concatenate(which), np.concatenate(rows).astype(np.float64)


def _row_sums(batches: Iterable[pa.RecordBatch], rank: int) -> Iterator[pa.RecordBatch]:
    """Sums of rows with equal codes in batches sorted by code."""
    last, total = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        codes, sums = _sums(_matrix(batch, rank), batch.column("code").to_numpy())
        if last is not None and codes[0] == last:
            sums[0] += total
        elif last is not None:
            yield _rows(np.array([last]), total[None])
        yield _rows(codes[:-1], sums[:-1])
        last, total = int(codes[-1]), sums[-1]
    if last is not None:
        yield _rows(np.array([last]), total[None])


def _matrix(batch: pa.RecordBatch, rank: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("sums").to_pylist()), np.float64).reshape(-1, rank).copy()


def _rows(codes: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(codes.astype(np.int64)), pa.array(
        [r.tobytes() for r in np.ascontiguousarray(rows)], pa.binary())], ["code", "sums"])


def latent_space(places: DataFrame, items: list[Item], weight: np.ndarray, settings: Settings) -> Space:
    """The space of ``rank`` dimensions. Each task sends the rows of the words it holds, and none if it holds none;
    they are summed by word. What comes to the driver is a row a word of the block, whatever the corpus."""
    size = len(weight)
    rank = min(size, settings.rank)
    omega = np.random.default_rng(7).standard_normal((size, rank)).astype(np.float32)
    shared = places.sparkSession.sparkContext.broadcast((weight.astype(np.float32), omega))

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, om = shared.value
        total, seen = None, None
        for batch in slices(batches, "places", 1 << 20):
            doc, place, code = _flat(batch)
            use = w[code] > 0
            if use.any():
                if total is None:
                    total, seen = np.zeros(om.shape), np.zeros(len(om), dtype=bool)
                which, rows = _spread_gram(_cells(doc, place, settings.passage)[use], code[use], w, om)
                np.add.at(total, which, rows)
                seen[which] = True
        if total is not None:
            touched = np.flatnonzero(seen)
            for k in range(0, len(touched), 1 << 12):
                yield _rows(touched[k: k + (1 << 12)], total[touched[k: k + (1 << 12)]])

    kind = "code long, sums binary"
    sums = places.select("places", "codes").mapInArrow(partial, kind).repartition("code").sortWithinPartitions("code")
    image = np.zeros((size, rank))
    for row in sums.mapInArrow(lambda batches: _row_sums(batches, rank), kind).toLocalIterator():
        image[row["code"]] = np.frombuffer(row["sums"], np.float64)
    # the items are passages of their own: rows of a sparse matrix, with weight enough to be held beside the corpus
    owner = np.repeat(np.arange(len(items)), [len(i.words) for i in items])
    word = np.concatenate([i.words for i in items]) if items else owner
    value = weight[word]
    cells, back = np.unique(owner * size + word, return_inverse=True)
    value = np.bincount(back, weights=value)
    owner, word = cells // size, cells % size
    norm = np.sqrt(np.bincount(owner, weights=value ** 2, minlength=len(items)))
    value = value / np.maximum(norm, 1e-12)[owner]

    def of_items(rows: np.ndarray) -> np.ndarray:
        out = np.zeros((len(items), rows.shape[1]))
        np.add.at(out, owner, value[:, None] * rows[word])
        return out

    spread = np.zeros((size, rank))
    np.add.at(spread, word, value[:, None] * of_items(omega.astype(np.float64))[owner])
    strength = settings.item_weight * np.linalg.norm(image) / max(1e-12, np.linalg.norm(spread)) if image.any() else 1.0
    basis = _nystrom(image + strength * spread, omega.astype(np.float64))
    latent = of_items(basis)
    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)
    return Space(weight.astype(np.float32), (basis * weight[:, None]).astype(np.float32), latent.astype(np.float32))


def _nystrom(image: np.ndarray, omega: np.ndarray) -> np.ndarray:
    """Orthonormal eigenvectors of a positive matrix ``M`` from ``M Ω``."""
    shift = np.finfo(float).eps * max(1.0, np.linalg.norm(image))
    moved = image + shift * omega
    core = omega.T @ moved
    values, left = np.linalg.eigh((core + core.T) / 2)
    good = values > 1e-10 * max(values.max(initial=0.0), 1e-300)
    root = moved @ (left[:, good] / np.sqrt(values[good]))
    return np.linalg.svd(root, full_matrices=False)[0]


# ----------------------------------------------------------------------------------------------------- search


def common_subsequence(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Length of the longest common subsequence, by bit-parallel rows, and a mask of the item's words in a match of
    that length as far as rows tell (set bits are matched)."""
    masks: dict[int, int] = {}
    for k, code in enumerate(item.tolist()):
        masks[code] = masks.get(code, 0) | (1 << k)
    everything = (1 << len(item)) - 1
    row = everything
    for code in text.tolist():
        match = masks.get(code)
        if match is not None:
            both = row & match
            row = ((row + both) | (row - both)) & everything
    matched = ~row & everything
    return bin(matched).count("1"), matched


@dataclass(frozen=True)
class Answers:
    """Which items of one window size a word answers, as ``items[begins[word]: begins[word + 1]]``, and for each item how
    many distinct words of its answer a confirmed match holds at least: 0, 1, or 2 for more."""

    begins: np.ndarray
    items: np.ndarray
    least: np.ndarray

    @staticmethod
    def of(answers: list[np.ndarray], chosen: np.ndarray, size: int, share: float) -> Answers:
        least = np.zeros(len(answers), dtype=np.int64)
        words_, owners = [], []
        for k in chosen.tolist():
            # the words that occur most in the answer make up its share with the fewest distinct ones
            own, times = np.unique(answers[k], return_counts=True)
            held = np.cumsum(np.sort(times)[::-1])
            least[k] = min(2, int(np.searchsorted(held, share * len(answers[k]) - 1e-9) + 1)) if len(own) and share > 0 else 0
            if least[k]:
                words_.append(own)
                owners.append(np.full(len(own), k))
        word = np.concatenate(words_) if words_ else np.zeros(0, np.int64)
        order = np.argsort(word, kind="stable")
        begins = np.searchsorted(word[order], np.arange(size + 1))
        return Answers(begins, (np.concatenate(owners) if owners else word)[order], least)


def _candidates(doc: np.ndarray, place: np.ndarray, code: np.ndarray, cell: np.ndarray, answers: Answers,
                chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``start, item``: windows (their first cells) with enough of an item's answer where a match would be confirmed, from
    two cells before the window to two after it. A window without cannot be confirmed for the item."""
    each = answers.begins[code + 1] - answers.begins[code]
    at = np.repeat(np.flatnonzero(each), each[each > 0])
    nth = np.arange(len(at)) - np.repeat(np.cumsum(each[each > 0]) - each[each > 0], each[each > 0])
    item = answers.items[answers.begins[code[at]] + nth]
    order = np.lexsort((place[at], item, doc[at]))
    at, item = at[order], item[order]
    one = answers.least[item] == 1
    low, high, who = [cell[at[one]]], [cell[at[one]]], [item[one]]
    # two words of an answer in reach of each other have neighbours that differ between them
    same = (doc[at[1:]] == doc[at[:-1]]) & (item[1:] == item[:-1]) & (code[at[1:]] != code[at[:-1]])
    pair = np.flatnonzero(same & (answers.least[item[1:]] == 2)) if len(at) else at
    low.append(cell[at[pair]])
    high.append(cell[at[pair + 1]])
    who.append(item[pair])
    low, high, who = np.concatenate(low), np.concatenate(high), np.concatenate(who)
    wide = np.maximum(0, 8 - (high - low))
    start = np.repeat(high - 5, wide) + np.arange(wide.sum()) - np.repeat(np.cumsum(wide) - wide, wide)
    who = np.repeat(who, wide)
    free = chosen[answers.least[chosen] == 0]
    if len(free):  # no answer to look for: every window with a word of the benchmark
        every = np.unique((np.unique(cell)[:, None] - np.arange(4)[None, :]).ravel())
        start = np.concatenate([start, np.tile(every, len(free))])
        who = np.concatenate([who, np.repeat(free, len(every))])
    found = np.unique(np.stack([start, who], axis=1), axis=0)
    return found[:, 0], found[:, 1]


def _vectors(starts: np.ndarray, cell: np.ndarray, code: np.ndarray, space: Space) -> np.ndarray:
    """Unit latent vectors of windows of four cells, zero for those without a steering word; ``cell`` and ``code`` are
    those of the steering words. Sums of windows are differences of running sums over the words in any of them."""
    low, high = np.searchsorted(cell, starts), np.searchsorted(cell, starts + 4)
    change = np.zeros(len(cell) + 1, dtype=np.int64)
    np.add.at(change, low, 1)
    np.add.at(change, high, -1)
    inside = np.cumsum(change)[:-1] > 0
    number = np.concatenate([[0], np.cumsum(inside)])
    running = np.zeros((int(inside.sum()) + 1, space.vectors.shape[1]))
    np.cumsum(space.vectors[code[inside]], axis=0, out=running[1:], dtype=np.float64)
    total = (running[number[high]] - running[number[low]]).astype(np.float32)
    return total / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-12)


def search(places: DataFrame, items: list[Item], space: Space, settings: Settings) -> DataFrame:
    """``row, doc_id, item_id, lcs, cosine, begin, end`` of confirmed passages; words count from 0."""
    rarest = []
    for item in items:
        own = np.unique(item.words)
        rarest.append(item.answer if len(item.answer) else
                      own[np.argsort(-space.weight[own], kind="stable")[: settings.answer_words]])
    # What a confirmed match holds at least of an item's words that steer, where the checks look: all but those that
    # ``min_lcs`` allows to be missing. A window with fewer around it cannot be confirmed for the item, nor can one
    # without the words of its answer that ``min_answer`` wants.
    steering = np.array([int((space.weight[i.words] > 0).sum()) for i in items])
    missing = np.array([len(i.words) - int(np.ceil(settings.min_lcs * len(i.words) - 1e-9)) for i in items])
    least = np.maximum(1, steering - missing)
    of_size = {w: np.array([k for k, i in enumerate(items) if i.window == w]) for w in sorted({i.window for i in items})}
    answering = {w: Answers.of(rarest, chosen, len(space.weight), settings.min_answer) for w, chosen in of_size.items()}
    shared = places.sparkSession.sparkContext.broadcast((items, space, rarest, least, of_size, answering))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, space, answers, least, of_size, answering = shared.value
        for batch in slices(batches, "places", 1 << 20):
            doc, place, code = _flat(batch)
            if not len(doc):
                continue
            bounds = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            use = space.weight[code] > 0
            best: dict[tuple[int, int], tuple] = {}
            for window, chosen in of_size.items():
                stride = window // 4
                cell, top = _cells(doc, place, stride), int(place.max(initial=0)) // stride + 8
                start, which = _candidates(doc, place, code, cell, answering[window], chosen)
                steered = cell[use]
                enough = np.searchsorted(steered, start + 6) - np.searchsorted(steered, start - 2) >= least[which]
                start, which = start[enough], which[enough]
                windows, back = np.unique(start, return_inverse=True)
                vectors = _vectors(windows, steered, code[use], space)
                cosine = np.concatenate([np.einsum("ij,ij->i", vectors[back[k: k + 65_536]], space.items[
                    which[k: k + 65_536]]) for k in range(0, len(start), 65_536)] or [np.zeros(0)])
                near = np.flatnonzero(cosine >= settings.min_cosine)
                begin = start % top
                here = begin < top - 5  # windows that begin before their document begin in the gap of the one before
                owner = np.where(here, start // top, start // top + 1)
                begin = np.where(here, begin, begin - top) * stride
                for at in near.tolist():
                    which_, who = int(which[at]), int(owner[at])
                    match = _confirm(items[which_], answers[which_], place[bounds[who]: bounds[who + 1]],
                                     code[bounds[who]: bounds[who + 1]], int(begin[at]), settings)
                    if match is not None:
                        entry = (match[0], float(cosine[at]), *match[1:])
                        best[who, which_] = max(best.get((who, which_), entry), entry)
            rows, ids = batch.column("row").to_pylist(), batch.column("doc_id").to_pylist()
            found = [(rows[d], ids[d], items[i].item_id, *v) for (d, i), v in sorted(best.items())]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.int64())
            names = ["row", "doc_id", "item_id", "lcs", "cosine", "begin", "end"]
            columns = list(zip(*found)) if found else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

    return places.select("row", "doc_id", "places", "codes").mapInArrow(
        run, "row long, doc_id long, item_id long, lcs double, cosine double, begin long, end long")


def _confirm(item: Item, answer: np.ndarray, place: np.ndarray, code: np.ndarray, begin: int,
             settings: Settings) -> tuple[float, int, int] | None:
    """Share of the item in the window and half a window around it, and the bounds looked at; None if too little."""
    low, high = begin - item.window // 2, begin + item.window + item.window // 2
    a, b = np.searchsorted(place, (low, high))
    length, _ = common_subsequence(item.words, code[a:b])
    share = length / len(item.words)
    if share < settings.min_lcs:
        return None
    if len(answer) and np.isin(answer, code[a:b]).mean() < settings.min_answer:
        return None
    return share, max(low, 0), high


def leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, item_id, lcs, cosine, begin, end``: one row for each benchmark item that a document holds, with the
    best match. A document without one has no row."""
    found = None
    for vocabulary, items in benchmark_items(benchmark, settings):
        path = shared_folder(spark, "places")
        occurrences(docs, vocabulary).write.option("compression", "zstd").parquet(path)
        places = spark.read.parquet(path)
        occurring, passages = statistics(places, len(vocabulary), settings.passage)
        weight = weights(items, occurring, passages, settings)
        new = search(places, items, latent_space(places, items, weight, settings), settings)
        found = new if found is None else found.union(new)
    if found is None:
        found = spark.createDataFrame(
            [], "row long, doc_id long, item_id long, lcs double, cosine double, begin long, end long")
    return found.drop("row")


def without_leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame,
                  settings: Settings = Settings()) -> DataFrame:
    """The rows of documents without a benchmark passage, with the columns they came with. A document number that
    occurs more than once goes with all its rows if one of them holds a passage."""
    bad = leaks(spark, docs, benchmark, settings).select("doc_id").distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["doc_id"]), "left_anti")
