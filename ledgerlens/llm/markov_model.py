"""A hidden Markov language model over words.

Words are emitted through a bounded number of classes: the ``heads`` most frequent words have a class each, all others
share ``tails`` classes by hash. A state emits a class, a class emits a word by its corpus count with one share kept for
words never seen, so any text has a positive probability. State tables are therefore bounded (states by classes) while
the word counts, which are not, live in a table that is joined.

1. ``encode``: documents are dealt into chunks (the slices that a task reads); each chunk gets a word list of its own
   and its documents become numbers into that list. Words go on as 64-bit hashes.
2. ``word_counts``: training counts of all words, over the whole corpus.
3. ``ready``: counts of the words of most chunks are shipped, those of words of one chunk are known there, the others
   are joined and gathered by chunk; a chunk's list is bounded by the chunk, whatever the size of the corpus.
4. ``train``: Baum-Welch. Every iteration each task runs scaled forward and backward recursions over its training
   documents and sends expected counts by cell; Spark adds them up and the next tables go back to the tasks. Documents of
   several chunks are taken together, by length, so that a step of the recursions serves many of them.
5. ``score``: the scaled forward recursion gives the exact log-likelihood of every document.

Each text ends with one ``end`` token. A null text counts as empty: one token. Rows with equal or null ``doc_id`` are
scored one by one; a null ``doc_id`` belongs to the training side. Without training documents all counts are 0.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.arrow import binaries, slices, words

END = "\n"  # never a word, since words hold no white space


@dataclass(frozen=True)
class Settings:
    states: int = 4
    heads: int = 1024
    tails: int = 1024
    iterations: int = 6
    chunk_bytes: int = 4 << 20
    at_once: int = 1 << 19  # tokens whose state probabilities a task holds
    together: int = 1 << 21  # tokens of the chunks whose documents a task takes together
    frequent: int = 1 << 16  # words whose counts are shipped to the tasks, 16 bytes each


@dataclass(frozen=True)
class Model:
    """Log-free tables of a trained model, and the corpus figures that the word probabilities need."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # states by classes
    heads: np.ndarray  # hashes of the words with a class of their own, in the order of the classes


# ------------------------------------------------------------------------------------------- chunks and counts

CHUNKS = "chunk long, doc_ids binary, null_ids binary, held_out binary, lengths binary, codes binary, hashes binary"


def word_hashes(listed: list[str]) -> np.ndarray:
    """64-bit hashes that stand for the words from here on."""
    return pd.util.hash_array(np.array(listed, dtype=object), categorize=False).view(np.int64)


def packed(codes: np.ndarray) -> np.ndarray:
    """Compressed codes: bytes of one weight side by side, so that they take the same little space in every exchange."""
    planes = codes.astype("<u4").view("u1").reshape(-1, 4).T
    return np.frombuffer(pa.compress(planes.tobytes(), codec="zstd", asbytes=True), "u1")


def unpacked(stored: bytes, count: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(stored, 4 * count, codec="zstd", asbytes=True), "u1").reshape(4, count)
    return np.ascontiguousarray(planes.T).view("<u4")[:, 0].astype(np.int64)


def encode(docs: DataFrame, held_out: Column, settings: Settings) -> DataFrame:
    """One row a chunk: document numbers, fold, lengths, word codes and the hashes of the chunk's words."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                       F.coalesce(held_out, F.lit(False)).alias("held_out"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in slices(batches, limit=settings.chunk_bytes):
            found = words(pc.ascii_lower(batch.column("text")))
            # the list holds only words that occur, frequent ones first, whose codes are small
            seen, times = np.unique(found.codes, return_counts=True)
            seen = seen[np.argsort(-times, kind="stable")]
            number = np.zeros(len(found.vocabulary) + 1, dtype=np.int64)
            number[seen] = np.arange(1, len(seen) + 1)
            codes = np.zeros(len(found.codes) + batch.num_rows, dtype=np.int64)  # 0: the end
            codes[np.arange(len(found.codes)) + found.rows] = number[found.codes]
            ids = batch.column("doc_id")
            raw = [pc.fill_null(ids, 0).to_numpy().astype("<i8"), np.asarray(ids.is_null()).astype("u1"),
                   np.asarray(batch.column("held_out")).astype("u1"), (found.counts + 1).astype("<u4"),
                   packed(codes)]
            listed = [END, *(found.vocabulary[k] for k in seen.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk]), *(pa.array([x.tobytes()], pa.binary()) for x in (*raw, word_hashes(listed)))],
                ["chunk", "doc_ids", "null_ids", "held_out", "lengths", "codes", "hashes"])
            chunk += 1

    return rows.mapInArrow(run, CHUNKS)


@dataclass(frozen=True)
class Chunk:
    doc_ids: list[int | None]
    held_out: np.ndarray
    lengths: np.ndarray
    codes: np.ndarray

    @staticmethod
    def of(row: dict) -> Chunk:
        take = lambda name, kind: np.frombuffer(row[name], kind)
        ids, null = take("doc_ids", "<i8").tolist(), take("null_ids", "u1").tolist()
        lengths = take("lengths", "<u4").astype(np.int64)
        return Chunk([None if n else d for d, n in zip(ids, null)], take("held_out", "u1").astype(bool), lengths,
                     unpacked(row["codes"], int(lengths.sum())))


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def _together(batches: Iterable[pa.RecordBatch], settings: Settings) -> Iterator[tuple[
        list[tuple[dict, Chunk]], np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Neighbouring chunks of about ``together`` tokens, and of all their documents fold, starts, lengths and classes."""
    held: list[tuple[dict, Chunk]] = []
    coded: list[np.ndarray] = []

    def joined():
        lengths = np.concatenate([chunk.lengths for _, chunk in held])
        folds = np.concatenate([chunk.held_out for _, chunk in held])
        return held, folds, np.cumsum(lengths) - lengths, lengths, np.concatenate(coded)

    for row in _rows(batches):
        chunk = Chunk.of(row)
        held.append((row, chunk))
        coded.append(np.frombuffer(row["class_of"], "<u4")[chunk.codes])
        if sum(map(len, coded)) >= settings.together:
            yield joined()
            held, coded = [], []
    if held:
        yield joined()


def _learned(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a chunk's words and their counts in its training documents."""
    chunk, hashes = Chunk.of(row), np.frombuffer(row["hashes"], "<i8")
    learn = np.repeat(~chunk.held_out, chunk.lengths)
    return hashes, np.bincount(chunk.codes[learn], minlength=len(hashes)).astype(np.int64)


def word_counts(chunks: DataFrame, waiting: int = 1 << 21) -> DataFrame:
    """``hash, total, parts``: training count of each word and the chunks that hold it. A task adds up its chunks, about
    ``waiting`` rows at a time, before anything is sent."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def summed() -> pa.RecordBatch:
            hashes, back = np.unique(np.concatenate([h for h, _ in held]), return_inverse=True)
            total = np.zeros(len(hashes), dtype=np.int64)
            np.add.at(total, back, np.concatenate([n for _, n in held]))
            return pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(total), pa.array(np.bincount(back))],
                                              names=["hash", "total", "parts"])

        for row in _rows(batches):
            held.append(_learned(row))
            if sum(len(h) for h, _ in held) > waiting:
                yield summed()
                held.clear()
        if held:
            yield summed()

    kind = "hash long, total long, parts long"
    return chunks.select("doc_ids", "null_ids", "held_out", "lengths", "codes", "hashes").mapInArrow(run, kind).groupBy(
        "hash").agg(F.sum("total").alias("total"), F.sum("parts").alias("parts"))


def frequent_words(totals: DataFrame, most: int) -> tuple[pd.DataFrame, DataFrame]:
    """The words of most chunks, no more than ``most``, as a table to ship, and the other words of several chunks. Words
    of one chunk are in neither: their count is known there."""
    level = F.floor(F.log2("parts") * 8).cast("int")
    several = totals.where("parts > 1").withColumn("level", level)
    chosen, total = 1 << 30, 0
    for row in several.groupBy("level").count().orderBy(F.desc("level")).collect():  # a few hundred levels
        total += row["count"]
        if total > most:
            break
        chosen = row["level"]
    shipped = several.where(F.col("level") >= chosen).select("hash", "total").toPandas().sort_values("hash")
    return shipped, several.where(F.col("level") < chosen).select("hash", "total")


def word_classes(heads: np.ndarray, hashes: np.ndarray, settings: Settings) -> np.ndarray:
    """Classes of words by hash: the place in ``heads``, or one of the shared classes."""
    classes = settings.heads + np.mod(hashes, settings.tails)
    if len(heads):
        order = np.argsort(heads)
        place = np.minimum(np.searchsorted(heads[order], hashes), len(heads) - 1)
        found = heads[order][place] == hashes
        classes[found] = order[place[found]]
    return classes


# --------------------------------------------------------------------------------------------------- recursions


def _batches(lengths: np.ndarray, at_once: int) -> Iterator[np.ndarray]:
    """Documents in order of falling length, in groups of about ``at_once`` tokens."""
    order = np.argsort(-lengths, kind="stable")
    ends = np.cumsum(lengths[order])
    start = 0
    while start < len(order):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + at_once, "right")))
        yield order[start:stop]
        start = stop


@dataclass(frozen=True)
class Steps:
    """Tokens of some documents, step by step: all first tokens, then all second ones, and so on. ``lengths`` falls, so a
    step holds the first ``live[step]`` documents, from ``at[step]`` on."""

    classes: np.ndarray
    live: list[int]
    at: list[int]
    document: np.ndarray

    @staticmethod
    def of(starts: np.ndarray, lengths: np.ndarray, classes: np.ndarray) -> Steps:
        live = np.searchsorted(-lengths, -np.arange(int(lengths[0])), "left")
        at = np.cumsum(live) - live
        document = np.arange(int(live.sum())) - np.repeat(at, live)
        place = starts[document] + np.repeat(np.arange(len(live)), live)
        return Steps(classes[place].astype(np.int64), live.tolist(), at.tolist(), document)


def forward(model: Model, starts: np.ndarray, lengths: np.ndarray, classes: np.ndarray) -> tuple[
        np.ndarray, Steps, np.ndarray, np.ndarray, np.ndarray]:
    """Log-likelihood of each document (natural logarithm) over classes; ``lengths`` falls. Then the steps and, a column
    a token of theirs, the scaled state probabilities, the emissions and the scales."""
    steps = Steps.of(starts, lengths, classes)
    emitted = model.emit.take(steps.classes, axis=1)
    states, scales = np.empty_like(emitted), np.empty(emitted.shape[1])
    onward, first = np.ascontiguousarray(model.move.T), steps.live[0]
    moved = np.empty((len(model.start), first))
    moved[:] = model.start[:, None]
    for n, at in zip(steps.live, steps.at):
        here, scale = states[:, at:at + n], scales[at:at + n]
        np.multiply(moved[:, :n], emitted[:, at:at + n], out=here)
        np.add.reduce(here, axis=0, out=scale)
        np.divide(here, scale, out=here)
        np.matmul(onward, here, out=moved[:, :n])
    return np.bincount(steps.document, weights=np.log(scales), minlength=first), steps, states, emitted, scales


def expect(model: Model, starts: np.ndarray, lengths: np.ndarray, classes: np.ndarray,
           counts: tuple[np.ndarray, np.ndarray, np.ndarray]) -> None:
    """Add the expected starts, moves and emissions of some documents to ``counts``."""
    start, move, emit = counts
    _, steps, states, ahead, scales = forward(model, starts, lengths, classes)
    np.divide(ahead, scales, out=ahead)
    back = np.ones((len(start), steps.live[0]))  # documents that end at a step join with 1
    for step in range(len(steps.live) - 1, -1, -1):
        n, at = steps.live[step], steps.at[step]
        here, known = states[:, at:at + n], back[:, :n]
        np.multiply(here, known, out=here)  # from now on the probability given the whole text
        if step:
            before, coming = steps.at[step - 1], ahead[:, at:at + n]
            np.multiply(coming, known, out=coming)
            move += states[:, before:before + n] @ coming.T
            np.matmul(model.move, coming, out=known)
    start += states[:, :steps.live[0]].sum(axis=1)
    for k in range(len(start)):
        emit[k] += np.bincount(steps.classes, weights=states[k], minlength=emit.shape[1])


def _normalised(start: np.ndarray, move: np.ndarray, emit: np.ndarray, heads: np.ndarray) -> Model:
    """Tables from expected counts; the move table was counted without its old factor. A little is added everywhere,
    so that no class has probability 0."""
    share = lambda x: (x + 1e-3) / (x + 1e-3).sum(axis=-1, keepdims=True)
    return Model(share(start), share(move), share(emit), heads)


# ------------------------------------------------------------------------------------------------ distributed


def first_model(class_counts: np.ndarray, heads: np.ndarray, settings: Settings) -> Model:
    """States that differ by a fixed draw around the corpus frequencies of the classes."""
    draw = np.random.default_rng(11)
    emit = (class_counts + 1.0)[None, :] * draw.uniform(0.5, 1.5, (settings.states, len(class_counts)))
    move = 20 * np.eye(settings.states) + draw.uniform(0.5, 1.5, (settings.states, settings.states))
    return _normalised(np.ones(settings.states), move, emit, heads)


def iterate(chunks: DataFrame, model: Model, settings: Settings) -> Model:
    """One Baum-Welch iteration over all training documents of ``chunks`` (columns of ``ready``)."""
    spark = chunks.sparkSession
    shared = spark.sparkContext.broadcast(model)
    states, size = settings.states, model.emit.shape[1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        counts = (np.zeros(states), np.zeros((states, states)), np.zeros((states, size)))
        for _, folds, starts, lengths, classes in _together(batches, settings):
            learn = np.flatnonzero(~folds)
            for some in _batches(lengths[learn], settings.at_once):
                expect(model, starts[learn[some]], lengths[learn[some]], classes, counts)
        flat = np.concatenate([x.reshape(-1) for x in counts])
        cell = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(flat[cell])], ["cell", "value"])

    sums = chunks.select("doc_ids", "null_ids", "held_out", "lengths", "codes", "class_of").mapInArrow(
        run, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value")).toPandas()
    flat = np.zeros(states + states * states + states * size)  # bounded: the cells of the tables
    flat[sums["cell"].to_numpy(dtype=np.int64)] = sums["value"].to_numpy()
    start, move, emit = np.split(flat, [states, states + states * states])
    # moves were counted without the factor of the move table itself
    return _normalised(start, move.reshape(states, states) * model.move, emit.reshape(states, size), model.heads)


def ready(chunks: DataFrame, totals: DataFrame, heads: np.ndarray, settings: Settings) -> DataFrame:
    """``chunks`` with ``class_of`` and ``count_of``: class and training count of each word of the chunk's list.

    Counts of the words of most chunks are shipped, those of words of one chunk are its own; only the rest are joined,
    as hash and place, so no word that every chunk holds meets in one task."""
    shipped, rest = frequent_words(totals, settings.frequent)
    shared = chunks.sparkSession.sparkContext.broadcast((shipped["hash"].to_numpy(), shipped["total"].to_numpy(), heads))

    def known(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        table = shared.value[0]
        place = np.minimum(np.searchsorted(table, hashes), max(len(table) - 1, 0))
        return (table[place] == hashes if len(table) else np.zeros(len(hashes), dtype=bool)), place

    def asked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            hashes = np.frombuffer(row["hashes"], "<i8")
            places = np.flatnonzero(~known(hashes)[0])
            yield pa.RecordBatch.from_arrays([pa.array(hashes[places]), pa.array(np.full(len(places), row["chunk"])),
                                              pa.array(places.astype(np.int32))], ["hash", "chunk", "place"])

    lists = chunks.select("chunk", "hashes").mapInArrow(asked, "hash long, chunk long, place int").join(
        rest, "hash").groupBy("chunk").agg(F.collect_list(F.struct("place", "total")).alias("list"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                one = batch.slice(k, 1)
                hashes, count = _learned(one.drop_columns(["list"]).to_pylist()[0])
                found, place = known(hashes)
                count[found] = shared.value[1][place[found]]
                if one.column("list").is_valid()[0].as_py():
                    entry = one.column("list").flatten()
                    count[pc.struct_field(entry, "place").to_numpy()] = pc.struct_field(entry, "total").to_numpy()
                classes = word_classes(shared.value[2], hashes, settings)
                added = pa.array([classes.astype("<u4").tobytes()]), pa.array([count.astype("<i8").tobytes()])
                kept = one.drop_columns(["hashes", "list"])
                yield pa.RecordBatch.from_arrays([*kept.columns, *added], [*kept.schema.names, "class_of", "count_of"])

    schema = CHUNKS.replace("hashes binary", "class_of binary, count_of binary")
    return chunks.join(lists, "chunk", "left").mapInArrow(run, schema)


def score(chunks: DataFrame, model: Model, figures: dict[str, np.ndarray | int], settings: Settings) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every document. ``figures`` has the
    corpus totals: tokens, distinct words, and both by class."""
    shared = chunks.sparkSession.sparkContext.broadcast((model, figures))
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, figures = shared.value
        tokens, distinct = figures["tokens"], figures["distinct"]
        for chunks, _, starts, lengths, classes in _together(batches, settings):
            states = np.empty(len(starts))
            for some in _batches(lengths, settings.at_once):
                states[some] = forward(model, starts[some], lengths[some], classes)[0] / np.log(10)
            ends = np.cumsum([len(chunk.lengths) for _, chunk in chunks])[:-1]
            for (row, chunk), by_state in zip(chunks, np.split(states, ends)):
                class_of = np.frombuffer(row["class_of"], "<u4").astype(np.int64)
                count = np.frombuffer(row["count_of"], "<i8").astype(np.float64)
                base = np.log10((count + 1) / (tokens + (distinct + 1)))
                # a word given its class: certain for a class of one word, else by count with a share for unseen words
                inside = np.log10((count + 1) / (figures["class_tokens"] + figures["class_distinct"] + 1)[class_of])
                inside[class_of < len(model.heads)] = 0.0
                begins = np.cumsum(chunk.lengths) - chunk.lengths
                total = lambda x: np.add.reduceat(x[chunk.codes], begins)
                columns = [chunk.doc_ids, chunk.held_out, chunk.lengths, total((count > 0).astype(np.int64)),
                           np.full(len(begins), tokens), total(base), total(inside) + by_state]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return chunks.select("doc_ids", "null_ids", "held_out", "lengths", "codes", "class_of", "count_of").mapInArrow(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
             "score double")


def fit_and_score(docs: DataFrame, held_out: Column, folder: str, settings: Settings = Settings()) -> DataFrame:
    """Train on the documents that are not held out and score all of them. ``folder`` is a shared one."""
    spark = docs.sparkSession
    zstd = lambda df, name: (df.write.option("compression", "zstd").parquet(f"{folder}/{name}"),
                             spark.read.parquet(f"{folder}/{name}"))[1]
    chunks = zstd(encode(docs, held_out, settings), "chunks")
    totals = zstd(word_counts(chunks), "words")
    known = totals.where("total > 0")
    tokens, distinct = known.agg(F.coalesce(F.sum("total"), F.lit(0)), F.count(F.lit(1))).first()
    end = int(word_hashes([END])[0])
    top = known.where(F.col("hash") != end).orderBy(F.desc("total"), "hash").limit(settings.heads - 1).collect()
    heads = np.array([end, *(r["hash"] for r in top)], dtype=np.int64)
    size = settings.heads + settings.tails
    listed = spark.createDataFrame([(h, k) for k, h in enumerate(heads.tolist())], "hash long, head int")  # at most `heads` rows
    tail = (F.pmod("hash", F.lit(settings.tails)) + settings.heads).cast("int")
    by_class = known.join(F.broadcast(listed), "hash", "left").groupBy(F.coalesce("head", tail).alias("c")).agg(
        F.sum("total").alias("tokens"), F.count(F.lit(1)).alias("distinct")).toPandas()
    class_tokens, class_distinct = np.zeros(size), np.zeros(size)
    class_tokens[by_class["c"].to_numpy(dtype=np.int64)] = by_class["tokens"].to_numpy()
    class_distinct[by_class["c"].to_numpy(dtype=np.int64)] = by_class["distinct"].to_numpy()
    prepared = zstd(ready(chunks, totals, heads, settings), "ready")
    model = first_model(class_tokens, heads, settings)
    for _ in range(settings.iterations if tokens else 0):
        model = iterate(prepared, model, settings)
    return score(prepared, model, {"tokens": tokens, "distinct": distinct, "class_tokens": class_tokens,
                                   "class_distinct": class_distinct}, settings)
