"""Operators that compare documents with each other, against brute force."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from cases import ODD
from pyspark.sql import functions as F

from ledgerlens.llm import decontaminate, graph, markov_model, near_duplicates, suffix_dedup
from ledgerlens.session import shared_folder

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ------------------------------------------------------------------------------------------------ components


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_union_find(spark, seed):
    shared_folder(spark, "test")
    rnd = random.Random(seed)
    links = [(rnd.randrange(120), rnd.randrange(120)) for _ in range(90)] + [(k, k + 1) for k in range(200, 230)]
    parent = {x: x for pair in links for x in pair}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    found = graph.components(spark.createDataFrame(links, "u long, v long")).collect()
    expected = {x: find(x) for x in parent if any(x in p and p[0] != p[1] for p in links)}
    assert {r["node"]: r["component"] for r in found} == expected
    assert len(found) == len(expected)
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0


# -------------------------------------------------------------------------------------------- near-duplicates


def plain_groups(rows):
    sets, parent = {}, {}
    for number, text in rows:
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        grams = {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) > 4 else {tuple(words)} if words else set()
        sets[number], parent[number] = grams, number

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    numbers = sorted(sets)
    for i, a in enumerate(numbers):
        for b in numbers[i + 1:]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= 75 * (len(sets[a]) + len(sets[b]) - shared):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {n: (len(sets[n]), find(n)) for n in numbers}


def edited(rnd, words, share):
    return [rnd.choice("abcdefgh") * 3 if rnd.random() < share else w for w in words]


def families(rnd, groups=12, size=8):
    rows = []
    for _ in range(groups):
        base = [f"w{rnd.randrange(400)}" for _ in range(rnd.choice([7, 40, 120, 300]))]
        for _ in range(size):
            rows.append(" ".join(edited(rnd, base, rnd.choice([0, 0.005, 0.02, 0.05]))))
    rnd.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("block", [2, 256])
def test_groups_equal_all_pairs(make, block):
    rows = families(random.Random(8)) + [(900, ""), (901, None), (902, "one two"), (903, "ONE two"), (904, "two one")]
    settings = near_duplicates.Settings(block=block)
    found = near_duplicates.group(make(rows), settings).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == plain_groups(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_near_duplicates_take_odd_rows(odd, empty, clashing):
    rows = near_duplicates.group(odd).collect()
    assert len(rows) == len(ODD)
    by_number = {r["doc_id"]: r for r in rows}
    assert by_number[11]["component_id"] == 10 and by_number[1]["component_id"] == 1 and by_number[1]["n_shingles"] == 0
    assert near_duplicates.group(empty).count() == 0
    kept = near_duplicates.keep_one(clashing)
    assert kept.columns == clashing.columns and kept.count() == 3


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2 ** 63, 4000, dtype=np.uint64)
    a, b = np.sort(pool[:3000]), np.sort(pool[1000:])
    sketch = near_duplicates.signatures(np.concatenate([a, b]), np.array([3000, 3000]), 256)
    assert abs((sketch[0] == sketch[1]).mean() - 0.5) < 0.1
    small = near_duplicates.signatures(pool[:1], np.array([1, 0]), 64)
    assert len(set((small[0] >> np.uint64(32)).tolist())) == 64  # one element: every round goes to another slot


def test_several_texts_of_one_document_belong_together(make):
    rnd = random.Random(8)
    text = lambda: " ".join(f"w{rnd.randrange(10 ** 6)}" for _ in range(120))
    a, b, c = text(), text(), text()
    rows = [(1, a), (1, b), (2, b + " more"), (3, a + " other"), (4, c), (4, c), (5, None), (5, c + " end"), (6, "")]
    found = sorted((r["doc_id"], r["component_id"], r["kept"]) for r in near_duplicates.group(make(rows)).collect())
    assert found == [(1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True), (4, 4, True), (5, 4, False),
                     (5, 5, True), (6, 6, True)]


# ----------------------------------------------------------------------------------------------- suffix dedup


def plain_removal(rows, length):
    counts = collections.Counter()
    for _, text in rows:
        raw = (text or "").encode()
        counts.update(raw[i:i + length] for i in range(len(raw) - length + 1))
    out = []
    for number, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if counts[raw[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        rest = bytes(x for x, g in zip(raw, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((number, len(raw), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("settings", [
    suffix_dedup.Settings(length=24, gram=8), suffix_dedup.Settings(length=24, gram=8, hot=2),
    suffix_dedup.Settings(length=24, gram=8, small=0, run=7, range=20), suffix_dedup.Settings(length=40, gram=4)])
def test_removal_equals_brute_force(spark, make, settings):
    rnd = random.Random(settings.length + settings.hot)
    passages = ["".join(rnd.choice("abcdé ") for _ in range(rnd.randrange(10, 90))) for _ in range(12)]
    rows = [(k, "".join(rnd.choice([rnd.choice(passages), "".join(rnd.choice("abcdef\n") for _ in range(20))])
                        for _ in range(rnd.randrange(9)))) for k in range(60)]
    rows += [(100, "a" * 300), (101, "ab" * 100), (102, None), (103, "x" * 10), (104, rows[3][1]), (104, rows[3][1])]
    found = suffix_dedup.deduplicate(make(rows), shared_folder(spark, "suffix-test"), settings).collect()
    assert sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found) \
        == plain_removal(rows, settings.length)
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in found)


def test_suffix_dedup_takes_odd_rows(spark, odd, empty, clashing):
    for docs, n in ((odd, len(ODD)), (empty, 0), (clashing, 3)):
        found = suffix_dedup.deduplicate(docs, shared_folder(spark, "suffix-test"))
        assert found.count() == n
    assert suffix_dedup.deduplicate(odd, shared_folder(spark, "suffix-test")).where(
        "doc_id = 9").first()["n_removed"] == 30_000


def test_loser_tree_merges_with_true_prefixes():
    rnd = random.Random(3)
    runs = [sorted((bytes(rnd.choice(b"ab") for _ in range(rnd.randrange(9))), rnd.randrange(99), b"l")
                   for _ in range(rnd.randrange(12))) for _ in range(5)]
    out = list(suffix_dedup.LoserTree([suffix_dedup.front_coded(r) for r in runs]))
    assert [k for _, k, _, _ in out] == sorted(k for r in runs for k, _, _ in r)
    for (_, a, _, _), (shared, b, _, _) in zip(out, out[1:]):
        assert shared == suffix_dedup.shared_prefix(a, b)
    assert list(suffix_dedup.LoserTree([])) == []


# -------------------------------------------------------------------------------------------- decontamination


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_common_subsequence_equals_the_table():
    rnd = random.Random(1)
    for _ in range(200):
        a = [rnd.randrange(5) for _ in range(rnd.randrange(1, 30))]
        b = [rnd.randrange(5) for _ in range(rnd.randrange(40))]
        assert decontaminate.common_subsequence(np.array(a), np.array(b, dtype=np.int64))[0] == lcs(a, b)


def test_planted_passages_are_found_and_clean_text_is_left(spark, make, odd, empty, clashing):
    rnd = random.Random(12)
    common = ["the", "of", "and", "to", "in", "is"]
    word = lambda: rnd.choice(common) if rnd.random() < 0.4 else f"v{rnd.randrange(3000)}"
    text = lambda n: [word() for _ in range(n)]
    items = [text(rnd.choice([12, 25, 60])) for _ in range(30)]
    rows, planted = [], set()
    for k in range(400):
        words = text(rnd.randrange(20, 400))
        if k % 8 == 0:
            i = rnd.randrange(30)
            passage = list(items[i])
            if k % 16 == 0:  # a paraphrase: one word in ten replaced, another one added
                passage = [w for x in passage for w in ([x] if rnd.random() > 0.1 else ["other"])] + ["added"]
            at = rnd.randrange(len(words))
            words[at:at] = passage
            planted.add((k, i))
        rows.append((k, " ".join(words).replace("v1 ", "V1, ")))
    benchmark = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)] + [(98, None), (99, "")],
                                      "item_id long, text string")
    settings = decontaminate.Settings(block=20)
    found = decontaminate.leaks(spark, make(rows), benchmark, settings).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == planted
    assert all(r["lcs"] >= settings.min_lcs for r in found)
    rest = decontaminate.without_leaks(spark, make(rows), benchmark, settings)
    assert rest.count() == 400 - len(planted)
    assert decontaminate.leaks(spark, odd, benchmark).count() == 0
    assert decontaminate.leaks(spark, empty, benchmark).count() == 0
    assert decontaminate.without_leaks(spark, clashing, benchmark).columns == clashing.columns
    assert decontaminate.leaks(spark, odd, benchmark.limit(0)).count() == 0
    answered = benchmark.withColumn("answer", F.lit("nowhere to be found"))
    assert decontaminate.leaks(spark, make(rows), answered, settings).count() == 0


def test_recall_against_every_window(spark, make):
    """Passages with up to 28 % of their words replaced, common words and hot items among them: whatever a plain search
    of all windows confirms is found."""
    rnd = random.Random(21)
    common = [f"c{k}" for k in range(12)]
    word = lambda: rnd.choice(common) if rnd.random() < 0.5 else f"v{rnd.randrange(4000)}"
    items = [[word() for _ in range(rnd.choice([15, 30, 57]))] for _ in range(60)]
    rows = []
    for k in range(300):
        words = [word() for _ in range(rnd.randrange(30, 200))]
        if k % 2:
            i = 0 if k % 3 == 0 else rnd.randrange(60)  # a third of the passages are of one item
            share = rnd.choice([0.0, 0.1, 0.2, 0.28])
            passage = [w if rnd.random() >= share else word() for w in items[i]]
            at = rnd.randrange(len(words))
            words[at:at] = passage
        rows.append((k, " ".join(words)))
    benchmark = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    settings = decontaminate.Settings()
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(spark, make(rows), benchmark, settings).collect()}
    count = {}
    for _, text in rows:
        for w in set(text.split()):
            count[w] = count.get(w, 0) + 1

    def plain(text, item):
        """Any window of the item's length and half of it on either side."""
        words = text.split()
        window = 1 << max(3, (len(item) - 1).bit_length())
        code = {w: k for k, w in enumerate(dict.fromkeys(item))}
        target = np.array([code[w] for w in item])
        for at in range(-window // 2, len(words), window // 4):
            part = words[max(0, at - window // 2): at + window + window // 2]
            if sum(w in code for w in part) < settings.min_lcs * len(item):
                continue
            share = decontaminate.common_subsequence(target, np.array([code.get(w, -1) for w in part]))[0] / len(item)
            if share >= 0.72:
                return True
        return False

    expected = {(k, i) for k, text in rows for i, item in enumerate(items) if plain(text, item)}
    assert len(expected) > 100 and len(expected - found) <= 0.02 * len(expected)


# ----------------------------------------------------------------------------------------------- Markov model


def plain_forward(model, classes):
    state, total = None, 0.0
    for c in classes:
        state = (model.start if state is None else state @ model.move) * model.emit[:, c]
        total += math.log(state.sum())
        state = state / state.sum()
    return total


def test_recursions_equal_enumeration():
    rng = np.random.default_rng(5)
    share = lambda x: x / x.sum(axis=-1, keepdims=True)
    model = markov_model.Model(share(rng.random(3)), share(rng.random((3, 3))), share(rng.random((3, 5))), {})
    lengths = np.array([5, 3, 3, 1])
    starts = np.cumsum(lengths) - lengths
    classes = rng.integers(0, 5, lengths.sum())
    total = markov_model.forward(model, starts, lengths, classes)[0]
    counts = (np.zeros(3), np.zeros((3, 3)), np.zeros((3, 5)))
    markov_model.expect(model, starts, lengths, classes, counts)
    start, move, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((3, 5))
    import itertools
    for k, (s, n) in enumerate(zip(starts, lengths)):
        seen = classes[s:s + n]
        paths = list(itertools.product(range(3), repeat=int(n)))
        weight = np.array([model.start[p[0]] * np.prod([model.move[a, b] for a, b in zip(p, p[1:])])
                           * np.prod([model.emit[x, c] for x, c in zip(p, seen)]) for p in paths])
        assert abs(total[k] - math.log(weight.sum())) < 1e-9
        for p, w in zip(paths, weight / weight.sum()):
            start[p[0]] += w
            for a, b in zip(p, p[1:]):
                move[a, b] += w
            for x, c in zip(p, seen):
                emit[x, c] += w
    assert np.allclose(counts[0], start) and np.allclose(counts[1] * model.move, move) and np.allclose(counts[2], emit)


def test_scores_and_base_figures(spark, make, odd, empty):
    rnd = random.Random(9)
    rows = []
    for k in range(120):  # two vocabularies: a state for each makes texts more probable than single words are
        prefix = rnd.choice("ab")
        rows.append((k, " ".join(f"{prefix}{min(int(rnd.expovariate(0.3)), 30)}" for _ in range(rnd.randrange(5, 60)))))
    rows += [(500, None), (501, "NEVER seen")]
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    settings = markov_model.Settings(states=2, heads=20, tails=8, iterations=12)
    found = {r["doc_id"]: r for r in markov_model.fit_and_score(
        make(rows), held, shared_folder(spark, "hmm-test"), settings).collect()}
    split = {k: WORD.findall((t or "").lower()) + ["\n"] for k, t in rows}
    counts = collections.Counter(w for k, ws in split.items() if zlib.crc32(str(k).encode()) % 7 != 2 for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    for k, ws in split.items():
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in ws)
        assert abs(found[k]["base_score"] - base) < 1e-9
        assert (found[k]["n_tokens"], found[k]["n_known"], found[k]["train_tokens"]) == (
            len(ws), sum(counts[w] > 0 for w in ws), total)
    held_out = [r for r in found.values() if r["held_out"] and r["doc_id"] < 500]
    assert sum(r["score"] for r in held_out) > sum(r["base_score"] for r in held_out)
    assert markov_model.fit_and_score(odd, held, shared_folder(spark, "hmm-test"), settings).count() == len(ODD)
    assert markov_model.fit_and_score(empty, held, shared_folder(spark, "hmm-test"), settings).count() == 0
    nothing = markov_model.fit_and_score(make([(1, "a b")]), F.lit(True), shared_folder(spark, "hmm-test"), settings)
    assert nothing.first()["train_tokens"] == 0 and math.isfinite(nothing.first()["score"])


def test_blocks_of_the_benchmark_close_before_they_hold_too_many_words(spark):
    rows = [(k, " ".join(f"w{k}x{j}" for j in range(30)) + " shared") for k in range(7)]
    benchmark = spark.createDataFrame(rows, "item_id long, text string").coalesce(1)
    blocks = list(decontaminate.benchmark_items(benchmark, decontaminate.Settings(max_words=100)))
    assert [[i.item_id for i in items] for _, items in blocks] == [[0, 1, 2], [3, 4, 5], [6]]
    for vocabulary, items in blocks:
        assert {c for i in items for c in i.words.tolist()} == set(range(len(vocabulary))) and len(vocabulary) <= 100
    with pytest.raises(ValueError):
        list(decontaminate.benchmark_items(benchmark, decontaminate.Settings(max_words=30)))
