"""Manifest trees against a plain construction."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import manifest, queries
from ledgerlens.session import shared_folder

ROWS = "doc_id long, source string, lang string, n_chars long, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, n_chars):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:3], n_chars, row[4])))


def tree(leaves, arity=2):
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[k: k + arity])) for k in range(0, len(last), arity)])
    return levels


def path(levels, place, arity=2):
    for level in levels[:-1]:
        first = place // arity * arity
        yield "".join(level[first: place]), "".join(level[place + 1: first + arity])
        place //= arity


def plain(rows, arity=2):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    order = lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[3]))
    own = {x: sorted((r for r in rows if r[2] == x), key=order) for x in langs}
    trees = {x: tree([leaf(r, r[3]) for r in own[x]], arity) for x in langs}
    top = tree([trees[x][-1][0] for x in langs], arity)
    out = []
    for k, lang in enumerate(langs):
        for place, row in enumerate(own[lang]):
            proof = [*path(trees[lang], place, arity), *path(top, k, arity)]
            hit = row[0] is not None and row[3] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            folded = leaf(row, row[3] + hit if hit else row[3])
            for before, after in proof:
                folded = sha(before + folded + after)
            out.append((row[0], leaf(row, row[3]), trees[lang][-1][0], top[-1][0],
                        sha("".join(a + b for a, b in proof)), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def rows_of(count, seed=2):
    rnd = random.Random(seed)
    return [(rnd.choice([None, rnd.randrange(200)]) if k % 9 == 0 else k, rnd.choice(["s", None]),
             rnd.choice(["en", "en", "en", "de", None, "é", "z", ""]), rnd.choice([None, 5, -1]),
             rnd.choice([None, "", "x", "é日"])) for k in range(count)]


def built(spark, frame, **options):
    found = manifest.manifest(spark, frame, shared_folder(spark, "manifest"), claimed=queries.tampered_fields(), **options)
    return sorted((tuple(r)[:7] for r in found.collect()), key=str)


@pytest.mark.parametrize("count, levels, arity", [(0, 12, 2), (1, 12, 2), (2, 1, 2), (7, 1, 2), (60, 2, 2), (300, 3, 2),
                                                  (300, 12, 2), (100, 2, 3)])
def test_equals_plain_trees(spark, count, levels, arity):
    rows = rows_of(count)
    frame = spark.createDataFrame(rows, ROWS).repartition(3)
    assert built(spark, frame, levels=levels, arity=arity) == plain(rows, arity)


def test_one_hot_tree_repeated_rows_and_clashing_columns(spark):
    rows = [(k // 3, "s", "en", 1, "same") for k in range(90)] + [(None, None, None, None, None)] * 20 + [(5, "s", "de", 1, "x" * 300_000)]
    frame = spark.createDataFrame(rows, ROWS).repartition(4).withColumns({c: F.lit("x") for c in (
        "name", "digest", "tree", "place", "nodes", "block", "nth", "part", "rank", "claim", "leaf", "root", "start")})
    assert built(spark, frame, levels=2) == plain(rows)


def test_proofs_lead_to_the_root(spark):
    frame = spark.createDataFrame(rows_of(50), ROWS)
    for r in manifest.manifest(spark, frame, shared_folder(spark, "manifest"), with_proofs=True, levels=2).collect():
        assert r["verified"] and manifest.fold(r["leaf"], zip(r["befores"], r["afters"])) == r["root"]
        assert manifest.fold(sha("other"), zip(r["befores"], r["afters"])) != r["root"]


def test_lost_order_of_messages_is_noticed():
    leaves = [sha(str(k)) for k in range(11)]
    nodes = manifest.forward(leaves, 2, 4)
    assert nodes[4, 0] == tree(leaves)[-1][0]
    proofs = dict(manifest.reverse(nodes, 2, 4, []))
    assert proofs == {k: list(path(tree(leaves), k)) for k in range(11)}
