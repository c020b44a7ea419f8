"""Near vectors against all pairs."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import near_vectors
from ledgerlens.session import shared_folder

ROWS = "vec_id long, embedding array<double>"


def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def plain(rows, similarity=0.9):
    """All pairs; vectors are scaled first so that their squares neither overflow nor vanish."""
    good = [k for k, (_, v) in enumerate(rows) if usable(v)]
    parent, degree = list(range(len(rows))), [0] * len(rows)

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    by_length = {}
    for k in good:
        by_length.setdefault(len(rows[k][1]), []).append(k)
    for own in by_length.values():
        x = np.array([rows[k][1] for k in own], float)
        x /= np.abs(x).max(axis=1)[:, None]
        x /= np.linalg.norm(x, axis=1)[:, None]
        for i, j in zip(*np.nonzero(np.triu(x @ x.T >= similarity, 1))):
            degree[own[i]] += 1
            degree[own[j]] += 1
            parent[top(own[i])] = top(own[j])
    smallest = {}
    for k, (n, _) in enumerate(rows):
        if n is not None:
            smallest[top(k)] = min(smallest.get(top(k), n), n)
    return sorted(((n, degree[k], smallest.get(top(k)), n is not None and n == smallest[top(k)])
                   for k, (n, _) in enumerate(rows)), key=str)


def found(spark, frame, **options):
    return sorted(map(tuple, near_vectors.group(spark, frame, shared_folder(spark, "vectors"), **options).collect()), key=str)


def cluster(rng, count, spread, length=32):
    centre = rng.standard_normal(length)
    return (centre / np.linalg.norm(centre) + spread * rng.standard_normal((count, length)) / math.sqrt(length)).tolist()


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(1)
    # tight groups, groups whose pairs lie on both sides of the threshold, a hot group of copies, strangers
    vectors = sum((cluster(rng, *x) for x in ((300, .15), (200, .35), (250, .5), (50, .25))), [])
    vectors += [vectors[0]] * 50 + rng.standard_normal((150, 32)).tolist()
    vectors += [[-0.0] * 32, [0.0] * 32, None, [], [math.nan] * 32, [math.inf] + [0.0] * 31, [None] * 32, [1.0, None],
                [1.0, 2.0], [2.0, 4.0], [1e200] * 32, [1e-300] * 32]
    return [(k if k % 97 else None, v) for k, v in enumerate(vectors)] + [(5, vectors[7]), (5, vectors[7]), (5, vectors[400])]


@pytest.mark.parametrize("crowd, block", [(64, 1024), (8, 1024), (20, 64), (10 ** 9, 50)])
def test_equals_all_pairs(spark, rows, crowd, block, monkeypatch):
    monkeypatch.setattr(near_vectors, "BLOCK", block)
    frame = spark.createDataFrame(rows, ROWS).repartition(5)
    assert found(spark, frame, crowd=crowd) == plain(rows)


def test_crowded_groups_become_cells(spark):
    rng = np.random.default_rng(4)
    rows = list(enumerate(cluster(rng, 600, .12) + rng.standard_normal((600, 32)).tolist()))
    root = shared_folder(spark, "vectors")
    near_vectors.group(spark, spark.createDataFrame(rows, ROWS), root).count()
    cells = spark.read.parquet(f"{root}/cells")
    assert cells.agg(F.max("size")).first()[0] > 400  # one cell holds most of the group
    assert spark.read.parquet(f"{root}/decided").count() < 5_000  # and its 180,000 pairs were never written


def test_recall_at_the_threshold():
    """Pairs at the very threshold meet about as often as planned."""
    rng = np.random.default_rng(2)
    x = rng.standard_normal((3000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y = rng.standard_normal((3000, 64))
    y -= (x * y).sum(axis=1)[:, None] * x
    y = 0.9 * x + math.sqrt(1 - 0.81) * y / np.linalg.norm(y, axis=1)[:, None]
    for vectors in (1_000, 50_000):
        plan = near_vectors.Tables.planned(vectors, 0.9, 0.99, 16.0)
        meets = np.mean([(plan.buckets(x[k: k + 500]) == plan.buckets(y[k: k + 500])).any(axis=1).mean()
                         for k in range(0, 3000, 500)])
        assert meets > 0.97


def test_other_thresholds_empty_and_clashing(spark):
    rng = np.random.default_rng(3)
    rows = list(enumerate(cluster(rng, 80, .6) + cluster(rng, 40, .3)))
    frame = spark.createDataFrame(rows, ROWS).withColumns({c: F.lit("x") for c in (
        "key", "node", "cell", "unit", "vector", "n", "id", "bucket", "kept", "component", "label")})
    assert found(spark, frame, similarity=0.8) == plain(rows, 0.8)
    assert found(spark, spark.createDataFrame([], ROWS)) == []
    assert found(spark, spark.createDataFrame([(1, None), (None, [0.0])], ROWS)) == [(1, 0, 1, True), (None, 0, None, False)]
