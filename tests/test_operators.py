"""Operators against brute force, and the shape of the plans."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from ledgerlens import schemas
from ledgerlens.operators.joins import find_hot_keys, lookup_join
from ledgerlens.operators.prefix import positions, running_totals
from ledgerlens.operators.quality import orphans
from ledgerlens.operators.sweep import Trailing, TrailingDistinct, trailing_frames, trailing_max
from ledgerlens.plans import kpis, model
from ledgerlens.sources.layout import Layout
from ledgerlens.session import shared_folder


@pytest.fixture(scope="module")
def hot(spark):
    """1,200 rows over three weeks; a third of them in one key, many in the same second, some without key."""
    rnd = random.Random(7)
    rows = []
    for i in range(1200):
        key = "hot" if i % 3 == 0 else rnd.choice(["a", "b", "c", None])
        second = rnd.choice([rnd.randrange(3 * 604_800), rnd.randrange(40) * 43_200])
        rows.append((f"{i:04d}", key, second, rnd.randrange(1, 50), rnd.choice(["x", "y", "z", None])))
    return spark.createDataFrame(rows, "id string, k string, s bigint, v bigint, m string").cache()


@pytest.mark.parametrize("seconds", [1, 3600, 86_400, 604_800])
def test_trailing_frames_equal_range_windows(hot, seconds):
    ours = trailing_frames(hot, "k", "s", {
        "n": Trailing(F.lit(1).cast("long"), seconds), "total": Trailing(F.col("v"), seconds),
        "kinds": TrailingDistinct(F.col("m"), seconds), "week": Trailing(F.col("v"), 604_800)})
    w = Window.partitionBy("k").orderBy("s").rangeBetween(-seconds, 0)
    week = Window.partitionBy("k").orderBy("s").rangeBetween(-604_800, 0)
    plain = hot.select("k", "s", F.count("id").over(w).alias("n"), F.sum("v").over(w).alias("total"),
                       F.size(F.collect_set("m").over(w)).cast("long").alias("kinds"),
                       F.sum("v").over(week).alias("week")).distinct()
    assert ours.count() == plain.count()
    assert ours.exceptAll(plain).count() == 0


def test_moves_of_trailing_frames_carry_a_value_once(hot):
    value = F.col("v")
    frames = trailing_frames(hot, "k", "s", {f"total_{n}": Trailing(value, n) for n in (10, 3600, 86_400)})
    plan = frames._jdf.queryExecution().executedPlan().toString()
    moved = [line.split("Generate inline(")[1] for line in plan.splitlines() if "Generate inline(" in line][0]
    # an entry and an exit for each of three lengths, with one value (before: two more exits' worth and three values)
    assert moved.count("_shift,") == 4 and moved.count("_value_0,") == 4 and "_value_1" not in moved
    run = hot.sparkSession.createDataFrame(hot.collect(), hot.schema)
    frames = trailing_frames(run, "k", "s", {"total": Trailing(value, 10)})
    query = frames._jdf.queryExecution()
    query.toRdd().count()
    final = query.executedPlan().toString().split("Initial Plan")[0]
    # the totals of the days come from the rows as they were moved for the running totals
    assert any("ReusedExchange" in line and "REPARTITION_BY_COL" in line for line in final.splitlines())


def test_trailing_max_equals_range_window(hot):
    values = hot.withColumn("v", F.col("v").cast("double")).where("k is not null")
    w = Window.partitionBy("k").orderBy("s").rangeBetween(-7 * 86_400, 0)
    plain = values.select("k", "s", F.max("v").over(w).alias("top")).distinct()
    assert trailing_max(values, "k", "s", "v", 7, "top").exceptAll(plain).count() == 0


def test_running_totals_and_positions_equal_plain_windows(hot):
    leveled = hot.withColumn("day", F.floor(F.col("s") / 86_400))
    plain = leveled.withColumn("v", F.sum("v").over(
        Window.partitionBy("k").orderBy("s").rangeBetween(Window.unboundedPreceding, 0)))
    ours = running_totals(leveled, ["k"], ["day", "s"], ["v"])
    assert ours.select(plain.columns).exceptAll(plain).count() == 0
    ranked = positions(leveled, ["k"], ["day", "s"], "id")
    expected = leveled.withColumn("position", F.row_number().over(
        Window.partitionBy("k").orderBy("day", "s", "id")).cast("long"))
    assert ranked.select(expected.columns).exceptAll(expected).count() == 0


def test_lookup_join_keeps_every_row(hot):
    lookup = hot.sparkSession.createDataFrame([("hot", 1), ("a", 2), ("zz", 3)], "k string, extra int")
    plain = hot.join(lookup, "k", "left")
    keys = find_hot_keys(hot, "k", 0.3)
    assert [r.k for r in keys.collect()] == ["hot"]
    for out in (lookup_join(hot, lookup, "k", "id"), lookup_join(hot, lookup, "k", "id", hot_keys=keys)):
        assert out.count() == 1200
        assert out.select(plain.columns).exceptAll(plain).count() == 0


def test_orphans_count_rows_and_keys(spark):
    tables = {"a": spark.createDataFrame([("1",), ("1",), ("9",), ("9",), (None,)], "fk string"),
              "b": spark.createDataFrame([("1",)], "pk string")}
    row = orphans(tables, [("a", "fk", "b", "pk")]).first()
    assert (row.referencing_rows, row.orphan_rows, row.orphan_keys) == (4, 2, 1)


def test_exact_split_shares(spark):
    rows = spark.range(1003).select(F.col("id").cast("string").alias("transaction_id"),
                                    (F.col("id") % 5 == 0).cast("int").alias("label"))
    counts = {(r.label, r.split): r["count"] for r in model.split_exact(rows).groupBy("label", "split").count().collect()}
    assert counts == {(0, "train"): 641, (0, "test"): 161, (1, "train"): 160, (1, "test"): 41}


# ------------------------------------------------------------------------------- storage and plans


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_date_filter_prunes_partitions(spark, folder):
    enriched = entry_point._warehouse(spark, folder).gold("transactions_enriched")
    text = plan(kpis.hourly(kpis.in_period(enriched, "2024-01-15", "2024-01-15")))
    assert "PartitionFilters: [isnotnull(txn_date" in text
    assert "ReadSchema: struct<txn_hour:int,is_fraud:int>" in text


@pytest.mark.parametrize("name", ["gold_transactions_enriched", "gold_ml_features", "rule_alerts", "case_queue",
                                  "roc_auc", "counterparty_risk", "velocity_features_extended"])
def test_no_cross_product_and_no_single_task_window(spark, folder, name):
    text = plan(entry_point.queries()[name](spark, folder))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "Exchange SinglePartition" not in text or name == "roc_auc"  # its last aggregate is one row


def test_large_sides_are_not_broadcast(spark, folder):
    """With every table above the broadcast limit, all joins of the enrichment are sort-merge joins."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(entry_point.queries()["gold_transactions_enriched"](spark, folder))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Broadcast" not in text and text.count("SortMergeJoin") >= 5
    # rows without account, customer or merchant are spread by a made-up key that the optimizer keeps
    assert text.count("SortMergeJoin [_key#") == 3


def test_frames_move_compacted_rows_once(spark, folder):
    """One window exchange for all frames, shared by the join with the carried-in totals; the
    per-second rows are computed once and reused."""
    df = entry_point.queries()["velocity_features"](spark, folder)
    df.collect()
    final = plan(df).split("== Initial Plan")[0]
    assert "ReusedExchange" in final
    assert final.count("Window [") == 2  # within days, and over the days of an account
    assert final.count("FileScan parquet") == 2  # the wide rows, and account + second + amount


def test_batch_run_counts_rows_while_writing(spark, folder):
    w = entry_point._warehouse(spark, folder)
    assert w.rows["silver.silver_transactions"] == w.silver()["transactions"].count() == 976
    assert len(w.gold("ml_features").columns) == 61 and len(w.rows) == 19
    assert set(w.raw()) == set(schemas.TABLES)


def test_refreshing_one_date_leaves_the_others(spark):
    layout = Layout(shared_folder(spark, "refresh"))
    days = spark.sql("select date'2024-01-01' as txn_date, 1 as v union all select date'2024-01-02', 2")
    assert layout.write(days, "gold", "t", "txn_date") == 2
    assert layout.refresh_dates(days.where("v = 2").withColumn("v", F.lit(5)), "gold", "t") == 1
    assert sorted(r.v for r in layout.read(spark, "gold", "t").collect()) == [1, 5]
    with pytest.raises(ValueError):
        layout.path("platinum", "t")


def test_exact_quantiles_equal_interpolated_ones(spark):
    import numpy as np

    from ledgerlens.operators.quantiles import exact_quantiles

    rng = np.random.default_rng(5)
    columns = {"a": [None if k % 7 == 0 else float(v) for k, v in enumerate(rng.normal(0, 1e4, 400))],
               "b": [5.0] * 133 + [7.0] * 267, "c": [-1e12, 1e-9] + [0.0] * 398, "d": [None] * 400}
    rows = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} double" for c in columns))
    shares = {"q1": 0.25, "median": 0.5, "p999": 0.999, "least": 0.0, "most": 1.0}
    found = {r.feature: r for r in exact_quantiles(rows, list(columns), shares).collect()}
    assert set(found) == {"a", "b", "c"}
    for c, r in found.items():
        values = [v for v in columns[c] if v is not None]
        assert [r[k] for k in shares] == pytest.approx([float(np.quantile(values, q)) for q in shares.values()], rel=1e-12)


def test_one_row_a_key_moves_the_input_once(spark):
    from ledgerlens.operators.dedup import keep_one

    rows = spark.range(3000).selectExpr("if(id % 3 = 0, 1, id) as k", "id % 5 as v", "if(id % 2 = 0, null, id) as w")
    plan = keep_one(rows, "k", ["v"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("WindowGroupLimit") == 2  # below the shuffle and after it
    best = {}
    for r in rows.collect():
        rank = (r.v, r.w is not None, r.w or 0)
        best[r.k] = max(best.get(r.k, rank), rank)
    got = {r.k: (r.v, r.w is not None, r.w or 0) for r in keep_one(rows, "k", ["v"]).collect()}
    assert got == best


def test_network_risk_on_hand_made_graphs(spark):
    from ledgerlens.plans.network import network_risk
    from ledgerlens.session import shared_folder

    shared_folder(spark, "checkpoints")
    pay = lambda *edges: spark.createDataFrame(
        [(a, c, 1.0, f) for a, c, f in edges], "account_id string, counterparty_id string, amount double, is_fraud int")
    risk = lambda df, **k: {r.account_id: r.exposure for r in network_risk(df, **k).collect()}
    chain = pay(("a", "b", 0), ("b", "c", 0), ("c", "d", 0), ("d", None, 1), ("a", "x", 0))
    assert risk(chain, hops=1) == {"a": 0, "b": 0, "c": 0.5, "d": 1, "x": 0}
    assert risk(chain, hops=3) == {"a": 0.0625, "b": 0.25, "c": 0.5, "d": 1, "x": 0}
    ring = pay(("a", "b", 1), ("b", "a", 0))  # a = 1 + b / 2, b = a / 2
    assert risk(ring) == {"a": pytest.approx(4 / 3, abs=1e-6), "b": pytest.approx(2 / 3, abs=1e-6)}
    hub = pay(*[(f"p{k}", "hub", 0) for k in range(300)], *[(f"p{k}", f"q{k}", 0) for k in range(300)], ("hub", None, 1))
    found = risk(hub, hops=2)
    assert {found[f"p{k}"] for k in range(300)} == {0.25} and found["hub"] == 1
    assert risk(pay(("a", None, 0))) == {}
    with pytest.raises(ValueError):
        network_risk(chain, damping=1.0)


def test_day_sketches_count_periods_within_their_bound(spark):
    from ledgerlens.plans import distincts

    rows = spark.range(400_000).selectExpr(
        "date_add(date'2024-01-01', cast(id % 60 as int)) as txn_date", "cast(xxhash64(id) % 90000 as string) as account_id",
        "cast(id % 7 as string) as merchant_id", "cast(null as string) as device_id", "cast(id % 10 = 0 as int) as is_fraud")
    days = distincts.daily_sketches(rows).cache()
    assert days.count() == 60
    for start, end in ((None, None), ("2024-01-10", "2024-02-09"), ("2024-02-01", None)):
        got = distincts.period_counts(days, start=start, end=end).first()
        part = rows.where(f"txn_date >= '{start or '2000-01-01'}' and txn_date <= '{end or '2100-01-01'}'")
        exact = part.selectExpr("count(distinct account_id) as a", "count(distinct if(is_fraud = 1, account_id, null)) as f",
                                "count(*) as n").first()
        bound = 3 * distincts.standard_error()
        assert abs(got.accounts - exact.a) <= bound * exact.a and abs(got.affected_accounts - exact.f) <= bound * exact.f
        assert (got.merchants, got.devices, got.transactions) == (7, 0, exact.n)
    assert distincts.period_counts(days, "txn_date", start="2030-01-01").count() == 0


def test_refresh_equals_a_full_rebuild_and_leaves_other_days_alone(spark, folder):
    """Inserts, late rows, altered and deleted rows, and a day that goes as a whole."""
    from pathlib import Path

    from ledgerlens.plans import features, refresh

    full = entry_point._warehouse(spark, folder).gold("transactions_enriched")
    days = [r.txn_date for r in full.select("txn_date").distinct().orderBy("txn_date").collect()]
    layout = Layout(shared_folder(spark, "refresh"))
    store = lambda df: layout.write(df, "gold", "gold_transactions_enriched", "txn_date")
    store(full)
    layout.write(features.ml_features(layout.read(spark, "gold", "gold_transactions_enriched")), "gold", "gold_ml_features",
                 "txn_date")
    files = lambda table: {str(p): p.stat().st_mtime_ns for p in Path(layout.path("gold", table)).rglob("*.parquet")}
    assert refresh.refresh(spark, layout, full) == refresh.Refreshed((), ())
    before = files("gold_ml_features"), files("gold_transactions_enriched")

    deleted, altered, late = days[3], days[12], days[13]
    new = full.where(F.col("txn_date") != F.lit(deleted)).withColumn(
        "amount", F.when(F.col("txn_date") == F.lit(altered), F.col("amount") + 0.004).otherwise(F.col("amount")))
    copies = full.where(F.col("txn_date") == F.lit(late)).limit(5).withColumn(
        "transaction_id", F.concat(F.lit("LATE"), "transaction_id"))
    new = new.where((F.col("txn_date") != F.lit(late)) | (F.xxhash64("transaction_id") % 4 != 0)).unionByName(copies)
    done = refresh.refresh(spark, layout, new)
    assert set(done.changed) == {deleted, altered, late}
    assert set(done.recomputed) == {d for d in days if d != deleted and any(0 <= (d - c).days <= 7 for c in done.changed)}
    assert deleted not in done.recomputed and len(done.recomputed) < len(days) - 1
    expected = features.ml_features(new)
    got = layout.read(spark, "gold", "gold_ml_features").select(expected.columns)
    assert got.count() == expected.count() and got.exceptAll(expected).count() == 0
    stored = layout.read(spark, "gold", "gold_transactions_enriched").select(new.columns)
    assert stored.count() == new.count() and stored.exceptAll(new).count() == 0
    after = files("gold_ml_features"), files("gold_transactions_enriched")
    for old, now, kept in ((before[0], after[0], set(days) - set(done.recomputed) - {deleted}),
                           (before[1], after[1], set(days) - set(done.changed))):
        untouched = {p: t for p, t in old.items() if any(f"txn_date={d}/" in p for d in kept)}
        assert untouched and all(now.get(p) == t for p, t in untouched.items())


def test_quantiles_move_only_the_slices_they_lie_in(spark):
    from ledgerlens.operators.quantiles import exact_quantiles, held_slices

    values = [float(v) for v in np.random.default_rng(4).lognormal(3, 2, 4000)] + [-1.5, 0.0, None, None]
    rows = spark.createDataFrame([(v, 7) for v in values], "x double, same int")
    shares = {"low": 0.1, "median": 0.5, "top": 1.0}
    got = {r.feature: (r.low, r.median, r.top) for r in exact_quantiles(rows, ["x", "same"], shares).collect()}
    known = [v for v in values if v is not None]
    assert got["x"] == pytest.approx(tuple(np.quantile(known, list(shares.values()))), rel=1e-12)
    assert got["same"] == (7.0, 7.0, 7.0)
    valued = rows.where("x is not null").selectExpr(
        "'x' as feature", "x as value", "floor(signum(x) * log1p(abs(x)) * 200) as slice")
    held = held_slices(valued, shares, "feature")
    assert held.count() <= 6 and valued.join(held, "slice").count() < 100


def test_parquet_tables_are_packed_with_zstd(spark):
    import pyarrow.parquet as pq

    layout = Layout(shared_folder(spark, "packed"))
    assert layout.write(spark.range(100), "gold", "gold_numbers") == 100
    files = layout.read(spark, "gold", "gold_numbers").inputFiles()
    groups = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in files]
    assert {g.row_group(0).column(0).compression for g in groups if g.num_rows} == {"ZSTD"}
