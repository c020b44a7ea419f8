"""Streams against their batch twins, in one and in several micro-batches, and after a restart."""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from ledgerlens import schemas
from ledgerlens.operators.joins import lookup_join
from ledgerlens.plans.features import VELOCITY_COLUMNS
from ledgerlens.plans.features import velocity as batch_velocity
from ledgerlens.plans.rules import rule_alerts, rule_inputs
from ledgerlens.session import shared_folder
from ledgerlens.sources.layout import Layout
from ledgerlens.streaming import alerts, history, ingest, transactions, velocity


@pytest.fixture(scope="module")
def warehouse(spark, folder):
    return entry_point._warehouse(spark, folder)


@pytest.fixture(scope="module")
def in_order(spark, warehouse):
    """Raw transactions as one file per week, written in order of time."""
    layout = Layout(shared_folder(spark, "ordered"))
    raw = warehouse.raw()["transactions"]
    for low, high in (("2024-01-01", "2024-01-08"), ("2024-01-08", "2024-01-15"), ("2024-01-15", "2024-02-01")):
        raw.where((F.col("txn_date") >= low) & (F.col("txn_date") < high)).coalesce(1).write.mode("append").parquet(
            layout.path("bronze", "transactions"))
    return layout


def land(spark, stream):
    root = shared_folder(spark, "t")
    ingest.finish([ingest.land(stream, f"{root}/out", f"{root}/checkpoint")])
    return spark.read.schema(stream.schema).parquet(f"{root}/out"), f"{root}/out"


def test_clean_stream_in_several_batches_equals_batch(spark, warehouse, in_order):
    out, _ = land(spark, transactions.clean(ingest.open_stream(spark, in_order, "transactions", 1)))
    batch = warehouse.silver()["transactions"].drop("_silver_load_ts")
    got = out.select(batch.columns)
    assert got.count() == batch.count() and got.exceptAll(batch).count() == 0


def test_exact_velocity_in_several_batches_equals_batch(spark, warehouse):
    silver, path = warehouse.silver()["transactions"], shared_folder(spark, "landed")
    for low, high in (("2024-01-01", "2024-01-08"), ("2024-01-08", "2024-01-15"), ("2024-01-15", "2024-02-01")):
        silver.where((F.col("txn_date") >= low) & (F.col("txn_date") < high)).coalesce(1).write.mode("append").parquet(path)
    frames, _ = land(spark, velocity.exact(ingest.follow(spark, path, silver.schema, 1)))
    batch = warehouse.gold("ml_features").select("account_id", F.col("txn_ts_unix").alias("second"), *VELOCITY_COLUMNS)
    rounded = [c for c in VELOCITY_COLUMNS if c.startswith("amount")]
    tidy = lambda df: df.select("account_id", "second", *[
        F.round(c, 6).alias(c) if c in rounded else c for c in VELOCITY_COLUMNS]).distinct()
    assert frames.count() == tidy(batch).count()
    assert tidy(frames).exceptAll(tidy(batch)).count() == 0


def test_exact_velocity_keeps_late_rows(spark):
    path = shared_folder(spark, "landed")
    schema = "account_id string, txn_datetime timestamp, amount double"
    for moments in (["10:00:00", "12:00:00"], ["11:30:00"], ["12:00:00", "12:10:00"]):
        spark.createDataFrame([("A", m, 5.0) for m in moments], "account_id string, m string, amount double").selectExpr(
            "account_id", "timestamp('2024-01-01 ' || m) as txn_datetime", "amount").coalesce(1).write.mode("append").parquet(path)
    frames, _ = land(spark, velocity.exact(ingest.follow(spark, path, schema, 1)))
    rows = [(r.txn_count_1h, r.txn_count_24h, r.amount_sum_24h) for r in frames.orderBy("second", "txn_count_24h").collect()]
    # 10:00, 11:30 (late, sees 10:00), 12:00 as first known, 12:00 again with the late one, 12:10
    assert rows == [(1, 1, 5.0), (1, 2, 10.0), (1, 2, 10.0), (3, 4, 20.0), (4, 5, 25.0)]


def test_late_rows_are_dropped_from_closed_windows(spark):
    layout = Layout(shared_folder(spark, "late"))

    def deliver(i, moment):
        spark.createDataFrame([(f"T{i}", "A", 10.0, moment, moment[:10], 12, "Completed")],
                              "transaction_id string, account_id string, amount double, txn_datetime string, "
                              "txn_date string, txn_hour int, status string").coalesce(1).write.mode("append").parquet(
            layout.path("bronze", "transactions"))

    out = shared_folder(spark, "late-out")
    for i, moment in enumerate(["2024-01-01 10:00:00", "2024-01-01 20:00:00", "2024-01-01 10:30:00", "2024-01-02 09:00:00"]):
        deliver(i, moment)
        stream = velocity.windowed(transactions.clean(ingest.open_stream(spark, layout, "transactions")), "1 hour", None)
        ingest.finish([ingest.land(stream, f"{out}/table", f"{out}/checkpoint")])  # resumes from the checkpoint
    rows = spark.read.schema(stream.schema).parquet(f"{out}/table").orderBy("window_start").collect()
    assert [(r.window_start.hour, r.txn_count) for r in rows] == [(10, 1), (20, 1)]


def test_restart_takes_nothing_twice(spark, warehouse):
    target, checkpoints = Layout(shared_folder(spark, "again")), shared_folder(spark, "again")
    for _ in range(2):
        paths = ingest.ingest(spark, warehouse.layout, target, checkpoints, ["customers", "alerts"])
    assert spark.read.parquet(paths["customers"]).count() == warehouse.rows["bronze.customers"]
    assert spark.read.parquet(paths["alerts"]).count() == warehouse.rows["bronze.alerts"]


def expected_alerts(warehouse):
    return rule_alerts(rule_inputs(warehouse.gold("ml_features"), warehouse.raw()["merchants"]))


def test_alert_stream_equals_batch_rules_with_restarts(spark, warehouse):
    """The whole rule book; a run for each week, each from the checkpoint of the one before."""
    root, silver = shared_folder(spark, "alerts"), warehouse.silver()
    static = {k: v.drop("_silver_load_ts") for k, v in silver.items()}
    rows = static["transactions"].withColumn("landed_at", F.col("txn_datetime"))
    hot = transactions.hot_keys_of(static["transactions"])
    for low, high in (("2024-01-01", "2024-01-08"), ("2024-01-08", "2024-01-15"), ("2024-01-15", "2024-02-01")):
        rows.where((F.col("txn_date") >= low) & (F.col("txn_date") < high)).coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = transactions.enrich(ingest.follow(spark, f"{root}/in", rows.schema, 1), static, hot_keys=hot)
        inputs = alerts.inputs(stream, warehouse.raw()["merchants"])
        ingest.finish([alerts.alert_stream(inputs, f"{root}/t", f"{root}/c")])
    got, expected = spark.read.parquet(f"{root}/t").drop("batch_id"), expected_alerts(warehouse)
    assert {r.rule_id for r in expected.select("rule_id").distinct().collect()} >= {"R103", "R108"}
    assert got.count() == expected.count() and got.exceptAll(expected).count() == 0


MOMENTS = "account_id string, m string, landed string, device_id string, is_declined boolean, transaction_id string"


def deliver(spark, path, *rows):
    spark.createDataFrame([(*r, f"T{r[1]}{k}") for k, r in enumerate(rows)], MOMENTS).selectExpr(
        "transaction_id", "account_id", "timestamp(m) as txn_datetime", "timestamp(landed) as landed_at", "device_id",
        "is_declined", "5.0D as amount").coalesce(1).write.mode("append").parquet(path)


def state_of(spark, checkpoint, variable):
    return spark.read.format("statestore").option("stateVarName", variable).load(checkpoint)


def test_facts_of_history_across_batches(spark):
    root = shared_folder(spark, "facts")
    for day, device, declined in (("01", "x", True), ("02", "x", True), ("02", "y", True), ("03", None, False), ("03", "y", True)):
        deliver(spark, f"{root}/in", ("A", f"2024-01-{day} 10:00:00", f"2024-01-{day} 11:00:00", device, declined))
    deliver(spark, f"{root}/in", ("A", "2024-02-20 10:00:00", "2024-02-20 11:00:00", "x", True),
            ("B", "2024-02-20 10:00:00", "2024-02-20 11:00:00", "x", None))
    deliver(spark, f"{root}/in", *[("C", f"2024-02-21 10:00:{k:02}", "2024-02-21 11:00:00", "x", False) for k in range(7)])
    schema = spark.read.parquet(f"{root}/in").schema
    found, _ = land(spark, history.facts(ingest.follow(spark, f"{root}/in", schema, 1), ["amount"]))
    rows = sorted((r.account_id, str(r.transaction_id)[1:11], r.is_new_device, r.is_after_long_gap, r.declines_24h or 0)
                  for r in found.where("account_id != 'C'").collect())
    burst = found.where("account_id = 'C'").orderBy("transaction_id").collect()
    assert [r.is_high_velocity for r in burst] == [0, 0, 0, 0, 0, 1, 1]
    assert rows == sorted([("A", "2024-01-01", False, False, 1), ("A", "2024-01-02", False, False, 2),
                           ("A", "2024-01-02", True, False, 3), ("A", "2024-01-03", True, False, 0),
                           ("A", "2024-01-03", False, False, 3), ("A", "2024-02-20", False, True, 1),
                           ("B", "2024-02-20", False, False, 0)])


def test_idle_accounts_leave_the_state_and_busy_days_stay(spark):
    root = shared_folder(spark, "idle")
    for day in ("2024-01-01", "2024-01-02", "2024-02-10", "2024-02-11"):
        deliver(spark, f"{root}/in", ("Busy", f"{day} 10:00:00", f"{day} 11:00:00", "x", False),
                *[("Idle", f"{day} 10:00:00", f"{day} 11:00:00", "x", False)] * (day < "2024-01-02"))
    schema = spark.read.parquet(f"{root}/in").schema
    stream = velocity.exact(ingest.follow(spark, f"{root}/in", schema, 1))
    ingest.finish([ingest.land(stream, f"{root}/out", f"{root}/c")])
    days = {(r.key[0], r.user_map_key[0]) for r in state_of(spark, f"{root}/c", "days").collect()}
    day = lambda d: int(np.datetime64(d).astype("datetime64[D]").astype(int))
    assert days == {("Busy", day("2024-02-10")), ("Busy", day("2024-02-11"))}
    # a late row of the idle account is not dropped: it sees what is left
    deliver(spark, f"{root}/in", ("Idle", "2024-01-01 10:30:00", "2024-02-12 11:00:00", "x", False))
    ingest.finish([ingest.land(velocity.exact(ingest.follow(spark, f"{root}/in", schema, 1)), f"{root}/out", f"{root}/c")])
    idle = spark.read.schema(stream.schema).parquet(f"{root}/out").where("account_id = 'Idle'").collect()
    assert sorted(r.txn_count_1h for r in idle) == [1, 1]


def test_a_batch_writes_the_days_it_touches(spark):
    """The entry of an untouched day keeps its value; only the touched one changes."""
    root = shared_folder(spark, "days")
    deliver(spark, f"{root}/in", *[("A", f"2024-01-0{d} 10:00:00", "2024-01-09 11:00:00", "x", False) for d in range(1, 8)])
    schema = spark.read.parquet(f"{root}/in").schema
    run = lambda: ingest.finish([ingest.land(velocity.exact(
        ingest.follow(spark, f"{root}/in", schema, 1)), f"{root}/out", f"{root}/c")])
    run()
    before = {r.user_map_key[0]: r.user_map_value for r in state_of(spark, f"{root}/c", "days").collect()}
    deliver(spark, f"{root}/in", ("A", "2024-01-07 12:00:00", "2024-01-09 12:00:00", "x", False))
    run()
    after = {r.user_map_key[0]: r.user_map_value for r in state_of(spark, f"{root}/c", "days").collect()}
    assert [d for d in after if after[d] != before.get(d)] == [max(before)]


def test_hot_accounts_are_spread_by_plan_on_a_stream(spark, warehouse):
    """Every eleventh row on one account: its rows meet their lookup in many tasks."""
    static = {k: v.drop("_silver_load_ts") for k, v in warehouse.silver().items()}
    rows = static["transactions"]
    hot = rows.selectExpr("min(account_id)").first()[0]
    skewed = rows.withColumn("account_id", F.when(F.xxhash64("transaction_id") % 11 == 0, F.lit(hot)).otherwise(F.col("account_id")))
    keys = transactions.hot_keys_of(skewed)
    assert hot in {r.account_id for r in keys["account_id"].collect()}
    root = shared_folder(spark, "hot")
    skewed.write.parquet(f"{root}/in")
    plans = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in plans}
    for k, v in plans.items():
        spark.conf.set(k, v)
    try:
        def hot_rows_by_task(hot_keys):
            out = f"{root}/{'salted' if hot_keys is not None else 'plain'}"
            stream = lookup_join(ingest.follow(spark, f"{root}/in", rows.schema).select("transaction_id", "account_id"),
                                 static["accounts"].select("account_id", "status"), "account_id", "transaction_id", hot_keys)
            placed = stream.where(F.col("account_id") == hot).withColumn("task", F.spark_partition_id())
            ingest.finish([ingest.land(placed, out, f"{out}-c")])
            return [r["count"] for r in spark.read.parquet(out).groupBy("task").count().collect()]

        plain, salted = hot_rows_by_task(None), hot_rows_by_task(keys["account_id"])
        assert len(plain) == 1 and sum(salted) == plain[0]
        assert len(salted) > 1 and max(salted) < 0.5 * plain[0]
        stream = transactions.enrich(ingest.follow(spark, f"{root}/in", rows.schema), static, hot_keys=keys)
        assert "_salt" in stream._jdf.queryExecution().analyzed().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_amounts_of_any_size_equal_plain_windows(spark):
    """Cents, tenths of cents and huge amounts in one account: batch and stream against a plain frame."""
    amounts = {"A": [2e15, 0.004, 0.004, 2e15], "B": [0.004] * 5, "C": [2e15 + k for k in range(6)], "D": [None, 3.0, None],
               "E": [1e14 + 0.01 * k for k in range(5)], "F": [-2e15, 5.0, 1e19, None], "G": [17.25, 99.99, 3.1] * 9}
    rows = [(f"{a}{k}", a, v, 60 * k) for a, values in amounts.items() for k, v in enumerate(values)]
    frame = spark.createDataFrame(rows, "transaction_id string, account_id string, amount double, s long").select(
        "transaction_id", "account_id", "amount", F.timestamp_seconds("s").alias("txn_datetime"))
    path = shared_folder(spark, "amounts")
    frame.coalesce(1).write.parquet(path)
    streamed, _ = land(spark, velocity.exact(ingest.follow(spark, path, frame.schema)))
    stream = {(r.account_id, r.second): r for r in streamed.collect()}
    for r in batch_velocity(frame).collect():
        known = [Fraction(repr(v)) for v in amounts[r.account_id][: r.txn_ts_unix // 60 + 1] if v is not None]
        mean = sum(known) / len(known) if known else None
        deviation = float(sum((v - mean) ** 2 for v in known) / (len(known) - 1)) ** 0.5 if len(known) > 1 else None
        for got in (r, stream[r.account_id, r.txn_ts_unix]):
            assert got.amount_sum_24h == float(sum(known)) and got.amount_sum_1h == got.amount_sum_24h
            assert got.amount_avg_7d == (None if mean is None else pytest.approx(float(mean), rel=1e-15))
            assert got.amount_stddev_7d == (None if deviation is None else pytest.approx(deviation, rel=1e-12))


def test_rows_without_a_time_are_set_aside(spark):
    raw = spark.createDataFrame([("T1", "2024-01-01 00:00:00"), ("T2", "soon"), ("T3", None)],
                                "transaction_id string, txn_datetime string")
    assert sorted(r.transaction_id for r in transactions.without_time(raw).collect()) == ["T2", "T3"]


def test_rows_without_a_time_land_in_their_own_table(spark):
    path, root = shared_folder(spark, "raw"), shared_folder(spark, "landed")
    schema = schemas.BRONZE["transactions"]
    row = spark.range(3).selectExpr("concat('T', id) as transaction_id", "array('2024-01-01 00:00:00', 'soon', null)[id] as txn_datetime")
    full = row.select(*[F.col(f.name) if f.name in row.columns else F.lit(None).cast(f.dataType).alias(f.name)
                        for f in spark.createDataFrame([], schema).schema])
    full.withColumns({"account_id": F.lit("A"), "amount": F.lit(5.0)}).write.parquet(path)
    timed, untimed = transactions.land_clean(ingest.follow(spark, path, schema), root)
    ids = lambda p: sorted(r.transaction_id for r in spark.read.parquet(p).collect())
    assert ids(untimed) == ["T1", "T2"] and not set(ids(timed)) & {"T1", "T2"}


def test_a_future_row_leaves_other_frames_alone(spark):
    path = shared_folder(spark, "landed")
    schema = "account_id string, txn_datetime timestamp, amount double"
    for moments in (["2024-01-01 10:00:00"], ["2099-01-01 00:00:00"], ["2024-01-01 10:10:00"]):
        spark.createDataFrame([("A", m, 5.0) for m in moments], "account_id string, m string, amount double").selectExpr(
            "account_id", "timestamp(m) as txn_datetime", "amount").coalesce(1).write.mode("append").parquet(path)
    frames, _ = land(spark, velocity.exact(ingest.follow(spark, path, schema, 1)))
    assert sorted(r.txn_count_1h for r in frames.collect()) == [1, 1, 2]


def test_days_that_no_frame_can_reach_are_not_written():
    """A micro-batch over a month writes the last days of an account only; the next one removes what it passes."""
    class Days(dict):
        written, updateValue = 0, lambda self, key, value: (self.__setitem__(key, value), setattr(self, "written", self.written + 1))
        exists, getValue, removeKey = (lambda self: bool(self)), dict.__getitem__, dict.pop

    class Handle:
        days = Days()

        def getMapState(self, *_):
            return self.days

        def getValueState(self, *_):
            return None

    frames, day = velocity.Frames(lateness=86_400, idle=0), 86_400
    frames.init(Handle())

    def put(days):
        rows = pd.DataFrame({"second": [d * day + 5 for d in days], "n": 1, "amounts": 1, "total": "20000",
                             "squares": "400000000", "clock": float("nan")})
        return pd.concat(frames.handleInputRows(("a",), iter([rows]), None))

    found = put(range(19_000, 19_031))
    assert found["txn_count_7d"].tolist() == [*range(1, 8), *[8] * 24]
    assert sorted(k[0] for k in Handle.days) == list(range(19_022, 19_031)) and Handle.days.written == 9
    assert put([19_031])["txn_count_7d"].tolist() == [8]
    assert sorted(k[0] for k in Handle.days) == list(range(19_023, 19_032)) and Handle.days.written == 10
