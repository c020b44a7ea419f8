"""Small hand-made inputs around every threshold."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlens import schemas
from ledgerlens.functions.risk import model_tier, policy_action, policy_tier
from ledgerlens.functions.text import contributions, driver_text
from ledgerlens.operators import quality
from ledgerlens.plans import features, gold, insights, kpis, rules, scorecard, silver
from ledgerlens.profiles import BATCH, DECLARATIVE


def raw(spark, table, *rows):
    """Raw rows from dicts; what is not given is NULL."""
    names = [c.split()[0] for c in schemas.BRONZE[table].split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schemas.BRONZE[table])


def txn(i, **over):
    base = dict(transaction_id=f"T{i}", account_id="A1", merchant_id="M1", transaction_type="Purchase", channel="POS",
                amount=50.0, currency="USD", txn_datetime="2024-01-10 12:00:00", txn_date="2024-01-10", txn_hour=12,
                is_international=False, device_id="D1", status="Completed")
    return base | over


def test_customer_bands_and_high_risk(spark):
    scores = [24.99, 25.0, 30.0, 50.0, 60.0, 70.0, 70.01, 75.0, 75.01, 80.0, None]
    df = raw(spark, "customers", *[
        dict(customer_id=f"C{i:02d}", risk_score=v, is_pep=False, is_sanctioned=False, date_joined="2020-02-30")
        for i, v in enumerate(scores)])
    batch = silver.refine("customers", df, BATCH).orderBy("customer_id").collect()
    assert [r.risk_band for r in batch] == ["Low", "Medium", "Medium", "High", "High", "High", "High", "Critical",
                                            "Critical", "Critical", "Critical"]
    assert [r.is_high_risk for r in batch] == [False] * 8 + [True, True, None]
    assert batch[0].date_joined is None  # no such day
    other = silver.refine("customers", df, DECLARATIVE).orderBy("customer_id").collect()
    assert [r.risk_band for r in other] == ["Low", "Low", "Low", "Medium", "Medium", "High", "High", "High", "High",
                                            "High", "Critical"]
    assert [r.is_high_risk for r in other] == [False] * 6 + [True] * 4 + [None]


def test_transaction_filters_and_flags(spark):
    rows = [
        txn(1, amount=10000.0, txn_hour=0), txn(2, amount=10000.01, txn_hour=5), txn(3, amount=0.0),
        txn(4, amount=-1.0), txn(5, status="Unknown"), txn(6, account_id=None), txn(7, amount=0.01, txn_hour=6),
        txn(8, txn_hour=22, status="Declined"), txn(9, txn_hour=23), txn(None, transaction_id=None),
    ]
    df = raw(spark, "transactions", *rows)
    kept = {r.transaction_id: r for r in silver.refine("transactions", df, BATCH).collect()}
    assert sorted(kept) == ["T1", "T2", "T7", "T8", "T9"]
    assert [kept[t].is_high_value for t in sorted(kept)] == [False, True, False, False, False]
    assert [kept[t].is_odd_hour for t in sorted(kept)] == [True, True, False, False, False]
    assert kept["T8"].is_declined and kept["T1"].week_of_year == 2 and kept["T1"].month == 1
    every = {r.transaction_id: r for r in silver.refine("transactions", df, DECLARATIVE).collect()}
    assert len(every) == 10
    assert [every[t].is_odd_hour for t in ("T2", "T7", "T8", "T9")] == [True, False, False, True]
    reasons = {r.transaction_id: r.violations for r in silver.quarantine("transactions", df).collect()}
    assert reasons == {"T3": ["amount_positive"], "T4": ["amount_positive"], "T5": ["status_known"],
                       "T6": ["account_id_present"], None: ["transaction_id_present"]}


def test_merchants_labels_alerts(spark):
    merchants = raw(spark, "merchants",
                    dict(merchant_id="M1", risk_level="High", is_blacklisted=False),
                    dict(merchant_id="M2", risk_level="Low", is_blacklisted=True),
                    dict(merchant_id="M3", risk_level="Low", is_blacklisted=None))
    assert [r.merchant_id for r in silver.refine("merchants", merchants, BATCH).collect()] == ["M1"]
    assert silver.refine("merchants", merchants, DECLARATIVE).where("is_high_risk_merchant").count() == 2
    labels = raw(spark, "fraud_labels",
                 dict(fraud_id="F1", transaction_id="T1", fraud_status="Confirmed", loss_amount=0.0, recovered_amount=5.0,
                      detected_datetime="2024-01-01 00:00:00", confirmed_datetime="2024-01-01 01:30:00"),
                 dict(fraud_id="F2", transaction_id="T2", fraud_status="False Positive", loss_amount=3.0,
                      recovered_amount=1.0, detected_datetime="bad", confirmed_datetime="2024-01-01 01:30:00"))
    one, two = silver.refine("fraud_labels", labels, BATCH).orderBy("fraud_id").collect()
    assert (one.recovery_rate, one.hours_to_confirm, one.is_resolved) == (None, 1.5, True)
    assert (two.recovery_rate, two.hours_to_confirm, two.is_resolved) == (0.3333, None, False)
    assert silver.refine("fraud_labels", labels, DECLARATIVE).orderBy("fraud_id").collect()[1].recovery_rate == 1 / 3


def test_duplicates_keep_the_same_copy_in_any_order(spark):
    rows = [txn(1, amount=float(a), txn_datetime=f"2024-01-1{a} 00:00:00") for a in (1, 3, 2)] + [txn(2)]
    for order in (rows, rows[::-1]):
        out = silver.refine("transactions", raw(spark, "transactions", *order).repartition(3), BATCH)
        assert [(r.transaction_id, r.amount) for r in out.orderBy("transaction_id").collect()] == [("T1", 3.0), ("T2", 50.0)]


@pytest.fixture(scope="module")
def layer(spark):
    return {
        "customers": silver.refine("customers", raw(
            spark, "customers",
            dict(customer_id="C1", risk_score=10.0, is_pep=False, is_sanctioned=False),
            dict(customer_id="C2", risk_score=90.0, is_pep=False, is_sanctioned=False),
            dict(customer_id="C3", risk_score=5.0, is_pep=False, is_sanctioned=False))),
        "accounts": silver.refine("accounts", raw(
            spark, "accounts",
            dict(account_id="A1", customer_id="C1", balance=-5.0, status="Active"),
            dict(account_id="A2", customer_id="C1", balance=7.0, status="Dormant"),
            dict(account_id="A3", customer_id="C2", balance=1.0, status="Active"))),
        "merchants": silver.refine("merchants", raw(
            spark, "merchants", dict(merchant_id="M1", risk_level="High", is_blacklisted=False))),
        "transactions": silver.refine("transactions", raw(
            spark, "transactions", txn(1), txn(2, merchant_id=None), txn(3, merchant_id="M9", account_id="A2"))),
        "fraud_labels": silver.refine("fraud_labels", raw(
            spark, "fraud_labels",
            dict(fraud_id="F1", transaction_id="T1", fraud_type="Phishing", fraud_status="False Positive", loss_amount=9.0))),
        "alerts": silver.refine("alerts", raw(
            spark, "alerts",
            dict(alert_id="L1", transaction_id="T1", rule_id="R1", score=0.6, alert_status="Closed - True Positive",
                 false_positive=False),
            dict(alert_id="L2", transaction_id="T1", rule_id="R1", score=0.9, alert_status="Open",
                 false_positive=True))),
    }


def test_gold_tables(spark, layer):
    view = {r.customer_id: r for r in gold.customer_360(layer).collect()}
    assert (view["C1"].num_accounts, view["C1"].overdrawn_accounts, view["C1"].lifetime_txns) == (2, 1, 3)
    assert (view["C2"].num_accounts, view["C2"].lifetime_txns) == (1, None)  # account without transactions
    assert (view["C3"].num_accounts, view["C3"].lifetime_txns) == (None, None)
    assert len(gold.customer_360(layer).columns) == 22
    enriched = gold.transactions_enriched(layer)
    assert len(enriched.columns) == 46
    rows = {r.transaction_id: r for r in enriched.collect()}
    assert (rows["T1"].is_fraud, rows["T1"].alert_count, rows["T1"].max_alert_score,
            rows["T1"].has_true_positive_alert) == (1, 2, 0.9, 1)  # a label counts whatever became of it
    assert (rows["T2"].is_fraud, rows["T2"].alert_count, rows["T2"].is_high_risk_merchant) == (0, 0, None)
    assert rows["T3"].mcc_code is None and rows["T3"].account_status == "Dormant"
    assert gold.transactions_enriched(layer, confirmed_only=True).where("is_fraud = 1").count() == 0
    assert len(gold.daily_fraud_summary(enriched).columns) == 11
    perf = gold.alert_rule_performance(layer).collect()
    assert (perf[0].total_alerts, perf[0].true_positives, perf[0].false_positives, perf[0].confirmed_frauds,
            perf[0].fp_rate) == (2, 1, 1, 2, 0.5) and len(perf[0]) == 10


def enriched_rows(spark, *rows):
    """Just the columns the features read."""
    columns = ("transaction_id string, account_id string, amount double, txn_datetime timestamp, txn_date date, "
               "channel string, merchant_id string, device_id string, is_international boolean, is_odd_hour boolean, "
               "is_declined boolean, is_high_risk_merchant boolean, risk_score double, is_fraud int, "
               "account_status string, mcc_code string, mcc_description string, transaction_type string")
    base = dict(account_id="A", amount=100.0, channel="POS", merchant_id="M", device_id="D", is_international=False,
                is_odd_hour=False, is_declined=False, is_high_risk_merchant=False, risk_score=10.0, is_fraud=0,
                account_status="Active", mcc_code="5411", mcc_description="Grocery", transaction_type="Purchase")
    start = dt.datetime(2024, 1, 10, 12)
    data = []
    for i, r in enumerate(rows):
        at = start + dt.timedelta(seconds=r.pop("s", 0))
        full = base | dict(transaction_id=f"T{i}", txn_datetime=at, txn_date=at.date()) | r
        data.append(tuple(full[c.split()[0]] for c in columns.split(", ")))
    return spark.createDataFrame(data, columns)


def test_frame_edges_ties_and_lone_rows(spark):
    df = enriched_rows(spark, dict(s=0), dict(s=3600), dict(s=3601), dict(s=3601, amount=300.0),
                       dict(s=0, account_id="B", amount=7.0))
    out = {r.transaction_id: r for r in features.ml_features(df).collect()}
    assert [out[t].txn_count_1h for t in ("T0", "T1", "T2", "T3")] == [1, 2, 3, 3]  # the edge is included, ties are peers
    assert out["T2"].amount_sum_1h == 500.0 and out["T1"].amount_stddev_7d == 0.0
    assert (out["T4"].amount_stddev_7d, out["T4"].amount_zscore) == (None, 0.0)
    assert out["T3"].amount_zscore == pytest.approx(1.5)


def test_scores_and_flags(spark):
    df = enriched_rows(
        spark, dict(account_id="A", is_high_risk_merchant=None),
        dict(account_id="B", channel="API", is_international=True, is_odd_hour=True, is_high_risk_merchant=True),
        dict(account_id="C", amount=500.0), dict(account_id="D", amount=600.0), dict(account_id="E", amount=650.0),
        *[dict(account_id="F", s=i) for i in range(6)])
    out = {r.transaction_id: r for r in features.ml_features(df).collect()}
    assert out["T0"].geo_risk_score is None and out["T0"].composite_risk_score == 100.0
    assert features.ml_features(df, null_safe=True).where("transaction_id = 'T0'").first().composite_risk_score == 5.0
    assert (out["T1"].geo_risk_score, out["T1"].channel_risk, out["T1"].composite_risk_score) == (5.5, 3, 41.5)
    assert [out[t].is_round_amount for t in ("T2", "T3", "T4")] == [0, 1, 0]
    assert [out[f"T{i}"].is_high_velocity for i in (9, 10)] == [0, 1]  # more than five in the hour


def test_extended_frames(spark):
    df = enriched_rows(spark, dict(s=0, merchant_id="M1", amount=900.0), dict(s=10, merchant_id="M2"),
                       dict(s=86400, merchant_id="M1"), dict(s=86401, merchant_id=None), dict(s=604800, amount=5.0),
                       dict(s=604801, amount=6.0))
    out = {r.transaction_id: r for r in features.velocity_extended(df).collect()}
    assert [out[f"T{i}"].unique_merchants_24h for i in range(6)] == [1, 2, 2, 2, 1, 1]
    assert [out[f"T{i}"].amount_max_7d for i in range(6)] == [900.0, 900.0, 900.0, 900.0, 900.0, 100.0]


def test_structuring(spark):
    def case(step, account):
        kinds = [("Cash Deposit", 900.0, "ATM"), ("Cash Deposit", 850.0, "Branch"), ("Cash Deposit", 950.0, "Mobile"),
                 ("Cash Deposit", 800.0, "ATM"), ("ATM Withdrawal", 3500.0, "ATM")]
        return [dict(s=i * step, transaction_type=k, amount=a, channel=c, account_id=account)
                for i, (k, a, c) in enumerate(kinds)]
    df = enriched_rows(spark, *case(3600, "fast"), *case(7000, "slow"))
    found = rules.structuring_patterns(df).collect()
    assert [(r.account_id, r.deposits, r.deposit_total, r.channels) for r in found] == [("fast", 4, 3500.0, 3)]


def test_tiers(spark):
    df = spark.createDataFrame([(p,) for p in (0.0, 0.3, 0.4, 0.6, 0.8, 0.85, 1.0)], "p double").select(
        "p", model_tier(F.col("p")).alias("m"), policy_tier(F.col("p")).alias("t"), policy_action(F.col("p")).alias("a"))
    rows = df.orderBy("p").collect()
    assert [r.m for r in rows] == [None, "Low", "Medium", "Medium", "High", "High", "Critical"]
    assert [r.t for r in rows] == ["Low", "Low", "Medium", "High", "Critical", "Critical", "Critical"]
    assert rows[-1].a.startswith("Auto-block")


def test_driver_text_orders_by_magnitude(spark):
    df = spark.createDataFrame([(0.5, -2.0, 0.5, 0.01)], "a double, b double, c double, d double")
    assert df.select(driver_text(contributions(["a", "b", "c", "d"]))).first()[0] == "b(-2.000), a(+0.500), c(+0.500)"


def test_expectations_count_null_as_violation(spark):
    df = spark.createDataFrame([("c1", 50.0), (None, None), ("c3", 101.0)], "customer_id string, risk_score double")
    rows = quality.report({"customers": df}, quality.MEASURED).collect()
    assert {r.expectation: r.violations for r in rows} == {"valid_customer_id": 1, "valid_risk_score": 2}
    assert {r.total_rows for r in rows} == {3}


def test_rule_history(spark):
    day = 86400
    df = enriched_rows(spark, dict(s=0), dict(s=31 * day, device_id="D2"), dict(s=31 * day + 5, device_id="D2"),
                       dict(s=62 * day + 5), *[dict(s=70 * day + i, is_declined=True, account_id="B") for i in range(3)])
    featured = features.ml_features(df)
    assert [r[0] for r in rules.new_devices(featured).collect()] == ["T1"]
    assert sorted(r[0] for r in rules.after_long_gap(featured).collect()) == ["T1", "T3"]
    assert {r.transaction_id: r.declines_24h for r in rules.declines_24h(featured).collect()} == {"T4": 1, "T5": 2, "T6": 3}


def test_period_and_spike(spark):
    df = spark.createDataFrame(
        [(dt.date(2024, 1, d), "Web", int(i < n)) for d, n in ((1, 1), (2, 1), (3, 5)) for i in range(6)],
        "txn_date date, channel string, is_fraud int")
    spikes = {r.txn_date.day: r.is_spike for r in insights.suspicion_rate_daily(df).collect()}
    assert spikes == {1: False, 2: False, 3: True}
    assert kpis.in_period(df, "2024-01-02", "2024-01-02").count() == 6


def test_report_and_auc_agree_with_mllib(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    df = spark.range(500).select(
        (F.pmod(F.xxhash64("id"), F.lit(17)) / 16).alias("fraud_probability"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(2)).cast("int").alias("label"))
    ours = scorecard.roc_auc(df).first().roc_auc
    theirs = BinaryClassificationEvaluator(rawPredictionCol="fraud_probability", numBins=0).evaluate(df)
    assert ours == pytest.approx(theirs, abs=1e-8)
    report = {r.class_name: r for r in scorecard.classification_report(df).collect()}
    assert report["Legit"].support + report["Fraud"].support == 500 == report["accuracy"].support
