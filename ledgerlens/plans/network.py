"""Risk carried over from counterparties."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.measures import exact_sum, ratio
from ledgerlens.operators.joins import find_hot_keys, lookup_join

_c = F.col


def edges(enriched: DataFrame) -> DataFrame:
    """Distinct payment relations between accounts, combined before anything is joined."""
    return enriched.where("counterparty_id is not null").groupBy("account_id", "counterparty_id").agg(
        F.count(F.lit(1)).alias("transfers"), exact_sum("amount").alias("amount"))


def counterparty_risk(enriched: DataFrame) -> DataFrame:
    """Per account: relations out and in, and which part of its counterparties has a labelled payment."""
    relations = edges(enriched)
    labelled = (
        enriched.where("is_fraud = 1").groupBy(_c("account_id").alias("counterparty_id"))
        .agg(F.lit(True).alias("is_labelled"))
    )
    outgoing = (
        lookup_join(relations, labelled, "counterparty_id", spread_by="account_id")
        .groupBy("account_id").agg(
            F.count(F.lit(1)).alias("out_degree"),
            F.sum("transfers").alias("out_transfers"),
            exact_sum("amount").alias("out_amount"),
            F.count_if("is_labelled").alias("labelled_counterparties"))
    )
    incoming = relations.groupBy(_c("counterparty_id").alias("account_id")).agg(
        F.count(F.lit(1)).alias("in_degree"), F.sum("transfers").alias("in_transfers"))
    return (
        outgoing.join(incoming, "account_id", "full")
        .na.fill(0, ["out_degree", "out_transfers", "out_amount", "labelled_counterparties", "in_degree",
                     "in_transfers"])
        .withColumn("labelled_share", ratio("labelled_counterparties", "out_degree"))
    )


def network_risk(enriched: DataFrame, damping: float = 0.5, hops: int | None = None, tolerance: float = 1e-6) -> DataFrame:
    """``account_id, is_labelled, exposure``: risk that reaches an account over its payment relations.

    An account with a labelled payment starts with 1. In each hop an account takes ``damping`` times the mean exposure
    of those it pays, weighted by transfers, on top of its own start. ``damping`` is below 1, so the hops settle at one
    fixed point; without ``hops`` as many are made as bring every account within ``tolerance`` of it.

    Weights are written once; each hop is one join and one sum, checkpointed. Counterparties with a large share of the
    relations are spread by plan, and sums are of decimals, so they do not depend on the order of rows.
    """
    if not 0 <= damping < 1:
        raise ValueError("damping must be from 0 to below 1")
    if hops is None:
        hops = math.ceil(math.log(tolerance * (1 - damping)) / math.log(damping)) if damping else 0
    relations = edges(enriched).select("account_id", "counterparty_id", "transfers")
    paid = relations.groupBy(_c("account_id").alias("_payer")).agg(F.sum("transfers").alias("total"))
    weighted = relations.join(paid, _c("account_id") == _c("_payer")).select(
        "account_id", "counterparty_id", (_c("transfers") / _c("total") * damping).alias("weight")).checkpoint()
    labelled = enriched.where("is_fraud = 1 and account_id is not null").select("account_id").distinct()
    start = (weighted.select("account_id").union(weighted.select("counterparty_id")).union(labelled).distinct()
             .join(labelled.withColumn("is_labelled", F.lit(True)), "account_id", "left")
             .select("account_id", F.coalesce("is_labelled", F.lit(False)).cast("int").alias("is_labelled")).checkpoint())
    hubs = find_hot_keys(weighted, "counterparty_id").checkpoint()
    now = start.withColumn("exposure", _c("is_labelled").cast("double"))
    for _ in range(hops):
        theirs = now.select(_c("account_id").alias("counterparty_id"), "exposure")
        taken = lookup_join(weighted, theirs, "counterparty_id", spread_by="account_id", hot_keys=hubs).groupBy(
            _c("account_id").alias("_payer")).agg(F.sum((_c("weight") * _c("exposure")).cast("decimal(38,18)")).alias("taken"))
        now = start.join(taken, _c("account_id") == _c("_payer"), "left").select(
            "account_id", "is_labelled",
            (_c("is_labelled") + F.coalesce(_c("taken").cast("double"), F.lit(0.0))).alias("exposure")).checkpoint()
    return now
