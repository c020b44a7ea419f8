"""Rule alerts on a stream, with the whole rule book."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlens.plans.features import DAY, ROUND_ABOVE, ROUND_UNIT
from ledgerlens.plans.rules import RULES, Rule, rule_alerts
from ledgerlens.streaming import history

# What the rule book looks at, beside the facts that need history. A book of its own passes its columns.
COLUMNS = ("transaction_id", "account_id", "txn_datetime", "amount", "is_international", "is_odd_hour", "account_status",
           "is_round_amount", "is_blacklisted_merchant")


def row_inputs(enriched: DataFrame, merchants_raw: DataFrame) -> DataFrame:
    """What the rules look at in one row, from an enriched stream or table."""
    blacklist = merchants_raw.where("is_blacklisted").select("merchant_id").distinct().withColumn(
        "is_blacklisted_merchant", F.lit(True))
    rounded_amount = (F.col("amount") % ROUND_UNIT == 0) & (F.col("amount") > ROUND_ABOVE)
    return enriched.withColumn("is_round_amount", rounded_amount.cast("int")).join(blacklist, "merchant_id", "left")


def inputs(enriched: DataFrame, merchants_raw: DataFrame, columns: Sequence[str] = COLUMNS,
           lateness_seconds: int = DAY) -> DataFrame:
    """The rules' inputs on a stream: ``columns`` of each row and the facts from its account's history."""
    return history.facts(row_inputs(enriched, merchants_raw), columns, lateness_seconds)


def alert_stream(inputs: DataFrame, path: str, checkpoint: str, rules: Sequence[Rule] = RULES) -> StreamingQuery:
    """Write the alerts of each micro-batch to its own folder, replacing what an earlier attempt left.

    A micro-batch that is repeated after a failure therefore adds nothing twice.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        rule_alerts(batch, rules).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return inputs.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(
        availableNow=True).foreachBatch(write).start()
