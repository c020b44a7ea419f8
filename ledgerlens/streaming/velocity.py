"""Account velocity on a stream: time windows, and the exact trailing frames of the batch."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessorHandle

from ledgerlens.functions import amounts
from ledgerlens.plans.features import DAY, HOUR, WEEK
from ledgerlens.streaming import history


def windowed(cleaned: DataFrame, length: str = "1 hour", slide: str | None = "5 minutes") -> DataFrame:
    """Count and amount per account and window; sliding, or tumbling with ``slide=None``.

    Counts are combined before the shuffle, so a hot account is a handful of rows per task. A window
    is emitted once, when the watermark passes its end; rows later than that are dropped.
    """
    high, low = amounts.limbs(F.col("amount"))
    span = F.window("event_time", length, slide) if slide else F.window("event_time", length)
    return cleaned.groupBy(span.alias("span"), "account_id").agg(
        F.count("transaction_id").alias("txn_count"),
        F.sum(high).alias("high"), F.sum(low).alias("low"),
    ).select("account_id", F.col("span.start").alias("window_start"), F.col("span.end").alias("window_end"),
             "txn_count", amounts.total(F.col("high"), F.col("low")).alias("amount_sum"))


class Frames(history.Remembering):
    """Trailing figures of the seconds that a micro-batch brings."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.days = history.DayMap(handle, ("n", "amounts"), ("total", "squares"))

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        import pandas as pd

        clock = []

        def noted():
            for chunk in rows:
                clock.append(chunk["clock"].max())
                yield chunk

        arrived = self.days.folded(noted())
        merged = self.days.merge(arrived, WEEK // DAY, self.lateness)
        over = history.frames_over(merged, arrived["second"].to_numpy())
        n, total, squares = (over(c, WEEK) for c in ("amounts", "total", "squares"))
        unit = 10 ** amounts.DIGITS
        spread = [int(a) * int(q) - int(s) * int(s) for a, q, s in zip(n, squares, total)]
        yield pd.DataFrame({
            "account_id": key[0], "second": arrived["second"],
            "txn_count_1h": over("n", HOUR), "txn_count_24h": over("n", DAY), "txn_count_7d": over("n", WEEK),
            "amount_sum_1h": [int(v) / unit for v in over("total", HOUR)],
            "amount_sum_24h": [int(v) / unit for v in over("total", DAY)],
            "amount_avg_7d": [int(s) / unit / int(a) if a else None for a, s in zip(n, total)],
            "amount_stddev_7d": [(v / (int(a) * (int(a) - 1))) ** 0.5 / unit if a > 1 else None
                                 for a, v in zip(n, spread)],
        })
        self.touch(pd.Series(clock).max())


def exact(landed: DataFrame, lateness_seconds: int = DAY, idle_seconds: int = 2 * WEEK) -> DataFrame:
    """Trailing one-hour, one-day and one-week figures of every (account, second) as it arrives.

    ``landed`` is a stream over landed silver transactions (the query that lands them deduplicates); with the landing
    clock, idle accounts leave the state (``streaming.history``).

    Rows are first combined per account and second within each Arrow batch, so a hot account does not
    cross the shuffle row by row, and its state is bounded by the clock, not by the rows. No row is
    dropped: a late one yields the figures of its own second as known then; seconds already emitted
    are not emitted again. Amounts are exact integers of any size with the digits of the batch; means and deviations
    are over rows with an amount.
    """
    high, low = amounts.limbs(F.col("amount"))
    clock = [history.CLOCK] if history.CLOCK in landed.columns else []
    timed = landed.select("account_id", F.unix_timestamp("txn_datetime").alias("second"), high.alias("high"),
                          low.alias("low"), *clock).where("second is not null")
    figures = {"n": "sum", "amounts": "sum", "total": "sum", "squares": "sum", **dict.fromkeys(clock, "max")}

    def combine(batches: Iterator):
        for batch in batches:
            rows = batch[["account_id", "second", *clock]].copy()
            rows["n"] = 1
            rows["amounts"] = batch["high"].notna().astype("int64")
            limbs = (batch[c].fillna(0).astype("int64").astype(object) for c in ("high", "low"))
            rows["total"] = next(limbs) * amounts.BASE + next(limbs)
            rows["squares"] = rows["total"] * rows["total"]
            found = rows.groupby(["account_id", "second"], as_index=False, sort=False, dropna=False).agg(figures)
            found[["total", "squares"]] = found[["total", "squares"]].astype(str)
            yield found

    combined = timed.mapInPandas(combine, "account_id string, second bigint, n bigint, amounts bigint, total string, "
                                          "squares string" + f", {history.CLOCK} timestamp" * len(clock))
    combined = history.clocked(combined).withColumn("clock", history.clock_of(combined))
    schema = ("account_id string, second bigint, txn_count_1h bigint, txn_count_24h bigint, txn_count_7d bigint, "
              "amount_sum_1h double, amount_sum_24h double, amount_avg_7d double, amount_stddev_7d double")
    return history.by_account(combined, Frames(lateness_seconds, idle_seconds), schema)
