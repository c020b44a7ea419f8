"""What an account did before, as keyed state: per-second figures by day, known devices, the last payment.

The state of an account is a map from day to the figures of that day's seconds with traffic. A micro-batch reads the
days its frames reach and writes the days it touches, not the account's whole past. Days that no frame can reach any
more are removed when the account moves on. An account that stays away is cleaned up by a timer: its stream carries a
clock, the time when a row was landed (``transactions.stamped``), and once the watermark on that clock is ``idle``
beyond the account's last row, its days go. The clock is not the event's time, so no late row is dropped; a row that
comes later than its days are kept sees what is left.

Rows of a micro-batch are combined per second below the shuffle where only figures are asked for (``velocity.exact``).
Where each row gets its own facts (``facts``), one task holds an account's rows of a micro-batch: the micro-batch's
size (``files_per_trigger``) bounds it. Seconds more than a day ahead of the present do not count as an account's
latest, so a wrongly dated row cannot push the others out.
"""

from __future__ import annotations

import time
from collections.abc import Iterable, Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ledgerlens.plans.features import BURST_1H, BURST_24H, DAY, HOUR, WEEK
from ledgerlens.plans.rules import LONG_GAP_DAYS

CLOCK = "landed_at"
CLOCK_DELAY = "1 hour"


def clocked(stream: DataFrame) -> DataFrame:
    """The stream with a watermark on its landing clock, if it carries one."""
    return stream.withWatermark(CLOCK, CLOCK_DELAY) if CLOCK in stream.columns else stream


def clock_of(stream: DataFrame):
    """Landing time in milliseconds; NULL without a clock."""
    return F.unix_millis(CLOCK) if CLOCK in stream.columns else F.lit(None).cast("long")


class DayMap:
    """Figures per second of one account, a map entry a day. ``exact`` columns hold integers of any size as text."""

    def __init__(self, handle: StatefulProcessorHandle, plain: Sequence[str], exact: Sequence[str] = ()):
        kinds = [f"{c} array<bigint>" for c in ("second", *plain)] + [f"{c} array<string>" for c in exact]
        self.plain, self.exact = list(plain), list(exact)
        self.state = handle.getMapState("days", "day bigint", ", ".join(kinds))

    def folded(self, chunks: Iterable):
        """Rows as one per second, chunk by chunk: never more than the seconds are held."""
        import pandas as pd

        found = None
        for chunk in chunks:
            chunk = chunk[["second", *self.plain, *self.exact]].copy()
            for c in self.exact:
                chunk[c] = [int(v) for v in chunk[c]]
            chunk[self.exact] = chunk[self.exact].astype(object)
            found = (chunk if found is None else pd.concat([found, chunk])).groupby("second", as_index=False).sum()
        return found

    def merge(self, arrived, reach: int, lateness: int):
        """``arrived`` (one row a second) put into the state; returns all seconds that frames of ``reach`` days see. The
        state holds no days that neither a frame nor a row ``lateness`` seconds late can reach: of a micro-batch over many
        days only the last ones are written."""
        import pandas as pd

        touched = sorted({int(s) // DAY for s in arrived["second"]})
        known = {k[0] for k in self.state.keys()} if self.state.exists() else set()
        wanted = known & {d - back for d in touched for back in range(reach + 1)}
        frames = [arrived]
        for day in wanted:
            names = ["second", *self.plain, *self.exact]
            frame = pd.DataFrame({n: list(v) for n, v in zip(names, self.state.getValue((day,)))})
            for c in self.exact:
                frame[c] = pd.Series([int(v) for v in frame[c]], dtype=object)
            frames.append(frame)
        merged = pd.concat(frames).groupby("second", as_index=False).sum()
        days, kept = merged["second"] // DAY, self._kept(known | set(touched), reach, lateness)
        for day in kept.intersection(touched):
            own = merged[days == day]
            self.state.updateValue((day,), tuple([int(v) for v in own[c]] for c in ("second", *self.plain)) + tuple(
                [str(v) for v in own[c]] for c in self.exact))
        for day in known - kept:
            self.state.removeKey((day,))
        return merged

    @staticmethod
    def _kept(days: set[int], reach: int, lateness: int) -> set[int]:
        """The days that a frame or a row ``lateness`` seconds late can reach."""
        believable = [d for d in days if d * DAY <= time.time() + DAY]
        latest = max(believable or days)
        return {d for d in days if d >= latest - reach - -(-lateness // DAY)}


def frames_over(merged, asked):
    """``over(column, seconds)``: the sums of the frames that end at the asked seconds."""
    import numpy as np

    at = merged["second"].to_numpy()
    running = {c: np.concatenate([[0], np.cumsum(merged[c].to_numpy())]) for c in merged.columns if c != "second"}
    upto = np.searchsorted(at, asked, side="right")

    def over(column: str, seconds: int):
        return running[column][upto] - running[column][np.searchsorted(at, asked - seconds, side="left")]

    return over


class Remembering(StatefulProcessor):
    """A processor whose days go when its account has been idle for ``idle`` seconds of the clock."""

    def __init__(self, lateness: int, idle: int):
        self.lateness, self.idle = lateness, idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.touched = handle.getValueState("touched", "clock bigint")

    def touch(self, clock: float | None) -> None:
        """Note the clock of the account's last row; one timer at a time waits for it."""
        if clock is None or clock != clock:
            return
        before = self.touched.get()[0] if self.touched.exists() else None
        self.touched.update((max(int(clock), before or 0),))
        if before is None:
            self.handle.registerTimer(int(clock) + self.idle * 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        due = self.touched.get()[0] + self.idle * 1000 if self.touched.exists() else None
        if due is not None and due > expiredTimerInfo.getExpiryTimeInMs():
            self.handle.registerTimer(due)
        else:
            self.days.state.clear()
            self.touched.clear()
        return iter(())

    def close(self) -> None:
        pass


class Facts(Remembering):
    """Rows with what the account's past says about them."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.days = DayMap(handle, ("n", "declines"))
        self.devices = handle.getMapState("devices", "device string", "second bigint")
        self.last = handle.getValueState("last", "second bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        import numpy as np
        import pandas as pd

        frame = pd.concat(list(rows)).sort_values(["second", "transaction_id"], kind="stable", ignore_index=True)
        second = frame["second"].to_numpy(np.int64)
        declined = frame["is_declined"].eq(True).to_numpy()
        merged = self.days.merge(self.days.folded([pd.DataFrame({
            "second": second, "n": frame["transaction_id"].notna().astype("int64"), "declines": declined.astype("int64")})]), 1, self.lateness)
        over = frames_over(merged, second)
        before = self.last.get()[0] if self.last.exists() else None
        earlier = np.maximum.accumulate(np.concatenate([[second[0] if before is None else before], second]))
        frame["is_high_velocity"] = ((over("n", HOUR) > BURST_1H) | (over("n", DAY) > BURST_24H)).astype("int32")
        frame["is_after_long_gap"] = second - earlier[:-1] > LONG_GAP_DAYS * DAY
        frame["declines_24h"] = pd.Series(over("declines", DAY)).where(declined).astype("Int64")
        frame["is_new_device"] = self._new(frame["device_id"], second, before is None)
        self.last.update((int(earlier[-1]),))
        self.touch(frame["clock"].max())
        yield frame.drop(columns=["second", "clock", CLOCK], errors="ignore")

    def _new(self, devices, second, opening: bool):
        """Which rows show a device for the first time, the account's very first row aside."""
        import numpy as np

        names = devices.map(lambda d: "+" + d, na_action="ignore").fillna("-")
        found = np.zeros(len(names), dtype=bool)
        for k in np.flatnonzero(~names.duplicated().to_numpy()):
            if not self.devices.containsKey((names[k],)):
                self.devices.updateValue((names[k],), (int(second[k]),))
                found[k] = k > 0 or not opening
        return found


def facts(stream: DataFrame, columns: Sequence[str], lateness_seconds: int = DAY, idle_seconds: int = 2 * WEEK) -> DataFrame:
    """``columns`` of every row and what needs its account's history: ``is_high_velocity``, ``is_new_device``,
    ``is_after_long_gap``, ``declines_24h``, as the batch finds them (``plans.rules.rule_inputs``).

    Rows that arrive in order get the batch's facts; a late one gets those known when it comes, and rows already put
    out are not put out again. Rows without a time cannot be placed and are left out (``transactions.without_time``).
    Known devices and the last payment of an account stay; its days go when it has been idle.
    """
    needed = list(dict.fromkeys(["account_id", "transaction_id", "device_id", "is_declined", *columns]))
    timed = clocked(stream).select(*needed, F.unix_timestamp("txn_datetime").alias("second"),
                                   clock_of(stream).alias("clock"), *[c for c in (CLOCK,) if c in stream.columns])
    timed = timed.where("second is not null")
    kinds = dict(stream.select(*needed).dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in needed) + (
        ", is_high_velocity int, is_after_long_gap boolean, declines_24h bigint, is_new_device boolean")
    return by_account(timed, Facts(lateness_seconds, idle_seconds), schema)


def by_account(timed: DataFrame, processor: StatefulProcessor, schema: str) -> DataFrame:
    """One state for each account; rows without an account have one of their own."""
    mode = "eventtime" if CLOCK in timed.columns else "none"
    return timed.groupBy("account_id").transformWithStateInPandas(processor, schema, "append", mode)
