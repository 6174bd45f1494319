"""Keyed state on ``transformWithState``: alerts, visitor flags, session flags and timers.

Rows of a key come in pandas frames or, for daily and session flags, one by one: a device or session has few rows in a
micro-batch, and a frame per key costs more than its rows. Where the order matters, a processor sorts the rows a key has
in one micro-batch by their time and sequence, so the amount admitted per trigger (``maxFilesPerTrigger``,
``maxBytesPerTrigger`` or ``maxOffsetsPerTrigger``) bounds its memory. State per key is a few values.

Alerts, daily flags and session flags forget. Given ``et``, the watermarked time column, a timer clears the state of
a key when the watermark has passed the moment after which it can matter to no further row; without ``et`` a query
has no watermark and keeps its state.

A query may start from a batch snapshot of the rows before it (``known``), so that no history is read as a stream.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import UTC, datetime
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

DAY_MS = 86_400_000
LAST = T.StructType([T.StructField("at", T.LongType()), T.StructField("val", T.LongType())])
DAY = T.StructType([T.StructField("day", T.StringType())])
MOMENT = T.StructType([T.StructField("at", T.LongType())])


def _in_order(rows: Iterator[pd.DataFrame], *order: str) -> pd.DataFrame:
    return pd.concat(list(rows), ignore_index=True).sort_values(list(order), kind="stable", ignore_index=True)


def _days(ms: pd.Series) -> pd.Series:
    return pd.to_datetime(ms, unit="ms").dt.strftime("%Y-%m-%d")


def _rows_in_order(rows: Iterator[Row]) -> list[Row]:
    """Rows by ``ts, seq``, those without a time last."""
    return sorted(rows, key=lambda row: (row.ts is None, row.ts or 0, row.seq))


@lru_cache(maxsize=10_000)
def _day_text(number: int) -> str:
    return datetime.fromtimestamp(number * 86_400, UTC).strftime("%Y-%m-%d")


@lru_cache(maxsize=10_000)
def _day_end(day: str) -> int:
    return int(pd.Timestamp(day).timestamp() * 1000) + DAY_MS


class Forgetful(StatefulProcessor):
    """A processor whose key forgets its only value ``kept`` when the timer of its last update fires."""

    timed = False
    fields: T.StructType

    def lasts_until(self, value: tuple) -> int:
        """Milliseconds until which the value matters."""
        raise NotImplementedError

    def handleInitialState(self, key, initialState, timerValues) -> None:
        """The value of a key before the stream begins, as a row; the columns beside the key are the value's fields."""
        self.remember(tuple(initialState)[-len(self.fields) :])

    def remember(self, value: tuple) -> None:
        self.kept.update(value)
        if self.timed:
            self.handle.registerTimer(self.lasts_until(value))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        """Timers of values that were replaced since find a value that lasts longer."""
        value = self.kept.get()
        if value is not None and self.lasts_until(value) <= expiredTimerInfo.getExpiryTimeInMs():
            self.kept.clear()
        return iter(())


class JumpAlert(Forgetful):
    """Alert when a reading is more than ``threshold`` away from the last one, unless that is ``ttl`` seconds old."""

    fields = LAST

    def __init__(self, ttl: int, threshold: int, timed: bool = False):
        self.ttl, self.threshold, self.timed = ttl, threshold, timed

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.kept = handle, handle.getValueState("last", LAST)

    def lasts_until(self, value: tuple) -> int:
        return (value[0] + self.ttl) * 1000

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = _in_order(rows, "sec", "seq")
        before = self.kept.get() if self.kept.exists() else (None, None)
        prev_sec = batch["sec"].shift(1, fill_value=-1).to_numpy(dtype="float64")
        prev_val = batch["val"].shift(1, fill_value=0).to_numpy(dtype="float64")
        prev_sec[0], prev_val[0] = (np.nan, np.nan) if before[0] is None else before
        near = batch["sec"].to_numpy() - prev_sec < self.ttl
        hit = near & (np.abs(prev_val - batch["val"].to_numpy()) > self.threshold)
        self.remember((int(batch["sec"].iloc[-1]), int(batch["val"].iloc[-1])))
        out = batch.loc[hit, ["key", "sec", "val"]]
        yield out.assign(prev_val=prev_val[hit].astype("int32"))[["key", "sec", "prev_val", "val"]]

    def close(self) -> None:
        pass


class NewFlagRepair(StatefulProcessor):
    """Correct ``is_new`` from the day of the first visit, which the first record of a device fixes.

    Only the first micro-batch of a device needs its rows in order; later ones pass through batch by batch.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.first = handle.getValueState("first", DAY)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.first.update((initialState["first"].iloc[0],))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if self.first.exists():
            first = self.first.get()[0]
        else:
            batch = _in_order(rows, "ts", "seq")
            first = _days(batch["ts"].iloc[:1]).iloc[0]
            if batch["is_new"].iloc[0] != "1":
                first = str((pd.Timestamp(first) - pd.Timedelta(days=1)).date())
            self.first.update((first,))
            rows = iter([batch])
        for batch in rows:
            batch.loc[(batch["is_new"] == "1") & (_days(batch["ts"]) != first), "is_new"] = "0"
            yield batch

    def close(self) -> None:
        pass


class DailyVisitor(Forgetful):
    """``uv`` is 1 when the day differs from that of the previous visit of the device; it matters until that day is over."""

    fields = DAY

    def __init__(self, timed: bool = False):
        self.timed = timed

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.kept = handle, handle.getValueState("last", DAY)

    def lasts_until(self, value: tuple) -> int:
        return _day_end(value[0])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        kept = self.kept.get()
        before = last = kept[0] if kept is not None else None
        flagged = None
        for row in _rows_in_order(rows):
            flagged = flagged or Row(*row.__fields__, "uv")
            day = _day_text(row.ts // DAY_MS) if row.ts is not None else None
            yield flagged(*row, int(day is None or day != last))
            last = day or last
        if last != before:
            self.remember((last,))

    def close(self) -> None:
        pass


class SessionStart(Forgetful):
    """``sv`` is 1 when no visit opened a session of this ``sid`` within the last ``ttl_ms``."""

    fields = MOMENT

    def __init__(self, ttl_ms: int, timed: bool = False):
        self.ttl_ms, self.timed = ttl_ms, timed

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.kept = handle, handle.getValueState("opened", MOMENT)

    def lasts_until(self, value: tuple) -> int:
        return value[0] + self.ttl_ms

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        kept = self.kept.get()
        ready = self.lasts_until(kept) if kept is not None else None
        last, flagged = None, None
        for row in _rows_in_order(rows):
            flagged = flagged or Row(*row.__fields__, "sv")
            opens = row.ts is not None and (ready is None or row.ts >= ready)
            if opens:
                last, ready = row.ts, row.ts + self.ttl_ms
            yield flagged(*row, int(opens))
        if last is not None:
            self.remember((last,))

    def close(self) -> None:
        pass


class FixedTimer(StatefulProcessor):
    """One event-time timer per key at a fixed moment; registering it again changes nothing."""

    def __init__(self, at_ms: int):
        self.at_ms = at_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for _ in rows:
            pass
        self.handle.registerTimer(self.at_ms)
        yield pd.DataFrame({"key": pd.Series(dtype="str"), "fired_at": pd.Series(dtype="int64")})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"key": [key[0]], "fired_at": [expiredTimerInfo.getExpiryTimeInMs()]})

    def close(self) -> None:
        pass


def jump_alert(readings: DataFrame, ttl: int = 10, threshold: int = 10, et: str | None = None) -> DataFrame:
    """``et`` names the watermarked time column of the readings, by which old readings are forgotten."""
    return readings.groupBy("key").transformWithStateInPandas(
        JumpAlert(ttl, threshold, bool(et)), "key string, sec int, prev_val int, val int", "Append", "EventTime" if et else "None"
    )


def _known(snapshot: DataFrame | None, *columns: str):
    """The state before the stream, one row per key, as the operator takes it."""
    return None if snapshot is None else snapshot.select(*columns).groupBy(columns[0])


def repair_new_flag(visits: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``known`` holds ``mid, first``: the first days of devices seen before the stream, as ``visits.first_days`` gives them.

    It is read once, when the query first starts; a restart finds it in the checkpoint.
    """
    return visits.groupBy("mid").transformWithStateInPandas(
        NewFlagRepair(), visits.schema, "Append", "None", initialState=_known(known, "mid", "first")
    )


def _flagged(df: DataFrame, flag: str) -> T.StructType:
    return T.StructType(df.schema.fields + [T.StructField(flag, T.IntegerType())])


def _run(df: DataFrame, key: str, processor: StatefulProcessor, schema: T.StructType, et: str | None, known=None) -> DataFrame:
    mode = {"timeMode": "EventTime", "eventTimeColumnName": et} if et else {"timeMode": "None"}
    return df.groupBy(key).transformWithState(processor, schema, "Append", **mode, initialState=known)


def daily_visitor_flag(visits: DataFrame, et: str | None = None, known: DataFrame | None = None) -> DataFrame:
    """``et`` names the watermarked time column, by which past days are forgotten and a windowed summary may follow.

    ``known`` holds ``mid, day`` as text: the last day of devices seen before the stream.
    """
    return _run(visits, "mid", DailyVisitor(bool(et)), _flagged(visits, "uv"), et, _known(known, "mid", "day"))


def session_flag(visits: DataFrame, ttl_ms: int = 3_600_000, et: str | None = None, known: DataFrame | None = None) -> DataFrame:
    """``et`` names the watermarked time column, by which old sessions are forgotten and a summary may follow.

    ``known`` holds ``sid, at``: the millisecond at which the last session of an id opened before the stream.
    """
    return _run(visits, "sid", SessionStart(ttl_ms, bool(et)), _flagged(visits, "sv"), et, _known(known, "sid", "at"))


def timer_fire(pairs: DataFrame, at_ms: int = 5000) -> DataFrame:
    """Fired timers of a watermarked stream; ``pairs`` hold ``key`` and the watermarked time."""
    return pairs.groupBy("key").transformWithStateInPandas(
        FixedTimer(at_ms), "key string, fired_at bigint", "Append", "EventTime"
    )
