"""Batch forms of the keyed-state operators over visits and readings.

None of them sorts or collects the rows of a key in one task. Each picks the few rows that matter with partial
aggregation and joins them back on the identity of the row. A stream handles the same logic row by row in
:mod:`tidewater.streaming.state`; both give the same result when rows arrive in the order of ``ts, seq``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.time import et_from_millis
from tidewater.operators.skew import attach, mark

HOUR_MS = 3_600_000


def flat_visits(log: DataFrame) -> DataFrame:
    """Visitor columns of the log at the top level, with the day of the visit."""
    return log.select(
        F.col("common.mid").alias("mid"),
        F.col("common.sid").alias("sid"),
        F.col("common.vc").alias("vc"),
        F.col("common.ch").alias("ch"),
        F.col("common.ar").alias("ar"),
        F.col("common.is_new").alias("is_new"),
        F.col("page")["during_time"].try_cast("bigint").alias("during_time"),
        "ts",
        "seq",
        F.to_date(et_from_millis(F.col("ts"))).alias("day"),
    )


def first_days(visits: DataFrame) -> DataFrame:
    """``mid, first``: the day on which a device counts as new, fixed by its first record."""
    day = F.to_date(et_from_millis(F.col("ts")))
    found = visits.groupBy("mid").agg(F.min_by(F.struct(day.alias("day"), "is_new"), F.struct("ts", "seq")).alias("f"))
    return found.select("mid", F.when(F.col("f.is_new") == "1", F.col("f.day")).otherwise(F.date_sub("f.day", 1)).alias("first"))


def last_days(visits: DataFrame) -> DataFrame:
    """``mid, day``: the day of the last visit of a device, as text."""
    found = visits.groupBy("mid").agg(F.max_by("ts", F.struct("ts", "seq")).alias("ts"))
    return found.select("mid", F.date_format(et_from_millis(F.col("ts")), "yyyy-MM-dd").alias("day"))


def repair_new_flag(log: DataFrame) -> DataFrame:
    """Correct ``common.is_new``: a device counts as new on the day of its first visit only.

    The first record of a device fixes that day: its own day when it says new, else the day before.
    """
    day = F.to_date(et_from_millis(F.col("ts")))
    rows = log.withColumn("_mid", F.col("common.mid"))
    first = first_days(rows.select(F.col("_mid").alias("mid"), F.col("common.is_new").alias("is_new"), "ts", "seq"))
    joined = attach(rows, first.select(F.col("mid").alias("_mid"), F.col("first").alias("_first")), "_mid")
    wrong = (F.col("common.is_new") == "1") & (day != F.col("_first"))
    fixed = F.when(wrong, "0").otherwise(F.col("common.is_new"))
    return joined.withColumn("common", F.col("common").withField("is_new", fixed)).select(*log.columns)


def first_visits(visits: DataFrame) -> DataFrame:
    """The first visit of each device on each day, as a whole row."""
    rest = [c for c in visits.columns if c not in ("mid", "day")]
    picked = visits.groupBy("mid", "day").agg(F.min_by(F.struct(*rest), F.struct("ts", "seq")).alias("first"))
    return picked.select("mid", "day", "first.*")


def daily_visitor_flag(visits: DataFrame) -> DataFrame:
    """``uv`` is 1 on the first visit of a device on a day, else 0."""
    first = visits.groupBy("mid", "day").agg(F.min(F.struct("ts", "seq")).alias("first"))
    return mark(visits, first.select("mid", "first.*"), ("mid", "ts", "seq"), "uv")


CHUNK_TTLS = 12  # length of a chunk of one sid, in session lengths
Batches = Iterator[pd.DataFrame]


def _heads(batch: pd.DataFrame) -> np.ndarray:
    """Positions in a sorted batch where a new ``sid, chunk`` begins."""
    sids, chunks = batch["sid"].to_numpy(), batch["chunk"].to_numpy()
    return np.flatnonzero(np.append(True, (sids[1:] != sids[:-1]) | (chunks[1:] != chunks[:-1])))


def _groups(batch: pd.DataFrame) -> Iterator[tuple[tuple, int, int]]:
    """Runs of equal ``sid, chunk`` in a sorted batch, as key, begin and end."""
    sids, chunks, heads = batch["sid"].to_numpy(), batch["chunk"].to_numpy(), _heads(batch)
    for head, end in zip(heads, np.append(heads[1:], len(sids))):
        yield (sids[head], chunks[head]), head, end


def _whole_groups(batches: Batches) -> Batches:
    """The same sorted rows, cut so that no group lies in two batches."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if batch.empty:
            continue
        key = ["sid", "chunk"]
        head = _heads(batch)[-1]
        if held and (head > 0 or tuple(held[-1][key].iloc[-1]) != tuple(batch[key].iloc[0])):
            yield pd.concat([*held, batch.iloc[:head]], ignore_index=True)
            held = []
        elif head > 0:
            yield batch.iloc[:head].reset_index(drop=True)
        held.append(batch.iloc[head:])
    if held:
        yield pd.concat(held, ignore_index=True)


def _outcomes(ttl: int) -> Callable[[Batches], Batches]:
    """For each chunk, its last opener as a step function of the moment from which a visit may open a session.

    A row ``upto, last`` says: from any moment up to ``upto``, and past that of the row before, the walk from
    opener to opener ends at ``last``. Starts that meet on the way share a row. Only starts in the first session
    length of a chunk can follow an opener of the chunk before.
    """
    length = ttl * CHUNK_TTLS

    def run(batches: Batches) -> Batches:
        for batch in _whole_groups(batches):
            heads = _heads(batch)
            sizes = np.diff(np.append(heads, len(batch)))
            ends = np.repeat(heads + sizes, sizes)
            begin = batch["chunk"].to_numpy() * length
            within = batch["ts"].to_numpy() - begin
            # one rising line of time over all groups of the batch, farther apart than any step
            line = within + np.repeat(np.arange(len(heads)), sizes) * (length + ttl)
            after = np.searchsorted(line, line + ttl)
            step = np.where(after < ends, after, np.arange(len(line)))
            for _ in range(CHUNK_TTLS.bit_length()):
                step = step[step]
            # a start lies in the first session length, or is the first visit after it
            start = np.append(True, within[:-1] < ttl) | (within < ttl)
            start[heads] = True
            chosen = batch[start].assign(upto=batch["ts"][start], last=batch["ts"].to_numpy()[step][start])
            nxt = chosen[["sid", "chunk", "last"]].shift(-1)
            same = (nxt["sid"] == chosen["sid"]) & (nxt["chunk"] == chosen["chunk"]) & (nxt["last"] == chosen["last"])
            yield chosen.loc[~same, ["sid", "chunk", "upto", "last"]]

    return run


def _entries(ttl: int) -> Callable[[Batches], Batches]:
    """Walk the chunks of each sid in order: the moment ``ready`` from which a visit may open a session in each."""

    def run(batches: Batches) -> Batches:
        at, ready, following = (None, None), None, None
        for batch in batches:
            upto, last = batch["upto"].to_numpy(), batch["last"].to_numpy()
            out = []
            for key, head, end in _groups(batch):
                if key != at:
                    ready = following if key[0] == at[0] else None
                    at = key
                    if ready is not None and ready > key[1] * ttl * CHUNK_TTLS:
                        out.append((*key, ready))
                    settled = False
                if not settled:
                    found = head if ready is None else head + np.searchsorted(upto[head:end], ready)
                    if found < end:
                        following, settled = last[found] + ttl, True
                    elif ready is None:
                        following = None
            yield pd.DataFrame(out, columns=["sid", "chunk", "ready"])

    return run


def _openers(ttl: int, names: list[str]) -> Callable[[Batches], Batches]:
    """Openers of each chunk; a row with ``ready`` set comes first in its chunk and is no visit."""

    def run(batches: Batches) -> Batches:
        at, ready = None, None
        for batch in batches:
            ts, entry = batch["ts"].to_numpy(), batch["ready"].to_numpy()
            kept = []
            for key, head, end in _groups(batch):
                if key != at:
                    at, ready = key, ts[head]
                    if entry[head] >= 0:
                        ready, head = entry[head], head + 1
                here = head + np.searchsorted(ts[head:end], ready)
                while here < end:
                    kept.append(here)
                    ready = ts[here] + ttl
                    here = head + np.searchsorted(ts[head:end], ready)
            yield batch.iloc[kept][names]

    return run


def session_starts(visits: DataFrame, ttl_ms: int = HOUR_MS) -> DataFrame:
    """Visits that open a session: the first of a ``sid``, then each one ``ttl_ms`` or more after the last opener.

    This is no gap session: visits between two openers do not extend the first one, so an opener depends on the
    one before and that on its own. To keep a busy ``sid`` out of a single task its time is cut into chunks:
    each chunk is reduced, in parallel, to where it ends for every possible entry; the entries are chained
    through these short step functions; then each chunk, in parallel, picks its openers. Copies of a moment
    become one row before anything is shuffled, so a chunk holds at most one row per millisecond.
    """
    names = list(visits.columns)
    rest = [c for c in names if c not in ("sid", "ts")]
    moments = (
        visits.groupBy("sid", "ts")
        .agg(F.min_by(F.struct(*rest), F.col("seq")).alias("row"))
        .select("sid", "ts", "row.*", F.floor(F.col("ts") / (ttl_ms * CHUNK_TTLS)).alias("chunk"))
    )

    def in_order(df: DataFrame, by: tuple[str, ...], then: str) -> DataFrame:
        return df.repartition(*by).sortWithinPartitions("sid", "chunk", then)

    chunks = in_order(moments.select("sid", "chunk", "ts"), ("sid", "chunk"), "ts")
    outcomes = chunks.mapInPandas(_outcomes(ttl_ms), "sid string, chunk bigint, upto bigint, last bigint")
    entries = in_order(outcomes, ("sid",), "upto").mapInPandas(_entries(ttl_ms), "sid string, chunk bigint, ready bigint")
    before_all = F.col("chunk") * ttl_ms * CHUNK_TTLS - 1
    marked = moments.withColumn("ready", F.lit(-1).cast("bigint")).unionByName(
        entries.withColumn("ts", before_all), allowMissingColumns=True
    )
    ordered = in_order(marked, ("sid", "chunk"), "ts")
    return ordered.mapInPandas(_openers(ttl_ms, names), moments.select(*names).schema)


def session_flag(visits: DataFrame, ttl_ms: int = HOUR_MS) -> DataFrame:
    """``sv`` is 1 on a visit that opens a session, else 0."""
    openers = session_starts(visits.select("sid", "ts", "seq"), ttl_ms)
    return mark(visits, openers, ("sid", "ts", "seq"), "sv")


def jump_alert(readings: DataFrame, ttl: int, threshold: int = 10) -> DataFrame:
    """Readings that differ by more than ``threshold`` from the last one of their key, if that is younger than ``ttl``.

    Rows are grouped by key and second, never by key alone. The predecessor of the first row of a second is the
    last row of an earlier second; it is looked up among the seconds of the key, which are reduced to one row
    each and cut into stretches of ``ttl``: a predecessor young enough lies in the same stretch or the one before.
    """
    seconds = (
        readings.groupBy("key", "sec")
        .agg(F.max_by("val", "seq").alias("val"))
        .withColumn("stretch", F.floor(F.col("sec") / ttl))
    )
    here = F.struct("sec", "val")
    in_stretch = Window.partitionBy("key", "stretch").orderBy("sec")
    tails = seconds.groupBy("key", (F.col("stretch") + 1).alias("stretch")).agg(F.max(here).alias("tail"))
    earlier = (
        seconds.withColumn("prev", F.lag(here).over(in_stretch))
        .join(tails, ["key", "stretch"], "left")
        .select("key", "sec", F.coalesce("prev", "tail").alias("prev"))
        .where(F.col("sec") - F.col("prev.sec") < ttl)
        .select("key", "sec", F.col("prev.val").alias("earlier_val"))
    )
    in_second = Window.partitionBy("key", "sec").orderBy("seq")
    linked = readings.withColumn("same_val", F.lag("val").over(in_second)).join(earlier, ["key", "sec"], "left")
    prev = F.coalesce("same_val", "earlier_val")
    return linked.where(F.abs(prev - F.col("val")) > threshold).select("key", "sec", prev.alias("prev_val"), "val")
