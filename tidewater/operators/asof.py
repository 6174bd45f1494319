"""Lookups as of a time: each row meets the version of its code that held at the row's own moment.

Versions are cut into chunks of time. A chunk of a code holds the versions that began in it and the one carried in from
before, so a row finds its version inside its own chunk: an equi-join on code and chunk whose range condition picks one
interval. Rows are never grouped by code. What is grouped are chunks: one summary row per code and chunk is carried
forward, so a code with a long history or most of the rows is many chunks, and a hot chunk is split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.operators.skew import hot_join

DAY = 86_400


def as_of(
    rows: DataFrame,
    versions: DataFrame,
    code: str,
    at: Column,
    values: list[str],
    version_code: str = "code",
    since: str = "since",
    order: tuple[str, ...] = (),
    gone: Column | None = None,
    how: str = "inner",
    chunk: int = DAY,
) -> DataFrame:
    """``rows`` with the columns ``values`` of the last version of their code that began at or before ``at``.

    ``since`` and ``at`` are numbers in one unit, in chunks of ``chunk``. Versions of a code that begin together are
    ordered by ``order`` and the last holds. A version for which ``gone`` holds ends the code: rows in its time, before
    the first version, without a code or without a time have no version; they are dropped, or kept with nulls when
    ``how`` is ``left``. Rows that repeat are kept as often; ``values`` must not be columns of ``rows``.
    """
    place = lambda moment: F.floor(moment / F.lit(chunk))
    alive = ~F.coalesce(gone, F.lit(False)) if gone is not None else F.lit(True)
    known = versions.where(F.col(version_code).isNotNull() & F.col(since).isNotNull())
    known = known.select(
        F.col(version_code).alias("_code"), place(F.col(since)).alias("_chunk"), F.col(since).alias("_since"), F.struct(*order).alias("_order") if order else F.lit(0).alias("_order"), alive.alias("_alive"), F.struct(*values).alias("_values")
    )
    # of versions that begin together, the last
    known = known.groupBy("_code", "_chunk", "_since").agg(F.max_by(F.struct("_alive", "_values"), "_order").alias("_version"))

    facts = rows.withColumn("_at", at).withColumn("_at_chunk", place(F.col("_at")))
    asked = facts.where(F.col(code).isNotNull() & F.col("_at").isNotNull()).select(F.col(code).alias("_code"), F.col("_at_chunk").alias("_chunk")).distinct()
    begun = known.groupBy("_code", "_chunk").agg(F.max_by(F.struct("_since", "_version"), "_since").alias("_last"))
    summary = asked.withColumn("_asked", F.lit(True)).join(begun, ["_code", "_chunk"], "full")
    before = Window.partitionBy("_code").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.withColumn("_carried", F.last("_last", ignorenulls=True).over(before)).where("_asked and _carried is not null")
    carried = carried.select("_code", "_chunk", F.col("_carried._since").alias("_since"), F.col("_carried._version").alias("_version"))

    held = known.select("_code", "_chunk", "_since", "_version").unionByName(carried)
    after = Window.partitionBy("_code", "_chunk").orderBy("_since")
    held = held.withColumn("_until", F.lead("_since").over(after)).where("_version._alive")
    held = held.select("_code", "_chunk", "_since", "_until", "_version._values")
    inside = (F.col("_at") >= F.col("_since")) & (F.col("_until").isNull() | (F.col("_at") < F.col("_until")))
    found = hot_join(facts, held, {code: "_code", "_at_chunk": "_chunk"}, how, extra=inside)
    return found.select(*rows.columns, "_values.*")
