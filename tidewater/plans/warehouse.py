"""The warehouse jobs: dimensions, log split, dynamic split, facts and window summaries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewater import schemas
from tidewater.operators.changes import config_snapshot, dim_etl, drop_bootstrap
from tidewater.operators.logs import dead_letters, fields_of, pages, parse_records, routes, valid_records
from tidewater.operators.routing import ConfigHistory, dim_route, dim_route_at, dwd_route
from tidewater.operators.visits import HOUR_MS, flat_visits, repair_new_flag
from tidewater.functions.text import tokens
from tidewater.functions.time import et_from_millis
from tidewater.operators import windows
from tidewater.operators.windows import keyword_window, search_terms, traffic_window
from tidewater.sinks.files import write_by_target
from tidewater.sources.lines import app_log
from tidewater.sinks.keyed import CellTable, cell_rows
from tidewater.streaming import state


def _start(
    log: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, interval: str | None
) -> StreamingQuery:
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return log.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def dimension_rows(log: DataFrame, config: DataFrame, database: str) -> DataFrame:
    """Current dimension rows: change log, cleaned, routed by configuration, pruned and folded by row key."""
    return cell_rows(dim_route(dim_etl(log, database), config))


def dimension_stream(
    log: DataFrame,
    read_config: Callable[[], DataFrame],
    table: CellTable,
    checkpoint: str,
    database: str,
    interval: str | None = None,
) -> StreamingQuery:
    """The dimension job as a stream: each batch reads the configuration changes so far and stores its cells.

    Without ``interval`` the job handles what is there now and ends.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        config = config_snapshot(read_config())
        table.write_batch(dim_route(dim_etl(batch, database), config, f"{checkpoint}-config"), batch_id)

    return _start(log, write, checkpoint, interval)


def dimension_stream_at(
    log: DataFrame, config: DataFrame, path: str, checkpoint: str, database: str, at: str = "pos", interval: str | None = None
) -> StreamingQuery:
    """The dimension routing as one stream over both logs: a change goes where the configuration of its position sends it.

    ``config`` streams configuration changes. Both logs advance together in a batch; a configuration change that arrives
    after the changes of its position holds for those that follow. Routed rows of a batch overwrite their own folder.
    """
    spark = log.sparkSession
    history = ConfigHistory(spark, f"{checkpoint}-config", ("source_table",))
    both = log.select(F.struct(*log.columns).alias("change")).unionByName(config.select(F.struct(*config.columns).alias("entry")), allowMissingColumns=True)

    def write(batch: DataFrame, batch_id: int) -> None:
        known = history.advance(batch.where("entry is not null").select("entry.*"), batch_id)
        changes = dim_etl(batch.where("change is not null").select("change.*"), database)
        dim_route_at(changes, known, at).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return _start(both, write, checkpoint, interval)


def split_changes(log: DataFrame, config: DataFrame, staging: str | None = None) -> DataFrame:
    """Changes routed to the fact table their table and type are configured for."""
    return dwd_route(drop_bootstrap(log), config, staging)


def split_changes_stream(
    log: DataFrame,
    read_config: Callable[[], DataFrame],
    path: str,
    checkpoint: str,
    keys: tuple[str, ...] = ("source_table", "source_type"),
    interval: str | None = None,
) -> StreamingQuery:
    """The dynamic split as a stream: each batch reads the configuration as it stands and appends per target.

    Without ``interval`` the job handles what is there now and ends.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        routed = split_changes(batch, config_snapshot(read_config(), keys), f"{checkpoint}-config")
        routed.write.mode("overwrite").partitionBy("sink_table").parquet(f"{path}/batch={batch_id}")

    return _start(log, write, checkpoint, interval)


def stage_log(lines: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Parse log lines once into columns and the whole record at ``path``; returns valid records and dead letters.

    The steps after it read the log more than once and only some columns of it, which JSON text cannot offer.
    A second run replaces what the first has staged.
    """
    parse_records(lines).select(*fields_of(schemas.APP_LOG), "record", "bad").write.mode("overwrite").parquet(path)
    staged = lines.sparkSession.read.parquet(path)
    return staged.where(F.col("record").isNotNull()).drop("bad"), dead_letters(staged)


def write_log(lines: DataFrame, path: str, staging: str, run: int | None = None) -> None:
    """Log lines into the folder of their route: five for repaired records, ``dirty`` for what is no record.

    Given a ``run``, a repeated run overwrites its own rows.
    """
    log, bad = stage_log(lines, staging)
    dirty = bad.select(F.lit("dirty").alias("route"), "value")
    write_by_target(routes(repair_new_flag(log)).unionByName(dirty), path, "route", run)


def stored_pages(spark: SparkSession, path: str, staging: str | None = None) -> DataFrame:
    """The page output of the log split that lies under ``path``, as log rows for the summaries; other routes are not read.

    Given ``staging``, the lines are parsed once into columns there, without the whole record, for summaries that read
    their log more than once.
    """
    lines = spark.read.parquet(path).where(F.col("route") == "page").select("value")
    log = app_log(lines)
    if staging is None:
        return log
    columns = log.drop("record")
    columns.write.mode("overwrite").parquet(staging)
    return spark.read.schema(columns.schema).parquet(staging)


def log_line_stream(lines: DataFrame) -> DataFrame:
    """The log split as a stream of ``route, value``; the visitor flag comes from keyed state per device.

    A record passes the state as its key columns and its line, which Arrow moves as text, and is read again after it.
    """
    parsed = parse_records(lines)
    log = valid_records(parsed.select("record", "value"), schemas.APP_LOG)
    keyed = log.select("common.mid", "common.is_new", "ts", "seq", F.to_json("record").alias("value"))
    fixed = parse_records(state.repair_new_flag(keyed)).select(F.struct("is_new").alias("common"), "record")
    dirty = dead_letters(parsed).select(F.lit("dirty").alias("route"), "value")
    return routes(fixed).unionByName(dirty)


def keyword_summary(log: DataFrame, size: str = "5 seconds", tokenizer: Callable[[Column], Column] = tokens) -> DataFrame:
    return keyword_window(search_terms(pages(log)), size, tokenizer)


def keyword_stream(log: DataFrame, size: str = "5 seconds", delay: str = "5 seconds") -> DataFrame:
    """Keyword counts of a streamed log; a window appears once the watermark has passed it."""
    return keyword_window(search_terms(pages(log)).withWatermark("et", delay), size)


def traffic_summary(log: DataFrame, size: str = "5 seconds") -> DataFrame:
    return traffic_window(flat_visits(pages(log)), size)


def traffic_stream(log: DataFrame, size: str = "5 seconds", delay: str = "5 seconds", session_ttl_ms: int = HOUR_MS) -> DataFrame:
    """Traffic summary of a streamed log: visitor and session flags from keyed state, then one windowed sum."""
    visits = flat_visits(pages(log)).drop("day").withColumn("et", et_from_millis(F.col("ts"))).withWatermark("et", delay)
    flagged = state.session_flag(state.daily_visitor_flag(visits, et="et"), session_ttl_ms, et="et")
    measures = flagged.select(
        "et",
        *windows.DIMENSIONS,
        F.col("uv").cast("bigint").alias("uv_count"),
        F.col("sv").cast("bigint").alias("sv_count"),
        F.lit(1).cast("bigint").alias("pv_count"),
        F.coalesce("during_time", F.lit(0)).cast("bigint").alias("duration_sum"),
    )
    return windows.traffic_summary(measures, size)
