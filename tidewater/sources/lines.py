"""Line sources. The same call reads a topic or files, as a batch or a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater import schemas
from tidewater.functions.time import et_from_millis, et_from_seconds
from tidewater.operators.changes import choose_row
from tidewater.operators.logs import dead_letters, parse, parse_records, valid, valid_records


def read_lines(
    spark: SparkSession, fmt: str, start: str = "earliest", stream: bool = False, path: str | None = None, **options: str
) -> DataFrame:
    """Raw lines as a string column ``value``; lines of a topic also have their offset in ``pos``.

    ``start`` is the offset a topic is read from, ``earliest`` for tables and ``latest`` for raw logs; file
    formats have no offsets. The Kafka format needs its public Spark package on the class path.
    """
    reader = spark.readStream if stream else spark.read
    if fmt == "kafka":
        options = {"startingOffsets": start if stream else "earliest", **options}
    loaded = reader.format(fmt).options(**options).load(path)
    value = F.col("value").cast("string").alias("value")
    return loaded.select(value, F.col("offset").alias("pos")) if fmt == "kafka" else loaded.select(value)


def read_raw_log(spark: SparkSession, fmt: str, stream: bool = False, path: str | None = None, **options: str) -> DataFrame:
    return read_lines(spark, fmt, "latest", stream, path, **options)


def change_log(lines: DataFrame) -> DataFrame:
    """Change log out of JSON lines; lines that do not parse are skipped.

    A position ``pos`` of the lines is kept: changes of one key lie in one partition of a topic, so it orders the
    changes that share a second.
    """
    return valid(parse(lines, schemas.CHANGE_LOG))


def change_log_dead_letters(lines: DataFrame) -> DataFrame:
    return dead_letters(parse(lines, schemas.CHANGE_LOG))


def app_log(lines: DataFrame) -> DataFrame:
    """Application log out of JSON lines: its columns and the whole ``record``."""
    return valid_records(parse_records(lines), schemas.APP_LOG)


def config_changes(lines: DataFrame, row: T.StructType = schemas.DIM_CONFIG) -> DataFrame:
    """Configuration changes out of change-envelope JSON lines: ``op``, the row concerned, ``seq``."""
    return choose_row(valid(parse(lines, schemas.config_change(row))))


def facts(lines: DataFrame, schema: T.StructType, unit: str = "seconds", delay: str | None = None) -> DataFrame:
    """A derived fact table out of JSON lines, with its event time ``et`` and, given ``delay``, a watermark."""
    to_time = {"seconds": et_from_seconds, "millis": et_from_millis}[unit]
    rows = valid(parse(lines, schema)).withColumn("et", to_time(F.col("ts")))
    return rows.withWatermark("et", delay) if delay else rows


def _piece(value: Column, at: int) -> Column:
    return F.get(F.split(value, ","), at)


def readings(lines: DataFrame) -> DataFrame:
    """Comma records ``key,sec,val`` as typed columns; lines without a number in both places are dropped."""
    value = F.col("value")
    rows = lines.select(
        _piece(value, 0).alias("key"), _piece(value, 1).try_cast("int").alias("sec"), _piece(value, 2).try_cast("int").alias("val")
    )
    return rows.where(F.col("sec").isNotNull() & F.col("val").isNotNull())


def pairs(lines: DataFrame) -> DataFrame:
    """Comma records ``key,sec`` as typed columns."""
    value = F.col("value")
    rows = lines.select(_piece(value, 0).alias("key"), _piece(value, 1).try_cast("int").alias("sec"))
    return rows.where(F.col("sec").isNotNull())


def dictionary(rows: DataFrame, code: str, name: str) -> DataFrame:
    """A code table with its name nested the way a column-family store returns it."""
    return rows.select(F.col(code).alias("dic_code"), F.struct(F.col(name).alias("dic_name")).alias("info"))
