"""Rows for a message topic: key and value as JSON text, the topic fixed or taken from a column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def _json(columns: tuple[str, ...]) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def topic_rows(df: DataFrame, keys: tuple[str, ...] = (), topic: str | None = None, topic_column: str | None = None) -> DataFrame:
    """Columns ``key, value`` and, when asked for, ``topic``, as the Kafka format takes them.

    With ``keys`` a reader of a compacted topic keeps the last row per key; without, every row counts.
    """
    body = tuple(c for c in df.columns if c != topic_column)
    columns = [(_json(keys) if keys else F.lit(None).cast("string")).alias("key"), _json(body).alias("value")]
    if topic_column or topic:
        columns.append((F.col(topic_column) if topic_column else F.lit(topic)).alias("topic"))
    return df.select(*columns)


def publish(rows: DataFrame, checkpoint: str, interval: str = "5 seconds", **options: str) -> StreamingQuery:
    """Write topic rows to Kafka; needs its public Spark package, and delivers at least once."""
    writer = rows.writeStream.format("kafka").options(**options).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=interval).start()
