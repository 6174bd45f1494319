"""File writers for batches and streams."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewater.functions.text import snake_columns
from tidewater.operators.routing import by_token


def write_csv_gzip(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.option("sep", sep).option("header", True).option("compression", "gzip").mode("append").csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.json(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.parquet(path)


def write_text(df: DataFrame, path: str, codec: str = "none") -> None:
    """Text lines, compressed with a named codec (``none, bzip2, gzip, lz4, snappy, deflate, zstd``)."""
    df.write.option("compression", codec).text(path)


def write_by_target(df: DataFrame, path: str, target: str = "sink_table", run: int | None = None) -> None:
    """Each row into the folder of the target named in it.

    Given a ``run``, the rows stand under ``run=`` and a repeated run overwrites its own; else they are appended.
    """
    if run is None:
        df.write.partitionBy(target).mode("append").parquet(path)
    else:
        df.write.partitionBy(target).mode("overwrite").parquet(f"{path}/run={run}")


def write_routed(lines: DataFrame, path: str, token: str) -> None:
    """Lines with the token under ``route=main``, the others under ``route=other``, each ended by CR LF."""
    by_token(lines, token).write.partitionBy("route").option("lineSep", "\r\n").text(path)


def json_lines(df: DataFrame) -> DataFrame:
    """One JSON object per row, names in snake case, as a bulk loader takes them."""
    rows = snake_columns(df)
    return rows.select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("value"))


def write_json_lines(df: DataFrame, path: str) -> None:
    json_lines(df).write.text(path)


def append_stream(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", interval: str | None = None) -> StreamingQuery:
    """Exactly-once append to files; a restart with the same checkpoint neither loses nor repeats rows.

    Without ``interval`` the query handles what is there now and ends.
    """
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint).option("path", path)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def partition_concat(lines: DataFrame, piece_chars: int = 1 << 24) -> DataFrame:
    """The lines of each partition in one string, or in several of about ``piece_chars`` characters, no line cut.

    A partition without lines gives an empty string.
    """

    def concat(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces, rows, chars, whole = [], 0, 0, True
        for batch in batches:
            for text in batch["value"]:
                pieces.append(text)
                rows, chars = rows + 1, chars + len(text)
                if chars >= piece_chars:
                    yield pd.DataFrame({"n": [rows], "text": ["".join(pieces)]})
                    pieces, rows, chars, whole = [], 0, 0, False
        if rows or whole:
            yield pd.DataFrame({"n": [rows], "text": ["".join(pieces)]})

    return lines.select(F.coalesce("value", F.lit("")).alias("value")).mapInPandas(concat, "n bigint, text string")
