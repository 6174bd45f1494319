"""Filters and projections over the change log, and the current state of a changing configuration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.values import as_int

WRITE_TYPES = ("insert", "update", "delete", "bootstrap-insert")


def rows_of(log: DataFrame, table: str, kind: str, database: str) -> DataFrame:
    """Changes of one kind to one table."""
    return log.where((F.col("database") == database) & (F.col("table") == table) & (F.col("type") == kind))


def pick(log: DataFrame, *names: str, **renamed: str) -> DataFrame:
    """Columns out of the ``data`` map, plus ``ts``; a missing key gives NULL."""
    columns = [F.col("data")[name].alias(name) for name in names]
    columns += [F.col("data")[source].alias(alias) for alias, source in renamed.items()]
    return log.select(*columns, "ts")


def changed_to(column: str, value: str) -> Column:
    """The column was part of the change and now holds ``value``, even if it held it before."""
    return (F.col("data")[column] == value) & F.col("old")[column].isNotNull()


def changed_to_strict(column: str, value: str) -> Column:
    """The column now holds ``value`` and held a different, known one before."""
    return (F.col("data")[column] == value) & (F.col("data")[column] != F.col("old")[column])


def cart_add(log: DataFrame, database: str) -> DataFrame:
    """Added quantity per cart change: all of an insert, the growth of an update that grew."""
    now, before = as_int(F.col("data")["sku_num"]), as_int(F.col("old")["sku_num"])
    inserted = F.col("type") == "insert"
    grown = (F.col("type") == "update") & F.col("old")["sku_num"].isNotNull() & (now > before)
    data = F.col("data")
    return log.where(
        (F.col("database") == database) & (F.col("table") == "cart_info") & (inserted | grown)
    ).select(
        data["id"].alias("id"),
        data["user_id"].alias("user_id"),
        data["sku_id"].alias("sku_id"),
        F.when(inserted, data["sku_num"]).otherwise((now - before).cast("string")).alias("sku_num"),
        "ts",
    )


def dim_etl(log: DataFrame, database: str) -> DataFrame:
    """Row changes with a body; markers of the initial load and empty bodies are dropped."""
    return log.where(
        (F.col("database") == database) & F.col("type").isin(*WRITE_TYPES) & (F.size("data") > 0)
    )


def drop_bootstrap(log: DataFrame) -> DataFrame:
    """Everything but the messages of an initial load."""
    return log.where(~F.col("type").startswith("bootstrap-"))


def choose_row(changes: DataFrame) -> DataFrame:
    """The row a configuration change speaks of: ``before`` for a delete, else ``after``."""
    row = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    return changes.select("op", row.alias("row"), "seq").select("op", "row.*", "seq")


def config_snapshot(changes: DataFrame, keys: tuple[str, ...] = ("source_table",)) -> DataFrame:
    """Entries that hold after all changes: the last change per key, unless it is a delete."""
    rest = [c for c in changes.columns if c not in keys]
    last = changes.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col("seq")).alias("last"))
    return (
        last.where(F.col("last.op") != "d")
        .select(*keys, "last.*")
        .drop("op", "seq")
    )


