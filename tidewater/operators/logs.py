"""Application log: JSON validation, five-way split and fan-out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BAD = "_bad"


def _once(lines: DataFrame, name: str, decoded: Column) -> DataFrame:
    """``decoded`` as a column that filters and projections after it do not compute again."""
    return lines.select("*", F.explode(F.array(decoded)).alias(name))


def parse(lines: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Each line with its decoded ``row`` and, for a line that is no valid record, its text in ``bad``."""
    wanted = T.StructType(schema.fields + [T.StructField(BAD, T.StringType())])
    decoded = _once(lines, "row", F.from_json(value, wanted, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}))
    return decoded.withColumn("bad", F.when(F.col("row").isNull(), F.col(value)).otherwise(F.col(f"row.{BAD}")))


def valid(parsed: DataFrame) -> DataFrame:
    """Fields of the valid records, after them the position ``pos`` where the lines have one."""
    kept = ["pos"] if "pos" in parsed.columns else []
    return parsed.where(F.col("bad").isNull() & F.col("row").isNotNull()).select("row.*", *kept).drop(BAD)


def parse_records(lines: DataFrame, value: str = "value") -> DataFrame:
    """Each line with its JSON object as the variant ``record`` or, when it is no JSON object, its text in ``bad``.

    The line is read between brackets, so that anything after the object is an error or a second element. A NULL
    line has neither.
    """
    bracketed = F.try_parse_json(F.concat(F.lit("["), F.col(value), F.lit("]")))
    items = _once(lines, "_items", F.try_variant_get(bracketed, "$", "array<variant>"))
    record = F.get("_items", 0)
    is_object = (F.size("_items") == 1) & F.try_variant_get(record, "$", "map<string,variant>").isNotNull()
    found = items.withColumn("record", F.when(is_object, record)).drop("_items")
    return found.withColumn("bad", F.when(F.col("record").isNull(), F.col(value)))


def fields_of(schema: T.StructType) -> list[Column]:
    """The columns of ``schema`` read from ``record``, NULL where a field has another form."""
    return [F.try_variant_get("record", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in schema.fields]


def valid_records(parsed: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``, the whole ``record``, and the position ``pos`` where the lines have one."""
    kept = ["record"] + (["pos"] if "pos" in parsed.columns else [])
    return parsed.where(F.col("record").isNotNull()).select(*fields_of(schema), *kept)


def dead_letters(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("bad").isNotNull()).select(F.col("bad").alias("value"))


def errors(log: DataFrame) -> DataFrame:
    """Records with an error, whole."""
    return log.where(F.col("err").isNotNull())


def starts(log: DataFrame) -> DataFrame:
    """Start records; one that also held an error goes on without it."""
    return log.where(F.col("start").isNotNull()).drop("err")


def displays(log: DataFrame) -> DataFrame:
    """One row per displayed item of a record that is no start."""
    return log.where(F.col("start").isNull()).select("common", "page", F.explode("displays").alias("display"), "ts", "seq")


def actions(log: DataFrame, keep_ts: bool = False) -> DataFrame:
    """One row per action of a record that is no start; the time is left out unless asked for."""
    ts = F.col("ts") if keep_ts else F.lit(None).cast("bigint")
    return log.where(F.col("start").isNull()).select(
        "common", "page", F.explode("actions").alias("action"), ts.alias("ts"), "seq"
    )


def pages(log: DataFrame) -> DataFrame:
    """What is left of a record that is no start, without error, displays and actions."""
    return log.where(F.col("start").isNull()).select("common", "page", "ts", "seq")


def _filled(value: Column) -> Column:
    """A variant, with NULL for the null of JSON."""
    return F.when(~F.is_variant_null(value), value)


def _with_flag(record: Column, is_new: Column) -> Column:
    """The fields of a record, ``is_new`` of its ``common`` replaced when it is another."""
    fields = F.try_variant_get(record, "$", "map<string,variant>")
    common = F.try_variant_get(record, "$.common", "map<string,variant>")
    fixed = F.transform_values(common, lambda k, v: F.when(k == "is_new", is_new.cast("variant")).otherwise(v))
    changed = F.transform_values(fields, lambda k, v: F.when(k == "common", F.to_variant_object(fixed)).otherwise(v))
    same = is_new.eqNullSafe(F.try_variant_get(record, "$.common.is_new", "string"))
    return F.when(same, fields).otherwise(changed)


def routes(log: DataFrame) -> DataFrame:
    """All five outputs in one pass: a row ``route, value`` per output record, the value being JSON text.

    The texts are made from the whole ``record`` with the flag in ``common.is_new``: fields that no schema names,
    numbers and nested values go along. The page output is what is left without error, displays and actions.
    """
    fields = log.select(F.explode(F.array(_with_flag(F.col("record"), F.col("common.is_new")))).alias("f"))
    part = {name: _filled(F.col("f")[name]) for name in ("common", "page", "displays", "actions", "err", "start", "ts")}
    started = part["start"].isNotNull()

    def without(*names: str) -> Column:
        return F.to_json(F.map_filter("f", lambda k, _: ~k.isin(*names)))

    def one(route: str, condition: Column, value: Column) -> Column:
        return F.when(condition, F.array(F.struct(F.lit(route).alias("route"), value.alias("value"))))

    def many(route: str, items: str, *after: str) -> Column:
        def output(item: Column) -> Column:
            own = [part["common"].alias("common"), part["page"].alias("page"), item.alias(route)]
            value = F.to_json(F.struct(*own, *[part[name].alias(name) for name in after]))
            return F.struct(F.lit(route).alias("route"), value.alias("value"))

        return F.when(~started, F.transform(F.try_variant_get(part[items], "$", "array<variant>"), output))

    nothing = F.array().cast("array<struct<route:string,value:string>>")
    parts = [
        one("err", part["err"].isNotNull(), F.to_json("f")),
        one("start", started, without("err")),
        many("display", "displays", "ts"),
        many("action", "actions"),
        one("page", ~started, without("err", "displays", "actions")),
    ]
    out = F.concat(*[F.coalesce(p, nothing) for p in parts])
    return fields.select(F.explode(out).alias("out")).select("out.*")
