"""Lookups and configurations as of a moment, against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidewater import schemas
from tidewater.operators.asof import as_of
from tidewater.operators.routing import ConfigHistory, dwd_route_at

FACT, VERSION = "id int, code string, at long", "code string, since long, n int, name string, gone boolean"


def plain(facts, versions, how):
    out = []
    for i, code, at in facts:
        past = [v for v in versions if code is not None and at is not None and v[0] == code and v[1] is not None and v[1] <= at]
        last = max(past, key=lambda v: (v[1], v[2]), default=None)
        if last is not None and not last[4]:
            out.append((i, code, at, last[3]))
        elif how == "left":
            out.append((i, code, at, None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("chunk", [1, 7, 1000])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_as_of(spark, how, chunk):
    """Ties of time, ends, nulls, negative times, one hot code, codes without versions and rows that repeat."""
    rng = random.Random(chunk)
    codes = ["hot"] * 6 + ["a", "b", "never", None]
    facts = [(i % 190, rng.choice(codes), rng.choice([None, *range(-30, 60)])) for i in range(400)]
    versions = [(rng.choice(["hot", "hot", "a", "b", None]), rng.choice([None, *range(-20, 50)]), n, f"v{n}", rng.random() < 0.2) for n in range(80)]
    got = as_of(spark.createDataFrame(facts, FACT), spark.createDataFrame(versions, VERSION), "code", F.col("at"), ["name"], order=("n",), gone=F.col("gone"), how=how, chunk=chunk)
    assert rows(got) == plain(facts, versions, how)


def test_as_of_without_versions_or_rows(spark):
    facts = spark.createDataFrame([(1, "a", 5)], FACT)
    none = spark.createDataFrame([], VERSION)
    assert rows(as_of(facts, none, "code", F.col("at"), ["name"], how="left")) == [(1, "a", 5, None)]
    assert as_of(facts.limit(0), none, "code", F.col("at"), ["name"]).count() == 0


def test_a_hot_code_is_joined_by_chunk(spark):
    """The join key is code and chunk; no step groups the rows of a code but for the distinct chunks they ask for."""
    from tests.conftest import plan

    facts = spark.range(1000).select(F.col("id").cast("int"), F.lit("hot").alias("code"), F.col("id").alias("at"))
    versions = spark.range(100).select(F.lit("hot").alias("code"), (F.col("id") * 10).alias("since"), F.col("id").cast("int").alias("n"), F.concat(F.lit("v"), "id").alias("name"), F.lit(False).alias("gone"))
    found = as_of(facts, versions, "code", F.col("at"), ["name"], chunk=50)
    assert "Window" in plan(found) and rows(found.where("id = 999").select("name")) == [("v99",)]


CONFIG = "op string, source_table string, source_type string, sink_table string, sink_columns string, seq long"


def changes(spark, *kinds):
    made = [("db", t, k, {"id": str(p), "x": "1"}, None, p, p) for t, k, p in kinds]
    return spark.createDataFrame(made, "database string, table string, type string, data map<string,string>, old map<string,string>, ts long, pos long")


def test_facts_are_routed_by_table_type_and_position(spark):
    config = spark.createDataFrame([("c", "t", "insert", "one", "id", 10), ("u", "t", "insert", "two", "id,x", 20), ("d", "t", "insert", "two", "id,x", 30), ("c", "t", "update", "upd", "id", 0), ("c", None, "insert", "odd", "id", 0)], CONFIG)
    log = changes(spark, ("t", "insert", 9), ("t", "insert", 10), ("t", "insert", 19), ("t", "insert", 20), ("t", "insert", 31), ("t", "update", 5), ("u", "insert", 15), (None, "insert", 15))
    got = rows(dwd_route_at(log, config, chunk=8).select("sink_table", "pos", F.sort_array(F.map_keys("data")).alias("k")))
    assert got == sorted([("one", 10, ["id", "ts"]), ("one", 19, ["id", "ts"]), ("two", 20, ["id", "ts", "x"]), ("upd", 5, ["id", "ts"])], key=repr)


def test_history_keeps_one_entry_per_key(spark, tmp_path):
    """A batch reads the entries before it and its own changes; a repeated batch reads the same again."""
    history = ConfigHistory(spark, str(tmp_path), ("source_table",))
    schema = "op string, source_table string, sink_table string, seq long"
    first = [("c", "t", f"s{n}", n) for n in range(50)]
    assert history.advance(spark.createDataFrame(first, schema), 0).count() == 50
    second = spark.createDataFrame([("d", "t", "s50", 50), ("c", "u", "v", 51)], schema)
    for _ in range(2):
        assert rows(history.advance(second, 1)) == sorted([("c", "t", "s49", 49), ("d", "t", "s50", 50), ("c", "u", "v", 51)], key=repr)
    assert rows(history.advance(second.limit(0), 2)) == sorted([("d", "t", "s50", 50), ("c", "u", "v", 51)], key=repr)


def test_versions_have_the_documented_shape(spark):
    from tests.conftest import SMALL
    from tidewater import fixtures as fx

    for made in (fx.dictionary_versions(spark, SMALL), fx.grade_versions(spark, SMALL)):
        assert [(f.name, f.dataType) for f in made.schema.fields] == [(f.name, f.dataType) for f in schemas.DICTIONARY_VERSION.fields]
