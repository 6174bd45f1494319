"""Filters over the change log on hand-made rows: missing keys, unknown old values, odd types."""

from pyspark.sql import functions as F

from tests.conftest import rows
from tidewater import schemas
from tidewater.catalog import QUERIES, dims
from tidewater.functions.values import keep_columns, with_entry
from tidewater.operators import changes
from tidewater.operators.routing import dim_route, dwd_route
from tidewater.plans import warehouse
from tidewater.session import settings
from tidewater.sinks.keyed import CellTable, cell_rows
from tidewater.sources import lines as src


def log(spark, *records):
    full = [("shop", *r) if len(r) == 5 else r for r in records]
    return spark.createDataFrame(full, schemas.CHANGE_LOG)


def test_missing_key_gives_null(spark):
    df = log(spark, ("t", "insert", {"id": "1"}, None, 5))
    assert rows(changes.pick(df, "id", "nothing")) == [("1", None, 5)]


def test_rows_of_needs_database_table_and_type(spark):
    df = log(
        spark,
        ("t", "insert", {"id": "1"}, None, 1),
        ("t", "update", {"id": "2"}, None, 1),
        ("u", "insert", {"id": "3"}, None, 1),
        ("other", "t", "insert", {"id": "4"}, None, 1),
    )
    assert rows(changes.pick(changes.rows_of(df, "t", "insert", "shop"), "id")) == [("1", 1)]


def test_changed_to_and_its_strict_form(spark):
    df = log(
        spark,
        ("t", "update", {"id": "changed", "s": "9"}, {"s": "1"}, 1),
        ("t", "update", {"id": "same", "s": "9"}, {"s": "9"}, 1),
        ("t", "update", {"id": "untouched", "s": "9"}, {"x": "1"}, 1),
        ("t", "update", {"id": "no-old", "s": "9"}, None, 1),
        ("t", "update", {"id": "else", "s": "8"}, {"s": "1"}, 1),
    )
    loose = {r[0] for r in rows(changes.pick(df.where(changes.changed_to("s", "9")), "id"))}
    strict = {r[0] for r in rows(changes.pick(df.where(changes.changed_to_strict("s", "9")), "id"))}
    assert loose == {"changed", "same"}
    assert strict == {"changed"}


def test_cart_add(spark):
    def cart(i, kind, now, before):
        return ("cart_info", kind, {"id": i, "user_id": "u", "sku_id": "s", "sku_num": now}, before, 1)

    df = log(
        spark,
        cart("insert", "insert", "3", None),
        cart("grown", "update", "10", {"sku_num": "9"}),
        cart("shrunk", "update", "2", {"sku_num": "9"}),
        cart("equal", "update", "9", {"sku_num": "9"}),
        cart("other-column", "update", "9", {"price": "1"}),
        cart("no-number", "update", "x", {"sku_num": "9"}),
        cart("deleted", "delete", "9", {"sku_num": "1"}),
    )
    assert [(r[0], r[3]) for r in rows(changes.cart_add(df, "shop"))] == [("grown", "1"), ("insert", "3")]


def test_dim_etl_and_bootstrap(spark):
    df = log(
        spark,
        ("t", "insert", {"id": "1"}, None, 1),
        ("t", "bootstrap-insert", {"id": "2"}, None, 2),
        ("t", "bootstrap-start", {}, None, 3),
        ("t", "insert", {}, None, 4),
        ("t", "insert", None, None, 5),
        ("t", "truncate", {"id": "6"}, None, 6),
        ("elsewhere", "t", "insert", {"id": "7"}, None, 7),
    )
    assert [r[-1] for r in rows(changes.dim_etl(df, "shop").select("ts"))] == [1, 2]
    assert sorted(r[0] for r in changes.drop_bootstrap(df).select("ts").collect()) == [1, 4, 5, 6, 7]


def test_config_snapshot_takes_the_last_change(spark):
    lines = [
        '{"op":"r","before":null,"after":{"source_table":"a","sink_columns":"x"},"seq":1}',
        '{"op":"u","before":{"source_table":"a","sink_columns":"x"},"after":{"source_table":"a","sink_columns":"y"},"seq":2}',
        '{"op":"c","before":null,"after":{"source_table":"b","sink_columns":"x"},"seq":3}',
        '{"op":"d","before":{"source_table":"b","sink_columns":"x"},"after":null,"seq":4}',
        '{"op":"d","before":{"source_table":"c","sink_columns":"x"},"after":null,"seq":5}',
        '{"op":"c","before":null,"after":{"source_table":"c","sink_columns":"z"},"seq":6}',
        '{"op":"c","after":{"source_tab',
    ]
    parsed = src.config_changes(spark.createDataFrame([(l,) for l in lines], "value string"))
    now = changes.config_snapshot(parsed).select("source_table", "sink_columns")
    assert rows(now) == [("a", "y"), ("c", "z")]


def test_prune_and_add_entry(spark):
    df = log(spark, ("t", "insert", {"id": "1", "name": "n", "x": "y", "type": "old"}, None, 1))
    kept = df.select(keep_columns(F.col("data"), F.lit("id,name,absent")).alias("m"))
    assert kept.first().m == {"id": "1", "name": "n"}
    assert df.select(with_entry(F.col("data"), "type", F.lit("new")).alias("m")).first().m["type"] == "new"


def test_routes(spark):
    dims = spark.createDataFrame([("user", "dim_user", "id,name", "info", "id")], schemas.DIM_CONFIG)
    facts = spark.createDataFrame([("user", "insert", "dwd_user", "id")], schemas.SPLIT_CONFIG)
    df = log(
        spark,
        ("user", "insert", {"id": "1", "name": "n", "age": "3"}, None, 7),
        ("user", "update", {"id": "2", "name": "n"}, None, 8),
        ("nobody", "insert", {"id": "3"}, None, 9),
    )
    routed = {r.row_key: r for r in dim_route(df, dims).collect()}
    assert set(routed) == {"1", "2"}
    assert routed["1"].data == {"id": "1", "name": "n", "type": "insert"} and routed["1"].sink_table == "dim_user"
    assert [r.data for r in dwd_route(df, facts).collect()] == [{"id": "1", "ts": "7"}]


def test_routes_without_broadcast(spark):
    """A configuration that Spark measures above the threshold is joined like any table and gives the same rows."""
    dims = spark.createDataFrame([("user", "dim_user", "id", "info", "id"), (None, "none", "id", "info", "id")], schemas.DIM_CONFIG)
    df = log(spark, ("user", "insert", {"id": "1"}, None, 7), ("x", "insert", {"id": "3"}, None, 9))
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        routed = dim_route(df, dims)
        assert "Broadcast" not in routed._jdf.queryExecution().executedPlan().toString()
        assert [r.row_key for r in routed.collect()] == ["1"]


def test_routes_with_no_configuration(spark):
    df = log(spark, ("user", "insert", {"id": "1"}, None, 7))
    assert dim_route(df, spark.createDataFrame([], schemas.DIM_CONFIG)).collect() == []


def test_cells(spark):
    """An empty cell leaves the old one, a delete clears the row, a later write starts it anew."""
    changed = [
        ("t", "1", {"a": "x", "b": "y", "type": "insert"}, "insert", 1),
        ("t", "1", {"a": "z", "b": "", "type": "update"}, "update", 2),
        ("t", "2", {"a": "x", "type": "insert"}, "insert", 1),
        ("t", "2", {"a": "x", "type": "delete"}, "delete", 2),
        ("t", "3", {"a": "x", "b": "y", "type": "insert"}, "insert", 1),
        ("t", "3", {"a": "x", "type": "delete"}, "delete", 2),
        ("t", "3", {"a": "w", "type": "insert"}, "insert", 3),
        ("u", "1", {"a": "other table", "type": "insert"}, "insert", 1),
    ]
    df = spark.createDataFrame(changed, "sink_table string, row_key string, data map<string,string>, type string, ts bigint")
    got = {(r.sink_table, r.row_key): r.data for r in cell_rows(df).collect()}
    assert got == {("t", "1"): {"a": "z", "b": "y"}, ("t", "3"): {"a": "w"}, ("u", "1"): {"a": "other table"}}


def test_stored_cells(spark, tmp_path):
    """Cells over batches, one of them repeated, give the rows of all changes at once."""
    schema = "sink_table string, row_key string, data map<string,string>, type string, ts bigint"
    batches = [
        [("t", "1", {"a": "x", "b": "y"}, "insert", 1), ("t", "2", {"a": "x"}, "insert", 1)],
        [("t", "1", {"a": "z", "b": ""}, "update", 2), ("t", "2", {"a": "x"}, "delete", 2)],
        [("t", "2", {"b": "new"}, "insert", 3)],
    ]
    table = CellTable(spark, str(tmp_path / "cells"))

    def state():
        return {r.row_key: r.data for r in table.read().collect()}

    for i in (0, 1, 1):
        table.write_batch(spark.createDataFrame(batches[i], schema), i)
    assert state() == {"1": {"a": "z", "b": "y"}}
    table.write_batch(spark.createDataFrame(batches[2], schema), 2)
    assert state() == {"1": {"a": "z", "b": "y"}, "2": {"b": "new"}}


def test_split_stream_reads_the_configuration_per_batch(spark, tmp_path):
    """Each batch of the dynamic split uses the configuration as it then stands."""
    one = log(spark, ("user", "insert", {"id": "1", "name": "n"}, None, 1))
    two = log(spark, ("user", "insert", {"id": "2", "name": "n"}, None, 2))
    one.coalesce(1).write.parquet(str(tmp_path / "in"))
    states = iter([("id", 1), ("id,name", 2)])

    def config():
        columns, seq = next(states)
        return spark.createDataFrame(
            [("c", "user", "insert", "dwd_user", columns, seq)],
            "op string, source_table string, source_type string, sink_table string, sink_columns string, seq bigint",
        )

    def run():
        stream = spark.readStream.schema(one.schema).parquet(str(tmp_path / "in"))
        warehouse.split_changes_stream(stream, config, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()

    run()
    two.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    run()
    got = spark.read.parquet(str(tmp_path / "out")).select("sink_table", "data")
    assert sorted((r.sink_table, sorted(r.data)) for r in got.collect()) == [
        ("dwd_user", ["id", "name", "ts"]),
        ("dwd_user", ["id", "ts"]),
    ]


def test_changes_of_one_second_keep_the_order_of_the_log(spark, tmp_path):
    """The position in the log goes from the line to the merge, in whatever order the merge sees the rows."""
    lines = [
        ('{"database":"shop","table":"t","type":"delete","data":{"id":"1","a":"old"},"ts":5}', 1),
        ('{"database":"shop","table":"t","type":"insert","data":{"id":"1","a":"new"},"ts":5}', 2),
        ('{"database":"shop","table":"t","type":"update","data":{"id":"2","a":"a"},"ts":5}', 3),
        ('{"database":"shop","table":"t","type":"update","data":{"id":"2","a":"b"},"ts":5}', 4),
        ('{"database":"shop","table":"t","type":"insert","data":{"id":"3","a":"a"},"ts":5}', 5),
        ('{"database":"shop","table":"t","type":"delete","data":{"id":"3","a":"a"},"ts":5}', 6),
    ]
    dims = spark.createDataFrame([("t", "dim_t", "id,a", "info", "id")], schemas.DIM_CONFIG)
    for given in (lines, lines[::-1]):
        read = src.change_log(spark.createDataFrame(given, "value string, pos bigint"))
        got = {r.row_key: r.data["a"] for r in warehouse.dimension_rows(read, dims, "shop").collect()}
        assert got == {"1": "new", "2": "b"}
    table = CellTable(spark, str(tmp_path / "cells"))
    for batch, some in enumerate((lines[3:], lines[:3])):
        table.write_batch(dim_route(src.change_log(spark.createDataFrame(some, "value string, pos bigint")), dims), batch)
    assert {r.row_key: r.data["a"] for r in table.read().collect()} == {"1": "new", "2": "b"}


def test_steps_of_a_routed_stream_are_written_by_many_tasks(spark, tmp_path, sf, monkeypatch):
    made = spark.range(50).withColumn("v", F.lit("x"))
    for name, made_rows in (("all", made), ("few", made.where("id < 2")), ("none", made.where("id < 0"))):
        dims.write_step(made_rows, str(tmp_path / name), 5)
        staged = spark.read.schema(made.schema).parquet(str(tmp_path / name))
        assert len(staged.inputFiles()) == 5 and rows(staged) == rows(made_rows)
    monkeypatch.setattr(dims, "ORDERS_A_FILE", 400)
    assert rows(QUERIES["dim_route_at_stream"](spark, sf)) == rows(QUERIES["dim_route_at"](spark, sf))
