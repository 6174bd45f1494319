"""The shape of physical plans: what is pruned, pushed down, combined before a shuffle and split when hot."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan
from tidewater import fixtures as fx
from tidewater.operators import changes, skew, visits, windows
from tidewater.operators.routing import dim_route
from tidewater.plans import warehouse
from tidewater.session import settings


def test_table_filter_prunes_all_other_branches(spark, sf):
    log = changes.rows_of(fx.change_log(spark, sf), "comment_info", "insert", fx.DATABASE)
    text = plan(changes.pick(log, "id"))
    assert "Union" not in text and "lineitem" not in text and "documents" in text


def test_configured_tables_prune_the_log(spark, sf):
    text = plan(dim_route(fx.change_log(spark, sf), fx.dim_config(spark)))
    assert "lineitem" not in text and "supplier" not in text and "customer" in text


def test_log_stored_by_table_reads_configured_folders_only(spark, sf, tmp_path):
    log = fx.user_changes(spark, sf).unionByName(fx.static_changes(spark, sf))
    log.write.partitionBy("table").parquet(str(tmp_path / "log"))
    stored = spark.read.parquet(str(tmp_path / "log"))
    text = plan(dim_route(stored, fx.dim_config(spark)))
    assert "PartitionFilters: [table" in text.replace("isnotnull(table", "table").replace("PartitionFilters: [isnotnull", "PartitionFilters: [table")


def test_filter_reaches_the_scan(spark, sf):
    text = plan(fx.table(spark, sf, "lineitem").where("l_discount >= 0.05").select("l_orderkey"))
    assert "GreaterThanOrEqual(l_discount" in text and "l_comment" not in text


def test_top_values_are_limited_before_the_shuffle(spark, sf):
    text = plan(windows.top_per_window(windows.sliding_count(fx.readings(spark, sf), "2 hours", "1 hour")))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_no_cross_join_or_single_partition(spark, sf):
    log, flat = fx.change_log(spark, sf), visits.flat_visits(fx.app_log(spark, sf))
    frames = [
        warehouse.dimension_rows(log, fx.dim_config(spark), fx.DATABASE),
        windows.traffic_window(flat),
        visits.daily_visitor_flag(flat),
        visits.session_flag(flat),
        visits.repair_new_flag(fx.app_log(spark, sf)),
        visits.jump_alert(fx.readings(spark, sf), 3600),
    ]
    for df in frames:
        text = plan(df)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text and "SinglePartition" not in text


def test_visit_flag_never_shuffles_by_device_alone(spark, sf):
    text = plan(visits.daily_visitor_flag(visits.flat_visits(fx.app_log(spark, sf))))
    assert "Window" not in text and "partial_min" in text


@pytest.fixture
def small_skew(spark):
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="50KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="50KB",
    ):
        yield


def hot(spark):
    return spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 5000)).alias("key"),
        F.hash("id").alias("v"),
    )


def test_hot_key_is_split(spark, small_skew):
    """Half of the rows under one key: the joined summary is right and the hot partition is read in parts."""
    df = hot(spark)
    joined = skew.attach(df, df.groupBy("key").agg(F.min("v").alias("least")), "key")
    assert joined.where("least > v").count() == 0
    joined = joined.select("key", "v", "least")
    assert len(joined.collect()) == 200_000
    assert "skew=true" in plan(joined)


def test_hot_order_is_split_after_a_join_on_it(spark, small_skew):
    left = hot(spark).join(spark.range(1).select(F.lit("hot").alias("key"), F.lit(1).alias("flag")), "key", "left")
    right = left.groupBy("key").agg(F.count("*").alias("n")).withColumnRenamed("key", "other")
    joined = skew.hot_join(left, right, {"key": "other"}).select("key", "v", "n")
    assert len(joined.collect()) == 200_000
    assert "skew=true" in plan(joined)
