"""Stored pages of the log split, parsed once for summaries that read them more than once."""

from pyspark.sql import functions as F

from tests.conftest import rows
from tidewater.plans import warehouse


def test_parsed_pages_give_the_same_summary_without_json(spark, tmp_path):
    pages = [
        '{"common":{"mid":"m1","sid":"s1","vc":"v","ch":"c","ar":"1","is_new":"1"},"page":{"during_time":"7"},"seq":1,"ts":1704067200000}',
        '{"common":{"mid":"m1","sid":"s1","vc":"v","ch":"c","ar":"1","is_new":"1"},"page":{"during_time":"7"},"seq":1,"ts":1704067200000}',
        '{"common":{"mid":null,"sid":null,"vc":"v","ch":null,"ar":"1","is_new":"0"},"page":{"during_time":null},"seq":2,"ts":1704070800000}',
        '{"common":{"mid":"m2"},"seq":"x","ts":1704070800001}',
    ]
    made = spark.createDataFrame([(p,) for p in pages], "value string").withColumn("route", F.lit("page"))
    made.write.partitionBy("route").parquet(f"{tmp_path}/split")
    read_again = warehouse.stored_pages(spark, f"{tmp_path}/split")
    parsed = warehouse.stored_pages(spark, f"{tmp_path}/split", f"{tmp_path}/pages")
    assert rows(warehouse.traffic_summary(parsed, "1 hour")) == rows(warehouse.traffic_summary(read_again, "1 hour"))
    assert all("/pages/" in file for file in parsed.inputFiles()) and "record" not in parsed.columns
