"""Files as they lie on disk: headers, codecs, line ends, routes, whole files and option building."""

import gzip
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidewater import schemas
from tidewater.functions.text import camel, snake
from tidewater.operators import basics
from tidewater.session import new_dir, shared_base
from tidewater.sinks import files as out
from tidewater.sinks.topics import topic_rows
from tidewater.sources import files, jdbc
from tidewater.sources import lines as src


def parts(path, suffix=""):
    return sorted(p for p in Path(path).rglob(f"part-*{suffix}"))


def text(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_csv_gzip_appends_and_reads_as_text(spark, tmp_path):
    users = spark.createDataFrame([(7, "Ann"), (8, "Bo")], schemas.USER).coalesce(1)
    out.write_csv_gzip(users, str(tmp_path / "u"))
    out.write_csv_gzip(users, str(tmp_path / "u"))
    written = parts(tmp_path / "u", ".csv.gz")
    assert len(written) == 2 and gzip.open(written[0], "rt").readline() == "age,name\n"
    back = files.read_csv(spark, str(tmp_path / "u"))
    assert back.dtypes == [("age", "string"), ("name", "string")] and back.count() == 4
    typed = basics.enforce_schema(back, schemas.USER)
    assert rows(typed)[0] == (7, "Ann")


def test_json_schema_is_found_or_given(spark, tmp_path):
    Path(tmp_path / "users.json").write_text('{"age": 12, "name": "Cy"}\n{"age": 30, "name": "Di"}\n')
    assert files.read_json(spark, str(tmp_path)).dtypes == [("age", "bigint"), ("name", "string")]
    assert rows(basics.sql_filter(files.read_json(spark, str(tmp_path), schemas.USER), "people", "age > 20")) == [(30, "Di")]


def test_parquet_schema_print(spark, tmp_path, capsys):
    out.write_parquet(spark.createDataFrame([(7, "Ann")], schemas.USER), str(tmp_path / "p"))
    files.read_parquet(spark, str(tmp_path / "p"), show_schema=True)
    assert "age: long" in capsys.readouterr().out


def test_codecs(spark, tmp_path):
    lines = text(spark, "one", "two")
    for codec, suffix in [("gzip", ".gz"), ("bzip2", ".bz2"), ("deflate", ".deflate"), ("none", ".txt")]:
        path = str(tmp_path / codec)
        out.write_text(lines, path, codec)
        assert parts(path, suffix)
        assert rows(files.read_text(spark, path)) == [("one",), ("two",)]


def test_routed_lines_end_in_cr_lf(spark, tmp_path):
    """One line with the token goes to one output, the other eight to the second, each once and with CR LF."""
    urls = [f"http://www.site{i}.example" for i in range(8)] + ["http://www.wanted.example"]
    lines = basics.distinct_sorted(text(spark, *urls, *urls))
    out.write_routed(lines, str(tmp_path / "r"), "wanted")
    body = {route: b"".join(p.read_bytes() for p in parts(tmp_path / "r" / f"route={route}")) for route in ("main", "other")}
    assert body["main"] == b"http://www.wanted.example\r\n"
    assert sorted(body["other"].split(b"\r\n")[:-1]) == sorted(u.encode() for u in urls[:8])


def test_whole_files(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"line one\nline two\n\x00\xff")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "b.txt").write_bytes(b"\n")
    got = {Path(r.path).name: bytes(r.content) for r in files.read_whole_files(spark, str(tmp_path)).collect()}
    assert got == {"a.txt": b"line one\nline two\n\x00\xff", "b.txt": b"\n"}


def test_collection_has_its_partitions(spark):
    df = files.from_collection(spark, [(i,) for i in range(1, 6)], "num int", 2)
    assert df.rdd.getNumPartitions() == 2 and rows(df) == [(i,) for i in range(1, 6)]


def test_partition_concat(spark):
    df = text(spark, "a", "b", "c").coalesce(1)
    (row,) = out.partition_concat(df).collect()
    assert (row.n, sorted(row.text)) == (3, ["a", "b", "c"])


def test_partition_concat_in_pieces(spark):
    df = text(spark, "aa", "bb", "cc", "dddd", "e").coalesce(1)
    pieces = [(r.n, r.text) for r in out.partition_concat(df, 4).collect()]
    assert pieces == [(2, "aabb"), (2, "ccdddd"), (1, "e")]


def test_json_lines_use_snake_case(spark):
    df = spark.createDataFrame([("x", None, 1)], "curDate string, isNew string, pvCount bigint")
    assert out.json_lines(df).first().value == '{"cur_date":"x","is_new":null,"pv_count":1}'


def test_topic_rows(spark):
    df = spark.createDataFrame([("1", None, "dwd_a")], "id string, v string, sink_table string")
    keyed = topic_rows(df.drop("sink_table"), ("id",), topic="facts").first()
    assert tuple(keyed) == ('{"id":"1"}', '{"id":"1","v":null}', "facts")
    assert tuple(topic_rows(df, topic_column="sink_table").first()) == (None, '{"id":"1","v":null}', "dwd_a")


def test_names():
    assert [snake(n) for n in ("uvCount", "stt", "curDate")] == ["uv_count", "stt", "cur_date"]
    assert [camel(n) for n in ("source_table", "id")] == ["sourceTable", "id"]


def test_readings_drop_what_is_no_record(spark):
    got = src.readings(text(spark, "a,1,2", "a,x,2", "a,1", "", "b,3,4,5"))
    assert rows(got) == [("a", 1, 2), ("b", 3, 4)]
    assert rows(src.pairs(text(spark, "a,1", "b"))) == [("a", 1)]


def test_dictionary_nests_its_name(spark):
    dic = src.dictionary(spark.createDataFrame([("1", "card")], "code string, label string"), "code", "label")
    assert dic.schema == schemas.DICTIONARY or dic.first().info.dic_name == "card"
    assert rows(dic.select("dic_code", F.col("info.dic_name"))) == [("1", "card")]


def test_jdbc_options():
    split = jdbc.Split("id", "0", "1000", 8)
    options = jdbc.read_options("jdbc:x", "t", {"user": "u"}, split)
    assert options == {
        "url": "jdbc:x", "dbtable": "t", "user": "u", "partitionColumn": "id", "lowerBound": "0", "upperBound": "1000", "numPartitions": "8",
    }
    assert "numPartitions" not in jdbc.read_options("jdbc:x", "t", {}, None)


def session(master, **conf):
    return SimpleNamespace(conf=SimpleNamespace(get=conf.get), sparkContext=SimpleNamespace(master=master))


def test_scratch_folder_follows_the_cluster_setting(spark):
    cluster = session("yarn", **{"spark.checkpoint.dir": "hdfs://shared/"})
    assert new_dir(cluster, "x").startswith("hdfs://shared/x-")
    with pytest.raises(RuntimeError):
        shared_base(session("yarn"))
    assert shared_base(session("local[2]")) == shared_base(session("local[4]"))
    assert new_dir(spark, "x") != new_dir(spark, "x")


def test_a_repeated_run_replaces_its_rows(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "sink_table string, v int")
    for run in (0, 1, 1):
        out.write_by_target(df, str(tmp_path / "t"), run=run)
    assert rows(spark.read.parquet(str(tmp_path / "t")).groupBy("sink_table", "v").count()) == [("a", 1, 2), ("b", 2, 2)]
