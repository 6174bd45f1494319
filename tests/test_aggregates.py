"""User aggregates: against plain sums, under hot keys and nulls, and the sketch within its stated error."""

from collections import Counter
from math import log2

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidewater.functions import aggregates
from tidewater.functions.aggregates import Aggregate, Average, Quantiles, ValueCounts, aggregate


def test_average_and_counts(spark):
    made = [(("hot", None, "a", "b")[0 if n % 3 else n % 4], n % 2, None if n % 5 == 0 else n * 7 % 40) for n in range(900)] + [("none", 0, None)]
    df = spark.createDataFrame(made, "k string, j int, v int").repartition(7)
    want = {}
    for k, j, v in made:
        want.setdefault((k, j), []).append(v)
    got = rows(aggregate(df, ["k", "j"], "v", Average(), "mean"))
    plain = {key: [v for v in vs if v is not None] for key, vs in want.items()}
    assert got == sorted(((*key, sum(vs) / len(vs) if vs else None) for key, vs in plain.items()), key=repr)
    top = {r.k: [(x["value"], x["count"]) for x in r.top] for r in aggregate(df.where("j = 0"), ["k"], "v", ValueCounts(3), "top").collect()}
    for k in {r[0] for r in made if r[1] == 0}:
        counts = Counter(v for key, vs in plain.items() if key == (k, 0) for v in vs)
        assert top[k] == sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:3]


def test_empty_table(spark):
    assert aggregate(spark.createDataFrame([], "k string, v int"), ["k"], "v", Average(), "mean").count() == 0


def test_buffers_are_passed_on_when_many_keys_are_held(spark, monkeypatch):
    monkeypatch.setattr(aggregates, "HELD", 3)
    df = spark.range(1000).select((F.col("id") % 50).alias("k"), F.col("id").alias("v"))
    got = dict(rows(aggregate(df, ["k"], "v", Average(), "mean")))
    assert got == {k: sum(range(k, 1000, 50)) / 20 for k in range(50)}


class Longest(Aggregate):
    """A user's own: the longest text, the smallest of equal length."""

    result = "string"

    def zero(self):
        return None

    def reduce(self, buffer, values):
        return self.merge(buffer, min(values.tolist(), key=lambda t: (-len(t), t)))

    def merge(self, a, b):
        found = [t for t in (a, b) if t is not None]
        return min(found, key=lambda t: (-len(t), t)) if found else None

    def finish(self, buffer):
        return buffer


def test_own_aggregate(spark):
    df = spark.createDataFrame([(1, "ab"), (1, "zz"), (1, "b"), (2, None)], "k int, t string")
    assert rows(aggregate(df, ["k"], "t", Longest(), "longest")) == [(1, "ab"), (2, None)]


@pytest.mark.parametrize("size,parts", [(64, 1), (64, 9), (256, 40)])
@pytest.mark.parametrize("shape", ["up", "down", "random", "ties"])
def test_quantile_error(size, parts, shape):
    """The rank of every answer is off by no more than the stated bound, however the values come and buffers meet."""
    n = 30_000
    values = {"up": np.arange(n), "down": np.arange(n)[::-1], "random": np.random.default_rng(1).normal(size=n), "ties": np.arange(n) % 11}[shape]
    at = (0.01, 0.25, 0.5, 0.9, 0.999)
    sketch = Quantiles(at, size)
    whole = sketch.zero()
    for part in np.array_split(values, parts):
        whole = sketch.merge(whole, sketch.reduce(sketch.zero(), part))
    assert sum(map(len, whole[0])) <= size * (log2(n / size) + 2)
    bound = n * (log2(n / size) + 1) / size
    for q, answer in zip(at, sketch.finish(whole)):
        low, high = (values < answer).sum(), (values <= answer).sum()
        assert low - bound <= q * n <= high + bound


def test_quantiles_of_a_table(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("k"), (F.col("id") * 7919 % 5000).cast("double").alias("v"))
    got = {r.k: r.q for r in aggregate(df, ["k"], "v", Quantiles((0.5,), 8192), "q").collect()}
    for k in "ab":
        values = sorted(r.v for r in df.where(F.col("k") == k).collect())
        assert got[k] == [values[(len(values) + 1) // 2 - 1]]
