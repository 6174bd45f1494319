"""Word segmentation against all ways to cut a text."""

import hashlib
import random
import re
from math import log

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL, rows
from tidewater.functions.segment import PIECES, SLICE, Lattice, _cutter, lattice_of, register_segmenter, segmenter, word_costs
from tidewater.functions.text import explode_tokens


def all_cuts(text):
    if not text:
        yield []
    for end in range(1, len(text) + 1):
        for rest in all_cuts(text[end:]):
            yield [text[:end], *rest]


def by_brute_force(text, costs, unknown):
    """Cheapest cut into known words and single unknown characters; ties by fewer pieces, then longer ones from the end."""
    best = None
    for cut in all_cuts(text):
        # a single character may be taken as a word or as unknown, whichever is cheaper
        if all(p in costs or len(p) == 1 for p in cut):
            cost = sum(min(costs.get(p, unknown), unknown) if len(p) == 1 else costs[p] for p in cut)
            order = (cost, len(cut), [-len(p) for p in reversed(cut)])
            best = min(best, (order, cut)) if best else (order, cut)
    merged = []
    for p in best[1]:
        strange = len(p) == 1 and costs.get(p, unknown + 1) >= unknown
        if strange and merged and merged[-1][1]:
            merged[-1] = (merged[-1][0] + p, True)
        else:
            merged.append((p, strange))
    return [p for p, _ in merged]


def test_best_path_by_brute_force():
    rng = random.Random(7)
    for _ in range(400):
        letters = rng.choice(["ab", "abc", "研究生命起源"])
        words = {"".join(rng.choices(letters, k=rng.randint(1, 4))) for _ in range(rng.randint(0, 8))}
        costs = {w: rng.randint(1, 6) for w in words}
        text = "".join(rng.choices(letters + "x", k=rng.randint(1, 10)))
        assert Lattice(costs, 7).best(text) == by_brute_force(text, costs, 7), (costs, text)


def test_classic_ambiguity():
    words = [("研究", 40, 200), ("研究生", 20, 200), ("生命", 40, 200), ("命", 5, 200), ("起源", 30, 200), ("生", 9, 200)]
    assert lattice_of(words).best("研究生命起源") == ["研究", "生命", "起源"]


@pytest.fixture(scope="module")
def model(spark):
    texts = spark.createDataFrame([("Red ring, red bolt!",), ("blue bolt red",), (None,), ("",)], "t string")
    return word_costs(texts, F.col("t"))


def test_costs(model):
    assert rows(model) == [("blue", 1, 7), ("bolt", 2, 7), ("red", 3, 7), ("ring", 1, 7)]
    assert lattice_of([("red", 3, 7)]).costs[-1] == round(1e6 * log(7 / 3))


def test_hard_rows(spark, model):
    df = spark.createDataFrame([(1, "RedBoltblue"), (2, None), (3, ""), (4, " ,.! "), (5, "redzzzring-xy bolt"), (6, "q" * 5000 + "red")], "id int, t string")
    got = dict(rows(df.select("id", segmenter(model)(F.col("t")))))
    assert got == {1: ["red", "bolt", "blue"], 2: None, 3: [], 4: [], 5: ["red", "zzz", "ring", "xy", "bolt"], 6: ["q" * 5000, "red"]}
    assert explode_tokens(df, F.col("t"), tokenizer=segmenter(model)).count() == 10


def test_empty_model(spark):
    none = word_costs(spark.createDataFrame([], "t string"), F.col("t"))
    got = spark.createDataFrame([("Ab cd",)], "t string").select(segmenter(none)(F.col("t")).alias("w")).first().w
    assert got == ["ab", "cd"]


def test_sql_function(spark, model):
    register_segmenter(spark, model, "cut_words")
    spark.createDataFrame([("k1", "redring"), ("k2", None)], "k string, body string").createOrReplaceTempView("bodies")
    assert rows(spark.sql(f"SELECT k, w FROM bodies LATERAL VIEW explode(cut_words({PIECES})) t AS w")) == [("k1", "red"), ("k1", "ring")]


def test_documents(spark):
    from tidewater.catalog import QUERIES

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    learned = [tuple(r) for r in word_costs(docs, F.col("text")).collect()]
    best = lattice_of(learned).best
    got = {r.doc_id: (r.n_words, r.words_sha256) for r in QUERIES["segment_documents"](spark, SMALL).collect()}
    import regex

    for r in docs.collect():
        pieces = [p for p in regex.split(r"[\p{P}\p{S}\s]+", re.sub(r"[ \t\n\x0b\f\r]+", "", r.text).lower()) if p]
        words = [w for p in pieces for w in best(p)]
        assert got[r.doc_id] == (len(words), hashlib.sha256(" ".join(words).encode()).hexdigest())


def test_texts_are_cut_slice_by_slice_in_arrow(spark):
    model = word_costs(spark.createDataFrame([("red box red",)], "t string"), F.col("t"))
    texts = [None if i % 7 == 0 else [] if i % 7 == 1 else ["redbox", f"x{i}red"] for i in range(2 * SLICE + 1)]
    found = _cutter(model).func(pa.array(texts, pa.list_(pa.string())))
    assert found.to_pylist() == [None if t is None else [w for p in t for w in (["red", "box"] if p == "redbox" else [p[:-3], "red"])] for t in texts]
    assert _cutter(model).func(pa.array([], pa.list_(pa.string()))).to_pylist() == []
