"""Each operator on hand-made hard rows and on the smallest tables, against plain loops, libraries or SQL."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from check import connect, differences
from tests.conftest import SMALL
from tidewater import llm
from tidewater.llm import bpe, components, dedup, licenses, mixing, quality, rans, simhash, token_files, topk, toxicity, warc
from tidewater.llm.common import staged

SPACE = r"[\x20\x09-\x0D]+"

LONG = "Long  text with\tmany words, and more.\n" * 4000

#: null and empty texts, white space only, ties and repeated rows, null ids, a very long text, a null source
HARD = [
    (1, "Alpha beta gamma delta epsilon.", "b"), (2, " Alpha beta gamma  delta epsilon.\n", "a"), (3, None, "a"), (4, "", None), (5, " \t\n", "b"),
    (6, "one", "c"), (6, "one", "c"), (None, "Alpha beta gamma delta epsilon.", "a"), (None, None, None), (7, LONG, "b"), (8, LONG + "end", "a"),
    (9, "Released under the MIT License. Apache License, Version 2 and CC BY-NC.", "d"), (10, "ünïcode İ 日本 <|endoftext|> it's 12.5% o'clock", "d"),
    (11, "This work is licensed under the GNU General Public License, version 3.", "c"), (12, "Alpha beta gamma delta epsilon.", "c"),
]


@pytest.fixture(scope="module")
def hard(spark):
    """The hard rows with extra columns whose names the operators use inside."""
    rows = pa.table({"doc_id": pa.array([r[0] for r in HARD], pa.int64()), "text": [r[1] for r in HARD], "source": [r[2] for r in HARD], "lang": ["en"] * len(HARD), "n_chars": [len(r[1] or "") for r in HARD], "row": [0] * len(HARD), "key": ["k"] * len(HARD), "score": [0.5] * len(HARD), "id": [1] * len(HARD)})
    return staged(spark, spark.createDataFrame(rows), "hard")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def words(text, lower=False):
    text = text or ""
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text) if lower else text
    return [w for w in re.split(SPACE, text) if w]


def everything(hard, docs):
    return [(r.doc_id, r.text) for df in (hard, docs) for r in df.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def both(hard, docs):
    return staged(hard.sparkSession, hard.select("doc_id", "text", "source").unionByName(docs.select((F.col("doc_id") + 1000).alias("doc_id"), "text", "source")), "both")


@pytest.mark.parametrize("name", sorted(llm.SQL))
def test_sql(spark, name, monkeypatch):
    monkeypatch.setattr("check.queries", lambda: llm.QUERIES)
    monkeypatch.setattr("check.oracle_sql", lambda: llm.SQL)
    assert differences(spark, connect(SMALL), SMALL, name) is None


def test_empty_tables(spark, hard):
    none = hard.filter("doc_id = -1")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    found = [
        token_files.token_files(none, public_tokenizers.path("word_bpe_49k.json")), simhash.near_dedup(none), licenses.scan_licenses(none), mixing.mix(none), mixing.mixed_documents(none),
        dedup.exact_dedup(none), dedup.without_copies(none), bpe.digests(bpe.encode_decode(none, path, pattern)), quality.score(none, quality.train(none, labels)), toxicity.grade(none, toxicity.train(none, labels)),
        warc.archive(none, id_col="doc_id", url_col="lang", html_col="text"), topk.top_k(none.select("doc_id", F.array("score").alias("v")), F.lit(True), "doc_id", "v"),
    ]
    assert [df.count() for df in found] == [0] * len(found)


def test_token_files(spark, both):
    path = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    got = token_files.token_files(both, path).collect()
    want = sorted(((i is not None, i or 0), zlib.crc32(ids.tobytes()), len(ids)) for i, t in [(r.doc_id, r.text) for r in both.collect()] for ids in [np.array(whole.encode(t or "", add_special_tokens=False).ids + [2], "<u4")])
    assert sorted(((r.doc_id is not None, r.doc_id or 0), r.ids_crc32, r.n_tokens) for r in got) == want
    start = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == start
        start += r.n_tokens
    order = [(r.doc_id is not None, r.doc_id or 0) for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order)


def test_token_ids_of_odd_texts():
    """Capitals under combining marks, longer runs of marks, contractions and names of special tokens, as the library."""
    path = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    rng = random.Random(3)
    marks = [chr(c) for c in (*range(0x300, 0x370), 0x1AB0, 0x20D0, 0x3099, 0x0F71, 0x0F73, 0x0591)]
    texts = [a + m for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZabiÀÉŁΩ" for m in marks]
    texts += ["I\u0307" + m for m in marks] + ["J\u030c", "x <|endoftext|> Y\u030a", "I'LL don'T we'Re O'\u0301clock", "\u212a\u212b A\u0301", " \u0301A", "A!\u0338=\u0338<\u0338>\u0338"]
    parts = [*marks, *"AEIOUTWJHYaeioutwjhy", "'S", "'LL", "'re", " ", "  ", "\n", "12", ".", "!", "=", "<|endoftext|>", "<|", "é", "İ", "ß", "日本", "가", "\u1100", "\u1161"]
    texts += ["".join(rng.choices(parts, k=rng.randint(1, 14))) for _ in range(60_000)]
    texts += ["".join(rng.choices(parts[len(marks) :], k=rng.randint(1, 14))) for _ in range(40_000)]
    for at in range(0, len(texts), 20_000):
        part = texts[at : at + 20_000]
        ids, counts = token_files.encode_texts(pa.array(part, pa.large_string()), path, 2)
        ends = np.concatenate(([0], np.cumsum(counts)))
        for text, a, b, want in zip(part, ends, ends[1:], whole.encode_batch_fast(part, add_special_tokens=False)):
            assert ids[a : b - 1].tolist() == want.ids, ascii(text)


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 5000, 700_000])
def test_rans_round_trip(n):
    ids = np.minimum(np.random.default_rng(n).zipf(1.3, n) - 1, 4999).astype(np.uint32)
    table = rans.Table.from_bytes(rans.Table.from_counts(np.bincount(ids, minlength=5000)).to_bytes())
    data = rans.encode_block(table, ids, [(None, n)])
    block = rans.Block(data, table)
    assert (block.ids() == ids).all() and block.document_ids == [None]
    assert (block.ids(n // 3, n // 2) == ids[n // 3 : n // 2]).all()
    with pytest.raises(ValueError):
        rans.Block(data[:-1] + bytes([data[-1] ^ 1]), table)


def linked(prints):
    """Least id by fingerprint, by brute force."""
    marks = sorted(set(prints.values()) if isinstance(prints, dict) else prints)
    parent = list(range(len(marks)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(marks)):
        for j in range(i):
            if (marks[i] ^ marks[j]).bit_count() <= 4:
                parent[find(i)] = find(j)
    return {m: find(i) for i, m in enumerate(marks)}


def test_simhash(both):
    expected = []
    for i, t in [(r.doc_id, r.text) for r in both.collect()]:
        w = words(t, True)
        runs = [" ".join(w[a : a + 4]) for a in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)] if w else []
        h = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
        expected.append((i, sum(1 << k for k in range(64) if 2 * sum(v >> k & 1 for v in h) > len(h))))
    root = linked([p for _, p in expected])
    least = {}
    for i, p in expected:
        if i is not None:
            least[root[p]] = min(least.get(root[p], i), i)
    want = sorted((i or -1, f"{p:016x}", least.get(root[p])) for i, p in expected)
    assert sorted((r.doc_id or -1, r.fingerprint, r.component_id) for r in simhash.near_dedup(both).collect()) == want


@pytest.mark.parametrize("plain_read", [True, False])
def test_one_of_each_with_repeated_and_null_ids(spark, plain_read):
    """A row goes by what it is, not by its id: ids that repeat with another text, near copies under one id or none."""
    rng = random.Random(11)
    a, b, c, d, e, f, g = (" ".join(rng.choices("abcdefghijklmnop", k=60)) for _ in range(7))
    near = lambda t: t.replace(" ", "  ").upper()
    rows = [(5, a, "goes"), (3, near(a), "a"), (5, b, "b"), (7, c, "c"), (7, near(c), "c"), (None, d, "d"), (None, near(d), "d"), (None, e, "goes"), (9, near(e), "e"), (None, f, "f"), (4, g, "g"), (4, g, "g")]
    table = spark.createDataFrame(rows, "doc_id long, text string, note string")
    table = staged(spark, table, "repeated") if plain_read else table.repartition(3)
    got = simhash.one_of_each(table)
    assert got.columns == table.columns
    assert Counter(r.note for r in got.collect()) == Counter("abcdefg")


@pytest.mark.parametrize("crowded", [2000, 10])
def test_crowded_points_lose_no_link(spark, crowded, monkeypatch):
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    rng = random.Random(5)
    centre, cloud = rng.getrandbits(64), set()
    for _ in range(250):
        x = rng.choice(sorted(cloud)) if cloud and rng.random() < 0.5 else centre
        for b in rng.sample(range(64), rng.randint(0, 7)):
            x ^= 1 << b
        cloud.add(x)
    cloud = sorted(cloud)
    marks = spark.createDataFrame(pa.table({"bits": np.array(cloud, np.uint64).view(np.int64), "least": np.arange(len(cloud))}))
    edges = staged(spark, simhash.links(marks.select("bits")), "edges")
    got = {int(np.int64(r.bits).view(np.uint64)): r.component for r in components.components(edges, marks, "bits", "least").collect()}
    root = linked(cloud)
    assert len({(root[c], got[c]) for c in cloud}) == len(set(root.values())) == len(set(got.values()))


def test_chain_is_one_component(spark):
    edges = spark.range(1, 60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    nodes = spark.range(0, 62).select("id", F.col("id").alias("name"))
    got = {r.id: r.component for r in components.components(edges, nodes, "id", "name").collect()}
    assert got == {i: 1 if 1 <= i <= 60 else i for i in range(62)}


def test_licenses(both):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    want = []
    for i, t in [(r.doc_id, r.text) for r in both.collect()]:
        w = pattern.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        places = [(a, label) for p, label in licenses.PHRASES.items() for a in range(len(w)) if w[a : a + len(p.split())] == p.split()]
        at = [a for a, _ in places]
        want.append((i or -1, len(w), len(at), min(at, default=-1), max(at, default=-1), ",".join(sorted({x for _, x in places}))))
    rows = licenses.scan_licenses(both).collect()
    none = lambda x: -1 if x is None else x
    assert sorted((r.doc_id or -1, r.n_words, r.n_base, none(r.first_word), none(r.last_word), r.base_labels) for r in rows) == sorted(want)
    assert {r.doc_id: r.labels for r in rows}[11] == "gpl-3"


def test_license_blocks_against_all_pairs(spark):
    rng = random.Random(3)
    vocabulary = sorted({w for _, t in licenses.TEMPLATES for w in t.split()}) + ["zz"] * 200
    texts = []
    for _ in range(120):
        text = []
        for _ in range(rng.randint(0, 5)):
            drop = rng.choice([0, 0.05, 0.1, 0.2])
            text += [w for w in rng.choice(licenses.TEMPLATES)[1].split() if rng.random() >= drop] if rng.random() < 0.5 else rng.choices(vocabulary, k=rng.randint(0, 80))
        texts.append(" ".join(text))
    df = spark.createDataFrame(pa.table({"doc_id": list(range(len(texts))), "text": texts}))
    got = {r.doc_id: sorted((b.first_word, b.label) for b in r.blocks) for r in licenses.scan_licenses(df).collect()}
    for i, text in enumerate(texts):
        w = text.split()
        found = [(a, label) for a in range(0, max(1, len(w)), 32) for label, t in licenses.TEMPLATES if len(set(t.split()) & set(w[a : a + 64])) >= 0.9 * len(set(t.split())) - 1e-9]
        assert got[i] == sorted(found)


def test_license_blocks_from_every_word(spark):
    """Notices broken up by other words, at all offsets: every run of 64 words that holds a template is found."""
    rng = random.Random(6)
    texts = []
    for span in (42, 48, 56, 64, 66):
        for offset in rng.sample(range(64), 24):
            label, notice = rng.choice(licenses.TEMPLATES)
            notice = notice.split()
            for _ in range(max(0, span - len(notice))):
                notice.insert(rng.randint(1, len(notice) - 1), "zz")
            texts.append(" ".join(["zz"] * offset + notice + rng.choices(["zz", "the", "license"], k=rng.choice([0, 70]))))
    df = spark.createDataFrame(pa.table({"doc_id": list(range(len(texts))), "text": texts}))
    got = {r.doc_id: r for r in licenses.scan_licenses(df, phrases={}).collect()}
    off_grid = 0
    for i, text in enumerate(texts):
        w, want = text.split(), {}
        for label, t in licenses.TEMPLATES:
            own = set(t.split())
            for a in range(len(w)):
                share = len(own & set(w[a : a + 64])) / len(own)
                if share >= 0.9 - 1e-9:
                    want[label, a] = share
        runs = got[i].runs
        assert {(x.label, a) for x in runs for a in range(x.first_start, x.last_start + 1)} == set(want)
        assert sum(x.last_start - x.first_start + 1 for x in runs) == len(want)
        assert all(x.containment == max(want[x.label, a] for a in range(x.first_start, x.last_start + 1)) for x in runs)
        assert got[i].labels == ",".join(sorted({label for label, _ in want})) and got[i].score == max(want.values(), default=0.0)
        off_grid += bool(want) and not got[i].blocks
    assert off_grid


def test_top_k(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(0, 0.2, (60, 6)).round(2).tolist()
    vectors = base + base[:5] + [None, [None, 1.0, 1.0, 1.0, 1.0, 1.0], [float("nan")] * 6, [float("inf")] * 6, [], [0.5, 0.5]]
    ids = [*range(len(vectors) - 3), 0, None, 3]
    df = spark.createDataFrame([(i, v, "x") for i, v in zip(ids, vectors)], "vec_id long, embedding array<double>, score string")
    rows = [(n, i, [int(np.floor(256 * x)) for x in v]) for n, (i, v) in enumerate(zip(ids, vectors)) if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for n, i, v in rows:
        if i is not None and i % 5 == 0:
            scored = sorted(((-sum(a * b for a, b in zip(v, u)), j if j is not None else 1 << 60) for m, j, u in rows if m != n and len(u) == len(v)))[:5]
            want += [(i, k, j, -s) for k, (s, j) in enumerate(scored, 1)]
    got = topk.top_k(df, F.col("vec_id") % 5 == 0, block=7, query_block=3).collect()
    assert sorted((r.query_id, r["rank"], 1 << 60 if r.vec_id is None else r.vec_id, r.score) for r in got) == sorted(want)


def test_top_k_of_large_vectors(spark):
    """No vector is left out for its size, no score wraps, and one beyond 64 bits is an error."""
    rng = random.Random(4)
    for size, dims in ((1e7, 8), (8e6, 64), (3e9, 4)):
        rows = [(i, [rng.uniform(-size, size) for _ in range(dims)]) for i in range(120)]
        want = []
        whole = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows}
        for q in range(0, 120, 50):
            scored = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)[:5]
            want += [(q, r, i, -s) for r, (s, i) in enumerate(scored, 1)]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        run = lambda: topk.top_k(df, F.col("vec_id") % 50 == 0, block=40, query_block=2).collect()
        if all(abs(s) < 2**63 for *_, s in want):
            assert sorted(map(tuple, run())) == sorted(want)
        else:
            with pytest.raises(Exception, match="beyond 64 bits"):
                run()
    # scores beyond 64 bits that are not among the best do no harm
    rows = [(0, [1e9, 0.0]), (1, [-1e18, 0.0]), *[(i, [float(i), 1.0]) for i in range(2, 9)]]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, block=3).collect()
    assert [r.vec_id for r in sorted(got, key=lambda r: r.rank)] == [8, 7, 6, 5, 4]


def test_warc(spark):
    same, other = "x" * 1200, "é" * 600
    pages = [(1, "http://a/1", same), (2, None, same), (3, "http://a/ü\n", other), (4, "u", None), (5, "u", ""), (6, "u", "short"), (7, "u", "short"), (None, "u", same), (9, "u", same), (9, "u", same), (10, "u", other)]
    df = spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, kind int")
    got = warc.archive(df, file_bytes=700)
    latest = {same: 9, other: 10}
    want = []
    for i, _, h in pages:
        payload = (h or "").encode()
        to = latest.get(h)
        again = to is not None and i != to
        want.append((i or -1, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if again else "response", to if again else -1))
    rows = got.collect()
    assert sorted((r.page_id or -1, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to or -1) for r in rows) == sorted(want)
    assert {r.payload.decode() for r in rows if r.payload is not None} == {same, other, "", "short"}


def test_warc_is_deterministic(spark, tmp_path):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    runs = [warc.write_warc(pages, f"{tmp_path}/{k}", file_bytes=20_000).orderBy("shard", "part").collect() for k in "ab"]
    assert [(r.shard, r.part, r.records, r.bytes, r.crc32) for r in runs[0]] == [(r.shard, r.part, r.records, r.bytes, r.crc32) for r in runs[1]]
    assert len(runs[0]) > 1


def test_warc_shards_follow_from_the_pages_alone(spark, tmp_path):
    """More rows than a range sort samples, cut and dealt otherwise in each run, a third of them without an id: same files."""
    made = spark.range(30_000).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("page_id"), F.concat(F.lit("u"), "id").alias("url"), F.concat(F.lit("<p>"), F.xxhash64("id").cast("string"), F.repeat(F.lit("x"), (F.col("id") % 90).cast("int"))).alias("html")
    )
    runs = []
    for parts in (3, 40):
        df = staged(spark, made.repartition(parts, "url"), f"warc-{parts}")
        found = warc.write_warc(df, f"{tmp_path}/{parts}", file_bytes=200_000, shard_bytes=800_000)
        runs.append(sorted((r.shard, r.part, r.records, r.bytes, r.crc32) for r in found.collect()))
    assert runs[0] == runs[1] and len({r[0] for r in runs[0]}) > 15
    # the rows without an id are many shards
    assert max(sum(r[2] for r in runs[0] if r[0] == n) for n in {r[0] for r in runs[0]}) < 3000


def test_warc_of_equal_pages_without_ids(spark):
    """One page, repeated without an id in most rows, fills several shards, and its mark reaches all of them."""
    page = "<html>" + "same body " * 200
    rows = [(None, "u", page)] * 300 + [(n, f"u{n}", page if n == 7 else f"<p>{n}") for n in range(60)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    pages = df.select("page_id", F.sha2("html", 256).alias("sha256"), F.octet_length("html").cast("long").alias("bytes"))
    assert len(warc.shard_bounds(pages, 100_000)) > 5
    got = warc.archive(df, shard_bytes=100_000).collect()
    assert Counter((r.page_id, r.record_type, r.refers_to) for r in got if r.payload_bytes > 1000) == {(None, "revisit", 7): 300, (7, "response", None): 1}
    assert len(got) == 360


def test_one_text_per_labelled_id(spark):
    """An id that repeats in most rows gives one text to a fit."""
    from tidewater.llm.labelled import labelled_sample

    docs = spark.createDataFrame([(4, f"text {n}") for n in range(200)] + [(n, f"other {n}") for n in range(5, 30)], "doc_id long, text string")
    labels = spark.createDataFrame([(n, n % 2) for n in range(30)], "doc_id long, quality int")
    rows, _ = labelled_sample(docs, labels, "quality", 50, 1000)
    assert sum(t.startswith("text") for t, _ in rows) == 1 and len(rows) > 10


def test_calibrated_quality_against_a_plain_loop(spark):
    """Features, weights and score of a text, step by step with the public library."""
    import math

    import zstandard

    rng = random.Random(8)
    rows = [(n, " ".join(rng.choices(["river", "stone", "light", "walks"] if n % 2 else ["buy", "now", "$$$", "win"], k=rng.randint(20, 60)))) for n in range(240)] + [(998, ""), (999, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(n, n % 2) for n in range(240)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    for r in quality.score(docs, model).collect():
        assert r.score == pytest.approx(plain_quality(dict(rows)[r.doc_id] or "", model, math, zstandard), abs=1e-9)
        assert r.predicted == int(r.score >= 0.7) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def plain_quality(text, model, math, zstandard):
    data = text.encode()

    def size(content):
        options = {"level": 3, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
        if content:
            options["dict_data"] = zstandard.ZstdCompressionDict(content)
            options["dict_data"].precompute_compress(level=3)
        return len(zstandard.ZstdCompressor(**options).compress(data))

    n, g, b, o = len(data), size(model.good), size(model.bad), size(None)
    base = [(g - b) / (o + 1), (g - b) / (n + 16), o / (n + 16), math.log1p(n), min(g, b) / (n + 16)]
    x = base + [v * v for v in base] + [base[0] * v for v in base[1:]] + [base[2] * base[3]]
    z = model.weights[0]
    for value, centre, spread, weight in zip(x, model.centre, model.spread, model.weights[1:]):
        z += weight * min(8, max(-8, (value - centre) / spread))
    return 1 / (1 + math.exp(-min(30, max(-30, z))))


def test_ordinal_grades_against_a_plain_loop(spark):
    """Shared weights, ordered thresholds: grade probabilities and severity of a text, one word at a time."""
    import math

    rng = random.Random(9)
    calm, rude = ["river", "stone", "light", "walks", "gently"], ["blorf", "snark", "grumph"]
    rows = [(n, " ".join(rng.choices(calm + (rude * (n % 4) if n % 2 else []), k=rng.randint(5, 50))), n % 2) for n in range(300)]
    sample = [(t, y) for _, t, y in rows]
    model = toxicity.fit(sample)
    assert model.features and list(model.thresholds) == sorted(model.thresholds)
    texts = [*[t for _, t, _ in rows[:60]], "", "BLORF blorfing snar snarks"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.grade(df, model).collect()}
    for n, text in enumerate(texts):
        p = plain_grades(text, model, math)
        assert got[n].severity == pytest.approx(sum(k * q for k, q in enumerate(p)), abs=1e-9)
        assert got[n].toxic_score == pytest.approx(1 - p[0], abs=1e-9) and sum(p) == pytest.approx(1)
        assert p[got[n].grade] == pytest.approx(max(p))


def plain_grades(text, model, math):
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())
    counts = Counter(f for w in found for f in (w, "^" + w[:4], "^" + w[:5]) if f in model.features)
    at = sum(model.weights[model.features[f]] * math.log1p(c * (1000 / (len(found) + 20))) for f, c in counts.items())
    upto = [1 / (1 + math.exp(-min(40, max(-40, cut - at)))) for cut in model.thresholds]
    return [b - a for a, b in zip([0, *upto], [*upto, 1])]


def test_ties_between_grades():
    """Thresholds that leave two grades equally likely: the lower one is named."""
    model = toxicity.ToxicityModel({}, (), (0.0, 40.0, 41.0))
    p = model.grades(["", "any words"])
    assert p[0, 0] == p[0, 1] == 0.5 and p.argmax(1).tolist() == [0, 0]


def test_long_html(spark):
    """A payload of several megabytes is archived and read back whole."""
    page = "<html>" + "".join(f"<p>{n} ünï</p>" for n in range(400_000))
    df = spark.createDataFrame([(1, "u", page), (2, "v", page), (3, "w", "")], "page_id long, url string, html string")
    got = {r.page_id: r for r in warc.archive(df, file_bytes=100_000).collect()}
    assert got[2].payload == page.encode() and got[1].record_type == "revisit" and got[1].refers_to == 2 and got[3].payload_bytes == 0


def test_quality_and_toxicity(spark):
    sf = SMALL.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    truth = {r.doc_id: r for r in labels.collect()}
    rows = [r for r in llm.QUERIES["op6_quality"](spark, sf).collect()]
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in held)
    assert np.mean([r.predicted == truth[r.doc_id].quality for r in held]) > 0.9
    rows = llm.QUERIES["op10_toxicity"](spark, sf).collect()
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([r.toxic == bool(truth[r.doc_id].toxic) for r in held]) > 0.9
    assert all(0 <= r.severity <= 3 for r in rows)


def test_classifiers_on_hard_rows(spark, hard, docs):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    scored = quality.score(hard, quality.train(docs, labels)).collect()
    graded = toxicity.grade(hard, toxicity.train(docs, labels)).collect()
    assert Counter(r.doc_id for r in scored) == Counter(r.doc_id for r in graded) == Counter(r[0] for r in HARD)
    assert all(0 <= r.score <= 1 for r in scored) and not any(r.held_out for r in scored if r.doc_id is None)
    assert not any(r.toxic for r in graded)
    kept = quality.good_documents(hard, quality.train(docs, labels))
    assert kept.columns == hard.columns and kept.count() == sum(r.predicted for r in scored)


def test_apportion_against_single_awards():
    rng = random.Random(2)
    for _ in range(60):
        votes = [rng.choice([0, rng.random() * 1000, 50]) for _ in range(rng.randint(1, 12))]
        seats = rng.randint(0, 300)
        given = [0] * len(votes)
        for _ in range(seats if sum(votes) else 0):
            best = max((i for i in range(len(votes)) if votes[i]), key=lambda i: (votes[i] / (2 * given[i] + 1), -i))
            given[best] += 1
        assert mixing.apportion(votes, seats) == given
        quotas = mixing.shard_quotas(votes, seats, 5)
        assert [sum(q) for q in zip(*quotas)] == given and min(min(q) for q in quotas) >= 0


def test_mix(both):
    rows = mixing.mix(both, block=8).collect()
    again = mixing.mix(both, block=8).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))
    source = {r.doc_id: r.source for r in both.collect()}
    sizes = Counter(len(words(r.text)) for r in both.collect())
    assert Counter(r.size for r in rows) == sizes
    total = sum(k * n for k, n in sizes.items())
    assert abs(sum(r.taken for r in rows) - total) <= 8 * 30 and len(set(source.values())) > 3
    taken, target, size = defaultdict(int), {}, defaultdict(int)
    for r in mixing.mix(both.withColumn("of", mixing.source_key("source")), block=8, keep=("of",)).collect():
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.whole * r.size + sum(p.b - p.a for p in r.pieces)
        taken[r.of] += r.taken
        target[r.of] = r.target
        size[r.of] += r.size
    # the words of each source are near its target, which a plain loop gives
    want = plain_targets(size)
    assert target == pytest.approx(want)
    assert all(abs(taken[s] - want[s]) <= 2 * 8 + 64 for s in size)


def plain_targets(size):
    """Share by weight; whoever passes 3 times its size stops there and the rest is shared among the others."""
    names = sorted(size)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    fixed = {}
    while True:
        left = sum(size.values()) - sum(fixed.values())
        open_ = [s for s in names if s not in fixed]
        share = {s: left * weight[s] / sum(weight[t] for t in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * size[s]]
        if not over:
            return fixed | share
        fixed |= {s: 3.0 * size[s] for s in over}


def test_shards_hold_their_quotas(spark):
    """Every shard takes its blocks of every source, from documents of its own part of the stream."""
    rng = random.Random(5)
    rows = [(n, " ".join(["w"] * rng.randint(1, 30)), rng.choice("aaab") if n % 9 else "c") for n in range(600)]
    table = staged(spark, spark.createDataFrame(rows, "doc_id long, text string, source string"), "sharded")
    size = Counter()
    for _, t, s in rows:
        size[f"0{s}"] += len(t.split())
    planned = {r["mix_key"]: r for r in mixing.plan(sorted(size.items()), 16, 8, 7)}
    quotas = mixing.shard_quotas([planned[k]["target"] for k in sorted(size)], round(sum(size.values()) / 16), 8)
    for i, k in enumerate(sorted(size)):
        shards = planned[k]["shards"]
        assert [s[2] for s in shards[:-1]] == [s[1] for s in shards[1:]] and shards[0][1] == 0 and shards[-1][2] == size[k]
        for number, a, b, rounds, begin, rest in shards:
            assert rounds * (b - a) + rest == min(quotas[number][i] * 16, 3 * (b - a)) and a <= begin < b
    found = mixing.mix(table.withColumn("of", mixing.source_key("source")), block=16, shards=8, keep=("of",)).collect()
    assert {r.shard for r in found} == set(range(8))
    other = mixing.mix(table, block=16, shards=3).collect()
    assert sorted((r.doc_id, r.taken) for r in found) != sorted((r.doc_id, r.taken) for r in other)


def test_place_of_null_and_repeated_ids(spark):
    """A third of the rows has no id and some are equal: each row has its place and the sums hold."""
    rows = [(None if n % 3 else n, f"text number {n % 50} of many words", "a" if n % 4 else None) for n in range(300)]
    table = staged(spark, spark.createDataFrame(rows, "doc_id long, text string, source string"), "placeless")
    found = mixing.mix(table, block=8).collect()
    assert len(found) == 300 and all(0 <= r.taken <= 3 * r.size for r in found)
    assert abs(sum(r.taken for r in found) - 300 * 6) <= 3 * 8 + 64
    assert sorted(map(repr, found)) == sorted(map(repr, mixing.mix(table, block=8).collect()))


def test_mixed_documents(both):
    rows = {(r.doc_id, r.size): r for r in mixing.mix(both, block=8).collect()}
    count = defaultdict(int)
    for r in mixing.mixed_documents(both, block=8).collect():
        count[r.doc_id] += len(words(r.text))
    repeated = {6, None}
    assert {i: n for i, n in count.items() if i not in repeated} == {i: r.taken for (i, _), r in rows.items() if r.taken and i not in repeated}


def test_mixed_documents_with_repeated_and_null_ids(spark):
    """Documents that share id and size have plans of their own, in one source or over several."""
    rng = random.Random(12)
    letters = "abcdefghijklmnop"
    rows = [(rng.choice([None, None, 1, 2, n]), " ".join([f"t{n}", *rng.choices(letters, k=rng.choice([4, 4, 9]))]), rng.choice("aaaaab" if n % 2 else "cb")) for n in range(120)]
    rows += [(8, "same words each time", "b"), (8, "same words each time", "b")]
    table = staged(spark, spark.createDataFrame(rows, "doc_id long, text string, source string"), "repeated")
    taken = Counter()
    for r in mixing.mix(table.withColumn("n", F.regexp_extract("text", "^t([0-9]+) ", 1).try_cast("long")), block=8, shards=1, keep=("n",)).collect():
        taken[r.n] += r.taken
    source, size = {n: r[2] for n, r in enumerate(rows)}, {n: len(r[1].split()) for n, r in enumerate(rows)}
    count = Counter()
    for r in mixing.mixed_documents(table, block=8, shards=1).collect():
        if r.text.startswith("same") or not r.text.startswith("t"):
            continue
        n = int(r.text.split()[0][1:])
        assert r.source == source[n]
        count[n] += len(r.text.split())
    cut = {n for n in taken if n is not None and taken[n] % size[n]}
    assert len(cut) <= 8 and {n: k for n, k in count.items() if n not in cut} == {n: k for n, k in taken.items() if k and n is not None and n not in cut}
    whole = mixing.mixed_documents(table, block=8, shards=1).select(F.sum(F.size(F.split("text", " ")))).first()[0]
    assert whole == sum(taken.values()) and 0 in [taken[n] for n in size] and max(taken[n] / size[n] for n in size if n < 120) > 1


def test_mixed_documents_are_the_planned_pieces(spark):
    """Many shards on short documents: what comes out of each row is its whole copies and its pieces, word by word."""
    rng = random.Random(13)
    rows = [(rng.choice([None, 1, n]), " ".join(f"{n}.{i}" for i in range(rng.choice([0, 1, 7, 40]))), rng.choice("aaab")) for n in range(200)]
    table = staged(spark, spark.createDataFrame(rows, "doc_id long, text string, source string"), "pieces")
    want = Counter()
    for r in mixing.mix(table.withColumn("words", F.split("text", " ")), block=8, shards=12, keep=("words",)).collect():
        want.update({" ".join(r.words): r.whole} if r.taken else {})
        want.update(" ".join(r.words[p.a : p.b]) for p in r.pieces)
    got = Counter(r.text for r in mixing.mixed_documents(table, block=8, shards=12).collect())
    assert got == +want and len(got) > 50


def test_byte_bpe(both):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    public = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for r in both.collect():
        ids = public.encode_ordinary(r.text or "")
        want[r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()] += 1
    got = bpe.digests(bpe.encode_decode(both, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN))
    assert Counter(tuple(r) for r in got.collect()) == want


def test_merge_replay_against_the_library():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = bpe.load_ranks(path)
    public = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    texts = ["".join(rng.choices("ab eé\n\t 12.,'sñ日本aAthe", k=rng.randint(0, 60))) for _ in range(2000)] + ["a" * 3000, "the" * 999, " " * 500]
    _, ids, counts = bpe.encode_batch(texts, path, public_tokenizers.PATTERN)
    ends = np.concatenate(([0], np.cumsum(counts)))
    assert all(ids[a:b].tolist() == public.encode_ordinary(t) for t, a, b in zip(texts, ends, ends[1:]))


@pytest.mark.parametrize("weak", [False, True])
def test_exact_dedup(both, weak):
    """A weak hash makes every bucket a chain of collisions."""
    rows = [(r.doc_id, r.text or "") for r in both.collect()]
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(SPACE, "", t)].append((-len(t), i if i is not None else 1 << 62, i))
    want = Counter()
    for i, t in rows:
        norm = re.sub(SPACE, "", t)
        want[i, min(groups[norm])[2], len(groups[norm]), hashlib.sha256(norm.encode()).hexdigest()] += 1
    options = {"hash_of": lambda c: F.length(c).cast("long") % 3, "capacity": 2} if weak else {"capacity": 5}
    got = dedup.exact_dedup(both, **options).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert Counter(r.text_sha256 for r in got if r.kept) == Counter(hashlib.sha256(n.encode()).hexdigest() for n in groups)


def test_without_copies(both):
    kept = dedup.without_copies(both)
    norms = Counter(re.sub(SPACE, "", r.text or "") for r in kept.filter("doc_id is not null").collect())
    assert max(norms.values()) == 1
    assert set(norms) == {re.sub(SPACE, "", r.text or "") for r in both.filter("doc_id is not null").collect()}


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "simhash", "mix_sources", "byte_bpe"]
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(staged(spark, stage(spark, tables[-1], SMALL), f"test-{name}"))
        if name != "byte_bpe":
            assert tables[-1].schema.simpleString() == docs.schema.simpleString()
    start, good, single, near, mixed, last = tables
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in llm.QUERIES["op6_quality"](spark, SMALL).collect() if r.predicted}
    norm = lambda t: re.sub(SPACE, "", t)
    assert Counter(norm(r.text) for r in single.collect()) == Counter({norm(r.text) for r in good.collect()})
    assert {r.doc_id for r in near.collect()} == {r.component_id for r in simhash.near_dedup(single).collect()}
    taken = {r.doc_id: r.taken for r in mixing.mix(near).collect() if r.taken}
    count = Counter()
    for r in mixed.collect():
        count[r.doc_id] += len(words(r.text))
    assert count == taken and last.count() == mixed.count()
    whole = corpus_pipeline.run(spark, SMALL)
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, last.collect()))


@pytest.mark.parametrize("labelled", ["quality is null", "quality = 0"])
def test_pipeline_without_both_labels_rejects_nothing(spark, tmp_path, labelled):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.limit(40)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.filter(labelled).write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.good_quality(spark, docs, str(tmp_path)).count() == docs.count() > 0
    if labelled == "quality is null":
        assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
