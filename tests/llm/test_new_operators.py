"""The Merkle manifest, phrase collocations and Lempel-Ziv fingerprints on hard rows, against plain loops."""

import hashlib
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tests.llm.test_operators import HARD, LONG
from tidewater.llm import lempel, merkle, phrases
from tidewater.llm.common import staged


@pytest.fixture(scope="module")
def hard(spark):
    """Hard rows, repeated rows and null languages, with extra columns whose names the operators use inside."""
    rows = [(i, t, s, None if k % 4 == 0 else "en") for k, (i, t, s) in enumerate(HARD)]
    rows += [(None, "same again", "hot", "fr")] * 40 + [(100 + k % 7, f"text {k % 3} of many", "hot", "fr") for k in range(300)]
    names = {c: [7] * len(rows) for c in ("group", "node", "pos", "n", "run", "path", "range", "hash", "last", "f", "a", "l", "w1", "size")}
    made = pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": [r[1] for r in rows], "source": [r[2] for r in rows], "lang": [r[3] for r in rows], "n_chars": pa.array([None if r[1] is None else len(r[1]) for r in rows], pa.int64()), **names})
    return staged(spark, spark.createDataFrame(made), "hard-new")


def small(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(nodes):
    """Root, and the pairs of siblings of every node up to it."""
    paths, where, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        for k, at in enumerate(where):
            run = level[at // 16 * 16 : at // 16 * 16 + 16]
            paths[k].append(("".join(run[: at % 16]), "".join(run[at % 16 + 1 :])))
        level = [sha(*level[i : i + 16]) for i in range(0, len(level), 16)]
        where = [at // 16 for at in where]
    return level[0], paths


def plain_manifest(rows):
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, text: sha(*[part(v) for v in (r.doc_id, r.source, r.lang, r.n_chars, text)])
    sources = sorted({r.source for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        own = sorted(((r.doc_id is not None, r.doc_id or 0, leaf(r, r.text), r) for r in rows if r.source == s), key=lambda x: x[:3])
        trees[s] = (*tree([x[2] for x in own]), own)
    root, upper = tree([trees[s][0] for s in sources])
    out = []
    for s, above in zip(sources, upper):
        subroot, paths, own = trees[s]
        for (_, _, mark, r), path in zip(own, paths):
            path = path + above
            bad = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0
            x = leaf(r, r.text and small(r.text)) if bad else mark
            for left, right in path:
                x = sha(left, x, right)
            out.append((r.doc_id, mark, subroot, root, sha(*[a + b for a, b in path]), x, x == root))
    return out


def test_merkle(spark, hard):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for df in (hard, docs, hard.filter("doc_id = 9"), hard.filter("doc_id in (1, 9)")):
        got = sorted(map(tuple, merkle.document_manifest(df).collect()), key=repr)
        assert got == sorted(plain_manifest(df.collect()), key=repr)


def test_merkle_tells_tampered_rows(hard):
    rows = merkle.document_manifest(hard).collect()
    assert {r.verified for r in rows} == {True, False}
    assert all(r.verified == (r.folded_root == r.root) for r in rows) and len({r.root for r in rows}) == 1


def test_empty_tables(hard):
    none = hard.filter("doc_id = -1")
    assert [merkle.document_manifest(none).count(), phrases.collocations(none).count(), lempel.fingerprints(none).count()] == [0, 0, 0]


def plain_collocations(rows, longest, least, share, best):
    counts = Counter()
    for r in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", small(r.text or "")):
            found = re.findall(r"[^\x20\x09]+", piece)
            for m in range(1, longest + 1):
                counts.update((r.lang or "und", tuple(found[i : i + m])) for i in range(len(found) - m + 1))
    totals = Counter()
    for (lang, p), c in counts.items():
        totals[lang] += c if len(p) == 1 else 0
    chosen = {k: c for k, c in counts.items() if len(k[1]) > 1 and c >= least}
    longer = Counter()
    for (lang, p), c in chosen.items():
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                longer[lang, p[i : i + m]] = max(longer[lang, p[i : i + m]], c)
    out = []
    for lang in {k[0] for k in chosen}:
        scored = []
        for (of, p), a in chosen.items():
            if of == lang and not 100 * longer[lang, p] >= share * a:
                score, k, left, right = min((1_000_000 * a * a // (counts[lang, p[:k]] * counts[lang, p[k:]]), k, counts[lang, p[:k]], counts[lang, p[k:]]) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:best], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -s))
    return sorted(out)


@pytest.mark.parametrize("longest,least,best", [(3, 10, 2000), (3, 2, 50), (4, 3, None), (2, 5, None)])
def test_collocations(spark, hard, longest, least, best):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("text", "lang").unionByName(hard.select("text", "lang"))
    got = sorted(map(tuple, phrases.collocations(docs, longest, least, best=best).collect()))
    assert got == plain_collocations(docs.collect(), longest, least, 50, best) and got


def test_collocations_beyond_64_bits(spark):
    """Counts whose products pass 64 bits keep their exact quotient."""
    a, b = 3_000_000_000, 3_000_000_019
    row = spark.range(1).select(F.lit(a).cast(phrases.EXACT).alias("a"), F.lit(b).cast(phrases.EXACT).alias("l"))
    row = row.withColumn("above", F.lit(1_000_000).cast("decimal(7,0)") * (F.col("a") * F.col("a"))).withColumn("below", F.col("l") * F.col("l"))
    assert row.selectExpr("above div below AS q").first().q == 1_000_000 * a * a // (b * b)


def plain_phrases(text):
    found, start = set(), 0
    for end in range(1, len(text) + 1):
        if text[start:end] not in found:
            found.add(text[start:end])
            start = end
    return found


@pytest.mark.parametrize("text", ["", "a", "aaaaaaaaaaaa", "abababababab", "日本語日本語", LONG[:3000], "the cat sat on the cat mat the cat"])
def test_phrases_by_plain_parse(text):
    assert lempel.finish(text, set(), 0) == plain_phrases(text)
    for cut in range(0, len(text) + 1, max(1, len(text) // 7)):
        known = set()
        assert lempel.finish(text, known, lempel.parse(text, known, 0, cut)) == plain_phrases(text)


def test_fingerprints(spark, hard):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    for df, size in ((hard, 8 << 20), (hard, 300), (docs, 40_000), (hard.filter("doc_id = 9"), 1 << 20)):
        rows = sorted(((r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()), key=lambda r: (r[0] is None, -(r[0] or 0)))
        got = lempel.fingerprints(df, range_bytes=size).collect()
        assert sorted((r.doc_id is None, r.doc_id or 0, r.n_chars) for r in got) == sorted((i is None, i or 0, len(t)) for i, t in rows)
        print_of = {t: lempel.written(lempel.sketch(plain_phrases(t))) for _, t in rows}
        assert Counter(r.fingerprint for r in got) == Counter(print_of[t] for _, t in rows)
        if len({i for i, _ in rows}) == len(rows):  # no ties: the next document is known
            by_id = {r.doc_id: r for r in got}
            for (i, t), (_, after) in zip(rows, rows[1:] + rows[:1]):
                changed = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
                other, r = lempel.sketch(plain_phrases(changed)), by_id[i]
                assert r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest() and r.edited_fingerprint == lempel.written(other)
                own = lempel.read_marks(r.fingerprint)
                assert r.near_edited == lempel.likeness(own, other) and r.near_next == lempel.likeness(own, lempel.read_marks(print_of[after]))


def test_likeness_estimates_the_jaccard_similarity():
    texts = [LONG[:4000], LONG[:3000] + "other words stand here now " * 30, "".join(map(str, range(900)))]
    for a in texts:
        for b in texts:
            x, y = plain_phrases(a), plain_phrases(b)
            true = len(x & y) / len(x | y)
            assert abs(lempel.likeness(lempel.sketch(x, 512), lempel.sketch(y, 512), 512) - true) < 0.08
    assert lempel.likeness(lempel.sketch(set()), lempel.sketch(set())) == 1.0


def test_the_directory_owns_the_rows(spark):
    """Buckets are prefixes that hold at most their capacity, entries lie in their bucket's range, rows find them there."""
    from tidewater.llm import dedup
    from tidewater.session import new_dir

    keys = staged(spark, spark.range(500).select(F.xxhash64("id").alias("key"), "id", F.col("id").alias("row"), F.lit(3).alias("chars")), "owned")
    index, depths = dedup.build_index(keys, new_dir(spark, "owned-index"), 10)
    held = Counter(r.bucket for r in index.collect())
    assert max(held.values()) <= 10 and len(held) > 50
    depth = {r.cell: r.depth for r in depths.collect()}
    for r in index.collect():
        cell = (r.key & (2**64 - 1)) >> (64 - dedup.DEPTH)
        shift = dedup.DEPTH - depth[cell]
        assert r.bucket == cell >> shift << shift
    assert {(r.key, r.bucket) for r in dedup.owned(keys, depths).collect()} == {(r.key, r.bucket) for r in index.collect()}


@pytest.mark.parametrize("bits", [7, 12, 26])
def test_bitmap_keeps_every_shared_key(spark, monkeypatch, bits):
    """However full the bitmap is, no shared key is lost."""
    from tidewater.llm import dedup

    monkeypatch.setattr(dedup, "MAP_BITS", bits)
    rows = spark.range(3000).select(F.xxhash64("id").alias("key"), "id")
    shared = rows.filter("id % 10 = 0")
    met = {r.id for r in dedup.may_share(rows, shared).collect()}
    assert met >= set(range(0, 3000, 10)) and (bits < 26 or len(met) < 330)
