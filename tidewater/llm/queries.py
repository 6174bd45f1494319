"""The registered queries: each applies its operator to the whole of its table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tidewater.llm import quality, toxicity
from tidewater.llm.bpe import digests, encode_decode
from tidewater.llm.dedup import exact_dedup
from tidewater.llm.lempel import fingerprints
from tidewater.llm.licenses import scan_licenses
from tidewater.llm.merkle import document_manifest
from tidewater.llm.mixing import mix
from tidewater.llm.phrases import collocations
from tidewater.llm.registry import query, table
from tidewater.llm.simhash import near_dedup
from tidewater.llm.token_files import token_files
from tidewater.llm.topk import top_k
from tidewater.llm.warc import archive


@query(
    "op9_exact_dedup",
    r"""
    WITH plain AS (
      SELECT doc_id, length(coalesce(text, '')) AS chars,
             regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm
      FROM documents),
    best AS (
      SELECT norm, count(*) AS n,
             first(doc_id ORDER BY chars DESC, doc_id) AS keep_id
      FROM plain GROUP BY norm)
    SELECT p.doc_id, b.keep_id, b.n AS group_size, p.doc_id = b.keep_id AS kept, sha256(p.norm) AS text_sha256
    FROM plain p JOIN best b ON p.norm = b.norm
    """,
)
def op9_exact_dedup(spark, sf):
    return exact_dedup(table(spark, sf, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op7_mix_sources")
def op7_mix_sources(spark, sf):
    return mix(table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken", "shard")


@query("op8_byte_bpe")
def op8_byte_bpe(spark, sf):
    docs = table(spark, sf, "documents")
    return digests(encode_decode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN))


@query("op2_simhash")
def op2_simhash(spark, sf):
    return near_dedup(table(spark, sf, "documents"))


@query("op6_quality")
def op6_quality(spark, sf):
    docs = table(spark, sf, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf, "labels")))


@query("op10_toxicity")
def op10_toxicity(spark, sf):
    docs = table(spark, sf, "documents")
    return toxicity.grade(docs, toxicity.train(docs, table(spark, sf, "labels")))


@query("op1_token_files")
def op1_token_files(spark, sf):
    docs = table(spark, sf, "documents")
    return token_files(docs, public_tokenizers.path("word_bpe_49k.json")).select("doc_id", "start", "n_tokens", "ids_crc32")


@query("op3_licenses")
def op3_licenses(spark, sf):
    found = scan_licenses(table(spark, sf, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


@query(
    "op4_exact_topk",
    """
    WITH whole AS (
      SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
      FROM embeddings
      WHERE embedding IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
    scored AS (
      SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
             CAST(list_sum([p[1] * p[2] FOR p IN list_zip(q.v, c.v)]) AS BIGINT) AS score
      FROM whole q JOIN whole c ON q.vec_id <> c.vec_id
      WHERE q.vec_id % 50 = 0),
    ranked AS (
      SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
)
def op4_exact_topk(spark, sf):
    return top_k(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0)


@query(
    "op5_warc",
    """
    WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
    d AS (SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest,
                 max(page_id) OVER (PARTITION BY payload) AS latest FROM p)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= 1000 AND page_id < latest THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= 1000 AND page_id < latest THEN latest END AS refers_to
    FROM d
    """,
)
def op5_warc(spark, sf):
    return archive(table(spark, sf, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _merkle_sql(levels: int, upper_levels: int) -> str:
    """Trees of at most 16^levels rows a source and 16^upper_levels sources, one table per level."""
    part = lambda c: f"coalesce(strlen({c}) || ':' || {c}, '-')"
    leaf = lambda text: f"sha256({part('CAST(doc_id AS VARCHAR)')} || {part('source')} || {part('lang')} || {part('CAST(n_chars AS VARCHAR)')} || {part(text)})"
    small = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    tables = [
        f"""made AS (SELECT doc_id, CASE WHEN source IS NULL THEN '0' ELSE '1' || source END AS g, {leaf("text")} AS leaf, {leaf(small)} AS low, text FROM documents)""",
        """a0 AS (SELECT doc_id, g, leaf AS node, low, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM made)""",
    ]

    def climb(name: str, count: int) -> None:
        for i in range(count):
            run = "PARTITION BY g, pos // 16 ORDER BY pos"
            near = lambda a, b: f"coalesce(string_agg(node, '') OVER ({run} ROWS BETWEEN {a} AND {b}), '')"
            tables.append(f"{name}s{i} AS (SELECT *, CASE WHEN n > 1 THEN {near('UNBOUNDED PRECEDING', '1 PRECEDING')} END AS l, {near('1 FOLLOWING', 'UNBOUNDED FOLLOWING')} AS r FROM {name}{i})")
            tables.append(f"{name}{i + 1} AS (SELECT g, pos // 16 AS pos, (any_value(n) + 15) // 16 AS n, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(node, '' ORDER BY pos)) ELSE any_value(node) END AS node FROM {name}{i} GROUP BY g, pos // 16)")

    climb("a", levels)
    tables.append(f"b0 AS (SELECT '' AS g, g AS name, node, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM a{levels})")
    climb("b", upper_levels)
    # every leaf with its siblings on all levels
    joins, steps = [], []
    for i in range(levels):
        joins.append(f"JOIN as{i} t{i} ON t{i}.g = d.g AND t{i}.pos = d.pos // {16**i}")
        steps.append(f"t{i}")
    joins.append("JOIN bs0 u0 ON u0.name = d.g")
    steps.append("u0")
    for i in range(1, upper_levels):
        joins.append(f"JOIN bs{i} u{i} ON u{i}.pos = u0.pos // {16**i}")
        steps.append(f"u{i}")
    proof = " || ".join(f"coalesce({s}.l || {s}.r, '')" for s in steps)
    tables.append(
        f"""f0 AS (SELECT d.doc_id, d.node AS leaf, u0.node AS subroot, sha256({proof}) AS proof_sha256,
          CASE WHEN crc.tampered THEN d.low ELSE d.node END AS x, {", ".join(f"{s}.l AS l{i}, {s}.r AS r{i}" for i, s in enumerate(steps))}
          FROM a0 d {" ".join(joins)} JOIN crc ON crc.doc_id IS NOT DISTINCT FROM d.doc_id)"""
    )
    for i in range(len(steps)):
        tables.append(f"f{i + 1} AS (SELECT * REPLACE (CASE WHEN l{i} IS NULL THEN x ELSE sha256(l{i} || x || r{i}) END AS x) FROM f{i})")
    # CRC-32 of the decimal id, bit by bit: the table-free form of the public polynomial
    crc = f"""crc AS (SELECT doc_id, coalesce(xor(list_reduce(
        list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
        lambda s, c: list_reduce(list_prepend(xor(s, c), [CAST(i AS BIGINT) FOR i IN range(8)]),
          lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295) % 5 = 0, false) AS tampered
        FROM (SELECT DISTINCT doc_id FROM documents))"""
    tables.insert(0, crc)
    return f"""WITH {", ".join(tables)}
      SELECT doc_id, leaf, subroot, b.node AS root, proof_sha256, x AS folded_root, x = b.node AS verified
      FROM f{len(steps)}, (SELECT node FROM b{upper_levels}) b"""


@query("op13_merkle", _merkle_sql(6, 4))
def op13_merkle(spark, sf):
    return document_manifest(table(spark, sf, "documents"))


@query(
    "op11_phrases",
    r"""
    WITH pieces AS (
      SELECT row_number() OVER () AS id, lang, piece
      FROM (SELECT coalesce(lang, 'und') AS lang,
              unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents)),
    words AS (
      SELECT id, lang, unnest(w) AS w1, generate_subscripts(w, 1) AS i
      FROM (SELECT id, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces) WHERE len(w) > 0),
    beside AS (SELECT lang, w1, lead(w1) OVER p AS w2, lead(w1, 2) OVER p AS w3 FROM words WINDOW p AS (PARTITION BY id ORDER BY i)),
    counts AS MATERIALIZED (
      SELECT lang, 1 AS m, w1 AS phrase, count(*) AS f FROM beside GROUP BY ALL
      UNION ALL SELECT lang, 2, w1 || ' ' || w2, count(*) FROM beside WHERE w2 IS NOT NULL GROUP BY ALL
      UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) FROM beside WHERE w3 IS NOT NULL GROUP BY ALL),
    totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE m = 1 GROUP BY lang),
    candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE m > 1 AND f >= 10),
    cuts AS (
      SELECT c.lang, c.phrase, c.m, c.f AS a, k, x.f AS l, y.f AS r,
             CAST((1000000 * CAST(c.f AS HUGEINT) * c.f) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
      FROM candidates c, (SELECT unnest([1, 2]) AS k), counts x, counts y
      WHERE k < c.m AND x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : k], ' ')
        AND y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1 : c.m], ' ')),
    lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    inside AS (
      SELECT lang, part, max(f) AS longer
      FROM (SELECT lang, f, unnest([array_to_string(w[1 : 2], ' '), array_to_string(w[2 : 3], ' ')]) AS part FROM candidates WHERE m = 3)
      GROUP BY lang, part),
    kept AS (
      SELECT p.* FROM lowest p LEFT JOIN inside i ON i.lang = p.lang AND i.part = p.phrase
      WHERE i.longer IS NULL OR 100 * i.longer < 50 * p.a),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
    """,
)
def op11_phrases(spark, sf):
    return collocations(table(spark, sf, "documents"))


@query("op12_lempel")
def op12_lempel(spark, sf):
    return fingerprints(table(spark, sf, "documents"))
