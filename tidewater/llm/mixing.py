"""Mixing sources to target weights by Sainte-Lague apportionment.

Equal-token blocks are the seats, the sources' targets are the votes: each block goes to the source with the highest
quotient target / (2 * blocks + 1). The method gives more blocks to nobody when the house shrinks, so the difference
between two house sizes is the integer quota of a shard. A source's documents stand in a seeded order and form one
stream of words, which its shards share in proportion to their quotas. Inside a shard the quota runs through the shard's
part of the stream from a seeded place on, round after round. So nearly every document is taken whole, every shard holds
the whole mixture in small, and a rerun takes the same.

The order is made by range-sorted files, so that neither a hot source nor rows that repeat meet in one task. Only one
row per source reaches the driver: the sources of a mixture are a list that a person weighs.
"""

from __future__ import annotations

import heapq
import random
import zlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import BLANKS, ROW, staged, text_of, with_row
from tidewater.operators.skew import hot_join
from tidewater.session import new_dir

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)

WORD = f"[^{BLANKS}]+"


def targets(sizes: list[int], weights: list[float], most: float = 3.0) -> list[float]:
    """Share all words by weight; a target stops at ``most`` times its size and the excess is shared again by weight."""
    result = [0.0] * len(sizes)
    open_, left = set(range(len(sizes))), float(sum(sizes))
    while open_:
        whole = sum(weights[i] for i in sorted(open_))
        share = {i: left * weights[i] / whole for i in sorted(open_)}
        full = [i for i in sorted(open_) if share[i] > most * sizes[i]]
        if not full:
            for i in share:
                result[i] = share[i]
            break
        for i in full:
            result[i] = most * sizes[i]
        open_.difference_update(full)
        left = float(sum(sizes)) - sum(result[i] for i in range(len(sizes)) if i not in open_)
    return result


def apportion(votes: list[float], seats: int) -> list[int]:
    """Sainte-Lague: seats by highest quotient, ties to the earlier party.

    The seats that a divisor a little too large would give are a prefix of the awards; the few others are awarded singly.
    """
    total, parties = sum(votes), len(votes)
    given = [0] * parties
    if total <= 0 or seats <= 0:
        return given
    if seats > parties:
        divisor = total / (seats - parties / 2 - 1)
        given = [max(0, int(v / divisor + 0.5) - 1) for v in votes]
    heap = [(-v / (2 * g + 1), i) for i, (v, g) in enumerate(zip(votes, given)) if v > 0]
    heapq.heapify(heap)
    for _ in range(seats - sum(given)):
        _, i = heapq.heappop(heap)
        given[i] += 1
        heapq.heappush(heap, (-votes[i] / (2 * given[i] + 1), i))
    return given


def shard_quotas(votes: list[float], seats: int, shards: int) -> list[list[int]]:
    """Blocks per shard and source; every shard holds the whole mixture in small."""
    ends = [apportion(votes, seats * s // shards) for s in range(shards + 1)]
    return [[b - a for a, b in zip(ends[s], ends[s + 1])] for s in range(shards)]


def plan(sources: list[tuple[str, int]], block: int, shards: int, seed: int, weights: tuple = WEIGHTS) -> list[dict]:
    """Per source (key, words): target and shards.

    A shard (number, a, b, rounds, begin, rest) owns the words a to b of the source's stream: it takes them all
    ``rounds`` times and ``rest`` words more from ``begin`` on, going on at ``a`` after ``b``.
    """
    sources = sorted(sources)
    sizes = [n for _, n in sources]
    goal = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))])
    quotas = shard_quotas(goal, round(sum(sizes) / block), shards)
    rows = []
    for i, (key, size) in enumerate(sources):
        blocks = [q[i] for q in quotas]
        whole, given, parts = sum(blocks), 0, []
        draw = random.Random(seed ^ zlib.crc32(key.encode()))
        for number, quota in enumerate(blocks):
            a, b = (size * given // whole, size * (given + quota) // whole) if whole else (0, 0)
            given += quota
            if b > a:
                words = min(quota * block, 3 * (b - a))
                begin = a + draw.randrange(-(-(b - a) // block)) * block
                parts.append((number, a, b, words // (b - a), begin, words % (b - a)))
        rows.append({"mix_key": key, "source_size": size, "target": goal[i], "shards": parts})
    return rows


def source_key(name: str):
    """Never null; sorts by code point with null last."""
    return F.when(F.col(name).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(name).cast("string")))


SPANS = "array<struct<a:bigint,b:bigint>>"


def _in_order(sized: DataFrame) -> DataFrame:
    """Rows with ``start``, the words before them in the stream of their source."""
    spark = sized.sparkSession
    order = ["mix_key", "place", "id", "size", "text_hash", *ROW]
    dealt = sized.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    path = new_dir(spark, "mix-order")
    dealt.write.option("maxRecordsPerFile", 0).parquet(path)
    files = spark.read.schema(dealt.schema).parquet(path).withColumn("at", F.col("_metadata.row_index"))
    parts = files.groupBy(F.col("mix_key").alias("at_key"), F.col("part").alias("at_part")).agg(F.sum("size").alias("n"))  # a row per file and source
    before = Window.partitionBy("at_key").orderBy("at_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("at_key", "at_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("mix_key", "part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.withColumn("inner", F.coalesce(F.sum("size").over(within), F.lit(0)))
    placed = placed.join(offsets, (F.col("mix_key") == F.col("at_key")) & (F.col("part") == F.col("at_part")))
    return placed.withColumn("start", F.col("offset") + F.col("inner")).drop("at_key", "at_part", "offset", "inner", "part", "at")


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int = 64, shards: int = 16, seed: int = 7, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: ``id, size, source_size, target, taken``, and how: ``shard, whole, pieces``.

    Every document is taken ``whole`` times, and once more each piece of its words, from ``a`` to ``b``. ``taken`` counts
    them all and is at most 3 times the size. ``shard`` is the shard in whose words the document begins, null where its
    source has none. Null texts have size 0 and take nothing; a null source is a source of its own, last in order; null
    ids take part like others. Rows that repeat are separate documents, whose plans may be told apart by nothing else.
    An empty table gives an empty result; other columns are ignored but for those in ``keep``, which stand beside the
    result.
    """
    spark = df.sparkSession
    rows = df if set(ROW) <= set(df.columns) else with_row(df, "mix-rows")
    more = [c for c in keep if c not in ROW]
    sized = staged(
        spark,
        rows.select(
            F.col(id_col).cast("long").alias("id"),
            source_key(source_col).alias("mix_key"),
            F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long").alias("size"),
            F.xxhash64(text_of(text_col)).alias("text_hash"),
            F.struct(*[F.col(c) for c in more]).alias("kept") if more else F.lit(0).alias("kept"),
            *ROW,
        ).withColumn("place", F.xxhash64(F.lit(seed), "id", "text_hash")),
        "mix-sizes",
    )
    totals = [(r[0], int(r[1])) for r in sized.groupBy("mix_key").agg(F.sum("size")).collect()]
    planned = [(r["mix_key"], r["source_size"], r["target"], r["shards"]) for r in plan(totals, block, shards, seed)]
    shard = "struct<number:int,from:bigint,to:bigint,rounds:bigint,begin:bigint,rest:bigint>"
    chosen = spark.createDataFrame(planned, f"plan_key string, source_size long, target double, shards array<{shard}>")
    placed = hot_join(_in_order(sized), chosen, {"mix_key": "plan_key"})

    start, end = F.col("start"), F.col("start") + F.col("size")
    empty = F.array().cast(SPANS)

    def inside(a: Column, b: Column) -> Column:
        """The words a to b of the stream that are the document's own, counted from its beginning; none if empty."""
        low, high = F.greatest(a, start) - start, F.least(b, end) - start
        return F.when(high > low, F.array(F.struct(low.alias("a"), high.alias("b")))).otherwise(empty)

    def pieces(s: Column) -> Column:
        """What a shard takes of the document beyond the whole copies."""
        stop = s["begin"] + s["rest"]
        own = F.flatten(F.array_repeat(inside(s["from"], s["to"]), (s["rounds"] - F.col("whole")).cast("int")))
        return F.concat(own, inside(s["begin"], F.least(stop, s["to"])), inside(s["from"], s["from"] + stop - s["to"]))

    touched = F.filter("shards", lambda s: (s["from"] < end) & (s["to"] > start))
    home = F.filter("shards", lambda s: (s["from"] <= start) & ((s["to"] > start) | (s["to"] == F.col("source_size"))))
    spans = F.transform("touched", lambda s: s["rounds"])
    result = (
        placed.withColumn("shard", F.get(home, 0)["number"])
        .withColumn("touched", touched)
        .withColumn("whole", F.coalesce(F.array_min(spans), F.lit(0)))
        .withColumn("pieces", F.flatten(F.transform("touched", pieces)))
        .withColumn("taken", F.col("whole") * F.col("size") + F.aggregate("pieces", F.lit(0).cast("long"), lambda n, p: n + p["b"] - p["a"]))
    )
    kept = [F.col(f"kept.{c}").alias(c) if c in more else F.col(c) for c in keep]
    return result.select(F.col("id").alias(id_col), "size", "source_size", "target", "taken", "shard", "whole", "pieces", *kept)


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mixture as documents with the columns of ``docs``: whole copies, and the few cut documents at the ends of a quota.

    A cut document holds its taken words, joined by single blanks. Documents of which nothing is taken are left out, and
    so are documents without words. Each row has its own plan, whatever other rows share its id.
    """
    spark = docs.sparkSession
    rows = with_row(docs, "mix-rows")
    taken = staged(spark, mix(rows, id_col, text_col, source_col, keep=ROW, **options), "mix-taken").filter("taken > 0")
    span = lambda a, b: F.struct(a.cast("long").alias("a"), b.alias("b"))
    pieces = F.concat(F.array_repeat(span(F.lit(0), F.col("size")), F.col("whole").cast("int")), "pieces")
    ways = taken.select(*[F.col(c).alias(f"_of{c}") for c in ROW], F.col("size").alias("_size"), pieces.alias("_pieces"))
    out = rows.join(ways, [F.col(c) == F.col(f"_of{c}") for c in ROW])
    out = out.withColumn("_piece", F.explode("_pieces"))
    cut = F.array_join(F.slice(F.regexp_extract_all(text_of(text_col), F.lit(f"({WORD})"), 1), (F.col("_piece.a") + 1).cast("int"), (F.col("_piece.b") - F.col("_piece.a")).cast("int")), " ")
    whole = (F.col("_piece.a") == 0) & (F.col("_piece.b") == F.col("_size"))
    changed = out.withColumn(text_col, F.when(whole, F.col(text_col)).otherwise(cut))
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.when(whole, F.col("n_chars")).otherwise(F.length(text_col)).cast(docs.schema["n_chars"].dataType))
    return changed.select(*docs.columns)
