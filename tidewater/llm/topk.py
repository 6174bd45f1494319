"""Exact top-k by inner product with the threshold algorithm.

Vectors are cut into blocks; a block keeps its rows sorted by every dimension. A query walks down all lists at once, from
the top where its component is positive and from the bottom where it is negative. Every row met is scored in full. The
values at the current depth bound the score of all rows not met; the walk stops when that bound is below the k-th best
score. All queries of a group walk together, those that have stopped drop out. Each group is one block of vectors with
one block of queries. The first block gives each query a floor, its k-th best score there: the walks of all blocks stop
at the floor too, and rows below it are not sent, so that little more than the result is merged by rank.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import staged

#: Below every score, in 64 bits and without a bound.
LOW, LOWEST = np.iinfo(np.int64).min, -(1 << 4000)


def whole_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``id, dim, data``: vectors as 64-bit floating integers floor(scale * x); rows that are not finite are left out.

    A product that no double holds is an error, as no score with it is a 64-bit number.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch["vector"]
            sizes = np.asarray(pc.list_value_length(vectors).fill_null(0)).astype(np.int64)
            flat = np.asarray(vectors.flatten().fill_null(np.nan), np.float64)
            ends = np.concatenate(([0], np.cumsum(sizes)))
            good = np.array(vectors.is_valid())
            finite = np.isfinite(flat)
            good[np.searchsorted(ends, np.flatnonzero(~finite), "right") - 1] = False
            with np.errstate(over="ignore"):
                numbers = np.where(finite, np.floor(np.where(finite, flat, 0) * scale), 0).astype("<f8")
            if not np.isfinite(numbers).all():
                raise OverflowError(f"a component times {scale} is beyond a double")
            data = [numbers[a:b].tobytes() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            out = pa.RecordBatch.from_arrays([batch["id"], pa.array(sizes.astype(np.int32)), pa.array(data, pa.binary())], ["id", "dim", "data"])
            yield out.filter(pa.array(good))

    source = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    return source.mapInArrow(work, "id long, dim int, data binary")


def _whole(numbers: np.ndarray, small: bool) -> np.ndarray:
    """Floating integers as 64-bit integers, or as integers of any size."""
    return numbers.astype(np.int64) if small else np.array([int(x) for x in numbers.ravel().tolist()], object).reshape(numbers.shape)


def walk(vectors: np.ndarray, queries: np.ndarray, own: np.ndarray, k: int, floor: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the rows met that may be among its k best, and their scores.

    ``own`` marks (query, row) not to count; ``floor`` holds scores that a query's k-th best is known to reach. Both
    arrays are 64-bit integers, or objects where a score may pass 64 bits.
    """
    n, dims = vectors.shape
    count, kind = len(queries), vectors.dtype
    low = LOW if kind == np.int64 else LOWEST
    floor = np.full(count, low, kind) if floor is None else floor
    order = np.argsort(vectors, axis=0, kind="stable")  # by dimension, ascending
    ranked = np.take_along_axis(vectors, order, 0)
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    scores = np.full((count, n), low, kind)
    met = np.zeros((count, n), bool)
    active = np.arange(count)
    depth = 0
    while len(active) and depth < n:
        deeper = min(n, max(8, depth * 2))
        fresh = np.zeros((len(active), n), bool)
        for d in range(dims):
            fresh[np.ix_(queries[active, d] > 0, order[n - deeper : n - depth, d])] = True
            fresh[np.ix_(queries[active, d] < 0, order[depth:deeper, d])] = True
        if not dims or deeper == n:
            fresh[:] = True
        fresh &= ~met[active]
        at, row = np.nonzero(fresh)
        met[active] |= fresh
        for a in range(0, len(at), 1 << 16):
            q, r = active[at[a : a + (1 << 16)]], row[a : a + (1 << 16)]
            product = np.einsum("pd,pd->p", queries[q], vectors[r]) if kind == np.int64 else (queries[q] * vectors[r]).sum(1)
            scores[q, r] = np.where(own[q, r], low, product)
        depth = deeper
        bound = up[active] @ ranked[n - depth] + down[active] @ ranked[depth - 1]
        kth = np.sort(scores[active], axis=1)[:, n - k] if n >= k else np.full(len(active), low, kind)
        least = np.maximum(kth, floor[active])
        active = active[(least <= bound) | (least == low)]
    return [((rows := np.flatnonzero((s > low) & (s >= f))), s[rows]) for s, f in zip(scores, floor)]


def _group(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    """Best k rows of one block of vectors for each query of one block of queries, none below the query's floor."""
    out: dict[str, list] = {"query": [], "query_id": [], "vec": [], "vec_id": [], "score": []}
    if left.num_rows and right.num_rows:
        numbers, asked_for = (np.frombuffer(b"".join(t["data"].to_pylist()), "<f8").reshape(t.num_rows, -1) for t in (left, right))
        small = not numbers.size or bool((np.abs(asked_for) @ np.abs(numbers).max(0)).max() < 2**62 and max(np.abs(numbers).max(), np.abs(asked_for).max()) < 2**62)
        vectors, queries = _whole(numbers, small), _whole(asked_for, small)
        low = LOW if small else LOWEST
        floor = np.array([low if f is None else f for f in right["floor"].to_pylist()], vectors.dtype)
        rows, names = left["row"].to_numpy(), left["id"].to_pylist()
        asked = right["row"].to_numpy()
        order_key = np.array([2**63 - 1 if v is None else v for v in names], np.int64)
        for q, (found, scores) in enumerate(walk(vectors, queries, asked[:, None] == rows[None, :], k, floor)):
            best = np.lexsort((rows[found], order_key[found]))
            best = best[np.argsort(-scores[best], kind="stable")][:k]
            out["query"] += [int(asked[q])] * len(best)
            out["query_id"] += [right["id"][q].as_py()] * len(best)
            out["vec"] += rows[found[best]].tolist()
            out["vec_id"] += [names[i] for i in found[best].tolist()]
            out["score"] += [None if score < LOW else score for score in scores[best].tolist()]
    if any(score is not None and score >= 2**63 for score in out["score"]):
        raise OverflowError("a score among the best is beyond 64 bits")
    return pa.table({name: pa.array(values, pa.int64()) for name, values in out.items()})


def top_k(
    df: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 5,
    scale: int = 256,
    block: int = 512,
    query_block: int = 512,
) -> DataFrame:
    """The ``k`` best rows of each query: ``query_id, rank, vec_id, score``; ties go to the smaller id.

    ``is_query`` is a condition on the id. Every row but the query's own is a candidate. Vectors that are null, or hold a
    null or a non-finite component, take no part; all others do, whatever their size. Sums are exact; if a score that is
    to be returned does not fit into 64 bits, the query fails with an error. A query meets vectors of its own length
    only. A null id is no query and loses ties; rows that repeat an id are separate candidates and separate queries; an
    empty table gives an empty result; other columns are ignored.
    """
    spark = df.sparkSession
    vectors = staged(spark, whole_vectors(df, id_col, vector_col, scale).withColumn("row", F.monotonically_increasing_id()), "topk-vectors")
    queries = staged(spark, vectors.withColumnRenamed("id", id_col).filter(is_query).withColumnRenamed(id_col, "id"), "topk-queries")
    blocks, query_blocks = max(1, ceil(vectors.count() / block)), max(1, ceil(queries.count() / query_block))
    number = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    mine = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    left = vectors.withColumn("block", mine(blocks)).withColumn("query_block", number(query_blocks))
    right = queries.withColumn("query_block", mine(query_blocks))
    keys = ("dim", "block", "query_block")

    def work(a: pa.Table, b: pa.Table) -> pa.Table:
        return _group(a, b, k)

    def best_of(rows: DataFrame, asked: DataFrame) -> DataFrame:
        found = rows.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(work, "query long, query_id long, vec long, vec_id long, score long")
        order = Window.partitionBy("query").orderBy(F.col("score").desc_nulls_last(), F.col("vec_id").asc_nulls_last(), "vec")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    no_floor = right.withColumn("floor", F.lit(None).cast("long"))
    first = best_of(left.filter("block = 0"), no_floor.withColumn("block", F.lit(0)))
    floors = staged(spark, first.filter(F.col("rank") == k).select(F.col("query").alias("row"), F.col("score").alias("floor")), "topk-floors")
    ranked = best_of(left, right.join(floors, "row", "left").withColumn("block", number(blocks)))
    score = F.when(F.col("score").isNull(), F.raise_error(F.lit("a score among the best is beyond 64 bits"))).otherwise(F.col("score"))
    return ranked.select("query_id", "rank", F.col("vec_id").alias(id_col), score.alias("score"))
