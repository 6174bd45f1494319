"""Bounded samples of labelled documents for fitting small models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import text_of


def held_out(id_col: str = "doc_id") -> Column:
    """True for the quarter of ids from which nothing is learned; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, longest: int, id_col: str = "doc_id", text_col: str = "text") -> tuple[list[tuple[str, int]], float]:
    """At most ``per_class`` texts of each label 0 and 1, none over ``longest`` code points, in an order fixed by id.

    Ids that are held out, null, or labelled both ways are left out. The ids are chosen before a text is read, so
    documents are scanned once, against a list of at most 2 * per_class ids. Of several texts of an id that with the
    smallest hash is taken, so that no more texts than ids reach the driver. The second value is the share of label 1
    among all such ids, sampled or not, so that a fit can weigh the sample back to it.
    """
    clear = labels.filter(F.col(label).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col)).groupBy(F.col(id_col).cast("long").alias("_id"))
    clear = clear.agg(F.min(label).cast("int").alias("_label"), F.max(label).cast("int").alias("_other")).filter("_label = _other").withColumn("_order", F.xxhash64("_id"))
    of = lambda y: clear.filter(F.col("_label") == y).orderBy("_order", "_id").limit(per_class)
    chosen = F.broadcast(of(0).unionByName(of(1)).select("_id", "_label", "_order"))
    texts = docs.select(F.col(id_col).cast("long").alias("_doc"), text_of(text_col).alias("_text")).filter((F.length("_text") > 0) & (F.length("_text") <= longest))
    found = texts.join(chosen, F.col("_doc") == F.col("_id")).groupBy("_order", "_id", "_label").agg(F.min_by("_text", F.xxhash64("_text")).alias("_text"))
    rows = found.select("_order", "_id", "_text", "_label").toArrow().to_pylist()
    rows.sort(key=lambda r: (r["_order"], r["_id"], r["_text"]))
    share = clear.agg(F.avg("_label")).first()[0]
    return [(r["_text"], r["_label"]) for r in rows], 0.5 if share is None else float(share)


def weights_to(share: float, labels: list[int]) -> list[float]:
    """Weights of mean one that bring the share of label 1 among ``labels`` back to ``share``; one if a label is missing."""
    ones = sum(labels)
    if not 0 < ones < len(labels) or not 0 < share < 1:
        return [1.0] * len(labels)
    return [share * len(labels) / ones if y else (1 - share) * len(labels) / (len(labels) - ones) for y in labels]
