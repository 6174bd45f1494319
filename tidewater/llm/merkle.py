"""A Merkle manifest of a table: one tree per group, the groups' roots under one root.

The rows of a group stand in order; every run of 16 consecutive nodes becomes a parent, level by level, until one node
is left. On each level fixed-offset ``lag`` and ``lead`` columns, masked by a node's slot and the length of its run,
hold its siblings, and the row of the first child hashes the parent. Downwards a node's path is its own pair of left and
right siblings before the path of its parent, so a proof is made by joins of ever larger levels, never by a walk.

A place in a group is found without a window over the group: rows are range-sorted into files, and a row's place is its
number in the file plus the rows of the group in the files before. Windows hold one run of 16 rows, whatever a group
holds. A level is a staged table a sixteenth of the one below; the loop over levels is as long as a tree is high.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import ROW, staged, with_row
from tidewater.session import new_dir

#: Nodes of a run.
FAN = 16

CAPITALS, SMALLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

PATH = "array<struct<left:string,right:string>>"


def sealed(*values: Column) -> Column:
    """Digest of values, each with its length in bytes before it; null is a dash."""
    part = lambda v: F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))
    return F.sha2(F.concat(*[part(v.cast("string")) for v in values]), 256)


def placed(rows: DataFrame, order: list[Column], label: str) -> DataFrame:
    """Rows with ``pos``, the place in their ``group`` from 0, and ``n``, the size of the group."""
    spark = rows.sparkSession
    path = new_dir(spark, label)
    dealt = rows.repartitionByRange("group", *order).sortWithinPartitions("group", *order).withColumn("part", F.spark_partition_id())
    dealt.write.option("maxRecordsPerFile", 0).parquet(path)
    files = spark.read.schema(dealt.schema).parquet(path).withColumn("at", F.col("_metadata.row_index"))
    held = files.groupBy("group", "part").agg(F.min("at").alias("first"), F.count("*").alias("held"))  # one row per file and group
    whole = Window.partitionBy("group")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = held.select("group", "part", (F.coalesce(F.sum("held").over(before), F.lit(0)) - F.col("first")).alias("shift"), F.sum("held").over(whole).alias("n"))
    return files.join(shifts, ["group", "part"]).withColumn("pos", F.col("at") + F.col("shift")).drop("at", "shift", "part")


def with_siblings(nodes: DataFrame) -> DataFrame:
    """``run`` and ``slot`` of each node, and the digests of its run to its ``left`` and ``right``."""
    nodes = nodes.withColumn("run", F.floor(F.col("pos") / FAN)).withColumn("slot", F.col("pos") % FAN)
    nodes = nodes.withColumn("length", F.least(F.lit(FAN), F.col("n") - F.col("run") * FAN))
    near = Window.partitionBy("group", "run").orderBy("pos")
    left = [F.when(F.col("slot") >= j, F.lag("node", j).over(near)) for j in range(FAN - 1, 0, -1)]
    right = [F.when(F.col("slot") + j < F.col("length"), F.lead("node", j).over(near)) for j in range(1, FAN)]
    return nodes.withColumn("left", F.concat_ws("", *left)).withColumn("right", F.concat_ws("", *right))


def climb(leaves: DataFrame, label: str) -> list[DataFrame]:
    """The levels of all groups from the leaves up: ``group, pos, n, node``; a group ends where it has one node."""
    levels = [leaves.select("group", "pos", "n", "node")]
    while not (open_ := levels[-1].filter("n > 1")).isEmpty():
        first = with_siblings(open_).filter("slot = 0")
        above = first.select("group", F.col("run").alias("pos"), F.ceil(F.col("n") / FAN).alias("n"), F.sha2(F.concat("node", "right"), 256).alias("node"))
        levels.append(staged(leaves.sparkSession, above, label))
    return levels


def roots(levels: list[DataFrame]) -> DataFrame:
    """``group, height, node`` of the node in which each group ends."""
    ends = [level.filter("n = 1").select("group", F.lit(h).alias("height"), "node") for h, level in enumerate(levels)]
    return reduce(DataFrame.unionByName, ends)


def descend(leaves: DataFrame, levels: list[DataFrame], tops: DataFrame, label: str) -> DataFrame:
    """Leaves with their ``path`` to the root. ``tops``: ``group, height, path, subroot, root`` of the groups' last nodes."""
    path = F.concat(F.when(F.col("n") > 1, F.array(F.struct("left", "right"))).otherwise(F.array().cast(PATH)), F.col("path")).alias("path")
    above = None
    for height in range(len(levels) - 1, -1, -1):
        ends = tops.filter(F.col("height") == height).select("group", F.lit(0).cast("long").alias("run"), "path", "subroot", "root")
        above = ends if above is None else above.unionByName(ends)
        level = levels[height] if height else leaves
        own = [c for c in level.columns if c not in ("group", "pos", "n", "node")] if not height else []
        found = with_siblings(level).join(above, ["group", "run"])
        above = found.select("group", F.col("pos").alias("run"), path, "subroot", "root", *own, *([] if height else ["node"]))
        if height:
            above = staged(leaves.sparkSession, above, label)
    return above


def fold(start: Column, path: Column) -> Column:
    """The root that follows from a leaf and the siblings on its path."""
    return F.aggregate(path, start, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings on a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def manifest(df: DataFrame, fields: list[Column], group: Column, order: Column, keep: dict[str, Column]) -> DataFrame:
    """One row per row: the columns ``keep``, ``leaf, path, subroot, root``.

    A leaf is ``sealed(*fields)``. Groups ascend as UTF-8 bytes with null first; inside a group rows ascend by ``order``,
    null first, then by leaf, so rows that repeat stand side by side and any order of them gives the same tree. ``path``
    holds one pair of left and right siblings per level up to ``root``; it is empty for a table of one row. An empty
    table gives an empty result; columns that are not named are ignored.
    """
    spark = df.sparkSession
    rows = with_row(df, "merkle-rows")
    key = F.when(group.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), group.cast("string")))
    leaves = rows.select(key.alias("group"), order.alias("order"), sealed(*fields).alias("node"), F.struct(*[c.alias(k) for k, c in keep.items()]).alias("kept"), *[F.col(c).alias(c) for c in ROW])
    leaves = placed(leaves, [F.col("order").asc_nulls_first(), F.col("node"), *[F.col(c) for c in ROW]], "merkle-leaves").drop("order", *ROW)
    levels = climb(leaves, "merkle-level")
    subroots = staged(spark, roots(levels), "merkle-subroots")

    named = placed(subroots.select(F.lit("").alias("group"), F.col("group").alias("name"), "node"), [F.col("name")], "merkle-groups")
    upper = climb(named, "merkle-upper")
    ends = roots(upper).select("group", "height", F.array().cast(PATH).alias("path"), F.col("node").alias("subroot"), F.col("node").alias("root"))
    above = descend(named, upper, ends, "merkle-upper-path").select("name", "path", F.col("node").alias("subroot"), "root")
    tops = staged(spark, above.join(subroots.select(F.col("group").alias("name"), "height"), "name").withColumnRenamed("name", "group"), "merkle-tops")
    return descend(leaves, levels, tops, "merkle-path").select("kept.*", F.col("node").alias("leaf"), "path", "subroot", "root")


def document_manifest(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row of ``docs``, grouped by source.

    A fifth of the rows (5 divides the checksum of the id; never a null id) is tampered with by small letters for A-Z;
    ``folded_root`` follows from the tampered leaf, or else the original, and the original siblings. Every column may
    hold nulls; a tampered text without capitals is still verified.
    """
    named = lambda text: [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    small = F.translate(F.col("text").cast("string"), CAPITALS, SMALLS)
    keep = {"doc_id": F.col("doc_id"), "changed": F.when(tampered, sealed(*named(small)))}
    found = manifest(docs, named(F.col("text")), F.col("source"), F.col("doc_id"), keep)
    found = found.withColumn("folded_root", fold(F.coalesce("changed", "leaf"), F.col("path")))
    return found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
