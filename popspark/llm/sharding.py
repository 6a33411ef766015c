"""Sharding by k-d tree partitioning.

Nodes are split at weighted medians along their widest metadata dimension until every leaf is one shard of about the
target bytes.  Medians come from histograms of 16 bits of the value and then 16 bits of a hash that breaks ties, so a
value that holds many rows is split too.  Every level is a few grouped sums over a narrow table, which is written with
its new nodes; the tree itself is a table too, so nothing of it comes to the driver.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import crc32, durable, utf8

SLOT_ROWS = 200_000
#: Nodes of a level that are sent to every executor at most; more are joined by shuffle.
BROADCAST_NODES = 50_000
#: name -> SQL that gives a number; each is scaled to its own least and greatest value.
DIMENSIONS = {"lang": "crc32(cast(lang as binary))", "source": "crc32(cast(source as binary))", "length": "ln(size)", "id": "doc_id"}


def metadata(docs: DataFrame, dimensions: dict[str, str]) -> tuple[DataFrame, int]:
    """(doc_id, size, text_crc32, the dimensions as 0 to 65535 (q), and tie, a 16-bit hash; written once), and all bytes."""
    size = (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("long")
    out = docs.withColumn("size", size).select("doc_id", "size", crc32("text").alias("text_crc32"), *[F.coalesce(F.expr(sql).cast("double"), F.lit(0.0)).alias(f"d{i}") for i, sql in enumerate(dimensions.values())])
    out = durable(out)
    d = [f"d{i}" for i in range(len(dimensions))]
    ends = out.agg(*[f(x) for x in d for f in (F.min, F.max)], F.sum("size")).first()
    scaled = []
    for i, x in enumerate(d):
        low, high = ends[2 * i], ends[2 * i + 1]
        scaled.append(F.floor((F.col(x) - F.lit(low)) * (65535 / (high - low))).cast("int") if low is not None and high > low else F.lit(0))
    tie = F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(65536)).cast("long")
    return out.select("doc_id", "size", "text_crc32", F.array(*scaled).alias("q"), tie.alias("tie")), int(ends[-1] or 0)


def _crossing(rows: DataFrame, value: str, name: str) -> DataFrame:
    """For each node the least value (name) at which its running sum, on top of `base`, reaches `goal`, and the sum before it (base).

    A node's window has a row for each of at most 65,536 values.
    """
    sums = rows.groupBy("node", value).agg(F.sum("size").alias("s"), F.first("base").alias("base"), F.first("goal").alias("goal"))
    upto = F.col("base") + F.sum("s").over(W.partitionBy("node").orderBy(value))
    found = sums.withColumn("upto", upto).where("upto >= goal").groupBy("node").agg(F.min(F.struct(F.col(value).alias("v"), (F.col("upto") - F.col("s")).alias("before"))).alias("x"))
    return found.select("node", F.col("x.v").alias(name), F.col("x.before").alias("base"))


def _splits(rows: DataFrame, nodes: DataFrame, dimensions: int) -> DataFrame:
    """node, n, fewer (shards of its left part), dim (the widest), goal (bytes of its left part) and base of the nodes to split."""
    spread = [(F.max(F.col("q")[i]) - F.min(F.col("q")[i])).alias(f"w{i}") for i in range(dimensions)]
    widths = F.array(*[F.col(f"w{i}") for i in range(dimensions)])
    sums = rows.groupBy("node").agg(F.sum("size").alias("bytes"), *spread).join(nodes.where("n > 1"), "node")
    dim = (F.array_position(widths, F.array_max(widths)) - 1).cast("int")
    return sums.select("node", "n", F.expr("CAST(n div 2 AS INT)").alias("fewer"), dim.alias("dim"), F.expr("bytes * (n div 2) div n").alias("goal"), F.lit(0).cast("long").alias("base"))


def kd_shards(docs: DataFrame, target_bytes: int | None = None, shards: int | None = None, dimensions: dict[str, str] | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard (from 0) and slot (gapless from 0 within its shard) of every row.

    Give target_bytes, or the number of shards.  size is the text's UTF-8 bytes plus 1 (null: none); a null in a dimension
    counts as 0.  Rows with the same id and text fall together; all others can be split.  An empty table gives no rows; other
    columns are ignored.
    """
    dimensions = dimensions or DIMENSIONS
    rows, total = metadata(docs, dimensions)
    shards = shards or max(1, ceil(total / target_bytes))
    rows = durable(rows.withColumn("node", F.lit(0)))
    nodes = docs.sparkSession.range(1).select(F.lit(0).alias("node"), F.lit(shards).alias("n"))  # first shard of a node, its shards
    for level in range(ceil(log2(shards))):
        small = F.broadcast if min(2**level, shards) <= BROADCAST_NODES else lambda x: x
        splits = durable(_splits(rows, nodes, len(dimensions)))
        asked = rows.join(small(splits), "node").withColumn("v", F.element_at("q", F.col("dim") + 1))
        high = durable(splits.drop("base").join(_crossing(asked, "v", "split_at"), "node"))
        fine = rows.join(small(high), "node").where(F.element_at("q", F.col("dim") + 1) == F.col("split_at"))
        told = durable(high.drop("base").join(_crossing(fine, "tie", "tie_at").drop("base"), "node"))
        v = F.element_at("q", F.col("dim") + 1)
        right = (v > F.col("split_at")) | ((v == F.col("split_at")) & (F.col("tie") > F.col("tie_at")))
        moved = F.when(right, F.col("node") + F.col("fewer")).otherwise(F.col("node"))
        rows = durable(rows.join(small(told), "node", "left").select("doc_id", "size", "text_crc32", "q", "tie", F.coalesce(moved, F.col("node")).alias("node")))
        parts = told.select(F.explode(F.array(F.struct("node", F.col("fewer").alias("n")), F.struct((F.col("node") + F.col("fewer")).alias("node"), (F.col("n") - F.col("fewer")).alias("n")))).alias("x"))
        nodes = durable(nodes.join(told.select("node"), "node", "left_anti").unionByName(parts.select("x.node", "x.n")))
    rows = rows.select("doc_id", "size", "text_crc32", "tie", F.col("node").alias("shard"))
    parts = max(1, ceil(rows.count() / SLOT_ROWS))
    part = F.floor(F.col("tie") * parts / 65536).cast("int")
    counts = rows.groupBy("shard", part.alias("part")).agg(F.count("*").alias("n"))
    before = counts.select("shard", "part", (F.sum("n").over(W.partitionBy("shard").orderBy("part")) - F.col("n")).alias("before"))
    within = F.row_number().over(W.partitionBy("shard", "part").orderBy("tie", "doc_id", "text_crc32", "size")) - 1
    placed = rows.withColumn("part", part).withColumn("within", within).join(before, ["shard", "part"])
    return placed.select("doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("within")).alias("slot"))
