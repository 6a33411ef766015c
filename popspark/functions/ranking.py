"""Exact ranks, quantiles and running sums without one task that holds all rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.shared import written

#: Buckets of one round of nearest_rank, and the different values that it may list on the driver.
BUCKETS = 256
LISTED = 10_000


def nearest_rank(df: DataFrame, column: str, d: float, last: bool = False, ascending: bool = False, listed: int = LISTED) -> DataFrame:
    """One row, `value`: the value of column (of numbers) at index int(d * n) of the sorted values (last: int(d * (n - 1))).

    Null if there is no such index; null values are left out, NaN is the greatest.  Different values are counted and written
    first.  Then their range is narrowed to the one of 256 buckets that holds the index, with borders from a quantile sketch
    (they say where to cut, the counts are exact), until `listed` different values at most are left, which the driver lists.
    So no task sorts all values, however many are different, and the rounds are the logarithm to base 256 of their number.
    """
    spark, value = df.sparkSession, F.col("value")
    counts = written(df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("c")))
    total, rows = counts.agg(F.sum("c"), F.count("*")).first()
    n, at, inside = total or 0, None, counts
    if n:
        index = math.floor(d * (n - 1 if last else n))
        at = index if ascending else n - 1 - index  # in rising order
    if at is None or not 0 <= at < n:
        return spark.createDataFrame([(None,)], counts.select("value").schema)
    while rows > listed:
        cuts = inside.agg(F.percentile_approx("value", [i / BUCKETS for i in range(1, BUCKETS)], 10_000)).first()[0]
        borders = F.array(*map(F.lit, cuts))
        bucketed = inside.withColumn("bucket", F.size(F.filter(borders, lambda x: x < F.col("value"))))  # bucket k: above border k - 1, up to border k
        for bucket, c, different in sorted(bucketed.groupBy("bucket").agg(F.sum("c"), F.count("*")).collect()):
            if at < c:
                break
            at -= c
        if different == rows:  # integers whose neighbours are one double; at most some thousands
            break
        rows = different
        if bucket > 0:
            inside = inside.where(value > cuts[bucket - 1])
        if bucket < len(cuts):
            inside = inside.where(value <= cuts[bucket])
    for row in inside.orderBy("value").collect():
        if at < row.c:
            break
        at -= row.c
    return spark.createDataFrame([(row.value,)], counts.select("value").schema)


def at_least(df: DataFrame, column: str, lo: int, hi: int, strict: bool = False, by: list[str] | None = None) -> DataFrame:
    """k = lo to hi and, for each, the number of rows whose column is at least k (strict: above k): a histogram, summed once."""
    by = by or []
    value = F.col(column) - 1 if strict else F.col(column)
    counts = df.groupBy(*by, F.least(value, F.lit(hi)).alias("v")).agg(F.count("*").alias("c"))
    ks = counts.select(*by).distinct() if by else df.sparkSession.range(1).select()
    ks = ks.select(*by, F.explode(F.sequence(F.lit(lo).cast("long"), F.lit(hi).cast("long"))).alias("v")).withColumn("c", F.lit(0).cast("long"))
    both = counts.where(F.col("v") >= lo).select(*by, F.col("v").cast("long"), "c").unionByName(ks).groupBy(*by, "v").agg(F.sum("c").alias("c"))
    running = F.sum("c").over(W.partitionBy(*by).orderBy(F.desc("v")))
    return both.select(*by, F.col("v").alias("k"), running.alias("rows"))


def number_rows(df: DataFrame, parts: list[Column], order: list[Column], name: str = "number", ascending: bool = False) -> DataFrame:
    """Number all rows from 1 in a total order.  parts: expressions that follow the order, falling or ascending, and split it into ranges.

    Ranges are counted, their offsets come from the counts, and rows are numbered within their range.
    """
    names = [f"_part{i}" for i in range(len(parts))]
    keyed = df.select("*", *[p.alias(n) for n, p in zip(names, parts)])
    counts = keyed.groupBy(*names).agg(F.count("*").alias("_c"))
    before = F.sum("_c").over(W.orderBy(*[F.asc(n) if ascending else F.desc(n) for n in names])) - F.col("_c")
    offsets = counts.withColumn("_before", before).drop("_c")
    within = F.row_number().over(W.partitionBy(*names).orderBy(*order))
    return keyed.withColumn("_within", within).join(offsets, names).withColumn(name, F.col("_before") + F.col("_within")).drop(*names, "_within", "_before")
