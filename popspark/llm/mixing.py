"""Mixing sources to target weights by weighted fair queueing.

Each source's documents are shuffled by a hash.  A document's virtual finish time is its source's words up to and with
it, divided by the source's target; a source that must give more than it has goes round again, up to `most` times.
The mix is all documents by finish time, cut where their words reach the budget.
"""

from __future__ import annotations

from math import ceil, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import WORD, durable

BUCKET_ROWS = 50_000
#: Parts (by two hex digits fewer) and ranges of finish times that are summed together first, so that no running sum is over all of them.
COARSE_DIGITS, COARSE_RANGES = 2, 256


def place(seed: int = 42) -> Column:
    """Where a row stands in its source's shuffle: a hash of seed, doc_id and text."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("doc_id").cast("string"), F.col("text")))


def measured(docs: DataFrame, seed: int = 42, key: str | None = None) -> DataFrame:
    """doc_id, source, size (words), place (hex, orders the shuffle) and rid, which tells rows apart (the column key, if given); written once."""
    rid = F.col(key) if key else F.monotonically_increasing_id()
    return durable(docs.select("doc_id", "source", F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("size"), place(seed).alias("place"), rid.alias("rid")))


def upto(sums: DataFrame, value: str, order: str, coarse: Column, by: list[str]) -> DataFrame:
    """sums with upto, the running sum of value by order for each `by` (null is a key): over coarse groups, then within each."""
    rows = sums.withColumn("coarse", coarse)
    whole = rows.groupBy(*by, "coarse").agg(F.sum(value).alias("whole"))
    before = whole.withColumn("before", F.sum("whole").over(W.partitionBy(*by).orderBy("coarse")) - F.col("whole"))
    before = before.select(*[F.col(c).alias(f"{c}_") for c in (*by, "coarse")], "before")
    within = F.sum(value).over(W.partitionBy(*by, "coarse").orderBy(order))
    same = F.lit(True)
    for c in (*by, "coarse"):
        same = same & F.col(c).eqNullSafe(F.col(f"{c}_"))
    return rows.withColumn("within", within).join(before, same).withColumn("upto", F.col("before") + F.col("within")).select(*sums.columns, "upto")


def targets(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """source, source_size, weight and target of each source.

    Sources by code point, null last, weigh `weights`, repeating, and share all words; no target is above `most` times
    its source's words, and the excess goes to the others by weight.  Sources fill up in order of words by weight, so
    one pass over them finds which are full: a row for each source meets in one task, none for a document.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    nth = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (nth % len(weights) + 1).cast("int"))
    by_fill = W.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    full = F.col("source_size") * most
    rest = F.sum("source_size").over(W.partitionBy()) - F.sum(full).over(by_fill.rowsBetween(W.unboundedPreceding, 0)) + full
    heavier = F.sum("weight").over(by_fill.rowsBetween(0, W.unboundedFollowing))
    out = sizes.withColumn("weight", weight).withColumn("rest", rest).withColumn("heavier", heavier).withColumn("is_full", full * F.col("heavier") <= F.col("rest") * F.col("weight"))
    spare = F.sum("source_size").over(W.partitionBy()) - F.sum(F.when(F.col("is_full"), full).otherwise(0)).over(W.partitionBy())
    share = F.sum(F.when(~F.col("is_full"), F.col("weight"))).over(W.partitionBy())
    target = F.when(F.col("is_full"), full.cast("double")).otherwise((spare * F.col("weight")).cast("double") / share)
    return out.withColumn("target", target).select("source", "source_size", "weight", "target")


def finish_times(sized: DataFrame, goals: DataFrame, n: int, most: int = 3) -> DataFrame:
    """The rows of sized, `most` times each (lap 0 to most - 1), with source_size, target and finish.

    Sums run over buckets of the shuffled order first, so that no task holds a whole source.  Sources without words
    have no finish time and no rows.
    """
    digits = max(1, ceil(log(max(1, n / BUCKET_ROWS), 16)))
    rows = sized.withColumn("part", F.substring("place", 1, digits))
    parts = upto(rows.groupBy("source", "part").agg(F.sum("size").alias("part_size")), "part_size", "part", F.substring("part", 1, max(1, digits - COARSE_DIGITS)), ["source"])
    offsets = parts.select(F.col("source").alias("s"), F.col("part").alias("p"), (F.col("upto") - F.col("part_size")).alias("before"))
    goals = goals.select(F.col("source").alias("g"), "source_size", "target")
    offsets = offsets.join(goals, F.col("s").eqNullSafe(F.col("g"))).drop("g")
    within = F.sum("size").over(W.partitionBy("source", "part").orderBy("place", "size", "rid").rowsBetween(W.unboundedPreceding, 0))
    rows = rows.withColumn("within", within).join(offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
    rows = rows.where("source_size > 0").withColumn("lap", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
    reached = F.col("lap") * F.col("source_size") + F.col("before") + F.col("within")
    return rows.select("rid", "doc_id", "source", "size", "place", "source_size", "target", "lap", (reached / F.col("target")).alias("finish"))


def cut(queue: DataFrame, n: int) -> DataFrame:
    """The rows with the least finish times whose words reach the budget, all words of all sources: a range sort.

    Ranges of finish times are summed first.  Those that end within the budget stay whole; only the range in which the
    budget runs out is ordered row by row.
    """
    ranges = max(64, 8 * (n // BUCKET_ROWS))
    queue = queue.withColumn("range", F.least(F.floor(F.col("finish") * ranges), F.lit(64 * ranges)).cast("long"))
    sums = queue.groupBy("range").agg(F.sum("size").alias("range_size"), F.sum(F.when(F.col("lap") == 0, F.col("size"))).alias("own"))
    sums = upto(durable(sums), "range_size", "range", F.floor(F.col("range") / COARSE_RANGES), [])
    budget = sums.agg(F.coalesce(F.sum("own"), F.lit(0))).first()[0]
    sums = durable(sums.select(F.col("range").alias("r"), "upto", (F.col("upto") - F.col("range_size")).alias("start")).where(F.col("start") < budget)).withColumn("budget", F.lit(budget))
    queue = queue.join(sums, F.col("range") == F.col("r"))
    last = queue.where("upto > budget").withColumn("run", F.col("start") + F.sum("size").over(W.partitionBy("range").orderBy("finish", "source", "place", "size", "rid").rowsBetween(W.unboundedPreceding, 0)))
    return queue.where("upto <= budget").drop("range", "r", "upto", "start", "budget").unionByName(last.where("run <= budget").drop("range", "r", "upto", "start", "budget", "run"))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, seed: int = 42, key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, mix).  rows: every row of docs with doc_id, source, size, source_size, target, place, taken, laps and rid.

    mix: the taken rows in the mix's own terms (rid, lap, finish): order by finish to write it out.  taken counts the
    row's words once for each lap.  Null texts and texts without words have size 0: they have no words to take, and
    are in the mix as often as their place in the queue says.  A null source is a source.  Rows that repeat are rows of
    their own; reruns over the same rows agree but for which of rows with the same id, text and source goes first.  rid
    tells rows apart: the column `key` of docs, which must then be unique, or else a number given here.  Rows with the
    same id and text stand side by side in their source and so in one part.  An empty table gives no rows; other columns
    are ignored.
    """
    sized = measured(docs.select("doc_id", "source", "text", *([key] if key else [])), seed, key)
    n = sized.count()
    goals = durable(targets(sized, weights, most))
    mix = cut(finish_times(sized, goals, n, most), n)
    laps = mix.groupBy("rid").agg(F.count("*").cast("int").alias("laps"))
    goals = goals.select(F.col("source").alias("g"), "source_size", "target")
    rows = sized.join(laps, "rid", "left").join(F.broadcast(goals) if goals.limit(10_001).count() <= 10_000 else goals, F.col("source").eqNullSafe(F.col("g")))
    laps = F.coalesce("laps", F.lit(0))
    return rows.select("doc_id", "source", "size", "source_size", F.col("target"), "place", (F.col("size") * laps).alias("taken"), laps.alias("laps"), "rid"), mix
