"""Intervals and alignments."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.ranking import nearest_rank
from ..sources.shared import written
from .reads import natural_key

#: Fixed value: the pattern of clips of 20 bases and more, two digits from 20 on, or three.
CLIP = "[2-9].[SH]|[1-9][0-9].[SH]"
BIN = 1024
BUCKETS = 1 << 16
#: Rows of a part of a shuffle that would grow with the tables.
PART_ROWS = 200_000
#: Rows of a file of a table that is shuffled into many parts.  The writer of a shuffle may hold all that its task reads; a split of 128 MB has 32 files at
#: most, since Spark counts 4 MB more for each, so that's 1.6 million rows, however large the table is.
FILE_ROWS = 50_000


def filter_clipped(aln: DataFrame) -> DataFrame:
    return aln.where(~F.col("cigar").rlike(CLIP))


def filter_mapq(aln: DataFrame, min_mapq: int = 1) -> DataFrame:
    return aln.where(F.col("mapq") >= min_mapq)


def to_intervals(aln: DataFrame) -> DataFrame:
    """sample, contig, start, end (half-open, from 0) by the CIGAR operations that use up reference."""
    ops = F.regexp_extract_all("cigar", F.lit(r"([0-9]+)[MDN=X]"), F.lit(1))
    length = F.aggregate(ops, F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))
    return aln.select("sample", "contig", (F.col("pos") - 1).alias("start"), (F.col("pos") - 1 + length).alias("end"))


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """df by keys in parts of about PART_ROWS of its rows, however many there are; the session's number of partitions stays the same while tables grow."""
    return df.repartition(rows // PART_ROWS + 1, *keys)


def _united(iv: DataFrame, by: list[str] | None, bin_width: int) -> DataFrame:
    """Islands of iv(start, end, n, ...) within contig (and by), with the sum of n: first within the bins of the starts, then within contigs."""
    keys, rows = [*(by or []), "contig"], iv.count()

    def once(df: DataFrame, parts: list[str]) -> DataFrame:
        """An island's last row knows its end, and where the next island starts; no row is grouped, so all is one sort."""
        w = W.partitionBy(*parts).orderBy("start", "end")
        upto = w.rowsBetween(W.unboundedPreceding, 0)
        df = dealt(df, rows, *parts)
        df = df.select(*parts, F.max("end").over(upto).alias("end"), F.sum("n").over(upto).alias("_n"), F.lead("start").over(w).alias("_next"), F.first("start").over(upto).alias("_first"), F.row_number().over(w).alias("_no"))
        last = W.partitionBy(*parts).orderBy("_no")
        df = df.where("_next IS NULL OR end IS NULL OR _next > end")
        return df.select(*parts, F.coalesce(F.lag("_next").over(last), "_first").alias("start"), "end", (F.col("_n") - F.coalesce(F.lag("_n").over(last), F.lit(0))).alias("n"))

    binned = iv.select(*keys, "start", "end", "n").withColumn("_bin", F.floor(F.col("start") / bin_width))
    return once(once(binned, [*keys, "_bin"]).drop("_bin"), keys).select(*keys, "start", "end", "n")


def merge_intervals(iv: DataFrame, by: list[str] | None = None, bin_width: int = BIN, long_contigs: bool = False) -> DataFrame:
    """Unite intervals that overlap or touch, within contig (and by).

    Intervals are first united within the bins of their starts, so that the pass over a whole contig sees few of them.  That
    pass is one task for each contig, right for many contigs; with long_contigs no task holds one (merge_long), at some
    four times the cost.  iv is counted while the plan is built.
    """
    if long_contigs:
        return merge_long(iv, by, bin_width)
    return _united(iv.withColumn("n", F.lit(1).cast("long")), by, bin_width).drop("n")


def merged_coverage(iv: DataFrame, bin_width: int = BIN) -> DataFrame:
    """contig, start, end, depth: interval_coverage(merge_intervals(iv), iv) from the merge alone, since an interval with a base lies in one island.

    Only intervals without a base are joined to the islands; they count inside one, not at its ends.
    """
    islands = _united(iv.select("contig", "start", "end", (F.col("start") < F.col("end")).cast("long").alias("n")), None, bin_width).withColumnRenamed("n", "depth")
    points = iv.where("start >= end").select("contig", "start", "end")
    if points.isEmpty():
        return islands
    islands = written(islands)
    more = interval_coverage(islands.select("contig", "start", "end"), points).withColumnRenamed("depth", "_more")
    return islands.join(more, ["contig", "start", "end"]).select("contig", "start", "end", (F.col("depth") + F.col("_more")).alias("depth"))


def merge_long(iv: DataFrame, by: list[str] | None = None, bin_width: int = BIN) -> DataFrame:
    """merge_intervals for contigs of any length.

    Intervals are united within the bins of their starts.  What reaches into a bin from before comes from a row for each bin,
    in steps of a thousand bins; so the last pass is within bins again.
    """
    keys = [*(by or []), "contig"]
    same = lambda other: F.expr(" AND ".join(f"a.`{k}` <=> {other}.`{k}`" for k in keys))

    def running(df: DataFrame, parts: list[str]) -> DataFrame:
        """_before: the furthest end of the earlier intervals of the same part."""
        return df.withColumn("_before", F.max("end").over(W.partitionBy(*parts).orderBy("start", "end").rowsBetween(W.unboundedPreceding, -1)))

    binned = running(iv.select(*keys, "start", "end").withColumn("_bin", F.floor(F.col("start") / bin_width)), [*keys, "_bin"])
    island = F.sum(F.coalesce((F.col("start") > F.col("_before")).cast("long"), F.lit(1))).over(W.partitionBy(*keys, "_bin").orderBy("start", "end"))
    binned = written(binned.withColumn("_g", island).groupBy(*keys, "_bin", "_g").agg(F.min("start").alias("start"), F.max("end").alias("end")))
    reach = binned.groupBy(*keys, "_bin").agg(F.max("end").alias("_end")).withColumn("_coarse", F.floor(F.col("_bin") / 1000))
    coarse = reach.groupBy(*keys, "_coarse").agg(F.max("_end").alias("_end"))
    coarse = coarse.withColumn("_reach", F.max("_end").over(W.partitionBy(*keys).orderBy("_coarse").rowsBetween(W.unboundedPreceding, -1))).drop("_end")
    near = F.max("_end").over(W.partitionBy(*keys, "_coarse").orderBy("_bin").rowsBetween(W.unboundedPreceding, -1))
    before = reach.withColumn("_near", near).alias("a").join(coarse.alias("b"), same("b") & F.expr("a._coarse = b._coarse")).select("a.*", F.greatest("a._near", "b._reach").alias("_reach"))
    rows = binned.alias("a").join(before.alias("b"), same("b") & F.expr("a._bin = b._bin")).select("a.*", "b._reach")
    # the head of an island: nothing before reaches it; every interval belongs to the last head at or before it
    inner = F.max("end").over(W.partitionBy(*keys, "_bin").orderBy("start", "end").rowsBetween(W.unboundedPreceding, -1))
    head = F.coalesce(F.col("start") > F.greatest("_reach", inner), F.lit(True))
    rows = rows.withColumn("_head", F.when(head, F.col("start")))
    own = F.max("_head").over(W.partitionBy(*keys, "_bin").orderBy("start", "end"))
    parts = written(rows.withColumn("_own", own).groupBy(*keys, "_bin", "_own").agg(F.max("end").alias("end")))
    # islands that began in an earlier bin: the last head of the bins before, found in the same steps
    heads = parts.groupBy(*keys, "_bin").agg(F.max("_own").alias("_last")).withColumn("_coarse", F.floor(F.col("_bin") / 1000))
    far = heads.groupBy(*keys, "_coarse").agg(F.max("_last").alias("_last"))
    far = far.withColumn("_far", F.max("_last").over(W.partitionBy(*keys).orderBy("_coarse").rowsBetween(W.unboundedPreceding, -1))).drop("_last")
    last = F.max("_last").over(W.partitionBy(*keys, "_coarse").orderBy("_bin").rowsBetween(W.unboundedPreceding, -1))
    heads = heads.withColumn("_near", last).alias("a").join(far.alias("b"), same("b") & F.expr("a._coarse = b._coarse")).select("a.*", F.greatest("a._near", "b._far").alias("_begun"))
    whole = parts.alias("a").join(heads.alias("b"), same("b") & F.expr("a._bin = b._bin")).select(*[f"a.{k}" for k in keys], F.coalesce("a._own", "b._begun").alias("start"), "a.end")
    return whole.groupBy(*keys, "start").agg(F.max("end").alias("end")).select(*keys, "start", "end")


def order_by_reference(iv: DataFrame, contigs: DataFrame) -> DataFrame:
    """Sorted by the contigs' numbers, then start, in parts that grow in number with iv, which is written first."""
    iv = written(iv)
    rows = iv.count()
    found = dealt(iv, rows, "contig").join(contigs.select("contig", "contig_no"), "contig")
    return found.repartitionByRange(rows // PART_ROWS + 1, "contig_no", "start").sortWithinPartitions("contig_no", "start")


def _level(width: int) -> Column:
    """The finest of nine levels, of bins of width * 32 ** level bases, where an interval is no longer than a bin: it lies in two bins at most."""
    length = F.col("end") - F.col("start")
    return sum((length > (width << 5 * k)).cast("int") for k in range(8))


def _celled(df: DataFrame, other: DataFrame, up: Callable[[Column, Column], Column], width: int) -> DataFrame:
    """A row for each cell (_up, _level, _bin) of df's intervals, given the other table.

    Each interval is entered at its own level and once at each coarser level of the other table, never at a finer one.  _up tells
    (up: of the own and the other's level) which of the two tables has the coarser interval, so that two fine ones never meet in a coarse bin.
    """
    own = df.sparkSession.range(9).select(F.col("id").cast("int").alias("_own"))
    levels = other.select(_level(width).alias("_x")).distinct()
    grid = own.join(levels).select("_own", up(F.col("_own"), F.col("_x")).alias("_up"), F.greatest("_own", "_x").alias("_level")).distinct()  # 81 rows at most
    size = F.lit(width).cast("long") * F.expr("shiftleft(1L, 5 * _level)")
    cells = df.withColumn("_own", _level(width)).join(F.broadcast(grid), "_own").drop("_own").withColumn("_size", size)
    bins = F.sequence(F.floor(F.col("start") / F.col("_size")), F.floor(F.greatest(F.col("end") - 1, F.col("start")) / F.col("_size")))
    return cells.withColumn("_bin", F.explode(bins)).withColumn("_bucket", F.pmod(F.xxhash64("contig", "_up", "_level", "_bin"), F.lit(BUCKETS)).cast("int"))


def _deep(cells: DataFrame, deep: int, name: str) -> DataFrame:
    """Buckets of cells with more rows than deep and than four times the mean, and in how many parts to deal them: at most 16,384 buckets, and twice as many parts."""
    counts = cells.groupBy("_bucket").agg(F.count("*").alias("n"))
    limit = F.greatest(F.lit(deep), F.ceil(4 * F.sum("n").over(W.partitionBy()) / BUCKETS))
    return counts.select("_bucket", F.ceil(F.col("n") / limit).cast("int").alias(name)).where(F.col(name) > 1)


def overlap_join(a: DataFrame, b: DataFrame, width: int = BIN, deep: int = 50_000) -> DataFrame:
    """Pairs of a(contig, start, end, ...) and b(contig, start, end as b_start, b_end, ...) that overlap.

    Intervals are joined on bins whose width goes with their length, so one as long as a chromosome has a few rows as well; a pair
    counts only in the bin of the later start.  Cells are counted in BUCKETS buckets.  The rows of a bucket with more than `deep` are dealt
    into parts by place and input partition, and each part meets all the other table's rows there.  Dealing repeats no more than about half
    of the other table's rows beyond those in deep cells.  Rows with a null in contig, start or end give no pair.
    Both tables are read three times (levels, counts, join), so they are written first, in files of FILE_ROWS rows.
    """
    a, b = written(a, FILE_ROWS), written(b, FILE_ROWS)
    left, right = _celled(a, b, lambda own, x: x < own, width), _celled(b, a, lambda own, x: x > own, width)
    deals = [F.broadcast(_deep(left, deep, "_na")), F.broadcast(_deep(right, deep, "_nb"))]
    mine = lambda n: F.pmod(F.xxhash64("start", "end", F.spark_partition_id()), F.coalesce(n, F.lit(1))).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.coalesce(F.col(n), F.lit(1)) - 1))

    def parted(cells: DataFrame, own: str, other: str) -> DataFrame:
        for deal in deals:
            cells = cells.join(deal, "_bucket", "left")
        return cells.withColumn("_of" + own, mine(F.col(own))).withColumn("_of" + other, each(other)).drop("_na", "_nb", "_bucket")

    right = parted(right, "_nb", "_na").withColumnRenamed("start", "b_start").withColumnRenamed("end", "b_end").drop("_size")
    rows, on = a.count() + b.count(), ["contig", "_up", "_level", "_bin", "_of_na", "_of_nb"]
    pairs = dealt(parted(left, "_na", "_nb"), rows, *on).join(dealt(right, rows, *on), on).where("start < b_end AND b_start < end")
    return pairs.where(F.col("_bin") == F.floor(F.greatest("start", "b_start") / F.col("_size"))).drop("_up", "_level", "_bin", "_size", "_of_na", "_of_nb")


def interval_counts(iv: DataFrame, aln_iv: DataFrame) -> DataFrame:
    """contig, start, end, sample, depth: alignments over each interval, for the samples that have any."""
    return overlap_join(iv, aln_iv).groupBy("contig", "start", "end", "sample").agg(F.count("*").alias("depth"))


def coverage_by_interval(iv: DataFrame, aln_iv: DataFrame) -> DataFrame:
    """contig, start, end, sample, depth: alignments over each interval, for every sample; none is a row of 0.

    The table of every interval and sample is the result's own size, but only intervals, alignments and what overlaps are shuffled: an
    interval's counts meet in one row, and the other samples are put beside them there.  Use interval_counts where rows of 0 aren't needed.
    """
    iv, aln_iv, place = written(iv), written(aln_iv), ["contig", "start", "end"]
    samples = aln_iv.select("sample").distinct().agg(F.collect_list("sample").alias("_hit"), F.max(F.col("sample").isNull()).alias("_null"))
    samples = samples.select(F.when(F.col("_null"), F.concat("_hit", F.array(F.lit(None)))).otherwise(F.col("_hit")).alias("_all"))
    rows = iv.count() + aln_iv.count()
    pairs = dealt(overlap_join(iv.select(*place), aln_iv.where("sample IS NOT NULL")).select(*place, "sample"), rows, *place)
    counts = pairs.groupBy(*place, "sample").agg(F.count("*").alias("n")).groupBy(*place).agg(F.collect_list(F.struct("sample", F.col("n").alias("depth"))).alias("_hits"))
    own = dealt(iv.select(*place), rows, *place).join(counts, place, "left").join(F.broadcast(samples))
    without = F.expr("transform(array_except(_all, coalesce(_hits.sample, array())), s -> struct(s AS sample, 0L AS depth))")
    hits = F.coalesce("_hits", F.expr("filter(transform(_all, s -> struct(s AS sample, 0L AS depth)), x -> false)"))
    return own.select(*place, F.inline(F.concat(hits, without)))


def total_coverage(cov: DataFrame) -> DataFrame:
    return cov.groupBy("contig", "start", "end").agg(F.sum("depth").alias("depth"))


def interval_coverage(iv: DataFrame, aln_iv: DataFrame) -> DataFrame:
    """contig, start, end, depth over all samples: total_coverage of coverage_by_interval, but no row for a sample is made."""
    counts = overlap_join(iv, aln_iv.select("contig", "start", "end")).groupBy("contig", "start", "end").agg(F.count("*").alias("n"))
    return iv.join(counts, ["contig", "start", "end"], "left").select("contig", "start", "end", F.coalesce("n", F.lit(0)).alias("depth"))


def depth_ceiling(cov: DataFrame, d: float = 0.001) -> DataFrame:
    """The depth at index int(d * n) of all depths, falling."""
    return nearest_rank(cov, "depth", d).select(F.col("value").alias("ceiling"))


def filter_depth(cov: DataFrame, ceiling: DataFrame) -> DataFrame:
    return cov.join(F.broadcast(ceiling)).where("depth < ceiling").drop("ceiling")


def target_load(cov: DataFrame, ceiling: DataFrame, parts: int) -> DataFrame:
    load = F.sum((F.col("end") - F.col("start")) * F.col("depth"))
    return filter_depth(cov, ceiling).agg(F.bround(load / parts).cast("long").alias("target"))


def split_by_depth(cov: DataFrame, cut: int = 500_000) -> tuple[DataFrame, DataFrame]:
    """(high, low)."""
    return cov.where(F.col("depth") > cut), cov.where(F.col("depth") <= cut)


def make_windows(iv: DataFrame, width: int, step: int) -> DataFrame:
    """Windows of width bases every step bases; the last is cut at the interval's end."""
    starts = F.explode(F.sequence(F.col("start"), F.col("end") - 1, F.lit(step).cast("long")))
    return iv.where("start < end").withColumn("_s", starts).withColumn("end", F.least(F.col("_s") + width, F.col("end"))).withColumn("start", F.col("_s")).drop("_s")


def intersect_intervals(a: DataFrame, b: DataFrame) -> DataFrame:
    """The parts of a's intervals that lie in b's, with a's other columns."""
    pairs = overlap_join(a, b.select("contig", "start", "end"))
    return pairs.select(*[F.greatest("start", "b_start").alias(c) if c == "start" else F.least("end", "b_end").alias(c) if c == "end" else F.col(c) for c in a.columns])


def split_coverage(cov: DataFrame, cut: int, width: int) -> DataFrame:
    """Intervals deeper than cut in windows (step width + 1), the others as they are."""
    high, low = split_by_depth(cov, cut)
    return make_windows(high, width, width + 1).unionByName(low)


def balance_chunks(cov: DataFrame, target: int) -> DataFrame:
    """cov with load and chunk: intervals in natural order of contigs, a new chunk each time the running load passes target.

    Running loads come from contigs' sums and the loads within blocks of a contig, so no task holds a contig.
    """
    load = (F.col("end") - F.col("start")) * F.col("depth")
    cov = written(cov)
    rows = cov.withColumn("load", load).withColumn("_bin", F.floor(F.col("start") / (64 * BIN)))
    text, number = natural_key(F.col("contig"))
    bins = rows.groupBy("contig", "_bin").agg(F.sum("load").alias("_load"))
    sums = bins.groupBy("contig").agg(F.sum("_load").alias("_sum")).withColumn("_t", text).withColumn("_n", number)
    before = sums.select("contig", (F.sum("_sum").over(W.orderBy("_t", "_n", "contig").rowsBetween(W.unboundedPreceding, 0)) - F.col("_sum")).alias("_before"))
    upto = F.sum("_load").over(W.partitionBy("contig").orderBy("_bin").rowsBetween(W.unboundedPreceding, 0)) - F.col("_load")
    begun = bins.withColumn("_upto", upto).join(before, "contig").select("contig", "_bin", (F.col("_before") + F.col("_upto")).alias("_begun"))
    within = F.sum("load").over(W.partitionBy("contig", "_bin").orderBy("start", "end").rowsBetween(W.unboundedPreceding, 0))
    placed = dealt(rows, cov.count(), "contig", "_bin").withColumn("_within", within).join(begun, ["contig", "_bin"])
    return placed.withColumn("chunk", F.floor((F.col("_begun") + F.col("_within") - F.col("load")) / target)).drop("_begun", "_within", "_bin")


def _exits(jump: np.ndarray, low: int) -> np.ndarray:
    """For each row of a block that begins at number low, the first row behind the block that jumps lead to; jump is a row's next, from low on."""
    out, high = jump.copy(), low + len(jump)
    while (inside := out < high).any():
        out[inside] = out[out[inside] - low]
    return out


def fold_chunks(cov: DataFrame, target: int, alone: int, block: int = 20_000) -> DataFrame:
    """contig, start, end, depth, load and chunk (from 0) of the exact walk through all intervals in natural order.

    A row that brings the running load to target begins a chunk, with its load; a row with a load of at least `alone` is a chunk
    by itself, after which the running load is 0, but not after such a very first row.

    Were a chunk to begin with a row, the row that begins the next one is the first whose sum of loads reaches that before it plus
    target: looked up for all rows at once, in ranges of sums.  A block of about `block` rows follows these jumps to where they
    leave it; where the walk enters blocks is found by doubling the jumps between them.  No task holds more than a block or a range.
    """
    text, number = natural_key(F.col("contig"))
    order = [F.col("_t"), F.col("_n"), F.col("contig"), F.col("start"), F.col("end")]
    rows = cov.select("contig", "start", "end", "depth", ((F.col("end") - F.col("start")) * F.col("depth")).alias("load"), text.alias("_t"), number.alias("_n"))
    rows = written(rows)
    total = rows.count()
    parts = max(1, -(-total // block))
    rows = dealt(written(rows.repartitionByRange(parts, *order).withColumn("_block", F.spark_partition_id())), total, "_block")
    within, lone = W.partitionBy("_block").orderBy(*order), F.col("load") >= alone
    rows = rows.withColumn("_i", F.row_number().over(within) - 1).withColumn("_sum", F.sum("load").over(within.rowsBetween(W.unboundedPreceding, 0))).withColumn("_lone", lone)
    # of each block: rows and loads before it, the first lone row behind it, and whether the row before it is lone
    blocks = rows.groupBy("_block").agg(F.count("*").alias("n"), F.sum("load").alias("s"), F.min(F.when(lone, F.col("_i"))).alias("f"), F.max_by("_lone", "_i").alias("l"))
    by_block = W.orderBy("_block")
    before = lambda c: F.sum(c).over(by_block) - F.col(c)
    blocks = blocks.withColumn("_first", before("n")).withColumn("_loads", before("s")).withColumn("_then", F.col("f") + F.col("_first"))
    blocks = blocks.withColumn("_behind", F.min("_then").over(W.orderBy(F.desc("_block")).rowsBetween(W.unboundedPreceding, -1))).withColumn("_was", F.coalesce(F.lag("l").over(by_block), F.lit(False)))
    rows = rows.join(blocks.select("_block", "_first", "_loads", "_behind", "_was"), "_block")
    rows = rows.withColumn("i", F.col("_i") + F.col("_first")).withColumn("upto", F.col("_sum") + F.col("_loads"))
    coming = F.min(F.when(lone, F.col("i"))).over(W.partitionBy("_block").orderBy(F.desc("_i")).rowsBetween(W.unboundedPreceding, -1))
    after_lone = F.coalesce(F.lag("_lone").over(within), F.col("_was")) | (F.col("i") == 0)
    base = F.when(lone & (F.col("i") > 0), F.col("upto")).otherwise(F.col("upto") - F.col("load"))
    rows = written(rows.select(
        "_block", "i", "contig", "start", "end", "depth", "load", "upto", F.col("_lone").alias("lone"), F.coalesce(coming, F.col("_behind"), F.lit(total)).alias("stop"),
        (base + target).alias("goal"), F.when(lone & ~after_lone, 1).otherwise(0).alias("before"),
    ))

    # the first row behind i whose sum reaches the goal: as many rows have a smaller sum.  Row -1 stands for the beginning
    first_lone = F.coalesce(F.min(F.when(F.col("lone"), F.col("i"))), F.lit(total))
    beginning = rows.agg(first_lone.alias("stop")).select(F.lit(-1).cast("long").alias("i"), "stop", F.lit(target).cast("long").alias("goal"), F.lit(True).alias("lone"), F.lit(-1).alias("_block"))
    asked = rows.select("i", "stop", "goal", "lone", "_block").unionByName(beginning)
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("stop", "long"), ("lone", "boolean"), ("_block", "int"))]
    both = rows.select(F.col("upto").alias("v"), F.lit(1).alias("d"), "i", *nothing).unionByName(asked.select(F.col("goal").alias("v"), F.lit(0).alias("d"), "i", "stop", "lone", "_block"))
    both = written(both.repartitionByRange(2 * parts, "v", "d", "i").withColumn("range", F.spark_partition_id()))
    ranges = both.groupBy("range").agg(F.sum("d").alias("n"))
    ranges = ranges.select("range", (F.sum("n").over(W.orderBy("range")) - F.col("n")).alias("less"))
    smaller = F.sum("d").over(W.partitionBy("range").orderBy("v", "d", "i").rowsBetween(W.unboundedPreceding, 0))
    looked = dealt(both, 2 * total, "range").withColumn("smaller", smaller).where("d = 0").join(ranges, "range")
    jump = F.greatest(F.col("less") + F.col("smaller"), F.col("i") + 1)
    jumps = written(looked.select("i", "lone", "_block", F.when(jump < F.col("stop"), jump).alias("jump")))

    def leave(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("i")
        low = int(pdf["i"].iloc[0])
        out = _exits(pdf["jump"].fillna(total).to_numpy(np.int64), low)
        return pd.DataFrame({"i": pdf["i"].to_numpy(np.int64)[out < total], "jump": out[out < total]})

    entered = written(jumps.where("lone AND jump IS NOT NULL").select(F.col("jump").alias("i")).distinct())
    far = written(dealt(jumps.where("i >= 0"), total, "_block").groupBy("_block").applyInPandas(leave, "i long, jump long"))
    while True:
        new = written(dealt(entered, total, "i").join(dealt(far, total, "i"), "i").select(F.col("jump").alias("i")).distinct().join(entered, "i", "left_anti"))
        if new.isEmpty():
            break
        entered = written(entered.unionByName(new))
        far = written(dealt(far, total, "jump").join(dealt(far.select(F.col("i").alias("jump"), F.col("jump").alias("then")), total, "jump"), "jump").select("i", F.col("then").alias("jump")))

    def follow(pdf: pd.DataFrame) -> pd.DataFrame:
        """Whether each row begins a chunk by its load: those entered, and where their jumps lead within the block."""
        pdf = pdf.sort_values("i")
        low, jump = int(pdf["i"].iloc[0]), pdf["jump"].fillna(total).to_numpy(np.int64)
        begins = pdf["entered"].to_numpy(bool).copy()
        front = np.flatnonzero(begins)
        while len(front):
            front = np.unique(jump[front] - low)
            front = front[front < len(begins)]
            front = front[~begins[front]]
            begins[front] = True
        return pd.DataFrame({"i": pdf["i"], "begins": begins})

    marked = dealt(jumps.where("i >= 0"), total, "i").join(entered.withColumn("entered", F.lit(True)), "i", "left").withColumn("entered", F.coalesce("entered", F.lit(False)))
    begun = dealt(marked, total, "_block").groupBy("_block").applyInPandas(follow, "i long, begins boolean")
    rows = dealt(dealt(rows, total, "i").join(dealt(begun, total, "i"), "i"), total, "_block").withColumn("more", F.col("before") + F.col("begins").cast("int")).withColumn("after", F.col("lone").cast("int"))
    by_row = W.partitionBy("_block").orderBy("i")
    rows = written(rows.withColumn("nth", F.sum(F.col("more") + F.col("after")).over(by_row) - F.col("after")))
    counts = rows.groupBy("_block").agg(F.sum(F.col("more") + F.col("after")).alias("n"))
    counts = counts.select("_block", (F.sum("n").over(by_block) - F.col("n")).alias("earlier"))
    return rows.join(counts, "_block").select("contig", "start", "end", "depth", "load", (F.col("earlier") + F.col("nth")).alias("chunk"))


def merge_alignments(*aln: DataFrame) -> DataFrame:
    out = aln[0]
    for a in aln[1:]:
        out = out.unionByName(a)
    return out
