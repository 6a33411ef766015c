"""Mapping summaries over samples and contigs, and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.shared import written
from .intervals import BIN, dealt
from .sites import with_number


def flag_stats(aln: DataFrame) -> DataFrame:
    """sample, mapped, proper, mismatched (mate on another contig, mapping quality at least 5)."""
    mapped = F.col("flag").bitwiseAND(4) == 0
    proper = mapped & (F.col("flag").bitwiseAND(2) != 0)
    other = mapped & (F.col("rnext") != "=") & (F.col("mapq") >= 5)
    return aln.groupBy("sample").agg(F.count_if(mapped).alias("mapped"), F.count_if(proper).alias("proper"), F.count_if(other).alias("mismatched"))


def contig_counts(aln: DataFrame, contigs: DataFrame) -> DataFrame:
    """sample, contig, n mapped reads, for every sample and contig."""
    counts = aln.where(F.col("flag").bitwiseAND(4) == 0).groupBy("sample", "contig").agg(F.count("*").alias("c"))
    every = contigs.select("contig").join(aln.select("sample").distinct())
    return every.join(counts, ["sample", "contig"], "left").select("sample", "contig", F.coalesce("c", F.lit(0)).alias("n"))


def contig_coverage_stats(counts: DataFrame, include_unmapped_row: bool = False) -> DataFrame:
    """sample, contigs with reads, mean over all contigs, mean over those with reads."""
    rows = F.count("*") + (1 if include_unmapped_row else 0)
    some = F.count_if(F.col("n") > 0)
    return counts.groupBy("sample").agg(some.alias("contigs_hit"), (F.sum("n") / rows).alias("mean"), F.try_divide(F.sum("n"), some).alias("mean_hit"))


def mapping_results(per_sample: DataFrame, keys: list[str]) -> DataFrame:
    """Means and sums over samples for each setting: from flag_stats joined with contig_coverage_stats."""
    return per_sample.groupBy(*keys).agg(
        F.avg("mean").alias("cov"), F.avg("mean_hit").alias("cov_hit"), F.avg("contigs_hit").alias("mean_contigs"), F.sum("mapped").alias("sum_mapped"), F.sum("proper").alias("sum_proper"),
        F.avg("mapped").alias("mean_mapped"), F.avg("proper").alias("mean_proper"), F.avg("mismatched").alias("mean_mismatched"),
    )


def histogram(df: DataFrame, column: str, width: float, lo: float | None = None, hi: float | None = None) -> DataFrame:
    """bin (its middle) and count."""
    if lo is not None:
        df = df.where(F.col(column) >= lo)
    if hi is not None:
        df = df.where(F.col(column) <= hi)
    return df.where(F.col(column).isNotNull()).groupBy((F.floor(F.col(column) / width) * width + width / 2).alias("bin")).agg(F.count("*").alias("n"))


def coverage_histogram(counts: DataFrame, width: int = 10) -> tuple[DataFrame, DataFrame]:
    """(contig, average over samples), and its histogram."""
    average = counts.groupBy("contig").agg(F.avg("n").alias("coverage"))
    return average, histogram(average, "coverage", width)


def pick_samples(sizes: DataFrame, n: int = 20, seed: int = 1) -> DataFrame:
    """n samples by a seeded hash, without the tenth that is largest and the tenth that is smallest."""
    place = F.row_number().over(W.orderBy(F.desc("size"), "sample"))
    ranked = sizes.withColumn("_p", place).withColumn("_n", F.count("*").over(W.partitionBy()))
    middle = ranked.where("_p > _n div 10 AND _p <= _n - _n div 10").drop("_p", "_n")
    return middle.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), "sample")), "sample").limit(n)


def largest_samples(reads: DataFrame, n: int = 10) -> DataFrame:
    """The n samples with the most bases, and their bases."""
    return reads.groupBy("sample").agg(F.sum(F.length("seq").cast("long")).alias("bases")).orderBy(F.desc("bases"), "sample").limit(n)


def reads_of_largest(reads: DataFrame, n: int = 10) -> DataFrame:
    """The reads of the n samples with the most bases, united for an assembly."""
    return reads.join(F.broadcast(largest_samples(reads, n).select("sample")), "sample", "left_semi")


def step_report(before: DataFrame, after: DataFrame, label: str) -> DataFrame:
    """label, before, after, removed."""
    rows = before.select(F.lit(1).alias("b"), F.lit(0).alias("a")).unionByName(after.select(F.lit(0).alias("b"), F.lit(1).alias("a")))
    return rows.agg(F.coalesce(F.sum("b"), F.lit(0)).alias("before"), F.coalesce(F.sum("a"), F.lit(0)).alias("after")).select(F.lit(label).alias("label"), "before", "after", (F.col("before") - F.col("after")).alias("removed"))


def mean_depth_per_site(calls: DataFrame, n_ind: int | DataFrame) -> DataFrame:
    sums = with_number(calls.groupBy("chrom", "pos").agg(F.sum("dp").alias("_dp")), n_ind, "_n")
    return sums.select("chrom", "pos", (F.col("_dp") / F.col("_n")).alias("mean_dp"))


def top_values(df: DataFrame, column: str, n: int = 3) -> DataFrame:
    return df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(n)


def summarise_sweep(kopt: DataFrame) -> DataFrame:
    """kind, value, n: the mean contig count, the three commonest counts, and those of counts rounded to hundreds."""
    mean = kopt.agg(F.avg("n_contigs").alias("value"), F.count("*").alias("n")).select(F.lit("mean").alias("kind"), "value", "n")
    exact = top_values(kopt, "n_contigs").select(F.lit("count").alias("kind"), F.col("value").cast("double").alias("value"), "n")
    hundreds = top_values(kopt.select(F.bround("n_contigs", -2).alias("x")), "x").select(F.lit("hundreds").alias("kind"), F.col("value").cast("double").alias("value"), "n")
    return mean.unionByName(exact).unionByName(hundreds)


def pileup_counts(aln: DataFrame, min_mapq: int = 5, min_baseq: int = 5) -> DataFrame:
    """contig, pos, sample, base, n over the aligned bases of mapped reads.  Clips, insertions and deletions give no base; without qualities (*) all bases count."""
    own = aln.where(f"mapq >= {min_mapq} AND flag & 4 = 0").select("contig", "sample", F.col("pos").cast("long").alias("pos"), "seq", "qual", "cigar")
    own = own.withColumn("steps", F.expr("transform(arrays_zip(regexp_extract_all(cigar, '([0-9]+)[MIDNSHP=X]', 1), regexp_extract_all(cigar, '[0-9]+([MIDNSHP=X])', 1)), x -> struct(CAST(x['0'] AS INT) AS n, x['1'] AS op))"))
    spans = """aggregate(steps, struct(0 AS r, 0 AS a, CAST(array() AS ARRAY<STRUCT<r: INT, a: INT, n: INT>>) AS spans), (s, x) -> struct(
      s.r + if(x.op IN ('M', 'D', 'N', '=', 'X'), x.n, 0) AS r, s.a + if(x.op IN ('M', 'I', 'S', '=', 'X'), x.n, 0) AS a,
      if(x.op IN ('M', '=', 'X') AND x.n > 0, concat(s.spans, array(struct(s.r AS r, s.a AS a, x.n AS n))), s.spans) AS spans)).spans"""
    span = own.select("contig", "sample", "pos", "seq", "qual", F.explode(F.expr(spans)).alias("x"))
    # the pieces of reads meet by place before their bases are spread out: a piece is a fraction of its bases' rows
    bins = "sequence((pos + x.r) div {0}, (pos + x.r + x.n - 1) div {0})".format(BIN)
    piece = span.select("contig", "sample", "pos", "seq", "qual", "x", F.explode(F.expr(bins)).alias("_bin"))
    ends = f"greatest(0, _bin * {BIN} - pos - x.r) AS first", f"least(x.n, (_bin + 1) * {BIN} - pos - x.r) AS end"
    piece = piece.selectExpr("contig", "sample", "pos + x.r AS pos", "seq", "qual", "x.a AS a", "_bin", *ends)
    piece = piece.selectExpr("contig", "sample", "_bin", "pos + first AS pos", "substring(seq, CAST(a + first + 1 AS INT), CAST(end - first AS INT)) AS seq", "if(qual = '*', qual, substring(qual, CAST(a + first + 1 AS INT), CAST(end - first AS INT))) AS qual", "qual = '*' AS free", "end - first AS n")
    piece = dealt(piece, 5 * aln.count(), "contig", "_bin")
    one = piece.select("*", F.explode(F.expr("sequence(0, CAST(n - 1 AS INT))")).alias("i")).drop("n")
    base = one.selectExpr("contig", "_bin", "pos + i AS pos", "sample", "substring(seq, i + 1, 1) AS base", "if(free, NULL, ascii(substring(qual, i + 1, 1)) - 33) AS q")
    counts = base.where(f"base <> '' AND coalesce(q >= {min_baseq}, true)").groupBy("contig", "_bin", "pos", "sample", "base").agg(F.count("*").alias("n"))
    return counts.drop("_bin")


def call_by_threshold(pileup: DataFrame, ref: DataFrame, min_cov: int = 5, min_frac: float = 0.1, min_alt: int = 2, max_alleles: int = 10) -> DataFrame:
    """contig, pos, sample, cov, ref, alts, gt from counts and the reference's bases (contig, pos, ref).

    A sample with less than min_cov reads has no row.  A base is seen in a sample with min_alt reads and min_frac of its
    cover; alts are the bases other than ref seen in any sample, the most reads first (then by letter), max_alleles with
    ref.  gt holds the sample's one or two best-supported alleles by number; it is null where none of them is seen.
    """
    site, own = W.partitionBy("contig", "pos"), W.partitionBy("contig", "pos", "sample")
    seen = pileup.withColumn("cov", F.sum("n").over(own)).where(F.col("cov") >= min_cov).join(ref, ["contig", "pos"])
    seen = written(seen.withColumn("seen", F.expr(f"n >= {min_alt} AND n >= {min_frac}D * cov")))
    support = seen.where("seen AND base <> ref").groupBy("contig", "pos", "base").agg(F.sum("n").alias("total"))
    ranked = support.withColumn("no", F.row_number().over(site.orderBy(F.desc("total"), "base"))).where(F.col("no") < max_alleles)
    alts = ranked.groupBy("contig", "pos").agg(F.expr("transform(sort_array(collect_list(struct(no, base))), x -> x.base) AS alts"))
    rows = seen.groupBy("contig", "pos", "sample", "cov", "ref").agg(F.expr("sort_array(collect_list(if(seen, struct(-n AS n, base), NULL))) AS found"))
    numbered = rows.join(alts, ["contig", "pos"], "left").withColumn("alts", F.coalesce("alts", F.array().cast("array<string>")))
    best = "slice(filter(transform(found, x -> if(x.base = ref, 0, nullif(array_position(alts, x.base), 0))), x -> x IS NOT NULL), 1, 2)"
    gt = F.expr(f"transform(array({best}), b -> if(size(b) = 0, NULL, concat(array_min(b), '/', array_max(b))))[0]")
    return numbered.select("contig", "pos", "sample", "cov", "ref", "alts", gt.alias("gt"))
