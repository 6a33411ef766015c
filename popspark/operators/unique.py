"""Unique sequences: counting, thresholds, curves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.ranking import at_least, number_rows


def unique_per_sample(df: DataFrame) -> DataFrame:
    """Identical sequences within each sample: sample, seq, n."""
    return df.groupBy("sample", "seq").agg(F.count("*").alias("n"))


def forward_counts(pairs: DataFrame) -> DataFrame:
    """pairs with n, the count of their forward sequence within the sample; counted before NNN pairs are dropped."""
    counted = pairs.withColumn("n", F.count("*").over(W.partitionBy("sample", "fwd")))
    return counted.where(~F.col("fwd").contains("NNN") & ~F.col("rev").contains("NNN"))


def coverage_curve(uniq: DataFrame, lo: int = 2, hi: int = 20, strict: bool = False) -> DataFrame:
    """k and the number of (sample, seq) rows with count at least k."""
    return at_least(uniq, "n", lo, hi, strict)


def filter_k1(uniq: DataFrame, k1: int) -> DataFrame:
    return uniq.where(F.col("n") >= k1)


def individuals_per_seq(uniq: DataFrame, k1: int) -> DataFrame:
    """seq and n_ind, the number of samples that hold it at least k1 times."""
    return filter_k1(uniq, k1).groupBy("seq").agg(F.count("*").alias("n_ind"))


def individuals_per_forward(counted: DataFrame, k1: int, k2: int) -> DataFrame:
    """From forward_counts: n_ind and the glued pair for every pair whose forward reaches k1 copies in at least k2 samples."""
    kept = counted.where(F.col("n") >= k1)
    per = kept.select("sample", "fwd").distinct().groupBy("fwd").agg(F.count("*").alias("n_ind")).where(F.col("n_ind") >= k2)
    return kept.join(per, "fwd").select("n_ind", F.concat("fwd", F.lit("N" * 10), "rev").alias("seq"))


def individual_curve(uniq_ind: DataFrame, n_samples: int) -> DataFrame:
    """i and the number of sequences in at least i samples, up to all samples, or half of them if there are over 10."""
    return at_least(uniq_ind, "n_ind", 2, n_samples // 2 if n_samples > 10 else n_samples)


def filter_k2(uniq_ind: DataFrame, k2: int) -> DataFrame:
    return uniq_ind.where(F.col("n_ind") >= k2)


def number_contigs(uniq_ind: DataFrame) -> DataFrame:
    """contig_no from 1 by falling number of samples, then falling text."""
    return number_rows(uniq_ind, [F.col("n_ind"), F.substring("seq", 1, 3)], [F.desc("n_ind"), F.desc("seq")], "contig_no")


def length_bounds(df: DataFrame) -> DataFrame:
    return df.agg(F.min(F.length("seq")).cast("long").alias("shortest"), F.max(F.length("seq")).cast("long").alias("longest"))


def filter_length(df: DataFrame, least: int) -> DataFrame:
    return df.where(F.length("seq") >= least)


def k1_k2_surface(uniq: DataFrame, k1s: range, k2s: range) -> DataFrame:
    """For each k1 and k2 (but 1 and 1) the number of sequences that reach k1 copies in k2 samples.

    Each row counts for the k1s up to its own count, so one pass gives all cells.
    """
    per_k1 = uniq.where(F.col("n") >= k1s[0]).select("seq", F.explode(F.sequence(F.lit(k1s[0]), F.least(F.col("n"), F.lit(k1s[-1])).cast("int"))).alias("k1"))
    counts = per_k1.groupBy("k1", "seq").agg(F.count("*").alias("n_ind"))
    return at_least(counts, "n_ind", k2s[0], k2s[-1], by=["k1"]).where("k1 + k > 2").select(F.col("k1").cast("long").alias("k1"), F.col("k").alias("k2"), F.col("rows").alias("n_seqs"))


def assembly_summary(uniq_k: DataFrame, contigs: DataFrame) -> DataFrame:
    """Sequences after the cutoffs and contigs produced, in one row."""
    a, b = uniq_k.select(F.lit(1).alias("x")), contigs.select(F.lit(0).alias("x"))
    return a.unionByName(b).agg(F.coalesce(F.sum("x"), F.lit(0)).alias("sequences"), F.coalesce(F.sum(1 - F.col("x")), F.lit(0)).alias("contigs"))


def unique_pooled(pairs: DataFrame) -> DataFrame:
    """Identical glued pairs over all samples, the second mate reverse-complemented: seq, n."""
    from .reads import revcomp

    return pairs.select(F.concat("fwd", F.lit("N" * 10), revcomp(F.col("rev"))).alias("seq")).groupBy("seq").agg(F.count("*").alias("n"))
