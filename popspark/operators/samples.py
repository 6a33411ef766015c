"""Individuals and populations."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.ranking import nearest_rank
from ..sources.shared import written
from .sites import ALLELES, allele_sums, with_number

SITE = ["chrom", "pos"]


def missing_by_individual(calls: DataFrame, samples: DataFrame, n_sites: int | DataFrame) -> DataFrame:
    """sample, n_data, n_miss, f_miss over all sites, for each of samples(sample); one without any call misses all."""
    called = calls.groupBy("sample").agg(F.count("gt").alias("called"))
    both = with_number(samples.select("sample").join(called, "sample", "left"), n_sites, "n_data")
    miss = F.col("n_data") - F.coalesce("called", F.lit(0))
    return both.select("sample", "n_data", miss.alias("n_miss"), (miss / F.col("n_data")).alias("f_miss"))


def missing_cutoff(imiss: DataFrame, d: float = 0.14) -> DataFrame:
    """The missing rate at rank int(d * (n - 1)), falling."""
    return nearest_rank(imiss, "f_miss", d, last=True).select(F.col("value").alias("cutoff"))


def remove_missing_individuals(calls: DataFrame, samples: DataFrame, n_sites: int | DataFrame, cutoff: float | None = None, d: float = 0.14) -> DataFrame:
    """Drop individuals that miss more than the cutoff (or than the one at rank d)."""
    imiss = missing_by_individual(calls, samples, n_sites)
    limit = missing_cutoff(imiss, d) if cutoff is None else calls.sparkSession.range(1).select(F.lit(cutoff).alias("cutoff"))
    bad = imiss.join(F.broadcast(limit)).where("f_miss > cutoff").select("sample")
    return calls.join(bad, "sample", "left_anti")


def remove_low_depth_individuals(calls: DataFrame, d: float = 0.85) -> DataFrame:
    """Drop individuals whose mean depth is under that at rank int(d * (n - 1)), falling."""
    depth = calls.groupBy("sample").agg(F.avg("dp").alias("depth"))
    bad = depth.join(F.broadcast(nearest_rank(depth, "depth", d, last=True))).where("depth < value").select("sample")
    return calls.join(bad, "sample", "left_anti")


def keep_individuals(calls: DataFrame, names: DataFrame) -> DataFrame:
    return calls.join(names.select("sample"), "sample", "left_semi")


def remove_individuals(calls: DataFrame, names: DataFrame) -> DataFrame:
    return calls.join(names.select("sample"), "sample", "left_anti")


def missing_by_site_pop(calls: DataFrame, popmap: DataFrame) -> DataFrame:
    """chrom, pos, pop, n_data, n_miss, f_miss for every site and population; sites nobody of a population has count in full."""
    sizes = popmap.groupBy("pop").agg(F.count("*").alias("n_data"))
    called = calls.where(F.col("gt").isNotNull()).select(*SITE, "sample").join(popmap, "sample").groupBy(*SITE, "pop").agg(F.count("*").alias("called"))
    every = calls.select(*SITE).distinct().join(F.broadcast(sizes))
    miss = F.col("n_data") - F.coalesce("called", F.lit(0))
    return every.join(called, [*SITE, "pop"], "left").select(*SITE, "pop", "n_data", miss.alias("n_miss"), (miss / F.col("n_data")).alias("f_miss"))


def filter_missing_by_pop(calls: DataFrame, popmap: DataFrame, x: float, m: int = 1) -> DataFrame:
    """Drop sites that miss more than x in at least m populations."""
    bad = missing_by_site_pop(calls, popmap).where(F.col("f_miss") > x).groupBy(*SITE).agg(F.count("*").alias("n")).where(F.col("n") >= m)
    return calls.join(bad.select(*SITE), SITE, "left_anti")


def hwe_exact(hom1, het, hom2):
    """Exact test of Hardy-Weinberg proportions: the chance of a heterozygote count no likelier than the observed one.

    Numbers, or arrays of them.  Chances of all heterozygote counts of a triple come from the ratio of each to the one before.
    """
    a, h, b = (np.atleast_1d(np.asarray(x, np.int64)) for x in (hom1, het, hom2))
    n, rare, out = a + h + b, 2 * np.minimum(a, b) + h, np.ones(len(a))
    order, at = np.argsort(-rare, kind="stable"), 0
    while at < len(order):
        width = int(rare[order[at]]) // 2 + 1  # heterozygote counts: rare % 2, and so on by 2 up to rare
        own = order[at : at + max(1, (1 << 20) // width)]
        at += len(own)
        half, odd = (rare[own] // 2)[:, None], (rare[own] % 2)[:, None]
        j = np.arange(width - 1)
        hets, homs = odd + 2 * j, half - j
        others = n[own][:, None] - hets - homs
        with np.errstate(divide="ignore"):
            ratio = np.log(np.maximum(4.0 * homs * others, 0) / ((hets + 1.0) * (hets + 2.0)))
        logs = np.concatenate([np.zeros((len(own), 1)), np.cumsum(ratio, axis=1)], axis=1)
        logs -= logs.max(1, keepdims=True)
        chances = np.exp(logs)
        mine = chances[np.arange(len(own)), (h[own] - rare[own] % 2) // 2][:, None]
        out[own] = np.minimum(1.0, np.where(chances <= mine * (1 + 1e-9), chances, 0).sum(1) / chances.sum(1))
    return out if np.ndim(het) else float(out[0])


def _below_in_integers(hom1: int, het: int, hom2: int, limit: Fraction) -> bool:
    n, rare = hom1 + het + hom2, 2 * min(hom1, hom2) + het
    h, x = rare % 2, rare // 2
    way, ways = comb(n, h) * comb(n - h, x) << h, []
    while x >= 0:  # of all genotypes with these allele counts, how many have h heterozygotes
        ways.append(way)
        way = way * 4 * x * (n - h - x) // ((h + 1) * (h + 2))
        h, x = h + 2, x - 1
    own = ways[(het - rare % 2) // 2]
    return sum(w for w in ways if w <= own) * limit.denominator < limit.numerator * sum(ways)


def hwe_below(hom1: np.ndarray, het: np.ndarray, hom2: np.ndarray, limit: float) -> np.ndarray:
    """Whether hwe_exact is under limit, taken as the decimal number that it is written as; near it, by integers alone."""
    p, exact = hwe_exact(hom1, het, hom2), Fraction(str(limit))
    below = p < limit
    for i in np.flatnonzero(np.abs(p - limit) <= 1e-6 * max(limit, 1e-300)):
        below[i] = _below_in_integers(int(hom1[i]), int(het[i]), int(hom2[i]), exact)
    return below


def _by_triple(test, kind: str):
    """test, on arrays, as a column of the three counts; each different triple of a batch is tested once."""

    @F.pandas_udf(kind)
    def run(a: pd.Series, h: pd.Series, b: pd.Series) -> pd.Series:
        triples, which = np.unique(np.stack([a, h, b], axis=1), axis=0, return_inverse=True)
        return pd.Series(test(*triples.T)[which.ravel()]) if len(a) else pd.Series([], dtype=bool if kind == "boolean" else float)

    return run("hom1", "het", "hom2")


def genotype_counts(calls: DataFrame, popmap: DataFrame) -> DataFrame:
    """chrom, pos, pop, hom1, het, hom2 over called bi-allelic genotypes."""
    alt = F.col("a1") + F.col("a2")
    own = calls.where("gt IS NOT NULL AND a1 < 2 AND a2 < 2").select(*SITE, "sample", alt.alias("alt")).join(popmap, "sample")
    return own.groupBy(*SITE, "pop").agg(F.count_if(F.col("alt") == 0).alias("hom1"), F.count_if(F.col("alt") == 1).alias("het"), F.count_if(F.col("alt") == 2).alias("hom2"))


def hwe(calls: DataFrame, popmap: DataFrame) -> DataFrame:
    """genotype_counts with expected heterozygotes and the exact p."""
    n, ref = F.col("hom1") + F.col("het") + F.col("hom2"), 2 * F.col("hom1") + F.col("het")
    return genotype_counts(calls, popmap).withColumn("p", _by_triple(hwe_exact, "double")).withColumn("exp_het", F.try_divide(ref * (2 * n - ref), 2 * n))


def filter_hwe(calls: DataFrame, popmap: DataFrame, p: float = 0.001, cutoff: float = 0.25) -> tuple[DataFrame, DataFrame]:
    """(calls, excluded): sites with a p under `p` in more than `cutoff` of the populations are excluded.  A p equal to it is not under it."""
    pops = popmap.agg(F.count_distinct("pop").alias("pops"))
    tested = genotype_counts(calls, popmap).withColumn("_low", _by_triple(lambda a, h, b: hwe_below(a, h, b, p), "boolean"))
    low = tested.groupBy(*SITE).agg(F.count_if("_low").alias("low"))
    bad = low.join(F.broadcast(pops)).where(F.col("low") > cutoff * F.col("pops")).select(*SITE, "low")
    return calls.join(bad, SITE, "left_anti"), bad


def duplicate_mismatches(calls: DataFrame, pairs: DataFrame, min_dp: int = 5, unordered: bool = False) -> DataFrame:
    """chrom, pos and the number of pairs(sample_a, sample_b) whose genotypes differ there, both called at min_dp."""
    own = calls.where((F.col("dp") >= min_dp) & F.col("gt").isNotNull())
    gt = F.when(F.col("a1") > F.col("a2"), F.concat("a2", F.lit("/"), "a1")).otherwise(F.col("gt")) if unordered else F.col("gt")
    a = own.select(*SITE, F.col("sample").alias("sample_a"), gt.alias("gt_a")).join(F.broadcast(pairs), "sample_a")
    b = own.select(*SITE, F.col("sample").alias("sample_b"), gt.alias("gt_b"))
    return a.join(b, [*SITE, "sample_b"]).where("gt_a <> gt_b").groupBy(*SITE).agg(F.count("*").alias("pairs"))


#: The high error rates of heterozygotes at depths 1 to 5.
HIGH_RATES = (0.75, 0.5625, 0.42, 0.316, 0.237)


def error_count(calls: DataFrame, n_sites: int | DataFrame, n_samples: int | DataFrame) -> DataFrame:
    """Genotypes that low depth may have got wrong: counts at depths 1 to 5, the low and high expected errors, and their shares of all called.

    Genotypes of alleles 0 and 1 count: homozygotes at every depth, heterozygotes at depth 1, and at 2 and 3 if the next
    value (ro) starts with 0 or with the depth.
    """
    dp, hom = F.col("dp"), F.col("a1") == F.col("a2")
    called = F.col("gt").isNotNull()
    plain = called & (F.col("a1") < 2) & (F.col("a2") < 2)
    bare = F.substring(F.col("ro").cast("string"), 1, 1).isin("0") | F.col("ro").cast("string").startswith(dp.cast("string"))
    fits = {1: F.lit(True), 2: hom | bare, 3: hom | bare, 4: hom, 5: hom}
    counts = calls.agg(*[F.count_if(plain & (dp == d) & fits[d]).alias(f"n{d}") for d in fits], F.count_if(called).alias("called"))
    low = sum((F.col(f"n{d}") * 0.5**d for d in range(2, 6)), F.col("n1") * 0.5)
    high = sum((F.col(f"n{d}") * HIGH_RATES[d - 1] for d in range(2, 6)), F.col("n1") * HIGH_RATES[0])
    total = sum((F.col(f"n{d}") for d in range(2, 6)), F.col("n1"))
    columns = counts.columns
    counts = with_number(with_number(counts, n_sites, "_sites"), n_samples, "_samples")
    return counts.select(*columns, (F.col("_sites") * F.col("_samples")).alias("genotypes"), (low / F.col("called")).alias("low_share"), (high / F.col("called")).alias("high_share"), (total / F.col("called")).alias("depth_share"))


def genotype_totals(calls: DataFrame, n_sites: int | DataFrame, n_samples: int | DataFrame) -> DataFrame:
    """All genotypes, those missing (neither genotype nor depth), and the rest."""
    called = calls.agg(F.count_if(F.col("gt").isNotNull() | F.col("dp").isNotNull()).alias("called"))
    total = with_number(with_number(called, n_sites, "_sites"), n_samples, "_samples").withColumn("genotypes", F.col("_sites") * F.col("_samples"))
    return total.select("genotypes", (F.col("genotypes") - F.col("called")).alias("missing"), "called")


def site_pi(calls: DataFrame) -> DataFrame:
    """Nucleotide diversity of each site: the share of pairs of called copies that differ (null for a single copy)."""
    alike = sum((F.col(f"_{k}") * (F.col(f"_{k}") - 1) for k in range(1, ALLELES)), F.col("_0") * (F.col("_0") - 1))
    return allele_sums(calls).where("called > 0").select(*SITE, (1 - F.try_divide(alike, F.col("copies") * (F.col("copies") - 1))).alias("pi"))


def resample_pi(calls: DataFrame, popmap: DataFrame, rounds: int = 100, n: int = 15, seed: int = 1, alleles: int = 16) -> DataFrame:
    """pop, round and the mean site diversity of n individuals drawn by a seeded hash.

    Calls are shuffled once, for all rounds: each site's genotypes in a population become bits, one for each individual, of the digits of
    their allele numbers.  A task adds up its sites for all rounds at once, as products of genotypes and draws, and sends a sum for each
    round.  The draws, a bit for each individual and round, go with the tasks.  Allele numbers from `alleles` on raise an
    error: give a larger one.
    """
    people = written(popmap.select("sample", "pop").withColumn("_at", F.row_number().over(W.partitionBy("pop").orderBy("sample")) - 1))
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("round").cast("string"), "sample"))
    drawn = people.withColumn("round", F.explode(F.sequence(F.lit(1), F.lit(rounds))))
    drawn = drawn.withColumn("_n", F.row_number().over(W.partitionBy("pop", "round").orderBy(order, "sample"))).where(F.col("_n") <= n).select("pop", "round", "_at").toPandas()
    most = people.agg(F.coalesce(F.max("_at"), F.lit(-1))).first()[0] + 1
    words, digits = -(-most // 62), (alleles - 1).bit_length()
    draws = {}
    for pop, own in drawn.groupby("pop", dropna=False):
        draws[pop] = np.zeros((62 * words, rounds), np.float32)
        draws[pop][own["_at"], own["round"] - 1] = 1

    known = F.when(F.greatest("a1", "a2") < alleles, F.lit(True)).otherwise(F.raise_error(F.lit(f"{alleles} alleles or more")).cast("boolean"))
    own = calls.where(F.col("gt").isNotNull()).select(*SITE, "sample", "a1", "a2", known.alias("_known")).where("_known").join(people, "sample")
    bit = lambda there, w: F.bit_or(F.when(there & (F.floor(F.col("_at") / 62) == w), F.expr("shiftleft(1L, _at % 62)")).otherwise(F.lit(0).cast("long")))
    planes = [bit(F.col(a).isNotNull() if d < 0 else F.getbit(F.coalesce(a, F.lit(0)), F.lit(d)) == 1, w).alias(f"{a}_{d}_{w}") for a in ("a1", "a2") for d in range(-1, digits) for w in range(words)]
    packed = own.groupBy("pop", *SITE).agg(*planes).drop(*SITE)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for pop, rows in batch.groupby("pop", dropna=False):
                for at in range(0, len(rows), 1024):
                    bits = rows.iloc[at : at + 1024].drop(columns="pop").to_numpy(np.int64).reshape(-1, 2, digits + 1, words, 1)
                    bits = (bits >> np.arange(62) & 1).reshape(len(bits), 2, digits + 1, -1)
                    allele = np.where(bits[:, :, 0] == 1, (bits[:, :, 1:] << np.arange(digits)[:, None]).sum(2), -1)
                    counts = [(allele == k).sum(1).astype(np.float32) @ draws[pop] for k in np.unique(allele[allele >= 0]).tolist()]
                    copies, alike = sum(counts), sum((c.astype(np.float64) * (c - 1) for c in counts))
                    there = copies > 1
                    pi = np.where(there, 1 - alike / np.where(there, copies.astype(np.float64) * (copies - 1), 1), 0)
                    yield pd.DataFrame({"pop": pop, "round": np.arange(1, rounds + 1), "s": pi.sum(0), "n": there.sum(0), "sites": (copies > 0).sum(0)})

    kind = popmap.schema["pop"].dataType.simpleString()
    parts = packed.mapInPandas(sums, f"pop {kind}, round long, s double, n long, sites long").groupBy("pop", "round").agg(F.sum("s").alias("s"), F.sum("n").alias("n"), F.sum("sites").alias("sites"))
    return parts.where("sites > 0").select("pop", "round", F.try_divide("s", "n").alias("pi"))


def samples_of_pop(popmap: DataFrame) -> DataFrame:
    """pop and its samples, in order.  A population map has a row for each individual."""
    return popmap.groupBy("pop").agg(F.array_join(F.array_sort(F.collect_list("sample")), ",").alias("samples"), F.count("*").alias("n"))


def popmap_from_names(samples: DataFrame) -> DataFrame:
    return samples.select("sample", F.substring_index("sample", "_", 1).alias("pop"))


def check_sample_names(samples: DataFrame) -> DataFrame:
    return samples.where(~F.col("sample").contains("_"))


def rename_samples(df: DataFrame, mapping: DataFrame) -> DataFrame:
    """mapping(old, new); names that it lacks stay."""
    return df.join(mapping, df["sample"] == mapping["old"], "left").withColumn("sample", F.coalesce("new", "sample")).drop("old", "new")


def combine_calls(*calls: DataFrame) -> DataFrame:
    """Shards of one call set as one; a lone . becomes ./."""
    out = calls[0]
    for c in calls[1:]:
        out = out.unionByName(c)
    return out.withColumn("gt", F.when(F.col("gt") == ".", "./.").otherwise(F.col("gt")))
