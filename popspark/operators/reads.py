"""Reads, pairs and contigs: projections and filters."""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


#: Letters and what stands for them on the other strand, in capitals; other characters stay.
_STRAND = ("abcdefghijklmnopqrstuvwxyzACGT", "TBGDEFCHIJKLMNOPQRSAUVWXYZTGCA")


def revcomp(seq: Column) -> Column:
    return F.reverse(F.translate(seq, *_STRAND))


def normalise_names(reads: DataFrame) -> DataFrame:
    """Names that end in _1 or _2 end in /1 or /2, if some sample's first name has neither form of the standard."""
    odd = reads.where("ordinal = 0").agg(F.coalesce(F.bool_or(~F.col("name").rlike("/[12]$| [12]:")), F.lit(False)).alias("_odd"))
    mark = F.when(F.col("mate") == 1, F.regexp_replace("name", "_1$", "/1")).otherwise(F.regexp_replace("name", "_2$", "/2"))
    return reads.join(F.broadcast(odd)).withColumn("name", F.when(F.col("_odd"), mark).otherwise(F.col("name"))).drop("_odd")


#: Mutants of barcodes that are sent to every executor at most; more are joined by shuffle.
BROADCAST_MUTANTS = 500_000


def _mutants(barcodes: DataFrame, column: str, max_dist: int) -> DataFrame:
    """barcodes with start, each text of up to max_dist other bases than column has, and dist, how many."""
    out = barcodes.withColumn("start", F.col(column)).withColumn("dist", F.lit(0))
    for _ in range(max_dist):
        at = out.withColumn("i", F.explode(F.sequence(F.lit(1), F.length("start")))).withColumn("base", F.explode(F.array(*[F.lit(b) for b in "ACGTN"])))
        more = at.withColumn("start", F.expr("overlay(start PLACING base FROM i)")).withColumn("dist", F.col("dist") + 1).drop("i", "base")
        out = out.unionByName(more).groupBy(*barcodes.columns, "start").agg(F.min("dist").alias("dist"))
    return out


def demultiplex(reads: DataFrame, barcodes: DataFrame, max_dist: int = 1) -> DataFrame:
    """Give each read (seq) the sample whose barcode starts it, with up to max_dist other bases, and cut the barcode off.

    barcodes(sample, barcode) may be of several lengths, 64 at most.  The barcode with the fewest other bases wins, of these
    the longest; a read that is as near to two samples has none and goes, like one near to no barcode.  With a second barcode
    (barcode2), the reads' column index must be as near to that, and other bases count together.
    """
    second = "barcode2" in barcodes.columns
    own = barcodes.select("sample", "barcode", *["barcode2"] * second).distinct()
    found = _mutants(own, "barcode", max_dist)
    if second:
        other = _mutants(own.select("barcode2").distinct(), "barcode2", max_dist).select("barcode2", F.col("start").alias("index"), F.col("dist").alias("dist2"))
        found = found.join(other, "barcode2").withColumn("dist", F.col("dist") + F.col("dist2")).drop("dist2")
    keys = ["start", *["index"] * second]
    # of those with the same start: the nearest, and none if two samples are as near
    nearest = found.groupBy(*keys, "dist").agg(F.min("sample").alias("to"), F.count_distinct("sample").alias("n")).groupBy(*keys).agg(F.min_by(F.struct("dist", "to", "n"), "dist").alias("won"))
    told = nearest.select(*keys, F.struct(F.col("won.dist").alias("dist"), (-F.length("start")).alias("short"), "won.n", "won.to").alias("won"))
    lengths = sorted(r[0] for r in own.select(F.length("barcode")).distinct().limit(65).collect())
    if len(lengths) > 64:
        raise ValueError("barcodes of more than 64 lengths")
    small = told.limit(BROADCAST_MUTANTS + 1).count() <= BROADCAST_MUTANTS
    out = reads
    for n in lengths:
        table = told.where(F.length("start") == n).toDF("_start", *["_index"] * second, f"_won{n}")
        same = F.substring("seq", 1, n) == F.col("_start")
        same = same & (F.col("index") == F.col("_index")) if second else same
        out = out.join(F.broadcast(table) if small else table, same, "left").drop("_start", "_index")
    best = F.array_min(F.array_compact(F.array(*[F.col(f"_won{n}") for n in lengths])))
    out = out.withColumn("_best", best).where("_best.n = 1")
    return out.withColumn("sample", F.col("_best.to")).withColumn("seq", F.expr("substring(seq, 1 - _best.short)")).select(*reads.columns, *["sample"] * ("sample" not in reads.columns))


def min_length(reads: DataFrame) -> DataFrame:
    """Half (rounded down) the length of the longest of the samples' first reads."""
    return reads.where("ordinal = 0").agg(F.expr("CAST(max(length(seq)) AS BIGINT) div 2 AS min_len"))


def pair_reads(reads: DataFrame) -> DataFrame:
    """sample, ordinal, fwd and rev of reads that have both mates: one shuffle."""
    pick = lambda mate: F.max(F.when(F.col("mate") == mate, F.col("seq")))
    return reads.groupBy("sample", "ordinal").agg(pick(1).alias("fwd"), pick(2).alias("rev")).where("fwd IS NOT NULL AND rev IS NOT NULL")


def drop_ambiguous(pairs: DataFrame, run: str = "NNN") -> DataFrame:
    return pairs.where(~F.col("fwd").contains(run) & ~F.col("rev").contains(run))


def glue_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn("seq", F.concat("fwd", F.lit("N" * 10), "rev")).drop("fwd", "rev")


def split_pairs(glued: DataFrame) -> DataFrame:
    parts = F.split("seq", "N" * 10, 2)
    return glued.withColumn("fwd", parts[0]).withColumn("rev", F.get(parts, 1)).drop("seq")


def dedup_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.select("fwd", "rev").distinct()


def insert_model(reads: DataFrame) -> DataFrame:
    """Insert size from the longest read: twice its length, 100 less and more, and a fifth of it."""
    longest = F.max(F.length("seq")).cast("long")
    return reads.agg((2 * longest).alias("insert_size"), (2 * longest - 100).alias("low"), (2 * longest + 100).alias("high"), F.floor(2 * longest / 5).alias("sd"))


def insert_model_from_contigs(contigs: DataFrame) -> DataFrame:
    return contigs.agg(F.floor(F.avg(F.length("seq"))).alias("insert_size"))


def pad_contigs(contigs: DataFrame) -> DataFrame:
    return contigs.withColumn("seq", F.regexp_replace(F.regexp_replace("seq", "^([ACGT])", "N$1"), "([ACGT])$", "$1N"))


def relabel_contigs(contigs: DataFrame, prefix: str, old: str = "ctg_") -> DataFrame:
    return contigs.withColumn("contig", F.regexp_replace("contig", f"^{old}", prefix))


def count_matching(contigs: DataFrame, regex: str) -> DataFrame:
    return contigs.agg(F.count_if(F.col("seq").rlike(regex)).alias("matching"), F.count("*").alias("contigs"))


def natural_key(name: Column) -> list[Column]:
    """Sort keys of natural order: the text before the last number, then the number."""
    return [F.regexp_extract(name, r"^(.*?)[0-9]*$", 1), F.regexp_extract(name, r"([0-9]*)$", 1).try_cast("long")]


def natural_order(df: DataFrame, name: str = "contig") -> DataFrame:
    """df sorted by the text before the last number of name, then by the number, then by the whole name."""
    return df.orderBy(*natural_key(F.col(name)), name)


def split_by_length(df: DataFrame, least: int, most: int) -> DataFrame:
    n = F.length("seq")
    return df.where((n >= least) & (n <= most))


def cut_fixed(df: DataFrame, head_end: int, tail_start: int) -> DataFrame:
    """The first head_end bases as fwd and all from tail_start (from 1) as rev."""
    return df.withColumn("fwd", F.substring("seq", 1, head_end)).withColumn("rev", F.expr(f"substring(seq, {tail_start})")).drop("seq")


def mask_range(df: DataFrame, lo: int, hi: int) -> DataFrame:
    """Bases lo to hi (from 1) become N; a sequence that ends before keeps its length."""
    masked = F.concat(F.substring("seq", 1, lo - 1), F.expr(f"repeat('N', greatest(0, least(length(seq), {hi}) - {lo} + 1))"), F.expr(f"substring(seq, {hi + 1})"))
    return df.withColumn("seq", masked)


def barcode_mutants(barcode: str) -> list[str]:
    """All texts that differ from barcode in one base (for tests and small tables)."""
    return sorted({barcode[:i] + b + barcode[i + 1 :] for i, b in product(range(len(barcode)), "ACGTN")} - {barcode})


def _spans(quals: list[str], window: int, mean_q: int, q: int, unqual_pct: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the kept span of each read starts, and its size; 0 if the read goes.  All reads' scores lie in one array."""
    n = np.array([len(x) for x in quals], np.int64)
    scores = np.frombuffer("".join(quals).encode("latin-1", "replace"), np.uint8).astype(np.int64) - 33
    first = np.cumsum(n) - n
    sums, low = np.concatenate([[0], np.cumsum(scores)]), np.concatenate([[0], np.cumsum(scores < q)])
    read = np.repeat(np.arange(len(n)), n)
    width = np.minimum(window, n)[read]
    at = np.arange(len(scores))
    whole = at + width <= (first + n)[read]
    good = at[whole][(sums[(at + width)[whole]] - sums[at[whole]]) >= (mean_q * width)[whole]]
    start, end = np.full(len(n), 0), np.full(len(n), 0)
    start[read[good[::-1]]] = good[::-1]  # the first good window of each read is written last
    end[read[good]] = good + width[good]
    kept = end - start
    return np.where(kept > 0, start - first, 0), np.where(100 * (low[end] - low[start]) > unqual_pct * kept, 0, kept)


def trim_reads(reads: DataFrame, window: int = 5, mean_q: int = 15, q: int = 15, unqual_pct: int = 50, min_len: int = 1, paired: bool = False) -> DataFrame:
    """Cut each read to the span from its first to its last window with a mean quality of mean_q or more.

    Reads without such a window go (null and empty ones too), then those with more than unqual_pct % of bases below q, and
    those shorter than min_len.  paired: a mate stays only if both mates of its sample and ordinal stay.  Qualities are
    Phred + 33; a read shorter than the window is one window.
    """

    @F.pandas_udf("start int, size int")
    def span(qual: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(dict(zip(("start", "size"), _spans(list(qual), window, mean_q, q, unqual_pct))))

    own = reads.where("length(seq) > 0 AND length(seq) = length(qual)").withColumn("_cut", span("qual")).where(F.col("_cut.size") >= max(min_len, 1))
    kept = own.withColumns({c: F.expr(f"substring({c}, _cut.start + 1, _cut.size)") for c in ("seq", "qual")}).select(*reads.columns)
    if not paired:
        return kept
    both = kept.groupBy("sample", "ordinal").agg(F.countDistinct("mate").alias("n")).where("n = 2")
    return kept.join(both, ["sample", "ordinal"], "left_semi")


#: Of each pair of bits the lower one, and the lower n pairs.
_LOWER, _FIRST = np.uint64(0x5555555555555555), np.array([(1 << 2 * n) - 1 for n in range(33)], np.uint64)


def _windows(texts: list[str], codes: np.ndarray, groups: int) -> list[np.ndarray]:
    """At each letter of all texts, one behind the other, two bits of the codes of the 32 letters from there on, the first lowest; for each two bits of the codes."""
    own, out = codes[np.frombuffer("".join(texts).encode("latin-1", "replace"), np.uint8)], []
    for g in range(groups):
        out.append((own >> 2 * g & 3).astype(np.uint64))
        for i in (1, 2, 4, 8, 16):
            out[-1][:-i] |= out[-1][i:] << np.uint64(2 * i)
    return out


def best_overlaps(fwd: list[str], other: list[str], min_overlap: int, max_mismatch_frac: float, most: int = 1 << 18) -> np.ndarray:
    """Of each pair, how many bases of fwd's end and other's beginning overlap best; 0 if none do.

    Places of many pairs are tried at once, of each pair about two thirds of those left (`most` at most), the longest overlaps first: 32 letters are compared as
    bits, and only places that don't yet differ too much go on to the next 32.
    """
    found, least = np.zeros(len(fwd), np.int64), max(min_overlap, 1)
    sizes, at = np.cumsum([len(x) for x in fwd]), 0
    while at < len(fwd):
        stop = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + most, "right")))
        texts, others = fwd[at:stop], other[at:stop]
        n, m = np.array([len(x) for x in texts], np.int64), np.array([len(x) for x in others], np.int64)
        letters = np.unique(np.frombuffer("".join([*texts, *others]).encode("latin-1", "replace"), np.uint8))
        codes, groups = np.zeros(256, np.uint8), max(1, ((len(letters) - 1).bit_length() + 1) // 2)
        codes[letters] = range(len(letters))
        a, b = _windows(texts, codes, groups), _windows(others, codes, groups)
        ends, begins = np.cumsum(n), np.cumsum(m) - m
        best, score, high = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64), np.minimum(n, m)
        while True:
            low = np.maximum.reduce([high // 3, high - most, np.full(len(n), least - 1), score])  # no shorter overlap than the score can win
            count = np.maximum(high - low, 0)
            if not count.any():
                break
            pair = np.repeat(np.arange(len(n)), count)
            overlap = high[pair] - (np.arange(len(pair)) - np.repeat(np.cumsum(count) - count, count))
            x, y, wrong, whole = ends[pair] - overlap, begins[pair], np.zeros(len(pair), np.int64), []
            left = overlap
            while len(pair):
                apart = np.uint64(0)
                for p, q in zip(a, b):
                    differ = p[x] ^ q[y]
                    apart = apart | differ | differ >> np.uint64(1)
                wrong = wrong + np.bitwise_count(apart & _LOWER & _FIRST[np.minimum(left, 32)])
                near = wrong <= max_mismatch_frac * overlap
                done, on = np.flatnonzero(near & (left <= 32)), np.flatnonzero(near & (left > 32))
                whole.append((pair[done], overlap[done], wrong[done]))
                pair, overlap, wrong, x, y, left = pair[on], overlap[on], wrong[on], x[on] + 32, y[on] + 32, left[on] - 32
            pair, overlap, wrong = map(np.concatenate, zip(*whole))
            gain = overlap - 2 * wrong
            order = np.lexsort((overlap, gain, pair))
            order = order[np.flatnonzero(np.diff(pair[order], append=-1))]  # of each pair the greatest gain, of these the longest
            order = order[gain[order] > score[pair[order]]]
            best[pair[order]], score[pair[order]] = overlap[order], gain[order]
            high = low
        found[at:stop], at = best, stop
    return found


def merge_overlaps(pairs: DataFrame, min_len: int, max_mismatch_frac: float = 0.1, min_overlap: int = 10) -> tuple[DataFrame, DataFrame]:
    """Pairs whose forward read ends as the reverse read's other strand begins, as one read (seq), and all other pairs.

    The ungapped overlap with the most matches less mismatches wins, the longer one on a tie; bases come from the forward
    read there.  Merged reads shorter than min_len, and pairs with a null mate, are left un-merged.
    """

    strand = str.maketrans(*_STRAND)

    @F.pandas_udf("string")
    def merge(fwd: pd.Series, rev: pd.Series) -> pd.Series:
        own, other = fwd.fillna("").tolist(), [x[::-1].translate(strand) for x in rev.fillna("")]
        return pd.Series([a + b[n:] if n else None for a, b, n in zip(own, other, best_overlaps(own, other, min_overlap, max_mismatch_frac).tolist())], dtype=object)

    # not deterministic: else the filter on seq would run it once more
    tried = pairs.withColumn("seq", merge.asNondeterministic()("fwd", "rev"))
    good = F.coalesce(F.length("seq") >= min_len, F.lit(False))
    return tried.where(good).drop("fwd", "rev"), tried.where(~good).drop("seq")
