"""Operators on small hand-made tables: limits, missing values and printed figures of the walkthroughs."""

import random
from fractions import Fraction
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from popspark.functions.ranking import nearest_rank
from popspark.operators import intervals as I
from popspark.operators import mapping as M
from popspark.operators import reads as R
from popspark.operators import samples as P
from popspark.operators import sites as V
from popspark.operators import unique as U
from popspark.sources import formats as X

CALLS = "chrom string, pos long, sample string, gt string, a1 long, a2 long, dp long"


def calls(spark, rows):
    return spark.createDataFrame([(c, p, s, None if a is None else f"{a}/{b}", a, b, d) for c, p, s, a, b, d in rows], CALLS)


def test_nearest_rank(spark):
    df = spark.createDataFrame([(float(x),) for x in (5, 1, 3, 3, 2, 4)] + [(None,)], "x double")
    assert nearest_rank(df, "x", 0.0).first().value == 5 and nearest_rank(df, "x", 0.5).first().value == 3
    assert nearest_rank(df, "x", 1.0, last=True).first().value == 1
    assert nearest_rank(df, "x", 0.9, last=True, ascending=True).first().value == 4
    assert nearest_rank(df.limit(0), "x", 0.5).first().value is None
    assert nearest_rank(df, "x", 1.0).first().value is None  # index n
    odd = spark.createDataFrame([(x,) for x in (float("nan"), float("inf"), -0.0, 0.0, float("-inf"))], "x double")
    assert [str(nearest_rank(odd, "x", d, last=True, ascending=True, listed=1).first().value) for d in (0.0, 0.3, 0.5, 0.75, 1.0)] == ["-inf", "0.0", "0.0", "inf", "nan"]


@pytest.mark.parametrize("kind", ["double", "long"])
def test_nearest_rank_narrows_many_different_values(spark, kind):
    """Values over many powers of two (long: closer than doubles are), a third of the rows one value; no task sorts them."""
    rng = np.random.default_rng(3)
    if kind == "double":
        own = np.concatenate([rng.choice([-1.0, 1.0], 4000) * 2.0 ** rng.uniform(-900, 900, 4000), np.full(2000, 0.1)])
    else:
        own = np.concatenate([2**62 + rng.permutation(4000), np.full(2000, 2**62 + 17)])
    df = spark.createDataFrame([(x.item(),) for x in own], f"x {kind}").repartition(4)
    for d in (0.0, 0.4, 0.93):
        for last, ascending in ((True, True), (True, False)):
            want = sorted(own.tolist(), reverse=not ascending)[int(d * (len(own) - 1))]
            assert nearest_rank(df, "x", d, last, ascending, listed=10).first().value == want
    plan = nearest_rank(df, "x", 0.5)._jdf.queryExecution().toString()
    assert "Window" not in plan


def test_thresholds_are_inclusive(spark):
    uniq = spark.createDataFrame([("A_1", "x", 4), ("A_2", "x", 3), ("A_1", "y", 4)], "sample string, seq string, n long")
    assert {r.seq: r.n_ind for r in U.individuals_per_seq(uniq, 4).collect()} == {"x": 1, "y": 1}
    assert {r.k: r.rows for r in U.coverage_curve(uniq, 2, 5).collect()} == {2: 3, 3: 3, 4: 2, 5: 0}
    assert {r.k: r.rows for r in U.coverage_curve(uniq, 2, 5, strict=True).collect()} == {2: 3, 3: 2, 4: 0, 5: 0}
    assert {r.k: r.rows for r in U.coverage_curve(uniq.limit(0), 2, 3).collect()} == {2: 0, 3: 0}


def test_call_rate_counts_absent_rows_and_masked_genotypes(spark):
    c = calls(spark, [("c", 1, "A_1", 0, 1, 9), ("c", 1, "A_2", 0, 0, 2), ("c", 2, "A_1", 1, 1, 3)])
    assert {r.pos for r in V.max_missing(c, 0.5, 4).collect()} == {1}
    masked = V.min_depth(c, 3)
    assert {(r.pos, r.sample, r.gt, r.dp) for r in masked.collect()} == {(1, "A_1", "0/1", 9), (1, "A_2", None, 2), (2, "A_1", "1/1", 3)}
    assert P.genotype_totals(masked, 2, 2).first() == (4, 1, 3)  # a masked genotype keeps its depth
    assert P.missing_by_individual(masked, spark.createDataFrame([("A_2",), ("A_9",)], "sample string"), 2).where("f_miss = 1").count() == 2


def test_strand_filter_without_division(spark):
    s = spark.createDataFrame([(101, 0, 201, 0), (100, 1, 101, 1), (101, 1, 101, 1), (0, 0, 0, 0), (0, 5, 0, 1)], "saf long, sar long, srf long, srr long")
    assert [r.saf for r in V.filter_strand(s).collect()] == [101, 101, 0]


def test_snp_clusters_and_closest(spark):
    s = spark.createDataFrame([("c", p) for p in (1, 10, 26, 60, 100)] + [("d", 5)], "chrom string, pos long")
    assert sorted(r.pos for r in V.snp_clusters(s).collect()) == [1, 10, 26]
    assert {(r.chrom, r.pos): r.distance for r in V.closest_variant(s).collect()} == {("c", 1): 9, ("c", 10): 9, ("c", 26): 16, ("c", 60): 34, ("c", 100): 40, ("d", 5): None}


def test_missing_table_of_the_walkthrough(spark):
    rates = [0.611215, 0.55, 0.5, 0.2]
    imiss = spark.createDataFrame([(f"A_{i}", x) for i, x in enumerate([0.9] * 5 + rates + [0.1] * 31)], "sample string, f_miss double")
    assert P.missing_cutoff(imiss).first().cutoff == 0.611215  # rank int(0.14 * 39) = 5 of 40


def test_depth_limit_of_the_walkthrough(spark):
    s = spark.createDataFrame([("c", 1, 1952, 1.0), ("c", 2, 1952, 1.0), ("c", 3, 2085, 1.0), ("c", 4, 1819, 1.0)], "chrom string, pos long, dp long, qual double")
    assert [r.pos for r in V.low_quality_high_depth(s, "sqrt3").collect()] == [3]  # int(1952 + 3 * sqrt(1952)) = 2084


def test_hwe_exact():
    def brute(hom1, het, hom2):
        n, rare = hom1 + het + hom2, 2 * hom1 + het
        chance = {h: Fraction(2**h, factorial(h) * factorial((rare - h) // 2) * factorial((2 * n - rare - h) // 2)) for h in range(rare % 2, min(rare, 2 * n - rare) + 1, 2)}
        return float(sum(c for c in chance.values() if c <= chance[het]) / sum(chance.values()))

    assert P.hwe_exact(0, 0, 0) == 1.0
    for a in range(7):
        for b in range(7):
            for c in range(7):
                if a + b + c:
                    assert P.hwe_exact(a, b, c) == pytest.approx(brute(a, b, c), rel=1e-6)
    assert P.hwe_exact(250, 500, 250) == pytest.approx(1.0)
    rng = np.random.default_rng(3)
    a, h, b = rng.integers(0, 60, (3, 300))
    assert P.hwe_exact(a, h, b).tolist() == pytest.approx([brute(*map(int, x)) if sum(x) else 1.0 for x in zip(a, h, b)], rel=1e-9)
    assert P.hwe_exact(20_000, 100, 30_000) == pytest.approx(0.0, abs=1e-300) and 0 < P.hwe_exact(30_000, 40_000, 13_500) < 1


def test_p_equal_to_the_limit_is_not_below_it(spark):
    triples = [(2, 0, 1), (6, 1, 1), (1, 1, 1), (5, 0, 5)]  # the first two have a p of 1/5
    a, h, b = np.array(triples).T
    assert P.hwe_below(a, h, b, 0.2).tolist() == [False, False, False, True]
    assert P.hwe_below(a, h, b, 0.2000000001).tolist() == [True, True, False, True]
    assert [P._below_in_integers(*t, Fraction(1, 5)) for t in triples] == [False, False, False, True]
    own = [("c", pos, f"A_{i}", g // 2, (g + 1) // 2, 9) for pos, t in enumerate(triples) for i, g in enumerate([0] * t[0] + [1] * t[1] + [2] * t[2])]
    popmap = spark.createDataFrame([(f"A_{i}", "A") for i in range(12)], "sample string, pop string")
    kept, out = P.filter_hwe(calls(spark, own), popmap, p=0.2)
    assert [(r.pos, r.low) for r in out.collect()] == [(3, 1)] and {r.pos for r in kept.collect()} == {0, 1, 2}
    kept, out = P.filter_hwe(calls(spark, own), popmap, p=0.201, cutoff=0.99)
    assert {r.pos for r in out.collect()} == {0, 1, 3}


def test_merge_is_idempotent_and_joins_touching(spark):
    iv = spark.createDataFrame([("c", 0, 10), ("c", 10, 12), ("c", 2, 5), ("c", 13, 14), ("c", 1000, 5000), ("c", 1020, 1030), ("c", 4999, 5001), ("d", 1, 2)], "contig string, start long, end long")
    once = I.merge_intervals(iv)
    want = {("c", 0, 12), ("c", 13, 14), ("c", 1000, 5001), ("d", 1, 2)}
    assert {tuple(r) for r in once.collect()} == want == {tuple(r) for r in I.merge_intervals(once).collect()}


def test_overlaps_are_found_once(spark):
    a = spark.createDataFrame([("c", 0, 5000), ("c", 1024, 1025), ("c", 1023, 1024)], "contig string, start long, end long")
    b = spark.createDataFrame([("c", 100, 4000), ("c", 1024, 1026), ("d", 0, 9)], "contig string, start long, end long")
    assert sorted((r.start, r.b_start) for r in I.overlap_join(a, b).collect()) == [(0, 100), (0, 1024), (1023, 100), (1024, 100), (1024, 1024)]


def test_chunks_by_fold(spark):
    cov = spark.createDataFrame([("c_2", 0, 1, 5), ("c_10", 0, 1, 5), ("c_1", 0, 1, 100), ("c_3", 0, 1, 100), ("c_4", 0, 1, 5)], "contig string, start long, end long, depth long")
    for block in (1, 2, 100):
        got = {r.contig: r.chunk for r in I.fold_chunks(cov, 10, 100, block).collect()}
        # the first row alone doesn't reset the running load, so c_2 begins a chunk again; c_4 and c_10 reach the target together
        assert got == {"c_1": 0, "c_2": 2, "c_3": 3, "c_4": 4, "c_10": 5}


def plain_fold(load, target, alone):
    """The walk by its four rules."""
    chunk, run, lone, out = 0, 0, False, []
    for i, x in enumerate(load):
        run += x
        if x >= alone:
            chunk += not (lone or i == 0)
            out.append(chunk)
            run, chunk, lone = run if i == 0 else 0, chunk + 1, True
        else:
            if run >= target:
                chunk, run = chunk + 1, x
            out.append(chunk)
            lone = False
    return out


@pytest.mark.parametrize("block", [1, 7, 60, 1000])
def test_fold_in_blocks_is_the_walk(spark, block):
    import random

    rng = random.Random(block)
    rows = [(f"c_{i // 9}", i, i + 1, rng.choice([0, 1, 2, 5, 8, 30])) for i in range(150)]
    cov = spark.createDataFrame(rows, "contig string, start long, end long, depth long").repartition(5)
    got = [r.chunk for r in sorted(I.fold_chunks(cov, 12, 30, block).collect(), key=lambda r: r.start)]
    assert got == plain_fold([r[3] for r in rows], 12, 30)
    assert I.fold_chunks(cov.limit(0), 12, 30).count() == 0


@pytest.mark.parametrize("block,target,alone,first", [(7, 400, 10**6, 0), (7, 150, 30, 30), (3, 1, 30, 1), (40, 90, 25, 8)])
def test_fold_with_a_target_above_every_block(spark, block, target, alone, first):
    import random

    rng = random.Random(target)
    rows = [("c_1" if i < 120 else "c_2", i, i + 1, first if not i else rng.choice([0, 1, 5, 8, rng.choice([9, 30])])) for i in range(240)]
    cov = spark.createDataFrame(rows, "contig string, start long, end long, depth long").repartition(5)
    got = [r.chunk for r in sorted(I.fold_chunks(cov, target, alone, block).collect(), key=lambda r: r.start)]
    assert got == plain_fold([r[3] for r in rows], target, alone)


def test_resampled_diversity_is_that_of_the_drawn(spark):
    import hashlib
    import random

    rng = random.Random(5)
    people = [(f"S_{i}", "A" if i < 70 else "B" if i < 75 else "C") for i in range(76)]  # more of A than a word has bits
    rows = [("c", pos, s, *rng.choices([0, 1, 2, 11], [60, 30, 5, 5], k=2), 9) for pos in range(12) for s, _ in people if rng.random() < (0.8 if pos else 0.02)]
    popmap = spark.createDataFrame(people, "sample string, pop string")
    got = {(r.pop, r["round"]): r.pi for r in P.resample_pi(calls(spark, rows), popmap, rounds=7, n=4, seed=3).collect()}
    want = {}
    for pop in "ABC":
        for k in range(1, 8):
            own = sorted((s for s, p in people if p == pop), key=lambda s: (hashlib.md5(f"3|{k}|{s}".encode()).hexdigest(), s))[:4]
            copies = [[a for _, p, s, *ab, _ in rows if p == pos and s in own for a in ab] for pos in range(12)]
            each = [1 - sum(x.count(a) * (x.count(a) - 1) for a in set(x)) / (len(x) * (len(x) - 1)) for x in copies if x]
            if each:
                want[pop, k] = sum(each) / len(each)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    with pytest.raises(Exception, match="11 alleles or more"):
        P.resample_pi(calls(spark, rows), popmap, rounds=2, n=4, alleles=11).collect()


def test_site_aggregates_exchange_calls_once(spark):
    own = calls(spark, [("c", 1, "A_1", 0, 1, 5), ("c", 1, "A_2", None, None, 5), ("c", 1, "A_3", 12, 12, 5), ("d", 2, "A_1", 1, 1, 5)])
    sites = spark.createDataFrame([("c", 1, 50.0, ["T"] * 12)], "chrom string, pos long, qual double, alts array<string>")
    exchanges = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert exchanges(V.allele_stats(own)) == 1 and exchanges(P.site_pi(own)) == 1
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert exchanges(V.final_filter(sites, own, 3)) == 2  # of sites and of calls
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    got = {r.pos: (r.called, r.copies, [tuple(x) for x in r.counts]) for r in V.allele_stats(own).collect()}
    assert got == {1: (2, 4, [(0, 1), (1, 1), (12, 2)]), 2: (1, 2, [(1, 2)])}
    with pytest.raises(Exception, match="12 alleles or more"):
        V.allele_stats(own, alleles=12).collect()


def test_merged_intervals_of_all_shapes(spark):
    import random

    rng = random.Random(11)
    rows = []
    for _ in range(400):
        start = rng.randrange(6000)
        rows.append((rng.choice(["c", "d"]), start, start + rng.choice([1, 3, 20, 700, 2500]) if rng.random() < 0.2 else start + rng.randrange(1, 9)))
    want = set()
    for contig in "cd":
        for start, end in sorted(r[1:] for r in rows if r[0] == contig):
            last = max((w for w in want if w[0] == contig), default=None)
            if last and start <= last[2]:
                want.remove(last)
                want.add((contig, last[1], max(end, last[2])))
            else:
                want.add((contig, start, end))
    iv = spark.createDataFrame(rows, "contig string, start long, end long")
    for width in (1, 7, 1024):
        for long_contigs in (False, True):
            assert sorted(map(tuple, I.merge_intervals(iv, None, width, long_contigs).collect())) == sorted(want)
    by = iv.withColumn("sample", F.lit("s"))
    assert sorted(map(tuple, I.merge_intervals(by, ["sample"], long_contigs=True).drop("sample").collect())) == sorted(want)


def test_demultiplex_drops_ambiguous_prefixes(spark):
    reads = spark.createDataFrame([("AAAC", 1), ("AATC", 2), ("CCCC", 3), ("ATTG", 4)], "seq string, n long").withColumn("sample", F.lit(""))
    codes = spark.createDataFrame([("s", "AAA"), ("t", "ATT")], "sample string, barcode string")
    assert {(r.n, r.sample, r.seq) for r in R.demultiplex(reads, codes, 1).collect()} == {(1, "s", "C"), (4, "t", "G")}  # AAT is one base from both
    assert {r.n for r in R.demultiplex(reads, codes, 0).collect()} == {1, 4}


def test_demultiplex_takes_the_nearest_then_the_longest(spark):
    reads = spark.createDataFrame([("ACGTTC", 1), ("ACGTAC", 2), ("ACGGTC", 3), ("TTTTTT", 4), ("TT", 5), ("GGCCCC", 6)], "seq string, n long")
    codes = spark.createDataFrame([("short", "ACGT"), ("long", "ACGTT"), ("t", "TTTTAA"), ("g", "GGGG")], "sample string, barcode string")
    got = lambda d: {(r.n, r["sample"], r.seq) for r in R.demultiplex(reads, codes, d).collect()}
    assert got(0) == {(1, "long", "C"), (2, "short", "AC")}
    assert got(1) == {(1, "long", "C"), (2, "short", "AC"), (3, "long", "C")}
    assert got(2) == got(1) | {(4, "t", ""), (6, "g", "CC")}
    both = spark.createDataFrame([("s", "AC", "GG"), ("t", "AC", "TT")], "sample string, barcode string, barcode2 string")
    reads = spark.createDataFrame([("ACA", "GG", 1), ("ACA", "TG", 2), ("ACC", "TA", 3), ("GGG", "GG", 4)], "seq string, index string, n long")
    assert {(r.n, r["sample"], r.seq) for r in R.demultiplex(reads, both, 1).collect()} == {(1, "s", "A"), (3, "t", "C")}


def test_sites_of_several_alternates(spark):
    rows = [("c", 1, f"A_{i}", *g, 5) for i, g in enumerate([(1, 1), (1, 2), (2, 2), (1, 2)])] + [("c", 2, f"A_{i}", *g, 5) for i, g in enumerate([(0, 0), (1, 1), (2, 2), (1, 2)])] + [("c", 3, "A_0", None, None, 5)]
    c = calls(spark, rows)
    sites = spark.createDataFrame([("c", 1, "A", ["C", "G"], [0.5, 0.6], 50.0), ("c", 2, "A", ["C", "G", "T"], [0.1, 0.2, 0.3], 50.0), ("c", 3, "A", [], [], 50.0)], "chrom string, pos long, ref string, alts array<string>, af array<double>, qual double")
    at = lambda df: {r.pos for r in df.collect()}
    assert at(V.mac(c, 4)) == {1} and at(V.mac(c, 3)) == {1, 2} and at(V.maf(c, 0.5)) == {1}
    assert at(V.non_ref_af(c)) == {1, 2} and at(V.non_ref_af(c, sites=sites)) == {1}  # no copy of T
    assert {r.pos: round(r.pi, 4) for r in P.site_pi(c).collect()} == {1: 0.5714, 2: 0.75}
    assert at(V.final_filter(sites, c, 4)) == {1}
    pops = spark.createDataFrame([(f"A_{i}", "A") for i in range(4)], "sample string, pop string")
    assert [round(r.pi, 4) for r in P.resample_pi(c.where("pos = 2"), pops, rounds=2, n=4).collect()] == [0.75, 0.75]
    left, own = V.filter_alleles(sites, lambda a: a.isin("G", "T"), ("af",), c)
    assert {r.pos: (r.alts, r.af) for r in left.collect()} == {1: (["G"], [0.6]), 2: (["G", "T"], [0.2, 0.3])}
    assert sorted((r.pos, r["sample"], r.gt) for r in own.collect()) == [(1, "A_0", None), (1, "A_1", None), (1, "A_2", "1/1"), (1, "A_3", None), (2, "A_0", "0/0"), (2, "A_1", None), (2, "A_2", "1/1"), (2, "A_3", None)]


def test_heterozygotes_of_low_depth(spark):
    rows = [(0, 1, 2, 0), (0, 1, 2, 1), (1, 0, 2, 2), (0, 1, 3, 3), (0, 1, 3, 1), (0, 1, 4, 4), (1, 1, 4, 0), (0, 2, 1, 1)]
    c = calls(spark, [("c", i, "A_1", a, b, d) for i, (a, b, d, _) in enumerate(rows)]).join(spark.createDataFrame([(i, r[3]) for i, r in enumerate(rows)], "pos long, ro long"), "pos")
    r = P.error_count(c, 8, 1).first()
    assert (r.n1, r.n2, r.n3, r.n4, r.n5, r.called) == (0, 2, 1, 1, 0, 8)


def test_names_in_natural_order(spark, tmp_path):
    names = ["c_10", "c_9", "b", "c_1", "c", "a_2"]
    assert [r.contig for r in R.natural_order(spark.createDataFrame([(n,) for n in names], "contig string")).collect()] == ["a_2", "b", "c", "c_1", "c_9", "c_10"]
    (tmp_path / "popmap").write_text("A_1\tX\tACGT\n\nB_2\n C_3  Y \n")
    assert sorted(map(tuple, X.read_popmap(spark, str(tmp_path / "popmap")).collect())) == [("A_1", "X", "ACGT"), ("B_2", "B", None), ("C_3", "Y", None)]


def test_chain_masks_genotypes_and_counts_once(spark):
    site = lambda pos, **x: ({"ab": 0.5, "qual": 50.0, "dp": 10, "mqm": 40, "mqmr": 40, "saf": 200, "sar": 1, "srf": 200, "srr": 1, "paired": 1.0, "pairedr": 1.0} | x, pos)
    made = [site(1), site(2, ab=0.1), site(3, qual=0.5), site(4, mqm=5), site(5, sar=100), site(6, pairedr=0.1), site(7), site(8, dp=1)]
    names = list(made[0][0])
    sites = spark.createDataFrame([("c", pos, *[float(x[n]) for n in names]) for x, pos in made], "chrom string, pos long, " + ", ".join(f"{n} double" for n in names))
    own = spark.createDataFrame([("c", pos, s, "0/1", 0, 1, 40 if pos == 7 else 5, ro, ao) for _, pos in made for s, ro, ao in (("A_1", 3, 2), ("A_2", 0, 0))], CALLS + ", ro long, ao long")
    left, calls_left, report = V.filter_chain(sites, own, cutoff=20)
    assert [r.pos for r in left.collect()] == [1] and left.columns == sites.columns
    assert sorted((r["sample"], r.gt, r.dp) for r in calls_left.collect()) == [("A_1", "0/1", 5), ("A_2", None, 5)]
    assert [(r.step, r.sites) for r in report.orderBy("step").collect()] == [(0, 8), (1, 7), (2, 6), (3, 5), (4, 4), (5, 3), (6, 3), (7, 2), (8, 1)]
    for some, n in ((sites.withColumn("qual", F.lit(0.0)), [8, 7, *[0] * 7]), (sites.limit(0), [0] * 9)):  # a step that leaves nothing is told as well
        left, _, report = V.filter_chain(some, own, cutoff=20)
        assert left.count() == 0 and [r.sites for r in report.orderBy("step").collect()] == n


def test_reads(spark):
    df = spark.createDataFrame([("ACGTNn",), ("",), (None,)], "seq string")
    assert [r.s for r in df.select(R.revcomp(F.col("seq")).alias("s")).collect()] == ["NNACGT", "", None]
    twice = df.select(R.revcomp(R.revcomp(F.col("seq"))).alias("s")).first().s
    assert twice == "ACGTNN"
    pairs = spark.createDataFrame([("s", 1, "AC", "GT"), ("s", 2, "", "NNNN")], "sample string, ordinal long, fwd string, rev string")
    assert sorted(map(tuple, R.split_pairs(R.glue_pairs(pairs)).collect())) == sorted(map(tuple, pairs.collect()))


def test_error_rates(spark):
    c = calls(spark, [("c", i, "A_1", a, b, d) for i, (a, b, d) in enumerate([(0, 1, 1), (0, 0, 2), (0, 1, 2), (1, 1, 5), (0, 0, 9)])]).withColumn("ro", F.lit(1))
    r = P.error_count(c, 5, 1).first()
    assert (r.n1, r.n2, r.n3, r.n4, r.n5, r.called) == (1, 1, 0, 0, 1, 5)
    assert r.low_share == pytest.approx((0.5 + 0.25 + 1 / 32) / 5) and r.high_share == pytest.approx((0.75 + 0.5625 + 0.237) / 5)


def test_empty_tables(spark):
    c = calls(spark, [])
    assert V.mac(c, 1).count() == 0 and P.site_pi(c).count() == 0 and V.site_depth(c).count() == 0
    assert M.histogram(c, "dp", 1).count() == 0 and M.step_report(c, c, "x").first()[1:] == (0, 0, 0)


def test_trim_reads_against_plain_python(spark):
    import random

    rng = random.Random(5)
    rows = [("S_1", 1 + i % 2, i // 2, "".join(rng.choice("ACGT") for _ in range(n)), "".join(chr(33 + max(0, min(40, int(rng.gauss(rng.choice((8, 16, 30)), 8))))) for _ in range(n))) for i, n in enumerate([0, 1, 3, 5, 6, *[rng.randrange(5, 60) for _ in range(95)]])]

    def plain(seq, qual, least):
        s, w = [ord(c) - 33 for c in qual], min(5, len(qual))
        good = [i for i in range(len(s) - w + 1) if w and sum(s[i : i + w]) >= 15 * w]
        a, b = (good[0], good[-1] + w) if good else (0, 0)
        return (seq[a:b], qual[a:b]) if b > a and b - a >= least and 100 * sum(x < 15 for x in s[a:b]) <= 50 * (b - a) else None

    schema = "sample string, mate int, ordinal int, seq string, qual string"
    df = spark.createDataFrame([*rows, ("S_1", 1, 900, None, None), ("S_1", 2, 900, "A", None)], schema)
    want = {(m, o): plain(seq, qual, 4) for _, m, o, seq, qual in rows}
    want = {k: v for k, v in want.items() if v}
    assert {(r.mate, r.ordinal): (r.seq, r.qual) for r in R.trim_reads(df, min_len=4).collect()} == want and want
    both = {k: v for k, v in want.items() if (3 - k[0], k[1]) in want}
    assert {(r.mate, r.ordinal): (r.seq, r.qual) for r in R.trim_reads(df, min_len=4, paired=True).collect()} == both
    assert R.trim_reads(df.limit(0)).count() == 0


def test_merge_overlaps(spark):
    rc = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    whole = "ACGTTGCAAGGCTTACCGATAGGCTAACGTCATTGACC"
    rows = [(1, whole[:25], rc(whole[12:])), (2, whole[:25], rc("T" * 20)), (3, None, "ACGT"), (4, whole[:20] + "T" + whole[21:25], rc(whole[12:])), (5, "", "")]
    merged, rest = R.merge_overlaps(spark.createDataFrame(rows, "id int, fwd string, rev string"), 30)
    assert {r.id: r.seq for r in merged.collect()} == {1: whole, 4: whole[:20] + "T" + whole[21:]}
    assert {r.id for r in rest.collect()} == {2, 3, 5}


def test_best_overlaps_are_those_of_trying_all():
    import random

    rng, pairs = random.Random(4), [("", ""), ("A", "A"), ("ACGT" * 60, "ACGT" * 60)]
    for n in (3, 40, 64, 65, 130, 700):
        for letters in ("ACGT", "ACGTN\u00e9", "A"):
            whole = "".join(rng.choice(letters) for _ in range(n))
            a, b = whole[: rng.randrange(n + 1)], whole[rng.randrange(n) :]
            pairs += [(a, b), (a, "".join(rng.choice(letters) if rng.random() < 0.1 else c for c in b)), (b, a)]
    want = []
    for a, b in pairs:
        tries = [(n - 2 * sum(x != y for x, y in zip(a[-n:], b)), n) for n in range(3, min(len(a), len(b)) + 1)]
        score, n = max((t for t in tries if t[1] - t[0] <= 2 * 0.1 * t[1] and t[0] > 0), default=(0, 0))
        want.append(n)
    assert R.best_overlaps([a for a, _ in pairs], [b for _, b in pairs], 3, 0.1).tolist() == want
    assert R.best_overlaps([], [], 3, 0.1).tolist() == []


def test_decompose_walks_the_cigar(spark):
    sites = spark.createDataFrame([("c", 10, "ACGT", ["AGGT", "AGT", "TCGT"], ["1M1X2M", "1M1D2M", None], 5.0), ("c", 50, "A", ["GA", "AT", "A"], None, 1.0)], "chrom string, pos long, ref string, alts array<string>, cigars array<string>, qual double")
    of = calls(spark, [("c", 10, "s", 1, 3, 7), ("c", 10, "t", None, 2, 7), ("c", 50, "s", 0, 2, 1)])
    records, own = V.decompose(sites, of)
    assert {(r.pos, r.ref, r.alt, r.qual) for r in records.collect()} == {(11, "C", "G", 5.0), (10, "AC", "A", 5.0), (10, "A", "T", 5.0), (50, "A", "GA", 1.0), (50, "A", "AT", 1.0)}
    got = {(r.origin, r.ref, r.alt, r["sample"]): r.gt for r in own.collect()}
    assert got[10, "C", "G", "s"] == "1/0" and got[10, "A", "T", "s"] == "0/1" and got[10, "AC", "A", "t"] is None and got[50, "A", "AT", "s"] == "0/1"


def test_pileup_walks_the_cigar(spark):
    rows = [("s", "c", 100, 60, 0, "2S3M1I2M2D1M", "TTACGTCAG", "IIIIIIIII"), ("s", "c", 100, 4, 0, "3M", "ACG", "III"), ("s", "c", 100, 9, 4, "3M", "ACG", "III"), ("s", "c", 101, 9, 0, "2M", "CG", "I#")]
    aln = spark.createDataFrame(rows, "sample string, contig string, pos long, mapq int, flag int, cigar string, seq string, qual string")
    assert {(r.pos, r.base): r.n for r in M.pileup_counts(aln).collect()} == {(100, "A"): 1, (101, "C"): 2, (102, "G"): 1, (103, "C"): 1, (104, "A"): 1, (107, "G"): 1}


def test_readers_of_written_and_found_files(spark, tmp_path):
    import gzip

    with gzip.open(tmp_path / "P_1.R.fq.gz", "wt") as out:
        out.write("@a\nAC\n+\n@@\n@b\nGT\n+\nI+\n")
    assert [tuple(r) for r in X.read_fastq(spark, str(tmp_path)).orderBy("ordinal").collect()] == [("P_1", 2, 0, "a", "AC", "@@"), ("P_1", 2, 1, "b", "GT", "I+")]
    vcf = tmp_path / "x.vcf"
    vcf.write_text("##x\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tA_1\tA_2\nc\t5\t.\tA\tC,G\t.\tPASS\tDP=3;FLAG\tGT:DP\t1|2:3\t.\nc\t6\t.\tA\t.\t9\tlow\t.\tGT\t./.\t0/0\n")
    sites, own = X.read_vcf(spark, str(vcf))
    assert [(r.pos, r.alts, r.qual, r["filter"], r.info.get("DP")) for r in sites.orderBy("pos").collect()] == [(5, ["C", "G"], None, [], "3"), (6, [], 9.0, ["low"], None)]
    assert [(r.pos, r["sample"], r.gt, r.data.get("DP")) for r in own.orderBy("pos").collect()] == [(5, "A_1", "1/2", "3"), (6, "A_2", "0/0", None)]
    fasta = tmp_path / "x.fa"
    fasta.write_text(">c1 first\nAC\nGT\n>c2\n\n")
    assert {tuple(r) for r in X.read_fasta(spark, str(fasta)).collect()} == {("c1", "ACGT"), ("c2", "")}


def test_typed_vcf_is_what_was_written(spark, tmp_path):
    sites = spark.createDataFrame(
        [("c10", 7, "A", ["C", "G"], 3.5, ["q10", "s50"], 4, [0.25, None], True, ["x", "y"]), ("c2", 9, "T", [], None, [], None, [], None, None)],
        "chrom string, pos long, ref string, alts array<string>, qual double, filter array<string>, dp long, af array<double>, db boolean, tags array<string>",
    )
    calls = spark.createDataFrame(
        [("c10", 7, "S1", "0/1", 3, [2, 1]), ("c10", 7, "S1", "0/1", 3, [2, 1]), ("c10", 7, "S4", "1/2", None, [0, None]), ("c2", 9, "S2", "0/0", 1, None), ("c2", 9, None, "0/0", 1, None), ("c7", 1, "S3", "0/0", 1, None)],
        "chrom string, pos long, sample string, gt string, dp int, ad array<long>",
    )
    contigs = spark.createDataFrame([("c10", 90), ("c2", None)], "contig string, length long")
    path = str(tmp_path / "typed")
    X.write_vcf(sites, calls, path, ["dp", "af", "db", "tags"], ["gt", "dp", "ad"], {"af": "A", "ad": "R"}, contigs)
    lines = "".join(p.read_text() for p in sorted((tmp_path / "typed").glob("part-*"))).splitlines()
    assert lines == [
        "##fileformat=VCFv4.2",
        '##INFO=<ID=DP,Number=1,Type=Integer,Description="dp">', '##INFO=<ID=AF,Number=A,Type=Float,Description="af">',
        '##INFO=<ID=DB,Number=0,Type=Flag,Description="db">', '##INFO=<ID=TAGS,Number=.,Type=String,Description="tags">',
        '##FORMAT=<ID=GT,Number=1,Type=String,Description="gt">', '##FORMAT=<ID=DP,Number=1,Type=Integer,Description="dp">',
        '##FORMAT=<ID=AD,Number=R,Type=Integer,Description="ad">',
        "##contig=<ID=c2>", "##contig=<ID=c10,length=90>",
        "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1\tS2\tS3\tS4",
        "c2\t9\t.\tT\t.\t.\t.\t.\tGT:DP:AD\t./.\t0/0:1:.\t./.\t./.",
        "c10\t7\t.\tA\tC,G\t3.5\tq10;s50\tDP=4;AF=0.25,.;DB;TAGS=x,y\tGT:DP:AD\t0/1:3:2,1\t./.\t./.\t1/2:.:0,.",
    ]
    typed, own = X.read_typed_vcf(spark, path)
    types = dict(typed.dtypes)["info"], dict(own.dtypes)["data"]
    assert types == ("struct<AF:array<double>,DB:boolean,DP:bigint,TAGS:array<string>>", "struct<AD:array<bigint>,DP:bigint,GT:string>")
    assert [(r.pos, *r.info, r.other) for r in typed.orderBy("pos").collect()] == [(7, [0.25, None], True, 4, ["x", "y"], {}), (9, None, False, None, None, {})]
    assert [(r.pos, r["sample"], r.gt, *r.data) for r in own.orderBy("pos", "sample").collect()] == [(7, "S1", "0/1", [2, 1], 3, "0/1"), (7, "S4", "1/2", [0, None], None, "1/2"), (9, "S2", "0/0", None, 1, "0/0")]
    assert X.vcf_header(spark, path).count() == 7
    bare = tmp_path / "bare.vcf"
    bare.write_text("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\nc\t1\t.\tA\tC\t1\t.\tDP=2;H2\n")
    typed, own = X.read_typed_vcf(spark, str(bare))
    assert typed.first().other == {"DP": "2", "H2": None} and own.count() == 0


def test_overlaps_of_all_lengths_and_deep_places(spark):
    import random

    rng = random.Random(5)

    def own(n):
        lengths = lambda: rng.choice([0, 1, 40, 1024, 1025, 3000, 40_000]) if rng.random() < 0.4 else rng.randrange(1, 60)
        rows = [(rng.choice("cd"), start, start + lengths(), i) for i, start in enumerate(rng.randrange(300_000) for _ in range(n))]
        return [*rows, *[("c", 5000, 5040, n + i) for i in range(30)], ("c", 0, 2_000_000_000, n + 30), (None, 1, 5, n + 31), ("c", None, 5, n + 32)]

    a, b = own(200), own(150)
    want = sorted((x[3], y[3]) for x in a for y in b if None not in x + y and x[0] == y[0] and x[1] < y[2] and y[1] < x[2])
    left, right = spark.createDataFrame(a, "contig string, start long, end long, a long"), spark.createDataFrame(b, "contig string, start long, end long, b long")
    for width, deep in ((1, 50_000), (1024, 3), (1024, 50_000)):
        assert sorted(map(tuple, I.overlap_join(left, right, width, deep).select("a", "b").collect())) == want
    assert I.overlap_join(left, right.limit(0)).count() == I.overlap_join(left.limit(0), right).count() == 0


def test_a_long_interval_has_a_few_cells_and_a_deep_cell_is_dealt(spark):
    iv = spark.createDataFrame([("c", 0, 2_000_000_000), ("c", 3, 9)], "contig string, start long, end long")
    cells = I._celled(iv, iv, lambda own, x: x < own, 1024)
    assert cells.where("end > 9").count() <= 2 * 2 and cells.where("end = 9").count() == 2  # at its own level and the other's
    same = spark.range(4000).selectExpr("'c' AS contig", "id % 50 AS start", "id % 50 + 10 AS end")
    cells = I._celled(same, same, lambda own, x: x < own, 1024)
    deals = I._deep(cells, 500, "parts").collect()
    assert [r.parts for r in deals] == [8]
    dealt = cells.groupBy(F.pmod(F.xxhash64("start", "end", F.spark_partition_id()), F.lit(8))).count().collect()
    assert len(dealt) == 8 and max(r[1] for r in dealt) < 1000


def test_merged_coverage_counts_as_the_join_does_and_points_only_inside(spark):
    rng = random.Random(5)
    rows = [(rng.choice("ab"), s, s + rng.choice([0, 0, 1, 3, 900])) for s in (rng.randrange(6000) for _ in range(400))] + [("c", 5, 5), ("c", 5, 9), ("c", 9, 9), ("c", 7, 7), ("d", 1, 1)]
    iv = spark.createDataFrame(rows, "contig string, start long, end long")
    got = sorted(map(tuple, I.merged_coverage(iv, 64).collect()))
    assert got == sorted(map(tuple, I.interval_coverage(I.merge_intervals(iv), iv).collect())) and ("c", 5, 9, 2) in got and ("d", 1, 1, 0) in got
    solid = iv.where("start < end")
    want = sorted(map(tuple, I.interval_coverage(I.merge_intervals(solid, long_contigs=True), solid).collect()))
    assert sorted(map(tuple, I.merged_coverage(solid).collect())) == want


def test_interval_passes_have_more_parts_for_more_rows(spark, monkeypatch):
    monkeypatch.setattr(I, "PART_ROWS", 50)
    iv = spark.range(1000).selectExpr("concat('c', id % 90) AS contig", "id * 3 AS start", "id * 3 + 2 AS end", "concat('s', id % 3) AS sample")
    merged = I.merge_intervals(iv)
    assert merged.rdd.getNumPartitions() == 21 and merged.count() == 1000
    cov = I.merged_coverage(iv)
    assert cov.rdd.getNumPartitions() == 21 and cov.agg({"depth": "sum"}).first()[0] == 1000


def test_files_that_an_overlap_join_shuffles_have_few_rows(spark, monkeypatch):
    monkeypatch.setattr(I, "FILE_ROWS", 50)
    iv = spark.range(0, 1000, 1, 1).selectExpr("'c' AS contig", "id * 3 AS start", "id * 3 + 2 AS end")
    pairs = I.overlap_join(iv, iv)
    assert max(spark.read.parquet(f).count() for f in pairs.inputFiles()) == 50
    assert pairs.count() == 1000


def test_written_intervals_have_more_parts_for_more_rows(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(X, "PART_ROWS", 50, raising=False)
    iv = spark.range(1000).selectExpr("concat('c', id % 9) AS contig", "id * 3 AS start", "id * 3 + 2 AS end")
    X.write_bed(iv, str(tmp_path / "bed"))
    parts = [f.read_text().splitlines() for f in sorted((tmp_path / "bed").glob("part-*"))]
    assert max(map(len, parts)) <= 100 and len(parts) >= 20
    assert [tuple(x.split("\t")) for p in parts for x in p] == [("c" + str(c), str(i * 3), str(i * 3 + 2)) for c in range(9) for i in range(c, 1000, 9)]
    assert X.read_bed(spark, str(tmp_path / "bed")).count() == 1000


def test_samples_are_put_beside_intervals_without_shuffling_their_product(spark):
    iv = spark.createDataFrame([("a", 0, 10), ("a", 20, 30), (None, 0, 5)], "contig string, start long, end long")
    aln = spark.createDataFrame([("s", "a", 1, 4), ("s", "a", 2, 4), ("t", "a", 25, 26), (None, "a", 3, 4)], "sample string, contig string, start long, end long")
    found = I.coverage_by_interval(iv, aln)
    depth = {("a", "s", 0): 2, ("a", "t", 20): 1}
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(str((c, s, e, p, depth.get((c, p, s), 0))) for c, s, e in [("a", 0, 10), ("a", 20, 30), (None, 0, 5)] for p in ("s", "t", None))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("inline") < plan.index("RepartitionByExpression")  # rows of 0 are made after the last shuffle


def test_pileup_shuffles_pieces_of_reads_and_cuts_them_at_bins(spark):
    rows = [("s", "c", 1020, 9, 0, "2S6M1I3M", "TTACGTACGTAC", "IIIIII!IIIII"), ("s", "c", 1022, 9, 0, "4M", "GTAC", "*"), ("t", "c", 1, 9, 0, "3M", "AC", "III")]
    aln = spark.createDataFrame(rows, "sample string, contig string, pos long, mapq long, flag long, cigar string, seq string, qual string")
    found = M.pileup_counts(aln)
    got = {(r.pos, r.sample, r.base): r.n for r in found.collect()}
    assert got == {(1020, "s", "A"): 1, (1021, "s", "C"): 1, (1022, "s", "G"): 2, (1023, "s", "T"): 2, (1024, "s", "A"): 1, (1025, "s", "C"): 2, (1026, "s", "T"): 1, (1027, "s", "A"): 1, (1028, "s", "C"): 1, (1, "t", "A"): 1, (2, "t", "C"): 1}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("explode(sequence(0") < plan.index("RepartitionByExpression")


def _plain_overlap(a, b, least, frac):
    found = [(n - 2 * wrong, n) for n in range(max(least, 1), min(len(a), len(b)) + 1) if (wrong := sum(x != y for x, y in zip(a[len(a) - n :], b))) <= frac * n and n > 2 * wrong]
    return max(found, default=(0, 0))[1]


@pytest.mark.parametrize("letters", ["A", "ACGT", "ACGTN", "abcdefghijklmnopqrstuvwxyz"])
def test_best_overlaps_are_those_of_trying_each(letters):
    rng = random.Random(len(letters))
    text = lambda n: "".join(rng.choice(letters) for _ in range(n))
    fwd = [text(rng.randint(0, 90)) for _ in range(120)]
    other = ["".join(c if rng.random() > 0.07 else rng.choice(letters) for c in x[rng.randint(0, len(x)) :]) + text(rng.randint(0, 40)) for x in fwd]
    for least, frac, most in ((10, 0.1, 1 << 18), (0, 0.3, 40), (1, 0.0, 1)):
        assert R.best_overlaps(fwd, other, least, frac, most).tolist() == [_plain_overlap(a, b, least, frac) for a, b in zip(fwd, other)]
    assert R.best_overlaps([], [], 10, 0.1).tolist() == []


def test_overlaps_are_looked_for_once(spark):
    """One Python step, and mates that cost something are made once, not for each use."""
    pairs = spark.createDataFrame([(1, "ACGTACGTACGTAA", "TTACGTACGT")], "id int, fwd string, rev string").withColumn("fwd", F.regexp_replace("fwd", "N", ""))
    for found in R.merge_overlaps(pairs, 10):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1 == plan.count("regexp_replace")
