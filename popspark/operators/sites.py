"""Variant sites and genotype calls: filters.

sites has one row for each (chrom, pos) with qual, alts, filter and INFO columns; calls has one row for each site and
sample with a genotype (gt null: masked).  A sample without a row at a site is missing there, so shares are taken over
the number of samples, never over rows.  Ratios are written as products: nothing divides by zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.ranking import nearest_rank
from ..sources.shared import written

SITE = ["chrom", "pos"]
#: Allele numbers that a site's counts have room for.
ALLELES = 16


def with_number(df: DataFrame, n: int | DataFrame, name: str) -> DataFrame:
    """df with a column of the number n: given as such, or as a table of one row and column, so that it is counted in the same job."""
    return df.withColumn(name, F.lit(n).cast("long")) if isinstance(n, int) else df.join(F.broadcast(n.toDF(name)))


def depth_stats(calls: DataFrame) -> DataFrame:
    """chrom, pos, called (genotypes), dp_sum and dp_n (depths): one grouped sum."""
    return calls.groupBy(*SITE).agg(F.count("gt").alias("called"), F.sum("dp").alias("dp_sum"), F.count("dp").alias("dp_n"))


def allele_sums(calls: DataFrame, alleles: int = ALLELES) -> DataFrame:
    """chrom, pos, called, copies (called copies of all alleles) and _0, _1, ..., the copies of each allele: one grouped sum.

    There is a column for allele numbers below `alleles`; from there on an error is raised: give a larger one.
    """
    known = F.when(F.greatest("a1", "a2") >= alleles, F.raise_error(F.lit(f"{alleles} alleles or more")).cast("string")).otherwise(F.col("gt"))
    own = calls.select(*SITE, known.alias("gt"), "a1", "a2")
    there = F.col("gt").isNotNull()
    n = [F.count_if(there & (F.col("a1") == k)) + F.count_if(there & (F.col("a2") == k)) for k in range(alleles)]
    copies = F.count_if(there & F.col("a1").isNotNull()) + F.count_if(there & F.col("a2").isNotNull())
    return own.groupBy(*SITE).agg(F.count("gt").alias("called"), copies.alias("copies"), *[x.alias(f"_{k}") for k, x in enumerate(n)])


def allele_stats(calls: DataFrame, alleles: int = ALLELES) -> DataFrame:
    """chrom, pos, called, copies (called copies of all alleles) and counts, an array of (allele, n) by allele.

    Counts have room for allele numbers below `alleles`; from there on an error is raised: give a larger one.
    """
    every = F.array(*[F.struct(F.lit(k).cast("long").alias("allele"), F.col(f"_{k}").alias("n")) for k in range(alleles)])
    return allele_sums(calls, alleles).select(*SITE, "called", "copies", F.filter(every, lambda x: x["n"] > 0).alias("counts"))


def _keep(calls: DataFrame, stats: DataFrame, condition: Column) -> DataFrame:
    return calls.join(stats.where(condition).select(*SITE), SITE, "left_semi")


def max_missing(calls: DataFrame, share: float, n_samples: int | DataFrame) -> DataFrame:
    """Sites called in at least `share` of the samples."""
    return _keep(calls, with_number(depth_stats(calls), n_samples, "_samples"), F.col("called") >= share * F.col("_samples"))


def _minor() -> Column:
    """Copies of the second commonest allele; 0 if there is only one."""
    return F.sort_array(F.array(*[F.col(f"_{k}") for k in range(ALLELES)]), asc=False)[1]


def _every_alternate(lo: float, hi: float, alternates: Column | None = None) -> Column:
    """Whether each alternate (of those called, or 1 to `alternates`) has a share of the called copies from lo to hi; false without any."""
    copies, room = F.col("copies"), F.array(*[F.col(f"_{k}") for k in range(1, ALLELES)])
    fits = lambda n: n.between(lo * copies, hi * copies)
    if alternates is None:
        return (copies > 0) & (F.col("_0") < copies) & F.forall(room, lambda n: (n == 0) | fits(n))
    return (copies > 0) & (alternates > 0) & ((alternates < ALLELES) | F.lit(lo <= 0)) & F.forall(F.slice(room, F.lit(1), F.greatest(alternates, F.lit(0))), fits)


def mac(calls: DataFrame, n: int) -> DataFrame:
    """Sites whose second commonest allele has at least n copies."""
    return _keep(calls, allele_sums(calls), _minor() >= n)


def maf(calls: DataFrame, share: float) -> DataFrame:
    """Sites whose second commonest allele has at least this share of the called copies."""
    return _keep(calls, allele_sums(calls), (F.col("copies") > 0) & (_minor() >= share * F.col("copies")))


def non_ref_af(calls: DataFrame, lo: float = 0.001, hi: float = 0.9999, sites: DataFrame | None = None) -> DataFrame:
    """Sites of which every alternate has a share of called copies from lo to hi: those that sites lists (alts), or without it those called."""
    stats = allele_sums(calls)
    if sites is None:
        return _keep(calls, stats, _every_alternate(lo, hi))
    return _keep(calls, stats.join(sites.select(*SITE, F.size("alts").alias("_alts")), SITE), _every_alternate(lo, hi, F.col("_alts")))


def min_qual(sites: DataFrame, q: float) -> DataFrame:
    return sites.where(F.col("qual") >= q)


def min_depth(calls: DataFrame, n: int) -> DataFrame:
    """Genotypes with a depth under n become missing; depths stay."""
    deep = F.col("dp") >= n
    return calls.withColumns({c: F.when(deep, F.col(c)) for c in ("gt", "a1", "a2")})


def mean_depth(calls: DataFrame, lo: float, hi: float) -> DataFrame:
    """Sites whose mean depth over genotypes with a depth is from lo to hi."""
    return _keep(calls, depth_stats(calls), (F.col("dp_n") > 0) & (F.col("dp_sum") >= lo * F.col("dp_n")) & (F.col("dp_sum") <= hi * F.col("dp_n")))


def _is_snp() -> Column:
    return F.forall("alts", lambda a: F.length(a) == F.length("ref"))


def remove_indels(sites: DataFrame) -> DataFrame:
    return sites.where(_is_snp())


def select_type(sites: DataFrame, kind: str) -> DataFrame:
    return sites.where(_is_snp() if kind == "snp" else ~_is_snp())


def max_alleles(sites: DataFrame, n: int) -> DataFrame:
    return sites.where(F.size("alts") + 1 <= n)


def keep_positions(df: DataFrame, positions: DataFrame) -> DataFrame:
    return df.join(positions.select(*SITE), SITE, "left_semi")


def exclude_positions(df: DataFrame, positions: DataFrame) -> DataFrame:
    return df.join(positions.select(*SITE), SITE, "left_anti")


def filter_sites(sites: DataFrame, expr: str) -> DataFrame:
    """Sites for which the SQL predicate on their columns holds."""
    return sites.where(F.expr(expr))


def filter_alleles(sites: DataFrame, condition, per_allele: tuple[str, ...] = (), calls: DataFrame | None = None) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Keep the alternates for which condition(alt) holds, and the sites that have any left.

    Arrays named in per_allele have a value for each alternate and lose those of the others.  With calls, (sites, calls):
    alleles are numbered anew, and a genotype with an alternate that went is missing.
    """
    kept = F.filter(F.sequence(F.lit(0), F.size("alts") - 1), lambda i: condition(F.element_at("alts", i + 1)))
    own = sites.where(F.size("alts") > 0).withColumn("_kept", kept).where(F.size("_kept") > 0)
    left = own.withColumns({c: F.expr(f"transform(_kept, i -> {c}[i])") for c in ("alts", *per_allele)}).drop("_kept")
    if calls is None:
        return left
    new = lambda a: F.when(F.col(a) == 0, 0).otherwise(F.expr(f"nullif(array_position(_kept, CAST({a} - 1 AS INT)), 0)"))
    told = calls.join(own.select(*SITE, "_kept"), SITE).withColumns({a: new(a).cast("long") for a in ("a1", "a2")}).drop("_kept")
    whole = F.col("gt").isNotNull() & F.col("a1").isNotNull() & F.col("a2").isNotNull()
    told = told.withColumn("gt", F.when(whole, F.concat_ws("/", "a1", "a2"))).withColumns({a: F.when(F.col("gt").isNotNull(), F.col(a)) for a in ("a1", "a2")})
    return left, told.select(*calls.columns)


def filter_genotypes(calls: DataFrame, expr: str) -> DataFrame:
    """Genotypes for which the SQL predicate fails become missing."""
    good = F.expr(expr)
    return calls.withColumns({c: F.when(good, F.col(c)) for c in ("gt", "a1", "a2")})


def tag_sites(sites: DataFrame, expr: str | Column, pass_tag: str | None = None, fail_tag: str | None = None, append: bool = True) -> DataFrame:
    """Put a tag into filter, by whether the predicate holds; append: tags that are there stay."""
    old = F.col("filter") if append else F.array().cast("array<string>")
    add = lambda tag: F.array_union(old, F.array(F.lit(tag))) if tag else old
    return sites.withColumn("filter", F.when(F.expr(expr) if isinstance(expr, str) else expr, add(pass_tag)).otherwise(add(fail_tag)))


def keep_tagged(sites: DataFrame, tag: str) -> DataFrame:
    return sites.where(F.array_contains("filter", tag))


def remove_tagged(sites: DataFrame, tag: str) -> DataFrame:
    return sites.where(~F.array_contains("filter", tag))


def balanced(lo: float = 0.2, hi: float = 0.8, fixed_lo: float = 0.01, fixed_hi: float = 0.99) -> Column:
    ab = F.col("ab")
    return ((ab > lo) & (ab < hi)) | (ab < fixed_lo) | (ab > fixed_hi)


def deep_enough_quality(ratio: float = 0.1) -> Column:
    return F.col("qual") > ratio * F.col("dp")


def like_mapped(lo: float = 0.25, hi: float = 1.75) -> Column:
    return (F.col("mqm") > lo * F.col("mqmr")) & (F.col("mqm") < hi * F.col("mqmr"))


def one_stranded(r1: float = 100, r2: float = 100, r3: float = 100, r4: float = 50) -> Column:
    return F.expr(f"(saf > {r1} * sar AND srf > {r2} * srr) OR (sar > {r3} * saf AND srr > {r4} * srf)")


def like_paired(least: float = 0.05, lo: float = 0.25, hi: float = 1.75) -> Column:
    return F.expr(f"(paired > {least} AND pairedr > {least} AND pairedr > {lo} * paired AND pairedr < {hi} * paired) OR (paired < {least} AND pairedr < {least})")


def both_paired_or_neither(least: float = 0.005) -> Column:
    return F.expr(f"(paired < {least}) = (pairedr < {least})")


def filter_allele_balance(sites: DataFrame, *limits: float) -> DataFrame:
    return sites.where(balanced(*limits))


def filter_qual_depth(sites: DataFrame, ratio: float = 0.1) -> DataFrame:
    return sites.where(deep_enough_quality(ratio))


def filter_mapq_ratio(sites: DataFrame, lo: float = 0.25, hi: float = 1.75) -> DataFrame:
    return sites.where(like_mapped(lo, hi))


def filter_strand(sites: DataFrame, *ratios: float) -> DataFrame:
    """Sites whose alternates and references come from the same strand: forward by r1 and r2 to 1, or reverse by r3 and r4."""
    return sites.where(one_stranded(*ratios))


def filter_pairing(sites: DataFrame, *limits: float) -> DataFrame:
    return sites.where(like_paired(*limits))


def filter_pairing_mixed(sites: DataFrame, least: float = 0.005) -> DataFrame:
    """Drop sites of which exactly one of the two shares is under least: tagged NP, then removed."""
    return remove_tagged(tag_sites(sites, both_paired_or_neither(least), fail_tag="NP"), "NP")


def hard_filter(sites: DataFrame, rules: dict[str, str]) -> DataFrame:
    """filter lists the names of the rules (SQL predicates) that hold; PASS if none does."""
    hit = F.array_compact(F.array(*[F.when(F.expr(e), F.lit(n)) for n, e in rules.items()]))
    return sites.withColumn("filter", F.when(F.size(hit) > 0, hit).otherwise(F.array(F.lit("PASS"))))


def low_quality_high_depth(sites: DataFrame, mode: str = "sd") -> DataFrame:
    """Sites deeper than a limit with a quality under twice (mode sqrt: just) their depth.

    The limit is the truncated mean plus the truncated deviation (sd), or the truncated mean + 3 * sqrt(mean) (sqrt3), or
    the mean (mean: quality under the depth itself).
    """
    stats = sites.agg(F.avg("dp").alias("m"), F.stddev_pop("dp").alias("sd"))
    limit = {"sd": F.floor("m") + F.floor("sd"), "sqrt3": F.floor(F.col("m") + 3 * F.sqrt("m")), "mean": F.floor("m")}[mode]
    return sites.join(F.broadcast(stats.select(limit.alias("limit")))).where((F.col("dp") > F.col("limit")) & (F.col("qual") < (1 if mode == "mean" else 2) * F.col("dp"))).drop("limit")


def depth_cutoffs(calls: DataFrame, n_ind: int | DataFrame) -> DataFrame:
    """Two cutoffs of mean depth: mean + 1.645 deviations of site depth over individuals, and the depth of the deepest 5 %."""
    depth = site_depth(calls)
    high = depth.agg((F.avg("dp") + 1.645 * F.stddev_pop("dp")).alias("high")).join(F.broadcast(nearest_rank(depth, "dp", 0.05, last=True)))
    return with_number(high, n_ind, "_n").select(F.floor(F.col("high") / F.col("_n")).alias("by_sd"), F.floor(F.col("value") / F.col("_n")).alias("by_rank"))


def filter_max_mean_depth(calls: DataFrame, cutoff: float) -> DataFrame:
    return mean_depth(calls, 0, cutoff)


def depth_mismatch(depth: DataFrame, share: float = 0.6) -> DataFrame:
    """Sites with less than share of their contig's mean site depth; contigs' means are joined, so no contig is held whole."""
    means = depth.groupBy("chrom").agg(F.sum("dp").alias("s"), F.count("*").alias("n"))
    return depth.join(means, "chrom").where(F.col("dp") * F.col("n") < share * F.col("s")).select(*depth.columns)


def final_filter(sites: DataFrame, calls: DataFrame, n_samples: int | DataFrame) -> DataFrame:
    """Sites with a call rate of 0.9, every alternate's share from 0.001 to 0.9999, a minor allele and a quality of 30: one pass over calls."""
    good = min_qual(sites, 30).withColumn("_alts", F.size("alts")).join(with_number(allele_sums(calls), n_samples, "_samples"), SITE)
    return good.where((F.col("called") >= 0.9 * F.col("_samples")) & _every_alternate(0.001, 0.9999, F.col("_alts")) & (_minor() >= 1)).select(*sites.columns)


def first_filter(sites: DataFrame, calls: DataFrame, n_samples: int | DataFrame, share: float = 0.5, copies: int = 3, quality: float = 30) -> DataFrame:
    """Sites with a call rate of share, so many copies of a minor allele and a quality: max_missing, mac and min_qual in one pass over calls."""
    stats = with_number(allele_sums(calls), n_samples, "_samples").where((F.col("called") >= share * F.col("_samples")) & (_minor() >= copies))
    return min_qual(sites, quality).join(stats.select(*SITE), SITE, "left_semi")


def filter_chain(sites: DataFrame, calls: DataFrame, overlap: bool = False, mixed: bool = False, cutoff: float | None = None, genotypes: str = "ro > 0 OR ao > 0") -> tuple[DataFrame, DataFrame, DataFrame]:
    """The whole filter chain: (sites left, calls left, report of step, filter and sites: a row for every step, be it 0 sites).

    Steps: allele balance, quality by depth, mapping-quality ratio, strand (unless reads overlap), pairing, low quality at
    high depth (limits from the unfiltered sites), mean depth, depth within contigs.  Genotypes that fail the predicate are
    missing from the first step on; they keep their depth.  Each site is marked once with the step that drops it (and
    written so), and the report is one count over these marks.
    """
    steps = [("allele balance", balanced()), ("quality by depth", deep_enough_quality()), ("mapping quality", like_mapped())]
    steps += [] if overlap else [("strand", one_stranded())]
    steps += [("pairing", both_paired_or_neither() if mixed else like_paired())]
    steps += [("low quality at high depth", ~((F.col("dp") > F.col("_limit")) & (F.col("qual") < 2 * F.col("dp"))))]
    steps += [("mean depth", (F.col("dp_n") > 0) & (F.lit(True) if cutoff is None else F.col("dp_sum") <= cutoff * F.col("dp_n")))]
    limit = sites.agg((F.floor(F.avg("dp")) + F.floor(F.stddev_pop("dp"))).alias("_limit"))
    with_depth = sites.join(F.broadcast(limit)).join(depth_stats(calls).select(*SITE, "dp_sum", "dp_n"), SITE, "left")
    failed = F.coalesce(*[F.when(~F.coalesce(good, F.lit(False)), n) for n, (_, good) in enumerate(steps, 1)])
    marked = written(with_depth.select(*sites.columns, failed.alias("_out")))
    means = marked.where("_out IS NULL").groupBy("chrom").agg(F.sum("dp").alias("_s"), F.count("*").alias("_n"))
    shallow = F.when(F.col("dp") * F.col("_n") < 0.6 * F.col("_s"), len(steps) + 1)
    marked = marked.join(means, "chrom", "left").withColumn("_out", F.coalesce("_out", shallow))
    left = marked.where("_out IS NULL").select(*sites.columns)
    names = ["all", *[n for n, _ in steps], "depth within contig"]
    alive = [F.count_if(F.col("_out").isNull() | (F.col("_out") > n)) for n in range(len(names))]
    counts = marked.agg(F.array(*[F.struct(F.lit(n).cast("long").alias("step"), F.lit(name).alias("filter"), c.alias("sites")) for n, (name, c) in enumerate(zip(names, alive))]).alias("x"))
    report = counts.select(F.explode("x").alias("x")).select("x.*")
    return left, keep_positions(filter_genotypes(calls, genotypes), left), report


def site_depth(calls: DataFrame) -> DataFrame:
    return calls.groupBy(*SITE).agg(F.sum("dp").alias("dp"))


def site_quality(sites: DataFrame) -> DataFrame:
    return sites.select(*SITE, "qual")


def allele_counts(calls: DataFrame) -> DataFrame:
    """chrom, pos, allele, n over called copies."""
    copies = calls.where(F.col("gt").isNotNull()).select(*SITE, F.explode(F.array("a1", "a2")).alias("allele"))
    return copies.groupBy(*SITE, "allele").agg(F.count("*").alias("n"))


def filter_multi_maf(sites: DataFrame, x: float) -> DataFrame:
    """Sites whose alternates' shares (array af) sum to more than x and less than 1 - x."""
    total = F.aggregate("af", F.lit(0.0), lambda a, b: a + b)
    return sites.where((total > x) & (total < 1 - x))


def snp_clusters(sites: DataFrame, n: int = 3, window: int = 25) -> DataFrame:
    """Sites in a run of at least n within window bases: as its last, first or a middle one."""
    w = W.partitionBy("chrom").orderBy("pos")
    member = F.lit(False)
    for back in range(n):
        first = F.lag("pos", back).over(w) if back else F.col("pos")
        last = F.lead("pos", n - 1 - back).over(w) if n - 1 - back else F.col("pos")
        member = member | F.coalesce(last - first <= window, F.lit(False))
    return sites.withColumn("_in", member).where("_in").drop("_in")


def het_counts(calls: DataFrame) -> DataFrame:
    return calls.groupBy(*SITE).agg(F.count_if(F.col("gt").isNotNull() & (F.col("a1") != F.col("a2"))).alias("hets"), F.sum("dp").alias("dp"))


def paralog_sites(calls: DataFrame, clusters: DataFrame, q: float = 0.9) -> DataFrame:
    """Clustered sites with more heterozygotes than the value at rank int(q * (n - 1)) of their rising counts."""
    hets = keep_positions(het_counts(calls), clusters)
    limit = nearest_rank(hets, "hets", q, last=True, ascending=True)
    return hets.join(F.broadcast(limit)).where("hets > value").select(*SITE, "hets")


def hets_vs_depth(calls: DataFrame) -> DataFrame:
    return het_counts(calls)


def fit_line(df: DataFrame, y: str = "hets", x: str = "dp") -> DataFrame:
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def one_random_site(sites: DataFrame, seed: int = 1) -> DataFrame:
    """One site of each contig, by a seeded hash."""
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), "chrom", F.col("pos").cast("string")))
    return sites.withColumn("_n", F.row_number().over(W.partitionBy("chrom").orderBy(order, "pos"))).where("_n = 1").drop("_n")


def best_site(sites: DataFrame) -> DataFrame:
    """The site of best quality of each contig, the first of them."""
    return sites.withColumn("_n", F.row_number().over(W.partitionBy("chrom").orderBy(F.desc("qual"), "pos"))).where("_n = 1").drop("_n")


def count_loci(sites: DataFrame) -> DataFrame:
    return sites.agg(F.count_distinct("chrom").alias("loci"))


def closest_variant(sites: DataFrame) -> DataFrame:
    """chrom, pos and the distance to the nearest other site of the contig (null if it has none)."""
    w = W.partitionBy("chrom").orderBy("pos")
    return sites.select(*SITE, F.least(F.col("pos") - F.lag("pos").over(w), F.lead("pos").over(w) - F.col("pos")).alias("distance"))


def split_outliers(sites: DataFrame, scores: DataFrame, q: float) -> tuple[DataFrame, DataFrame]:
    """(outliers, neutral): sites joined to scores(ordinal, q) by ordinal; a score up to q is an outlier."""
    scored = sites.join(scores.select("ordinal", F.col("q").alias("_q")), "ordinal")
    return scored.where(F.col("_q") <= q).drop("_q"), scored.where(F.col("_q") > q).drop("_q")


def split_outliers_p(sites: DataFrame, scores: DataFrame, q: float) -> tuple[DataFrame, DataFrame]:
    """The second form: a probability of at least 1 - q / 2 is an outlier."""
    scored = sites.join(scores.select("ordinal", F.col("q").alias("_q")), "ordinal")
    return scored.where(F.col("_q") >= 1 - q / 2).drop("_q"), scored.where(F.col("_q") < 1 - q / 2).drop("_q")


def remove_loci(sites: DataFrame, loci: DataFrame) -> DataFrame:
    return sites.join(loci.select(F.col("locus").alias("chrom")), "chrom", "left_anti")


def bad_haplotype_loci(hap_stats: DataFrame) -> DataFrame:
    return hap_stats.where((F.col("status") == "FILTERED") & ~F.col("comment").contains("Complex")).select("locus").distinct()


def contigs_of_sites(contigs: DataFrame, positions: DataFrame) -> DataFrame:
    return contigs.join(positions.select(F.col("chrom").alias("contig")).distinct(), "contig", "left_semi")


def low_maf_loci(freqs: DataFrame, loci: DataFrame, x: float = 0.95) -> DataFrame:
    """Running numbers of the loci whose major allele has a share above x: freqs(locus, af), loci(locus, locus_no)."""
    return freqs.where(F.greatest("af", 1 - F.col("af")) > x).select("locus").distinct().join(loci, "locus").select("locus", "locus_no")


def keep_scored(sites: DataFrame, key: str, tag_pattern: str) -> DataFrame:
    """Sites whose info map has the key and whose filter has no tag that fits the pattern."""
    return sites.where(F.map_contains_key("info", key) & ~F.exists("filter", lambda t: t.rlike(tag_pattern)))


def decompose(sites: DataFrame, calls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Variants as single-base substitutions and indels, one alternate each: sites with alt and origin, and calls over them.

    A column cigars (one for each alternate; M, =, X, I, D) says how an alternate lies on ref.  Without one, the bases of
    equal lengths face each other, and else the gap comes first if the shorter text ends the longer, last if not.  Indels
    carry the base before them (the one after, at the start).  Alleles of a record that come from several alternates count
    together; a1, a2 and gt are renumbered, other columns stay.  A site whose alternates equal ref gives no record.
    """
    has = "get(cigars, _k)" if "cigars" in sites.columns else "CAST(NULL AS STRING)"
    one = sites.select("*", F.posexplode("alts").alias("_k", "_alt")).withColumn("_gap", F.expr("length(_alt) - length(ref)")).withColumn("_m", F.expr("least(length(_alt), length(ref))"))
    gap = "concat(abs(_gap), if(_gap > 0, 'I', 'D'))"
    default = f"CASE WHEN _gap = 0 THEN concat(_m, 'M') WHEN endswith(if(_gap > 0, _alt, ref), if(_gap > 0, ref, _alt)) THEN concat({gap}, _m, 'M') ELSE concat(_m, 'M', {gap}) END"
    one = one.withColumn("_cigar", F.expr(f"coalesce({has}, {default})"))
    one = one.withColumn("_steps", F.expr("transform(arrays_zip(regexp_extract_all(_cigar, '([0-9]+)[MID=X]', 1), regexp_extract_all(_cigar, '[0-9]+([MID=X])', 1)), x -> struct(CAST(x['0'] AS INT) AS n, x['1'] AS op))"))
    edits = """aggregate(_steps, struct(0 AS r, 0 AS a, CAST(array() AS ARRAY<STRUCT<at: INT, ref: STRING, alt: STRING>>) AS out), (s, x) -> struct(
      s.r + if(x.op = 'I', 0, x.n) AS r, s.a + if(x.op = 'D', 0, x.n) AS a,
      concat(s.out, CASE WHEN x.n = 0 THEN CAST(array() AS ARRAY<STRUCT<at: INT, ref: STRING, alt: STRING>>)
        WHEN x.op = 'I' AND s.r = 0 THEN array(struct(0 AS at, substring(ref, 1, 1) AS ref, concat(substring(_alt, 1, x.n), substring(ref, 1, 1)) AS alt))
        WHEN x.op = 'I' THEN array(struct(s.r - 1 AS at, substring(ref, s.r, 1) AS ref, concat(substring(ref, s.r, 1), substring(_alt, s.a + 1, x.n)) AS alt))
        WHEN x.op = 'D' AND s.r = 0 THEN array(struct(0 AS at, substring(ref, 1, x.n + 1) AS ref, substring(ref, x.n + 1, 1) AS alt))
        WHEN x.op = 'D' THEN array(struct(s.r - 1 AS at, substring(ref, s.r, x.n + 1) AS ref, substring(ref, s.r, 1) AS alt))
        ELSE filter(transform(sequence(0, x.n - 1), j -> struct(s.r + j AS at, substring(ref, s.r + j + 1, 1) AS ref, substring(_alt, s.a + j + 1, 1) AS alt)), e -> e.ref <> e.alt) END) AS out)).out"""
    each = one.withColumn("_e", F.explode(F.expr(edits))).select("chrom", F.col("pos").alias("origin"), F.expr("pos + _e.at AS pos"), F.col("_e.ref").alias("ref"), F.col("_e.alt").alias("alt"), (F.col("_k") + 1).alias("_k"))
    records = each.groupBy("chrom", "origin", "pos", "ref", "alt").agg(F.collect_set("_k").alias("_ks"))
    info = sites.drop("ref", "alts", "cigars").withColumnRenamed("pos", "origin")
    new = lambda a: f"if(array_contains(_ks, CAST({a} AS INT)), 1L, if({a} IS NULL, NULL, 0L))"
    own = calls.withColumnRenamed("pos", "origin").join(records, ["chrom", "origin"]).withColumns({"a1": F.expr(new("a1")), "a2": F.expr(new("a2"))})
    own = own.withColumn("gt", F.expr("if(a1 IS NULL OR a2 IS NULL, NULL, concat(a1, '/', a2))")) if "gt" in calls.columns else own
    return records.drop("_ks").join(info, ["chrom", "origin"]), own.drop("_ks")
