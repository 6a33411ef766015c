"""One query for each operator over the bound tables, with its DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clusters as C
from ..operators import intervals as I
from ..operators import mapping as M
from ..operators import reads as R
from ..operators import samples as P
from ..operators import sites as V
from ..operators import unique as U
from ..functions.ranking import number_rows
from ..sources import formats as X
from ..sources.bindings import Tables, with_tables
from ..sources.shared import new_path, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def q(name: str, plan: Callable[[Tables], DataFrame], tables: str = "", sql: str = "") -> None:
    QUERIES[name] = lambda spark, sf_dir: plan(Tables(spark, sf_dir))
    if sql:
        ORACLE_SQL[name] = with_tables(tables, sql) if tables else sql


def r6(column) -> F.Column:
    return F.round(column, 6)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: r6(c) for c in columns})


def n_samples(t: Tables) -> DataFrame:
    return t.popmap.agg(F.count("*").alias("n"))


def n_sites(t: Tables) -> DataFrame:
    return t.calls.select("chrom", "pos").distinct().agg(F.count("*").alias("n"))


def listed(df: DataFrame) -> DataFrame:
    """Sites with their arrays as texts."""
    return df.withColumn("alts", F.array_join("alts", ",")).withColumn("filter", F.array_join("filter", ","))


# Unique sequences
q("uq_1_unique_per_sample", lambda t: U.unique_per_sample(t.reads), "uniq", "SELECT * FROM uniq")
q("uq_2_forward_counts", lambda t: U.forward_counts(R.pair_reads(t.mates)), "pairs",
  "SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY sample, fwd) AS n FROM pairs) WHERE NOT contains(fwd, 'NNN') AND NOT contains(rev, 'NNN')")
q("uq_3_coverage_curve", lambda t: U.coverage_curve(U.unique_per_sample(t.reads)), "uniq", "SELECT k, count(CASE WHEN n >= k THEN 1 END) AS rows FROM uniq, range(2, 21) AS r(k) GROUP BY k")
q("uq_4_filter_k1", lambda t: U.filter_k1(U.unique_per_sample(t.reads), 2), "uniq", "SELECT * FROM uniq WHERE n >= 2")
q("uq_5_individuals_per_seq", lambda t: U.individuals_per_seq(U.unique_per_sample(t.reads), 2), "uniq", "SELECT seq, count(*) AS n_ind FROM uniq WHERE n >= 2 GROUP BY seq")
q("uq_6_individuals_per_forward", lambda t: U.individuals_per_forward(U.forward_counts(R.pair_reads(t.mates)), 1, 1), "pairs",
  """WITH c AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY sample, fwd) AS n FROM pairs) WHERE NOT contains(fwd, 'NNN') AND NOT contains(rev, 'NNN')),
  f AS (SELECT fwd, count(DISTINCT sample) AS n_ind FROM c GROUP BY fwd)
  SELECT n_ind, fwd || repeat('N', 10) || rev AS seq FROM c JOIN f USING (fwd)""")  # fmt: skip
q("uq_7_individual_curve", lambda t: U.individual_curve(U.individuals_per_seq(U.unique_per_sample(t.reads), 1), t.reads.select("sample").distinct().count()), "uniq",
  "WITH i AS (SELECT seq, count(*) AS n_ind FROM uniq GROUP BY seq) SELECT k, count(CASE WHEN n_ind >= k THEN 1 END) AS rows FROM i, range(2, 1 + (SELECT CASE WHEN count(DISTINCT sample) > 10 THEN count(DISTINCT sample) // 2 ELSE count(DISTINCT sample) END FROM uniq)) AS r(k) GROUP BY k")
q("uq_8_filter_k2", lambda t: U.filter_k2(U.individuals_per_seq(U.unique_per_sample(t.reads), 1), 3), "uniq", "SELECT seq, count(*) AS n_ind FROM uniq GROUP BY seq HAVING count(*) >= 3")
q("uq_9_number_contigs", lambda t: U.number_contigs(U.filter_k2(U.individuals_per_seq(U.unique_per_sample(t.reads), 1), 2)), "uniq",
  "SELECT seq, n_ind, row_number() OVER (ORDER BY n_ind DESC, seq DESC) AS contig_no FROM (SELECT seq, count(*) AS n_ind FROM uniq GROUP BY seq HAVING count(*) >= 2)")
q("uq_10_length_bounds", lambda t: U.length_bounds(t.reads), "reads", "SELECT min(length(seq)) AS shortest, max(length(seq)) AS longest FROM reads")
q("uq_10_filter_length", lambda t: U.filter_length(t.reads, 40), "reads", "SELECT * FROM reads WHERE length(seq) >= 40")
q("uq_11_k1_k2_surface", lambda t: U.k1_k2_surface(U.unique_per_sample(t.reads), range(1, 6), range(1, 6)), "uniq",
  """WITH c AS (SELECT k1, seq, count(*) AS n_ind FROM uniq, range(1, 6) AS a(k1) WHERE n >= k1 GROUP BY k1, seq)
  SELECT k1, k2, count(CASE WHEN n_ind >= k2 THEN 1 END) AS n_seqs FROM c, range(1, 6) AS b(k2) WHERE k1 + k2 > 2 GROUP BY k1, k2""")  # fmt: skip
q("uq_12_assembly_summary", lambda t: U.assembly_summary(U.filter_k2(U.individuals_per_seq(U.unique_per_sample(t.reads), 1), 2), t.contigs), "uniq contigs",
  "SELECT (SELECT count(*) FROM (SELECT seq FROM uniq GROUP BY seq HAVING count(*) >= 2)) AS sequences, (SELECT count(*) FROM contigs) AS contigs")
_RC = "reverse(translate({}, 'abcdefghijklmnopqrstuvwxyzACGT', 'TBGDEFCHIJKLMNOPQRSAUVWXYZTGCA'))"
q("uq_13_unique_pooled", lambda t: U.unique_pooled(R.pair_reads(t.mates)), "pairs", f"SELECT fwd || repeat('N', 10) || {_RC.format('rev')} AS seq, count(*) AS n FROM pairs GROUP BY 1")
q("uq_13_pooled_curve", lambda t: U.coverage_curve(U.unique_pooled(R.pair_reads(t.mates)), 1, 50, strict=True), "pairs",
  f"WITH u AS (SELECT count(*) AS n FROM pairs GROUP BY fwd || {_RC.format('rev')}) SELECT k, count(CASE WHEN n > k THEN 1 END) AS rows FROM u, range(1, 51) AS r(k) GROUP BY k")

# Reads
q("rd_1_normalise_names", lambda t: R.normalise_names(t.mates), "mates", "SELECT sample, mate, ordinal, CASE mate WHEN 1 THEN regexp_replace(name, '_1$', '/1') ELSE regexp_replace(name, '_2$', '/2') END AS name, seq FROM mates")


def _barcodes(t: Tables) -> DataFrame:
    """A barcode of 6 (even numbers: 5) bases for each supplier."""
    code = "concat(" + ", ".join(f"substring('ACGT', CAST(s_suppkey * 1237 div {4**i} % 4 AS INT) + 1, 1)" for i in range(6)) + ")"
    return t.read("supplier").selectExpr("concat('S', s_suppkey) AS sample", f"substring({code}, 1, CAST(6 - (1 - s_suppkey % 2) AS INT)) AS barcode")


_CODE = " || ".join(f"substr('ACGT', s_suppkey * 1237 // {4**i} % 4 + 1, 1)" for i in range(6))
q("rd_2_demultiplex", lambda t: R.demultiplex(t.dna.drop("sample"), _barcodes(t), 1), "dna",
  f"""WITH bc AS (SELECT 'S' || s_suppkey AS sample, substr({_CODE}, 1, 6 - (1 - s_suppkey % 2)) AS barcode FROM supplier),
  d AS (SELECT doc_id, line, seq, bc.sample AS owner, length(barcode) AS n, hamming(substr(seq, 1, length(barcode)), barcode) AS dist FROM dna JOIN bc ON length(seq) >= length(barcode)),
  k AS (SELECT *, rank() OVER (PARTITION BY doc_id, line ORDER BY dist, n DESC) AS r FROM d WHERE dist <= 1)
  SELECT doc_id, line, substr(any_value(seq), any_value(n) + 1) AS seq, any_value(owner) AS sample FROM k WHERE r = 1 GROUP BY doc_id, line HAVING count(DISTINCT owner) = 1""")  # fmt: skip
q("rd_3_min_length", lambda t: R.min_length(t.mates), "mates", "SELECT max(length(seq)) // 2 AS min_len FROM mates WHERE ordinal = 0")
q("rd_5_pair_reads", lambda t: R.pair_reads(t.mates), "pairs", "SELECT * FROM pairs")
q("rd_6_drop_ambiguous", lambda t: R.drop_ambiguous(R.pair_reads(t.mates), "the"), "pairs", "SELECT * FROM pairs WHERE NOT contains(fwd, 'the') AND NOT contains(rev, 'the')")
q("rd_7_glue_pairs", lambda t: R.glue_pairs(R.pair_reads(t.mates)), "pairs", "SELECT sample, ordinal, fwd || repeat('N', 10) || rev AS seq FROM pairs")
q("rd_7_split_pairs", lambda t: R.split_pairs(R.glue_pairs(R.pair_reads(t.mates))), "pairs", "SELECT * FROM pairs")
q("rd_8_revcomp", lambda t: t.dna.select("sample", "doc_id", "line", R.revcomp(F.col("seq")).alias("seq")), "dna", f"SELECT sample, doc_id, line, {_RC.format('seq')} AS seq FROM dna")
q("rd_10_dedup_pairs", lambda t: R.dedup_pairs(R.pair_reads(t.mates)), "pairs", "SELECT DISTINCT fwd, rev FROM pairs")
q("rd_11_insert_model", lambda t: R.insert_model(t.reads), "reads", "SELECT 2 * m AS insert_size, 2 * m - 100 AS low, 2 * m + 100 AS high, 2 * m // 5 AS sd FROM (SELECT max(length(seq)) AS m FROM reads)")
q("rd_11_insert_model_from_contigs", lambda t: R.insert_model_from_contigs(t.contigs), "contigs", "SELECT CAST(floor(avg(length(seq))) AS BIGINT) AS insert_size FROM contigs")
q("rd_12_pad_contigs", lambda t: R.pad_contigs(t.dna), "dna", r"SELECT sample, doc_id, line, regexp_replace(regexp_replace(seq, '^([ACGT])', 'N\1'), '([ACGT])$', '\1N') AS seq FROM dna")
q("rd_13_relabel_contigs", lambda t: R.relabel_contigs(t.contigs, "ref_"), "contigs", "SELECT 'ref_' || contig_no AS contig, contig_no, seq FROM contigs")
q("rd_14_count_matching", lambda t: R.count_matching(t.dna, "^[AC].*A.*T"), "dna", "SELECT count(CASE WHEN regexp_matches(seq, '^[AC].*A.*T') THEN 1 END) AS matching, count(*) AS contigs FROM dna")
q("rd_15_natural_order", lambda t: t.contigs.select("contig", *[k.alias(n) for k, n in zip(R.natural_key(F.col("contig")), ("text", "number"))]), "contigs", "SELECT contig, 'ctg_' AS text, contig_no AS number FROM contigs")
q("rd_15_natural_positions", lambda t: number_rows(t.contigs.select("contig"), [R.natural_key(F.col("contig"))[0], F.floor(R.natural_key(F.col("contig"))[1] / 1000)], [*R.natural_key(F.col("contig")), F.col("contig")], "position", ascending=True), "contigs",
  "SELECT contig, row_number() OVER (ORDER BY contig_no) AS position FROM contigs")
q("rd_15_natural_sort", lambda t: R.natural_order(t.contigs).select("contig", "seq"), "contigs", "SELECT contig, seq FROM contigs ORDER BY contig_no")
q("rd_16_split_by_length", lambda t: R.cut_fixed(R.split_by_length(t.reads, 50, 60), 20, 31), "reads", "SELECT sample, doc_id, line, substr(seq, 1, 20) AS fwd, substr(seq, 31) AS rev FROM reads WHERE length(seq) BETWEEN 50 AND 60")
q("rd_17_mask_range", lambda t: R.mask_range(t.reads, 96, 105), "reads", "SELECT sample, doc_id, line, substr(seq, 1, 95) || repeat('N', greatest(0, least(length(seq), 105) - 95)) || substr(seq, 106) AS seq FROM reads")

# Sites and genotypes
_STATS = """sc AS (SELECT chrom, pos, CAST(sum(n) AS BIGINT) AS copies, list_reverse_sort(list(n)) AS ns, coalesce(sum(n) FILTER (allele = 1), 0) AS c1, coalesce(sum(n) FILTER (allele = 2), 0) AS c2 FROM counts GROUP BY chrom, pos),
  st AS (SELECT c.*, copies, coalesce(ns[2], 0) AS second, c1 >= 0.001 * copies AND c1 <= 0.9999 * copies AND (alt2 IS NULL OR c2 >= 0.001 * copies AND c2 <= 0.9999 * copies) AS shared
    FROM (SELECT chrom, pos, count(*) AS called, CAST(sum(dp) AS BIGINT) AS dp_sum, count(*) AS dp_n FROM calls GROUP BY chrom, pos) AS c JOIN sc USING (chrom, pos) JOIN sites USING (chrom, pos))"""
_CALLS = "SELECT calls.* FROM calls SEMI JOIN g USING (chrom, pos)"


def _calls(name: str, plan: Callable[[Tables], DataFrame], where: str) -> None:
    q(name, plan, "counts sites popmap", f"WITH {_STATS}, g AS (SELECT chrom, pos FROM st WHERE {where}) {_CALLS}")


_calls("v_1_max_missing", lambda t: V.max_missing(t.calls, 0.5, n_samples(t)), "called >= 0.5 * (SELECT count(*) FROM popmap)")
_calls("v_2_mac", lambda t: V.mac(t.calls, 3), "second >= 3")
_calls("v_3_maf", lambda t: V.maf(t.calls, 0.05), "second >= 0.05 * copies")
_calls("v_4_non_ref_af", lambda t: V.non_ref_af(t.calls, sites=t.sites), "shared")
_calls("v_7_mean_depth", lambda t: V.mean_depth(t.calls, 15, 18), "dp_sum >= 15 * dp_n AND dp_sum <= 18 * dp_n")
_calls("v_26_filter_max_mean_depth", lambda t: V.filter_max_mean_depth(t.calls, 16), "dp_sum <= 16 * dp_n")
_SITE = "chrom, pos, pk, ref, alt1 || CASE WHEN alt2 IS NULL THEN '' ELSE ',' || alt2 END AS alts, qual, {} AS filter, dp, ab, saf, sar, srf, srr, mqm, mqmr, paired, pairedr"


def _sites(name: str, plan: Callable[[DataFrame], DataFrame], where: str, tag: str = "''") -> None:
    q(name, lambda t: listed(plan(t.sites)), "sites", f"SELECT {_SITE.format(tag)} FROM sites WHERE {where}")


_SNP = "length(alt1) = 1"
_sites("v_5_min_qual", lambda s: V.min_qual(s, 30), "qual >= 30")
_sites("v_8_remove_indels", V.remove_indels, _SNP)
_sites("v_9_select_indels", lambda s: V.select_type(s, "indel"), f"NOT ({_SNP})")
_sites("v_10_max_alleles", lambda s: V.max_alleles(s, 2), "alt2 IS NULL")
_sites("v_12_filter_sites", lambda s: V.filter_sites(s, "ab > 0.25 AND ab < 0.75 OR ab < 0.01"), "ab > 0.25 AND ab < 0.75 OR ab < 0.01")
_sites("v_15_tag_sites", lambda s: V.tag_sites(s, "qual >= 50", "HighQual", "LowQual"), "true", "CASE WHEN qual >= 50 THEN 'HighQual' ELSE 'LowQual' END")
_sites("v_15_keep_tagged", lambda s: V.keep_tagged(V.tag_sites(s, "qual >= 50", "HighQual"), "HighQual"), "qual >= 50", "'HighQual'")
_sites("v_15_remove_tagged", lambda s: V.remove_tagged(V.tag_sites(s, "qual >= 50", None, "LowQual"), "LowQual"), "qual >= 50")
_AB = "(ab > 0.2 AND ab < 0.8 OR ab < 0.01 OR ab > 0.99)"
_sites("v_16_filter_allele_balance", V.filter_allele_balance, _AB)
_sites("v_17_filter_qual_depth", V.filter_qual_depth, "qual > 0.1 * dp")
_MQ = "(mqm > 0.25 * mqmr AND mqm < 1.75 * mqmr)"
_sites("v_18_filter_mapq_ratio", V.filter_mapq_ratio, _MQ)
_STRAND = "(saf > 100 * sar AND srf > 100 * srr OR sar > 100 * saf AND srr > 50 * srf)"
_sites("v_19_filter_strand", V.filter_strand, _STRAND)
_PAIR = "(paired > 0.05 AND pairedr > 0.05 AND pairedr > 0.25 * paired AND pairedr < 1.75 * paired OR paired < 0.05 AND pairedr < 0.05)"
_sites("v_20_filter_pairing", V.filter_pairing, _PAIR)
_sites("v_21_filter_pairing_mixed", V.filter_pairing_mixed, "(paired < 0.005) = (pairedr < 0.005)")
_sites("v_22_hard_filter", lambda s: V.hard_filter(s, {"BadValidation": "sar >= 2 AND 10 * sar > dp", "LowQual": "qual < 30", "LowQD": "qual < 5 * sar"}), "true",
       "CASE WHEN NOT (sar >= 2 AND 10 * sar > dp) AND qual >= 30 AND qual >= 5 * sar THEN 'PASS' ELSE concat_ws(',', CASE WHEN sar >= 2 AND 10 * sar > dp THEN 'BadValidation' END, CASE WHEN qual < 30 THEN 'LowQual' END, CASE WHEN qual < 5 * sar THEN 'LowQD' END) END")
q("v_6_min_depth", lambda t: V.min_depth(t.calls, 5), "calls",
  "SELECT chrom, pos, sample, pop, sid, pk, dp, CASE WHEN dp >= 5 THEN a1 END AS a1, CASE WHEN dp >= 5 THEN a2 END AS a2, CASE WHEN dp >= 5 THEN gt END AS gt, ro, ao FROM calls")
q("v_11_keep_positions", lambda t: V.keep_positions(t.calls, t.sites.where("qual >= 50")), "calls sites", f"WITH g AS (SELECT chrom, pos FROM sites WHERE qual >= 50) {_CALLS}")
q("v_11_exclude_positions", lambda t: V.exclude_positions(t.calls, t.sites.where("qual >= 50")), "calls sites", f"WITH g AS (SELECT chrom, pos FROM sites WHERE qual < 50) {_CALLS}")
q("v_13_filter_alleles", lambda t: listed(V.filter_alleles(t.sites, lambda a: a.isin("A", "C"))).select("chrom", "pos", "alts"), "sites",
  "SELECT chrom, pos, concat_ws(',', CASE WHEN alt1 IN ('A', 'C') THEN alt1 END, CASE WHEN alt2 IN ('A', 'C') THEN alt2 END) AS alts FROM sites WHERE alt1 IN ('A', 'C') OR coalesce(alt2, '') IN ('A', 'C')")
q("v_13_filter_alleles_calls", lambda t: V.filter_alleles(t.sites, lambda a: a.isin("A", "C"), calls=t.calls)[1].select("chrom", "pos", "sample", "gt"), "sites",
  """WITH k AS (SELECT chrom, pos, coalesce(alt1 IN ('A', 'C'), false) AS k1, coalesce(alt2 IN ('A', 'C'), false) AS k2 FROM sites),
  n AS (SELECT c.chrom, c.pos, sample, [CASE WHEN a = 0 THEN 0 WHEN a = 1 AND k1 THEN 1 WHEN a = 2 AND k2 THEN 1 + k1::INT END FOR a IN [a1, a2]] AS g FROM calls AS c JOIN k USING (chrom, pos) WHERE k1 OR k2)
  SELECT chrom, pos, sample, g[1] || '/' || g[2] AS gt FROM n""")  # fmt: skip
q("v_14_filter_genotypes", lambda t: V.filter_genotypes(t.calls, "ro > 3 OR ao > 10").select("chrom", "pos", "sample", "gt"), "calls", "SELECT chrom, pos, sample, CASE WHEN ro > 3 OR ao > 10 THEN gt END AS gt FROM calls")
_LOW = "lim AS (SELECT floor(avg(dp)) + floor(stddev_pop(dp)) AS sd, floor(avg(dp) + 3 * sqrt(avg(dp))) AS s3, floor(avg(dp)) AS m FROM sites)"
for _mode, _where in (("sd", "dp > sd AND qual < 2 * dp"), ("sqrt3", "dp > s3 AND qual < 2 * dp"), ("mean", "dp > m AND qual < dp")):
    q(f"v_24_low_quality_high_depth_{_mode}", lambda t, m=_mode: V.low_quality_high_depth(t.sites, m).select("chrom", "pos", "dp", "qual"), "sites", f"WITH {_LOW} SELECT chrom, pos, dp, qual FROM sites, lim WHERE {_where}")
q("v_25_depth_cutoffs", lambda t: V.depth_cutoffs(t.calls, n_samples(t)), "sites popmap",
  """WITH n AS (SELECT count(*) AS n FROM popmap), s AS (SELECT dp, row_number() OVER (ORDER BY dp DESC) - 1 AS i, count(*) OVER () AS c FROM sites)
  SELECT (SELECT CAST(floor((avg(dp) + 1.645 * stddev_pop(dp)) / max(n)) AS BIGINT) FROM sites, n) AS by_sd, (SELECT CAST(floor(dp / n) AS BIGINT) FROM s, n WHERE i = CAST(floor(0.05 * (c - 1)) AS BIGINT)) AS by_rank""")  # fmt: skip
q("v_27_depth_mismatch", lambda t: V.depth_mismatch(V.site_depth(t.calls)), "sites",
  "SELECT chrom, pos, dp FROM (SELECT chrom, pos, dp, sum(dp) OVER (PARTITION BY chrom) AS s, count(*) OVER (PARTITION BY chrom) AS n FROM sites) WHERE dp * n < 0.6 * s")
_CHAIN = f"""WITH {_LOW}, s1 AS (SELECT * FROM sites WHERE {_AB}), s2 AS (SELECT * FROM s1 WHERE qual > 0.1 * dp), s3 AS (SELECT * FROM s2 WHERE {_MQ}), s4 AS (SELECT * FROM s3 WHERE {{strand}}), s5 AS (SELECT * FROM s4 WHERE {_PAIR}),
  s6 AS (SELECT s5.* FROM s5, lim WHERE NOT (dp > sd AND qual < 2 * dp)), md AS (SELECT chrom, pos FROM calls GROUP BY chrom, pos HAVING sum(dp) <= 17 * count(*)), s7 AS (SELECT s6.* FROM s6 SEMI JOIN md USING (chrom, pos)),
  s8 AS (SELECT * FROM (SELECT *, sum(dp) OVER (PARTITION BY chrom) AS cs, count(*) OVER (PARTITION BY chrom) AS cn FROM s7) WHERE dp * cn >= 0.6 * cs) """
_NAMES = ["all", "allele balance", "quality by depth", "mapping quality", "strand", "pairing", "low quality at high depth", "mean depth", "depth within contig"]
_REPORT = " UNION ALL ".join(f"SELECT CAST({i} AS BIGINT) AS step, '{n}' AS filter, count(*) AS sites FROM {'sites' if i == 0 else f's{i}'}" for i, n in enumerate(_NAMES))
q("v_28_filter_chain", lambda t: V.filter_chain(t.sites, t.calls, overlap=True, cutoff=17)[0].select("chrom", "pos", "qual", "dp"), "calls sites", _CHAIN.format(strand="true") + "SELECT chrom, pos, qual, dp FROM s8")
q("v_28_filter_chain_report", lambda t: V.filter_chain(t.sites, t.calls, cutoff=17)[2], "calls sites", _CHAIN.format(strand=_STRAND) + _REPORT)
q("v_28_filter_chain_calls", lambda t: V.filter_chain(t.sites, t.calls, overlap=True, cutoff=17)[1].select("chrom", "pos", "sample", "gt", "dp"), "calls sites",
  _CHAIN.format(strand="true") + "SELECT c.chrom, c.pos, sample, CASE WHEN ro > 0 OR ao > 0 THEN gt END AS gt, c.dp FROM calls AS c SEMI JOIN s8 ON c.chrom = s8.chrom AND c.pos = s8.pos")
q("v_1_2_5_first_filter", lambda t: V.first_filter(t.sites, t.calls, n_samples(t)).select("chrom", "pos", "qual"), "counts sites popmap",
  f"WITH {_STATS} SELECT chrom, pos, qual FROM sites SEMI JOIN (SELECT * FROM st WHERE called >= 0.5 * (SELECT count(*) FROM popmap) AND second >= 3) AS g USING (chrom, pos) WHERE qual >= 30")
q("v_29_final_filter", lambda t: V.final_filter(t.sites, t.calls, n_samples(t).select(F.floor(F.col("n") / 2))).select("chrom", "pos", "qual"), "counts sites popmap",
  f"WITH {_STATS} SELECT chrom, pos, qual FROM sites SEMI JOIN (SELECT * FROM st WHERE called >= 0.9 * (SELECT count(*) // 2 FROM popmap) AND shared AND second >= 1) AS g USING (chrom, pos) WHERE qual >= 30")
q("v_30_site_depth", lambda t: V.site_depth(t.calls), "sites", "SELECT chrom, pos, dp FROM sites")
q("v_30_site_quality", lambda t: V.site_quality(t.sites), "sites", "SELECT chrom, pos, qual FROM sites")
q("v_31_allele_counts", lambda t: V.allele_counts(t.calls), "calls", "SELECT chrom, pos, allele, count(*) AS n FROM (SELECT chrom, pos, a1 AS allele FROM calls UNION ALL SELECT chrom, pos, a2 FROM calls) GROUP BY ALL")
q("v_32_filter_multi_maf", lambda t: V.filter_multi_maf(t.sites.withColumn("af", F.array("ab", F.col("paired") / 4)), 0.3).select("chrom", "pos"), "sites", "SELECT chrom, pos FROM sites WHERE ab + paired / 4 > 0.3 AND ab + paired / 4 < 0.7")
q("v_33_snp_clusters", lambda t: V.snp_clusters(t.sites.select("chrom", "pos")), "sites",
  """SELECT chrom, pos FROM (SELECT chrom, pos, lag(pos, 2) OVER w AS a, lag(pos, 1) OVER w AS b, lead(pos, 1) OVER w AS c, lead(pos, 2) OVER w AS d FROM sites WINDOW w AS (PARTITION BY chrom ORDER BY pos))
  WHERE pos - a <= 25 OR c - b <= 25 OR d - pos <= 25""")  # fmt: skip
_HETS = "h AS (SELECT chrom, pos, count(CASE WHEN a1 <> a2 THEN 1 END) AS hets, CAST(sum(dp) AS BIGINT) AS dp FROM calls GROUP BY chrom, pos)"
q("v_34_paralog_sites", lambda t: V.paralog_sites(t.calls, t.sites), "calls",
  f"WITH {_HETS}, k AS (SELECT hets, row_number() OVER (ORDER BY hets) - 1 AS i, count(*) OVER () AS n FROM h) SELECT chrom, pos, hets FROM h WHERE hets > (SELECT hets FROM k WHERE i = CAST(floor(0.9 * (n - 1)) AS BIGINT))")
q("v_35_hets_vs_depth", lambda t: V.hets_vs_depth(t.calls), "calls", f"WITH {_HETS} SELECT * FROM h")
q("v_35_fit_line", lambda t: rounded(V.fit_line(V.hets_vs_depth(t.calls)), "slope", "intercept"), "calls", f"WITH {_HETS} SELECT round(regr_slope(hets, dp), 6) AS slope, round(regr_intercept(hets, dp), 6) AS intercept FROM h")
q("v_36_one_random_site", lambda t: V.one_random_site(t.sites).select("chrom", "pos", "qual"), "sites",
  "SELECT chrom, pos, qual FROM (SELECT *, row_number() OVER (PARTITION BY chrom ORDER BY md5('1|' || chrom || '|' || pos), pos) AS n FROM sites) WHERE n = 1")
q("v_37_best_site", lambda t: V.best_site(t.sites).select("chrom", "pos", "qual"), "sites", "SELECT chrom, pos, qual FROM (SELECT *, row_number() OVER (PARTITION BY chrom ORDER BY qual DESC, pos) AS n FROM sites) WHERE n = 1")
q("v_38_count_loci", lambda t: V.count_loci(t.sites), "sites", "SELECT count(DISTINCT chrom) AS loci FROM sites")
q("v_39_closest_variant", lambda t: V.closest_variant(t.sites), "sites",
  "SELECT chrom, pos, least(pos - lag(pos) OVER w, lead(pos) OVER w - pos) AS distance FROM sites WINDOW w AS (PARTITION BY chrom ORDER BY pos)")


def _scored(t: Tables) -> DataFrame:
    return t.sites.select("chrom", "pos", F.col("pk").alias("ordinal"))


q("v_40_outliers", lambda t: V.split_outliers(_scored(t), t.hap_stats, 0.1)[0], "sites hap_stats", "SELECT chrom, pos, ordinal FROM sites JOIN hap_stats ON pk = ordinal WHERE q <= 0.1")
q("v_40_neutral", lambda t: V.split_outliers(_scored(t), t.hap_stats, 0.1)[1], "sites hap_stats", "SELECT chrom, pos, ordinal FROM sites JOIN hap_stats ON pk = ordinal WHERE q > 0.1")
q("v_40_outliers_p", lambda t: V.split_outliers_p(_scored(t), t.hap_stats, 0.1)[0], "sites hap_stats", "SELECT chrom, pos, ordinal FROM sites JOIN hap_stats ON pk = ordinal WHERE q >= 1 - 0.1 / 2")
_BAD = "SELECT DISTINCT locus FROM hap_stats WHERE status = 'FILTERED' AND NOT contains(comment, 'Complex')"
q("v_41_remove_loci", lambda t: V.remove_loci(t.sites.select("chrom", "pos"), t.hap_stats.where("q < 0.02").select("locus")), "sites hap_stats", "SELECT chrom, pos FROM sites WHERE chrom NOT IN (SELECT locus FROM hap_stats WHERE q < 0.02)")
q("v_42_bad_haplotype_loci", lambda t: V.bad_haplotype_loci(t.hap_stats), "hap_stats", _BAD)
q("v_43_contigs_of_sites", lambda t: V.contigs_of_sites(t.contigs, t.sites), "contigs sites", "SELECT * FROM contigs WHERE contig IN (SELECT chrom FROM sites)")
q("v_44_low_maf_loci", lambda t: V.low_maf_loci(t.sites.select(F.col("chrom").alias("locus"), F.col("ab").alias("af")), t.contigs.select(F.col("contig").alias("locus"), F.col("contig_no").alias("locus_no"))), "sites contigs",
  "SELECT DISTINCT chrom AS locus, contig_no AS locus_no FROM sites JOIN contigs ON chrom = contig WHERE greatest(ab, 1 - ab) > 0.95")
q("v_45_keep_scored", lambda t: V.keep_scored(V.tag_sites(t.sites, "sar = 0", "PASS", "TrancheHigh").withColumn("info", F.when(F.col("pk") % 2 == 0, F.create_map(F.lit("VQSLOD"), F.lit("1"))).otherwise(F.create_map().cast("map<string,string>"))), "VQSLOD", "^Tranche").select("chrom", "pos"), "sites",
  "SELECT chrom, pos FROM sites WHERE pk % 2 = 0 AND sar = 0")

# Individuals and populations
_IMISS = "i AS (SELECT p.sample, (SELECT count(*) FROM sites) AS n_data, (SELECT count(*) FROM sites) - count(CASE WHEN dp >= 3 THEN 1 END) AS n_miss FROM popmap AS p LEFT JOIN calls AS c ON p.sample = c.sample GROUP BY p.sample)"


def _masked(t: Tables) -> DataFrame:
    return V.min_depth(t.calls, 3)


q("p_1_missing_by_individual", lambda t: rounded(P.missing_by_individual(_masked(t), t.popmap, n_sites(t)), "f_miss"), "sites popmap", f"WITH {_IMISS} SELECT *, round(n_miss / n_data, 6) AS f_miss FROM i")
_CUT = "cut AS (SELECT n_miss AS c FROM (SELECT n_miss, row_number() OVER (ORDER BY n_miss DESC) - 1 AS k, count(*) OVER () AS n FROM i) WHERE k = CAST(floor(0.14 * (n - 1)) AS BIGINT))"
q("p_2_missing_cutoff", lambda t: rounded(P.missing_cutoff(P.missing_by_individual(_masked(t), t.popmap, n_sites(t))), "cutoff"), "sites popmap", f"WITH {_IMISS}, {_CUT} SELECT round(c / (SELECT count(*) FROM sites), 6) AS cutoff FROM cut")
q("p_2_remove_missing_individuals", lambda t: P.remove_missing_individuals(_masked(t), t.popmap, n_sites(t)).groupBy("sample").agg(F.count("*").alias("n")), "sites popmap",
  f"WITH {_IMISS}, {_CUT} SELECT sample, count(*) AS n FROM calls WHERE sample NOT IN (SELECT sample FROM i, cut WHERE n_miss > c) GROUP BY sample")
q("p_3_remove_low_depth_individuals", lambda t: P.remove_low_depth_individuals(t.calls).groupBy("sample").agg(F.count("*").alias("n")), "calls",
  """WITH d AS (SELECT sample, avg(dp) AS x FROM calls GROUP BY sample), k AS (SELECT x, row_number() OVER (ORDER BY x DESC) - 1 AS i, count(*) OVER () AS n FROM d)
  SELECT sample, count(*) AS n FROM calls WHERE sample NOT IN (SELECT sample FROM d WHERE x < (SELECT x FROM k WHERE i = CAST(floor(0.85 * (n - 1)) AS BIGINT))) GROUP BY sample""")  # fmt: skip
q("p_4_keep_individuals", lambda t: P.keep_individuals(t.calls, t.popmap.where("pop = 'P1'")), "calls", "SELECT * FROM calls WHERE pop = 'P1'")
q("p_4_remove_individuals", lambda t: P.remove_individuals(t.calls, t.popmap.where("pop = 'P1'")), "calls", "SELECT * FROM calls WHERE pop <> 'P1'")
_MSP = "m AS (SELECT s.chrom, s.pos, z.pop, z.n AS n_data, z.n - count(CASE WHEN c.dp >= 3 THEN 1 END) AS n_miss FROM sites AS s CROSS JOIN (SELECT pop, count(*) AS n FROM popmap GROUP BY pop) AS z LEFT JOIN calls AS c ON c.pk = s.pk AND c.pop = z.pop GROUP BY s.chrom, s.pos, z.pop, z.n)"
q("p_5_missing_by_site_pop", lambda t: rounded(P.missing_by_site_pop(_masked(t), t.popmap), "f_miss"), "sites popmap", f"WITH {_MSP} SELECT *, round(n_miss / n_data, 6) AS f_miss FROM m")
q("p_6_filter_missing_by_pop", lambda t: P.filter_missing_by_pop(_masked(t), t.popmap, 0.6, 2).select("chrom", "pos", "sample"), "sites popmap",
  f"WITH {_MSP}, b AS (SELECT chrom, pos FROM m WHERE n_miss / n_data > 0.6 GROUP BY chrom, pos HAVING count(*) >= 2) SELECT chrom, pos, sample FROM calls ANTI JOIN b USING (chrom, pos)")
_GC = "g AS (SELECT chrom, pos, pop, count(CASE WHEN a1 + a2 = 0 THEN 1 END) AS hom1, count(CASE WHEN a1 + a2 = 1 THEN 1 END) AS het, count(CASE WHEN a1 + a2 = 2 THEN 1 END) AS hom2 FROM calls WHERE a1 < 2 AND a2 < 2 GROUP BY chrom, pos, pop)"
q("p_7_genotype_counts", lambda t: P.genotype_counts(t.calls.drop("pop"), t.popmap), "calls", f"WITH {_GC} SELECT * FROM g")
_HWE = f"""{_GC}, t AS (SELECT DISTINCT hom1, het, hom2, hom1 + het + hom2 AS n, 2 * least(hom1, hom2) + het AS r FROM g),
  l AS (SELECT *, h * ln(2) - lgamma(h + 1) - lgamma((r - h) // 2 + 1) - lgamma(n - h - (r - h) // 2 + 1) AS w FROM (SELECT *, unnest(range(r % 2, least(r, 2 * n - r) + 1, 2)) AS h FROM t)),
  m AS (SELECT *, max(w) OVER k AS top, max(CASE WHEN h = het THEN w END) OVER k AS own FROM l WINDOW k AS (PARTITION BY hom1, het, hom2)),
  e AS (SELECT hom1, het, hom2, least(1, sum(exp(w - top)) FILTER (exp(w - top) <= exp(own - top) * (1 + 1e-9)) / sum(exp(w - top))) AS p FROM m GROUP BY hom1, het, hom2)"""
q("p_7_hwe", lambda t: rounded(P.hwe(t.calls.drop("pop"), t.popmap), "p", "exp_het"), "calls",
  f"WITH {_HWE} SELECT g.*, round(p, 6) AS p, round((2 * hom1 + het) * (2 * hom2 + het) / (2 * (hom1 + het + hom2)), 6) AS exp_het FROM g JOIN e USING (hom1, het, hom2)")
# An exact p of 1/5 occurs: it is not under 0.2, whatever the last bits of a sum of exponentials are.
_LOW = f"WITH {_HWE} SELECT chrom, pos, count(CASE WHEN p < {{0}} - 1e-9 THEN 1 END) AS low FROM g JOIN e USING (hom1, het, hom2) GROUP BY chrom, pos HAVING count(CASE WHEN p < {{0}} - 1e-9 THEN 1 END) > 0.25 * (SELECT count(DISTINCT pop) FROM popmap)"
q("p_8_filter_hwe", lambda t: P.filter_hwe(t.calls.drop("pop"), t.popmap, p=0.2)[1], "calls popmap", _LOW.format("0.2"))
q("p_8_filter_hwe_kept", lambda t: P.filter_hwe(t.calls.drop("pop"), t.popmap, p=0.05, cutoff=0.1)[0].groupBy("chrom", "pos").agg(F.count("*").alias("n")), "calls popmap",
  f"WITH low AS ({_LOW.format('0.05').replace('0.25 *', '0.1 *')}) SELECT chrom, pos, count(*) AS n FROM calls ANTI JOIN low USING (chrom, pos) GROUP BY chrom, pos")
q("p_8_filter_hwe_default", lambda t: P.filter_hwe(t.calls.drop("pop"), t.popmap)[1], "calls popmap", _LOW.format("0.001"))
_DUP = "d AS (SELECT a.pk, a.chrom, a.pos FROM calls AS a JOIN calls AS b ON a.pk = b.pk AND b.sid = a.sid + 20 WHERE a.dp >= 5 AND b.dp >= 5 AND ({}))"


def _twins(t: Tables) -> DataFrame:
    return t.spark.range(20).selectExpr("concat('P', id % 4, '_', id) AS sample_a", "concat('P', (id + 20) % 4, '_', id + 20) AS sample_b")


q("p_9_duplicate_mismatches", lambda t: P.duplicate_mismatches(t.calls, _twins(t)), "calls", f"WITH {_DUP.format('a.gt <> b.gt')} SELECT chrom, pos, count(*) AS pairs FROM d GROUP BY chrom, pos")
q("p_9_duplicate_mismatches_unordered", lambda t: P.duplicate_mismatches(t.calls, _twins(t), unordered=True), "calls", f"WITH {_DUP.format('least(a.a1, a.a2) <> least(b.a1, b.a2) OR greatest(a.a1, a.a2) <> greatest(b.a1, b.a2)')} SELECT chrom, pos, count(*) AS pairs FROM d GROUP BY chrom, pos")
_BARE = "left(CAST(ro AS VARCHAR), 1) = '0' OR starts_with(CAST(ro AS VARCHAR), CAST(dp AS VARCHAR))"
_N = ", ".join(f"count(CASE WHEN a1 < 2 AND a2 < 2 AND dp = {d}{['', '', f' AND (a1 = a2 OR {_BARE})', f' AND (a1 = a2 OR {_BARE})', ' AND a1 = a2', ' AND a1 = a2'][d]} THEN 1 END) AS n{d}" for d in range(1, 6))
q("p_10_error_count", lambda t: rounded(P.error_count(t.calls, n_sites(t), n_samples(t)), "low_share", "high_share", "depth_share"), "sites popmap",
  f"""WITH c AS (SELECT {_N}, count(*) AS called FROM calls) SELECT *, (SELECT count(*) FROM sites) * (SELECT count(*) FROM popmap) AS genotypes, round((n1 / 2 + n2 / 4 + n3 / 8 + n4 / 16 + n5 / 32) / called, 6) AS low_share,
  round((n1 * 0.75 + n2 * 0.5625 + n3 * 0.42 + n4 * 0.316 + n5 * 0.237) / called, 6) AS high_share, round((n1 + n2 + n3 + n4 + n5) / called, 6) AS depth_share FROM c""")  # fmt: skip
q("p_11_genotype_totals", lambda t: P.genotype_totals(_masked(t), n_sites(t), n_samples(t)), "sites popmap",
  "WITH g AS (SELECT (SELECT count(*) FROM sites) * (SELECT count(*) FROM popmap) AS n, (SELECT count(*) FROM calls) AS c) SELECT n AS genotypes, n - c AS missing, c AS called FROM g")
_PI = "1 - CAST(sum(n * (n - 1)) AS DOUBLE) / (sum(n) * (sum(n) - 1))"
q("p_12_site_pi", lambda t: rounded(P.site_pi(t.calls), "pi"), "counts", f"SELECT chrom, pos, round({_PI}, 6) AS pi FROM counts GROUP BY chrom, pos")
q("p_13_resample_pi", lambda t: rounded(P.resample_pi(t.calls.drop("pop"), t.popmap, rounds=100, n=5), "pi"), "calls popmap",
  f"""WITH d AS (SELECT sample, pop, round FROM (SELECT *, row_number() OVER (PARTITION BY pop, round ORDER BY md5('1|' || round || '|' || sample), sample) AS k FROM popmap, range(1, 101) AS r(round)) WHERE k <= 5),
  g AS (SELECT d.pop, round, pk, a1, a2 FROM calls JOIN d ON calls.sample = d.sample),
  c AS (SELECT pop, round, pk, allele, count(*) AS n FROM (SELECT pop, round, pk, a1 AS allele FROM g UNION ALL SELECT pop, round, pk, a2 FROM g) GROUP BY pop, round, pk, allele)
  SELECT pop, round, round(avg(pi), 6) AS pi FROM (SELECT pop, round, pk, {_PI} AS pi FROM c GROUP BY pop, round, pk) GROUP BY pop, round""")  # fmt: skip
q("p_14_samples_of_pop", lambda t: P.samples_of_pop(t.popmap), "popmap", "SELECT pop, string_agg(sample, ',' ORDER BY sample) AS samples, count(*) AS n FROM popmap GROUP BY pop")
q("io_7_read_popmap", lambda t: X.read_popmap(t.spark, _again(t, lambda p: t.popmap.select(F.concat_ws("\t", "sample", "pop")).write.text(p))).select("sample", "pop"), "popmap", "SELECT * FROM popmap")
q("io_7_popmap_from_names", lambda t: P.popmap_from_names(t.popmap), "popmap", "SELECT * FROM popmap")
q("io_8_check_sample_names", lambda t: P.check_sample_names(t.reads.select("sample").distinct()), "reads", "SELECT DISTINCT sample FROM reads WHERE NOT contains(sample, '_')")
q("io_10_combine_calls", lambda t: P.combine_calls(*[t.calls.where(f"sid % 2 = {i}").withColumn("gt", F.when(F.col("dp") < 2, ".").otherwise(F.col("gt"))) for i in (0, 1)]).select("chrom", "pos", "sample", "gt"), "calls",
  "SELECT chrom, pos, sample, CASE WHEN dp < 2 THEN './.' ELSE gt END AS gt FROM calls")
q("io_13_rename_samples", lambda t: P.rename_samples(t.calls.select("chrom", "pos", "sample"), t.popmap.where("pop = 'P0'").select(F.col("sample").alias("old"), F.concat(F.lit("new_"), "sample").alias("new"))), "calls",
  "SELECT chrom, pos, CASE WHEN pop = 'P0' THEN 'new_' || sample ELSE sample END AS sample FROM calls")

# Intervals and alignments
q("iv_1_filter_clipped", lambda t: I.filter_clipped(t.aln), "aln", "SELECT sample, contig, pos, mapq, flag, clip || 'S' || len || 'M' AS cigar, rnext FROM aln WHERE clip < 20")
q("iv_2_filter_mapq", lambda t: I.filter_mapq(t.aln).select("sample", "contig", "pos", "mapq"), "aln", "SELECT sample, contig, pos, mapq FROM aln WHERE mapq >= 1")
q("iv_3_to_intervals", lambda t: I.to_intervals(t.aln), "iv", "SELECT sample, contig, s AS start, e AS \"end\" FROM iv")
_SE = "s AS start, e AS \"end\""


def _merged(t: Tables) -> DataFrame:
    return I.merge_intervals(I.to_intervals(t.aln))


def _depths(t: Tables) -> DataFrame:
    """interval_coverage of the merged intervals, written, since most queries read it more than once."""
    return written(I.merged_coverage(I.to_intervals(t.aln)), I.FILE_ROWS)


q("iv_4_merge_intervals", _merged, "merged", f"SELECT contig, {_SE} FROM merged")
q("iv_4_merge_per_sample", lambda t: I.merge_intervals(I.to_intervals(t.aln), ["sample"]), "iv",
  """SELECT sample, contig, min(s) AS start, max(e) AS "end" FROM (SELECT *, sum(CASE WHEN m IS NULL OR s > m THEN 1 ELSE 0 END) OVER (PARTITION BY sample, contig ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS g
  FROM (SELECT *, max(e) OVER (PARTITION BY sample, contig ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM iv)) GROUP BY sample, contig, g""")  # fmt: skip
q("iv_5_order_by_reference", lambda t: I.order_by_reference(_merged(t), t.contigs).select("contig", "start", "end", "contig_no"), "merged contigs", f"SELECT contig, {_SE}, contig_no FROM merged JOIN contigs USING (contig)")
q("iv_6_coverage_by_interval", lambda t: I.coverage_by_interval(_merged(t), I.to_intervals(t.aln)), "merged iv",
  """WITH e AS (SELECT m.contig, m.s, m.e, p.sample FROM merged AS m, (SELECT DISTINCT sample FROM iv) AS p),
  c AS (SELECT m.contig, m.s, m.e, iv.sample, count(*) AS n FROM merged AS m JOIN iv ON m.contig = iv.contig AND iv.s < m.e AND m.s < iv.e GROUP BY ALL)
  SELECT e.contig, e.s AS start, e.e AS "end", e.sample, coalesce(n, 0) AS depth FROM e LEFT JOIN c ON e.contig = c.contig AND e.s = c.s AND e.e = c.e AND e.sample = c.sample""")  # fmt: skip
q("iv_7_total_coverage", _depths, "cov", f"SELECT contig, {_SE}, depth FROM cov")
_CEIL = "k AS (SELECT depth AS c FROM (SELECT depth, row_number() OVER (ORDER BY depth DESC) - 1 AS i, count(*) OVER () AS n FROM cov) WHERE i = CAST(floor(0.001 * n) AS BIGINT))"
q("iv_8_depth_ceiling", lambda t: I.depth_ceiling(_depths(t)), "cov", f"WITH {_CEIL} SELECT c AS ceiling FROM k")
q("iv_8_filter_depth", lambda t: (lambda cov: I.filter_depth(cov, I.depth_ceiling(cov)))(_depths(t)), "cov", f"WITH {_CEIL} SELECT contig, {_SE}, depth FROM cov, k WHERE depth < c")
q("iv_9_target_load", lambda t: (lambda cov: I.target_load(cov, I.depth_ceiling(cov), 8))(_depths(t)), "cov", f"WITH {_CEIL} SELECT CAST(round_even(sum((e - s) * depth) / 8, 0) AS BIGINT) AS target FROM cov, k WHERE depth < c")
q("iv_10_split_by_depth_high", lambda t: I.split_by_depth(_depths(t), 3)[0], "cov", f"SELECT contig, {_SE}, depth FROM cov WHERE depth > 3")
q("iv_10_split_by_depth_low", lambda t: I.split_by_depth(_depths(t), 3)[1], "cov", f"SELECT contig, {_SE}, depth FROM cov WHERE depth <= 3")
q("iv_11_make_windows", lambda t: I.make_windows(_depths(t), 25, 26), "cov", 'SELECT contig, w AS start, least(w + 25, e) AS "end", depth FROM (SELECT contig, e, depth, unnest(range(s, e, 26)) AS w FROM cov)')
q("iv_12_intersect_intervals", lambda t: I.intersect_intervals(I.to_intervals(t.aln), _merged(t)), "merged iv",
  "SELECT sample, iv.contig, greatest(iv.s, m.s) AS start, least(iv.e, m.e) AS \"end\" FROM iv JOIN merged AS m ON iv.contig = m.contig AND iv.s < m.e AND m.s < iv.e")
q("iv_13_split_coverage", lambda t: I.split_coverage(_depths(t), 3, 25), "cov",
  f'SELECT contig, w AS start, least(w + 25, e) AS "end", depth FROM (SELECT contig, e, depth, unnest(range(s, e, 26)) AS w FROM cov WHERE depth > 3) UNION ALL SELECT contig, {_SE}, depth FROM cov WHERE depth <= 3')
q("iv_14_balance_chunks", lambda t: I.balance_chunks(_depths(t), 5000), "cov",
  f"SELECT contig, {_SE}, depth, (e - s) * depth AS load, CAST((sum((e - s) * depth) OVER (ORDER BY CAST(substr(contig, 5) AS BIGINT), s, e ROWS UNBOUNDED PRECEDING) - (e - s) * depth) // 5000 AS BIGINT) AS chunk FROM cov")
# x: load, p: running sum; goal: the sum that the next chunk's first row reaches, stop: the next row that stands alone
_FOLD = f"""WITH RECURSIVE r AS (
  SELECT *, (e - s) * depth AS x, row_number() OVER o - 1 AS i, sum((e - s) * depth) OVER (o ROWS UNBOUNDED PRECEDING) AS p FROM cov WINDOW o AS (ORDER BY CAST(substr(contig, 5) AS BIGINT), s, e)),
l AS (SELECT *, x >= 300 AS lone, coalesce(lag(x) OVER w >= 300, true) AS behind, min(CASE WHEN x >= 300 THEN i END) OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS stop, CASE WHEN x >= 300 AND i > 0 THEN p ELSE p - x END + 5000 AS goal FROM r WINDOW w AS (ORDER BY i)),
asked AS (SELECT i, lone, stop, goal FROM l UNION ALL SELECT -1, true, (SELECT min(i) FROM l WHERE lone), 5000),
j AS (SELECT asked.i, lone, greatest(t, asked.i + 1) AS jump FROM asked ASOF JOIN (SELECT p, min(i) AS t FROM r GROUP BY p) AS u ON goal <= p WHERE stop IS NULL OR greatest(t, asked.i + 1) < stop),
c AS (SELECT jump AS i FROM j WHERE lone UNION SELECT jump FROM c JOIN j USING (i)),
m AS (SELECT l.*, (lone AND NOT behind)::INT + (l.i IN (SELECT i FROM c))::INT AS more, lone::INT AS after FROM l)
SELECT contig, {_SE}, depth, x AS load, CAST(sum(more + after) OVER (ORDER BY i) - after AS BIGINT) AS chunk FROM m"""
q("iv_14_fold_chunks", lambda t: I.fold_chunks(_depths(t), 5000, 300), "cov", _FOLD)
q("iv_15_merge_alignments", lambda t: I.merge_alignments(*[t.aln.where(f"flag & 16 = {x}") for x in (0, 16)]).select("sample", "contig", "pos", "flag"), "aln", "SELECT sample, contig, pos, flag FROM aln")
_FLAGS = "f AS (SELECT sample, count(CASE WHEN flag & 4 = 0 THEN 1 END) AS mapped, count(CASE WHEN flag & 4 = 0 AND flag & 2 <> 0 THEN 1 END) AS proper, count(CASE WHEN flag & 4 = 0 AND rnext <> '=' AND mapq >= 5 THEN 1 END) AS mismatched FROM aln GROUP BY sample)"
q("mp_1_flag_stats", lambda t: M.flag_stats(t.aln), "aln", f"WITH {_FLAGS} SELECT * FROM f")
_CC = "cc AS (SELECT e.sample, e.contig, coalesce(n, 0) AS n FROM (SELECT sample, contig FROM (SELECT DISTINCT sample FROM aln), contigs) AS e LEFT JOIN (SELECT sample, contig, count(*) AS n FROM aln WHERE flag & 4 = 0 GROUP BY sample, contig) AS x ON e.sample = x.sample AND e.contig = x.contig)"
q("mp_2_contig_counts", lambda t: M.contig_counts(t.aln, t.contigs), "aln contigs", f"WITH {_CC} SELECT * FROM cc")
_CS = "cs AS (SELECT sample, count(CASE WHEN n > 0 THEN 1 END) AS contigs_hit, sum(n) / count(*) AS mean, sum(n) / count(CASE WHEN n > 0 THEN 1 END) AS mean_hit FROM cc GROUP BY sample)"
q("mp_3_contig_coverage_stats", lambda t: rounded(M.contig_coverage_stats(M.contig_counts(t.aln, t.contigs)), "mean", "mean_hit"), "aln contigs", f"WITH {_CC}, {_CS} SELECT sample, contigs_hit, round(mean, 6) AS mean, round(mean_hit, 6) AS mean_hit FROM cs")
q("mp_4_mapping_results", lambda t: rounded(M.mapping_results(M.flag_stats(t.aln).join(M.contig_coverage_stats(M.contig_counts(t.aln, t.contigs)), "sample").withColumn("k1", F.substring_index("sample", "_", 1)), ["k1"]), "cov", "cov_hit", "mean_contigs", "mean_mapped", "mean_proper", "mean_mismatched"), "aln contigs",
  f"""WITH {_CC}, {_CS}, {_FLAGS} SELECT split_part(sample, '_', 1) AS k1, round(avg(mean), 6) AS cov, round(avg(mean_hit), 6) AS cov_hit, round(avg(contigs_hit), 6) AS mean_contigs, CAST(sum(mapped) AS BIGINT) AS sum_mapped, CAST(sum(proper) AS BIGINT) AS sum_proper,
  round(avg(mapped), 6) AS mean_mapped, round(avg(proper), 6) AS mean_proper, round(avg(mismatched), 6) AS mean_mismatched FROM cs JOIN f USING (sample) GROUP BY 1""")  # fmt: skip
q("mp_5_coverage_histogram", lambda t: M.coverage_histogram(M.contig_counts(t.aln, t.contigs), 2)[1], "aln contigs", f"WITH {_CC}, a AS (SELECT avg(n) AS x FROM cc GROUP BY contig) SELECT floor(x / 2) * 2 + 1.0 AS bin, count(*) AS n FROM a GROUP BY 1")
q("mp_6_pick_samples", lambda t: M.pick_samples(t.reads.groupBy("sample").agg(F.count("*").alias("size")), 10), "reads",
  """WITH z AS (SELECT sample, count(*) AS size FROM reads GROUP BY sample), k AS (SELECT *, row_number() OVER (ORDER BY size DESC, sample) AS p, count(*) OVER () AS n FROM z)
  SELECT sample, size FROM k WHERE p > n // 10 AND p <= n - n // 10 ORDER BY md5('1|' || sample), sample LIMIT 10""")  # fmt: skip
q("mp_9_reads_of_largest", lambda t: M.reads_of_largest(t.reads), "reads", "SELECT * FROM reads WHERE sample IN (SELECT sample FROM reads GROUP BY sample ORDER BY sum(length(seq)) DESC, sample LIMIT 10)")
q("mp_9_largest_samples", lambda t: M.largest_samples(t.reads), "reads", "SELECT sample, CAST(sum(length(seq)) AS BIGINT) AS bases FROM reads GROUP BY sample ORDER BY bases DESC, sample LIMIT 10")

# Clusters and reports.  A document's source stands for a cluster.


def _clusters(t: Tables) -> DataFrame:
    return t.dna.select(F.concat_ws("_", "sample", F.pmod("doc_id", F.lit(5)).cast("string")).alias("cluster"), "doc_id", "line", F.col("seq").alias("fwd"))


_RCL = "rc AS (SELECT sample || '_' || (doc_id % 5) AS cluster, doc_id, line, seq AS fwd FROM dna)"
_PROF = "pr AS (SELECT cluster, i AS pos, substr(fwd, i, 1) AS base, count(*) AS n FROM (SELECT cluster, fwd, unnest(range(1, length(fwd) + 1)) AS i FROM rc) GROUP BY 1, 2, 3)"
q("cl_4_count_clusters", lambda t: C.count_clusters(_clusters(t)), "dna", f"WITH {_RCL} SELECT count(DISTINCT cluster) AS clusters FROM rc")
q("cl_5_base_profile", lambda t: C.base_profile(_clusters(t)), "dna", f"WITH {_RCL}, {_PROF} SELECT * FROM pr")
_VAR = "va AS (SELECT cluster, pos, max(CASE WHEN r = 1 THEN n END) AS first, max(CASE WHEN r = 2 THEN n END) AS second FROM (SELECT *, row_number() OVER (PARTITION BY cluster, pos ORDER BY n DESC, base) AS r FROM pr) GROUP BY cluster, pos HAVING max(CASE WHEN r = 2 THEN n END) >= 0.9 * max(CASE WHEN r = 1 THEN n END) AND max(CASE WHEN r = 2 THEN n END) >= 10)"
q("cl_5_variable_columns", lambda t: C.variable_columns(C.base_profile(_clusters(t)), 0.9), "dna", f"WITH {_RCL}, {_PROF}, {_VAR} SELECT * FROM va")
q("cl_6_divide_clusters", lambda t: C.divide_clusters(_clusters(t), 0.9), "dna",
  f"WITH {_RCL}, {_PROF}, {_VAR} SELECT rc.cluster, doc_id, line, fwd, coalesce(string_agg(substr(fwd, pos, 1), '' ORDER BY pos), '') AS allele FROM rc LEFT JOIN va ON rc.cluster = va.cluster GROUP BY rc.cluster, doc_id, line, fwd")
q("cl_7_cluster_consensus", lambda t: C.cluster_consensus(_clusters(t)), "dna",
  f"WITH {_RCL}, {_PROF} SELECT cluster, string_agg(base, '' ORDER BY pos) AS seq FROM (SELECT *, row_number() OVER (PARTITION BY cluster, pos ORDER BY n DESC, base DESC) AS r FROM pr) WHERE r = 1 GROUP BY cluster")


def _paired_clusters(t: Tables) -> DataFrame:
    """Conversation pairs with the lower-case letters as bases, as in dna, in 97 clusters."""
    base = "translate(regexp_replace({0}, '[^a-z]', ''), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC') AS {0}"
    return R.pair_reads(t.mates).selectExpr("ordinal % 97 AS cluster", base.format("fwd"), base.format("rev"))


_BASES = "translate(regexp_replace({0}, '[^a-z]', '', 'g'), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC')"
q("cl_7_paired_consensus", lambda t: C.paired_consensus(_paired_clusters(t)), "pairs",
  f"""WITH m AS (SELECT ordinal % 97 AS cluster, 1 AS side, {_BASES.format('fwd')} AS seq FROM pairs UNION ALL SELECT ordinal % 97, 2, {_BASES.format('rev')} FROM pairs),
  pr AS (SELECT cluster, side, i AS pos, substr(seq, i, 1) AS base, count(*) AS n FROM (SELECT *, unnest(range(1, length(seq) + 1)) AS i FROM m) GROUP BY 1, 2, 3, 4),
  b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cluster, side, pos ORDER BY n DESC, base DESC) AS r FROM pr) WHERE r = 1),
  s AS (SELECT cluster, coalesce(string_agg(base, '' ORDER BY pos) FILTER (side = 1), '') AS fwd, coalesce(string_agg(base, '' ORDER BY pos) FILTER (side = 2), '') AS rev FROM b GROUP BY cluster)
  SELECT cluster, CASE WHEN rev = '' THEN fwd ELSE fwd || repeat('N', 10) || rev END AS seq FROM s""")  # fmt: skip
q("cl_9_union_contigs", lambda t: C.union_contigs(R.relabel_contigs(t.contigs, "A_"), R.relabel_contigs(t.contigs, "B_")).select("contig", "seq"), "contigs", "SELECT 'A_' || contig_no AS contig, seq FROM contigs UNION ALL SELECT 'B_' || contig_no, seq FROM contigs")
q("cl_12_summarise_sweep", lambda t: rounded(M.summarise_sweep(t.hap_stats), "value"), "hap_stats",
  """SELECT 'mean' AS kind, round(avg(n_contigs), 6) AS value, count(*) AS n FROM hap_stats
  UNION ALL SELECT * FROM (SELECT 'count' AS kind, CAST(n_contigs AS DOUBLE) AS value, count(*) AS n FROM hap_stats GROUP BY n_contigs ORDER BY n DESC, value LIMIT 3)
  UNION ALL SELECT * FROM (SELECT 'hundreds' AS kind, round_even(n_contigs / 100, 0) * 100 AS value, count(*) AS n FROM hap_stats GROUP BY 2 ORDER BY n DESC, value LIMIT 3)""")  # fmt: skip
q("rp_1_histogram", lambda t: M.histogram(t.calls, "dp", 1, 0, 30), "calls", "SELECT dp + 0.5 AS bin, count(*) AS n FROM calls WHERE dp BETWEEN 0 AND 30 GROUP BY 1")
q("rp_2_step_report", lambda t: M.step_report(t.sites, V.min_qual(t.sites, 30), "quality"), "sites", "SELECT 'quality' AS label, count(*) AS before, count(CASE WHEN qual >= 30 THEN 1 END) AS after, count(CASE WHEN qual < 30 THEN 1 END) AS removed FROM sites")
q("rp_3_mean_depth_per_site", lambda t: rounded(M.mean_depth_per_site(t.calls, n_samples(t)), "mean_dp"), "sites popmap", "SELECT chrom, pos, round(dp / (SELECT count(*) FROM popmap), 6) AS mean_dp FROM sites")
q("rp_4_top_values", lambda t: M.top_values(t.calls, "gt"), "calls", "SELECT gt AS value, count(*) AS n FROM calls GROUP BY gt ORDER BY n DESC, value LIMIT 3")


# Text formats: the bound tables are written to the shared folder and read again
def _again(t: Tables, write: Callable[[str], None]) -> str:
    path = new_path(t.spark)
    write(path)
    return path


def _vcf(t: Tables) -> tuple[DataFrame, DataFrame]:
    info = ["dp", "ab", "saf", "sar", "srf", "srr", "mqm", "mqmr", "paired", "pairedr"]
    return X.read_vcf(t.spark, _again(t, lambda p: X.write_vcf(t.sites, t.calls, p, info, ["gt", "dp", "ro", "ao"])))


def _typed(t: Tables) -> tuple[DataFrame, DataFrame]:
    calls, form = t.calls.withColumn("ad", F.array("ro", "ao")), ["gt", "dp", "ad"]
    return X.read_typed_vcf(t.spark, _again(t, lambda p: X.write_vcf(t.sites, calls, p, ["dp", "ab", "saf"], form, {"ad": "R"})))


def _halves(t: Tables) -> list[tuple[DataFrame, DataFrame]]:
    own = [t.calls.where(f"sid {x} 20") for x in ("<", ">=")]
    return [(c.groupBy("chrom", "pos").agg(F.sum("dp").alias("dp"), F.count("*").alias("called")), c) for c in own]


q("io_1_fastq", lambda t: X.read_fastq(t.spark, _again(t, lambda p: X.write_fastq(t.fastq, p, "doc_id", "line"))), "fastq",
  "SELECT sample, mate, row_number() OVER (PARTITION BY sample ORDER BY doc_id, line) - 1 AS ordinal, name, seq, qual FROM fastq")
q("io_2_read_vcf_calls", lambda t: _vcf(t)[1].selectExpr("chrom", "pos", "sample", "gt", "a1", "a2", *[f"CAST(data['{k.upper()}'] AS BIGINT) AS {k}" for k in ("dp", "ro", "ao")]), "calls", "SELECT chrom, pos, sample, gt, a1, a2, dp, ro, ao FROM calls")
q("io_3_write_vcf_sites", lambda t: _vcf(t)[0].selectExpr("chrom", "pos", "ref", "array_join(alts, ',') AS alts", "qual", "CAST(info['DP'] AS BIGINT) AS dp", "CAST(info['AB'] AS DOUBLE) AS ab", "CAST(info['SAF'] AS BIGINT) AS saf"), "sites",
  "SELECT chrom, pos, ref, alt1 || CASE WHEN alt2 IS NULL THEN '' ELSE ',' || alt2 END AS alts, qual, dp, ab, saf FROM sites")
q("io_2_typed_vcf_calls", lambda t: _typed(t)[1].selectExpr("chrom", "pos", "sample", "gt", "data.DP AS dp", "data.AD[0] AS ro", "data.AD[1] AS ao"), "calls", "SELECT chrom, pos, sample, gt, dp, ro, ao FROM calls")
q("io_2_typed_vcf_sites", lambda t: _typed(t)[0].selectExpr("chrom", "pos", "info.DP AS dp", "info.AB AS ab", "info.SAF AS saf"), "sites", "SELECT chrom, pos, dp, ab, saf FROM sites")
q("io_4_fasta", lambda t: X.read_fasta(t.spark, _again(t, lambda p: X.write_fasta(t.contigs, p))), "contigs", "SELECT contig, seq FROM contigs")
q("io_5_bed", lambda t: X.read_bed(t.spark, _again(t, lambda p: X.write_bed(_depths(t), p, "depth")), depth="long"), "cov", f"SELECT contig, {_SE}, depth FROM cov")
q("io_6_sam", lambda t: X.read_sam(t.spark, _again(t, lambda p: X.write_sam(t.sequenced.withColumn("rnext", F.lit("=")), p))).select("sample", "flag", "contig", "pos", "mapq", "seq", "qual"), "sequenced", "SELECT sample, flag, contig, pos, mapq, seq, qual FROM sequenced")
q("io_9_uniq", lambda t: X.read_uniq(t.spark, _again(t, lambda p: X.write_uniq(U.unique_per_sample(t.reads), p))), "uniq", "SELECT sample, n, seq FROM uniq")
q("io_11_merge_call_sets", lambda t: X.merge_call_sets(*_halves(t))[0], "calls",
  """WITH h AS (SELECT chrom, pos, sid < 20 AS first, CAST(sum(dp) AS BIGINT) AS dp, count(*) AS called, sum((a1 > 0)::INT + (a2 > 0)::INT) AS ac FROM calls GROUP BY 1, 2, 3)
  SELECT chrom, pos, dp, called FROM (SELECT *, row_number() OVER (PARTITION BY chrom, pos ORDER BY ac DESC, first DESC) AS r FROM h) WHERE r = 1""")  # fmt: skip
_HAP = "concat_ws('\t', locus, ordinal, '-', 3, 40, q, status, '-', 1, 2, comment) AS value"
q("io_12_hap_stats", lambda t: X.read_hap_stats(t.spark, _again(t, lambda p: t.hap_stats.selectExpr(_HAP).write.text(p))).select("locus", "sites", "haplotypes", "prop_haplotyped", "status", "comment"), "hap_stats",
  "SELECT locus, ordinal AS sites, CAST(NULL AS BIGINT) AS haplotypes, q AS prop_haplotyped, status, nullif(comment, '-') AS comment FROM hap_stats")

# Trimming, overlaps, cluster tables, pile-up, decomposition
q("rd_4_trim_reads", lambda t: R.trim_reads(t.fastq.select("sample", "doc_id", "line", "seq", "qual"), min_len=10), "fastq",
  """WITH f AS (SELECT *, length(seq) AS n, least(5, length(seq)) AS w FROM fastq), b AS (SELECT *, ascii(substr(qual, i, 1)) - 33 AS s FROM (SELECT doc_id, line, qual, n, w, unnest(range(1, n + 1)) AS i FROM f)),
  g AS (SELECT *, sum(s) OVER (PARTITION BY doc_id, line ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS total FROM b),
  k AS (SELECT doc_id, line, min(i) AS a, max(i + w) AS e FROM g WHERE i + w <= n + 1 AND total >= 15 * w GROUP BY doc_id, line),
  c AS (SELECT doc_id, line, a, count(CASE WHEN s < 15 THEN 1 END) AS bad, count(*) AS m FROM k JOIN b USING (doc_id, line) WHERE i >= a AND i < e GROUP BY doc_id, line, a)
  SELECT sample, doc_id, line, substr(seq, a, m) AS seq, substr(qual, a, m) AS qual FROM f JOIN c USING (doc_id, line) WHERE 100 * bad <= 50 * m AND m >= 10""")  # fmt: skip


def _mates_of_lines(t: Tables) -> DataFrame:
    """Mates that cover each whole line: its first and its last two thirds (rounded up), so the overlap grows with the line."""
    two = "CAST(ceil(length(seq) * 2 / 3) AS INT)"
    return t.dna.select("sample", "doc_id", "line", F.expr(f"substring(seq, 1, {two})").alias("fwd"), R.revcomp(F.expr(f"right(seq, {two})")).alias("rev"))


_OVERLAPS = """WITH m AS (SELECT sample, doc_id, line, substr(seq, 1, t) AS fwd, right(seq, t) AS other, t FROM (SELECT *, CAST(ceil(length(seq) * 2 / 3) AS BIGINT) AS t FROM dna)),
  o AS (SELECT doc_id, line, n, hamming(right(fwd, n), left(other, n)) AS wrong FROM (SELECT *, unnest(range(10, t + 1)) AS n FROM m)),
  b AS (SELECT doc_id, line, arg_max(n, 1000000 * (n - 2 * wrong) + n) AS n FROM o WHERE wrong <= 0.1::DOUBLE * n AND n > 2 * wrong GROUP BY doc_id, line),
  r AS (SELECT m.*, fwd || substr(other, n + 1) AS seq FROM m LEFT JOIN b USING (doc_id, line))"""
q("rd_9_merge_overlaps", lambda t: R.merge_overlaps(_mates_of_lines(t), 40)[0], "dna", f"{_OVERLAPS} SELECT sample, doc_id, line, seq FROM r WHERE length(seq) >= 40")
q("rd_9_unmerged", lambda t: R.merge_overlaps(_mates_of_lines(t), 40)[1], "dna", f"{_OVERLAPS} SELECT sample, doc_id, line, fwd, {_RC.format('other')} AS rev FROM r WHERE seq IS NULL OR length(seq) < 40")
q("cl_2_cluster_table", lambda t: C.cluster_table(R.glue_pairs(R.pair_reads(t.mates)).select(F.col("ordinal").alias("read_id"), "seq"), R.pair_reads(t.mates).selectExpr("ordinal AS read_id", "ordinal % 97 AS cluster")), "pairs", "SELECT ordinal AS read_id, ordinal % 97 AS cluster, fwd, rev FROM pairs")
q("mp_7_pileup_counts", lambda t: M.pileup_counts(t.sequenced), "pile", "SELECT * FROM pile")


def _called(t: Tables) -> DataFrame:
    pile = M.pileup_counts(t.sequenced).withColumn("pos", F.expr("pos div 100"))  # tens of reads for each position
    pile = written(pile.groupBy("contig", "pos", "sample", "base").agg(F.sum("n").alias("n")))
    ref = pile.select("contig", "pos").distinct().withColumn("ref", F.expr("substring('ACGT', CAST(pos % 4 AS INT) + 1, 1)"))
    return M.call_by_threshold(pile, ref).withColumn("alts", F.array_join("alts", ","))


q("mp_8_call_by_threshold", _called, "pile",
  """WITH p AS (SELECT contig, pos // 100 AS pos, sample, base, CAST(sum(n) AS BIGINT) AS n, substr('ACGT', (pos // 100) % 4 + 1, 1) AS ref FROM pile GROUP BY contig, pos // 100, sample, base),
  c AS (SELECT *, n >= 2 AND n >= 0.1 * cov AS seen FROM (SELECT *, CAST(sum(n) OVER (PARTITION BY contig, pos, sample) AS BIGINT) AS cov FROM p) WHERE cov >= 5),
  s AS (SELECT contig, pos, base, row_number() OVER (PARTITION BY contig, pos ORDER BY sum(n) DESC, base) AS no FROM c WHERE seen AND base <> ref GROUP BY contig, pos, base),
  al AS (SELECT contig, pos, string_agg(base, ',' ORDER BY no) AS alts FROM s WHERE no < 10 GROUP BY contig, pos),
  k AS (SELECT c.*, CASE WHEN c.base = ref THEN 0 ELSE no END AS a, row_number() OVER (PARTITION BY c.contig, c.pos, sample ORDER BY n DESC, c.base) AS r FROM c LEFT JOIN s ON c.contig = s.contig AND c.pos = s.pos AND c.base = s.base WHERE seen),
  g AS (SELECT contig, pos, sample, min(a) || '/' || max(a) AS gt FROM k WHERE r <= 2 GROUP BY contig, pos, sample)
  SELECT d.contig, d.pos, d.sample, cov, ref, coalesce(alts, '') AS alts, gt FROM (SELECT DISTINCT contig, pos, sample, cov, ref FROM c) AS d LEFT JOIN al USING (contig, pos) LEFT JOIN g ON d.contig = g.contig AND d.pos = g.pos AND d.sample = g.sample""")  # fmt: skip
_DEC = "dc AS (SELECT chrom, pos, ref, alt1 AS alt, 1 AS k, qual FROM sites UNION ALL SELECT chrom, pos, ref, alt2, 2, qual FROM sites WHERE alt2 IS NOT NULL)"
q("v_23_decompose_sites", lambda t: V.decompose(t.sites, t.calls)[0].select("chrom", "pos", "origin", "ref", "alt", "qual"), "sites", f"WITH {_DEC} SELECT chrom, pos, pos AS origin, ref, alt, qual FROM dc")
q("v_23_decompose_calls", lambda t: V.decompose(t.sites, t.calls)[1].select("chrom", "pos", "alt", "sample", "gt"), "sites",
  f"WITH {_DEC} SELECT c.chrom, c.pos, alt, sample, CASE WHEN a1 = k THEN 1 ELSE 0 END || '/' || CASE WHEN a2 = k THEN 1 ELSE 0 END AS gt FROM calls AS c JOIN dc ON c.chrom = dc.chrom AND c.pos = dc.pos")


# Clustering by identity: no SQL; tests hold it against one-by-one clustering
#: The reference's clustering tool leaves sequences of 10 bases and less out; here they are clusters of their own.
SHORTEST = 11


def _reads(t: Tables) -> DataFrame:
    return t.dna.selectExpr("concat(doc_id, '_', line) AS id", "seq")


def _assembled(t: Tables) -> DataFrame:
    """Each document's lines as candidates: every third forward, reverse, mixed."""
    kind = "(doc_id + line) % 3"
    return t.dna.selectExpr("doc_id AS cluster", "line AS ordinal", "seq", "length(seq) % 7 AS freq", f"{kind} <> 1 AS fwd", f"{kind} <> 0 AS rev")


q("cl_1_cluster_sequences", lambda t: C.cluster_sequences(_reads(t), shortest=SHORTEST))
q("cl_3_cluster_table_rpe", lambda t: C.cluster_table_rpe(R.glue_pairs(R.pair_reads(t.mates)).select(F.col("ordinal").alias("read_id"), "seq"), shortest=SHORTEST))
q("cl_8_best_contigs", lambda t: C.best_contigs(_assembled(t), 60))
q("cl_10_build_reference", lambda t: C.build_reference(t.dna.selectExpr("concat('ctg_', doc_id, '_', line) AS contig", "seq"), shortest=SHORTEST))
q("cl_11_sweep_reference", lambda t: C.sweep_reference(U.unique_per_sample(t.dna), range(1, 6), range(2, 7), [c / 100 for c in range(80, 100, 2)], shortest=SHORTEST))
