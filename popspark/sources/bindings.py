"""Reads, alignments, sites and genotype calls derived from the general tables, so that every operator has whole tables to run on.

All arithmetic is on integers (or floors of doubles), so any engine gets the same rows.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SITE = ["chrom", "pos"]


class Tables:
    """The bound tables of one folder; each is a plan, nothing is computed here."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def calls(self) -> DataFrame:
        """chrom, pos, sample, pop, sid, pk, dp, a1, a2, gt, ro, ao: one row for each site and sample with a genotype.

        Sites with two alternates (pk % 10 = 0) have alleles 0 to 2, the others 0 and 1.
        """
        line = self.read("lineitem").selectExpr("l_partkey AS pk", "l_orderkey % 40 AS sid", "l_orderkey AS ok", "CAST(floor(l_quantity) AS BIGINT) AS qty", "CAST(l_linenumber AS BIGINT) AS ln", "l_suppkey AS sk")
        sums = line.groupBy("pk", "sid").agg(F.expr("sum(qty) % 37 AS dp"), F.expr("sum(ln + ok) % 11 AS h1"), F.expr("sum(3 * ln + sk) % 11 AS h2"))
        alleles = sums.selectExpr("*", *[f"CAST(if({h} < pk % 9, if(pk % 10 = 0, 1 + {h} % 2, 1), 0) AS BIGINT) AS {a}" for h, a in (("h1", "a1"), ("h2", "a2"))])
        refs = "(if(a1 = 0, 1, 0) + if(a2 = 0, 1, 0))"
        return alleles.selectExpr(
            "concat('ctg_', pk div 20) AS chrom", "1 + (pk % 20) * 12 + (pk * 7) % 11 AS pos", "concat('P', sid % 4, '_', sid) AS sample", "concat('P', sid % 4) AS pop", "sid", "pk", "dp", "a1", "a2",
            "concat(a1, '/', a2) AS gt", f"dp * {refs} div 2 AS ro", f"dp - dp * {refs} div 2 AS ao",
        )

    @cached_property
    def sites(self) -> DataFrame:
        """chrom, pos, pk, ref, alts, qual, filter and INFO columns of each site."""
        depth = self.calls.groupBy("pk").agg(F.sum("dp").alias("dp"))
        base = "substring('ACGT', CAST((pk + {}) % 4 AS INT) + 1, 1)"
        first = f"concat({base.format(1)}, if(pk % 13 = 0, {base.format(0)}, ''))"
        return depth.selectExpr(
            "concat('ctg_', pk div 20) AS chrom", "1 + (pk % 20) * 12 + (pk * 7) % 11 AS pos", "pk", f"{base.format(0)} AS ref",
            f"if(pk % 10 = 0, array({first}, {base.format(2)}), array({first})) AS alts", "(pk * 37 % 1000) / 10 AS qual", "CAST(array() AS ARRAY<STRING>) AS filter", "dp",
            "(pk % 101) / 100 AS ab", "pk * 13 % 211 AS saf", "pk % 3 AS sar", "pk * 17 % 223 AS srf", "pk % 2 AS srr", "20 + pk % 41 AS mqm", "20 + pk * 3 % 41 AS mqmr", "(pk % 21) / 20 AS paired", "(pk * 5 % 21) / 20 AS pairedr",
        )

    @cached_property
    def popmap(self) -> DataFrame:
        return self.read("lineitem").selectExpr("l_orderkey % 40 AS sid").distinct().selectExpr("concat('P', sid % 4, '_', sid) AS sample", "concat('P', sid % 4) AS pop")

    @cached_property
    def reads(self) -> DataFrame:
        """sample, doc_id, line, seq: a read for each line of each document."""
        docs = self.read("documents").select("source", "doc_id", F.posexplode(F.split("text", "\n")).alias("line", "seq"))
        return docs.selectExpr("source AS sample", "doc_id", "CAST(line AS BIGINT) AS line", "seq")

    @cached_property
    def dna(self) -> DataFrame:
        """reads with the lower-case letters of each line as bases; lines without one are left out."""
        letters = F.regexp_replace("seq", "[^a-z]", "")
        return self.reads.withColumn("seq", F.translate(letters, "abcdefghijklmnopqrstuvwxyz", "ACGTACGTACGTACGTACGTACGTAC")).where("seq <> ''")

    @cached_property
    def mates(self) -> DataFrame:
        """sample, mate, ordinal, name, seq: conversation turns as mates 1 (even turn) and 2 (odd turn)."""
        return self.read("conversations").selectExpr("concat('S', conv_id % 40) AS sample", "1 + turn % 2 AS mate", "conv_id * 1000 + turn div 2 AS ordinal", "concat('r', conv_id, '_', 1 + turn % 2) AS name", "text AS seq")

    @cached_property
    def aln(self) -> DataFrame:
        """Alignments: sample, contig, pos (from 1), mapq, flag, cigar, rnext."""
        return self.read("lineitem").selectExpr(
            "concat('P', l_orderkey % 4, '_', l_orderkey % 40) AS sample", "concat('ctg_', l_suppkey) AS contig", "l_partkey * 40 + l_linenumber + 1 AS pos", "CAST(floor(l_discount * 600) AS BIGINT) AS mapq",
            "CAST(1 + if(l_returnflag = 'R', 2, 0) + if(l_linestatus = 'O', 4, 0) + 16 * (l_linenumber % 2) AS BIGINT) AS flag",
            "concat(5 + 20 * l_linenumber % 30, 'S', CAST(floor(l_quantity) AS BIGINT), 'M') AS cigar", "if(l_linenumber % 3 = 0, concat('ctg_', l_suppkey + 1), '=') AS rnext",
        )

    @cached_property
    def sequenced(self) -> DataFrame:
        """aln with seq and qual, of the clipped and the aligned length."""
        n = "CAST(5 + 20 * l_linenumber % 30 + floor(l_quantity) AS INT)"
        own = self.read("lineitem").selectExpr("*", f"{n} AS n")
        return own.selectExpr(
            "concat('P', l_orderkey % 4, '_', l_orderkey % 40) AS sample", "concat('ctg_', l_suppkey) AS contig", "l_partkey * 40 + l_linenumber + 1 AS pos", "CAST(floor(l_discount * 600) AS BIGINT) AS mapq", "CAST(1 + if(l_linestatus = 'O', 4, 0) AS BIGINT) AS flag",
            "concat(5 + 20 * l_linenumber % 30, 'S', CAST(floor(l_quantity) AS BIGINT), 'M') AS cigar", "substring(repeat('ACGGTTCA', 12), CAST(1 + l_orderkey % 8 AS INT), n) AS seq", "substring(repeat('#*5:?', 20), CAST(1 + l_linenumber % 5 AS INT), n) AS qual",
        )

    @cached_property
    def fastq(self) -> DataFrame:
        """Mate 1 of each dna read, with a name and a quality for each letter."""
        letters = F.regexp_replace("seq", "[^a-z]", "")
        own = self.reads.where(letters != "").select("sample", F.lit(1).alias("mate"), "doc_id", "line", letters.alias("x"))
        return own.selectExpr("sample", "mate", "doc_id", "line", "concat('r', doc_id, '_', line) AS name", "translate(x, 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC') AS seq", "translate(x, 'abcdefghijklmnopqrstuvwxyz', '@ABCDEFGHI+,-./0123456#$%&') AS qual")

    @cached_property
    def contigs(self) -> DataFrame:
        return self.read("supplier").selectExpr("concat('ctg_', s_suppkey) AS contig", "s_suppkey AS contig_no", "translate(regexp_replace(lower(s_name), '[^a-z]', ''), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC') AS seq")

    @cached_property
    def hap_stats(self) -> DataFrame:
        return self.read("part").selectExpr("concat('ctg_', p_partkey div 20) AS locus", "if(p_size % 5 = 0, 'FILTERED', 'PASSED') AS status", "if(p_size % 10 = 0, 'Complex', '-') AS comment", "p_partkey AS ordinal", "(p_partkey * 29 % 100) / 100 AS q", "CAST(900 + p_size AS BIGINT) AS n_contigs")


#: The same tables as common table expressions for DuckDB.
CTE = {
    "calls": """calls AS (SELECT 'ctg_' || (pk // 20) AS chrom, 1 + (pk % 20) * 12 + (pk * 7) % 11 AS pos, 'P' || (sid % 4) || '_' || sid AS sample, 'P' || (sid % 4) AS pop, sid, pk, dp, a1, a2,
  a1 || '/' || a2 AS gt, dp * ((a1 = 0)::BIGINT + (a2 = 0)::BIGINT) // 2 AS ro, dp - dp * ((a1 = 0)::BIGINT + (a2 = 0)::BIGINT) // 2 AS ao
  FROM (SELECT pk, sid, dp, CAST(CASE WHEN h1 >= pk % 9 THEN 0 WHEN pk % 10 = 0 THEN 1 + h1 % 2 ELSE 1 END AS BIGINT) AS a1, CAST(CASE WHEN h2 >= pk % 9 THEN 0 WHEN pk % 10 = 0 THEN 1 + h2 % 2 ELSE 1 END AS BIGINT) AS a2
    FROM (SELECT l_partkey AS pk, l_orderkey % 40 AS sid, CAST(sum(CAST(floor(l_quantity) AS BIGINT)) AS BIGINT) % 37 AS dp, CAST(sum(l_linenumber + l_orderkey) AS BIGINT) % 11 AS h1, CAST(sum(3 * l_linenumber + l_suppkey) AS BIGINT) % 11 AS h2
      FROM lineitem GROUP BY l_partkey, l_orderkey % 40)))""",
    "counts": "counts AS (SELECT chrom, pos, allele, count(*) AS n FROM (SELECT chrom, pos, a1 AS allele FROM calls UNION ALL SELECT chrom, pos, a2 FROM calls) GROUP BY chrom, pos, allele)",
    "sites": """sites AS (SELECT 'ctg_' || (pk // 20) AS chrom, 1 + (pk % 20) * 12 + (pk * 7) % 11 AS pos, pk, substr('ACGT', pk % 4 + 1, 1) AS ref,
  substr('ACGT', (pk + 1) % 4 + 1, 1) || CASE WHEN pk % 13 = 0 THEN substr('ACGT', pk % 4 + 1, 1) ELSE '' END AS alt1, CASE WHEN pk % 10 = 0 THEN substr('ACGT', (pk + 2) % 4 + 1, 1) END AS alt2,
  (pk * 37 % 1000) / 10 AS qual, dp, (pk % 101) / 100 AS ab, pk * 13 % 211 AS saf, pk % 3 AS sar, pk * 17 % 223 AS srf, pk % 2 AS srr, 20 + pk % 41 AS mqm, 20 + pk * 3 % 41 AS mqmr, (pk % 21) / 20 AS paired, (pk * 5 % 21) / 20 AS pairedr
  FROM (SELECT pk, CAST(sum(dp) AS BIGINT) AS dp FROM calls GROUP BY pk))""",
    "popmap": "popmap AS (SELECT 'P' || (sid % 4) || '_' || sid AS sample, 'P' || (sid % 4) AS pop FROM (SELECT DISTINCT l_orderkey % 40 AS sid FROM lineitem))",
    "reads": "reads AS (SELECT source AS sample, doc_id, CAST(generate_subscripts(ls, 1) - 1 AS BIGINT) AS line, unnest(ls) AS seq FROM (SELECT source, doc_id, string_split(text, chr(10)) AS ls FROM documents))",
    "dna": "dna AS (SELECT * FROM (SELECT sample, doc_id, line, translate(regexp_replace(seq, '[^a-z]', '', 'g'), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC') AS seq FROM reads) WHERE seq <> '')",
    "uniq": "uniq AS (SELECT sample, seq, count(*) AS n FROM reads GROUP BY sample, seq)",
    "mates": "mates AS (SELECT 'S' || (conv_id % 40) AS sample, 1 + turn % 2 AS mate, conv_id * 1000 + turn // 2 AS ordinal, 'r' || conv_id || '_' || (1 + turn % 2) AS name, text AS seq FROM conversations)",
    "pairs": "pairs AS (SELECT sample, ordinal, max(CASE WHEN mate = 1 THEN seq END) AS fwd, max(CASE WHEN mate = 2 THEN seq END) AS rev FROM mates GROUP BY sample, ordinal HAVING count(DISTINCT mate) = 2)",
    "aln": """aln AS (SELECT 'P' || (l_orderkey % 4) || '_' || (l_orderkey % 40) AS sample, 'ctg_' || l_suppkey AS contig, l_partkey * 40 + l_linenumber + 1 AS pos, CAST(floor(l_discount * 600) AS BIGINT) AS mapq,
  CAST(1 + CASE WHEN l_returnflag = 'R' THEN 2 ELSE 0 END + CASE WHEN l_linestatus = 'O' THEN 4 ELSE 0 END + 16 * (l_linenumber % 2) AS BIGINT) AS flag, 5 + 20 * l_linenumber % 30 AS clip, CAST(floor(l_quantity) AS BIGINT) AS len,
  CASE WHEN l_linenumber % 3 = 0 THEN 'ctg_' || (l_suppkey + 1) ELSE '=' END AS rnext FROM lineitem)""",
    "iv": "iv AS (SELECT sample, contig, pos - 1 AS s, pos - 1 + len AS e FROM aln)",
    "merged": """merged AS (SELECT contig, min(s) AS s, max(e) AS e FROM (SELECT *, sum(CASE WHEN m IS NULL OR s > m THEN 1 ELSE 0 END) OVER (PARTITION BY contig ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS g
  FROM (SELECT *, max(e) OVER (PARTITION BY contig ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM iv)) GROUP BY contig, g)""",
    "cov": "cov AS (SELECT m.contig, m.s, m.e, count(*) AS depth FROM merged AS m JOIN iv ON m.contig = iv.contig AND iv.s < m.e AND m.s < iv.e GROUP BY m.contig, m.s, m.e)",
    "sequenced": """sequenced AS (SELECT *, substr(repeat('ACGGTTCA', 12), 1 + okey % 8, clip + len) AS seq, substr(repeat('#*5:?', 20), 1 + ln % 5, clip + len) AS qual FROM (
  SELECT 'P' || (l_orderkey % 4) || '_' || (l_orderkey % 40) AS sample, 'ctg_' || l_suppkey AS contig, l_partkey * 40 + l_linenumber + 1 AS pos, CAST(floor(l_discount * 600) AS BIGINT) AS mapq, CASE WHEN l_linestatus = 'O' THEN 5 ELSE 1 END AS flag,
  5 + 20 * l_linenumber % 30 AS clip, CAST(floor(l_quantity) AS BIGINT) AS len, l_orderkey AS okey, l_linenumber AS ln FROM lineitem))""",
    "fastq": """fastq AS (SELECT sample, 1 AS mate, doc_id, line, 'r' || doc_id || '_' || line AS name, translate(x, 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC') AS seq,
  translate(x, 'abcdefghijklmnopqrstuvwxyz', '@ABCDEFGHI+,-./0123456#$%&') AS qual FROM (SELECT *, regexp_replace(seq, '[^a-z]', '', 'g') AS x FROM reads) WHERE x <> '')""",
    "pile": """pile AS (SELECT contig, pos + i AS pos, sample, substr(seq, clip + i + 1, 1) AS base, count(*) AS n FROM (SELECT *, unnest(range(0, len)) AS i FROM sequenced WHERE mapq >= 5 AND flag & 4 = 0)
  WHERE ascii(substr(qual, clip + i + 1, 1)) - 33 >= 5 GROUP BY 1, 2, 3, 4)""",
    "contigs": "contigs AS (SELECT 'ctg_' || s_suppkey AS contig, s_suppkey AS contig_no, translate(regexp_replace(lower(s_name), '[^a-z]', '', 'g'), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC') AS seq FROM supplier)",
    "hap_stats": "hap_stats AS (SELECT 'ctg_' || (p_partkey // 20) AS locus, CASE WHEN p_size % 5 = 0 THEN 'FILTERED' ELSE 'PASSED' END AS status, CASE WHEN p_size % 10 = 0 THEN 'Complex' ELSE '-' END AS comment, p_partkey AS ordinal, (p_partkey * 29 % 100) / 100 AS q, CAST(900 + p_size AS BIGINT) AS n_contigs FROM part)",
}
_NEEDS = {"fastq": ["reads"], "pile": ["sequenced"], "sites": ["calls"], "counts": ["calls"], "dna": ["reads"], "uniq": ["reads"], "pairs": ["mates"], "iv": ["aln"], "merged": ["iv"], "cov": ["merged", "iv"]}


def with_tables(names: str, sql: str) -> str:
    """sql with the named bound tables (and those they need) in front."""
    order: list[str] = []

    def need(name: str) -> None:
        for x in _NEEDS.get(name, []):
            need(x)
        if name not in order:
            order.append(name)

    for name in names.split():
        need(name)
    sql = sql.strip()
    own = next((w for w in ("WITH RECURSIVE ", "WITH ") if sql.upper().startswith(w)), "")
    return (own or "WITH ") + ",\n".join(CTE[n] for n in order) + (",\n" if own else "\n") + sql[len(own) :]
