"""Queries that take whole tables: nothing of their input is left out."""

from pyspark.sql import functions as F

from popspark.jobs.queries import QUERIES
from popspark.operators import clusters as C
from popspark.operators import intervals as I
from popspark.sources.bindings import Tables


def test_coverage_and_intersection_have_all_contigs_and_samples(spark, data):
    iv = I.to_intervals(Tables(spark, data).aln)
    rows, contigs, samples = iv.agg(F.count("*"), F.count_distinct("contig"), F.count_distinct("sample")).first()
    merged = I.merge_intervals(iv).count()
    depth = QUERIES["iv_6_coverage_by_interval"](spark, data).agg(F.count("*"), F.sum("depth"), F.count_distinct("contig")).first()
    assert tuple(depth) == (merged * samples, rows, contigs)  # each alignment lies in one merged interval
    assert sorted(map(tuple, QUERIES["iv_12_intersect_intervals"](spark, data).select("sample", "contig", "start", "end").collect())) == sorted(map(tuple, iv.select("sample", "contig", "start", "end").collect()))


def test_profiles_have_every_base_of_every_line(spark, data):
    dna = Tables(spark, data).dna
    bases, longest = dna.agg(F.sum(F.length("seq")), F.max(F.length("seq"))).first()
    assert tuple(QUERIES["cl_5_base_profile"](spark, data).agg(F.sum("n"), F.max("pos")).first()) == (bases, longest)
    assert QUERIES["cl_7_cluster_consensus"](spark, data).agg(F.max(F.length("seq"))).first()[0] == longest
    own = QUERIES["cl_6_divide_clusters"](spark, data)
    assert tuple(own.agg(F.count("*"), F.sum(F.length("fwd"))).first()) == (dna.count(), bases)
    assert own.where("length(allele) > 60").count() > 0


def test_mates_cover_whole_lines(spark, data):
    lines = Tables(spark, data).dna.where("length(seq) >= 40")
    merged = QUERIES["rd_9_merge_overlaps"](spark, data).withColumnRenamed("seq", "got")
    whole, long_ones = lines.join(merged, ["sample", "doc_id", "line"]).agg(F.count_if(F.expr("got = seq")), F.count_if(F.expr("got = seq AND length(seq) > 90"))).first()
    assert whole >= 0.95 * lines.count() and long_ones > 0.95 * lines.where("length(seq) > 90").count()


def test_consensus_of_both_mates_is_glued(spark):
    rows = [(1, "ACGT", "TTA"), (1, "ACG", "TTC"), (1, "AGG", "GTC"), (2, "AC", ""), (2, "AG", None), (3, "", "GG")]
    got = C.paired_consensus(spark.createDataFrame(rows, "cluster int, fwd string, rev string")).collect()
    assert {r.cluster: r.seq for r in got} == {1: "ACGT" + "N" * 10 + "TTC", 2: "AG", 3: "N" * 10 + "GG"} and len(got) == 3


def test_hundred_rounds(spark, data):
    pops = Tables(spark, data).popmap.select("pop").distinct().count()
    assert tuple(QUERIES["p_13_resample_pi"](spark, data).agg(F.count("*"), F.max("round")).first()) == (100 * pops, 100)
