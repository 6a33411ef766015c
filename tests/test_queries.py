"""Every query against its SQL on the smallest tables."""

import hashlib
import importlib.util
import os

import duckdb
import numpy as np
import pytest
from test_clusters import walk

from pyspark.sql import functions as F

from popspark.jobs.queries import ORACLE_SQL, QUERIES, SHORTEST
from popspark.operators import clusters as C
from popspark.operators import reads as R
from popspark.operators import unique as U
from popspark.sources.bindings import Tables

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def con(data):
    c = duckdb.connect()
    for t in TABLES:
        p = f"{data}/{t}.parquet"
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p if os.path.isfile(p) else p + '/*.parquet'}'")
    return c


def same(value):
    return "null" if value is None else f"{float(value):.6g}" if isinstance(value, (int, float)) and not isinstance(value, bool) else str(value)


def best(got, t):
    rows = {}
    for r in t.dna.collect():
        kind = (r.doc_id + r.line) % 3
        rows.setdefault(r.doc_id, []).append((r.line, r.seq, len(r.seq) % 7, kind != 1, kind != 0))
    assert dict(zip(got["cluster"], got["seq"])) == {c: walk(own, 66) for c, own in rows.items()}


def clustered(got, t):
    """Every line once; equal lines together; each is a part of its representative within the edits allowed; no representative is part of an earlier one."""
    seqs = {f"{r.doc_id}_{r.line}": r.seq for r in t.dna.collect()}
    assert sorted(got["id"]) == sorted(seqs)
    seq, rep = got["id"].map(seqs), got["rep_id"].map(seqs)
    assert got.groupby(seq)["cluster"].nunique().max() == 1 and got.groupby("cluster")["rep_id"].nunique().max() == 1
    most = seq.map(lambda s: C.allowed_edits(len(s), 0.9))
    assert (C.edits_up_to(list(seq), list(rep), most.to_numpy()) <= most).all()
    reps = [s for s in sorted(set(rep), key=lambda s: (len(s), hashlib.md5(s.encode()).hexdigest()), reverse=True) if 40 <= len(s) <= 150][:300]
    pairs = [(b, a) for i, a in enumerate(reps) for b in reps[i + 1 :]]  # without any seed rule
    limit = np.array([C.allowed_edits(len(b), 0.9) for b, _ in pairs])
    assert (C.edits_up_to([b for b, _ in pairs], [a for _, a in pairs], limit) > limit).all()


def paired(got, t):
    assert len(got) == R.pair_reads(t.mates).count() and got.groupby("fwd")["cluster"].nunique().max() == 1 and got["cluster"].nunique() < got["fwd"].nunique() + 1


def built(got, t):
    whole = {r.seq for r in t.dna.collect()}
    assert got["contig"].is_unique and all(s.strip("N") in whole or s in whole for s in got["seq"]) and 0 < len(got) <= len(whole)


def swept(got, t):
    """All 250 cells; looser cutoffs leave more sequences, a looser identity fewer clusters; one cell by itself gives the same."""
    cells = {(r.k1, r.k2, round(100 * r.identity)): r.contigs for r in got.itertuples()}
    assert set(cells) == {(k1, k2, c) for k1 in range(1, 6) for k2 in range(2, 7) for c in range(80, 100, 2)}
    assert all(cells[k1, k2, 80] <= cells[k1, k2, 90] <= cells[k1, k2, 98] <= cells[max(1, k1 - 1), max(2, k2 - 1), 98] for k1, k2, _ in cells)
    uniq = t.spark.createDataFrame(t.dna.groupBy("sample", "seq").count().toPandas(), "sample string, seq string, n long")
    for k1, k2, c in ((1, 2, 80), (1, 3, 90), (2, 2, 86)):
        kept = U.filter_k2(U.individuals_per_seq(uniq, k1), k2).select(F.col("seq").alias("contig"), "seq")
        assert C.build_reference(kept, c / 100, shortest=SHORTEST).count() == cells[k1, k2, c]


WITHOUT_SQL = {
    "cl_8_best_contigs": best, "cl_1_cluster_sequences": clustered,
    "cl_3_cluster_table_rpe": paired, "cl_10_build_reference": built, "cl_11_sweep_reference": swept,
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, con, name):
    got = QUERIES[name](spark, data)
    if name not in ORACLE_SQL:
        WITHOUT_SQL[name](got.toPandas(), Tables(spark, data))
        return
    want = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    key = lambda rows: sorted(tuple(map(same, r)) for r in rows)
    assert key(got.select(*[f"`{n}`" for n in names]).collect()) == key(want.fetchall())


def test_entry_lists_all_queries():
    import __spark_entry__ as e

    assert QUERIES.keys() <= e.queries().keys() and ORACLE_SQL.keys() <= e.oracle_sql().keys()
    assert ("pipeline" in e.queries()) == (importlib.util.find_spec("popspark.llm") is not None)
