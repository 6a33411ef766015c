"""The pipeline's stages against plain Python, and the queries' SQL against Spark."""

import hashlib
import re
from collections import Counter, defaultdict

import duckdb
import pytest
from test_dedup import brute_components, brute_fingerprint

import corpus_pipeline
from popspark.llm import language_id, mixing
from popspark.llm.registry import ORACLE_SQL, QUERIES

COLUMNS = corpus_pipeline.COLUMNS


def as_rows(df):
    assert df.columns == COLUMNS
    return [tuple(r) for r in df.collect()]


def test_stages(spark, docs):
    stage = dict(corpus_pipeline.STAGES)
    assert list(stage) == ["identify_language", "drop_copies", "drop_near_copies", "mix", "pack"]
    now = stage["identify_language"](spark, docs, "")
    rows = as_rows(now)
    model = language_id.fit(docs.select(*COLUMNS))
    want = Counter()
    for r in docs.select(*COLUMNS).collect():
        lang = language_id.predict(model, [r.text])[0][0]
        assert (lang == "und") == (not any(map(str.isalpha, r.text or "")))
        want[r.doc_id, r.text, lang, r.source, r.n_chars] += lang != "und"
    assert Counter(rows) == +want
    now = corpus_pipeline.durable(now)
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", r[1])].append(r)
    now = corpus_pipeline.durable(stage["drop_copies"](spark, now, ""))
    kept = as_rows(now)
    order = lambda r: (r[0] is None, r[0] or 0)
    assert Counter((r[0], re.sub(r"[\x20\x09-\x0D]+", " ", r[1])) for r in kept) == Counter((min(own, key=order)[0], text) for text, own in groups.items())
    ids, fps = [r[0] for r in kept], [brute_fingerprint(r[1]) for r in kept]
    now = corpus_pipeline.durable(stage["drop_near_copies"](spark, now, ""))
    rows = as_rows(now)
    stay = {i for i, c in zip(ids, brute_components(fps, ids)) if i == c}
    assert Counter(rows) == Counter(r for r in kept if r[0] in stay) and len(rows) < len(kept)
    laps = Counter()
    for r in mixing.mix_sources(now)[0].collect():
        laps[r.place] = max(laps[r.place], r.laps)
    now = corpus_pipeline.durable(stage["mix"](spark, now, ""))
    mixed = Counter(as_rows(now))
    place = lambda r: hashlib.md5(f"42|{r[0]}|{r[1]}".encode()).hexdigest()
    assert {r[0]: n for r, n in mixed.items() if r[0] is not None} == {r[0]: laps[place(r)] for r in rows if r[0] is not None and laps[place(r)]}
    pieces = stage["pack"](spark, now, "").collect()
    assert Counter(r.doc_id for r in pieces if r.piece == 0) == sum((Counter({r[0]: n}) for r, n in mixed.items()), Counter())


def test_stages_of_no_rows_and_of_odd_rows(spark, docs, nothing):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, "").count() == 0, name
    odd = [(None, None, None, None, None)] * 3 + [(None, "", None, None, None), (None, "a b", None, None, 1), (7, "a  b", None, "x", 2), (7, "a  b", None, "x", 2), (3, "word " * 40_000, None, "x", 3)]
    odd = spark.createDataFrame([(*r, "v") for r in odd], "doc_id long, text string, lang string, source string, n_chars long, RID string")
    stage = dict(corpus_pipeline.STAGES)
    assert stage["identify_language"](spark, odd, "").count() == 0  # nothing to learn from
    assert sorted((r.doc_id or -1, len((r.text or "").split())) for r in stage["drop_copies"](spark, odd, "").collect()) == [(-1, 0), (3, 40_000), (7, 2)]
    assert sorted((r.doc_id or -1, len((r.text or "").split())) for r in stage["drop_near_copies"](spark, odd, "").collect()) == [(-1, 0), (3, 40_000), (7, 2)]
    assert stage["mix"](spark, odd, "").columns == COLUMNS
    pieces = stage["pack"](spark, odd, "").collect()
    assert sum(r.piece == 0 for r in pieces) == 8


def test_mix_counts_rows_that_repeat_one_by_one(spark):
    rows = [(5, "x y", "a"), (5, "x y", "b"), (5, "x y", "b"), (None, "5|x y", "b"), (None, "x", "a")] + [(i, "w " * 9, "c") for i in range(20)]
    docs = spark.createDataFrame([(i, t, "en", s, 1) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    mixed = Counter((r.doc_id, r.text, r.source) for r in dict(corpus_pipeline.STAGES)["mix"](spark, docs, "").collect())
    laps = Counter()
    for r in mixing.mix_sources(docs)[0].collect():
        laps[r.doc_id, r["size"], r.source] += r.laps
    got = Counter()
    for (i, t, s), n in mixed.items():
        got[i, len(t.split()), s] += n
    assert got == +laps


def test_run(spark, data):
    out = corpus_pipeline.run(spark, data).collect()
    spans = defaultdict(list)
    for r in out:
        spans[r.sequence_id].append((r.offset, r.length))
    assert out and all(sum(n for _, n in own) <= 2048 for own in spans.values())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, data, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    key = lambda rows: sorted(map(repr, rows))
    want = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    got = QUERIES[name](spark, data)
    assert sorted(names) == sorted(got.columns)
    assert key(tuple(r) for r in got.select(*names).collect()) == key(tuple(r) for r in want.fetchall())
