"""One row of each group of near copies stays, whatever the ids."""

import corpus_pipeline


def test_repeated_and_null_ids_leave_one_row_a_group(spark):
    a, b, c, d = (" ".join(f"{x}{i * i}" for i in range(40)) for x in "abcd")
    rows = [(1, a), (1, b), (0, b.upper()), (2, a.upper()), (None, c), (None, c.upper()), (None, b.title()), (None, d), (7, d.upper()), (8, b + "  "), (8, b + " ")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.drop_near_copies(spark, docs, "").collect()
    assert sorted((r.text[0].lower(), -1 if r.doc_id is None else r.doc_id) for r in got) == [("a", 1), ("b", 0), ("c", -1), ("d", 7)]
    again = spark.createDataFrame([(3, a, "en", "s", 9)] * 3, docs.schema)
    assert corpus_pipeline.drop_near_copies(spark, again, "").count() == 1
