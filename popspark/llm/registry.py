"""The queries of this folder and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup, fill_in_middle, language_id, media, mixing, packing, resampling, sentence_pieces, sharding, simhash, substring_dedup, url_filter, warc

#: The rules of op2, in the order in which they were given.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(_docs(spark, sf_dir)).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(_pages(spark, sf_dir).select("page_id", "url"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = mixing.mix_sources(_docs(spark, sf_dir))
    return rows.select("doc_id", "size", "source_size", "target", "taken")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_docs(spark, sf_dir), tokenizer_path())


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    model = language_id.fit(docs)
    return language_id.identify(docs.select("doc_id", "text"), model).select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


def op6_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.kd_shards(_docs(spark, sf_dir), shards=16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_resolved(spark, warc.write_archives(_pages(spark, sf_dir)))


def op8_mpeg_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.decode(media.encode(_docs(spark, sf_dir))).drop("stamps", "access_points")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_docs(spark, sf_dir))


def exact_index_withdrawals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents enter the index of op9; then the toxic ones are withdrawn, and all come again: the decisions on these."""
    docs = _docs(spark, sf_dir)
    toxic = spark.read.parquet(f"{sf_dir}/labels.parquet").where("toxic = 1").select("doc_id")
    buckets = max(1, -(-docs.count() // exact_dedup.BUCKET_DIGESTS))
    index, _ = exact_dedup.update_index(None, docs, buckets=buckets)
    return exact_dedup.update_index(index, docs, docs.join(toxic, "doc_id", "left_semi"), buckets=buckets)[1]


def op10_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(_docs(spark, sf_dir))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return resampling.resample(_docs(spark, sf_dir), target).select("doc_id", "n_features", "weight", "score", "rank")


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    restored = fill_in_middle.restore(fill_in_middle.rearrange(_docs(spark, sf_dir)))
    digests = [F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return restored.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = tokenizer_path("piece_bpe_32k.model")
    decoded = sentence_pieces.decode(sentence_pieces.encode(_docs(spark, sf_dir), model), model)
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_substring_dedup, op2_url_filters, op3_source_mixing, op4_best_fit_packing, op5_language_id, op6_kd_sharding, op7_warc_revisits, op8_mpeg_ts, op9_exact_dedup, op10_simhash_components,
        op11_importance_resampling, op12_fill_in_middle, op13_sentencepiece, exact_index_withdrawals,
    )
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_OP1 = rf"""
WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
starts AS (SELECT doc_id, unnest(generate_series(1, len(ws) - 34)) AS i, ws FROM w WHERE len(ws) >= 35),
windows AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 34], ' ')) AS h FROM starts),
repeated AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
hits AS (SELECT DISTINCT doc_id, i FROM windows SEMI JOIN repeated USING (h)),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM hits, range(0, 35) AS r(k)),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS kept FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

_OP2 = r"""
WITH p AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)\A.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)\A.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(action, h, p, rule) AS (VALUES ('allow', 'org', '/', 'org/'), ('block', 'example.org', '/es/', 'example.org/es/'), ('block', 'example.org', '/en/1', 'example.org/en/1'),
                                     ('allow', 'com', '/fr/', 'com/fr/'), ('block', 'com', '/de/', 'com/de/')),
fits AS (SELECT DISTINCT host, path, rule, action FROM (SELECT DISTINCT host, path FROM p) AS d JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, rules.p)),
best AS (SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS verdict FROM fits GROUP BY host, path)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN best USING (host, path)
"""

_OP3 = rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size, md5(concat_ws('|', '42', CAST(doc_id AS VARCHAR), text)) AS place, row_number() OVER (ORDER BY doc_id) AS rid
  FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS n FROM sized GROUP BY source),
weighed AS (SELECT source, source_size, CAST(1 + n % 3 AS BIGINT) AS w FROM sizes),
filled AS (
  SELECT *, sum(source_size) OVER () - sum(3 * source_size) OVER (ORDER BY source_size / w, source NULLS LAST ROWS UNBOUNDED PRECEDING) + 3 * source_size AS rest,
         sum(w) OVER (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS heavier
  FROM weighed),
marked AS (SELECT *, 3 * source_size * heavier <= rest * w AS is_full FROM filled),
goals AS (
  SELECT source, source_size, CASE WHEN is_full THEN CAST(3 * source_size AS DOUBLE)
         ELSE CAST((sum(source_size) OVER () - sum(CASE WHEN is_full THEN 3 * source_size ELSE 0 END) OVER ()) * w AS DOUBLE) / CAST(sum(CASE WHEN is_full THEN 0 ELSE w END) OVER () AS DOUBLE) END AS target
  FROM marked),
laps AS (
  SELECT s.*, source_size, target, lap, (lap * source_size + sum(size) OVER (PARTITION BY s.source, lap ORDER BY place, size, rid ROWS UNBOUNDED PRECEDING)) / target AS finish
  FROM sized AS s JOIN goals ON s.source IS NOT DISTINCT FROM goals.source CROSS JOIN range(0, 3) AS r(lap) WHERE source_size > 0),
run AS (SELECT *, sum(size) OVER (ORDER BY finish, source NULLS LAST, place, size, rid ROWS UNBOUNDED PRECEDING) AS upto FROM laps),
mix AS (SELECT rid, count(*) AS laps FROM run WHERE upto <= (SELECT sum(size) FROM sized) GROUP BY rid)
SELECT doc_id, size, source_size, target, CAST(size * coalesce(laps, 0) AS BIGINT) AS taken
FROM sized AS s JOIN goals ON s.source IS NOT DISTINCT FROM goals.source LEFT JOIN mix USING (rid)
"""

_OP7 = """
WITH p AS (SELECT page_id, sha256(coalesce(html, '')) AS payload_digest, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages),
o AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM o
"""

_OP9 = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256 FROM d WINDOW w AS (PARTITION BY text_sha256)
"""

_WITHDRAWALS = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS sha, EXISTS (SELECT 1 FROM labels AS l WHERE l.doc_id = documents.doc_id AND toxic = 1) AS toxic FROM documents),
k AS (SELECT sha, min(doc_id) AS keep_id, coalesce(bool_or(toxic AND doc_id = m), false) AS gone FROM (SELECT *, min(doc_id) OVER (PARTITION BY sha) AS m FROM d) GROUP BY sha)
SELECT doc_id, keep_id, gone AND doc_id = keep_id AS is_new FROM d JOIN k USING (sha)
"""

_OP11 = r"""
WITH crcs AS (SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t FROM range(256) AS r(i)),
texts AS (SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
targets AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
own AS (SELECT rid, w, count(*) AS n FROM (SELECT rid, unnest(ws) AS w FROM texts) GROUP BY ALL),
towards AS (SELECT w, count(*) AS n FROM (SELECT unnest(ws) AS w FROM targets) GROUP BY ALL),
words AS (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM own UNION SELECT w FROM towards)),
buckets AS (
  SELECT w, xor(list_reduce(list_transform(range(length(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)), lambda c, b: xor(t[1 + (xor(c, b) & 255)], c >> 8), 4294967295), 4294967295) % 10000 AS b
  FROM words, crcs),
s AS (SELECT b, sum(n) AS s FROM own JOIN buckets USING (w) GROUP BY b), t AS (SELECT b, sum(n) AS t FROM towards JOIN buckets USING (w) GROUP BY b),
gains AS (
  SELECT b, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM s) + 10000)::DOUBLE / ((s + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM t) + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM s LEFT JOIN t USING (b)),
weights AS (SELECT rid, CAST(sum(n * gain) AS BIGINT) AS weight FROM own JOIN buckets USING (w) JOIN gains USING (b) GROUP BY rid),
scored AS (
  SELECT doc_id, rid, CAST(len(ws) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight, len(ws) >= 20 AS able,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM texts LEFT JOIN weights USING (rid)),
placed AS (SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id) AS place FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= 10 * (SELECT count(*) FROM scored WHERE able) // 100 THEN place END AS rank FROM placed
"""

_OP12 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^
]*
|[^
]+') AS u, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
e AS (SELECT *, CAST(len(u) AS BIGINT) AS n, list_transform(range(4), lambda i: CAST('0x' || substr(h, 8 * i + 1, 8) AS BIGINT)) AS r FROM d),
f AS (
  SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS low, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS high,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR r[3] % 100 >= 100 THEN 'plain' WHEN r[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM e),
g AS (SELECT *, array_to_string(u[1:low], '') AS p, array_to_string(u[low + 1:high], '') AS m, array_to_string(u[high + 1:n], '') AS s FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE text END) AS output_sha256, sha256(text) AS restored_sha256
FROM g
"""

ORACLE_SQL: dict[str, str] = {"op1_substring_dedup": _OP1, "op2_url_filters": _OP2, "op3_source_mixing": _OP3, "op7_warc_revisits": _OP7, "op9_exact_dedup": _OP9, "op11_importance_resampling": _OP11, "op12_fill_in_middle": _OP12, "exact_index_withdrawals": _WITHDRAWALS}
