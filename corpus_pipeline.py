"""A training corpus from documents: language ID, exact dedup, SimHash near-dedup, mixing and packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.  Common
to all stages: columns of docs beyond these are left out, an empty table gives no rows, texts of any length are taken
whole, and rows are told apart by a row key, so that null and repeated ids are no different from others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from popspark.llm import exact_dedup, language_id, mixing, packing, simhash
from popspark.llm._common import durable
from popspark.llm.registry import tokenizer_path
from popspark.shipping import ship

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _keyed(docs: DataFrame) -> DataFrame:
    """The columns of documents and rid, a key of the row; written, so that it stays as it is."""
    return durable(docs.select(*COLUMNS).withColumn("rid", F.monotonically_increasing_id()))


def _only(keyed: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows whose key is in kept(rid)."""
    return keyed.join(kept.select("rid"), "rid", "left_semi").select(*COLUMNS)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is found, with that language as lang; those without a text or a letter go.

    A wrong or null lang is replaced by the model's.  Without any labelled row there is no model, and all rows go.
    """
    docs = docs.select(*COLUMNS)
    found = language_id.identify(docs, language_id.fit(docs))
    return found.where("lang_pred <> 'und'").withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one with the smallest id (null ids come last), once if its row repeats.

    Null and empty texts are equal to each other.
    """
    keyed = _keyed(docs)
    return _only(keyed, exact_dedup.exact_dedup(keyed, key="rid").where("kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash component: the one with the smallest id (null ids come last; of rows that share it, one).

    Null, empty and blank texts have fingerprint zero, and are near copies of each other.
    """
    keyed = _keyed(docs)
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), "rid")
    found = simhash.simhash_roots(keyed.select(place.alias("doc_id"), "text"))
    return _only(keyed, found.groupBy("root").agg(F.min("doc_id").alias("key")).select("key.rid"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, by row.

    Null texts and texts without words have no size: they stay as often as their place in the queue says.  A null source
    is a source.
    """
    keyed = _keyed(docs)
    rows, _ = mixing.mix_sources(keyed, key="rid")
    own = keyed.join(rows.where("laps > 0").select("rid", "laps"), "rid")
    return own.withColumn("lap", F.explode(F.sequence(F.lit(1), F.col("laps")))).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in token sequences.

    A null text is empty: one piece, the id 0.  Repeated rows are packed as often as they occur.
    """
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [(f.__name__, lambda spark, docs, sf_dir, f=f: f(ship(spark), docs, sf_dir)) for f in (identify_language, drop_copies, drop_near_copies, mix, pack)]

#: The model and the fingerprints have no SQL form; tests/llm/test_pipeline.py holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
