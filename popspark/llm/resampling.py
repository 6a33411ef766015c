"""Importance resampling towards a target distribution, by an external sort-count of hashed n-grams.

Each task writes its documents' features as packed streams: uint16 bucket numbers, one after another, with the offsets of
the documents.  To count, a task sorts a stream and run-length encodes it; runs are merged there and added up in Spark.
The log ratio of the two distributions is one number for each bucket; a later pass over the streams gathers these gains and
adds them up between the offsets.  Documents are drawn without replacement by the Gumbel top-k rule: highest weight plus noise.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import floor, log
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import durable, slices, string_bytes

PART_ROWS = 50_000
HELD_RUNS = 1 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
#: Bytes of words, in lower case: digits, letters, and all of other code points than ASCII.
_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = _WORD[0x80:] = True


def words_of(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words in lower-case data, and each document's first word (one more at the end)."""
    word = np.concatenate([_WORD[data], [False]])
    begins = word[:-1].copy()
    begins[1:] &= ~word[:-2]
    edges = offsets[(offsets > 0) & (offsets < len(data))]  # a document's first byte begins a word, whatever stands before it
    begins[edges] |= word[edges]
    stops = word[:-1] & ~word[1:]
    stops[edges - 1] |= word[edges - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets)


def _hashes(starts: np.ndarray, ends: np.ndarray, data: np.ndarray) -> np.ndarray:
    """CRC-32 of data between starts and ends, which do not overlap.  Each different text is hashed once."""
    if not len(starts):
        return np.zeros(0, np.int64)
    offsets = np.empty(2 * len(starts) + 1, np.int32 if len(data) < 1 << 31 else np.int64)  # texts and what lies between them
    offsets[:-1:2], offsets[1::2], offsets[-1] = starts, ends, ends[-1]
    kind = pa.binary() if offsets.dtype == np.int32 else pa.large_binary()
    texts = pa.Array.from_buffers(kind, len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
    return np.array([crc32(x) for x in texts.dictionary.to_pylist()], np.int64)[texts.indices.to_numpy()[::2]]


def features_of(offsets: np.ndarray, data: np.ndarray, order: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The stream of buckets of all runs of 1 to `order` words, the documents' offsets in it, and their numbers of words."""
    data = _LOWER[data]
    starts, ends, first = words_of(offsets, data)
    n = np.diff(first)
    streams = [_hashes(starts, ends, data)]
    own = [np.repeat(np.arange(len(n)), n)]
    if order > 1:  # the words once more, joined by single spaces: a run of words is a run of bytes
        sizes = ends - starts
        till = np.cumsum(sizes + 1) - 1
        joined = np.full(int(till[-1]) + 1 if len(till) else 0, 0x20, np.uint8)
        inside = np.arange(int(sizes.sum())) + np.repeat(np.arange(len(sizes)), sizes)
        joined[inside] = data[np.arange(len(inside)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts, sizes)]
        view, begin = memoryview(joined), till - sizes
        for k in range(2, order + 1):
            at = np.flatnonzero(np.arange(len(starts)) + k <= np.repeat(first[1:], n))
            streams.append(np.fromiter((crc32(view[a:b]) for a, b in zip(begin[at].tolist(), till[at + k - 1].tolist())), np.int64, len(at)))
            own.append(own[0][at])
    stream, owner = np.concatenate(streams) % buckets, np.concatenate(own)
    if order > 1:
        stream = stream[np.argsort(owner, kind="stable")]
    return stream.astype(np.uint16), np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(n)))]).astype(np.int64), n


def write_streams(docs: DataFrame, order: int = 1, buckets: int = 10_000, batch_bytes: int = 4 << 20) -> DataFrame:
    """ids, words, offsets and stream of runs of documents (about batch_bytes of text, a longer text whole), written to the shared folder.

    stream holds little-endian uint16 buckets, offsets where each document's begin (and the end) in it.
    """
    if not 1 <= buckets <= 1 << 16:
        raise ValueError("a bucket is a uint16")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", batch_bytes):
            stream, offsets, words = features_of(*string_bytes(batch.column(1)), order, buckets)
            ids = batch.column(0)
            yield pa.record_batch({
                "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                "words": pa.array([words.astype(np.int64)], pa.list_(pa.int64())),
                "offsets": pa.array([offsets], pa.list_(pa.int64())),
                "stream": pa.array([stream.astype("<u2").tobytes()], pa.binary()),
            })

    kind = docs.schema["doc_id"].dataType.simpleString()
    return durable(docs.select("doc_id", "text").mapInArrow(pack, f"ids array<{kind}>, words array<bigint>, offsets array<bigint>, stream binary"))


def run_lengths(values: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Different values in order and how often each occurs (or the sum of its counts)."""
    if not len(values):
        return values, np.zeros(0, np.int64)
    order = None if counts is None else np.argsort(values, kind="stable")
    values = np.sort(values, kind="stable") if order is None else values[order]
    at = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    return values[at], np.diff(np.append(at, len(values))) if order is None else np.add.reduceat(counts[order], at)


def count_buckets(streams: DataFrame) -> DataFrame:
    """bucket and n, the features in it: streams are sorted and run-length encoded; a task sends one row for each bucket at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, counts, held = [], [], 0
        for batch in batches:
            for packed in batch.column(0):
                v, c = run_lengths(np.frombuffer(packed.as_buffer(), "<u2"))
                values.append(v)
                counts.append(c)
                held += len(v)
                if held > HELD_RUNS:
                    v, c = run_lengths(np.concatenate(values), np.concatenate(counts))
                    values, counts, held = [v], [c], len(v)
        if held:
            v, c = run_lengths(np.concatenate(values), np.concatenate(counts))
            yield pa.record_batch({"bucket": pa.array(v, pa.int32()), "n": pa.array(c, pa.int64())})

    return streams.select("stream").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """floor(1000 * ln of the target's share of each bucket by the corpus'), both with one feature more in each.

    Of corpus and target, counts by bucket, a row for each bucket comes to the driver: 65,536 at most.
    """
    s, t = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for out, counts in ((s, corpus), (t, target)):
        for bucket, n in counts.collect():
            out[bucket] = n
    in_s, in_t = float(s.sum() + buckets), float(t.sum() + buckets)
    return np.array([floor(1000 * log((b + 1.0) * in_s / ((a + 1.0) * in_t))) for a, b in zip(s.tolist(), t.tolist())], np.int64)


def weigh(streams: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features and weight, the sum of the gains of a document's features (none: 0)."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, words, offsets, packed = (batch.column(c)[i] for c in range(4))
                offsets = offsets.values.to_numpy()
                n = np.diff(offsets)
                weight, some = np.zeros(len(n), np.int64), n > 0  # reduceat has no empty runs
                if some.any():
                    weight[some] = np.add.reduceat(gain[np.frombuffer(packed.as_buffer(), "<u2")], offsets[:-1][some])
                yield pa.record_batch({"doc_id": ids.values, "n_words": words.values, "n_features": pa.array(n, pa.int64()), "weight": pa.array(weight, pa.int64())})

    kind = streams.schema["ids"].dataType.elementType.simpleString()
    return streams.select("ids", "words", "offsets", "stream").mapInArrow(gather, f"doc_id {kind}, n_words long, n_features long, weight long")


def gumbel(seed: int) -> Column:
    """floor(1000 * Gumbel noise) from the sha256 of seed and doc_id (null: empty)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def ranked(scored: DataFrame, drawn: int, width: int = 64) -> DataFrame:
    """scored (a written table with score, doc_id, rid and able) with rank, from 1, of the `drawn` highest scores among able rows; else null.

    A histogram of scores in steps of `width` finds where the draw ends.  The rows down to there are ranked by a range sort,
    whose parts are counted; so one score's rows may lie in many parts.
    """
    none = scored.withColumn("rank", F.lit(None).cast("long"))
    if not drawn:
        return none
    step = F.floor(F.col("score") / width)
    counts = scored.where("able").groupBy(step.alias("step")).agg(F.count("*").alias("c"))
    above = F.sum("c").over(W.orderBy(F.desc("step"))) - F.col("c")
    last = counts.withColumn("above", above).where(F.col("above") < drawn).agg(F.min("step")).first()[0]
    near = F.col("able") & (step >= last)
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("rid")]
    ranged = scored.where(near).repartitionByRange(max(1, -(-2 * drawn // PART_ROWS)), *order)
    ranged = durable(ranged.withColumn("part", F.spark_partition_id()))
    parts = ranged.groupBy("part").agg(F.count("*").alias("c"))
    parts = parts.select("part", (F.sum("c").over(W.orderBy("part")) - F.col("c")).alias("before"))
    rank = F.col("before") + F.row_number().over(W.partitionBy("part").orderBy(*order))
    found = ranged.join(parts, "part").withColumn("rank", rank).withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return none.where(~near).unionByName(found.drop("part", "before"))


def resample(docs: DataFrame, target: DataFrame, order: int = 1, buckets: int = 10_000, least_words: int = 20, percent: int = 10, seed: int = 2024) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every row of docs (doc_id, text), drawn towards the texts of target (text).

    Words are runs of digits, letters and code points beyond ASCII, after lower-casing A to Z; features are runs of 1 to `order`
    words, joined by one space, repeats counted, in `buckets` (65,536 at most) by their CRC-32.  score is weight plus Gumbel noise; of the rows
    with `least_words` words, `percent` of 100, rounded down, are drawn: the highest scores, ties to the smaller doc_id (null last; then
    to any).  rank is the place among them, else null.

    Null and empty texts have no features, and weight 0.  Repeated rows are rows of their own; with their ids they share the
    noise.  A text of any length is one entry of a stream.  An empty docs gives no rows; an empty target counts as one that has every bucket
    alike.  Other columns are ignored.
    """
    streams = write_streams(docs, order, buckets)
    towards = write_streams(target.select(F.lit(0).alias("doc_id"), "text"), order, buckets)
    gain = gains(count_buckets(streams), count_buckets(towards), buckets)
    scored = weigh(streams, gain).withColumn("score", F.col("weight") + gumbel(seed)).withColumn("able", F.col("n_words") >= least_words)
    scored = durable(scored.withColumn("rid", F.monotonically_increasing_id()))
    return ranked(scored, percent * scored.where("able").count() // 100).drop("able", "rid")
