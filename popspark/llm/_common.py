"""Small helpers that several operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of bytes other than these six; the same set bytes.split() uses.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors share.  Local sessions without one get their own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def durable(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it back: lineage is cut, and a lost executor loses nothing."""
    path = f"{shared_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread_join(rows: DataFrame, found: DataFrame, key: str, n: int, most: int = 50_000) -> DataFrame:
    """rows (n of them, a written table) joined to found, which has each key once.

    A key's rows are dealt to salts, and found is sent to each of those that occur, so a hot key meets in tasks of about `most` rows.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(max(1, -(-n // most)))))
    each = salted.select(key, "_salt").distinct().join(found, key)
    return salted.join(each, [key, "_salt"]).drop("_salt")


def utf8(column: str | Column) -> Column:
    """UTF-8 bytes of a text; null counts as empty."""
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(c, F.lit("")).cast("binary")


def crc32(column: str | Column) -> Column:
    return F.crc32(utf8(column)).cast("long")


def string_bytes(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (one more than rows, from 0) and the bytes of a string column, without a copy.  Null is empty."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(array, pa.ChunkedArray):
        array = pa.concat_arrays(array.chunks) if array.num_chunks else pa.array([], pa.string())
    if array.null_count:
        array = array.fill_null("" if not pa.types.is_binary(array.type) else b"")
    if not len(array):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return at - at[0], raw[at[0] : at[-1]]


def texts_of(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8; null is empty."""
    offsets, data = string_bytes(column)
    whole = data.tobytes()
    return [whole[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows of about `most` bytes of text; a longer text is a run of its own."""
    for batch in batches:
        offsets, _ = string_bytes(batch.column(batch.schema.get_field_index(column)))
        start, n = 0, batch.num_rows
        while start < n:
            end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1)
            yield batch.slice(start, end - start)
            start = end
