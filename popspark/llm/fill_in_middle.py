"""Fill-in-middle: documents cut in three, with the middle moved to the end, in Spark SQL functions alone.

A pattern makes the array of units.  Slices of the sha256 of seed and id, as numbers, say where to cut and how to arrange; slices of
the array, joined, are the pieces.  The text comes back from the output alone, by its sentinels.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Units: lines with their ends, words with the white space before them, or code points.
LINES, WORDS, CHARACTERS = r"[^\n]*\n|[^\n]+", r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", r"(?s)."
SENTINELS = ("<P>", "<S>", "<M>")


def _check(sentinels: tuple[str, str, str]) -> None:
    """Sentinels must be told apart wherever they stand: none begins with what another, or itself, ends with."""
    for a in sentinels:
        if not a:
            raise ValueError("a sentinel is empty")
        for b in sentinels:
            whole = a if a != b else a[1:]
            if sentinels.count(a) > 1 or (a != b and b in a) or any(whole.endswith(b[:k]) for k in range(1, len(b))):
                raise ValueError(f"sentinels {a} and {b} overlap")


def _draws(seed: int) -> Column:
    """Four numbers below 2**32: the first groups of 8 digits of the sha256 of seed and doc_id (null: empty)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    digest = F.sha2(text.cast("binary"), 256)
    return F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.conv(F.substring(digest, i * 8 + 1, F.lit(8)), 16, 10).cast("long"))


def _joined(units: Column, after: Column, upto: Column) -> Column:
    return F.array_join(F.slice(units, after + 1, upto - after), "")


def rearrange(docs: DataFrame, seed: int = 7, rate: int = 100, spm_rate: int = 50, unit: str = LINES, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars and output of every row of docs (doc_id, text).

    The text's units are the matches of the pattern `unit`, which must cover it; two cuts anywhere between them, ends included, make
    prefix, middle and suffix.  `rate` of 100 documents are rearranged, of these `spm_rate` of 100 in the form spm, suffix first, the others
    as psm, prefix first; each piece follows its sentinel (of prefix, suffix and middle, in this order), and the middle comes last.  The form is
    plain, the output the text itself, if the text is empty, is not drawn, or has a sentinel in it, as it could not come back then.

    A null text is empty, and a null doc_id draws as an empty one.  Repeated rows give the same output again.  A text is taken whole;
    it and its units must fit a task.  An empty table gives no rows; other columns are ignored.
    """
    _check(sentinels)
    prefix_mark, suffix_mark, middle_mark = sentinels
    text, n = F.col("text"), F.col("n")
    cut = F.col("draws")
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), _draws(seed).alias("draws"))
    own = own.withColumn("units", F.regexp_extract_all("text", F.lit(unit), F.lit(0))).withColumn("n", F.size("units").cast("long"))
    own = own.withColumn("one", cut[0] % (n + 1)).withColumn("two", cut[1] % (n + 1))
    marked = F.lit(False)
    for mark in sentinels:
        marked = marked | F.contains(text, F.lit(mark))
    form = F.when((text == "") | marked | (cut[2] % 100 >= rate), "plain").when(cut[3] % 100 < spm_rate, "spm").otherwise("psm")
    own = own.withColumn("form", form).withColumn("low", F.least("one", "two").cast("int")).withColumn("high", F.greatest("one", "two").cast("int"))
    units, low, high = F.col("units"), F.col("low"), F.col("high")
    own = own.withColumn("prefix", _joined(units, F.lit(0), low)).withColumn("middle", _joined(units, low, high)).withColumn("suffix", _joined(units, high, n.cast("int")))
    psm = F.concat(F.lit(prefix_mark), "prefix", F.lit(suffix_mark), "suffix", F.lit(middle_mark), "middle")
    spm = F.concat(F.lit(suffix_mark), "suffix", F.lit(prefix_mark), "prefix", F.lit(middle_mark), "middle")
    moved = F.col("form") != "plain"
    chars = lambda piece: F.when(moved, F.char_length(piece).cast("long"))
    output = F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm).otherwise(text)
    return own.select("doc_id", "n", "form", chars("prefix").alias("prefix_chars"), chars("middle").alias("middle_chars"), output.alias("output"))


def restore(rearranged: DataFrame, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """rearranged (form, output and any other columns but _pieces) with restored, the text before it was rearranged.

    A null form or output gives a null.
    """
    _check(sentinels)
    pieces = F.split("output", "|".join(re.escape(m) for m in sentinels))
    first, second, middle = (F.get("_pieces", F.lit(i)) for i in (1, 2, 3))
    text = F.when(F.col("form") == "psm", F.concat(first, middle, second)).when(F.col("form") == "spm", F.concat(second, middle, first)).when(F.col("form") == "plain", F.col("output"))
    return rearranged.withColumn("_pieces", F.when(F.col("form") != "plain", pieces)).withColumn("restored", text).drop("_pieces")
