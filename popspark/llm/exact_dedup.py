"""Exact dedup with a cuckoo-filter index of live digests.

Texts are reduced to SHA-256 digests in the scan.  Digests are dealt into buckets, and each bucket holds a cuckoo filter:
rows of four 16-bit marks, two rows for each digest, that take insertions and deletions.  A digest that the filter seems
to hold is looked up in the bucket's content, its live digests in order; only there is it told from others with its mark.
When an insertion finds no room, the filter doubles and is filled again from these stored keys.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import durable, spread_join, string_bytes

BUCKET_DIGESTS = 50_000
_SLOTS, _KICKS, _BATCH = 4, 200, 8192
_DIGEST = "S32"


class CuckooFilter:
    """Marks of digests, four in a row (0: free).  All work is on whole arrays of digests."""

    def __init__(self, rows: int = 16):
        self.rows = rows  # a power of two
        self.marks = np.zeros(rows * _SLOTS, np.uint16)

    def places(self, digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The mark of each digest and the first of its rows."""
        words = np.ascontiguousarray(digests).view(np.uint64).reshape(-1, 4)
        return (words[:, 0] % np.uint64(65535) + np.uint64(1)).astype(np.uint16), (words[:, 1] & np.uint64(self.rows - 1)).astype(np.int64)

    def other(self, row: np.ndarray, mark: np.ndarray) -> np.ndarray:
        """The other row of a mark, from either one."""
        return row ^ ((mark.astype(np.int64) * 0x5BD1E995 >> 7) & (self.rows - 1))

    def _slots(self, row: np.ndarray) -> np.ndarray:
        return row[:, None] * _SLOTS + np.arange(_SLOTS)

    def may_hold(self, digests: np.ndarray) -> np.ndarray:
        mark, row = self.places(digests)
        return np.logical_or(*[(self.marks[self._slots(r)] == mark[:, None]).any(1) for r in (row, self.other(row, mark))])

    def _fill(self, row: np.ndarray, old: np.ndarray, new: np.ndarray) -> np.ndarray:
        """In each row one slot that holds old becomes new; which of them found one.  Of those that want one slot, the first gets it."""
        done = np.zeros(len(row), bool)
        while True:
            open_ = self.marks[self._slots(row)] == old[:, None]
            wants = np.flatnonzero(~done & open_.any(1))
            if not len(wants):
                return done
            slot = row[wants] * _SLOTS + open_[wants].argmax(1)
            slot, first = np.unique(slot, return_index=True)
            self.marks[slot] = new[wants[first]]
            done[wants[first]] = True

    def insert(self, digests: np.ndarray) -> bool:
        """False if there was no room for all; the filter must then be filled again."""
        mark, row = self.places(digests)
        for kick in range(_KICKS):
            for _ in range(2):  # into free slots of the one row, then of the other
                left = ~self._fill(row, np.zeros(len(row), np.uint16), mark)
                mark, row = mark[left], self.other(row[left], mark[left])
            if not len(mark):
                return True
            slot = row * _SLOTS + (mark.astype(np.int64) + kick) % _SLOTS  # turn a mark out of the row, one for each slot
            slot, first = np.unique(slot, return_index=True)
            out, mine = self.marks[slot].copy(), np.zeros(len(mark), bool)
            self.marks[slot], mine[first] = mark[first], True
            moved = self.other(slot // _SLOTS, out)
            mark, row = np.concatenate([out, mark[~mine]]), np.concatenate([moved, row[~mine]])
        return False

    def delete(self, digests: np.ndarray) -> None:
        """Take one mark of each digest out; all of them must have been inserted."""
        mark, row = self.places(digests)
        free = np.zeros(len(mark), np.uint16)
        left = ~self._fill(row, mark, free)
        self._fill(self.other(row, mark)[left], mark[left], free[left])


class CuckooIndex:
    """Live digests (keys, in order) with a number each (values), behind a cuckoo filter."""

    def __init__(self, rows: int = 16):
        self.filter, self.keys, self.values = CuckooFilter(rows), np.zeros(0, _DIGEST), np.zeros(0, np.int64)

    def _at(self, digests: np.ndarray) -> np.ndarray:
        """Place in keys, or -1.  What the filter lets through is verified there."""
        out = np.full(len(digests), -1)
        maybe = np.flatnonzero(self.filter.may_hold(digests))
        at = np.searchsorted(self.keys, digests[maybe])
        there = at < len(self.keys)
        there[there] = self.keys[at[there]] == digests[maybe[there]]
        out[maybe[there]] = at[there]
        return out

    def find(self, digests: np.ndarray) -> np.ndarray:
        """The number of each digest, or -1 if it isn't live."""
        at = self._at(digests)
        return np.where(at >= 0, self.values[at], -1) if len(self.keys) else at

    def insert(self, digests: np.ndarray, values: np.ndarray) -> None:
        """New digests, each once."""
        order = np.argsort(digests)
        at = np.searchsorted(self.keys, digests[order])
        self.keys, self.values = np.insert(self.keys, at, digests[order]), np.insert(self.values, at, values[order])
        if not self.filter.insert(digests):
            while True:  # twice the rows, filled again from the stored keys
                self.filter = CuckooFilter(self.filter.rows * 2)
                if len(self.keys) <= self.filter.rows * _SLOTS and self.filter.insert(self.keys):
                    return

    def delete(self, digests: np.ndarray) -> np.ndarray:
        """Take live digests, each once, out; which of them were live."""
        at = self._at(digests)
        self.filter.delete(digests[at >= 0])
        self.keys, self.values = np.delete(self.keys, at[at >= 0]), np.delete(self.values, at[at >= 0])
        return at >= 0


def _from_hex(shas: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(string_bytes(shas)[1].tobytes().decode()), _DIGEST)


def normalised(text: str | Column = "text") -> Column:
    """The text with each run of white space as one space; null is empty."""
    c = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digests(docs: DataFrame, key: str | None = None) -> DataFrame:
    """doc_id, sha (hex) and rid (the column key, if given), which tells rows apart; written once, so that rid stays as it is."""
    rid = F.col(key) if key else F.monotonically_increasing_id()
    return durable(docs.select("doc_id", F.sha2(normalised().cast("binary"), 256).alias("sha"), rid.alias("rid")))


def _partials(hashed: DataFrame, salts: int) -> DataFrame:
    """One row for each digest and salt: a hot digest is summed before it is sent, and has `salts` rows at most."""
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("rid").alias("rid"))
    return hashed.withColumn("salt", F.pmod("rid", F.lit(salts)).cast("int")).groupBy("sha", "salt").agg(F.min(order).alias("least"), F.count("*").alias("n"))


def _index(table: pa.Table) -> pa.Table:
    """Put a bucket's digests into its index as they come.

    A digest that isn't live is inserted; a hit that verifies joins its group.  If its row comes before the one that was
    kept so far, the live digest is deleted and inserted anew with this one.
    """
    least = table["least"].combine_chunks()
    least = pa.table({c: least.field(c) for c in ("none", "id", "rid")})
    order = pc.sort_indices(least, [(c, "ascending") for c in least.column_names]).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    digest, n = _from_hex(table["sha"]), table["n"].to_numpy()
    index, kept, size, used = CuckooIndex(), np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64), 0
    for at in range(0, len(rank), _BATCH):
        own, which = np.unique(digest[at : at + _BATCH], return_inverse=True)
        first, total = np.full(len(own), len(rank)), np.zeros(len(own), np.int64)
        np.minimum.at(first, which, rank[at : at + _BATCH])
        np.add.at(total, which, n[at : at + _BATCH])
        group = index.find(own)
        live = group >= 0
        total[live] += size[group[live]]
        sooner = live.copy()
        sooner[live] = first[live] < kept[group[live]]
        index.delete(own[sooner])
        new = sooner | ~live
        group[new] = used + np.arange(int(new.sum()))
        used += int(new.sum())
        index.insert(own[new], group[new])
        kept[group[new]], size[group] = first[new], total
    group = index.find(digest)
    keep = pa.array(order[kept[group]])
    return pa.table({"sha": table["sha"], "salt": table["salt"], "keep_id": least["id"].take(keep), "keep_rid": least["rid"].take(keep), "group_size": pa.array(size[group])})


def exact_dedup(docs: DataFrame, bucket_digests: int = BUCKET_DIGESTS, key: str | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 for every row, and the column `key` of docs, if given, which must be unique.

    Texts are equal when they agree after each run of white space became one space; null counts as empty.  The row with
    the smallest doc_id stays; null ids come last; among rows that repeat the smallest id, one stays.  An empty table
    gives no rows; other columns are ignored.
    """
    hashed = digests(docs.select("doc_id", "text", *([key] if key else [])), key)
    n = hashed.count()
    salts = max(1, -(-n // bucket_digests))
    partial = _partials(hashed, salts)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    bucketed = partial.withColumn("bucket", F.pmod(F.xxhash64("sha"), F.lit(salts)))
    found = bucketed.groupBy("bucket").applyInArrow(_index, f"sha string, salt int, keep_id {id_type}, keep_rid long, group_size long")
    return (
        hashed.withColumn("salt", F.pmod("rid", F.lit(salts)).cast("int")).join(found, ["sha", "salt"])
        .select("doc_id", "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"), F.col("sha").alias("text_sha256"), *([F.col("rid").alias(key)] if key else []))
    )


def update_index(index: DataFrame | None, added: DataFrame, removed: DataFrame | None = None, buckets: int = 16) -> tuple[DataFrame, DataFrame]:
    """Apply withdrawals, then additions, to a stored index: (new index, decisions on the added rows).

    index has a row for each bucket: bucket, live (digests), rows and marks (of its filter), digests (32 bytes each, in
    order) and ids (of their keepers; None: empty).  Keep the same number of buckets for its life, about one for each
    BUCKET_DIGESTS.  added and removed have doc_id, of one type, and text.  Decisions are doc_id, keep_id and is_new:
    keep_id is the doc_id that was live first, the smallest of its batch.  A digest is withdrawn when the row that keeps it
    is among the removed; other removals change nothing.  Copies within one batch are summed before they are sent.
    """
    spark, id_type = added.sparkSession, added.schema["doc_id"].dataType.simpleString()
    stored = f"bucket long, live long, rows long, marks binary, digests binary, ids array<{id_type}>"
    index = index if index is not None else spark.createDataFrame([], stored)
    batch = digests(added.select("doc_id", "text"))
    events = batch.groupBy("sha").agg(F.min("doc_id").alias("id")).withColumn("gone", F.lit(False))
    if removed is not None:
        out = removed.select(F.sha2(normalised().cast("binary"), 256).alias("sha"), F.col("doc_id").alias("id"))
        events = events.unionByName(out.distinct().withColumn("gone", F.lit(True)))
    events = events.withColumn("bucket", F.pmod(F.xxhash64("sha"), F.lit(buckets)))

    def apply(key, old: pa.Table, new: pa.Table) -> pa.Table:
        own, ids = CuckooIndex(), []
        if old.num_rows:
            own.filter, own.keys = CuckooFilter(old["rows"][0].as_py()), np.frombuffer(old["digests"][0].as_py(), _DIGEST)
            own.filter.marks, ids = np.frombuffer(old["marks"][0].as_py(), np.uint16).copy(), old["ids"][0].as_py()
            own.values = np.arange(len(own.keys))
        gone, given = new["gone"].to_numpy(), new["id"].to_pylist()
        digest = _from_hex(new["sha"])
        leave = np.flatnonzero(gone)
        leave = leave[[v >= 0 and ids[v] == given[i] for i, v in zip(leave, own.find(digest[leave]))]] if len(leave) else leave
        own.delete(digest[leave])
        come = np.flatnonzero(~gone)
        value = own.find(digest[come])
        is_new = value < 0
        value[is_new] = len(ids) + np.arange(int(is_new.sum()))
        ids = ids + [given[i] for i in come[is_new]]
        own.insert(digest[come[is_new]], value[is_new])
        n, kinds = len(come), {"long": pa.int64(), "binary": pa.binary(), "id": new["id"].type}
        last = lambda x, kind: pa.array([None] * n + [x], kinds.get(kind, kind))
        return pa.table({
            "bucket": pa.array([key[0].as_py()] * (n + 1), pa.int64()),
            "live": last(len(own.keys), "long"),
            "rows": last(own.filter.rows, "long"),
            "marks": last(own.filter.marks.tobytes(), "binary"),
            "digests": last(own.keys.tobytes(), "binary"),
            "ids": last([ids[v] for v in own.values], pa.list_(kinds["id"])),
            "sha": pa.array([*new["sha"].take(pa.array(come)).to_pylist(), None], pa.string()),
            "keep_id": pa.array([*[ids[v] for v in value], None], kinds["id"]),
            "is_new": pa.array([*is_new.tolist(), None], pa.bool_()),
        })

    both = durable(index.groupBy("bucket").cogroup(events.groupBy("bucket")).applyInArrow(apply, f"{stored}, sha string, keep_id {id_type}, is_new boolean"))
    decided = both.where("sha is not null").select("sha", "keep_id", "is_new")
    told = spread_join(batch, decided, "sha", batch.count()).select("doc_id", "keep_id", (F.col("is_new") & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("is_new"))
    return both.where("digests is not null").drop("sha", "keep_id", "is_new"), told
