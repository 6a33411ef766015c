"""SimHash near-dedup by meet-in-the-middle ball hashing.

Two fingerprints at most `radius` bits apart share a variant at most radius/2 bits from both.  Every distinct
fingerprint goes to each bucket (prefix of variants) that holds one of its variants, and the bucket writes out the
variants that lie in it: the shuffle is on variants, but a variant's 8 bytes never travel.  Buckets that come out heavy are
dealt on by more bits.  Fingerprints that collide on a variant are deduplicated to a spanning forest of the bucket and
verified; components close the links.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import durable, slices, spread_join, texts_of
from .components import connected_components

BUCKET_VARIANTS = 2 << 20
#: Buckets of more variants than this are split by so many bits more, as long as bits are left.
HEAVY_VARIANTS, SPLIT_BITS, MOST_BITS = 32 << 20, 8, 40
_MOST_VARIANTS = 6 << 20
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: bytes, shingle: int = 4, seed: int = 42) -> int:
    """SimHash of a UTF-8 text: a bit is 1 if over half of its shingles' XXH64 have it.  No word: 0."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        return xxh64_intdigest(b" ".join(words), seed)
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    n = len(words) - shingle + 1
    h = np.fromiter((xxh64_intdigest(g, seed) for g in grams), np.uint64, n).astype(">u8").view(np.uint8).reshape(n, 8)
    if n < 256:
        ones = np.unpackbits(h, axis=1).sum(0, dtype=np.int64)
    else:
        ones = np.concatenate([np.bincount(h[:, i], minlength=256) @ _BYTE_BITS for i in range(8)])
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """doc_id and fp (the 64 bits as a long) of every row; a null text is empty."""

    def hashed(batches):
        for batch in slices(batches, "text"):
            fp = np.array([fingerprint(t, shingle) for t in texts_of(batch.column(1))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp, pa.int64())], ["doc_id", "fp"])

    docs = docs.select("doc_id", "text")
    return docs.mapInArrow(hashed, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp long")


def _flips(bits: int, most: int) -> np.ndarray:
    """All masks over the lowest `bits` bits with at most `most` bits set."""
    return np.array([sum(1 << i for i in c) for k in range(most + 1) for c in combinations(range(bits), k)], np.uint64)


def _forest(links: np.ndarray, n: int) -> np.ndarray:
    """Least member of each node's component, for local numbers 0 to n - 1."""
    label = np.arange(n)
    while len(links):
        low = np.minimum(label[links[:, 0]], label[links[:, 1]])
        np.minimum.at(label, label[links[:, 0]], low)
        np.minimum.at(label, label[links[:, 1]], low)
        while True:
            jump = label[label]
            if (jump == label).all():
                break
            label = jump
        links = links[label[links[:, 0]] != label[links[:, 1]]]
    return label


def _collide(radius: int):
    def collide(table: pa.Table) -> pa.Table:
        bucket, prefix = np.uint64(table["bucket"][0].as_py()), table["prefix"][0].as_py()
        fp = np.unique(np.asarray(table["fp"].to_numpy(), np.int64)).view(np.uint64)
        free, half = 64 - prefix, radius // 2
        used = np.bitwise_count((fp >> np.uint64(free)) ^ bucket) if prefix else np.zeros(len(fp), np.int64)
        low = fp & np.uint64((1 << free) - 1)
        masks = [_flips(free, left) for left in range(half + 1)]
        total = sum(int((used == half - left).sum()) * len(masks[left]) for left in range(half + 1))
        parts = max(1, -(-total // _MOST_VARIANTS))
        label = np.arange(len(fp))
        for part in range(parts):
            variants, owners = [], []
            for left, mask in enumerate(masks):
                own = np.flatnonzero(used == half - left)
                for at in range(0, len(own), 512):
                    some = own[at : at + 512]
                    v = (low[some][:, None] ^ mask[None, :]).ravel()
                    o = np.repeat(some.astype(np.int32), len(mask))
                    if parts > 1:
                        mine = (v * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(parts) == part
                        v, o = v[mine], o[mine]
                    variants.append(v)
                    owners.append(o)
            v, o = np.concatenate(variants), np.concatenate(owners)
            del variants, owners
            order = np.argsort(v)
            v, o = v[order], o[order]
            same = np.flatnonzero(v[1:] == v[:-1])
            links = np.stack([o[same], o[same + 1]], 1).astype(np.int64)
            links = np.unique(np.sort(links, 1), axis=0) if len(links) else links
            links = links[np.bitwise_count(fp[links[:, 0]] ^ fp[links[:, 1]]) <= radius]
            tree = np.flatnonzero(label != np.arange(len(fp)))  # the forest so far stands for all links of earlier parts
            label = _forest(np.concatenate([links, np.stack([tree, label[tree]], 1)]), len(fp))
        rest = np.flatnonzero(label != np.arange(len(fp)))
        signed = fp.view(np.int64)
        return pa.table({"a": pa.array(signed[rest], pa.int64()), "b": pa.array(signed[label[rest]], pa.int64())})

    return collide


def _dealt_on(sent: DataFrame, prefix: int, bits: int, half: int) -> DataFrame:
    """Rows (fp, bucket, used) of buckets of `prefix` bits, dealt to buckets of `bits` bits more; used counts the bits flipped so far."""
    by_used = [F.array(*[F.struct(F.lit(int(m)).cast("long").alias("mask"), F.lit(int(m).bit_count()).alias("more")) for m in _flips(bits, half - used)]) for used in range(half + 1)]
    masks = by_used[half]
    for used in range(half):
        masks = F.when(F.col("used") == used, by_used[used]).otherwise(masks)
    own = F.shiftrightunsigned("fp", 64 - prefix - bits).bitwiseAND((1 << bits) - 1) if bits else F.lit(0).cast("long")
    rows = sent.select("fp", "bucket", "used", own.alias("own"), F.explode(masks).alias("x"))
    return rows.select("fp", F.shiftleft("bucket", bits).bitwiseOR(F.col("own").bitwiseXOR(F.col("x.mask"))).alias("bucket"), (F.col("used") + F.col("x.more")).alias("used"))


def near_links(fps: DataFrame, radius: int = 4, bucket_variants: int = BUCKET_VARIANTS, heavy_variants: int = HEAVY_VARIANTS) -> DataFrame:
    """fps(fp), distinct -> links (a, b) that join exactly what links of at most `radius` bits join (a forest per bucket)."""
    if radius % 2:
        raise ValueError("radius is even: half of it is the radius of the balls")
    n, half = fps.count(), radius // 2
    prefix = min(MOST_BITS, max(0, int(np.ceil(np.log2(max(1, n * len(_flips(64, half)) / bucket_variants))))))
    sent = _dealt_on(fps.select("fp", F.lit(0).cast("long").alias("bucket"), F.lit(0).alias("used")), 0, prefix, half)
    found = None
    while True:
        variants = F.lit(1)
        for used in range(half):
            variants = F.when(F.col("used") == used, len(_flips(64 - prefix, half - used))).otherwise(variants)
        more = min(SPLIT_BITS, MOST_BITS - prefix)
        heavy = durable(sent.groupBy("bucket").agg(F.sum(variants.cast("long")).alias("n")).where(F.col("n") > heavy_variants).select("bucket")) if more else None
        split = heavy is not None and not heavy.isEmpty()
        light = sent.join(heavy, "bucket", "left_anti") if split else sent
        links = light.withColumn("prefix", F.lit(prefix)).groupBy("bucket").applyInArrow(_collide(radius), "a long, b long")
        found = links if found is None else found.unionByName(links)
        if not split:
            return found
        sent, prefix = _dealt_on(sent.join(heavy, "bucket", "left_semi"), prefix, more, half), prefix + more


def simhash_components(docs: DataFrame, radius: int = 4, shingle: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id reachable over links of `radius` bits.

    One row out for each row in.  Null and empty texts and texts without a word have fingerprint zero and link like any
    other.  Repeated rows and repeated ids share a component; null ids never become a component's id unless it has no
    other (then it is null).  An empty table gives no rows; other columns are ignored.
    """
    hashed, rooted = _rooted(docs, radius, shingle)
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    known = spread_join(rooted, least, "root", rooted.count()).select("fp", "component_id")
    return spread_join(hashed, known, "fp", hashed.count()).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def simhash_roots(docs: DataFrame, radius: int = 4, shingle: int = 4) -> DataFrame:
    """doc_id (of any type) of each row and root, which rows have in common if they are in one component."""
    hashed, rooted = _rooted(docs, radius, shingle)
    return spread_join(hashed, rooted.select("fp", "root"), "fp", hashed.count()).select("doc_id", "root")


def _rooted(docs: DataFrame, radius: int, shingle: int) -> tuple[DataFrame, DataFrame]:
    """doc_id and fp of each row; fp, its least id and the root of its component."""
    hashed = durable(fingerprints(docs, shingle))
    by_fp = durable(hashed.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = connected_components(near_links(by_fp.select("fp"), radius))
    return hashed, durable(by_fp.join(roots, by_fp.fp == roots.node, "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root")))
