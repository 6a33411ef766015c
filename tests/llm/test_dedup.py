import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import functions as F

from popspark.llm import components, exact_dedup, simhash, substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_substring(texts, window):
    split = [WORD.findall(t or "") for t in texts]
    starts = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if starts[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest(), " ".join(kept)))
    return out


def test_substring_dedup(docs, rows, nothing):
    for window, settings in ((35, {}), (5, {"chunk_bytes": 3000, "bucket_windows": 500})):
        got = substring_dedup.substring_dedup(docs, window, keep_text=True, **settings).collect()
        want = [(r[0], *b) for r, b in zip(rows, brute_substring([r[1] for r in rows], window))]
        key = lambda r: (r[0] is None, r[0] or 0, r[3])
        assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in got), key=key) == sorted(want, key=key)
        for r in got:
            assert sum(s.end - s.start for s in r.removed) == r.n_removed
            assert all(a.end < b.start for a, b in zip(r.removed, r.removed[1:]))  # maximal
    assert substring_dedup.substring_dedup(nothing).count() == 0


def test_rolling_hash_is_that_of_the_words():
    data = np.frombuffer(b"ab cd  ab cd ab", np.uint8)
    at, (h, g), first = substring_dedup.window_hashes(np.array([0, 7, 7, 15]), data, 2)
    assert first.tolist() == [0, 2, 2, 5] and at.tolist() == [0, 2, 3]
    assert h[0] == h[1] != h[2] and g[0] == g[1] != g[2]


def test_rolling_hash_is_the_polynomial():
    rng, p = random.Random(8), substring_dedup._PRIME
    values = [0, 1, p - 1, p - 1, *[rng.randrange(p) for _ in range(80)]]
    for window in (1, 2, 3, 35, 64, 84, 85):
        for base in substring_dedup._BASES:
            want = [sum(v * pow(base, window - 1 - k, p) for k, v in enumerate(values[i : i + window])) % p for i in range(len(values) - window + 1)]
            assert substring_dedup._rolling(np.array(values, np.uint64), window, base).tolist() == want


def test_words_that_differ_are_not_taken_for_each_other(spark):
    morse = "a"
    while len(morse) < 1024:
        morse += morse.translate(str.maketrans("ab", "ba"))
    rest = " ".join(f"w{i}" for i in range(34))
    texts = [f"{morse} {rest}", f"{morse.translate(str.maketrans('ab', 'ba'))} {rest}", f"x {rest}", f"x {rest}"]
    got = substring_dedup.substring_dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_removed for r in got} == {0: 0, 1: 0, 2: 35, 3: 35}


def test_hits_are_confirmed_by_whole_hashes(spark, docs, rows, monkeypatch):
    # a first hash of 4 bits hits nearly everywhere
    monkeypatch.setattr(substring_dedup, "_short", lambda h, bits: h >> np.uint64(57 - bits))
    monkeypatch.setattr(substring_dedup, "_short_bits", lambda bits: 4 + bits)
    texts = [r[1] for r in rows]
    h = substring_dedup.window_hashes(np.cumsum([0, *[len((t or "").encode()) for t in texts]]), np.frombuffer("".join(t or "" for t in texts).encode(), np.uint8), 5)[1]
    assert len(np.unique(substring_dedup._short(h[0], 0))) == 16
    got = _in_one_process(texts, 5, 1)
    assert got == [(n, gone) for n, gone, *_ in brute_substring(texts, 5)]


def _in_one_process(texts, window, bits):
    """The steps of the operator on two chunks, without Spark."""
    import pyarrow as pa

    s = substring_dedup
    chunks = [pa.table({"doc_id": list(range(k, len(texts), 2)), "text": pa.array(texts[k::2], pa.string()), "chunk": [k] * len(texts[k::2])}) for k in (0, 1)]

    def count(sent):
        whole = pa.concat_tables(sent)
        told = [s._count(whole.filter(pa.compute.equal(whole["bucket"], b))) for b in range(1 << bits) if b in whole["bucket"].to_pylist()]
        told = pa.concat_tables(told)
        return [told.filter(pa.compute.equal(told["chunk"], k)) for k in (0, 1)]

    first = count([s._send(window, bits)(c) for c in chunks])
    last = count([s._confirm(window, bits)(c, a) for c, a in zip(chunks, first)])
    out = {}
    for c, a in zip(chunks, last):
        for r in s._remove(window, bits, False)(c, a).to_pylist():
            out[r["doc_id"]] = (r["n_words"], r["n_removed"])
    return [out[i] for i in range(len(texts))]


def test_rows_without_words_are_dealt_out(spark):
    docs = spark.range(1000).selectExpr("1L AS doc_id", "if(id % 2 = 0, NULL, '') AS text")
    got = substring_dedup.substring_dedup(docs, chunk_rows=100)
    assert got.agg({"n_words": "sum"}).first()[0] == 0 and got.count() == 1000
    sizes = [r["count"] for r in docs.withColumn("chunk", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(10))).groupBy("chunk").count().collect()]
    assert len(sizes) == 10 and max(sizes) < 200


def test_exact_dedup(docs, rows, nothing):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = defaultdict(list)
    for r in rows:
        groups[norm(r[1])].append(r[0])
    for size in (50_000, 7):
        got = exact_dedup.exact_dedup(docs, bucket_digests=size).collect()
        assert len(got) == len(rows)
        seen = defaultdict(list)
        for r in got:
            seen[r.text_sha256].append(r)
        assert len(seen) == len(groups)
        for text, ids in groups.items():
            own = seen[hashlib.sha256(text.encode()).hexdigest()]
            least = min((i for i in ids if i is not None), default=None)
            assert sorted(str(r.doc_id) for r in own) == sorted(map(str, ids))
            assert {(r.keep_id, r.group_size) for r in own} == {(least, len(ids))}
            assert [r.doc_id for r in own if r.kept] == [least]
    assert exact_dedup.exact_dedup(nothing).count() == 0


def test_cuckoo_index_grows_and_deletes():
    rng = random.Random(3)
    digests = [rng.randbytes(32) for _ in range(5000)]
    digests += [d[:16] + rng.randbytes(16) for d in digests[:50]]  # the same mark and rows
    digests += [d[:31] + b"\0" for d in digests[:20]] + [b"\0" * 32]
    all_ = np.array(digests, "S32")
    index, live = exact_dedup.CuckooIndex(rows=1), {}
    for step in range(60):
        some = np.array(rng.sample(range(len(all_)), rng.choice([1, 30, 400])))
        new = np.array([i for i in some if i not in live], np.int64)
        assert index.find(all_[some]).tolist() == [live.get(i, -1) for i in some]
        index.insert(all_[new], new + step)
        live.update({i: i + step for i in new.tolist()})
        out = rng.sample(range(len(all_)), 150)
        assert index.delete(all_[out]).tolist() == [i in live for i in out]
        for i in out:
            live.pop(i, None)
    assert index.filter.rows > 100 and len(index.keys) == len(live) == int((index.filter.marks > 0).sum())
    assert index.find(all_).tolist() == [live.get(i, -1) for i in range(len(all_))]


def test_a_sooner_row_takes_the_place_of_a_live_one(monkeypatch):
    import pyarrow as pa

    deleted, delete = [], exact_dedup.CuckooIndex.delete
    monkeypatch.setattr(exact_dedup, "_BATCH", 3)
    monkeypatch.setattr(exact_dedup.CuckooIndex, "delete", lambda self, d: deleted.extend(d) or delete(self, d))
    rows = [("aa", 5), ("bb", 4), ("aa", 3), ("aa", 2), ("cc", None), ("bb", 9), ("cc", 7), ("aa", 8)]
    table = pa.table({
        "sha": [x * 32 for x, _ in rows], "salt": pa.array(range(8), pa.int32()), "n": pa.array([1] * 8),
        "least": [{"none": i is None, "id": i, "rid": n} for n, (_, i) in enumerate(rows)],
    })
    got = exact_dedup._index(table).to_pylist()
    assert [(r["keep_id"], r["keep_rid"], r["group_size"]) for r in got] == [{"aa": (2, 3, 4), "bb": (4, 1, 2), "cc": (7, 6, 2)}[x] for x, _ in rows]
    assert len(deleted) == 2  # aa: 3, then 2; cc: none, then 7


def test_index_takes_additions_and_withdrawals(spark):
    for kind in ("long", "string"):
        docs = lambda rows: spark.createDataFrame([(i if kind == "long" else str(i), t) for i, t in rows], f"doc_id {kind}, text string")  # noqa: B023, E731
        told_of = lambda told: sorted((int(a), int(b), c) for a, b, c in told.collect())
        index, told = exact_dedup.update_index(None, docs([(2, "a  b"), (1, "a b"), (3, "c"), (4, None)]), buckets=3)
        assert told_of(told) == [(1, 1, True), (2, 1, False), (3, 3, True), (4, 4, True)]
        index, told = exact_dedup.update_index(index, docs([(5, "c"), (6, "d"), (7, "a b")]), docs([(1, "a b"), (9, "c")]), buckets=3)
        assert told_of(told) == [(5, 3, False), (6, 6, True), (7, 7, True)]
        assert index.agg({"live": "sum"}).first()[0] == 4
        index, told = exact_dedup.update_index(index, docs([(8, "c"), (1, "a b")]), docs([(7, "a b"), (4, "")]), buckets=3)
        assert told_of(told) == [(1, 1, True), (8, 3, False)] and index.agg({"live": "sum"}).first()[0] == 3
        assert exact_dedup.update_index(index, docs([]), docs([]), buckets=3)[0].agg({"live": "sum"}).first()[0] == 3


def brute_fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, ids, radius=4):
    label = list(range(len(fps)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                label[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, x in enumerate(ids):
        if x is not None:
            least[root(i)] = min(x, least.get(root(i), x))
    return [least.get(root(i)) for i in range(len(fps))]


def test_simhash_components(docs, rows, nothing):
    fps = [brute_fingerprint(r[1]) for r in rows]
    want = Counter((r[0], f"{f:016x}", c) for r, f, c in zip(rows, fps, brute_components(fps, [r[0] for r in rows])))
    got = simhash.simhash_components(docs)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert Counter(map(tuple, got.collect())) == want
    assert len({c for _, _, c in want if c is not None and 300 <= c < 310}) < 10  # near copies link
    assert simhash.simhash_components(nothing).count() == 0


def test_ball_hashing_finds_every_pair(spark):
    rng = random.Random(5)
    fps = [0, (1 << 64) - 1]
    for _ in range(40):
        f = rng.getrandbits(64)
        for _ in range(6):
            fps.append(f)
            for _ in range(rng.randint(1, 5)):
                f ^= 1 << rng.randrange(64)
    fps = sorted(set(fps))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    frame = spark.createDataFrame([(f,) for f in signed], "fp long")
    for variants, heavy in ((1 << 21, 1 << 25), (4000, 1 << 25), (40_000, 3000), (1 << 21, 0)):
        roots = {r.node: r.root for r in components.connected_components(simhash.near_links(frame, bucket_variants=variants, heavy_variants=heavy)).collect()}
        assert [roots.get(s, s) for s in signed] == [c for c in brute_components(fps, signed)]


def test_parts_of_a_heavy_bucket_are_joined(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(simhash, "_MOST_VARIANTS", 3000)
    rng = random.Random(6)
    fps = sorted({sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for _ in range(60)})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = simhash._collide(4)(pa.table({"fp": signed, "bucket": [0] * len(fps), "prefix": [0] * len(fps)})).to_pylist()
    label = {s: s for s in signed}
    label.update({r["a"]: r["b"] for r in got})
    groups = lambda of: sorted(map(sorted, ([k for k in of if of[k] == v] for v in set(of.values()))))
    assert groups(label) == groups(dict(zip(signed, brute_components(fps, list(range(len(fps)))))))


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(0, 300)] + [(400, 402), (402, 401), (5, 5), (None, 3), (7, None)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 301)} | {401: 400, 402: 400}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
