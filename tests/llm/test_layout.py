"""URL filters, mixing, sharding, packing."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from popspark.llm import mixing, packing, sharding, url_filter
from popspark.llm.registry import URL_RULES, tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
URLS = [
    None, "", "no scheme", "http://", "http://org", "http://a.org/", "HTTP://Sub.Example.ORG/es/x?q#f", "http://example.org/en/123", "http://example.org/en/2", "http://example.org/es",
    "http://notexample.org/es/", "https://x.com/fr/", "https://com/de/1", "https://x.com/DE/", "http://a.org?x=/", "ftp://b.com/de/://example.org/es/", "x://y\nz.org/p\nq", "http://a.com:80/fr/", "http://example.org/en/1/es/",
]


def brute_verdict(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        rest = re.split(r"[?#]", rest, maxsplit=1)[0]
        host, slash, path = rest.partition("/")
        host, path = re.sub("[A-Z]", lambda m: m[0].lower(), host), slash + path
    best = None
    for action, rule in rules:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[1])):
            best = (action, rule)
    return host, path, best and best[1], best[0] if best else default


@pytest.mark.parametrize("rules", [URL_RULES, [], [("block", "a.org/"), ("block", "org/"), ("allow", "x.com/f"), ("block", "y\nz.org/p\nq")]])
def test_url_filters(spark, rules):
    pages = spark.createDataFrame([(i, u, "h", "r", "t") for i, u in enumerate(URLS + URLS[:8])], "page_id long, url string, host string, rule string, token string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(pages, rules).collect()}
    assert got == {i: brute_verdict(u, rules) for i, u in enumerate(URLS + URLS[:8])}
    assert url_filter.filter_urls(pages.limit(0), rules).count() == 0


def test_url_filter_has_no_python(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    plan = url_filter.filter_urls(pages, URL_RULES)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_url_filter_with_hot_urls_and_any_columns(spark):
    names = ["u", "h", "p", "n", "action", "Regex", "token", "target", "rank", "urls", "place", "won", "_key", "__of", "salt", "hot", "verdict", "a.b"]
    urls = [*URLS, *["http://example.org/en/1"] * 40, *["http://nothing.net/"] * 30, *[None] * 50, "http://b.example.org/es/" + "x/" * 200_000, "://" + "a" * 300_000 + ".com/de/", "x" * 500_000]
    pages = spark.createDataFrame([(i, u, *["x"] * len(names)) for i, u in enumerate(urls)], "page_id long, url string, " + ", ".join(f"`{c}` string" for c in names)).repartition(3)
    for hot_rows in (10, 1, 10**6):
        out = url_filter.filter_urls(pages, URL_RULES, hot_rows=hot_rows)
        assert set(out.columns) == set(pages.columns) | {"host", "path", "rule"}
        assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in out.collect()} == {i: brute_verdict(u, URL_RULES) for i, u in enumerate(urls)}
        assert out.count() == len(urls) and out.where("action = 'x' AND u = 'x' AND `a.b` = 'x'").count() == len(urls)


def test_longer_rule_lists_are_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "BROADCAST_RULES", 0)
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    assert {r.page_id: r.verdict for r in url_filter.filter_urls(pages, URL_RULES).collect()} == {i: brute_verdict(u, URL_RULES)[3] for i, u in enumerate(URLS)}


def brute_targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full = set()
    while True:
        spare = sum(sizes.values()) - sum(most * sizes[s] for s in full)
        rest = sum(w[s] for s in names if s not in full)
        new = {s for s in names if s not in full and spare * w[s] >= most * sizes[s] * rest}
        if not new:
            return {s: float(most * sizes[s]) if s in full else spare * w[s] / rest for s in names}
        full |= new


@pytest.mark.parametrize("bucket_rows", [50_000, 6])
def test_mixing(docs, rows, nothing, monkeypatch, bucket_rows):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket_rows)
    monkeypatch.setattr(mixing, "COARSE_RANGES", 256 if bucket_rows > 6 else 5)
    monkeypatch.setattr(mixing, "COARSE_DIGITS", 2 if bucket_rows > 6 else 1)
    out, mix = mixing.mix_sources(docs)
    got = out.collect()
    size = lambda t: len(WORD.findall(t or ""))
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += size(r[1])
    goal = brute_targets(sizes)
    assert Counter((r.doc_id, r.source, r["size"]) for r in got) == Counter((r[0], r[3], size(r[1])) for r in rows)
    taken, longest = defaultdict(int), max(size(r[1]) for r in rows)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(goal[r.source], abs=1e-9)
        assert r.taken == r.laps * r["size"] and r.laps <= 3
        taken[r.source] += r.taken
    assert sum(taken.values()) <= sum(sizes.values())
    for s in sizes:
        assert abs(taken[s] - goal[s]) <= longest
    # the queue in plain Python: by finish time, until the words reach the budget
    queue = []
    for s in sizes:
        own = sorted((r for r in got if r.source == s), key=lambda r: (r.place, r["size"]))
        total = 0
        for lap in range(3 if sizes[s] else 0):
            for r in own:
                total += r["size"]
                queue.append((total / r.target, s is not None, s or "", r.place, r["size"], lap))
    run, took = 0, Counter()
    for finish, _, s, place, n, _ in sorted(queue):
        run += n
        if run <= sum(sizes.values()):
            took[s, place] += n
    want = Counter()
    for r in got:
        want[r.source or "", r.place] += r.taken
    assert +took == +want
    assert mix.count() == sum(r.laps for r in got)
    assert mixing.mix_sources(nothing)[0].count() == 0


def test_reruns_of_mixing_agree(docs):
    a, b = (Counter((r.doc_id, r.source, r.taken) for r in mixing.mix_sources(docs.repartition(n))[0].collect()) for n in (3, 8))
    assert a == b


def test_kd_shards(docs, rows, nothing):
    for shards in (1, 5, 16):
        got = sharding.kd_shards(docs, shards=shards).collect()
        text = lambda r: (r[1] or "").encode()
        assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter((r[0], len(text(r)) + 1, zlib.crc32(text(r))) for r in rows)
        slots, bytes_of = defaultdict(list), Counter()
        for r in got:
            slots[r.shard].append(r.slot)
            bytes_of[r.shard] += r["size"]
        assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))
        assert max(bytes_of.values()) <= sum(bytes_of.values()) / shards + 2 * max(r["size"] for r in got)
    assert sharding.kd_shards(nothing, shards=16).count() == 0
    assert sharding.kd_shards(docs, target_bytes=10_000).agg({"shard": "max"}).first()[0] > 5


def brute_tree(rows, shards, dimensions):
    """Shard of each row (doc_id, size, q, tie) by recursion over sorted lists."""
    out = {}

    def split(own, first, n):
        if n == 1 or not own:
            out.update({i: first for i, *_ in own})
            return
        widths = [max(q[d] for _, _, q, _ in own) - min(q[d] for _, _, q, _ in own) for d in range(dimensions)]
        key = lambda r: (r[2][widths.index(max(widths))], r[3])
        own = sorted(own, key=key)
        goal, run = sum(r[1] for r in own) * (n // 2) // n, 0
        for r in own:
            run += r[1]
            if run >= goal:
                break
        split([x for x in own if key(x) <= key(r)], first, n // 2)
        split([x for x in own if key(x) > key(r)], first + n // 2, n - n // 2)

    split(rows, 0, shards)
    return out


def test_kd_shards_are_those_of_the_plain_tree(docs, monkeypatch):
    own = sharding.metadata(docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]), sharding.DIMENSIONS)[0].collect()
    rows = [(r.doc_id, r["size"], list(r.q), r.tie) for r in own]
    some = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    for shards, most in ((2, 50_000), (7, 50_000), (16, 1)):
        monkeypatch.setattr(sharding, "BROADCAST_NODES", most)
        got = {r.doc_id: r.shard for r in sharding.kd_shards(some, shards=shards).collect()}
        assert got == brute_tree(rows, shards, len(sharding.DIMENSIONS))


def test_kd_shards_are_even_under_skew(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "repeat('x', int(id % 7) + 90) AS text", "'en' AS lang", "if(id % 3 = 0, 'hot', concat('s', id % 50)) AS source")
    by = [r[1] for r in sharding.kd_shards(docs, shards=16).groupBy("shard").sum("size").collect()]
    assert len(by) == 16 and max(by) < 1.01 * min(by)
    plan = sharding.kd_shards(docs, shards=16)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def check_packing(got, capacity):
    spans = defaultdict(list)
    for r in got:
        spans[r.sequence_id].append((r.offset, r.length))
    for own in spans.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(spans)


def test_packing_documents(docs, rows, nothing):
    t = Tokenizer.from_file(tokenizer_path())
    out = packing.pack_documents(docs, tokenizer_path(), with_ids=True, block_pieces=20)
    got = out.collect()
    want = Counter()
    for r in rows:
        ids = t.encode(r[1] or "", add_special_tokens=False).ids + [0]
        start, first = 0, len(ids) % 2048 or 2048
        for piece, end in enumerate(range(first, len(ids) + 1, 2048)):
            data = np.array(ids[start:end], "<u4").tobytes()
            want[r[0], piece, start, end - start, zlib.crc32(data), data] += 1
            start = end
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in got) == want
    n = check_packing(got, 2048)
    assert n <= -(-sum(r.length for r in got) // 2048) + 2
    assert packing.pack_documents(nothing, tokenizer_path()).count() == 0


def test_units_of_the_tokenizer():
    t = Tokenizer.from_file(tokenizer_path())
    w = packing.WordTokenizer(tokenizer_path())
    texts = ["", " ", "  ", "a  b", "a \n b", "a\n b", "\ta b ", " a", "it's  we 're", "x\xa0 y", "x \xa0y", "a\u2003b \u2003 c", "a \x1c b", "a<|endoftext|> b", "é è\r\n\r\n ü", "12 345  6", "a \x85b", "日本 語"]
    texts += ["a <|endoftext|>  b", "a  <|endoftext|>", "<|endoftext|><|endoftext|> x", " <|endoftext| >", "é<|endoftext|>\n\n x"]
    texts += ["(can't) we'll I'M x'd'", "ça où Ω mixed5words ×÷ _a_", "a\nb\n\nc \n", "a|b | c || !? ...", "0x1F 3.14e5 […] — \u200b"]
    for text in texts * 2:
        assert np.frombuffer(w.encode(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, text
    assert np.frombuffer(w.encode("a<|endoftext|> b"), "<u4").tolist() == [64, 50256, 275]
    rng = random.Random(9)
    for _ in range(300):
        text = "".join(rng.choice(["a", "B2", " ", "  ", "\n", "<|endoftext|>", "<|", "é", "'s", "."]) for _ in range(rng.randint(0, 12)))
        assert np.frombuffer(w.encode(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, text
        texts.append(text)
    assert w.encode_all(pa.array(texts)[3:]) == [w.encode(text) for text in texts][3:]
    assert w.encode_all(pa.array(["  "])) == [w.encode("  ")] and w.encode_all(pa.array([], pa.string())) == []


def test_tokenizer_on_the_documents(spark, data):
    t = Tokenizer.from_file(tokenizer_path())
    w = packing.WordTokenizer(tokenizer_path())
    texts = [r.text for r in spark.read.parquet(f"{data}/documents.parquet").select("text").collect()]
    for text, ids in zip(texts, w.encode_all(pa.array(texts))):
        assert np.frombuffer(ids, "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


def test_packing_any_lengths(spark):
    rng = np.random.default_rng(1)
    lengths = np.concatenate([rng.integers(1, 300, 3000), rng.integers(900, 1001, 500), [1000] * 5])
    rows = spark.createDataFrame([(int(n), i) for i, n in enumerate(lengths)], "length long, name long").repartition(6)
    got = packing.pack(rows, capacity=1000, block_pieces=500).collect()
    assert sorted((r.name, r.length) for r in got) == sorted((i, int(n)) for i, n in enumerate(lengths))
    assert check_packing(got, 1000) <= -(-int(lengths.sum()) // 1000) + 3
    assert {r.name: (r.sequence_id, r.offset) for r in got if r.length == 1000}.values()


def test_packing_in_many_rounds_with_clashing_columns(spark):
    rng = np.random.default_rng(8)
    names = ["rid", "block", "poor", "own", "best", "bins", "island", "sequence_id", "offset", "generations", "a.b"]
    lengths = [int(n) for n in rng.integers(100, 700, 1500)] + [1000] * 4
    rows = spark.createDataFrame([(n, i, *[f"x{i}"] * len(names)) for i, n in enumerate(lengths)], "length int, name long, " + ", ".join(f"`{c}` string" for c in names)).repartition(3)
    for rounds in (1, 6):
        out = packing.pack(rows, capacity=1000, block_pieces=60, rounds=rounds, population=2, epochs=1, generations=1)
        assert set(out.columns) == set(rows.columns)
        got = out.collect()
        assert sorted((r.name, r.length, r.rid, r.block, r.poor, r["a.b"]) for r in got) == sorted((i, n, *[f"x{i}"] * 4) for i, n in enumerate(lengths))
        assert check_packing(got, 1000) >= -(-sum(lengths) // 1000)
    alone = packing.pack(rows.select("length"), capacity=1000, block_pieces=400)
    assert alone.columns == ["length", "sequence_id", "offset", "generations"] and check_packing(alone.collect(), 1000)
    for bad in ({"rounds": 0}, {"rounds": 256}, {"block_pieces": 1 << 25}):
        with pytest.raises(ValueError):
            packing.pack(rows, **bad)


def test_crossover_packs_the_blocks(spark):
    rng = np.random.default_rng(3)
    rows = spark.createDataFrame([(int(n), i) for i, n in enumerate(rng.integers(100, 700, 1500))], "length long, name long")
    got = packing.pack(rows, capacity=1000, block_pieces=400).collect()
    assert all(r.generations > 0 for r in got)
    assert check_packing(got, 1000) <= 1.02 * sum(r.length for r in got) / 1000


def test_best_fit_takes_the_fullest_bin_with_room():
    rng = np.random.default_rng(4)
    lengths, fill, want = rng.integers(1, 40, 400), [30, 0, 95, 60], {}
    mine, bins = list(fill), np.zeros(400, np.int32)
    packing.best_fit(lengths, np.arange(400), bins, mine, 100)
    for n, b in zip(lengths.tolist(), bins.tolist()):
        room = [100 - f for f in fill if f + n <= 100]
        if room:
            assert 100 - fill[b] == min(room)
        else:
            assert b == len(fill)
            fill.append(0)
        fill[b] += n
    assert fill == mine


def test_crossover_keeps_every_piece_once_and_evolution_improves():
    rng = np.random.default_rng(2)
    lengths = rng.integers(20, 60, 300).astype(np.int64)
    population = [packing.fresh(lengths, 100, rng) for _ in range(4)]
    before = min(packing.fitness(lengths, p, 100) for p in population)
    child = packing.crossover(lengths, population[0], population[1], 100, rng)
    assert len(child) == 300 and child.min() == 0 and np.bincount(child, lengths).max() <= 100 and (np.bincount(child) > 0).all()
    after, ran = packing.evolve(lengths, population, 100, 60, rng)
    assert 0 < ran <= 60 and packing.fitness(lengths, after[0], 100) < before and all(np.bincount(p, lengths).max() <= 100 for p in after)


