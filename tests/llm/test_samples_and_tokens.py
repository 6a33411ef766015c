"""Importance resampling, fill-in-middle, pieces of a merge-type vocabulary."""

import hashlib
import math
import random
import re
from collections import Counter
from itertools import pairwise
from zlib import crc32

import numpy as np
import pytest
import sentencepiece

from popspark.llm import fill_in_middle, resampling, sentence_pieces
from popspark.llm.registry import tokenizer_path

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
MODEL = tokenizer_path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "\n", "\n\n", "a", "A b\nc", "no end\nof line", "ends\n", "Éa É ﬁ 中文 x\x00y", "a" * 5000, "word " * 3000, "\n" * 400, "x<P>y", "<S>", "tail <M", "<", "<P\n>", "ÀÉ-é_z\x7fq", "one two three four five six seven eight nine ten " * 3,
]


def drawn(texts, target, order, buckets, least, percent, seed):
    """(id, n_features, weight, score, rank) of (id, text) rows, one by one."""
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    words = [WORD.findall(lower(t)) for _, t in texts]
    grams = lambda w: [crc32(" ".join(w[i : i + k]).encode()) % buckets for k in range(1, order + 1) for i in range(len(w) - k + 1)]
    own = [grams(w) for w in words]
    s, t = Counter(b for x in own for b in x), Counter(b for x in target for b in grams(WORD.findall(lower(x))))
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))) for b in s}
    out = []
    for (i, _), w, x in zip(texts, words, own):
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in x)
        out.append([i, len(x), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), len(w) >= least])
    able = sorted((x for x in out if x[4]), key=lambda x: (-x[3], x[0] is None, x[0] or 0))
    rank = {id(x): k for k, x in enumerate(able[: percent * len(able) // 100], 1)}
    return sorted(((*x[:4], rank.get(id(x))) for x in out), key=str)


@pytest.mark.parametrize("order,buckets,least,percent", [(1, 10_000, 20, 10), (1, 1 << 16, 1, 50), (3, 97, 3, 100), (2, 1000, 0, 0)])
def test_resampling(spark, docs, rows, order, buckets, least, percent):
    target = [rows[3][1], rows[7][1], None, "", "The quick fox the"]
    towards = spark.createDataFrame([(x, i, "b") for i, x in enumerate(target)], "text string, bucket int, doc_id string")
    got = resampling.resample(docs, towards, order, buckets, least, percent)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    got = sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in got.collect()), key=str)
    want = drawn([(r[0], r[1]) for r in rows], target, order, buckets, least, percent, 2024)
    assert [x[:4] for x in got] == [x[:4] for x in want]
    ranks = lambda x: sorted((r[4], r[0] is None, r[0] or 0, r[3]) for r in x if r[4])
    assert ranks(got) == ranks(want)


def test_resampling_draws_many_parts_and_ties(spark, monkeypatch):
    monkeypatch.setattr(resampling, "PART_ROWS", 7)
    rows = [(i // 3, f"w{i % 5} x y") for i in range(300)] + [(None, "w1 x y")] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    target = spark.createDataFrame([("w1 w1 w2",)], "text string")
    got = resampling.resample(docs, target, least_words=2, percent=60).where("rank IS NOT NULL").collect()
    assert sorted(r["rank"] for r in got) == list(range(1, 205))
    order = [(-r.score, r.doc_id is None, r.doc_id or 0) for r in sorted(got, key=lambda r: r["rank"])]
    want = [x for x in drawn(rows, ["w1 w1 w2"], 1, 10_000, 2, 60, 2024) if x[4]]
    assert order == sorted(order) == sorted((-x[3], x[0] is None, x[0] or 0) for x in want)


def test_resampling_of_nothing(spark, nothing):
    one = spark.createDataFrame([(1, None), (2, "a b")], "doc_id long, text string")
    assert resampling.resample(nothing, one).collect() == []
    got = resampling.resample(one, nothing, least_words=0, percent=100).orderBy("doc_id").collect()
    assert [(r.n_features, r.weight) for r in got] == [(x[1], x[2]) for x in drawn([(1, None), (2, "a b")], [], 1, 10_000, 0, 100, 2024)] and {r["rank"] for r in got} == {1, 2}
    with pytest.raises(ValueError):
        resampling.write_streams(one, buckets=1 << 17)


def test_runs_are_counts():
    rng = np.random.default_rng(3)
    values = rng.integers(0, 50, 1000).astype(np.uint16)
    v, c = resampling.run_lengths(values)
    assert dict(zip(v.tolist(), c.tolist())) == Counter(values.tolist())
    v, c = resampling.run_lengths(np.concatenate([v, v[:9]]), np.concatenate([c, c[:9]]))
    assert c.sum() == 1000 + sum(Counter(values.tolist())[x] for x in v[:9].tolist()) and (np.diff(v.astype(int)) > 0).all()


def arranged(i, text, seed, rate, spm_rate, unit, marks):
    text = text or ""
    units = [m[0] for m in re.finditer(unit, text)]
    assert "".join(units) == text
    digest = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    low, high = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or any(x in text for x in marks) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    if h[3] % 100 < spm_rate:
        return len(units), "spm", len(p), len(m), marks[1] + s + marks[0] + p + marks[2] + m
    return len(units), "psm", len(p), len(m), marks[0] + p + marks[1] + s + marks[2] + m


@pytest.mark.parametrize("settings", [{}, {"rate": 40, "spm_rate": 0, "unit": fill_in_middle.WORDS}, {"seed": 1, "unit": fill_in_middle.CHARACTERS, "sentinels": ("[pre]", "[suf]", "[mid]")}, {"spm_rate": 100, "rate": 99}])
def test_fill_in_middle(spark, docs, rows, settings):
    texts = [(r[0], r[1]) for r in rows] + [(None if i % 7 == 3 else 1000 + i, t) for i, t in enumerate(TEXTS * 3)]
    df = docs.select("doc_id", "text", "lang", "part", "n").unionByName(spark.createDataFrame([(*t, "x", "y", "z") for t in texts[len(rows) :]], "doc_id long, text string, lang string, part string, n string"))
    marks = settings.get("sentinels", fill_in_middle.SENTINELS)
    got = fill_in_middle.restore(fill_in_middle.rearrange(df, **settings), marks).collect()
    full = {"seed": 7, "rate": 100, "spm_rate": 50, "unit": fill_in_middle.LINES, "sentinels": marks} | settings
    want = [(i, *arranged(i, t, full["seed"], full["rate"], full["spm_rate"], full["unit"], marks), t or "") for i, t in texts]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert {r.form for r in got} >= {"plain", "spm" if full["spm_rate"] else "psm"}


def test_fill_in_middle_has_no_python_and_takes_no_rows(spark, nothing):
    out = fill_in_middle.restore(fill_in_middle.rearrange(nothing))
    assert out.collect() == []
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    for bad in (("<P>", "<P>", "<M>"), ("", "<S>", "<M>"), ("<P>", "<S>", "P><"), ("aa", "b", "c"), ("<P>", "<P>x", "<M>")):
        with pytest.raises(ValueError):
            fill_in_middle.rearrange(nothing, sentinels=bad)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def file():
    with open(MODEL, "rb") as f:
        return f.read()


def odd_texts(file, n):
    rng, model = random.Random(11), sentence_pieces.model_of(file)[0]
    some = ["a", "b", " ", "  ", "\n", "the", " in", "é", "中", "▁", "<0x0A>", "</s>", "\x00", "😀", "ﬁ", "\t", "ing", "ß", "​", "aaaa", "00", "==="]
    pieces = sorted(model.ids)
    for k in range(n):
        yield "".join(rng.choice(some) for _ in range(rng.randrange(40)))
        yield "".join(rng.choice(pieces).replace("▁", " " if rng.random() < 0.5 else "") for _ in range(rng.randrange(1, 30)))
        yield "".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(32, 0x3000), rng.randrange(0x4E00, 0x9FFF)])) for _ in range(rng.randrange(50)))
        yield "".join(rng.choice("abcdefghij"[: 1 + k % 10]) for _ in range(rng.randrange(80)))
        yield rng.choice(["", "x", "\n"]) + " " * (k % 70) + rng.choice(["", "hello", "é\n"])


def test_pieces_are_the_librarys(file, library):
    model, _ = sentence_pieces.model_of(file)
    for text in [*(t or "" for t in TEXTS), *odd_texts(file, 600), "".join(random.Random(1).choice("abcde") for _ in range(50_000))]:
        want = [library.bos_id(), *library.encode(text), library.eos_id()]
        got = np.frombuffer(sentence_pieces.encode_text(file, text), "<u4")
        assert got.tolist() == want, text[:200]
        assert model.decoded(got).decode() == library.decode(want), text[:200]


def test_backtracking_finds_what_merging_gives(file):
    model, rng = sentence_pieces.model_of(file)[0], random.Random(2)
    for k in range(2000):
        text = "".join(rng.choice("aeinrst" if k % 2 else "abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(1, 40)))
        pieces = model.split(text)
        assert pieces == model.merged(text) and "".join(pieces) == text
        assert all(model.merged(a + b) == [a, b] for a, b in pairwise(pieces))
    some = [p for p in sorted(model.ids) if set(p) <= set("▁aeinrsth")]
    for a, b in zip(rng.choices(some, k=20_000), rng.choices(some, k=20_000)):
        if a.strip("▁") and b.strip("▁"):
            assert model.compatible(a, b) == (model.merged(a + b) == [a, b]), (a, b)


def test_any_ids_decode_as_in_the_library(file, library):
    model, rng = sentence_pieces.model_of(file)[0], random.Random(5)
    for _ in range(1500):
        ids = [rng.randrange(3, 32000) if rng.random() < 0.5 else rng.randrange(0, 262) for _ in range(rng.randrange(12))]
        ids[:0] = rng.choice([[], [1], [28705], [1, 28705], [13]])
        assert model.decoded(np.array(ids, np.uint32)).decode() == library.decode(ids), ids


def test_documents_encode_and_come_back(spark, docs, rows, nothing, library):
    encoded = sentence_pieces.encode(docs, MODEL)
    got = sentence_pieces.decode(encoded.withColumnRenamed("n_tokens", "decoded"), MODEL).drop("n_tokens")
    assert got.columns == ["doc_id", "ids", "decoded"]
    want = [(r[0], np.array([1, *library.encode(r[1] or ""), 2], "<u4").tobytes(), library.decode(library.encode(r[1] or ""))) for r in rows]
    assert sorted(((r.doc_id, bytes(r.ids), r.decoded) for r in got.collect()), key=str) == sorted(want, key=str)
    assert {len(r.ids) // 4 == r.n_tokens for r in encoded.collect()} == {True}
    assert sentence_pieces.encode(nothing, MODEL).collect() == [] and sentence_pieces.decode(sentence_pieces.encode(nothing, MODEL), MODEL).collect() == []
    bare = sentence_pieces.encode(docs.where("doc_id = 400"), MODEL, ends=False).first()
    assert (bare.n_tokens, bytes(bare.ids)) == (0, b"")
    assert sentence_pieces.decode(spark.createDataFrame([(None,), (b"",)], "ids binary"), MODEL).orderBy("ids").collect() == [(None, None), (b"", "")]


def test_what_is_held_is_bounded(file, library, monkeypatch):
    monkeypatch.setattr(sentence_pieces, "HELD_PAIRS", 2)
    model = sentence_pieces.Model(file)
    parts = sentence_pieces._Parts(model.encoded, 3)
    text = "▁some▁words▁of▁different▁kinds▁come▁here"
    ids = b"".join(map(parts.__getitem__, model.parts(text)))
    assert np.frombuffer(ids, "<u4").tolist() == library.encode(text.replace("▁", " ")[1:]) and len(parts) <= 3 and len(parts.old) <= 3 and len(model.fits) <= 2


def test_other_kinds_of_models_are_refused():
    with pytest.raises(ValueError):
        sentence_pieces.Model(b"\x12\x02\x18\x01")  # a unigram model
