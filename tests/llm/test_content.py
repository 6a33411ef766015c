"""Language ID, WARC, media columns."""

import gzip
import hashlib
import random
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest

from popspark.llm import language_id, media, warc

PAGES = "page_id long, url string, html string, digest string, original string, record string"


def test_forward_backward_is_exact():
    rng = np.random.default_rng(0)
    potential, move, start = rng.random((4, 2, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    potential[2:, 1] = 1
    lengths = np.array([4, 2])
    posterior, pairs, log_z = language_id.forward_backward(potential, lengths, move, start)
    want_pairs, want_z = np.zeros((3, 3)), 0
    for c, n in enumerate(lengths):
        weights = {y: np.exp(start[y[0]] + sum(move[a, b] for a, b in zip(y, y[1:]))) * np.prod([potential[t, c, s] for t, s in enumerate(y)]) for y in product(range(3), repeat=int(n))}
        z = sum(weights.values())
        want_z += np.log(z)
        for t in range(n):
            assert np.allclose(posterior[t, c], [sum(w for y, w in weights.items() if y[t] == s) / z for s in range(3)])
        for y, w in weights.items():
            for a, b in zip(y, y[1:]):
                want_pairs[a, b] += w / z
    assert np.allclose(pairs, want_pairs) and np.isclose(log_z, want_z)


def test_language_id_on_held_out_rows(spark, data):
    docs = spark.read.parquet(data.replace("sf0.001", "sf0.01") + "/documents.parquet")
    model = language_id.fit(docs, rows_per_language=100)
    out = language_id.identify(docs, model).withColumn("held", language_id.held_out()).collect()
    held = [r for r in out if r.held and r.lang]
    right = sum(r.lang_pred == r.lang for r in held) / len(held)
    assert len(held) > 100 and right >= 0.97, right
    for lang in model.labels:
        own = [r for r in held if r.lang == lang]
        assert sum(r.lang_pred == lang for r in own) >= 0.9 * len(own)
    assert all(0 <= r.score <= 1 and abs(sum(r.lang_shares.values()) - 1) < 1e-6 for r in out if r.lang_pred != "und")
    texts = [next(r.text for r in held if r.lang == lang and len(r.text) > 600)[:500] for lang in ("de", "fr")]
    (_, _, shares), = language_id.predict(model, [" ".join(texts)])
    assert shares["de"] > 0.3 and shares["fr"] > 0.3  # code-switched text


def test_language_id_learns_only_from_labelled_rows_that_are_not_held_out(spark, docs, rows):
    held = {r[0] for r in rows if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 4 == 2}
    assert {r.doc_id for r in docs.where(language_id.held_out()).select("doc_id").collect()} == held
    marked = docs.selectExpr("doc_id", "text", "if(crc32(cast(cast(doc_id AS string) AS binary)) % 4 = 2, 'held', lang) AS lang")
    assert "held" not in language_id.fit(marked, rounds=1).labels


def test_predict_is_the_sum_over_all_labellings(monkeypatch):
    """Shares of the languages from every labelling of every chain, with features scored one by one."""
    texts = ["the ein que", "ein Ein, der! the", "que 12 -- eau mixed ein", "eau", "the the der que que eau ein der", "½ ² Ⅷ", "", None]
    model = language_id.train(["the of the and", "ein der ein", "que eau que le"] * 3, ["en", "de", "fr"] * 3, rounds=4)
    model.transitions[:] += np.random.default_rng(1).normal(size=(3, 3))
    monkeypatch.setattr(language_id, "CHAIN", 3)

    def shares(text):
        words, total = (text or "").split(), np.zeros(3)
        for i in range(0, len(words), 3):
            chain, z, own = words[i : i + 3], 0.0, np.zeros(3)
            for y in product(range(3), repeat=len(chain)):
                score = model.start[y[0]] + sum(model.transitions[a, b] for a, b in zip(y, y[1:]))
                score += sum(model.weights[model.numbers[f], label] for w, label in zip(chain, y) for f in language_id.features(w) if f in model.numbers)
                z += np.exp(score)
                for w, label in zip(chain, y):
                    own[label] += np.exp(score) * any(c.isalpha() for c in w)
            total += own / z
        return total / total.sum() if total.sum() else None

    for text, (lang, score, found) in zip(texts, language_id.predict(model, texts)):
        want = shares(text)
        if want is None:
            assert (lang, score, found) == ("und", 0.0, {})
        else:
            assert lang == model.labels[int(want.argmax())] and np.isclose(score, want.max()) and np.allclose([found[x] for x in model.labels], want)


def test_letters_are_those_of_category_l():
    import unicodedata

    for i in range(0x30000):
        c = chr(i)
        assert bool(language_id.letters(c)) == any(unicodedata.category(x)[0] == "L" for x in c.lower())
    model = language_id.train(["the of"] * 3, ["en"] * 3, rounds=1)
    assert [x[:2] for x in language_id.predict(model, ["½ ½", "²", "Ⅷ", "1_2"])] == [("und", 0.0)] * 4
    assert language_id.predict(model, ["ª"])[0][0] == "en"


def test_language_id_is_fitted_on_a_bounded_sample_of_whole_texts(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(language_id, "train", lambda texts, langs, **_: seen.append(list(zip(langs, texts))))
    long_text = " ".join(f"w{i}" for i in range(256 * 40))
    rows = [(i, f"{long_text} {i}", "en") for i in range(40)] + [(100, "z" * 50_000, "de")] + [(101, "ein der", "de")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    language_id.fit(docs, rows_per_language=50)
    held = sum(zlib.crc32(str(i).encode()) % 4 == 2 for i in range(40))
    assert [t for lang, t in seen[0] if lang == "de"] == ["ein der"]  # repeated rows count once; one word above the bound
    assert len(seen[0]) - 1 == 41 * (40 - held) and any(t.startswith(f"w{256 * 39} ") for _, t in seen[0])
    language_id.fit(docs, rows_per_language=10, spans_per_language=30)
    assert len([1 for lang, _ in seen[1] if lang == "en"]) == 30


def test_language_id_edge_cases(docs, rows, nothing):
    model = language_id.fit(docs, rounds=5)
    got = {(r.doc_id, r.text): r for r in language_id.identify(docs, model).collect()}
    assert len(got) <= len(rows) and all(got[r[0], r[1]] for r in rows)
    for i, text in ((400, None), (401, ""), (402, " \n\t "), (403, "12 34 | --")):
        assert (got[i, text].lang_pred, got[i, text].score) == ("und", 0.0)
    assert language_id.identify(docs, model).count() == len(rows)
    assert set(docs.drop("score").columns) < set(language_id.identify(docs, model).columns)
    assert language_id.fit(nothing) is None and language_id.identify(nothing, None).count() == 0
    assert {r.lang_pred for r in language_id.identify(docs, None).collect()} == {"und"}
    again = {(r.doc_id, r.text): r.score for r in language_id.identify(docs.repartition(2), language_id.fit(docs.repartition(7), rounds=5)).collect()}
    assert all(abs(again[k] - got[k].score) < 1e-9 for k in got)


def page_rows():
    rng = random.Random(4)
    big = "<html>é\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n" + "x" * 200
    rows = [(i, f"http://a/{i}", "p" * rng.choice([5, 99, 100, 300]) + str(rng.randrange(3))) for i in range(60)]
    rows += [(100 + i, "u\r\nX: y", big) for i in range(20)] + [(None, None, None), (None, "n", big), (130, None, ""), (131, "e", None), (132, "r", "z" * 150), (132, "r", "z" * 150), (133, "r", "z" * 150)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("most", [10**6, 0])
def test_warc(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(warc, "BROADCAST_REVISITS", most)
    monkeypatch.setattr(warc, "GROUP_ROWS", 10)
    rows = page_rows()
    pages = spark.createDataFrame([(*r, "d", "o", "c") for r in rows], PAGES).repartition(3)
    path = warc.write_archives(pages, f"file://{tmp_path}/warc", archive_bytes=3000)
    files = list((tmp_path / "warc").glob("*.warc.gz"))
    assert len(files) > 3
    first = {}
    for i, _, html in rows:
        if i is not None and len((html or "").encode()) >= 100:
            first[html] = min(i, first.get(html, i))
    want = Counter()
    for i, _, html in rows:
        raw = (html or "").encode()
        revisit = len(raw) >= 100 and i != first[html]
        want[i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", first[html] if revisit else None] += 1
    got = warc.read_resolved(spark, path)
    assert Counter(map(tuple, got.collect())) == want
    payloads = {bytes(r.payload) for r in warc.read_archives(spark, path, with_payload=True).where("record_type = 'response'").collect()}
    assert payloads == {(r[2] or "").encode() for r in rows}
    # any gzip reader gets the whole file, and the index finds each record
    for file in files:
        records = list(warc.parse(gzip.decompress(file.read_bytes())))
        assert records[0][0]["warc-type"] == "warcinfo" and all(h["warc-record-id"] for h, _ in records)
    for r in spark.read.parquet(f"{path}/index").collect():
        (headers, _), = warc.parse(gzip.decompress((tmp_path / "warc" / r.file).read_bytes()[r.offset : r.offset + r.length]))
        assert headers.get("x-page-id") == (None if r.page_id is None else str(r.page_id))
    empty = warc.write_archives(pages.limit(0), f"file://{tmp_path}/empty")
    assert warc.read_resolved(spark, empty).count() == 0


def test_headers_alone_are_shuffled(spark):
    pages = spark.createDataFrame([(i, "u", "p" * 200) for i in range(9)], "page_id long, url string, html string")
    plan = warc.resolve(pages)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_warc_records_that_are_cut_short(spark):
    import io

    record = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [b for _, b in warc.parse(record * 2)] == [b"abc"] * 2
    with pytest.raises(ValueError):
        list(warc.parse(record[:-3]))
    whole = gzip.compress(record) * 3
    assert list(warc.members(io.BytesIO(whole))) == [record] * 3
    with pytest.raises(ValueError):
        list(warc.members(io.BytesIO(whole[:-9])))


@pytest.mark.parametrize("n", [0, 1, 161, 162, 163, 164, 575, 576, 577, 4608, 4609, 9216, 50_000])
def test_transport_stream_round_trip(n):
    payload = media.pad(bytes(i * 7 % 251 for i in range(n)))
    stream = media.mux(payload)
    assert len(stream) % 188 == 0 and stream[::188] == b"G" * (len(stream) // 188)
    s = media.demux(stream)
    own = s.streams[media.DATA_PID]
    assert s.payload == payload and (s.gaps, s.orphans) == (0, 0) and s.programs == {1: media.MAP_PID} and list(s.streams) == [media.DATA_PID] and own.kind == 6
    assert own.stamps == [i * media.TICKS for i in range(-(-len(payload) // 4608))] and len(s.access) == len(own.stamps) and all(own.access)
    if len(stream) > 6 * 188:
        assert media.demux(stream[: 3 * 188] + stream[4 * 188 :]).gaps == 1  # a lost packet shows
    assert media.demux(stream[: 3 * 188] + stream[2 * 188 :]).payload == payload  # a packet that came twice counts once
    assert plain_reader(stream) == (payload, own.stamps, [2 + sum(-(-(min(4608, len(payload) - 4608 * k) + 22 - 8) // 184) for k in range(i)) for i in range(len(own.stamps))])


def plain_reader(stream):
    """Payload, time stamps and random-access packets by the standard's bit fields, one packet after another."""
    bits = lambda data: "".join(f"{x:08b}" for x in data)
    maps, kinds, pes, access, counts = {}, {}, [], [], {}
    for number in range(len(stream) // 188):
        own = stream[number * 188 : number * 188 + 188]
        head = bits(own[:4])
        assert head[:8] == "01000111" and head[8] == "0" and head[24:26] == "00"
        start, pid, control, counter = head[9] == "1", int(head[11:24], 2), head[26:28], int(head[28:], 2)
        assert control in ("01", "11") and counter == (counts.get(pid, -1) + 1) % 16
        counts[pid] = counter
        at = 4
        if control == "11":
            at = 5 + own[4]
            if own[4]:
                flags = bits(own[5:6])
                if flags[1] == "1":
                    access.append(number)
                if flags[3] == "1":
                    clock = bits(own[6:12])
                    base, extension = int(clock[:33], 2), int(clock[39:], 2)
                    assert clock[33:39] == "111111" and extension == 0
                    assert base == len(pes) * 8 * 2160
                assert set(own[6 + 6 * (flags[3] == "1") : at]) <= {255}
        data = own[at:]
        if pid == 0 or pid in maps.values():
            assert start and data[0] == 0
            length = int(bits(data[2:4])[4:], 2)
            section = data[1 : 4 + length]
            assert bits(section[1:2])[0] == "1" and set(data[4 + length :]) <= {255}
            remainder = "".join(str(int(x) ^ (i < 32)) for i, x in enumerate(bits(section)))
            value = [int(x) for x in remainder]
            for i in range(len(value) - 32):  # long division by the polynomial
                if value[i]:
                    for k, x in enumerate("100000100110000010001110110110111"):
                        value[i + k] ^= int(x)
            assert not any(value)
            if pid == 0:
                assert section[0] == 0
                for i in range(8, len(section) - 4, 4):
                    maps[int(bits(section[i : i + 2]), 2)] = int(bits(section[i + 2 : i + 4])[3:], 2)
            else:
                assert section[0] == 2
                i = 12 + int(bits(section[10:12])[4:], 2)
                while i < len(section) - 4:
                    kinds[int(bits(section[i + 1 : i + 3])[3:], 2)] = section[i]
                    i += 5 + int(bits(section[i + 3 : i + 5])[4:], 2)
        else:
            assert pid in kinds and kinds[pid] == 6
            if start:
                pes.append(b"")
            pes[-1] += data
    payload, stamps = b"", []
    for x in pes:
        assert x[:4] == b"\0\0\x01\xbd" and len(x) == 6 + int(bits(x[4:6]), 2)
        head = bits(x[6:9])
        assert head[:2] == "10" and head[8:10] == "10"
        stamp = bits(x[9:14])
        assert stamp[:4] == "0010" and stamp[7] == stamp[23] == stamp[39] == "1"
        stamps.append(int(stamp[4:7] + stamp[8:23] + stamp[24:39], 2))
        payload += x[9 + x[8] :]
    return payload, stamps, access


def _cut(pid, data, counter=0, start=True, size=184):
    return [media.packet(pid, counter + i, data[a : a + size], start and not a) for i, a in enumerate(range(0, len(data), size))]


def test_streams_of_other_writers():
    entry = lambda kind, pid, info=b"": bytes([kind]) + (0xE000 | pid).to_bytes(2, "big") + (0xF000 | len(info)).to_bytes(2, "big") + info
    pat = media.section(0, 1, b"\0\0\xe0\x10" + b"".join(i.to_bytes(2, "big") + (0xE000 | 0x40 + i).to_bytes(2, "big") for i in (1, 2)))
    pmt = media.section(2, 1, (0xE000 | 0x101).to_bytes(2, "big") + b"\xf0\x04desc" + entry(0x1B, 0x101, b"x" * 150) + entry(0x0F, 0x102, b"y" * 120))  # longer than a packet
    other = media.section(2, 2, (0xE000 | 0x103).to_bytes(2, "big") + b"\xf0\0" + entry(6, 0x103))
    tables = _cut(0, b"\0" + pat) + _cut(0x41, b"\0" + pmt)
    cut_short = [*_cut(0x42, b"\0" + other[:10], 0), *_cut(0x42, bytes([len(other) - 10]) + other[10:] + other, 1)]  # a section that ends behind the pointer of the next
    a, b, c = bytes(range(256)) * 3, b"B" * 600, b"C" * 700
    video = _cut(0x101, b"\0\0\x01\xe0\0\0\x80\xc0\x0a" + media._stamp(7) + media._stamp(5) + a)  # length 0; two stamps
    video += _cut(0x101, b"\0\0\x01\xe0\0\0\x80\0\0" + b, len(video))  # no stamp
    audio = _cut(0x102, b"\0\0\x01\xc0" + (len(c) + 3).to_bytes(2, "big") + b"\x80\0\0" + c)
    bare = _cut(0x103, b"\0\0\x01\xbf\0\x05hello")
    mixed = [x for pair in zip(video, [*audio, *[media.packet(0x1FFF, 0, b"\xff" * 184, False)] * (len(video) - len(audio))]) for x in pair]
    lost = media.packet(0x102, 15, b"tail of what began before", False)
    s = media.demux(b"".join(tables + cut_short + [lost] + mixed + bare))
    assert s.programs == {1: 0x41, 2: 0x42} and {p: e.kind for p, e in s.streams.items()} == {0x101: 0x1B, 0x102: 0x0F, 0x103: 6}
    assert s.streams[0x101].payloads == [a, b] and s.streams[0x101].stamps == [7, None]
    assert s.streams[0x102].payloads == [c] and s.streams[0x103].payloads == [b"hello"] and (s.gaps, s.orphans) == (0, 1)
    assert media.demux(b"".join(mixed)).streams == {}  # no tables, no streams
    with pytest.raises(ValueError):
        media.demux(b"".join(tables)[:-1])


def test_time_stamps_of_33_bits():
    for ticks in (0, 1, (1 << 33) - 1, 0x155555555, 0x0AAAAAAAA):
        assert media._unstamp(media._stamp(ticks)) == ticks


def test_damaged_tables_are_refused():
    stream = bytearray(media.mux(media.pad(b"x")))
    stream[10] ^= 1
    with pytest.raises(ValueError):
        media.demux(bytes(stream))


def test_media_columns(docs, rows, nothing):
    got = media.decode(media.encode(docs)).collect()
    want = Counter()
    for r in rows:
        raw = (r[1] or "").encode()
        payload, stored = media.pad(raw), media.mux(media.pad(raw))
        want[r[0], len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(stored), hashlib.sha256(stored).hexdigest()] += 1
    assert Counter(tuple(r)[:7] for r in got) == want and all(r.feature for r in got)
    assert media.decode(media.encode(nothing)).count() == 0


def test_a_fit_with_many_languages_stays_small():
    import subprocess
    import sys

    code = """
import random, resource
from popspark.llm import language_id as l
assert l.SPAN_LABELS // 200**2 == 1 and l.MOST_LANGUAGES == 200
rng = random.Random(1)
texts = [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(l.SPAN_WORDS)) for _ in range(200)]
model = l.train(texts, [f"l{i}" for i in range(200)], rounds=2)
assert len(model.labels) == 200
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) < 1500


def test_batches_of_chains_give_the_same_fit(monkeypatch):
    texts, labels = ["the of the and ing " * 40, "ein der ein ung sch " * 40, "que eau que le ment " * 40], ["en", "de", "fr"]
    whole = language_id.train(texts, labels, rounds=5)
    monkeypatch.setattr(language_id, "_FIT_CELLS", 1)
    parts = language_id.train(texts, labels, rounds=5)
    assert np.allclose(whole.weights, parts.weights) and np.allclose(whole.transitions, parts.transitions) and np.allclose(whole.start, parts.start)
