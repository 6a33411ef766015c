"""Substring dedup: words in windows that also start elsewhere are removed.

Rabin-Karp hashes of all windows are counted in Spark.  Documents are dealt into chunks of a few MB, row by row.  Each chunk
sends every bucket of the hash space one row: 40 bits of its distinct window hashes, sorted.  A bucket finds those that
occur twice and answers each chunk with one bit per hash.  Of the windows that hit, the chunk sends the whole hash and a
second, independent one of the same words; only those that agree in both are repeated.  The chunk hashes its windows
again, so neither positions nor texts travel with the hashes, and repeated windows merge into maximal intervals there.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import string_bytes

CHUNK_BYTES = 4 << 20
CHUNK_ROWS = 100_000
BUCKET_WINDOWS = 2 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: The modulus of the hashes, a Mersenne prime, and two bases drawn at random below it.
_PRIME = (1 << 61) - 1
_BASES = 0x0B7C4E1D93A5F286, 0x1563D08F7E42B9C1
_SEED = 0x5AD6B39C
_FIRST = 5  # bytes of the first hash that are sent beyond the bucket's own bits


def _reduced(x: np.ndarray) -> np.ndarray:
    """x modulo the prime, for x below 2**63."""
    x = (x & np.uint64(_PRIME)) + (x >> np.uint64(61))
    return np.where(x >= np.uint64(_PRIME), x - np.uint64(_PRIME), x)


def _times(a: np.ndarray, b: int) -> np.ndarray:
    """a * b modulo the prime in 64 bits, from halves of 31 bits."""
    low31, low30 = np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)
    high, low, b_high, b_low = a >> np.uint64(31), a & low31, np.uint64(b >> 31), np.uint64(b & (1 << 31) - 1)
    middle = high * b_low + low * b_high
    return _reduced((high * b_high << np.uint64(1)) + (middle >> np.uint64(30)) + ((middle & low30) << np.uint64(31)) + low * b_low)


def _rolling(values: np.ndarray, window: int, base: int) -> np.ndarray:
    """Rabin-Karp hashes of all `window` values in a row: sum of value * base ** place, from the hashes of 1, 2, 4, ... values."""
    n = len(values) - window + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    block, size, out, done = values, 1, None, 0
    while True:
        if window & size:
            part = block[done : done + n]
            out = part if out is None else _reduced(_times(out, pow(base, size, _PRIME)) + part)
            done += size
        if done == window:
            return out
        block = _reduced(_times(block[: len(block) - size], pow(base, size, _PRIME)) + block[size:])
        size *= 2


def words_of(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words in data, and for each document the number of its first word (one more at the end)."""
    word = ~_SPACE[data]
    before, after = np.zeros_like(word), np.zeros_like(word)
    before[1:], after[:-1] = word[:-1], word[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before[edges], after[edges - 1] = False, False
    starts, ends = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_values(starts: np.ndarray, ends: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Two numbers below the prime for each word: halves of the XXH3 of its bytes.  Each different word is hashed once."""
    from xxhash import xxh3_128_digest

    if not len(starts):
        return np.zeros((2, 0), np.uint64)
    offsets = np.empty(2 * len(starts) + 1, np.int32 if len(data) < 1 << 31 else np.int64)  # words and what lies between them
    offsets[:-1:2], offsets[1::2], offsets[-1] = starts, ends, ends[-1]
    kind = pa.binary() if offsets.dtype == np.int32 else pa.large_binary()
    texts = pa.Array.from_buffers(kind, len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
    digests = np.frombuffer(b"".join([xxh3_128_digest(w, _SEED) for w in texts.dictionary.to_pylist()]), np.uint64).reshape(-1, 2)
    return (digests & np.uint64(_PRIME)).T[:, texts.indices.to_numpy()[::2]] % np.uint64(_PRIME)


def window_hashes(offsets: np.ndarray, data: np.ndarray, window: int, both: bool = True) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Word number at which each window starts, its two hashes (or the first alone), and each document's first word."""
    starts, ends, first = words_of(offsets, data)
    last = np.repeat(first[1:], np.diff(first))
    at = np.flatnonzero(np.arange(len(starts)) + window <= last)
    values = word_values(starts, ends, data)
    return at, [_rolling(v, window, base)[at] for v, base in zip(values, _BASES[: 1 + both])], first


def _planes(x: np.ndarray, width: int) -> bytes:
    """The lowest bytes of numbers, first all lowest ones, then the next, which compresses better."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _numbers(planes: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(planes) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, -1).T
    return out.view(np.uint64).ravel()


def _packed(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _flags(packed: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(packed, np.uint8), count=n).astype(bool)


def _cuts(sorted_: np.ndarray, bits: int, width: int) -> list[tuple[int, int]]:
    """Where each bucket's numbers, those with the same highest `bits` of `width` bits, begin and end."""
    cuts = np.searchsorted(sorted_, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(width - bits)).tolist() if bits else []
    return list(zip([0, *cuts], [*cuts, len(sorted_)]))


def _short(h: np.ndarray, bits: int) -> np.ndarray:
    """The bucket's bits of a hash and the 40 bits behind them."""
    return h >> np.uint64(61 - 8 * _FIRST - bits) if bits <= 61 - 8 * _FIRST else h


def _short_bits(bits: int) -> int:
    return min(61, 8 * _FIRST + bits)


#: What a chunk sends a bucket: two sorted hashes as byte planes, which of them repeat in the chunk, and the bits of the bucket's first answer.
_SENT = "chunk long, bucket int, first binary, n_first long, planes binary, second binary, multi binary"
_ANSWER = "chunk long, bucket int, first binary, n_first long, n long, repeated binary"


def _table(schema: str, rows: list[tuple]) -> pa.Table:
    types = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    names = [f.split(" ") for f in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.table({n: pa.array(c, types[t]) for (n, t), c in zip(names, columns)})


def _send(window: int, bits: int):
    """One row for each bucket that the chunk has windows in: 40 bits of the distinct hashes, and which repeat."""

    def send(table: pa.Table) -> pa.Table:
        chunk = table["chunk"][0].as_py()
        _, (h,), _ = window_hashes(*string_bytes(table["text"]), window, both=False)
        h, count = np.unique(_short(h, bits), return_counts=True)
        cuts = _cuts(h, bits, _short_bits(bits))
        return _table(_SENT, [(chunk, k, None, None, _planes(h[a:b], _FIRST), None, _packed(count[a:b] > 1)) for k, (a, b) in enumerate(cuts) if a < b])

    return send


def _count(table: pa.Table) -> pa.Table:
    """For each row sent to this bucket, the bits of its hashes that occur twice anywhere."""
    whole = table["second"].null_count == 0
    parts = [_numbers(p.as_py(), 8 if whole else _FIRST) for p in table["planes"]]
    sizes = [len(p) for p in parts]
    repeated = np.concatenate([_flags(m.as_py(), n) for m, n in zip(table["multi"], sizes)])
    values = np.concatenate(parts)
    del parts
    if whole:
        second = np.concatenate([_numbers(p.as_py(), 8) for p in table["second"]])
        order = np.lexsort((second, values))
        second = second[order]
    else:
        order = np.argsort(values, kind="stable")
    values = values[order]
    same = values[1:] == values[:-1]
    if whole:
        same &= second[1:] == second[:-1]
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    ends = np.cumsum([0, *sizes])
    answers = [_packed(repeated[a:b]) for a, b in zip(ends[:-1], ends[1:])]
    return _table(_ANSWER, list(zip(*[table[c].to_pylist() for c in ("chunk", "bucket", "first", "n_first")], sizes, answers)))


def _hits(h: np.ndarray, bits: int, answers: list[tuple[bytes, int]]) -> np.ndarray:
    """Which windows' short hashes occur twice; answers are in the order of buckets."""
    if not len(h):
        return np.zeros(0, bool)
    _, inverse = np.unique(_short(h, bits), return_inverse=True)
    return np.concatenate([_flags(x, n) for x, n in answers])[inverse]


def _distinct(h: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs of two hashes in order, how often each occurs, and which one each pair is."""
    order = np.lexsort((g, h))
    new = np.ones(len(order), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (g[order][1:] != g[order][:-1])
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    return h[order][new], g[order][new], np.bincount(which, minlength=int(new.sum())), which


def _confirm(window: int, bits: int):
    """One row for each bucket that answered the chunk: both hashes of the windows that hit."""

    def confirm(docs: pa.Table, answers: pa.Table) -> pa.Table:
        told = sorted(zip(*[answers[c].to_pylist() for c in ("bucket", "repeated", "n", "chunk")]))
        if not told:
            return _table(_SENT, [])
        _, (h, g), _ = window_hashes(*string_bytes(docs["text"]), window)
        hit = _hits(h, bits, [(x, n) for _, x, n, _ in told])
        h, g, count, _ = _distinct(h[hit], g[hit])
        cuts = _cuts(h, bits, 61)
        return _table(_SENT, [(chunk, k, first, n, _planes(h[a:b], 8), _planes(g[a:b], 8), _packed(count[a:b] > 1)) for k, first, n, chunk in told for a, b in [cuts[k]]])

    return confirm


def _remove(window: int, bits: int, keep_text: bool):
    def remove(docs: pa.Table, answers: pa.Table) -> pa.Table:
        offsets, data = string_bytes(docs["text"])
        at, (h, g), first = window_hashes(offsets, data, window)
        n_words = int(first[-1])
        change = np.zeros(n_words + 1, np.int32)
        if len(h):
            told = sorted(zip(*[answers[c].to_pylist() for c in ("bucket", "first", "n_first", "repeated", "n")]))
            hit = np.flatnonzero(_hits(h, bits, [(x, n) for _, x, n, _, _ in told]))
            *_, which = _distinct(h[hit], g[hit])
            bad = np.concatenate([_flags(x, n) for *_, x, n in told])
            hit = at[hit[bad[which]]]
            change += np.bincount(hit, minlength=n_words + 1) - np.bincount(hit + window, minlength=n_words + 1)
        gone = np.cumsum(change[:-1]) > 0
        before = np.concatenate([[0], np.cumsum(gone)])
        edges = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
        edges_up, edges_down = np.flatnonzero(edges > 0), np.flatnonzero(edges < 0)
        whole, shas, kept_texts, spans = data.tobytes(), [], [], []
        for d in range(docs.num_rows):
            a, b = int(first[d]), int(first[d + 1])
            words = whole[offsets[d] : offsets[d + 1]].split()
            runs = []
            if before[b] > before[a]:
                words = list(compress(words, ~gone[a:b]))
                lo, hi = np.searchsorted(edges_down, a, "right"), np.searchsorted(edges_up, b)
                runs = [{"start": max(int(s), a) - a, "end": min(int(e), b) - a} for s, e in zip(edges_up[lo:hi], edges_down[lo:hi])]
            kept = b" ".join(words)
            shas.append(hashlib.sha256(kept).hexdigest())
            spans.append(runs)
            if keep_text:
                kept_texts.append(kept.decode())
        out = {
            "doc_id": docs["doc_id"],
            "n_words": pa.array(np.diff(first), pa.int64()),
            "n_removed": pa.array(before[first[1:]] - before[first[:-1]], pa.int64()),
            "kept_sha256": pa.array(shas, pa.string()),
            "removed": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        }
        if keep_text:
            out["kept_text"] = pa.array(kept_texts, pa.string())
        return pa.table(out)

    return remove


def substring_dedup(docs: DataFrame, window: int = 35, keep_text: bool = False, chunk_bytes: int = CHUNK_BYTES, chunk_rows: int = CHUNK_ROWS, bucket_windows: int = BUCKET_WINDOWS) -> DataFrame:
    """Remove each word that a repeated window of `window` words covers.

    Returns doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space), removed (maximal
    intervals of word numbers, end exclusive) and, with keep_text, kept_text.  One row out for each row in: repeated
    rows, repeated ids and null ids are rows like any other, dealt to chunks one by one.  Null and empty texts have no
    words; a text shorter than a window loses nothing.  An empty table gives no rows; other columns are ignored.  A chunk
    holds about chunk_bytes of text and chunk_rows rows, and a longer text whole.

    Windows are equal if two hashes of 61 bits agree, polynomials of the words' XXH3 at bases drawn at random.  Two given
    windows that differ agree by chance with about (window / 2**61)**2, whatever their words look like: over n windows
    about n*n * window**2 / 2**123, 1e-8 at 1e13 windows.  Rows are told apart by their place in the input, so docs
    should come from a table, where a lost task finds them in the same order.
    """
    docs = docs.select("doc_id", "text")
    total, rows = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).first()
    chunks = max(1, -(-total // chunk_bytes), -(-rows // chunk_rows))
    bits = max(0, int(np.ceil(np.log2(max(1, total / 6 / bucket_windows)))))
    dealt = docs.withColumn("chunk", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(chunks)))
    by_chunk = dealt.groupBy("chunk")
    first = by_chunk.applyInArrow(_send(window, bits), _SENT).groupBy("bucket").applyInArrow(_count, _ANSWER)
    hits = by_chunk.cogroup(first.groupBy("chunk")).applyInArrow(_confirm(window, bits), _SENT)
    answers = hits.groupBy("bucket").applyInArrow(_count, _ANSWER)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_words long, n_removed long, kept_sha256 string, removed array<struct<start:long,end:long>>" + ", kept_text string" * keep_text
    return by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(_remove(window, bits, keep_text), schema)
