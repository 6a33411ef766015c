"""Pairs of sequences of which the later is, but for a share of edits, a part of the earlier one: every such pair, found by seeds.

A sequence that may have k edits is cut into k // 2 + 1 parts, of which one has one edit at most.  More than that: put into groups, and these into blocks
of at most 64 bases, a group or block of c parts with 2c - 1 edits at most holds a smaller one of which this is true, down to a part with one.  So
each pair has such a part, in such a group, in such a block, and what is found is tried in this order:

- parts of up to _LISTED bases: all texts with one edit at most are listed and looked up in the earlier sequences.  Parts of up to _PAIRED bases go
  in twos; the neighbour must follow (or precede) with the edits that are left.
- longer ones: a part of blocks of b, b - 1 and b bases with one edit has two left whole: the first two, the last two, or the outer two, around a gap
  that is as long as the middle block, or one base longer or shorter.  So it shares a run of 2b - 1 bases, or two runs around a gap, with the other
  sequence.  What lies next to them is compared as bits and must fit with one edit.
- the block of the part must fit near there, then spans of 4, 16 and 64 blocks around it, then the whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import written

_NONE = np.uint64(2**64 - 1)
_ACGT = np.frombuffer(b"ACGT", np.uint8)
#: Two bits for each letter.  Seeds spread other letters than A, C, G and T over the four (equal ones stay equal); words count them as A.
_CODE, _WORD_CODE = np.arange(256) * 0x9E37 >> 7 & 3, np.zeros(256, np.uint16)
_CODE[_ACGT] = _WORD_CODE[_ACGT] = range(4)
#: The largest b of a longer part.  Bases of the words that are counted before edits are.  Bits of the filter of seeds.
_BLOCK, _WORD, _FILTER_BITS = 10, 5, 25
#: Bases of parts whose texts with one edit are listed, and of those that go in twos.  Hits of a block in a stretch of so many places are tried once.
_LISTED, _PAIRED, _STRETCH = 16, 12, 16
#: Sequences of more bases are long.
_LONG = 1024
#: Zeros around the bases of texts, so that no window around a hit leaves them.
_PAD = 256


def allowed_edits(n: int, identity: float) -> int:
    return int((1 - identity) * n + 1e-9)


def expected_hits(n: int, identity: float, bases: int) -> float:
    """Places where a part of a sequence of n bases is found in so many random ones, about."""
    parts = allowed_edits(n, identity) // 2 + 1
    size = n // parts
    return bases * parts * (10 * size / 4**size if size <= _LISTED else 5 / 4 ** (2 * min((size + 1) // 3, _BLOCK) - 1))


def _bits(code: np.ndarray, size: int) -> np.ndarray:
    """At each place, `size` (a power of two, up to 64) places' bits, the nearest lowest; code has zeros behind its end."""
    out, i = code.astype(np.uint64), 1
    while i < size:
        out[:-i] |= out[i:] << np.uint64(i)
        i *= 2
    return out


class _Runs:
    """Sequences' bases, one behind the other, and their runs as numbers."""

    def __init__(self, texts: list[str]):
        pad = np.zeros(_PAD, np.int64)
        own = _CODE[np.frombuffer("".join(texts).encode("latin-1", "replace"), np.uint8)]
        self.n = np.array([len(x) for x in texts], np.int64)
        self.start = len(pad) + np.cumsum(self.n) - self.n
        self.code = np.concatenate([pad, own, pad])
        self.known: dict[tuple[int, bool], np.ndarray] = {}

    @cached_property
    def row(self) -> np.ndarray:
        """The text of each place; those before and behind all count to the next."""
        last = max(len(self.n) - 1, 0)
        return np.concatenate([np.zeros(_PAD, np.int64), np.repeat(np.arange(len(self.n)), self.n), np.full(_PAD, last)])

    def _packed(self, size: int, back: bool) -> np.ndarray:
        """At each place, the `size` bases from there on (back: in the order of the reversed text) in bits, the nearest lowest."""
        if (size, back) not in self.known:
            code = self.code[::-1] if back else self.code
            out = np.zeros(len(code), np.int64)
            for i in range(size):
                out[: len(code) - i] |= code[i:] << 2 * i
            self.known[size, back] = out
        return self.known[size, back]

    def after(self, at: np.ndarray, size: int) -> np.ndarray:
        """The bases from each place on, the nearest in the lowest bits."""
        return self._packed(size, False)[at]

    def before(self, at: np.ndarray, size: int) -> np.ndarray:
        """The bases that end before each place, the nearest in the lowest bits."""
        return self._packed(size, True)[len(self.code) - at]

    def run(self, at: np.ndarray, b: int) -> np.ndarray:
        return self.after(at, 2 * b - 1) | b << 50

    def outer(self, at: np.ndarray, b: int, shift: int = 0) -> np.ndarray:
        """Runs of b and b - 1 bases around a gap of b - 1 bases, or one more or less."""
        return self.after(at, b) | self.after(at + 2 * b - 1 + shift, b - 1) << 2 * b | b << 50 | 1 << 56

    def planes(self, size: int, back: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """The low and the high bits of the `size` bases from each place on (back: that end before it, the nearest lowest)."""
        code = self.code[::-1] if back else self.code
        low, high = _bits(code & 1, size), _bits(code >> 1, size)
        return tuple(np.append(x, np.uint64(0))[::-1] for x in (low, high)) if back else (low, high)


class _Index:
    """Numbers, looked up: seed, in order, and row (below 2 ** 27), what stands at each."""

    def __init__(self, seed: np.ndarray, row: np.ndarray):
        if len(seed) and seed.max() < 1 << 36:
            both = np.sort(seed << 27 | row)
            seed, self.row = both >> 27, (both & ((1 << 27) - 1)).astype(np.int32)
        else:
            order = np.argsort(seed)
            seed, self.row = seed[order], row[order]
        first = np.flatnonzero(np.concatenate([[True], seed[1:] != seed[:-1]])) if len(seed) else np.zeros(0, np.int64)
        self.seed, self.ends = seed[first], np.append(first, len(seed))
        slot = _distinct(_slot(self.seed))
        self.told, word = np.zeros(1 << (_FILTER_BITS - 6), np.uint64), (slot >> np.uint64(6)).astype(np.int64)
        if len(slot):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            self.told[word[first]] = np.bitwise_or.reduceat(np.uint64(1) << (slot & np.uint64(63)), first)

    def may_have(self, seed: np.ndarray) -> np.ndarray:
        """Places of the seeds that may be there, by a bit for each hash: 4 MB, whatever there is of them."""
        slot = _slot(seed)
        return np.flatnonzero((self.told[(slot >> np.uint64(6)).view(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1))

    def found(self, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(places in seed of those that are there, their first rows, how many)."""
        nth = np.minimum(np.searchsorted(self.seed, seed), max(len(self.seed) - 1, 0))
        own = np.flatnonzero(self.seed[nth] == seed) if len(self.seed) else nth[:0]
        return own, self.ends[nth[own]], self.ends[nth[own] + 1] - self.ends[nth[own]]


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def _slot(seed: np.ndarray) -> np.ndarray:
    return (seed.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _FILTER_BITS)


def _each(low: np.ndarray, count: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place in low, row) of the rows low, low + 1, ..., so many of each; about `most` at once."""
    ends, begun = np.cumsum(count), 0
    while begun < len(low):
        before = ends[begun - 1] if begun else 0
        stop = max(begun + 1, int(np.searchsorted(ends, before + most, "right")))
        c = count[begun:stop]
        yield np.repeat(np.arange(begun, stop), c), np.arange(before, ends[stop - 1]) + np.repeat(low[begun:stop] - (ends[begun:stop] - c), c)
        begun = stop


def with_one_edit(code: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(place in code, text, edits) of all texts with one edit at most of texts of `size` bases, as numbers with a 1 in front.

    A base added at an end is not listed, nor one like its left neighbour: the text itself is found there, or the base is added further left.
    """
    rows, low = np.arange(len(code)), lambda i: code & ((1 << 2 * i) - 1)
    base = [code >> 2 * i & 3 for i in range(size)]
    yield rows, code | 1 << 2 * size, 0
    for i in range(size):
        for d in (1, 2, 3):
            yield rows, code ^ d << 2 * i | 1 << 2 * size, 1
        own = rows if i == size - 1 else np.flatnonzero(base[i] != base[i + 1])
        yield own, (low(i) | code >> 2 * (i + 1) << 2 * i | 1 << 2 * (size - 1))[own], 1
        for c in range(4) if i else ():
            own = np.flatnonzero(base[i - 1] != c)
            yield own, (low(i) | c << 2 * i | code >> 2 * i << 2 * (i + 1) | 1 << 2 * (size + 1))[own], 1


def _may_follow(low: np.ndarray, high: np.ndarray, size: np.ndarray, near: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Whether one of three runs (bases 0 to 2, 3 to 5 and 6 to 8 of texts of `size` bases) is whole in what is near, at most two places off: true with two edits."""
    inside, bad = np.left_shift(1, size) - 1, np.uint16(0xFFFF)
    for shift in (0, -1, 1, -2, 2):
        if shift < 0:
            x = (low ^ (near[0] << -shift)) | (high ^ (near[1] << -shift)) | np.uint16((1 << -shift) - 1)
        else:
            x = (low ^ (near[0] >> shift)) | (high ^ (near[1] >> shift))
        x &= inside
        bad = bad & (x | x >> 1 | x >> 2)
    return bad & 0b1001001 != 0b1001001


def _after_or_before(part: dict[str, np.ndarray], near: tuple[np.ndarray, np.ndarray], most: np.ndarray) -> np.ndarray:
    """Places of the texts (low and high bits of up to 12 bases, their size) that are, with `most` edits, up to 3, the beginning of what is near (low and high bits)."""
    out = []
    for a in range(0, len(most), 1 << 13):
        low, high, size, left, s, t = (x[a : a + (1 << 13)] for x in (part["low"], part["high"], part["size"], most, *near))
        some = np.flatnonzero(_may_follow(low, high, size, (s, t)) | (left > 2))
        out.append(a + some)
    some = np.concatenate([np.zeros(0, np.int64), *out])
    size, most, out = part["size"][some], most[some], np.empty(len(some), bool)
    own = [(x << 16 - size).view(np.int16) for x in (part["low"][some], part["high"][some])]  # in the upper bits
    dummy, near = (np.left_shift(1, 16 - size) - np.uint16(1)).view(np.int16), [x[some].view(np.int16) for x in near]
    for a in range(0, len(most), 1 << 13):
        low, high, blank, s, t = (x[a : a + (1 << 13)] for x in (*own, dummy, *near))
        pv, mv = ~blank, np.zeros_like(blank)
        score = size[a : a + (1 << 13)].astype(np.int16)
        best = score.copy()
        for j in range(min(int(score.max()) + 3, 16)):
            eq = ~((low ^ (s << 15 - j >> 15)) | (high ^ (t << 15 - j >> 15)) | blank)
            xv, xh = eq | mv, ((eq & pv) + pv ^ pv) | eq
            ph, mh = mv | ~(xh | pv), pv & xh
            score = score - (ph >> 15) + (mh >> 15)
            np.minimum(best, score, out=best)
            ph = ph << 1 | 1
            pv, mv = mh << 1 | ~(xv | ph), ph & xv
        out[a : a + (1 << 13)] = best <= most[a : a + (1 << 13)]
    return some[out]


def _block_fits(low: np.ndarray, high: np.ndarray, size: np.ndarray, most: np.ndarray, at: np.ndarray, planes: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Whether each block (bits of `size` bases, in the upper bits) has `most` edits at most as a part of the window at `at`, of two stretches more."""
    out = np.empty(len(at), bool)
    own, planes = [x.view(np.int64) for x in (low, high)], [x.view(np.int64) for x in planes]
    for a in range(0, len(at), 1 << 12):
        low, high = (x[a : a + (1 << 12)] for x in own)
        n, e, w = (x[a : a + (1 << 12)] for x in (size, most, at))
        dummy = np.where(n == 64, np.int64(0), (np.int64(1) << np.minimum(64 - n, 63)) - 1)
        pv, mv = ~dummy, np.zeros_like(dummy)
        score = n.astype(np.int64)
        best = score.copy()
        for j in range(int((n + 2 * e).max()) + 2 * _STRETCH + 2):
            if j % 64 == 0:
                s, t = planes[0][w + j], planes[1][w + j]
            eq = ~((low ^ (s << 63 - j % 64 >> 63)) | (high ^ (t << 63 - j % 64 >> 63))) | dummy
            xv, xh = eq | mv, ((eq & pv) + pv ^ pv) | eq
            ph, mh = mv | ~(xh | pv), pv & xh
            score = score - (ph >> 63) + (mh >> 63)
            np.minimum(best, score, out=best)
            ph <<= 1
            pv, mv = mh << 1 | ~(xv | ph), ph & xv
        out[a : a + (1 << 12)] = best <= e
    return out


class _Late:
    """A block of later sequences: their parts, blocks and seeds."""

    def __init__(self, texts: list[str], key: np.ndarray, identity: float):
        self.texts, self.key = texts, np.asarray(key, np.int64)
        runs = _Runs(texts)
        self.n, n = runs.n, np.maximum(runs.n, 1)
        self.most = np.array([allowed_edits(x, identity) for x in self.n.tolist()], np.int64)
        count = np.where(self.n > 0, self.most // 2 + 1, 0)
        row = np.repeat(np.arange(len(n)), count)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        at = nth * n[row] // count[row]
        size = (nth + 1) * n[row] // count[row] - at
        longest = -(-n // np.maximum(count, 1))
        paired, held = longest <= _PAIRED, np.maximum(64 // longest, 1)
        unit, units, held = np.where(paired[row], nth // 2, nth), np.where(paired, (count + 1) // 2, count), np.where(paired, held // 2, held)
        blocks = -(-units // held)
        block = (np.cumsum(blocks) - blocks)[row] + unit * blocks[row] // np.maximum(units[row], 1)
        self.row, self.at, self.block = row, at, block

        first = np.flatnonzero(np.diff(block, prepend=-1))
        last = np.append(first[1:], len(block)) - 1 if len(first) else first
        self.block_row, self.block_at = row[first], at[first]
        self.block_size = np.minimum((at + size)[last] - at[first], 64)
        self.block_most = np.minimum(2 * (last - first + 1) - 1, self.most[row[first]])
        place, up = runs.start[self.block_row] + self.block_at, (64 - self.block_size).astype(np.uint64)
        self.block_low, self.block_high = (x[place] << up for x in runs.planes(64))

        # Spans of up to 4, 16 and 64 blocks: for each block its span, for each span what it is of; a sequence of one span is left to the whole.
        nth_block = np.arange(len(first)) - (np.cumsum(blocks) - blocks)[self.block_row]
        self.levels = []
        for held in (4, 16, 64):
            spans = -(-blocks // held)
            span = (np.cumsum(spans) - spans)[self.block_row] + nth_block * spans[self.block_row] // blocks[self.block_row]
            begun = np.flatnonzero(np.diff(span, prepend=-1))
            ended = np.append(begun[1:], len(span)) - 1 if len(begun) else begun
            own = self.block_row[begun]
            most = np.minimum(2 * (last[ended] - first[begun] + 1) - 1, self.most[own])
            self.levels.append((spans <= 1, span, own, self.block_at[begun], self.block_at[ended] + self.block_size[ended], most, 16 * held if held < 64 else 0))

        # Words of long sequences, which may share repeats with many others: a pair that lacks too many needs no look at its blocks.
        own = np.flatnonzero((self.n > _LONG) & (self.n > _WORD * (self.most + 1)))
        self.long_row = np.full(len(texts), -1)
        self.long_row[own] = np.arange(len(own))
        self.long_most, self.words = _WORD * self.most[own], [_word_counts([texts[r]])[0] for r in own.tolist()]

        # Parts whose texts with one edit are listed, by what goes with them: 0 nothing, 1 the part behind, 2 the one before.
        side = np.where(paired[row] & (nth % 2 == 0) & (nth + 1 < count[row]), 1, np.where(paired[row] & (nth % 2 == 1), 2, 0))
        self.listed: list[_Index | None] = []
        self.beside: list[dict[str, np.ndarray]] = []  # for each part, what goes with it, and the edits of both
        for s in (0, 1, 2):
            seeds, parts = [], []
            for z in np.unique(size[(side == s) & (size <= _LISTED)]).tolist():
                own = np.flatnonzero((side == s) & (size == z))
                for some, seed, edits in with_one_edit(runs.after(runs.start[row[own]] + at[own], z), z):
                    some = own[some]
                    if edits:
                        kept = self.most[row[some]] > 0
                        some, seed = some[kept], seed[kept]
                    seeds.append(seed)
                    parts.append(some << 1 | edits)
            self.listed.append(_Index(np.concatenate(seeds), np.concatenate(parts)) if seeds else None)
            self.beside.append({})
            if s:
                own = np.flatnonzero(side == s)
                other = own + (1 if s == 1 else -1)
                place, inside = runs.start[row[other]] + at[other] + (0 if s == 1 else size[other]), ((1 << size[other]) - 1).astype(np.uint64)
                low, high = ((x[place] & inside).astype(np.uint16) for x in runs.planes(16, back=s == 2))
                for c, v in (("low", low), ("high", high), ("size", size[other].astype(np.uint16)), ("most", np.minimum(3, self.most[row[own]]).astype(np.int16))):
                    self.beside[s][c] = np.zeros(len(row), v.dtype)
                    self.beside[s][c][own] = v
        self.lengths = [[] if x is None else np.unique(np.frexp(x.seed.astype(float))[1] - 1 >> 1).tolist() for x in self.listed]

        # Longer parts: seed, kind, at (where the seed begins in the text), near (the bases that must fit beside it) and size (how many).
        # kind: what lies behind (0) or before (1) a run, or inside and behind two (2).
        long: dict[str, list[np.ndarray]] = {c: [] for c in ("seed", "part", "kind", "at", "near", "size")}
        b = np.where(size > _LISTED, np.minimum((size + 1) // 3, _BLOCK), 0)
        self.sizes = [x for x in np.unique(b).tolist() if x]
        for x in self.sizes:
            own = np.flatnonzero(b == x)
            begin, place = at[own], runs.start[row[own]] + at[own]
            seeds = [(runs.run(place, x), 0, begin, runs.after(place + 2 * x - 1, x), x), (runs.run(place + x, x), 1, begin + x, runs.before(place + x, x), x)]
            seeds += [(runs.outer(place, x, shift), 2, begin, runs.after(place + x, 2 * x - 1), 2 * x - 1) for shift in (0, -1, 1)]
            for seed, kind, where, near, z in seeds:
                for c, v in zip(long, (seed, own, np.full(len(own), kind), where, near, np.full(len(own), z))):
                    long[c].append(v)
        if self.sizes:
            self.long_rows = {c: np.concatenate(v) for c, v in long.items()}
            seed = self.long_rows.pop("seed")
            self.long = _Index(seed, np.arange(len(seed)))


def _chunks(batches: Iterator[pd.DataFrame], most: int = 1 << 20) -> Iterator[pd.DataFrame]:
    """Rows of about `most` bases together; a longer sequence is alone."""
    for batch in batches:
        size = batch["seq"].str.len().cumsum().to_numpy()
        at = 0
        while at < len(batch):
            end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + most, "right")))
            yield batch[at:end]
            at = end


def _fits(a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether what is near a seed fits with one edit: `size` bases of the later text, a, and one more of the other, b, differ from bit p on."""
    low = lambda n: (np.int64(1) << n) - 1
    x = (a ^ b) & low(2 * size)
    p = np.bitwise_count((x & -x) - 1).astype(np.int64) & ~1
    some = np.flatnonzero(x)
    a, b, size, q = a[some], b[some], size[some], p[some]
    out = x == 0
    out[some] = (x[some] >> (q + 2) == 0) | (((a >> q) ^ (b >> (q + 2))) & low(2 * size - q) == 0) | (((a >> (q + 2)) ^ (b >> q)) & low(np.maximum(2 * size - q - 2, 0)) == 0)
    return out


def _listed_hits(late: _Late, runs: _Runs, most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(part, place) where a listed part begins in runs, with one edit at most, and what goes with it fits."""
    places = np.arange(_PAD, len(runs.code) - _PAD)
    planes: dict[bool, tuple[np.ndarray, np.ndarray]] = {}
    for side, (index, lengths) in enumerate(zip(late.listed, late.lengths)):
        for size in lengths:
            seed = runs.after(places, size) | 1 << 2 * size
            some = index.may_have(seed)
            own, low, count = index.found(seed[some])
            at = places[some[own]]
            if side and bool(side - 1) not in planes:
                planes[bool(side - 1)] = tuple(x.astype(np.uint16) for x in runs.planes(16, back=side == 2))
            for i, entry in _each(low, count, most):
                edits, place = index.row[entry] & 1, at[i]
                part = index.row[entry] >> 1
                if side:
                    near = tuple(x[place + (size if side == 1 else 0)] for x in planes[side == 2])
                    other = {c: v[part] for c, v in late.beside[side].items()}
                    some = _after_or_before(other, near, (other["most"] - edits).astype(np.int16))
                    part, place = part[some], place[some]
                yield part, place - late.at[part]


def _long_hits(late: _Late, runs: _Runs, most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(part, place) where a longer part lies in runs with one edit at most."""
    places = np.arange(_PAD, len(runs.code) - _PAD)
    for b in late.sizes:
        for kind in (0, 2):
            seed = runs.outer(places, b) if kind else runs.run(places, b)
            some = late.long.may_have(seed)
            seed, at = seed[some], places[some]
            near = runs.after(at + b, 2 * b) if kind else runs.after(at + 2 * b - 1, b + 1) | runs.before(at, b + 1) << 2 * (b + 1)
            # Of places of a stretch that look the same, as in repeats, the first will do.
            new, stretch = np.ones(len(at), bool), runs.row[at] << 32 | at // _STRETCH
            for d in range(1, 9):
                new[d:] &= (seed[d:] != seed[:-d]) | (near[d:] != near[:-d]) | (stretch[d:] != stretch[:-d])
            seed, at, near = seed[new], at[new], near[new]
            own, low, count = late.long.found(seed)
            at, near = at[own], near[own]
            rows = late.long_rows
            for i, entry in _each(low, count, most):
                entry, own = late.long.row[entry], near[i]
                size = rows["size"][entry]
                other = np.where(rows["kind"][entry] == 1, own >> 2 * (size + 1), own)
                some = np.flatnonzero(_fits(rows["near"][entry], other, size))
                entry = entry[some]
                yield rows["part"][entry], at[i[some]] - rows["at"][entry]


def _in_blocks(late: _Late, others: list[str], early_key: np.ndarray, runs: _Runs, most: int = 1 << 19) -> Iterator[tuple[np.ndarray, ...]]:
    """(block, early row, low end of the shifts) where a hit's block fits."""
    room = runs.n // _STRETCH + 2 * (_PAD // 2 // _STRETCH) + 2  # stretches of each early sequence, with some before and behind
    base = np.cumsum(room) - room
    total = int(room.sum())
    planes, held, count = None, [], 0
    words: dict[int, np.ndarray] = {}
    told = np.zeros((len(late.words), len(others)), np.int8)  # 1: too many words of the long sequence are missing, 2: not so
    for part, begin in chain(*[f(late, runs) for f, has in ((_listed_hits, any(late.lengths)), (_long_hits, bool(late.sizes))) if has], [(None, None)]):
        if part is not None:
            row = runs.row[np.clip(begin + late.at[part], 0, len(runs.row) - 1)]
            block = late.block[part]
            some = np.flatnonzero(early_key[row] < late.key[late.row[part]])
            part, begin, row, block = part[some], begin[some], row[some], block[some]
            if len(told):
                long = late.long_row[late.row[part]]
                for z, y in zip(*np.divmod(_distinct((long * len(others) + row)[long >= 0]), len(others))):
                    if not told[z, y]:
                        if y not in words:
                            words[y] = _word_counts([others[y]])[0]
                        told[z, y] = 1 if np.maximum(late.words[z] - words[y], 0).sum() > late.long_most[z] else 2
                some = np.flatnonzero((long < 0) | (told[long, row] == 2))
                part, begin, row, block = part[some], begin[some], row[some], block[some]
            nth = np.clip((begin + late.block_at[block] - runs.start[row] + _PAD // 2) // _STRETCH, 0, room[row] - 1)
            held.append(_distinct(block * total + base[row] + nth))
            count += len(held[-1])
        if held and (count >= most or part is None):
            at = _distinct(np.concatenate(held))
            held, count = [], 0
            block, at = at // total, at % total
            row = np.searchsorted(base, at, "right") - 1
            place = (at - base[row]) * _STRETCH - _PAD // 2  # of the stretch, in the early sequence
            planes = planes or runs.planes(64)
            window = runs.start[row] + place - late.block_most[block] - 1
            some = np.flatnonzero(_block_fits(late.block_low[block], late.block_high[block], late.block_size[block], late.block_most[block], np.maximum(window, 0), planes))
            yield block[some], row[some], place[some] - late.block_at[block[some]]


def _in_spans(late: _Late, block: np.ndarray, row: np.ndarray, low: np.ndarray, others: list[str]) -> np.ndarray:
    """Which of _in_blocks' finds are in spans that fit."""
    out = np.arange(len(block))
    for whole, span, span_row, at, end, most, room in late.levels:
        some = np.flatnonzero(~whole[late.block_row[block[out]]])
        if not len(some):
            break
        own = out[some]
        shift = low[own] // room if room else np.zeros(len(own), np.int64)  # 0: all shifts at once
        least, shifts = int(shift.min()), int(np.ptp(shift)) + 1
        key, nth = np.unique((span[block[own]] * len(others) + row[own]) * shifts + shift - least, return_inverse=True)
        z, y, fits = key // shifts // len(others), key // shifts % len(others), []
        begin, last = np.full(len(key), np.iinfo(np.int64).max), np.full(len(key), np.iinfo(np.int64).min)
        np.minimum.at(begin, nth, low[own])
        np.maximum.at(last, nth, low[own])
        for a in range(0, len(z), 20_000):
            x = z[a : a + 20_000]
            start = np.maximum(begin[a : a + 20_000] + at[x] - most[x] - 1, 0)
            stop = np.maximum(last[a : a + 20_000] + end[x] + most[x] + 2 * _STRETCH + 1, 0)
            short = [late.texts[r][s:t] for r, s, t in zip(span_row[x].tolist(), at[x].tolist(), end[x].tolist())]
            fits.append(edits_up_to(short, [others[r][s:t] for r, s, t in zip(y[a : a + 20_000].tolist(), start.tolist(), stop.tolist())], most[x]) <= most[x])
        kept = np.ones(len(out), bool)
        kept[some] = np.concatenate(fits)[nth]
        out = out[kept]
    return out


def _grouped(pair: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each pair once: its least low, its greatest high."""
    order = np.argsort(pair)
    pair = pair[order]
    first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]])) if len(pair) else order
    return (pair[first], np.minimum.reduceat(low[order], first), np.maximum.reduceat(high[order], first)) if len(first) else (pair, low, high)


class Pairs:
    """The pairs of nodes (key, seq, n; longer ones have smaller keys): late, early, edits and identity of all with an early key below the late one's.

    Later sequences are dealt into blocks of at most late_bases bases (None: a thirty-second of all, 131,072 to 4 million) or `hits` expected hits, earlier ones into
    blocks of early_bases, by key.  A block is a row.  Each two blocks meet in a Cartesian product, whose tasks read blocks where they lie, and the seeds of the
    ones are looked up in those of the others; no seed is written or shuffled.  So a sequence is shuffled as often as it is packed, however many
    blocks there are of the others, and no task holds more than a batch of pairs of blocks.
    """

    def __init__(self, nodes: DataFrame, identity: float, late_bases: int | None = None, early_bases: int = 1 << 22, hits: int = 1 << 24):
        self.identity = float(identity)
        lengths = sorted(((n, key, c) for n, key, c in nodes.groupBy("n").agg(F.min("key"), F.count("*")).collect()), reverse=True)
        bases = sum(n * c for n, _, c in lengths)
        late_bases = late_bases or min(max(bases // 32, 1 << 17), 1 << 22)
        share = lambda n: max(n / late_bases, expected_hits(n, self.identity, min(bases, early_bases)) / hits) if n else 0
        self.cuts = [self._cuts([(share(n), key, c) for n, key, c in lengths]), self._cuts([(n / early_bases, key, c) for n, key, c in lengths])]

    @staticmethod
    def _cuts(sizes: list[tuple[float, int, int]]) -> list[int]:
        """The first keys of all blocks but the first, of (a sequence's share of a block, first key, sequences) in order of keys."""
        out, held = [], 0.0
        for size, key, c in sizes:
            while c:
                room = int((1 - held) / size) if size else c
                if room >= c:
                    held += c * size
                    break
                key, c, held = key + room, c - room, 0.0
                if key > 1:
                    out.append(key)
                if size >= 1:
                    key, c, held = key + 1, c - 1, 1.0
        return sorted(set(out))

    def _blocks(self, df: DataFrame, side: int, most: int = 1000) -> DataFrame:
        """block, least (of the keys), last, key and seq (arrays; mask too) of df (key, seq and maybe mask), dealt by block."""
        block = F.size(F.filter(F.array(*map(F.lit, self.cuts[side])).cast("array<long>"), lambda x: x <= F.col("key")))
        own = [c for c in ("key", "seq", "mask") if c in df.columns]
        rows = df.select(block.alias("block"), F.struct(*own).alias("x")).groupBy("block").agg(F.min("x.key").alias("least"), F.max("x.key").alias("last"), F.collect_list("x").alias("x"))
        return rows.select("block", "least", "last", *[f"x.{c}" for c in own]).repartitionById(min(len(self.cuts[side]) + 1, most), "block")

    def packed(self, early: DataFrame) -> DataFrame:
        """early (key, seq and maybe mask) in blocks, written: what `of` takes; such tables may be united."""
        return written(self._blocks(early, 1))

    def _met(self, late: DataFrame, early: DataFrame) -> DataFrame:
        """A row for each block of late and each of early that has earlier keys; early's columns are called early, long and has (its mask)."""
        early = early if "block" in early.columns else self.packed(early)
        names = {"key": "early", "seq": "long", "mask": "has"}
        own = [c for c in names if c in early.columns]
        other = early.select(F.col("least").alias("_least"), *[F.col(c).alias(names[c]) for c in own])
        return self._blocks(late, 0).hint("shuffle_replicate_nl").join(other, F.col("_least") < F.col("last")).select("block", *own, *[names[c] for c in own])

    def of(self, late: DataFrame, early: DataFrame) -> DataFrame:
        """late, early, edits and identity of the pairs between late (key, seq) and early (key, seq, or packed)."""
        identity = self.identity

        def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            block, own = None, None  # a later block is followed by all earlier ones of the task
            for batch in batches:
                for row in batch.itertuples(index=False):
                    if own is None or row.block != block:
                        block, own = row.block, _Late(list(row.seq), row.key, identity)
                    yield from _verified(_near(own, list(row.long), row.early))

        return self._met(late, early).mapInPandas(meet, "late long, early long, edits int, identity double")

    def masked(self, late: DataFrame, early: DataFrame, held: Callable[[np.ndarray, np.ndarray], np.ndarray], words: int, united: bool = False) -> DataFrame:
        """Links between late and early (key, seq and mask, an array of `words` longs; early maybe packed): late, early and w0, w1, ..., the bits that are in both
        masks and in held(length of the later, edits).

        Pairs without a bit in common are not verified, and links without one are left out.  united: late and the union of its links' bits (in some
        rows for each late) instead, so no link leaves its task; pairs that could add no bit to what the task has are not verified then.
        """
        identity, names = self.identity, [f"w{i}" for i in range(words)]

        def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            block, own, left, found = None, None, None, None
            rows = lambda mask: np.array([list(x) for x in mask], np.int64).reshape(-1, words)
            for batch in batches:
                for row in batch.itertuples(index=False):
                    if own is None or row.block != block:
                        if found is not None and found.any():
                            yield _with_words(own.key, found, names)
                        block, own, left = row.block, _Late(list(row.seq), row.key, identity), rows(row.mask)
                        found = np.zeros_like(left) if united else None
                        of_late = np.argsort(own.key)
                    has, of_early = rows(row.has), np.argsort(row.early)
                    for pairs in _verified(_near(own, list(row.long), row.early, lambda x, y, left=left, has=has: (left[x] & has[y]).any(1))):
                        late, early = pairs["late"].to_numpy(), pairs["early"].to_numpy()
                        x, y = of_late[np.searchsorted(own.key, late, sorter=of_late)], of_early[np.searchsorted(row.early, early, sorter=of_early)]
                        bits = left[x] & has[y] & held(own.n[x], pairs["edits"].to_numpy())
                        if united:
                            np.bitwise_or.at(found, x, bits)
                            left[x] &= ~found[x]
                        else:
                            yield _with_words(late, bits, names, early)
            if found is not None and found.any():
                yield _with_words(own.key, found, names)

        return self._met(late, early).mapInPandas(meet, ", ".join(f"{c} long" for c in ["late", *([] if united else ["early"]), *names]))


def _with_words(late: np.ndarray, bits: np.ndarray, names: list[str], early: np.ndarray | None = None) -> pd.DataFrame:
    some = bits.any(1)
    keys = {"late": late[some]} | ({} if early is None else {"early": early[some]})
    return pd.DataFrame(keys | dict(zip(names, bits[some].T)))


def _near(late: _Late, early: list[str], early_key: np.ndarray, wanted: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None) -> Iterator[pd.DataFrame]:
    """late, early, short, laid (where short may lie in the other) and most of the pairs of a block of later and one of earlier sequences of which a block fits.

    wanted tells of places in late and in early which pairs to give.
    """
    texts, key, n, most = late.texts, late.key, late.n, late.most
    order = np.argsort(early_key, kind="stable")
    for some in _chunks(iter([pd.DataFrame({"key": np.asarray(early_key, np.int64), "seq": early}).iloc[order]])):
        others, other_key = list(some["seq"]), some["key"].to_numpy(np.int64)
        if other_key[0] >= key.max():
            return
        found = list(_in_blocks(late, others, other_key, _Runs(others)))
        if not found:
            continue
        block, j, low = map(np.concatenate, zip(*found))
        fits = _in_spans(late, block, j, low, others)
        block, j, low = block[fits], j[fits], low[fits]
        pair, low, high = _grouped(j * len(texts) + late.block_row[block], low, low + 2 * _STRETCH - 1)
        for at in range(0, len(pair), 20_000):
            y, x = np.divmod(pair[at : at + 20_000], len(texts))
            first, last = low[at : at + 20_000], high[at : at + 20_000]
            if wanted is not None:
                kept = np.flatnonzero(wanted(x, some.index.to_numpy()[y]))
                x, y, first, last = x[kept], y[kept], first[kept], last[kept]
            start = np.maximum(first - most[x] - 1, 0)
            end = last + 1 + n[x] + most[x]
            laid = [others[r][s:t] for r, s, t in zip(y.tolist(), start.tolist(), end.tolist())]
            yield pd.DataFrame({"late": key[x], "early": other_key[y], "short": [texts[r] for r in x.tolist()], "laid": laid, "most": most[x]})


def _verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The pairs with at most `most` edits.  Those with enough words in common are gathered, so that edits are counted for many at once."""
    held, size = [], 0
    for batch in chain(batches, [None]):
        if batch is not None:
            told = np.flatnonzero(batch["short"].str.len().to_numpy() > _WORD * (batch["most"].to_numpy() + 1))  # of others no word may be left whole
            near = np.ones(len(batch), bool)
            near[told] = missing_words(list(batch["short"].iloc[told]), list(batch["laid"].iloc[told])) <= _WORD * batch["most"].to_numpy()[told]
            held.append(batch[near])
            size += len(held[-1])
        if held and (size >= 20_000 or batch is None):
            some, held, size = pd.concat(held), [], 0
            edits, most = edits_up_to(list(some["short"]), list(some["laid"]), some["most"].to_numpy()), some["most"].to_numpy()
            yield some[["late", "early"]].assign(edits=edits, identity=1 - edits / some["short"].str.len())[edits <= most]


def _word_counts(texts: list[str]) -> np.ndarray:
    """How often each word of _WORD bases (other letters than A, C, G and T count as A) occurs in each text."""
    base = _WORD_CODE[np.frombuffer("".join(texts).encode("latin-1", "replace"), np.uint8)]
    ends = np.cumsum([len(x) for x in texts])
    n = np.diff(ends, prepend=0)
    word = np.zeros(len(base), np.uint16)
    for i in range(min(_WORD, len(base))):
        word[: len(base) - i] = word[: len(base) - i] * 4 + base[i:]
    whole = np.ones(len(base), bool)  # where a word of the same text begins
    for i in range(1, _WORD):
        whole[ends[n >= i] - i] = False
    place = np.repeat(np.arange(len(n), dtype=np.int32) * 4**_WORD, n) + word
    return np.bincount(place[whole], minlength=len(n) * 4**_WORD).astype(np.int32).reshape(len(n), -1)


def missing_words(short: list[str], long: list[str]) -> np.ndarray:
    """How many of short's words long lacks.  Each edit that makes short a part of long spoils at most _WORD of them."""
    out = [np.zeros(0, np.int64)]
    for at in range(0, len(short), 512):
        gap = _word_counts(short[at : at + 512]) - _word_counts(long[at : at + 512])
        out.append(np.maximum(gap, 0, out=gap).sum(1))
    return np.concatenate(out)


def least_edits(short: list[str], long: list[str]) -> np.ndarray:
    """Edits that make each of short a part of its long, whose ends are free: Myers' bit vectors, for all pairs at once."""
    n = np.array([len(x) for x in short])
    out = np.zeros(len(n), np.int64)
    words, width = -(-n // 64), np.array([len(x) for x in long])
    order, at = np.lexsort((-width, -words)), 0
    while at < len(order):
        own = order[at : at + max(1, min(2048, (1 << 23) // int(64 * words[order[at]] + width[order[at]] + 1)))]
        own = own[words[own] == words[own[0]]]
        out[own], at = _myers([short[i] for i in own], [long[i] for i in own]), at + len(own)
    return out


def edits_up_to(short: list[str], long: list[str], most: np.ndarray) -> np.ndarray:
    """least_edits, or more than most where it is more."""
    out = most + 1
    near = np.array([i for i, x in enumerate(short) if len(x) <= _LONG], np.int64)
    out[near] = least_edits([short[i] for i in near], [long[i] for i in near])
    for i, x in enumerate(short):
        if len(x) > _LONG:
            out[i] = _by_diagonals(x, long[i], int(most[i]))
    return out


def _by_diagonals(short: str, long: str, most: int) -> int:
    """least_edits of a long pair, or most + 1: with 0, 1, 2, ... edits, how far each diagonal can be followed.  Few edits take few rounds."""
    letters, both = np.unique(np.frombuffer((short + long).encode("utf-32-le"), np.uint32), return_inverse=True)
    if len(letters) > 253:
        return int(least_edits([short], [long])[0])
    n, m = len(short), len(long)
    # Eight letters at each place; behind the ends are two more that are unlike each other and all.
    eight = []
    for own, end in ((both[:n], 254), (both[n:], 255)):
        code = np.concatenate([own, np.full(8, end)]).astype(np.uint64)
        eight.append(sum(code[i : len(code) - 7 + i] << np.uint64(8 * i) for i in range(8)))
    diagonal = np.arange(-most - 1, max(m - n, 0) + most + 2)  # the outer two stay out of reach
    limit = np.minimum(n, m - diagonal)
    far = np.where((diagonal >= 0) & (limit >= 0), 0, -2 * n - 2 * most - 4)
    for edits in range(most + 1):
        if edits:
            step = far + 1
            step[1:-1] = np.maximum(np.maximum(step[1:-1], far[:-2]), far[2:] + 1)
            far = np.minimum(step, limit)
        live = np.flatnonzero((far >= 0) & (far < limit))
        while len(live):
            x = eight[0][far[live]] ^ eight[1][far[live] + diagonal[live]]
            same = np.where(x == 0, 8, np.bitwise_count((x & (~x + np.uint64(1))) - np.uint64(1)) >> 3).astype(np.int64)
            far[live] += same
            live = live[same == 8]
        if far.max() >= n:
            return edits
    return most + 1


def _codes(texts: list[str], width: int) -> np.ndarray:
    """Characters by number from 1 (0: behind the end)."""
    out = np.zeros((len(texts), width), np.uint32)
    for i, x in enumerate(texts):
        out[i, : len(x)] = np.frombuffer(x.encode("utf-32-le"), np.uint32) + 1
    return out


def _myers(short: list[str], long: list[str]) -> np.ndarray:
    n, m = np.array([len(x) for x in short]), np.array([len(x) for x in long])
    words = max(1, -(-int(n.max()) // 64))
    s, t = _codes(short, words * 64), _codes(long, max(1, int(m.max())))
    letters = np.unique(np.concatenate([np.unique(s), np.unique(t)]))
    bit = np.uint64(1) << np.arange(64, dtype=np.uint64)
    peq = np.stack([((s == c).reshape(len(s), words, 64) * bit).sum(2, dtype=np.uint64) for c in letters])
    t, rows, one, top = np.searchsorted(letters, t), np.arange(len(s)), np.uint64(1), np.uint64(63)
    shift = ((n - 1) % 64).astype(np.uint64)
    pv, mv = [np.full(len(s), _NONE) for _ in range(words)], [np.zeros(len(s), np.uint64) for _ in range(words)]
    score, best = n.astype(np.int64), n.astype(np.int64)
    for j in range(t.shape[1]):
        eqs = peq[t[:, j], rows]
        up, down = np.zeros(len(s), np.uint64), np.zeros(len(s), np.uint64)
        for w in range(words):
            p, q, eq = pv[w], mv[w], eqs[:, w]
            xv = eq | q
            eq = eq | down
            xh = (((eq & p) + p) ^ p) | eq
            ph, mh = q | ~(xh | p), p & xh
            if w == words - 1:
                score = score + ((ph >> shift) & one).astype(np.int64) - ((mh >> shift) & one).astype(np.int64)
            up_next, down_next = ph >> top, mh >> top
            ph, mh = (ph << one) | up, (mh << one) | down
            pv[w], mv[w] = mh | ~(xv | ph), ph & xv
            up, down = up_next, down_next
        best = np.where(j < m, np.minimum(best, score), best)
    return best
