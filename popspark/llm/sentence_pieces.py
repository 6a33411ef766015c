"""SentencePiece encoding and decoding for models of merge type, exact and by backtracking.

The library joins, again and again, the two neighbours whose union is the piece of highest score.  Here an Aho-Corasick automaton over the
pieces finds the longest one at every place; going left to right, the longest piece that is compatible with the one before is
taken, else a shorter one; where none fits, the place is marked in a bit field, never to be tried again, and the last piece is taken
back.  Two pieces are compatible if merging their joined characters again gives just these two.  A sequence in which all neighbours
are compatible is the one that merging gives, as long as scores differ; texts in which pieces of equal scores meet
(runs of spaces) are merged directly.  Texts are cut where no piece reaches across, and each different part is encoded once in a while.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

from ._common import slices, string_bytes, texts_of
from .packing import Units

SPACE = "▁"
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = range(1, 7)
HELD_PARTS, HELD_PAIRS, LONG_PART = 200_000, 500_000, 64


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protocol-buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = message[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while at < len(message):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
        else:
            size = number() if kind == 2 else {1: 8, 5: 4}[kind]
            yield key >> 3, message[at : at + size]
            at += size


class Model:
    """Pieces, scores and settings of a model file, and its encoding of parts of texts.

    Models of merge type with byte fallback or not, the identity as normalizer, spaces kept and escaped, and no user-defined or
    unused pieces; others raise ValueError.
    """

    def __init__(self, file: bytes):
        import ahocorasick

        self.pieces, self.scores, self.kinds = [], [], []
        trainer, normalizer = {}, {}
        for field, value in _fields(file):
            if field == 1:
                own = dict(_fields(value))
                self.pieces.append(own[1].decode())
                self.scores.append(float(np.frombuffer(own[2], "<f4")[0]) if 2 in own else 0.0)
                self.kinds.append(own.get(3, _NORMAL))
            elif field == 2:
                trainer = dict(_fields(value))
            elif field == 3:
                normalizer = dict(_fields(value))
        plain = not normalizer.get(2) and not normalizer.get(4, 1) and normalizer.get(5, 1) and not trainer.get(24, 0)
        if trainer.get(3, 1) != 2 or not plain or {_USER, _UNUSED} & set(self.kinds):
            raise ValueError("only models of merge type, with the identity as normalizer and without user-defined or unused pieces")
        self.prefix = SPACE if normalizer.get(3, 1) else ""
        place = {p: i for i, p in enumerate(self.pieces)}
        named = {field: place.get(trainer.get(field, default).decode()) for field, default in ((45, b"<unk>"), (46, b"<s>"), (47, b"</s>"))}
        self.unknown, self.begin, self.end = named.values()
        self.bytes = {int(p[3:5], 16): i for i, (p, kind) in enumerate(zip(self.pieces, self.kinds)) if kind == _BYTE}
        self.ids = {p: i for i, (p, kind) in enumerate(zip(self.pieces, self.kinds)) if kind == _NORMAL}
        self.score = {p: self.scores[i] for p, i in self.ids.items()}
        long = [p for p in self.ids if len(p) > 1]
        several = Counter(self.score[p] for p in long)
        tied = sorted((p for p in long if several[self.score[p]] > 1), key=len)
        tied = [p for i, p in enumerate(tied) if not any(x in p for x in tied[:i])]
        self.tied = re.compile("|".join(map(re.escape, tied))).search if tied else None
        inner = {c for p in long for c in p} - {SPACE}
        letters = "".join(map(re.escape, sorted(inner)))
        inside = any(SPACE in p.lstrip(SPACE) for p in long)  # of a piece, behind another character
        own = [rf"[{letters}{SPACE}]+"] if inside else [rf"{SPACE}+[{letters}]*", f"[{letters}]+"] if letters else [f"{SPACE}+"]
        self.parts = re.compile("|".join([*own, "(?s:.)"])).findall
        self.shorter = {p: next((p[:k] for k in range(len(p) - 1, 0, -1) if k == 1 or p[:k] in self.ids), "") for p in self.ids}
        self.packed = {p: np.array([i], "<u4").tobytes() for p, i in self.ids.items()}
        self.automaton = ahocorasick.Automaton()
        for p in self.ids:
            self.automaton.add_word(p, (len(p), p))
        self.automaton.make_automaton()
        self.whole: dict[str, bool] = {}
        self.ends: dict[str, tuple] = {}  # of pieces and characters met: no more than there are
        self.fits: dict[tuple[str, str], str] = {}
        self.surface = [self._surface(i) for i in range(len(self.pieces))]

    def _surface(self, i: int) -> bytes:
        kind = self.kinds[i]
        if kind == _CONTROL:
            return b""
        if kind == _UNKNOWN:
            return " ⁇ ".encode()
        return bytes([int(self.pieces[i][3:5], 16)]) if kind == _BYTE else self.pieces[i].replace(SPACE, " ").encode()

    def _merge(self, text: str, left: list | None = None, right: list | None = None) -> list[str]:
        """What merging makes of text: the pair of highest score first, of equal ones the leftmost.

        left and right get each piece that is the first or the last one for a while, and the lowest score merged so far.
        """
        own: list[str | None] = list(text)
        after, before = list(range(1, len(own) + 1)), list(range(-1, len(own) - 1))
        heap = [(-self.score[a + b], i, i + 1, a + b) for i, (a, b) in enumerate(pairwise(own)) if a + b in self.score]
        heapq.heapify(heap)
        low = math.inf
        while heap:
            score, i, j, both = heapq.heappop(heap)
            if own[i] is None or own[j] is None or after[i] != j or own[i] + own[j] != both:
                continue
            low = min(low, -score)
            own[i], own[j] = both, None
            after[i] = k = after[j]
            if left is not None and not i:
                left.append((both, low))
            if right is not None and k == len(own):
                right.append((both, low))
            if k < len(own):
                before[k] = i
                if (new := both + own[k]) in self.score:
                    heapq.heappush(heap, (-self.score[new], i, k, new))
            if (h := before[i]) >= 0 and (new := own[h] + both) in self.score:
                heapq.heappush(heap, (-self.score[new], h, i, new))
        return [x for x in own if x is not None]

    def merged(self, text: str) -> list[str]:
        return self._merge(text)

    def edges(self, piece: str) -> tuple[list[tuple[str, float, float]], list[tuple[str, float, float]]]:
        """The pieces that begin, and those that end, piece while it is merged, and down from which score to which each is there."""
        found = self.ends.get(piece)
        if found is None:
            sides = [(piece[0], math.inf)], [(piece[-1], math.inf)]
            self._merge(piece, *sides)
            found = self.ends[piece] = tuple([(x, born, gone) for (x, born), (_, gone) in pairwise([*side, ("", -math.inf)])] for side in sides)
        return found

    def compatible(self, a: str, b: str) -> bool:
        """Whether merging a and b again, joined, gives just these two: nothing is merged across the seam.

        A piece of a's end and one of b's beginning merge if their union's score is reached while both are there.  An empty a is
        compatible with what merging gives at all.
        """
        return self.reached(b) and (not a or (self.reached(a) and self._apart(a, b)))

    def fitting(self, before: str, piece: str) -> str:
        """The longest piece that begins piece, or is it, and is compatible with the one before; empty if none is."""
        if not piece:
            return ""
        found = self.fits.get((before, piece))
        if found is None:
            found = piece if self.compatible(before, piece) else self.fitting(before, self.shorter.get(piece, ""))
            if len(self.fits) >= HELD_PAIRS:
                self.fits.clear()
            self.fits[before, piece] = found
        return found

    def _apart(self, a: str, b: str) -> bool:
        for x, born_x, gone_x in self.edges(a)[1]:
            for y, born_y, gone_y in self.edges(b)[0]:
                score = self.score.get(x + y)
                if score is not None:
                    begins, ends = min(born_x, born_y, score), max(gone_x, gone_y)
                    if begins > ends:
                        return False
                    if begins == ends:  # which comes first depends on places
                        return self.merged(a + b) == [a, b]
        return True

    def reached(self, piece: str) -> bool:
        """Whether merging piece's characters gives piece."""
        found = self.whole.get(piece)
        if found is None:
            found = self.whole[piece] = self.merged(piece) == [piece]
        return found

    def split(self, text: str) -> list[str]:
        """text as pieces, and characters that are none."""
        n = len(text)
        if n == 1:
            return [text]
        if self.tied and self.tied(text):
            return self.merged(text)
        longest: list[str] = list(text)
        for end, (size, piece) in self.automaton.iter(text):  # by their ends, so the last that begins at a place is the longest
            longest[end - size + 1] = piece
        failed, some_failed = bytearray(n // 8 + 1), False
        fits, shorter = self.fits, self.shorter
        out: list[str] = []
        at, before, piece = 0, "", longest[0]
        while at < n:
            fit = fits.get((before, piece)) if piece else ""
            if fit is None:
                fit = self.fitting(before, piece)
            while some_failed and fit and failed[(to := at + len(fit)) >> 3] >> (to & 7) & 1:
                fit = self.fitting(before, shorter.get(fit, ""))
            if fit:
                out.append(fit)
                at += len(fit)
                before, piece = fit, longest[at] if at < n else ""
            else:
                failed[at >> 3] |= 1 << (at & 7)
                some_failed = True
                last = out.pop()
                at -= len(last)
                before, piece = out[-1] if out else "", shorter.get(last, "")
        return out

    def encoded(self, part: str) -> bytes:
        """Little-endian ids of a part; characters that are no piece become bytes (or the unknown piece)."""
        return b"".join([self.packed.get(piece) or self._packed(piece) for piece in self.split(part)])

    def _packed(self, character: str) -> bytes:
        return np.array([self.bytes[b] for b in character.encode()] if self.bytes else [self.unknown], "<u4").tobytes()

    def decoded(self, ids: np.ndarray) -> bytes:
        """The text of ids in UTF-8.  Bytes that are no UTF-8 become U+FFFD each."""
        surface, own = self.surface, ids.tolist()
        if self.prefix:  # the first space that is no byte is the encoder's
            for n, i in enumerate(own):
                if self.kinds[i] != _CONTROL:
                    if self.pieces[i].startswith(SPACE) and self.kinds[i] == _NORMAL:
                        own = own[n:]
                        return self._valid([surface[own[0]][1:], *map(surface.__getitem__, own[1:])], own)
                    break
        return self._valid(list(map(surface.__getitem__, own)), own)

    def _valid(self, texts: list[bytes], ids: list[int]) -> bytes:
        joined = b"".join(texts)
        try:
            joined.decode()
            return joined
        except UnicodeDecodeError:
            pass
        out, run = [], bytearray()
        for text, i in zip([*texts, b""], [*ids, None]):
            if i is not None and self.kinds[i] == _BYTE:
                run += text
                continue
            while run:
                size = next((k for k in range(1, 5) if k <= len(run) and _is_character(run[:k])), 0)
                out.append(bytes(run[:size]) if size else "�".encode())
                del run[: size or 1]
            out.append(text)
        return b"".join(out)


def _is_character(raw: bytes) -> bool:
    try:
        return len(raw.decode()) == 1
    except UnicodeDecodeError:
        return False


class _Parts(Units):
    """Ids of parts met lately; long ones are not kept."""

    def __missing__(self, part: str) -> bytes:
        return super().__missing__(part) if len(part) <= LONG_PART else self.encode(part)


@lru_cache(2)
def model_of(file: bytes) -> tuple[Model, _Parts]:
    """The model of a file's bytes and the parts that this worker has encoded with it."""
    model = Model(file)
    return model, _Parts(model.encoded, HELD_PARTS)


def encode_text(file: bytes, text: str, ends: bool = True) -> bytes:
    """Ids of text, packed as little-endian uint32, with begin and end ids or without."""
    model, parts = model_of(file)
    body = b"".join(map(parts.__getitem__, model.parts((model.prefix + text).replace(" ", SPACE)))) if text else b""
    mark = lambda i: np.array([i], "<u4").tobytes()
    return mark(model.begin) + body + mark(model.end) if ends else body


def encode(docs: DataFrame, model_path: str, ends: bool = True) -> DataFrame:
    """doc_id, n_tokens and ids (packed little-endian uint32) of every row of docs (doc_id, text), as the SentencePiece library encodes it.

    ends adds the begin and end ids.  Null and empty texts have these alone.  Texts are taken whole; what a worker keeps of
    parts and pairs met before is bounded.  Repeated rows and null ids are rows like any other; an empty table gives no
    rows; other columns are ignored.  The model file is read on the driver and sent with the tasks; its kind is checked there.
    """
    with open(model_path, "rb") as f:
        file = f.read()
    model_of(file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            ids = [encode_text(file, text.decode(), ends) for text in texts_of(batch.column(1))]
            yield pa.record_batch({"doc_id": batch.column(0), "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()), "ids": pa.array(ids, pa.binary())})

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids binary")


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """encoded (ids as encode gives them, and any other columns; an earlier decoded is replaced) with decoded, the text; null ids give a null."""
    with open(model_path, "rb") as f:
        file = f.read()
    model_of(file)
    encoded = encoded.drop("decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            model, _ = model_of(file)
            column = batch.column(batch.schema.get_field_index("ids"))
            offsets, data = string_bytes(column)
            texts = [model.decoded(np.frombuffer(data[a:b].tobytes(), "<u4")) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            texts = [None if null else t.decode() for t, null in zip(texts, column.is_null().to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, StructType([*encoded.schema.fields, StructField("decoded", StringType())]))
