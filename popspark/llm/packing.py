"""Best-fit packing of token sequences by a grouping genetic algorithm on islands.

Pieces are dealt into blocks of bounded size.  Each block starts several islands, each a row with a small population of
packings in shuffled order.  An epoch evolves every island in its own task: a crossover injects whole well-filled bins of
one parent into the other, removes the bins that now hold duplicates, and best-fits the displaced pieces.  Between epochs
the elite of each island moves to the next by a join, and the packing of longest pieces first joins as one more elite.
Bins that stay poorly filled are opened again and packed across blocks.
"""

from __future__ import annotations

import re
import zlib
from array import array
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from ._common import durable, slices

CAPACITY = 2048
BLOCK_PIECES = 8192
_CACHE_WORDS = 400_000
_IRREGULAR = re.compile(r" (?:\s|\Z)|[\x1c-\x1f]")
_IRREGULAR_RE2 = r" (?:[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|\z)|[\x1c-\x1f]"
_LETTER = "A-Za-zÀ-ÖØ-öø-ɏ"
#: Text of which the tokenizer's pattern needs no Unicode tables, and that pattern for it.
_PLAIN = re.compile(rf"[\n !-~{_LETTER}]*")
_PARTS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[0-9]+| ?[^\s{_LETTER}0-9]+|\s+(?!\S)|\s+")
#: The character that stands for each byte in a byte-level vocabulary: itself if it is a visible Latin-1 character, else one from U+0100 on.
_VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_MARKS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _VISIBLE)}


class Units(dict):
    """Units met so far -> their ids as bytes; a new unit is encoded when it is first asked for.

    At most twice `most` units stay: when there are `most`, they become the old ones, of which those asked for again stay.
    """

    def __init__(self, encode, most: int):
        super().__init__()
        self.encode, self.most, self.old = encode, most, {}

    def __missing__(self, unit: str) -> bytes:
        ids = self.old.get(unit)
        if ids is None:
            ids = self.encode(unit)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[unit] = ids
        return ids


class WordTokenizer:
    """Ids of a byte-level BPE as 32-bit numbers in the machine's order, little-endian wherever Spark runs today.

    Its pattern always starts a new unit at a space before a character that isn't white space, so the ids of a text are
    those of its units, and units that were met before come from a cache.  Texts in which a space stands before other
    white space or the end are cut only where that holds.  Units of plain Latin text are split by the pattern here, and
    the BPE model is asked for each part once; the whole tokenizer encodes all others, and the texts that hold one of its
    added tokens, such as <|endoftext|>, which have ids of their own.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.units, self.parts = Units(self._unit, _CACHE_WORDS), Units(self._part, _CACHE_WORDS // 4)

    def _part(self, part: str) -> bytes:
        """Ids of one match of the tokenizer's pattern."""
        if part.isascii() and part.isprintable():
            marked = part.replace(" ", "\u0120")
        else:
            marked = part.encode().decode("latin-1").translate(_BYTE_MARKS)
        return array("I", [t.id for t in self.model.tokenize(marked)]).tobytes()

    def _unit(self, unit: str) -> bytes:
        if unit.isascii():
            if unit.isalpha():
                return self._part(" " + unit)
            if unit[:-1].isalpha() and unit.isprintable():  # a word and its full stop or comma
                if not unit[-1].isdigit():
                    return self.units[unit[:-1]] + self.parts[unit[-1]]
        text = unit[1:] if unit.startswith("\0") else " " + unit
        if _PLAIN.fullmatch(text):
            return b"".join(map(self.parts.__getitem__, _PARTS.findall(text)))
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    @staticmethod
    def cut(text: str) -> list[str]:
        """The units without their leading space; the first has a mark before it."""
        parts = text.split(" ")
        if _IRREGULAR.search(text):
            units = parts[:1]
            for part in parts[1:]:
                if part and not part[0].isspace():
                    units.append(part)
                else:
                    units[-1] += " " + part
            parts = units
        parts[0] = "\0" + parts[0]
        return parts

    def encode(self, text: str) -> bytes:
        if any(t in text for t in self.added):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.units.__getitem__, self.cut(text)))

    def encode_all(self, column: pa.Array) -> list[bytes]:
        """encode() of every text of a column without nulls; each different unit of it is looked up once."""
        odd = pc.match_substring_regex(column, _IRREGULAR_RE2)
        for t in self.added:
            odd = pc.or_(odd, pc.match_substring(column, t))
        split = pc.split_pattern(column.filter(pc.invert(odd)), " ")
        first = split.offsets.to_numpy()
        units = split.flatten().dictionary_encode()
        number = units.indices.to_numpy().astype(np.int64)
        known = [self.units[u] for u in units.dictionary.to_pylist()]
        known += [self.units["\0" + u] for u in pc.list_element(split, 0).to_pylist()]
        number[first[:-1] - first[0]] = len(units.dictionary) + np.arange(len(split))
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        flat = np.frombuffer(b"".join(known), np.uint32)
        size = sizes[number]
        upto = np.cumsum(size)
        begin = (np.cumsum(sizes) - sizes)[number] - (upto - size)
        ids = flat[np.repeat(begin, size) + np.arange(len(begin) and upto[-1])]
        ends = np.concatenate([[0], upto])[first - first[0]]
        regular = (ids[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:]))
        return [self.encode(t.as_py()) if o else next(regular) for o, t in zip(odd.to_pylist(), column)]


_LOADED: dict[str, WordTokenizer] = {}


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids, binary) of every piece of every document.

    A document is its ids and one id 0; one longer than capacity is cut so that all pieces but the first are full.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        if tokenizer not in _LOADED:
            _LOADED[tokenizer] = WordTokenizer(tokenizer)
        for batch in slices(batches, "text", 8 << 20):
            row, out = [], []
            for i, ids in enumerate(_LOADED[tokenizer].encode_all(pc.fill_null(batch.column(1), ""))):
                ids += b"\0\0\0\0"
                n = len(ids) // 4
                starts = [0, *range(n % capacity or capacity, n, capacity)]
                for piece, (a, b) in enumerate(zip(starts, [*starts[1:], n])):
                    row.append(i)
                    out.append((piece, a, b - a, zlib.crc32(ids[4 * a : 4 * b]), ids[4 * a : 4 * b] if with_ids else None))
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(columns[0], pa.int32()), *[pa.array(c, pa.int64()) for c in columns[1:4]], *[pa.array(columns[4], pa.binary())] * with_ids],
                ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids],
            )

    return docs.select("doc_id", "text").mapInArrow(cut, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)


@cache
def _bits(capacity: int) -> list[int]:
    return [1 << n for n in range(capacity + 1)]


def best_fit(lengths: np.ndarray, order: np.ndarray, bins: np.ndarray, fill: list[int], capacity: int) -> None:
    """Put the pieces of order, one by one, into the fullest bin with room, or a new one.  Changes bins and fill.

    Open bins are filed by their room; the rooms that occur are the bits of one integer, whose lowest one from n on is the best fit.
    """
    bit, filed, rooms, put = _bits(capacity), [[] for _ in range(capacity + 1)], 0, []
    for b, f in enumerate(fill):
        filed[capacity - f].append(b)
    for left, open_bins in enumerate(filed):
        if open_bins:
            rooms |= bit[left]
    for n in lengths[order].tolist():
        fits = rooms >> n
        if fits:
            left = n + (fits & -fits).bit_length() - 1
            own = filed[left]
            b = own.pop()
            if not own:
                rooms ^= bit[left]
        else:
            left, b = capacity, len(fill)
            fill.append(0)
        put.append(b)
        fill[b] += n
        own = filed[left - n]
        if not own:
            rooms |= bit[left - n]
        own.append(b)
    bins[order] = put


def fresh(lengths: np.ndarray, capacity: int, rng: np.random.Generator | None = None) -> np.ndarray:
    """A packing of all pieces in shuffled order; without rng, longest first."""
    order = np.argsort(-lengths, kind="stable") if rng is None else rng.permutation(len(lengths))
    bins, fill = np.zeros(len(lengths), np.int32), []
    best_fit(lengths, order, bins, fill, capacity)
    return bins


def fitness(lengths: np.ndarray, bins: np.ndarray, capacity: int) -> tuple[int, float]:
    """Less is better: the number of bins, then minus the mean square of their fill."""
    fill = np.bincount(bins, lengths) / capacity
    return len(fill), -float((fill**2).mean())


def crossover(lengths: np.ndarray, a: np.ndarray, b: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """Inject some of the best-filled bins of b into a; bins of a that hold their pieces go, and the rest is best-fitted."""
    fill_b = np.bincount(b, lengths)
    good = np.argsort(-fill_b, kind="stable")[: max(1, len(fill_b) // 2)]
    chosen = np.zeros(len(fill_b), bool)
    chosen[rng.choice(good, max(1, len(good) // 3), replace=False)] = True
    injected = chosen[b]
    fill_a = np.bincount(a, lengths)
    gone = np.zeros(len(fill_a), bool)
    gone[a[injected]] = True
    gone[np.argsort(fill_a)[:2]] = True  # mutation: the two worst bins are opened as well
    stay = ~injected & ~gone[a]
    names, kept = np.unique(a[stay], return_inverse=True)
    _, put = np.unique(b[injected], return_inverse=True)
    child = np.full(len(a), -1, np.int32)
    child[stay], child[injected] = kept, put + len(names)
    placed = child >= 0
    fill = np.bincount(child[placed], lengths[placed]).astype(np.int64).tolist() if placed.any() else []
    rest = np.flatnonzero(~placed)
    best_fit(lengths, rest[np.argsort(-lengths[rest], kind="stable")], child, fill, capacity)
    return child


def evolve(lengths: np.ndarray, population: list[np.ndarray], capacity: int, generations: int, rng: np.random.Generator) -> tuple[list[np.ndarray], int]:
    """The population after some generations, best first, and how many there were; stops at the least number of bins there can be."""
    least = -(-int(lengths.sum()) // capacity)
    ranked, ran = sorted(((fitness(lengths, p, capacity), i, p) for i, p in enumerate(population)), key=lambda x: x[:2]), 0
    for g in range(generations):
        if ranked[0][0][0] <= least or len(ranked) < 2:
            break
        ran += 1
        i, j = rng.choice(len(ranked), 2, replace=False)
        child = crossover(lengths, ranked[min(i, j)][2], ranked[max(i, j)][2], capacity, rng)
        score = fitness(lengths, child, capacity)
        if score < ranked[-1][0]:
            ranked[-1] = (score, len(population) + g, child)
            ranked.sort(key=lambda x: x[:2])
    return [p for _, _, p in ranked], ran


_ISLAND = "block long, island int, lengths binary, population array<binary>, bins long, score double, done boolean, generations long"


def _row(block: int, island: int, lengths: np.ndarray, population: list[np.ndarray], capacity: int, generations: int) -> dict:
    n, score = fitness(lengths, population[0], capacity)
    least = -(-int(lengths.sum()) // capacity)
    return {"block": block, "island": island, "lengths": lengths.astype("<i4").tobytes(), "population": [p.astype("<i4").tobytes() for p in population], "bins": n, "score": score, "done": n <= least, "generations": generations}


def _island_table(rows: list[dict]) -> pa.Table:
    types = {"block": pa.int64(), "island": pa.int32(), "lengths": pa.binary(), "population": pa.list_(pa.binary()), "bins": pa.int64(), "score": pa.float64(), "done": pa.bool_(), "generations": pa.int64()}
    return pa.table({k: pa.array([r[k] for r in rows], t) for k, t in types.items()})


def _ordered(table: pa.Table) -> pa.Table:
    return table.sort_by([("length", "descending"), ("rid", "ascending")])


def pack(rows: DataFrame, capacity: int = CAPACITY, block_pieces: int = BLOCK_PIECES, islands: int = 2, population: int = 3, epochs: int = 2, generations: int = 4, rounds: int = 3, well_filled: float = 0.99) -> DataFrame:
    """rows(length, any other columns) -> the same rows with sequence_id, offset and generations.

    Every length is 1 to capacity.  A task holds one block, of about block_pieces rows (2**24 at most), whatever the rows repeat.
    Bins filled to less than well_filled are packed again with those of other blocks, in rounds of fewer blocks, 255 at most.
    generations counts the crossovers behind the row's packing; rows that fill a sequence alone need none.  Columns of these
    three names are replaced; all others, whatever their names, come back as they were.
    """
    if not 1 <= rounds <= 255 or not 1 <= block_pieces <= 1 << 24:
        raise ValueError("1 to 255 rounds, and 1 to 2**24 pieces a block")
    width = rounds.bit_length()  # of the round in a sequence's number; 0 stands for rows that fill one alone
    results = ["sequence_id", "offset", "generations"]
    others = [c for c in rows.columns if c not in ("length", *results)]
    own = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.lit(None).cast("int")
    rows = durable(rows.select("length", own.alias("own"), F.monotonically_increasing_id().alias("rid")))
    full, none = F.col("length") == capacity, F.lit(0).cast("long")
    done = [rows.where(full).select("length", "own", F.shiftleft("rid", width).alias("sequence_id"), none.alias("offset"), none.alias("generations"))]
    left = rows.where(~full)
    for number in range(1, rounds + 1):
        blocks = max(1, -(-left.count() // block_pieces))
        left = left.withColumn("block", F.pmod(F.xxhash64("rid", F.lit(number)), F.lit(blocks)))

        def begin(table: pa.Table) -> pa.Table:
            block = table["block"][0].as_py()
            lengths = _ordered(table.select(["length", "rid"]))["length"].to_numpy().astype(np.int64)
            out = []
            for island in range(islands):
                rng = np.random.default_rng([block, island])
                out.append(_row(block, island, lengths, [fresh(lengths, capacity, rng) for _ in range(population)], capacity, 0))
            return _island_table(out)

        def live(epoch: int):
            def step(batches):
                for batch in batches:
                    for r in batch.to_pylist():
                        lengths = np.frombuffer(r["lengths"], "<i4").astype(np.int64)
                        own, ran = [np.frombuffer(p, "<i4") for p in r["population"]], 0
                        if not r["done"] or not epoch:
                            if epoch:  # the neighbour's elite, and once the packing of longest pieces first
                                own[-1] = np.frombuffer(r["migrant"], "<i4") if r["migrant"] else own[-1]
                                own += [fresh(lengths, capacity)] if (epoch, r["island"]) == (1, 0) else []
                            own, ran = evolve(lengths, own, capacity, generations, np.random.default_rng([r["block"], r["island"], epoch, 1]))
                        yield from _island_table([_row(r["block"], r["island"], lengths, own, capacity, r["generations"] + ran)]).to_batches()

            return step

        state = durable(left.select("block", "length", "rid").groupBy("block").applyInArrow(begin, _ISLAND))
        for epoch in range(epochs):
            elites = state.where("not done").select("block", F.pmod(F.col("island") + 1, F.lit(islands)).cast("int").alias("island"), F.col("population")[0].alias("migrant"))
            state = durable(state.join(elites, ["block", "island"], "left").mapInArrow(live(epoch), _ISLAND))
        best = state.groupBy("block").agg(F.min_by(F.col("population")[0], F.struct("bins", "score", "island")).alias("best"), F.sum("generations").alias("generations"))

        def place(table: pa.Table, winner: pa.Table) -> pa.Table:
            table = _ordered(table)
            lengths = table["length"].to_numpy().astype(np.int64)
            bins = np.frombuffer(winner["best"][0].as_py(), "<i4").astype(np.int64)
            order = np.argsort(bins, kind="stable")
            before = np.cumsum(lengths[order]) - lengths[order]
            first = np.searchsorted(bins[order], bins[order])
            offset = np.empty(len(bins), np.int64)
            offset[order] = before - before[first]
            poor = np.bincount(bins, lengths) < well_filled * capacity
            ids = ((table["block"].to_numpy() << 24 | bins) << width) | number
            return table.append_column("sequence_id", pa.array(ids, pa.int64())).append_column("offset", pa.array(offset, pa.int64())).append_column("generations", pa.array(np.full(len(bins), winner["generations"][0].as_py()), pa.int64())).append_column("poor", pa.array(poor[bins], pa.bool_()))

        found = StructType([*left.schema.fields, *[StructField(c, LongType()) for c in results], StructField("poor", BooleanType())])
        placed = durable(left.groupBy("block").cogroup(best.groupBy("block")).applyInArrow(place, found))
        again = placed.where("poor").select("length", "own", "rid")
        if blocks == 1 or number == rounds:
            done.append(placed.select("length", "own", *results))
            break
        done.append(placed.where("not poor").select("length", "own", *results))
        left = again
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.select(*[F.col("own")[c].alias(c) for c in others], "length", *results)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False, **settings) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset and generations of every piece (and ids, with with_ids).

    The tokenizer is used as its file says: an added token's string in a text gets that token's id.  A null text is
    empty: one piece, the id 0.  Repeated rows and ids are packed as often as they occur.  An empty table gives no rows;
    other columns are ignored.
    """
    return pack(pieces(docs.select("doc_id", "text"), tokenizer, capacity, with_ids), capacity, **settings)
