"""Language ID of words and documents by a linear-chain conditional random field.

Each word is a state with affix, letter-trigram and lexicon features; learned transitions tie neighbours.  The model is
fitted on a bounded sample of spans of labelled rows, spliced into code-switched chains.  Prediction runs
forward-backward over chains of up to 64 words of the whole text; a document's language has the most expected words.
"""

from __future__ import annotations

from array import array
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import durable, slices

#: The model is fitted on about so many different rows of each language, all if there are fewer, drawn by a hash of id and text.
ROWS_PER_LANGUAGE = 250
#: Of these, on all spans of so many words, but for spans of more bytes; beyond so many spans a language, on those with the least hash.
SPAN_WORDS, SPAN_BYTES, SPANS_PER_LANGUAGE = 256, 16_384, 2_000
#: Spans of all languages together, times languages, that a model is fitted on at most: what the fit holds grows with this product.
SPAN_LABELS = 40_000
#: Languages that one model can have; a table with more is refused.
MOST_LANGUAGES = 200
CHAIN = 64
#: Numbers that forward-backward gets at a time in the fit.
_FIT_CELLS = 1 << 22
_CACHE_WORDS = 400_000


def held_out(doc_id: str | Column = "doc_id") -> Column:
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def letters(word: str) -> str:
    """The letters of a word, those of Unicode category L, in lower case."""
    word = word.lower()
    return word if word.isalpha() else "".join(filter(str.isalpha, word))


def features(word: str) -> list[str]:
    """Features of a word; none if it has no letter."""
    form = letters(word)
    if not form:
        return []
    marked = f"^{form}$"
    return ["=" + form, *[marked[: i + 1] for i in (1, 3)], *[marked[-i - 1 :] for i in (1, 3)], *[marked[i : i + 3] for i in range(len(marked) - 2)]]


@dataclass
class Model:
    labels: list[str]
    numbers: dict[str, int]
    weights: np.ndarray  # features x labels
    transitions: np.ndarray  # labels x labels
    start: np.ndarray
    rows: dict[str, int] = field(default_factory=dict)  # words met before -> row of potentials
    potentials: np.ndarray | None = None
    lettered: np.ndarray | None = None

    def look_up(self, words: list[str]) -> np.ndarray:
        """Rows of self.potentials for the words; new words are scored once."""
        new = list(set(words) - self.rows.keys())
        if self.potentials is None or len(self.rows) + len(new) > _CACHE_WORDS:
            self.rows, new = {}, list(set(words))
            self.potentials, self.lettered = np.ones((1, len(self.labels))), np.zeros(1, bool)
        if new:
            score = _emissions(self.weights, *_numbered(new, self.numbers))
            at = len(self.potentials)
            self.potentials = np.concatenate([self.potentials, np.exp(score - score.max(1, keepdims=True))])
            self.lettered = np.concatenate([self.lettered, np.array([bool(letters(w)) for w in new])])
            self.rows.update(zip(new, range(at, at + len(new))))
        return np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))


def _numbered(words: list[str], numbers: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """The known features of all words in a row, and how many each word has."""
    flat, counts = array("q"), array("q")
    for w in words:
        before = len(flat)
        flat.extend(numbers[f] for f in features(w) if f in numbers)
        counts.append(len(flat) - before)
    return np.array(flat, np.int64), np.array(counts, np.int64)


def _emissions(weights: np.ndarray, numbers: np.ndarray, counts: np.ndarray) -> np.ndarray:
    out = np.zeros((len(counts), weights.shape[1]))
    some = np.flatnonzero(counts)
    begin = np.cumsum(counts)[some] - counts[some]
    for j in range(weights.shape[1] if len(some) else 0):  # label by label, to hold less at a time
        out[some, j] = np.add.reduceat(weights[:, j][numbers], begin)
    return out


def forward_backward(potential: np.ndarray, lengths: np.ndarray, transitions: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginals of chains.  potential: steps x chains x labels, ones after a chain's end.

    Returns the posteriors (same shape), the expected transitions summed over all chains, and the log-partition sum.
    """
    steps, chains, k = potential.shape
    move = np.exp(transitions)
    alpha = np.empty_like(potential)
    log_z = np.zeros(chains)
    for t in range(steps):
        a = np.exp(start) * potential[0] if t == 0 else (alpha[t - 1] @ move) * potential[t]
        total = a.sum(1, keepdims=True)
        alpha[t] = a / total
        log_z += np.where(t < lengths, np.log(total[:, 0]), 0)
    beta = np.ones((chains, k))
    pairs = np.zeros((k, k))
    posterior = np.empty_like(potential)
    for t in range(steps - 1, -1, -1):
        if t + 1 < steps:
            after = potential[t + 1] * beta
            inside = t + 1 < lengths
            joint = (alpha[t] * inside[:, None]) / np.maximum(((alpha[t] @ move) * after).sum(1, keepdims=True), 1e-300)
            pairs += (joint.T @ after) * move
            step = after @ move.T
            beta = np.where(inside[:, None], step / step.sum(1, keepdims=True), 1.0)
        p = alpha[t] * beta
        posterior[t] = p / p.sum(1, keepdims=True)
    return posterior, pairs, log_z.sum()


def train(texts: list[str], labels_of: list[str], rounds: int = 40, rate: float = 0.3, l2: float = 1e-3, least: int = 2, seed: int = 0) -> Model:
    """Fit by gradient ascent on the conditional likelihood of chains spliced from spans of the texts."""
    labels = sorted(set(labels_of))
    k, rng = len(labels), np.random.default_rng(seed)
    spans = []
    for text, label in zip(texts, labels_of):
        words, at = text.split(), 0
        while at < len(words):
            n = int(rng.integers(8, CHAIN + 1))
            spans.append((words[at : at + n], labels.index(label)))
            at += n
    spans = [spans[i] for i in rng.permutation(len(spans))]
    words = [w for s, _ in spans for w in s]
    truth = np.repeat([label for _, label in spans], [len(s) for s, _ in spans]).astype(np.int64)
    forms = sorted(set(words))
    row = {w: i for i, w in enumerate(forms)}
    index = np.fromiter(map(row.__getitem__, words), np.int64, len(words))
    total, n_forms = len(words), len(forms)
    del words, spans, row
    counts = Counter(f for w in forms for f in features(w))
    named = sorted(f for f, c in counts.items() if c >= least or f[0] == "=")
    del counts
    numbers = {f: i for i, f in enumerate(named)}
    flat, sizes = _numbered(forms, numbers)
    del forms
    chains = -(-total // CHAIN)
    lengths = np.full(chains, CHAIN)
    lengths[-1] = total - CHAIN * (chains - 1)
    grid = np.full(chains * CHAIN, n_forms)
    grid[:total] = index
    grid = grid.reshape(chains, CHAIN).T
    weights, transitions, start = np.zeros((len(named), k)), np.zeros((k, k)), np.zeros(k)
    hot = np.zeros((n_forms, k))
    np.add.at(hot, (index, truth), 1)
    pair = np.zeros((k, k))
    inner = np.arange(1, total) % CHAIN != 0
    np.add.at(pair, (truth[:-1][inner], truth[1:][inner]), 1)
    first = np.bincount(truth[::CHAIN], minlength=k)
    params, squares = [weights, transitions, start], [np.full(x.shape, 1e-8) for x in (weights, transitions, start)]
    for _ in range(rounds):
        score = _emissions(weights, flat, sizes)
        potential = np.concatenate([np.exp(score - score.max(1, keepdims=True)), np.ones((1, k))])
        miss, pairs, begun, batch = hot.copy(), np.zeros((k, k)), np.zeros(k), max(1, _FIT_CELLS // (CHAIN * k))
        for at in range(0, chains, batch):
            some = grid[:, at : at + batch]
            posterior, moves, _ = forward_backward(potential[some], lengths[at : at + batch], transitions, start)
            for j in range(k):
                miss[:, j] -= np.bincount(some.ravel(), posterior[:, :, j].ravel(), n_forms + 1)[:-1]
            pairs += moves
            begun += posterior[0].sum(0)
        gradient = np.stack([np.bincount(flat, np.repeat(miss[:, j], sizes), len(named)) for j in range(k)], 1)
        gradients = [gradient / total - l2 * weights / len(named), (pair - pairs) / total, (first - begun) / total]
        for x, g, s in zip(params, gradients, squares):
            s += g * g
            x += rate * g / np.sqrt(s)
    return Model(labels, numbers, weights, transitions, start)


def _spans(batches):
    """lang, key and text of each span of SPAN_WORDS words of whole texts."""
    for batch in slices(batches, "text"):
        out = []
        for lang, h, text in zip(*(c.to_pylist() for c in batch.columns)):
            words = text.split()
            out += [(lang, h, n, " ".join(words[i : i + SPAN_WORDS])) for n, i in enumerate(range(0, len(words), SPAN_WORDS))]
        out = [x for x in out if len(x[3].encode()) <= SPAN_BYTES]
        columns = list(zip(*out)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string()))], ["lang", "h", "n", "text"])


def fit(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE, spans_per_language: int = SPANS_PER_LANGUAGE, **settings) -> Model | None:
    """A model from labelled rows of docs that aren't held out; None if there are none.

    What comes to the driver is bounded for each language by spans_per_language * SPAN_BYTES, and for all k languages together by
    SPAN_LABELS / k spans (one a language at least); the fit holds some numbers for each word of these and language, and goes through
    the chains in batches.  Rows of one id and text count once.  Ranks are taken over hashes alone; texts only pass through tasks one by one.
    """
    own = docs.select("text", "lang", F.xxhash64("doc_id", "text").alias("h")).where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(docs["doc_id"]))
    different = own.groupBy("lang").agg(F.approx_count_distinct("h", 0.02).alias("rows")).limit(MOST_LANGUAGES + 1).collect()
    if len(different) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    spans_per_language = min(spans_per_language, max(1, SPAN_LABELS // max(1, len(different)) ** 2))
    shares = [(r["lang"], 1.0 if rows_per_language > 0.9 * r["rows"] else rows_per_language / r["rows"]) for r in different]
    share = F.broadcast(docs.sparkSession.createDataFrame(shares, "lang string, share double"))  # a row a language
    drawn = own.join(share, "lang").where(F.shiftrightunsigned("h", 11) / float(1 << 53) < F.col("share"))
    spans = durable(drawn.dropDuplicates(["lang", "h"]).select("lang", "h", "text").mapInArrow(_spans, "lang string, h long, n long, text string"))
    keyed = spans.withColumn("key", F.xxhash64("h", "n"))
    nth = F.row_number().over(W.partitionBy("lang").orderBy("key", "h", "n"))
    last = keyed.select("lang", "key", "h", "n").withColumn("nth", nth).where(F.col("nth") <= spans_per_language).groupBy("lang").agg(F.max("key").alias("last"))
    sample = keyed.join(F.broadcast(last), "lang").where("key <= last").orderBy("lang", "key", "h", "n").select("text", "lang").collect()
    return train([r["text"] for r in sample], [r["lang"] for r in sample], **settings) if sample else None


def predict(model: Model | None, texts: list[str | None]) -> list[tuple[str, float, dict[str, float]]]:
    """Language, its share of expected words, and all languages' shares, of each text."""
    if model is None:
        return [("und", 0.0, {})] * len(texts)
    split = [(t or "").split() for t in texts]
    sizes = np.array([len(w) for w in split], np.int64)
    rows = model.look_up([w for words in split for w in words])
    first = np.cumsum(sizes) - sizes
    per = -(-sizes // CHAIN)
    owner = np.repeat(np.arange(len(texts)), per)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
    begin, lengths = first[owner] + nth * CHAIN, np.minimum(sizes[owner] - nth * CHAIN, CHAIN)
    shares = np.zeros((len(texts), len(model.labels)))
    if len(owner):
        at = begin[None, :] + np.arange(min(CHAIN, int(lengths.max())))[:, None]
        inside = np.arange(len(at))[:, None] < lengths[None, :]
        grid = np.where(inside, rows[np.minimum(at, len(rows) - 1)], 0)
        posterior, _, _ = forward_backward(model.potentials[grid], lengths, model.transitions, model.start)
        np.add.at(shares, owner, (posterior * (inside & model.lettered[grid])[:, :, None]).sum(0))
    out = []
    for total, share in zip(shares.sum(1), shares):
        if total <= 0:
            out.append(("und", 0.0, {}))
        else:
            share = share / total
            best = int(share.argmax())
            out.append((model.labels[best], min(1.0, float(share[best])), dict(zip(model.labels, share.tolist()))))
    return out


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of docs, all columns, with lang_pred, score (0 to 1) and lang_shares (language -> share of words).

    A null text, or one without a letter, is `und` with score 0; so is every row when there is no model.  Each row in
    gives one row out; an empty table gives none.  Columns of docs with these three names are replaced.
    """
    docs = docs.drop("lang_pred", "score", "lang_shares")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [*docs.columns, "lang_pred", "score", "lang_shares"]
    text = docs.columns.index("text")

    def label(batches):
        for batch in slices(batches, "text"):
            found = predict(shared.value, batch.column(text).to_pylist())
            new = [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64()), pa.array([list(x[2].items()) for x in found], pa.map_(pa.string(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(label, fields + ", lang_pred string, score double, lang_shares map<string,double>")
