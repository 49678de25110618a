"""Quality classifier on random-indexing vectors.

Every word and every word shape has a hash bucket with a sparse random index vector; a
bucket's context vector is the sum of the index vectors around all its occurrences in the
corpus. Documents pool the context vectors of their words and shapes; a two-layer network in
numpy scores the pool, and a temperature fitted on rows held out of training calibrates its
probabilities. Tables have a fixed size and are counted over all documents; only the labelled
rows that train the network are a bounded sample.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscope.llm import tables
from peerscope.llm.words import mix64, numbered, texts_of

WORDS, SHAPES, WIDTH, ONES, REACH = 1 << 13, 1 << 10, 64, 2, 2
BUCKETS = WORDS + SHAPES
#: Pooled values of a text: mean over its words, mean and spread over their shapes.
FEATURES = 3 * WIDTH
#: Labelled documents that train the network, at most, in the order of a hash of their ids.
SAMPLE_ROWS = 20_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY, CALIBRATE = 32, 30, 128, 2e-3, 1e-4, 0.15
#: Words handled at once.
CHUNK_WORDS = 1 << 18

_CLASSES = bytes.maketrans(
    bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(48, 58)) + bytes(range(128, 256)),
    b"A" * 26 + b"a" * 26 + b"0" * 10 + b"a" * 128)
_RUN = re.compile(rb"(.)\1+", re.DOTALL)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero values of every bucket's index vector."""
    h = mix64(np.arange(BUCKETS * ONES, dtype=np.uint64) + np.uint64(0x51ED)).reshape(-1, ONES)
    return (h % np.uint64(WIDTH)).astype(np.int64), np.where(h >> np.uint64(63), 1.0, -1.0)


def bucketed(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word bucket and shape bucket of every word; a shape has runs of small letters,
    capitals and digits as one sign each, and other characters themselves."""
    distinct, ids = numbered(words)
    crc, run = zlib.crc32, _RUN
    word = np.fromiter((crc(w) for w in distinct), np.int64, len(distinct)) % WORDS
    shape = np.fromiter((crc(run.sub(rb"\1", w.translate(_CLASSES))) for w in distinct),
                        np.int64, len(distinct)) % SHAPES + WORDS
    return word[ids], shape[ids]


def _chunks(texts, limit: int = CHUNK_WORDS):
    """(words, words of each text) of consecutive texts, until ``limit`` words are reached."""
    words, counts = [], []
    for t in texts:
        own = (t or "").encode("utf-8", "surrogatepass").split()
        words += own
        counts.append(len(own))
        if len(words) >= limit:
            yield words, np.array(counts)
            words, counts = [], []
    if counts:
        yield words, np.array(counts)


def _contexts(batches):
    """Context vectors of one task."""
    place, sign = index_vectors()
    table = np.zeros(BUCKETS * WIDTH)

    def see(at: np.ndarray, near: np.ndarray):
        for k in range(ONES):
            table[:] += np.bincount(at * WIDTH + place[near, k], weights=sign[near, k],
                                    minlength=len(table))

    for batch in batches:
        for words, counts in _chunks(texts_of(batch["text"])):
            text = np.repeat(np.arange(len(counts)), counts)
            for units in bucketed(words):
                for reach in range(1, REACH + 1):
                    same = text[reach:] == text[:-reach]
                    a, b = units[:-reach][same], units[reach:][same]
                    see(np.concatenate((a, b)), np.concatenate((b, a)))
    yield tables.blocks_of("contexts", table)


def context_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Unit context vectors [bucket, value] over all texts."""
    parts = docs.select(F.col(text_col).alias("text")).filter("text IS NOT NULL").mapInArrow(
        _contexts, tables.SCHEMA)
    table = tables.collected(parts, {"contexts": BUCKETS * WIDTH})["contexts"]
    table = table.reshape(BUCKETS, WIDTH)
    length = np.sqrt((table ** 2).sum(axis=1, keepdims=True))
    return (table / np.maximum(length, 1e-12)).astype(np.float32)


def pooled(vectors: np.ndarray, words: list[bytes], counts: np.ndarray) -> np.ndarray:
    """Mean of the context vectors of each text's words, mean and spread of those of their
    shapes; zeros without words. Shapes are few, so a text's are counted and multiplied."""
    out = np.zeros((len(counts), FEATURES), np.float32)
    some = np.flatnonzero(counts)
    if not len(some):
        return out
    first = (np.cumsum(counts) - counts)[some]
    n = counts[some][:, None].astype(np.float32)
    word, shape = bucketed(words)
    out[some, :WIDTH] = np.add.reduceat(vectors[word], first, axis=0) / n
    text = np.repeat(np.arange(len(some)), counts[some])
    place = text * SHAPES + (shape - WORDS)
    often = np.bincount(place, minlength=len(some) * SHAPES).reshape(-1, SHAPES)
    often = often.astype(np.float32) / n
    near = vectors[WORDS:]
    mean = often @ near
    out[some, WIDTH:2 * WIDTH] = mean
    out[some, 2 * WIDTH:] = np.sqrt(np.maximum(often @ (near * near) - mean * mean, 0))
    return out


class Network:
    """Standardised values -> tanh layer -> logistic output, with a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.rate = float(y.mean()) if len(y) else 0.5
        self.temperature = 1.0
        self.flat = len(np.unique(y)) < 2  # nothing to tell apart
        if self.flat:
            return
        order = rng.permutation(len(y))
        cut = int(len(y) * CALIBRATE)
        held, fit = order[:cut], order[cut:]
        self.mean, self.scale = x[fit].mean(axis=0), x[fit].std(axis=0) + 1e-3
        width = x.shape[1]
        p = [rng.normal(0, width ** -0.5, (width, HIDDEN)), np.zeros(HIDDEN),
             rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(1)]
        m, v, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
        z = (x - self.mean) / self.scale
        for epoch in range(EPOCHS):
            rate = RATE * (1 - epoch / EPOCHS)
            rng.shuffle(fit)
            for s in range(0, len(fit), BATCH):
                rows = fit[s:s + BATCH]
                a, t = z[rows], y[rows]
                h = np.tanh(a @ p[0] + p[1])
                e = (1 / (1 + np.exp(-(h @ p[2] + p[3]))) - t) / len(rows)
                back = np.outer(e, p[2]) * (1 - h ** 2)
                grads = [a.T @ back, back.sum(axis=0), h.T @ e, e.sum(keepdims=True)]
                step += 1
                for i, g in enumerate(grads):
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.999 * v[i] + 0.001 * g * g
                    p[i] = p[i] * (1 - rate * DECAY * (p[i].ndim == 2)) - rate * (
                        m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
        self.params = [a.astype(np.float64) for a in p]
        if len(held):
            raw, target = self.raw(x[held]), y[held]

            def loss(t):
                return np.mean(np.logaddexp(0, raw / t) - target * raw / t)

            self.temperature = float(min(np.exp(np.linspace(-1.5, 2.5, 81)), key=loss))

    def raw(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.params
        return np.tanh(((x - self.mean) / self.scale) @ a + b) @ c + d

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.flat:
            return np.full(len(x), self.rate)
        return 1 / (1 + np.exp(-np.clip(self.raw(x) / self.temperature, -500, 500)))


def with_pool(df: DataFrame, vectors, text_col: str, out_col: str) -> DataFrame:
    held = df.sparkSession.sparkContext.broadcast(vectors)

    @F.arrow_udf("binary")
    def pool(text: pa.Array) -> pa.Array:
        found = []
        for words, counts in _chunks(texts_of(text)):
            found += [row.tobytes() for row in pooled(held.value, words, counts)]
        return pa.array(found, pa.binary())

    return df.withColumn(out_col, pool(F.col(text_col)))


class QualityModel:
    def __init__(self, vectors: np.ndarray, network: Network):
        self.vectors, self.network = vectors, network


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> QualityModel:
    """Context vectors from all ``docs``; the network from at most ``sample_rows`` rows of
    ``labels`` (those least by a hash of the id) joined to their documents by id. Rows with a
    null id or label teach nothing; without two classes the score is the labels' mean."""
    vectors = context_vectors(docs, text_col)
    known = labels.select(F.col(id_col).alias("__id"), F.col(label_col).alias("__label"))
    sample = (known.filter("__id IS NOT NULL AND __label IS NOT NULL")
              .orderBy(F.xxhash64("__id"), "__id", "__label").limit(sample_rows))
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(
        F.broadcast(sample), "__id")  # at most sample_rows rows
    rows = with_pool(rows, vectors, "__text", "__pool").select("__id", "__label", "__pool")
    found = rows.sortWithinPartitions("__id").collect()
    found.sort(key=lambda r: (r["__id"], r["__label"], bytes(r["__pool"])))
    x = np.frombuffer(b"".join(bytes(r["__pool"]) for r in found), np.float32)
    y = np.array([float(r["__label"]) for r in found])
    return QualityModel(vectors, Network(x.reshape(len(y), FEATURES).astype(np.float64), y))


def with_score(df: DataFrame, model: QualityModel, text_col: str = "text",
               out_col: str = "score") -> DataFrame:
    """``df`` with the calibrated probability of label 1; a column already named ``out_col``
    is replaced, others pass through. Null and empty texts have an empty pool and the score
    the network gives it. Whole texts are pooled, some at a time; there is no shuffle."""
    held = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        model, found = held.value, []
        for words, counts in _chunks(texts_of(text)):
            x = pooled(model.vectors, words, counts).astype(np.float64)
            found.append(model.network.scores(x))
        return pa.array(np.concatenate(found) if found else [], pa.float64())

    return df.withColumn(out_col, score(F.col(text_col)))
