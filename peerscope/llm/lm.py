"""Language-model scoring with a log-bilinear neural model.

Words fall into a fixed number of classes: the most frequent words and the end of a text
have one each, other words share classes by their last letters. The network predicts the
next class from the two before it: the sum of two linear maps of their vectors, times the
class's output vector, plus a bias. Tasks train it with noise-contrastive estimation on all
training texts from one start and their parameters are averaged by weight; matrix products
over all pairs of context classes give the exact normalisers. Inside a shared class a word
has its smoothed share of the class's count, so token probabilities sum to one.

Word counts cover the whole corpus. Counts of the most frequent words travel by broadcast (a
fixed number); those of all other words are joined by word, whatever their number.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscope.llm import tables
from peerscope.llm.session import materialised, unused
from peerscope.llm.words import numbered, texts_of

#: Words with a class of their own; classes shared by last letters; vector size.
OWN, SHARED, WIDTH = 255, 256, 16
CLASSES = OWN + 1 + SHARED
END_CLASS = OWN
NOISE, BATCH, RATE, PASSES = 24, 4096, 0.05, 1
#: Words whose counts are broadcast, at most, and their longest UTF-8 form: a bound on its size.
HEAD_WORDS, HEAD_BYTES = 200_000, 64
#: Distinct words a task counts before it hands them on; words handled at once.
FLUSH, CHUNK_WORDS = 300_000, 1 << 19
ADD = 0.1
END = b""  # the end of a text, counted as a token; never a word

_COUNTS = pa.schema([("word", pa.binary()), ("n", pa.int64())])


def tokens(text: str | None) -> list[bytes]:
    """Words with A-Z lower-cased (bytes.lower touches ASCII only)."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _count(batches):
    held: dict[bytes, int] = {}

    def out():
        return pa.record_batch([pa.array(held.keys(), pa.binary()),
                                pa.array(held.values(), pa.int64())], schema=_COUNTS)

    for batch in batches:
        for words, counts in _chunks(texts_of(batch["text"])):
            distinct, ids = numbered(words)
            for w, n in zip(distinct, np.bincount(ids, minlength=len(distinct)).tolist()):
                held[w] = held.get(w, 0) + n
            held[END] = held.get(END, 0) + len(counts)
            if len(held) > FLUSH:
                yield out()
                held.clear()
    if held:
        yield out()


def _chunks(texts, limit: int = CHUNK_WORDS):
    words, counts = [], []
    for t in texts:
        own = tokens(t)
        words += own
        counts.append(len(own))
        if len(words) >= limit:
            yield words, np.array(counts)
            words, counts = [], []
    if counts:
        yield words, np.array(counts)


def word_counts(training: DataFrame, text_col: str = "text") -> DataFrame:
    """(word binary, n) over all rows; the empty word is the end of a text."""
    parts = training.select(F.col(text_col).alias("text")).mapInArrow(
        _count, "word binary, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def shared_class(word: bytes) -> int:
    return OWN + 1 + (zlib.crc32(word[-3:]) & (SHARED - 1))


class Vocabulary:
    """Counts of the frequent words, own classes, and totals of the shared classes."""

    def __init__(self, counts: DataFrame):
        total = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
        self.total, self.distinct = total["n"] or 0, total["v"]
        # words by steps of their count's logarithm (at most 1,024 steps): the steps from the top
        # that hold at most HEAD_WORDS words are the frequent ones
        short = counts.filter(F.length("word").between(1, HEAD_BYTES)).withColumn(
            "step", F.floor(F.log2("n") * 16))
        steps = sorted(short.groupBy("step").agg(F.count("*").alias("v")).collect(), reverse=True)
        held, lowest = 0, None
        for r in steps:
            held += r["v"]
            if held > HEAD_WORDS:
                break
            lowest = r["step"]
        top = [] if lowest is None else short.filter(F.col("step") >= lowest).select(
            "word", "n").collect()
        top.sort(key=lambda r: (-r["n"], bytes(r["word"])))
        self.head = {bytes(r["word"]): r["n"] for r in top}
        self.own = {w: i for i, w in enumerate(list(self.head)[:OWN])}
        ends = counts.filter(F.length("word") == 0).first()
        self.ends = ends["n"] if ends else 0
        # the class of a shared word, as in shared_class
        tail = F.substring("word", -3, 3)
        tail = F.when(F.length("word") < 3, F.col("word")).otherwise(tail)
        self.class_count, self.class_words = np.zeros(CLASSES), np.zeros(CLASSES)
        per = (counts.filter(F.length("word") > 0)
               .groupBy(F.crc32(tail).bitwiseAND(SHARED - 1).alias("k"))
               .agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect())
        for r in per:
            self.class_count[OWN + 1 + r["k"]] = r["n"]
            self.class_words[OWN + 1 + r["k"]] = r["v"]
        for w, i in self.own.items():
            self.class_count[shared_class(w)] -= self.head[w]
            self.class_words[shared_class(w)] -= 1
            self.class_count[i] = self.head[w]
        self.class_count[END_CLASS] = self.ends

    def log_share(self) -> np.ndarray:
        """log10 of the denominator of a word's share in its class; 0 where it is alone."""
        out = np.log10(self.class_count + ADD * (self.class_words + 1))
        out[:OWN + 1] = 0
        return out


class Start:
    """What workers need to train: own classes and the common first parameters."""

    def __init__(self, vocabulary: Vocabulary, seed: int = 11):
        rng = np.random.default_rng(seed)
        share = vocabulary.class_count + 1.0
        self.own = vocabulary.own
        self.noise = share / share.sum()
        self.params = {
            "input": rng.normal(0, 0.1, (CLASSES, WIDTH)),
            "output": rng.normal(0, 0.1, (CLASSES, WIDTH)),
            "first": np.eye(WIDTH), "second": np.eye(WIDTH),
            "bias": np.log(self.noise)}


def classes_of(words: list[bytes], own: dict[bytes, int]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words, their classes, and every word's index among them."""
    distinct, ids = numbered(words)
    get, crc, low = own.get, zlib.crc32, SHARED - 1
    kinds = np.fromiter((k if (k := get(w)) is not None else OWN + 1 + (crc(w[-3:]) & low)
                         for w in distinct), np.int64, len(distinct))
    return distinct, kinds, ids


def sequences(kinds: np.ndarray, counts: np.ndarray):
    """Targets with an end after every text, the two classes before each of them (the end
    class before a text), and the place of each text's first target."""
    ends = np.cumsum(counts)
    target = np.insert(kinds, ends, END_CLASS)
    first = ends - counts + np.arange(len(counts))
    one = np.empty_like(target)
    one[1:], one[:1] = target[:-1], END_CLASS
    one[first] = END_CLASS
    two = np.empty_like(target)
    two[1:], two[:1] = one[:-1], END_CLASS
    two[first] = END_CLASS
    return target, one, two, first


class Trainer:
    """Noise-contrastive estimation by AdaGrad on weighted (context, target) rows."""

    def __init__(self, start: Start):
        self.params = {k: v.astype(np.float32) for k, v in start.params.items()}
        self.squares = {k: np.full_like(v, 1e-6) for k, v in self.params.items()}
        self.noise = start.noise
        self.log_noise = np.log(NOISE * start.noise).astype(np.float32)
        self.rng = np.random.default_rng(5)

    def learn(self, target, one, two, weight) -> None:
        order = self.rng.permutation(len(target))
        for s in range(0, len(order), BATCH):
            rows = order[s:s + BATCH]
            self.step(target[rows], one[rows], two[rows], weight[rows] / weight[rows].sum())

    def step(self, w, x, y, n) -> None:
        """Climb the mean log odds of a batch; its noise is drawn once from class shares."""
        r, q, a, b, bias = (self.params[k] for k in ("input", "output", "first", "second", "bias"))
        drawn = self.rng.choice(CLASSES, NOISE, p=self.noise)
        n = n.astype(np.float32)
        rx, ry, qw, qd = r[x], r[y], q[w], q[drawn]
        h = rx @ a + ry @ b
        good = np.einsum("ij,ij->i", h, qw) + (bias - self.log_noise)[w]
        bad = h @ qd.T + (bias - self.log_noise)[drawn]
        e_good = n / (1 + np.exp(np.clip(good, -50, 50)))  # 1 - P(data)
        e_bad = -n[:, None] / (1 + np.exp(np.clip(-bad, -50, 50)))
        back = e_good[:, None] * qw + e_bad @ qd
        rise = {
            "input": _scatter(x, back @ a.T) + _scatter(y, back @ b.T),
            "output": _scatter(w, e_good[:, None] * h) + _scatter(drawn, e_bad.T @ h),
            "first": rx.T @ back, "second": ry.T @ back,
            "bias": np.bincount(w, e_good, CLASSES) + np.bincount(
                drawn, e_bad.sum(axis=0), CLASSES)}
        for k, g in rise.items():
            g = g.astype(np.float32)
            self.squares[k] += g * g
            self.params[k] += RATE * g / np.sqrt(self.squares[k])


def _scatter(at: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Rows added up by class."""
    place = at[:, None] * WIDTH + np.arange(WIDTH)
    return np.bincount(place.ravel(), rows.ravel(), CLASSES * WIDTH).reshape(CLASSES, WIDTH)


def _trainer(start):
    def train(batches):
        begin, seen = start.value, 0
        trainer = Trainer(begin)
        for batch in batches:
            for words, counts in _chunks(texts_of(batch["text"])):
                _, kinds, ids = classes_of(words, begin.own)
                target, one, two, _ = sequences(kinds[ids], counts)
                key, n = np.unique((two * CLASSES + one) * CLASSES + target, return_counts=True)
                rows = key % CLASSES, key // CLASSES % CLASSES, key // CLASSES ** 2
                for _ in range(PASSES):
                    trainer.learn(*rows, n.astype(float))
                seen += len(target)
        for name, x in trainer.params.items():
            yield tables.blocks_of(name, x.astype(np.float64) * seen)
        yield tables.blocks_of("seen", np.array([seen]))
    return train


class LogBilinear:
    """Averaged parameters as tables: ``pairs`` of a context class and a target, the bias, and
    the log normaliser of every pair of context classes."""

    def __init__(self, params: dict[str, np.ndarray]):
        r, q, bias = params["input"], params["output"], params["bias"]
        one, two = r @ params["first"], r @ params["second"]
        self.one, self.two, self.bias = one @ q.T, two @ q.T, bias
        self.norm = np.empty((CLASSES, CLASSES))  # [two, one]
        for k in range(CLASSES):  # all contexts with one class two words back
            logits = self.one + self.two[k] + bias
            top = logits.max(axis=1)
            self.norm[k] = top + np.log(np.exp(logits - top[:, None]).sum(axis=1))
        self.one, self.two, self.norm = (x.astype(np.float32) for x in
                                         (self.one, self.two, self.norm))

    def log10(self, target, one, two) -> np.ndarray:
        """Normalised log10 probability of each target class."""
        return (self.one[one, target].astype(np.float64) + self.two[two, target]
                + self.bias[target] - self.norm[two, one]) / np.log(10)


class LanguageModel:
    def __init__(self, vocabulary: Vocabulary, network: LogBilinear):
        self.network, self.own, self.head = network, vocabulary.own, vocabulary.head
        self.total, self.distinct, self.ends = (vocabulary.total, vocabulary.distinct,
                                                vocabulary.ends)
        self.log_share = vocabulary.log_share()


def fit(training: DataFrame, counts: DataFrame, text_col: str = "text") -> LanguageModel:
    """The model of all training rows, given their word counts."""
    vocabulary = Vocabulary(counts)
    begin = Start(vocabulary)
    held = training.sparkSession.sparkContext.broadcast(begin)
    parts = training.select(F.col(text_col).alias("text")).mapInArrow(
        _trainer(held), tables.SCHEMA)
    shapes = {k: v.shape for k, v in begin.params.items()}
    got = tables.collected(parts, {k: int(np.prod(s)) for k, s in shapes.items()} | {"seen": 1})
    seen = got.pop("seen")[0]
    params = {k: (v / seen if seen else begin.params[k].ravel()).reshape(shapes[k])
              for k, v in got.items()}
    return LanguageModel(vocabulary, LogBilinear(params))


_PARTS = ("key binary, word binary, times int, n_tokens bigint, n_known bigint,"
          " base double, score double")
_ARROW = pa.schema([("key", pa.binary()), ("word", pa.binary()), ("times", pa.int32()),
                    ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()),
                    ("score", pa.float64())])
#: Digests of texts that a task remembers, to score copies once.
SEEN = 1 << 17


def _unseen(batches):
    """(key, text) of each batch without texts the task has just had."""
    seen = set()
    for batch in batches:
        fresh = []
        for i, k in enumerate(batch["key"].to_pylist()):
            if k not in seen:
                seen.add(k)
                fresh.append(i)
        if len(seen) > SEEN:
            seen.clear()
        if fresh:
            yield batch.take(pa.array(fresh)) if len(fresh) < len(batch) else batch


def _scorer(held):
    def nulls(n, kind):
        return pa.nulls(n, kind)

    def score(batches):
        m = held.value
        log_all = float(np.log10(m.total + ADD * (m.distinct + 1)))
        end_base = float(np.log10(m.ends + ADD)) - log_all
        for batch in _unseen(batches):
            at = 0
            for words, counts in _chunks(texts_of(batch["text"])):
                key, at = batch["key"].slice(at, len(counts)), at + len(counts)
                distinct, kinds, ids = classes_of(words, m.own)
                known = np.fromiter((m.head.get(w, -1) for w in distinct), np.int64, len(distinct))
                log_count = np.log10(np.maximum(known, 0) + ADD)
                log_count[known < 0] = 0  # joined later
                target, one, two, first = sequences(kinds[ids], counts)
                log_class = np.add.reduceat(m.network.log10(target, one, two), first)
                doc = np.repeat(np.arange(len(counts)), counts)
                n = len(counts)
                in_head = known[ids] >= 0
                base = np.bincount(doc, log_count[ids], n) + end_base - counts * log_all
                shared = kinds > END_CLASS
                inside = np.where(shared, log_count - m.log_share[kinds], 0.0)
                score = log_class + np.bincount(doc, inside[ids], n)
                have = np.bincount(doc, in_head & (known[ids] > 0), n).astype(np.int64)
                yield pa.record_batch([
                    key, pa.array([b" " + k for k in key.to_pylist()], pa.binary()),
                    nulls(n, pa.int32()),
                    pa.array(counts + 1), pa.array(have + (m.ends > 0)), pa.array(base),
                    pa.array(score)], schema=_ARROW)
                rest, times = np.unique(doc[~in_head] * len(distinct) + ids[~in_head],
                                        return_counts=True) if len(words) else ([], [])
                for s in range(0, len(rest), 1 << 16):
                    some = rest[s:s + (1 << 16)]
                    k = len(some)
                    yield pa.record_batch([
                        key.take(pa.array(some // len(distinct))),
                        pa.array([distinct[i] for i in some % len(distinct)], pa.binary()),
                        pa.array(times[s:s + k].astype(np.int32)), nulls(k, pa.int64()),
                        nulls(k, pa.int64()), nulls(k, pa.float64()), nulls(k, pa.float64())],
                        schema=_ARROW)
    return score


def with_lm_score(df: DataFrame, model: LanguageModel, counts: DataFrame,
                  text_col: str = "text", out_col: str = "lm") -> DataFrame:
    """``df`` with struct(n_tokens, n_known, train_tokens, base_score, score); a column already
    named ``out_col`` is replaced, others pass through (and through one shuffle), whatever
    their names. An empty table gives an empty one.

    base_score is the smoothed unigram log10 probability, score that of the network. A null
    text is an empty one: a single end. Repeated rows are scored one by one. Untrained, every
    token is unknown.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.drop(out_col)
    key, = unused(rows, "__key")
    rows = rows.withColumn(key, F.unhex(F.md5(text)))
    held = df.sparkSession.sparkContext.broadcast(model)
    parts = rows.select(F.col(key).alias("key"), text.alias("text")).mapInArrow(
        _scorer(held), _PARTS)
    # rows of texts carry a word that no text holds, so that they spread over the join as well
    found = parts.join(counts, "word", "left")
    log = F.when(F.col("times").isNotNull(),
                 F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(ADD)))
    sums = found.groupBy("key").agg(
        F.count("n_tokens").alias("copies"),  # copies of a text that other tasks have scored
        F.max("n_tokens").alias("n_tokens"), F.max("n_known").alias("head_known"),
        F.coalesce(F.sum(F.when(F.col("n") > 0, F.col("times"))), F.lit(0)).alias("known"),
        F.max("base").alias("base"), F.max("score").alias("score"),
        F.coalesce(F.sum(log), F.lit(0.0)).alias("rest"))
    rest = F.col("rest") / F.col("copies")
    one = F.struct(
        "n_tokens", (F.col("head_known") + F.expr("known div copies")).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("base") + rest).alias("base_score"), (F.col("score") + rest).alias("score"))
    # written first, so that the join deals both sides anew and can split a much-copied text
    sums = materialised(sums.select(F.col("key").alias(key), one.alias(out_col)))
    return rows.join(sums, key).drop(key)
