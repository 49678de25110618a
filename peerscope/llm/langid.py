"""Language identification of mixed-language texts.

The script of a word (by code point ranges) narrows the languages it may be in; hashed letter
trigrams score every word under each of them; a Viterbi pass with a switching penalty labels
the words, and equal neighbours form spans. The model is a table of fixed size for each
language label, counted over all training texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerscope.llm import tables
from peerscope.llm.words import mix64, texts_of

#: Hash buckets of letter trigrams for each language.
BUCKETS = 1 << 15
#: Count added to every bucket.
SMOOTHING = 0.5
#: Loss (natural log) for a change of language between two words.
SWITCH = 12.0
#: A language may use a script that holds at least this share of its training letters.
SCRIPT_SHARE = 0.01
#: Characters handled at once, divided by the number of languages; longer texts go in slices.
SLICE = 1 << 23
# First code points of blocks and their script.
SCRIPT_RANGES = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"),
    (0x0590, "hebrew"), (0x0600, "arabic"), (0x0900, "indic"), (0x0E00, "thai"),
    (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"),
    (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"),
    (0x2C80, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3130, "hangul"),
    (0x3190, "other"), (0x31F0, "kana"), (0x3200, "other"), (0x3400, "han"), (0xA000, "other"),
    (0xA640, "cyrillic"), (0xA6A0, "other"), (0xA720, "latin"), (0xA800, "other"),
    (0xAC00, "hangul"), (0xD800, "other"), (0xF900, "han"), (0xFB00, "latin"),
    (0xFB13, "other"), (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"),
    (0xFFE0, "other"), (0x20000, "han"), (0x32400, "other"))
SCRIPTS = sorted({s for _, s in SCRIPT_RANGES})
TABLE = BUCKETS + len(SCRIPTS)
#: All code points.
PLANES = 0x110000
UNKNOWN = "und"


class Letters:
    """Lookup tables over code points: small letter (0 for what is no letter) and script."""

    def __init__(self):
        small = np.zeros(PLANES, np.uint32)
        for c in range(PLANES):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                small[c] = ord(low) if len(low) == 1 else c
        self.small = small
        starts = np.array([a for a, _ in SCRIPT_RANGES])
        ids = np.array([SCRIPTS.index(s) for _, s in SCRIPT_RANGES], np.uint8)
        self.script = ids[np.searchsorted(starts, np.arange(PLANES), "right") - 1]

    def read(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        return self.small[points]


def trigram_buckets(small: np.ndarray) -> np.ndarray:
    """The bucket of the trigram around every position; ends count as no letter."""
    pad = np.zeros(len(small) + 2, np.uint64)
    pad[1:-1] = small
    key = pad[:-2] | pad[1:-1] << np.uint64(21) | pad[2:] << np.uint64(42)
    return (mix64(key) & np.uint64(BUCKETS - 1)).astype(np.int64)


_HELD: dict[str, object] = {}


def _letters() -> Letters:
    if "letters" not in _HELD:
        _HELD["letters"] = Letters()
    return _HELD["letters"]


def _count(batches):
    """Trigram and script counts of each language in one task."""
    letters, held = _letters(), {}

    def add(lang, texts):
        small = letters.read("\n".join(texts))
        is_letter = small > 0
        table = held.setdefault(lang, np.zeros(TABLE))
        table[:BUCKETS] += np.bincount(trigram_buckets(small)[is_letter], minlength=BUCKETS)
        table[BUCKETS:] += np.bincount(letters.script[small[is_letter]], minlength=len(SCRIPTS))

    for batch in batches:
        pending: dict[str, list[str]] = {}
        sizes: dict[str, int] = {}
        for lang, text in zip(batch["lang"].to_pylist(), texts_of(batch["text"])):
            for start in range(0, len(text), SLICE // 4):
                part = text[start:start + SLICE // 4]
                pending.setdefault(lang, []).append(part)
                sizes[lang] = sizes.get(lang, 0) + len(part)
                if sizes[lang] > SLICE // 8:
                    add(lang, pending.pop(lang))
                    sizes[lang] = 0
        for lang, texts in pending.items():
            add(lang, texts)
    for lang, table in held.items():
        yield tables.blocks_of(lang, table)


class Model:
    """Languages in order, log scores [language, bucket] and allowed scripts."""

    def __init__(self, counts: dict[str, np.ndarray]):
        self.langs = sorted(counts)
        n = len(self.langs)
        self.scores = np.zeros((n, BUCKETS), np.float32)
        self.allowed = np.ones((n, len(SCRIPTS)), bool)
        for i, lang in enumerate(self.langs):
            c = counts[lang][:BUCKETS]
            self.scores[i] = np.log((c + SMOOTHING) / (c.sum() + SMOOTHING * BUCKETS))
            share = counts[lang][BUCKETS:] / max(1.0, counts[lang][BUCKETS:].sum())
            self.allowed[i] = share >= SCRIPT_SHARE
        self.allowed |= ~self.allowed.any(axis=0)  # a script that nobody uses leaves all open

    def words(self, small: np.ndarray):
        """(first position, length, scores [word, language]) of the runs of letters."""
        letters = _letters()
        edge = np.diff(np.concatenate(([0], (small > 0).view(np.int8), [0])))
        starts = np.flatnonzero(edge == 1)
        lengths = np.flatnonzero(edge == -1) - starts
        scores = np.zeros((len(starts), len(self.langs)), np.float32)
        step = max(1, SLICE // 4 // max(1, len(self.langs)))
        for a in range(0, len(small), step):
            b = min(len(small), a + step)
            lo, hi = max(0, a - 1), min(len(small), b + 1)
            part = small[a:b]
            where = np.flatnonzero(part > 0)
            if not len(where):
                continue
            bucket = trigram_buckets(small[lo:hi])[a - lo:a - lo + b - a][where]
            word = np.searchsorted(starts, where + a, "right") - 1
            first = word[0]
            for i in range(len(self.langs)):
                sums = np.bincount(word - first, weights=self.scores[i][bucket])
                scores[first:first + len(sums), i] += sums.astype(np.float32)
        scores -= scores.max(axis=1, keepdims=True) if len(scores) else 0
        script = letters.script[small[starts]]
        scores[~self.allowed[:, script].T] -= 1e4
        return starts, lengths, scores


def viterbi(scores: np.ndarray, first: np.ndarray, count: np.ndarray,
            switch: float = SWITCH) -> np.ndarray:
    """The best language of every word. Text d has ``count[d]`` words from ``first[d]`` on;
    all texts advance together, the longest ones last, one word at a time."""
    label = np.zeros(len(scores), np.int32)
    order = np.argsort(-count, kind="stable")
    order = order[count[order] > 0]
    if not len(order):
        return label
    begin, size = first[order], count[order]
    stayed = np.ones(scores.shape, bool)
    origin = np.zeros(len(scores), np.int32)
    longest = int(size[0])
    live = np.searchsorted(-size, -np.arange(longest), "left")  # texts with more than t words
    best = scores[begin].copy()
    for t in range(1, longest):
        k = live[t]
        at = begin[:k] + t
        b = best[:k]
        top = b.argmax(axis=1)
        move = b[np.arange(k), top] - switch
        stay = b >= move[:, None]
        stayed[at], origin[at] = stay, top
        np.maximum(b, move[:, None], out=b)
        b += scores[at]
    now = best.argmax(axis=1)
    for t in range(longest - 1, -1, -1):
        k = live[t]
        at = begin[:k] + t
        label[at] = now[:k]
        now[:k] = np.where(stayed[at, now[:k]], now[:k], origin[at])
    return label


def train_rows(df: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return df.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter(
        "text IS NOT NULL AND lang IS NOT NULL")


def fit(training: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model from all rows with text and language. Its size is 2^15 counts for each label."""
    parts = train_rows(training, text_col, lang_col).mapInArrow(_count, tables.SCHEMA)
    return Model(tables.collected(parts, size=TABLE))


def _chunks(texts, limit: int):
    pending, size = [], 0
    for t in texts:
        pending.append(t or "")
        size += len(t or "")
        if size >= limit:
            yield pending
            pending, size = [], 0
    if pending:
        yield pending


def label_texts(model: Model, texts: list[str], switch: float = SWITCH):
    """For a list of texts: (text index, start, length, language) arrays of their words."""
    if not model.langs:
        return (np.empty(0, np.int64),) * 4
    letters = _letters()
    joined = "\n".join(texts)
    starts, lengths, scores = model.words(letters.read(joined))
    ends = np.cumsum([len(t) + 1 for t in texts])
    begins = ends - np.array([len(t) + 1 for t in texts])
    doc = np.searchsorted(ends, starts, "right")
    count = np.bincount(doc, minlength=len(texts))
    first = np.cumsum(count) - count
    return doc, starts - begins[doc], lengths, viterbi(scores, first, count, switch)


def with_language(df: DataFrame, model: Model, text_col: str = "text",
                  out_col: str = "language") -> DataFrame:
    """``df`` with struct(lang_pred, score, spans): the language with most letters (the least
    code on ties), its share of the letters, and the labelled spans (start, stop, lang; in
    code points, from first to last word of a language). A column already named ``out_col``
    is replaced, others pass through.

    Texts that are null or hold no letter, and all texts if nothing was learned, are ``und``
    with score 0 and no spans. Whole texts are labelled; long ones are scored in slices. An
    empty table gives an empty one.
    """
    held = df.sparkSession.sparkContext.broadcast(model)
    item = "array<struct<start:int,stop:int,lang:string>>"

    @F.arrow_udf(f"struct<lang_pred:string,score:double,spans:{item}>")
    def predict(text: pa.Array) -> pa.Array:
        model = held.value
        n = len(model.langs)
        preds, scores, counts, found = [], [], [], []
        for chunk in _chunks(texts_of(text), SLICE // max(2, n)):
            doc, start, length, label = label_texts(model, chunk)
            votes = np.bincount(doc * max(n, 1) + label, weights=length,
                                minlength=len(chunk) * max(n, 1)).reshape(len(chunk), -1)
            total, top = votes.sum(axis=1), votes.argmax(axis=1)
            preds += [model.langs[k] if t else UNKNOWN for k, t in zip(top, total)]
            scores.append(votes.max(axis=1) / np.maximum(total, 1))
            cut = np.flatnonzero(np.diff(doc, prepend=-1) | np.diff(label, prepend=-1))
            last = np.append(cut[1:], len(doc))[:len(cut)] - 1
            counts.append(np.bincount(doc[cut], minlength=len(chunk)))
            found.append((start[cut], start[last] + length[last], label[cut]))
        ends = np.cumsum(np.concatenate([[0], *counts]).astype(np.int64))
        begin, stop, label = (np.concatenate([f[k] for f in found] or [[]]) for k in range(3))
        langs = pa.DictionaryArray.from_arrays(
            pa.array(label.astype(np.int32)), pa.array(model.langs, pa.string()))
        every = pa.StructArray.from_arrays(
            [pa.array(begin.astype(np.int32)), pa.array(stop.astype(np.int32)),
             langs.cast(pa.string())], names=["start", "stop", "lang"])
        return pa.StructArray.from_arrays(
            [pa.array(preds, pa.string()),
             pa.array(np.concatenate(scores) if scores else [], pa.float64()),
             pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), every)],
            names=["lang_pred", "score", "spans"])

    return df.withColumn(out_col, predict(F.col(text_col)))


def remainder(id_col: str, by: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % by
