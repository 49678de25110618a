"""BPE encoding and decoding with a given vocabulary file.

A piece of text is a doubly linked list of symbols; a heap holds the merge rank of every
adjacent pair. The lowest rank (leftmost first) is merged, its neighbours are entered anew,
and entries whose symbols have changed meanwhile are skipped as stale. Decoding joins the
vocabulary strings. The tokenizer file is read on the driver and never trained.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import struct
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscope.llm.words import texts_of

#: Twice so many words and pieces, of up to so many bytes, are kept with their ids by a Python
#: worker at most. A batch of texts has about BATCH_CHARS characters.
CACHE_WORDS, CACHE_BYTES = 100_000, 48
BATCH_CHARS = 1 << 20
#: Ids that are decoded at a time.
DECODE_IDS = 1 << 17
#: Marks that often end words; a run of them is one piece.
STOPS = ".,;:!?*#$%&-()"
SCHEMA = "n_tokens:bigint,ids_sha256:string,decoded_sha256:string"
OUTPUTS = {"ids": "array<int>", "decoded": "string"}


def byte_symbols() -> list[str]:
    """The printable stand-in of every byte in byte-level vocabularies: printable Latin-1
    bytes stand for themselves, the others follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table, spare = [""] * 256, 0x100
    for b in range(256):
        if b in own:
            table[b] = chr(b)
        else:
            table[b], spare = chr(spare), spare + 1
    return table


class Kept(dict):
    """What ``make`` gives for a key, kept for keys of up to CACHE_BYTES. When there are too
    many, those not asked for since the last such time are forgotten."""

    def __init__(self, make):
        self.make, self.old = make, {}

    def __missing__(self, key):
        out = self.old.get(key)
        if out is None:
            out = self.make(key)
        if len(key) <= CACHE_BYTES:
            if len(self) >= CACHE_WORDS:
                self.old = dict(self)
                self.clear()
            self[key] = out
        return out


class WordBpe:
    """Encoder for a tokenizer file of kind: NFC, white space dropped, lower case, word
    pattern, byte-level symbols, end-of-word suffix, no decoder."""

    def __init__(self, spec: dict):
        import regex

        model = spec["model"]
        suffix: str = model["end_of_word_suffix"] or ""
        v: dict[str, int] = model["vocab"]
        self.size = max(v.values()) + 1
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        # a pair is left * size + right; the suffix only ends a word
        self.ranks = {v[a] * self.size + v[b]: rank for rank, (a, b) in enumerate(pairs)}
        self.made = [(v[a], v[b], v[a + b]) for a, b in pairs]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_bytes = [t.encode() for t in self.special]
        # vocabulary strings one after the other, each with a blank behind it
        strings = {i: s.encode() + b" " for s, i in (v | self.special).items()}
        strings = [strings.get(i, b" ") for i in range(max(strings) + 1)]
        self.lengths = np.array([len(s) for s in strings])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(strings), np.uint8)
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        # \s of the pattern is the Unicode property White_Space
        self.pattern = regex.compile(split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"))
        self.plain = not any(t.rstrip(STOPS).isalpha() for t in self.special)
        marks = "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))
        self.marks = regex.compile(f"({marks})") if marks else None
        symbols = byte_symbols()
        self.inner = [v.get(s, -1) for s in symbols]
        self.final = [v.get(s + suffix, -1) for s in symbols]
        #: ids (little-endian 32 bit) of words and of pieces
        self.words, self.pieces = Kept(self.word), Kept(self.piece)

    def merge(self, symbols: list[int]) -> list[int]:
        """Apply all merges to the symbols of one piece. A queue entry is the rank and, in the
        lowest bits, the place of the pair's left symbol."""
        n, size, rank_of, made = len(symbols), self.size, self.ranks.get, self.made
        bits = n.bit_length()
        mask, push, pop = (1 << bits) - 1, heapq.heappush, heapq.heappop
        queue = [rank << bits | i for i, rank in enumerate(
            [rank_of(a * size + b) for a, b in zip(symbols, symbols[1:])]) if rank is not None]
        if not queue:
            return symbols
        heapq.heapify(queue)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        while queue:
            entry = pop(queue)
            i = entry & mask
            a, b, merged = made[entry >> bits]
            if symbols[i] != a:
                continue  # stale
            j = right[i]
            if j >= n or symbols[j] != b:
                continue
            symbols[i], symbols[j] = merged, -1
            k = right[i] = right[j]
            if k < n:
                left[k] = i
                rank = rank_of(merged * size + symbols[k])
                if rank is not None:
                    push(queue, rank << bits | i)
            h = left[i]
            if h >= 0:
                rank = rank_of(symbols[h] * size + merged)
                if rank is not None:
                    push(queue, rank << bits | h)
        return [s for s in symbols if s >= 0]

    def piece(self, text: str) -> bytes:
        raw = text.encode("utf-8", "surrogatepass")
        ids = list(map(self.inner.__getitem__, raw))
        ids[-1] = self.final[raw[-1]]
        ids = self.merge(ids if min(ids) >= 0 else [i for i in ids if i >= 0])
        return struct.pack(f"<{len(ids)}I", *ids)

    def word(self, raw: bytes) -> bytes:
        """Ids of a run without ASCII white space. No piece, composition or special token
        reaches over such white space."""
        text, out = raw.decode("utf-8", "surrogatepass"), []
        if self.plain:  # letters of Latin-1, and marks: a piece, and one of marks
            core = text.rstrip(STOPS)
            if core.isalpha() and (core.isascii() or max(core) < "\u0100"):
                ids = self.pieces[core.lower()]
                return ids if len(core) == len(text) else ids + self.pieces[text[len(core):]]
        marked = any(m in raw for m in self.special_bytes)
        for part in self.marks.split(text) if marked else [text]:
            if part in self.special:
                out.append(struct.pack("<I", self.special[part]))
            elif part:
                # letter by letter, as the library does: a final capital sigma is no exception
                plain = part if part.isascii() else unicodedata.normalize(
                    "NFC", part).replace("Σ", "σ")
                out += map(self.pieces.__getitem__, self.pattern.findall(plain.lower()))
        return b"".join(out)

    def decoded(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The vocabulary strings of the ids, a blank behind each, as bytes, and where each
        one ends."""
        ends = np.cumsum(self.lengths[ids])
        out = np.empty(ends[-1] if len(ids) else 0, np.uint8)
        for s in range(0, len(ids), DECODE_IDS):
            some, stop = ids[s:s + DECODE_IDS], ends[s:s + DECODE_IDS]
            length = self.lengths[some]
            first = stop[0] - length[0]
            at = np.repeat(self.starts[some] - (stop - length), length)
            at += np.arange(first, stop[-1])
            out[first:stop[-1]] = self.flat[at]
        return out, ends

    def encoded(self, texts) -> Iterator[tuple[bytes, bytes]]:
        """Ids as little-endian unsigned 32-bit integers, and the decoded text in UTF-8, of each
        of a batch of texts."""
        known = self.words.__getitem__
        parts = [b"".join(map(known, (t or "").encode("utf-8", "surrogatepass").split()))
                 for t in texts]
        plain, ends = self.decoded(np.frombuffer(b"".join(parts), "<u4"))
        stops = np.concatenate(([0], ends))[np.cumsum([0] + [len(p) // 4 for p in parts])]
        for ids, start, stop in zip(parts, stops[:-1].tolist(), stops[1:].tolist()):
            yield ids, plain[start:max(start, stop - 1)].tobytes()

    def encode(self, text: str | None) -> tuple[bytes, bytes]:
        """``encoded`` of one text."""
        return next(self.encoded([text]))


def read_spec(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def batches(texts) -> Iterator[list]:
    """Runs of texts of about ``BATCH_CHARS`` characters."""
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t or "")
        if size >= BATCH_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _worker_encoder(spec) -> WordBpe:
    """One encoder for each Python worker and broadcast vocabulary."""
    import sys

    # the module is shipped by value, so what outlives a task hangs on a real module
    held = sys.modules.setdefault("_bpe_encoders", type(sys)("_bpe_encoders")).__dict__
    value = spec.value
    key = f"k{len(value['model']['vocab'])}_{len(value['model']['merges'])}_{spec.id_hint}"
    if key not in held:
        held[key] = WordBpe(value)
    return held[key]


class _Spec:
    """A broadcast vocabulary (its size is that of the tokenizer file) and its digest."""

    def __init__(self, spark, spec: dict):
        self.broadcast = spark.sparkContext.broadcast(spec)
        self.id_hint = hashlib.md5(json.dumps(spec, sort_keys=True).encode()).hexdigest()

    @property
    def value(self):
        return self.broadcast.value


def with_bpe(df: DataFrame, path: str, text_col: str = "text", out_col: str = "bpe",
             outputs: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with a struct column: token count and digests of ids and decoded text, and those
    of ``ids`` and ``decoded`` themselves that ``outputs`` names. A column already named
    ``out_col`` is replaced, others pass through.

    Null counts as the empty text: no tokens, digests of nothing. Special tokens written out
    in a text give their ids. Texts are taken whole; a word of any length is merged in
    n log n steps. There is no shuffle.
    """
    spec = _Spec(df.sparkSession, read_spec(path))

    kinds = "".join(f",{name}:{OUTPUTS[name]}" for name in outputs)

    @F.arrow_udf(f"struct<{SCHEMA}{kinds}>")
    def encode(text: pa.Array) -> pa.Array:
        encoder = _worker_encoder(spec)
        counts, marks, plain_marks, kept, plain = [], [], [], [], []
        for ids, decoded in chain.from_iterable(map(encoder.encoded, batches(texts_of(text)))):
            counts.append(len(ids) // 4)
            marks.append(hashlib.sha256(ids).hexdigest())
            plain_marks.append(hashlib.sha256(decoded).hexdigest())
            if "ids" in outputs:
                kept.append(ids)
            if "decoded" in outputs:
                plain.append(decoded.decode())
        arrays = [pa.array(counts, pa.int64()), pa.array(marks, pa.string()),
                  pa.array(plain_marks, pa.string())]
        names = ["n_tokens", "ids_sha256", "decoded_sha256"]
        for name in outputs:
            if name == "ids":
                ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                arrays.append(pa.ListArray.from_arrays(
                    pa.array(ends), pa.array(np.frombuffer(b"".join(kept), "<i4"))))
            else:
                arrays.append(pa.array(plain, pa.string()))
        return pa.StructArray.from_arrays(arrays, names=[*names, *outputs])

    return df.withColumn(out_col, encode(F.col(text_col)))
