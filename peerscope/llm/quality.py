"""Quality rules by repetition coverage.

For every text, rolling hashes of word n-grams of lengths 5 to 10 find the n-grams that occur
again; the rules measure the share of characters inside later occurrences of an n-gram and
inside lines that repeat an earlier line. Equal hashes are compared word by word, so a
collision never counts as a repetition.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscope.llm.words import mix64, numbered, texts_of

# N-gram length -> largest allowed percentage of a text's word characters that
# lie in later occurrences of an n-gram of that length (published repetition thresholds).
MAX_NGRAM_PERCENT = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}
# Fixed value: largest allowed percentage of a text's line characters in repeated lines. How
# many lines repeat decides nothing: one short heading used twice in a short text is no fault.
MAX_LINE_CHAR_PERCENT = 20
# Fixed values of the base rules.
MIN_WORDS = 10
REPEAT_WINDOW = 5
MAX_REPEAT_PERCENT = 20

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
_BASE = np.uint64(0x9E3779B97F4A7C15)

NAMES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "dup_line_chars",
         "line_chars", "n_repeat_words", *(f"dup_chars_{n}" for n in MAX_NGRAM_PERCENT)]
SCHEMA = ("struct<" + ",".join(f"{n}:bigint" for n in NAMES)
          + ",base_failed:boolean,kept:boolean>")


def _equal_windows(ids: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the n-word windows that occur at least twice, and of those that repeat an
    earlier one. ``hashes`` has one rolling hash for each window."""
    order = np.argsort(hashes, kind="stable")
    h = hashes[order]
    same = h[1:] == h[:-1]
    if not same.any():
        return order[:0], order[:0]
    a, b = order[:-1][same], order[1:][same]
    if any((ids[a + j] != ids[b + j]).any() for j in range(n)):  # a collision
        windows = np.lib.stride_tricks.sliding_window_view(ids, n)
        order = np.lexsort(windows.T[::-1])
        same = (windows[order[1:]] == windows[order[:-1]]).all(axis=1)
        a, b = order[:-1][same], order[1:][same]
    return np.union1d(a, b), np.sort(b)


def _covered(starts: np.ndarray, n: int, n_words: int) -> np.ndarray:
    edge = np.zeros(n_words + 1, np.int64)
    edge[starts] += 1
    edge[starts + n] -= 1
    return np.cumsum(edge[:-1]) > 0


def repeated_lines(text: str) -> tuple[int, int, int, int]:
    """Lines with a word, their characters, and the same of those equal to an earlier line."""
    seen, lines, chars, again, again_chars = set(), 0, 0, 0, 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            lines += 1
            chars += len(line)
            if line in seen:
                again += 1
                again_chars += len(line)
            else:
                seen.add(line)
    return lines, chars, again, again_chars


def measures(text: str | None) -> dict[str, int]:
    """All counts of one text; None counts as a text without words."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    out = dict.fromkeys(NAMES, 0)
    out["n_words"] = len(words)
    out["word_chars"] = len(text) - sum(map(text.count, SPACES))
    out["n_symbols"] = sum(map(text.count, SYMBOLS))
    (out["n_lines"], out["line_chars"], out["n_dup_lines"],
     out["dup_line_chars"]) = repeated_lines(text)
    if len(words) <= REPEAT_WINDOW:
        return out
    distinct, ids = numbered(words)
    if len(distinct) == len(words):
        return out
    lengths = None
    value = mix64(ids.astype(np.uint64) + np.uint64(1))
    with np.errstate(over="ignore"):
        rolling = value
        for n in range(2, max(MAX_NGRAM_PERCENT) + 1):
            if len(words) <= n:
                break
            rolling = rolling[:-1] * _BASE + value[n - 1:]
            if n not in MAX_NGRAM_PERCENT:
                continue
            twice, later = _equal_windows(ids, rolling, n)
            if not len(later):  # then no longer n-gram repeats either
                break
            if lengths is None:
                size = np.fromiter((len(w.decode("utf-8", "surrogatepass")) for w in distinct),
                                   np.int64, len(distinct))
                lengths = size[ids]
            if n == REPEAT_WINDOW:
                out["n_repeat_words"] = int(_covered(twice, n, len(words)).sum())
            out[f"dup_chars_{n}"] = int(lengths[_covered(later, n, len(words))].sum())
    return out


def verdict(m: dict[str, int]) -> tuple[bool, bool]:
    failed = (m["n_words"] < MIN_WORDS
              or 100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])
    rejected = (
        failed
        or any(100 * m[f"dup_chars_{n}"] > p * m["word_chars"]
               for n, p in MAX_NGRAM_PERCENT.items())
        or 100 * m["dup_line_chars"] > MAX_LINE_CHAR_PERCENT * m["line_chars"])
    return failed, not rejected


def with_quality(df: DataFrame, text_col: str = "text", out_col: str = "quality") -> DataFrame:
    """``df`` with one struct column of counts and verdicts per row; a column already named
    ``out_col`` is replaced, all others pass through untouched.

    Null and empty texts have no words: every count is 0, base_failed is true, kept false.
    Repeated rows are judged one by one. One text is held at a time, so memory is bounded by
    the longest text; there is no shuffle.
    """
    @F.arrow_udf(SCHEMA)
    def rules(text: pa.Array) -> pa.Array:
        columns = {n: [] for n in [*NAMES, "base_failed", "kept"]}
        for t in texts_of(text):
            m = measures(t)
            for n in NAMES:
                columns[n].append(m[n])
            failed, kept = verdict(m)
            columns["base_failed"].append(failed)
            columns["kept"].append(kept)
        arrays = [pa.array(v, pa.bool_() if n in ("base_failed", "kept") else pa.int64())
                  for n, v in columns.items()]
        return pa.StructArray.from_arrays(arrays, names=list(columns))

    return df.withColumn(out_col, rules(F.col(text_col)))
