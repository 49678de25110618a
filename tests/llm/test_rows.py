"""Row-wise operators against brute force and the tokenizer library."""

import hashlib
import re
import struct
from collections import Counter

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from peerscope.llm import bpe, quality

WORD = re.compile("[^\x20\x09-\x0d]+")
FILE = public_tokenizers.path("word_bpe_49k.json")


def brute_quality(text):
    text = text or ""
    words = WORD.findall(text)
    out = {"n_words": len(words), "word_chars": sum(map(len, words)),
           "n_symbols": sum(c in "#*$%&|<>" for c in text)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    later = [x for i, x in enumerate(lines) if x in lines[:i]]
    out |= {"n_lines": len(lines), "n_dup_lines": len(later),
            "line_chars": sum(map(len, lines)), "dup_line_chars": sum(map(len, later))}
    for n in range(5, 11):
        grams = [tuple(words[i:i + n]) for i in range(len(words) - n + 1)]
        counts, seen, twice, again = Counter(grams), set(), set(), set()
        for i, g in enumerate(grams):
            if counts[g] > 1:
                twice |= set(range(i, i + n))
            if g in seen:
                again |= set(range(i, i + n))
            seen.add(g)
        if n == 5:
            out["n_repeat_words"] = len(twice)
        out[f"dup_chars_{n}"] = sum(len(words[i]) for i in again)
    return out


@settings(max_examples=200, deadline=None)
@given(st.one_of(st.none(), st.lists(st.sampled_from(
    ["a", "b", "é", "#x", "\n", "\t", " ", "日本", " ", "c c c c c c c\n"])).map(" ".join)))
def test_quality_measures_equal_brute_force(text):
    assert quality.measures(text) == brute_quality(text)


def test_quality_survives_hash_collisions(monkeypatch):
    monkeypatch.setattr(quality, "mix64", lambda x: x * 0)
    text = "a b c d e f g a b c d e f g h i j k l m n o p q r s t u v w x y z"
    assert quality.measures(text) == brute_quality(text)


def test_quality_rows_clash_and_edge_cases(spark):
    long = "word " * 3 + " ".join(f"w{i}" for i in range(200_000))
    clean = " ".join(f"w{i}" for i in range(50))
    rows = [(1, None, "x"), (1, None, "x"), (None, "", "y"), (2, clean, None), (3, long, "z"),
            (4, "spam " * 50, "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality string")
    got = quality.with_quality(df)
    assert got.columns == ["doc_id", "text", "quality"]
    kept = [(r.doc_id, r.quality.kept, r.quality.n_words) for r in got.collect()]
    assert kept == [(1, False, 0), (1, False, 0), (None, False, 0), (2, True, 50),
                    (3, True, 200_003), (4, False, 50)]
    assert quality.with_quality(df.limit(0)).count() == 0


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(FILE)
    t.no_truncation()
    t.no_padding()
    return t


def assert_same(encoder, library, text):
    ids, decoded = encoder.encode(text)
    want = library.encode(text, add_special_tokens=False).ids
    assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == want, repr(text)
    assert decoded.decode() == library.decode(want, skip_special_tokens=False), repr(text)


@pytest.fixture(scope="module")
def encoder():
    return bpe.WordBpe(bpe.read_spec(FILE))


@pytest.mark.parametrize("text", [
    "", " ", "Hello, world's BEST!! don't we'll I'd 123 4", "ΣΑΣ ΟΔΟΣ", "İstanbul ẞ ŉ",
    "é ́x a b c d", "a<|endoftext|>b <|startoftext|><|endoftext|>",
    "<|ENDOFTEXT|>", "\x1c\x1d\x85 x", "日本語テキスト 한국어 \U0001f600\U0001f468‍", "\x00\x7f",
    "x" * 3000, "the" * 2000, "'s 's't", "ﬁ Å Å Ω", "٣٤ ⅷ ²"])
def test_bpe_equals_library(encoder, library, text):
    assert_same(encoder, library, text)


@settings(max_examples=400, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs", "Cn", "Co"]), max_size=60))
def test_bpe_equals_library_on_any_text(encoder, library, text):
    assert_same(encoder, library, text)


def test_bpe_caches_start_anew(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 3)
    fresh = bpe.WordBpe(bpe.read_spec(FILE))
    assert_same(fresh, library, "one two three four five one two " * 3)


def test_bpe_rows(spark, library):
    df = spark.createDataFrame([(1, None, 5), (2, "", 6), (2, "A b", 7), (None, "A b", 8)],
                               "doc_id long, text string, bpe int")
    got = bpe.with_bpe(df, FILE).collect()
    nothing = hashlib.sha256(b"").hexdigest()
    assert [r.bpe.n_tokens for r in got] == [0, 0, 2, 2]
    assert got[0].bpe.ids_sha256 == got[1].bpe.decoded_sha256 == nothing
    full = bpe.with_bpe(df, FILE, outputs=("ids", "decoded")).collect()
    assert full[3].bpe.decoded == "a</w> b</w>"
    assert full[3].bpe.ids == library.encode("A b", add_special_tokens=False).ids
    assert bpe.with_bpe(df.limit(0), FILE).count() == 0
