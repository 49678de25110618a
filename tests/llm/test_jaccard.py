"""The Jaccard join against brute force, and the guarantees its steps rest on."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from peerscope.llm import components, jaccard, rtree


def brute(rows, words_each, percent):
    """doc_id -> (n_shingles, component) by comparing all pairs; ids are distinct."""
    sets = {}
    for i, text in rows:
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split()
        k = min(words_each, len(w))
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if w else set()
    comp = {i: i for i in sets}

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                comp[max(find(a), find(b))] = min(find(a), find(b))
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed, families=6, copies=30):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    shared = " ".join(rng.choices(words, k=30))
    texts = [None, "", " \n", "One two", "one TWO", "one", "x y z q", "x y z q"]
    for f in range(families):
        base = rng.choices(words, k=rng.choice([3, 8, 20, 60, 150]))
        for _ in range(rng.randint(1, copies)):
            copy = [rng.choice(words) if rng.random() < rng.choice([0, 0.01, 0.03]) else w
                    for w in base]
            texts.append(" ".join(copy + rng.choices(words, k=rng.choice([0, 0, 1, 2]))))
    for _ in range(60):  # unlike but for a passage
        texts.append(shared + " " + " ".join(rng.choices(words, k=rng.randint(5, 60))))
    return list(enumerate(texts))


@pytest.mark.parametrize("words_each,percent,tile,small", [
    (4, 85, 128, 32), (4, 85, 5, 3), (5, 80, 7, 4), (4, 85, 3, 2)])
def test_components_equal_brute_force(spark, monkeypatch, words_each, percent, tile, small):
    monkeypatch.setattr(jaccard, "TILE_ROWS", tile)
    monkeypatch.setattr(jaccard, "SMALL_BLOCK", small)
    monkeypatch.setattr(jaccard, "SEARCH_ROWS", 2 * tile)
    rows = corpus(tile)
    df = spark.createDataFrame([(i, t, "e") for i, t in rows],
                               "doc_id long, text string, kid string")
    got = jaccard.near_duplicates(df.repartition(3), words_each, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(
        rows, words_each, percent)


def test_large_blocks_repeat_no_member():
    """Near copies share many signatures: their blocks are one, and each class is in it once,
    wherever the batches end."""
    sig = np.repeat(np.arange(50), 1000)
    kid = np.tile(np.arange(1000) * 7 + 5, 50)
    for step in (300, 999, 4000):
        batches = [pa.record_batch({"sig": sig[at:at + step], "kid": kid[at:at + step]})
                   for at in range(0, len(sig), step)]
        found = pa.Table.from_batches(jaccard._blocks(iter(batches)))
        assert all(found["large"].to_pylist())
        pairs = set(zip(found["a"].to_pylist(), found["b"].to_pylist()))
        assert pairs == {(5, k) for k in kid[:1000].tolist()}


def test_pieces_of_a_block_meet_where_they_are_not_connected(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SEARCH_ROWS", 10)
    base = np.random.default_rng(3).integers(0, 2**64, 2000, np.uint64)
    rows, want = [], []
    for k in range(60):  # three clusters, dealt over six pieces
        own = np.sort(base[(k % 3) * 600:(k % 3) * 600 + 500 + k // 3])
        rows.append((1, k, k % 6, len(own), rtree.packed(own)))
        want.append(k % 3)
    df = spark.createDataFrame(rows, "head long, kid long, cut long, n long, counts binary")
    near = spark.createDataFrame([(k, k + 6) for k in range(0, 54, 2)], "a long, b long")
    found = jaccard._across(df.select("head", "kid", "cut"), df.select("kid", "n", "counts"),
                            near, 85)
    got = {r.node: r.component for r in components.components(near.union(found)).collect()}
    assert [got[k] for k in range(60)] == want


def test_null_and_repeated_ids(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(None, text), (7, text), (7, text), (3, text + " more"), (None, "alone here"),
            (None, None), (9, None), (9, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id))
                 for r in jaccard.near_duplicates(df).collect())
    assert got == sorted([("None", 47, "3"), ("7", 47, "3"), ("7", 47, "3"), ("3", 48, "3"),
                          ("None", 1, "None"), ("None", 0, "None"), ("9", 0, "9"),
                          ("9", 0, "9")])
    assert jaccard.near_duplicates(df.limit(0)).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 400), st.integers(0, 2**32), st.sampled_from([80, 85, 95]))
def test_similar_sets_share_a_signature(size, seed, percent):
    rng = np.random.default_rng(seed)
    both = rng.integers(0, 2**64, size, np.uint64)
    # as many own elements on either side as the similarity allows
    spare = size * (100 - percent) // percent
    cut = rng.integers(0, spare + 1)
    a = np.unique(np.concatenate((both, rng.integers(0, 2**64, cut, np.uint64))))
    b = np.unique(np.concatenate((both, rng.integers(0, 2**64, spare - cut, np.uint64))))
    same = len(np.intersect1d(a, b))
    assert 100 * same >= percent * (len(a) + len(b) - same)
    s = jaccard.Schemes(percent)
    assert set(s.signatures(a).tolist()) & set(s.signatures(b).tolist())


def test_tree_finds_every_pair_within_the_bound():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**64, 300, np.uint64)
    sets = [np.unique(np.where(rng.random(300) < rng.random() * 0.2,
                               rng.integers(0, 2**64, 300, np.uint64), base)[:rng.integers(200, 300)])
            for _ in range(200)]
    points = np.stack([rtree.count_vector(np.sort(s)) for s in sets])
    sizes = np.array([len(s) for s in sets])
    tree = rtree.PackedTree(points, sizes)
    q, p = tree.partners(points, sizes, 85)
    found = set(zip(q.tolist(), p.tolist()))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            same = len(np.intersect1d(a, b))
            if 100 * same >= 85 * (len(a) + len(b) - same):
                assert (i, j) in found
    assert len(found) < len(sets) ** 2 / 2


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
def test_connected_components(spark, pairs):
    up = list(range(31))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in pairs:
        up[max(find(a), find(b))] = min(find(a), find(b))
    nodes = {x for a, b in pairs if a != b for x in (a, b)}
    df = spark.createDataFrame([*pairs, (None, 3), (4, None)], "a int, b int")
    got = [tuple(r) for r in components.components(df).collect()]
    assert sorted(got) == sorted((i, find(i)) for i in nodes)
