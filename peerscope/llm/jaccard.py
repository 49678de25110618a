"""N-gram Jaccard join of documents on count vectors.

1. Every text becomes its set of hashed word shingles; equal sets are one class.
2. Classes meet by signatures. Sets that reach the similarity differ in at most d elements
   (d follows from their size class), so of more than d hash groups some are equal, and the
   hash of an equal, non-empty group is a signature that both have. Sets with many empty
   groups also sign these. No similar pair is lost, whatever it has in common.
3. Pairs from small blocks must pass the count-vector bound. In large blocks no pairs are
   listed: blocks with the same least member are one, and a search over the count vectors
   gives a forest that connects just the members which pairs within the bound connect. It is
   cut into pieces that hold every member once; across pieces, only members outside of the
   block's largest component are compared. The components of both are families.
4. Families are cut into tiles of bounded size. In a tile, a packed R-tree over the count
   vectors bounds overlaps by summed coordinate minima, and surviving pairs in different
   components are verified on the whole sets. First neighbouring tiles are joined; then what
   is not in a family's largest component meets all its tiles of a fitting size.
5. The components of verified links label the documents.

Shingles and classes are compared by 64-bit hashes (a class also by its size).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peerscope.llm.components import components
from peerscope.llm.rtree import (TABLE_BITS, PackedTree, bits_of, count_vector, folded, need,
                                 packed)
from peerscope.llm.session import materialised, release
from peerscope.llm.words import mix64, numbered, texts_of

#: Blocks of up to so many classes list their pairs; larger ones are searched, so many
#: classes at once.
SMALL_BLOCK, SEARCH_ROWS = 32, 4096
#: Documents and shingles of a tile, about.
TILE_ROWS, TILE_SHINGLES = 128, 1 << 19
#: Digests of texts (16 bytes each) that are broadcast at most; more are joined by a shuffle.
BROADCAST_KEYS = 1 << 20
#: Growth of the size classes; at least 100 / percent.
CLASS_GROWTH = 1.5
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: list[str | None], words_each: int) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of each text's shingles; a text with fewer words is one shingle,
    one without words has none."""
    import xxhash

    words, counts = [], []
    for t in texts:
        own = (t or "").encode("utf-8", "surrogatepass").lower().split()
        words += own
        counts.append(len(own))
    distinct, ids = numbered(words)
    digest = xxhash.xxh3_64_intdigest
    word = np.fromiter(map(digest, distinct), np.uint64, len(distinct))[ids]
    at = 0
    with np.errstate(over="ignore"):
        rolling = word.copy()
        for k in range(1, words_each):
            rolling = rolling[:-1] * _STEP + word[k:]
        rolling = mix64(rolling)
        for n in counts:
            if n >= words_each:
                own = np.sort(rolling[at:at + n - words_each + 1])
                yield own[np.concatenate(([True], own[1:] != own[:-1]))]
            elif n:
                key = np.uint64(n)
                for w in word[at:at + n]:
                    key = key * _STEP + w
                yield mix64(np.array([key], np.uint64))
            else:
                yield np.empty(0, np.uint64)
            at += n


def _groups(texts, limit: int = 1 << 21):
    """Runs of texts of about ``limit`` characters."""
    pending, size = [], 0
    for t in texts:
        pending.append(t)
        size += len(t or "")
        if size >= limit:
            yield pending
            pending, size = [], 0
    if pending:
        yield pending


def class_id(elements: np.ndarray) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh3_64_intdigest(elements.tobytes())).view(np.int64))


class Schemes:
    """Size classes and the number of hash groups with which each class signs."""

    def __init__(self, percent: int):
        if percent * CLASS_GROWTH < 100:
            raise ValueError("similarities below 67 percent need wider size classes")
        self.percent = percent
        self.low = [1]
        self._groups: list[tuple[int, int]] = []

    def _reach(self, size: int) -> None:
        while self.low[-1] <= size:
            last = self.low[-1]
            self.low.append(max(last + 1, math.ceil(last * CLASS_GROWTH)))

    def of(self, size: int) -> list[int]:
        """The size's own class, and lower ones whose largest size can be a partner."""
        self._reach(size)
        own = int(np.searchsorted(self.low, size, "right")) - 1
        found = [own]
        for k in range(own - 1, -1, -1):
            if 100 * (self.low[k + 1] - 1) < self.percent * size:
                break
            found.append(k)
        return found

    def groups(self, k: int) -> tuple[int, int]:
        """Hash groups of class k, and the empty groups beyond which a set signs these too."""
        while len(self._groups) <= k:
            j = len(self._groups)
            self._reach(self.low[j])
            small = self.low[j + 1] - 1
            large = 100 * small // self.percent
            differ = (small + large) * (100 - self.percent) // (100 + self.percent)
            spare = 0
            for _ in range(8):  # room for nearly all sets' empty groups
                n = differ + 1 + spare
                empty = n * math.exp(-self.low[j] / n)
                spare = math.ceil(empty + 4 * math.sqrt(empty)) if differ else 0
                spare = min(spare, differ + 1)
            self._groups.append((differ + 1 + spare, spare))
        return self._groups[k]

    def signatures(self, elements: np.ndarray) -> np.ndarray:
        """All signatures of a set, as int64."""
        out = []
        mixed = mix64(elements + _STEP)
        for k in self.of(len(elements)):
            n, spare = self.groups(k)
            place = ((elements >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)
            first = np.flatnonzero(np.diff(place, prepend=-1))
            with np.errstate(over="ignore"):
                total = np.add.reduceat(mixed, first)
                tag = mix64(place[first].astype(np.uint64) + np.uint64(k << 40))
                out.append(mix64(total ^ tag))
                if n - len(first) > spare:
                    void = np.setdiff1d(np.arange(n), place[first]).astype(np.uint64)
                    out.append(mix64(mix64(void + np.uint64(k << 40)) + np.uint64(1)))
        return np.concatenate(out).view(np.int64)


def _describe(words_each: int):
    @F.arrow_udf("struct<kid:bigint,n:bigint,counts:binary>")
    def describe(text: pa.Array) -> pa.Array:
        kid, n, counts = [], [], []
        for group in _groups(texts_of(text)):
            for s in shingle_sets(group, words_each):
                kid.append(class_id(s))
                n.append(len(s))
                counts.append(packed(s))
        return pa.StructArray.from_arrays(
            [pa.array(kid, pa.int64()), pa.array(n, pa.int64()), pa.array(counts, pa.binary())],
            names=["kid", "n", "counts"])
    return describe


_SIGNED = pa.schema([("sig", pa.int64()), ("kid", pa.int64())])


def _sign(words_each: int, percent: int):
    def sign(batches):
        schemes, seen = Schemes(percent), set()
        for batch in batches:
            for group in _groups(texts_of(batch["text"])):
                sigs, kids, sizes = [], [], []
                for s in shingle_sets(group, words_each):
                    if not len(s) or (kid := class_id(s)) in seen:
                        continue
                    seen.add(kid)
                    own = schemes.signatures(s)
                    sigs.append(own)
                    kids.append(kid)
                    sizes.append(len(own))
                if len(seen) > 1 << 18:
                    seen.clear()
                if sigs:
                    yield pa.record_batch([
                        pa.array(np.concatenate(sigs)),
                        pa.array(np.repeat(np.array(kids, np.int64), sizes))], schema=_SIGNED)
    return sign


_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("large", pa.bool_())])


def _blocks(batches):
    """Rows sorted by (sig, kid) -> pairs (a, b) of small blocks, and the members (least class
    of the block, class) of large ones. Near copies share many signatures, whose blocks mostly
    have the same least class: named by it, they are one."""
    def out(a, b, large):
        pair = np.unique(np.stack([a, b], axis=1), axis=0)
        return pa.record_batch([pa.array(pair[:, 0]), pa.array(pair[:, 1]),
                                pa.array(np.full(len(pair), large))], schema=_EDGES)

    sig, kid = np.empty(0, np.int64), np.empty(0, np.int64)
    large = head = None  # the signature and the least class of a large block that goes on

    def close(sig, kid):
        start = np.flatnonzero(np.diff(sig, prepend=sig[0] - 1 if len(sig) else 0))
        size = np.diff(np.append(start, len(sig)))
        a, b = [], []
        for s in np.unique(size[(size > 1) & (size <= SMALL_BLOCK)]):
            rows = kid[start[size == s][:, None] + np.arange(s)]
            i, j = np.triu_indices(s, 1)
            a.append(rows[:, i].ravel())
            b.append(rows[:, j].ravel())
        if a:
            yield out(np.concatenate(a), np.concatenate(b), False)
        for f, s in zip(start[size > SMALL_BLOCK], size[size > SMALL_BLOCK]):
            yield out(np.full(s, kid[f]), kid[f:f + s], True)

    for batch in batches:
        s, k = batch["sig"].to_numpy(), batch["kid"].to_numpy()
        if large is not None:
            same = s == large
            if same.any():
                yield out(np.full(same.sum(), head), k[same], True)
            s, k = s[~same], k[~same]
            if not len(s):
                continue
            large = None
        sig, kid = np.concatenate((sig, s)), np.concatenate((kid, k))
        if not len(sig):
            continue
        fresh = np.ones(len(sig), bool)
        fresh[1:] = (sig[1:] != sig[:-1]) | (kid[1:] != kid[:-1])
        sig, kid = sig[fresh], kid[fresh]
        cut = np.searchsorted(sig, sig[-1], "left")  # the last block may go on
        if len(sig) - cut > SMALL_BLOCK:
            yield from close(sig, kid)
            large, head = sig[-1], kid[cut]
            sig, kid = sig[:0], kid[:0]
        else:
            yield from close(sig[:cut], kid[:cut])
            sig, kid = sig[cut:], kid[cut:]
    yield from close(sig, kid)


def _within_bound(percent: int):
    @F.arrow_udf("boolean")
    def within(a: pa.Array, b: pa.Array, n_a: pa.Array, n_b: pa.Array) -> pa.Array:
        out = np.zeros(len(a), bool)
        sizes = n_a.to_numpy(), n_b.to_numpy()
        wanted = need(*sizes, percent)
        bits = np.minimum(bits_of(sizes[0]), bits_of(sizes[1]))
        for k in np.unique(bits).tolist():
            every, step = np.flatnonzero(bits == k), max(1, (1 << 21) >> k)
            for at in (every[s:s + step] for s in range(0, len(every), step)):
                x, y = (folded(v.take(pa.array(at)).to_pylist(), n[at], k)
                        for v, n in zip((a, b), sizes))
                out[at] = np.minimum(x, y).sum(axis=1) >= wanted[at]
        return pa.array(out)
    return within


def _forest(percent: int):
    """Members (kid, n, counts) of a large block -> edges that connect what pairs within the
    count-vector bound connect; every member is compared with those not reached yet."""
    def search(table: pa.Table) -> pa.Table:
        table = table.sort_by("n")
        kid, n = table["kid"].to_numpy(), table["n"].to_numpy()
        points = folded(table["counts"].to_pylist(), n, min(TABLE_BITS, int(bits_of(n[0]))))
        low = np.searchsorted(n, -((-percent * n) // 100), "left")
        high = np.searchsorted(n, 100 * n // percent, "right")
        fresh = np.ones(len(kid), bool)
        a, b = [], []
        for start in range(len(kid)):
            if not fresh[start]:
                continue
            fresh[start] = False
            queue = [start]
            while queue:
                p = queue.pop()
                near = low[p] + np.flatnonzero(fresh[low[p]:high[p]])
                shared = np.minimum(points[near], points[p]).sum(axis=1)
                near = near[shared >= need(n[p], n[near], percent)]
                fresh[near] = False
                a.append(np.full(len(near), kid[p]))
                b.append(kid[near])
                queue.extend(near.tolist())
        a, b = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (a, b))
        return pa.table({"a": pa.array(a[a != b], pa.int64()),
                         "b": pa.array(b[a != b], pa.int64())})
    return search


class Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        self.up[self.find(i)] = self.find(j)


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


def _join_tile(words_each: int, percent: int):
    """Rows (kid, comp, text, asks, answers) of one meeting of tiles -> verified links that
    connect different components; ``asks`` rows are the queries, ``answers`` rows the tree."""
    def join(table: pa.Table) -> pa.Table:
        kid = table["kid"].to_numpy()
        comp = table["comp"].to_numpy()
        asks = np.array(table["asks"].to_pylist(), bool)
        answers = np.array(table["answers"].to_pylist(), bool)
        sets = list(shingle_sets(table["text"].to_pylist(), words_each))
        sizes = np.array([len(s) for s in sets])
        bits = min(TABLE_BITS, int(bits_of(sizes.min())))
        points = np.stack([count_vector(s, bits) for s in sets])
        parts = Union(len(kid))
        first: dict[int, int] = {}
        for i, c in enumerate(comp.tolist()):
            parts.join(i, first.setdefault(c, i))
        q, p = np.flatnonzero(asks), np.flatnonzero(answers)
        a, b = [], []
        if len(q) and len(p):
            tree = PackedTree(points[p], sizes[p])
            i, j = tree.partners(points[q], sizes[q], percent)
            i, j = q[i], p[j]
            other = kid[i] != kid[j]
            for x, y in zip(i[other].tolist(), j[other].tolist()):
                if parts.find(x) == parts.find(y):
                    continue
                same = _overlap(sets[x], sets[y])
                if 100 * same >= percent * (len(sets[x]) + len(sets[y]) - same):
                    parts.join(x, y)
                    a.append(kid[x])
                    b.append(kid[y])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return join


def _labelled(nodes: DataFrame, edges: DataFrame, name: str) -> DataFrame:
    """``nodes`` (kid, ...) with the component of each under ``edges``; alone: its own."""
    found = components(edges).withColumnsRenamed({"node": "kid", "component": "__c"})
    return nodes.join(found, "kid", "left").withColumn(
        name, F.coalesce("__c", "kid")).drop("__c")


def _across(wide: DataFrame, points: DataFrame, near: DataFrame, percent: int) -> DataFrame:
    """Members (head, kid, cut) of blocks in several pieces -> edges across the pieces, given the
    edges ``near`` within them. What these connect to the block's largest component need not be
    compared with each other: the rest meets all pieces, the others are repeated only for it."""
    state = _labelled(wide.select("head", "kid", "cut"), near, "comp")
    sizes = state.groupBy("head", "comp").agg(F.count("*").alias("m"))
    main = sizes.groupBy("head").agg(F.max_by("comp", F.struct("m", "comp")).alias("main"))
    state = materialised(state.join(main, "head").withColumn("left", F.col("comp") != F.col("main")))
    rests = state.filter("left").groupBy("head").agg(
        F.ceil(F.count("*") / SEARCH_ROWS).alias("rests"))
    state = state.join(rests, "head").withColumn("own", F.pmod(F.xxhash64("kid"), F.col("rests")))
    home = state.select("head", F.col("cut").alias("at")).distinct()
    asking = state.filter("left").join(home, "head").select(
        "head", F.col("own").alias("r"), F.col("at").alias("cut"), "kid")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("rests") - 1))
    answering = state.select("head", every.alias("r"), "cut", "kid")
    return materialised(asking.union(answering).distinct().join(points, "kid")
                        .groupBy("head", "r", "cut").applyInArrow(
                            _forest(percent), "a bigint, b bigint"))


def near_duplicates(df: DataFrame, words_each: int = 4, percent: int = 85,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``df``: doc_id, n_shingles, component_id (the least id that can
    be reached by links, its own included; links need ``percent`` percent similarity).

    Null and empty texts, and texts without words, have no shingles and no links: their
    component is their own id. Rows with a null id take part and lend no id; their component
    is null if no id can be reached. Repeated rows have equal sets and are linked. Other
    columns are ignored; an empty table gives an empty result.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                     F.unhex(F.md5(F.col(text_col))).alias("tkey"))
    rows = materialised(docs.withColumn("d", _describe(words_each)("text"))
                        .select("doc_id", "tkey", "d.*"))
    classes = materialised(rows.filter("n > 0").groupBy("kid", "n").agg(
        F.min("tkey").alias("tkey"), F.min("doc_id").alias("least"),
        F.any_value("counts").alias("counts")))

    signed = docs.select("text").filter("text IS NOT NULL").mapInArrow(
        _sign(words_each, percent), "sig bigint, kid bigint")
    edges = materialised(
        signed.repartition(parts, "sig").sortWithinPartitions("sig", "kid")
        .mapInArrow(_blocks, "a bigint, b bigint, large boolean").distinct())
    of = lambda name: classes.select(
        F.col("kid").alias(name), F.col("n").alias(f"n_{name}"),
        F.col("counts").alias(f"counts_{name}"))
    sized = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    close = (edges.filter("NOT large").join(of("a"), "a").join(of("b"), "b").filter(
        sized & _within_bound(percent)("counts_a", "counts_b", "n_a", "n_b")).select("a", "b"))
    # every member of a large block once, in one of the block's pieces
    large = edges.filter("large").select(F.col("a").alias("head"), F.col("b").alias("kid"))
    cuts = large.groupBy("head").agg(F.ceil(F.count("*") / SEARCH_ROWS).alias("cuts"))
    large = materialised(large.join(cuts, "head").withColumn(
        "cut", F.pmod(F.xxhash64("kid"), F.col("cuts"))))
    points = classes.select("kid", "n", "counts")
    loose = (large.join(points, "kid").groupBy("head", "cut")
             .applyInArrow(_forest(percent), "a bigint, b bigint"))
    near = materialised(close.union(loose))
    wide = large.filter("cuts > 1")
    if not wide.isEmpty():
        near = near.union(_across(wide, points, near, percent))
    del signed, edges, close, large, cuts, points, loose, wide
    release(spark)
    family = components(near).toDF("kid", "family")

    # members of families with their tiles; a family's tiles of one size bucket are dealt by id
    member = classes.select("kid", "n", "tkey").join(family, "kid").withColumn(
        "bucket", F.floor(F.log(F.col("n").cast("double")) / F.lit(math.log(CLASS_GROWTH)))
        .cast("int"))
    cells = member.groupBy("family", "bucket").agg(F.greatest(
        F.ceil(F.count("*") / TILE_ROWS), F.ceil(F.sum("n") / TILE_SHINGLES)).alias("cuts"))
    member = member.join(cells, ["family", "bucket"]).withColumn(
        "cut", F.pmod(F.xxhash64("kid"), F.col("cuts"))).drop("cuts")
    tiles = member.select("family", "bucket", "cut").distinct()
    in_order = Window.partitionBy("family").orderBy("bucket", "cut")
    tiles = tiles.withColumn("tile", F.row_number().over(in_order))
    member = materialised(member.join(tiles, ["family", "bucket", "cut"]).select(
        "kid", "family", "bucket", "tile", "tkey"))
    # only members' texts are moved; where their digests may be broadcast, no other text is
    n_members = member.count()
    wanted = member.select("tkey").distinct()
    wanted = F.broadcast(wanted) if n_members <= BROADCAST_KEYS else wanted
    texts = docs.join(wanted, "tkey", "left_semi").groupBy("tkey").agg(
        F.any_value("text").alias("text"))
    member = materialised(member.join(texts, "tkey").drop("tkey"))
    # the meetings' work follows their pairs, not their bytes: tasks enough for all tiles
    tasks = max(parts, math.ceil(n_members / TILE_ROWS))

    release(spark)

    # neighbouring tiles
    count = member.groupBy("family").agg(F.max("tile").alias("tiles"))
    placed = member.join(count, "family").withColumn("meeting", F.explode(
        F.when(F.col("tiles") == 1, F.array(F.lit(1))).otherwise(F.filter(
            F.array(F.col("tile") - 1, F.col("tile")),
            lambda m: (m >= 1) & (m < F.col("tiles"))))))
    yes, links = F.lit(True), "a bigint, b bigint"
    first = materialised(placed.select(
        "family", "meeting", "kid", F.col("kid").alias("comp"), "text", yes.alias("asks"),
        yes.alias("answers")).repartition(tasks, "family", "meeting")
        .groupBy("family", "meeting").applyInArrow(
        _join_tile(words_each, percent), links))

    # the rest of families with three tiles or more
    wide = member.join(count.filter("tiles > 2").select("family"), "family")
    state = _labelled(wide, first, "comp")
    sizes = state.groupBy("family", "comp").agg(F.count("*").alias("m"))
    main = sizes.groupBy("family").agg(F.max_by("comp", F.struct("m", "comp")).alias("main"))
    state = materialised(state.join(main, "family"))
    rest = state.filter("comp != main")
    cuts = rest.groupBy("family", "bucket").agg(
        F.ceil(F.count("*") / TILE_ROWS).alias("rests"))
    rest = rest.join(cuts, ["family", "bucket"]).withColumn(
        "r", F.pmod(F.xxhash64("kid"), F.col("rests"))).drop("tile")
    home = state.select("family", F.col("bucket").alias("to"), "tile").distinct()
    asking = rest.join(home, "family").filter("abs(bucket - to) <= 1").select(
        "family", "bucket", "r", "tile", "kid", "comp", "text", yes.alias("asks"),
        F.lit(False).alias("answers"))
    offers = cuts.select("family", F.col("bucket").alias("from"),
                         F.explode(F.sequence(F.lit(0), F.col("rests") - 1)).alias("r"))
    answering = state.join(offers, "family").filter("abs(bucket - from) <= 1").select(
        "family", F.col("from").alias("bucket"), "r", "tile", "kid", "comp", "text",
        F.lit(False).alias("asks"), yes.alias("answers"))
    meeting = ["family", "bucket", "r", "tile"]
    second = asking.union(answering).repartition(tasks, *meeting).groupBy(*meeting).applyInArrow(
        _join_tile(words_each, percent), links)

    found = _labelled(classes.select("kid", "n", "least"), first.union(second), "component")
    least = found.groupBy("component").agg(F.min("least").alias("component_id"))
    found = found.join(least, "component").select("kid", "n", "component_id")
    with_words = rows.filter("n > 0").select("doc_id", "kid", "n").join(found, ["kid", "n"])
    alone = rows.filter("n = 0")
    return with_words.select("doc_id", F.col("n").alias("n_shingles"), "component_id").union(
        alone.select("doc_id", F.lit(0).cast("long"), "doc_id"))
