"""Near-duplicate embeddings by cross-polytope hashing.

A vector is turned by three rounds of random signs and a fast Hadamard transform; the axis
(and sign) nearest to the result is its hash. Several such hashes name a bucket, and several
tables of buckets are kept. Every vector is filed once in each table and asks in the buckets
nearest to it as well. Rows carry 64 signs of further rotations; a candidate pair whose signs
differ more often than those of a similar pair ever would (by five standard deviations) is
dropped before its vectors are fetched, all others are verified by the exact cosine. Below 8
dimensions rotations hardly differ: all candidates are verified there.

Equal vectors of a label are one class before anything is hashed, so copies cost nothing.
"""

from __future__ import annotations

import math
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerscope.llm.components import components
from peerscope.llm.session import materialised
from peerscope.llm.words import mix64

#: Tables, buckets asked in each, and axes considered by each hash when asking.
TABLES, PROBES, AXES = 12, 8, 4
#: Unrelated classes that a bucket may hold on average before buckets get another hash.
BUCKET_CLASSES = 8
#: Dimensions from which 64 signs of rotations are independent enough to tell pairs apart.
SIGN_DIMS = 8
#: Most hashes of a bucket below 4 and below 8 dimensions; more would lose similar pairs.
FEW_HASHES = ((4, 2), (8, 3))
#: Parts over which the rows of one label are dealt when they look up their hashes.
SALTS = 16


def rotations(width: int, count: int) -> np.ndarray:
    """Signs of three rounds for ``count`` rotations of ``width`` values: [count, 3, width]."""
    key = np.arange(count * 3 * width, dtype=np.uint64) + np.uint64(width << 32)
    return np.where(mix64(key) >> np.uint64(63), 1.0, -1.0).reshape(count, 3, width)


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Hadamard transform of every row; the width is a power of two."""
    n, width = x.shape
    half = 1
    while half < width:
        x = x.reshape(n, -1, 2, half)
        x = np.concatenate((x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]), axis=2)
        half *= 2
    return x.reshape(n, width) / math.sqrt(width)


def turned(x: np.ndarray, signs: np.ndarray) -> np.ndarray:
    for s in signs:
        x = hadamard(x * s)
    return x


def probe_order(axes: int, hashes: int, probes: int) -> list[tuple[int, ...]]:
    """Which of its nearest axes each hash takes, the likeliest buckets first: by the sum of
    ranks, then fewest changes."""
    every = sorted(product(range(axes), repeat=hashes),
                   key=lambda c: (sum(c), sum(r > 0 for r in c), c))
    return every[:probes]


def buckets(x: np.ndarray, label: np.ndarray, hashes: int) -> np.ndarray:
    """Bucket keys [vector, table, probe] of unit vectors of one dimension; probe 0 is the
    vector's own bucket. A key mixes label, dimension, table and axes."""
    n, dim = x.shape
    width = 1 << max(1, (dim - 1).bit_length())
    padded = np.zeros((n, width))
    padded[:, :dim] = x
    signs = rotations(width, TABLES * hashes)
    axes = min(AXES, width)
    order = probe_order(axes, hashes, PROBES)
    out = np.empty((n, TABLES, len(order)), np.uint64)
    seed = mix64(mix64(label.astype(np.int64).view(np.uint64)) + np.uint64(dim))
    for t in range(TABLES):
        near = []
        for h in range(hashes):
            y = turned(padded, signs[t * hashes + h])
            top = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :axes]
            near.append(top * 2 + (np.take_along_axis(y, top, axis=1) < 0))
        for p, ranks in enumerate(order):
            key = mix64(seed + np.uint64(t))
            for h, r in enumerate(ranks):
                key = mix64(key ^ near[h][:, r].astype(np.uint64))
            out[:, t, p] = key
    return out.view(np.int64)


def signs_of(x: np.ndarray) -> np.ndarray:
    """64 signs of random rotations of unit vectors, as bits of an integer; all alike below
    ``SIGN_DIMS`` dimensions."""
    n, dim = x.shape
    if dim < SIGN_DIMS:
        return np.zeros(n, np.int64)
    width = 1 << max(1, (dim - 1).bit_length())
    padded = np.zeros((n, width))
    padded[:, :dim] = x
    extra = rotations(width, TABLES * 8 + max(1, 64 // width))[TABLES * 8:]
    y = np.concatenate([turned(padded, s)[:, :64] for s in extra], axis=1)[:, :64]
    return np.packbits(y > 0, axis=1).view(np.uint64)[:, 0].view(np.int64)


def most_unlike(least: float) -> int:
    """Signs of 64 that differ, at most, for a cosine of ``least``: five standard deviations
    above the mean."""
    p = math.acos(max(-1.0, min(1.0, least))) / math.pi
    return min(64, math.ceil(64 * p + 5 * math.sqrt(64 * p * (1 - p))))


def _dense(vectors: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Rows by dimension: places and values of the vectors without a null or non-finite
    component and of a length above zero."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    rows: dict[int, tuple[list, list]] = {}
    for i, v in enumerate(vectors):
        if v.is_valid and v.values.null_count == 0:
            x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
            if len(x) and np.isfinite(x).all() and x.any():
                at = rows.setdefault(len(x), ([], []))
                at[0].append(i)
                at[1].append(x)
    return {d: (np.array(i), np.stack(x)) for d, (i, x) in rows.items()}


@F.arrow_udf(T.BinaryType())
def vector_key(vectors: pa.Array) -> pa.Array:
    """A digest of the exact values; null for vectors that link with nothing."""
    import hashlib

    keys: list[bytes | None] = [None] * len(vectors)
    for rows, x in _dense(vectors).values():
        for i, v in zip(rows.tolist(), x):
            keys[i] = hashlib.md5(v.tobytes()).digest()
    return pa.array(keys, pa.binary())


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times an exact power of two, so that squares neither overflow nor vanish."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def _unit(x: np.ndarray) -> np.ndarray:
    x = _scaled(x)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


_ROWS = "bucket bigint, cid bigint, signs bigint"
_FILED = pa.schema([("bucket", pa.int64()), ("cid", pa.int64()), ("signs", pa.int64())])


def _file(asking: bool):
    def rows(batches):
        for batch in batches:
            cid, label = batch["cid"].to_numpy(), batch["label"].to_numpy()
            hashes = batch["hashes"].to_numpy()
            for every, vectors in _dense(batch["vector"]).values():
                for h in np.unique(hashes[every]).tolist():
                    at, x = every[hashes[every] == h], _unit(vectors[hashes[every] == h])
                    key = buckets(x, label[at], h)
                    key = key if asking else key[:, :, :1]
                    each = key.shape[1] * key.shape[2]
                    yield pa.record_batch([
                        pa.array(key.ravel()), pa.array(np.repeat(cid[at], each)),
                        pa.array(np.repeat(signs_of(x), each))], schema=_FILED)
    return rows


def crowded(classes: DataFrame) -> DataFrame:
    """(label, d, hashes) of the labels and dimensions that need more than two hashes. With one
    hash more, unrelated vectors meet 2 * dimension times less often."""
    d = F.col("d")
    axes = F.greatest(F.lit(1), F.ceil(F.log2(d) - 1e-9)) + 1  # its logarithm
    hashes = F.ceil((F.log2(F.col("n") / F.lit(float(BUCKET_CLASSES))) - 1e-9) / axes)
    for dims, most in reversed(FEW_HASHES):
        hashes = F.when(d < dims, F.least(hashes, F.lit(most))).otherwise(hashes)
    return classes.groupBy("label", F.size("vector").alias("d")).agg(
        F.count("*").alias("n")).select("label", "d", hashes.cast("int").alias("hashes")).filter(
        "hashes > 2")


def _similar(least: float):
    @F.arrow_udf("boolean")
    def similar(a: pa.Array, b: pa.Array) -> pa.Array:
        out = np.zeros(len(a), bool)
        left, right = _dense(a), _dense(b)
        for d, (i, x) in left.items():
            if d in right:
                j, y = right[d]
                both, p, q = np.intersect1d(i, j, assume_unique=True, return_indices=True)
                x, y = _scaled(x[p]), _scaled(y[q])
                dots = np.einsum("ij,ij->i", x, y)
                norms = np.sqrt((x ** 2).sum(axis=1) * (y ** 2).sum(axis=1))
                out[both] = dots >= least * norms
        return pa.array(out)
    return similar


def near_vectors(df: DataFrame, least: float = 0.93, id_col: str = "vec_id",
                 vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row for each row of ``df``: vec_id, n_links (other rows of equal, non-null label
    with a cosine of ``least`` or more that were found), component_id (least id reachable by
    links, its own included), kept (vec_id = component_id).

    A vector that is null, empty, zero or holds a null or non-finite component, or whose label
    is null, links with nothing: 0 links, its own component, kept. Vectors of different
    dimensions do not link. Rows with a null id count as others' links and lend no id; they
    are not kept. Repeated rows link with each other. Other columns are ignored.
    """
    rows = materialised(df.select(
        F.col(id_col).alias("vec_id"), F.col(label_col).cast("long").alias("label"),
        F.col(vector_col).alias("vector")).withColumn(
        "key", F.when(F.col("label").isNotNull(), vector_key("vector"))))
    sound = rows.filter("key IS NOT NULL")
    classes = sound.groupBy("label", "key").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("copies"),
        F.any_value("vector").alias("vector"))
    classes = materialised(classes.withColumn("cid", F.monotonically_increasing_id()))
    points, more = classes.select("cid", "label", "vector"), materialised(crowded(classes))
    if more.isEmpty():
        hashed = points.withColumn("hashes", F.lit(2))
    else:  # salted, for a label may hold most rows
        more = more.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        hashed = (points.withColumn("d", F.size("vector"))
                  .withColumn("salt", F.pmod(F.xxhash64("cid"), F.lit(SALTS)).cast("int"))
                  .join(more, ["label", "d", "salt"], "left")
                  .select("cid", "label", "vector", F.coalesce("hashes", F.lit(2)).alias("hashes")))
    filed = hashed.mapInArrow(_file(False), _ROWS)
    asking = hashed.mapInArrow(_file(True), _ROWS)
    unlike = F.bit_count(F.col("s").bitwiseXOR(F.col("t")))
    pairs = (asking.toDF("bucket", "x", "s").join(filed.toDF("bucket", "y", "t"), "bucket")
             .filter((F.col("x") != F.col("y")) & (unlike <= most_unlike(least)))
             .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    of = lambda c: points.select(F.col("cid").alias(c), F.col("label").alias(f"label_{c}"),
                                 F.col("vector").alias(f"vector_{c}"))
    links = materialised(
        pairs.join(of("a"), "a").join(of("b"), "b").filter("label_a = label_b")
        .filter(_similar(least)("vector_a", "vector_b")).select("a", "b"))
    sizes = classes.select("cid", "copies")
    both = links.union(links.select("b", "a")).toDF("cid", "other")
    linked = both.join(sizes.toDF("other", "others"), "other").groupBy("cid").agg(
        F.sum("others").alias("others"))
    member = components(links).toDF("cid", "component")
    found = (classes.join(linked, "cid", "left").join(member, "cid", "left")
             .withColumn("component", F.coalesce("component", "cid")))
    lowest = found.groupBy("component").agg(F.min("least").alias("component_id"))
    found = found.join(lowest, "component").select(
        "label", "key", "component_id",
        (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    out = sound.select("vec_id", "label", "key").join(found, ["label", "key"]).select(
        "vec_id", "n_links", "component_id").union(
        rows.filter("key IS NULL").select("vec_id", F.lit(0).cast("long"), "vec_id"))
    kept = F.when(F.col("vec_id").isNull(), False).otherwise(
        F.col("vec_id").eqNullSafe(F.col("component_id")))
    return out.withColumn("kept", kept)
