"""Adding up arrays of fixed size that tasks have gathered.

Every task keeps one array for a table (a size that does not depend on the data), cuts it
into blocks and emits these; blocks are added in two levels, streaming, so neither a task
nor the driver ever holds more than the table's own size.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "name string, block int, value binary"
ARROW = pa.schema([("name", pa.string()), ("block", pa.int32()), ("value", pa.binary())])
BLOCK = 1 << 14
#: First level: so many groups of tasks add up their blocks before the groups are added.
GROUPS = 8


def blocks_of(name: str, array: np.ndarray) -> pa.RecordBatch:
    """The non-zero blocks of a float64 array."""
    flat = np.ascontiguousarray(array, np.float64).ravel()
    rows = [(i, flat[s:s + BLOCK]) for i, s in enumerate(range(0, len(flat), BLOCK))]
    rows = [(i, x) for i, x in rows if x.any()]
    return pa.record_batch([
        pa.array([name] * len(rows), pa.string()), pa.array([i for i, _ in rows], pa.int32()),
        pa.array([zlib.compress(x.tobytes(), 1) for _, x in rows], pa.binary())], schema=ARROW)


def _read(value: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(value), np.float64)


def _add(batches):
    held: dict[tuple[str, int], np.ndarray] = {}
    for batch in batches:
        for name, block, value in zip(batch["name"].to_pylist(), batch["block"].to_pylist(),
                                      batch["value"]):
            x, key = _read(value.as_py()), (name, block)
            held[key] = held[key] + x if key in held else x
    for (name, block), x in held.items():
        yield pa.record_batch([pa.array([name], pa.string()), pa.array([block], pa.int32()),
                               pa.array([zlib.compress(x.tobytes(), 1)], pa.binary())],
                              schema=ARROW)


def summed(parts: DataFrame) -> DataFrame:
    """Blocks of many tasks -> one block for each (name, block)."""
    n = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = (parts.withColumn("g", F.spark_partition_id() % GROUPS)
             .repartition(n, "name", "block", "g").drop("g").mapInArrow(_add, SCHEMA))
    return first.repartition(n, "name", "block").mapInArrow(_add, SCHEMA)


def collected(parts: DataFrame, sizes: dict[str, int] | None = None,
              size: int | None = None) -> dict[str, np.ndarray]:
    """The summed tables as arrays on the driver, which must be of bounded size: ``sizes``
    by name, or ``size`` for every name that occurs."""
    rows = summed(parts).collect()
    names = sorted(sizes) if sizes is not None else sorted({r.name for r in rows})
    out = {n: np.zeros(sizes[n] if sizes is not None else size) for n in names}
    for r in rows:
        x = _read(bytes(r.value))
        out[r.name][r.block * BLOCK:r.block * BLOCK + len(x)] = x
    return out
