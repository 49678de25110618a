"""Join helpers: null-safe equi-joins and size-checked broadcasts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest number of rows we broadcast when a side has no structural size bound of its own.
BROADCAST_ROW_LIMIT = 2_000_000


def join_null_safe(left: DataFrame, right: DataFrame, keys, how: str = "inner",
                   broadcast_right: bool = False) -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL (``<=>``), keeping one copy of the keys.

    Spark plans ``<=>`` as an ordinary equi-join key, so this is still a hash/sort-merge
    join, not a nested loop.
    """
    keys = list(keys)
    renamed = right
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"__r_{k}")
    if broadcast_right:
        renamed = F.broadcast(renamed)
    cond = reduce(lambda a, b: a & b,
                  [left[k].eqNullSafe(renamed[f"__r_{k}"]) for k in keys])
    out = left.join(renamed, cond, how)
    if how in ("left_semi", "left_anti", "semi", "anti"):
        return out
    if how in ("full", "full_outer", "outer", "right", "right_outer"):
        for k in keys:
            out = out.withColumn(k, F.coalesce(left[k], F.col(f"__r_{k}")))
    return out.drop(*[f"__r_{k}" for k in keys])


#: A key's rows are cut into pieces of at most one part in PIECES of a task's mean share.
PIECES = 8


def replication(rows: DataFrame, keys, tasks: int | None = None) -> tuple[DataFrame, int]:
    """(``keys``, factor) of the keys with more rows than a piece, and a bound of how many such
    keys there are: ``PIECES * tasks``, since each holds more than that part of all rows. The
    counts, and the total that they are measured against, are taken when the query runs."""
    tasks = tasks or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    piece = rows.agg(F.ceil(F.count(F.lit(1)) / F.lit(PIECES * tasks)).alias("_p")).scalar()
    factor = F.ceil(F.col("_n") / F.greatest(piece, F.lit(1))).cast("int")
    return (sizes.select(*keys, factor.alias("_factor")).filter("_factor > 1"),
            PIECES * tasks)


def join_salted(rows: DataFrame, groups: DataFrame, keys, spread, how: str = "inner",
                tasks: int | None = None) -> DataFrame:
    """Null-safe join of many rows to one row per group, however the rows are dealt to groups:
    a group's row is repeated as often as the group's rows are more than a piece of a task's
    share (``replication``), and these rows are dealt over its copies by a hash of ``spread``.
    Groups of ordinary size are not repeated. ``how`` is ``inner`` or ``left``."""
    keys = list(keys)
    hot, bound = replication(rows, keys, tasks)
    hot = broadcast_if_small(hot, bound)
    factor = F.coalesce("_factor", F.lit(1))
    left = join_null_safe(rows, hot, keys, "left").withColumn(
        "__salt", F.pmod(F.xxhash64(spread), factor).cast("int")).drop("_factor")
    right = join_null_safe(groups, hot, keys, "left").withColumn(
        "__salt", F.explode(F.sequence(F.lit(0), factor - 1))).drop("_factor")
    return join_null_safe(left, right, [*keys, "__salt"], how).drop("__salt")


# Largest estimated size we broadcast (rows x bytes per row).
BROADCAST_BYTE_LIMIT = 256 * 1024 * 1024


def can_broadcast(bound_rows: int | None, row_bytes: int = 64,
                  limit: int = BROADCAST_ROW_LIMIT) -> bool:
    """True when a side with at most ``bound_rows`` rows of about ``row_bytes`` bytes is
    proven small enough to broadcast."""
    return (bound_rows is not None and bound_rows <= limit
            and bound_rows * row_bytes <= BROADCAST_BYTE_LIMIT)


def broadcast_if_small(df: DataFrame, bound_rows: int | None, limit: int = BROADCAST_ROW_LIMIT,
                       row_bytes: int = 64):
    """Broadcast ``df`` only when its size is *proven* below the limits.

    ``bound_rows`` is a structural upper bound computed by the caller (e.g. number of hot
    groups <= total rows / hot threshold) and ``row_bytes`` an upper estimate of one row.
    Without a bound, or above the limits, the frame is returned as is and the planner
    chooses a shuffle join (AQE may still broadcast at runtime if the measured size is
    small, and splits skewed partitions of a sort-merge join).
    """
    if can_broadcast(bound_rows, row_bytes, limit):
        return F.broadcast(df)
    return df
