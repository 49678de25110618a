"""Combining single-row metric frames into one row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def metrics_row(*frames: DataFrame) -> DataFrame:
    """Put single-row frames of integer metrics side by side, in their column order.

    Each row is unpivoted to (metric, value), the pieces are unioned and pivoted back into
    one row, so no cross join is planned. Every frame must hold exactly one row and
    distinct column names; values are returned as BIGINT.
    """
    names = [c for f in frames for c in f.columns]
    if len(set(names)) != len(names):
        raise ValueError(f"duplicate metric names in {names}")
    longs = [f.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("long").alias("value"))
        for c in f.columns])).alias("kv")).select("kv.*") for f in frames]
    u = reduce(lambda a, b: a.unionByName(b), longs)
    return u.groupBy().pivot("metric", names).agg(F.first("value")).select(*names)


def unpruned(df: DataFrame) -> DataFrame:
    """``df`` for readers of different columns that should share what stands below: its rows are
    generated whole, so that no reader prunes the plan to columns of its own, which would keep
    their exchanges from being reused. For frames of few rows."""
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))
