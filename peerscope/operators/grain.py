"""Grain and group-shape audits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def grain_check(df: DataFrame, keys) -> DataFrame:
    """Keys seen more than once and the rows in them — one row
    ``(duplicate_keys, rows_in_duplicate_keys)``; both 0 when ``keys`` is unique."""
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return dup.agg(F.count(F.lit(1)).alias("duplicate_keys"),
                   F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("rows_in_duplicate_keys"))


def unscoreable_rows(df: DataFrame, keys, min_peers: int) -> DataFrame:
    """Rows that fall in groups of fewer than ``min_peers`` rows under ``keys``."""
    small = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
               .filter(F.col("n") < min_peers))
    return small.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("unscoreable_rows"))


def ends_of_distinct(df: DataFrame, key: str, out_key: str, ends) -> DataFrame:
    """One row per ``key`` with the aggregates ``ends`` (Columns of string minimums and
    maximums) over the distinct rows of ``df``.

    String minimums have no fixed-width buffer, so Spark sorts for them. The distinct rows are
    taken first with a hash aggregate, which leaves about one row per key to sort; the count
    keeps the optimizer from dropping that step as redundant.
    """
    found = df.distinct().groupBy(F.col(key).alias(out_key)).agg(
        *ends, F.count(F.lit(1)).alias("_rows"))
    return found.filter("_rows > 0").drop("_rows")
