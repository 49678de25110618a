"""Reshaping: wide measures to long rows and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unpivot_measures(df: DataFrame, ids, measures: dict[str, Column], *,
                     name: str = "measure", value: str = "value",
                     drop_nulls: bool = True) -> DataFrame:
    """(ids..., m1, m2, ...) -> (ids..., measure, value) with every value cast to double.

    SQL UNPIVOT drops NULL values; ``DataFrame.unpivot`` keeps them, so the filter is
    explicit here (``drop_nulls``).
    """
    ids = list(ids)
    wide = df.select(*ids, *[e.cast("double").alias(n) for n, e in measures.items()])
    long = wide.unpivot(ids, list(measures), name, value)
    return long.filter(F.col(value).isNotNull()) if drop_nulls else long


def melt_breakpoints(df: DataFrame, ids, breakpoints, *, name: str = "percentile",
                     value: str = "value") -> DataFrame:
    """p10..p99 columns -> (ids..., percentile int, value): the curve behind a chart."""
    ids = list(ids)
    pairs = F.array(*[F.struct(F.lit(int(round(p * 100))).alias(name),
                               F.col(col).cast("double").alias(value))
                      for col, p in breakpoints])
    return df.select(*ids, F.explode(pairs).alias("_bp")).select(*ids, f"_bp.{name}",
                                                                   f"_bp.{value}")
