"""Exact percentiles of very large groups by bracketed selection.

Two scans, whatever the number of groups' rows, and no job while the plan is built:

1. one aggregate counts each group's rows by *cell*: a cell holds the values between two powers
   of two, cut into steps of equal ratio, so its number is a rising function of the value that
   needs nothing known of the group. A group leaves some hundred counts, added up before the
   shuffle, and their running sum gives every wanted position its *bracket*: the one cell that
   holds it, with the exact number of rows before it;
2. a second scan keeps only the rows inside brackets, as counts by value, also added up before the
   shuffle, and the positions are read off the running count inside each bracket.

Counts are exact in both scans, so every position lies in its bracket. A bracket is sorted by one
task: how much of a group that is, its values decide (all of it where they differ by less than a
cell's ratio and are not equal; the sort spills).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peerscope.operators.combine import unpruned
from peerscope.operators.joins import broadcast_if_small, join_null_safe

#: What a caller may raise for narrower brackets: a cell's values are within a factor of
#: 2 ** (ACCURACY_STEP / accuracy) of each other.
ACCURACY, ACCURACY_STEP = 10_000, 625
#: Beyond the exponents of all doubles, the smallest ones included.
EXPONENTS = 1100


def position(p: float, n: Column) -> Column:
    """Position of quantile ``p`` among ``n`` values, counted from 0."""
    return F.lit(p) * (n - 1)


def interpolated(p: float, n: Column, low: Column, high: Column) -> Column:
    """Between the values at floor and ceiling of the position, with the weights that Spark's
    own ``percentile`` uses."""
    pos = position(p, n)
    return F.when(low == high, low).otherwise(
        (F.floor(pos) + 1 - pos) * low + (pos - F.floor(pos)) * high)


def cell(value: Column, accuracy: int = ACCURACY) -> Column:
    """Number of the cell of a double, null for null: never less for a greater value (the logarithm
    is semi-monotonic), NaN beyond all others."""
    steps = max(1, accuracy // ACCURACY_STEP)
    beyond, infinite = EXPONENTS * steps, F.lit(float("inf"))
    size = lambda x: (F.floor(F.log2(x) * F.lit(float(steps))) + beyond).cast("int")
    return F.when(value >= infinite, 2 * beyond).when(value == -infinite, -2 * beyond) \
        .when(value > 0, size(value)).when(value < 0, -size(-value)).when(value == 0, 0)


def bracketed_percentiles(df: DataFrame, keys, value: Column, probs, *,
                          group_bound: int | None = None, accuracy: int = ACCURACY,
                          extra: dict[str, Column] | None = None) -> DataFrame:
    """``keys, n (non-null values), <extra>..., <name>...`` for each (name, p) of ``probs``:
    exact interpolated percentiles, null for a group without values.

    ``extra`` are aggregates over the rows of a group, taken in the first scan, with the value
    as column ``_v``. ``group_bound``, a proven upper bound of the number of groups, decides
    whether the brackets are broadcast.
    """
    keys, extra = list(keys), extra or {}
    rows = df.select(*keys, value.cast("double").alias("_v"))
    placed = rows.withColumn("_cell", cell(F.col("_v"), accuracy))
    by_cell = [F.col(c) for c in (*keys, "_cell")]
    cells = placed.groupingSets([by_cell, by_cell[:-1]], *by_cell) if extra \
        else placed.groupBy(*by_cell)
    cells = unpruned(cells.agg(  # read twice below, from one scan
        F.count("_v").alias("_c"), (F.grouping_id() if extra else F.lit(0)).alias("_total"),
        *[c.alias(name) for name, c in extra.items()]))
    totals = cells.filter("_total = 1").select(*keys, F.col("_c").alias("n"), *extra) if extra \
        else cells.groupBy(*keys).agg(F.sum("_c").alias("n"))
    group = Window.partitionBy(*keys)
    upto = (Window.unboundedPreceding, Window.currentRow)
    ordered = group.orderBy(F.col("_cell").asc_nulls_first())
    sums = cells.filter("_total = 0").withColumns({
        "_cum": F.sum("_c").over(ordered.rowsBetween(*upto)),
        "_n": F.sum("_c").over(ordered.rowsBetween(upto[0], Window.unboundedFollowing))})

    def holds(spot):
        """Whether a row, which stands for ``_c`` values up to ``_cum``, has the one at ``spot``."""
        return (F.col("_cum") > spot) & (F.col("_cum") - F.col("_c") <= spot)

    spots = {name: [f(position(p, F.col("_n"))) for f in (F.floor, F.ceil)] for name, p in probs}
    brackets = sums.filter(reduce(lambda a, b: a | b, [
        holds(spot) for pair in spots.values() for spot in pair])).select(
        *keys, "_cell", (F.col("_cum") - F.col("_c")).alias("_before"), "_n")
    bound = None if group_bound is None else group_bound * 2 * len(probs)
    brackets = broadcast_if_small(brackets, bound, row_bytes=96)
    inside = join_null_safe(placed.filter(F.col("_cell").isNotNull()), brackets,
                            [*keys, "_cell"])
    bracket = [*keys, "_cell", "_before", "_n"]
    counted = inside.groupBy(*bracket, "_v").agg(F.count(F.lit(1)).alias("_c"))
    counted = counted.withColumn("_cum", F.col("_before") + F.sum("_c").over(
        Window.partitionBy(*bracket).orderBy("_v").rowsBetween(*upto)))
    found = counted.groupBy(*keys).agg(*[
        F.max(F.when(holds(spot), F.col("_v"))).alias(f"{end}_{name}")
        for name, pair in spots.items() for end, spot in zip(("_lo", "_hi"), pair)])
    out = join_null_safe(totals, found, keys, "left")
    return out.select(*keys, "n", *extra, *[
        interpolated(p, F.col("n"), F.col(f"_lo_{name}"), F.col(f"_hi_{name}")).alias(name)
        for name, p in probs])
