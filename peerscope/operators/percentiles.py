"""Exact interpolated percentiles per group (``quantile_cont`` semantics), by group size.

* Groups of up to ``MAP_ROWS`` rows: Spark's exact ``percentile`` aggregate, whose buffer holds
  every distinct value of a group.
* Larger ones go through bracketed selection (``operators.brackets``), as does the whole-table
  form, where the one group *is* the table: two scans, added up before the shuffle, so neither a
  buffer nor a task grows with a group's rows.
* Where no sizes are probed (``hot_rows=None``), all are read off sorted runs: one Exchange on
  the group, one sort and running row number per measure, and of all rows only those at a wanted
  position are kept (two for each quantile). The sort spills, so a group needs constant memory
  however many values it has.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peerscope.operators.brackets import (ACCURACY, bracketed_percentiles, interpolated,
                                          position)
from peerscope.operators.joins import can_broadcast, join_null_safe
from peerscope.operators.rank import DEFAULT_HOT_ROWS, group_sizes
from peerscope.session import ensure_checkpoint_dir


#: Rows of the largest group whose values an aggregation buffer holds (up to 128 groups and
#: all measures are held at a time), and a bound above which a group is large in any case.
MAP_ROWS, PERCENTILE_ROWS = 10_000, DEFAULT_HOT_ROWS


def _mapped_percentiles(df: DataFrame, keys, values: dict, probs,
                        rows: str | None = None) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias(rows)] if rows else []
    for name, expr in values.items():
        aggs += [F.count(expr).alias(f"{name}__n_rows"),
                 F.percentile(expr, [p for _, p in probs]).alias(f"{name}__arr")]
    out = [F.col(k) for k in keys] + ([F.col(rows)] if rows else [])
    for name in values:
        out += [F.col(f"{name}__n_rows"), *[F.get(f"{name}__arr", F.lit(i)).alias(
            f"{name}__{pname}") for i, (pname, _) in enumerate(probs)]]
    return df.groupBy(*keys).agg(*aggs).select(*out)


def _sorted_percentiles(df: DataFrame, keys, values: dict, probs,
                        rows: str | None = None) -> DataFrame:
    """All windows of a group share one Exchange; the last aggregation needs none."""
    group = Window.partitionBy(*keys)
    whole = (Window.unboundedPreceding, Window.unboundedFollowing)
    cols = {f"__v{i}": e.cast("double") for i, e in enumerate(values.values())}
    out = df.select(*keys, *[e.alias(c) for c, e in cols.items()])
    runs = []
    for i, c in enumerate(cols):
        order = group.orderBy(F.col(c).asc_nulls_last())
        runs += [(F.row_number().over(order) - 1).cast("long").alias(f"__r{i}"),
                 F.count(c).over(order.rowsBetween(*whole)).alias(f"__n{i}")]
        if i == 0:
            runs.append(F.count(F.lit(1)).over(order.rowsBetween(*whole)).alias("__rows"))
    out = out.select("*", *runs)
    quantiles = F.array(*[F.lit(p) for _, p in probs])

    def wanted(i):
        r, n = F.col(f"__r{i}"), F.col(f"__n{i}")
        return F.exists(quantiles, lambda p: (r == F.floor(p * (n - 1)))
                        | (r == F.ceil(p * (n - 1))))

    few = out.filter(reduce(lambda a, b: a | b, [wanted(i) for i in range(len(cols))],
                            F.col("__r0") == 0))
    found = few.groupBy(*keys).agg(
        F.max("__rows").alias(rows or "__rows"),
        *[F.max(f"__n{i}").alias(f"{name}__n_rows") for i, name in enumerate(values)],
        *[F.map_from_entries(F.collect_list(F.when(wanted(i), F.struct(f"__r{i}", f"__v{i}"))))
          .alias(f"__at{i}") for i in range(len(cols))])
    picked = [F.col(k) for k in keys] + ([F.col(rows)] if rows else [])
    for i, name in enumerate(values):
        n, at = F.col(f"{name}__n_rows"), F.col(f"__at{i}")
        picked += [n, *[interpolated(p, n, F.element_at(at, F.floor(position(p, n))),
                                     F.element_at(at, F.ceil(position(p, n))))
                        .alias(f"{name}__{pname}") for pname, p in probs]]
    return found.select(*picked)


def _bracketed(df: DataFrame, keys, values: dict, probs, rows: str | None, large: DataFrame,
               bound: int, accuracy: int) -> DataFrame:
    """One selection for all measures: the rows of the ``large`` groups become narrow (group and
    measure, value) rows, a group being its number ``_id``."""
    k, few = len(values), can_broadcast(bound, row_bytes=128)
    met = join_null_safe(df.select(*keys, F.array(*[e.cast("double") for e in values.values()])
                                   .alias("_all")), large.drop("_n"), keys, broadcast_right=few)
    long = met.select("_id", F.posexplode("_all").alias("_m", "_x")).select(
        (F.col("_id") * k + F.col("_m")).alias("_g"), "_x")
    pc = bracketed_percentiles(long, ["_g"], F.col("_x"), probs, accuracy=accuracy,
                               group_bound=bound * k)
    pick = lambda i, col: F.max(F.when(F.pmod("_g", F.lit(k)) == i, F.col(col)))
    wide = pc.groupBy(F.call_function("div", "_g", F.lit(k)).alias("_of")).agg(*[
        pick(i, col).alias(f"{name}__{'n_rows' if col == 'n' else col}")
        for i, name in enumerate(values) for col in ("n", *[p for p, _ in probs])])
    out = large.join(F.broadcast(wide) if few else wide, F.col("_id") == F.col("_of"))
    return out.select(*keys, *([F.col("_n").alias(rows)] if rows else []),
                      *[c for c in wide.columns if c != "_of"])


def large_groups(df: DataFrame, keys, hot_rows: int, map_rows: int = MAP_ROWS):
    """(groups above ``map_rows`` or ``hot_rows`` rows with their size ``_n`` and a number
    ``_id``, how many they are): one aggregate, kept in the checkpoint folder, of which the
    driver sees one number."""
    ensure_checkpoint_dir(df.sparkSession)
    sizes = group_sizes(df, keys).filter(F.col("_n") > min(map_rows, hot_rows)).withColumn(
        "_id", F.monotonically_increasing_id()).checkpoint(eager=True)
    return sizes, sizes.count()


def group_percentiles(df: DataFrame, keys, values: dict[str, Column], probs, *,
                      hot_rows: int | None = PERCENTILE_ROWS, map_rows: int = MAP_ROWS,
                      accuracy: int = ACCURACY, large=None, rows: str | None = None
                      ) -> DataFrame:
    """Wide result: keys, with ``rows`` a column of that name for count(*), then per value
    name ``<name>__n_rows`` (non-null count) and ``<name>__<p>`` for each (p, prob) in
    ``probs``.

    ``large`` is a ``large_groups`` result, where the caller has it; else the sizes are probed
    first. ``hot_rows=None`` probes nothing and reads all groups off sorted runs.
    """
    keys = list(keys)
    if hot_rows is None:
        return _sorted_percentiles(df, keys, values, probs, rows)
    sizes, n = large or large_groups(df, keys, hot_rows, map_rows)
    if n == 0:
        return _mapped_percentiles(df, keys, values, probs, rows)
    rest = join_null_safe(df, sizes, keys, "left_anti",
                          broadcast_right=can_broadcast(n, row_bytes=128))
    return _mapped_percentiles(rest, keys, values, probs, rows).unionByName(
        _bracketed(df, keys, values, probs, rows, sizes, n, accuracy))


def global_percentiles(df: DataFrame, value: Column, probs, *,
                       accuracy: int = ACCURACY) -> DataFrame:
    """Exact percentiles of a whole column, never collecting it into one buffer."""
    keyed = df.select(F.lit(0).alias("_all"), value.alias("_x"))
    return bracketed_percentiles(keyed, ["_all"], F.col("_x"), probs, group_bound=1,
                                 accuracy=accuracy).drop("_all")


def weighted_percentiles(counts: DataFrame, keys, value: str, freq: str, probs) -> DataFrame:
    """Exact percentiles from pre-aggregated (value, frequency) rows: the buffer holds one
    entry per distinct value, not per row."""
    ps = [p for _, p in probs]
    arr = F.percentile(F.col(value), ps, F.col(freq)).alias("_arr")
    g = counts.groupBy(*keys).agg(arr) if keys else counts.agg(arr)
    return g.select(*keys, *[F.col("_arr")[i].alias(name) for i, (name, _) in enumerate(probs)])
