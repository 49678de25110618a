"""Data profiles behind the design decisions, as keyed DataFrame operators.

All are aggregations with map-side partial aggregation; none collects a group. Means and
percentages of integer counts are rounded with the exact integer form (``rounded_ratio``)
so they do not depend on floating-point summation order. Whole-column percentiles go through
bracketed selection, those of groups through the size-checked split of ``group_percentiles``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peerscope.functions.columns import rounded_ratio, safe_divide
from peerscope.operators.bitmaps import distinct_count, set_counts
from peerscope.operators.brackets import ACCURACY, bracketed_percentiles
from peerscope.operators.combine import metrics_row
from peerscope.operators.percentiles import (PERCENTILE_ROWS, group_percentiles,
                                             weighted_percentiles)
from peerscope.operators.reshape import unpivot_measures

# ---------------------------------------------------------------- cardinality, nulls


def cardinality(df: DataFrame, columns: dict[str, str], *, identifiers=(), approx: bool = False,
                rsd: float = 0.01) -> DataFrame:
    """Several COUNT(DISTINCT) as one row (A4): alias -> column. Exact by default: every column
    is a scan of that column alone, which costs columnar files no more reading than one scan of
    all, and no row is expanded for another column's sake. Columns named in ``identifiers``
    hold NPIs and are counted as bits (``operators.bitmaps``). ``approx=True`` opts into
    HyperLogLog++ sketches with relative standard deviation ``rsd`` in a single scan."""
    if approx:
        return df.agg(*[F.approx_count_distinct(c, rsd).alias(a) for a, c in columns.items()])
    return metrics_row(*[
        distinct_count(df, c, a) if c in identifiers
        else df.select(c).distinct().agg(F.count(c).alias(a)) for a, c in columns.items()])


def null_profile(df: DataFrame, columns=None) -> DataFrame:
    """NULLs per column (A15): one aggregate over every column, then unpivoted to
    (column, rows, nulls)."""
    cols = list(columns or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("__rows"),
                  *[(F.count(F.lit(1)) - F.count(c)).alias(c) for c in cols])
    long = wide.unpivot(["__rows"], cols, "column", "nulls")
    return long.select("column", F.col("__rows").alias("rows"),
                       F.col("nulls").cast("long").alias("nulls"))


def suppression_report(raw_d: DataFrame) -> DataFrame:
    """Part D's blanked counts and suppression flags."""
    n = F.count(F.lit(1))
    null_benes = F.count_if(F.col("Tot_Benes").isNull())
    return raw_d.agg(
        n.alias("rows"),
        null_benes.alias("tot_benes_null"),
        rounded_ratio(null_benes * 100, n, 2).alias("tot_benes_null_pct"),
        F.count_if(F.col("GE65_Sprsn_Flag").isNotNull()).alias("ge65_suppressed"),
        F.count_if(F.col("GE65_Bene_Sprsn_Flag").isNotNull()).alias("ge65_bene_suppressed"),
        F.count_if(F.col("Tot_Clms").isNull()).alias("tot_clms_null"),
        F.count_if(F.col("Tot_Drug_Cst").isNull()).alias("tot_drug_cst_null"))


def part_b_nulls(raw_b: DataFrame) -> DataFrame:
    """Part B's null counts and non-US rows."""
    n = F.count(F.lit(1))
    return raw_b.agg(
        n.alias("rows"),
        (n - F.count("Tot_Benes")).alias("tot_benes_null"),
        (n - F.count("Tot_Srvcs")).alias("tot_srvcs_null"),
        (n - F.count("Avg_Mdcr_Stdzd_Amt")).alias("stdzd_amt_null"),
        (n - F.count("Rndrng_Prvdr_Type")).alias("specialty_null"),
        (n - F.count("Rndrng_Prvdr_State_Abrvtn")).alias("state_null"),
        (n - F.count("Rndrng_Prvdr_RUCA")).alias("ruca_null"),
        F.count_if(F.col("Rndrng_Prvdr_Cntry") != "US").alias("non_us_rows"))


def suppression_floor(df: DataFrame, measures: dict[str, str], threshold_col: str,
                      threshold: int = 11) -> DataFrame:
    """Minimum of each measure and rows below the publication threshold."""
    return df.agg(*[F.min(c).alias(a) for a, c in measures.items()],
                  F.count_if(F.col(threshold_col) < threshold)
                  .alias(f"rows_below_{threshold}"))


def low_end_histogram(df: DataFrame, col: str, upper: int = 20) -> DataFrame:
    """Row counts per value at the low end, to find the suppression cliff."""
    return (df.filter(F.col(col) <= upper).groupBy(col)
            .agg(F.count(F.lit(1)).alias("n_rows")).orderBy(col))


# ---------------------------------------------------------------- group shape


def _size_percentiles(df: DataFrame, size: str, probs, keys=("_all",)) -> DataFrame:
    """Exact percentiles of a per-group size column, from (size -> number of groups).

    The distinct sizes d of groups that partition N rows satisfy d(d+1)/2 <= N, so each
    buffer holds at most sqrt(2N) entries (1.4M at 10^12 rows): a proven bound, no probe
    job needed. ``keys`` label independent size distributions (default: one, ``_all``).
    """
    keys = list(keys)
    freq = df.groupBy(*keys, size).agg(F.count(F.lit(1)).alias("_f"))
    return weighted_percentiles(freq, keys, size, "_f", probs)


def _size_stats(sizes: DataFrame, label: str, min_peers: int) -> DataFrame:
    """Group-size profile per ``label`` from one row per group (``label``, ``n``).

    Everything is read off the (size -> number of groups) frequencies in one aggregation,
    so the group sizes are computed once; the exact percentiles weight each distinct size
    by its frequency (at most sqrt(2N) distinct sizes, see ``_size_percentiles``)."""
    freq = sizes.groupBy(label, "n").agg(F.count(F.lit(1)).alias("_f"))
    f, n = F.col("_f"), F.col("n")
    groups = F.sum(f)
    rows = F.sum(n * f)
    under_g = F.coalesce(F.sum(F.when(n < min_peers, f)), F.lit(0))
    under_r = F.coalesce(F.sum(F.when(n < min_peers, n * f)), F.lit(0))
    out = freq.groupBy(label).agg(
        groups.cast("long").alias("n_groups"),
        rows.cast("long").alias("n_rows"),
        rounded_ratio(rows, groups, 1).alias("mean_rows"),
        F.percentile(n, [0.5, 0.9, 0.99], f).alias("_q"),
        F.max("n").alias("max_rows"),
        under_g.cast("long").alias("groups_under_min"),
        under_r.cast("long").alias("rows_under_min"),
        rounded_ratio(under_g * 100, groups, 1).alias("pct_groups_under_min"),
        rounded_ratio(under_r * 100, rows, 2).alias("pct_rows_under_min"))
    return out.select(
        F.col(label).alias("peer_key"), "n_groups", "n_rows", "mean_rows",
        F.col("_q")[0].alias("p50"), F.col("_q")[1].alias("p90"), F.col("_q")[2].alias("p99"),
        "max_rows", "groups_under_min", "rows_under_min", "pct_groups_under_min",
        "pct_rows_under_min")


def group_size_profile(df: DataFrame, keys, min_peers: int = 30, label: str | None = None
                       ) -> DataFrame:
    """Aggregate of an aggregate (A9): how big are groups under ``keys``?"""
    lab = label or " + ".join(keys)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).withColumn("_label", F.lit(lab))
    return _size_stats(sizes, "_label", min_peers)


def peer_key_variants(df: DataFrame, variants, min_peers: int = 30) -> DataFrame:
    """A9 for several candidate keys, stacked (A10), from ONE scan: the group sizes of every
    candidate key come out of a single GROUPING SETS aggregation (partially aggregated
    map-side), and ``grouping_id`` tells the sets apart."""
    cols = []
    for keys, _ in variants:
        for k in keys:
            if k not in cols:
                cols.append(k)
    width = len(cols)

    def gid(keys):   # bit i (from the left) is 1 when column i is not in this set
        return sum(1 << (width - 1 - i) for i, c in enumerate(cols) if c not in keys)
    sets = [[F.col(c) for c in keys] for keys, _ in variants]
    sizes = df.groupingSets(sets, *cols).agg(F.count(F.lit(1)).alias("n"),
                                            F.grouping_id().alias("_gid"))
    label = None
    for keys, lab in variants:
        cond = F.col("_gid") == gid(keys)
        label = F.when(cond, F.lit(lab)) if label is None else label.when(cond, F.lit(lab))
    sizes = sizes.select(label.alias("_label"), "n")
    return _size_stats(sizes, "_label", min_peers)


# ---------------------------------------------------------------- distributions

DIST_POINTS = [("p50", 0.50), ("p90", 0.90), ("p99", 0.99), ("p999", 0.999)]


def measure_distribution(df: DataFrame, measures: dict[str, Column], *,
                         accuracy: int = ACCURACY) -> DataFrame:
    """Whole-table distribution per measure (A11): p50 p90 p99 p99.9 max mean mean/median,
    unrounded. Two scans for all measures (``operators.brackets``), nothing before the query
    runs; the first one also gives the sizes, maxima and means."""
    long = unpivot_measures(df, [], measures, drop_nulls=False)
    pct = bracketed_percentiles(
        long, ["measure"], F.col("value"), DIST_POINTS, accuracy=accuracy,
        group_bound=len(measures), extra={"max": F.max("_v"), "mean": F.avg("_v")})
    return pct.filter("n > 0").select(
        "measure", *[p for p, _ in DIST_POINTS], "max", "mean",
        safe_divide(F.col("mean"), F.col("p50")).alias("mean_over_median")).orderBy("measure")


def within_group_spread(df: DataFrame, keys, price: Column, volume: Column, *,
                        min_rows: int = 1000, top: int = 25,
                        hot_rows: int | None = PERCENTILE_ROWS) -> DataFrame:
    """p99/p50 of price and volume inside each large group, largest groups first (A12),
    unrounded. Sizes and percentiles come from one aggregation; a huge group is split, not
    buffered (``group_percentiles``)."""
    keys = list(keys)
    q = [("p50", 0.5), ("p99", 0.99)]
    g = group_percentiles(df, keys, {"pr": price, "vo": volume}, q, hot_rows=hot_rows,
                          rows="n_rows").filter(F.col("n_rows") >= min_rows)
    pr50, pr99, vo50, vo99 = (F.col("pr__p50"), F.col("pr__p99"), F.col("vo__p50"),
                              F.col("vo__p99"))
    return (g.select(*keys, "n_rows",
                     pr50.alias("price_p50"), pr99.alias("price_p99"),
                     safe_divide(pr99, pr50).alias("price_p99_over_p50"),
                     vo50.alias("volume_p50"), vo99.alias("volume_p99"),
                     safe_divide(vo99, vo50).alias("volume_p99_over_p50"))
            .orderBy(F.desc("n_rows"), *keys).limit(int(top)))


def key_spread_comparison(df: DataFrame, value: Column, variants, *, min_rows: int = 30,
                          hot_rows: int | None = PERCENTILE_ROWS) -> DataFrame:
    """Within-group spread of ``value`` under alternative keys (A13): per key definition,
    the groups of at least ``min_rows`` rows and the distribution of their p99/p50."""
    parts = []
    for keys, label in variants:
        keys = list(keys)
        g = group_percentiles(df, keys, {"x": value}, [("p50", 0.5), ("p99", 0.99)],
                              hot_rows=hot_rows, rows="n").filter(F.col("n") >= min_rows)
        parts.append(g.select(F.lit(label).alias("key_def"), "n",
                              F.col("x__p50").alias("p50"), F.col("x__p99").alias("p99")))
    u = reduce(lambda a, b: a.unionByName(b), parts)
    u = u.withColumn("ratio", safe_divide(F.col("p99"), F.col("p50")))
    # reported over groups with a positive median only, like the count of groups
    u = u.filter(F.col("p50").isNotNull() & (F.col("p50") > 0))
    basic = u.groupBy("key_def").agg(F.count(F.lit(1)).alias("n_groups"),
                                     F.sum("n").cast("long").alias("n_rows_covered"),
                                     F.max("ratio").alias("_mx"))
    q = group_percentiles(u, ["key_def"], {"r": F.col("ratio")}, [("p50", 0.5), ("p90", 0.9)],
                          hot_rows=hot_rows)
    return (basic.join(q, "key_def")
            .select("key_def", "n_groups", "n_rows_covered",
                    F.col("r__p50").alias("median_p99_over_p50"),
                    F.col("r__p90").alias("p90_p99_over_p50"),
                    F.col("_mx").alias("max_p99_over_p50"))
            .orderBy("key_def"))


def fanout_profile(df: DataFrame, parent: str, child: str) -> DataFrame:
    """How many distinct ``child`` values per ``parent`` (A14), e.g. brands per generic."""
    g = (df.select(parent, child).distinct().groupBy(parent)
         .agg(F.count(F.lit(1)).alias("k")).withColumn("_all", F.lit(0)))
    n = F.count(F.lit(1))
    basic = g.groupBy("_all").agg(n.alias("parents"),
                                  F.count_if(F.col("k") == 1).alias("with_one"),
                                  rounded_ratio(F.sum("k"), n, 2).alias("mean_children"),
                                  F.max("k").alias("max_children"))
    q = _size_percentiles(g, "k", [("p50_children", 0.5), ("p90_children", 0.9)])
    return basic.join(q, "_all").select(
        "parents", "with_one", "mean_children", "p50_children", "p90_children", "max_children")


# ---------------------------------------------------------------- providers across files


def _npis(raw_b: DataFrame, raw_d: DataFrame):
    b = raw_b.select(F.col("Rndrng_NPI").alias("npi"))
    d = raw_d.select(F.col("Prscrbr_NPI").alias("npi"))
    return b, d


def provider_set_overlap(raw_b: DataFrame, raw_d: DataFrame) -> DataFrame:
    """Distinct NPIs per file, in both, and in one file only, counted (U2, U3), as bits: the two
    files' sets meet bucket by bucket (``operators.bitmaps``), one scan of each file's NPIs."""
    found = set_counts({"part_b": (raw_b, "Rndrng_NPI"), "part_d": (raw_d, "Prscrbr_NPI")})
    return found.select(F.col("part_b").alias("part_b_providers"),
                        F.col("part_d").alias("part_d_prescribers"),
                        F.col("both").alias("in_both"), "part_b_only", "part_d_only")


def providers_in_both(raw_b: DataFrame, raw_d: DataFrame) -> DataFrame:
    """INTERSECT of the two files' NPI sets."""
    b, d = _npis(raw_b, raw_d)
    return b.intersect(d)


def providers_only_in(raw_b: DataFrame, raw_d: DataFrame, side: str = "part_b") -> DataFrame:
    """EXCEPT (distinct) of one file's NPI set minus the other's."""
    b, d = _npis(raw_b, raw_d)
    return b.subtract(d) if side == "part_b" else d.subtract(b)


def provider_overlap(raw_b: DataFrame, raw_d: DataFrame) -> DataFrame:
    """NPIs present in both files, with each side's specialty."""
    b = raw_b.select(F.col("Rndrng_NPI").alias("npi"),
                     F.col("Rndrng_Prvdr_Type").alias("specialty_b")).distinct()
    d = raw_d.select(F.col("Prscrbr_NPI").alias("npi"),
                     F.col("Prscrbr_Type").alias("specialty_d")).distinct()
    return b.join(d, "npi")


def multi_specialty(raw_b: DataFrame, raw_d: DataFrame) -> DataFrame:
    """Providers carrying more than one specialty inside a file, per file."""
    def side(df, npi, spec, name):
        g = df.groupBy(npi).agg(F.count_distinct(spec).alias("k"))
        return g.agg(F.count(F.lit(1)).alias("providers"),
                     F.count_if(F.col("k") > 1).alias("with_multiple_specialties"),
                     F.max("k").alias("max_specialties")
                     ).select(F.lit(name).alias("dataset"), "*")
    return side(raw_b, "Rndrng_NPI", "Rndrng_Prvdr_Type", "part_b").unionByName(
        side(raw_d, "Prscrbr_NPI", "Prscrbr_Type", "part_d"))


def specialty_agreement(raw_b: DataFrame, raw_d: DataFrame) -> DataFrame:
    """Exact agreement of specialty strings across files for shared NPIs."""
    pairs = provider_overlap(raw_b, raw_d)
    n = F.count(F.lit(1))
    match = F.count_if(F.col("specialty_b") == F.col("specialty_d"))
    return pairs.agg(n.alias("npi_specialty_pairs"), match.alias("exact_string_match"),
                     rounded_ratio(match * 100, n, 1).alias("pct_match"))


def specialty_mismatches(raw_b: DataFrame, raw_d: DataFrame, top: int = 30) -> DataFrame:
    """Most common cross-file specialty disagreements (J6): the draft crosswalk."""
    pairs = provider_overlap(raw_b, raw_d).filter(F.col("specialty_b") != F.col("specialty_d"))
    return (pairs.groupBy("specialty_b", "specialty_d")
            .agg(F.count(F.lit(1)).alias("n_providers"))
            .orderBy(F.desc("n_providers"), "specialty_b", "specialty_d").limit(int(top)))


def entity_split(raw_b: DataFrame, raw_d: DataFrame) -> DataFrame:
    """Part-B-only NPIs split by entity type (J5): left join + null probe, per group."""
    pairs = raw_b.select("Rndrng_NPI", "Rndrng_Prvdr_Ent_Cd").distinct()
    b = pairs.groupBy(F.col("Rndrng_NPI").alias("npi")).agg(
        F.min("Rndrng_Prvdr_Ent_Cd").alias("entity"),
        F.count("Rndrng_Prvdr_Ent_Cd").alias("n_entity_codes"))
    d = raw_d.select(F.col("Prscrbr_NPI").alias("npi_d")).distinct()
    j = b.join(d, b["npi"] == d["npi_d"], "left")
    n = F.count(F.lit(1))
    only = F.count_if(F.col("npi_d").isNull())
    return (j.groupBy("entity")
            .agg(n.alias("part_b_providers"), only.alias("part_b_only"),
                 rounded_ratio(only * 100, n, 1).alias("pct_not_in_part_d"),
                 F.max("n_entity_codes").alias("max_entity_codes_per_npi"))
            .orderBy("entity"))


def provider_attribute_counts(raw: DataFrame, npi: str, attrs: dict[str, str]) -> DataFrame:
    """COUNT(DISTINCT attribute) per provider (A3)."""
    return raw.groupBy(F.col(npi).alias("npi")).agg(
        *[F.count_distinct(c).alias(a) for a, c in attrs.items()])


def key_profile(df: DataFrame, key: str, ordinal: str, *, width: int = 1 << 16) -> DataFrame:
    """min, max, distinct and sortedness of an integer ``key`` in ``ordinal`` order.

    Sortedness is the number of adjacent pairs where the key decreases, adjacent in the order
    of the ordinal, whatever gaps it has. Rows are cut into ranges of ``width`` ordinals;
    descents inside a range are counted there, and each range goes on as one row with its
    first and last key, three times over, so no window holds more than ``width`` ordinals
    (and, at last, the 2^16 ranges that 64-bit ordinals can still span).
    """
    cur = df.select(F.col(ordinal).cast("long").alias("o"), F.col(key).alias("first"),
                    F.col(key).alias("last"))
    steps = cur.select("o", "first", "last", F.lit(0).cast("long").alias("down"))
    for level in range(4):
        steps = steps.withColumn("r", F.floor(F.col("o") / F.lit(width)) if level < 3
                                 else F.lit(0).cast("long"))
        order = Window.partitionBy("r").orderBy("o", "first")
        steps = steps.withColumn("down", F.col("down") + F.coalesce(
            (F.lag("last").over(order) > F.col("first")).cast("long"), F.lit(0)))
        at = F.struct("o", "first")
        steps = steps.groupBy("r").agg(
            F.min_by("first", at).alias("first"), F.max_by("last", at).alias("last"),
            F.sum("down").alias("down")).withColumnRenamed("r", "o")
    basic = cur.agg(F.count(F.lit(1)).alias("rows"), F.min("first").alias("min_key"),
                    F.max("first").alias("max_key"),
                    F.count_distinct("first").alias("distinct_keys"))
    down = steps.agg(F.coalesce(F.sum("down"), F.lit(0)).alias("descending_steps"))
    out = metrics_row(basic, down)
    return out.withColumn("is_sorted", F.col("descending_steps") == 0)
