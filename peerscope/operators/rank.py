"""peer_rank — empirical-CDF rank of each row inside its peer group.

rank = cume_dist() OVER (PARTITION BY peer ORDER BY measure)  (ties share the upper rank,
NULL measures sort last), rounded half-up to ``decimals`` places, and NULL for every row of
a group with fewer than ``min_peers`` rows (rows, not distinct providers).

Two physical strategies give identical results:

* window (default): one Exchange on the peer key, then one Sort + Window per measure. A
  group is one window partition, which is fine while groups are bounded.
* prefix sums (``operators.prefix``): for groups above ``hot_rows`` rows. They are dealt by
  ranges of (group, value), and each range carries on the counts of those before it.

``hot_rows=None`` skips the size probe and always uses the window form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peerscope.functions.columns import rounded_ratio
from peerscope.operators.joins import broadcast_if_small, can_broadcast, join_null_safe
from peerscope.operators.prefix import running_counts
from peerscope.session import ensure_checkpoint_dir

# A window task sorting this many rows is still comfortable; bigger groups are split.
DEFAULT_HOT_ROWS = 5_000_000
# Rows of hot groups that a task of the split form sorts, about.
SPLIT_ROWS = 500_000


def group_sizes(df: DataFrame, peer) -> DataFrame:
    """count(*) per peer group (partially aggregated before the shuffle)."""
    return df.groupBy(*peer).agg(F.count(F.lit(1)).alias("_n"))


def find_hot(df: DataFrame, peer, hot_rows: int | None):
    """(hot groups with their size ``_n``, number of hot groups) — one aggregate job whose
    only driver-side result is the count."""
    if hot_rows is None:
        return None, 0
    hot = group_sizes(df, list(peer)).filter(F.col("_n") > hot_rows)
    return hot, hot.count()


def split_hot(df: DataFrame, peer, hot_rows: int | None, hot=None):
    """Split ``df`` into (cold rows, hot rows with ``_n``, number of hot groups).

    ``hot`` may carry a precomputed ``find_hot`` result for the same groups (the build
    probes once per dataset and reuses it for ranks and the serving table). The hot-group
    list is broadcast only when its size is proven small (at most total_rows / hot_rows
    rows).
    """
    peer = list(peer)
    hot_df, n_hot = hot if hot is not None else find_hot(df, peer, hot_rows)
    if hot_df is None or n_hot == 0:
        return df, None, 0
    small = can_broadcast(n_hot, row_bytes=128)
    cold = join_null_safe(df, hot_df.select(*peer), peer, "left_anti", broadcast_right=small)
    warm = join_null_safe(df, hot_df.select(*peer, "_n"), peer, "inner", broadcast_right=small)
    return cold, warm, n_hot


def _window_rank(df: DataFrame, peer, measures: dict, min_peers: int, decimals: int,
                 range_partitions: int | None = None, range_keys=None) -> DataFrame:
    """One Exchange on the peer key, then one Sort + Window per measure. The group size is
    a whole-frame count evaluated in the first measure's Window node (same ordering, so no
    extra sort), and each cumulative count is materialised once before it is rounded."""
    w = Window.partitionBy(*peer)
    items = list(measures.items())
    # Range partitioning on exactly the peer key satisfies the windows' clustering, so it
    # replaces their hash exchange and leaves key-ordered partitions for a sorted write.
    out = (df.repartitionByRange(range_partitions, *(range_keys or peer))
           if range_partitions else df)
    # all window expressions in one projection: Spark then evaluates those sharing a
    # (partition, order) spec in one Window node
    wins = []
    for i, (name, expr) in enumerate(items):
        ordered = w.orderBy(expr.asc_nulls_last())
        if i == 0:
            wins.append(F.count(F.lit(1)).over(
                ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
                .alias("_n"))
        wins.append(F.count(F.lit(1)).over(ordered).alias(f"_k{i}"))
    out = out.select("*", *wins)
    ranks = [F.when(F.col("_n") >= min_peers,
                    rounded_ratio(F.col(f"_k{i}"), F.col("_n"), decimals)).alias(name)
             for i, (name, _) in enumerate(items)]
    return out.select(*[c for c in df.columns], *ranks)


def _split_rank(warm: DataFrame, peer, measures: dict, min_peers: int, decimals: int,
                n_hot: int) -> DataFrame:
    """Ranks of hot-group rows from running counts over range partitions. The rows get a number
    and their group's size; narrow (group and measure, value, row) rows are dealt by value, and
    the counts come back to the rows by their number, which is even however skewed the values
    are."""
    spark, k = warm.sparkSession, len(measures)
    ensure_checkpoint_dir(spark)
    hot = warm.select(*peer, "_n").distinct().withColumn("__g", F.monotonically_increasing_id())
    hot = hot.checkpoint(eager=True)
    # as many partitions as the groups' rows need, whatever the session's number is
    n_rows, session = hot.agg(F.sum("_n")).first()[0] or 0, int(
        spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(session, -(-n_rows // SPLIT_ROWS))
    hot = broadcast_if_small(hot.drop("_n"), n_hot, row_bytes=128)
    rows = join_null_safe(warm, hot, list(peer)).withColumn(
        "__row", F.monotonically_increasing_id()).checkpoint(eager=True)
    long = rows.select("__row", F.col("__g"), F.posexplode(F.array(
        *[e.cast("double") for e in measures.values()])).alias("m", "v")).select(
        (F.col("__g") * k + F.col("m")).alias("g"), "v", F.col("__row").alias("id"))
    counts = running_counts(long, group_bound=n_hot * k,
                            parts=max(session, -(-n_rows * k // SPLIT_ROWS)))
    wide = counts.repartition(parts, "id").groupBy(F.col("id").alias("__row")).agg(*[
        F.max(F.when(F.pmod(F.col("g"), F.lit(k)) == i, F.col("n"))).alias(f"__k{i}")
        for i in range(k)])
    out = rows.repartition(parts, "__row").join(wide, "__row")
    return out.select(*[c for c in warm.columns if c != "_n"], *[
        F.when(F.col("_n") >= min_peers,
               rounded_ratio(F.col(f"__k{i}"), F.col("_n"), decimals)).alias(name)
        for i, name in enumerate(measures)])


def peer_rank(df: DataFrame, peer, measures: dict[str, Column], *, min_peers: int = 30,
              decimals: int = 4, hot_rows: int | None = DEFAULT_HOT_ROWS,
              range_partitions: int | None = None, range_keys=None, hot=None) -> DataFrame:
    """Add one rank column per entry of ``measures`` (output name -> value Column).

    ``range_partitions``: range-partition the (non-hot) rows on the peer key instead of
    hash-partitioning them, so the result is already laid out for a key-sorted write.
    ``range_keys`` (default: the peer key) must be a subset of the peer key; leave out
    columns that are constant in ``df`` (Catalyst drops those from the window partition,
    and a range partitioning that still names them would not satisfy it)."""
    peer = list(peer)
    cold, warm, n_hot = split_hot(df, peer, hot_rows, hot)
    ranked = _window_rank(cold, peer, measures, min_peers, decimals, range_partitions,
                          range_keys)
    if warm is None:
        return ranked
    hot_ranked = _split_rank(warm, peer, measures, min_peers, decimals, n_hot)
    if range_partitions:
        # keep the layout promise for hot groups too: a hot group is cut into contiguous
        # slices (by its first rank) instead of scattered by the join's hash partitioning
        first = next(iter(measures))
        hot_ranked = hot_ranked.repartitionByRange(range_partitions, *(range_keys or peer),
                                                   F.col(first).asc_nulls_last())
    return ranked.unionByName(hot_ranked.select(*ranked.columns))


def peer_size(df: DataFrame, peer, name: str = "peer_rows", *,
              hot_rows: int | None = DEFAULT_HOT_ROWS) -> DataFrame:
    """count(*) OVER (PARTITION BY peer) on every row (W1), as a pre-aggregated join. Rows of
    groups above ``hot_rows`` meet the sizes of these few groups in a join of their own, by
    broadcast of a proven size, so a hot group is never one task."""
    peer = list(peer)
    cold, warm, _ = split_hot(df, peer, hot_rows)
    sizes = group_sizes(cold, peer).withColumnRenamed("_n", name)
    out = join_null_safe(cold, sizes, peer, "inner")
    if warm is None:
        return out
    return out.unionByName(warm.withColumnRenamed("_n", name))
