"""peer_stats — the serving table: exact breakpoints per (peer group, measure).

Wide, not long: one ``groupBy(year, peer)`` per dataset with one exact ``percentile(array)``
per measure, then the (small) aggregated groups are unpivoted. Shuffling the long form
would move rows x measures records instead of rows.

n_providers is ``count(DISTINCT npi)`` over the rows where the measure is not NULL; it is
computed as (group, npi) flags summed per group, so no per-measure Expand is needed.
Groups with fewer than ``min_peers`` non-NULL values of a measure are not served.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscope.operators.joins import join_null_safe
from peerscope.operators.percentiles import PERCENTILE_ROWS, group_percentiles
from peerscope.schema import BREAKPOINTS, MIN_PEERS, PART_B, PART_D, PEER_STATS_COLUMNS


def provider_counts(fact: DataFrame, keys, values: dict) -> DataFrame:
    """Distinct npi per group among rows where each value is present (H3)."""
    flags = fact.groupBy(*keys, "npi").agg(
        *[F.max(e.isNotNull().cast("int")).alias(f"{n}__has") for n, e in values.items()])
    return flags.groupBy(*keys).agg(
        *[F.sum(f"{n}__has").cast("long").alias(f"{n}__n_providers") for n in values])


def dataset_stats(fact: DataFrame, spec, *, min_peers: int = MIN_PEERS,
                  hot_rows=PERCENTILE_ROWS) -> DataFrame:
    keys = ["year", *spec.peer]
    values = {m.name: m.expr() for m in spec.measures}
    wide = group_percentiles(fact, keys, values, BREAKPOINTS, hot_rows=hot_rows)
    if set(spec.grain) <= {"npi", *spec.peer}:
        # the grain has one row for each provider of a group (the grain check proves it), so
        # the rows with a value are the providers with one
        j = wide.withColumns({f"{n}__n_providers": F.col(f"{n}__n_rows") for n in values})
    else:
        j = join_null_safe(wide, provider_counts(fact, keys, values), keys, "inner")
    names = [p for p, _ in BREAKPOINTS]
    per_measure = F.array(*[
        F.struct(F.lit(n).alias("measure"),
                 F.col(f"{n}__n_providers").alias("n_providers"),
                 F.col(f"{n}__n_rows").cast("long").alias("n_rows"),
                 *[F.col(f"{n}__{p}").alias(p) for p in names])
        for n in values])
    pos = F.col("place_of_service") if spec.has_place_of_service \
        else F.lit(None).cast("string")
    long = j.select("year", F.lit(spec.name).alias("dataset"), "specialty",
                    F.col(spec.code_col).alias("code"), pos.alias("place_of_service"),
                    F.explode(per_measure).alias("m"))
    return (long.select("year", "dataset", "specialty", "code", "place_of_service", "m.*")
            .filter(F.col("n_rows") >= min_peers))


def peer_stats(fact_b: DataFrame, fact_d: DataFrame, *, min_peers: int = MIN_PEERS,
               hot_rows=PERCENTILE_ROWS) -> DataFrame:
    """``hot_rows``: groups with more rows get their percentiles from the distributed CDF."""
    b = dataset_stats(fact_b, PART_B, min_peers=min_peers, hot_rows=hot_rows)
    d = dataset_stats(fact_d, PART_D, min_peers=min_peers, hot_rows=hot_rows)
    return b.unionByName(d).select(*PEER_STATS_COLUMNS, "year")
