"""Serving queries: what the interactive screen asks, as lazy DataFrames.

Distribution questions read only ``peer_stats``; provider questions read a filtered slice
of a fact (the sorted layout turns the filter into a few row groups) and ask the provider
dimension for the top-k's providers only, by value. The state filter narrows the list, never the comparison set: ranks were fixed
at build time over the whole peer group.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscope.functions.columns import safe_divide, title_case
from peerscope.operators.brackets import bracketed_percentiles
from peerscope.operators.joins import broadcast_if_small, join_null_safe, join_salted
from peerscope.operators.percentiles import PERCENTILE_ROWS
from peerscope.operators.reshape import melt_breakpoints
from peerscope.schema import BREAKPOINTS, DATASETS


@dataclass(frozen=True)
class PeerGroup:
    dataset: str
    specialty: str
    code: str
    place_of_service: str | None = None
    year: int | None = None


def _spec(group_or_dataset):
    name = group_or_dataset if isinstance(group_or_dataset, str) else group_or_dataset.dataset
    return DATASETS[name]


def fact_filter(group: PeerGroup, *, with_place: bool = True):
    """Column predicate selecting one peer group's rows in its fact."""
    spec = _spec(group)
    conds = [F.col("specialty") == F.lit(group.specialty),
             F.col(spec.code_col) == F.lit(group.code)]
    if spec.has_place_of_service and with_place:
        conds.append(F.col("place_of_service").eqNullSafe(F.lit(group.place_of_service)))
    if group.year is not None:
        conds.append(F.col("year") == F.lit(group.year))
    return reduce(lambda a, b: a & b, conds)


def stats_filter(group: PeerGroup, measure: str | None = None):
    conds = [F.col("dataset") == group.dataset, F.col("specialty") == F.lit(group.specialty),
             F.col("code") == F.lit(group.code),
             F.col("place_of_service").eqNullSafe(F.lit(group.place_of_service))]
    if measure is not None:
        conds.append(F.col("measure") == measure)
    if group.year is not None:
        conds.append(F.col("year") == F.lit(group.year))
    return reduce(lambda a, b: a & b, conds)


def specialties(peer_stats: DataFrame, dataset: str) -> DataFrame:
    """Specialties with at least one scoreable group (Q1)."""
    return (peer_stats.filter(F.col("dataset") == dataset).select("specialty").distinct()
            .orderBy("specialty"))


def codes(peer_stats: DataFrame, dataset: str, specialty: str, dim: DataFrame | None = None
          ) -> DataFrame:
    """Codes of a specialty, largest group first, with a label (Q2).

    Always grouped by (code, place_of_service) so F and O groups are never merged. With no
    dimension the code is its own label; Part D's label is the sorted list of generics.
    """
    ps = peer_stats.filter((F.col("dataset") == dataset) & (F.col("specialty") == specialty))
    if dim is None:
        out = (ps.groupBy("code", "place_of_service")
               .agg(F.max("n_providers").alias("n_providers"))
               .select("code", F.col("place_of_service").alias("pos"),
                       F.col("code").alias("label"), "n_providers"))
    elif dataset == "part_b":
        j = ps.join(dim, _label_key(ps, dim, "hcpcs_code"), "left")
        out = (j.groupBy("code", "place_of_service", "hcpcs_desc")
               .agg(F.max("n_providers").alias("n_providers"))
               .select("code", F.col("place_of_service").alias("pos"),
                       F.col("hcpcs_desc").alias("label"), "n_providers"))
    else:
        # generics per brand are bounded by the drug dimension, not by the fact
        j = ps.join(dim, _label_key(ps, dim, "brand_name"), "left")
        out = (j.groupBy("code")
               .agg(F.array_join(F.array_sort(F.collect_set("generic_name")), ", ")
                    .alias("label"),
                    F.max("n_providers").alias("n_providers"))
               .select("code", F.lit(None).cast("string").alias("pos"), "label",
                       "n_providers"))
    return out.orderBy(F.desc("n_providers"), "code", F.col("pos").asc_nulls_first())


def _label_key(ps: DataFrame, dim: DataFrame, column: str):
    """Code and, for dimensions written by year, the year."""
    key = ps["code"] == dim[column]
    return key & (ps["year"] == dim["year"]) if "year" in dim.columns else key


def distribution(peer_stats: DataFrame, group: PeerGroup, measure: str) -> DataFrame:
    """The group's breakpoints, from the serving table only (Q3)."""
    return peer_stats.filter(stats_filter(group, measure)).select(
        "n_providers", "n_rows", *[p for p, _ in BREAKPOINTS])


def distribution_curve(peer_stats: DataFrame, group: PeerGroup, measure: str) -> DataFrame:
    """(percentile, value) points of the curve (P20)."""
    return melt_breakpoints(distribution(peer_stats, group, measure), [], BREAKPOINTS)


def _slice(fact: DataFrame, group: PeerGroup, measure: str, state: str | None,
           scored_only: bool = True) -> DataFrame:
    m = _spec(group).measure(measure)
    s = fact.filter(fact_filter(group))
    if scored_only:
        s = s.filter(F.col(m.rank_col).isNotNull())
    if state:
        s = s.filter(F.col("state") == F.lit(state))
    return s.select("year", "npi", "state", m.expr().alias("value"),
                    (F.lit(100) * F.col(m.rank_col)).alias("percentile"))


def _with_provider(top: DataFrame, dim_provider: DataFrame, cols,
                   bound: int | None = None) -> DataFrame:
    """Join providers of the row's year. ``bound``: most rows of ``top``; it is broadcast only
    if that is proven small."""
    on = ["year", "npi"] if "year" in dim_provider.columns else ["npi"]
    return dim_provider.select(*on, *cols).join(broadcast_if_small(top, bound), on)


#: Providers of a list that are asked for by value; those of a longer list are joined.
LOOKUP_KEYS = 1000


def _looked_up(top: DataFrame, dim_provider: DataFrame, cols, limit: int) -> DataFrame:
    """Providers of a list of at most ``limit`` rows, in two phases: the list is taken first,
    and its npis (and years) then reach the npi-sorted dimension as a pushed ``IN``, so that
    only row groups that can hold them are read."""
    if limit > LOOKUP_KEYS:
        return _with_provider(top, dim_provider, cols, limit)
    rows = top.collect()
    wanted = F.col("npi").isin(sorted({r.npi for r in rows if r.npi is not None}))
    if "year" in dim_provider.columns:
        wanted &= F.col("year").isin(sorted({r.year for r in rows}))
    known = top.sparkSession.createDataFrame(rows, top.schema)
    return _with_provider(known, dim_provider.filter(wanted), cols, limit)


def candidates(fact: DataFrame, dim_provider: DataFrame, group: PeerGroup, measure: str,
               state: str | None = None, limit: int = 200) -> DataFrame:
    """Providers of the group, highest value first, with npi (Q6)."""
    top = (_slice(fact, group, measure, state)
           .orderBy(F.desc("value"), "npi").limit(int(limit)))
    j = _looked_up(top, dim_provider, ["last_or_org_name", "first_name", "city"], int(limit))
    return j.select("npi", F.col("last_or_org_name").alias("provider"), "first_name", "city",
                    "state", "value", "percentile").orderBy(F.desc("value"), "npi")


def outliers(fact: DataFrame, dim_provider: DataFrame, group: PeerGroup, measure: str,
             state: str | None = None, limit: int = 25) -> DataFrame:
    """The top of the peer group with precomputed percentiles (Q4)."""
    return candidates(fact, dim_provider, group, measure, state, limit).drop("npi")


def outliers_display(fact: DataFrame, dim_provider: DataFrame, group: PeerGroup,
                     measure: str, state: str | None = None, limit: int = 25) -> DataFrame:
    """Screen shaping (P22): 'Last, First' in title case, 1-dp value and percentile."""
    c = candidates(fact, dim_provider, group, measure, state, limit)
    name = F.concat(title_case(F.col("provider")), F.lit(", "), title_case(F.col("first_name")))
    return c.select("npi", name.alias("provider"), "city", "state",
                    F.round("value", 1).alias("value"),
                    F.round("percentile", 1).alias("percentile"))


def provider_detail(fact: DataFrame, dim_provider: DataFrame, group: PeerGroup, measure: str,
                    npi: str) -> DataFrame:
    """One provider's value and rank in the group (Q5)."""
    s = _slice(fact, group, measure, None, scored_only=False).filter(F.col("npi") == npi)
    j = _with_provider(s, dim_provider,
                       ["last_or_org_name", "first_name", "credentials", "city"])
    return j.select("npi", "last_or_org_name", "first_name", "credentials", "city", "state",
                    "value", "percentile")


def states(fact: DataFrame, group: PeerGroup, *, with_place: bool = False) -> DataFrame:
    """States present in the group (Q7); place of service ignored unless asked."""
    return (fact.filter(fact_filter(group, with_place=with_place)).select("state").distinct()
            .orderBy("state"))


def live_percentile(fact: DataFrame, group: PeerGroup, measure: str, *,
                    hot_rows: int | None = PERCENTILE_ROWS, rows: int | None = None
                    ) -> DataFrame:
    """Breakpoints computed on the fact slice at query time (Q8); must equal Q3.

    ``rows``: the slice's size, where the caller knows it (the serving table has it). A slice
    known to be within ``hot_rows`` is one aggregation; any other goes through bracketed
    selection, two scans of the slice, so that it never sits in one aggregation buffer.
    Nothing runs before the query does. A group without values gives one row of 0 and nulls.
    """
    m = _spec(group).measure(measure)
    s = fact.filter(fact_filter(group)).select("npi", m.expr().alias("v"))
    names = [p for p, _ in BREAKPOINTS]
    if hot_rows is None or (rows is not None and rows <= hot_rows):
        one = s.agg(F.count_distinct(F.when(F.col("v").isNotNull(), F.col("npi")))
                    .alias("n_providers"),
                    F.count("v").alias("n_rows"),
                    F.percentile("v", [p for _, p in BREAKPOINTS]).alias("_q"))
        return one.select("n_providers", "n_rows",
                          *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])
    keyed = s.withColumn("_g", F.lit(0))
    prov = s.filter(F.col("v").isNotNull()).select("npi").distinct().agg(
        F.count(F.lit(1)).alias("n_providers")).withColumn("_g", F.lit(0))
    pct = bracketed_percentiles(keyed, ["_g"], F.col("v"), BREAKPOINTS, group_bound=1)
    return prov.join(F.broadcast(pct), "_g", "left").select(
        "n_providers", F.coalesce("n", F.lit(0)).alias("n_rows"), *names)


def drilldown(fact: DataFrame, group: PeerGroup, limit: int = 10) -> DataFrame:
    """Top rows of one group by services, three columns (Q9)."""
    return (fact.filter(fact_filter(group))
            .select("npi", "tot_srvcs", "tot_srvcs_pct")
            .orderBy(F.desc("tot_srvcs"), "npi").limit(int(limit)))


def provider_vs_median(fact: DataFrame, peer_stats: DataFrame, dataset: str, measure: str
                       ) -> DataFrame:
    """Every scored row's value against its group median (P21, J8): the contract join of a
    fact's ``<measure>_pct`` to ``peer_stats.measure`` on (year, specialty, code, place of
    service), the last matched null-safe (Part D has none)."""
    spec = DATASETS[dataset]
    m = spec.measure(measure)
    pos = F.col("place_of_service") if spec.has_place_of_service \
        else F.lit(None).cast("string")
    extra = [c for c in spec.grain if c not in ("npi", spec.code_col, "place_of_service")]
    f = fact.filter(F.col(m.rank_col).isNotNull()).select(
        "year", "npi", "specialty", F.col(spec.code_col).alias("code"),
        pos.alias("place_of_service"), *extra,
        m.expr().alias("value"), F.col(m.rank_col).alias("rank"))
    s = (peer_stats.filter((F.col("dataset") == dataset) & (F.col("measure") == measure))
         .select("year", "specialty", "code", "place_of_service", "p50"))
    # the medians are groups, the facts rows of groups of any size: large ones are dealt over
    # copies of their median
    j = join_salted(f, s, ["year", "specialty", "code", "place_of_service"], F.col("npi"))
    return j.withColumn("ratio_to_median", safe_divide(F.col("value"), F.col("p50")))


def largest_peer_group(fact: DataFrame, dataset: str) -> DataFrame:
    """Arg-max of group size (O3), ties broken by the key."""
    spec = DATASETS[dataset]
    keys = ["year", *spec.peer]
    return (fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .orderBy(F.desc("n_rows"), *keys).limit(1))


def peer_group_rows(fact: DataFrame, group: PeerGroup) -> DataFrame:
    """All fact rows of one group (P10): a pushed-down equality filter."""
    return fact.filter(fact_filter(group))
