"""Build checks: grain, provider attributes, reference dimensions, serving-table agreement.

Each check is one row of named BIGINT metrics (computed with single-pass conditional
aggregates per input, then combined into one row). ``run_checks`` evaluates a list of
specs concurrently into a long (check, metric, value, expectation, status) table and
``assert_checks`` fails the build when an asserted metric is violated.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerscope.functions.columns import monotone, normalised
from peerscope.operators.combine import metrics_row
from peerscope.operators.grain import ends_of_distinct, grain_check
from peerscope.schema import BREAKPOINTS, MIN_PEERS, PART_B, PART_D


def _one_row(*frames: DataFrame) -> DataFrame:
    """One-row metric frames side by side (``operators.combine.metrics_row``)."""
    return metrics_row(*frames)


def written_metrics(table: str, min_peers: int = MIN_PEERS) -> dict[str, Column]:
    """Metrics of a table that need no more than its rows one by one: row, null and threshold
    counts. The build takes them while it writes the table (``write_sorted(metrics=...)``)."""
    rows, unscored = F.count(F.lit(1)), lambda c: F.count_if(F.col(c).isNull())
    return {
        "dim_hcpcs": {"dim_hcpcs_rows": rows},
        "dim_drug": {"dim_drug_rows": rows},
        "dim_geography": {"dim_geography_rows": rows,
                          "geography_rows_labelled_state": F.count_if(
                              F.col("category") == "state")},
        "dim_ruca": {"dim_ruca_rows": rows},
        PART_B.fact: {"part_b_unscoreable_rows": unscored("tot_srvcs_pct")},
        PART_D.fact: {"part_d_unscoreable_rows": unscored("tot_claims_pct")},
        "peer_stats": {
            "peer_stats_rows": rows,
            "part_b_rows": F.count_if(F.col("dataset") == "part_b"),
            "part_d_rows": F.count_if(F.col("dataset") == "part_d"),
            "groups_below_min_peers": F.count_if(F.col("n_rows") < min_peers),
            "non_monotonic_breakpoints": F.count_if(
                ~monotone(*[F.col(n) for n, _ in BREAKPOINTS])),
            "groups_with_repeat_providers": F.count_if(
                F.col("n_providers") != F.col("n_rows"))},
    }.get(table, {})


def _measured(df: DataFrame, table: str, observed: dict | None, min_peers: int = MIN_PEERS
              ) -> DataFrame:
    """``written_metrics`` as one row: as observed, or else from a scan of ``df``."""
    metrics = written_metrics(table, min_peers)
    if observed is None or not set(metrics) <= set(observed):
        return df.agg(*[c.alias(name) for name, c in metrics.items()])
    return df.sparkSession.createDataFrame([tuple(int(observed[n]) for n in metrics)],
                                           ", ".join(f"{n} long" for n in metrics))


def check_grain_part_b(fact_b: DataFrame) -> DataFrame:
    return grain_check(fact_b, ["year", *PART_B.grain])


def check_grain_part_d(fact_d: DataFrame) -> DataFrame:
    return grain_check(fact_d, ["year", *PART_D.grain])


def _attr_side(raw: DataFrame, npi: str, spec: str, name: str, city: str) -> DataFrame:
    # least and greatest value differ exactly when a provider has more than one (NULLs are no
    # value)
    ends = ends_of_distinct(raw.select(npi, spec, name, city), npi, "npi", [
        f(c).alias(f"{a}{end}") for a, c in (("specialty", spec), ("name", name), ("city", city))
        for f, end in ((F.min, ""), (F.max, "_max"))])
    return ends.select("npi", "specialty", "name", "city", *[
        (F.col(a) != F.col(f"{a}_max")).alias(f"multi_{a}")
        for a in ("specialty", "name", "city")])


def check_provider_attributes(raw_b: DataFrame, raw_d: DataFrame) -> DataFrame:
    """One scan of each file: a full join of their providers gives all metrics at once."""
    b = _attr_side(raw_b, "Rndrng_NPI", "Rndrng_Prvdr_Type", "Rndrng_Prvdr_Last_Org_Name",
                   "Rndrng_Prvdr_City")
    d = _attr_side(raw_d, "Prscrbr_NPI", "Prscrbr_Type", "Prscrbr_Last_Org_Name",
                   "Prscrbr_City")

    parts = ("specialty", "name", "city")
    b, d = (x.select("npi", F.lit(True).alias(f"{side}_in"),
                     *[F.col(c).alias(f"{side}_{c}") for c in x.columns if c != "npi"])
            for side, x in (("b", b), ("d", d)))
    both = b.join(d, "npi", "full_outer")
    met = F.col("b_in") & F.col("d_in")

    def differ(part, form=lambda c: c):
        return F.count_if(met & ~form(F.col(f"b_{part}")).eqNullSafe(form(F.col(f"d_{part}"))))

    counts = {"overlapping_npis": F.count_if(met)}
    for side, name in (("b", "part_b"), ("d", "part_d")):
        counts[f"{name}_providers"] = F.count_if(F.col(f"{side}_in"))
        counts |= {f"{name}_npis_multi_{p}": F.count_if(F.col(f"{side}_multi_{p}"))
                   for p in parts}
    for part in parts:
        counts[f"{part}_disagreements"] = differ(part)
        if part != "specialty":
            counts[f"{part}_disagreements_normalized"] = differ(part, normalised)
    out = both.agg(*[c.alias(n) for n, c in counts.items()])
    return out.select("part_b_providers", "part_d_providers", "overlapping_npis",
                      "part_b_npis_multi_specialty", "part_d_npis_multi_specialty",
                      "part_b_npis_multi_name", "part_d_npis_multi_name",
                      "part_b_npis_multi_city", "part_d_npis_multi_city",
                      "specialty_disagreements", "name_disagreements",
                      "name_disagreements_normalized", "city_disagreements",
                      "city_disagreements_normalized")


def check_reference_dims(raw_b: DataFrame, dim_hcpcs: DataFrame, dim_drug: DataFrame,
                         dim_geography: DataFrame, dim_ruca: DataFrame, *,
                         observed: dict | None = None) -> DataFrame:
    """``observed``: metrics taken while the dimensions were written; they are not read again
    for these."""
    pairs = raw_b.select("HCPCS_Cd", "HCPCS_Desc").distinct()
    multi = (pairs.groupBy("HCPCS_Cd").agg(F.count("HCPCS_Desc").alias("nd"))
             .agg(F.count_if(F.col("nd") > 1).alias("hcpcs_codes_multi_desc")))
    distinct = dim_drug.agg(F.count_distinct("brand_name").alias("distinct_brands"),
                            F.count_distinct("generic_name").alias("distinct_generics"))
    return _one_row(
        _measured(dim_hcpcs, "dim_hcpcs", observed), multi,
        _measured(dim_drug, "dim_drug", observed), distinct,
        _measured(dim_geography, "dim_geography", observed),
        _measured(dim_ruca, "dim_ruca", observed))


def check_peer_stats(peer_stats: DataFrame, fact_b: DataFrame, fact_d: DataFrame, *,
                     min_peers: int = MIN_PEERS, observed: dict | None = None) -> DataFrame:
    """Agreement of the serving table with the fact ranks.

    Group mismatch is the size of the symmetric difference between the *sets* of scoreable
    fact groups and served groups (a count difference could hide swapped groups). Each fact
    is scanned once: it is pre-aggregated to its finest needed key with (rows, scored
    rows), and every fact metric is derived from that small aggregate. ``observed``: metrics
    taken while the tables were written, which are not computed again.
    """
    ps = _measured(peer_stats, "peer_stats", observed, min_peers)

    def mismatch(groups, spec, measure, alias):
        """groups: (year, specialty, code, place_of_service, scored) per fact group."""
        fg = groups.filter(F.col("scored") > 0).select("year", "specialty", "code",
                                                       "place_of_service")
        sg = (peer_stats.filter((F.col("dataset") == spec.name) & (F.col("measure") == measure))
              .select("year", "specialty", "code", "place_of_service"))
        k = ["year", "specialty", "code", "place_of_service"]
        cond = reduce(lambda a, b: a & b, [fg[c].eqNullSafe(sg[c]) for c in k])
        both = fg.alias("f").join(sg.alias("s"), cond, "full_outer")
        return both.agg(F.count_if(F.col("f.year").isNull() | F.col("s.year").isNull())
                        .alias(alias))

    scored = lambda c: F.count_if(F.col(c).isNotNull()).alias("scored")
    gb = (fact_b.groupBy("year", "specialty", F.col("hcpcs_code").alias("code"),
                         "place_of_service")
          .agg(F.count(F.lit(1)).alias("n"), scored("tot_srvcs_pct")))
    gd_fine = (fact_d.groupBy("year", "specialty", "brand_name", "generic_name")
               .agg(F.count(F.lit(1)).alias("n"), scored("tot_claims_pct")))
    gd = (gd_fine.groupBy("year", "specialty", F.col("brand_name").alias("code"))
          .agg(F.sum("scored").alias("scored"))
          .withColumn("place_of_service", F.lit(None).cast("string")))
    unscored = lambda groups, name: groups.agg(F.coalesce(
        F.sum(F.col("n") - F.col("scored")), F.lit(0)).cast("long").alias(name))
    seen = set(observed or ())
    fb = (_measured(fact_b, PART_B.fact, observed) if "part_b_unscoreable_rows" in seen
          else unscored(gb, "part_b_unscoreable_rows"))
    fd = (_measured(fact_d, PART_D.fact, observed) if "part_d_unscoreable_rows" in seen
          else unscored(gd_fine, "part_d_unscoreable_rows"))
    gen = (gd_fine.groupBy("year", "specialty", "generic_name").agg(F.sum("n").alias("n"))
           .filter(F.col("n") < min_peers)
           .agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long")
                .alias("part_d_unscoreable_rows_generic_key")))
    out = _one_row(ps, mismatch(gb, PART_B, "tot_srvcs", "part_b_group_mismatch"),
                   mismatch(gd, PART_D, "tot_claims", "part_d_group_mismatch"), fb, fd, gen)
    return out.select("peer_stats_rows", "part_b_rows", "part_d_rows", "part_b_group_mismatch",
                      "part_d_group_mismatch", "groups_below_min_peers",
                      "non_monotonic_breakpoints", "groups_with_repeat_providers",
                      "part_b_unscoreable_rows", "part_d_unscoreable_rows",
                      "part_d_unscoreable_rows_generic_key")


@dataclass(frozen=True)
class CheckSpec:
    name: str
    frame: DataFrame
    expect_zero: tuple = ()
    expect_at_most: tuple = ()          # ((metric, bound), ...)


def run_checks(specs, *, parallel: int = 8) -> DataFrame:
    """Long table (check, metric, value, expectation, status): 'ok' / 'FAIL' for asserted
    metrics, 'info' for reported ones.

    Each check is one row of metrics. The checks run as concurrent Spark jobs (each one a
    few aggregations over the tables) and only their metric rows — a few dozen numbers —
    come back to build the result, instead of one plan that unions every check.
    """
    specs = list(specs)
    if not specs:
        raise ValueError("no checks")
    spark = specs[0].frame.sparkSession

    def one(s):
        row = s.frame.collect()
        if len(row) != 1:
            raise AssertionError(f"check {s.name} returned {len(row)} rows, expected 1")
        return s, row[0].asDict()

    with ThreadPoolExecutor(max_workers=max(1, min(parallel, len(specs)))) as pool:
        results = list(pool.map(one, specs))
    rows = []
    for s, metrics in results:
        bounds = {m: 0 for m in s.expect_zero}
        bounds.update(dict(s.expect_at_most))
        for metric, value in metrics.items():
            value = None if value is None else int(value)
            if metric in bounds:
                b = bounds[metric]
                exp = "= 0" if metric in s.expect_zero else f"<= {b}"
                status = "ok" if value is not None and value <= b else "FAIL"
            else:
                exp, status = None, "info"
            rows.append((s.name, metric, value, exp, status))
    return spark.createDataFrame(rows, "check string, metric string, value long, "
                                       "expectation string, status string")


def standard_checks(m) -> list:
    """The build's five checks over a model (see ``plans.model``)."""
    return [
        CheckSpec("grain_fact_part_b_service", check_grain_part_b(m.fact_b),
                  expect_zero=("duplicate_keys",)),
        CheckSpec("grain_fact_part_d_drug", check_grain_part_d(m.fact_d),
                  expect_zero=("duplicate_keys",)),
        CheckSpec("provider_attributes", check_provider_attributes(m.raw_b, m.raw_d),
                  expect_zero=("part_b_npis_multi_specialty", "part_d_npis_multi_specialty",
                               "specialty_disagreements")),
        CheckSpec("reference_dims",
                  check_reference_dims(m.raw_b, m.dim_hcpcs, m.dim_drug, m.dim_geography,
                                       m.dim_ruca, observed=m.observed),
                  expect_zero=("hcpcs_codes_multi_desc",),
                  expect_at_most=(("geography_rows_labelled_state", 50),)),
        CheckSpec("peer_stats", check_peer_stats(m.peer_stats, m.fact_b, m.fact_d,
                                                 observed=m.observed),
                  expect_zero=("part_b_group_mismatch", "part_d_group_mismatch",
                               "groups_below_min_peers", "non_monotonic_breakpoints")),
    ]


def failures(results: DataFrame) -> DataFrame:
    return results.filter(F.col("status") == "FAIL")


def assert_checks(results: DataFrame) -> None:
    """Raise when an asserted metric fails (the driver sees the failing ones, at most one row a metric)."""
    bad = failures(results).collect()
    if bad:
        raise AssertionError("; ".join(f"{r.check}.{r.metric}={r.value} (expected "
                                       f"{r.expectation})" for r in bad))
