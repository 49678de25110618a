"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver's tables (through the fixture mapping) and runs over whole
tables. Parameters such as the served peer group are fixed values chosen to be
scoreable at every test scale. Percentile outputs are rounded to 6 dp, the comparison
rule shared with the oracle (two engines interpolate with different float formulas).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerscope.fixtures import load_tables, provider_sides
from peerscope.operators.grain import grain_check, unscoreable_rows
from peerscope.operators.rank import peer_rank, peer_size
from peerscope.operators.reshape import unpivot_measures
from peerscope.plans import checks, dims, profile, serve, state
from peerscope.plans.facts import PART_B_RENAMES, project_rename
from peerscope.plans.model import fixture_model
from peerscope.schema import BREAKPOINTS, PART_B, PART_D
from peerscope.session import release, scratch_path

# The served peer groups and provider used by the serving queries.
GROUP_B = serve.PeerGroup("part_b", "NATION_7", "Brand#13", "O", 2023)
GROUP_D = serve.PeerGroup("part_d", "HOUSEHOLD", "Brand#7", None, 2023)
STATE_B = "TX"
NPI_B = "0000000270"
#: Lines of a group that one task ranks; the few groups of ``peer_rank`` grow with the table.
LINE_HOT_ROWS = 250_000
PCT_NAMES = [p for p, _ in BREAKPOINTS]


def _r6(df: DataFrame, cols=PCT_NAMES) -> DataFrame:
    return df.select(*[F.round(F.col(c), 6).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def _m(spark, sf):
    return fixture_model(spark, sf)


def _rounded(df: DataFrame, *cols) -> DataFrame:
    """The comparison rule for measures that two engines interpolate: 6 decimals."""
    return _r6(df, [c for c, kind in df.dtypes if kind == "double"] if not cols else cols)


# ---------------------------------------------------------------- build

def q_fact_part_b_service(spark, sf):
    return _m(spark, sf).fact_b


def q_fact_part_d_drug(spark, sf):
    return _m(spark, sf).fact_d


def q_peer_stats(spark, sf):
    return _r6(_m(spark, sf).peer_stats)


def q_peer_stats_hot(spark, sf):
    """peer_stats with every group above 40 rows sent through bracketed selection."""
    m = _m(spark, sf)
    from peerscope.plans.stats import peer_stats
    return _r6(peer_stats(m.fact_b, m.fact_d, hot_rows=40))


def _lineitem_rank(spark, sf, hot_rows):
    li = load_tables(spark, sf, ("lineitem",))["lineitem"]
    ranked = peer_rank(li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                 "l_returnflag", "l_linestatus", "l_extendedprice",
                                 "l_quantity"),
                       ["l_returnflag", "l_linestatus"],
                       {"price_pct": F.col("l_extendedprice"),
                        "qty_pct": F.col("l_quantity")},
                       min_peers=30, decimals=4, hot_rows=hot_rows)
    return ranked


def q_peer_rank(spark, sf):
    return _lineitem_rank(spark, sf, hot_rows=LINE_HOT_ROWS)


def q_peer_rank_hot(spark, sf):
    """Same ranks with every group forced through the skew-safe value-CDF path."""
    return _lineitem_rank(spark, sf, hot_rows=100)


def q_peer_size(spark, sf):
    li = load_tables(spark, sf, ("lineitem",))["lineitem"]
    return peer_size(li.select("l_orderkey", "l_linenumber", "l_partkey"), ["l_partkey"])


def q_project_rename(spark, sf):
    return project_rename(_m(spark, sf).raw_b, PART_B_RENAMES)


def q_derive_total_payment(spark, sf):
    f = _m(spark, sf).fact_b
    return f.select("npi", "hcpcs_code", "place_of_service",
                    PART_B.measure("total_medicare_payment").expr()
                    .alias("total_medicare_payment"))


def q_derive_cost_per_claim(spark, sf):
    f = _m(spark, sf).fact_d
    return f.select("npi", "brand_name", "generic_name",
                    PART_D.measure("cost_per_claim").expr().alias("cost_per_claim"))


def q_unpivot_measures(spark, sf):
    f = _m(spark, sf).fact_d
    return unpivot_measures(f, ["npi", "brand_name", "generic_name"],
                            {"tot_claims": F.col("tot_claims"),
                             "tot_benes": F.col("tot_benes"),
                             "ge65_tot_benes": F.col("ge65_tot_benes")})


def q_dim_provider(spark, sf):
    return _m(spark, sf).dim_provider


def q_dim_provider_sides(spark, sf):
    """The provider dimension over sides with providers of their own."""
    return dims.dim_provider(*provider_sides(spark, sf))


def q_dim_hcpcs(spark, sf):
    return _m(spark, sf).dim_hcpcs


def q_dim_drug(spark, sf):
    return _m(spark, sf).dim_drug


def q_dim_geography(spark, sf):
    return _m(spark, sf).dim_geography


def q_dim_ruca(spark, sf):
    return _m(spark, sf).dim_ruca


# ---------------------------------------------------------------- checks

def q_check_grain_part_b(spark, sf):
    return checks.check_grain_part_b(_m(spark, sf).fact_b)


def q_check_grain_part_d(spark, sf):
    return checks.check_grain_part_d(_m(spark, sf).fact_d)


def q_check_provider_attributes(spark, sf):
    m = _m(spark, sf)
    return checks.check_provider_attributes(m.raw_b, m.raw_d)


def q_check_reference_dims(spark, sf):
    m = _m(spark, sf).kept
    return checks.check_reference_dims(m.raw_b, m.dim_hcpcs, m.dim_drug, m.dim_geography,
                                       m.dim_ruca)


def q_check_peer_stats(spark, sf):
    m = _m(spark, sf)
    return checks.check_peer_stats(m.peer_stats, m.fact_b, m.fact_d)


def q_check_provider_sides(spark, sf):
    """The attribute check over sides with providers of their own."""
    return checks.check_provider_attributes(*provider_sides(spark, sf))


def q_run_checks(spark, sf):
    return checks.run_checks(checks.standard_checks(_m(spark, sf).kept))


def q_grain_check(spark, sf):
    li = load_tables(spark, sf, ("lineitem",))["lineitem"]
    return grain_check(li, ["l_orderkey", "l_linenumber"])


def q_unscoreable_rows(spark, sf):
    return unscoreable_rows(_m(spark, sf).fact_d, ["year", "specialty", "generic_name"], 30)


# ---------------------------------------------------------------- serving

def q_specialties(spark, sf):
    return serve.specialties(_m(spark, sf).peer_stats, "part_b")


def q_codes(spark, sf):
    m = _m(spark, sf)
    return serve.codes(m.peer_stats, "part_b", GROUP_B.specialty, m.dim_hcpcs)


def q_peer_stats_updated(spark, sf):
    """Both datasets' serving rows, brought from a faulty version of the facts (values that are
    too high, rows that are missing, rows twice) to the right one by their difference."""
    m, base, parts = _m(spark, sf), scratch_path(spark, "peer_state"), []
    for spec, measure in ((PART_B, "tot_srvcs"), (PART_D, "tot_claims")):
        m.dealt_fact(spec.name).write.parquet(f"{base}/{spec.fact}")
        release(spark)
        fact = spark.read.parquet(f"{base}/{spec.fact}")
        mark = F.pmod(F.xxhash64("npi", spec.code_col), F.lit(50))
        faulty = fact.filter(mark != 0).withColumn(measure, F.when(
            mark == 1, F.col(measure) + 1).otherwise(F.col(measure)))
        # one reading yields the rows that come twice, too
        twice = F.when(mark == 2, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        faulty = faulty.select("*", F.explode(twice).alias("_copy")).drop("_copy")
        state.write_state(faulty, spec, f"{base}/{spec.name}", buckets=4)
        state.update_state(faulty, fact, spec, f"{base}/{spec.name}", buckets=4)
        parts.append(state.read_stats(spark, spec, f"{base}/{spec.name}"))
    return _r6(parts[0].unionByName(parts[1]))


def q_codes_drug(spark, sf):
    m = _m(spark, sf)
    return serve.codes(m.peer_stats, "part_d", GROUP_D.specialty, m.dim_drug)


def q_codes_unlabelled(spark, sf):
    m = _m(spark, sf)
    return serve.codes(m.peer_stats, "part_b", GROUP_B.specialty, None)


def q_distribution(spark, sf):
    return _r6(serve.distribution(_m(spark, sf).peer_stats, GROUP_B, "tot_srvcs"))


def q_distribution_drug(spark, sf):
    return _r6(serve.distribution(_m(spark, sf).peer_stats, GROUP_D, "cost_per_claim"))


def q_distribution_curve(spark, sf):
    return _r6(serve.distribution_curve(_m(spark, sf).peer_stats, GROUP_B,
                                        "total_medicare_payment"), ["value"])


def q_live_percentile(spark, sf):
    return _r6(serve.live_percentile(_m(spark, sf).fact_b, GROUP_B, "tot_srvcs"))


def q_live_percentile_hot(spark, sf):
    """The live percentile of a slice that is known to be beyond one aggregation."""
    return _r6(serve.live_percentile(_m(spark, sf).fact_b, GROUP_B, "tot_srvcs", hot_rows=10,
                                     rows=11))


def q_outliers(spark, sf):
    m = _m(spark, sf)
    return serve.outliers(m.fact_b, m.dim_provider, GROUP_B, "total_medicare_payment")


def q_outliers_state(spark, sf):
    m = _m(spark, sf)
    return serve.outliers(m.fact_b, m.dim_provider, GROUP_B, "tot_srvcs", state=STATE_B)


def q_outliers_drug(spark, sf):
    m = _m(spark, sf)
    return serve.outliers(m.fact_d, m.dim_provider, GROUP_D, "cost_per_claim")


def q_outliers_display(spark, sf):
    m = _m(spark, sf)
    return serve.outliers_display(m.fact_d, m.dim_provider, GROUP_D, "tot_drug_cost")


def q_candidates(spark, sf):
    m = _m(spark, sf)
    return serve.candidates(m.fact_d, m.dim_provider, GROUP_D, "tot_claims")


def q_provider_detail(spark, sf):
    m = _m(spark, sf)
    return serve.provider_detail(m.fact_b, m.dim_provider, GROUP_B, "tot_benes", NPI_B)


def q_states(spark, sf):
    return serve.states(_m(spark, sf).fact_b, GROUP_B)


def q_drilldown(spark, sf):
    return serve.drilldown(_m(spark, sf).fact_b, GROUP_B)


def q_provider_vs_median(spark, sf):
    m = _m(spark, sf)
    out = serve.provider_vs_median(m.fact_d, m.peer_stats, "part_d", "cost_per_claim")
    return _r6(out, ["p50", "ratio_to_median", "value"])


def q_largest_peer_group(spark, sf):
    return serve.largest_peer_group(_m(spark, sf).fact_b, "part_b")


def q_peer_group_rows(spark, sf):
    return serve.peer_group_rows(_m(spark, sf).fact_b, GROUP_B)


def q_null_safe_filter(spark, sf):
    ps = _m(spark, sf).peer_stats
    return _r6(ps.filter(F.col("place_of_service").eqNullSafe(F.lit(None).cast("string"))
                         & (F.col("code") == GROUP_D.code)))


# ---------------------------------------------------------------- profiles

def q_cardinality(spark, sf):
    return profile.cardinality(_m(spark, sf).raw_b, {
        "providers": "Rndrng_NPI", "specialties": "Rndrng_Prvdr_Type",
        "hcpcs_codes": "HCPCS_Cd", "states": "Rndrng_Prvdr_State_Abrvtn",
        "ruca_codes": "Rndrng_Prvdr_RUCA", "places_of_service": "Place_Of_Srvc",
        "entity_types": "Rndrng_Prvdr_Ent_Cd"}, identifiers=("Rndrng_NPI",))


def q_null_profile(spark, sf):
    return profile.null_profile(_m(spark, sf).raw_d)


def q_part_b_nulls(spark, sf):
    return profile.part_b_nulls(_m(spark, sf).raw_b)


def q_suppression_report(spark, sf):
    return profile.suppression_report(_m(spark, sf).raw_d)


def q_suppression_floor(spark, sf):
    return profile.suppression_floor(_m(spark, sf).raw_b, {
        "min_tot_benes": "Tot_Benes", "min_tot_srvcs": "Tot_Srvcs",
        "min_bene_day_srvcs": "Tot_Bene_Day_Srvcs"}, "Tot_Benes", 11)


def q_suppression_floor_drug(spark, sf):
    return profile.suppression_floor(_m(spark, sf).raw_d, {
        "min_tot_clms": "Tot_Clms", "min_tot_benes": "Tot_Benes",
        "min_ge65_tot_benes": "GE65_Tot_Benes"}, "Tot_Clms", 11)


def q_low_end_histogram(spark, sf):
    return profile.low_end_histogram(_m(spark, sf).raw_b, "Tot_Benes", 20)


def q_low_end_histogram_services(spark, sf):
    return profile.low_end_histogram(_m(spark, sf).raw_b, "Tot_Srvcs", 20)


# Candidate peer keys and how a report words them.
PART_B_VARIANTS = [
    (["Rndrng_Prvdr_Type", "HCPCS_Cd"], "specialty + code"),
    (["Rndrng_Prvdr_Type", "HCPCS_Cd", "Place_Of_Srvc"], "specialty + code + place of service"),
    (["Rndrng_Prvdr_Type", "HCPCS_Cd", "Rndrng_Prvdr_RUCA"], "specialty + code + RUCA"),
    (["Rndrng_Prvdr_Type", "HCPCS_Cd", "Rndrng_Prvdr_State_Abrvtn"], "specialty + code + state"),
]
PART_D_VARIANTS = [
    (["Prscrbr_Type", "Gnrc_Name"], "specialty + generic"),
    (["Prscrbr_Type", "Brnd_Name"], "specialty + brand"),
    (["Prscrbr_Type", "Gnrc_Name", "Prscrbr_State_Abrvtn"], "specialty + generic + state"),
]
PART_D_KEY_VARIANTS = [
    (["Prscrbr_Type", "Gnrc_Name"], "specialty + generic"),
    (["Prscrbr_Type", "Brnd_Name"], "specialty + brand"),
]


def q_group_size_profile(spark, sf):
    return profile.group_size_profile(_m(spark, sf).raw_d, ["Prscrbr_Type", "Gnrc_Name"], 30,
                                      "specialty + generic")


def q_peer_key_variants(spark, sf):
    return profile.peer_key_variants(_m(spark, sf).raw_b, PART_B_VARIANTS, 30)


def q_peer_key_variants_drug(spark, sf):
    return profile.peer_key_variants(_m(spark, sf).raw_d, PART_D_VARIANTS, 30)


def _cost_per_claim():
    return F.col("Tot_Drug_Cst") / F.nullif(F.col("Tot_Clms").cast("double"), F.lit(0.0))


def _measures_b():
    return {c: F.col(c) for c in ("Tot_Benes", "Tot_Srvcs", "Avg_Sbmtd_Chrg",
                                  "Avg_Mdcr_Alowd_Amt", "Avg_Mdcr_Pymt_Amt",
                                  "Avg_Mdcr_Stdzd_Amt")} | {
        "row_total_payment": F.col("Tot_Srvcs") * F.col("Avg_Mdcr_Pymt_Amt")}


def q_measure_distribution(spark, sf):
    return _rounded(profile.measure_distribution(_m(spark, sf).raw_b, _measures_b()))


def q_measure_distribution_hot(spark, sf):
    """measure_distribution with coarse cells, so that much is left inside the brackets."""
    return _rounded(profile.measure_distribution(_m(spark, sf).raw_b, _measures_b(),
                                                 accuracy=50))


def q_measure_distribution_drug(spark, sf):
    measures = {c: F.col(c) for c in ("Tot_Clms", "Tot_30day_Fills", "Tot_Day_Suply",
                                      "Tot_Drug_Cst", "Tot_Benes")}
    return _rounded(profile.measure_distribution(
        _m(spark, sf).raw_d, measures | {"cost_per_claim": _cost_per_claim()}))


def q_within_group_spread(spark, sf):
    return _rounded(profile.within_group_spread(
        _m(spark, sf).raw_b, ["Rndrng_Prvdr_Type", "HCPCS_Cd"],
        F.col("Avg_Mdcr_Stdzd_Amt"), F.col("Tot_Srvcs"), min_rows=30, top=25))


def q_within_group_spread_drug(spark, sf):
    """Cost per claim and claims inside a specialty's drugs."""
    return _rounded(profile.within_group_spread(
        _m(spark, sf).raw_d, ["Prscrbr_Type", "Gnrc_Name"],
        _cost_per_claim(), F.col("Tot_Clms"), min_rows=30, top=25))


def q_key_spread_comparison(spark, sf):
    return _rounded(profile.key_spread_comparison(
        _m(spark, sf).raw_d, _cost_per_claim(), PART_D_KEY_VARIANTS, min_rows=30))


def q_fanout_profile(spark, sf):
    return profile.fanout_profile(_m(spark, sf).raw_d, "Gnrc_Name", "Brnd_Name")


def q_provider_set_overlap(spark, sf):
    return profile.provider_set_overlap(*provider_sides(spark, sf))


def q_providers_in_both(spark, sf):
    return profile.providers_in_both(*provider_sides(spark, sf))


def q_providers_b_only(spark, sf):
    return profile.providers_only_in(*provider_sides(spark, sf), "part_b")


def q_providers_d_only(spark, sf):
    return profile.providers_only_in(*provider_sides(spark, sf), "part_d")


def q_provider_overlap(spark, sf):
    return profile.provider_overlap(*provider_sides(spark, sf))


def q_multi_specialty(spark, sf):
    m = _m(spark, sf)
    return profile.multi_specialty(m.raw_b, m.raw_d)


def q_specialty_agreement(spark, sf):
    return profile.specialty_agreement(*provider_sides(spark, sf))


def q_specialty_mismatches(spark, sf):
    return profile.specialty_mismatches(*provider_sides(spark, sf))


def q_entity_split(spark, sf):
    return profile.entity_split(*provider_sides(spark, sf))


def q_provider_attribute_counts(spark, sf):
    return profile.provider_attribute_counts(_m(spark, sf).raw_d, "Prscrbr_NPI", {
        "n_specialty": "Prscrbr_Type", "n_name": "Prscrbr_Last_Org_Name",
        "n_city": "Prscrbr_City"})


def q_key_profile(spark, sf):
    o = load_tables(spark, sf, ("orders",))["orders"]
    return profile.key_profile(o, "o_custkey", "o_orderkey")


QUERIES = {name[2:]: fn for name, fn in dict(globals()).items()
           if name.startswith("q_") and callable(fn)}


def queries() -> dict:
    from peerscope.sources import registered as src  # sources add their own queries
    out = dict(QUERIES)
    out.update(src.QUERIES)
    return out


def run(spark: SparkSession, name: str, sf_dir: str) -> DataFrame:
    return queries()[name](spark, sf_dir)
