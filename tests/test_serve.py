"""Serving queries over a small built model."""

import pytest
from pyspark.sql import functions as F

from peerscope.functions.columns import title_case
from peerscope.plans import serve
from peerscope.plans.model import fixture_model

SF = "/root/testdata/sf0.01"
GB = serve.PeerGroup("part_b", "NATION_7", "Brand#13", "O", 2023)
GD = serve.PeerGroup("part_d", "HOUSEHOLD", "Brand#7", None, 2023)


@pytest.fixture(scope="module")
def model(spark):
    return fixture_model(spark, SF)


def test_live_percentile_equals_served(model):
    served = serve.distribution(model.peer_stats, GB, "tot_srvcs").collect()[0]
    live = serve.live_percentile(model.fact_b, GB, "tot_srvcs").collect()[0]
    assert served.n_rows == live.n_rows and served.n_providers == live.n_providers
    for p in ("p10", "p50", "p99"):
        assert served[p] == pytest.approx(live[p], rel=1e-12)


def test_state_filters_the_list_not_the_ranks(model):
    everyone = {(r.provider, r.value): r.percentile
                for r in serve.outliers(model.fact_b, model.dim_provider, GB, "tot_srvcs",
                                        limit=1000).collect()}
    tx = serve.outliers(model.fact_b, model.dim_provider, GB, "tot_srvcs", state="TX",
                        limit=1000).collect()
    assert tx and all(r.state == "TX" for r in tx)
    for r in tx:
        assert everyone[(r.provider, r.value)] == r.percentile


def test_outliers_are_top_k_by_value(model):
    top = serve.candidates(model.fact_d, model.dim_provider, GD, "tot_claims", limit=10).collect()
    values = [r.value for r in top]
    assert len(top) == 10 and values == sorted(values, reverse=True)
    assert all(0 < r.percentile <= 100 for r in top)


def test_provider_detail_and_states(model):
    c = serve.candidates(model.fact_b, model.dim_provider, GB, "tot_benes", limit=1).collect()[0]
    d = serve.provider_detail(model.fact_b, model.dim_provider, GB, "tot_benes", c.npi).collect()
    assert len(d) == 1 and d[0].value == c.value
    states = [r.state for r in serve.states(model.fact_b, GB).collect()]
    assert states == sorted(states) and "TX" in states


def test_codes_labels(model):
    drug = serve.codes(model.peer_stats, "part_d", "HOUSEHOLD", model.dim_drug).collect()
    assert drug and all(r.pos is None and ", " in r.label for r in drug)
    counts = [r.n_providers for r in drug]
    assert counts == sorted(counts, reverse=True)


def test_curve_and_median_ratio(model):
    curve = serve.distribution_curve(model.peer_stats, GB, "tot_srvcs").collect()
    assert [r.percentile for r in curve] == [10, 25, 50, 75, 90, 95, 99]
    vs = serve.provider_vs_median(model.fact_d, model.peer_stats, "part_d", "cost_per_claim")
    r = vs.filter(F.col("p50") > 0).limit(1).collect()[0]
    assert r.ratio_to_median == pytest.approx(r.value / r.p50)


def test_title_case_like_python(spark):
    names = ["O'NEIL SMITH-JONES", "mcdonald", "ANN-MARIE"]
    df = spark.createDataFrame([(n,) for n in names], "s string")
    got = [r.t for r in df.select(title_case(F.col("s")).alias("t")).collect()]
    assert got == [n.title() for n in names]


def test_build_invariants(model):
    """rank in (0, 1]; max rank of a scored group is 1; rank NULL iff the group is under 30
    rows; breakpoints monotone; scored fact groups == served groups (as sets)."""
    from pyspark.sql import Window

    f = model.fact_b
    w = Window.partitionBy("year", "specialty", "hcpcs_code", "place_of_service")
    g = (f.withColumn("n", F.count(F.lit(1)).over(w))
         .groupBy("year", "specialty", "hcpcs_code", "place_of_service", "n")
         .agg(F.max("tot_srvcs_pct").alias("mx"), F.min("tot_srvcs_pct").alias("mn"),
              F.count("tot_srvcs_pct").alias("scored")))
    bad = g.filter(((F.col("n") >= 30) & ((F.col("mx") != 1.0) | (F.col("mn") <= 0)
                                          | (F.col("scored") != F.col("n"))))
                   | ((F.col("n") < 30) & (F.col("scored") > 0))).count()
    assert bad == 0
    ps = model.peer_stats
    assert ps.filter(~((F.col("p10") <= F.col("p25")) & (F.col("p25") <= F.col("p50"))
                       & (F.col("p50") <= F.col("p75")) & (F.col("p75") <= F.col("p90"))
                       & (F.col("p90") <= F.col("p95")) & (F.col("p95") <= F.col("p99")))
                     ).count() == 0
    scored = {(r.specialty, r.hcpcs_code, r.place_of_service)
              for r in g.filter(F.col("scored") > 0).collect()}
    served = {(r.specialty, r.code, r.place_of_service)
              for r in ps.filter((F.col("dataset") == "part_b")
                                 & (F.col("measure") == "tot_srvcs")).collect()}
    assert scored == served and len(served) > 0


def test_a_list_asks_the_dimension_by_value(spark, model, tmp_path):
    from peerscope.sources.parquet import write_sorted
    write_sorted(model.dim_provider.withColumn("year", F.lit(2023)), f"{tmp_path}/dim", ["npi"],
                 num_files=1)
    dim = spark.read.parquet(f"{tmp_path}/dim")
    top = serve.candidates(model.fact_b, dim, GB, "tot_srvcs", limit=5)
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    plan = top._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.splitlines() if "FileScan" in x)
    assert "In(npi, [" in scan.split("PushedFilters")[1] and "year" in scan.split(
        "PartitionFilters")[1].split("PushedFilters")[0]
    joined = serve.candidates(model.fact_b, model.dim_provider, GB, "tot_srvcs", limit=2000)
    assert top.collect() == joined.collect()[:5]
    nobody = serve.PeerGroup("part_b", "none", "none", "O", 2023)
    assert serve.candidates(model.fact_b, dim, nobody, "tot_srvcs").collect() == []
