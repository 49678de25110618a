"""Plan shape: the physical plans we rely on at scale."""

import re
import tempfile

import pytest
from pyspark.sql import functions as F

from peerscope.operators.rank import peer_size
from peerscope.plans import dims, facts, profile, serve
from peerscope.plans.build import build
from peerscope.plans.model import fixture_model
from peerscope.schema import PART_B

SF = "/root/testdata/sf0.001"


def _plan(df):
    spark = df.sparkSession
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")   # no truncated filter lists
    return df._jdf.queryExecution().executedPlan().toString()


def test_all_ranks_share_one_exchange(spark):
    raw_b = fixture_model(spark, SF).raw_b
    base = tempfile.mkdtemp(prefix="peerscope-plan-")
    raw_b.write.mode("overwrite").parquet(f"{base}/raw_b")
    staged = spark.read.parquet(f"{base}/raw_b")
    plan = _plan(facts.fact_part_b_service(staged, hot_rows=None))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert len(re.findall(r"\bWindow\b", plan)) == len(PART_B.measures)
    ranged = _plan(facts.fact_part_b_service(staged, hot_rows=None, range_partitions=4))
    assert "rangepartitioning" in ranged and "hashpartitioning" not in ranged


def test_serving_filter_reaches_scan_and_build_checks_pass(spark):
    m = fixture_model(spark, SF)
    out = tempfile.mkdtemp(prefix="peerscope-build-")
    res = build(spark, m.raw_b, m.raw_d, out, block_bytes=64 * 1024)
    g = serve.PeerGroup("part_d", "HOUSEHOLD", "Brand#7", None, 2023)
    q = serve.peer_group_rows(res.tables["fact_part_d_drug"], g).select("npi", "tot_claims")
    plan = _plan(q)
    assert "PartitionFilters: [isnotnull(year" in plan
    assert "EqualTo(brand_name,Brand#7)" in plan and "EqualTo(specialty,HOUSEHOLD)" in plan
    assert re.search(r"ReadSchema: struct<npi:string,brand_name:string,specialty:string,"
                     r"tot_claims:bigint>", plan) or "ReadSchema: struct<npi" in plan
    status = {(r.check, r.metric): r.status for r in res.checks.collect()}
    for metric in ("duplicate_keys",):
        assert status[("grain_fact_part_b_service", metric)] == "ok"
        assert status[("grain_fact_part_d_drug", metric)] == "ok"
    for metric in ("part_b_group_mismatch", "part_d_group_mismatch",
                   "groups_below_min_peers", "non_monotonic_breakpoints"):
        assert status[("peer_stats", metric)] == "ok"
    # written peer_stats equals the in-memory plan
    a = res.tables["peer_stats"].drop("year").collect()
    b = m.peer_stats.drop("year").collect()
    key = lambda r: (r.dataset, r.specialty, r.code, r.measure)
    assert sorted(a, key=key) == sorted(b, key=key)
    assert res.tables["fact_part_b_service"].filter(F.col("tot_srvcs_pct").isNotNull()).count() \
        == m.fact_b.filter(F.col("tot_srvcs_pct").isNotNull()).count()


def test_build_with_hot_groups_matches(spark):
    """A build where most peer groups exceed the hot threshold (value-CDF ranks and
    percentiles, range-partitioned hot branch) writes the same facts and serving table."""
    m = fixture_model(spark, SF)
    out = tempfile.mkdtemp(prefix="peerscope-hotbuild-")
    res = build(spark, m.raw_b, m.raw_d, out, hot_rows=20, percentile_rows=20,
                block_bytes=64 * 1024, run_checks=False, stage_raw=False, fact_files=4)
    cols = ["npi", "brand_name", "generic_name", "tot_claims_pct", "tot_drug_cost_pct",
            "cost_per_claim_pct"]
    got = sorted(res.tables["fact_part_d_drug"].select(*cols).collect())
    want = sorted(m.fact_d.select(*cols).collect())
    assert got == want
    key = lambda r: (r.dataset, r.specialty, r.code, r.measure)
    a = sorted(res.tables["peer_stats"].drop("year").collect(), key=key)
    b = sorted(m.peer_stats.drop("year").collect(), key=key)
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert key(x) == key(y) and x.n_rows == y.n_rows and x.n_providers == y.n_providers
        for p in ("p10", "p25", "p50", "p75", "p90", "p95", "p99"):
            assert x[p] == y[p]  # one interpolation formula: the same bits


def test_two_yearly_builds_share_a_root(spark):
    """Building 2022 then 2023 into one root keeps both years (dynamic partition
    overwrite), and a year's serving table is computed from that year only."""
    m = fixture_model(spark, SF)
    out = tempfile.mkdtemp(prefix="peerscope-years-")
    build(spark, m.raw_b, m.raw_d, out, year=2022, run_checks=False, block_bytes=64 * 1024)
    res = build(spark, m.raw_b, m.raw_d, out, year=2023, run_checks=False,
                block_bytes=64 * 1024)
    from peerscope.sources.parquet import read_table
    fact = read_table(spark, out, "fact_part_d_drug")
    years = {r.year: r["count"] for r in fact.groupBy("year").count().collect()}
    assert set(years) == {2022, 2023} and years[2022] == years[2023]
    ps = read_table(spark, out, "peer_stats")
    per_year = {r.year: r["count"] for r in ps.groupBy("year").count().collect()}
    assert per_year[2022] == per_year[2023] == res.tables["peer_stats"].count()


def test_dimensions_of_two_years_stay_apart(spark):
    """The second year's build has half the providers; the first year's serving rows keep all
    of theirs."""
    from peerscope.plans.build import load_built
    m = fixture_model(spark, SF)
    half = m.raw_b.filter("cast(Rndrng_NPI as long) % 2 = 0")
    half_d = m.raw_d.filter("cast(Prscrbr_NPI as long) % 2 = 0")
    out = tempfile.mkdtemp(prefix="peerscope-dims-")
    kw = {"run_checks": False, "block_bytes": 64 * 1024, "min_peers": 2}
    build(spark, m.raw_b, m.raw_d, out, year=2023, **kw)
    build(spark, half, half_d, out, year=2024, **kw)
    everything = load_built(spark, out)
    for year, raw in ((2023, m.raw_b), (2024, half)):
        t = load_built(spark, out, year)
        assert t["dim_provider"].count() == raw.select("Rndrng_NPI").distinct().count()
        big = serve.largest_peer_group(t["fact_part_b_service"], "part_b").first()
        group = serve.PeerGroup("part_b", big.specialty, big.hcpcs_code, big.place_of_service,
                                year)
        for tables in (t, everything):
            rows = serve.candidates(tables["fact_part_b_service"], tables["dim_provider"], group,
                                    "tot_srvcs", limit=10**6).collect()
            assert len(rows) == big.n_rows
    labels = serve.codes(everything["peer_stats"].filter("year = 2023"), "part_b", big.specialty,
                         everything["dim_hcpcs"]).collect()
    assert len(labels) == len({(r.code, r.pos) for r in labels})


def test_source_variants_have_their_own_root(spark):
    m = fixture_model(spark, SF)
    out = tempfile.mkdtemp(prefix="peerscope-source-")
    kw = {"run_checks": False, "block_bytes": 64 * 1024}
    full = build(spark, m.raw_b, m.raw_d, out, source="full", **kw)
    part = build(spark, m.raw_b.limit(50), m.raw_d.limit(50), out, source="samples", **kw)
    assert full.out_dir != part.out_dir
    assert full.tables["fact_part_b_service"].count() == m.raw_b.count()
    assert part.tables["fact_part_b_service"].count() == 50
    assert part.tables["peer_stats"].columns == full.tables["peer_stats"].columns
    with pytest.raises(ValueError):
        build(spark, m.raw_b, m.raw_d, out, source="other", **kw)


def test_fixtures_hold_every_order(spark):
    from peerscope.fixtures import load_tables
    m = fixture_model(spark, SF)
    lines = load_tables(spark, SF, ("lineitem",))["lineitem"].count()
    assert m.raw_b.agg({"Tot_Bene_Day_Srvcs": "sum"}).first()[0] == lines
    assert m.raw_d.agg({"Tot_Clms": "sum"}).first()[0] == lines


def test_string_minimums_come_after_distinct(spark):
    """A sort-based aggregate over strings only ever sees distinct attribute rows."""
    out = tempfile.mkdtemp(prefix="peerscope-plan-")
    m = fixture_model(spark, SF)
    m.raw_b.write.parquet(f"{out}/b")
    m.raw_d.write.parquet(f"{out}/d")
    b, d = spark.read.parquet(f"{out}/b"), spark.read.parquet(f"{out}/d")
    for df in (dims.dim_hcpcs(b), dims.dim_geography(b, d), dims.dim_ruca(b)):
        lines = _plan(df).splitlines()
        for i, line in enumerate(lines):
            if "FileScan" in line:  # the first aggregate above a scan is a hash aggregate
                above = [x for x in lines[:i] if "Aggregate" in x]
                assert "HashAggregate" in above[-1]


def test_groups_of_any_size_are_spread(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        m = fixture_model(spark, SF)
        plan = _plan(serve.provider_vs_median(m.fact_d, m.peer_stats, "part_d", "cost_per_claim"))
        join = next(x for x in plan.splitlines() if "SortMergeJoin" in x)
        assert "__salt" in join
        li = spark.read.parquet(f"{SF}/lineitem.parquet")
        plan = _plan(peer_size(li, ["l_linestatus"], hot_rows=10))
        assert "BroadcastHashJoin" in plan  # the few hot groups, by a proven bound
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_key_with_half_the_rows_is_dealt_by_its_count(spark):
    from peerscope.operators.joins import join_salted, replication
    rows = spark.range(64_000).selectExpr(
        "CASE WHEN id % 2 = 0 THEN NULL ELSE id % 400 END AS k", "id")
    groups = spark.range(400).selectExpr("id AS k", "id * 10 AS v").union(
        spark.sql("SELECT CAST(NULL AS BIGINT), -1L"))
    hot, bound = replication(rows, ["k"], 16)
    factors = {r.k: r._factor for r in hot.collect()}
    assert factors == {None: 64} and bound == 128
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled",
                                           "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = join_salted(rows, groups, ["k"], F.col("id"))
        tasks = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(tasks) == 64_000 and max(tasks) <= 2 * 64_000 / 16
        bad = out.filter(~F.coalesce(F.col("v") == F.col("k") * 10, F.col("v") == -1))
        assert bad.isEmpty() and "_factor" not in out.columns
        some = join_salted(rows, groups.filter("k > 5"), ["k"], F.col("id"), "left")
        assert some.count() == 64_000
        assert join_salted(rows.filter("false"), groups, ["k"], F.col("id")).isEmpty()
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_identifiers_are_counted_as_bits(spark):
    from peerscope.operators.bitmaps import distinct_count, set_counts
    npi = [f"{1_000_000_000 + 7919 * i:010d}" for i in range(5000)]
    a = npi[:4000] + npi[:100] + ["", "12", "A123456789", "12345678901", None, "0000000001"]
    b = npi[3000:] + ["12", "B", None, "9999999999"]
    left = spark.createDataFrame([(x,) for x in a], "npi string").repartition(5)
    right = spark.createDataFrame([(x,) for x in b], "id string")
    x, y = set(a) - {None}, set(b) - {None}
    found = distinct_count(left, "npi", "n")
    assert found.first().n == len(x) and "Expand" not in _plan(found)
    got = set_counts({"a": (left, "npi"), "b": (right, "id")}).first().asDict()
    assert got == {"a": len(x), "b": len(y), "both": len(x & y), "a_only": len(x - y),
                   "b_only": len(y - x)}
    none = set_counts({"a": (left.filter("false"), "npi"), "b": (right, "id")}).first()
    assert (none.a, none.b, none.both, none.a_only) == (0, len(y), 0, 0)
    m = fixture_model(spark, SF)
    plan = _plan(profile.cardinality(m.raw_b, {"n": "Rndrng_NPI", "s": "HCPCS_Cd"},
                                     identifiers=("Rndrng_NPI",)))
    assert "Expand" not in plan and "bitmap_construct_agg" in plan
