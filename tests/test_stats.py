"""Percentiles and the peer_stats serving table."""

import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from peerscope.operators.brackets import bracketed_percentiles
from peerscope.operators.percentiles import (global_percentiles, group_percentiles,
                                             weighted_percentiles)
from peerscope.plans.stats import peer_stats
from peerscope.schema import BREAKPOINTS

PROBS = BREAKPOINTS


def _np(vals, p):
    return float(np.percentile(np.array(vals, dtype=float), p * 100, method="linear"))


@pytest.mark.parametrize("hot_rows, map_rows", [(None, 0), (20, 20), (20, 9), (100, 20),
                                                (1000, 1000)])
def test_group_percentiles_exact(spark, hot_rows, map_rows):
    rnd = np.random.default_rng(1)
    data = {"a": rnd.normal(100, 20, 250).round(2), "b": rnd.integers(0, 9, 40).astype(float),
            "c": rnd.normal(0, 1, 15)}
    rows = [(g, float(v)) for g, vs in data.items() for v in vs] + [("a", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    out = group_percentiles(df, ["g"], {"v": F.col("v")}, PROBS, hot_rows=hot_rows,
                            map_rows=map_rows, rows="rows")
    got = {r.g: r for r in out.collect()}
    for g, vs in data.items():
        assert got[g]["v__n_rows"] == len(vs) and got[g]["rows"] == len(vs) + (g == "a")
        for name, p in PROBS:
            assert got[g][f"v__{name}"] == pytest.approx(_np(vs, p), rel=1e-12, abs=1e-9)


def test_global_and_weighted_percentiles(spark):
    vals = [float(x) for x in range(1, 1001)] + [7.0] * 50
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    g = global_percentiles(df, F.col("v"), PROBS, accuracy=100).collect()[0]
    counts = df.groupBy("v").agg(F.count(F.lit(1)).alias("f"))
    w = weighted_percentiles(counts, [], "v", "f", PROBS).collect()[0]
    for name, p in PROBS:
        assert g[name] == pytest.approx(_np(vals, p))
        assert w[name] == pytest.approx(_np(vals, p))


@pytest.mark.parametrize("accuracy", [10, 1000, 10_000])
def test_bracketed_percentiles_equal_numpy(spark, accuracy):
    rnd = np.random.default_rng(accuracy)
    data = {"a": rnd.normal(0, 9, 4000), "b": rnd.integers(0, 5, 3000).astype(float),
            "c": np.array([3.5]), None: rnd.exponential(1, 500), "d": np.array([])}
    rows = [(g, float(v)) for g, vs in data.items() for v in vs] + [("a", None), ("d", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    for bound in (5, None):
        out = {r.g: r for r in bracketed_percentiles(
            df, ["g"], F.col("v"), PROBS, group_bound=bound, accuracy=accuracy,
            extra={"rows": F.count(F.lit(1))}).collect()}
        assert set(out) == set(data)
        for g, vs in data.items():
            assert out[g].n == len(vs) and out[g]["rows"] == len(vs) + (g in ("a", "d"))
            for name, p in PROBS:
                want = _np(vs, p) if len(vs) else None
                assert out[g][name] == (want if want is None else pytest.approx(want, rel=1e-12))
    assert bracketed_percentiles(df.filter("false"), ["g"], F.col("v"), PROBS).collect() == []


def test_bracketed_percentiles_plan(spark):
    """Nothing runs while the plan is built; two scans; few values leave the second one."""
    path = tempfile.mkdtemp(prefix="brackets-") + "/t"
    spark.range(200_000).selectExpr("cast(id * 7919 % 200003 AS double) AS v").write.parquet(path)
    tracker = spark.sparkContext.statusTracker()
    jobs = set(tracker.getJobIdsForGroup(None))
    df = spark.read.parquet(path)
    out = global_percentiles(df, F.col("v"), [("p50", 0.5), ("p99", 0.99)])
    assert len(set(tracker.getJobIdsForGroup(None)) - jobs) <= 1  # the file's schema
    vals = [i * 7919 % 200003 for i in range(200_000)]
    row = out.first()
    assert row.n == 200_000 and row.p50 == _np(vals, 0.5) and row.p99 == _np(vals, 0.99)
    final = global_percentiles(df, F.col("v"), [("p50", 0.5), ("p99", 0.99)])
    final.collect()
    plan = final._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    assert plan.count("FileScan") == 2 and "ReusedExchange" in plan


def test_sorted_runs_hold_no_map(spark):
    """A group of 10^6 distinct values: no aggregation buffer grows with them."""
    df = spark.range(1_000_000).selectExpr("id % 2 AS g", "cast(id AS double) AS v",
                                           "cast(-id AS double) AS w")
    out = group_percentiles(df, ["g"], {"v": F.col("v"), "w": F.col("w")}, PROBS, hot_rows=None,
                            rows="rows")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan
    assert plan.count("Exchange hashpartitioning") == 1
    for r in out.collect():
        vals = np.arange(r.g, 1_000_000, 2, dtype=float)
        assert r["rows"] == r.v__n_rows == r.w__n_rows == 500_000
        for name, p in PROBS:
            assert r[f"v__{name}"] == pytest.approx(_np(vals, p), rel=1e-12)
            assert r[f"w__{name}"] == pytest.approx(_np(-vals, p), rel=1e-12)


def _fact_b(spark, rows):
    return spark.createDataFrame(rows, "year int, npi string, specialty string, "
                                       "hcpcs_code string, place_of_service string, "
                                       "tot_srvcs double, tot_benes long, "
                                       "avg_medicare_standardized double, "
                                       "avg_medicare_payment double")


def _fact_d(spark, rows):
    return spark.createDataFrame(rows, "year int, npi string, specialty string, "
                                       "brand_name string, generic_name string, "
                                       "tot_claims long, tot_drug_cost double")


def test_peer_stats_semantics(spark):
    b = [(2023, f"{i:010d}", "S", "C1", "F", float(i), 11 + i, 10.0 + i, 2.0) for i in range(30)]
    b += [(2023, f"{i:010d}", "S", "C1", "O", float(i), 11, 1.0, 1.0) for i in range(29)]
    b += [(2023, "0000000000", "S", "C2", "F", None, 11, 1.0, 1.0)]
    b += [(2023, f"{i:010d}", "S", "C2", "F", float(i), 11, 1.0, 1.0) for i in range(1, 30)]
    # repeat provider: one npi, one brand, two generics
    d = [(2023, f"{i:010d}", "S", "BR", "G1", 11 + i, 100.0 * i) for i in range(30)]
    d += [(2023, "0000000001", "S", "BR", "G2", 0, 5.0)]
    ps = peer_stats(_fact_b(spark, b), _fact_d(spark, d))
    rows = {(r.dataset, r.code, r.place_of_service, r.measure): r for r in ps.collect()}
    # group of 30 scored, group of 29 not
    assert ("part_b", "C1", "F", "tot_srvcs") in rows
    assert ("part_b", "C1", "O", "tot_srvcs") not in rows
    # NULL measure dropped and not counted: C2 has 30 rows but 29 values
    assert ("part_b", "C2", "F", "tot_srvcs") not in rows
    assert rows[("part_b", "C2", "F", "tot_benes")].n_rows == 30
    # Part D: NULL place_of_service, repeat provider counted once
    r = rows[("part_d", "BR", None, "tot_claims")]
    assert r.n_rows == 31 and r.n_providers == 30
    # zero denominator: cost_per_claim NULL for that row, so 30 values
    assert rows[("part_d", "BR", None, "cost_per_claim")].n_rows == 30
    c1 = rows[("part_b", "C1", "F", "tot_srvcs")]
    assert c1.p50 == pytest.approx(14.5) and c1.p10 <= c1.p25 <= c1.p99


def test_peer_stats_two_years_not_pooled(spark):
    b = [(y, f"{i:010d}", "S", "C", "F", float(i + y), 11, 1.0, 1.0)
         for y in (2022, 2023) for i in range(30)]
    d = [(2023, f"{i:010d}", "S", "BR", "G", 11, 1.0) for i in range(30)]
    ps = peer_stats(_fact_b(spark, b), _fact_d(spark, d)).filter("measure = 'tot_srvcs'")
    got = {r.year: r for r in ps.collect()}
    assert set(got) == {2022, 2023}
    assert got[2022].n_rows == 30 and got[2023].p50 == pytest.approx(2023 + 14.5)


def test_peer_stats_hot_path_equal(spark):
    rnd = np.random.default_rng(9)
    b = [(2023, f"{i:010d}", "S", f"C{i % 3}", "F", float(rnd.integers(1, 99)),
          int(rnd.integers(11, 40)), round(float(rnd.normal(50, 9)), 2), 1.5) for i in range(400)]
    d = [(2023, f"{i:010d}", "S", f"B{i % 2}", "G", int(rnd.integers(11, 50)),
          float(rnd.integers(100, 900))) for i in range(300)]
    fb, fd = _fact_b(spark, b), _fact_d(spark, d)
    a = peer_stats(fb, fd).collect()
    h = peer_stats(fb, fd, hot_rows=50).collect()

    def key(r):
        return (r.dataset, r.code, r.measure)
    a, h = sorted(a, key=key), sorted(h, key=key)
    assert len(a) == len(h) == 3 * 4 + 2 * 3
    for x, y in zip(a, h):
        assert key(x) == key(y) and x.n_rows == y.n_rows and x.n_providers == y.n_providers
        for name, _ in PROBS:
            assert x[name] == pytest.approx(y[name], rel=1e-12)


def _files(path):
    import os
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_state_follows_a_corrected_file(spark, tmp_path):
    """Changed, added, removed and repeated rows, a group that goes and one that comes: the
    state equals one made anew, only touched groups are computed, other files stay."""
    from peerscope.plans import state
    from peerscope.plans.stats import dataset_stats
    from peerscope.schema import PART_D
    rnd = np.random.default_rng(4)
    rows = [(2023, f"{i % 60:010d}", f"S{i % 7}", f"B{i % 5}", f"G{i % 11}",
             int(rnd.integers(1, 50)) if i % 9 else None, float(rnd.integers(1, 900)) / 4)
            for i in range(2500)] + [(2022, "0000000001", "S0", "B0", "G0", 5, 7.0)] * 40
    gone = [(2023, f"{i:010d}", "gone", "B", "G", 3, 4.0) for i in range(35)]
    come = [(2023, f"{i:010d}", "come", "B", "G", i, float(i)) for i in range(35)]
    changed = [(*r[:5], (r[5] or 0) + 1, r[6]) if r[2] == "S3" and i % 3 == 0 else r
               for i, r in enumerate(rows)]
    new = changed[:-3] + come + [changed[1]] * 2
    old, new = _fact_d(spark, rows + gone), _fact_d(spark, new)
    base = str(tmp_path)
    state.write_state(old, PART_D, base, buckets=8)

    def served():
        return sorted(map(repr, state.read_stats(spark, PART_D, base, min_peers=30).select(
            "year", "specialty", "code", "measure", "n_providers", "n_rows",
            *[F.round(p, 9).alias(p) for p, _ in PROBS]).collect()))

    def whole(fact):
        return sorted(map(repr, dataset_stats(fact, PART_D, min_peers=30).select(
            "year", "specialty", "code", "measure", "n_providers", "n_rows",
            *[F.round(p, 9).alias(p) for p, _ in PROBS]).collect()))

    assert served() == whole(old)
    before = _files(base)
    assert state.update_state(old, old, PART_D, base, buckets=8).isEmpty()
    assert _files(base) == before
    touched = {(r.year, r.specialty) for r in state.update_state(
        old, new, PART_D, base, buckets=8).collect()}
    assert {s for _, s in touched} >= {"S3", "gone", "come"} and (2023, "S5") not in touched
    assert served() == whole(new)
    after = _files(base)
    assert set(before) & set(after) and set(before) - set(after)
    # back again, over the zeros of the group that had gone
    state.update_state(new, old, PART_D, base, buckets=8)
    assert served() == whole(old)


def test_state_holds_a_provider_of_a_group_once(spark, tmp_path):
    """A row for each provider of a group, not one for each of its measures; a measure without a
    value is null, not a count."""
    from peerscope.plans import state
    from peerscope.schema import PART_D
    rows = [(2023, f"{i % 4:010d}", "S", "B", f"G{i}", i if i % 4 else None, 2.0)
            for i in range(12)]
    state.write_state(_fact_d(spark, rows), PART_D, str(tmp_path), buckets=2)
    found = spark.read.parquet(f"{tmp_path}/providers").orderBy("npi").collect()
    assert [r.npi for r in found] == [f"{i:010d}" for i in range(4)]
    assert [r.n_tot_claims for r in found] == [None, 3, 3, 3]
    assert [r.n_tot_drug_cost for r in found] == [3] * 4


def _scans_and_windows(df):
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    return plan.count("FileScan"), plan.count("Window [")


def test_an_update_writes_each_table_once(spark, tmp_path, monkeypatch):
    """New tables are written beside the old ones and take their place; none is checkpointed and
    written again, and nothing is left behind."""
    import os

    from peerscope.plans import state
    from peerscope.schema import PART_D
    rows = [(2023, f"{i:010d}", f"S{i % 3}", "B", "G", i, float(i % 17)) for i in range(300)]
    old, new = (_fact_d(spark, r) for r in (rows, rows[1:] + rows[5:7]))
    state.write_state(old, PART_D, str(tmp_path), buckets=2)
    written, pinned = [], []
    monkeypatch.setattr(state, "_write", lambda df, path: written.append(path))
    kept = state._pinned
    monkeypatch.setattr(state, "_pinned", lambda df: pinned.append(df.columns) or kept(df))
    state.update_state(old, new, PART_D, str(tmp_path), buckets=2)
    assert written == [] and pinned == [["bucket", "year", "specialty", "brand_name"]]
    assert sorted(os.listdir(tmp_path)) == ["providers", "stats", "values"]
    counts = spark.read.parquet(f"{tmp_path}/values").filter("measure = 'tot_claims'")
    assert counts.agg(F.sum("n")).first()[0] == 301
    found = state.counted_percentiles(counts, ["specialty"], BREAKPOINTS)
    assert _scans_and_windows(found)[1] == 1


def test_counts_are_dealt_by_their_rows(spark, tmp_path, monkeypatch):
    """One shuffle, of a partition for each so many rows, adds up counts of any key, doubles and
    nulls too; both writers of a state tell how many rows there are."""
    from peerscope.plans import state
    from peerscope.schema import PART_D
    monkeypatch.setattr(state, "COUNT_ROWS", 10)
    rows = spark.createDataFrame([(None, 0.0, 1), (None, -0.0, 2), ("a", float("nan"), 3),
                                  ("a", float("nan"), 4)], "k string, v double, n int")
    found = state._added(rows, ["n"], 115)
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    assert plan.count("Exchange") == 1 and ", 12)" in plan
    assert sorted(r.n for r in found.collect()) == [3, 7]
    told, added = [], state._added
    monkeypatch.setattr(state, "_added", lambda df, sums, n=None: told.append(n) or added(
        df, sums, n))
    fact = [(2023, f"{i:010d}", "S", "B", "G", i, 2.0) for i in range(35)]
    old, new = _fact_d(spark, fact), _fact_d(spark, fact[1:])
    state.write_state(old, PART_D, str(tmp_path), buckets=2)
    assert told == [35]
    state.update_state(old, new, PART_D, str(tmp_path), buckets=2)
    assert [n for n in told[1:] if n] == [35 + 1 + 34, 35]  # values: of claims, of cost, of both
    assert spark.read.parquet(f"{tmp_path}/stats").agg(F.max("n_rows")).first()[0] == 34


def test_a_whole_fact_is_dealt_by_its_bytes(spark, monkeypatch):
    from peerscope.plans import model
    m = model.fixture_model(spark, "/root/testdata/sf0.001")
    size = model.input_partitions(m.lines_d, 1)
    monkeypatch.setattr(model, "FACT_BYTES", size // 50)
    for name, whole in (("part_b", m.fact_b), ("part_d", m.fact_d)):
        dealt = m.dealt_fact(name)
        plan = dealt._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
        assert plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan
        assert dealt.rdd.getNumPartitions() >= 50
        assert dealt.exceptAll(whole).isEmpty() and whole.exceptAll(dealt).isEmpty()


def test_a_lookup_opens_one_directory(spark, tmp_path):
    from peerscope.plans import serve, state
    from peerscope.plans.model import fixture_model
    from peerscope.schema import PART_B, PART_D
    m = fixture_model(spark, "/root/testdata/sf0.001")
    for spec, fact in ((PART_B, m.fact_b), (PART_D, m.fact_d)):
        base = f"{tmp_path}/{spec.name}"
        state.write_state(fact, spec, base)
        rows = state.read_stats(spark, spec, base, min_peers=5).limit(5).collect()
        for r in rows:
            group = serve.PeerGroup(spec.name, r.specialty, r.code, r.place_of_service, r.year)
            one = state.lookup(spark, spec, base, group, r.measure, min_peers=5)
            assert tuple(one.collect()[0])[:2] == (r.n_providers, r.n_rows)
            assert len(one.collect()) == 1 and one.first().p50 == r.p50
            assert len({f.rsplit("/", 2)[1] for f in one.inputFiles()}) >= 1
            scan = one._jdf.queryExecution().executedPlan().toString()
            assert "PartitionFilters" in scan and "bucket" in scan.split("PartitionFilters")[1]
            found = one.select(F.input_file_name()).distinct().collect()
            assert len(found) == 1
            metrics = one._jdf.queryExecution().executedPlan().collectLeaves().head().metrics()
            assert metrics.get("numPartitions").get().value() <= 1


@pytest.mark.parametrize("accuracy", [10, 10_000])
def test_cells_rise_with_the_value(spark, accuracy):
    from peerscope.operators.brackets import cell
    vals = sorted({s * m * 2.0 ** e for e in range(-1074, 1024, 7) for m in (1.0, 1.3, 1.999)
                   for s in (-1, 1)} | {0.0, float("inf"), float("-inf"), 5e-324, 1.7e308})
    rows = [(i, v) for i, v in enumerate([*vals, float("nan"), None])]
    df = spark.createDataFrame(rows, "i int, v double").select("i", cell(F.col("v"), accuracy).alias("c"))
    got = [r.c for r in df.orderBy("i").collect()]
    assert got[-1] is None and got[:-1] == sorted(got[:-1])
    assert got[-2] == got[-3] > got[-4]


def test_large_groups_without_sketches(spark, tmp_path):
    """Large groups of any values are counted by cells: no sketch, whose buffers were the most of
    the time, and the first scan's exchange is read again."""
    rnd = np.random.default_rng(3)
    data = {"mixed": rnd.normal(0, 1e3, 900), "close": 1e9 + rnd.permutation(800) / 8,
            "ties": np.repeat([-2.0, 0.0, 7.5], 250), "wide": 10.0 ** rnd.uniform(-300, 300, 700),
            "small": rnd.normal(0, 1, 20), None: rnd.exponential(1, 300), "none": np.array([])}
    rows = [(2023, g, float(v), float(-v)) for g, vs in data.items() for v in vs]
    rows += [(2023, "none", None, 1.0)] * 60
    spark.createDataFrame(rows, "year int, g string, v double, w double").repartition(5) \
        .write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    out = group_percentiles(df, ["year", "g"], {"v": F.col("v"), "w": F.col("w")}, PROBS,
                            hot_rows=50, rows="rows")
    got = {r.g: r for r in out.collect()}
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    assert "percentile_approx" not in plan and "ReusedExchange" in plan
    assert set(got) == set(data)
    for g, vs in data.items():
        assert got[g].v__n_rows == len(vs) and got[g]["rows"] == (len(vs) or 60)
        for name, p in PROBS:
            if len(vs):
                assert got[g][f"v__{name}"] == pytest.approx(_np(vs, p), rel=1e-12)
                assert got[g][f"w__{name}"] == pytest.approx(_np(-vs, p), rel=1e-12)
            else:
                assert got[g][f"v__{name}"] is None and got[g][f"w__{name}"] == 1.0


def test_no_task_sorts_a_whole_group(spark):
    """Groups beyond an aggregation buffer but below ``hot_rows`` are not one task's sort either."""
    df = spark.range(3000).selectExpr("id % 3 AS g", "cast(id AS double) AS v")
    out = group_percentiles(df, ["g"], {"v": F.col("v")}, PROBS, hot_rows=5000, map_rows=100)
    assert "row_number" not in out._jdf.queryExecution().executedPlan().toString()
    for r in out.collect():
        for name, p in PROBS:
            assert r[f"v__{name}"] == pytest.approx(_np(np.arange(r.g, 3000, 3), p), rel=1e-12)
