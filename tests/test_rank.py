"""peer_rank: cume_dist semantics, threshold on rows, exact rounding, both strategies."""

import random

import numpy as np
from pyspark.sql import functions as F

from peerscope.functions.columns import rounded_ratio
from peerscope.operators.prefix import dealt, running_counts
from peerscope.operators.rank import peer_rank, peer_size


def _rank(spark, rows, hot_rows=None, min_peers=30, decimals=4):
    df = spark.createDataFrame(rows, "g string, id int, v double")
    out = peer_rank(df, ["g"], {"r": F.col("v")}, min_peers=min_peers, decimals=decimals,
                    hot_rows=hot_rows)
    return {(r.g, r.id): r.r for r in out.collect()}


def _cume(values, decimals=4):
    """Reference cume_dist with NULLs last and exact half-up rounding."""
    n = len(values)
    out = []
    for v in values:
        k = n if v is None else sum(1 for x in values if x is not None and x <= v)
        q = (2 * k * 10 ** decimals + n) // (2 * n)
        out.append(q / 10 ** decimals)
    return out


def test_threshold_is_on_rows(spark):
    rows = []
    for g, n in (("a", 29), ("b", 30), ("c", 31)):
        rows += [(g, i, float(i)) for i in range(n)]
    r = _rank(spark, rows)
    assert all(r[("a", i)] is None for i in range(29))
    assert r[("b", 29)] == 1.0 and r[("b", 0)] == round(1 / 30, 4)
    assert r[("c", 30)] == 1.0


def test_ties_share_the_upper_rank(spark):
    rows = [("t", i, 5.0) for i in range(40)]
    rows += [("h", i, 1.0 if i < 20 else 2.0) for i in range(40)]
    r = _rank(spark, rows)
    assert {r[("t", i)] for i in range(40)} == {1.0}
    assert {r[("h", i)] for i in range(20)} == {0.5}
    assert {r[("h", i)] for i in range(20, 40)} == {1.0}


def test_rounding_is_exact_half_up(spark):
    # 57 / 800 = 0.07125 exactly: half-up gives 0.0713 (binary rounding may give 0.0712)
    df = spark.createDataFrame([(57, 800), (1, 3), (2, 3)], "k long, n long")
    got = [r.x for r in df.select(rounded_ratio(F.col("k"), F.col("n"), 4).alias("x")).collect()]
    assert got == [0.0713, 0.3333, 0.6667]


def test_null_measure_sorts_last(spark):
    rows = [("g", i, float(i)) for i in range(30)] + [("g", 30, None)]
    r = _rank(spark, rows)
    assert r[("g", 30)] == 1.0
    assert r[("g", 29)] == round(30 / 31, 4)


def test_window_and_cdf_paths_agree(spark):
    rnd = random.Random(5)
    rows = []
    for g, n in (("x", 300), ("y", 120), ("z", 45), ("w", 10)):
        for i in range(n):
            v = None if rnd.random() < 0.05 else float(rnd.randint(0, 40))
            rows.append((g, i, v))
    a = _rank(spark, rows, hot_rows=None)
    b = _rank(spark, rows, hot_rows=50)          # x, y go through prefix sums
    assert a == b
    for g in ("x", "y", "z"):
        ids = [i for (gg, i) in a if gg == g]
        vals = [next(v for gg, ii, v in rows if gg == g and ii == i) for i in sorted(ids)]
        assert [a[(g, i)] for i in sorted(ids)] == _cume(vals)


def test_peer_size(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "g string, id int")
    got = {r.id: r.peer_rows for r in peer_size(df, ["g"]).collect()}
    assert got == {1: 2, 2: 2, 3: 1}


def test_two_years_are_not_pooled(spark):
    rows = [(2022, i, float(i)) for i in range(30)] + [(2023, i, float(i + 100)) for i in range(30)]
    df = spark.createDataFrame(rows, "year int, id int, v double")
    out = peer_rank(df, ["year"], {"r": F.col("v")}, hot_rows=None)
    got = {(r.year, r.id): r.r for r in out.collect()}
    assert got[(2023, 0)] == round(1 / 30, 4) and got[(2022, 29)] == 1.0


def test_cdf_matches_numpy_cume(spark):
    rnd = np.random.default_rng(3)
    vals = rnd.integers(0, 500, 2000).astype(float)
    rows = [("g", i, float(v)) for i, v in enumerate(vals)]
    r = _rank(spark, rows, hot_rows=100)
    srt = np.sort(vals)
    for i, v in enumerate(vals[:200]):
        k = int(np.searchsorted(srt, v, side="right"))
        assert r[("g", i)] == ((2 * k * 10000 + 2000) // 4000) / 10000


def test_running_counts_equal_brute_force(spark):
    """Ties, nulls, NaN, signed zeros and values that fill several partitions; the sums per
    partition broadcast or joined."""
    rnd = random.Random(8)
    odd = [None, float("nan"), 0.0, -0.0, 7.0, -3.5, 1e300]
    rows = [(g, rnd.choice(odd) if rnd.random() < 0.6 else float(rnd.randint(0, 30)))
            for g in (0, 3, 9) for _ in range(700)] + [(4, 1.0)] * 900 + [(5, None)] * 3
    df = spark.createDataFrame([(g, v, i) for i, (g, v) in enumerate(rows)],
                               "g long, v double, id long").repartition(5)
    rank = lambda v: (2, 0.0) if v is None else (1, 0.0) if v != v else (0, v)
    for bound, parts in ((5, 11), (None, 7), (5, 1)):
        got = {r.id: (r.g, r.n) for r in running_counts(df, group_bound=bound,
                                                        parts=parts).collect()}
        assert len(got) == len(rows)
        for i, (g, v) in enumerate(rows):
            assert got[i] == (g, sum(h == g and rank(w) <= rank(v) for h, w in rows))
    assert running_counts(df.filter("g > 99")).collect() == []


def test_one_value_is_dealt_over_tasks(spark):
    df = spark.range(30_000).selectExpr(
        "0L AS g", "CASE WHEN id % 3 = 0 THEN 5.0D ELSE cast(id AS double) END AS v", "id")
    sizes = {}
    for r in dealt(df, 8).filter("v = 5.0").groupBy("p").count().collect():
        sizes[r.p] = r["count"]
    assert len(sizes) >= 3 and max(sizes.values()) < 30_000 / 4
    n = {r.n for r in running_counts(df, group_bound=1, parts=8).join(
        df.filter("v = 5.0").select("id"), "id").collect()}
    assert len(n) == 1


def test_hot_ranks_join_on_row_numbers_only(spark):
    df = spark.range(5000).selectExpr("id % 2 AS grp", "cast(id % 50 AS double) AS val", "id")
    out = peer_rank(df, ["grp"], {"r": F.col("val")}, hot_rows=100)
    plan = out._jdf.queryExecution().executedPlan().toString()
    joins = [x for x in plan.splitlines() if "Join" in x]
    assert joins and not any("val" in x for x in joins)
