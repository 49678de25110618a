"""Property tests: peer ranks and breakpoints against brute force on random groups."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from peerscope.operators.percentiles import group_percentiles
from peerscope.operators.rank import peer_rank

groups = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c"]),
              st.one_of(st.none(), st.integers(min_value=0, max_value=12))),
    min_size=1, max_size=120)


def _brute(rows, min_peers, decimals=4):
    out = {}
    for g in {g for g, _ in rows}:
        vals = [v for gg, v in rows if gg == g]
        n = len(vals)
        for v in set(vals):
            if n < min_peers:
                out[(g, v)] = None
                continue
            k = n if v is None else sum(1 for x in vals if x is not None and x <= v)
            out[(g, v)] = ((2 * k * 10 ** decimals + n) // (2 * n)) / 10 ** decimals
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=groups, min_peers=st.sampled_from([1, 5, 30]))
def test_rank_strategies_equal_brute_force(spark, rows, min_peers):
    df = spark.createDataFrame([(g, None if v is None else float(v)) for g, v in rows],
                               "g string, v double")
    want = _brute([(g, None if v is None else float(v)) for g, v in rows], min_peers)
    for hot in (None, 3):
        got = peer_rank(df, ["g"], {"r": F.col("v")}, min_peers=min_peers, hot_rows=hot)
        for r in got.collect():
            assert r.r == want[(r.g, r.v)]
            if r.r is not None:
                assert 0 < r.r <= 1


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=groups)
def test_breakpoints_monotone_and_exact(spark, rows):
    df = spark.createDataFrame([(g, None if v is None else float(v)) for g, v in rows],
                               "g string, v double")
    probs = [("p10", 0.1), ("p50", 0.5), ("p99", 0.99)]
    for hot in (None, 3):
        out = {r.g: r for r in group_percentiles(df, ["g"], {"v": F.col("v")}, probs,
                                                 hot_rows=hot).collect()}
        for g, r in out.items():
            vals = [float(v) for gg, v in rows if gg == g and v is not None]
            assert r.v__n_rows == len(vals)
            if not vals:
                continue
            exp = [float(np.percentile(vals, p * 100)) for _, p in probs]
            got = [r.v__p10, r.v__p50, r.v__p99]
            assert got == sorted(got)
            assert np.allclose(got, exp, rtol=1e-12, atol=1e-12)


def test_rounded_ratio_beyond_doubles(spark):
    from peerscope.functions.columns import rounded_ratio
    k, n = 300_000_000_000_001, 900_000_000_000_007
    got = spark.range(1).select(rounded_ratio(F.lit(k), F.lit(n), 4).alias("r")).first().r
    assert got == 0.3333


@pytest.mark.parametrize("text", ["JOSÉ NUÑEZ", "o'neil SMITH-jones", "ÉLODIE d'ångström 3x", ""])
def test_title_case_equals_python(spark, text):
    from peerscope.functions.columns import title_case
    assert spark.range(1).select(title_case(F.lit(text)).alias("t")).first().t == text.title()


def test_key_profile_with_gaps(spark):
    import random

    from peerscope.plans.profile import key_profile
    rng = random.Random(3)
    for width in (2, 7, 1 << 16):
        ordinals = rng.sample(range(-500, 10**12), 200)
        rows = [(o, rng.randint(0, 30)) for o in ordinals]
        keys = [k for _, k in sorted(rows)]
        got = key_profile(spark.createDataFrame(rows, "o long, k long"), "k", "o",
                          width=width).first()
        assert got.descending_steps == sum(a > b for a, b in zip(keys, keys[1:]))
        assert (got.rows, got.min_key, got.max_key) == (200, min(keys), max(keys))


def test_all_failing_metrics_are_reported(spark):
    from peerscope.plans.checks import assert_checks
    rows = [("c", f"m{i}", i + 1, "= 0", "FAIL") for i in range(150)]
    df = spark.createDataFrame(rows, "check string, metric string, value long, "
                                     "expectation string, status string")
    with pytest.raises(AssertionError) as e:
        assert_checks(df)
    assert all(f"c.m{i}=" in str(e.value) for i in range(150))
