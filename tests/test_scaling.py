"""Work is dealt in proportion to the input, and inputs that are joins are computed once."""

import pytest
from pyspark.sql import functions as F

from peerscope import fixtures
from peerscope.operators import rank
from peerscope.plans.model import fixture_model
from peerscope.sources import registered

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_partitions_of_the_lines_follow_the_bytes(spark, monkeypatch):
    lineitem = fixtures.load_tables(spark, SF, ("lineitem",))["lineitem"]
    assert fixtures.line_partitions(lineitem) == 1
    monkeypatch.setattr(fixtures, "LINE_BYTES", 4096)
    n = fixtures.line_partitions(lineitem)
    assert n > 8  # beyond the session's shuffle partitions
    _, raw_d = fixtures.raw_inputs(spark, SF)
    for key in ("l_orderkey", "l_partkey", "o_custkey"):
        assert any(f"hashpartitioning({key}#" in line and f", {n})" in line
                   for line in _plan(raw_d).splitlines()), key


def test_lines_with_null_keys_are_left_out(spark, tmp_path):
    rows = {"lineitem": ([(1, 1, 2.0, 5.0, "O"), (None, 1, 1.0, 5.0, "O"),
                          (1, None, 1.0, 5.0, "O"), (2, 1, 1.0, 5.0, "O")],
                         "l_orderkey long, l_partkey long, l_quantity double, "
                         "l_extendedprice double, l_linestatus string"),
            "orders": ([(1, 7), (2, None), (None, 7)], "o_orderkey long, o_custkey long"),
            "part": ([(1, "B", "T"), (None, "B", "T")],
                     "p_partkey long, p_brand string, p_type string"),
            "customer": ([(7, "c", 0, "BUILDING"), (None, "d", 0, "BUILDING")],
                         "c_custkey long, c_name string, c_nationkey int, c_mktsegment string"),
            "nation": ([(0, "N", 0)], "n_nationkey int, n_name string, n_regionkey int")}
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    raw_b, raw_d = fixtures.raw_inputs(spark, str(tmp_path))
    assert [(r.Rndrng_NPI, r.Tot_Srvcs) for r in raw_b.collect()] == [("0000000007", 2.0)]
    assert [(r.Prscrbr_NPI, r.Tot_Clms) for r in raw_d.collect()] == [("0000000007", 1)]


def test_facts_are_not_joined_again_for_each_reading(spark):
    m = fixture_model(spark, SF, min_peers=30)
    for df in (m.fact_b, m.fact_d, m.peer_stats):
        assert "lineitem" not in df._jdf.queryExecution().optimizedPlan().toString()
        assert "l_orderkey" not in _plan(df)
    assert m.kept.raw_b.exceptAll(m.raw_b).isEmpty() and m.raw_d.exceptAll(m.kept.raw_d).isEmpty()


def test_a_side_of_the_csv_inputs_does_not_write_the_other(spark, monkeypatch):
    written = []
    monkeypatch.setattr(registered, "_CACHE", {})
    monkeypatch.setattr(registered.csvsrc, "write_csv", lambda df, path: written.append(df.columns[0]))
    registered._csv_input(spark, SF, "raw_d")
    registered._csv_input(spark, SF, "raw_d")
    assert written == ["Prscrbr_NPI"]


def test_a_csv_input_is_packed(spark, monkeypatch):
    monkeypatch.setattr(registered, "_CACHE", {})
    path = registered._csv_input(spark, SF, "raw_b")
    raw, got = fixture_model(spark, SF).raw_b, registered.csvsrc.read_part_b(spark, path)
    assert got.inputFiles() and all(f.endswith(".csv.gz") for f in got.inputFiles())
    assert got.exceptAll(raw).isEmpty() and raw.exceptAll(got).isEmpty()


@pytest.mark.parametrize("large", [True, False])
def test_large_builds_write_in_turn(spark, tmp_path, monkeypatch, large):
    """Both stagings, and both facts, of a large input are not on their way at a time, and what
    one has shuffled is let go before the next."""
    from peerscope.plans import build as B
    m, seen, ran = fixture_model(spark, SF).kept, [], B._concurrently
    monkeypatch.setattr(B, "IN_TURN_BYTES", 0 if large else 1 << 40)
    monkeypatch.setattr(B, "_concurrently", lambda res, jobs, n: (
        seen.append(sorted(jobs)), ran(res, jobs, n))[1])
    monkeypatch.setattr(B, "release", lambda s: seen.append("release"))
    B.build(spark, m.raw_b, m.raw_d, str(tmp_path), run_checks=False)
    if large:
        assert seen[:4] == [["stage_raw_b"], "release", ["stage_raw_d"], "release"]
        assert seen[-4:] == [["fact_part_d_drug"], "release", ["fact_part_b_service"], "release"]
    else:
        assert seen[:2] == [["stage_raw_b", "stage_raw_d"], "release"]
        assert seen[-2:] == [["fact_part_b_service", "fact_part_d_drug"], "release"]


@pytest.mark.parametrize("per_task", [7, 500_000])
def test_split_ranks_are_dealt_by_the_groups_rows(spark, monkeypatch, per_task):
    monkeypatch.setattr(rank, "SPLIT_ROWS", per_task)
    df = spark.range(300).select((F.col("id") % 2).alias("g"), (F.col("id") % 41).alias("v"), "id")
    ranked = rank.peer_rank(df, ["g"], {"p": F.col("v")}, hot_rows=20)
    if per_task == 7:
        assert f"hashpartitioning(__row" in _plan(ranked) and ", 43)" in _plan(ranked)
    want = rank.peer_rank(df, ["g"], {"p": F.col("v")}, hot_rows=None)
    assert ranked.exceptAll(want).isEmpty() and want.exceptAll(ranked).isEmpty()
