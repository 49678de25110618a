"""Typed CSV scans, sorted Parquet layout, footer audit."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from peerscope.sources import csv as csvsrc
from peerscope.sources import footer
from peerscope.sources.parquet import (has_facts, read_table, register_present, table_exists,
                                       write_sorted, write_unsorted)


def _write(text):
    d = tempfile.mkdtemp(prefix="peerscope-test-")
    with open(os.path.join(d, "part.csv"), "w") as fh:
        fh.write(text)
    return d


def test_typed_csv_by_header_name(spark):
    # reordered header, leading zeros, RUCA '1.0', blank Tot_Benes
    path = _write("Tot_Benes,Rndrng_NPI,Rndrng_Prvdr_Zip5,Rndrng_Prvdr_RUCA,Tot_Srvcs\n"
                  ",0012345678,02134,1.0,5.5\n"
                  "12,0000000001,00501,1,7\n")
    df = csvsrc.read_typed_csv(spark, path, ["Rndrng_NPI", "Rndrng_Prvdr_Zip5",
                                             "Rndrng_Prvdr_RUCA", "Tot_Benes", "Tot_Srvcs"],
                               {"Tot_Benes": "bigint", "Tot_Srvcs": "double"})
    rows = sorted(df.collect(), key=lambda r: r.Rndrng_NPI)
    assert rows[1].Rndrng_NPI == "0012345678" and rows[1].Rndrng_Prvdr_Zip5 == "02134"
    assert rows[1].Rndrng_Prvdr_RUCA == "1.0" and rows[0].Rndrng_Prvdr_RUCA == "1"
    assert rows[1].Tot_Benes is None and rows[0].Tot_Benes == 12
    assert rows[1].Tot_Srvcs == 5.5
    assert dict(df.dtypes)["Tot_Benes"] == "bigint"


def test_declared_type_is_an_assertion(spark):
    path = _write("Rndrng_NPI,Tot_Benes\n0000000001,12.5\n")
    df = csvsrc.read_typed_csv(spark, path, ["Rndrng_NPI", "Tot_Benes"], {"Tot_Benes": "bigint"})
    with pytest.raises(Exception):
        csvsrc.type_audit(df).collect()


def test_missing_declared_column_fails(spark):
    path = _write("Rndrng_NPI\n1\n")
    with pytest.raises(ValueError):
        csvsrc.read_typed_csv(spark, path, ["Rndrng_NPI", "Tot_Benes"], {"Tot_Benes": "bigint"})


def test_sorted_layout_prunes_row_groups(spark):
    base = tempfile.mkdtemp(prefix="peerscope-layout-")
    rows = [(2023, f"S{i % 40:02d}", f"C{i % 7}", i, float(i)) for i in range(40000)]
    df = spark.createDataFrame(rows, "year int, specialty string, code string, id int, v double")
    write_sorted(df, f"{base}/sorted", ["specialty", "code", "id"], num_files=4,
                 block_bytes=16 * 1024)
    write_unsorted(df, f"{base}/shuffled", num_files=4, block_bytes=16 * 1024)
    s = read_table(spark, base, "sorted")
    u = read_table(spark, base, "shuffled")
    assert s.count() == u.count() == 40000
    assert dict(s.dtypes)["year"] == "int"
    assert s.filter("year = 2023 and specialty = 'S07'").count() == 1000
    foot = footer.footers(spark, {"sorted": s, "shuffled": u})
    z = {r.table: r for r in footer.zone_map_candidates(foot, "specialty", "S07").collect()}
    assert z["sorted"].candidate_row_groups < z["shuffled"].candidate_row_groups
    assert z["shuffled"].candidate_row_groups == z["shuffled"].row_groups
    a = {r.table: r for r in footer.artifact_stats(foot).collect()}
    assert a["sorted"].rows == 40000
    assert table_exists(spark, f"{base}/sorted") and not table_exists(spark, f"{base}/nope")


def test_pushdown_reaches_the_scan(spark):
    base = tempfile.mkdtemp(prefix="peerscope-push-")
    df = spark.createDataFrame([(2023, "S", "C", 1.0)], "year int, specialty string, code string, v double")
    write_sorted(df, f"{base}/t", ["specialty", "code"], num_files=1)
    q = (read_table(spark, base, "t").filter((F.col("year") == 2023) & (F.col("specialty") == "S"))
         .select("v"))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert "PushedFilters: [IsNotNull(specialty), EqualTo(specialty,S)]" in plan


def test_presence_aware_registration(spark):
    base = tempfile.mkdtemp(prefix="peerscope-reg-")
    df = spark.createDataFrame([("1", 2023)], "npi string, year int")
    write_sorted(df, f"{base}/dim_provider", ["npi"], partition_by=(), num_files=1)
    present = register_present(spark, base, ["dim_provider", "fact_part_b_service"])
    assert present == {"dim_provider": True, "fact_part_b_service": False}
    assert not has_facts(present)
    assert spark.table("dim_provider").count() == 1


def test_files_with_different_headers_are_never_swapped(spark):
    d = tempfile.mkdtemp(prefix="peerscope-test-")
    for name, text in (("a.csv", "id,a,b\n0,1,2\n"), ("b.csv", "id,b,a\n1,20,10\n")):
        with open(os.path.join(d, name), "w") as fh:
            fh.write(text)
    df = csvsrc.read_typed_csv(spark, d, ["id", "a", "b"], {"id": "bigint"})
    with pytest.raises(Exception, match="header"):
        df.collect()


def test_checkpoint_folder_is_never_local_on_a_cluster():
    from types import SimpleNamespace

    from peerscope.session import ensure_checkpoint_dir
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:1")
    session = SimpleNamespace(sparkContext=context,
                              conf=SimpleNamespace(get=lambda key, default=None: default))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(session)


def _rows_like(spark, rows):
    return spark.createDataFrame(rows, "k long, s string, v double, n int").repartition(4)


def test_bag_difference_finds_planted_rows(spark):
    from collections import Counter

    from peerscope.operators.bagdiff import bag_comparison, bag_difference
    rows = [(i % 97, f"s{i % 13}", i / 4.0, None if i % 5 else i % 7) for i in range(3000)]
    rows += [(None, None, None, None)] * 3 + [(1, None, 0.0, None), (None, "x", 1.0, 1)]
    other = rows[5:] + [(500, "new", 1.5, 1)] * 2 + [rows[100]] + [(1, "x", None, None)]
    left, right = _rows_like(spark, rows), _rows_like(spark, other)
    a, b = Counter(rows), Counter(other)
    want = {r: (max(a[r] - b[r], 0), max(b[r] - a[r], 0)) for r in a | b if a[r] != b[r]}
    got = {tuple(r)[:4]: tuple(r)[4:] for r in bag_difference(left, right).collect()}
    assert got == want
    row = bag_comparison(left, right).first()
    assert tuple(row) == (len(rows), len(other), sum(x for x, _ in want.values()),
                          sum(y for _, y in want.values()))
    # a null and its neighbour change places
    x, y = _rows_like(spark, [(None, "7", 1.0, 2)]), _rows_like(spark, [(7, None, 1.0, 2)])
    assert bag_difference(x, y).count() == 2
    none = left.filter("false")
    assert bag_difference(none, none).isEmpty() and bag_comparison(none, none).first()[0] == 0
    assert bag_comparison(left, none).first().only_left == len(rows)


@pytest.mark.parametrize("rows", [100, 100_000])
def test_many_different_rows_are_counted_in_one_reading(spark, tmp_path, monkeypatch, rows):
    """Where hardly a prefix is equal no further level is looked at; few different rows still
    go by prefixes. Both count nulls, copies and signed zeros as one difference does."""
    from peerscope.operators import bagdiff
    monkeypatch.setattr(bagdiff, "COUNT_ROWS", 10_000)
    spark.range(50_000).selectExpr("if(id % 7 = 0, null, id % 100) AS key", "id / 2 AS val").union(
        spark.sql("SELECT 1L, 0.0D")).write.parquet(f"{tmp_path}/a")
    left = spark.read.parquet(f"{tmp_path}/a")
    left.filter(f"val * 2 >= {rows} OR val = 0").selectExpr("key", "if(val = 0, -0.0D, val) AS val") \
        .union(left.filter("val = 24999")).write.parquet(f"{tmp_path}/b")
    right = spark.read.parquet(f"{tmp_path}/b")
    out = bagdiff.bag_difference_now(left, right)
    if rows == 100_000:
        plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
        assert plan.count("FileScan") == 2 and "Join" not in plan and "(__h" in plan
    want = bagdiff.bag_difference(left, right)
    assert out.columns == want.columns and out.exceptAll(want).isEmpty()
    assert want.exceptAll(out).isEmpty() and out.count() == (100 if rows == 100 else 49_998)
    assert out.agg(F.sum("only_left"), F.sum("only_right")).first() == (
        (99, 1) if rows == 100 else (49_998, 0))
    assert bagdiff.bag_difference_now(left, left).isEmpty()
    none = left.filter("false")
    assert bagdiff.bag_difference_now(none, none).isEmpty()


def test_equal_bags_shuffle_fingerprints_only(spark, tmp_path):
    from peerscope.operators.bagdiff import bag_difference
    spark.range(20_000).selectExpr("id % 100 AS key", "id AS val").write.parquet(f"{tmp_path}/a")
    spark.range(20_000).selectExpr("id % 100 AS key", "id AS val").orderBy(
        "key").write.parquet(f"{tmp_path}/b")
    out = bag_difference(spark.read.parquet(f"{tmp_path}/a"), spark.read.parquet(f"{tmp_path}/b"))
    assert out.collect() == []
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    assert "hashpartitioning(key" not in plan and plan.count("FileScan") <= 2
