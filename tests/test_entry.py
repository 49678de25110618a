"""Driver contract: entry(), queries(), oracle_sql(), plus a DuckDB spot check."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E

SMOKE = "/root/testdata/sf0.001"
TABLES = ["nation", "customer", "part", "orders", "lineitem"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:7] == ["dataset", "specialty", "code", "place_of_service", "measure",
                              "n_providers", "n_rows"]


def test_every_oracle_has_a_query():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 80
    assert {k for k in q if not k.startswith(("op", "pipeline"))} <= set(o)


@pytest.mark.parametrize("name", ["peer_stats", "fact_part_d_drug", "dim_provider",
                                  "check_peer_stats", "outliers_drug", "peer_rank_hot"])
def test_matches_oracle_at_smoke_scale(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    got = E.queries()[name](spark, SMOKE).toPandas()
    want = con.sql(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)

    def norm(df):
        out = []
        for rec in df[cols].astype(object).itertuples(index=False):
            out.append(tuple(None if (v is None or v is pd.NA or v != v) else
                             (int(v) if isinstance(v, float) and v.is_integer() else v)
                             for v in rec))
        return sorted(out, key=repr)
    assert norm(got) == norm(want)
