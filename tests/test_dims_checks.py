"""Dimensions and build checks on hand-made raw rows."""

import pytest
from pyspark.sql import functions as F

from peerscope.operators.grain import grain_check
from peerscope.plans import checks as C
from peerscope.plans import dims
from peerscope.schema import PART_B_COLUMNS, PART_B_TYPES, PART_D_COLUMNS, PART_D_TYPES


def _raw(spark, columns, types, rows):
    schema = ", ".join(f"{c} {types.get(c, 'string')}" for c in columns)
    full = [tuple(r.get(c) for c in columns) for r in rows]
    return spark.createDataFrame(full, schema)


def raw_b(spark, rows):
    return _raw(spark, PART_B_COLUMNS, PART_B_TYPES, rows)


def raw_d(spark, rows):
    return _raw(spark, PART_D_COLUMNS, PART_D_TYPES, rows)


def b_row(npi, **kw):
    base = {"Rndrng_NPI": npi, "Rndrng_Prvdr_Last_Org_Name": "SMITH", "Rndrng_Prvdr_Type": "NP",
            "Rndrng_Prvdr_City": "BOSTON", "Rndrng_Prvdr_State_Abrvtn": "MA",
            "Rndrng_Prvdr_State_FIPS": "25", "HCPCS_Cd": "99213", "HCPCS_Desc": "Visit",
            "HCPCS_Drug_Ind": "N", "Place_Of_Srvc": "O", "Rndrng_Prvdr_Ent_Cd": "I",
            "Tot_Benes": 11, "Tot_Srvcs": 12.5}
    base.update(kw)
    return base


def d_row(npi, **kw):
    base = {"Prscrbr_NPI": npi, "Prscrbr_Last_Org_Name": "SMITH", "Prscrbr_First_Name": "ANN",
            "Prscrbr_Type": "NP", "Prscrbr_City": "BOSTON", "Prscrbr_State_Abrvtn": "MA",
            "Prscrbr_State_FIPS": "25", "Brnd_Name": "B", "Gnrc_Name": "G", "Tot_Clms": 11}
    base.update(kw)
    return base


def test_dim_provider_merge(spark):
    b = raw_b(spark, [b_row("0000000001", Rndrng_Prvdr_First_Name=None),
                      b_row("0000000002", Rndrng_Prvdr_First_Name="BOB")])
    d = raw_d(spark, [d_row("0000000001", Prscrbr_First_Name="ANN"),
                      d_row("0000000003", Prscrbr_City="SALEM")])
    got = {r.npi: r for r in dims.dim_provider(b, d).collect()}
    assert set(got) == {"0000000001", "0000000002", "0000000003"}
    assert got["0000000001"].first_name == "ANN"          # NULL in B, filled from D
    assert got["0000000001"].in_part_b and got["0000000001"].in_part_d
    assert got["0000000002"].in_part_b and not got["0000000002"].in_part_d
    assert got["0000000003"].city == "SALEM" and not got["0000000003"].in_part_b
    assert got["0000000003"].entity_type is None


def test_dim_geography_categories(spark):
    states = ["MA", "DC", "PR", "FM", "AE", "XX", "QQ"]
    b = raw_b(spark, [b_row(f"{i:010d}", Rndrng_Prvdr_State_Abrvtn=s,
                            Rndrng_Prvdr_State_FIPS=None if s == "XX" else f"{i:02d}")
                      for i, s in enumerate(states)])
    d = raw_d(spark, [d_row("0000000099", Prscrbr_State_Abrvtn="XX", Prscrbr_State_FIPS="99")])
    got = {r.state: r for r in dims.dim_geography(b, d).collect()}
    assert got["DC"].category == "district" and got["PR"].category == "territory"
    assert got["FM"].category == "freely_associated" and got["AE"].category == "military"
    assert got["XX"].category == "unknown" and got["XX"].state_fips == "99"
    assert got["QQ"].category == "state" and got["QQ"].is_us_state      # ELSE branch
    assert got["MA"].is_us_state and not got["DC"].is_us_state


def test_dim_ruca_and_hcpcs(spark):
    b = raw_b(spark, [b_row("1", Rndrng_Prvdr_RUCA="1", Rndrng_Prvdr_RUCA_Desc="Metro"),
                      b_row("2", Rndrng_Prvdr_RUCA="1.0", Rndrng_Prvdr_RUCA_Desc="Metro"),
                      b_row("3", Rndrng_Prvdr_RUCA=None, HCPCS_Cd="J0100",
                            HCPCS_Drug_Ind="Y")])
    ruca = {r.ruca for r in dims.dim_ruca(b).collect()}
    assert ruca == {"1", "1.0"}                          # codes are text: '1' != '1.0'
    h = {r.hcpcs_code: r.is_drug for r in dims.dim_hcpcs(b).collect()}
    assert h == {"99213": False, "J0100": True}


def test_grain_check_counts_duplicates(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1)], "k string, j int")
    r = grain_check(df, ["k", "j"]).collect()[0]
    assert (r.duplicate_keys, r.rows_in_duplicate_keys) == (1, 2)
    r = grain_check(df.filter("k = 'b'"), ["k", "j"]).collect()[0]
    assert (r.duplicate_keys, r.rows_in_duplicate_keys) == (0, 0)


def test_provider_attribute_agreement(spark):
    b = raw_b(spark, [b_row("1", Rndrng_Prvdr_Last_Org_Name=" Boston"),
                      b_row("2", Rndrng_Prvdr_Type="MD"), b_row("2", Rndrng_Prvdr_Type="DO")])
    d = raw_d(spark, [d_row("1", Prscrbr_Last_Org_Name="BOSTON"), d_row("2")])
    r = C.check_provider_attributes(b, d).collect()[0]
    assert r.overlapping_npis == 2
    assert r.part_b_npis_multi_specialty == 1
    assert r.name_disagreements == 1 and r.name_disagreements_normalized == 0


def test_run_checks_status_and_assert(spark):
    ok = spark.createDataFrame([(0, 5)], "duplicate_keys long, rows long")
    bad = spark.createDataFrame([(2, 60)], "duplicate_keys long, states long")
    res = C.run_checks([C.CheckSpec("a", ok, expect_zero=("duplicate_keys",)),
                        C.CheckSpec("b", bad, expect_zero=("duplicate_keys",),
                                    expect_at_most=(("states", 50),))])
    got = {(r.check, r.metric): r.status for r in res.collect()}
    assert got == {("a", "duplicate_keys"): "ok", ("a", "rows"): "info",
                   ("b", "duplicate_keys"): "FAIL", ("b", "states"): "FAIL"}
    with pytest.raises(AssertionError):
        C.assert_checks(res)


def test_metrics_observed_while_writing_equal_those_of_a_scan(spark, tmp_path):
    from dataclasses import replace

    from peerscope.plans.build import build
    from peerscope.plans.checks import run_checks, standard_checks, written_metrics
    from peerscope.plans.model import Model, fixture_model

    m = fixture_model(spark, "/root/testdata/sf0.001")
    res = build(spark, m.raw_b, m.raw_d, str(tmp_path), fact_files=2, run_checks=False)
    names = [n for t in res.tables for n in written_metrics(t)]
    assert set(names) == set(res.observed) and res.observed["peer_stats_rows"] > 0
    model = Model(res.raw_b, res.raw_d)
    model.__dict__.update(fact_b=res.tables["fact_part_b_service"],
                          fact_d=res.tables["fact_part_d_drug"],
                          **{k: v for k, v in res.tables.items() if not k.startswith("fact")})
    scanned = standard_checks(model)
    seen = replace(model, observed=res.observed)
    seen.__dict__.update({k: v for k, v in model.__dict__.items() if k not in seen.__dict__})
    observed = standard_checks(seen)
    assert sorted(run_checks(scanned).collect()) == sorted(run_checks(observed).collect())

    def scans(spec):
        plan = spec.frame._jdf.queryExecution().executedPlan().toString()
        return plan.split("== Initial Plan")[0].count("FileScan")
    fewer = {a.name: (scans(a), scans(b)) for a, b in zip(scanned, observed)}
    assert fewer["reference_dims"][1] < fewer["reference_dims"][0]
    assert fewer["peer_stats"][1] < fewer["peer_stats"][0]
    assert fewer["provider_attributes"] == (2, 2)


def test_small_dimensions_from_one_scan(spark):
    from peerscope.plans import dims
    from peerscope.plans.model import fixture_model

    m = fixture_model(spark, "/root/testdata/sf0.001")
    found = dims.domains(m.raw_b)
    of = {n: found.filter(F.col("_set") == n) for n in dims.DOMAINS}
    for name, make in (("dim_hcpcs", dims.dim_hcpcs), ("dim_ruca", dims.dim_ruca),
                       ("dim_geography", lambda b: dims.dim_geography(b, m.raw_d))):
        assert sorted(make(of[name]).collect(), key=repr) == sorted(
            make(m.raw_b).collect(), key=repr)


def test_write_without_rows_observes_zero(spark, tmp_path):
    from peerscope.sources.parquet import write_sorted
    df = spark.createDataFrame([], "k long, year int")
    for files in (1, 3):
        got = write_sorted(df, f"{tmp_path}/t{files}", ["k"], num_files=files,
                           metrics={"rows": F.count(F.lit(1)), "nulls": F.count_if(
                               F.col("k").isNull())})
        assert got == {"rows": 0, "nulls": 0}
    one = spark.createDataFrame([(1, 5), (None, 5), (2, 6)], "k long, year int")
    assert write_sorted(one, f"{tmp_path}/u", ["k"], num_files=2, metrics={
        "rows": F.count(F.lit(1)), "nulls": F.count_if(F.col("k").isNull())}) == {
            "rows": 3, "nulls": 1}
