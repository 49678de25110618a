"""The command-line build and the schema drift report."""

import tempfile

from peerscope import cli
from peerscope.plans.model import fixture_model
from peerscope.schema import PART_B_COLUMNS, PART_B_TYPES
from peerscope.sources import csv as csvsrc

SF = "/root/testdata/sf0.001"


def test_cli_build_reports_and_fails_on_asserted_checks(spark, capsys):
    m = fixture_model(spark, SF)
    base = tempfile.mkdtemp(prefix="peerscope-cli-")
    csvsrc.write_csv(m.raw_b, f"{base}/b")
    csvsrc.write_csv(m.raw_d, f"{base}/d")
    code = cli.main(["--part-b", f"{base}/b", "--part-d", f"{base}/d", "--out", f"{base}/out",
                     "--year", "2023", "--report", f"{base}/report"])
    text = capsys.readouterr().out
    # the fixture's two files name specialties differently, so the asserted cross-file
    # specialty agreement fails and the build exits non-zero
    assert code == 1
    assert "| provider_attributes | specialty_disagreements |" in text and "FAIL" in text
    assert "| fact_part_b_service |" in text
    assert spark.read.text(f"{base}/report").count() > 10


def test_schema_drift(spark):
    m = fixture_model(spark, SF)
    base = tempfile.mkdtemp(prefix="peerscope-drift-")
    csvsrc.write_csv(m.raw_b, f"{base}/b")
    rows = {r.column: r for r in csvsrc.schema_drift(spark, f"{base}/b", PART_B_COLUMNS,
                                                     PART_B_TYPES).collect()}
    assert len(rows) == len(PART_B_COLUMNS)
    # the zero-padded NPI would be inferred as a number: the declared type protects it
    assert rows["Rndrng_NPI"].declared == "string" and rows["Rndrng_NPI"].drift
    assert not rows["Tot_Srvcs"].drift
