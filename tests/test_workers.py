"""Python-worker code must not depend on the package being importable on executors."""

import os
import subprocess
import sys
import tempfile
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_footer_reader_runs_without_package_on_workers():
    work = tempfile.mkdtemp(prefix="peerscope-worker-")
    script = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {REPO!r})
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[2]")
                 .config("spark.ui.enabled", "false").getOrCreate())
        from peerscope.sources import footer
        spark.range(1000).withColumnRenamed("id", "k").write.parquet({work!r} + "/t")
        t = spark.read.parquet({work!r} + "/t")
        rows = footer.artifact_stats(footer.footers(spark, {{"t": t}})).collect()
        assert rows[0]["rows"] == 1000, rows
        print("OK")
    """)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", script], cwd=work, env=env,
                         capture_output=True, text=True, timeout=600)
    assert "OK" in out.stdout, out.stderr[-3000:]
