"""Command-line build: ``python -m peerscope.cli --part-b B.csv --part-d D.csv --out DIR``.

Runs the two-pass build for one year, prints the report (artifacts and checks) as
Markdown, and exits non-zero when an asserted check fails. The session is whatever
``spark-submit`` / the cluster provides; only a local run creates its own.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F

from peerscope.plans.build import build, build_report, report_markdown
from peerscope.plans.checks import failures
from peerscope.schema import MIN_PEERS, RANK_DECIMALS
from peerscope.session import ensure_checkpoint_dir
from peerscope.sources import footer
from peerscope.sources.csv import read_part_b, read_part_d


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("--part-b", required=True, help="Part B CSV path (file or directory)")
    ap.add_argument("--part-d", required=True, help="Part D CSV path (file or directory)")
    ap.add_argument("--out", required=True, help="output root (one per source variant)")
    ap.add_argument("--year", type=int, required=True)
    ap.add_argument("--min-peers", type=int, default=MIN_PEERS)
    ap.add_argument("--rank-decimals", type=int, default=RANK_DECIMALS)
    ap.add_argument("--report", help="write the Markdown report here as well")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName("peerscope-build").getOrCreate()
    ensure_checkpoint_dir(spark)
    res = build(spark, read_part_b(spark, args.part_b), read_part_d(spark, args.part_d),
                args.out, year=args.year, min_peers=args.min_peers,
                decimals=args.rank_decimals)
    report = build_report(spark, res).collect()
    checks = res.checks.collect()
    # the five biggest columns of each table (a bounded, small list)
    foot = footer.column_footprint(footer.footers(spark, res.tables))
    top = (foot.withColumn("_r", F.row_number().over(
        Window.partitionBy("table").orderBy(F.desc("compressed_bytes"), "column")))
        .filter(F.col("_r") <= 5).drop("_r").orderBy("table", F.desc("compressed_bytes")))
    text = report_markdown([r.asDict() for r in report], [r.asDict() for r in checks],
                           [r.asDict() for r in top.collect()])
    print(text)
    if args.report:
        spark.createDataFrame([(text,)], "report string").coalesce(1) \
            .write.mode("overwrite").text(args.report)
    bad = failures(res.checks).count()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
