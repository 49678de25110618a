"""Layout audit from Parquet footers, as a Spark job over a file list.

The footer of each file is read by a task (``mapInPandas`` + pyarrow), yielding one row per
(file, row group, column) with sizes and min/max statistics. Everything after that is
ordinary aggregation: bytes per column and their share of the table, row groups per table,
and zone-map candidates (row groups whose [min, max] cannot exclude a value).
Only the file list (one path per file) is built on the driver.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The footer reader runs in Python workers. Ship it by value (it imports what it needs
# inside), so executors do not need this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FOOTER_SCHEMA = ("table string, file string, row_group int, rg_rows long, column string, "
                 "compressed_bytes long, uncompressed_bytes long, min_str string, "
                 "max_str string, min_num double, max_num double")


def _read_footers(batches):
    import pandas as pd
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    def num(x):
        try:
            return float(x)
        except (TypeError, ValueError):
            return None

    for pdf in batches:
        rows = []
        for table, path in zip(pdf["table"], pdf["file"]):
            fs, p = pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)
            with fs.open_input_file(p) as fh:
                md = pq.ParquetFile(fh).metadata
                for g in range(md.num_row_groups):
                    rg = md.row_group(g)
                    for c in range(rg.num_columns):
                        col = rg.column(c)
                        st = col.statistics
                        has = st is not None and st.has_min_max
                        mn = st.min if has else None
                        mx = st.max if has else None
                        rows.append((table, path, g, rg.num_rows, col.path_in_schema,
                                     col.total_compressed_size, col.total_uncompressed_size,
                                     None if mn is None else str(mn),
                                     None if mx is None else str(mx), num(mn), num(mx)))
        yield pd.DataFrame(rows, columns=["table", "file", "row_group", "rg_rows", "column",
                                          "compressed_bytes", "uncompressed_bytes", "min_str",
                                          "max_str", "min_num", "max_num"])


def footers(spark: SparkSession, tables: dict) -> DataFrame:
    """tables: name -> DataFrame read from Parquet. One row per (file, row group, column)."""
    files = [(name, f) for name, df in tables.items() for f in sorted(df.inputFiles())]
    n = max(1, min(len(files), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    listing = spark.createDataFrame(files, "table string, file string").repartition(n)
    return listing.mapInPandas(_read_footers, FOOTER_SCHEMA)


def artifact_stats(foot: DataFrame) -> DataFrame:
    """Per table: files, row groups, rows and compressed bytes."""
    rg = foot.select("table", "file", "row_group", "rg_rows").distinct()
    a = rg.groupBy("table").agg(F.count_distinct("file").alias("files"),
                                F.count(F.lit(1)).alias("row_groups"),
                                F.sum("rg_rows").alias("rows"))
    b = foot.groupBy("table").agg(F.sum("compressed_bytes").alias("bytes"))
    return a.join(b, "table").orderBy("table")


def column_footprint(foot: DataFrame) -> DataFrame:
    """Compressed bytes per column and share of its table, biggest first."""
    per = foot.groupBy("table", "column").agg(
        F.sum("compressed_bytes").alias("compressed_bytes"),
        F.sum("uncompressed_bytes").alias("uncompressed_bytes"))
    tot = F.sum("compressed_bytes").over(Window.partitionBy("table"))
    return (per.withColumn("share", F.round(F.col("compressed_bytes") / tot, 4))
            .orderBy("table", F.desc("compressed_bytes"), "column"))


def zone_map_candidates(foot: DataFrame, column: str, value) -> DataFrame:
    """Row groups whose [min, max] of ``column`` cannot exclude ``value`` vs all."""
    c = foot.filter(F.col("column") == column)
    if isinstance(value, (int, float)):
        hit = (F.col("min_num") <= value) & (F.col("max_num") >= value)
    else:
        hit = (F.col("min_str") <= F.lit(value)) & (F.col("max_str") >= F.lit(value))
    # a row group without statistics can never be skipped
    hit = hit | F.col("min_str").isNull()
    return (c.groupBy("table")
            .agg(F.count_distinct(F.when(hit, F.struct("file", "row_group")))
                 .alias("candidate_row_groups"),
                 F.count_distinct(F.struct("file", "row_group")).alias("row_groups"))
            .orderBy("table"))


def projection_footprint(foot: DataFrame, columns) -> DataFrame:
    """Bytes a projection of ``columns`` reads against ``SELECT *``."""
    sel = F.col("column").isin(*columns)
    return (foot.groupBy("table")
            .agg(F.sum(F.when(sel, F.col("compressed_bytes"))).alias("projected_bytes"),
                 F.sum("compressed_bytes").alias("all_bytes"))
            .withColumn("ratio", F.round(F.col("all_bytes") / F.col("projected_bytes"), 2)))
