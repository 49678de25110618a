"""Parquet sources and sinks: year-partitioned, range-sorted, zstd.

The physical layout is the main lever for the serving queries: rows of one peer group are
contiguous, so a filter on (specialty, code) touches a few row groups (min/max statistics)
and the ``year=`` directory prunes whole years.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Row groups small enough that one peer group spans a few of them, large enough to keep
# per-group overhead low.
DEFAULT_BLOCK_BYTES = 32 * 1024 * 1024
# Staged (zstd) bytes of raw input for each range partition of a fact: some hundred thousand rows,
# which a task sorts once for every rank and once for the write.
FACT_BYTES = 8 * 1024 * 1024


def write_sorted(df: DataFrame, path: str, sort_keys, *, partition_by=("year",),
                 num_files: int | None = None, block_bytes: int = DEFAULT_BLOCK_BYTES,
                 mode: str = "overwrite", prepartitioned: bool = False,
                 metrics: dict[str, Column] | None = None) -> dict[str, int]:
    """Range-partition on (partition cols, sort keys), sort within partitions and write
    zstd Parquet under ``<path>/year=<y>/``.

    Each output file holds one key range, so files and row groups have tight, disjoint
    min/max statistics. Overwrite is dynamic: rewriting one year keeps the others.

    ``metrics``, counts by name, are taken of the rows as they are written and returned, so
    that no one has to read the table again for them. They stand behind the last exchange, in
    the writing tasks, where a task that is run again counts once.
    """
    keys = [*partition_by, *sort_keys]
    spark = df.sparkSession
    if prepartitioned:
        # the producer already range-partitioned on a prefix of ``keys``
        out = df.sortWithinPartitions(*keys)
    else:
        n = num_files or int(spark.conf.get("spark.sql.shuffle.partitions"))
        out = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    seen = Observation() if metrics else None
    if seen is not None:
        out = out.observe(seen, *[c.alias(name) for name, c in metrics.items()])
    w = (out.write.mode(mode)
         .option("compression", "zstd")
         .option("parquet.block.size", str(block_bytes))
         .option("partitionOverwriteMode", "dynamic"))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    # nothing is observed of an empty table
    return {} if seen is None else {name: seen.get.get(name) or 0 for name in metrics}


def write_unsorted(df: DataFrame, path: str, *, partition_by=("year",), seed: int = 7,
                   num_files: int | None = None, block_bytes: int = DEFAULT_BLOCK_BYTES
                   ) -> None:
    """Control copy for the layout audit: same rows, random order."""
    spark = df.sparkSession
    n = num_files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = df.repartition(n).sortWithinPartitions(F.rand(seed))
    w = (out.write.mode("overwrite").option("compression", "zstd")
         .option("parquet.block.size", str(block_bytes)))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def _hadoop_fs(spark: SparkSession, path: str):
    """(filesystem, path) through the session's Hadoop configuration, or None when the
    session has no JVM gateway (Spark Connect)."""
    try:
        jvm = spark.sparkContext._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath
    except Exception:  # noqa: BLE001
        return None


def partitions_for(spark: SparkSession, path: str, target_bytes: int = 256 * 1024 * 1024,
                   minimum: int | None = None) -> int:
    """Partition count that gives about ``target_bytes`` of (compressed) input per task,
    from the filesystem's content summary of ``path`` (a metadata call)."""
    floor = minimum or int(spark.conf.get("spark.sql.shuffle.partitions"))
    fs = _hadoop_fs(spark, path)
    if fs is None:
        return floor
    size = fs[0].getContentSummary(fs[1]).getLength()
    return max(floor, -(-int(size) // target_bytes))


def input_bytes(df: DataFrame) -> int | None:
    """Bytes of all files that ``df`` reads, or None without a JVM gateway."""
    size = 0
    for file in df.inputFiles():
        fs = _hadoop_fs(df.sparkSession, file)
        if fs is None:
            return None
        size += int(fs[0].getContentSummary(fs[1]).getLength())
    return size


def input_partitions(df: DataFrame, target_bytes: int) -> int:
    """``partitions_for`` over all files that ``df`` reads."""
    floor = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(floor, -(-(input_bytes(df) or 0) // target_bytes))


def read_table(spark: SparkSession, base: str, table: str, schema: str | None = None
               ) -> DataFrame:
    """Hive-partitioned scan with partition discovery; ``year`` comes from the path. With
    ``schema``, a folder without files is an empty table."""
    reader = spark.read.option("basePath", f"{base}/{table}")
    return (reader.schema(schema) if schema else reader).parquet(f"{base}/{table}")


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` holds any file, via the cluster's Hadoop filesystem (or, without a
    JVM gateway, by resolving a Parquet scan of it)."""
    fs = _hadoop_fs(spark, path)
    if fs is not None:
        return bool(fs[0].exists(fs[1]))
    try:
        spark.read.parquet(path).schema
        return True
    except Exception:  # noqa: BLE001
        return False


def register_present(spark: SparkSession, base: str, tables) -> dict:
    """Register a temp view for each table that exists; return {table: present}."""
    present = {}
    for t in tables:
        ok = table_exists(spark, f"{base}/{t}")
        if ok:
            read_table(spark, base, t).createOrReplaceTempView(t)
        present[t] = ok
    return present


def has_facts(present: dict) -> bool:
    return all(present.get(t) for t in ("fact_part_b_service", "fact_part_d_drug",
                                        "dim_provider"))
