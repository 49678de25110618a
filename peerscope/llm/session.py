"""Cutting lineage with reliable checkpoints in the folder the session names."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder of ``spark.checkpoint.dir``; only a local session without one gets a
    temporary folder of its own."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    named = sc.getConf().get("spark.checkpoint.dir")
    if named is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="checkpoint-")
    sc.setCheckpointDir(named)


def materialised(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read from there: computed once,
    the same rows for every later use, and safe when executors are lost."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path under the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4()}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that nothing reads any more, in whatever store it is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def with_row_key(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``df`` with a number of its own for every row in column ``name``, written once to the
    shared checkpoint folder, so that every later use sees the same numbers."""
    path = path or scratch_folder(df.sparkSession, "rows")
    df.withColumn(name, F.monotonically_increasing_id()).write.option(
        "compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle and checkpoint files of plans that nothing refers to any
    more; it notices them when the driver collects its garbage, which may be long after."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def unused(df: DataFrame, *names: str) -> list[str]:
    """These names, or longer ones where the table has columns of that name (in any case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
