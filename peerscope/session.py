"""Session helpers: one place that knows how a session is configured.

On a cluster the session is created by the platform and already names a shared
``spark.checkpoint.dir``; every helper here *reads* that setting. Only when it is unset
(local tests, the bench harness) do we create a scratch folder of our own.
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Conf defaults for a session we create ourselves (tests, bench). A cluster session keeps
# whatever its operator configured; we never override those.
LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "peerscope", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's shared checkpoint folder, creating a local one only if unset."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions expose no SparkContext
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc is not None:
            sc.setCheckpointDir(configured)
            return sc.getCheckpointDir() or configured
        return configured
    if sc is not None and (not sc.master.startswith("local")
                           or sc.master.startswith("local-cluster")):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    # Local sessions only: nothing configured a shared folder, so take a fresh one.
    local = tempfile.mkdtemp(prefix="peerscope-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", local)
    if sc is not None:
        sc.setCheckpointDir(local)
        return sc.getCheckpointDir() or local
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder, for intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/peerscope-{name}-{uuid.uuid4().hex[:12]}"


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs that nothing refers to any more. It
    notices them when the driver collects its garbage, which may be long after, and until then
    they add up on the executors' disks."""
    gc.collect()
    try:
        spark.sparkContext._jvm.System.gc()
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no JVM gateway
        pass


def staged(df: DataFrame, path: str, partition_by=()) -> DataFrame:
    """``df`` written to ``path``, a folder of its own, and read from there."""
    df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def _hadoop(spark: SparkSession, path: str):
    """(file system, path, class of paths) of the session's Hadoop configuration."""
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(sc._jsc.hadoopConfiguration()), at, sc._jvm.org.apache.hadoop.fs.Path


def remove_staged(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more, in whatever store it is."""
    fs, at, _ = _hadoop(spark, path)
    fs.delete(at, True)


def replace_partitions(spark: SparkSession, path: str, table: str, depth: int) -> None:
    """Put the partition directories under ``path``, ``depth`` levels down, in the place of a
    table's own, as the commit of a dynamic overwrite does: other partitions stay, and nothing is
    written again. Both lie in one file system."""
    fs, new, Path = _hadoop(spark, path)
    for part in fs.globStatus(Path(new, "/".join(["*=*"] * depth))):
        names, at = [], part.getPath()
        for _ in range(depth):
            names.insert(0, at.getName())
            at = at.getParent()
        to = Path(f"{table}/{'/'.join(names)}")
        fs.delete(to, True)
        fs.mkdirs(to.getParent())
        if not fs.rename(part.getPath(), to):
            raise OSError(f"{part.getPath()} could not be renamed to {to}")
