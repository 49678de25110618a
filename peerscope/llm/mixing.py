"""Mixing sources to target weights along a time-varying curriculum.

Targets: each source's share of the word budget follows its weight, stops at a multiple of
its own size, and what is cut off goes to the others by weight. Inside a source, documents
are taken in hash order until the target is filled, whole passes first; running sums come in
two levels (hash buckets, then rows of a bucket), so no source meets in one task. Each
source's weight over training time t in [0, 1] is a line; its integral is the source's
cumulative demand, whose inverse turns a document's place in its source into a training
position, and the result is range-sorted by position.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerscope.llm.session import materialised, unused, with_row_key
from peerscope.llm.words import texts_of
from peerscope.operators.joins import join_null_safe

# Weights of the sources by code point (null last), repeating; the budget in
# percent of all sizes; most passes over a source.
WEIGHTS = (3, 1, 2)
BUDGET_PERCENT = 150
MAX_PASSES = 2
#: Slope of each source's weight over time, repeating: falling, flat and rising demand.
SLOPES = (-0.5, 0.0, 0.5)
#: Rows of a hash bucket that one window partition sorts, about.
BUCKET_ROWS = 4096


@F.arrow_udf(T.LongType())
def word_count(text: pa.Array) -> pa.Array:
    return pa.array([len((t or "").encode("utf-8", "surrogatepass").split())
                     for t in texts_of(text)], pa.int64())


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, size) rows -> one row a source: source_size, weight, slope, target.

    In order of 2 * size / weight, a source is full when its fair share of what the fuller
    ones left over reaches its limit; the first one that is not sets everybody else's share.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    every = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = lambda values: F.element_at(
        F.array(*map(F.lit, values)), (F.col("nr") % len(values) + 1).cast("int"))
    limit = F.lit(MAX_PASSES) * F.col("source_size")
    per = (per.withColumn("nr", F.row_number().over(by_name) - 1)
           .withColumn("weight", cycle(WEIGHTS)).withColumn("slope", cycle(SLOPES))
           .withColumn("cap", limit)
           .withColumn("ratio", F.col("cap") / F.col("weight").cast("double"))
           .withColumn("budget", F.sum("source_size").over(every) * F.lit(BUDGET_PERCENT) / 100.0))
    filled = Window.orderBy("ratio", "nr").rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy("ratio", "nr").rowsBetween(0, Window.unboundedFollowing)
    per = per.withColumn(
        "level", (F.col("budget") - F.coalesce(F.sum("cap").over(filled), F.lit(0)))
        / F.sum("weight").over(rest))
    full = F.col("level") >= F.col("ratio")
    share = F.max(F.when(~full, F.col("level"))).over(every)
    return per.select("source", "source_size", "slope", F.when(
        full, F.col("cap").cast("double")).otherwise(share * F.col("weight")).alias("target"))


def inverse_demand(u, slope):
    """The time t at which the demand t + slope * (t^2 - t), the integral of the weight
    1 + slope * (2t - 1), reaches u; for a slope between -1 and 1 it never falls."""
    b = F.lit(1.0) - slope
    bend = F.try_divide(F.sqrt(b * b + F.lit(4.0) * slope * u) - b, F.lit(2.0) * slope)
    return F.when(slope == 0, u).otherwise(bend)


def mix(df: DataFrame, id_col: str = "doc_id", source_col: str = "source",
        text_col: str = "text") -> DataFrame:
    """One row for each row of ``df``: doc_id, source, size, source_size, target, passes
    (whole passes over the source), taken, copies (whole documents nearest to taken) and
    position (of the first copy, 0 to 1; null if nothing is taken), range-sorted by position.

    A null text has size 0 and takes nothing; null is a source of its own, the last one; a
    null id is an id. Documents are in order of a hash of their id, their text and, for rows that
    repeat both, a running number, so that rows of one id are not neighbours. Other columns are
    ignored. An empty table gives an empty result.
    """
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return (_planned(df, id_col, source_col, text_col)
            .repartitionByRange(parts, F.col("position"), F.col("doc_id"))
            .sortWithinPartitions("position", "doc_id"))


def _planned(df: DataFrame, id_col: str, source_col: str, text_col: str,
             *row_key: str) -> DataFrame:
    """The rows of ``mix`` in no order, with the column ``row_key`` of ``df`` (``with_row_key``).
    Equal rows are numbered, which tells them apart: counted first and numbered then, or,
    where they have a key, counted by its partition and numbered inside of each."""
    rows = df.select(
        *row_key, F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        F.coalesce(F.md5(F.col(text_col)), F.lit("")).alias("mark"),
        word_count(F.col(text_col)).alias("size"))
    same = ["doc_id", "source", "mark", "size"]
    if row_key:
        rows = rows.withColumn("part", F.shiftright(F.col(*row_key), 33))
        per = rows.groupBy(*same, "part").agg(F.count("*").alias("n"))
        before = Window.partitionBy(*same).orderBy("part").rowsBetween(
            Window.unboundedPreceding, -1)
        per = per.withColumn("first", F.sum("n").over(before)).filter("first > 0").drop("n")
        own = F.row_number().over(Window.partitionBy(*same, "part").orderBy(*row_key)) - 1
        rows = join_null_safe(rows.withColumn("own", own), per, [*same, "part"], "left")
        rows = rows.withColumn("copy", F.col("own") + F.coalesce("first", F.lit(0))).drop(
            "own", "first", "part")
    else:
        rows = rows.groupBy(*same).agg(F.count("*").alias("n"))
        rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).drop("n")
    identity = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = materialised(rows.withColumn("h", F.md5(F.concat(
        identity, F.lit("|"), "mark", F.lit("|"), F.col("copy").cast("string")))).drop(
        "mark", "copy"))
    n, digits = rows.count(), 0
    while 16 ** digits * BUCKET_ROWS < n:
        digits += 1
    rows = rows.withColumn("b", F.substring("h", 1, digits))
    targets = source_targets(rows)
    buckets = rows.groupBy("source", "b").agg(F.sum("size").alias("bucket_size"))
    before = Window.partitionBy("source").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.select(F.col("source").alias("s"), F.col("b").alias("sb"), F.coalesce(
        F.sum("bucket_size").over(before), F.lit(0)).alias("bucket_before"))
    joined = targets.select(F.col("source").alias("ts"), "source_size", "slope", "target")
    lead = buckets.join(joined, F.col("s").eqNullSafe(F.col("ts"))).drop("ts")
    in_bucket = (Window.partitionBy("source", "b").orderBy("h", "doc_id", "size")
                 .rowsBetween(Window.unboundedPreceding, -1))
    out = (rows.withColumn("own", F.coalesce(F.sum("size").over(in_bucket), F.lit(0)))
           .join(lead, F.col("source").eqNullSafe(F.col("s")) & (F.col("b") == F.col("sb")))
           .withColumn("start", F.col("own") + F.col("bucket_before"))
           .withColumn("goal", F.floor(F.col("target") + 0.5))
           .withColumn("passes", F.when(F.col("source_size") > 0,
                                        F.expr("goal div source_size")).otherwise(0))
           .withColumn("left", F.col("goal") - F.col("passes") * F.col("source_size"))
           .withColumn("part", F.greatest(F.lit(0), F.least(
               F.col("size"), F.col("left") - F.col("start"))))
           .withColumn("taken", F.col("passes") * F.col("size") + F.col("part"))
           .withColumn("copies", F.col("passes") + (
               (2 * F.col("part") >= F.col("size")) & (F.col("part") > 0)).cast("int"))
           .withColumn("u", F.try_divide(
               (2 * F.col("start") + F.col("size")).cast("double"), 2.0 * F.col("goal")))
           .withColumn("position", F.when(F.col("taken") > 0, inverse_demand(
               F.least(F.col("u"), F.lit(1.0)), F.col("slope")))))
    return out.select("doc_id", "source", "size", "source_size", "target", "slope", "goal",
                      "passes", "taken", "copies", "u", "position", *row_key)


def mixed_documents(df: DataFrame, id_col: str = "doc_id", source_col: str = "source",
                    text_col: str = "text") -> DataFrame:
    """The rows of ``df`` in training order, each as often as ``mix`` gives it whole copies
    (rows without copies go). Rows that share a null or repeated id keep their own counts;
    columns may have any names."""
    row, identity, copy, position = unused(df, "__row", "__id", "__copy", "__position")
    rows = with_row_key(df, row)
    plan = _planned(rows, id_col, source_col, text_col, row).filter("copies > 0").select(
        row, F.col("doc_id").alias(identity),
        F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias(copy),
        "u", "slope", "source_size", "goal")
    place = inverse_demand(F.least(F.lit(1.0), F.col("u") + F.col(copy) * F.col("source_size")
                                   / F.col("goal")), F.col("slope"))
    plan = plan.select(row, identity, copy, place.alias(position))
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return (rows.join(plan, row)
            .repartitionByRange(parts, F.col(position), F.col(identity))
            .sortWithinPartitions(position, identity, row, copy).select(*df.columns))
