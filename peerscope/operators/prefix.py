"""Running counts of very large groups by prefix sums over range partitions.

A window ranks a group in one task. Here the rows of hot groups are dealt by ranges of
(group, value), with a hash behind the value, so that even one value that holds most of a
group is cut into partitions of even size:

1. every partition sums up each group that it holds: rows, first and last value, and the rows
   of these two values (a few numbers, whatever the partition's size);
2. from these, a window over partitions gives what a partition must add: the rows of its
   groups in earlier partitions, and the rows in later ones that equal its last value;
3. each partition is read once more, in order, and its local counts are carried on.

The dealt rows are written to the checkpoint folder, so both readings, and any recomputation
after an executor loss, see the same partitions. There is no sketch, and no join on values.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peerscope.operators.joins import broadcast_if_small, can_broadcast
from peerscope.session import ensure_checkpoint_dir

# The counting functions run in Python workers; shipped by value, executors need no package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_SUMMARY = ("p int, g long, rows long, first long, first_rows long, last long, last_rows long, "
            "first_null boolean, last_null boolean")
_COUNTED = "id long, g long, n long"


def _bits(batch):
    """Values as integers that are equal when the values are (NaN included), and null flags."""
    values = batch["v"]
    empty = values.is_null().to_numpy(zero_copy_only=False)
    x = values.fill_null(0.0).to_numpy(zero_copy_only=False) + 0.0
    bits = np.where(np.isnan(x), np.nan, x).view(np.int64)
    return np.where(empty, 0, bits), empty


def _runs(p, g, bits, empty):
    """Starts of runs of equal (partition, group, value), and of groups, in sorted columns."""
    new_group = np.concatenate(([True], (g[1:] != g[:-1]) | (p[1:] != p[:-1])))
    new_value = np.concatenate(([True], (bits[1:] != bits[:-1]) | (empty[1:] != empty[:-1])))
    return np.flatnonzero(new_group | new_value), new_group


def _summaries(batches):
    """One row for each group of the partition."""
    out, now = [], None
    for batch in batches:
        if not len(batch):
            continue
        p, g = batch["p"].to_numpy(), batch["g"].to_numpy()
        bits, empty = _bits(batch)
        starts, _ = _runs(p, g, bits, empty)
        lengths = np.diff(np.append(starts, len(g)))
        for s, rows in zip(starts.tolist(), lengths.tolist()):
            run = (int(bits[s]), bool(empty[s]))
            if now is None or (now["p"], now["g"]) != (p[s], g[s]):
                if now:
                    out.append(now)
                now = {"p": int(p[s]), "g": int(g[s]), "rows": 0, "first": run[0], "first_null": run[1],
                       "first_rows": 0, "last": run[0], "last_null": run[1], "last_rows": 0}
            if run != (now["last"], now["last_null"]):
                now |= {"last": run[0], "last_null": run[1], "last_rows": 0}
            now["rows"] += rows
            now["last_rows"] += rows
            if run == (now["first"], now["first_null"]):
                now["first_rows"] += rows
    if now:
        out.append(now)
    yield pa.RecordBatch.from_pylist(out, pa.schema([
        ("p", pa.int32()), ("g", pa.int64()), ("rows", pa.int64()), ("first", pa.int64()),
        ("first_rows", pa.int64()), ("last", pa.int64()), ("last_rows", pa.int64()),
        ("first_null", pa.bool_()), ("last_null", pa.bool_())]))


def _counts(batches):
    """(id, g, n): how many rows of the group have this value or a lower one. Rows wait only
    until the run of their value ends."""
    schema = pa.schema([("id", pa.int64()), ("g", pa.int64()), ("n", pa.int64())])
    waiting: list = []  # ids of the last run
    run = None  # (p, g, bits, empty) of it
    before = add = tail = 0  # rows of the group before the run; what the partition adds

    def ended(last):
        ids = np.concatenate(waiting)
        n = before + len(ids) + add + (tail if last else 0)
        return pa.record_batch([pa.array(ids), pa.array(np.full(len(ids), run[1])),
                                pa.array(np.full(len(ids), n))], schema=schema)

    for batch in batches:
        if not len(batch):
            continue
        p, g, ids = (batch[c].to_numpy() for c in ("p", "g", "id"))
        carried, later = batch["carried"].to_numpy(), batch["later"].to_numpy()
        bits, empty = _bits(batch)
        starts, new_group = _runs(p, g, bits, empty)
        stops = np.append(starts[1:], len(g))
        opening = (int(p[0]), int(g[0]), int(bits[0]), bool(empty[0]))
        at = 0
        if run is not None and run == opening:  # the waiting run goes on
            waiting.append(ids[:stops[0]])
            at = 1
        if at < len(starts):
            s = starts[at:]
            if run is not None:
                other = (p[s[0]], g[s[0]]) != run[:2]
                yield ended(other)
                before = 0 if other else before + sum(map(len, waiting))
            # all runs of this batch but its last one end here
            lengths = (stops - starts)[at:]
            seen = np.cumsum(lengths)
            opens = new_group[s].copy()
            opens[0] = run is None or (p[s[0]], g[s[0]]) != run[:2]
            base = np.where(opens, seen - lengths, 0)
            base = np.maximum.accumulate(base)  # rows of this batch before the group
            own = np.cumsum(opens) > 0  # the group began here
            ahead = seen - lengths - base + np.where(own, 0, before)
            closes = np.append(opens[1:], False)
            n = ahead + lengths + carried[s] + np.where(closes, later[s], 0)
            if len(s) > 1:
                done = slice(s[0], s[-1])
                yield pa.record_batch([
                    pa.array(ids[done]), pa.array(g[done]),
                    pa.array(np.repeat(n[:-1], lengths[:-1]))], schema=schema)
            run = (int(p[s[-1]]), int(g[s[-1]]), int(bits[s[-1]]), bool(empty[s[-1]]))
            waiting, before = [ids[s[-1]:]], int(ahead[-1])
            add, tail = int(carried[s[-1]]), int(later[s[-1]])
    if run is not None:
        yield ended(True)


def dealt(rows: DataFrame, parts: int) -> DataFrame:
    """``rows`` (g long, v double, id long) sorted by (g, v), nulls last, and cut into ``parts``
    ranges of even size, with the number of the partition as ``p``; written once."""
    ensure_checkpoint_dir(rows.sparkSession)
    v = F.col("v").asc_nulls_last()
    return rows.select("g", F.when(F.col("v") == 0, F.lit(0.0)).otherwise(F.col("v")).alias("v"),
                       "id") \
        .repartitionByRange(parts, "g", v, F.xxhash64("id")).sortWithinPartitions("g", v) \
        .withColumn("p", F.spark_partition_id()).checkpoint(eager=True)


def carries(ranged: DataFrame) -> DataFrame:
    """(p, g, carried, later) of dealt rows: the group's rows in earlier partitions, and its rows
    in later partitions whose value is the last one of this partition."""
    sums = ranged.select("p", "g", "v").mapInArrow(_summaries, _SUMMARY)
    by_group = Window.partitionBy("g").orderBy("p")
    sums = sums.withColumn("carried", F.coalesce(
        F.sum("rows").over(by_group.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # the first and the last value of each partition meet those of other partitions
    end = lambda bits, none, rows, is_last: F.struct(
        F.col(bits).alias("bits"), F.col(none).alias("none"), rows.alias("rows"),
        F.lit(is_last).alias("is_last"))
    ends = sums.select("p", "g", "carried", F.inline(F.array(
        end("first", "first_null", F.col("first_rows"), False),
        end("last", "last_null", F.lit(0).cast("long"), True))))
    same = Window.partitionBy("g", "none", "bits").orderBy("p", "is_last") \
        .rowsBetween(1, Window.unboundedFollowing)
    ends = ends.withColumn("later", F.coalesce(F.sum("rows").over(same), F.lit(0)))
    return ends.filter("is_last").select("p", "g", "carried", "later")


def running_counts(rows: DataFrame, *, group_bound: int | None = None,
                   parts: int | None = None) -> DataFrame:
    """(id, g, n) for each of ``rows`` (g long, v double, id long): how many rows of its group g
    have a value up to v; nulls come last and count all rows. ``group_bound``: a proven upper
    bound of the number of groups, which decides whether the sums per partition are broadcast."""
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = dealt(rows, parts)
    bound = None if group_bound is None else group_bound + parts
    sums = broadcast_if_small(carries(ranged), bound, row_bytes=48)
    met = ranged.join(sums, ["p", "g"])
    if not can_broadcast(bound, 48):  # a shuffle join: put the partitions in order again
        met = met.repartition(parts, "p").sortWithinPartitions(
            "p", "g", F.col("v").asc_nulls_last())
    return met.select("p", "g", "v", "id", "carried", "later").mapInArrow(_counts, _COUNTED)
