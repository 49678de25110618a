"""Sets of identifiers as bits.

An identifier of decimal digits is a number; numbers fall into buckets of 32,768, and a
bucket's members are the bits of one bitmap. Sets are counted, united and compared bucket by
bucket, so several sets meet in one small row per bucket instead of one row per identifier,
and no row is expanded for another column. Identifiers that are not plain numbers (leading
zeros apart, which must give one length) are compared as strings, so all counts are exact.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Digits of an identifier that is kept as a bit; a National Provider Identifier has ten.
DIGITS = 10


def number_of(identifier: Column, digits: int = DIGITS) -> Column:
    """The number that a string of exactly ``digits`` decimal digits is, else null."""
    return F.when(identifier.rlike(f"^[0-9]{{{digits}}}$"), identifier.cast("bigint"))


def bitmaps(df: DataFrame, column: str, digits: int = DIGITS) -> tuple[DataFrame, DataFrame]:
    """(bucket, bits) of the identifiers in ``column``, and the distinct other strings (other).
    Nulls are no members. Bits are set on the map side; in a file sorted by identifier a task
    meets few buckets, and what is shuffled is mostly zeros."""
    ids = df.select(F.col(column).cast("string").alias("other")).withColumn(
        "number", number_of(F.col("other"), digits))
    bits = ids.filter("number IS NOT NULL").groupBy(
        F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))
    return bits, ids.filter("number IS NULL AND other IS NOT NULL").select("other").distinct()


def distinct_count(df: DataFrame, column: str, name: str, digits: int = DIGITS) -> DataFrame:
    """One row: the number of distinct identifiers in ``column``, as ``name``."""
    bits, other = bitmaps(df, column, digits)
    counts = bits.select(F.bitmap_count("bits").alias("n")).union(
        other.select(F.lit(1).cast("long")))
    return counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias(name))


def set_counts(sets: dict[str, tuple[DataFrame, str]], digits: int = DIGITS) -> DataFrame:
    """One row for sets a and b (name -> (frame, column)): the members of each (``<name>``), of
    both (``both``), and of one only (``<name>_only``)."""
    (a, (left, left_col)), (b, (right, right_col)) = sets.items()
    parts = []
    for name, (df, column) in ((a, (left, left_col)), (b, (right, right_col))):
        bits, other = bitmaps(df, column, digits)
        parts.append((bits.withColumn("side", F.lit(name)), other.withColumn("side", F.lit(name))))
    mine = lambda name, n: F.sum(F.when(F.col("side") == name, n)).alias(name)
    bits = reduce(DataFrame.unionByName, [p[0] for p in parts]).groupBy("bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("bits")).alias("any"),
        mine(a, F.bitmap_count("bits")), mine(b, F.bitmap_count("bits")))
    other = reduce(DataFrame.unionByName, [p[1] for p in parts]).groupBy("other").agg(
        F.lit(1).cast("long").alias("any"), mine(a, F.lit(1)), mine(b, F.lit(1)))
    whole = bits.drop("bucket").unionByName(other.drop("other"))
    total = whole.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("any", a, b)])
    return total.select(a, b, (F.col(a) + F.col(b) - F.col("any")).alias("both"),
                        (F.col("any") - F.col(b)).alias(f"{a}_only"),
                        (F.col("any") - F.col(a)).alias(f"{b}_only"))
