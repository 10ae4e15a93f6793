"""Exact distinct counts and sums over sets of orders as mergeable bitmap states.

Orders get dense numbers, sorted by the attributes they are sliced by, so a slice
lies in few buckets of 32,768 numbers.  Two kinds of state, one 4 KB bitmap per
group and bucket:

* a *set* (:func:`order_sets`): the orders that a group touches.  Sets of several
  groups merge by OR; an order that spans groups is still counted once.
* a *bit slice* (:func:`bit_slices`): the orders whose measure has bit b set.  The
  sum of a measure over any set of orders is the sum over b of 2^b times the number
  of orders in both.

Making them moves each row once, to its bucket; merging moves bitmaps, never orders.  Size: at most
groups x (orders / 32,768 + 1) bitmaps of 4 KB for each kind, and a bucket that
holds few orders compresses to little more than those.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dense_numbers(rows: DataFrame, write, order_by: Sequence[str], out: str = "number") -> DataFrame:
    """``rows`` with numbers from 1 without gaps, rising with ``order_by``.

    The rows are range-partitioned and written once (``write`` returns the table
    read back) with their place inside their range; the ranges' sizes, one row per
    range, give what lies before each.  ``order_by`` should end in a unique key:
    rows that are equal in it share a range."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the low 33 bits of a monotonic id are the row's place in its partition
    placed = (rows.repartitionByRange(n, *order_by).sortWithinPartitions(*order_by)
              .withColumn("_at", F.monotonically_increasing_id()))
    mask = (1 << 33) - 1
    written = write(placed.withColumn("_range", F.shiftrightunsigned("_at", 33))
                    .withColumn("_at", F.col("_at").bitwiseAND(F.lit(mask))))
    sizes = written.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (written.join(starts, "_range")
            .withColumn(out, F.col("_before") + F.col("_at") + 1).drop("_range", "_at", "_before"))


def _by_bucket(rows: DataFrame, number: str, *columns) -> DataFrame:
    """The ``columns`` and number of the rows of each bucket in one task.  A bucket has at
    most 32,768 orders; combined where they are, tasks that each hold a few orders of every
    bucket would each make a bitmap per group and bucket."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.select(*columns, number, F.bitmap_bucket_number(number).alias("bucket"))
            .repartition(max(1, n), "bucket"))


def order_sets(rows: DataFrame, keys: Sequence[str], number: str = "number") -> DataFrame:
    """The orders of each group as bitmaps (keys, bucket, bits)."""
    return (_by_bucket(rows.where(F.col(number).isNotNull()), number, *keys)
            .groupBy(*keys, "bucket")
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col(number))).alias("bits")))


def bit_slices(rows: DataFrame, keys: Sequence[str], measures: dict[str, Column],
               number: str = "number") -> DataFrame:
    """Whole-number measures of orders as bit slices (keys, name, weight, bucket,
    bits); a negative value is kept as its size under a negative weight.  A row
    must be the only one of its order and keys."""
    named = F.array(*[F.struct(F.lit(n).alias("name"), F.col(f"_m{i}").alias("value"))
                      for i, n in enumerate(measures)])
    placed = _by_bucket(rows.where(F.col(number).isNotNull()), number, *keys,
                        *[c.cast("long").alias(f"_m{i}") for i, c in enumerate(measures.values())])
    # the bits up to the size's highest
    bits = F.sequence(F.lit(0), F.length(F.bin("_size")) - 1)
    return (placed.select(*keys, number, "bucket", F.explode(named).alias("m"))
            .where(F.col("m.value") != 0)
            .select(*keys, number, "bucket", F.col("m.name").alias("name"),
                    F.signum(F.col("m.value")).cast("long").alias("_sign"),
                    F.abs(F.col("m.value")).alias("_size"))
            .select("*", F.explode(bits).alias("_bit")).where(F.getbit("_size", "_bit") == 1)
            .withColumn("weight", F.col("_sign") * F.expr("shiftleft(1L, _bit)"))
            .groupBy(*keys, "name", "weight", "bucket")
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col(number))).alias("bits")))


def union_sets(sets: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sets merged into those of coarser groups (by, bucket, bits)."""
    return sets.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def count_sets(sets: DataFrame, by: Sequence[str], out: str = "n") -> DataFrame:
    """Distinct orders per group of merged sets (one bitmap per group and bucket)."""
    return sets.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias(out))


def sums_over_sets(slices: DataFrame, keys: Sequence[str], sets: DataFrame,
                   by: Sequence[str]) -> DataFrame:
    """Sum of every measure over every set: (keys, by, name, total).

    Slices and sets meet by bucket.  Each pair is laid out as two rows side by side
    and folded by AND, which is done before anything is moved."""
    pairs = (slices.withColumnRenamed("bits", "_slice")
             .join(sets.withColumnRenamed("bits", "_set"), "bucket")
             .select(*keys, *by, "name", "weight", "bucket",
                     F.explode(F.array("_slice", "_set")).alias("bits")))
    both = pairs.groupBy(*keys, *by, "name", "weight", "bucket").agg(
        F.bitmap_and_agg("bits").alias("bits"))
    return both.groupBy(*keys, *by, "name").agg(
        F.sum(F.col("weight") * F.bitmap_count("bits")).alias("total"))
