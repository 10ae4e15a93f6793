"""Ordered windows without PARTITION BY over any number of rows, as a two-level scan.

``ranked`` gives row numbers, RANK, DENSE_RANK, LAG and running RANGE sums of

    ... OVER (ORDER BY value [DESC], tiebreak)

without moving the rows into one task:

1. The rows are written once and cut into ranges of the full key (value, id), by
   boundaries from a bounded hash sample, so a value that a third of the rows share
   is spread over many ranges.
2. Each range is ranked and summed by itself (a window PARTITION BY range).
3. One row per range (its size, its totals, its first and last value and what lies on
   them) reaches the driver, which carries the offsets along the ranges, and ties
   across their borders: a rank goes back to where its value begins, a RANGE sum
   forward to where it ends.
4. The offsets go back as literals; the result is a projection.

The sample decides only how even the ranges are; the result is exact.  Nulls come
first in ascending and last in descending order, as in SQL, and tie with one
another; they add nothing to sums.
"""

from __future__ import annotations

import datetime
import json
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType

from starbi.operators.ranking import BOUNDARIES, SAMPLE_ROWS, key_bounds, rank_in, sort_key_of
from starbi.session import checkpoint_dir

_SUM = "decimal(38,{scale})"
TASK_ROWS = 100_000  # rows that a task sorts, on average


def _scale(df: DataFrame, column: str) -> int:
    kind = df.schema[column].dataType
    if isinstance(kind, DecimalType):
        return kind.scale
    if isinstance(kind, IntegralType):
        return 0
    raise TypeError(f"{column}: running sums are exact, over integers or decimals; not {kind.simpleString()}")


def _plain(x):
    """A value as JSON takes it back into the same type."""
    if isinstance(x, Decimal):
        return str(x)
    return x.isoformat() if isinstance(x, (datetime.date, datetime.datetime)) else x


def ranked(df: DataFrame, value: str, tiebreak: str, descending: bool = False,
           sums: Sequence[str] = (), lags: Sequence[str] = (), boundaries: int | None = None) -> DataFrame:
    """``df`` with row_number, rank, dense_rank, and per column of ``sums`` and
    ``lags`` a ``running_<column>`` and ``lag_<column>``.

    ``tiebreak`` must make the order total (a unique id); ties of ``value`` alone
    share a rank and a running sum, as in SQL's default frame."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    base = df.checkpoint(eager=True)
    key = sort_key_of(base, value, tiebreak, descending)
    rows = base.count()
    bounds, literal = key_bounds(base, key, tiebreak, SAMPLE_ROWS,
                                 BOUNDARIES if boundaries is None else boundaries, rows)
    place = rank_in(key, literal, len(bounds)) if bounds else F.lit(0)
    # tasks of a bounded number of rows, whatever they compress to; the key in columns of
    # its own, so that one sort serves the windows by row and by value
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // TASK_ROWS)
    tagged = (base.withColumn("_key", key).withColumn("_range", place)
              .select("*", F.col("_key.a").alias("_a"), F.col("_key.v").alias("_v")).drop("_key")
              .repartition(max(1, tasks), "_range"))
    at_value = F.struct(F.col("_a").alias("a"), F.col("_v").alias("v"))
    inside = Window.partitionBy("_range")
    by_row, by_value = inside.orderBy("_a", "_v", tiebreak), inside.orderBy("_a", "_v")
    through = by_value.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    kinds = {c: _SUM.format(scale=_scale(base, c)) for c in sums}
    scanned = tagged.select(
        "*", F.row_number().over(by_row).alias("_n"), F.rank().over(by_value).alias("_rank"),
        F.dense_rank().over(by_value).alias("_dense"),
        *[F.sum(F.col(c).cast(kinds[c])).over(through).alias(f"_sum_{c}") for c in sums],
        *[F.lag(c).over(by_row).alias(f"_lag_{c}") for c in lags]).checkpoint(eager=True)

    offsets = _carry(scanned, sums, lags)
    fields = ["n bigint", "rank bigint", "dense bigint", "first struct<a:int,v:decimal(38,6)>",
              "last struct<a:int,v:decimal(38,6)>",
              *[f"`sum_{c}` {kinds[c]}" for c in sums], *[f"`tail_{c}` {kinds[c]}" for c in sums],
              *[f"`lag_{c}` {base.schema[c].dataType.simpleString()}" for c in lags]]
    own = F.get(F.from_json(F.lit(json.dumps(offsets)), f"array<struct<{','.join(fields)}>>"),
                F.col("_range"))

    def carried(name: str) -> Column:
        return own[name]
    on_first, on_last = (at_value.eqNullSafe(carried(side)) for side in ("first", "last"))
    out = [
        (carried("n") + F.col("_n")).alias("row_number"),
        # the offset's rank is set where the range's first value began before it
        F.when(on_first & carried("rank").isNotNull(), carried("rank"))
        .otherwise(carried("n") + F.col("_rank")).alias("rank"),
        (carried("dense") + F.col("_dense")).alias("dense_rank")]
    for c in sums:
        whole = carried(f"sum_{c}") + F.coalesce(F.col(f"_sum_{c}"), F.lit(0)) \
            + F.when(on_last, carried(f"tail_{c}")).otherwise(F.lit(0))
        out.append(whole.cast(kinds[c]).alias(f"running_{c}"))
    for c in lags:
        out.append(F.when(F.col("_n") == 1, carried(f"lag_{c}")).otherwise(F.col(f"_lag_{c}"))
                   .alias(f"lag_{c}"))
    return scanned.select(*[F.col(f"`{c}`") for c in df.columns], *out)


def _carry(scanned: DataFrame, sums: Sequence[str], lags: Sequence[str]) -> list[dict]:
    """What comes before (and, for RANGE sums, after) each range: one entry per
    range, in order; ranges without rows are never looked up."""
    ends = scanned.groupBy("_range").agg(
        F.count(F.lit(1)).alias("n"), F.max("_dense").alias("dense"),
        *[pick(c, "_n").alias(f"{side}{c}") for side, pick in (("first", F.min_by), ("last", F.max_by))
          for c in ("_a", "_v")],
        # rows of the first value have rank 1: its RANGE sum is that of the value
        F.max(F.when(F.col("_rank") == 1, F.col("_n"))).alias("on_first"),
        F.max("_rank").alias("last_begins"),
        *[F.max_by(f"_sum_{c}", "_n").alias(f"sum_{c}") for c in sums],
        *[F.min_by(f"_sum_{c}", "_n").alias(f"first_{c}") for c in sums],
        *[F.max_by(c, "_n").alias(f"lag_{c}") for c in lags]) \
        .orderBy("_range").collect()  # at most BOUNDARIES + 1 rows
    ends = [{**r.asDict(), **{side: {"a": r[f"{side}_a"], "v": r[f"{side}_v"]} for side in ("first", "last")}}
            for r in ends]
    out: list[dict] = [{} for _ in range(max((r["_range"] for r in ends), default=-1) + 1)]
    n = dense = 0
    before, begins = None, None  # the range before, and the rank at which its last value begins
    total = dict.fromkeys(sums, Decimal(0))
    for r in ends:
        tied = before is not None and before["last"] == r["first"]
        entry = out[r["_range"]]
        entry.update(n=n, rank=begins if tied else None, dense=dense - tied,
                     first={k: _plain(v) for k, v in r["first"].items()},
                     last={k: _plain(v) for k, v in r["last"].items()})
        for c in sums:
            entry[f"sum_{c}"] = str(total[c])
            total[c] += r[f"sum_{c}"] or 0
        for c in lags:
            entry[f"lag_{c}"] = _plain(before[f"lag_{c}"]) if before is not None else None
        if not (tied and r["first"] == r["last"]):
            begins = n + r["last_begins"]
        n, dense, before = n + r["n"], dense - tied + r["dense"], r
    after = None
    tail = dict.fromkeys(sums, Decimal(0))
    for r in reversed(ends):
        if after is None or after["first"] != r["last"]:
            tail = dict.fromkeys(sums, Decimal(0))
        else:
            whole = after["first"] == after["last"]
            tail = {c: (after[f"first_{c}"] or 0) + (tail[c] if whole else 0) for c in sums}
        out[r["_range"]].update({f"tail_{c}": str(tail[c]) for c in sums})
        after = r
    return out
