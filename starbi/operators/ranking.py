"""Ranking over a whole table without funnelling it through one task.

``ntile``/``rank`` windows without PARTITION BY make Spark move every row
into a single partition (``Exchange SinglePartition``).  That is harmless
over a few hundred aggregated rows (months, categories, payment types) but
not over every customer.  The operators here give the same numbers while
keeping the work spread out.
"""

from __future__ import annotations

import datetime
import json
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from starbi.session import checkpoint_dir

# Sort keys sampled per score, and the boundaries kept of them: a located
# range then holds about one row in 512.
SAMPLE_ROWS = 8192
BOUNDARIES = 511
_VALUE = "decimal(38,6)"


def _number(df: DataFrame, value: str) -> Column:
    """A date or number as an exact decimal of the same order."""
    c = F.col(value)
    if isinstance(df.schema[value].dataType, DateType):
        c = F.unix_date(c)
    return c.cast(_VALUE)


def _literal(keys: list[tuple], id_type: str) -> Column:
    """Sort keys as one array literal.  ``from_json`` of a literal is folded into
    one, and only if nothing is wrapped round it: any ``transform`` here would be
    run again for every comparison of every row."""
    # numbers as text: JSON numbers would lose decimal digits
    rows = [{"a": a, "v": None if v is None else str(v),
             "i": i.isoformat() if isinstance(i, datetime.date) else i} for a, v, i in keys]
    return F.from_json(F.lit(json.dumps(rows)), f"array<struct<a:int,v:{_VALUE},i:{id_type}>>")


def _sort_key(row) -> tuple:
    """Python order of a key equal to Spark's (nulls first inside a struct)."""
    a, v, i = row
    return a, (v is not None, v or Decimal(0)), (i is not None, i if i is not None else 0)


def rank_in(key: Column, bounds: Column, count: int) -> Column:
    """How many of the ``count`` ascending bounds are smaller than ``key``:
    a binary search, one comparison per bit."""
    bits = max(1, count).bit_length()
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(bits))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= count) & (F.get(bounds, at + step - 1) < key), at + step).otherwise(at))


def sort_key_of(df: DataFrame, value: str, tiebreak: str, descending: bool) -> Column:
    """The full sort key: nulls first ascending, last descending, then the value,
    then the id."""
    v = _number(df, value)
    return F.struct((v.isNull().cast("int") if descending else F.lit(0)).alias("a"),
                    (-v if descending else v).cast(_VALUE).alias("v"),
                    F.col(tiebreak).alias("i"))


def key_bounds(df: DataFrame, key: Column, tiebreak: str, sample_rows: int,
               boundaries: int, rows: int | None = None) -> tuple[list[tuple], Column | None]:
    """Up to ``boundaries`` rising keys that cut the rows about evenly, from a hash
    sample of ids, and the same as a folded literal."""
    every = max(1, (df.count() if rows is None else rows) // sample_rows)
    sampled = df.where(F.pmod(F.xxhash64(F.col(tiebreak)), F.lit(every)) == 0) \
        .select(key.alias("k")).collect()
    ordered = sorted((tuple(r["k"]) for r in sampled), key=_sort_key)
    step = max(1, len(ordered) // (boundaries + 1))
    bounds = ordered[step::step][:boundaries]
    id_type = df.schema[tiebreak].dataType.simpleString()
    return bounds, _literal(bounds, id_type) if bounds else None


def _at_or_below(key: Column, bounds: Column) -> Column:
    return F.size(F.filter(bounds, lambda x: x <= key))


def ntiles(df: DataFrame, k: int, specs: list[tuple[str, str, bool]], tiebreak: str) -> DataFrame:
    """Several exact ``NTILE(k) OVER (ORDER BY value [DESC], tiebreak)`` columns,
    one per ``(out, value, descending)``.

    ``tiebreak`` must make the order total (a unique id).  A tile is known from
    the k - 1 rows at which tiles begin, so only those are sought:

    1. The input is checkpointed once to the shared folder and counted.
    2. About ``SAMPLE_ROWS`` rows, chosen by a hash of the id, give up to
       ``BOUNDARIES`` boundaries per score on the full key (value, id); a value
       shared by a third of the rows is cut by the id.
    3. One pass counts the rows between boundaries (combined in each task; a
       few hundred rows per score reach the driver).
    4. One pass ranks, inside the few ranges that hold a tile's first row, the
       rows of that range, and picks those k - 1 keys.
    5. The tile of a row is one more than the number of those keys at or below
       its own: a projection, no shuffle.

    The sample decides only how even the ranges are; the result is exact.  Nulls
    come first in ascending and last in descending order, as in SQL.
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    spark = df.sparkSession
    checkpoint_dir(spark)
    base = df.checkpoint(eager=True)
    n = base.count()
    id_type = base.schema[tiebreak].dataType.simpleString()
    starts = [j * (n // k) + min(j, n % k) for j in range(1, k)]  # 0-based first rows of tiles
    starts = [s for s in starts if s < n]

    keys = [sort_key_of(base, value, tiebreak, descending) for _, value, descending in specs]
    if not starts:  # k = 1, or no rows
        return base.select("*", *[F.lit(1).alias(name) for name, _, _ in specs])
    every = max(1, n // SAMPLE_ROWS)
    sampled = base.where(F.pmod(F.xxhash64(F.col(tiebreak)), F.lit(every)) == 0) \
        .select(*[c.alias(f"k{j}") for j, c in enumerate(keys)]).collect()
    bounds = []
    for j in range(len(specs)):
        ordered = sorted((tuple(r[f"k{j}"]) for r in sampled), key=_sort_key)
        step = max(1, len(ordered) // (BOUNDARIES + 1))
        bounds.append(ordered[step::step][:BOUNDARIES])
    tagged = base.select(F.explode(F.array(*[
        F.struct(F.lit(j).alias("spec"),
                 (rank_in(c, _literal(b, id_type), len(b)) if b else F.lit(0)).alias("range"),
                 c.alias("key")) for j, (c, b) in enumerate(zip(keys, bounds))])).alias("t")) \
        .select("t.spec", "t.range", "t.key")
    sizes = {(r["spec"], r["range"]): r["count"]
             for r in tagged.groupBy("spec", "range").count().collect()}
    wanted = []  # (spec, range, place inside the range) of each tile's first row
    for j in range(len(specs)):
        before, left = 0, list(starts)
        for number in sorted(r for s, r in sizes if s == j):
            size = sizes[j, number]
            while left and left[0] < before + size:
                wanted.append((j, number, left.pop(0) - before + 1))
            before += size
    inside = F.struct("spec", "range").isin(
        [F.struct(F.lit(j).alias("spec"), F.lit(r).alias("range"))
         for j, r in sorted({w[:2] for w in wanted})])
    place = F.row_number().over(Window.partitionBy("spec", "range").orderBy("key"))
    picked = tagged.where(inside).withColumn("place", place).where(
        F.struct("spec", "range", "place").isin(
            [F.struct(F.lit(j).alias("spec"), F.lit(r).alias("range"), F.lit(p).alias("place"))
             for j, r, p in wanted])).select("spec", "key").collect()
    out = []
    for j, ((name, _, _), c) in enumerate(zip(specs, keys)):
        cuts = sorted((tuple(r["key"]) for r in picked if r["spec"] == j), key=_sort_key)
        out.append((_at_or_below(c, _literal(cuts, id_type)) + 1).alias(name))
    return base.select("*", *out)


def distributed_ntile(df: DataFrame, k: int, value: str, tiebreak: str,
                      descending: bool = False, out: str = "ntile") -> DataFrame:
    """:func:`ntiles` of a single value."""
    return ntiles(df, k, [(out, value, descending)], tiebreak)


def _top(df: DataFrame, k: int, value: str, tiebreak) -> DataFrame:
    ties = [tiebreak] if isinstance(tiebreak, str) else list(tiebreak)
    return df.orderBy(F.col(value).desc_nulls_last(),
                      *[F.col(t).asc_nulls_first() for t in ties]).limit(k)


def topk_dense_rank(df: DataFrame, k: int, value: str, tiebreak,
                    out: str = "dense_rank") -> DataFrame:
    """The first ``k`` rows by ``value`` DESC (ties by ``tiebreak`` columns),
    each with its ``DENSE_RANK() OVER (ORDER BY value DESC)`` over the whole
    input.

    Every row whose value is greater than a selected row's value is itself
    selected, so all values at or above the k-th one appear among the k rows
    and the dense rank computed on them equals the global one.  The top-k is
    a partial sort per task plus a merge of k rows per task; the window then
    runs over k rows only.
    """
    w = Window.orderBy(F.col(value).desc_nulls_last())
    return _top(df, k, value, tiebreak).withColumn(out, F.dense_rank().over(w).cast("int"))
