"""Multi-dimensional clustering: rows sorted along a curve that interleaves the
ranks of several keys.

Each key is cut into at most ``2 ** bits`` ranges of about equal row counts, by
boundaries from a bounded hash sample of the rows; the bits of a row's range
numbers are interleaved into one number, and the rows are range-partitioned and
sorted by it.  A file or row group then covers a small box of every key at once, so
Parquet's minima and maxima skip most of them for a filter on any one key, and its
Bloom filters and dictionaries most of the rest.  The sample decides only how
even the boxes are.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starbi.operators.ranking import rank_in
from starbi.sources.writers import RANGE_ROWS, write_clustered

SAMPLE_ROWS = 16_384
BITS = 8
CURVE = "_curve"


def boundaries(df: DataFrame, keys: Sequence[str], bits: int = BITS, rows: int | None = None) -> dict[str, list]:
    """Up to ``2 ** bits - 1`` rising values per key, cutting the rows evenly (a key
    value that many rows share is a boundary once)."""
    n = df.count() if rows is None else rows
    every = max(1, n // SAMPLE_ROWS)
    sample = df.where(F.pmod(F.xxhash64(*df.columns), F.lit(every)) == 0).select(*keys) \
        .limit(4 * SAMPLE_ROWS).collect()  # a hash deals evenly; copies of one row are the exception
    out = {}
    for key in keys:
        values = sorted(r[key] for r in sample if r[key] is not None)
        step = len(values) / (1 << bits)
        out[key] = sorted({values[int(i * step)] for i in range(1, 1 << bits)} if values else ())
    return out


def curve(df: DataFrame, cuts: dict[str, list], bits: int = BITS) -> Column:
    """The interleaved number: bit b of every key's range in turn, from the highest."""
    ranges = []
    for key, values in cuts.items():
        kind = df.schema[key].dataType.simpleString()
        literal = F.from_json(F.lit(json.dumps(values)), f"array<{kind}>")
        ranges.append(F.coalesce(rank_in(F.col(key), literal, len(values)), F.lit(0)).cast("long"))
    z = F.lit(0).cast("long")
    for b in reversed(range(bits)):
        for r in ranges:
            z = F.shiftleft(z, 1).bitwiseOR(F.getbit(r, F.lit(b)).cast("long"))
    return z


def write_by_keys(spark: SparkSession, df: DataFrame, path: str, keys: Sequence[str],
                  row_group_bytes: int | None = None) -> DataFrame:
    """``df`` laid out along the curve of ``keys``, with Bloom filters on them."""
    rows = max(1, df.count())
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // RANGE_ROWS)
    options = {}
    for key in keys:
        options[f"parquet.bloom.filter.enabled#{key}"] = "true"
        options[f"parquet.bloom.filter.expected.ndv#{key}"] = str(max(1_000, min(rows // n, 1_000_000)))
    if row_group_bytes:
        options["parquet.block.size"] = str(row_group_bytes)
    laid = df.withColumn(CURVE, curve(df, boundaries(df, keys, rows=rows)))
    return write_clustered(spark, laid, path, cluster_by=(CURVE, *keys),
                           unique_key=F.xxhash64(*df.columns), options=options, rows=rows).drop(CURVE)
