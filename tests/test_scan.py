"""The two-level scan against Spark's plain unpartitioned windows."""
import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from starbi.operators import scan
from starbi.operators.scan import ranked
from starbi.plans import analysis


def plain(df, descending, sums, lags):
    v = F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_first()
    by_value, by_row = Window.orderBy(v), Window.orderBy(v, "id")
    return df.select("*", F.row_number().over(by_row).alias("row_number"),
                     F.rank().over(by_value).alias("rank"), F.dense_rank().over(by_value).alias("dense_rank"),
                     *[F.coalesce(F.sum(c).over(by_value), F.lit(0)).alias(f"running_{c}") for c in sums],
                     *[F.lag(c).over(by_row).alias(f"lag_{c}") for c in lags])


def check(df, descending, boundaries, sums=("x",), lags=("x", "v")):
    got = ranked(df, "v", "id", descending, sums, lags, boundaries=boundaries)
    want = plain(df, descending, sums, lags)
    assert got.columns == want.columns
    def key(r):
        return [repr(Decimal(c).normalize() if isinstance(c, (int, Decimal)) else c) for c in r]
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))


KINDS = {"long": lambda rng: rng.choice([None, 1, 2, 2, 2, 2, 3, 9]),
         "decimal(18,2)": lambda rng: rng.choice([None, Decimal(rng.randint(-99, 99)) / 100, Decimal(7)]),
         "date": lambda rng: rng.choice([None, dt.date(2018, 1, 1) + dt.timedelta(rng.randint(0, 9))])}


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("boundaries", [3, 511])
def test_against_plain_windows(spark, kind, descending, boundaries):
    rng = random.Random(len(kind) + boundaries)
    data = [(f"u{i:04d}", KINDS[kind](rng), rng.choice([None, Decimal(rng.randint(-500, 500)) / 100]))
            for i in range(900)]
    check(spark.createDataFrame(data, f"id string, v {kind}, x decimal(18,2)"), descending, boundaries)


@pytest.mark.parametrize("n", [0, 1, 2, 5])
def test_few_rows(spark, n):
    data = [(i, i // 2, 10 ** i) for i in range(n)]
    for descending in (False, True):
        check(spark.createDataFrame(data, "id long, v long, x long"), descending, 511)


def test_a_value_over_many_ranges(spark):
    """A third of the rows share one value, another third are null: both span many
    ranges, and ranks and sums still agree across their borders."""
    data = [(i, 7 if i % 3 == 0 else None if i % 3 == 1 else i, i % 11) for i in range(3_000)]
    df = spark.createDataFrame(data, "id long, v long, x long").repartition(7)
    for descending in (False, True):
        check(df, descending, 200)


def test_the_plan_has_no_single_task(spark, star_small):
    df = spark.range(5_000).selectExpr("id", "id % 97 AS v")
    for out in (ranked(df, "v", "id", sums=["v"]), analysis.product_ranks(star_small)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan and "Window" not in plan
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = ranked(df, "v", "id").groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in out) < 2_500
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_inexact_sums_are_refused(spark):
    with pytest.raises(TypeError, match="exact"):
        ranked(spark.range(3).selectExpr("id", "id * 0.5D AS v"), "id", "id", sums=["v"])


def test_one_sort_of_bounded_tasks_serves_all_windows(spark, monkeypatch):
    df = spark.range(900).select("id", (F.col("id") % 7).alias("v"))
    kept, checkpoint = [], type(df).checkpoint

    def seen(self, eager=True):
        kept.append(self)
        return checkpoint(self, eager)
    monkeypatch.setattr(type(df), "checkpoint", seen)
    monkeypatch.setattr(scan, "TASK_ROWS", 30)
    ranked(df, "v", "id", sums=["v"], lags=["v"])
    plan = kept[-1]._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("Sort [") == 1
    assert "hashpartitioning(_range" in plan and ", 30)" in plan
