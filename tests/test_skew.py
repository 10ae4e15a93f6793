"""A join key holding a third of the rows: the fact build relies on AQE to
split the hot partition (by ranges of map outputs) instead of sending it to
one task.  Local data is tiny, so the skew thresholds are lowered and the
items are spread over several map tasks, as a large input would be."""
import tempfile
from collections import Counter

from pyspark.sql import functions as F

from conftest import SF_SMALL
from starbi.operators import etl
from starbi.operators.ranking import distributed_ntile
from starbi.sources.testdata import load_raw_from_testdata

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
}


def test_hot_order_is_split_in_fact_join(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        raw = load_raw_from_testdata(spark, SF_SMALL)
        items = raw["items"].withColumn(
            "order_id", F.when(F.col("order_id") % 3 == 0, F.lit(1)).otherwise(F.col("order_id")))
        path = tempfile.mkdtemp(prefix="starbi-skew-") + "/dim_order"
        etl.build_dim_order(raw["orders"], raw["reviews"], raw["payments"]).write.parquet(path)
        dim_order = spark.read.parquet(path)
        fact = etl.build_fact(items.repartition(16), dim_order)
        rows = fact.collect()
        plan = fact._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
        dated = Counter(r.order_id for r in dim_order.where("purchase_date IS NOT NULL").collect())
        want = sum(dated[r.order_id] for r in items.select("order_id").collect())
        assert len(rows) == want
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_ntile_hot_value_is_cut_by_the_id(spark):
    # 60% of the rows share one value: boundaries lie on (value, id)
    df = spark.range(6000).select(F.format_string("u%05d", "id").alias("id"),
                                  F.when(F.col("id") % 5 < 3, F.lit(7)).otherwise(F.col("id"))
                                  .alias("v"))
    out = distributed_ntile(df.repartition(8), 4, "v", "id", out="t")
    sizes = sorted(r["count"] for r in out.groupBy("t").count().collect())
    assert sizes == [1500, 1500, 1500, 1500]
