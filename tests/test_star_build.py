"""The star build at size: what meets what, how often it moves, and that repeated
and hot orders give the same sums."""
from collections import Counter, defaultdict
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from starbi.operators import etl
from starbi.plans import star as S
from starbi.sources import testdata
from starbi.sources.writers import write_clustered
from test_skew import SKEW_CONF

FACT = ("order_id long, order_item_id int, product_id long, seller_id long, customer_id long, date_key int, "
        "price decimal(18,2), freight_value decimal(18,2), total_item_value decimal(18,2)")
ORDERS = "order_id long, order_status string, purchase_date date"


@pytest.fixture()
def conf(spark):
    old = {}

    def put(values):
        for k, v in values.items():
            old.setdefault(k, spark.conf.get(k, None))
            spark.conf.set(k, v)
    yield put
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _money(x):
    return None if x is None else Decimal(x)


def _items(rows):
    return [(o, n, p, s, c, d, _money(a), _money(b), _money(a + b) if None not in (a, b) else None)
            for o, n, p, s, c, d, a, b in rows]


def test_item_totals_of_repeated_orders(spark):
    rows = _items([(1, 1, 7, 3, 9, 20180101, 10, 1), (1, 2, 7, 3, 9, 20180101, 5, None),
                   (2, 1, 7, None, 8, 20180102, 4, 2), (2, 1, 7, None, 8, 20180102, 4, 2),
                   (3, 1, None, 3, 8, 20180102, -4, 2), (5, 1, 1, 1, 1, 20180102, 1, 1)])
    orders = [(1, "delivered", date(2018, 1, 1)), (2, "delivered", date(2018, 1, 2)),
              (2, "delivered", date(2018, 1, 2)), (2, None, None), (3, "shipped", date(2018, 1, 2)),
              (None, "shipped", None), (None, "shipped", None), (4, "shipped", None)]
    got = S.derive_item_totals(spark.createDataFrame(rows, FACT), spark.createDataFrame(orders, ORDERS))
    sums = defaultdict(lambda: [None, None, None, 0])
    for o, _, p, s, c, d, *amounts in rows:
        at = sums[o, c, d, p, s]
        for i, v in enumerate(amounts):
            if v is not None:
                at[i] = (at[i] or 0) + v
        at[3] += 1
    want = Counter((*k, *v, status, day) for k, v in sums.items()
                   for o, status, day in orders if o == k[0])
    assert Counter(map(tuple, got.collect())) == want
    assert [f.dataType.simpleString() for f in got.schema.fields[5:9]] == ["decimal(28,2)"] * 3 + ["bigint"]


def test_items_move_once_to_their_sums(spark, conf):
    conf({"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"})
    got = S.derive_item_totals(spark.createDataFrame([], FACT).repartition(2),
                               spark.createDataFrame([], ORDERS).repartition(2))
    assert _plan(got).count("Exchange hashpartitioning(") == 2  # the items, the orders


def test_hot_order_is_split_before_its_sums(spark, conf, tmp_out):
    conf({**SKEW_CONF, "spark.sql.adaptive.forceOptimizeSkewedJoin": "true"})
    n = 20000
    i = F.col("id")
    fact = spark.range(0, n, 1, 16).select(
        F.when(i % 3 == 0, F.lit(1)).otherwise(i + 10).alias("order_id"), i.cast("int").alias("order_item_id"),
        (i % 500).alias("product_id"), (i % 7).alias("seller_id"), F.lit(1).cast("long").alias("customer_id"),
        F.lit(20180101).alias("date_key"), *[F.lit(Decimal("1.00")).cast("decimal(18,2)").alias(c)
                                             for c in ("price", "freight_value", "total_item_value")])
    orders = fact.select("order_id").distinct().select(
        "order_id", F.lit("delivered").alias("order_status"), F.lit(date(2018, 1, 1)).alias("purchase_date"))
    orders.write.parquet(f"{tmp_out}/orders")
    got = S.derive_item_totals(fact, spark.read.parquet(f"{tmp_out}/orders"))
    rows = got.collect()
    assert "skew=true" in _plan(got)
    assert sum(r["items"] for r in rows) == n and sum(r.price for r in rows) == n
    assert len(rows) == fact.select("order_id", "product_id", "seller_id").distinct().count()


def test_seller_totals_with_null_keys(spark):
    rows = [(1, 5, "delivered", Decimal(2)), (1, 5, "delivered", Decimal(3)), (2, 5, "delivered", None),
            (2, None, "delivered", Decimal(1)), (3, None, None, None), (4, 5, "shipped", Decimal(1))]
    items = spark.createDataFrame(rows, "order_id long, seller_id long, order_status string, "
                                        "total_item_value decimal(28,2)")
    got = S.derive_seller_totals(items)
    assert {(r.seller_id, r.order_status): (r.orders, r.total_item_value) for r in got.collect()} == {
        (5, "delivered"): (2, Decimal(5)), (None, "delivered"): (1, Decimal(1)),
        (None, None): (1, None), (5, "shipped"): (1, Decimal(1))}
    assert got.columns == ["seller_id", "order_status", "orders", "total_item_value"]
    assert got.schema["total_item_value"].dataType.simpleString() == "decimal(38,2)"


def test_refunds_reach_the_items_without_a_shuffle(spark, conf, monkeypatch):
    conf({"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"})
    sent = testdata.load_raw_from_testdata(spark, SF_SMALL)["items"]
    assert "Exchange hashpartitioning(" not in _plan(sent)
    monkeypatch.setattr(testdata, "BROADCAST_ROWS", 0)
    moved = testdata.load_raw_from_testdata(spark, SF_SMALL)["items"]
    assert "Exchange hashpartitioning(" in _plan(moved)
    assert Counter(map(tuple, sent.collect())) == Counter(map(tuple, moved.collect()))


def test_derived_columns_are_not_shuffled(spark, tmp_out):
    df = spark.createDataFrame([(1, 10, 2), (2, 20, 3), (3, 10, None)], "k int, day int, v int")
    out = write_clustered(spark, df, f"{tmp_out}/t", partition_by="folder", cluster_by=("k",),
                          derived={"folder": (F.col("day") / 10).cast("int").cast("string"),
                                   "twice": F.col("v") * 2}, columns=["k", "twice", "day", "v", "folder"])
    assert Counter(map(tuple, out.select("k", "twice", "day", "v", "folder").collect())) == Counter(
        [(1, 4, 10, 2, "1"), (2, 6, 20, 3, "2"), (3, None, 10, None, "1")])

def test_payments_are_summed_in_cents(spark):
    rows = [(1, "card", 1, Decimal("0.10")), (1, "slip", 2, Decimal("0.20")), (1, "slip", 1, None),
            (2, "card", 1, None), (3, "card", 1, Decimal("-9999999999999999.99")),
            (3, "slip", 1, Decimal("9999999999999999.98"))]
    pay = spark.createDataFrame(rows, "order_id long, payment_type string, payment_installments int, "
                                      "payment_value decimal(18,2)")
    got = etl.payment_summary(pay)
    assert {r.order_id: (r.payment_value, r.max_installments, r.payment_type) for r in got.collect()} == {
        1: (Decimal("0.30"), 2, "slip"), 2: (Decimal("0.00"), 1, "card"),
        3: (Decimal("-0.01"), 1, "slip")}
    assert "sum(cast" in _plan(got) and got.schema["payment_value"].dataType == etl.MONEY
