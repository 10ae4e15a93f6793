"""Measures on hand-written stars: order grain and calendar MoM (M-4/M-5, T7, T22)."""
from decimal import Decimal

from pyspark.sql import functions as F

from starbi.operators.measures import measure_mom_calendar, measures_by, measures_total
from starbi.plans.star import Star
from starbi.plans.analysis import q02_monthly_mom, q04_pareto


def _star(spark, orders, items, dates):
    o = spark.createDataFrame(orders, "order_id long, customer_id long, order_status string, "
                              "on_time int, review_score int")
    days = {r[0]: r[4] for r in items}  # an order's date is that of its items
    o = o.withColumn("purchase_date", F.to_date(F.element_at(F.create_map(*[
        F.lit(x) for k, v in days.items() for x in (k, str(v))]), F.col("order_id")), "yyyyMMdd"))
    f = spark.createDataFrame(items, "order_id long, product_id long, seller_id long, "
                              "customer_id long, date_key int, total_item_value decimal(18,2)")
    d = spark.createDataFrame(dates, "date_key int, year int, year_month string") \
        .withColumn("quarter", F.lit(None).cast("int")).withColumn("month", F.lit(None).cast("int"))
    c = spark.createDataFrame([(1, "SP")], "customer_id long, state string")
    p = spark.createDataFrame([(10, "a"), (11, "b")], "product_id long, category_en string")
    s = spark.createDataFrame([(5, "RJ")], "seller_id long, state string")
    f = f.withColumn("price", f.total_item_value).withColumn("freight_value", f.total_item_value * 0)
    return Star(dim_customer=c, dim_product=p, dim_seller=s, dim_order=o, dim_date=d,
                fact_order_items=f)


def test_rating_is_averaged_at_order_grain(spark):
    M = Decimal
    st = _star(spark,
               [(1, 1, "delivered", 1, 2), (2, 1, "delivered", 0, 4)],
               [(1, 10, 5, 1, 20180105, M("1.00")), (1, 10, 5, 1, 20180105, M("1.00")),
                (1, 11, 5, 1, 20180105, M("1.00")), (2, 10, 5, 1, 20180106, M("4.00"))],
               [(20180105, 2018, "2018-01"), (20180106, 2018, "2018-01")])
    r = measures_by(st, by="year").first()
    assert (r.pedidos, r.receita_total, r.nota_media, r.pct_no_prazo) == (2, 7.0, 3.0, 0.5)
    assert r.ticket_medio == 3.5
    by_cat = {x.category_en: (x.pedidos, x.nota_media)
              for x in measures_by(st, by="category_en").collect()}
    assert by_cat == {"a": (2, 3.0), "b": (1, 2.0)}
    sliced = measures_by(st, by="year", slicers={"category_en": ["b"]}).first()
    assert (sliced.pedidos, sliced.receita_total) == (1, 1.0)


def test_calendar_mom_vs_lag(spark):
    M = Decimal
    st = _star(spark,
               [(1, 1, "delivered", 1, 5), (2, 1, "delivered", 1, 5), (3, 1, "delivered", 1, 5),
                (4, 1, "delivered", 1, 5)],
               [(1, 10, 5, 1, 20180110, M("100.00")), (2, 10, 5, 1, 20180210, M("150.00")),
                (3, 10, 5, 1, 20180410, M("300.00"))],
               [(20180110, 2018, "2018-01"), (20180210, 2018, "2018-02"),
                (20180410, 2018, "2018-04"), (20180501, 2018, "2018-05")])
    cal = {r.year_month: (r.receita_total, r.receita_mes_anterior, r.crescimento_mom)
           for r in measure_mom_calendar(st).collect()}
    assert cal["2018-02"] == (150.0, 100.0, 0.5)
    assert cal["2018-04"] == (300.0, None, None)        # March absent: calendar gives null
    assert cal["2018-05"] == (None, 300.0, None)        # month with dates but no revenue
    lag = {r.year_month: r.receita_mes_anterior for r in q02_monthly_mom(st).collect()}
    assert lag["2018-04"] == 150.0                      # LAG takes the previous present month


def test_sums_come_from_the_fact_alone(spark):
    M = Decimal
    dates = [(20180105, 2018, "2018-01")]
    fact = [(1, 10, 5, 1, 20180105, M("10.00")), (1, 10, 5, 1, 20180105, M("10.00")),
            (2, 11, 5, 1, 20180105, M("20.00"))]
    order = (1, 1, "delivered", 1, 5)
    # a repeated order row multiplies nothing, a missing one loses nothing
    for orders in ([order, order, (2, 1, "delivered", 1, 5)], [order], [(2, 1, "delivered", 1, 5)]):
        st = _star(spark, orders, fact, dates)
        assert {r.category_en: r.receita for r in q04_pareto(st).collect()} == {"a": 20.0, "b": 20.0}
        assert [r.receita_total for r in measure_mom_calendar(st).collect()] == [40.0]
        assert measures_total(st).first().receita_total == 40.0
        assert {r.category_en: r.receita_total
                for r in measures_by(st, "category_en").collect()} == {"a": 20.0, "b": 20.0}


def test_missing_parent_is_the_null_group(spark):
    st = _star(spark, [(1, 9, "delivered", 1, 5)],
               [(1, 10, 5, 9, 20180105, Decimal("10.00"))], [(20180105, 2018, "2018-01")])
    rows = [(r.state, r.receita_total, r.pedidos, r.nota_media)
            for r in measures_by(st, "state").collect()]
    assert rows == [(None, 10.0, 1, 5.0)]


def test_averages_run_over_all_orders(spark):
    st = _star(spark, [(1, 1, "delivered", 1, 5), (2, 1, "delivered", 0, 1)],
               [(1, 10, 5, 1, 20180105, Decimal("10.00"))], [(20180105, 2018, "2018-01")])
    r = measures_total(st).first()  # order 2 has no items
    assert (r.pedidos, r.pct_no_prazo, r.nota_media) == (1, 0.5, 3.0)
    assert measures_by(st, "category_en").first().nota_media == 5.0


def test_calendar_slicer_keeps_the_month_before(spark):
    M = Decimal
    st = _star(spark, [(i, 1, "delivered", 1, 5) for i in (1, 2)],
               [(1, 10, 5, 1, 20171210, M("100.00")), (2, 10, 5, 1, 20180110, M("150.00"))],
               [(20171210, 2017, "2017-12"), (20180110, 2018, "2018-01")])
    rows = [tuple(r) for r in measure_mom_calendar(st, {"year": [2018]}).collect()]
    assert rows == [("2018-01", 150.0, 100.0, 0.5)]
    rows = [tuple(r) for r in measure_mom_calendar(st, {"state": ["SP"], "year": [2018]}).collect()]
    assert rows == [("2018-01", 150.0, 100.0, 0.5)]
