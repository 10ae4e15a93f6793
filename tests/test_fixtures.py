"""Questions on hand-written stars (FIXTURES §3): ties, edges and audits."""
import datetime as dt
from decimal import Decimal as M

from pyspark.sql import functions as F

from starbi.operators import quality
from starbi.plans import analysis as A
from starbi.plans.star import Star

D = dt.date


def make_star(spark, orders, items, customers=None, products=None, sellers=None, dates=None):
    """orders: (order_id, customer_id, status, purchase_date, delivery_days,
    delay_days, on_time, review_score, payment_value, max_installments,
    payment_type); items: (order_id, product_id, seller_id, total)."""
    o = spark.createDataFrame(
        orders, "order_id long, customer_id long, order_status string, purchase_date date, "
                "delivery_days int, delay_days int, on_time int, review_score int, "
                "payment_value decimal(18,2), max_installments int, payment_type string")
    ts = F.lit(None).cast("timestamp_ntz")
    o = o.select("order_id", "customer_id", "order_status", ts.alias("order_purchase_timestamp"),
                 "purchase_date", ts.alias("order_delivered_customer_date"),
                 ts.alias("order_estimated_delivery_date"), "delivery_days", "delay_days",
                 "on_time", "review_score", "payment_value", "max_installments", "payment_type")
    it = spark.createDataFrame(items, "order_id long, product_id long, seller_id long, "
                                      "total_item_value decimal(18,2)")
    dk = {r[0]: r[3] for r in orders}
    cust = {r[0]: r[1] for r in orders}
    it = it.withColumn("order_item_id", F.lit(1)).withColumn("price", F.col("total_item_value")) \
        .withColumn("freight_value", F.lit(M("0.00")).cast("decimal(18,2)"))
    keys = spark.createDataFrame([(k, cust[k], int(d.strftime("%Y%m%d")) if d else None)
                                  for k, d in dk.items()],
                                 "order_id long, customer_id long, date_key int")
    fact = it.join(keys.where(F.col("date_key").isNotNull()), "order_id").select(
        "order_id", "order_item_id", "product_id", "seller_id", "customer_id", "date_key",
        "price", "freight_value", "total_item_value")
    customers = customers or sorted({(r[1], f"U{r[1]}", "SP") for r in orders})
    c = spark.createDataFrame(customers, "customer_id long, customer_unique_id string, state string")
    p = spark.createDataFrame(products or [(1, "a")], "product_id long, category_en string")
    s = spark.createDataFrame(sellers or [(1, "RJ")], "seller_id long, state string")
    days = sorted({d for d in dk.values() if d})
    dd = spark.createDataFrame(dates or [(int(d.strftime("%Y%m%d")), d.strftime("%Y-%m"))
                                         for d in days] or [(0, "x")],
                               "date_key int, year_month string")
    return Star(dim_customer=c, dim_product=p, dim_seller=s, dim_order=o, dim_date=dd,
                fact_order_items=fact)


def _order(oid, cust=1, status="delivered", day=D(2018, 1, 5), dd=5, delay=-3, on_time=1,
           rating=5, pay=M("10.00"), inst=1, ptype="credit_card"):
    return (oid, cust, status, day, dd, delay, on_time, rating, pay, inst, ptype)


def test_pareto_ties_and_rank(spark):
    # categories with revenue 50, 20, 20, 10; one non-delivered order only in Q4
    orders = [_order(i) for i in range(1, 5)] + [_order(5, status="canceled")]
    items = [(1, 1, 1, M("50.00")), (2, 2, 1, M("20.00")), (3, 3, 1, M("20.00")),
             (4, 4, 1, M("10.00")), (5, 4, 1, M("100.00"))]
    prods = [(1, "a"), (2, "b"), (3, "c"), (4, "d")]
    st = make_star(spark, orders, items, products=prods)
    q3 = [(r.category_en, r.receita, r.posicao, r.pct_do_total)
          for r in A.q03_top_categories(st).collect()]
    assert q3 == [("a", 50.0, 1, 50.0), ("b", 20.0, 2, 20.0), ("c", 20.0, 2, 20.0),
                  ("d", 10.0, 4, 10.0)]
    # Q4 has no status filter: d = 110 first; the tie b/c shares one cumulative value
    q4 = [(r.category_en, r.pct_acumulado) for r in A.q04_pareto(st).collect()]
    assert q4 == [("d", 55.0), ("a", 80.0), ("b", 100.0), ("c", 100.0)]
    q4 = [(r.category_en, r.pct_acumulado)
          for r in A.q04_pareto(make_star(spark, orders[:4], items[:4], products=prods)).collect()]
    assert q4 == [("a", 50.0), ("b", 90.0), ("c", 90.0), ("d", 100.0)]


def test_having_edge_and_null_days(spark):
    orders = [_order(i, cust=1) for i in range(100)] + [_order(1000 + i, cust=2) for i in range(99)]
    orders += [_order(5000, cust=2, dd=None, delay=None, on_time=None)]   # excluded by IS NOT NULL
    custs = [(1, "U1", "AA"), (2, "U2", "BB")]
    st = make_star(spark, orders, [(0, 1, 1, M("1.00"))], customers=custs)
    rows = A.q06_logistics_by_state(st).collect()
    assert [(r.state, r.pedidos) for r in rows] == [("AA", 100)]
    assert A.q06_logistics_by_state(st, min_orders=99).count() == 2


def test_missing_band_kept(spark):
    orders = [_order(1, delay=-7, rating=5), _order(2, delay=-1, rating=4),
              _order(3, delay=3, rating=2), _order(4, delay=9, rating=1),
              _order(5, delay=9, rating=None)]
    st = make_star(spark, orders, [(1, 1, 1, M("1.00"))])
    c3 = [(r.faixa, r.nota, r.ord) for r in A.kpi_delay_vs_rating(st).collect()]
    assert c3 == [("Adiantado 5+ d", 5.0, 1), ("No prazo", 4.0, 2), ("No limite", None, 3),
                  ("Atraso ate 5 d", 2.0, 4), ("Atraso 5+ d", 1.0, 5)]
    n4 = [(r.faixa, r.pedidos, r.nota_media) for r in A.nb_delay_bands(st).collect()]
    assert n4[2] == ("No limite", 0, None)
    q7 = {r.faixa_entrega: r.pedidos for r in A.q07_delay_vs_rating(st).collect()}
    assert "No limite" not in q7 and q7["Atraso acima de 5 dias"] == 1


def test_empty_overview_is_one_row(spark):
    st = make_star(spark, [_order(1, status="shipped")], [(1, 1, 1, M("5.00"))])
    rows = A.q01_overview(st).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.pedidos, r.receita_total, r.ticket_medio) == (0, None, None)


def test_top_sellers_dense_rank_ties(spark):
    revs = [100, 90, 90, 80, 70, 60, 60, 50, 40, 30, 20, 10]
    orders = [_order(i) for i in range(1, 13)]
    items = [(i, 1, i, M(str(v))) for i, v in zip(range(1, 13), revs)]
    sellers = [(i, "S%02d" % i) for i in range(1, 13)]
    st = make_star(spark, orders, items, sellers=sellers)
    rows = [(r.seller_id, r.receita, r.ranking) for r in A.q09_top_sellers(st).collect()]
    assert rows == [(1, 100.0, 1), (2, 90.0, 2), (3, 90.0, 2), (4, 80.0, 3), (5, 70.0, 4),
                    (6, 60.0, 5), (7, 60.0, 5), (8, 50.0, 6), (9, 40.0, 7), (10, 30.0, 8)]


def test_audits_find_violations(spark):
    orders = [_order(1, cust=1, rating=0), _order(1, cust=1, rating=6, on_time=2),
              _order(2, cust=9)]                                   # dup PK, orphan customer
    items = [(1, 1, 1, M("1.00")), (2, 7, 8, M("1.00"))]           # orphan product and seller
    st = make_star(spark, orders, items, customers=[(1, "U1", "SP")])
    pk = {r.tabela: (r.chaves_duplicadas, r.linhas_duplicadas) for r in quality.audit_pk(st).collect()}
    assert pk["dim_order"] == (1, 2) and pk["dim_customer"] == (0, 0)
    fk = {(r.tabela, r.chave): r.orfaos for r in quality.audit_fk(st).collect()}
    assert fk[("dim_order", "customer_id")] == 1
    assert fk[("fact_order_items", "product_id")] == 1
    assert fk[("fact_order_items", "seller_id")] == 1
    assert fk[("fact_order_items", "customer_id")] == 1
    assert fk[("fact_order_items", "order_id")] == 0
    dom = {r.coluna: r.violacoes for r in quality.audit_domain(st).collect()}
    assert dom == {"review_score": 2, "on_time": 1}


def test_repeat_buyers_two_ids_one_person(spark):
    orders = [_order(1, cust=1), _order(2, cust=2), _order(3, cust=3)]
    custs = [(1, "P1", "SP"), (2, "P1", "SP"), (3, "P2", "SP")]
    items = [(1, 1, 1, M("10.00")), (2, 1, 1, M("30.00")), (3, 1, 1, M("60.00"))]
    st = make_star(spark, orders, items, customers=custs)
    rows = {r.tipo_cliente: (r.clientes, r.pct_clientes, r.receita, r.pct_receita)
            for r in A.q10_repeat_customers(st).collect()}
    assert rows == {"Recorrente": (1, 50.0, 40.0, 40.0), "Unico": (1, 50.0, 60.0, 60.0)}


def test_raw_timestamp_audit(spark):
    rows = [("2018-01-01 10:00:00",), ("2018-01-03",), ("bad",), ("",), (None,)]
    o = spark.createDataFrame(rows, "order_purchase_timestamp string")
    r = quality.audit_raw_timestamps(o).collect()
    assert [(x.coluna, x.preenchidos, x.convertidos, x.falhas) for x in r] == \
        [("order_purchase_timestamp", 3, 1, 2)]


def test_dropped_items_audit(spark):
    items = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "order_id long")
    orders = spark.createDataFrame([(1, D(2018, 1, 1)), (2, None)], "order_id long, purchase_date date")
    got = {r.destino: r.itens for r in quality.audit_dropped_items(items, orders).collect()}
    assert got == {"mantido": 2, "pedido_sem_data": 1, "pedido_ausente": 2}


def test_rfm_of_nine_people(spark):
    """Equal dates and values are cut by the person's id; two customer ids of one
    person count together; tiles of 3, 2, 2 and 2; the newest buyer has r = 1."""
    days = [D(2018, 1, 1)] * 4 + [D(2018, 2, 1)] * 3 + [D(2018, 3, 1), D(2018, 4, 1)]
    values = [10, 10, 10, 10, 20, 20, 30, 40, 50]
    orders = [_order(i, cust=i, day=d) for i, d in enumerate(days)] + [_order(9, cust=9, day=days[0])]
    customers = [(i, f"P{i}", "SP") for i in range(9)] + [(9, "P0", "SP")]
    items = [(i, 1, 1, M(f"{v}.00")) for i, v in enumerate(values)] + [(9, 1, 1, M("35.00"))]
    st = make_star(spark, orders, items, customers=customers)
    rows = {r.customer_unique_id: r for r in A.q05_rfm_scores(st).collect()}
    assert {p: r.r_score for p, r in rows.items()} == {
        "P8": 1, "P7": 1, "P4": 1, "P5": 2, "P6": 2, "P0": 3, "P1": 3, "P2": 4, "P3": 4}
    assert rows["P0"].valor == 45.0 and rows["P0"].frequencia == 2 and rows["P0"].f_score == 4
    assert {p: r.m_score for p, r in rows.items()} == {
        "P1": 1, "P2": 1, "P3": 1, "P4": 2, "P5": 2, "P6": 3, "P7": 3, "P0": 4, "P8": 4}
    high = {r.customer_unique_id: r.r_score
            for r in A.q05_rfm_scores(st, recency="recent_high").collect()}
    assert high["P8"] == 4 and high["P0"] == 1
    sizes = sorted(r.clientes for r in A.q05_rfm_segments(st).collect())
    assert sum(sizes) == 9
