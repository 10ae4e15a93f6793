"""The business questions (Q1–Q10), the KPI data sets (C1–C5) and the
notebook queries (N1, N3–N5) as DataFrame plans over a :class:`Star`.

Plan shape used throughout:

* Order-level questions read the order-grain summary
  (``Star.order_totals``: item sums per order with the order's status and
  purchase date), written once by the ETL.  They never join the item-grain
  fact to ``dim_order``; the reduction that builds the summary combines
  map-side, so a huge order never travels whole.
* Item-level questions (category, seller) reduce items per product or
  seller before the dimension join.
* Joins to dimensions are left to the planner (it broadcasts from measured
  sizes); only the five-row band table is broadcast explicitly.
* Windows without PARTITION BY only ever see aggregated rows whose count is
  bounded by the calendar or by a taxonomy (months, categories, payment
  types, two buyer types).  Per-customer quartiles use
  :func:`starbi.operators.ranking.ntiles`, which seeks only the keys at which
  quartiles begin.
* ROUND is computed exactly from integer numerators/denominators
  (:func:`starbi.functions.hround`), money is exact DECIMAL until the final
  DOUBLE projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starbi.functions import cents, hround, ratio
from starbi.operators.ranking import ntiles, topk_dense_rank
from starbi.operators.scan import ranked
from starbi.plans.star import Star

DELIVERED = "delivered"

# ---------------------------------------------------------------------------
# Fixed values of the reference (labels shown in the results)
# ---------------------------------------------------------------------------
# Delivery bands by delay_days: <= -5, < 0, = 0, <= 5, else.
BAND_LABELS = ["Adiantado 5+ dias", "No prazo", "No limite",
               "Atraso ate 5 dias", "Atraso acima de 5 dias"]
BAND_LABELS_SHORT = ["Adiantado 5+ d", "No prazo", "No limite",
                     "Atraso ate 5 d", "Atraso 5+ d"]
# RFM segments.
SEG_HIGH = "Alto valor"
SEG_RECENT = "Recente em desenvolvimento"
SEG_CHURN = "Em risco de churn"
SEG_LOW = "Baixo engajamento"
# Buyer types.
REPEAT, SINGLE = "Recorrente", "Unico"
# Month window of the KPI chart and notebook (reference default).
KPI_MONTHS = ("2017-01", "2018-08")


def _dbl(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def _delivered_order_totals(star: Star) -> DataFrame:
    """One row per delivered order with its item sums (order-grain summary;
    columns order_id, customer_id, date_key, purchase_date, first_row, _price,
    _freight, _total)."""
    t = star.order_totals.where(F.col("order_status") == DELIVERED)
    return t.select("order_id", "customer_id", "date_key", "purchase_date", "first_row",
                    F.col("price").alias("_price"), F.col("freight_value").alias("_freight"),
                    F.col("total_item_value").alias("_total"))


# --------------------------------------------------------------------- Q1 / C5
def q01_overview(star: Star) -> DataFrame:
    """Orders, product / freight / total revenue and average ticket of
    delivered orders (one row, also over empty input)."""
    t = _delivered_order_totals(star)
    agg = t.agg(F.coalesce(F.sum("first_row"), F.lit(0)).cast("long").alias("pedidos"),
                F.sum("_price").alias("p"), F.sum("_freight").alias("fr"),
                F.sum("_total").alias("tot"))
    return agg.select(
        "pedidos",
        _dbl("p").alias("receita_produtos"), _dbl("fr").alias("receita_frete"),
        _dbl("tot").alias("receita_total"),
        hround(cents("tot"), F.col("pedidos") * 100, 2).alias("ticket_medio"))


def kpi_headline(star: Star) -> DataFrame:
    """C5 / N2: orders, revenue, ticket."""
    q = q01_overview(star)
    return q.select("pedidos", F.col("receita_total").alias("receita"),
                    F.col("ticket_medio").alias("ticket"))


# ------------------------------------------------------------------ Q2 / C1 / N3
def monthly_revenue(star: Star, months: tuple[str, str] | None = None,
                    delivered_only: bool = True) -> DataFrame:
    """Revenue per ``year_month`` (exact decimal), optionally within an
    inclusive ``yyyy-MM`` range.  The order summary carries the calendar
    month of each order and is stored one folder per month, so a month
    range is a partition filter on the scan."""
    t = star.order_totals
    if delivered_only:
        t = t.where(F.col("order_status") == DELIVERED)
    ym = F.col("year_month")
    t = t.where(ym.between(*months) if months else ym.isNotNull())
    return t.groupBy("year_month").agg(F.sum("total_item_value").alias("receita"))


def _with_lag(monthly: DataFrame) -> DataFrame:
    # one row per month: the unpartitioned window sees a calendar-bounded set
    w = Window.orderBy("year_month")
    return monthly.withColumn("prev", F.lag("receita").over(w))


def _growth_pct(cur: str, prev: str) -> F.Column:
    return hround((cents(cur) - cents(prev)) * 100, cents(prev), 1)


def q02_monthly_mom(star: Star) -> DataFrame:
    m = _with_lag(monthly_revenue(star))
    return m.select("year_month", _dbl("receita").alias("receita"),
                    _dbl("prev").alias("receita_mes_anterior"),
                    _growth_pct("receita", "prev").alias("crescimento_pct")
                    ).orderBy("year_month")


def kpi_monthly_revenue(star: Star, months: tuple[str, str] = KPI_MONTHS) -> DataFrame:
    """C1: unrounded monthly revenue inside a month range."""
    return (monthly_revenue(star, months)
            .select("year_month", _dbl("receita").alias("receita")).orderBy("year_month"))


def nb_monthly_mom(star: Star, months: tuple[str, str] = KPI_MONTHS) -> DataFrame:
    """N3: ranged monthly revenue (unrounded) with MoM % (the LAG sees only
    the months inside the range)."""
    m = _with_lag(monthly_revenue(star, months))
    return m.select("year_month", _dbl("receita").alias("receita"),
                    _growth_pct("receita", "prev").alias("crescimento_pct")
                    ).orderBy("year_month")


def nb_monthly_mom_tail(star: Star, months: tuple[str, str] = KPI_MONTHS,
                        n: int = 5) -> DataFrame:
    """N3 ``.tail()``: the last ``n`` months of the ranged series."""
    return nb_monthly_mom(star, months).orderBy(F.col("year_month").desc()).limit(n) \
        .orderBy("year_month")


# ------------------------------------------------------------- Q3 / Q4 / C2
def _per_category(star: Star, per_product: DataFrame, how: str = "inner") -> DataFrame:
    return (per_product.join(star.dim_product.select("product_id", "category_en"),
                             "product_id", how)
            .groupBy("category_en")
            .agg(F.sum("r").alias("receita"), F.sum("n").alias("itens")))


def category_revenue(star: Star) -> DataFrame:
    """Revenue and item count of delivered orders per English category, from the
    per-(product, status) item sums the ETL writes: one row per product meets
    the product dimension, and no question re-joins the item-grain fact."""
    t = star.product_totals.where(F.col("order_status") == DELIVERED)
    return _per_category(star, t.groupBy("product_id").agg(
        F.sum("total_item_value").alias("r"), F.sum("items").alias("n")))


def category_revenue_all(star: Star) -> DataFrame:
    """The same over the fact alone: no order row is joined, so neither a
    repeated nor a missing one changes the sums."""
    return _per_category(star, star.fact.groupBy("product_id").agg(
        F.sum("total_item_value").alias("r"), F.count(F.lit(1)).alias("n")))


def q03_top_categories(star: Star, k: int = 10) -> DataFrame:
    c = category_revenue(star)
    # one row per category (a taxonomy, not a data-sized set)
    everything = Window.partitionBy()
    by_rev = Window.orderBy(F.col("receita").desc())
    c = (c.withColumn("total", F.sum("receita").over(everything))
         .withColumn("posicao", F.rank().over(by_rev).cast("int")))
    top = c.orderBy(F.col("receita").desc(), F.col("category_en").asc()).limit(k)
    return top.select("category_en", _dbl("receita").alias("receita"),
                      F.col("itens").cast("long").alias("itens"),
                      hround(cents("receita") * 100, cents("total"), 1).alias("pct_do_total"),
                      "posicao")


def kpi_top_categories(star: Star, k: int = 10) -> DataFrame:
    """C2: top-k categories by revenue, returned in ascending order."""
    c = category_revenue(star)
    top = c.orderBy(F.col("receita").desc(), F.col("category_en").asc()).limit(k)
    return (top.select(F.col("category_en").alias("categoria"),
                       _dbl("receita").alias("receita"))
            .orderBy(F.col("receita").asc(), F.col("categoria").desc()))


def q04_pareto(star: Star) -> DataFrame:
    """Cumulative revenue share by category, over all order statuses.
    RANGE frame: categories with equal revenue share one cumulative value."""
    c = category_revenue_all(star)
    running = Window.orderBy(F.col("receita").desc()).rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    c = (c.withColumn("cum", F.sum("receita").over(running))
         .withColumn("total", F.sum("receita").over(Window.partitionBy())))
    return c.select("category_en", _dbl("receita").alias("receita"),
                    hround(cents("cum") * 100, cents("total"), 1).alias("pct_acumulado")
                    ).orderBy(F.col("receita").desc(), "category_en")


def pareto_products(star: Star) -> DataFrame:
    """Q4 per product instead of per category: as many rows as there are products, so
    the running RANGE share comes from the distributed scan."""
    per = star.fact.where(F.col("product_id").isNotNull()).groupBy("product_id").agg(
        F.sum("total_item_value").alias("receita"))
    total = per.agg(F.sum("receita").alias("total"))  # one row
    scanned = ranked(per, "receita", "product_id", descending=True, sums=["receita"])
    return scanned.crossJoin(F.broadcast(total)).select(
        "product_id", _dbl("receita").alias("receita"),
        hround(cents("running_receita") * 100, cents("total"), 1).alias("pct_acumulado"),
        F.col("rank").cast("long").alias("posicao"))


def product_ranks(star: Star) -> DataFrame:
    """Q3's rank for every product with delivered items, by items sold (many ties) and
    id: rank, dense rank, row number, and the items of the product before."""
    per = (star.product_totals.where((F.col("order_status") == DELIVERED) & F.col("product_id").isNotNull())
           .groupBy("product_id").agg(F.sum("items").alias("itens")))
    scanned = ranked(per, "itens", "product_id", descending=True, sums=["itens"], lags=["itens"])
    return scanned.select(
        "product_id", F.col("itens").cast("long").alias("itens"),
        *[F.col(a).cast("long").alias(b) for a, b in (
            ("row_number", "linha"), ("rank", "posicao"), ("dense_rank", "posicao_densa"),
            ("running_itens", "itens_acumulados"), ("lag_itens", "itens_anterior"))])


# -------------------------------------------------------------------- Q5 / N5
def customer_base(star: Star) -> DataFrame:
    """Per person (customer_unique_id) over delivered orders: last purchase
    date, distinct orders and total value.  Orders are reduced first, so the
    customer join sees one row per order."""
    orders = _delivered_order_totals(star)
    people = star.dim_customer.select("customer_id", "customer_unique_id")
    return (orders.join(people, "customer_id")
            .groupBy("customer_unique_id")
            .agg(F.max("purchase_date").alias("ultima_compra"),
                 F.count_distinct("order_id").alias("frequencia"),
                 F.sum("_total").alias("valor")))


def q05_rfm_scores(star: Star, recency: str = "reference") -> DataFrame:
    """Quartile scores per person.  ``recency="reference"`` orders the
    recency quartile by last purchase DESC (the newest buyers get r=1, as
    the reference does); ``"recent_high"`` gives the newest buyers r=4.
    Ties are broken by customer_unique_id."""
    uid = "customer_unique_id"
    s = ntiles(customer_base(star), 4, [("r_score", "ultima_compra", recency == "reference"),
                                        ("f_score", "frequencia", False),
                                        ("m_score", "valor", False)], uid)
    return s.select(uid, "ultima_compra", F.col("frequencia").cast("long").alias("frequencia"),
                    _dbl("valor").alias("valor"), "r_score", "f_score", "m_score")


def _segment(r: str, m: str) -> F.Column:
    r, m = F.col(r), F.col(m)
    return (F.when((r >= 3) & (m >= 3), SEG_HIGH)
            .when((r >= 3) & (m < 3), SEG_RECENT)
            .when((r < 3) & (m >= 3), SEG_CHURN)
            .otherwise(SEG_LOW))


def _segments(scored: DataFrame) -> DataFrame:
    g = (scored.withColumn("segmento", _segment("r_score", "m_score"))
         .groupBy("segmento")
         .agg(F.count(F.lit(1)).alias("clientes"), F.sum("_v").alias("_sv")))
    return g.select("segmento", "clientes",
                    hround(cents("_sv"), F.col("clientes") * 100, 2).alias("valor_medio")
                    ).orderBy(F.col("valor_medio").desc())


def q05_rfm_segments(star: Star, recency: str = "reference") -> DataFrame:
    """Q5: segment sizes and mean (rounded-per-customer) value."""
    s = ntiles(customer_base(star), 4, [("r_score", "ultima_compra", recency == "reference"),
                                        ("m_score", "valor", False)], "customer_unique_id")
    # money is exact to the cent, so ROUND(valor, 2) is valor itself
    return _segments(s.withColumn("_v", F.col("valor")))


def nb_rfm_segments(star: Star) -> DataFrame:
    """N5: the notebook's variant (two scores, mean over unrounded value;
    identical numbers because money is exact to the cent)."""
    s = ntiles(customer_base(star), 4, [("r_score", "ultima_compra", True),
                                        ("m_score", "valor", False)], "customer_unique_id")
    return _segments(s.withColumn("_v", F.col("valor")))


# ------------------------------------------------------------------------ Q6
def q06_logistics_by_state(star: Star, min_orders: int = 100) -> DataFrame:
    """Delivery days, on-time % and rating per customer state, for states
    with at least ``min_orders`` delivered orders.  Orders are summed per
    customer before the customer join."""
    o = (star.dim_order.where((F.col("order_status") == DELIVERED)
                              & F.col("delivery_days").isNotNull())
         .groupBy("customer_id")
         .agg(F.count(F.lit(1)).alias("n"),
              F.sum("delivery_days").alias("dd_s"), F.count("delivery_days").alias("dd_n"),
              F.sum("on_time").alias("ot_s"), F.count("on_time").alias("ot_n"),
              F.sum("review_score").alias("rs_s"), F.count("review_score").alias("rs_n")))
    g = (o.join(star.dim_customer.select("customer_id", "state"), "customer_id")
         .groupBy("state")
         .agg(*[F.sum(c).alias(c) for c in ("n", "dd_s", "dd_n", "ot_s", "ot_n", "rs_s", "rs_n")]))
    return (g.where(F.col("n") >= min_orders)
            .select("state", F.col("n").cast("long").alias("pedidos"),
                    hround("dd_s", "dd_n", 1).alias("dias_entrega_medio"),
                    hround(F.col("ot_s") * 100, "ot_n", 1).alias("pct_no_prazo"),
                    hround("rs_s", "rs_n", 2).alias("nota_media"))
            .orderBy(F.col("dias_entrega_medio").desc_nulls_last(), "state"))


# ------------------------------------------------------------- Q7 / C3 / N4
def delay_band(labels: list[str]) -> F.Column:
    d = F.col("delay_days")
    return (F.when(d <= -5, labels[0]).when(d < 0, labels[1]).when(d == 0, labels[2])
            .when(d <= 5, labels[3]).otherwise(labels[4]))


def _band_stats(star: Star, labels: list[str]) -> DataFrame:
    o = star.dim_order.where((F.col("order_status") == DELIVERED)
                             & F.col("delay_days").isNotNull()
                             & F.col("review_score").isNotNull())
    return (o.groupBy(delay_band(labels).alias("faixa"))
            .agg(F.count(F.lit(1)).alias("pedidos"),
                 F.sum("review_score").alias("_rs"), F.count("review_score").alias("_rn")))


def _band_table(spark, labels: list[str]) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(lbl).alias("faixa"), F.lit(i + 1).alias("ord"))
                     for i, lbl in enumerate(labels)])
    return spark.range(1).select(F.inline(rows))


def q07_delay_vs_rating(star: Star) -> DataFrame:
    b = _band_stats(star, BAND_LABELS)
    return (b.select(F.col("faixa").alias("faixa_entrega"), "pedidos",
                     hround("_rs", "_rn", 2).alias("nota_media"))
            .orderBy(F.col("nota_media").desc(), "faixa_entrega"))


def kpi_delay_vs_rating(star: Star) -> DataFrame:
    """C3: unrounded mean rating per band, in the fixed band order; a band
    with no order is kept with a null rating (the reference would raise)."""
    b = _band_stats(star, BAND_LABELS_SHORT)
    bands = _band_table(star.dim_order.sparkSession, BAND_LABELS_SHORT)
    # the stats have one row per band (a five-way CASE): a proven bound
    return (bands.join(F.broadcast(b), "faixa", "left")
            .select("faixa", ratio("_rs", "_rn").alias("nota"), "ord").orderBy("ord"))


def nb_delay_bands(star: Star) -> DataFrame:
    """N4: orders and rounded mean rating per band, fixed band order."""
    b = _band_stats(star, BAND_LABELS_SHORT)
    bands = _band_table(star.dim_order.sparkSession, BAND_LABELS_SHORT)
    return (bands.join(F.broadcast(b), "faixa", "left")
            .select("faixa", F.coalesce("pedidos", F.lit(0)).cast("long").alias("pedidos"),
                    hround("_rs", "_rn", 2).alias("nota_media"), "ord").orderBy("ord"))


# -------------------------------------------------------------------- Q8 / C4
def _payment_groups(star: Star) -> DataFrame:
    o = star.dim_order.where((F.col("order_status") == DELIVERED)
                             & F.col("payment_type").isNotNull())
    g = o.groupBy("payment_type").agg(
        F.count(F.lit(1)).alias("pedidos"),
        F.sum("payment_value").alias("_pv"), F.count("payment_value").alias("_pn"),
        F.sum("max_installments").alias("_ms"), F.count("max_installments").alias("_mn"))
    # one row per payment type
    return g.withColumn("_all", F.sum("pedidos").over(Window.partitionBy()))


def q08_payment_mix(star: Star) -> DataFrame:
    g = _payment_groups(star)
    return (g.select("payment_type", "pedidos",
                     hround(cents("_pv"), F.col("_pn") * 100, 2).alias("ticket_medio"),
                     hround("_ms", "_mn", 1).alias("parcelas_medias"),
                     hround(F.col("pedidos") * 100, "_all", 1).alias("pct_pedidos"))
            .orderBy(F.col("pedidos").desc(), "payment_type"))


def kpi_payment_mix(star: Star) -> DataFrame:
    """C4: orders per payment type and the chart's share in percent."""
    g = _payment_groups(star)
    return (g.select(F.col("payment_type").alias("tipo"), "pedidos",
                     hround(F.col("pedidos") * 100, "_all", 1).alias("pct"))
            .orderBy(F.col("pedidos").desc(), "tipo"))


# ------------------------------------------------------------------------ Q9
def q09_top_sellers(star: Star, k: int = 10) -> DataFrame:
    # per-(seller, status) distinct orders and item sums written by the ETL
    per_seller = (star.seller_totals.where(F.col("order_status") == DELIVERED)
                  .select("seller_id", F.col("orders").alias("pedidos"),
                          F.col("total_item_value").alias("receita")))
    g = per_seller.join(star.dim_seller.select("seller_id", "state"), "seller_id")
    top = topk_dense_rank(g, k, "receita", ["seller_id", "state"], out="ranking")
    return top.select("seller_id", "state", F.col("pedidos").cast("long").alias("pedidos"),
                      _dbl("receita").alias("receita"), "ranking"
                      ).orderBy(F.col("receita").desc(), "seller_id")


# ----------------------------------------------------------------------- Q10
def q10_repeat_customers(star: Star) -> DataFrame:
    base = customer_base(star)
    g = (base.withColumn("tipo_cliente",
                         F.when(F.col("frequencia") > 1, REPEAT).otherwise(SINGLE))
         .groupBy("tipo_cliente")
         .agg(F.count(F.lit(1)).alias("clientes"), F.sum("valor").alias("receita")))
    everything = Window.partitionBy()  # two rows
    g = (g.withColumn("_nc", F.sum("clientes").over(everything))
         .withColumn("_nr", F.sum("receita").over(everything)))
    return g.select("tipo_cliente", "clientes",
                    hround(F.col("clientes") * 100, "_nc", 1).alias("pct_clientes"),
                    _dbl("receita").alias("receita"),
                    hround(cents("receita") * 100, cents("_nr"), 1).alias("pct_receita"))
