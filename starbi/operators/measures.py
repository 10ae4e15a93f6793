"""BI measures (M-1 … M-9) evaluated for a grouping and a set of slicers.

A measure is a function of the filter context: ``measures_by`` takes the
grouping columns and optional slicers (year, state, category, …) and
returns one row per group (one row in all without a grouping).

* Revenue, orders and ticket are sums over the fact alone: no order row is
  joined, so neither a repeated nor a missing one changes them.
* On-time rate and rating are averages over orders.  With calendar or
  customer attributes only, they run over ``dim_order`` itself, each order
  with its own date and customer, with or without items.  An item attribute
  (category, seller state) reaches orders through their items: an order
  counts once in each group it touches (the dashboard guide leaves that
  case open and this is the choice made here).
* A key without its dimension row falls into the null group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starbi.functions import date_key, ratio
from starbi.plans.star import Star

# where each attribute lives: date -> dim_date, place -> dim_customer,
# category -> dim_product, seller state -> dim_seller
_ATTRS = {
    "year": ("dim_date", "date_key", "year"),
    "quarter": ("dim_date", "date_key", "quarter"),
    "month": ("dim_date", "date_key", "month"),
    "year_month": ("dim_date", "date_key", "year_month"),
    "state": ("dim_customer", "customer_id", "state"),
    "city": ("dim_customer", "customer_id", "city"),
    "category_en": ("dim_product", "product_id", "category_en"),
    "category_pt": ("dim_product", "product_id", "category_pt"),
    "seller_state": ("dim_seller", "seller_id", "state"),
}
_ITEM_TABLES = ("dim_product", "dim_seller")


def _table(attr: str) -> str:
    if attr not in _ATTRS:
        raise ValueError(f"unknown attribute {attr!r}; known: {sorted(_ATTRS)}")
    return _ATTRS[attr][0]


def _attach(star: Star, rows: DataFrame, attrs: list[str], slicers: dict) -> DataFrame:
    """``rows`` with the attributes of their dimension rows.  A slicer is pushed
    into its dimension, whose join is then an inner one; an attribute that is
    only shown keeps rows without a parent (left join)."""
    by_table: dict[tuple[str, str], list[str]] = {}
    for a in attrs:
        by_table.setdefault((_table(a), _ATTRS[a][1]), []).append(a)
    # sliced dimensions first: they drop rows before the other joins
    for (table, key), names in sorted(by_table.items(),
                                      key=lambda t: not any(n in slicers for n in t[1])):
        dim = star[table].select(key, *[F.col(_ATTRS[n][2]).alias(n) for n in names])
        sliced = [n for n in names if n in slicers]
        for n in sliced:
            dim = dim.where(F.col(n).isin(list(slicers[n])))
        rows = rows.join(dim, key, "inner" if sliced else "left")
    return rows


def _on_days(star: Star, slicers: dict) -> DataFrame:
    """The fact's rows on the days that the calendar slicers leave: met before any
    reduction, so that only those months' folders are read."""
    days = {a: v for a, v in slicers.items() if _table(a) == "dim_date"}
    if not days:
        return star.fact
    calendar = star.dim_date
    for a, values in days.items():
        calendar = calendar.where(F.col(_ATTRS[a][2]).isin(list(values)))
    return star.fact_in(calendar)


def _fact_per_order(star: Star, attrs: list[str], slicers: dict) -> DataFrame:
    """The fact reduced, map-side first, to one row per order and key in use."""
    keys = sorted({"order_id"} | {_ATTRS[a][1] for a in attrs})
    return _on_days(star, slicers).groupBy(*keys).agg(F.sum("total_item_value").alias("_rev"))


def measures_by(star: Star, by=("year",), slicers: dict | None = None) -> DataFrame:
    """Receita Total, Pedidos, Ticket Medio, Pct No Prazo and Nota Media per
    group of ``by`` after applying ``slicers`` ({attribute: [values]})."""
    by = [by] if isinstance(by, str) else list(by)
    slicers = dict(slicers or {})
    attrs = sorted(set(by) | set(slicers))
    item_level = any(_table(a) in _ITEM_TABLES for a in attrs)

    # one row per (group, order)
    per_order = (_attach(star, _fact_per_order(star, attrs, slicers), attrs, slicers)
                 .groupBy(*by, "order_id").agg(F.sum("_rev").alias("_rev")))
    # order averages; summed in the same pass as the revenue
    if item_level:
        rated = star.dim_order.groupBy("order_id").agg(
            F.max("on_time").alias("on_time"), F.max("review_score").alias("review_score"))
        orders = per_order.join(rated, "order_id", "left")
    else:
        orders = _attach(star, star.dim_order.withColumn("date_key", date_key("purchase_date")),
                         attrs, slicers)
    nothing = F.lit(None)
    rows = per_order.select(*by, "_rev", F.lit(1).alias("_n"), nothing.cast("int").alias("on_time"),
                            nothing.cast("int").alias("review_score")).unionByName(
        orders.select(*by, nothing.cast("decimal(28,2)").alias("_rev"), F.lit(0).alias("_n"),
                      F.col("on_time").cast("int"), F.col("review_score").cast("int")))
    g = rows.groupBy(*by).agg(
        F.sum("_rev").alias("_rev"), F.coalesce(F.sum("_n"), F.lit(0)).alias("pedidos"),
        F.sum("on_time").alias("_ot"), F.count("on_time").alias("_otn"),
        F.sum("review_score").alias("_rs"), F.count("review_score").alias("_rsn"))
    return g.select(*by,
                    F.col("_rev").cast("double").alias("receita_total"),
                    F.col("pedidos").cast("long").alias("pedidos"),
                    ratio("_rev", "pedidos").alias("ticket_medio"),
                    ratio("_ot", "_otn").alias("pct_no_prazo"),
                    ratio("_rs", "_rsn").alias("nota_media"))


def measures_total(star: Star, slicers: dict | None = None) -> DataFrame:
    """The dashboard cards: all measures over the whole (sliced) model, one row."""
    return measures_by(star, (), slicers)


def measure_mom_calendar(star: Star, slicers: dict | None = None) -> DataFrame:
    """M-1, M-6, M-7 per month: revenue, revenue of the previous *calendar*
    month (null when that month has no dates in the calendar or no revenue —
    unlike LAG, which takes the previous month present) and the MoM ratio.

    Place and item slicers choose the revenue; months are then shifted on the
    whole calendar, and calendar slicers choose the months that are shown, so
    the first shown month still knows the one before it.  Revenue is reduced
    per day before meeting the calendar, and the previous month is a RANGE
    frame over the month-level rows (bounded by the calendar)."""
    slicers = dict(slicers or {})
    shown = {a: v for a, v in slicers.items() if _table(a) == "dim_date"}
    chosen = {a: v for a, v in slicers.items() if a not in shown}
    keys = sorted({"date_key"} | {_ATTRS[a][1] for a in chosen})
    src = star.fact.groupBy(*keys).agg(F.sum("total_item_value").alias("_rev"))
    daily = (_attach(star, src, sorted(chosen), chosen)
             .groupBy("date_key").agg(F.sum("_rev").alias("rev")))
    cal = star.dim_date.select("date_key", "year_month", "year", "quarter", "month") \
        if shown else star.dim_date.select("date_key", "year_month")
    extra = [c for c in cal.columns if c not in ("date_key", "year_month")]
    ym = F.col("year_month")
    month_index = F.substring(ym, 1, 4).cast("int") * 12 + F.substring(ym, 6, 2).cast("int")
    monthly = (cal.join(daily, "date_key", "left")
               .groupBy("year_month", *extra, month_index.alias("_mi"))
               .agg(F.sum("rev").alias("rev")))
    prev_month = Window.orderBy("_mi").rangeBetween(-1, -1)
    out = monthly.withColumn("prev_rev", F.sum("rev").over(prev_month))
    for attr, values in shown.items():
        out = out.where(F.col(attr).isin(list(values)))
    return out.select(
        "year_month",
        F.col("rev").cast("double").alias("receita_total"),
        F.col("prev_rev").cast("double").alias("receita_mes_anterior"),
        ratio(F.col("rev") - F.col("prev_rev"), "prev_rev").alias("crescimento_mom"))
