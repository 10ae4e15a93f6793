"""The one-page dashboard under its slicers year, state and category (M-8, M-9).

Tables written once, beside the star:

* ``sales``: revenue at every level of (year > month, state, category);
* ``orders``: order averages as sums and counts at every level of (year, state),
  per delivery band;
* ``touched``: the set of orders that each (year, state, category) touches;
* ``row_slices`` and ``order_slices``: order measures as bit slices.

A visual reads the smallest level that has its dimensions and slicers; an item
attribute (category) reaches orders through their items, so order visuals under a
category slicer sum bit slices over the union of the categories' order sets.  No
visual reads the fact, and none shuffles orders: cells and bitmaps are all that
moves.  See :mod:`starbi.operators.bitmaps` for sizes.

An order without items has no category; one whose customer or date has no
dimension row has no state or year and is met only where that slicer is open.
Orders without a state are not shown by state, products without a dimension row
not by category.
"""

from __future__ import annotations

import threading
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starbi.functions import cents, date_key, hround, ratio
from starbi.operators import bitmaps, lattice
from starbi.operators.lattice import Lattice
from starbi.plans.analysis import BAND_LABELS_SHORT, DELIVERED
from starbi.plans.star import Star
from starbi.session import checkpoint_dir, describe_jobs, freeing_shuffles, remove_at_exit
from starbi.sources.writers import write_clustered, write_star_table

YEAR, MONTH, STATE, CATEGORY, BAND = "year", "year_month", "state", "category_en", "faixa"
SLICERS = (YEAR, STATE, CATEGORY)

_SALES = ((YEAR, MONTH), (STATE,), (CATEGORY,))
_ORDERS = ((YEAR,), (STATE,))


@dataclass(frozen=True)
class Page:
    sales: Lattice
    orders: Lattice
    touched: DataFrame
    row_slices: DataFrame
    order_slices: DataFrame
    months: DataFrame


# ------------------------------------------------------------------- building
def _dated(star: Star, rows: DataFrame, *attrs: str) -> DataFrame:
    return rows.join(star.dim_date.select("date_key", *attrs), "date_key", "left")


def _placed(star: Star, rows: DataFrame) -> DataFrame:
    return rows.join(star.dim_customer.select("customer_id", STATE), "customer_id", "left")


def _categorised(star: Star, rows: DataFrame) -> DataFrame:
    return rows.join(star.dim_product.select("product_id", CATEGORY), "product_id", "left")


def _sales_cells(star: Star) -> DataFrame:
    """Revenue of all items, and that of delivered orders, per finest cell."""
    keys = ["date_key", "customer_id", "product_id"]
    none = F.lit(None).cast("decimal(28,2)")
    rows = star.fact.groupBy(*keys).agg(F.sum("total_item_value").alias("all")) \
        .withColumn("delivered", none).unionByName(
        star.item_totals.where(F.col("order_status") == DELIVERED).groupBy(*keys)
        .agg(F.sum("total_item_value").alias("delivered")).withColumn("all", none))
    wide = _categorised(star, _placed(star, _dated(star, rows, YEAR, MONTH)))
    return wide.groupBy(YEAR, MONTH, STATE, CATEGORY).agg(
        F.sum("all").alias("all"), F.sum("delivered").alias("delivered"))


def _order_measures() -> dict[str, F.Column]:
    """Sums over ``dim_order`` rows: all orders (o), delivered ones with delivery
    days (d), and those of a band (b)."""
    one = F.lit(1)
    arrived = (F.col("order_status") == DELIVERED) & F.col("delivery_days").isNotNull()

    def both(prefix, keep, column):
        value = F.when(keep, F.col(column))
        return {f"{prefix}_{column}": F.sum(value), f"{prefix}_{column}_n": F.count(value)}
    return {**both("o", F.lit(True), "on_time"), **both("o", F.lit(True), "review_score"),
            "d_n": F.count(F.when(arrived, one)), "d_days": F.sum(F.when(arrived, F.col("delivery_days"))),
            **both("d", arrived, "on_time"), **both("d", arrived, "review_score"),
            "b_n": F.count(F.when(F.col(BAND).isNotNull(), one)),
            "b_review_score": F.sum(F.when(F.col(BAND).isNotNull(), F.col("review_score")))}


def _banded(star: Star) -> DataFrame:
    """``dim_order`` with its year, state and the number of its delivery band
    (from 1; null unless delivered, with a delay and a rating)."""
    d = F.col("delay_days")
    rated = (F.col("order_status") == DELIVERED) & d.isNotNull() & F.col("review_score").isNotNull()
    band = F.when(d <= -5, 1).when(d < 0, 2).when(d == 0, 3).when(d <= 5, 4).otherwise(5)
    rows = star.dim_order.withColumn("date_key", date_key("purchase_date")) \
        .withColumn(BAND, F.when(rated, band))
    return _placed(star, _dated(star, rows, YEAR))


def materialize_page(star: Star, path: str) -> Page:
    """Write the page's tables under ``path`` and open them."""
    spark = star.fact.sparkSession

    def write(df, name, partition_by=None, cluster_by=(), unique_key=None):
        describe_jobs(spark, f"page: {name}")
        if partition_by:
            return write_clustered(spark, df, f"{path}/{name}", partition_by, cluster_by, unique_key)
        return write_star_table(spark, df, f"{path}/{name}")

    cells, levels = lattice.build(_sales_cells(star), _SALES, {
        "all": F.sum("all"), "delivered": F.sum("delivered")})
    sales = lattice.opened(write(cells, "sales", lattice.LEVEL, (YEAR,)), levels)

    banded = write(_banded(star).groupBy("order_id", YEAR, STATE, BAND).agg(
        *[c.alias(n) for n, c in _order_measures().items()]), "order_rows")
    measures = list(_order_measures())
    cells, levels = lattice.build(banded, _ORDERS, {n: F.sum(n) for n in measures}, [BAND])
    orders = lattice.opened(write(cells, "orders", lattice.LEVEL, (YEAR,)), levels)

    # orders numbered along (year, state), so that a slice lies in few buckets
    touching = write(_categorised(star, _placed(star, _dated(
        star, star.fact.groupBy("order_id", "date_key", "customer_id", "product_id").agg(
            F.count(F.lit(1)).alias("items")), YEAR)))
        .groupBy("order_id", YEAR, STATE, CATEGORY).agg(F.sum("items").alias("items")), "order_items")
    ids = (banded.select("order_id", YEAR, STATE).unionByName(touching.select("order_id", YEAR, STATE))
           .where(F.col("order_id").isNotNull())
           .groupBy("order_id").agg(F.min(YEAR).alias(YEAR), F.min(STATE).alias(STATE)))
    numbers = write(bitmaps.dense_numbers(ids, lambda df: write(df, "order_places"),
                                          [YEAR, STATE, "order_id"])
                    .select("order_id", "number"), "order_numbers")

    touched = write(bitmaps.order_sets(touching.join(numbers, "order_id"), SLICERS),
                    "touched", CATEGORY, (YEAR, STATE), "bucket")
    numbered = banded.join(numbers, "order_id")
    row_slices = write(bitmaps.bit_slices(numbered, [YEAR, STATE, BAND], {
        n: F.col(n) for n in measures if not n.startswith("o_")}),
        "row_slices", YEAR, (STATE, "name"), "bucket")
    ratings = star.dim_order.groupBy("order_id").agg(
        F.max("on_time").alias("on_time"), F.max("review_score").alias("review_score"))
    order_slices = write(bitmaps.bit_slices(ratings.join(numbers, "order_id"), [], {
        "on_time": F.col("on_time"), "on_time_n": F.col("on_time").isNotNull(),
        "review_score": F.col("review_score"),
        "review_score_n": F.col("review_score").isNotNull()}), "order_slices")
    months = write(star.dim_date.select(YEAR, MONTH).distinct(), "months")
    describe_jobs(spark, None)
    return Page(sales, orders, touched, row_slices, order_slices, months)


def load_page(spark: SparkSession, path: str) -> Page:
    """The page of an earlier :func:`materialize_page`."""
    def read(name):
        return spark.read.parquet(f"{path}/{name}")
    return Page(lattice.opened(read("sales"), lattice.all_levels(_SALES)),
                lattice.opened(read("orders"), lattice.all_levels(_ORDERS)),
                *[read(n) for n in ("touched", "row_slices", "order_slices", "months")])


_LOCK = threading.Lock()


def page_for(star: Star) -> Page:
    """The star's page, written on first use (beside the star if it is stored)."""
    with _LOCK:
        if star.page is None:
            spark = star.fact.sparkSession
            root = star.path or f"{checkpoint_dir(spark).rstrip('/')}/starbi-page-{uuid.uuid4().hex}"
            remove_at_exit(spark, f"{root}/page")
            with freeing_shuffles(spark):
                star.page = materialize_page(star, f"{root}/page")
        return star.page


# -------------------------------------------------------------------- visuals
def _split(slicers: dict | None) -> tuple[dict, dict]:
    """Slicers of orders themselves, and of their items."""
    slicers = dict(slicers or {})
    unknown = sorted(set(slicers) - set(SLICERS))
    if unknown:
        raise ValueError(f"unknown slicer {', '.join(unknown)}; known: {', '.join(SLICERS)}")
    return ({k: v for k, v in slicers.items() if k != CATEGORY},
            {k: v for k, v in slicers.items() if k == CATEGORY})


def _sliced(rows: DataFrame, slicers: dict) -> DataFrame:
    for name, values in slicers.items():
        rows = rows.where(F.col(name).isin(list(values)))
    return rows


def _order_sums(page: Page, by: str, names: list[str], slicers: dict | None) -> DataFrame:
    """Sums of order measures per ``by`` (state or band)."""
    own, items = _split(slicers)
    if not items:
        dims = [by] if by != BAND else []
        rows = page.orders.read(dims, own)
        return rows.where(F.col(by).isNotNull()).groupBy(by).agg(*[F.sum(n).alias(n) for n in names])
    orders = bitmaps.union_sets(_sliced(page.touched, items), [])
    slices = _sliced(page.row_slices, own).where(F.col("name").isin(names) & F.col(by).isNotNull())
    sums = bitmaps.sums_over_sets(slices, [YEAR, STATE, BAND], orders, [])
    return sums.groupBy(by).agg(*[F.coalesce(F.sum(F.when(F.col("name") == n, F.col("total"))),
                                             F.lit(0)).alias(n) for n in names])


def delivery_by_state(star: Star, slicers: dict | None = None, min_orders: int = 1) -> DataFrame:
    """Q6 on the page: delivered orders, mean delivery days, on-time share and
    rating per state."""
    names = ["d_n", "d_days", "d_on_time", "d_on_time_n", "d_review_score", "d_review_score_n"]
    g = _order_sums(page_for(star), STATE, names, slicers)
    return (g.where(F.col("d_n") >= max(1, min_orders))
            .select(STATE, F.col("d_n").cast("long").alias("pedidos"),
                    hround("d_days", "d_n", 1).alias("dias_entrega_medio"),
                    hround(F.col("d_on_time") * 100, "d_on_time_n", 1).alias("pct_no_prazo"),
                    hround("d_review_score", "d_review_score_n", 2).alias("nota_media"))
            .orderBy(F.col("dias_entrega_medio").desc_nulls_last(), STATE))


def rating_by_band(star: Star, slicers: dict | None = None) -> DataFrame:
    """N4 on the page: orders and mean rating per delivery band, all five bands."""
    g = _order_sums(page_for(star), BAND, ["b_n", "b_review_score"], slicers) \
        .withColumnRenamed(BAND, "ord")
    labels = F.array(*[F.struct(F.lit(x).alias("faixa"), F.lit(i + 1).alias("ord"))
                       for i, x in enumerate(BAND_LABELS_SHORT)])
    bands = star.fact.sparkSession.range(1).select(F.inline(labels))
    # one row per band
    return (bands.join(F.broadcast(g), "ord", "left")
            .select("faixa", F.coalesce("b_n", F.lit(0)).cast("long").alias("pedidos"),
                    hround("b_review_score", "b_n", 2).alias("nota_media"), "ord").orderBy("ord"))


def top_categories(star: Star, slicers: dict | None = None, k: int = 10) -> DataFrame:
    """C2 on the page: the categories with the largest delivered revenue, ascending."""
    _split(slicers)
    rows = page_for(star).sales.read([CATEGORY], slicers)
    per = (rows.where(F.col(CATEGORY).isNotNull()).groupBy(CATEGORY)
           .agg(F.sum("delivered").alias("r")).where(F.col("r").isNotNull()))
    top = per.orderBy(F.col("r").desc(), F.col(CATEGORY).asc()).limit(k)
    return (top.select(F.col(CATEGORY).alias("categoria"), F.col("r").cast("double").alias("receita"))
            .orderBy(F.col("receita").asc(), F.col("categoria").desc()))


def monthly_line(star: Star, slicers: dict | None = None) -> DataFrame:
    """M-1, M-6, M-7 on the page: revenue per month beside that of the calendar
    month before it.  Place and item slicers choose the revenue, the year slicer
    the months shown: the first one still knows the month before it."""
    page = page_for(star)
    own, items = _split(slicers)
    years = own.pop(YEAR, None)
    rows = page.sales.read([MONTH], {**own, **items})
    revenue = rows.groupBy(MONTH).agg(F.sum("all").alias("rev"))
    ym = F.col(MONTH)
    index = F.substring(ym, 1, 4).cast("int") * 12 + F.substring(ym, 6, 2).cast("int")
    # one row per month of the calendar
    before = Window.orderBy("_index").rangeBetween(-1, -1)
    line = (page.months.where(ym.isNotNull()).join(revenue, MONTH, "left")
            .withColumn("_index", index).withColumn("prev", F.sum("rev").over(before)))
    if years is not None:
        line = line.where(F.col(YEAR).isin(list(years)))
    return line.select(
        MONTH, F.col("rev").cast("double").alias("receita_total"),
        F.col("prev").cast("double").alias("receita_mes_anterior"),
        ratio(F.col("rev") - F.col("prev"), "prev").alias("crescimento_mom")).orderBy(MONTH)


def measures(star: Star, by=(), slicers: dict | None = None) -> DataFrame:
    """The cards (M-1 … M-5) per group of ``by`` (year, state, category), with the
    meaning of :func:`starbi.operators.measures.measures_by`: distinct orders and
    their averages come from merged order sets."""
    page, by = page_for(star), [by] if isinstance(by, str) else list(by)
    own, items = _split(slicers)
    _split(dict.fromkeys(by))
    revenue = page.sales.read(by, slicers).groupBy(*by).agg(F.sum("all").alias("_rev"))
    sets = bitmaps.union_sets(_sliced(page.touched, {**own, **items}), by)
    counts = bitmaps.count_sets(sets, by, "_n")
    names = ["on_time", "on_time_n", "review_score", "review_score_n"]
    if items or CATEGORY in by:
        found = bitmaps.sums_over_sets(page.order_slices, [], sets, by)
        averages = found.groupBy(*by).agg(*[F.sum(F.when(F.col("name") == n, F.col("total"))).alias(n)
                                            for n in names])
    else:
        averages = page.orders.read(by, own).groupBy(*by).agg(
            *[F.sum(f"o_{n}").alias(n) for n in names])
    parts = [revenue, counts, averages]
    columns = ["_rev", "_n", *names]
    types = {f.name: f.dataType for p in parts for f in p.schema.fields}
    rows = None
    for p in parts:
        p = p.select(*by, *[F.col(c) if c in p.columns else F.lit(None).cast(types[c]).alias(c)
                            for c in columns])
        rows = p if rows is None else rows.unionByName(p)
    g = rows.groupBy(*by).agg(*[F.sum(c).alias(c) for c in columns])
    if by:  # groups that neither sales nor orders have
        g = g.where(F.col("_rev").isNotNull() | F.col("_n").isNotNull() | (
            F.lit(CATEGORY not in by and not items) & F.col("on_time_n").isNotNull()))
    return g.select(*by, F.col("_rev").cast("double").alias("receita_total"),
                    F.coalesce("_n", F.lit(0)).cast("long").alias("pedidos"),
                    ratio("_rev", F.coalesce("_n", F.lit(0))).alias("ticket_medio"),
                    ratio("on_time", F.coalesce("on_time_n", F.lit(0))).alias("pct_no_prazo"),
                    ratio("review_score", F.coalesce("review_score_n", F.lit(0))).alias("nota_media"))
