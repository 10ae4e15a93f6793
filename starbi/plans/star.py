"""E-8: build the star schema, and give queries one star per (session, input).

Two forms of the same star:

* ``build_star(raw)`` — lazy DataFrames; every consumer re-derives what it
  needs from the raw tables and Catalyst prunes the rest.
* ``materialize_star(spark, raw, path)`` — the ETL job proper: each table
  is written once to the shared checkpoint folder and read back, which
  cuts lineage (a lost executor re-reads files instead of re-running the
  ETL) and lets every later query scan Parquet with pushdown and pruning.

Layout.  By default the fact is stored in a folder per month, sorted by order
inside each file, and the other tables are plain Parquet.  ``buckets=N`` buckets
``fact_order_items`` and ``dim_order`` by ``order_id`` so that the star
join and per-order reductions skip their shuffle — but a bucket cannot be
split at read time, so one order holding a large share of all items would
make one task read that share.  Bucketing is therefore opt-in, for data
whose orders are known to be small; the default path relies on map-side
combining before every shuffle and on AQE's skew-join splitting, which
stay balanced whatever the key distribution.
"""

from __future__ import annotations

import hashlib
import threading
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starbi.operators import etl
from starbi.session import application_id, checkpoint_dir, describe_jobs, freeing_shuffles, remove_at_exit
from starbi.sources.writers import write_clustered, write_star_table

STAR_TABLES = ("dim_customer", "dim_product", "dim_seller", "dim_order",
               "dim_date", "fact_order_items")
# written beside the six tables by the ETL
SUMMARIES = ("item_totals", "order_totals", "product_totals", "seller_totals")
BUCKETED = ("dim_order", "fact_order_items")
BUCKET_KEY = "order_id"
# session setting that turns on order_id bucketing for star_for (0 = off)
BUCKETS_CONF = "starbi.star.buckets"

# folder column of the written fact
FACT_FOLDER = "year_month"

_SUMS = ("price", "freight_value", "total_item_value", "items")


def derive_item_totals(fact: DataFrame, dim_order: DataFrame) -> DataFrame:
    """The one item-grain join behind all summaries: the fact's sums per (order,
    product, seller), with the attributes of the order's ``dim_order`` rows.
    Multiplicities are those of joining the fact itself, so questions that join
    ``dim_order`` get the same numbers from the sums.

    Items meet their order first and are summed where they meet it: one shuffle of
    the fact, by order, serves both (``_row`` keeps the rows of a repeated order
    apart).  ``materialize_star`` lets Spark split the join of a hot order, which
    adds a shuffle before the sums in that case only."""
    keys = ["order_id", "customer_id", "date_key", "product_id", "seller_id",
            "order_status", "purchase_date"]
    orders = (dim_order.select("order_id", "order_status", "purchase_date")
              .withColumn("_row", F.monotonically_increasing_id()))
    per = fact.join(orders, "order_id").groupBy(*keys, "_row").agg(
        F.sum("price").alias("price"), F.sum("freight_value").alias("freight_value"),
        F.sum("total_item_value").alias("total_item_value"), F.count(F.lit(1)).alias("items"))
    return per.select(*keys[:5], *_SUMS, *keys[5:])


def derive_order_totals(items: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Order-grain sums from :func:`derive_item_totals`, with the calendar month
    (null for a date key that the calendar lacks).  ``first_row`` is 1 on one
    row per order and status: distinct orders are its sum, without a shuffle."""
    keys = ["order_id", "customer_id", "date_key", "order_status", "purchase_date"]
    per_order = items.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in _SUMS])
    nth = F.row_number().over(Window.partitionBy("order_id", "order_status")
                              .orderBy("purchase_date", "date_key", "customer_id"))
    months = dim_date.select("date_key", "year_month")
    return (per_order.withColumn("first_row", (nth == 1).cast("int"))
            .join(months, "date_key", "left"))


def derive_product_totals(items: DataFrame) -> DataFrame:
    """Item sums per (product, order status)."""
    return items.groupBy("product_id", "order_status").agg(
        F.sum("total_item_value").alias("total_item_value"), F.sum("items").alias("items"))


def derive_seller_totals(items: DataFrame) -> DataFrame:
    """Item sums and distinct orders per (seller, order status).  The sums are
    combined before their shuffle, so the rows that tell the orders apart carry
    no amounts."""
    keys = ["seller_id", "order_status"]
    sums = items.groupBy(*keys).agg(F.sum("total_item_value").alias("total_item_value"))
    orders = (items.select(*keys, "order_id").distinct().groupBy(*keys)
              .agg(F.count("order_id").alias("orders")))
    return (sums.withColumn("orders", F.lit(0).cast("long")).unionByName(
        orders.withColumn("total_item_value", F.lit(None).cast(sums.schema["total_item_value"].dataType)))
        .groupBy(*keys).agg(F.sum("orders").alias("orders"),
                            F.sum("total_item_value").alias("total_item_value")))


@dataclass
class Star:
    dim_customer: DataFrame
    dim_product: DataFrame
    dim_seller: DataFrame
    dim_order: DataFrame
    dim_date: DataFrame
    fact_order_items: DataFrame
    # summaries (not model tables): written by the ETL when the star is
    # materialized, derived on the fly otherwise
    item_totals_table: DataFrame | None = None
    order_totals_table: DataFrame | None = None
    product_totals_table: DataFrame | None = None
    seller_totals_table: DataFrame | None = None
    # the stored fact with its folder column, by which scans can be pruned
    fact_by_month: DataFrame | None = None
    # folder of a stored star; its dashboard page and access path once written
    path: str | None = None
    page: object = None
    items_by_keys: DataFrame | None = None

    @property
    def fact(self) -> DataFrame:
        return self.fact_order_items

    def fact_in(self, days: DataFrame) -> DataFrame:
        """The fact's rows on ``days`` (rows of the calendar).  On a stored fact the
        join is also on its month folder, so the folders of other months are
        pruned at run time, by the months that the days turn out to have."""
        keys = ["date_key"]
        rows = self.fact
        if self.fact_by_month is not None:
            rows, keys = self.fact_by_month, ["date_key", FACT_FOLDER]
        return rows.join(days.select(*keys), keys, "left_semi").select(*self.fact.columns)

    @property
    def item_totals(self) -> DataFrame:
        if self.item_totals_table is not None:
            return self.item_totals_table
        return derive_item_totals(self.fact_order_items, self.dim_order)

    @property
    def order_totals(self) -> DataFrame:
        if self.order_totals_table is not None:
            return self.order_totals_table
        return derive_order_totals(self.item_totals, self.dim_date)

    @property
    def product_totals(self) -> DataFrame:
        if self.product_totals_table is not None:
            return self.product_totals_table
        return derive_product_totals(self.item_totals)

    @property
    def seller_totals(self) -> DataFrame:
        if self.seller_totals_table is not None:
            return self.seller_totals_table
        return derive_seller_totals(self.item_totals)

    def tables(self) -> dict[str, DataFrame]:
        return {n: getattr(self, n) for n in STAR_TABLES}

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)


def build_star(raw: dict[str, DataFrame]) -> Star:
    """Lazy star from the eight raw tables (dim_date is fed from the
    orders' purchase dates, as in the reference)."""
    dim_order = etl.build_dim_order(raw["orders"], raw["reviews"], raw["payments"])
    return Star(
        dim_customer=etl.build_dim_customer(raw["customers"]),
        dim_product=etl.build_dim_product(raw["products"], raw["cat"]),
        dim_seller=etl.build_dim_seller(raw["sellers"]),
        dim_order=dim_order,
        dim_date=etl.build_dim_date(dim_order.select("purchase_date")),
        fact_order_items=etl.build_fact(raw["items"], dim_order),
    )


@contextmanager
def _splitting_hot_keys(spark: SparkSession):
    """Skewed joins are split also where the operator above then needs a shuffle."""
    name = "spark.sql.adaptive.forceOptimizeSkewedJoin"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def _table_name(tag: str, name: str) -> str:
    return f"starbi_{tag}_{name}"


def materialize_star(spark: SparkSession, raw: dict[str, DataFrame], path: str,
                     buckets: int | None = None, tag: str = "star", journal=None) -> Star:
    """Run the ETL and persist the star under ``path`` (optionally with the
    two order-grain tables bucketed by ``order_id``); return the star read
    back from storage.  With a ``journal`` (:mod:`starbi.sources.publish`)
    tables that it holds are taken as they are, and the others are entered."""
    # Independent tables are written by concurrent jobs (Spark schedules
    # their tasks side by side).  dim_order comes first in its wave; the
    # fact and the calendar are derived from the written copy (it has three
    # consumers), and the order summary from the written fact.
    out: dict[str, DataFrame] = {}

    def journaled(name, write):
        table = journal.read(name) if journal is not None else None
        if table is None:
            describe_jobs(spark, f"star build: {name}")
            table = write()
            if journal is not None:
                journal.finish(name, table)
        return table

    def put(name, build):
        b = buckets if name in BUCKETED else None
        if name == "fact_order_items" and not b:
            # one folder per month, rows of an order side by side; the month is
            # a column of the layout, not of the model
            fact = build()
            month = F.concat_ws("-", F.substring(F.col("date_key").cast("string"), 1, 4),
                                F.substring(F.col("date_key").cast("string"), 5, 2))
            # an order that holds a large share of the items is cut by item and row;
            # the month and the total follow from the other columns after the shuffle
            out["fact_by_month"] = journaled(name, lambda: write_clustered(
                spark, fact.drop("total_item_value"), f"{path}/{name}",
                partition_by=FACT_FOLDER, cluster_by=("order_id",),
                unique_key=["order_item_id", F.xxhash64(*[c for c in fact.columns if c != "total_item_value"])],
                derived={"total_item_value": etl.item_value(), FACT_FOLDER: month},
                columns=[*fact.columns, FACT_FOLDER]))
            out[name] = out["fact_by_month"].select(*fact.columns)
            return
        out[name] = journaled(name, lambda: write_star_table(
            spark, build(), f"{path}/{name}", _table_name(tag, name), buckets=b, bucket_key=BUCKET_KEY))

    def wave(jobs):
        with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
            for f in [pool.submit(put, n, fn) for n, fn in jobs]:
                f.result()

    wave([("dim_order", lambda: etl.build_dim_order(raw["orders"], raw["reviews"],
                                                    raw["payments"])
           # rows clustered by status inside each file: the frequent status
           # filter skips row groups through Parquet statistics
           .sortWithinPartitions("order_status")),
          ("dim_customer", lambda: etl.build_dim_customer(raw["customers"])),
          ("dim_product", lambda: etl.build_dim_product(raw["products"], raw["cat"])),
          ("dim_seller", lambda: etl.build_dim_seller(raw["sellers"]))])
    wave([("fact_order_items", lambda: etl.build_fact(raw["items"], out["dim_order"])),
          ("dim_date", lambda: etl.build_dim_date(out["dim_order"].select("purchase_date")))])
    # the item-grain join once, written; the other summaries reduce it
    # (rows of an order side by side compress, and meet in one task's partial sums)
    with _splitting_hot_keys(spark):
        items = journaled("item_totals", lambda: write_star_table(
            spark, derive_item_totals(out["fact_order_items"], out["dim_order"])
            .sortWithinPartitions("order_id"), f"{path}/item_totals"))
    aux: dict[str, DataFrame] = {"item_totals": items}

    def put_order_totals():
        # one folder per month (month-range reports prune folders), rows
        # clustered by status inside each file
        aux["order_totals"] = journaled("order_totals", lambda: write_clustered(
            spark, derive_order_totals(items, out["dim_date"]), f"{path}/order_totals",
            partition_by="year_month", cluster_by=("order_status",), unique_key="order_id"))

    def put_summary(name, df):
        aux[name] = journaled(name, lambda: write_star_table(spark, df, f"{path}/{name}"))

    with ThreadPoolExecutor(max_workers=3) as pool:
        for f in [pool.submit(put_order_totals),
                  pool.submit(put_summary, "product_totals", derive_product_totals(items)),
                  pool.submit(put_summary, "seller_totals", derive_seller_totals(items))]:
            f.result()
    describe_jobs(spark, None)
    return Star(**out, **{f"{name}_table": df for name, df in aux.items()}, path=path)


_CACHE: dict[tuple, Star] = {}
_LOCK = threading.Lock()


def star_for(spark: SparkSession, sf_dir: str, persist: bool = True) -> Star:
    """The star for the test tables under ``sf_dir``.

    With ``persist`` (default) the ETL runs once per application and state of
    the input files (their lengths and times) and writes the star to the
    session's checkpoint folder, which the application removes when it ends;
    later calls reuse the written tables.  Without it the lazy star is returned.
    """
    from starbi.sources.testdata import input_mark, load_raw_from_testdata

    if not persist:
        return build_star(load_raw_from_testdata(spark, sf_dir))
    app = application_id(spark)
    key = (app, sf_dir.rstrip("/"), spark.conf.get(BUCKETS_CONF, "0") or "0",
           input_mark(spark, sf_dir))
    with _LOCK:
        star = _CACHE.get(key)
        if star is not None:
            return star
        raw = load_raw_from_testdata(spark, sf_dir)
        tag = hashlib.sha1("|".join(key).encode()).hexdigest()[:10]
        path = f"{checkpoint_dir(spark).rstrip('/')}/starbi-star/{tag}"
        buckets = int(spark.conf.get(BUCKETS_CONF, "0") or 0) or None
        remove_at_exit(spark, path)
        with freeing_shuffles(spark):
            star = materialize_star(spark, raw, path, buckets=buckets, tag=tag)
        _CACHE[key] = star
        return star
