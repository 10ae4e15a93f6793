"""Name -> query registry used by ``__spark_entry__`` and ``bench.py``.

Every entry reads the test tables under ``sf_dir`` through the raw
adapter, builds (once per application and folder) the persisted star, and
runs one question over the whole star; results are returned in
engine-neutral column types (:func:`portable`).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType, TimestampType

from starbi.operators import measures, quality
from starbi.operators.digest import column_digests, md5_number, verify_tables
from starbi.operators.etl import build_dim_date, build_fact
from starbi.plans import analysis as A
from starbi.plans import oracle_sql as O
from starbi.plans import lookups, page
from starbi.plans.pipeline import open_star, publish_star
from starbi.plans.star import Star, build_star, star_for
from starbi.plans.sql import ask, catalog_inventory, register_views
from starbi.schemas import RAW_FILES
from starbi.session import checkpoint_dir, remove_at_exit
from starbi.sources.publish import current
from starbi.sources.readers import audit_raw_numbers, load_raw_csv, load_star
from starbi.sources.testdata import load_raw_from_testdata, raw_as_text, raw_csv_tables
from starbi.sources.writers import write_csv, write_star_csv, write_star_table

TEST_MONTHS = O.TEST_MONTHS
MEASURE_SLICE = {"year": [1997, 1998]}

MOM_SLICE = {"year": [1997], "state": ["NATION_2", "NATION_3", "NATION_18"]}

# one product, one seller and one customer to look up
LOOKUP = {"product_id": 77, "seller_id": 5, "customer_id": 130}

# year, state and category slicers of the dashboard page
PAGE_SLICE = {"year": [1997, 1998], "state": [f"NATION_{i}" for i in range(3, 11)],
              "category_en": [f"cat_{i}" for i in (1, 2, 3, 4, 6, 8, 9, 10, 11, 12, 13, 14)]}


def _catalog(star: Star) -> DataFrame:
    """S-3: the model tables listed from the session's catalog."""
    register_views(star, "starbi_")
    listed = catalog_inventory(star.fact.sparkSession, "starbi_")
    return listed.select(F.regexp_replace("name", "^starbi_", "").alias("name"), "c").orderBy("name")


def _folder(spark: SparkSession, label: str) -> str:
    path = f"{checkpoint_dir(spark).rstrip('/')}/starbi-io/{label}-{uuid.uuid4().hex}"
    remove_at_exit(spark, path)
    return path


# what tells rows of a table apart (repeated rows are counted as often as they stand)
_KEYS = {**{t: [k] for t, k in quality.PRIMARY_KEYS.items()},
         "fact_order_items": ["order_id", "order_item_id"]}


def _verified(star: Star, back: Star) -> DataFrame:
    return verify_tables(star.tables(), back.tables(), _KEYS, hasher=md5_number)


def _through_csv(star: Star) -> DataFrame:
    """K-1 and S-5: all tables after the CSV export and back, column by column."""
    spark = star.fact.sparkSession
    path = _folder(spark, "csv")
    write_star_csv(star.tables(), path)
    return _verified(star, load_star(spark, path, "csv"))


def _through_parquet(star: Star) -> DataFrame:
    """K-2, K-3 and S-5: all tables after a write, a rebuild over it, and back."""
    spark = star.fact.sparkSession
    path = _folder(spark, "parquet")
    for _ in range(2):
        for name, df in star.tables().items():
            write_star_table(spark, df, f"{path}/{name}")
    return _verified(star, load_star(spark, path))


def _from_raw_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-1: the eight raw tables written as quoted CSV, read back and made into the
    star; a digest of every column of its tables."""
    path = _folder(spark, "raw")
    for name, df in raw_csv_tables(load_raw_from_testdata(spark, sf_dir)).items():
        write_csv(df, f"{path}/{RAW_FILES[name]}")
    tables = load_raw_csv(spark, path)
    star = build_star(tables)
    # dim_order has three consumers: made once, as the ETL job does
    orders = write_star_table(spark, star.dim_order, f"{path}/star/dim_order")
    star = replace(star, dim_order=orders, dim_date=build_dim_date(orders.select("purchase_date")),
                   fact_order_items=build_fact(tables["items"], orders))
    parts = [column_digests(df, _KEYS[name], hasher=md5_number).groupBy("coluna").agg(
        F.sum("linhas").alias("linhas"), F.sum("preenchidos").alias("preenchidos"),
        F.sum("resumo").cast("string").alias("resumo"))
        .select(F.lit(name).alias("tabela"), "*") for name, df in star.tables().items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def _published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K-3: a version of the star built and published; rows and hash of each table of
    the version that readers open."""
    path = _folder(spark, "published")
    publish_star(spark, load_raw_from_testdata(spark, sf_dir), path, "v1", md5_number)
    _, _, manifest = current(spark, path)
    star = open_star(spark, path)
    parts = [column_digests(star[n], _KEYS[n], 1, md5_number).agg(
        F.max("linhas").alias("linhas"), F.sum("resumo").cast("string").alias("resumo"))
        .select(F.lit(n).alias("tabela"), "*", F.lit(manifest[n]["rows"]).cast("long").alias("linhas_manifesto"))
        for n in star.tables()]
    return reduce(lambda a, b: a.unionByName(b), parts)


# name -> (function of the star, oracle SQL or None)
_SPEC: dict[str, tuple[Callable[[Star], DataFrame], str | None]] = {
    "etl_dim_customer": (lambda s: s.dim_customer, O._etl("dim_customer")),
    "etl_dim_product": (lambda s: s.dim_product, O._etl("dim_product")),
    "etl_dim_seller": (lambda s: s.dim_seller, O._etl("dim_seller")),
    "etl_dim_order": (lambda s: s.dim_order, O._etl("dim_order")),
    "etl_dim_date": (lambda s: s.dim_date, O._etl("dim_date")),
    "etl_fact_order_items": (lambda s: s.fact_order_items, O._etl("fact_order_items")),
    "quality_report": (quality.quality_report, O.QUALITY_REPORT),
    "q01_overview": (A.q01_overview, O.Q01),
    "q02_monthly_mom": (A.q02_monthly_mom, O.Q02),
    "q03_top_categories": (A.q03_top_categories, O.Q03),
    "q04_pareto": (A.q04_pareto, O.Q04),
    "q04_pareto_products": (A.pareto_products, O.PARETO_PRODUCTS),
    "q03_product_ranks": (A.product_ranks, O.PRODUCT_RANKS),
    "q05_rfm_segments": (A.q05_rfm_segments, O.q05_rfm_segments()),
    "q05_rfm_segments_recent_high": (partial(A.q05_rfm_segments, recency="recent_high"),
                                     O.q05_rfm_segments("recent_high")),
    "q05_rfm_scores": (A.q05_rfm_scores, O.q05_rfm_scores()),
    "q06_logistics_by_state": (A.q06_logistics_by_state, O.q06_logistics_by_state(100)),
    "q06_logistics_by_state_min200": (partial(A.q06_logistics_by_state, min_orders=200),
                                      O.q06_logistics_by_state(200)),
    "q07_delay_vs_rating": (A.q07_delay_vs_rating, O.Q07),
    "q08_payment_mix": (A.q08_payment_mix, O.Q08),
    "q09_top_sellers": (A.q09_top_sellers, O.Q09),
    "q10_repeat_customers": (A.q10_repeat_customers, O.Q10),
    "kpi_monthly_revenue": (partial(A.kpi_monthly_revenue, months=TEST_MONTHS),
                            O.kpi_monthly_revenue(TEST_MONTHS)),
    "kpi_top_categories": (A.kpi_top_categories, O.KPI_TOP_CATEGORIES),
    "kpi_delay_vs_rating": (A.kpi_delay_vs_rating, O.KPI_DELAY_VS_RATING),
    "kpi_payment_mix": (A.kpi_payment_mix, O.KPI_PAYMENT_MIX),
    "kpi_headline": (A.kpi_headline, O.KPI_HEADLINE),
    "table_inventory": (quality.table_inventory, O.TABLE_INVENTORY),
    "nb_monthly_mom": (partial(A.nb_monthly_mom, months=TEST_MONTHS),
                       O.nb_monthly_mom(TEST_MONTHS)),
    "nb_monthly_mom_tail": (partial(A.nb_monthly_mom_tail, months=TEST_MONTHS),
                            O.nb_monthly_mom_tail(TEST_MONTHS)),
    "nb_delay_bands": (A.nb_delay_bands, O.NB_DELAY_BANDS),
    "nb_rfm_segments": (A.nb_rfm_segments, O.NB_RFM_SEGMENTS),
    "measures_by": (partial(measures.measures_by, by=("year", "state")),
                    O.measures_by(("year", "state"))),
    "measures_by_category_sliced": (
        partial(measures.measures_by, by=("category_en",), slicers=MEASURE_SLICE),
        O.measures_by(("category_en",), MEASURE_SLICE)),
    "measures_total": (measures.measures_total, O.measures_by(())),
    "measure_mom_calendar": (measures.measure_mom_calendar, O.MEASURE_MOM_CALENDAR),
    "measure_mom_sliced": (partial(measures.measure_mom_calendar, slicers=MOM_SLICE),
                           O.measure_mom({"state": MOM_SLICE["state"]}, "year = 1997")),
    "page_cards_sliced": (partial(page.measures, slicers=PAGE_SLICE), O.measures_by((), PAGE_SLICE)),
    "page_measures_by_state_sliced": (partial(page.measures, by=("state",), slicers=PAGE_SLICE),
                                      O.measures_by(("state",), PAGE_SLICE)),
    "page_measures_by_category": (partial(page.measures, by=("year", "category_en")),
                                  O.measures_by(("year", "category_en"))),
    "page_delivery_by_state_sliced": (partial(page.delivery_by_state, slicers=PAGE_SLICE),
                                      O.page_delivery_by_state(PAGE_SLICE)),
    "page_rating_by_band_sliced": (partial(page.rating_by_band, slicers=PAGE_SLICE),
                                   O.page_rating_by_band(PAGE_SLICE)),
    "page_top_categories_sliced": (partial(page.top_categories, slicers=PAGE_SLICE),
                                   O.page_top_categories(PAGE_SLICE)),
    "page_monthly_line_sliced": (partial(page.monthly_line, slicers=PAGE_SLICE),
                                 O.page_monthly_line(PAGE_SLICE)),
    "lookup_product_items": (partial(lookups.items_of, product_id=LOOKUP["product_id"]),
                             O.lookup("product_id", LOOKUP["product_id"])),
    "lookup_seller_items": (partial(lookups.items_of, seller_id=LOOKUP["seller_id"]),
                            O.lookup("seller_id", LOOKUP["seller_id"])),
    "lookup_customer_items": (partial(lookups.items_of, customer_id=LOOKUP["customer_id"]),
                              O.lookup("customer_id", LOOKUP["customer_id"])),
    "sql_q01_overview": (partial(ask, question="q01_overview"), O.Q01),
    "sql_q02_monthly_mom": (partial(ask, question="q02_monthly_mom"), O.Q02),
    "sql_q04_pareto": (partial(ask, question="q04_pareto"), O.Q04),
    "sql_q06_logistics_by_state": (partial(ask, question="q06_logistics_by_state", min_orders=200),
                                   O.q06_logistics_by_state(200)),
    "audit_schema": (quality.audit_schema, O.AUDIT_SCHEMA),
    "catalog_inventory": (lambda s: _catalog(s), O.TABLE_INVENTORY),
    "io_csv_roundtrip": (lambda s: _through_csv(s), O.round_trip(O.PRELUDE)),
    "io_parquet_roundtrip": (lambda s: _through_parquet(s), O.round_trip(O.PRELUDE)),
    "audit_pk": (quality.audit_pk, O.AUDIT_PK),
    "audit_fk": (quality.audit_fk, O.AUDIT_FK),
    "audit_domain": (quality.audit_domain, O.AUDIT_DOMAIN),
}


# audits over the raw tables: (spark, sf_dir) -> DataFrame, oracle SQL
_RAW_SPEC: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]] = {
    "publish_star": (_published, O.PUBLISHED),
    "etl_from_raw_csv": (_from_raw_csv, O.digests(O.WHOLE_SECONDS)),
    "audit_dropped_items": (
        lambda spark, sf: quality.audit_dropped_items(load_raw_from_testdata(spark, sf)["items"],
                                                      star_for(spark, sf).dim_order),
        O.AUDIT_DROPPED_ITEMS),
    "audit_raw_timestamps": (
        lambda spark, sf: quality.audit_raw_timestamps(load_raw_from_testdata(spark, sf)["orders"]),
        O.AUDIT_RAW_TIMESTAMPS),
    "audit_raw_numbers": (
        lambda spark, sf: audit_raw_numbers(raw_as_text(load_raw_from_testdata(spark, sf))),
        O.AUDIT_RAW_NUMBERS),
}


def portable(df: DataFrame, dates: bool = False) -> DataFrame:
    """Result columns in engine-neutral types: money (exact to the cent) as
    DOUBLE, the reference's declared REAL; wall-clock timestamps, and dates
    unless ``dates`` keeps them, as ISO text.  The persisted star keeps
    DECIMAL / DATE / TIMESTAMP."""
    cols = []
    for f in df.schema.fields:
        t, c = f.dataType, F.col(f"`{f.name}`")
        if isinstance(t, DecimalType):
            c = c.cast("double")
        elif isinstance(t, TimestampNTZType) or isinstance(t, DateType) and not dates:
            # ISO text: yyyy-MM-dd / yyyy-MM-dd HH:mm:ss, no time zone involved
            c = c.cast("string")
        elif isinstance(t, TimestampType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _runner(fn: Callable[[Star], DataFrame],
            dates: bool = False) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(fn(star_for(spark, sf_dir)), dates)
    return run


def _raw_runner(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(fn(spark, sf_dir))
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {name: _runner(fn, dates=name.startswith(("etl_", "io_")))
           for name, (fn, _) in _SPEC.items()}
    out.update({name: _raw_runner(fn) for name, (fn, _) in _RAW_SPEC.items()})
    return out


def oracle_sql() -> dict[str, str]:
    out = {name: sql for name, (_, sql) in _SPEC.items() if sql is not None}
    out.update({name: sql for name, (_, sql) in _RAW_SPEC.items()})
    return out
