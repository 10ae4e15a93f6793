"""SQL access to the star (S-2, S-3).

``register_views`` exposes the six model tables as temporary views so that
questions can be asked in SQL (``spark.sql(...)``) exactly as against the
persisted model; Catalyst plans SQL text and DataFrame code the same way.
``catalog_inventory`` lists the registered model tables from the catalog,
sorted by name, with their row counts.

``ask`` runs a question given as SQL text.  The views include the summaries that the
ETL writes, and three temporary SQL functions give the text what the DataFrame forms
have: ``sb_cents`` (a money amount as whole cents), ``sb_round`` (ROUND of a ratio,
exact, half away from zero) and ``sb_ratio`` (null for a zero denominator).  They are
SQL themselves, so the optimizer sees through them.  Values come in as parameters
(``:status``), never by pasting text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starbi.plans.star import STAR_TABLES, SUMMARIES, Star

PREFIX = "starbi_"

# a quotient of whole numbers is taken from an exact multiple, as in functions.hround
_FUNCTIONS = {
    "sb_cents(amount DECIMAL(38,2)) RETURNS DECIMAL(38,0)": "CAST(amount * 100 AS DECIMAL(38,0))",
    "sb_quotient(a DECIMAL(38,0), b DECIMAL(38,0)) RETURNS DECIMAL(38,0)":
        "CAST((a - pmod(a, b)) / b AS DECIMAL(38,0))",
    "sb_round(num DECIMAL(38,0), den DECIMAL(38,0), digits INT) RETURNS DOUBLE": """
      CASE WHEN den <> 0 THEN
        (CASE WHEN (num < 0) <> (den < 0) THEN -1 ELSE 1 END)
        * CAST(sb_quotient(CAST(abs(num) * CAST(2 * power(10, digits) AS DECIMAL(10,0)) AS DECIMAL(38,0))
                           + abs(den), abs(den) * 2) AS DOUBLE) / power(10, digits) END""",
    "sb_ratio(num DOUBLE, den DOUBLE) RETURNS DOUBLE": "try_divide(num, den)",
}

# Questions as text; the views are those of register_views with PREFIX.
QUESTIONS = {
    "q01_overview": """
      SELECT pedidos, CAST(p AS DOUBLE) AS receita_produtos, CAST(f AS DOUBLE) AS receita_frete,
             CAST(t AS DOUBLE) AS receita_total, sb_round(sb_cents(t), pedidos * 100, 2) AS ticket_medio
      FROM (SELECT CAST(coalesce(sum(first_row), 0) AS BIGINT) AS pedidos, sum(price) AS p,
                   sum(freight_value) AS f, sum(total_item_value) AS t
            FROM starbi_order_totals WHERE order_status = :status)""",
    "q02_monthly_mom": """
      SELECT year_month, CAST(receita AS DOUBLE) AS receita, CAST(prev AS DOUBLE) AS receita_mes_anterior,
             sb_round((sb_cents(receita) - sb_cents(prev)) * 100, sb_cents(prev), 1) AS crescimento_pct
      FROM (SELECT year_month, receita, lag(receita) OVER (ORDER BY year_month) AS prev
            FROM (SELECT year_month, sum(total_item_value) AS receita FROM starbi_order_totals
                  WHERE order_status = :status AND year_month IS NOT NULL GROUP BY year_month))
      ORDER BY year_month""",
    "q04_pareto": """
      SELECT category_en, CAST(receita AS DOUBLE) AS receita,
             sb_round(sb_cents(upto) * 100, sb_cents(total), 1) AS pct_acumulado
      FROM (SELECT category_en, receita, sum(receita) OVER (ORDER BY receita DESC) AS upto,
                   sum(receita) OVER () AS total
            FROM (SELECT category_en, sum(r) AS receita
                  FROM (SELECT product_id, sum(total_item_value) AS r
                        FROM starbi_fact_order_items GROUP BY product_id)
                  JOIN (SELECT product_id, category_en FROM starbi_dim_product) USING (product_id)
                  GROUP BY category_en))
      ORDER BY receita DESC, category_en""",
    "q06_logistics_by_state": """
      SELECT state, n AS pedidos, sb_round(dd, ddn, 1) AS dias_entrega_medio,
             sb_round(ot * 100, otn, 1) AS pct_no_prazo, sb_round(rs, rsn, 2) AS nota_media
      FROM (SELECT state, sum(n) AS n, sum(dd) AS dd, sum(ddn) AS ddn, sum(ot) AS ot, sum(otn) AS otn,
                   sum(rs) AS rs, sum(rsn) AS rsn
            FROM (SELECT customer_id, count(*) AS n, sum(delivery_days) AS dd, count(delivery_days) AS ddn,
                         sum(on_time) AS ot, count(on_time) AS otn, sum(review_score) AS rs,
                         count(review_score) AS rsn
                  FROM starbi_dim_order WHERE order_status = :status AND delivery_days IS NOT NULL
                  GROUP BY customer_id)
            JOIN (SELECT customer_id, state FROM starbi_dim_customer) USING (customer_id)
            GROUP BY state)
      WHERE n >= :min_orders
      ORDER BY dias_entrega_medio DESC NULLS LAST, state""",
}
DEFAULTS = {"status": "delivered", "min_orders": 100}


def register_functions(spark: SparkSession) -> None:
    for head, body in _FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")


def ask(star: Star, question: str, **parameters) -> DataFrame:
    """A question of :data:`QUESTIONS`, or any SQL text over the views, with named
    parameters (``status`` and ``min_orders`` have defaults)."""
    spark = star.fact.sparkSession
    register_functions(spark)
    register_views(star, PREFIX, summaries=True)
    text = QUESTIONS.get(question, question)
    return spark.sql(text, args={**DEFAULTS, **parameters})


def register_views(star: Star, prefix: str = "", summaries: bool = False) -> list[str]:
    names = []
    for name in [*STAR_TABLES, *(SUMMARIES if summaries else ())]:
        view = f"{prefix}{name}"
        star[name].createOrReplaceTempView(view)
        names.append(view)
    return names


def catalog_inventory(spark: SparkSession, prefix: str = "") -> DataFrame:
    """Model tables present in the session catalog (views or tables), sorted
    by name, each with ``COUNT(*)``.  The listing is the catalog's (a handful
    of names); the counts run as one unioned Spark job."""
    wanted = {f"{prefix}{n}" for n in STAR_TABLES}
    present = sorted(t.name for t in spark.catalog.listTables() if t.name in wanted)
    parts = [spark.table(n).agg(F.count(F.lit(1)).alias("c")).select(F.lit(n).alias("name"), "c")
             for n in present]
    if not parts:
        return spark.createDataFrame([], "name string, c long")
    return reduce(lambda a, b: a.unionByName(b), parts).orderBy("name")
