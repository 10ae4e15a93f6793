"""Questions as SQL text: same rows and same plan shapes as the DataFrame forms."""
import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starbi.functions import hround
from starbi.plans import analysis as A
from starbi.plans import sql

FORMS = {"q01_overview": A.q01_overview, "q02_monthly_mom": A.q02_monthly_mom, "q04_pareto": A.q04_pareto,
         "q06_logistics_by_state": lambda s: A.q06_logistics_by_state(s, min_orders=5)}


@pytest.mark.parametrize("name", FORMS)
def test_text_gives_the_rows_and_the_plan_of_the_dataframe(star_small, name):
    got = sql.ask(star_small, name, min_orders=5)
    want = FORMS[name](star_small)
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]
    assert got.columns == want.columns

    def shape(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = plan.split("== Initial Plan ==")[-1]
        return [sorted(re.findall(r"Exchange \w+", plan)), len(re.findall(r"Scan parquet", plan)),
                len(re.findall(r"\bWindow\b", plan)), len(re.findall("HashAggregate", plan)),
                sorted(re.findall(r"PushedFilters: \[[^\]\n.]*", plan))]
    assert shape(got) == shape(want)


def test_parameters_are_values(star_small):
    none = sql.ask(star_small, "q01_overview", status="x' OR '1'='1").first()
    assert none.pedidos == 0 and none.receita_total is None
    every = sql.ask(star_small, "SELECT count(*) AS n FROM starbi_dim_order WHERE review_score >= :low", low=4).first().n
    assert every == star_small.dim_order.where("review_score >= 4").count()


def test_rounding_function_is_exact(spark, star_small):
    sql.register_functions(spark)
    rng = random.Random(2)
    rows = [(Decimal(rng.randint(-10 ** 12, 10 ** 12)), Decimal(rng.choice([0, 1, 3, 7, -8, 40, 999, 10 ** 9])))
            for _ in range(300)] + [(Decimal(5), Decimal(1000)), (Decimal(-5), Decimal(1000)), (None, Decimal(1))]
    df = spark.createDataFrame(rows, "a decimal(38,0), b decimal(38,0)")
    for digits in (0, 1, 2):
        got = df.select(F.expr(f"sb_round(a, b, {digits})").alias("x"), hround("a", "b", digits).alias("y")).collect()
        assert [r.x for r in got] == [r.y for r in got]
    assert spark.sql("SELECT sb_ratio(1, 0) AS r, sb_cents(12.34BD) AS c").first() == (None, Decimal(1234))
