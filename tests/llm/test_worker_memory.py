"""What the pipeline's Python workers hold at a time."""
import pytest
from pyspark.sql import functions as F
from pyspark.util import PythonEvalType

from starbi.llm import bpe, quality, simhash


@pytest.mark.parametrize("column", [
    lambda spark, c: simhash.fingerprint_column(c),
    lambda spark, c: quality.score_column(quality.Model(), spark, c)])
def test_no_batch_of_texts_becomes_python_strings(spark, column):
    df = spark.createDataFrame([("a b c",), (None,), ("",)], "text string")
    out = df.select(column(spark, F.col("text")).alias("x"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    line = next(x for x in plan.splitlines() if "ArrowEvalPython" in x)
    assert line.rstrip().endswith(f", {PythonEvalType.SQL_SCALAR_ARROW_UDF}")
    assert out.count() == 3 and out.where("x is null").count() == 0


def test_shared_workers_keep_smaller_token_tables():
    assert bpe.ROW_MOVES <= bpe.MAX_MOVES // 4 and bpe.ROW_WORDS <= bpe.MAX_WORDS // 4
