"""Small tables with every awkward case, for all operators."""

from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from llm.helpers import CLASH, DOC_SCHEMA, awkward_texts

@pytest.fixture(scope="session")
def docs(spark: SparkSession):
    """Awkward documents: a null id, repeated rows, one id with two texts, nulls
    in every column."""
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(awkward_texts())]
    rows += [rows[9], rows[9], (3, "another text of the same id", None, None, None),
             (None, rows[8][1], None, None, None), (None, "no id here", "en", "s", 10)]
    return spark.createDataFrame(rows, DOC_SCHEMA)


@pytest.fixture(scope="session")
def crowded(docs):
    """The same rows with further columns of clashing names."""
    from pyspark.sql import functions as F
    return docs.select("*", *[F.lit("x").alias(c) for c in CLASH])


@pytest.fixture(scope="session")
def no_docs(spark: SparkSession):
    return spark.createDataFrame([], DOC_SCHEMA)
