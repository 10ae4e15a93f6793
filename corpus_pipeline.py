"""A training-data pipeline over ``documents``: five stages, each an operator of
``starbi.llm`` applied to everything that its predecessor kept.

Cases (each operator's module gives the details): null and empty texts, null
ids, repeated rows, empty tables and further columns pass through, but of each
group of near duplicates one row stays: rows that share an id are one document,
and a row without an id stays only if no row of its group has one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starbi.llm import bpe, decontam, quality, secrets, simhash
from starbi.llm.common import read_table, stored
from starbi.llm.queries import VOCABULARY


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = quality.train(docs, read_table(spark, sf_dir, "labels"))
    return docs.where(quality.score_column(model, spark, docs["text"]) >= quality.THRESHOLD)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, the first row with the smallest id."""
    rows = stored(docs.withColumn("__llm_row", F.monotonically_increasing_id()), "pipeline-rows")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__llm_row"))
    kept = (simhash.near_duplicates(rows, row_col="__llm_row").groupBy("component")
            .agg(first.alias("first")).select(F.col("first.__llm_row").alias("__llm_row")))
    return rows.join(kept, "__llm_row", "left_semi").drop("__llm_row")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate."""
    return decontam.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked."""
    return secrets.redact(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, token ids, their number, and the digests of the ids
    and of the decoded bytes."""
    tokenizer = bpe.Tokenizer(spark, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN,
                              bpe.WORD_CUTS)
    return tokenizer.encode_rows(docs.select("doc_id", "lang", "source", "text"))


STAGES = [("quality", quality_stage), ("near_dedup", near_dedup_stage),
          ("decontamination", decontamination_stage), ("secrets", secrets_stage),
          ("bpe", bpe_stage)]

#: SQL can't express the trained classifier or the token merges
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and reread."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
