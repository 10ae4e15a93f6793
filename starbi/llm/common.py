"""Helpers shared by the operators: table access, tables written to the shared
folder to cut lineage, and small column expressions."""

from __future__ import annotations

import os
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starbi.session import checkpoint_dir, remove_at_exit

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: str.translate table for the same mapping inside Python tasks
ASCII_LOWER = {ord(a): b for a, b in zip(UPPER, LOWER)}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder of the session and read back.

    Cuts lineage: a lost executor re-reads files instead of repeating the
    work, and values such as generated row ids stay fixed.  The folder goes
    when the application's JVM ends.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"
    remove_at_exit(spark, path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def by_shuffle(df: DataFrame) -> DataFrame:
    """``df`` as a side of a sort-merge join, neither side of which is broadcast.

    For rows whose size Spark takes too low: it counts an explode's rows as those
    before it, and a written table's as the bytes of its files.
    """
    return df.hint("merge")


def workers_see_package(spark: SparkSession) -> None:
    """Python workers import this package from where the driver has it.  (On a
    cluster it is installed or passed with ``--py-files`` as usual.)"""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    have = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in have:
        env["PYTHONPATH"] = os.pathsep.join([root, *have])


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(col: Column) -> Column:
    """A-Z to a-z, every other character untouched (``lower`` would fold É)."""
    return F.translate(col, UPPER, LOWER)


def crc_remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus`` (null for a null id)."""
    return F.crc32(F.col(id_col).cast("string")) % modulus
