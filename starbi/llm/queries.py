"""Registered queries of the numbered operators: each applies its operator,
with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starbi.llm import (bpe, brown, chat, ctph, decontam, negatives, quality, rules, secrets,
                        simhash, urlfilter, warc, whitening)
from starbi.llm.common import read_table

#: parts of host labels that put a host on the block list
BLOCKED_HOST_WORDS = ("ads", "adult", "bets", "casino", "pills", "spam")
#: percent of a host's pages blocked by rules from which it is on the list
BLOCKED_SHARE = 10
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(read_table(spark, sf_dir, "documents"),
                                  public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN,
                                  bpe.WORD_CUTS)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed are the hosts of whose pages a tenth or more is blocked by a rule, and
    those with one of the blocked words as a part of a label."""
    pages = read_table(spark, sf_dir, "pages")
    listed = urlfilter.suspect_hosts(pages, BLOCKED_HOST_WORDS, BLOCKED_SHARE)
    return urlfilter.filter_urls(pages, listed).drop("listed")


def op4_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.score(read_table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read_table(spark, sf_dir, "documents"),
                            read_table(spark, sf_dir, "labels"))


def op6_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat.perspectives(read_table(spark, sf_dir, "conversations"))
    return rows.withColumn("masks", chat.mask_text(F.col("masks")))


def op7_ctph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctph.against_next(read_table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.verdicts(read_table(spark, sf_dir, "documents"),
                             read_table(spark, sf_dir, "benchmark")).drop("h")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_archive(*warc.write_archive(read_table(spark, sf_dir, "pages")))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(read_table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = read_table(spark, sf_dir, "embeddings").withColumn("label", label)
    return negatives.mine(rows, F.col("vec_id") % 50 == 0)


def op13_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_byte_bpe, op2_simhash, op3_url_filter, op4_brown_lm, op5_quality,
                            op6_chat_perspectives, op7_ctph, op8_decontamination, op9_warc,
                            op10_secrets, op11_whitening, op12_hard_negatives,
                            op13_rules)}
