"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again for the next.

Toxic documents go, one of equal and one of nearly equal documents stays, contaminated documents go, and what is left is
encoded and decoded again. A stage works on all rows that the one before kept; all but the last give the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from loadgauge.llm import byte_bpe
from loadgauge.llm.common import or_empty, read
from loadgauge.llm.decontaminate import drop_contaminated
from loadgauge.llm.exact_dedup import drop_copies
from loadgauge.llm.near_dup import drop_near_copies
from loadgauge.llm.queries import TOXIC, toxic_network
from loadgauge.llm.toxicity import toxicity as scored
from loadgauge.session import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    network = toxic_network(docs, read(spark, sf_dir, "labels"))
    return scored(docs, network).where(F.col("score") < TOXIC).select("row.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five words and a similarity of 0.8 or more."""
    return drop_near_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with n_tokens, their token ids as little-endian unsigned 32-bit integers, and whether these decode to the text."""
    made = byte_bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, decode=True)
    same = F.col("decoded") == or_empty(F.col("row.text")).cast("binary")
    return made.select("row.*", "n_tokens", "ids", same.alias("round_trip"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("byte_bpe", encode),
]

#: SQL cannot express the network of the first stage nor the merges of the last.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
