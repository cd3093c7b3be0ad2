"""Counts over the raw requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.logline import request_extension


def share_of_total(counts: DataFrame, count: str = "request_count") -> DataFrame:
    """Add each row's percentage of all rows counted; the total is taken from the counts, not the log."""
    total = counts.agg(F.sum(count)).scalar()
    return counts.withColumn("percentage", F.col(count) / total * F.lit(100.0))


def top_k(counts: DataFrame, by: str, name: str, k: int) -> DataFrame:
    """The k highest, ties by name."""
    return counts.orderBy(F.desc(by), F.asc(name)).limit(k)


def top_hosts(log: DataFrame, k: int = 20) -> DataFrame:
    """Hosts with most requests; requests without a usable time count as well."""
    counts = log.groupBy("host").agg(F.count(F.lit(1)).alias("request_count"))
    return top_k(share_of_total(counts), "request_count", "host", k)


def content_report(log: DataFrame, k: int = 15) -> DataFrame:
    """File types with most requests."""
    counts = log.groupBy(request_extension(F.col("request")).alias("file_type")).agg(F.count(F.lit(1)).alias("count"))
    return top_k(counts, "count", "file_type", k)
