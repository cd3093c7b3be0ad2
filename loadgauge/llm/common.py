"""What several operators share: numbered rows in the shared folder, and Arrow helpers for tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import stage

#: A-Z and a-z; the white space of the word rules.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WHITE = " \t\n\x0b\x0c\r"

#: Bytes of text a task works on at once.
BATCH_BYTES = 4 << 20


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def numbered(df: DataFrame, name: str, **more: Column) -> DataFrame:
    """``df`` stored as (rid, row, *more): a number for each row, also for repeated ones, and the row's columns as one struct.

    Numbers are given once and read back from files, so they stay the same when executors are lost. Packing
    the columns keeps any names the input has apart from the operator's own.
    """
    made = df.select(F.monotonically_increasing_id().alias("rid"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[c.alias(k) for k, c in more.items()])
    return stage(made, name)


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that ``column`` has about ``limit`` bytes in each; one longer value stays whole."""
    for batch in batches:
        start, size = 0, 0
        lengths = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        for i, n in enumerate(lengths):
            if size and size + n > limit:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += int(n)
        if start < len(lengths):
            yield batch.slice(start)


class WordHashes(dict):
    """64-bit hashes of words, remembered up to ``limit`` words."""

    def __init__(self, limit: int = 150_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) > self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value
