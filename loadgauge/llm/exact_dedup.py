"""Exact duplicates by distributed MSD radix partitioning.

Documents are split by the first bytes of their normalised text, each part again by the next bytes, until a part holds
one document or its texts have ended; texts that end in the same part are equal, so no digest is needed. A digit is a run of
bytes that gets longer from round to round: the rounds needed grow with the logarithm of the longest text, and a
document leaves at the first digit it shares with no other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import stage
from .common import WHITE, numbered, or_empty

#: Bytes of the first digit, and how much longer each next one is.
FIRST_DIGIT, DIGIT_GROWTH = 32, 8
#: No binary value of Spark is longer.
LONGEST = (1 << 31) - 1


def normalised(text: Column) -> Column:
    """The text without the six white space characters of ASCII; null is empty."""
    return F.translate(or_empty(text), WHITE, "")


def _split(work: DataFrame, width: int) -> DataFrame:
    """One round: the rows that share their part's next digit with another row, with their part's new number.

    Parts are counted with partial sums, so a part with most of the rows costs each task one row. The parts come back by
    an equi-join whose large partitions Spark splits; a text that has gone its own way takes no part in later rounds.
    """
    cut = work.select(
        "rid", "n_points", "id", "part", F.substring("rest", 1, width).alias("digit"), F.substring("rest", width + 1, LONGEST).alias("rest"),
        (F.length("rest") <= width).alias("ended"),
    )
    parts = cut.groupBy("part", "digit", "ended").agg(F.count(F.lit(1)).alias("size"), F.min("rid").alias("next"))
    shared = stage(parts.where("size > 1"), "radix-parts")
    # Sorted and merged at every size: a part may hold most of the rows, and only such joins are split by AQE.
    joined = cut.join(shared.hint("merge"), ["part", "digit", "ended"])
    return stage(joined.select("rid", "n_points", "id", F.col("next").alias("part"), "rest", "ended"), "radix-round")


def equal_groups(rows: DataFrame, text: Column, doc_id: Column) -> DataFrame:
    """(rid, keep_id, keep_rid, group_size) for the rows whose normalised text another row has too."""
    rest = normalised(text).cast("binary")
    work = rows.select("rid", F.char_length(or_empty(text)).alias("n_points"), doc_id.alias("id"), F.lit(0).cast("long").alias("part"), rest.alias("rest"))
    width, ended = FIRST_DIGIT, []
    while True:
        found = _split(work, width)
        ended.append(found.where("ended").drop("rest", "ended"))
        work = found.where("NOT ended").drop("ended")
        if work.isEmpty():
            break
        width = min(width * DIGIT_GROWTH, LONGEST // 2)
    members = ended[0]
    for more in ended[1:]:
        members = members.unionByName(more)
    # The longest text stays, then the smallest id (no id comes last), then the row read first.
    order = F.struct(-F.col("n_points"), F.col("id").isNull(), F.col("id"), F.col("rid"))
    best = members.groupBy("part").agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("group_size"))
    best = stage(best, "radix-best").select("part", F.col("best.id").alias("keep_id"), F.col("best.rid").alias("keep_rid"), "group_size")
    return members.join(best, "part").select("rid", "keep_id", "keep_rid", "group_size")


def exact_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Every row of ``docs`` as (row, keep_id, group_size, kept, text_sha256).

    ``row`` is the struct of the input's columns, whatever their names. Null texts count as empty, and all empty texts are
    equal. Of equal texts the one with the most code points stays, then the smallest id, null ids last, then the
    row read first, so that exactly one of several rows with the same id stays. An empty table gives an empty result.
    """
    rows = numbered(docs, "exact-rows", text_sha256=F.sha2(normalised(F.col(f"`{text}`")).cast("binary"), 256))
    groups = equal_groups(rows, F.col(f"row.`{text}`"), F.col(f"row.`{doc_id}`"))
    return (
        rows.join(groups, "rid", "left")
        .select(
            "row",
            F.when(F.col("keep_rid").isNull(), F.col(f"row.`{doc_id}`")).otherwise(F.col("keep_id")).alias("keep_id"),
            F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
            (F.coalesce("keep_rid", "rid") == F.col("rid")).alias("kept"),
            "text_sha256",
        )
    )


def drop_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay, with the input's columns."""
    return exact_dedup(docs, text, doc_id).where("kept").select("row.*")
