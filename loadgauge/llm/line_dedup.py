"""Line deduplication by the spread of a line over sites.

A HyperLogLog sketch of the sites per line hash is merged by aggregation. A line whose estimate is clear of the threshold is
decided by it; lines within the sketch's error of the threshold get an exact count of distinct sites. Lines on that many sites
or more are boilerplate and are removed everywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import stage
from .common import WHITE, lower_ascii, numbered, or_empty

#: Sites from which on a line is boilerplate; the sketch's size as a power of two; errors of the sketch that count as near.
MIN_SITES, SKETCH, ERRORS = 10, 12, 8


def _lines(rows: DataFrame, text: str, site: str) -> DataFrame:
    """(rid, at, h1, h2, site) of every line that isn't blank: a 128-bit hash of the line without outer white space, A-Z in lower case."""
    cut = rows.select("rid", or_empty(F.col(f"row.`{site}`").cast("string")).alias("site"), F.posexplode(F.split(or_empty(F.col(f"row.`{text}`")), "\n", -1)).alias("at", "line"))
    plain = cut.withColumn("line", lower_ascii(F.btrim("line", F.lit(WHITE)))).where("line <> ''")
    return plain.select("rid", "at", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"), "site")


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """(h1, h2), stored: the line hashes on ``min_sites`` distinct sites or more."""
    error = ERRORS * 1.04 / (1 << SKETCH) ** 0.5
    low, high = min_sites * (1 - error) - 1, min_sites * (1 + error) + 1
    sketches = lines.groupBy("h1", "h2").agg(F.hll_sketch_agg("site", SKETCH).alias("sketch"))
    spread = stage(sketches.select("h1", "h2", F.hll_sketch_estimate("sketch").alias("sites")).where(F.col("sites") >= low), "line-spread")
    near = spread.where(F.col("sites") <= high).select("h1", "h2")
    exact = lines.join(near, ["h1", "h2"]).select("h1", "h2", "site").distinct().groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("sites"))
    found = spread.where(F.col("sites") > high).select("h1", "h2").unionByName(exact.where(F.col("sites") >= min_sites).select("h1", "h2"))
    return stage(found, "boilerplate")


def line_dedup(docs: DataFrame, text: str = "text", site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """Every row of ``docs`` as (row, n_lines, n_removed, text): ``text`` without the lines that ``min_sites`` sites or more have.

    Lines are parted by line feeds and are the same if equal without outer ASCII white space and with A-Z in lower case. Blank lines
    stay. A line counts once for a site however often it is there. Null sites read as an empty name, null texts as empty; rows without
    lines left have an empty text. Rows are never dropped.
    """
    rows = numbered(docs, "line-rows")
    lines = stage(_lines(rows, text, site), "lines")
    gone = lines.join(boilerplate(lines, min_sites), ["h1", "h2"]).groupBy("rid").agg(F.collect_list("at").alias("gone"))
    # Generated, so that the lines are cut once a row and not once for each line looked at.
    cut = F.explode(F.array(F.split(or_empty(F.col(f"row.`{text}`")), "\n", -1))).alias("parts")
    found = rows.join(gone, "rid", "left").select("row", "gone", cut)
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), "gone"), lambda i: F.get("parts", i))
    kept = F.when(F.col("gone").isNull(), F.col("parts")).otherwise(left)
    removed = F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone"))
    return found.select("row", F.size("parts").cast("long").alias("n_lines"), removed.cast("long").alias("n_removed"), F.array_join(kept, "\n").alias("text"))
