"""The sample tables seen as access logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SITES = 4
OUTAGES = (("2024-01-12 13:25:00", "2024-01-13 05:25:00"),)
SPLIT = "2024-01-22 00:00:00"
EXTENSIONS = ("gif", "html", "jpg", "txt", "GIF")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _k() -> Column:
    return F.regexp_extract("props", r"(\d+)", 1).cast("int")


def _status(k: Column) -> Column:
    kind = F.col("event_type")
    return F.when(kind == "error", F.when(k % 2 == 0, 500).otherwise(404)).when(kind == "signup", 302).otherwise(200)


def _size() -> Column:
    return F.round(F.col("value") * 100).cast("long")


def _request(k: Column) -> Column:
    ext = F.element_at(F.array(*[F.lit(e) for e in EXTENSIONS]), k % len(EXTENSIONS) + 1)
    return F.concat(F.lit("GET /"), "event_type", F.lit("/"), k.cast("string"), F.lit("."), ext, F.lit(" HTTP/1.0"))


def _line(k: Column, size: Column) -> Column:
    return F.concat(
        F.lit("u"),
        F.col("user_id").cast("string"),
        F.lit(" - - ["),
        F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"),
        F.lit(' -0400] "'),
        _request(k),
        F.lit('" '),
        _status(k).cast("string"),
        F.lit(" "),
        size,
    )


def site_of(host: Column) -> Column:
    """Series key of a host ``u<number>``."""
    return (F.substr(host, F.lit(2)).cast("long") % SITES).cast("int")


def _as_log(events: DataFrame) -> DataFrame:
    k = _k()
    status = _status(k)
    return events.select(
        (F.col("user_id") % SITES).cast("int").alias("site"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("host"),
        F.col("ts").alias("timestamp"),
        _request(k).alias("request"),
        status.cast("int").alias("status"),
        F.when(status == 404, F.lit(0).cast("long")).otherwise(_size()).alias("bytes"),
    )


def events_log(spark: SparkSession, folder: str) -> DataFrame:
    """events as typed access_log rows with their series key ``site``."""
    return _as_log(table(spark, folder, "events"))


def events_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same as a stream over the table's files; a pattern, as streams take no name of a single file."""
    schema = table(spark, folder, "events").schema
    return _as_log(spark.readStream.schema(schema).parquet(f"{folder}/events.parque[t]"))


def events_lines(spark: SparkSession, folder: str) -> DataFrame:
    """events printed as log lines, ``event_id`` alongside."""
    k = _k()
    size = F.when(_status(k) == 404, F.lit("-")).otherwise(_size().cast("string"))
    return table(spark, folder, "events").select("event_id", _line(k, size).alias("value"))


def mixed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Log lines among others.

    Sign-ups whose k ends in 0 print a size that is no number; the addresses of pages and the turns of
    conversations are no log lines at all.
    """
    k = _k()
    broken = (F.col("event_type") == "signup") & (k % 10 == 0)
    size = F.when(broken, F.concat(_size().cast("string"), F.lit("B"))).otherwise(_size().cast("string"))
    events = table(spark, folder, "events").select(_line(k, size).alias("value"))
    pages = table(spark, folder, "pages").select(F.col("url").alias("value"))
    turns = table(spark, folder, "conversations").select(F.col("text").alias("value"))
    return events.unionByName(pages).unionByName(turns)


def pages_log(spark: SparkSession, folder: str) -> DataFrame:
    """pages as requests for their address."""
    return table(spark, folder, "pages").select(F.concat(F.lit("GET "), "url", F.lit(" HTTP/1.0")).alias("request"))


def error_outages(spark: SparkSession, folder: str) -> DataFrame:
    """(site, start, end): an error whose k ends in 0 stands for an outage of k minutes on its site."""
    k = _k()
    errors = table(spark, folder, "events").filter((F.col("event_type") == "error") & (k % 10 == 0))
    end = F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), k)
    return errors.select((F.col("user_id") % SITES).cast("int").alias("site"), F.col("ts").alias("start"), end.alias("end"))
