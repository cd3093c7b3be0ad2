"""Typed stage tables: reading, writing, and predictions found by file name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

_L, _D, _I, _S, _N = T.LongType(), T.DoubleType(), T.IntegerType(), T.StringType(), T.TimestampNTZType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in columns.items()])


# Stage schemas, columns in table order.
ACCESS_LOG = _schema(host=_S, timestamp=_N, request=_S, status=_I, bytes=_L)
LOAD = _schema(
    ds=_N, y=_L, total_bytes=_L, avg_bytes=_D, error_4xx=_L, error_5xx=_L, error_rate=_D, intensity=_D, is_downtime=_I
)
FEATURES = _schema(
    ds=_N, intensity=_D, hour_sin=_D, hour_cos=_D, day_sin=_D, day_cos=_D, is_weekend=_I,
    lag_1step=_D, lag_1h=_D, lag_24h=_D, lag_7d=_D, roll_mean_4h=_D, roll_std_4h=_D, roll_max_4h=_D,
)
PREDICTIONS = _schema(model=_S, ds=_N, y=_D, yhat=_D)


def keyed(schema: T.StructType, **keys: T.DataType) -> T.StructType:
    """``schema`` with series columns in front."""
    return T.StructType([*_schema(**keys).fields, *schema.fields])


def read_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """A stage table with its declared types: parquet or headed CSV, nothing is inferred."""
    reader = spark.read.schema(schema)
    return reader.option("header", True).csv(path) if fmt == "csv" else reader.format(fmt).load(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Write a stage table; with ``partition_by`` only the partitions present in ``df`` are replaced.

    Tasks write what they hold, nothing is gathered first; long files are split by row count.
    """
    writer = df.write.mode("overwrite").format(fmt).option("maxRecordsPerFile", 20_000_000)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.save(path)


def read_predictions(spark: SparkSession, folder: str, schema: T.StructType = PREDICTIONS, fmt: str = "parquet") -> DataFrame:
    """All ``predictions_<interval>`` tables of a folder, with ``interval`` taken from the name."""
    reader = spark.read.schema(schema).option("basePath", folder)
    if fmt == "csv":
        reader = reader.option("header", True)
    found = reader.format(fmt).load(f"{folder}/predictions_*")
    interval = F.regexp_extract(F.col("_metadata.file_path"), r"predictions_([0-9]+min)", 1)
    return found.withColumn("interval", interval)
