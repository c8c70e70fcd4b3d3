"""Parquet scans with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.functions.timefns import day_of

READINGS_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("value", T.DoubleType()),
])

LEDGER_SCHEMA = T.StructType([
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("cumulative_sum", T.DoubleType()),
    T.StructField("integral", T.DoubleType()),
    T.StructField("delta", T.DoubleType()),
    T.StructField("value", T.DoubleType()),
])

SUMMARY_SCHEMA = T.StructType([
    T.StructField("date", T.DateType(), False),
    T.StructField("production_sum", T.DoubleType()),
    T.StructField("export_sum", T.DoubleType()),
])

MARKER_SCHEMA = T.StructType([
    T.StructField("batch_id", T.LongType()),
    T.StructField("processed_at", T.TimestampType()),
    T.StructField("row_count", T.LongType()),
])


def path_of(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(path_of(sf_dir, name))


def scan_readings(df: DataFrame, id_col="id", ts_col="ts", value_col="value") -> DataFrame:
    """(id, ts, value) of a narrow reading table."""
    return df.select(F.col(id_col).cast("bigint").alias("id"),
                     F.col(ts_col).alias("ts"),
                     F.col(value_col).cast("double").alias("value"))


def scan_meter(df: DataFrame, ts_col="ts", power_col="value") -> DataFrame:
    """Single signed meter -> (day, ts, value)."""
    return df.select(day_of(ts_col).alias("day"), F.col(ts_col).alias("ts"),
                     F.col(power_col).cast("double").alias("value"))


def scan_channels(df: DataFrame, ts_col="ts", channels=("v1", "v2", "v3")) -> DataFrame:
    """S3: three inverter channels -> (day, ts, v1, v2, v3)."""
    return df.select(day_of(ts_col).alias("day"), F.col(ts_col).alias("ts"),
                     *[F.col(c).alias(f"v{i + 1}") for i, c in enumerate(channels)])
