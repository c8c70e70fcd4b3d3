"""Weather documents: JSON objects of parallel hourly arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WEATHER_SCHEMA = T.StructType([T.StructField("hourly", T.StructType([
    T.StructField("time", T.ArrayType(T.StringType())),
    T.StructField("shortwave_radiation", T.ArrayType(T.DoubleType())),
    T.StructField("cloud_cover", T.ArrayType(T.DoubleType())),
]))])

TIME_FORMAT = "yyyy-MM-dd'T'HH:mm"


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    """Read weather documents (one JSON object per line) with a fixed schema."""
    return spark.read.schema(WEATHER_SCHEMA).json(path)


def explode_hourly(docs: DataFrame) -> DataFrame:
    """One row per hour (time, radiation, cloud). Like Python's zip the
    arrays are first cut to the shortest one (arrays_zip alone pads)."""
    h = F.col("hourly")
    m = F.least(F.size(h["time"]), F.size(h["shortwave_radiation"]), F.size(h["cloud_cover"]))
    z = F.arrays_zip(F.slice(h["time"], 1, m).alias("time"),
                     F.slice(h["shortwave_radiation"], 1, m).alias("radiation"),
                     F.slice(h["cloud_cover"], 1, m).alias("cloud"))
    return (docs.filter(m > 0).select(F.explode(z).alias("r"))
            .select(F.to_timestamp_ntz(F.col("r.time"), F.lit(TIME_FORMAT)).alias("time"),
                    F.col("r.radiation").alias("radiation"),
                    F.col("r.cloud").alias("cloud")))


def documents_from_events(events: DataFrame) -> DataFrame:
    """Fixture: per day one document; per hour with events the radiation is
    the mean of ``props.k`` and the cloud cover the event count. Each day
    collects at most 24 entries."""
    k = F.get_json_object("props", "$.k").cast("double")
    hourly = (events.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("h"))
              .agg(F.avg(k).alias("r"), F.count(F.lit(1)).cast("double").alias("c")))
    per_day = hourly.groupBy(F.to_date("h").alias("day")).agg(
        F.array_sort(F.collect_list(F.struct("h", "r", "c"))).alias("e"))
    doc = F.struct(F.struct(
        F.transform("e", lambda x: F.date_format(x["h"], TIME_FORMAT)).alias("time"),
        F.transform("e", lambda x: x["r"]).alias("shortwave_radiation"),
        F.transform("e", lambda x: x["c"]).alias("cloud_cover")).alias("hourly"))
    return per_day.select(F.to_json(doc).alias("value"))


def production_weather(hourly_energy: DataFrame, weather_rows: DataFrame) -> DataFrame:
    """Hourly production beside radiation and cloud cover; hours
    without weather keep NULLs."""
    w = weather_rows.select(F.to_date("time").alias("day"), F.hour("time").alias("hour"),
                            "radiation", "cloud")
    e = hourly_energy.select("day", F.hour("hour").alias("hour"), "energy")
    return e.join(w, ["day", "hour"], "left")
