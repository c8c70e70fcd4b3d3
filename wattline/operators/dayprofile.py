"""The per-day profile table: what a micro-batch needs of a ledger to fill gaps.

One row per series, day and ten minutes of the clock, with the points (clock time,
cumulative value) of that cell in order; several rows of one cell (of several batches)
count together. A gap's band meets the cells of its clock time on all days in
an equi-join, which finds the first and the last point in the band of each, and the
mean over days of last minus first is the profile. A batch adds the rows of what it
emitted, reads the cells its gaps ask for, and never the ledger.

In a batch of several days a gap sees the points of its own batch only from readings of
days before its own (``rday``, null for committed points), as per-day commits would have it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.functions.timefns import day_of, tod_us

CELL_US = 600_000_000
POINTS = T.ArrayType(T.StructType([T.StructField("t", T.LongType()), T.StructField("c", T.DoubleType())]))


def schema(keys: Sequence[T.StructField] = ()) -> T.StructType:
    """Schema of the written table: rows may be missing, columns never are."""
    return T.StructType([*keys, T.StructField("cell", T.IntegerType()), T.StructField("points", POINTS),
                         T.StructField("day", T.DateType()), T.StructField("batch_id", T.LongType())])


def points_of(ledger: DataFrame, keys: Sequence[str] = (), rday: str | None = None) -> DataFrame:
    """Profile rows (keys, day, cell, points[, rday]) of ledger rows."""
    t = F.col("_t")
    by = [*keys, "day", F.floor(t / CELL_US).cast("int").alias("cell"), *([F.col(rday).alias("rday")] if rday else [])]
    point = F.struct(t.alias("t"), F.col("cumulative_sum").alias("c"))
    rows = ledger.filter(F.col("ts").isNotNull()).withColumns({"_t": tod_us("ts"), "day": day_of("ts")})
    return rows.groupBy(*by).agg(F.sort_array(F.collect_list(point)).alias("points"))


def merged(points: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Profile rows with one row per cell."""
    return points.groupBy(*keys, "day", "cell").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("points")))).alias("points"))


def band_days(points: DataFrame, bands: DataFrame, K: Sequence[str], few: bool) -> DataFrame:
    """Per band (K, a, b[, gday]) and day its first and last point in the band, as structs lo and hi.

    ``few``: the bands are few and counted. They are broadcast, and what they meet is shuffled once, by band."""
    B = [*K, "a", "b", *(["gday"] if "gday" in bands.columns else [])]
    # a band that comes twice meets its points twice, which firsts and lasts do not mind
    asked = bands.filter(F.col("a") <= F.col("b")).select(*B).withColumn("cell", F.explode(F.sequence(
        F.floor(F.col("a") / CELL_US).cast("int"), F.floor(F.col("b") / CELL_US).cast("int"))))
    met = points.join(F.broadcast(asked) if few else asked.distinct(), [*K, "cell"])
    if "rday" in points.columns:
        met = met.filter(F.col("rday").isNull() | (F.col("rday") < F.col("gday")))
    inside = met.select(*B, "day", F.filter("points", lambda p: p["t"].between(F.col("a"), F.col("b"))).alias("_in")) \
        .filter(F.size("_in") > 0).select(*B, "day", F.get("_in", F.lit(0)).alias("lo"), F.get("_in", F.size("_in") - 1).alias("hi"))
    if few:
        inside = inside.repartition(*B)
    return inside.groupBy(*B, "day").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def mean_energy(points: DataFrame, bands: DataFrame, K: Sequence[str], few: bool = False) -> DataFrame:
    """Per band the number of days with points in it and the mean of their energy; bands without any are absent."""
    B = [*K, "a", "b", *(["gday"] if "gday" in bands.columns else [])]
    return band_days(points, bands, K, few).groupBy(*B).agg(
        F.count(F.lit(1)).alias("days"), F.avg(F.col("hi.c") - F.col("lo.c")).alias("profile"))
