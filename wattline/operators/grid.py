"""Regular time grids and counter series on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.functions.timefns import day_of, from_micros, micros, tod_us
from wattline.plans import stitch


def time_grid(spans: DataFrame, step_us: int) -> DataFrame:
    """One row per tick. ``spans`` has (day, t0_us, t1_us); ticks run
    from day + t0 to day + t1 inclusive at ``step_us``. Generated per span
    inside the task that holds it."""
    day_us = micros(F.col("day").cast("timestamp_ntz"))
    ticks = F.sequence(day_us + F.col("t0_us"), day_us + F.col("t1_us"),
                       F.lit(step_us).cast("bigint"))
    return (spans.select("day", F.explode(ticks).alias("_us"))
            .select("day", from_micros("_us").alias("ts")))


def spans_from(df: DataFrame, step_us: int, ts: str = "ts") -> DataFrame:
    """Per calendar day of ``df``: from its first reading (floored to the
    step) to its last reading."""
    return (df.groupBy(day_of(ts).alias("day"))
            .agg(F.min(tod_us(ts)).alias("t0"), F.max(tod_us(ts)).alias("t1_us"))
            .withColumn("t0_us", F.expr(f"t0 - pmod(t0, {step_us})")).drop("t0"))


def without_band(grid: DataFrame, a_us: int, b_us: int) -> DataFrame:
    """Drop ticks whose clock time lies in [a, b]."""
    t = tod_us("ts")
    return grid.filter((t < a_us) | (t > b_us))


def counter_series(grid: DataFrame, ledger: DataFrame, rows: int | None = None) -> DataFrame:
    """A counter on the grid: at every tick the ledger's running total (its last row at or
    before the tick, 0 before the first), and what it gained since the tick before.

    Ledger rows are put among the ticks; a running maximum carries the last of them along."""
    us = micros("ts")
    ticks = grid.select(us.alias("us"), F.lit(1).alias("o"), F.lit(None).cast("struct<us:bigint,c:double>").alias("rec"))
    points = ledger.filter(F.col("ts").isNotNull()).select(
        us.alias("us"), F.lit(0).alias("o"), F.struct(us.alias("us"), F.col("cumulative_sum").alias("c")).alias("rec"))
    d, many = stitch.bucketed(ticks.unionByName(points).withColumn("_series", F.lit(0)), ["_series"], F.col("us"), rows)
    d = stitch.running_max(d, ["_series"], ["us", "o"], "rec", "last", many=many).filter(F.col("o") == 1) \
        .select("_series", stitch.BKT, "us", F.coalesce("last.c", F.lit(0.0)).alias("cumulative_sum"))
    d = stitch.halo_lags(d, ["_series"], ["us"], ["cumulative_sum"], depth=1, many=many)
    return d.select(from_micros("us").alias("ts"), "cumulative_sum",
                    (F.col("cumulative_sum") - F.coalesce("_p1_cumulative_sum", F.lit(0.0))).alias("integral"))
