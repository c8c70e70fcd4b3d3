"""Data-quality checks (W1-W3, P9): lags and gaps over the whole series,
computed per bucket of a large series and stitched."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.functions.timefns import diff_seconds_boundary, micros
from wattline.plans import stitch


def _with_series(df: DataFrame, keys: Sequence[str]):
    if keys:
        return df, list(keys)
    return df.withColumn("_series", F.lit(0)), ["_series"]


def previous_ts(df: DataFrame, keys: Sequence[str] = (), ts: str = "ts",
                tiebreak: Sequence[str] = (), rows: int | None = None) -> DataFrame:
    """Every row with ``previous_ts`` = LAG(ts) OVER (ORDER BY ts)."""
    d, K = _with_series(df, keys)
    d, many = stitch.bucketed(d, K, micros(ts), rows)
    out = stitch.halo_lags(d, K, [ts, *tiebreak], [ts], depth=1, many=many)
    out = out.withColumnRenamed(f"_p1_{ts}", "previous_ts").drop(stitch.BKT)
    return out if keys else out.drop("_series")


def gap_detect(df: DataFrame, threshold_s: int, keys: Sequence[str] = (),
               tiebreak: Sequence[str] = ()) -> DataFrame:
    """Rows whose second-boundary distance to the previous row exceeds
    the threshold: (current_time, previous_time, diff_seconds)."""
    p = previous_ts(df.select(*keys, "ts", *tiebreak), keys, tiebreak=tiebreak)
    return (p.withColumn("diff_seconds", diff_seconds_boundary("previous_ts", "ts"))
            .filter(F.col("diff_seconds") > threshold_s)
            .select(*keys, F.col("ts").alias("current_time"),
                    F.col("previous_ts").alias("previous_time"), "diff_seconds"))


def continuity_check(ledger: DataFrame, threshold_s: int = 60) -> DataFrame:
    """Ledger rows more than ``threshold_s`` after the previous one; the
    reference expects this to be empty."""
    p = previous_ts(ledger.select("ts", "cumulative_sum"), tiebreak=["cumulative_sum"])
    return (p.withColumn("diff_seconds", diff_seconds_boundary("previous_ts", "ts"))
            .filter(F.col("diff_seconds") > threshold_s)
            .select("ts", "cumulative_sum", "diff_seconds"))


def anomaly_scan(ledger: DataFrame) -> DataFrame:
    """One pass over the ledger, one output row per violated rule."""
    reasons = F.array(
        F.when(F.col("value") < 0, F.lit("value<0")),
        F.when(F.col("cumulative_sum") < 0, F.lit("cumulative_sum<0")),
        F.when(F.col("delta") < 0, F.lit("delta<0")))
    return (ledger.select("ts", F.filter(reasons, lambda r: r.isNotNull()).alias("rs"))
            .filter(F.size("rs") > 0)
            .select("ts", F.explode("rs").alias("reason")))
