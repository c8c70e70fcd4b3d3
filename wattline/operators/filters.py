"""Projections and predicates (P1-P12). All are plain column expressions;
range predicates on ``ts`` reach the parquet scan as pushed filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.functions.timefns import day_of, ntz_literal, tod_us


def channel_sum(df: DataFrame, channels: Sequence[str] = ("v1", "v2", "v3"),
                out: str = "value") -> DataFrame:
    """Sum of channels, each cast to double, NULL counted as 0."""
    total = F.lit(0.0)
    for c in channels:
        total = total + F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    return df.select("ts", total.alias(out))


def null_as_zero(df: DataFrame, col: str = "value") -> DataFrame:
    """NULL reading -> 0.0, row kept."""
    return df.withColumn(col, F.coalesce(F.col(col).cast("double"), F.lit(0.0)))


def sign_clamp(df: DataFrame, col: str = "value") -> DataFrame:
    """Export keeps negatives, production keeps positives (after P3)."""
    v = F.coalesce(F.col(col), F.lit(0.0))
    return df.select("ts", F.least(v, F.lit(0.0)).alias("export_kw"),
                     F.greatest(v, F.lit(0.0)).alias("production_kw"))


def cutoff(df: DataFrame, start: str, ts: str = "ts") -> DataFrame:
    """P5: ts >= start (pushed down)."""
    return df.filter(F.col(ts) >= ntz_literal(start))


def time_range(df: DataFrame, lo, hi, ts: str = "ts", closed: bool = True) -> DataFrame:
    """Lo <= ts <= hi (closed) or lo <= ts < hi. ``lo``/``hi`` are
    Columns or NTZ strings."""
    lo_c = ntz_literal(lo) if isinstance(lo, str) else lo
    hi_c = ntz_literal(hi) if isinstance(hi, str) else hi
    upper = F.col(ts) <= hi_c if closed else F.col(ts) < hi_c
    return df.filter((F.col(ts) >= lo_c) & upper)


def time_of_day_band(df: DataFrame, a_us: int, b_us: int, ts: str = "ts") -> DataFrame:
    """Clock time in [a, b]; empty when a > b (no wrap)."""
    return df.filter(tod_us(ts).between(a_us, b_us))


def calendar_day(df: DataFrame, day: str, ts: str = "ts") -> DataFrame:
    """DATE(ts) = day; Catalyst rewrites it to a ts range."""
    return df.filter(day_of(ts) == F.lit(day).cast("date"))


def tagged(df: DataFrame, tag: str, name: str = "task") -> DataFrame:
    """Constant tag column in front of all columns."""
    return df.select(F.lit(tag).alias(name), "*")
