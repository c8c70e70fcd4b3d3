"""Ledger roll-ups.

Counter differences are ``max_by(cum, ts) - min_by(cum, ts)`` per group: a
partial/final hash aggregate, so even a day holding a third of all rows is
pre-aggregated on every mapper before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.functions.timefns import day_of, hour_start
from wattline.operators.profile import day_bounds_in_band



def _ord():
    return F.struct("ts", "cumulative_sum")


def counter_diff(col: str = "cumulative_sum"):
    return F.max_by(col, _ord()) - F.min_by(col, _ord())


def daily_bounds(ledger: DataFrame, a_us: int, b_us: int, keys: Sequence[str] = ()) -> DataFrame:
    """A1: per day MIN(ts), MAX(ts) of rows with clock time in [a, b]."""
    return day_bounds_in_band(ledger, a_us, b_us, keys).select(
        *keys, "day", "lower_bound", "upper_bound")


def day_first_last(ledger: DataFrame, day: str) -> DataFrame:
    """A2: base / end_sum of one calendar day (NULLs when the day is empty)."""
    rows = ledger.filter(day_of("ts") == F.lit(day).cast("date"))
    return rows.agg(F.min_by("cumulative_sum", _ord()).alias("base"),
                    F.max_by("cumulative_sum", _ord()).alias("end_sum"))


def daily_energy(ledger: DataFrame, keys: Sequence[str] = (), out: str = "energy") -> DataFrame:
    """A3: per day last - first cumulative value (the interval crossing
    midnight belongs to neither day, as in the reference)."""
    return (ledger.withColumn("day", day_of("ts"))
            .groupBy(*keys, "day").agg(counter_diff().alias(out)))


def hourly_energy(ledger: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """A4: per (date, hour) last - first cumulative value."""
    return (ledger.withColumn("day", day_of("ts"))
            .withColumn("hour", hour_start("ts"))
            .groupBy(*keys, "day", "hour").agg(counter_diff().alias("energy")))


def hourly_energy_map(ledger: DataFrame) -> DataFrame:
    """Date -> {hour of day: energy}; at most 24 entries per day."""
    h = hourly_energy(ledger).withColumn("h", F.hour("hour"))
    return h.groupBy("day").agg(F.map_from_entries(F.array_sort(
        F.collect_list(F.struct(F.col("h"), F.col("energy"))))).alias("map"))


def as_text(entries: str, places: int = 6) -> Column:
    """A map of hour to energy as text "h=energy" in ascending order of hours."""
    one = F.transform(F.array_sort(F.map_entries(entries)), lambda e: F.concat_ws(
        "=", e["key"].cast("string"), F.format_string(f"%.{places}f", e["value"])))
    return F.array_join(one, ",")


def day_ticks(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Distinct days, first timestamp of each, 'dd.MM' label."""
    return (df.groupBy(day_of(ts).alias("day")).agg(F.min(ts).alias("first_ts"))
            .withColumn("label", F.date_format("day", "dd.MM")))


def daily_summary(export_ledger: DataFrame, production_ledger: DataFrame,
                  keys: Sequence[str] = ()) -> DataFrame:
    """Per date (and series) the production and export
    energy; only dates present in both ledgers (the others are refused)."""
    e = daily_energy(export_ledger, keys, out="export_sum")
    p = daily_energy(production_ledger, keys, out="production_sum")
    return (p.join(e, [*keys, "day"], "inner")
            .select(*keys, F.col("day").alias("date"), "production_sum", "export_sum"))


NO_EXPORT, NO_PRODUCTION, OK = "No export data for the day", "No production data for the day", "ok"


def daily_summary_status(export_ledger: DataFrame, production_ledger: DataFrame,
                         keys: Sequence[str] = ()) -> DataFrame:
    """J6 with a status for dates (of a series) that miss one side."""
    e = daily_energy(export_ledger, keys, out="export_sum")
    p = daily_energy(production_ledger, keys, out="production_sum")
    j = p.join(e, [*keys, "day"], "full_outer")
    status = (F.when(F.col("export_sum").isNull(), F.lit(NO_EXPORT))
              .when(F.col("production_sum").isNull(), F.lit(NO_PRODUCTION))
              .otherwise(F.lit(OK)))
    return j.select(*keys, F.col("day").alias("date"), "production_sum", "export_sum",
                    status.alias("status"))


def upsert(old: DataFrame, new: DataFrame, key: Sequence[str] = ("date",)) -> DataFrame:
    """MERGE on key - matched rows take the new values, unmatched
    new rows are inserted, old rows without a match are kept."""
    keep = old.join(new.select(*key), list(key), "left_anti")
    return keep.unionByName(new)
