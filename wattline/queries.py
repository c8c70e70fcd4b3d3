"""Spark side of every registered query key (``__spark_entry__.queries``).

Each callable takes (spark, sf_dir) and reads the driver's tables under
``sf_dir``; fixtures are derived from ``events`` (see FIXTURES.md). Doubles
are rounded to 6 places, as in the oracle SQL.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.functions.timefns import instant_literal, ntz_literal, parse_tod
from wattline.operators import align, filters, grid, integrate as integ, lookup, profile, quality, rollup, unions
from wattline.plans.materialize import version
from wattline.session import configure, scratch_path
from wattline.sources import fixtures as fx
from wattline.sources import tables, weather
from wattline.streaming import sinks

BAND_A, BAND_B = parse_tod("11:00:00"), parse_tod("11:30:00")


def r6(df: DataFrame) -> DataFrame:
    """Round every double column to 6 places (comparison contract)."""
    return df.select(*[F.round(F.col(f.name), 6).alias(f.name)
                       if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                       for f in df.schema.fields])


def _prep(spark: SparkSession) -> None:
    configure(spark)


# ---- scans and predicates -------------------------------------------------

def readings_scan(spark, sf):
    return r6(tables.scan_readings(fx.readings(spark, sf)))


def meter_scan(spark, sf):
    return r6(tables.scan_meter(fx.readings(spark, sf)))


def channel_scan(spark, sf):
    return r6(tables.scan_channels(fx.channels(spark, sf)))


def channel_sum(spark, sf):
    return r6(filters.channel_sum(fx.channels(spark, sf)))


def null_as_zero(spark, sf):
    return r6(filters.null_as_zero(fx.readings_nulls(spark, sf)))


def sign_clamp(spark, sf):
    return r6(filters.sign_clamp(fx.readings(spark, sf)))


def cutoff_filter(spark, sf):
    return r6(filters.cutoff(fx.readings(spark, sf), "2024-01-15 00:00:00").select("ts", "value"))


def time_range_filter(spark, sf):
    lo = ntz_literal("10.01.2024 06:00", "dd.MM.yyyy HH:mm")
    hi = instant_literal("2024-01-12T20:30:00+02:00")
    return r6(filters.time_range(fx.readings(spark, sf), lo, hi).select("ts", "value"))


def time_of_day_band(spark, sf):
    return r6(filters.time_of_day_band(fx.readings(spark, sf), BAND_A, BAND_B).select("ts", "value"))


def calendar_day_filter(spark, sf):
    d = filters.calendar_day(fx.readings(spark, sf), "2024-01-15")
    return r6(d.filter(F.col("value") < 0).select("ts", "value"))


# ---- ledgers used by several keys ----------------------------------------

def _export_all(spark, sf):
    spec = fx.export_spec(fx.params())
    return fx.written(spark, sf, f"export {spec}", lambda: integ.integrate(
        fx.readings_nulls(spark, sf), None, spec))


def _production_all(spark, sf):
    spec = fx.production_spec(fx.params())
    return fx.written(spark, sf, f"production {spec}", lambda: integ.integrate(
        filters.channel_sum(fx.channels(spark, sf)), None, spec))


def _gapfill(spark, sf, spec=None):
    return integ.integrate(fx.new_days(spark, sf), fx.history(spark, sf), spec or fx.export_spec(fx.params()))


def anomaly_scan(spark, sf):
    return quality.anomaly_scan(_export_all(spark, sf))


def latest_row(spark, sf):
    return r6(lookup.latest_row(fx.whole_ledger(spark, sf)))


def latest_n(spark, sf):
    return r6(lookup.latest_n(tables.scan_readings(fx.readings(spark, sf)), 10, "id"))


def nearest_to_instant(spark, sf):
    inst = ntz_literal("2024-01-15 12:00:00")
    return r6(lookup.nearest_to_instant(fx.whole_ledger(spark, sf), inst, 30 * 60 * 1000))


def ledger_ordered(spark, sf):
    return r6(lookup.ledger_ordered(fx.whole_ledger(spark, sf)))


def lag_previous(spark, sf):
    return quality.previous_ts(fx.readings(spark, sf).select("ts", "id"),
                               tiebreak=["id"]).select("ts", "previous_ts")


def gap_detect(spark, sf):
    p = fx.params(sf)
    return quality.gap_detect(fx.readings(spark, sf).select("ts", "id"), p.gap_s, tiebreak=["id"])


def continuity_check(spark, sf):
    """On the unfilled ledger, whose holes the check has to find."""
    return r6(quality.continuity_check(fx.whole_ledger(spark, sf), fx.params().gap_s))


def _trapezoid(spark, sf):
    p = fx.params(sf)
    return integ.integrate(fx.readings(spark, sf), None, fx.history_spec(p))


def trapezoid_energy(spark, sf):
    return r6(_trapezoid(spark, sf).select("ts", "delta", "integral"))


def cumulative_energy(spark, sf):
    return r6(_trapezoid(spark, sf).select("ts", "delta", "integral", "cumulative_sum"))


def integrate_export(spark, sf):
    return r6(_export_all(spark, sf))


def integrate_production(spark, sf):
    return r6(_production_all(spark, sf))


def integrate_carry_in(spark, sf):
    return r6(integ.integrate(fx.new_days(spark, sf), fx.history(spark, sf), integ.LEGACY))


def first_row_policy(spark, sf):
    p = fx.params(sf)
    nd = fx.readings(spark, sf)
    syn = integ.integrate(nd, None, fx.history_spec(p))
    drp = integ.integrate(nd, None, fx.history_spec(p).with_(first_row="drop"))
    return r6(syn.select(F.lit("synthetic").alias("policy"), "*")
              .unionByName(drp.select(F.lit("drop").alias("policy"), "*")))


def _late_src(spark, sf):
    """Everything from half a day before the end of the history on."""
    return fx.readings(spark, sf).filter(F.col("ts") >= F.lit("2024-01-19 12:00:00").cast("timestamp_ntz"))


def late_rows(spark, sf):
    p = fx.params(sf)
    return r6(integ.integrate(_late_src(spark, sf), fx.history(spark, sf), fx.history_spec(p),
                              late="keep"))


def late_rows_dropped(spark, sf):
    p = fx.params(sf)
    return r6(integ.integrate(_late_src(spark, sf), fx.history(spark, sf), fx.history_spec(p),
                              late="drop"))


def gap_flags(spark, sf):
    p = fx.params(sf)
    d = quality.previous_ts(fx.readings(spark, sf).select("ts", "id"), tiebreak=["id"])
    from wattline.functions.timefns import diff_micros
    return (d.filter(F.col("previous_ts").isNotNull())
            .select("ts", "previous_ts",
                    (diff_micros("previous_ts", "ts") > 2 * p.step_s * 1_000_000).alias("is_gap")))


def gap_fill_slots(spark, sf):
    p = fx.params(sf)
    from wattline.functions.timefns import add_micros, diff_micros
    step = p.step_s * 1_000_000
    d = quality.previous_ts(fx.readings(spark, sf).select("ts", "id"), tiebreak=["id"])
    g = d.filter(diff_micros("previous_ts", "ts") > 2 * step)
    n = F.expr(f"div(timestampdiff(MICROSECOND, previous_ts, ts) + {step - 1}, {step})")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (integ.slots(g.withColumn("_n", n), parts, ["ts"])
            .select(F.col("ts").alias("gap_ts"), F.col("_k").alias("k"), add_micros("previous_ts", F.col("_k") * step).alias("ts")))


def _new_gaps(spark, sf):
    p = fx.params(sf)
    return integ.gap_list(fx.new_days(spark, sf), fx.history(spark, sf), fx.export_spec(p))


def gap_profile(spark, sf):
    gaps = _new_gaps(spark, sf)
    d = profile.band_day_diffs(gaps, fx.history(spark, sf))
    return r6(gaps.join(d, ["a", "b"]).select(
        "gap_ts", "day", (F.col("upper_value") - F.col("lower_value")).alias("energy")))


def band_profile(spark, sf):
    gaps = _new_gaps(spark, sf)
    bp = profile.band_profile(gaps, fx.history(spark, sf))
    return r6(gaps.join(bp, ["a", "b"]).select("gap_ts", "days", "profile"))


def integrate_gapfill(spark, sf):
    return r6(_gapfill(spark, sf))


def integrate_gapfill_production(spark, sf):
    p = fx.params(sf)
    ch = filters.channel_sum(fx.channels(spark, sf)).filter(
        F.col("ts") >= F.lit(fx.SPLIT_DAY).cast("timestamp_ntz"))
    return r6(integ.integrate(ch, fx.history(spark, sf), fx.production_spec(p)))


def integrate_gapfill_le(spark, sf):
    p = fx.params(sf)
    return r6(_gapfill(spark, sf, fx.export_spec(p).with_(slots="le")))


def integrate_keyed(spark, sf):
    """Many series (one per user): history before SPLIT_DAY integrated per
    series without fill, then the rest of the month integrated per series
    with gap fill, carry-in and per-series band profiles."""
    p = fx.params(sf)
    k = fx.keyed(spark, sf)
    split = F.lit(fx.SPLIT_DAY).cast("timestamp_ntz")
    hist = fx.written(spark, sf, f"keyed history {fx.history_spec(p)}", lambda: integ.integrate(
        k.filter(F.col("ts") < split), None, fx.history_spec(p), keys=["series"]))
    return r6(integ.integrate(k.filter(F.col("ts") >= split), hist, fx.export_spec(p),
                              keys=["series"]))


def integrate_gapfill_skip(spark, sf):
    """First gap version: 'skip' policy, '<=' slots, synthetic first row."""
    p = fx.params(sf)
    spec = integ.FIRST_GAP.with_(step_ms=p.step_ms)
    return r6(integ.integrate(fx.new_days(spark, sf), fx.history(spark, sf), spec))


def day_boundary_values(spark, sf):
    return r6(profile.day_bounds_in_band(fx.whole_ledger(spark, sf), BAND_A, BAND_B))


def day_boundary_values_join(spark, sf):
    return r6(profile.day_bounds_join_form(fx.whole_ledger(spark, sf), BAND_A, BAND_B))


def daily_bounds(spark, sf):
    return rollup.daily_bounds(fx.whole_ledger(spark, sf), BAND_A, BAND_B)


def day_first_last(spark, sf):
    return r6(rollup.day_first_last(fx.whole_ledger(spark, sf), "2024-01-15"))


def daily_energy(spark, sf):
    return r6(rollup.daily_energy(fx.whole_ledger(spark, sf)))


def hourly_energy(spark, sf):
    return r6(rollup.hourly_energy(_production_all(spark, sf)))


def hourly_energy_map(spark, sf):
    m = rollup.hourly_energy_map(_production_all(spark, sf))
    return m.select("day", rollup.as_text("map").alias("energy_by_hour"))


def _summary(spark, sf):
    return rollup.daily_summary(_export_all(spark, sf), _production_all(spark, sf))


def daily_summary(spark, sf):
    return r6(_summary(spark, sf))


def daily_summary_status(spark, sf):
    """J6 with statuses: every date and series of either ledger, 'ok' or
    which side is missing (users have days without one of their meters)."""
    export, production = fx.keyed_ledgers(spark, sf)
    return r6(rollup.daily_summary_status(export, production, keys=["series"]))


def daily_summary_backfill(spark, sf):
    s = _summary(spark, sf)
    return r6(s.filter(F.col("date").between(F.lit("2024-01-05").cast("date"),
                                             F.lit("2024-01-25").cast("date"))))


def daily_upsert(spark, sf):
    s = _summary(spark, sf)
    old = (s.filter(F.col("date") <= F.lit(fx.SUMMARY_OLD_LAST).cast("date"))
           .select("date", F.lit(0.0).alias("production_sum"), F.lit(0.0).alias("export_sum")))
    new = s.filter(F.col("date") >= F.lit(fx.SUMMARY_NEW_FIRST).cast("date"))
    return r6(rollup.upsert(old, new))


def _aligned(spark, sf):
    """Nearest-joined ledgers with sums at micro-kWh precision, so rates on
    (near-)zero differences do not depend on running-sum rounding noise."""
    p = fx.params(sf)
    return r6(align.nearest_join(fx.left_ledger(spark, sf), fx.right_ledger(spark, sf),
                                 p.tol_s * 1000))


def nearest_join(spark, sf):
    return r6(_aligned(spark, sf))


def nearest_join_keyed(spark, sf):
    """J2 series by series: the two meters of every user, whose readings are
    days apart, within hours."""
    left, right = fx.keyed_ledgers(spark, sf)
    return r6(align.nearest_join(left, right, fx.KEYED_TOL_S * 1000, keys=["series"]))


def consumption_rate_from(spark, sf):
    """D1 from a start time on, given as an instant with an offset."""
    near = align.nearest_join(fx.left_ledger(spark, sf), fx.right_ledger(spark, sf), fx.params().tol_s * 1000,
                              start=instant_literal("2024-01-05T01:30:00+01:30"))
    return r6(align.consumption_rate(r6(near)))


def daily_baseline_shift(spark, sf):
    return r6(align.baseline_shift(_aligned(spark, sf), "export_ts", ["export_sum", "production_sum"]))


def consumption_rate(spark, sf):
    return r6(align.consumption_rate(_aligned(spark, sf)))


def daily_consumption_rate(spark, sf):
    return r6(align.daily_consumption_rate(_aligned(spark, sf)))


def _weather_rows(spark, sf):
    digest = hashlib.sha256(version(spark, tables.path_of(sf, "events")).encode()).hexdigest()[:24]
    path = scratch_path(spark, f"weather/{spark.sparkContext.applicationId}/{digest}")
    fx.written(spark, sf, "weather", lambda: _write_weather(spark, sf, path))
    return weather.explode_hourly(weather.read_weather(spark, path))


def _write_weather(spark, sf, path):
    docs = weather.documents_from_events(fx.events(spark, sf))
    docs.write.mode("overwrite").text(path)
    return spark.range(1)


def weather_explode(spark, sf):
    return r6(_weather_rows(spark, sf))


def production_weather(spark, sf):
    he = rollup.hourly_energy(_production_all(spark, sf))
    out = weather.production_weather(he, _weather_rows(spark, sf))
    return r6(out.withColumn("hour", F.col("hour").cast("bigint")))


def day_ticks(spark, sf):
    return rollup.day_ticks(fx.readings(spark, sf))


RUN_PARTS = {
    "power_production_task": ("purchase", "signup"),
    "powermeter_integrate_task": ("click", "view"),
    "daily_consumption_task": ("error",),
}


def _run_parts(spark, sf):
    ev = fx.events(spark, sf)
    return {t: unions.run_log_from_events(ev, ty) for t, ty in RUN_PARTS.items()}


def tagged_union(spark, sf):
    return unions.tagged_union(_run_parts(spark, sf))


def tagged_union_all_columns(spark, sf):
    return unions.tagged_union(_run_parts(spark, sf), all_columns=True)


def _grid(spark, sf):
    p = fx.params(sf)
    step = p.step_s * 1_000_000
    return grid.time_grid(grid.spans_from(fx.events(spark, sf), step), step)


def time_grid(spark, sf):
    return _grid(spark, sf)


def time_grid_hole(spark, sf):
    return grid.without_band(_grid(spark, sf), BAND_A, BAND_B)


def counter_grid(spark, sf):
    """The whole ledger's counter at every tick of the grid."""
    return r6(grid.counter_series(_grid(spark, sf), fx.whole_ledger(spark, sf)))


def summary_upsert_keyed(spark, sf):
    """S12 / J7 by key: summaries of (date, series). Series with an even number come again with new values, on
    the dates from SUMMARY_NEW_FIRST on; the other series of those dates stay."""
    export, production = fx.keyed_ledgers(spark, sf)
    s = rollup.daily_summary(export, production, keys=["series"])
    path = scratch_path(spark, f"upsert/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}")
    sinks.upsert_by_key(s.withColumns({"production_sum": F.lit(0.0), "export_sum": F.lit(0.0)}), path, ["date", "series"])
    new = s.filter((F.col("series") % 2 == 0) & (F.col("date") >= F.lit(fx.SUMMARY_NEW_FIRST).cast("date")))
    for _ in range(2):                               # the second time changes nothing
        sinks.upsert_by_key(new, path, ["date", "series"])
    return r6(spark.read.schema(s.schema).parquet(path).select(*s.columns))


def catalog() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    names = [
        "readings_scan", "meter_scan", "channel_scan", "channel_sum", "null_as_zero",
        "sign_clamp", "cutoff_filter", "time_range_filter", "time_of_day_band",
        "calendar_day_filter", "anomaly_scan", "latest_row", "latest_n",
        "nearest_to_instant", "ledger_ordered", "lag_previous", "gap_detect",
        "continuity_check", "trapezoid_energy", "cumulative_energy", "integrate_export",
        "integrate_production", "integrate_carry_in", "first_row_policy", "late_rows",
        "late_rows_dropped", "gap_flags", "gap_fill_slots", "gap_profile", "band_profile",
        "integrate_gapfill", "integrate_gapfill_production", "integrate_gapfill_le",
        "integrate_gapfill_skip", "integrate_keyed",
        "day_boundary_values", "day_boundary_values_join", "daily_bounds", "day_first_last", "daily_energy",
        "hourly_energy", "hourly_energy_map", "daily_summary", "daily_summary_status",
        "daily_summary_backfill",
        "daily_upsert", "nearest_join", "nearest_join_keyed", "consumption_rate_from", "daily_baseline_shift", "consumption_rate",
        "daily_consumption_rate", "weather_explode", "production_weather", "day_ticks",
        "tagged_union", "tagged_union_all_columns", "time_grid", "time_grid_hole",
        "counter_grid", "summary_upsert_keyed",
    ]
    g = globals()

    def wrap(fn):
        def run(spark, sf_dir):
            _prep(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        return run
    return {n: wrap(g[n]) for n in names}
