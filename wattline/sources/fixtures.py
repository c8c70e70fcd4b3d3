"""Meter-shaped inputs derived from the driver's ``events`` table.

The same definitions appear as SQL in :mod:`wattline.oracles`, so every
query can be checked against DuckDB.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.operators import integrate as integ
from wattline.plans.materialize import written_table
from wattline.sources.tables import path_of, table

# Fixed values, the same for every folder: reading step, gap threshold
# (2 x step) and nearest-join tolerance used with the events-derived fixtures.
STEP_S, GAP_S, TOL_S = 300, 600, 60
KEYED_TOL_S = 6 * 3600             # a user has a reading every few hours
SPLIT_DAY = "2024-01-20"          # history < this day; new_days from this day on
SUMMARY_OLD_LAST = "2024-01-20"   # old_summary: days <= this, sums zeroed
SUMMARY_NEW_FIRST = "2024-01-18"  # new_summary: days >= this


@dataclass(frozen=True)
class Params:
    step_s: int = STEP_S
    gap_s: int = GAP_S
    tol_s: int = TOL_S

    @property
    def step_ms(self) -> int:
        return self.step_s * 1000


def params(sf_dir: str | None = None) -> Params:
    return Params()


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def written(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """A table made of the events, written once."""
    return written_table(spark, path_of(sf_dir, "events"), name, build)


def readings(spark, sf_dir) -> DataFrame:
    e = events(spark, sf_dir)
    return e.select(F.col("event_id").alias("id"), "ts",
                    (F.col("value") - 50).alias("value"))


def readings_nulls(spark, sf_dir) -> DataFrame:
    e = events(spark, sf_dir)
    return e.select("ts", F.when(F.col("event_type") == "error", F.lit(None))
                    .otherwise(F.col("value") - 50).cast("double").alias("value"))


def channels(spark, sf_dir) -> DataFrame:
    e = events(spark, sf_dir)
    t = F.col("event_type")
    return e.select("ts",
                    F.when(t == "click", F.col("value")).alias("v1"),
                    F.when(t == "view", F.col("value")).alias("v2"),
                    F.when(t.isin("purchase", "signup"), F.col("value")).alias("v3"))


def keyed(spark, sf_dir) -> DataFrame:
    e = events(spark, sf_dir)
    return e.select(F.col("user_id").alias("series"), "ts",
                    (F.col("value") - 50).alias("value"))


def export_spec(p: Params) -> integ.Spec:
    """Export variant at the fixture's step, without the 2025 cutoff."""
    return integ.EXPORT.with_(step_ms=p.step_ms, cutoff=None)


def production_spec(p: Params) -> integ.Spec:
    return integ.PRODUCTION.with_(step_ms=p.step_ms, cutoff=None)


def history_spec(p: Params) -> integ.Spec:
    """How the committed history is built: export clamp, no gap fill."""
    return integ.EXPORT.with_(step_ms=p.step_ms, cutoff=None, gap_fill=False,
                              first_row="synthetic")


def history_readings(spark, sf_dir) -> DataFrame:
    return readings(spark, sf_dir).filter(F.col("ts") < F.lit(SPLIT_DAY).cast("timestamp_ntz"))


def new_days(spark, sf_dir) -> DataFrame:
    """All readings from SPLIT_DAY on: what arrives after the history."""
    return readings(spark, sf_dir).filter(F.col("ts") >= F.lit(SPLIT_DAY).cast("timestamp_ntz"))


def history(spark, sf_dir) -> DataFrame:
    """The committed ledger before SPLIT_DAY, written once as a table."""
    spec = history_spec(params())
    return written(spark, sf_dir, f"history {spec}", lambda: integ.integrate(
        history_readings(spark, sf_dir), None, spec))


def whole_ledger(spark, sf_dir) -> DataFrame:
    """The ledger of every reading, built as the history is."""
    spec = history_spec(params())
    return written(spark, sf_dir, f"whole {spec}", lambda: integ.integrate(
        readings(spark, sf_dir), None, spec))


# The two meters of the nearest-join fixture: events split by type, so the
# two ledgers together cover every reading.
LEFT_TYPES = ("click", "view", "error")
RIGHT_TYPES = ("purchase", "signup")


def half(spark, sf_dir, side: int) -> DataFrame:
    e = events(spark, sf_dir)
    types = LEFT_TYPES if side == 0 else RIGHT_TYPES
    return (e.filter(F.col("event_type").isin(*types))
            .select(F.col("event_id").alias("id"), "ts",
                    (F.col("value") - 50).alias("value")))


def left_ledger(spark, sf_dir) -> DataFrame:
    """Export-like ledger of the LEFT_TYPES readings (nearest-join left side)."""
    spec = history_spec(params())
    return written(spark, sf_dir, f"left {spec}", lambda: integ.integrate(
        half(spark, sf_dir, 0), None, spec))


def right_ledger(spark, sf_dir) -> DataFrame:
    """Production-like ledger of the RIGHT_TYPES readings (nearest-join right side)."""
    spec = production_spec(params()).with_(gap_fill=False)
    return written(spark, sf_dir, f"right {spec}", lambda: integ.integrate(
        half(spark, sf_dir, 1), None, spec))


def keyed_half(spark, sf_dir, side: int) -> DataFrame:
    """The two meters of every user: one series each."""
    types = LEFT_TYPES if side == 0 else RIGHT_TYPES
    return events(spark, sf_dir).filter(F.col("event_type").isin(*types)).select(
        F.col("user_id").alias("series"), "ts", (F.col("value") - 50).alias("value"))


def keyed_ledgers(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Export-like and production-like ledgers of every user, without fill."""
    specs = history_spec(params()), production_spec(params()).with_(gap_fill=False)
    left, right = (written(spark, sf_dir, f"keyed half {i} {spec}", lambda i=i, spec=spec: integ.integrate(
        keyed_half(spark, sf_dir, i), None, spec, keys=["series"])) for i, spec in enumerate(specs))
    return left, right
