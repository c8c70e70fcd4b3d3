"""Aligning two ledgers in time.

The nearest partner of a row is the last one before it or the first one after
it. So the right side is put among the left rows in time order and a running
maximum, forward and backward, carries the latest right row along: at most two
candidates per left row, linear work at any tolerance, and the running maxima
are stitched across time buckets. Distances count whole milliseconds, so right
rows of one millisecond are equally near; the earliest stands for them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.functions.timefns import day_of, diff_millis, epoch_millis
from wattline.plans import stitch
from wattline.plans.materialize import cut


def _carried(rows: DataFrame, K: list[str], back: bool, out: str, many: bool) -> DataFrame:
    """``out``: of each row, the right row (ms, ts, sum) last before, or with
    ``back`` first after it, itself included."""
    t = F.lit(-1 if back else 1) * F.col("_ms")
    rows = rows.withColumn("_rec", F.when(F.col("_o") == 0, F.struct(t.alias("_t"), "_ts", "_sum")))
    return stitch.running_max(rows, K, [t, F.col("_o")], "_rec", out, many=many, back=back).drop("_rec")


def nearest_join(left: DataFrame, right: DataFrame, tol_ms: int,
                 start: Column | None = None, keys: Sequence[str] = (), rows: int | None = None) -> DataFrame:
    """J2 + W7: for every left (export) timestamp the right (production) row
    nearest in time within ``tol_ms`` (ties: earlier right ts, then lower
    sum). Left rows without a partner are dropped (inner join). ``start``
    leaves earlier left rows out; ``keys`` align series by series."""
    K = list(keys) or ["_series"]
    if not keys:
        left, right = (df.withColumn("_series", F.lit(0)) for df in (left, right))
    if start is not None:
        left = left.filter(F.col("ts") >= start)
    lf = left.filter(F.col("ts").isNotNull()).groupBy(*K, "ts").agg(F.min("cumulative_sum").alias("_sum")) \
        .select(*K, epoch_millis("ts").alias("_ms"), F.lit(1).alias("_o"), F.col("ts").alias("_ts"), "_sum")
    first = F.min(F.struct("ts", "cumulative_sum")).alias("r")
    rt = right.filter(F.col("ts").isNotNull()).groupBy(*K, epoch_millis("ts").alias("_ms")).agg(first) \
        .select(*K, "_ms", F.lit(0).alias("_o"), F.col("r.ts").alias("_ts"), F.col("r.cumulative_sum").alias("_sum"))
    rows, many = stitch.bucketed(lf.unionByName(rt), K, F.col("_ms"), rows)
    rows = _carried(_carried(rows, K, False, "_before", many), K, True, "_after", many)

    def candidate(c):
        far = F.abs(diff_millis("_ts", F.col(c)["_ts"]))
        return F.when(far <= tol_ms, F.struct(far.alias("far"), F.col(c)["_ts"].alias("ts"), F.col(c)["_sum"].alias("sum")))
    best = rows.filter(F.col("_o") == 1).withColumn("m", F.least(candidate("_before"), candidate("_after"))) \
        .filter(F.col("m").isNotNull())
    return best.select(*keys, F.col("_ts").alias("export_ts"), F.col("_sum").alias("export_sum"),
                       F.col("m.ts").alias("production_ts"), F.col("m.sum").alias("production_sum"))


def baseline_shift(df: DataFrame, ts: str, cols: list[str], suffix: str = "_shift",
                   keys: Sequence[str] = ()) -> DataFrame:
    """Per calendar day of ``ts`` (and series), each column minus its value
    at the day's first row. The first row per day is a ``min_by`` aggregate joined
    back (one row per day), not a window over the whole day. ``df`` is written once:
    the days' first rows and the result both read it."""
    d = cut(df.withColumn("_day", day_of(ts)))
    firsts = d.groupBy(*keys, "_day").agg(*[
        F.min_by(c, F.struct(ts, c)).alias(f"_first_{c}") for c in cols])
    out = d.join(firsts, [*keys, "_day"], "left")
    for c in cols:
        out = out.withColumn(c + suffix, F.col(c) - F.col(f"_first_{c}"))
    return out.drop("_day", *[f"_first_{c}" for c in cols])


def consumption_rate(aligned: DataFrame) -> DataFrame:
    """(production - export) / production on the aligned ledgers;
    division by zero gives NULL."""
    return aligned.withColumn("rate", F.try_divide(
        F.col("production_sum") - F.col("export_sum"), F.col("production_sum")))


def daily_consumption_rate(aligned: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The same rate on day-baseline-shifted sums (0 and +-inf -> NULL)."""
    s = baseline_shift(aligned, "export_ts", ["export_sum", "production_sum"], keys=keys)
    return s.withColumn("daily_rate", F.try_divide(
        F.col("production_sum_shift") - F.col("export_sum_shift"),
        F.col("production_sum_shift")))
