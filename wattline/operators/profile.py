"""Same-time-of-day energy profile of a ledger.

For a band [a, b] of clock time, every ledger day with rows inside the band
contributes ``cum(last row <= b) - cum(first row >= a)``; the profile is the
mean over those days (0 days -> no profile). Bands do not wrap midnight: when
a > b the band is empty.

No band is asked of every day. With all days laid over one clock, the sum over
days of "last value up to b" changes at a row by its difference to the row before
it, and that of "first value from a on" by the difference to the row after it: both
are prefix sums over the rows sorted by clock time, in which a band's a and b are
looked up as two more rows. Days without a row in the band have a hole around it,
between two rows in turn (or before the first, after the last): what such days
add to the sums is the sum over holes that begin before a and end after b, an offline
two-dimensional dominance sum. Only holes longer than the shortest band take part, and
of a gap-filled ledger few are. Values count from their day's first one, so
that sums over many days stay as exact as a day's energy.

Work is linear in ledger rows plus bands (a sort each); no row is produced per band and day.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattline.functions.timefns import DAY_US, day_of, from_micros, micros, tod_us
from wattline.plans import stitch
from wattline.plans.materialize import cut
from wattline.session import importable

#: Holes and bands that one dominance task takes, and those of small series that it meets at once.
BLOCK, AT_ONCE = 1 << 21, 1 << 15
#: Distance of two series on one clock, over any hole's end.
APART = 4 * DAY_US


def _points(ledger: DataFrame, K: list[str]) -> DataFrame:
    return ledger.filter(F.col("ts").isNotNull()).select(*K, micros("ts").alias("us"), F.col("cumulative_sum").alias("cum"))


def _with_series(gaps: DataFrame, ledger: DataFrame, keys: Sequence[str]):
    if keys:
        return gaps, ledger, list(keys)
    return gaps.withColumn("_series", F.lit(0)), ledger.withColumn("_series", F.lit(0)), ["_series"]


def dominance(holes: np.ndarray, weights: np.ndarray, bands: np.ndarray) -> np.ndarray:
    """Per band (a, b) the sum of the weights of holes (x, y) with x < a and y > b.

    Sums run on extended precision, as those of one band are differences of sums over all holes.

    In the order of x the holes that begin before a are a prefix, and a prefix is one
    node of each size 1, 2, 4 ... in its binary form. Size by size, all nodes' ends are
    sorted and summed, and all bands that use a node of this size search it.
    """
    out = np.zeros((len(bands), weights.shape[1]))
    if not len(holes) or not len(bands):
        return out
    by_x = np.argsort(holes[:, 0], kind="stable")
    x, y, w = holes[by_x, 0], holes[by_x, 1], weights[by_x]
    upto = np.searchsorted(x, bands[:, 0], side="left")            # holes that begin before a
    n, size = len(x), 1
    while size <= n:
        # nodes of this size are sorted by their end; suffix sums of a node answer "end after b"
        node = np.arange(n) // size
        order = np.lexsort((y, node))
        ys, ws = y[order], w[order]
        total = np.vstack([np.zeros((1, w.shape[1])), np.cumsum(ws, axis=0, dtype=np.longdouble)])
        use = np.flatnonzero(upto & size)                          # a prefix is one node of each size of its binary form
        if len(use):
            first = (upto[use] & ~(2 * size - 1))
            at = _search(ys, first, first + size, bands[use, 1])
            out[use] += total[first + size] - total[at]
        size *= 2
    return out


def _search(ys: np.ndarray, lo: np.ndarray, hi: np.ndarray, b: np.ndarray) -> np.ndarray:
    """First position in each sorted ys[lo:hi] whose value is over b."""
    lo, hi = lo.copy(), hi.copy()
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        mid = (lo + hi) // 2
        right = open_ & (ys[np.minimum(mid, len(ys) - 1)] <= b)
        lo, hi = np.where(right, mid + 1, lo), np.where(open_ & ~right, mid, hi)


def _covered(holes: DataFrame, bands: DataFrame, K: list[str]) -> DataFrame:
    """(K, a, b, cnt, w): sums over the holes around each band that has any."""
    sizes = holes.groupBy(*K).agg(F.count(F.lit(1)).alias("_nh")).join(
        bands.groupBy(*K).agg(F.count(F.lit(1)).alias("_nb")), K).select(
        *K, F.ceil(F.col("_nh") / BLOCK).cast("int").alias("_h"), F.ceil(F.col("_nb") / BLOCK).cast("int").alias("_b"))
    # a series with more holes or bands than a task takes is met block by block
    hs = holes.join(sizes, K).withColumn("_hb", F.pmod(F.xxhash64("x", "y", "day"), "_h")) \
        .withColumn("_bb", F.explode(F.sequence(F.lit(0), F.col("_b") - 1)))
    bs = bands.join(sizes, K).withColumn("_bb", F.pmod(F.xxhash64("a", "b"), "_b").cast("int")) \
        .withColumn("_hb", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_h").cast("bigint") - 1)))
    by = [*K, "_hb", "_bb"]

    # a row for each block of a series, of which a task meets many in one call
    both = hs.groupBy(*by).agg(F.collect_list(F.struct("x", "y", "cnt", "w")).alias("_holes")).join(
        bs.groupBy(*by).agg(F.collect_list(F.struct("a", "b")).alias("_asked")), by).select(*K, "_holes", "_asked")
    columns = [*K, "a", "b", "cnt", "w"]

    def laid_out(lists: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
        """Of all entries the row and the fields."""
        of = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        return of, [c.to_numpy(zero_copy_only=False) for c in lists.flatten().flatten()]

    def meet(t: pa.RecordBatch) -> pa.RecordBatch:
        h, (x, y, cnt, w) = laid_out(t.column(len(K)))
        q, (a, b) = laid_out(t.column(len(K) + 1))
        # APART from each other, a hole of another series begins after a band or ends before it
        got = dominance(np.column_stack([x, y]) + APART * h[:, None], np.column_stack([cnt, w]), np.column_stack([a, b]) + APART * q[:, None])
        any_ = got[:, 0] > 0
        return pa.RecordBatch.from_arrays([*(t.column(i).take(pa.array(q[any_])) for i in range(len(K))),
                                           *map(pa.array, (a[any_], b[any_], got[any_, 0], got[any_, 1]))], columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            size = sum(pc.list_value_length(t.column(len(K) + i)).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
            cuts = np.flatnonzero(np.diff(np.cumsum(size) // AT_ONCE)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, t.num_rows], strict=True):
                if hi > lo:
                    yield meet(t.slice(lo, hi - lo))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in bands.schema.fields if f.name in K)
    importable(holes.sparkSession)
    met = both.mapInArrow(run, f"{kinds}, a long, b long, cnt double, w double")
    return met.groupBy(*K, "a", "b").agg(F.sum("cnt").alias("cnt"), F.sum("w").alias("w"))


def neighbours(points: DataFrame, K: list[str], rows: int | None = None) -> DataFrame:
    """Ledger points (K, us, cum) with the points before and after them in the series, as structs p and n."""
    d, many = stitch.bucketed(points, K, F.col("us"), rows)
    w = Window.partitionBy(*K, stitch.BKT).orderBy("us", "cum")
    rec = F.struct("us", "cum")
    d = d.withColumns({"p": F.lag(rec).over(w), "n": F.lead(rec).over(w)})
    if many:
        ends = d.groupBy(*K, stitch.BKT).agg(F.min(rec).alias("_first"), F.max(rec).alias("_last"))
        ws = Window.partitionBy(*K).orderBy(stitch.BKT)
        ends = ends.select(*K, stitch.BKT, F.lag("_last").over(ws).alias("_before"), F.lead("_first").over(ws).alias("_after"))
        d = d.join(ends, [*K, stitch.BKT]).withColumns({"p": F.coalesce("p", "_before"), "n": F.coalesce("n", "_after")})
    return d.select(*K, "us", "cum", "p", "n")


def band_profile(gaps: DataFrame, ledger: DataFrame, keys: Sequence[str] = (), rows: int | None = None) -> DataFrame:
    """Per (keys, a, b): ``days`` with rows in the band and ``profile`` =
    mean of (upper - lower) over them (A5). Bands without days are absent.

    ``gaps`` has columns keys + ``a``, ``b`` (clock microseconds).
    """
    gaps, ledger, K = _with_series(gaps, ledger, keys)
    bands = gaps.select(*K, "a", "b").filter(F.col("a") <= F.col("b")).distinct()
    day = F.floor(F.col("us") / DAY_US)
    near = cut(neighbours(_points(ledger, K), K, rows).select(
        *K, day.cast("int").alias("day"), F.pmod("us", F.lit(DAY_US)).alias("t"), "cum",
        F.when(F.floor(F.col("p.us") / DAY_US) == day, F.col("p.cum")).alias("pc"),
        F.when(F.floor(F.col("n.us") / DAY_US) == day, F.struct(F.pmod("n.us", F.lit(DAY_US)).alias("t"), "n.cum")).alias("n")))
    bands = cut(bands)
    days = near.groupBy(*K, "day").agg(
        F.min_by("cum", F.struct("t", "cum")).alias("base"), F.min("t").alias("t0"),
        F.max_by(F.struct("t", "cum"), F.struct("t", "cum")).alias("end"))
    least = bands.groupBy(*K).agg(F.min(F.col("b") - F.col("a")).alias("_least"), F.count(F.lit(1)).alias("_nb"))

    # prefix sums over the clock: up to b of the lasts, before a of the firsts
    zero = F.lit(0.0)
    steps = near.select(*K, "t", F.lit(1).alias("o"), F.coalesce(F.col("cum") - F.col("pc"), zero).alias("dl"),
                        F.coalesce(F.col("n.cum") - F.col("cum"), zero).alias("df"))
    steps = steps.unionByName(days.select(*K, F.col("end.t").alias("t"), F.lit(1).alias("o"), zero.alias("dl"),
                                          (F.col("base") - F.col("end.cum")).alias("df")))
    steps = steps.select("*", F.lit(None).cast("bigint").alias("a"), F.lit(None).cast("bigint").alias("b"))
    asked = bands.select(*K, F.col("a").alias("t"), F.lit(0).alias("o"), zero.alias("dl"), zero.alias("df"), "a", "b").unionByName(
        bands.select(*K, F.col("b").alias("t"), F.lit(2).alias("o"), zero.alias("dl"), zero.alias("df"), "a", "b"))
    clock, many = stitch.bucketed(steps.unionByName(asked.select(*steps.columns)), K, F.col("t"), rows)
    clock = stitch.running_sum(clock, K, ["t", "o"], "dl", "l", many=many)
    clock = stitch.running_sum(clock, K, ["t", "o"], "df", "f", many=many)
    sums = clock.filter(F.col("o") != 1).groupBy(*K, "a", "b").agg(
        F.sum(F.when(F.col("o") == 2, F.col("l")).otherwise(-F.col("f"))).alias("s"))

    # the days without a row in the band
    far = F.lit(2 * DAY_US)
    inner = near.filter(F.col("n").isNotNull()).join(stitch.few(least), K).filter(F.col("n.t") - F.col("t") > F.col("_least")) \
        .join(days.select(*K, "day", "base"), [*K, "day"]).select(
        *K, "day", F.col("t").alias("x"), F.col("n.t").alias("y"), (F.col("cum") - F.col("n.cum")).alias("w"))
    edge = days.join(stitch.few(least), K)
    before = edge.filter(F.col("t0") > F.col("_least")).select(*K, "day", F.lit(-1).cast("bigint").alias("x"), F.col("t0").alias("y"), zero.alias("w"))
    after = edge.filter(F.col("end.t") < DAY_US - F.col("_least")).select(
        *K, "day", F.col("end.t").alias("x"), far.cast("bigint").alias("y"), (F.col("end.cum") - F.col("base")).alias("w"))
    holes = inner.unionByName(before).unionByName(after).withColumn("cnt", F.lit(1.0))
    around = _covered(cut(holes), bands, K)

    n_days = days.groupBy(*K).agg(F.count(F.lit(1)).alias("_days"))
    out = sums.join(around, [*K, "a", "b"], "left").join(n_days, K)
    out = out.select(*keys, "a", "b", (F.col("_days") - F.coalesce("cnt", zero)).cast("bigint").alias("days"),
                     (F.col("s") - F.coalesce("w", zero)).alias("_s"))
    return out.filter(F.col("days") > 0).select(*keys, "a", "b", "days", (F.col("_s") / F.col("days")).alias("profile"))


def band_day_diffs(gaps: DataFrame, ledger: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Per (keys, a, b, day): lower/upper bound rows of the band on that day (J3's
    rows: one for each band and day with rows in it is the result asked for).

    Returns keys, a, b, day, lower_ts, lower_value, upper_ts, upper_value.
    """
    gaps, ledger, K = _with_series(gaps, ledger, keys)
    bands = gaps.select(*K, "a", "b").filter(F.col("a") <= F.col("b")).distinct()
    points = _points(ledger, K).withColumn("day", day_of(from_micros("us")))
    days = points.groupBy(*K).agg(F.collect_set("day").alias("days"))
    midnight = micros(F.col("day").cast("timestamp_ntz"))
    asked = bands.join(days, K).select(*K, "a", "b", F.explode("days").alias("day")) \
        .withColumn("_a", midnight + F.col("a")).withColumn("_b", midnight + F.col("b"))
    lower = _nearest_rows(points, asked.withColumnRenamed("_a", "us"), K, back=True).select(
        *K, "day", F.col("us").alias("_a"), F.col("at").alias("_lo"), F.col("cum").alias("lower_value"))
    upper = _nearest_rows(points, asked.withColumnRenamed("_b", "us"), K, back=False).select(
        *K, "day", F.col("us").alias("_b"), F.col("at").alias("_hi"), F.col("cum").alias("upper_value"))
    return asked.join(lower, [*K, "day", "_a"]).join(upper, [*K, "day", "_b"]) \
        .filter((F.col("_lo") <= F.col("_b")) & (F.col("_hi") >= F.col("_a"))) \
        .select(*keys, "a", "b", "day", from_micros(F.col("_lo")).alias("lower_ts"), "lower_value",
                from_micros(F.col("_hi")).alias("upper_ts"), "upper_value")


def _nearest_rows(points: DataFrame, asked: DataFrame, K: list[str], back: bool) -> DataFrame:
    """Per asked (K, day, us): the last row at or before, or with ``back`` the
    first at or after it, of the same day, as (day, us, at, cum)."""
    sign = -1 if back else 1
    t = F.lit(sign) * F.col("us")
    rec = F.struct(t.alias("t"), (F.lit(sign) * F.col("cum")).alias("c"))
    rows = points.select(*K, "day", "us", F.lit(0).alias("_o"), rec.alias("rec")).unionByName(
        asked.select(*K, "day", "us", F.lit(1).alias("_o"), F.lit(None).cast("struct<t:bigint,c:double>").alias("rec")).distinct())
    part = [*K, "day"]
    rows, many = stitch.bucketed(rows, part, F.col("us"))
    found = stitch.running_max(rows, part, [t, F.col("_o")], "rec", "best", many=many, back=back)
    return found.filter((F.col("_o") == 1) & F.col("best").isNotNull()).select(
        *part, "us", (F.lit(sign) * F.col("best.t")).alias("at"), (F.lit(sign) * F.col("best.c")).alias("cum"))


def day_bounds_in_band(ledger: DataFrame, a_us: int, b_us: int,
                       keys: Sequence[str] = ()) -> DataFrame:
    """J1 / A1 for one fixed band: per day the first and last ledger row with
    clock time in [a, b] and their cumulative values. One partial/final
    aggregate replaces the reference's two self-joins."""
    K = list(keys)
    rows = (ledger.withColumn("tod", tod_us("ts"))
            .filter(F.col("tod").between(a_us, b_us))
            .withColumn("day", day_of("ts")))
    lo = F.struct("ts", "cumulative_sum")
    return (rows.groupBy(*K, "day")
            .agg(F.min("ts").alias("lower_bound"),
                 F.min_by("cumulative_sum", lo).alias("lower_value"),
                 F.max("ts").alias("upper_bound"),
                 F.max_by("cumulative_sum", lo).alias("upper_value")))


def day_bounds_join_form(ledger: DataFrame, a_us: int, b_us: int) -> DataFrame:
    """J1 in the reference's join form: per-day MIN/MAX ts of the band, joined
    back to the band rows on (day, ts = bound). Duplicate boundary
    timestamps multiply rows, as in the reference. The bounds table has one
    row per day, so the joins never shuffle the detail rows by more than
    (day, ts)."""
    rows = (ledger.withColumn("tod", tod_us("ts"))
            .filter(F.col("tod").between(a_us, b_us))
            .select(day_of("ts").alias("day"), "ts", "cumulative_sum"))
    bounds = rows.groupBy("day").agg(F.min("ts").alias("lower_bound"),
                                     F.max("ts").alias("upper_bound"))
    lv = rows.select("day", F.col("ts").alias("lower_bound"),
                     F.col("cumulative_sum").alias("lower_value"))
    uv = rows.select("day", F.col("ts").alias("upper_bound"),
                     F.col("cumulative_sum").alias("upper_value"))
    return (bounds.join(lv, ["day", "lower_bound"]).join(uv, ["day", "upper_bound"])
            .select("day", "lower_bound", "lower_value", "upper_bound", "upper_value"))
