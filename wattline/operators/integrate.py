"""Power -> energy integration with carry-in state and gap filling.

One declarative pass per batch replaces the reference's driver-side fold:

1. seed row per series: the newest ledger row (ts, value, cumulative_sum), or,
   with no ledger state, a synthetic row at ``first ts - step`` with value 0
   (``first_row='drop'`` also removes the first reading);
2. previous and second-previous row of every reading by a window over its
   (series, bucket); the first two rows of a bucket take theirs from the
   bucket summaries (no single-partition window over a large series);
3. ``gap`` = elapsed > 2 * step; the reading after a gap sees value 0;
4. normal rows: ``factor * hours * (clamp(v) + clamp(prev_v))``;
   gap rows: the band profile of the ledger spread over the fill slots
   ``prev_ts + k * step`` (k = 1..n), the gap-ending reading not emitted;
5. ``cumulative_sum`` = seed sum + running sum in reading order (a fill slot
   may lie after the next reading, so not in output-ts order); slot sums are
   ``sum_before_gap + k * slot_energy``, so slots are exploded after the
   window, in bounded chunks.

The detail rows are shuffled once (see ``Integrated``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.functions.timefns import (
    add_micros, day_of, diff_micros, micros, ntz_literal, tod_us)
from wattline.operators import profile as prof
from wattline.plans import stitch
from wattline.plans.materialize import cut

SERIES = "_series"
LEDGER_COLS = ["ts", "cumulative_sum", "integral", "delta", "value"]
SLOT_CHUNK = 4096


@dataclass(frozen=True)
class Spec:
    """Integration parameters (the four reference variants are below)."""
    name: str
    step_ms: int
    clamp: str                      # 'negative' keeps v < 0, 'positive' keeps v > 0
    factor: float                   # -0.5 export, +2.0 production (parity)
    gap_fill: bool = True
    slots: str = "lt"               # 'lt': ceil(gap/step) slots, 'le': floor(gap/step)+1
    empty_profile: str = "zero"     # 'zero' fill with 0 energy, 'skip' emit nothing
    first_row: str = "synthetic"    # 'synthetic' integrate from ts-step, 'drop' skip it
    first_step_ms: int | None = None
    cutoff: str | None = None       # readings before this NTZ time are ignored
    skip_shift_ms: int = 60_000     # 'skip': previous time moves to reading + 1 min

    def with_(self, **kw) -> "Spec":
        return replace(self, **kw)

    @property
    def seed_step_ms(self) -> int:
        return self.first_step_ms if self.first_step_ms is not None else self.step_ms


# Fixed values of the reference variants (step, clamp, factor, slot rule,
# empty-profile rule, first-row rule, cutoff).
LEGACY = Spec("legacy", 1000, "negative", -0.5, gap_fill=False,
              first_row="synthetic")
FIRST_GAP = Spec("first_gap", 1000, "negative", -0.5, slots="le",
                 empty_profile="skip", first_row="synthetic")
EXPORT = Spec("export", 30000, "negative", -0.5, slots="lt",
              empty_profile="zero", first_row="drop",
              cutoff="2025-10-20 00:00:00")
PRODUCTION = Spec("production", 30000, "positive", 2.0, slots="lt",
                  empty_profile="zero", first_row="synthetic",
                  cutoff="2025-10-20 00:00:00")


def clamp(col, how: str):
    """Keep only the sign that the ledger counts (after NULL -> 0)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.least(c, F.lit(0.0)) if how == "negative" else F.greatest(c, F.lit(0.0))


def _keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    if keys:
        return df, list(keys)
    return df.withColumn(SERIES, F.lit(0)), [SERIES]


def _small(df: DataFrame, single_row: bool) -> DataFrame:
    # One row per series; with no series key that is provably one row.
    return F.broadcast(df) if single_row else df


def ledger_state(ledger: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Newest ledger row per series (O1 / P12): keys, s_ts, s_value, s_cum."""
    lg, K = _keys(ledger, keys)
    last = stitch.last_in_group(
        lg.filter(F.col("ts").isNotNull()), K, ["ts", "cumulative_sum"],
        ["ts", "value", "cumulative_sum"], prefix="s_")
    return last.select(*keys, "s_ts", "s_value",
                       F.coalesce("s_cumulative_sum", F.lit(0.0)).alias("s_cum"))


def integrate(readings: DataFrame, ledger: DataFrame | None = None,
              spec: Spec = EXPORT, keys: Sequence[str] = (),
              state: DataFrame | None = None,
              profile_ledger: DataFrame | None = None,
              late: str = "keep", rows: int | None = None) -> DataFrame:
    """Integrate ``readings`` (keys, ts, value) into ledger rows.

    ``ledger`` supplies the carry-in state (newest row per series) and the
    rows the gap profile is taken from; ``state`` / ``profile_ledger``
    override either. ``rows`` is the bucket size. Returns keys + ts,
    cumulative_sum, integral, delta, value.
    """
    if spec.gap_fill and spec.empty_profile == "skip":
        from wattline.operators.skipfill import integrate_skip
        return integrate_skip(readings, ledger, spec, list(keys), state, profile_ledger, late, rows)[0].drop("_rts")
    return _integrate(readings, ledger, spec, keys, state, profile_ledger, late, rows).ledger()


def prepared(readings: DataFrame, spec: Spec, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """(series, ts, value): NULL values count as 0, readings without time or before the cutoff go."""
    r, K = _keys(readings.select(*keys, "ts", "value"), keys)
    r = r.select(*K, "ts", F.coalesce(F.col("value").cast("double"), F.lit(0.0)).alias("value"))
    r = r.filter(F.col("ts").isNotNull())
    return (r.filter(F.col("ts") >= ntz_literal(spec.cutoff)) if spec.cutoff else r), K


def seeds_of(first: DataFrame, state: DataFrame | tuple | None, K: list[str], spec: Spec, keyed: bool) -> DataFrame:
    """One seed per series of ``first`` (series, f_ts): where its integration starts from."""
    if isinstance(state, tuple):
        ts, value, cum = state                       # of a table of one series
        seeds = first.select("*", F.lit(ts).cast("timestamp_ntz").alias("s_ts"), F.lit(value).cast("double").alias("s_value"),
                             F.lit(cum).cast("double").alias("s_cum"))
    elif state is not None:
        seeds = first.join(_small(state.select(*K, "s_ts", "s_value", "s_cum"), not keyed), K, "left")
    else:
        seeds = first.select("*", F.lit(None).cast("timestamp_ntz").alias("s_ts"),
                             F.lit(None).cast("double").alias("s_value"), F.lit(None).cast("double").alias("s_cum"))
    has_state = F.col("s_ts").isNotNull()
    return seeds.select(
        *K, "f_ts", "s_ts",
        (~has_state & F.lit(spec.first_row == "drop")).alias("_drop_first"),
        F.when(has_state, F.col("s_ts"))
         .otherwise(add_micros("f_ts", F.lit(-spec.seed_step_ms * 1000))).alias("_seed_ts"),
        F.when(has_state, F.coalesce("s_value", F.lit(0.0))).otherwise(F.lit(0.0)).alias("_seed_v"),
        F.when(has_state, F.col("s_cum")).otherwise(F.lit(0.0)).alias("_seed_c"))


def newer_than_state(r: DataFrame, seeds: DataFrame, K: list[str], keyed: bool) -> DataFrame:
    """The readings after the carried-in state of their series."""
    return r.join(_small(seeds.select(*K, "s_ts"), not keyed), K, "left") \
        .filter(F.col("s_ts").isNull() | (F.col("ts") > F.col("s_ts"))).select(*K, "ts", "value")


def with_seeds(r: DataFrame, seeds: DataFrame, K, order, found: stitch.Cuts, drop: bool, one_task: bool = False) -> DataFrame:
    """Readings and one seed row per series, partitioned by (series, bucket).

    A seed lies in the bucket of the first reading and sorts before it, so the
    reading that ``first_row='drop'`` skips is the row right after such a
    seed: one row, also when several share the first timestamp."""
    rows = r.select(*K, "ts", "value", F.col("ts").alias("_at"),
                    F.lit(1).alias("_o"), F.lit(0.0).alias("_c0"), F.lit(False).alias("_d"))
    seed_rows = seeds.select(*K, F.col("_seed_ts").alias("ts"), F.col("_seed_v").alias("value"),
                             F.col("f_ts").alias("_at"), F.lit(0).alias("_o"),
                             F.col("_seed_c").alias("_c0"), F.col("_drop_first").alias("_d"))
    out = found.bucket(rows.unionByName(seed_rows), micros("_at")).drop("_at")
    out = out.coalesce(1) if one_task else stitch.partition_by_bucket(out, K)
    if drop:
        w = Window.partitionBy(*K, stitch.BKT).orderBy(*order)
        out = out.withColumn("_skip", F.coalesce(F.lag("_d").over(w), F.lit(False))).filter(~F.col("_skip"))
    return out.drop("_d", "_skip")


#: Order of a series' rows: the seed, then readings by time.
ORDER = ["_o", "ts", "value"]
#: What a row takes from the row before it.
BACK = ["ts", "_us", "value", "_o"]


@dataclass
class Integrated:
    """The parts of an integration: rows with local sums, and what is added to them by bucket.

    ``rows`` are the seeds and readings with everything that follows from their own
    bucket: ``_lc`` sums the contributions known there. What needs other rows, the
    first two of a bucket and all gaps, is ``pending`` (a small table, None if there
    can be none): completed by halo and profile, with ``_cp``, the running sum of
    pending contributions in the bucket. ``before`` has the sum before each bucket.
    ``_ps`` counts a row's pending rows up to itself, so ``_cp`` of the ``_ps``-th is what a
    row adds to ``_lc``: the detail rows meet the small tables by place, in one join, and
    are neither sorted nor shuffled again.
    """
    rows: DataFrame
    pending: DataFrame | None
    before: DataFrame | None
    n_pending: int
    K: list[str]
    keys: list[str]
    spec: Spec

    def summed(self) -> DataFrame:
        """Rows with ``_cum`` and their own gap, energy and interval."""
        x, P = self.rows, [*self.K, stitch.BKT]
        if self.pending is None:
            return x.withColumn("_cum", F.col("_lc"))
        info = F.struct("_ps", "_cp", "_gap", "_integral", "_delta")
        found = self.pending.groupBy(*P).agg(F.sort_array(F.collect_list(info)).alias("_pend"))
        if self.before is not None:
            found = self.before.join(found, P, "left")
        else:
            found = found.withColumn("_pre", F.lit(0.0))
        # one row a bucket; the arrays together hold n_pending entries
        x = x.drop("_gap").join(stitch.small(found, self.n_pending), P, "left")
        at = F.get("_pend", F.col("_ps") - 1)
        own = {c: F.when(F.col("_pending"), at[c]).otherwise(F.col(c)) for c in ("_integral", "_delta")}
        return x.withColumns({
            "_cum": F.coalesce("_pre", F.lit(0.0)) + F.col("_lc") + F.coalesce(at["_cp"], F.lit(0.0)),
            "_gap": F.when(F.col("_pending"), at["_gap"]).otherwise(F.lit(False)), **own}).drop("_pend", "_pre")

    def ledger(self, extra: bool = False, spread: bool = True) -> DataFrame:
        """Ledger rows: readings as they are, gaps as fill slots (from the pending rows alone).

        ``extra`` adds ``_rts``, the time of the reading that a row comes from. Without
        ``spread``, where slots are known to be few, they are generated where their gap is."""
        more = [F.col("ts").alias("_rts")] if extra else []
        plain = self.summed().filter((F.col("_o") == 1) & ~F.col("_gap")).select(
            *self.keys, "ts", F.col("_cum").alias("cumulative_sum"), F.col("_integral").alias("integral"),
            F.col("_delta").alias("delta"), "value", *more)
        if self.pending is None or not self.spec.gap_fill:
            return plain
        gaps = self.pending.filter(F.col("_gap"))
        if self.before is not None:
            gaps = gaps.join(stitch.small(self.before, self.n_pending), [*self.K, stitch.BKT])
        else:
            gaps = gaps.withColumn("_pre", F.lit(0.0))
        gaps = gaps.withColumn("_cum", F.col("_pre") + F.col("_lc") + F.col("_cp"))
        return plain.unionByName(fill_slots(gaps, self.K, self.keys, self.spec, "_p1_ts", more, spread))


def _columns(p1_us, p1_v, p1_o, p2_us, spec: Spec) -> dict:
    """Gap flag, interval and energy of a row from its two predecessors (times in microseconds, as the row's ``_us``)."""
    is_reading, thr = F.col("_o") == 1, F.lit(2 * spec.step_ms * 1000)
    d_us = F.col("_us") - p1_us
    if spec.gap_fill:
        gap = F.coalesce(is_reading & (d_us > thr), F.lit(False))
        prev_gap = F.coalesce(is_reading & (p1_o == 1) & (p1_us - p2_us > thr), F.lit(False))
    else:
        gap = prev_gap = F.lit(False)
    pv = F.when(prev_gap, F.lit(0.0)).otherwise(F.coalesce(p1_v, F.lit(0.0)))
    delta = d_us / F.lit(1e6)
    return {"_gap": gap, "_d_us": d_us, "_delta": delta,
            "_integral": (F.lit(spec.factor) * (delta / F.lit(3600.0))) * (clamp("value", spec.clamp) + clamp(pv, spec.clamp))}


@dataclass
class Scan:
    """Seeds and readings with what their own bucket tells (see ``Integrated``); ``kept`` where they are written."""
    rows: DataFrame
    many: bool
    kept: bool
    K: list[str]
    keys: list[str]
    spec: Spec


def scan(readings: DataFrame, spec: Spec, keys: Sequence[str] = (), state: DataFrame | None = None, late: str = "keep",
         rows: int | None = None, keep=cut, small_batch: bool = False) -> Scan:
    """The one pass over the detail rows: a shuffle by (series, bucket), one sort, and a write if they are read again.

    ``keep`` materializes (a reliable checkpoint; a micro-batch passes a persist-and-release
    function). ``small_batch``: the caller knows that the readings are few and come from small files, so
    nothing is counted, and those of a table of one series stay in the one task that has to sort them."""
    keys = list(keys)
    keyed = bool(keys)
    one_task = small_batch and not keyed
    r, K = prepared(readings, spec, keys)
    if one_task:
        r = r.coalesce(1)
    if state is not None and not isinstance(state, tuple):
        state, _ = _keys(state, keys)
    first = r.groupBy(*K).agg(F.min("ts").alias("f_ts"), F.count(F.lit(1)).alias("n"))
    if small_batch:
        found = stitch.Cuts(K)
    else:
        first = cut(first)                           # a row per series
        found = stitch.cuts(r, K, micros("ts"), rows, counts=first)
    seeds = seeds_of(first.select(*K, "f_ts"), state, K, spec, keyed)
    if late == "drop":
        r = newer_than_state(r, seeds, K, keyed)

    w = Window.partitionBy(*K, stitch.BKT).orderBy(*ORDER)
    goes_on = isinstance(state, tuple) and state[0] is not None      # then no reading is skipped
    x = with_seeds(r, seeds, K, ORDER, found, spec.first_row == "drop" and not goes_on, one_task)
    # the time as a number, once a row: its differences are many
    x = x.withColumn("_us", micros("ts"))
    back = {f"_p1{c}": F.lag(c).over(w) for c in BACK}
    x = x.withColumns({**back, "_p2_us": F.lag("_us", 2).over(w), "_rn": F.row_number().over(w),
                       "_last": F.lead("_o").over(w).isNull(), "_tail": F.lead("_o", 2).over(w).isNull()})
    x = x.withColumns(_columns(F.col("_p1_us"), F.col("_p1value"), F.col("_p1_o"), F.col("_p2_us"), spec))
    head = F.col("_rn") <= 2 if found.many else F.lit(False)
    x = x.withColumn("_pending", head | F.col("_gap"))
    known = F.when(F.col("_pending"), 0.0).when(F.col("_o") == 0, F.col("_c0")).otherwise(F.col("_integral"))
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = x.withColumns({"_lc": F.sum(known).over(so_far), "_ps": F.sum(F.col("_pending").cast("int")).over(so_far).cast("int")})
    if found.many:                                   # read for the pending rows, the bucket totals and the result
        return Scan(keep(x), True, True, K, keys, spec)
    # what follows from other columns is not kept, but by what many series are partitioned
    x = x.select(*([*K, stitch.BKT] if keyed else []), "ts", "value", "_o", "_c0", "_gap", "_d_us", "_integral", "_lc", "_ps")
    x = (keep(x) if spec.gap_fill else x).withColumns({
        "_pending": F.col("_gap"), "_delta": F.col("_d_us") / F.lit(1e6), "_p1_ts": add_micros("ts", -F.col("_d_us"))})
    if not keyed:
        x = x.withColumns({SERIES: F.lit(0), stitch.BKT: F.lit(0).cast("bigint")})
    return Scan(x, False, spec.gap_fill, K, keys, spec)


def scan_state(x: DataFrame, K: Sequence[str]) -> DataFrame:
    """Where the readings of a series leave it if they emit no ledger row: (K, s_ts, s_value, s_cum).

    That is its last row (the seed, if all readings were dropped) and the sum of its seed. A
    series that emits goes on from its newest ledger row instead."""
    order = F.struct(*ORDER)
    return x.groupBy(*K).agg(F.max_by("ts", order).alias("s_ts"), F.max_by("value", order).alias("s_value"),
                             F.max(F.when(F.col("_o") == 0, F.col("_c0"))).alias("s_cum"))


def _integrate(readings, ledger=None, spec: Spec = EXPORT, keys=(), state=None, profile_ledger=None, late="keep",
               rows: int | None = None) -> Integrated:
    """The integration in one exchange of the detail rows and at most one write of them."""
    if state is None and ledger is not None:
        state = ledger_state(ledger, keys)
    if profile_ledger is None:
        profile_ledger = ledger
    found = scan(readings, spec, keys, state, late, rows)
    profile = None
    if profile_ledger is not None:
        def profile(bands):
            return prof.band_profile(bands, _keys(profile_ledger, keys)[0], found.K)
    return completed(found, profile)


def completed(found: Scan, profile=None, keep=cut, n_pending: int | None = None) -> Integrated:
    """The scan with its pending rows completed by the halo of their bucket and the profile of their band.

    ``profile`` takes the bands (K, a, b, gday: the gap's day) and returns K, a, b, profile, or by gday too.
    ``n_pending`` spares the count of pending rows, if the caller knows it."""
    x, K, keys, spec = found.rows, found.K, found.keys, found.spec
    P = [*K, stitch.BKT]
    if not found.kept:
        return Integrated(x, None, None, 0, K, keys, spec)
    pending = x.filter(F.col("_pending"))
    if found.many:
        halo = stitch.halo_rows(x.filter(F.col("_tail")).select(*P, *ORDER, "_us"), K, ORDER, BACK, 2)
        h1, h2 = F.col("_h1"), F.col("_h2")
        first_row, second_row = F.col("_rn") == 1, F.col("_rn") == 2
        back = {f"_p1{c}": F.when(first_row, h1[c]).otherwise(F.col(f"_p1{c}")) for c in BACK}
        back["_p2_us"] = F.when(first_row, h2["_us"]).when(second_row, h1["_us"]).otherwise(F.col("_p2_us"))
        pending = pending.join(halo, P, "left").withColumns(back)
        pending = pending.withColumns({**_columns(F.col("_p1_us"), F.col("_p1value"), F.col("_p1_o"), F.col("_p2_us"), spec),
                                       "_p1_ts": F.col("_p1ts")}).drop("_h1", "_h2", "_p2_us", "_us", *[f"_p1{c}" for c in BACK])
    step_us = spec.step_ms * 1000
    if spec.gap_fill and profile is not None:
        pending = pending.withColumns({"a": F.when(F.col("_gap"), tod_us("_p1_ts")), "b": F.when(F.col("_gap"), tod_us("ts"))})
        if found.many:
            pending = keep(pending)                  # the halo join is read by the bands and by the rows
        pending = pending.withColumn("gday", F.when(F.col("_gap"), day_of("ts")))
        found_profile = profile(pending.filter(F.col("_gap")).select(*K, "a", "b", "gday"))
        on = [*K, "a", "b", *(["gday"] if "gday" in found_profile.columns else [])]
        found_profile = found_profile.select(*on, "profile")
        if n_pending is not None:                    # a row per band at most
            found_profile = stitch.small(found_profile, n_pending)
        pending = pending.join(found_profile, on, "left").drop("gday")
    else:
        pending = pending.withColumn("profile", F.lit(None).cast("double"))
    pending = pending.withColumns({
        "_n": n_slots(spec),
        # NULL between readings of one time, which are no gap
        "_ai": F.try_divide(F.coalesce("profile", F.lit(0.0)), (F.col("_delta") * F.lit(1000.0)) / F.lit(float(spec.step_ms)))})
    pending = pending.withColumn("_c", F.when(F.col("_o") == 0, F.col("_c0")).when(F.col("_gap"), F.col("_n") * F.col("_ai"))
                                 .otherwise(F.col("_integral")))
    wp = Window.partitionBy(*P).orderBy("_ps").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pending = keep(pending.withColumn("_cp", F.sum("_c").over(wp)))
    before = None
    if n_pending is None:
        n_pending = pending.count()
    if found.many:
        ends = x.filter(F.col("_last")).select(*P, F.col("_lc").alias("_t")).join(
            pending.groupBy(*P).agg(F.max_by("_cp", "_ps").alias("_tp")), P, "left")
        ws = Window.partitionBy(*K).orderBy(stitch.BKT).rowsBetween(Window.unboundedPreceding, -1)
        before = ends.select(*P, F.coalesce(F.sum(F.col("_t") + F.coalesce("_tp", F.lit(0.0))).over(ws), F.lit(0.0)).alias("_pre"))
    return Integrated(x, pending, before, n_pending, K, keys, spec)


def short(found: Scan, profile, n_gaps: int) -> DataFrame:
    """Ledger rows, with ``_rts``, of a scan without bucket summaries whose gaps and slots are known to be few: the
    profiles are broadcast to the rows, which are summed once more where they lie."""
    x, K, spec = found.rows, found.K, found.spec
    bands = x.filter(F.col("_gap")).select(*K, tod_us("_p1_ts").alias("a"), tod_us("ts").alias("b"), day_of("ts").alias("gday"))
    got = profile(bands)
    on = [*K, "a", "b", *(["gday"] if "gday" in got.columns else [])]
    gap = F.col("_gap")
    x = x.select(*K, stitch.BKT, "ts", "value", "_o", "_c0", "_gap", "_p1_ts", "_delta", "_integral", n_slots(spec).alias("_n"),
                 F.when(gap, tod_us("_p1_ts")).alias("a"), F.when(gap, tod_us("ts")).alias("b"), F.when(gap, day_of("ts")).alias("gday")) \
        .join(stitch.small(got.select(*on, "profile"), n_gaps), on, "left")
    each = F.try_divide(F.coalesce("profile", F.lit(0.0)), (F.col("_delta") * F.lit(1000.0)) / F.lit(float(spec.step_ms)))
    x = x.select("*", each.alias("_ai")).select("*", F.when(F.col("_o") == 0, F.col("_c0")).when(gap, F.col("_n") * F.col("_ai"))
                                                .otherwise(F.col("_integral")).alias("_c"))
    w = Window.partitionBy(*K, stitch.BKT).orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    zero = F.lit(0).cast("bigint")
    k = F.when(gap, F.sequence(F.lit(1).cast("bigint"), F.greatest("_n", F.lit(1)))).otherwise(F.array(zero))
    x = x.select("*", F.sum("_c").over(w).alias("_cum")).filter(F.col("_o") == 1).select("*", F.explode(k).alias("_k"))

    def either(slot: Column, reading) -> Column:
        return F.when(gap, slot).otherwise(reading if isinstance(reading, Column) else F.col(reading))
    return x.select(*found.keys, either(add_micros("_p1_ts", F.col("_k") * (spec.step_ms * 1000)), "ts").alias("ts"),
                    either((F.col("_cum") - F.col("_c")) + F.col("_k") * F.col("_ai"), "_cum").alias("cumulative_sum"),
                    either(F.col("_ai"), "_integral").alias("integral"), either(F.lit(spec.step_ms / 1000.0), "_delta").alias("delta"),
                    either(F.lit(0.0), "value").alias("value"), F.col("ts").alias("_rts"))


def n_slots(spec: Spec) -> Column:
    """Fill slots of a row with ``_gap`` and ``_d_us``; 0 where it is no gap."""
    step_us = spec.step_ms * 1000
    n = F.expr(f"div(_d_us + {step_us - 1}, {step_us})" if spec.slots == "lt" else f"div(_d_us, {step_us}) + 1")
    return F.when(F.col("_gap"), n).otherwise(F.lit(0)).cast("bigint")


def fill_slots(gaps: DataFrame, K, keys, spec: Spec, prev_col: str, more=(), spread: bool = True) -> DataFrame:
    """Ledger rows of gaps: fill slots ``prev + k * step``.

    A gap can stand for millions of slots while the gaps are few, so the
    partitioning the gaps arrive in says nothing about the output size.
    Gaps are cut into chunks of at most SLOT_CHUNK slots, and the chunks
    are spread over spark.sql.shuffle.partitions tasks before the slots are
    generated; the explicit number keeps AQE from merging them by the size of
    the chunk rows."""
    step_us = spec.step_ms * 1000
    parts = int(gaps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    x = slots(gaps, parts if spread else None, [*K, "ts"])
    return x.select(
        *keys, add_micros(prev_col, F.col("_k") * step_us).alias("ts"),
        ((F.col("_cum") - F.col("_c")) + F.col("_k") * F.col("_ai")).alias("cumulative_sum"),
        F.col("_ai").alias("integral"), F.lit(spec.step_ms / 1000.0).alias("delta"), F.lit(0.0).alias("value"), *more)


def slots(gaps: DataFrame, parts: int | None, spread: Sequence[str]) -> DataFrame:
    """``gaps`` (with ``_n``) once per ``_k`` = 1.._n, in bounded arrays, long gaps spread over ``parts`` tasks."""
    x = gaps.withColumn("_chunk", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.expr(f"div(greatest(_n - 1, 0), {SLOT_CHUNK})"))))
    if parts:
        x = x.repartition(parts, *spread, "_chunk")
    return x.withColumn("_k", F.explode(
        F.sequence(F.col("_chunk") * SLOT_CHUNK + 1, F.least((F.col("_chunk") + 1) * SLOT_CHUNK, F.col("_n")))))


def emit(x: DataFrame, K, keys, spec: Spec, prev_col: str) -> DataFrame:
    """Ledger rows, with ``_rts``, of integrated readings: those without a gap as they are, gaps as slots."""
    more = [F.col("ts").alias("_rts")]
    plain = x.filter(~F.col("_gap")).select(
        *keys, "ts", F.col("_cum").alias("cumulative_sum"), F.col("_integral").alias("integral"),
        F.col("_delta").alias("delta"), "value", *more)
    return plain.unionByName(fill_slots(x.filter(F.col("_gap")), K, keys, spec, prev_col, more))


def final_state(x: DataFrame, K, keys, order, ts, zero) -> DataFrame:
    """State after the last row of every series: keys, s_ts, s_value, s_cum.

    ``x`` holds the integrated readings and the seed rows, so a series whose
    readings emitted nothing still has a state, that of its seed. ``ts`` is
    the time to carry on from, ``zero`` where the carried value is 0."""
    value = F.when(zero, F.lit(0.0)).otherwise(F.col("value"))
    last = stitch.last_in_group(x.select(*K, *order, ts.alias("_t"), value.alias("_v"), "_cum"),
                                K, order, ["_t", "_v", "_cum"], prefix="l_")
    return last.select(*keys, F.col("l__t").alias("s_ts"), F.col("l__v").alias("s_value"),
                       F.col("l__cum").alias("s_cum"))


def gap_list(readings: DataFrame, ledger: DataFrame | None, spec: Spec,
             keys: Sequence[str] = ()) -> DataFrame:
    """G1 for a batch with carry-in: readings whose distance to the previous
    point (the ledger's newest row for the first one) exceeds 2 * step, with
    the clock-time band (a, b) their profile is taken over."""
    from wattline.operators.quality import previous_ts
    r = readings.select(*keys, "ts", F.lit(1).alias("_o"))
    if ledger is not None:
        st = ledger_state(ledger, keys).select(*keys, F.col("s_ts").alias("ts"),
                                               F.lit(0).alias("_o"))
        r = r.unionByName(st)
    p = previous_ts(r, keys, tiebreak=["_o"])
    thr = 2 * spec.step_ms * 1000
    return (p.filter((F.col("_o") == 1) & (diff_micros("previous_ts", "ts") > thr))
            .select(*keys, F.col("ts").alias("gap_ts"), "previous_ts",
                    tod_us("previous_ts").alias("a"), tod_us("ts").alias("b")))
