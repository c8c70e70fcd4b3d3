"""Integration with the ``skip`` empty-profile policy (first gap version).

When a gap's band has no ledger day, nothing is emitted and the previous
time moves to ``reading + skip_shift``; the next reading then sees a shorter
(possibly negative) interval, which may or may not be a gap. Whether row i
is skipped thus depends on whether row i-1 was.

Only two previous times are possible for a row (previous reading, or
previous reading + shift), so both candidate bands are profiled up front in
one set-based pass. Each row's "skipped" flag is then a function of the
previous row's flag that is constant, the identity or a negation. The flag
of row i is the value set by the last constant row, flipped by the parity
of negations after it: a running max ("last constant") and a running count
of negations, both stitched across time buckets. No sequential loop, no
single-partition window.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from wattline.functions.timefns import add_micros, day_of, diff_micros, micros, tod_us
from wattline.operators import profile as prof
from wattline.plans import stitch
from wattline.plans.materialize import cut


def integrate_skip(readings, ledger, spec, keys, state, profile_ledger, late, rows=None, keep=cut, profile=None,
                   small_batch=False):
    """(ledger rows with ``_rts``, state after the last reading of every series)."""
    from wattline.operators.integrate import (
        ORDER, _keys, clamp, emit, final_state, ledger_state, newer_than_state, prepared, seeds_of, with_seeds)
    keyed = bool(keys)
    r, K = prepared(readings, spec, keys)
    if state is None and ledger is not None:
        state = ledger_state(ledger, keys)
    if state is not None and not isinstance(state, tuple):
        state, _ = _keys(state, keys)
    if profile_ledger is None:
        profile_ledger = ledger
    if profile is None and profile_ledger is not None:
        def profile(bands):
            return prof.band_profile(bands, _keys(profile_ledger, keys)[0], K)
    step_us, shift_us = spec.step_ms * 1000, spec.skip_shift_ms * 1000
    thr_us = 2 * step_us

    found = stitch.Cuts(K) if small_batch else stitch.cuts(r, K, micros("ts"), rows)
    first = r.groupBy(*K).agg(F.min("ts").alias("f_ts"))
    seeds = seeds_of(first, state, K, spec, keyed)
    if late == "drop":
        r = newer_than_state(r, seeds, K, keyed)

    order, many = ORDER, found.many
    allrows = with_seeds(r, seeds, K, order, found, spec.first_row == "drop")
    lagged = stitch.halo_lags(allrows, K, order, ["ts", "value", "_o"], depth=1, many=many)

    is_reading = F.col("_o") == 1
    d_a = diff_micros("_p1_ts", "ts")
    cand = is_reading & (d_a > F.lit(thr_us))
    x = lagged.select(
        *K, stitch.BKT, "ts", "value", "_o", "_c0", "_p1_ts", "_p1_value",
        d_a.alias("_da"), F.coalesce(cand, F.lit(False)).alias("_cand"),
        F.coalesce(is_reading & (d_a - F.lit(shift_us) > F.lit(thr_us)), F.lit(False)).alias("_gapb"),
        tod_us("_p1_ts").alias("_aa"), tod_us(add_micros("_p1_ts", F.lit(shift_us))).alias("_ab"),
        tod_us("ts").alias("_b"))
    x = keep(x)

    # profiles of both candidate bands of every candidate row, one pass
    x = x.withColumn("gday", day_of("ts"))
    cands = x.filter("_cand")
    bands = (cands.select(*K, F.col("_aa").alias("a"), F.col("_b").alias("b"), "gday")
             .unionByName(cands.select(*K, F.col("_ab").alias("a"), F.col("_b").alias("b"), "gday")))
    if profile is not None:
        bp = profile(bands)
        on = ["gday"] if "gday" in bp.columns else []
        bp = keep(bp.select(*K, "a", "b", *on, "profile"))
        x = (x.join(bp.select(*K, *on, F.col("a").alias("_aa"), F.col("b").alias("_b"),
                              F.col("profile").alias("_pa")), [*K, *on, "_aa", "_b"], "left")
              .join(bp.select(*K, *on, F.col("a").alias("_ab"), F.col("b").alias("_b"),
                              F.col("profile").alias("_pb")), [*K, *on, "_ab", "_b"], "left")).drop("gday")
    else:
        x = x.withColumns({"_pa": F.lit(None).cast("double"), "_pb": F.lit(None).cast("double")}).drop("gday")
    f0 = F.col("_cand") & F.col("_pa").isNull()
    f1 = F.col("_cand") & F.col("_gapb") & F.col("_pb").isNull()
    x = x.withColumns({
        "_const": f0 == f1,
        "_neg": (f0 & ~f1).cast("int"),
        "_cval": f0.cast("int"),
    })
    x = stitch.running_sum(x, K, order, "_neg", "_nneg", many=many)
    x = x.withColumn("_cv", F.when(F.col("_const"), F.struct(
        *[F.col(o) for o in order],
        F.pmod(F.col("_cval") + F.col("_nneg").cast("int"), F.lit(2)).alias("v"))))
    x = stitch.running_max(x, K, order, "_cv", "_last", many=many)
    x = x.withColumn("_skip", F.pmod(F.col("_last.v") + F.col("_nneg").cast("int"), F.lit(2)) == 1)
    x = keep(x.drop("_cv", "_last", "_const", "_neg", "_cval", "_nneg"))

    # previous row's skip / gap (skip of row i-2 decides row i-1's gap)
    y = stitch.halo_lags(x, K, order, ["_skip", "_cand", "_gapb"], depth=2, many=many)
    shifted = F.coalesce(F.col("_p1__skip"), F.lit(False))
    prev_gap = F.coalesce(F.col("_p1__cand") & (~F.coalesce(F.col("_p2__skip"), F.lit(False))
                                                 | F.col("_p1__gapb")), F.lit(False))
    d_us = F.col("_da") - F.when(shifted, F.lit(shift_us)).otherwise(F.lit(0))
    gap = F.when(shifted, F.col("_gapb")).otherwise(F.col("_cand"))
    delta = d_us / F.lit(1e6)
    pv = F.when(prev_gap, F.lit(0.0)).otherwise(F.coalesce("_p1_value", F.lit(0.0)))
    P = F.when(shifted, F.col("_pb")).otherwise(F.col("_pa"))
    if spec.slots == "lt":
        n = F.expr(f"div(_d + {step_us - 1}, {step_us})")
    else:
        n = F.expr(f"div(_d, {step_us}) + 1")
    y = y.select(
        *K, stitch.BKT, "ts", "value", "_o", "_c0", "_skip",
        F.when(shifted, add_micros("_p1_ts", F.lit(shift_us))).otherwise(F.col("_p1_ts")).alias("_pt"),
        d_us.alias("_d"), delta.alias("_delta"),
        (is_reading & F.coalesce(gap, F.lit(False)) & ~F.col("_skip")).alias("_gap"),
        F.try_divide(F.coalesce(P, F.lit(0.0)), (delta * F.lit(1000.0)) / F.lit(float(spec.step_ms))).alias("_ai"),
        ((F.lit(spec.factor) * (delta / F.lit(3600.0)))
         * (clamp("value", spec.clamp) + clamp(pv, spec.clamp))).alias("_integral"))
    y = y.withColumn("_n", F.when(F.col("_gap"), n).otherwise(F.lit(0)).cast("bigint"))
    y = y.withColumn("_c", F.when(~is_reading, F.col("_c0"))
                     .when(F.col("_skip"), F.lit(0.0))
                     .when(F.col("_gap"), F.col("_n") * F.col("_ai"))
                     .otherwise(F.col("_integral")))
    y = keep(y)
    y = keep(stitch.running_sum(y, K, order, "_c", "_cum", many=many))
    skip = F.coalesce(F.col("_skip"), F.lit(False))
    ts = F.when(skip, add_micros("ts", F.lit(shift_us))).otherwise(F.col("ts"))
    state = final_state(y, K, keys, order, ts, F.col("_gap") | skip)
    return emit(y.filter(is_reading & ~skip), K, keys, spec, "_pt"), state
