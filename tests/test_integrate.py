"""Integrator vs the plain-Python fold on small random series."""

import random
from datetime import datetime, timedelta

import pytest

import fold
from wattline.operators import integrate as integ

T0 = datetime(2024, 3, 1, 23, 0, 0)


def series(rng, n, step_s, with_nulls=True):
    t, out = T0 + timedelta(seconds=rng.randint(0, 5000)), []
    for _ in range(n):
        r = rng.random()
        if r < 0.15:
            t += timedelta(seconds=step_s * rng.uniform(2.1, 9))      # gap
        elif r < 0.18:
            t += timedelta(seconds=step_s * 2)                         # exact multiple
        elif r < 0.2:
            t += timedelta(hours=rng.uniform(3, 30))                   # long / midnight gap
        else:
            t += timedelta(seconds=step_s * rng.uniform(0.3, 1.9))
        t = t.replace(microsecond=rng.choice([0, rng.randint(0, 999_999)]))
        v = None if (with_nulls and rng.random() < 0.05) else round(rng.uniform(-10, 10), 3)
        out.append((t, v))
    return out


def ledger_from(rng, spec, n):
    rows = series(rng, n, spec.step_ms / 1000, with_nulls=False)
    return fold.integrate([(t - timedelta(days=2), v) for t, v in rows], [],
                          spec.with_(gap_fill=False))


def check(spark, rows, ledger, spec, sizes=(None, 9)):
    """In one bucket, and cut into buckets of about nine rows."""
    from pyspark.sql import types as T
    rs = T.StructType([T.StructField("ts", T.TimestampNTZType()), T.StructField("value", T.DoubleType())])
    ls = "ts timestamp_ntz, cumulative_sum double, integral double, delta double, value double"
    rdf = spark.createDataFrame(rows, rs)
    ldf = spark.createDataFrame(ledger, ls) if ledger else None
    exp = sorted(fold.integrate(rows, ledger, spec))
    for size in sizes:
        got = sorted(tuple(r) for r in integ.integrate(rdf, ldf, spec, rows=size).collect())
        assert len(got) == len(exp)
        for g, e in zip(got, exp):
            assert g[0] == e[0]
            for a, b in zip(g[1:], e[1:]):
                assert a == pytest.approx(b, rel=1e-9, abs=1e-9)


SPECS = {
    "export": integ.EXPORT.with_(cutoff=None, step_ms=30_000),
    "production": integ.PRODUCTION.with_(cutoff=None, step_ms=30_000),
    "legacy": integ.LEGACY,
    "le_slots": integ.EXPORT.with_(cutoff=None, step_ms=30_000, slots="le"),
}


@pytest.mark.parametrize("name", sorted(SPECS))
@pytest.mark.parametrize("seed", [1, 2])
def test_against_fold(spark, name, seed):
    rng = random.Random(seed * 100 + len(name))
    spec = SPECS[name]
    rows = series(rng, 120, spec.step_ms / 1000)
    ledger = ledger_from(rng, spec, 300) if seed % 2 == 0 else []
    check(spark, rows, ledger, spec)


def test_keyed_equals_per_series(spark):
    rng = random.Random(7)
    spec = SPECS["export"]
    data = {k: series(rng, 60, 30) for k in range(3)}
    rows = [(k, t, v) for k, s in data.items() for t, v in s]
    df = spark.createDataFrame(rows, "series long, ts timestamp_ntz, value double")
    got = integ.integrate(df, None, spec, keys=["series"]).collect()
    for k, s in data.items():
        mine = sorted((r.ts, r.cumulative_sum) for r in got if r.series == k)
        exp = sorted((e[0], e[1]) for e in fold.integrate(s, [], spec))
        assert [m[0] for m in mine] == [e[0] for e in exp]
        assert [m[1] for m in mine] == pytest.approx([e[1] for e in exp], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("policy", ["skip", "zero"])
def test_seeded_scenario(spark, policy):
    """Counter ledger on three days 10:43-11:43 at 1 s with a fixed band
    increment, then one day of readings with the same half hour missing.
    Under 'skip' the first reading's gap wraps midnight (no profile), so the
    next reading gets a negative interval; the 30-minute hole is filled."""
    from pyspark.sql import functions as F
    spec = integ.FIRST_GAP.with_(empty_profile=policy)
    days = [datetime(2025, 11, d) for d in (1, 2, 3)]
    ledger, cum = [], 0.0
    for d in days:
        t = d.replace(hour=10, minute=43)
        while t <= d.replace(hour=11, minute=43):
            inc = 0.0002 if d.replace(hour=11) <= t <= d.replace(hour=11, minute=30) else 0.001
            cum += inc
            ledger.append((t, cum, inc, 1.0, 0.0))
            t += timedelta(seconds=1)
    assert len(ledger) == 10_803
    rows, t = [], datetime(2025, 11, 4, 10, 43)
    while t <= datetime(2025, 11, 4, 11, 43):
        tt = t.time()
        if tt < datetime(2025, 11, 4, 11).time() or tt > datetime(2025, 11, 4, 11, 30).time():
            rows.append((t, -1.0))
        t += timedelta(seconds=1)
    assert len(rows) == 1_800
    exp = fold.integrate(rows, ledger, spec)
    if policy == "skip":
        assert exp[0][3] == -59.0                  # reading after the skipped gap
        assert sum(1 for e in exp if e[4] == 0.0 and e[3] == 1.0) == 1_803   # filled hole
    check(spark, rows, ledger, spec, (None, 200))
    _ = F


@pytest.mark.parametrize("seed", [3, 4, 5])
def test_skip_policy_against_fold(spark, seed):
    rng = random.Random(seed)
    spec = integ.FIRST_GAP.with_(step_ms=30_000)
    rows = series(rng, 150, 30)
    ledger = ledger_from(rng, spec, 400) if seed != 5 else []
    check(spark, rows, ledger, spec)


def test_large_fill_spread_over_tasks(spark, monkeypatch):
    """Fill slots cut into small chunks and spread over tasks give the same
    ledger."""
    monkeypatch.setattr(integ, "SLOT_CHUNK", 7)
    rng = random.Random(21)
    spec = SPECS["export"]
    rows = series(rng, 80, 30)
    check(spark, rows, ledger_from(rng, spec, 200), spec)
