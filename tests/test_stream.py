"""Streaming: stream result = batch result; replaying a batch id is a no-op."""

import uuid

import pytest
from pyspark.sql import functions as F

from wattline.operators import integrate as integ
from wattline.session import scratch_path
from wattline.sources import fixtures as fx
from wattline.streaming import jobs, stream

SF = "/root/testdata/sf0.001"


def _job(spark, name, spec):
    base = scratch_path(spark, f"test-{name}-{uuid.uuid4().hex[:6]}")
    return jobs.IntegrationJob(name=name, spec=spec, ledger_path=f"{base}/ledger",
                               marker_path=f"{base}/marker", run_log_path=f"{base}/runs",
                               state_path=f"{base}/state"), base


def test_stream_equals_batch_without_gap_fill(spark):
    p = fx.params(SF)
    spec = fx.export_spec(p).with_(gap_fill=False)
    job, base = _job(spark, "eq", spec)
    src = f"{base}/feed"
    r = fx.readings(spark, SF)
    stream.write_day_files(r, src)
    stream.run_available(stream.reading_stream(spark, src, 7), f"{base}/ckpt", foreach_batch=job)
    got = sorted((x.ts, round(x.cumulative_sum, 9)) for x in spark.read.parquet(job.ledger_path).collect())
    exp = sorted((x.ts, round(x.cumulative_sum, 9)) for x in integ.integrate(r, None, spec).collect())
    assert got == exp
    assert set(job.statuses) == {"ok"}


def test_replay_is_idempotent(spark):
    p = fx.params(SF)
    job, _ = _job(spark, "replay", fx.export_spec(p))
    r = fx.readings(spark, SF)
    d1 = r.filter(F.to_date("ts") <= F.lit("2024-01-03").cast("date"))
    d2 = r.filter(F.to_date("ts") == F.lit("2024-01-04").cast("date"))
    job(d1, 0)
    job(d2, 1)
    first = sorted(tuple(x) for x in spark.read.parquet(job.ledger_path).drop("batch_id").collect())
    job(d2, 1)   # the same micro-batch delivered again after a failure
    second = sorted(tuple(x) for x in spark.read.parquet(job.ledger_path).drop("batch_id").collect())
    assert first == second
    markers = spark.read.parquet(job.marker_path).collect()
    assert sorted(m.batch_id for m in markers) == [0, 1]


def test_no_new_data(spark):
    p = fx.params(SF)
    job, _ = _job(spark, "empty", fx.export_spec(p))
    empty = fx.readings(spark, SF).filter(F.lit(False))
    assert job(empty, 0) == "no new data"


def test_multi_day_batch_commits_every_day(spark):
    """T5: a batch spanning three days runs the per-day loop and writes
    ledger rows for each of its days under one batch id."""
    p = fx.params(SF)
    spec = fx.export_spec(p)
    r = fx.readings(spark, SF).filter(F.to_date("ts") <= F.lit("2024-01-03").cast("date"))
    a, _ = _job(spark, "multi", spec)
    assert a(r, 0) == "ok"
    led = spark.read.parquet(a.ledger_path)
    days = {x[0] for x in led.select(F.to_date("ts")).distinct().collect()}
    assert {d for d in days if str(d) <= "2024-01-03"} >= {
        x[0] for x in r.select(F.to_date("ts")).distinct().collect()} - {min(days)}
    assert {x.batch_id for x in led.select("batch_id").distinct().collect()} == {0}


def test_late_rows_dropped_and_counted(spark):
    p = fx.params(SF)
    base = scratch_path(spark, f"test-late-{uuid.uuid4().hex[:6]}")
    job = jobs.IntegrationJob(name="late", spec=fx.export_spec(p), ledger_path=f"{base}/ledger",
                              marker_path=f"{base}/marker", run_log_path=f"{base}/runs",
                              state_path=f"{base}/state", late="drop")
    r = fx.readings(spark, SF)
    newer = r.filter(F.to_date("ts") == F.lit("2024-01-05").cast("date"))
    older = r.filter(F.to_date("ts") == F.lit("2024-01-04").cast("date"))
    job(newer, 0)
    before = spark.read.parquet(job.ledger_path).count()
    job(older, 1)          # arrives after a newer batch: every row is late
    assert spark.read.parquet(job.ledger_path).count() == before
    m = {x.batch_id: x.late_dropped for x in spark.read.parquet(job.marker_path).collect()}
    assert m[1] == older.count() and m[0] == 0


# ---- the job against the plain fold -------------------------------------------------

SCHEMA = "series long, ts timestamp_ntz, value double"
STEP = integ.EXPORT.with_(cutoff=None, step_ms=30_000)


def _series_job(spark, spec, keys=("series",), commit="day", late="keep"):
    job, base = _job(spark, "fold", spec)
    job.keys, job.commit, job.late = list(keys), commit, late
    return job


def _rows(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _fold_days(rows, spec):
    """One series, one batch: the fold goes on from day to day, each day's
    profile sees the ledger rows of the days before."""
    import fold
    return fold.integrate_days(rows, spec)


def _check(spark, job, rows, spec):
    import math
    led = spark.read.parquet(job.ledger_path)
    for s in {r[0] for r in rows}:
        mine = led.filter(F.col("series") == s) if "series" in led.columns else led
        got = sorted((r.ts, r.cumulative_sum) for r in mine.collect())
        want = sorted((r[0], r[1]) for r in _fold_days([(t, v) for k, t, v in rows if k == s], spec))
        assert [g[0] for g in got] == [w[0] for w in want]
        assert all(math.isclose(g[1], w[1], rel_tol=1e-9, abs_tol=1e-9) for g, w in zip(got, want, strict=True))


def _t(day, h, m, s=0):
    from datetime import datetime
    return datetime(2024, 5, day, h, m, s)


def _three_days():
    one = [(1, _t(d, 10, m, s), -float(d + m)) for d in (1, 2, 3) for m in range(0, 20, 2) for s in (0, 30)]
    two = [(2, _t(d, 11, m), -1.0 - m) for d in (1, 3) for m in (0, 1, 2, 9)]
    return one + two


def test_series_silent_for_a_day_keeps_its_state(spark):
    rows = _three_days()
    job = _series_job(spark, STEP)
    assert job(_rows(spark, rows), 0) == "ok"
    _check(spark, job, rows, STEP)


@pytest.mark.parametrize("empty", ["zero", "skip"])
def test_skip_and_zero_over_days(spark, empty):
    rows = _three_days()
    spec = STEP.with_(empty_profile=empty, slots="le", first_row="synthetic")
    job = _series_job(spark, spec)
    assert job(_rows(spark, rows), 0) == "ok"
    _check(spark, job, rows, spec)


def test_first_day_of_one_reading(spark):
    """Under ``drop`` the first day emits nothing; the second goes on from it."""
    rows = [(1, _t(1, 23, 59, 50), -5.0), (1, _t(2, 0, 0, 10), -6.0), (1, _t(2, 0, 0, 30), -7.0)]
    job = _series_job(spark, STEP)
    assert job(_rows(spark, rows), 0) == "ok"
    _check(spark, job, rows, STEP)


def test_first_batch_of_one_reading(spark):
    rows = [(1, _t(1, 10, 0), -5.0), (1, _t(1, 10, 0, 20), -6.0), (1, _t(1, 10, 0, 50), -7.0)]
    for keys in (("series",), ()):
        job = _series_job(spark, STEP, keys)
        assert job(_rows(spark, rows[:1]), 0) == "ok"
        assert job(_rows(spark, rows[1:]), 1) == "ok"
        _check(spark, job, rows, STEP)


def test_duplicate_first_timestamp_drops_one_reading(spark):
    rows = [(1, _t(1, 10, 0), -1.0), (1, _t(1, 10, 0), -2.0), (1, _t(1, 10, 0), -2.0), (1, _t(1, 10, 0, 30), -3.0)]
    for spec in (STEP, STEP.with_(empty_profile="skip")):
        job = _series_job(spark, spec)
        job(_rows(spark, rows), 0)
        _check(spark, job, rows, spec)


def test_failed_run_stays_in_the_log(spark):
    job = _series_job(spark, STEP)
    good = _rows(spark, _three_days())
    bad = good.withColumn("value", F.raise_error(F.lit("x" * 3000)).cast("double"))
    with pytest.raises(Exception):
        job(bad, 0)
    assert job(good, 0) == "ok"
    log = spark.read.parquet(job.run_log_path).orderBy("scheduled_time").collect()
    assert [r.state for r in log] == ["FAILED", "SUCCEEDED"] and len({r.attempt for r in log}) == 2
    assert "x" * 3000 in log[0].error_message


def test_old_states_are_retired(spark):
    import os
    job = _series_job(spark, STEP)
    for i, d in enumerate((1, 2, 3)):
        job(_rows(spark, [r for r in _three_days() if r[1].day == d]), i)
    left = sorted(x for x in os.listdir(job.state_path.removeprefix("file://")) if x.startswith("batch_id="))
    assert left == ["batch_id=1", "batch_id=2"]


def test_daily_job_says_what_is_missing(spark):
    base = scratch_path(spark, f"test-day-{uuid.uuid4().hex[:6]}")
    led = spark.createDataFrame([(_t(1, 10, 0), 1.0), (_t(1, 11, 0), 3.0), (_t(2, 10, 0), 4.0)], "ts timestamp_ntz, cumulative_sum double") \
        .withColumn("day", F.to_date("ts"))
    led.write.partitionBy("day").parquet(f"{base}/led")
    led = spark.read.parquet(f"{base}/led")
    first = led.filter(F.col("day") == F.lit("2024-05-01").cast("date"))
    assert jobs.day_summary_job(led, first, f"{base}/sum", "2024-05-01") == "ok"
    assert jobs.day_summary_job(led, first, f"{base}/sum", "2024-05-02") == "No production data for the day"
    assert jobs.day_summary_job(first, led, f"{base}/sum", "2024-05-02") == "No export data for the day"
    assert jobs.day_summary_job(led, led, f"{base}/sum", "2024-05-03") == "No export data for the day"
    assert [(str(r.date), r.export_sum) for r in spark.read.parquet(f"{base}/sum").collect()] == [("2024-05-01", 2.0)]
    day = F.lit("2024-05-01").cast("date")
    plan = jobs.of_days(led, day, day)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_yesterday_depends_on_the_zone(spark):
    from datetime import datetime, timedelta, timezone
    for hours in (-12, 0, 14):
        zone = "UTC" if not hours else f"{'+' if hours > 0 else '-'}{abs(hours):02d}:00"
        want = (datetime.now(timezone.utc) + timedelta(hours=hours) - timedelta(days=1)).date()
        assert jobs.yesterday(spark, zone) == str(want)


def test_session_settings_stay_as_they_are(spark):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    job = _series_job(spark, STEP)
    job(_rows(spark, _three_days()), 0)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


@pytest.mark.parametrize("keys", [(), ("series",)])
def test_batch_without_gaps_is_kept_once(spark, monkeypatch, keys):
    """Its ledger rows are columns of the kept scan; a series that goes on from a known row has no reading to skip."""
    rows = [(1, _t(d, 10, m, s), float(m - 5) * d) for d in (1, 2) for m in range(10) for s in (0, 30)]
    spec = STEP.with_(step_ms=24 * 3600 * 1000)          # the night is no gap
    job = _series_job(spark, spec, keys)
    files = scratch_path(spark, f"test-kept-{uuid.uuid4().hex[:6]}")
    for d in (0, 1):
        _rows(spark, rows[20 * d:20 * d + 20]).coalesce(1).write.parquet(f"{files}/{d}")
    days = [spark.read.schema(SCHEMA).parquet(f"{files}/{d}") for d in (0, 1)]       # small, as their files tell
    assert job(days[0], 0) == "ok"
    frame, kept = type(days[0]), []
    persist = frame.persist
    monkeypatch.setattr(frame, "persist", lambda df, *a: (kept.append(df), persist(df, *a))[1])
    assert job(days[1], 1) == "ok"
    assert len(kept) == 1
    assert not {"_p1_ts", "_delta", "_pending", "_rn", "_last", "_tail"} & set(kept[0].columns)
    if not keys:
        assert kept[0]._jdf.queryExecution().optimizedPlan().toString().count("Window [") == 2
    _check(spark, job, rows, spec)
