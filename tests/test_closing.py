"""Sinks that change what is written: closing of days, MERGE by key, the feed, the profile table, state as changes."""

import os
import random
import uuid
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

import fold
from wattline.operators import dayprofile, integrate as integ, profile
from wattline.plans import stitch
from wattline.session import scratch_path
from wattline.streaming import jobs, sinks, stream

STEP = integ.EXPORT.with_(cutoff=None, step_ms=30_000)


def base(spark, name):
    return scratch_path(spark, f"test-{name}-{uuid.uuid4().hex[:6]}")


def files(path):
    return sorted(os.path.relpath(os.path.join(d, f), path) for d, _, names in os.walk(path.removeprefix("file://")) for f in names if f.endswith(".parquet"))


def ledger(spark, day, minutes, value):
    rows = [(datetime(2024, 5, day, 10, m), float(value), 0.0, 60.0, 0.0) for m in minutes]
    return spark.createDataFrame(rows, "ts timestamp_ntz, cumulative_sum double, integral double, delta double, value double")


def test_closed_days(spark):
    path, schema = base(spark, "close"), sinks.ledger_schema()

    def content():
        return sorted(map(tuple, sinks.read_ledger(spark, path, schema=schema).collect()))
    for b in range(12):
        sinks.write_ledger(ledger(spark, 1 + b // 6, [b % 6 * 3, b % 6 * 3 + 1], b), path, b)
    before = content()
    listed = spark.read.schema(schema).parquet(path)               # a reader that came before
    assert sinks.close_days(spark, path, schema, "2024-05-02") == ["2024-05-01"]
    assert content() == before and listed.count() == 24
    assert len(files(sinks.closed_path(path))) == 1
    sinks.write_ledger(ledger(spark, 2, [40], 99), path, 12)        # the open day goes on
    sinks.write_ledger(ledger(spark, 1, [41], 98), path, 13)        # a batch that came too late for its day
    sinks.write_ledger(ledger(spark, 2, [40], 99), path, 12)        # a replay
    after = content()
    assert len(after) == 26 and set(before) < set(after)
    assert sinks.close_days(spark, path, schema, "2024-05-02") == ["2024-05-01"]
    assert content() == after and len(files(sinks.closed_path(path))) == 1
    assert [f for f in files(path) if "day=2024-05-01" in f] == [f for f in files(path) if "day=2024-05-01/batch_id=13" in f]
    assert sinks.close_days(spark, path, schema, "2024-05-03") == ["2024-05-02"]
    assert sinks.close_days(spark, path, schema, "2024-05-03") == []
    assert content() == after and not files(path) and len(files(sinks.closed_path(path))) == 2


def test_merge_by_key(spark):
    path = base(spark, "merge")

    def rows(*r):
        return spark.createDataFrame([(date(2024, 5, d), k, v) for d, k, v in r], "date date, series long, v double")

    def content():
        return sorted((r.date.day, r.series, r.v) for r in spark.read.schema(rows((1, 1, 1.0)).schema).parquet(path).collect())
    sinks.upsert_by_key(rows((1, 1, 1.0), (1, 2, 2.0), (2, 1, 3.0)), path, ["date", "series"])
    untouched = [f for f in files(path) if "2024-05-01" in f]
    for _ in range(2):
        sinks.upsert_by_key(rows((2, 1, 9.0), (2, 7, 5.0), (3, None, 6.0)), path, ["date", "series"])
        assert content() == [(1, 1, 1.0), (1, 2, 2.0), (2, 1, 9.0), (2, 7, 5.0), (3, None, 6.0)]
    assert [f for f in files(path) if "2024-05-01" in f] == untouched
    with pytest.raises(ValueError):
        sinks.upsert_by_key(rows((4, 1, 1.0), (4, 1, 2.0)), path, ["date", "series"])


def feed_days(spark, src, **how):
    seen = []
    stream.run_available(stream.reading_stream(spark, src, **how), f"{src}-ckpt-{uuid.uuid4().hex[:4]}",
                         foreach_batch=lambda df, i: seen.append(sorted(r.day.day for r in df.select("day").distinct().collect())))
    return seen


def test_feed_in_time_order(spark):
    """One job writes the feed; batches see its days in order, by files or by bytes, and later days after earlier ones."""
    src = base(spark, "feed")
    r = spark.range(9_000).selectExpr("id", "timestampadd(SECOND, (id * 7919) % 9000 * 86, TIMESTAMP_NTZ'2024-05-01 00:00:00') AS ts",
                                      "CAST(id AS DOUBLE) AS value").repartition(4)
    stream.write_day_files(r, src, [date(2024, 5, d) for d in (1, 2, 3, 4)])
    assert len(files(src)) == 4
    stream.write_day_files(r, src, [date(2024, 5, d) for d in (5, 6)])
    assert feed_days(spark, src, max_files=1) == [[1], [2], [3], [4], [5], [6]]
    assert feed_days(spark, src, max_files=4) == [[1, 2, 3, 4], [5, 6]]
    by_bytes = feed_days(spark, src, max_bytes="1")
    assert [d for b in by_bytes for d in b] == [1, 2, 3, 4, 5, 6] and len(by_bytes) == 6


def series_rows(seed, days, n):
    rng, out = random.Random(seed), []
    for d in range(days):
        t = datetime(2024, 5, 1 + d, 8)
        for _ in range(n):
            t += timedelta(seconds=rng.choice([10, 20, 30, 55, 70, 200, 900]))
            out.append((t, -rng.uniform(0, 9)))
    return out


def job_of(spark, name, **how):
    b = base(spark, name)
    return jobs.IntegrationJob(name=name, spec=how.pop("spec", STEP), ledger_path=f"{b}/ledger", marker_path=f"{b}/marker",
                               run_log_path=f"{b}/runs", state_path=f"{b}/state", **how)


def test_profile_table_equals_its_rebuild_and_the_ledger_is_not_read(spark, monkeypatch):
    job = job_of(spark, "points", compact_every=2)
    rows = series_rows(4, 3, 60)
    df = spark.createDataFrame(rows, "ts timestamp_ntz, value double")
    read = []
    real = sinks.read_ledger
    monkeypatch.setattr(sinks, "read_ledger", lambda s, path, *a, **k: (read.append(path), real(s, path, *a, **k))[1])
    for i, d in enumerate((1, 2, 3)):
        job(df.filter(F.dayofmonth("ts") == d), i)
    job(df.filter(F.dayofmonth("ts") == 3), 2)                      # a replay
    assert sinks.folders(spark, job.profile_path) == ["batch_id=-1", "batch_id=1", "batch_id=2"]
    assert read.count(job.ledger_path) == 1                         # the first batch looks whether there is one

    def flat(points):
        return sorted((r.day, p.t, p.c) for r in points.collect() for p in r.points)
    led = real(spark, job.ledger_path, schema=sinks.ledger_schema())
    assert flat(real(spark, job.profile_path, schema=dayprofile.schema())) == flat(dayprofile.points_of(led))
    bands = spark.createDataFrame([(28_800_000_000 + i * 97_000_000, 28_800_000_000 + i * 97_000_000 + 400_000_000 * (i % 9)) for i in range(40)],
                                  "a long, b long")
    points = dayprofile.points_of(led).withColumn("_series", F.lit(0))
    few = {(r.a, r.b): (r.days, round(r.profile, 9)) for r in dayprofile.mean_energy(points, bands.withColumn("_series", F.lit(0)), ["_series"], True).collect()}
    assert few == {(r.a, r.b): (r.days, round(r.profile, 9)) for r in profile.band_profile(bands, led).collect()} and few


def test_waves_follow_dependencies_not_days(spark):
    """Days whose gaps meet no fill of an earlier day are settled together."""
    def day(d, hour):
        t = [datetime(2024, 5, d, hour, m) for m in range(4)]
        return [(x + timedelta(seconds=s), -1.0 - d) for x in t for s in (0, 30)] + [(datetime(2024, 5, d, hour, 20), -2.0)]
    apart = [r for d in range(1, 7) for r in day(d, 2 + 3 * d)]
    alike = [r for d in range(1, 5) for r in day(d, 9)]
    waves = {}
    for name, rows in (("apart", apart), ("alike", alike)):
        job = job_of(spark, name)
        job(spark.createDataFrame(rows, "ts timestamp_ntz, value double"), 0)
        got = sorted((r.ts, round(r.cumulative_sum, 9)) for r in spark.read.parquet(job.ledger_path).collect())
        assert got == sorted((r[0], round(r[1], 9)) for r in fold.integrate_days(rows, STEP))
        waves[name] = job.waves
    assert waves["apart"] <= 2


def test_state_as_changes(spark):
    """Batches write the series they saw; a restart goes on from the last full copy and the changes since."""
    rows = {k: series_rows(k, 6, 8) for k in range(5)}
    how = {"keys": ["series"], "full_every": 3, "full_rows": 0, "spec": STEP.with_(gap_fill=False)}
    job = job_of(spark, "changes", **how)
    sizes = []
    for i in range(6):
        seen = [0, 1 + i % 4]
        batch = [(k, t, v) for k in seen for t, v in rows[k] if t.day == 1 + i]
        if i == 4:                                                  # a new process
            job = jobs.IntegrationJob(name="changes", ledger_path=job.ledger_path, marker_path=job.marker_path,
                                      run_log_path=job.run_log_path, state_path=job.state_path, **how)
        job(spark.createDataFrame(batch, "series long, ts timestamp_ntz, value double"), i)
        sizes.append(spark.read.parquet(f"{job.state_path}/batch_id={i}").count())
    assert sizes[1] == 2 and min(sizes[1:]) == 2 and max(sizes) > 2
    led = spark.read.parquet(job.ledger_path)
    for k in range(5):
        mine = [r for i in range(6) if k == 0 or k == 1 + i % 4 for r in rows[k] if r[0].day == 1 + i]
        want = sorted((r[0], round(r[1], 9)) for r in fold.integrate(mine, [], how["spec"]))
        assert sorted((r.ts, round(r.cumulative_sum, 9)) for r in led.filter(F.col("series") == k).collect()) == want


@pytest.mark.parametrize("empty,days,small", [("zero", 1, True), ("zero", 3, True), ("skip", 1, True), ("skip", 3, True),
                                              ("zero", 1, False), ("zero", 3, False)])
def test_batches_against_the_fold(spark, empty, days, small, monkeypatch):
    """Gap-filled batches of one and of three days against the sequential fold, state and profile going along; by
    the short plan and, cut into buckets of 20 rows, by the one for large batches."""
    if not small:
        monkeypatch.setattr(jobs, "SMALL_BYTES", -1)
        monkeypatch.setattr(jobs, "SMALL_SLOTS", 5)
        monkeypatch.setattr(stitch, "ROWS", 20)
    spec = STEP.with_(empty_profile=empty, slots="le" if empty == "skip" else "lt")
    rows = series_rows(11, 3, 25)
    job = job_of(spark, "fold", spec=spec)
    if days == 3:
        job(spark.createDataFrame(rows, "ts timestamp_ntz, value double"), 0)
        want = fold.integrate_days(rows, spec)
    else:
        want = []
        for d in range(3):
            batch = [r for r in rows if r[0].day == 1 + d]
            job(spark.createDataFrame(batch, "ts timestamp_ntz, value double"), d)
            want += fold.integrate(batch, want, spec)
    got = sorted((r.ts, r.cumulative_sum) for r in spark.read.parquet(job.ledger_path).collect())
    want = sorted((r[0], r[1]) for r in want)
    assert [g[0] for g in got] == [w[0] for w in want]
    assert [g[1] for g in got] == pytest.approx([w[1] for w in want], rel=1e-9, abs=1e-9)
