"""Registered stream/sink query keys: each runs a real stream (availableNow)
or sink round trip over the fixture feed and returns the table it wrote."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from wattline import oracles as O, stepwise
from wattline.operators import integrate as integ
from wattline.queries import _export_all, _production_all, r6
from wattline.session import configure, scratch_path
from wattline.sources import fixtures as fx
from wattline.streaming import jobs, sinks, stream


MARKER_FILES = 5   # day files per micro-batch in the marker / run-log streams


def _dir(spark, name: str) -> str:
    return scratch_path(spark, f"stream/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:8]}")


def _feed(spark, sf, name: str, days=None) -> str:
    path = _dir(spark, f"{name}-feed")
    stream.write_day_files(fx.readings(spark, sf), path, days)
    return path


def stream_mirror(spark, sf):
    src, out = _feed(spark, sf, "mirror"), _dir(spark, "mirror-out")
    stream.mirror(spark, src, out, _dir(spark, "mirror-ckpt"))
    return r6(spark.read.parquet(out).select("id", "ts", "value"))


def stream_new_rows_only(spark, sf):
    r = fx.readings(spark, sf)
    days = [x[0] for x in r.select(F.to_date("ts")).distinct().orderBy(1).collect()]
    early = [d for d in days if str(d) < fx.SPLIT_DAY]
    late = [d for d in days if str(d) >= fx.SPLIT_DAY]
    src, out, ck = _dir(spark, "fresh-feed"), _dir(spark, "fresh-out"), _dir(spark, "fresh-ckpt")
    stream.write_day_files(r, src, early)
    stream.start_after_existing(spark, src, ck)
    stream.write_day_files(r, src, late)
    stream.run_available(stream.reading_stream(spark, src).select("id", "ts", "value"), ck,
                         foreach_batch=lambda df, i: sinks.write_batch_table(df, out, i))
    return r6(spark.read.parquet(out).select("id", "ts", "value"))


def _integration(spark, sf, name, spec, max_files, commit="day"):
    base = _dir(spark, name)
    job = jobs.IntegrationJob(name=name, spec=spec, ledger_path=f"{base}/ledger",
                              marker_path=f"{base}/marker", run_log_path=f"{base}/runs",
                              state_path=f"{base}/state", commit=commit)
    src = _feed(spark, sf, name)
    stream.run_available(stream.reading_stream(spark, src, max_files), f"{base}/ckpt",
                         foreach_batch=job)
    return job


def stream_integrate(spark, sf):
    p = fx.params(sf)
    job = _integration(spark, sf, "integrate", fx.export_spec(p), 1)
    return r6(spark.read.parquet(job.ledger_path).select(*integ.LEDGER_COLS))


def stream_integrate_nofill(spark, sf):
    p = fx.params(sf)
    # without gap fill the ledger does not depend on batch boundaries
    job = _integration(spark, sf, "integrate-nofill", fx.export_spec(p).with_(gap_fill=False), 6)
    return r6(spark.read.parquet(job.ledger_path).select(*integ.LEDGER_COLS))


def stream_integrate_days(spark, sf):
    p = fx.params(sf)
    job = _integration(spark, sf, "integrate-days", fx.export_spec(p), 3)
    return r6(spark.read.parquet(job.ledger_path).select(*integ.LEDGER_COLS))


def stream_marker(spark, sf):
    p = fx.params(sf)
    job = _integration(spark, sf, "marker", fx.export_spec(p).with_(gap_fill=False), MARKER_FILES)
    return spark.read.parquet(job.marker_path).select("first_ts", "last_ts", "row_count")


def run_history(spark, sf):
    p = fx.params(sf)
    job = _integration(spark, sf, "runs", fx.export_spec(p).with_(gap_fill=False), MARKER_FILES)
    return spark.read.parquet(job.run_log_path).select("name", "state", "error_message", "status")


def ledger_append(spark, sf):
    path = _dir(spark, "ledger-append")
    sinks.write_ledger(fx.whole_ledger(spark, sf), path)
    return r6(spark.read.parquet(path).select(*integ.LEDGER_COLS))


def _baseline(spark, sf):
    first_day = fx.readings(spark, sf).agg(F.min(F.to_date("ts")).alias("d"))
    return first_day.select(F.col("d").cast("timestamp_ntz").alias("ts"),
                            *[F.lit(0.0).alias(c) for c in ("cumulative_sum", "integral", "delta", "value")])


def ledger_baseline(spark, sf):
    """A ledger that starts with a base row (all zeros) at the first
    reading day's midnight; the readings are then integrated onto it."""
    path = _dir(spark, "ledger-baseline")
    sinks.write_ledger(_baseline(spark, sf), path)
    p = fx.params(sf)
    base = spark.read.parquet(path).select(*integ.LEDGER_COLS)
    rows = integ.integrate(fx.readings(spark, sf), base, fx.export_spec(p))
    sinks.write_ledger(rows, path)
    return r6(spark.read.parquet(path).select(*integ.LEDGER_COLS))


def summary_upsert_sink(spark, sf):
    path = _dir(spark, "summary")
    s = jobs.rollup.daily_summary(_export_all(spark, sf), _production_all(spark, sf))
    old = (s.filter(F.col("date") <= F.lit(fx.SUMMARY_OLD_LAST).cast("date"))
           .select("date", F.lit(0.0).alias("production_sum"), F.lit(0.0).alias("export_sum")))
    sinks.upsert_by_date(old, path)
    jobs.daily_summary_job(_export_all(spark, sf), _production_all(spark, sf), path,
                           fx.SUMMARY_NEW_FIRST, "2099-12-31")
    return r6(spark.read.parquet(path).select("date", "production_sum", "export_sum"))


def catalog():
    names = ["stream_mirror", "stream_new_rows_only", "stream_integrate", "stream_integrate_nofill",
             "stream_integrate_days", "stream_marker", "run_history", "ledger_append",
             "ledger_baseline", "summary_upsert_sink"]
    g = globals()

    def wrap(fn):
        def run(spark, sf_dir):
            configure(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        return run
    return {n: wrap(g[n]) for n in names}


def oracle_sql() -> dict[str, str]:
    q = {}
    D = {"value"}
    q["stream_mirror"] = O.r6(O.READINGS, ["id", "ts", "value"], D)
    q["stream_new_rows_only"] = O.r6(f"SELECT * FROM ({O.READINGS}) r WHERE CAST(ts AS DATE) >= DATE '{fx.SPLIT_DAY}'",
                                     ["id", "ts", "value"], D)
    q["stream_integrate_nofill"] = O.ledger_r6(O.integrate_sql(
        f"SELECT ts, value FROM ({O.READINGS}) r", None, fill=False, first_row="drop"))
    q["stream_integrate"] = stepwise.per_day_sql(1)
    q["stream_integrate_days"] = stepwise.per_day_sql(3)
    q["stream_marker"] = (
        "SELECT min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS row_count FROM "
        f"(SELECT ts, (dense_rank() OVER (ORDER BY CAST(ts AS DATE)) - 1) // {MARKER_FILES} AS b FROM events) e "
        "GROUP BY b")
    q["run_history"] = (
        "SELECT 'runs' AS name, 'SUCCEEDED' AS state, NULL::VARCHAR AS error_message, 'ok' AS status FROM "
        f"(SELECT DISTINCT (dense_rank() OVER (ORDER BY CAST(ts AS DATE)) - 1) // {MARKER_FILES} AS b FROM events) e")
    q["ledger_append"] = O.ledger_r6(O.WHOLE)
    base = ("SELECT CAST(min(CAST(ts AS DATE)) AS TIMESTAMP) AS ts, 0.0::DOUBLE AS cumulative_sum, "
            "0.0::DOUBLE AS integral, 0.0::DOUBLE AS delta, 0.0::DOUBLE AS value FROM events")
    q["ledger_baseline"] = O.ledger_r6(
        f"SELECT * FROM ({base}) b UNION ALL SELECT * FROM ({O.integrate_sql(f'SELECT ts, value FROM ({O.READINGS}) r', base, first_row='drop')}) i")
    q["summary_upsert_sink"] = O.oracle_sql()["daily_upsert"]
    return q
