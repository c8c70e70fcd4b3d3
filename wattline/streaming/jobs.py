"""Status-returning jobs whose bodies are DataFrame code (§2.12).

``IntegrationJob`` is the ``foreachBatch`` handler of the incremental
integration (T1): new readings + carry-in state -> ledger rows, a marker
row (S8) and a run-log row (T10) per micro-batch.
"""

from __future__ import annotations

import traceback
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.functions.timefns import day_of
from wattline.operators import dayprofile, integrate as integ, rollup, skipfill
from wattline.plans.materialize import cut
from wattline.streaming import sinks


#: A batch whose files take at most so many bytes is integrated by the short plan.
SMALL_BYTES = 64 << 20
#: Bands that may be broadcast, and slots that are generated where their gap is, after counting them.
SMALL_BANDS, SMALL_SLOTS = 100_000, 1_000_000
#: Energies of two waves that differ by less (of the larger) are one.
SAME = 1e-12


class _Batch:
    """The integration of one micro-batch: its scan, its profiles and, for several days, its waves."""

    def __init__(self, job: IntegrationJob, rows: DataFrame, state: DataFrame | tuple | None, points: DataFrame | None, small: bool, keep):
        self.spec, self.keys, self.late = job.spec, list(job.keys), job.late
        self.K = self.keys or [integ.SERIES]
        self.rows, self.state, self.small, self.keep, self.waves = rows, state, small, keep, 1
        self.points = points if points is None or self.keys else points.withColumn(integ.SERIES, F.lit(0))
        self.skip = self.spec.gap_fill and self.spec.empty_profile == "skip"
        # one job brings the scan and what the batch has to know of it
        self.state = state = state[:3] if isinstance(state, tuple) else state
        self.scan = integ.scan(rows, self.spec, self.keys, state, self.late, keep=keep, small_batch=small)
        self.last = None
        counts = [F.count(F.lit(1)).alias("row_count"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")]
        gap = F.col("_gap")
        seen = rows.agg(*counts)
        if self.spec.gap_fill:
            seen = seen.crossJoin(self.scan.rows.agg(                         # a row each
                F.sum(gap.cast("int")).alias("gaps"), F.sum(integ.n_slots(self.spec)).alias("slots")))
        self.seen = seen.first()
        self.n_gaps, self.spread = 0, False
        if self.spec.gap_fill:
            self.n_gaps, self.spread = self.seen["gaps"] or 0, (self.seen["slots"] or 0) > SMALL_SLOTS
        days = self.seen["row_count"] and self.seen["first_ts"].date() != self.seen["last_ts"].date()
        # day by day only matters when a gap profile could see earlier days of this
        # batch; without gaps one pass is identical
        self.by_day = bool(job.commit == "day" and self.spec.gap_fill and days)

    @property
    def as_kept(self) -> bool:
        """Whether the ledger rows are columns of the kept scan, which are not kept again."""
        return self.scan.kept and not self.scan.many and not self.n_gaps and not self.skip

    def after(self) -> DataFrame:
        """State of the series that emitted nothing, where their readings left them."""
        if self.skip and self.last is not None:
            return self.last
        return integ.scan_state(self.scan.rows, self.K).select(*self.keys, "s_ts", "s_value", "s_cum")

    def attempt(self, profile) -> DataFrame:
        """Ledger rows with ``_rts`` under a profile of the gaps."""
        if self.skip:
            out, self.last = skipfill.integrate_skip(self.rows, None, self.spec, self.keys, self.state, None, self.late,
                                                     keep=self.keep, profile=profile, small_batch=self.small)
            return out
        found = self.scan
        if not found.many and not self.n_gaps:        # nothing is pending
            return integ.Integrated(found.rows, None, None, 0, self.K, self.keys, self.spec).ledger(extra=True)
        if not found.many and not self.spread and profile is not None:
            return integ.short(found, profile, self.n_gaps)
        n = self.n_gaps if not found.many else None
        return integ.completed(found, profile, self.keep, n).ledger(extra=True, spread=self.spread)

    def mean(self, bands: DataFrame, own: DataFrame | None = None) -> DataFrame:
        """Profiles of bands from committed points and those of the batch's own earlier days."""
        on = [*self.K, "a", "b", *(["gday"] if self.by_day else [])]
        cols = [*self.K, "day", "cell", "points"]
        every = None if self.points is None else self.points.select(*cols, F.lit(None).cast("date").alias("rday"))
        if own is not None:
            every = own.select(*cols, "rday") if every is None else every.unionByName(own.select(*cols, "rday"))
        if every is None:
            return bands.select(*on, F.lit(None).cast("double").alias("profile")).filter("false")
        if not self.by_day:
            every = every.drop("rday")
        # under skip a gap asks for two bands
        return dayprofile.mean_energy(every, bands.select(*on), self.K, 2 * self.n_gaps <= SMALL_BANDS).select(*on, "profile")

    def ledger(self) -> DataFrame:
        """Ledger rows with ``_rts``."""
        if not self.spec.gap_fill or not self.n_gaps and not self.skip or self.points is None and not self.by_day:
            return self.attempt(None)
        if not self.by_day:
            return self.attempt(self.mean)
        asked: list[DataFrame] = []

        def first(bands: DataFrame) -> DataFrame:
            asked.append(self.keep(bands.distinct()))
            asked.append(self.keep(self.mean(asked[0])))
            return asked[1]

        out, settled = self.attempt(first), None
        if not asked:
            return out
        bands, used = asked
        on = [*self.K, "a", "b", "gday"]
        while True:
            out = self.keep(out)
            own = out if self.keys else out.withColumn(integ.SERIES, F.lit(0))
            own = dayprofile.points_of(own.withColumn("_rday", day_of("_rts")), self.K, rday="_rday")
            due = bands if settled is None else bands.filter(F.col("gday") > F.lit(settled))
            again = self.keep(self.mean(due, own))
            pairs = due.select(*on).join(used.withColumnRenamed("profile", "_old"), on, "left").join(again, on, "left")
            p, q = F.col("profile"), F.col("_old")
            differs = (p.isNull() != q.isNull()) | (F.abs(p - q) > SAME * F.greatest(F.abs(p), F.abs(q)))
            changed = pairs.filter(differs).agg(F.min("gday")).first()[0]
            if changed is None:
                return out
            used = self.keep(again if settled is None else used.filter(F.col("gday") <= F.lit(settled)).unionByName(again))
            settled, self.waves = changed, self.waves + 1
            out = self.attempt(lambda _, used=used: used)


@dataclass
class IntegrationJob:
    """Incremental integration of a reading stream into a ledger.

    A batch reads its own rows, the state of its series and the per-day profile table
    (``profile_path``, whose batch folders are put together every ``compact_every`` batches), never the ledger. A small batch, which one aggregate tells, is
    one scan without bucket summaries, kept in executor memory while the batch runs.

    ``commit='day'`` gives the rows of the reference's per-day commits: a gap's profile
    sees the committed rows and those of the batch's earlier days. All days are
    integrated at once, in waves: the first takes profiles from committed rows alone;
    then profiles are taken again from what the wave before emitted, of the days after
    the first day that changed, until none changes. A wave settles all days up to the next one
    whose bands meet a fill that was not right yet, so days that do not depend on each other take two.
    ``commit='batch'`` takes profiles from the committed rows only. ``late='drop'``
    discards rows not newer than the carried state.
    """
    name: str
    spec: integ.Spec
    ledger_path: str
    marker_path: str
    run_log_path: str
    state_path: str
    keys: Sequence[str] = ()
    commit: str = "day"
    late: str = "keep"
    statuses: list = field(default_factory=list)
    profile_path: str = ""
    full_every: int = 16
    full_rows: int = 10_000
    compact_every: int = 64
    waves: int = 0
    _held: dict = field(default_factory=dict, repr=False)

    def __post_init__(self):
        self.profile_path = self.profile_path or f"{self.ledger_path.rstrip('/')}_profile"

    # ---- state (T4): changed series by batch, a full copy now and then -------------------

    def _state_schema(self, rows: DataFrame) -> T.StructType:
        keys = [rows.schema[k] for k in self.keys]
        return T.StructType([*keys, T.StructField("s_ts", T.TimestampNTZType()), T.StructField("s_value", T.DoubleType()),
                             T.StructField("s_cum", T.DoubleType()), T.StructField("s_led", T.IntegerType()),
                             T.StructField("whole", T.BooleanType()), T.StructField("batch_id", T.LongType())])

    @staticmethod
    def _state_row(spark, row: tuple) -> DataFrame:
        ts, value, cum, led = row
        return spark.range(1).select(F.lit(ts).cast("timestamp_ntz").alias("s_ts"), F.lit(value).cast("double").alias("s_value"),
                                     F.lit(cum).cast("double").alias("s_cum"), F.lit(led).cast("int").alias("s_led"))

    def _state_ids(self, spark) -> list[int]:
        """Batches with a state; as many as lie between two full copies, about twice."""
        return sorted(int(f.removeprefix("batch_id=")) for f in sinks.folders(spark, self.state_path) if f.startswith("batch_id="))

    def state_before(self, rows: DataFrame, batch_id: int) -> DataFrame | None:
        """State of every series after the newest earlier batch: the newest row of each
        since the last full copy before it."""
        spark = rows.sparkSession
        ids = [b for b in self._state_ids(spark) if b < batch_id]
        if not ids:
            return None
        st = spark.read.schema(self._state_schema(rows)).parquet(self.state_path).filter(F.col("batch_id") <= ids[-1])
        start = st.filter(F.col("whole")).agg(F.max("batch_id")).first()[0]
        st = st.filter(F.col("batch_id") >= (start if start is not None else ids[0]))
        cols = ["s_ts", "s_value", "s_cum", "s_led"]
        if start == ids[-1]:
            return st.select(*self.keys, *cols)
        newest = st.groupBy(*self.keys).agg(F.max_by(F.struct(*cols), "batch_id").alias("_s"))
        return newest.select(*self.keys, *[F.col("_s")[c].alias(c) for c in cols])

    def _write_state(self, newest: DataFrame, before: DataFrame | None, after: DataFrame, rows: DataFrame, batch_id: int) -> None:
        """The next batch goes on from the newest ledger row of a series (it may be a fill slot past the last
        reading). A series without a ledger row goes on from ``after``, where its readings left it.

        Only series of this batch are written, or all of them: every ``full_every`` batches, and
        while they are few, as a single series is."""
        pick, cols = F.struct("s_led", "s_ts", "s_cum"), ("s_ts", "s_value", "s_cum", "s_led")
        parts = [newest.withColumn("s_led", F.lit(1)), after.select(*self.keys, *cols[:3]).withColumn("s_led", F.lit(0))]
        if before is not None:
            parts.append(before.select(*self.keys, *cols).filter(F.col("s_led") == 1))
        new = reduce(DataFrame.unionByName, parts).filter(F.col("s_ts").isNotNull())
        new = new.groupBy(*self.keys).agg(*[F.max_by(c, pick).alias(c) for c in cols])
        since = self._held.get("since", self.full_every) + 1
        whole = before is None or since >= self.full_every or self._held.get("series", 0) <= self.full_rows
        seen = after.select(*self.keys)
        if whole and before is not None:
            silent = before.join(seen, list(self.keys), "left_anti").select(*self.keys, *cols)
            new = new.join(seen, list(self.keys), "left_semi").unionByName(silent)
        elif not whole:
            new = new.join(seen, list(self.keys), "left_semi")
        sinks.write_batch_table(new.withColumn("whole", F.lit(whole)), self.state_path, batch_id)
        series = rows.sparkSession.read.schema(T.StructType(self._state_schema(rows).fields[:-1])).parquet(f"{self.state_path}/batch_id={batch_id}").count() \
            if whole else self._held.get("series", 0)                       # from the footers
        self._held = {"since": 0 if whole else since, "series": series,
                      "whole": [*self._wholes(rows, batch_id), *([batch_id] if whole else [])], "ids": self._ids(rows, batch_id)}
        self._retire_states(rows.sparkSession, batch_id)

    def _write_one_state(self, newest, before: tuple | None, run: _Batch, rows: DataFrame, batch_id: int) -> None:
        """As _write_state for a table of one series: its state is a row that the batch's own jobs have brought along."""
        found = [(1, before[0], before[2], before[1])] if before is not None and before[3] == 1 and before[0] is not None else []
        if newest is not None and newest["ts"] is not None:
            found.append((1, newest["ts"], newest["cumulative_sum"], newest["value"]))
        if not found:
            left = run.after().first()
            if left is None or left["s_ts"] is None:
                return
            found = [(0, left["s_ts"], left["s_cum"], left["s_value"])]
        led, ts, cum, value = max(found)
        row = (ts, value, cum, led)
        spark = rows.sparkSession
        sinks.write_batch_table(self._state_row(spark, row).withColumn("whole", F.lit(True)), self.state_path, batch_id, single=True)
        ids = self._ids(rows, batch_id)
        self._held = {"after": batch_id, "row": row, "ids": ids, "whole": ids}
        self._retire_states(spark, batch_id)

    def _ids(self, rows: DataFrame, batch_id: int) -> list[int]:
        known = self._held.get("ids") or self._state_ids(rows.sparkSession)
        return sorted({*known, batch_id})

    def _wholes(self, rows: DataFrame, batch_id: int) -> list[int]:
        """Batches before this one with a full copy; read once after a restart."""
        if "whole" not in self._held:
            ids = [b for b in self._state_ids(rows.sparkSession) if b != batch_id]
            found = [] if not ids else rows.sparkSession.read.schema(self._state_schema(rows)).parquet(self.state_path) \
                .filter(F.col("whole") & (F.col("batch_id") != batch_id)).select("batch_id").distinct().collect()
            return sorted(r[0] for r in found)
        return [b for b in self._held["whole"] if b != batch_id]

    def _retire_states(self, spark, batch_id: int) -> None:
        """Drop states older than the full copy that a replay of this batch starts from."""
        full = [b for b in self._held["whole"] if b < batch_id]
        if full:
            for b in [b for b in self._held["ids"] if b < full[-1]]:
                sinks.remove(spark, f"{self.state_path}/batch_id={b}")
            self._held["ids"] = [b for b in self._held["ids"] if b >= full[-1]]
            self._held["whole"] = [b for b in self._held["whole"] if b >= full[-1]]

    # ---- the batch ------------------------------------------------------------------

    def __call__(self, batch: DataFrame, batch_id: int) -> str:
        spark = batch.sparkSession
        try:
            status = self._run(spark, batch, batch_id)
            self._log(spark, batch_id, "SUCCEEDED", None, status)
            return status
        except Exception as exc:  # record, then let the stream fail/retry
            self._held = {}
            self._log(spark, batch_id, "FAILED", f"{type(exc).__name__}: {exc}", "error")
            traceback.print_exc()
            raise

    def _run(self, spark, batch: DataFrame, batch_id: int) -> str:
        rows = batch.select(*self.keys, "ts", "value")
        held: list[DataFrame] = []
        small = int(str(batch._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= SMALL_BYTES

        def keep(df: DataFrame) -> DataFrame:
            if not small:
                return cut(df)
            # kept for this batch only; a lost executor recomputes it from the batch's source files
            df = df.persist(StorageLevel.MEMORY_AND_DISK)
            held.append(df)
            return df

        try:
            key_fields = [rows.schema[k] for k in self.keys]
            # a table of one series: its state is one row, known from the batch before unless this is a start or a replay
            one = self._held.get("row") if self._held.get("after", batch_id) < batch_id else None
            state = self.state_before(rows, batch_id) if one is None else self._state_row(spark, one)
            points = None
            if self.spec.gap_fill or state is None:
                state, points = self._history(spark, key_fields, state, batch_id)
            if not self.keys and state is not None:
                state = one or tuple(state.select("s_ts", "s_value", "s_cum", "s_led").first() or ()) or None
            run = _Batch(self, rows, state, points, small, keep)
            m = run.seen
            if m["row_count"] == 0:
                self.statuses.append("no new data")
                return "no new data"   # T3: nothing to integrate
            out = run.ledger() if run.as_kept else keep(run.ledger())
            self.waves = run.waves
            sinks.write_ledger(out.select(*self.keys, *integ.LEDGER_COLS), self.ledger_path, batch_id, self.keys,
                               few=small and not run.spread)
            if self.spec.gap_fill:
                sinks.write_points(dayprofile.points_of(out, self.keys), self.profile_path, batch_id, small and not run.spread)
                if batch_id % self.compact_every == self.compact_every - 1:
                    sinks.compact_points(spark, self.profile_path, dayprofile.schema(key_fields), batch_id,
                                         lambda rows: dayprofile.merged(rows, self.keys))
            late_dropped = self._late(rows, state) if self.late == "drop" and state is not None else 0
            if self.keys:
                self._write_state(integ.ledger_state(out, self.keys), state, run.after(), rows, batch_id)
            else:
                top = out.agg(F.max(F.struct("ts", "cumulative_sum", "value")).alias("top")).first()["top"]
                self._write_one_state(top, state, run, rows, batch_id)
        finally:
            for df in held:
                df.unpersist()
        marker = spark.range(1).select(
            F.lit(m["row_count"]).cast("bigint").alias("row_count"), F.lit(m["first_ts"]).cast("timestamp_ntz").alias("first_ts"),
            F.lit(m["last_ts"]).cast("timestamp_ntz").alias("last_ts"), F.lit(late_dropped).cast("bigint").alias("late_dropped"),
            F.current_timestamp().alias("processed_at"))
        sinks.write_batch_table(marker, self.marker_path, batch_id, single=True)
        self.statuses.append("ok")
        return "ok"

    def _history(self, spark, key_fields, state, batch_id: int) -> tuple[DataFrame | None, DataFrame | None]:
        """State and profile rows of what is committed; for a ledger that this job did not write they are made of it once."""
        points = sinks.read_ledger(spark, self.profile_path, exclude_batch=batch_id, schema=dayprofile.schema(key_fields))
        if state is not None and points is not None:
            return state, points
        committed = sinks.read_ledger(spark, self.ledger_path, exclude_batch=batch_id, schema=sinks.ledger_schema(key_fields))
        if committed is None:
            return state, points
        committed = committed.select(*self.keys, *integ.LEDGER_COLS)
        if state is None:
            state = integ.ledger_state(committed, self.keys).withColumn("s_led", F.lit(1)) \
                .filter(F.col("s_ts").isNotNull())
        if points is None and self.spec.gap_fill:
            sinks.write_points(dayprofile.points_of(committed, self.keys), self.profile_path, -1)
            points = sinks.read_ledger(spark, self.profile_path, exclude_batch=batch_id, schema=dayprofile.schema(key_fields))
        return state, points

    def _late(self, rows: DataFrame, state: DataFrame | tuple) -> int:
        """Rows not newer than the carried state are dropped, and counted."""
        K = list(self.keys)
        if K:
            late = rows.join(state.select(*K, "s_ts"), K, "inner")
        else:   # one series: its state is a single timestamp
            late = rows.withColumn("s_ts", F.lit(state[0]).cast("timestamp_ntz"))
        return late.filter(F.col("ts") <= F.col("s_ts")).count()

    def _log(self, spark, batch_id, state, error, status) -> None:
        log = spark.range(1).select(
            F.lit(self.name).alias("name"), F.lit(state).alias("state"),
            F.current_timestamp().alias("scheduled_time"),
            F.lit(error).cast("string").alias("error_message"),
            F.lit(status).alias("status"), F.lit(batch_id).cast("bigint").alias("batch_id"),
            F.lit(uuid.uuid4().hex).alias("attempt"))
        sinks.append_log(log, self.run_log_path)


def of_days(ledger: DataFrame, first: Column, last: Column) -> DataFrame:
    """Ledger rows of the days; a ``day`` partition column prunes folders."""
    rows = ledger.filter(day_of("ts").between(first, last))
    return rows.filter(F.col("day").between(first, last)) if "day" in ledger.columns else rows


def daily_summary_job(export_ledger: DataFrame, production_ledger: DataFrame,
                      summary_path: str, first_date: str, last_date: str) -> str:
    """Summaries for [first_date, last_date] in one grouped pass, upserted
    by date."""
    lo, hi = F.lit(first_date).cast("date"), F.lit(last_date).cast("date")
    s = rollup.daily_summary(of_days(export_ledger, lo, hi), of_days(production_ledger, lo, hi))
    sinks.upsert_by_date(s, summary_path)
    return rollup.OK


def yesterday(spark: SparkSession, zone: str) -> str:
    """the date of yesterday in a named zone."""
    now = F.convert_timezone(F.lit("UTC"), F.lit(zone), F.to_utc_timestamp(
        F.current_timestamp(), F.current_timezone()).cast("timestamp_ntz"))
    return str(spark.range(1).select(F.date_sub(F.to_date(now), 1)).first()[0])


def day_summary_job(export_ledger: DataFrame, production_ledger: DataFrame, summary_path: str,
                    date: str | None = None, zone: str = "UTC") -> str:
    """The summary of one date, by default yesterday in ``zone``; the
    status says which ledger has no row of it, and then nothing is written."""
    day = F.lit(date or yesterday(export_ledger.sparkSession, zone)).cast("date")
    s = rollup.daily_summary_status(of_days(export_ledger, day, day), of_days(production_ledger, day, day))
    found = s.first()
    if found is None:
        return rollup.NO_EXPORT
    if found["status"] == rollup.OK:
        sinks.upsert_by_date(s.drop("status"), summary_path)
    return found["status"]
