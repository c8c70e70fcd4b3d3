"""Structured Streaming entry points."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.functions.timefns import day_of

READING_STREAM_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("day", T.DateType()),
])


def reading_stream(spark: SparkSession, path: str, max_files: int | None = None,
                   schema: T.StructType = READING_STREAM_SCHEMA, max_bytes: str | None = None) -> DataFrame:
    """New reading files under ``path`` (append-only by contract; the
    source's offsets live in the query checkpoint). ``max_bytes`` ('1g') bounds a
    micro-batch by what it reads, ``max_files`` by files; one of them at most."""
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        r = r.option("maxBytesPerTrigger", max_bytes)
    return r.parquet(path)


def run_available(df: DataFrame, checkpoint: str, foreach_batch=None,
                  sink_path: str | None = None, processing_time: str | None = None):
    """Run the stream over everything available now and stop
    (``processing_time='1 minute'`` gives the scheduled form, T1)."""
    w = df.writeStream.option("checkpointLocation", checkpoint)
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    else:
        w = w.trigger(availableNow=True)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format("parquet").outputMode("append").option("path", sink_path)
    q = w.start()
    if not processing_time:
        q.awaitTermination()
    return q


def mirror(spark: SparkSession, source: str, sink: str, checkpoint: str) -> None:
    """INSERT INTO mirror SELECT id, ts, value FROM stream."""
    s = reading_stream(spark, source).select("id", "ts", "value")
    run_available(s, checkpoint, sink_path=sink)


def start_after_existing(spark: SparkSession, source: str, checkpoint: str) -> None:
    """S5 ``SHOW_INITIAL_ROWS = FALSE``: prime the checkpoint by consuming
    what exists now into a no-op batch handler; a later query on the same
    checkpoint sees only files that arrive afterwards."""
    run_available(reading_stream(spark, source), checkpoint,
                  foreach_batch=lambda df, i: None)


def write_day_files(readings: DataFrame, path: str, days=None, file_bytes: int = 256 << 20) -> None:
    """Feed: the readings as files by calendar day, in one job, that a file source sees in time order.

    A day of any size is written by as many tasks as it needs, sorted by time, a file a day where days are
    small. The source takes files by their times, so the new files get ascending ones in the order of
    their days (and parts): one call per file, no read of rows."""
    d = readings.withColumn("day", day_of("ts"))
    if days is not None:
        d = d.filter(F.col("day").isin(*[F.lit(x).cast("date") for x in days]))
    spark = readings.sparkSession
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def files() -> dict:
        found = {}
        if fs.exists(p):
            at = fs.listFiles(p, True)
            while at.hasNext():
                f = at.next()
                if f.getPath().getName().endswith(".parquet"):
                    found[f.getPath().toString()] = f
        return found

    before = files()
    (d.hint("rebalance", F.col("day")).sortWithinPartitions("day", "ts").write.mode("append")
     .option("maxRecordsPerFile", max(1, file_bytes // 24)).partitionBy("day").parquet(path))
    new = sorted(set(now := files()) - set(before))
    # between those that were there and this moment, or from the last one's time on
    first = max([f.getModificationTime() for f in before.values()], default=0)
    last = max([now[f].getModificationTime() for f in new], default=0)
    start = max(first + 1, last - len(new))
    for i, f in enumerate(new):
        fs.setTimes(now[f].getPath(), start + i, -1)
