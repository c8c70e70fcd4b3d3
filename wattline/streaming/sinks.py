"""Idempotent table sinks.

``foreachBatch`` is at-least-once: a batch may run again after a failure.
Every sink therefore writes a batch's rows under its own ``batch_id``
partition with dynamic partition overwrite, set on the writer alone, so a
replay replaces exactly what the failed attempt wrote (exactly-once effect)
and never touches other batches or the session. Ledgers are partitioned by
``day`` first (partition pruning for day-level reads, S10), rebalanced to the
advised partition size so that a day of any size is written by as many tasks
as it needs, rows sorted by ``ts`` inside files (row-group min/max stats).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.functions.timefns import day_of
from wattline.plans.materialize import cut

#: A file's size, about, and the bytes that a ledger row takes in it.
FILE_BYTES, ROW_BYTES = 256 << 20, 40


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def remove(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def ledger_schema(keys: Sequence[T.StructField] = ()) -> T.StructType:
    """Schema of a written ledger: rows may be missing, columns never are."""
    doubles = ["cumulative_sum", "integral", "delta", "value"]
    return T.StructType([*keys, T.StructField("ts", T.TimestampNTZType()),
                         *[T.StructField(c, T.DoubleType()) for c in doubles],
                         T.StructField("day", T.DateType()), T.StructField("batch_id", T.LongType())])


def write_ledger(rows: DataFrame, path: str, batch_id: int | None = None,
                 keys: Sequence[str] = (), file_bytes: int = FILE_BYTES, few: bool = False) -> None:
    """Append ledger rows (by name) for one batch; ``few`` rows are written as they lie."""
    out = rows.withColumn("day", day_of("ts"))
    parts = ["day"]
    if batch_id is not None:
        out = out.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        parts.append("batch_id")
    ((out if few else out.hint("rebalance", F.col("day"))).sortWithinPartitions(*parts, *keys, "ts")
        .write.mode("overwrite" if batch_id is not None else "append")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max(1, file_bytes // ROW_BYTES))
        .partitionBy(*parts).parquet(path))


def read_ledger(spark: SparkSession, path: str, exclude_batch: int | None = None,
                schema: T.StructType | None = None) -> DataFrame | None:
    """The table at ``path``, None before its first write. With ``schema`` a
    table whose batches wrote no row reads as empty. Closed days come from their own part."""
    if not exists(spark, path):
        return None
    df = spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)
    done = closed_days(spark, path)
    if done:
        days = F.col("day").isin(*[F.lit(d).cast("date") for d in done])
        still = ~days                                 # and batches that came after the closing
        for d in sorted(set(done) & set(open_days(spark, path))):
            still = still | ((F.col("day") == F.lit(d).cast("date")) & (F.col("batch_id") > done[d]))
        closed = spark.read.schema(df.schema).parquet(closed_path(path)).select(*df.columns)
        df = df.filter(still).unionByName(closed.filter(days))
    if exclude_batch is not None and "batch_id" in df.columns:
        df = df.filter(F.col("batch_id") != exclude_batch)
    return df


def write_batch_table(rows: DataFrame, path: str, batch_id: int, single: bool = False) -> None:
    """Per-batch tables: a batch's rows replace its own folder, no other; ``single`` for those of one row."""
    (rows.coalesce(1) if single else rows).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def write_points(points: DataFrame, path: str, batch_id: int, few: bool = False) -> None:
    """The profile rows that a batch adds, in its own folder; in clock order, so that files skip by cell."""
    (points.coalesce(1) if few else points.repartitionByRange("cell")).sortWithinPartitions("cell", "day") \
        .write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def compact_points(spark: SparkSession, path: str, schema: T.StructType, before: int, merge) -> int:
    """Put the profile rows of batches before ``before`` into one folder, -1; how many folders went.

    ``merge`` joins rows of one cell. Points that are there twice count once, so readers
    and a failure between the write and the removal of the old folders do no harm."""
    ids = [int(f.removeprefix("batch_id=")) for f in folders(spark, path) if f.startswith("batch_id=")]
    old = [b for b in ids if 0 <= b < before]
    if old:
        rows = cut(merge(spark.read.schema(schema).parquet(path).filter(F.col("batch_id") < before).drop("batch_id")))
        write_points(rows, path, -1)
        for b in old:
            remove(spark, f"{path}/batch_id={b}")
    return len(old)


def append_log(row: DataFrame, path: str) -> None:
    """A log row: nothing that was logged before is ever replaced."""
    row.coalesce(1).write.mode("append").parquet(path)


def upsert_by_date(new: DataFrame, path: str) -> None:
    """MERGE on ``date`` for a table partitioned by date: the dates in
    ``new`` are replaced (update + insert), every other date is kept."""
    (new.hint("rebalance", F.col("date")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("date").parquet(path))


def upsert_by_key(new: DataFrame, path: str, key: Sequence[str], partition: str = "date") -> None:
    """MERGE by key into a table partitioned by ``partition``, one of the key columns.

    Only partitions that ``new`` touches are read and written: their old rows without
    a match are kept (an anti join), matched ones take the new values, others are inserted.
    The merged partitions are written beside the table first, so that no file is replaced that
    the merge still reads, and then swapped in by a dynamic overwrite. Running it again, also
    after a failure in between, gives the same rows. Several rows of one key in ``new``: an error, as
    the MERGE statement has it."""
    spark = new.sparkSession
    new = cut(new)
    twice = new.groupBy(*key).count().filter("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"several new rows for one key: {twice[0]}")
    merged = new
    if exists(spark, path):
        old = spark.read.schema(new.schema).parquet(path)
        touched = new.select(partition).distinct()
        old = old.join(F.broadcast(touched), partition, "left_semi")     # prunes the partitions that are read
        keep = [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in key]
        on = keep[0]
        for c in keep[1:]:
            on = on & c
        merged = old.alias("o").join(new.select(*key).alias("n"), on, "left_anti").select(*new.columns).unionByName(new)
    staged = cut(merged)
    (staged.hint("rebalance", F.col(partition)).sortWithinPartitions(*key)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path))


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right under ``path``."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return sorted(f.getPath().getName() for f in fs.listStatus(p) if f.isDirectory())


# ---- closed days ------------------------------------------------------------

def closed_path(path: str) -> str:
    return f"{path}_closed"


def closed_days(spark: SparkSession, path: str) -> dict[str, int]:
    """Days whose rows, up to a batch, are read from the closed part: those with a finished write."""
    out: dict[str, int] = {}
    for f in folders(spark, f"{closed_path(path)}/_done"):
        day, upto = f.removeprefix("closed=").split(",upto=")
        out[day] = max(int(upto), out.get(day, int(upto)))
    return out


def open_days(spark: SparkSession, path: str) -> list[str]:
    return [f.removeprefix("day=") for f in folders(spark, path) if f.startswith("day=")]


def open_batches(spark: SparkSession, path: str, day: str) -> list[int]:
    return [int(f.removeprefix("batch_id=")) for f in folders(spark, f"{path}/day={day}") if f.startswith("batch_id=")]


def close_days(spark: SparkSession, path: str, schema: T.StructType, before: str, file_bytes: int = FILE_BYTES) -> list[str]:
    """Put the batch files of days before ``before`` together.

    A closed day is written whole to the closed part of the ledger, as files of about
    ``file_bytes`` in order of time; then a marker folder, which names the last batch in it, turns
    readers over to it. The batch folders stay until the next call, so a reader that has listed
    them can finish. A batch that comes later all the same is read beside the closed part and joins it at
    the next call. A call that failed before the marker starts its days anew. Rows keep their batch_id.
    """
    done, todo = closed_days(spark, path), {}
    for d in open_days(spark, path):
        found = open_batches(spark, path, d)
        for b in found:
            if b <= done.get(d, -2):
                remove(spark, f"{path}/day={d}/batch_id={b}")
        if found and d < before and max(found) > done.get(d, -2):
            todo[d] = max(found)
        elif not open_batches(spark, path, d):
            remove(spark, f"{path}/day={d}")
    if todo:
        # written aside first: a day that is closed again is read from where it is written to
        rows = cut(read_ledger(spark, path, schema=schema).filter(F.col("day").isin(*[F.lit(d).cast("date") for d in todo])))
        (rows.hint("rebalance", F.col("day")).sortWithinPartitions("day", "ts")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .option("maxRecordsPerFile", max(1, file_bytes // ROW_BYTES)).partitionBy("day").parquet(closed_path(path)))
        for d, b in todo.items():
            mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{closed_path(path)}/_done/closed={d},upto={b}")
            mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(mark)
    return sorted(todo)
