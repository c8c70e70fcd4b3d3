"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    A cluster whose machines lack the folder ships the package with --py-files.
    """
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, named by spark.checkpoint.dir.

    Only a local session without the setting (tests) gets a scratch folder;
    a cluster without it is an error, since executors could not see one.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="wattline-llm-")
        spark.conf.set("spark.checkpoint.dir", d)
    return d.rstrip("/")


def cut(df: DataFrame, name: str = "t", compression: str = "zstd") -> DataFrame:
    """Write df once as a table in the shared folder and read it back.

    Cuts the lineage and freezes values that depend on partitioning, so a
    lost executor can only make Spark read files again.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_last(df: DataFrame, name: str = "t") -> DataFrame:
    """As cut(), and Spark drops the shuffle files of the write as soon as it is done.

    For a result behind a shuffle of the size of the corpus, which nothing reads again. The session's setting
    for that is put back as it was.
    """
    spark, key = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        return cut(df, name)
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


#: Keys whose row of the other side may be broadcast, and the rows that a key has before it counts as heavy.
LIST, HEAVY = 100_000, 256


def spread_join(left: DataFrame, right: DataFrame, key: str, counts: DataFrame) -> DataFrame:
    """``left`` joined to ``right``, which has one row per key, without a task that gathers a heavy key.

    ``counts`` (key, n) tells how many rows of ``left`` a key has. Keys of over HEAVY rows, and of over a
    LIST-th part of all rows, are heavy; they are LIST at most, whatever the data, so their rows of ``right``
    are broadcast and meet the rows of ``left`` where these lie. All other keys are shuffled.
    """
    total = counts.agg(F.sum("n")).first()[0] or 0
    limit = max(HEAVY, -(-total // LIST))
    heavy = cut(counts.where(F.col("n") > limit).select(key).join(right, key), "heavy")
    if heavy.isEmpty():
        return left.join(right, key)
    near = left.join(F.broadcast(heavy), key)
    return near.unionByName(left.join(F.broadcast(heavy.select(key)), key, "left_anti").join(right, key).select(*near.columns))


def components(edges: DataFrame) -> DataFrame:
    """Distributed union-find: (node, root) for every node that is not its root.

    ``edges`` has long columns a, b. Alternating large-star and small-star
    steps, each one a min aggregate and a join. A node with very many neighbours is
    pre-aggregated for its minimum, and its minimum goes to where its neighbours lie
    (``spread_join``), so it is never gathered in one task. A component's
    root is its smallest node. No edge at all gives an empty frame.
    """
    e = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                         F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        sym = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        up = F.sum((F.col("v") > F.col("u")).cast("long"))
        low = cut(sym.groupBy("u").agg(F.min("v").alias("m"), up.alias("n")).select(
            "u", F.least("u", "m").alias("m"), "n"), "low")
        large = spread_join(sym.where("v > u"), low.select("u", "m"), "u", low.select("u", "n")).select(
            F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        large = cut(large, "large")
        low = cut(large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")), "low")
        pairs = spread_join(large, low.select("a", "m"), "a", low.select("a", "n"))
        small = pairs.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            low.select("a", F.col("m").alias("b"))).distinct()
        e = cut(small, "edges")
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before or now[0] == 0:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Arrow tables that hold whole groups of rows sorted by ``keys``.

    The last group of a batch waits for the next batch; callers keep groups
    small, so what is held stays small.
    """
    held = None
    for b in batches:
        t = pa.Table.from_batches([b])
        if held is not None:
            t = pa.concat_tables([held, t])
        t = t.combine_chunks()
        n = t.num_rows
        if n == 0:
            continue
        cols = [t.column(k).to_numpy(zero_copy_only=False) for k in keys]
        same = functools.reduce(np.logical_and, [c == c[-1] for c in cols])
        other = np.flatnonzero(~same)
        at = int(other[-1]) + 1 if len(other) else 0
        if at:
            yield t.slice(0, at)
        held = t.slice(at)
    if held is not None and held.num_rows:
        yield held
