"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings every wattline job relies on. UTC keeps NTZ <-> instant casts
# lossless; AQE supplies the runtime (measured-size) broadcast decisions the
# operators lean on instead of static broadcast hints.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app: str = "wattline",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to an existing session."""
    for k, v in BASE_CONF.items():
        if spark.conf.isModifiable(k):
            spark.conf.set(k, v)
    importable(spark)


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    A cluster whose machines lack the folder ships the package with --py-files.
    """
    root = str(Path(__file__).resolve().parents[1])
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Reads ``spark.checkpoint.dir`` from the session (runtime or launch
    configuration). Only a local session without it, as in tests, gets a
    scratch folder; on a cluster a missing setting is an error, since
    executors would not share the driver's disk.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        d = sc.getCheckpointDir()
        if d:
            return d
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="wattline-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    return checkpoint_dir(spark).rstrip("/") + "/" + name
