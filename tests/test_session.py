"""Lineage cuts use the shared folder the session names."""

import os

from wattline.plans.materialize import cut
from wattline.session import checkpoint_dir


def test_checkpoint_dir_comes_from_session(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    d = checkpoint_dir(spark)
    assert configured and d.startswith(configured)


def test_cut_writes_under_checkpoint_dir(spark):
    df = cut(spark.range(100).withColumnRenamed("id", "x"))
    assert df.count() == 100
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert any(files for _, _, files in os.walk(base))
