"""Bucket-stitched lag / running sum equal the global single-partition window."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wattline.functions.timefns import micros
from wattline.plans import stitch


@pytest.mark.parametrize("size", [1, 30, 1000])
def test_halo_and_running_sum(spark, size):
    rng = random.Random(3)
    t = datetime(2024, 1, 1)
    rows = []
    for i in range(400):
        t += timedelta(seconds=rng.choice([1, 5, 60, 3600, 7200, 40000]))
        rows.append((t, float(rng.randint(-5, 5))))
    df = spark.createDataFrame(rows, "ts timestamp_ntz, v double").withColumn("_s", F.lit(0))
    b, many = stitch.bucketed(df, ["_s"], micros("ts"), size)
    assert many == (size < 400)
    out = stitch.halo_lags(b, ["_s"], ["ts"], ["ts", "v"], depth=2, many=many)
    out = stitch.running_sum(out, ["_s"], ["ts"], "v", "cum", many=many)
    w = Window.orderBy("ts")
    ref = df.select("ts", F.lag("ts").over(w).alias("p1"), F.lag("v", 2).over(w).alias("p2v"),
                    F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum"))
    got = {r.ts: (r._p1_ts, r._p2_v, r.cum) for r in out.collect()}
    for r in ref.collect():
        g = got[r.ts]
        assert g[0] == r.p1 and g[1] == r.p2v
        assert g[2] == pytest.approx(r.cum)


def test_buckets_follow_the_data(spark):
    """A dense hour is cut, a sparse month is not; sizes stay near the bound whatever the rate."""
    dense = spark.range(20_000).selectExpr("'dense' AS k", "id * 180 AS us")                       # a row every 180 us
    bursts = spark.range(9_000).selectExpr("'bursts' AS k", "(id % 3) * 1000000000000 + id AS us")  # three dense moments, far apart
    sparse = spark.range(900).selectExpr("'sparse' AS k", "id * 2900000000 AS us")
    df = dense.unionByName(bursts).unionByName(sparse)
    b, many = stitch.bucketed(df, ["k"], F.col("us"), 1000)
    assert many
    sizes = {(r.k, r[stitch.BKT]): r["count"] for r in b.groupBy("k", stitch.BKT).count().collect()}
    by = {k: [n for (s, _), n in sizes.items() if s == k] for k in ("dense", "bursts", "sparse")}
    assert by["sparse"] == [900] and len(by["dense"]) == 20 and len(by["bursts"]) == 9
    assert max(by["dense"] + by["bursts"]) < 1300
    # buckets ascend in time
    edges = b.groupBy("k", stitch.BKT).agg(F.min("us").alias("lo"), F.max("us").alias("hi")).orderBy("k", stitch.BKT).collect()
    assert all(x.hi < y.lo for x, y in zip(edges, edges[1:]) if x.k == y.k)
