"""Physical-plan properties that matter at scale."""

import re

from wattline.operators import align, integrate as integ
from wattline.plans import stitch
from wattline.plans.materialize import cut
from wattline.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    """What the plan's shuffles partition by, from the top down."""
    return re.findall(r"Exchange (\w+(?:\([^)]*\))?)", plan(df).split("== Initial Plan ==")[0])


def keyed(spark, n=4000):
    return spark.range(n).selectExpr("id % 3 AS series", "timestampadd(SECOND, id * 40 + (id div 50) * 500, TIMESTAMP_NTZ'2024-05-01 00:00:00') AS ts",
                                     "CAST(-(id % 11) AS DOUBLE) AS value")


def test_integration_shuffles_detail_rows_once(spark):
    """Without fill: the shuffle by (series, bucket) alone, above it no other. With fill, cut into buckets: the scan
    is written once, and the result reads it without another shuffle of its rows."""
    p = fx.params(SF)
    plain = integ.integrate(keyed(spark), None, fx.export_spec(p).with_(gap_fill=False), keys=["series"])
    found = [e for e in exchanges(plain) if "hashpartitioning" in e]
    assert len(found) == 1 and "series" in found[0] and stitch.BKT in found[0]
    spec = fx.export_spec(p).with_(step_ms=100_000)
    written = []
    x = integ.scan(keyed(spark), spec, ["series"], rows=200, keep=lambda df: (written.append(df), cut(df))[1])
    assert x.many and len(written) == 1
    detail = [e for e in exchanges(written[0]) if "hashpartitioning" in e]
    assert len([e for e in detail if stitch.BKT in e]) == 1
    done = integ.completed(x, None)
    above = exchanges(done.summed())
    # what is shuffled above are bucket summaries: ends, halos, pending rows
    assert not any("SinglePartition" in e for e in above)
    rows = done.summed().count()
    assert rows == 4000 - 3 + 3 and done.n_pending < rows     # a seed for each series, its first reading dropped


def test_large_series_is_not_one_partition(spark):
    x = integ.scan(keyed(spark).drop("series"), fx.export_spec(fx.params(SF)), rows=300)
    sizes = [r["count"] for r in x.rows.groupBy(stitch.BKT).count().collect()]
    assert len(sizes) >= 13 and max(sizes) < 500


def test_nearest_join_is_equi_join(spark):
    p = fx.params(SF)
    out = align.nearest_join(fx.left_ledger(spark, SF), fx.right_ledger(spark, SF), p.tol_s * 1000)
    txt = plan(out)
    assert "NestedLoopJoin" not in txt and "CartesianProduct" not in txt


def test_filters_reach_the_scan(spark):
    from wattline.operators import filters
    df = filters.time_range(fx.readings(spark, SF), "2024-01-10 06:00:00", "2024-01-12 18:30:00")
    txt = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in txt
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,value:double>" in txt
