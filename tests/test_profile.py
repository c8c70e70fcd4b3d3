"""Band profile vs a brute-force band scan."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest

import fold
from wattline.operators import profile


@pytest.mark.parametrize("rows", [None, 40])
def test_band_profile_brute_force(spark, rows, monkeypatch):
    if rows:
        monkeypatch.setattr(profile, "BLOCK", 7)      # blocks of holes and bands meet
    rng = random.Random(11)
    ledger, cum = [], 0.0
    for d in range(5):
        t = datetime(2024, 2, 1 + d, rng.randint(0, 5))
        while t.day == 1 + d:
            cum += rng.uniform(0, 2)
            ledger.append((t, cum))
            t += timedelta(seconds=rng.choice([7, 30, 600, 5400]))
    bands = []
    for _ in range(60):
        a = rng.randint(0, 86_399_999_999)
        b = a + rng.randint(-10 ** 9, 6 * 3_600_000_000)
        bands.append((a, min(b, 86_399_999_999)))
    ldf = spark.createDataFrame([(t, c) for t, c in ledger], "ts timestamp_ntz, cumulative_sum double")
    gdf = spark.createDataFrame(bands, "a long, b long")
    got = {(r.a, r.b): (r.days, r.profile) for r in profile.band_profile(gdf, ldf, rows=rows).collect()}
    for a, b in bands:
        exp = fold.band_profile(ledger, a, b) if a <= b else None
        if exp is None:
            assert (a, b) not in got
        else:
            assert got[(a, b)][1] == pytest.approx(exp)


def test_dominance_sums():
    rng = np.random.default_rng(0)
    for n, m, span in ((0, 3, 5), (1, 3, 5), (7, 20, 9), (64, 50, 30), (700, 300, 10 ** 9)):
        h, b, w = rng.integers(0, span, (n, 2)), rng.integers(0, span, (m, 2)), rng.random((n, 2))
        want = [[w[(h[:, 0] < a) & (h[:, 1] > c), k].sum() for k in (0, 1)] for a, c in b]
        assert np.allclose(profile.dominance(h, w, b), want)


def test_rows_do_not_grow_with_bands_times_days(spark):
    """200 days, 200 bands: no operator produces rows by band and day."""
    day, n = 86_400_000_000, 200
    led = spark.range(n * 96).selectExpr(f"timestampadd(MICROSECOND, id * {day // 96}, TIMESTAMP_NTZ'2024-01-01 00:00:00') AS ts",
                                         "CAST(id AS DOUBLE) AS cumulative_sum")
    gaps = spark.range(n).selectExpr("id * 7000000 + 60000000 AS a", "id * 7000000 + 6000000000 AS b")
    out = profile.band_profile(gaps, led)
    out.write.format("noop").mode("overwrite").save()
    got = out.collect()
    assert len(got) == n and {r.days for r in got} == {n}
    most, nodes = 0, [out._jdf.queryExecution().executedPlan()]
    while nodes:
        p = nodes.pop()
        if p.metrics().contains("numOutputRows"):
            most = max(most, p.metrics().apply("numOutputRows").value())
        inner = p.executedPlan() if hasattr(p, "executedPlan") and p.nodeName() == "AdaptiveSparkPlan" else None
        kids = [inner] if inner is not None else [p.children().apply(i) for i in range(p.children().size())]
        if p.nodeName().endswith("QueryStage"):
            kids = [p.plan()]
        nodes += kids
    assert 0 < most <= n * 96 + n + 2 * n + n       # rows, days, two questions a band, and slack; bands x days are 40,000


@pytest.mark.parametrize("at_once", [None, 50])
def test_many_series_share_a_call(spark, at_once, monkeypatch):
    """Series by series as brute force, without a call of Python for each of them."""
    if at_once:
        monkeypatch.setattr(profile, "AT_ONCE", at_once)
    rng = random.Random(5)
    ledgers, bands, near_midnight = {}, [], 86_399_000_000
    for s in [f"s{i}" for i in range(25)] + [None]:
        cum, rows = 0.0, []
        for d in range(4):
            for h in sorted(rng.sample(range(24 * 60), rng.randint(1, 6))):
                cum += rng.uniform(0, 2)
                rows.append((datetime(2024, 2, 1 + d) + timedelta(minutes=h), cum))
        ledgers[s] = rows
        for _ in range(6):
            a = rng.randint(0, near_midnight)
            bands.append((s, a, min(a + rng.randint(0, 6 * 3_600_000_000), near_midnight)))
    ldf = spark.createDataFrame([(s, t, c) for s, rows in ledgers.items() for t, c in rows], "series string, ts timestamp_ntz, cumulative_sum double")
    out = profile.band_profile(spark.createDataFrame(bands, "series string, a long, b long"), ldf, ["series"])
    assert "CoGroup" not in out._jdf.queryExecution().executedPlan().toString()
    got = {(r.series, r.a, r.b): r.profile for r in out.collect()}
    for s, a, b in bands:
        exp = fold.band_profile(ledgers[s], a, b)
        if exp is None or s is None:                  # no series, no profile
            assert (s, a, b) not in got
        else:
            assert got[s, a, b] == pytest.approx(exp)
