"""Registered queries vs their DuckDB oracle on the smallest scale."""

import math

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
FAST = ["readings_scan", "channel_sum", "sign_clamp", "time_of_day_band", "calendar_day_filter",
        "latest_row", "latest_n", "nearest_to_instant", "lag_previous", "gap_detect", "gap_flags",
        "gap_fill_slots", "cumulative_energy", "integrate_export", "integrate_production",
        "integrate_carry_in", "first_row_policy", "late_rows", "gap_profile", "band_profile",
        "integrate_gapfill", "integrate_gapfill_le", "day_boundary_values", "daily_energy",
        "hourly_energy", "daily_summary", "daily_upsert", "nearest_join", "daily_consumption_rate",
        "weather_explode", "production_weather", "day_ticks", "tagged_union", "counter_grid",
        "time_grid_hole", "anomaly_scan", "integrate_gapfill_skip", "summary_upsert_keyed"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["events"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    return str(v)


def rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(norm(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    if name not in E.oracle_sql():
        pytest.skip("no oracle")
    sql = E.oracle_sql()[name]
    df = E.queries()[name](spark, SF)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(sql)
    exp = rows([d[0] for d in res.description], res.fetchall())
    assert sorted(df.columns) == sorted(d[0] for d in res.description)
    assert got == exp


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["day", "energy"]
    assert df.count() > 0
