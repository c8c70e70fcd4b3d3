"""DuckDB SQL for the keys whose rows depend on earlier rows' results.

The per-day commits are unrolled: a step for every day of the events, with the ledger so
far and the carried state as materialized tables. The ``skip`` policy is a
recursion over the readings.
"""

from __future__ import annotations

import datetime

from wattline.oracles import DAY_US, HISTORY, LEDGER_COLS, NEW_DAYS, READINGS
from wattline.sources.fixtures import STEP_S

FIRST_DAY, DAYS = datetime.date(2024, 1, 1), 30
STEP_US = STEP_S * 1_000_000


def per_day_sql(days_a_batch: int, days: int = DAYS) -> str:
    """Ledger of the export variant fed in batches of so many days: every day sees the ledger of the days
    before it; a batch goes on from the newest ledger row, a day within it from the last reading."""
    out = ["led0 AS (SELECT NULL::TIMESTAMP AS ts, NULL::DOUBLE AS cumulative_sum, NULL::DOUBLE AS integral, "
           "NULL::DOUBLE AS delta, NULL::DOUBLE AS value WHERE FALSE)",
           "end0 AS (SELECT NULL::TIMESTAMP AS ts, NULL::DOUBLE AS value, NULL::DOUBLE AS cum WHERE FALSE)"]
    for k in range(1, days + 1):
        day = FIRST_DAY + datetime.timedelta(days=k - 1)
        before, p = f"led{k - 1}", f"d{k}_"
        newest = f"SELECT ts, value, cumulative_sum AS cum FROM {before} ORDER BY ts DESC, cumulative_sum DESC LIMIT 1"
        if (k - 1) % days_a_batch == 0:
            state = f"SELECT * FROM ({newest}) UNION ALL SELECT * FROM end{k - 1} WHERE NOT EXISTS (SELECT 1 FROM {before})"
        else:
            state = f"SELECT * FROM end{k - 1}"
        out += [
            f"{p}st AS ({state})",
            f"{p}r AS (SELECT ts, coalesce(value, 0.0::DOUBLE) AS value, row_number() OVER (ORDER BY ts, value) AS place "
            f"FROM ({READINGS}) q WHERE CAST(ts AS DATE) = DATE '{day}')",
            f"{p}s AS (SELECT ts, value, 1 AS o, 0.0::DOUBLE AS c0 FROM {p}r WHERE place > 1 OR EXISTS (SELECT 1 FROM {p}st) "
            f"UNION ALL SELECT ts, value, 0, cum FROM {p}st WHERE EXISTS (SELECT 1 FROM {p}r) "
            f"UNION ALL SELECT make_timestamp(epoch_us(ts) - {STEP_US}), 0.0::DOUBLE, 0, 0.0::DOUBLE FROM {p}r "
            f"WHERE place = 1 AND NOT EXISTS (SELECT 1 FROM {p}st))",
            f"{p}l AS (SELECT *, lag(ts) OVER w AS pt, lag(value) OVER w AS rv, lag(ts, 2) OVER w AS ppt, lag(o) OVER w AS po "
            f"FROM {p}s WINDOW w AS (ORDER BY o, ts, value))",
            f"{p}y AS (SELECT *, epoch_us(ts) - epoch_us(pt) AS d, coalesce(o = 1 AND epoch_us(ts) - epoch_us(pt) > {2 * STEP_US}, FALSE) AS gap, "
            f"CASE WHEN po = 1 AND epoch_us(pt) - epoch_us(ppt) > {2 * STEP_US} THEN 0.0::DOUBLE ELSE coalesce(rv, 0.0::DOUBLE) END AS pv, "
            f"epoch_us(pt) % {DAY_US} AS a, epoch_us(ts) % {DAY_US} AS b FROM {p}l)",
            f"{p}pr AS (SELECT a, b, avg(diff) AS profile FROM (SELECT g.a, g.b, CAST(h.ts AS DATE) AS day, "
            f"arg_max(cumulative_sum, (h.ts, cumulative_sum)) - arg_min(cumulative_sum, (h.ts, cumulative_sum)) AS diff "
            f"FROM (SELECT DISTINCT a, b FROM {p}y WHERE gap AND a <= b) g JOIN {before} h ON epoch_us(h.ts) % {DAY_US} BETWEEN g.a AND g.b "
            f"GROUP BY ALL) x GROUP BY a, b)",
            f"{p}z AS (SELECT y.*, coalesce(profile, 0.0::DOUBLE) / (d / {float(STEP_US)}::DOUBLE) AS ai, (d + {STEP_US - 1}) // {STEP_US} AS n, "
            f"-0.5::DOUBLE * (d / 1e6 / 3600.0::DOUBLE) * (least(value, 0.0::DOUBLE) + least(pv, 0.0::DOUBLE)) AS integral "
            f"FROM {p}y y LEFT JOIN {p}pr pr ON y.gap AND y.a = pr.a AND y.b = pr.b)",
            f"{p}c AS (SELECT *, CASE WHEN o = 0 THEN c0 WHEN gap THEN n * ai ELSE integral END AS c FROM {p}z)",
            f"{p}cs AS (SELECT *, sum(c) OVER (ORDER BY o, ts, value ROWS UNBOUNDED PRECEDING) AS cum FROM {p}c)",
            f"led{k} AS (SELECT * FROM {before} UNION ALL SELECT ts, cum, integral, d / 1e6, value FROM {p}cs WHERE o = 1 AND NOT gap "
            f"UNION ALL SELECT make_timestamp(epoch_us(pt) + k * {STEP_US}), cum - c + k * ai, ai, {STEP_S}.0::DOUBLE, 0.0::DOUBLE "
            f"FROM (SELECT *, unnest(generate_series(1, n)) AS k FROM {p}cs WHERE gap) g)",
            f"end{k} AS (SELECT * FROM (SELECT ts, CASE WHEN gap THEN 0.0::DOUBLE ELSE value END AS value, cum FROM {p}cs "
            f"ORDER BY o DESC, ts DESC, value DESC LIMIT 1) UNION ALL SELECT * FROM end{k - 1} WHERE NOT EXISTS (SELECT 1 FROM {p}cs))",
        ]
    return "WITH " + ",\n".join(c.replace(" AS (", " AS MATERIALIZED (", 1) for c in out) + \
        f"\nSELECT {', '.join(f'round({c}, 6) AS {c}' if c != 'ts' else c for c in LEDGER_COLS)} FROM led{days}"


def skip_sql() -> str:
    """The first gap version on the days after the history: a gap without profile emits nothing and moves the
    time to its reading plus a minute, so whether a row is skipped depends on the row before."""
    shift, thr = 60_000_000, 2 * STEP_US
    band = "SELECT {i} AS i, CAST(h.ts AS DATE) AS day, arg_max(cumulative_sum, (h.ts, cumulative_sum)) - " \
           "arg_min(cumulative_sum, (h.ts, cumulative_sum)) AS diff FROM r JOIN h ON epoch_us(h.ts) % {day} BETWEEN r.{a} AND r.b " \
           "WHERE r.{gap} AND r.{a} <= r.b GROUP BY ALL"
    pa = band.format(i="r.i", day=DAY_US, a="a1", gap="gap1")
    pb = band.format(i="r.i", day=DAY_US, a="a2", gap="gap2")
    return f"""
WITH RECURSIVE h AS MATERIALIZED ({HISTORY}),
seed AS (SELECT ts, value, cumulative_sum AS cum FROM h ORDER BY ts DESC, cumulative_sum DESC LIMIT 1),
o AS (SELECT ts, coalesce(value, 0.0::DOUBLE) AS value, row_number() OVER (ORDER BY ts, value) AS i FROM ({NEW_DAYS}) q
      UNION ALL SELECT ts, coalesce(value, 0.0::DOUBLE), 0 FROM seed),
d AS (SELECT i, ts, value, lag(ts) OVER (ORDER BY i) AS pt, lag(value) OVER (ORDER BY i) AS rv FROM o),
r AS MATERIALIZED (SELECT *, epoch_us(ts) - epoch_us(pt) AS d1, coalesce(epoch_us(ts) - epoch_us(pt) > {thr}, FALSE) AS gap1,
      coalesce(epoch_us(ts) - epoch_us(pt) - {shift} > {thr}, FALSE) AS gap2, epoch_us(pt) % {DAY_US} AS a1,
      (epoch_us(pt) + {shift}) % {DAY_US} AS a2, epoch_us(ts) % {DAY_US} AS b FROM d),
p1 AS MATERIALIZED (SELECT i, avg(diff) AS p FROM ({pa}) x GROUP BY i),
p2 AS MATERIALIZED (SELECT i, avg(diff) AS p FROM ({pb}) x GROUP BY i),
c AS MATERIALIZED (SELECT r.*, p1.p AS p1, p2.p AS p2, gap1 AND p1.p IS NULL AS s1, gap2 AND p2.p IS NULL AS s2
      FROM r LEFT JOIN p1 USING (i) LEFT JOIN p2 USING (i)),
sk AS (SELECT 0::BIGINT AS i, FALSE AS s UNION ALL
       SELECT c.i, CASE WHEN sk.s THEN c.s2 ELSE c.s1 END FROM sk JOIN c ON c.i = sk.i + 1),
y AS (SELECT c.*, sk.s, coalesce(b1.s, FALSE) AS after, CASE WHEN coalesce(b1.s, FALSE) THEN gap2 ELSE gap1 END AS gap
      FROM c JOIN sk USING (i) LEFT JOIN sk b1 ON b1.i = c.i - 1 WHERE c.i > 0),
z AS (SELECT *, d1 - CASE WHEN after THEN {shift} ELSE 0 END AS d, CASE WHEN after THEN p2 ELSE p1 END AS p,
      epoch_us(pt) + CASE WHEN after THEN {shift} ELSE 0 END AS from_us,
      CASE WHEN coalesce(lag(gap) OVER (ORDER BY i), FALSE) THEN 0.0::DOUBLE ELSE rv END AS pv FROM y),
e AS (SELECT *, p / (d / {float(STEP_US)}::DOUBLE) AS ai, d // {STEP_US} + 1 AS n,
      -0.5::DOUBLE * (d / 1e6 / 3600.0::DOUBLE) * (least(value, 0.0::DOUBLE) + least(pv, 0.0::DOUBLE)) AS integral FROM z),
t AS (SELECT *, CASE WHEN s THEN 0.0::DOUBLE WHEN gap THEN n * ai ELSE integral END AS c FROM e),
cs AS (SELECT *, (SELECT cum FROM seed) + sum(c) OVER (ORDER BY i ROWS UNBOUNDED PRECEDING) AS cum FROM t),
led AS (SELECT ts, cum AS cumulative_sum, integral, d / 1e6 AS delta, value FROM cs WHERE NOT gap AND NOT s
        UNION ALL SELECT make_timestamp(from_us + k * {STEP_US}), cum - c + k * ai, ai, {STEP_S}.0::DOUBLE, 0.0::DOUBLE
        FROM (SELECT *, unnest(generate_series(1, n)) AS k FROM cs WHERE gap AND NOT s) g)
SELECT {', '.join(f'round({c}, 6) AS {c}' if c != 'ts' else c for c in LEDGER_COLS)} FROM led"""
