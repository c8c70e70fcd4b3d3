"""Time helpers as Catalyst column expressions (no UDFs).

All timestamps inside wattline are TIMESTAMP_NTZ holding UTC wall time. The
helpers use ``timestamp_diff`` / ``timestamp_add``, which do not depend on the
session time zone for NTZ input, so they stay inside whole-stage codegen and
give the same answer on every executor.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "DAY_US", "as_col", "micros", "from_micros", "add_micros", "tod_us",
    "parse_tod", "diff_micros", "diff_seconds_boundary", "diff_millis",
    "epoch_millis", "ntz_literal", "instant_literal", "hour_start", "day_of",
]

DAY_US = 86_400_000_000


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lit(c) -> Column:
    return F.lit(c) if isinstance(c, int) else as_col(c)


_EPOCH_SQL = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _name(c) -> str | None:
    """Backquoted column name when ``c`` is a plain name (one py4j call per
    expression instead of one per function)."""
    return f"`{c}`" if isinstance(c, str) and "`" not in c else None


def micros(ts) -> Column:
    """Microseconds since the epoch of an NTZ timestamp."""
    n = _name(ts)
    if n:
        return F.expr(f"timestampdiff(MICROSECOND, {_EPOCH_SQL}, {n})")
    return F.timestamp_diff("MICROSECOND", _epoch(), as_col(ts))


def from_micros(us) -> Column:
    """Inverse of :func:`micros`; returns TIMESTAMP_NTZ."""
    return F.timestamp_add("MICROSECOND", _lit(us), _epoch())


def add_micros(ts, us) -> Column:
    """ts + us microseconds (F14); stays NTZ."""
    return F.timestamp_add("MICROSECOND", _lit(us), as_col(ts))


def tod_us(ts) -> Column:
    """Time of day in microseconds; stands in for TO_TIME (F2)."""
    n = _name(ts)
    if n:
        return F.expr(f"pmod(timestampdiff(MICROSECOND, {_EPOCH_SQL}, {n}), {DAY_US}L)")
    return F.pmod(micros(ts), F.lit(DAY_US))


def parse_tod(text: str) -> int:
    """'HH:MM:SS[.ffffff]' -> microseconds of day (a driver-side literal)."""
    hh, mm, rest = text.split(":")
    ss, _, frac = rest.partition(".")
    frac = (frac + "000000")[:6]
    return ((int(hh) * 60 + int(mm)) * 60 + int(ss)) * 1_000_000 + int(frac)


def diff_micros(a, b) -> Column:
    """Exact elapsed microseconds from a to b."""
    na, nb = _name(a), _name(b)
    if na and nb:
        return F.expr(f"timestampdiff(MICROSECOND, {na}, {nb})")
    return F.timestamp_diff("MICROSECOND", as_col(a), as_col(b))


def diff_seconds_boundary(a, b) -> Column:
    """Second boundaries crossed from a to b: DATEDIFF('second', a, b)."""
    return (F.floor(micros(b) / F.lit(1_000_000))
            - F.floor(micros(a) / F.lit(1_000_000))).cast("bigint")


def epoch_millis(ts) -> Column:
    """DATE_PART(EPOCH_MILLISECOND, ts)."""
    return F.floor(micros(ts) / F.lit(1000)).cast("bigint")


def diff_millis(a, b) -> Column:
    """DATEDIFF(millisecond, a, b): millisecond boundaries crossed."""
    return (epoch_millis(b) - epoch_millis(a)).cast("bigint")


def ntz_literal(text: str, fmt: str | None = None) -> Column:
    """TO_TIMESTAMP_NTZ(text[, fmt]) with an explicit format."""
    if fmt:
        return F.to_timestamp_ntz(F.lit(text), F.lit(fmt))
    return F.lit(text).cast("timestamp_ntz")


def instant_literal(text: str) -> Column:
    """TO_TIMESTAMP_TZ('ISO with offset') folded to UTC wall time (F8)."""
    local = F.to_timestamp(F.lit(text)).cast("timestamp_ntz")
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), local)


def hour_start(ts) -> Column:
    """DATE_TRUNC('hour', ts) kept as NTZ."""
    return F.date_trunc("hour", as_col(ts)).cast("timestamp_ntz")


def day_of(ts) -> Column:
    """CAST(ts AS DATE) (F1)."""
    return F.to_date(as_col(ts))
