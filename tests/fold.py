"""Plain-Python sequential integrator used only as a test oracle.

It follows the documented semantics row by row (the way a single-threaded
job would), so the Spark plan can be compared against it on small series.
"""

from __future__ import annotations

import math
from datetime import datetime, timedelta


def _tod(ts):
    return ((ts.hour * 60 + ts.minute) * 60 + ts.second) * 1_000_000 + ts.microsecond


def band_profile(ledger, a, b):
    """ledger: list of (ts, cum). Mean over days of cum(last<=b)-cum(first>=a)."""
    days = {}
    for ts, cum in ledger:
        t = _tod(ts)
        if a <= t <= b:
            d = ts.date()
            lo, hi = days.get(d, (None, None))
            if lo is None or (ts, cum) < lo:
                lo = (ts, cum)
            if hi is None or (ts, cum) > hi:
                hi = (ts, cum)
            days[d] = (lo, hi)
    if not days:
        return None
    return sum(hi[1] - lo[1] for lo, hi in days.values()) / len(days)


class Fold:
    """State of one series and the rows it has emitted.

    ``step`` takes one reading; ``profile`` holds the ledger rows (ts, sum)
    that gaps are filled from.
    """

    def __init__(self, spec, start=None, profile=()):
        self.spec, self.profile, self.out = spec, list(profile), []
        self.at, self.value, self.total = start or (None, 0.0, 0.0)

    def counted(self, value):
        return min(value, 0.0) if self.spec.clamp == "negative" else max(value, 0.0)

    def step(self, ts, value):
        spec, value = self.spec, 0.0 if value is None else float(value)
        if self.at is None:
            self.at = ts - timedelta(milliseconds=spec.seed_step_ms)
            if spec.first_row == "drop":
                return
        seconds = (ts - self.at).total_seconds()
        if spec.gap_fill and seconds * 1000 > 2 * spec.step_ms:
            self.fill(ts, seconds)
            return
        energy = spec.factor * (seconds / 3600) * (self.counted(value) + self.counted(self.value))
        self.total += energy
        self.out.append((ts, self.total, energy, seconds, value))
        self.at, self.value = ts, value

    def fill(self, ts, seconds):
        spec, (a, b) = self.spec, (_tod(self.at), _tod(ts))
        energy = band_profile(self.profile, a, b) if a <= b else None
        self.value, begin = 0.0, self.at
        if energy is None and spec.empty_profile == "skip":
            self.at = ts + timedelta(milliseconds=spec.skip_shift_ms)
            return
        ratio = seconds * 1000 / spec.step_ms
        slots = math.ceil(round(ratio, 9)) if spec.slots == "lt" else math.floor(round(ratio, 9)) + 1
        for k in range(1, slots + 1):
            self.total += (energy or 0.0) / ratio
            self.out.append((begin + timedelta(milliseconds=k * spec.step_ms), self.total, (energy or 0.0) / ratio,
                             spec.step_ms / 1000, 0.0))
        self.at = ts


def _in_order(rows, spec):
    rows = sorted(rows, key=lambda r: (r[0], r[1] or 0.0))
    return [r for r in rows if not spec.cutoff or r[0] >= datetime.fromisoformat(spec.cutoff)]


def integrate(rows, ledger, spec):
    """rows: list of (ts, value) for one series; ledger: list of ledger tuples
    (ts, cum, integral, delta, value). Returns ledger tuples."""
    newest = max(ledger, key=lambda r: (r[0], r[1])) if ledger else None
    f = Fold(spec, newest and (newest[0], newest[4], newest[1] or 0.0), [(r[0], r[1]) for r in ledger or []])
    for ts, value in _in_order(rows, spec):
        f.step(ts, value)
    return f.out


def integrate_days(rows, spec):
    """As integrate() without a ledger, day by day: what a day emits joins the
    profile of the days after it."""
    f, day = Fold(spec), None
    for ts, value in _in_order(rows, spec):
        if ts.date() != day:
            f.profile, day = [(r[0], r[1]) for r in f.out], ts.date()
        f.step(ts, value)
    return f.out
