"""wattline: power-meter energy analytics on Spark DataFrames.

Readings (kW, irregular cadence) are integrated into an energy ledger with a
sign-aware trapezoid rule, gaps are filled from same-time-of-day profiles of
the committed ledger, and the ledger is rolled up, aligned and checked. Every
operator is a DataFrame -> DataFrame function; nothing iterates rows on the
driver.
"""

__version__ = "0.1.0"
