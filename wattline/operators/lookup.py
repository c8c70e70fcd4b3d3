"""Top-k style lookups (O1-O4). A global ORDER BY ... LIMIT k plans as
TakeOrderedAndProject: every task keeps its own top k, the driver merges
k x tasks rows, nothing else moves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.functions.timefns import day_of, epoch_millis


def latest_row(ledger: DataFrame) -> DataFrame:
    """Newest ledger row as (ts, value, cumulative_sum)."""
    return (ledger.orderBy(F.col("ts").desc(), F.col("cumulative_sum").desc()).limit(1)
            .select("ts", "value",
                    F.coalesce("cumulative_sum", F.lit(0.0)).alias("cumulative_sum")))


def latest_n(df: DataFrame, n: int = 10, by: str = "id") -> DataFrame:
    """O2: the n rows with the greatest ``by``."""
    return df.orderBy(F.col(by).desc()).limit(n)


def nearest_to_instant(df: DataFrame, instant: Column, window_ms: int) -> DataFrame:
    """O3: row closest to ``instant`` within +-window (pruned by a ts range
    the scan can push down), ties to the earlier row."""
    lo = F.timestamp_add("MILLISECOND", F.lit(-window_ms), instant)
    hi = F.timestamp_add("MILLISECOND", F.lit(window_ms), instant)
    dist = F.abs(epoch_millis("ts") - epoch_millis(instant))
    return (df.filter((F.col("ts") >= lo) & (F.col("ts") <= hi))
            .orderBy(dist, F.col("ts")).limit(1))


def ledger_ordered(ledger: DataFrame) -> DataFrame:
    """The ledger series extract ordered by time (range-partitioned
    global sort; only at the reading edge)."""
    return (ledger.select("ts", "cumulative_sum", "integral", "value",
                          day_of("ts").alias("date_only"))
            .orderBy("ts"))
