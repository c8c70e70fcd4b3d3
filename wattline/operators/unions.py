"""Tagged unions of run histories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.operators.filters import tagged

RUN_COLUMNS = ["name", "state", "scheduled_time", "error_message"]


def tagged_union(parts: dict[str, DataFrame], all_columns: bool = False, ordered: bool = True) -> DataFrame:
    """``'tag' AS task`` + the run columns (or all columns) of each
    part, UNION ALL by name, in the order of the scheduled time."""
    out = None
    for tag, df in parts.items():
        cols = df.columns if all_columns else RUN_COLUMNS
        t = tagged(df.select(*cols), tag)
        out = t if out is None else out.unionByName(t, allowMissingColumns=all_columns)
    return out.orderBy("scheduled_time") if ordered else out


def run_log_from_events(events: DataFrame, types: tuple[str, ...]) -> DataFrame:
    """Fixture: a run history (name, state, scheduled_time, error_message,
    query_id) made of the events of the given types."""
    et = F.col("event_type")
    return (events.filter(et.isin(*types))
            .select(F.upper(et).alias("name"),
                    F.when(et == "error", F.lit("FAILED")).otherwise(F.lit("SUCCEEDED")).alias("state"),
                    F.col("ts").alias("scheduled_time"),
                    F.when(et == "error", F.col("props")).alias("error_message"),
                    F.col("event_id").alias("query_id")))
