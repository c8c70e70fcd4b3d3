"""Ordered-series primitives that never funnel a large series into one task.

A global ``lag`` or running ``sum`` over an un-keyed series would plan as an
``Exchange SinglePartition``. Here series of more than ROWS rows are cut into
buckets of about ROWS rows (``bucketed``): equi-depth splitters from a quantile
sketch of each such series, so the cuts follow the data, whatever the rate. A
series under the bound is one bucket. Windows run per (series, bucket); the
few values that cross a bucket edge travel through a per-bucket summary (one
row per bucket), the only thing ordered across buckets. Where no series is cut,
which one count tells, there is no summary and no join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.plans.materialize import cut

BKT = "_bkt"
#: Rows of a bucket, about: what one task sorts.
ROWS = 1 << 20


class Cuts:
    """How the series of a table are cut: the splitters of those over the bound, or none."""

    def __init__(self, part: Sequence[str], table: DataFrame | None = None):
        self.part, self.table = list(part), table

    @property
    def many(self) -> bool:
        return self.table is not None

    def bucket(self, df: DataFrame, by: Column) -> DataFrame:
        """df with BKT, the number of splitters of the row's series up to ``by``.

        Splitters are looked up in two steps of about their square root. Their table is
        broadcast: it has a row per cut series and a long per bucket, total rows / ROWS.
        """
        if self.table is None:
            return df.withColumn(BKT, F.lit(0).cast("bigint"))
        df = df.withColumn("_by", by).join(F.broadcast(self.table), self.part, "left")
        block = F.size(F.filter("_heads", lambda h: h <= F.col("_by")))
        fine = F.slice("_split", (block - 1) * F.col("_width") + 1, F.col("_width"))
        n = (block - 1) * F.col("_width") + F.size(F.filter(fine, lambda s: s <= F.col("_by")))
        return df.withColumn(BKT, F.when(F.col("_split").isNull() | (block <= 0), 0).otherwise(n).cast("bigint")) \
            .drop("_by", "_split", "_heads", "_width")


def cuts(df: DataFrame, part: Sequence[str], by: Column, rows: int | None = None,
         counts: DataFrame | None = None) -> Cuts:
    """Splitters of ``by`` (a long in the order of the series) for the series of df over the bound.

    ``counts`` (part, n) spares the count, if the caller has it.
    """
    rows = rows or ROWS
    part = list(part)
    if counts is None:
        counts = df.groupBy(*part).agg(F.count(F.lit(1)).alias("n"))
    large = counts.where(F.col("n") > rows).select(*part, F.ceil(F.col("n") / rows).cast("int").alias("_p"))
    most = large.agg(F.max("_p")).first()[0]
    if most is None:
        return Cuts(part)
    fine = 4 * most                                 # so that smaller series find their quantiles, too
    grid = [i / fine for i in range(1, fine)]
    own = df.select(*part, by.alias("_by")).join(F.broadcast(large), part)
    sketch = own.groupBy(*part, "_p").agg(F.percentile_approx("_by", grid, 5 * fine).alias("_q"))
    # a smaller series takes its own share of the grid's quantiles
    chosen = F.transform(F.sequence(F.lit(1), F.greatest(F.col("_p") - 1, F.lit(1))), lambda i: F.get(
        "_q", F.least(F.greatest(F.round(i * F.lit(fine) / F.col("_p")).cast("int") - 1, F.lit(0)), F.size("_q") - 1)))
    table = sketch.select(*part, F.array_sort(F.array_distinct(chosen)).alias("_split")) \
        .withColumn("_width", F.ceil(F.sqrt(F.size("_split"))).cast("int")) \
        .withColumn("_heads", F.transform(F.sequence(F.lit(0), F.floor((F.size("_split") - 1) / F.col("_width")).cast("int")),
                                          lambda c: F.get("_split", c * F.col("_width"))))
    return Cuts(part, cut(table))


def bucketed(df: DataFrame, part: Sequence[str], by: Column, rows: int | None = None) -> tuple[DataFrame, bool]:
    """df with BKT, partitioned by (part, BKT), and whether any series has several buckets."""
    found = cuts(df, part, by, rows)
    return partition_by_bucket(found.bucket(df, by), part), found.many


def partition_by_bucket(df: DataFrame, part: Sequence[str]) -> DataFrame:
    """Hash-partition once on (series, bucket); later windows, aggregates and
    joins on these columns reuse this exchange."""
    return df.repartition(*part, BKT)


def halo_rows(tail: DataFrame, part: Sequence[str], order: Sequence[str], cols: Sequence[str], depth: int) -> DataFrame:
    """Per (part, BKT) the ``depth`` rows before the bucket as structs ``_h1``.. (nearest first).

    ``tail`` has the last ``depth`` rows of every bucket; a bucket may be shorter than that.
    """
    ws = Window.partitionBy(*part).orderBy(BKT, *order)
    rec = F.struct(*[F.col(c) for c in cols])
    # the earliest tail row of each bucket (its predecessor in the tail table
    # lies in another bucket) carries the rows before the bucket
    return (tail.select(
        *part, BKT, F.lag(BKT).over(ws).alias("_pb"),
        *[F.lag(rec, d).over(ws).alias(f"_h{d}") for d in range(1, depth + 1)])
        .filter(F.col("_pb").isNull() | (F.col("_pb") != F.col(BKT)))
        .drop("_pb"))


def halo_lags(df: DataFrame, part: Sequence[str], order: Sequence[str],
              cols: Sequence[str], depth: int = 2, many: bool = True) -> DataFrame:
    """Add ``_p{d}_{c}``: column ``c`` of the row ``d`` places earlier in the
    series (order ``order``, ascending), for d = 1..depth, across buckets.

    The last ``depth`` rows of every bucket form a small table; lagging over it
    gives, for each bucket, the ``depth`` rows that precede its first row.
    """
    P = [*part, BKT]
    w = Window.partitionBy(*P).orderBy(*order)
    if not many:
        return df.withColumns({f"_p{d}_{c}": F.lag(c, d).over(w) for c in cols for d in range(1, depth + 1)})
    w_desc = Window.partitionBy(*P).orderBy(*[F.col(o).desc() for o in order])
    keep = list(dict.fromkeys([*order, *cols]))
    tail = (df.select(*P, *keep)
            .withColumn("_rd", F.row_number().over(w_desc))
            .filter(F.col("_rd") <= depth))
    out = df.join(halo_rows(tail, part, order, cols, depth), P, "left")
    rn = F.row_number().over(w)
    lags = {}
    for c in cols:
        for d in range(1, depth + 1):
            expr = F.lag(c, d).over(w)
            for r in range(d, 0, -1):
                # rows 1..d of the bucket reach back into the halo
                expr = F.when(rn == r, F.col(f"_h{d - r + 1}")[c]).otherwise(expr)
            lags[f"_p{d}_{c}"] = expr
    return out.withColumns(lags).drop(*[f"_h{d}" for d in range(1, depth + 1)])


def running_sum(df: DataFrame, part: Sequence[str], order: Sequence[str],
                value: str, out: str, many: bool = True) -> DataFrame:
    """``out`` = sum of ``value`` over all earlier rows of the series and this
    one. Two-phase: per-bucket totals -> exclusive prefix over the small
    bucket table -> joined back and added to the in-bucket running sum."""
    P = [*part, BKT]
    w = (Window.partitionBy(*P).orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    if not many:
        return df.withColumn(out, F.sum(value).over(w))
    totals = df.groupBy(*P).agg(F.sum(value).alias("_t"))
    ws = (Window.partitionBy(*part).orderBy(BKT)
          .rowsBetween(Window.unboundedPreceding, -1))
    prefix = totals.select(*P, F.coalesce(F.sum("_t").over(ws), F.lit(0.0)).alias("_pre"))
    return (df.join(prefix, P, "left")
            .withColumn(out, F.col("_pre") + F.sum(value).over(w))
            .drop("_pre"))


def first_in_group(df: DataFrame, group: Sequence[str], order: Sequence[Column | str],
                   cols: Sequence[str], prefix: str = "first_") -> DataFrame:
    """Per group, the columns of the earliest row (``min_by`` over a struct),
    a partial/final hash aggregate, no sort of the detail rows."""
    ordk = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    rec = F.struct(*[F.col(c) for c in cols])
    agg = df.groupBy(*group).agg(F.min_by(rec, ordk).alias("_r"))
    return agg.select(*group, *[F.col("_r")[c].alias(prefix + c) for c in cols])


def last_in_group(df: DataFrame, group: Sequence[str], order: Sequence[Column | str],
                  cols: Sequence[str], prefix: str = "last_") -> DataFrame:
    ordk = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    rec = F.struct(*[F.col(c) for c in cols])
    agg = df.groupBy(*group).agg(F.max_by(rec, ordk).alias("_r"))
    return agg.select(*group, *[F.col("_r")[c].alias(prefix + c) for c in cols])


def running_max(df: DataFrame, part: Sequence[str], order: Sequence[str | Column],
                value: str, out: str, many: bool = True, back: bool = False) -> DataFrame:
    """``out`` = max of ``value`` (NULLs ignored; any orderable type, e.g. a
    struct led by the order key = "last non-null") over all earlier rows of
    the series and this one, stitched across buckets like running_sum. With
    ``back`` later buckets count as earlier (``order`` is the caller's)."""
    P = [*part, BKT]
    w = (Window.partitionBy(*P).orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    if not many:
        return df.withColumn(out, F.max(value).over(w))
    tops = df.groupBy(*P).agg(F.max(value).alias("_m"))
    ws = (Window.partitionBy(*part).orderBy(F.col(BKT).desc() if back else F.col(BKT))
          .rowsBetween(Window.unboundedPreceding, -1))
    prefix = tops.select(*P, F.max("_m").over(ws).alias("_pm"))
    return (df.join(prefix, P, "left")
            .withColumn(out, F.greatest(F.col("_pm"), F.max(value).over(w)))
            .drop("_pm"))


def few(df: DataFrame) -> DataFrame:
    """A join's small side, counted first: written, and broadcast if its rows are few."""
    df = cut(df)
    return small(df, df.count())


def small(df: DataFrame, rows: int) -> DataFrame:
    """A written or counted table as a join's small side: broadcast if its counted rows are few."""
    return F.broadcast(df) if rows <= SMALL else df


#: Rows of a table that may be broadcast, after counting them.
SMALL = 200_000
