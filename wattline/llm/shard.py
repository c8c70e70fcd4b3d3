"""Sharding by sampled splitters: near equal bytes, equal texts together.

Records are ordered by (hash of the text, hash of the doc_id). A size-weighted
sample of the keys gives quantile boundaries that range-partition the records.
The exact size of every range is then measured; a range over OVERFULL times
the mean is subdivided, by the key inside the range or, where one text fills
it, by the doc_id hash. Sizes run up along the ranges, and the shard of a text
is the one in which its middle byte falls; only a text whose copies exceed
GROUP of a shard is spread over several, copy by copy.

Every step is a DataFrame operation. The sample is bounded by its expected
size, the ranges by RANGES; no range is gathered beyond its own sort.

Sizes are the UTF-8 bytes of the text (null: none) plus one, so null and empty
texts take part; text_crc32 of a null text is that of an empty one, 0. A null
doc_id sorts first. Repeated rows get slots of their own. An empty table gives
an empty result. The columns of the input travel in a struct, so no name clashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattline.llm.common import cut, table

#: Ranges cut by the splitters, a power of two.
RANGES = 1024
#: Expected number of sampled keys for each range.
OVERSAMPLE = 8
#: A range over so many times the mean size is subdivided.
OVERFULL = 2.0
#: Copies of a text stay together up to this share of a shard.
GROUP = 0.05
SEED = 42


def text_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def splitters(keys: DataFrame, total: int, ranges: int = RANGES) -> list[int]:
    """Ascending quantile boundaries of _k from a sample weighted by size.

    A row is drawn with probability min(1, size * sample / total) by a hash of
    its doc_id, so reruns draw alike. A text that holds several quantiles gives
    its key once and the key after it, which fences it into its own range.
    """
    want = ranges * OVERSAMPLE
    p = F.col("size") * (want / max(total, 1))
    u = F.shiftrightunsigned(F.xxhash64("_g", "_k", F.lit(SEED + 1)), 11) / float(1 << 53)
    drawn = keys.where(u < p).select("_k", F.when(p > 1, p).otherwise(F.lit(1.0)).alias("w"))
    per_key = drawn.groupBy("_k").agg(F.sum("w").alias("w")).orderBy("_k").collect()  # about `want` rows
    weight = sum(r.w for r in per_key)
    cuts, run, step = [], 0.0, weight / ranges if weight else 1.0
    for r in per_key:
        before, run = run, run + r.w
        if int(run / step) > int(before / step):
            cuts.append(r["_k"])
            if r.w >= 2 * step:
                cuts.append(r["_k"] + 1)
    return sorted({c for c in cuts if c < 1 << 63})


def range_of(key: Column, cuts: list[int]) -> Column:
    """Number of boundaries at or below the key, by binary search."""
    bits = max(1, len(cuts).bit_length())
    table = F.array(*(F.lit(c) for c in cuts)) if cuts else F.array(F.lit((1 << 63) - 1))
    n = len(cuts)

    def step(acc, j):
        nxt = acc + j
        return F.when((nxt <= n) & (F.get(table, F.least(nxt, F.lit(n)) - 1) <= key), nxt).otherwise(acc)
    if not cuts:
        return F.lit(0)
    return F.aggregate(F.array(*(F.lit(1 << b) for b in reversed(range(bits)))), F.lit(0), step)


def shard(docs: DataFrame, shards: int = 8, ranges: int = RANGES, group: float = GROUP,
          carry: list[str] | None = None) -> DataFrame:
    """(doc, size, crc, shard, slot): a row for each row of docs.

    ``doc`` is a struct of the carried columns (all of docs unless named), so
    that no name of theirs can clash; shards count from 0 and slots are gapless
    within a shard. Texts move through one shuffle if they are carried, and
    through none otherwise.
    """
    text = F.col("text").cast("string")
    wide = docs.select(
        F.struct(*(carry or docs.columns)).alias("doc"), F.col("doc_id").alias("_id"), text_size(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("crc"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("_k"), F.xxhash64("doc_id").alias("_g"))
    narrow = cut(wide if carry else wide.drop("doc"), "shard-keys")
    total = narrow.agg(F.sum("size")).first()[0] or 0
    cuts = splitters(narrow, total, ranges)
    mean = max(total / ranges, 1.0)
    rid = range_of(F.col("_k"), cuts)

    # exact sizes of the ranges, and the pieces that an overfull one is cut into
    sized = narrow.withColumn("_r", rid).groupBy("_r").agg(
        F.sum("size").alias("b"), F.min("_k").alias("_lo"), F.max("_k").alias("_hi"))
    full = sized.where(F.col("b") > OVERFULL * mean).select(
        "_r", F.ceil(F.col("b") / mean).alias("_pieces"), "_lo", "_hi")
    full = F.broadcast(cut(full, "shard-full"))  # at most RANGES / OVERFULL rows
    low, high = F.col("_lo").cast("double"), F.col("_hi").cast("double")
    share = F.when(F.col("_lo") == F.col("_hi"), (F.col("_g").cast("double") + 2.0 ** 63) / 2.0 ** 64) \
        .otherwise((F.col("_k").cast("double") - low) / (high - low + 1))
    piece = F.least(F.floor(share * F.col("_pieces")), F.col("_pieces") - 1)

    def placed(df: DataFrame) -> DataFrame:
        return df.withColumn("_r", rid).join(full, "_r", "left").withColumn(
            "_p", F.coalesce(piece, F.lit(0)).cast("long")).drop("_pieces", "_lo", "_hi")

    cells = placed(narrow).groupBy("_r", "_p").agg(
        F.sum("size").alias("b"), F.count("*").alias("n"), F.min("_k").alias("_lo"), F.max("_k").alias("_hi"))
    # at most RANGES plus the pieces of overfull ranges: a few thousand rows
    along = Window.orderBy("_r", "_p").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("_r", "_p", "b", "_lo", "_hi", F.coalesce(F.sum("b").over(along), F.lit(0)).alias("_b0"),
                         F.coalesce(F.sum("n").over(along), F.lit(0)).alias("_n0"))
    # a text that fills its range is measured over all pieces; any other lies in one piece
    pieces = Window.partitionBy("_r")
    fills = F.min("_lo").over(pieces) == F.max("_hi").over(pieces)
    cells = F.broadcast(cut(cells.select(
        "_r", "_p", "_b0", "_n0", F.when(fills, F.sum("b").over(pieces)).alias("_tb"),
        F.when(fills, F.min("_b0").over(pieces)).alias("_t0")), "shard-cells"))

    cell = Window.partitionBy("_r", "_p").orderBy("_k", "_g", "_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    same = Window.partitionBy("_r", "_p", "_k")
    copies = F.coalesce("_tb", "_gb")
    before = F.coalesce(F.col("_t0"), F.col("_b0") + F.col("_ge") - F.col("_gb"))
    middle = F.when(copies <= group * total / shards, before + copies / 2) \
        .otherwise(F.col("_b0") + F.col("_end") - F.col("size") / 2)

    def dealt(df: DataFrame) -> DataFrame:
        df = placed(df).join(cells, ["_r", "_p"]) \
            .withColumn("_end", F.sum("size").over(cell)).withColumn("_row", F.count("*").over(cell)) \
            .withColumn("_gb", F.sum("size").over(same)).withColumn("_ge", F.max("_end").over(same))
        return df.withColumn("shard", F.least(F.floor(middle * shards / max(total, 1)), F.lit(shards - 1)).cast("int")) \
            .withColumn("_at", F.col("_n0") + F.col("_row") - 1)

    rows = cut(dealt(narrow).select(*(["doc", "size", "crc"] if carry else []), "shard", "_at"), "shards")
    first = cut(rows.groupBy("shard").agg(F.min("_at").alias("_first")), "shard-first")  # a row for each shard
    if not carry:
        rows = dealt(wide)
    return rows.join(F.broadcast(first), "shard") \
        .select("doc", "size", "crc", "shard", (F.col("_at") - F.col("_first")).alias("slot"))


def digest(sharded: DataFrame) -> DataFrame:
    return sharded.select(
        "doc.doc_id", "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(shard(table(spark, sf_dir, "documents"), carry=["doc_id"]))
