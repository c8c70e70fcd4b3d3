"""Mixing sources to target weights by Sainte-Lague apportionment.

Targets share the corpus's words by weight; none exceeds REPEAT times its
source, the excess going to the others by weight. The mix is made of blocks of
``block`` words, and each shard's blocks go to sources by the highest
quotients target / (2k + 1), ties to the earlier source: integer quotas for
every shard, as the apportionment of a prefix never shrinks.

The quotas come in closed form: every award with a quotient over a safe
divisor is counted by rounding, and only the last few awards of a shard, in
proportion to the number of sources, are ranked.

Block selection: a source's documents lie end to end in a seeded order (md5 of
seed and doc_id, without one of the text, then doc_id, then size), cut into blocks of ``block`` words
regardless of document ends; the source's quota is taken from the front,
starting over when it is used up. The blocks go to the shards in that order,
as many as the shard's quota for the source. Positions are prefix sums per (source, hash
prefix), so a source with a third of all rows spreads over many tasks.

Nulls: a null source is a source, last in order; a null or empty text has size
zero and is never taken from. Repeated rows count each. Rows of equal doc_id
and size are interchangeable. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattline.llm.common import WORD, cut, table

BLOCK = 16
SEED = 42
REPEAT = 3
WEIGHTS = (1, 2, 3)
SHARDS = 8
#: Rows of a source's hash prefix, about.
CELL = 20_000


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeat: int = REPEAT) -> DataFrame:
    """sources (src, source, source_size) with rank, weight and target.

    One row per source; the loop below reads three sums a round and ends when
    no further source reaches its cap.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))  # one row per source
    ranked = cut(sources.withColumn("rank", rank).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("rank") - 1, len(weights)) + 1).cast("int"))),
        "mix-sources")
    total, cap = ranked.agg(F.sum("source_size")).first()[0] or 0, repeat * F.col("source_size")
    level, held = 0.0, -1
    while True:
        above = cap < F.col("weight") * F.lit(level)
        capped, weight, n = ranked.agg(
            F.sum(F.when(above, cap).otherwise(0)), F.sum(F.when(above, 0).otherwise(F.col("weight"))),
            F.count_if(above)).first()
        if n == held or not weight:
            break
        held, level = n, float(total - capped) / float(weight)
    target = F.least(cap.cast("double"), F.col("weight") * F.lit(level))
    return ranked.withColumn("target", target)


def quotas(targets: DataFrame, blocks: int, shards: int) -> DataFrame:
    """(rank, shard, upto): blocks awarded to the source in shards 1 to ``shard``."""
    n_sources, weight = targets.agg(F.count("*"), F.sum("target")).first()
    if not weight:
        return targets.select("rank", F.explode(F.sequence(F.lit(1), F.lit(shards))).alias("shard")).withColumn(
            "upto", F.lit(0).cast("long"))
    seats = targets.select("rank", "target", F.explode(F.sequence(F.lit(1), F.lit(shards))).alias("shard")) \
        .withColumn("n", F.floor(F.lit(blocks) * F.col("shard") / shards)) \
        .withColumn("sure", F.floor(F.col("target") * F.greatest(F.col("n") - n_sources, F.lit(0)) / weight + 0.5))
    shard = Window.partitionBy("shard")
    seats = seats.withColumn("open", F.col("n") - F.sum("sure").over(shard))
    extra = F.ceil((F.col("open") + n_sources) * F.col("target") / weight) + 2
    last = seats.where("open > 0 and target > 0").select(
        "rank", "shard", "open", "target", F.explode(F.sequence(F.col("sure"), F.col("sure") + extra)).alias("k")) \
        .withColumn("place", F.row_number().over(shard.orderBy((F.col("target") / (2 * F.col("k") + 1)).desc(), "rank"))) \
        .where("place <= open").groupBy("rank", "shard").agg(F.count("*").alias("more"))
    return seats.join(last, ["rank", "shard"], "left").select(
        "rank", "shard", (F.col("sure") + F.coalesce("more", F.lit(0))).alias("upto"))


def mix(docs: DataFrame, block: int = BLOCK, seed: int = SEED, weights: tuple[int, ...] = WEIGHTS,
        repeat: int = REPEAT, shards: int = SHARDS, carry: list[str] | None = None) -> DataFrame:
    """(doc, size, source_size, target, pos, used, taken, by_shard): a row for each row of docs.

    ``doc`` is a struct of the carried columns (all unless named); ``pos`` is
    the word at which the document starts in its source's seeded order,
    ``used`` the words the mix takes of the source and ``taken`` of the
    document, repeats counted; ``by_shard`` splits ``taken`` by shard, from
    the first shard on.
    """
    wide = docs.select(
        F.struct(*(carry or docs.columns)).alias("doc"), F.col("doc_id").alias("_id"), F.col("source").alias("source"),
        F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("-")).alias("src"),
        F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.concat(
            F.lit("-"), F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))))))).alias("at"))
    narrow = cut(wide if carry else wide.drop("doc"), "mix-sizes")
    sources = targets(narrow.groupBy("src").agg(
        F.first("source").alias("source"), F.sum("size").alias("source_size"), F.count("*").alias("rows")),
        weights, repeat)
    total, most = sources.agg(F.sum("source_size"), F.max("rows")).first()
    quota = quotas(sources, -(-(total or 0) // block), shards).groupBy("rank").agg(
        F.sort_array(F.collect_list(F.struct("shard", "upto"))).alias("q"), F.max("upto").alias("upto"))
    most_of = repeat * F.col("source_size")
    used = sources.join(quota, "rank").select(
        "src", "source_size", "target", F.least(F.col("upto") * block, most_of).alias("used"),
        F.transform("q", lambda x: F.least(x["upto"] * block, most_of)).alias("_upto"))

    digits = 1
    while 16 ** digits * CELL < (most or 0):
        digits += 1
    key = F.substring("at", 1, digits)
    cells = narrow.groupBy("src", key.alias("cell")).agg(F.sum("size").alias("words"))
    before = Window.partitionBy("src").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("start", F.coalesce(F.sum("words").over(before), F.lit(0))) \
        .join(used, "src").select("src", "cell", "start", "source_size", "target", "used", "_upto")
    inside = Window.partitionBy("src", "cell").orderBy("at", "_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    rows = (narrow if carry else wide).withColumn("cell", key) \
        .withColumn("_run", F.sum("size").over(inside)).join(cells, ["src", "cell"]) \
        .withColumn("pos", F.col("start") + F.col("_run") - F.col("size"))

    def taken(used):
        turns = F.when(F.col("source_size") > 0, F.floor(used / F.col("source_size"))).otherwise(F.lit(0))
        rest = F.least(F.greatest(used - turns * F.col("source_size") - F.col("pos"), F.lit(0)), F.col("size"))
        return (turns * F.col("size") + rest).cast("long")
    by_shard = F.transform("_upto", lambda u, i: taken(u) - F.when(i > 0, taken(F.get("_upto", i - 1))).otherwise(F.lit(0)))
    return rows.select("doc", "size", "source_size", "target", "pos", "used", taken(F.col("used")).alias("taken"),
                       by_shard.alias("by_shard"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as whole documents: each as often as the mix takes it, rounded.

    A document cut by the end of its source's share counts as whole if more
    than half of it is taken. Documents without words stay, once. The rows are
    dealt to shards by the stage that follows, not by ``by_shard``: a document may lie in the blocks of
    several shards, and here it stays whole.
    """
    m = mix(docs, **options)
    copies = F.when(F.col("size") > 0, F.floor((2 * F.col("taken") + F.col("size") - 1) / (2 * F.col("size")))) \
        .otherwise(F.lit(1)).cast("int")
    return m.withColumn("_n", copies).where("_n > 0").select(
        F.explode(F.array_repeat("doc", F.col("_n"))).alias("doc")).select("doc.*").select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the words taken of each document for each shard, comma-joined."""
    return mix(table(spark, sf_dir, "documents"), carry=["doc_id"]).select(
        "doc.doc_id", "size", "source_size", "target", "taken", F.array_join(F.transform("by_shard", lambda n: n.cast("string")), ",").alias("shard_words"))


#: The same rows in DuckDB: the cap by sorted ratios, all awards ranked at once.
def _taken(used: str) -> str:
    return (f"CASE WHEN source_size = 0 THEN 0 ELSE {used} // source_size * size "
            f"+ least(greatest({used} % source_size - pos, 0), size) END")


SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         md5('42:' || coalesce(CAST(doc_id AS VARCHAR), '-' || md5(coalesce(text, '')))) AS ord
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source ASC NULLS LAST) AS rank FROM d GROUP BY source),
w AS (SELECT *, CAST((rank - 1) % 3 + 1 AS BIGINT) AS weight FROM s),
r AS (
  SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS all_w,
         coalesce(sum(3 * source_size) OVER o, 0) AS cap_before, coalesce(sum(weight) OVER o, 0) AS w_before
  FROM w WINDOW o AS (ORDER BY 3.0 * source_size / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (
  SELECT first(CAST(total - cap_before AS DOUBLE) / CAST(all_w - w_before AS DOUBLE)
               ORDER BY 3.0 * source_size / weight, rank) AS level FROM r
  WHERE 3 * source_size >= weight * (CAST(total - cap_before AS DOUBLE) / CAST(all_w - w_before AS DOUBLE))),
t AS (
  SELECT source, rank, source_size, total, least(CAST(3 * source_size AS DOUBLE), weight * level) AS target FROM r, l),
a AS (
  SELECT rank, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, rank) AS place, ceil(total / 16.0) AS blocks
  FROM (SELECT *, unnest(generate_series(0, CAST(target / 16 + 3 AS BIGINT))) AS k FROM t WHERE target > 0)),
q AS (SELECT rank, <upto> FROM a GROUP BY rank),
u AS (SELECT t.*, <used> FROM t LEFT JOIN q USING (rank)),
p AS (
  SELECT doc_id, source, size,
         sum(size) OVER (PARTITION BY source ORDER BY ord, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS pos FROM d)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(<all> AS BIGINT) AS taken, <shared> AS shard_words
FROM p JOIN u ON p.source IS NOT DISTINCT FROM u.source
"""


def _filled(sql: str) -> str:
    """The SQL with its columns by shard."""
    every = range(1, SHARDS + 1)
    for name, text in {
            "<upto>": ", ".join(f"count(*) FILTER (place <= floor(blocks * {i} / {SHARDS})) * 16 AS w{i}" for i in every),
            "<used>": ", ".join(f"least(coalesce(w{i}, 0), 3 * source_size) AS u{i}" for i in every),
            "<all>": _taken(f"u{SHARDS}"),
            "<shared>": " || ',' || ".join(
                f"CAST({_taken(f'u{i}')}{f' - ({_taken(f'u{i - 1}')})' if i > 1 else ''} AS BIGINT)" for i in every)}.items():
        sql = sql.replace(name, text)
    return sql


SQL = _filled(SQL)
