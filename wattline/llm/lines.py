"""Line dedup across documents: fuzzy lines by MinHash.

Equal lines collapse first, by a 64-bit hash; lines of different texts that
share one by chance are found by a second hash and all stay. Every distinct
line gets MinHash values over its shingles of SHINGLE characters (lower case,
white space runs as one space); BANDS bands of ROWS values bring pairs of
similarity 0.8 together with probability 0.998. Band keys are sorted across
the cluster, and the lines of equal keys stream past as buckets; equal buckets,
which near-copies make in most bands, count once. Inside a bucket the exact
Jaccard similarity of the shingle sets (as 64-bit hashes) decides on every pair;
a bucket over TILE lines is cut into chunks that meet pairwise in separate
tasks. Verified links go through distributed union-find, and of each component
the line with the smallest (doc_id, line number) stays.

The distinct lines are written bucketed by their hash, so their texts are not
shuffled again when the buckets' members are joined to them.

Lines without a character other than white space always stay. A line shorter
than a shingle is one shingle. Null texts have no lines, an empty text one
blank line. Rows of equal doc_id and text are one document; a null doc_id
sorts first. An empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm.common import components, cut, shared_dir, table, whole_groups
from wattline.llm.decontaminate import codes_of, grams, normal
from wattline.llm.simhash import spanning

SHINGLE = 8
BANDS, ROWS = 12, 4
SIMILARITY = 0.8
TILE = 256
#: Groups of fewer lines compare sets; larger ones multiply matrices of so many columns.
FEW, COLUMNS = 8, 1 << 13
#: Shingles hashed at once.
CHUNK = 1 << 16
SEED = 42


def shingles(line: str, width: int = SHINGLE) -> frozenset[str]:
    t = normal(line)
    return frozenset(t[i:i + width] for i in range(max(1, len(t) - width + 1)))


def shingle_hashes(lines: list[str], width: int = SHINGLE) -> list[np.ndarray]:
    """The hashes (64 bits) of the shingles of every line, repeats included."""
    texts = [normal(x).ljust(width, "\x00") for x in lines]
    h = grams(codes_of("".join(texts)), width)
    ends = np.cumsum([len(t) for t in texts])
    return [h[e - len(t):e - width + 1] for e, t in zip(ends.tolist(), texts, strict=True)]


def band_keys(lines: list[str], bands: int = BANDS, rows: int = ROWS, width: int = SHINGLE) -> np.ndarray:
    """(lines, bands) keys: equal in a band if all its MinHash values are."""
    rng = np.random.default_rng(SEED)
    factors = rng.integers(1, 1 << 31, bands * rows, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    masks = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint32)
    out = np.empty((len(lines), bands * rows), np.uint32)
    at = 0
    while at < len(lines):
        part, n = [], 0
        while at + len(part) < len(lines) and (not part or n < CHUNK):
            part.append(normal(lines[at + len(part)]).ljust(width, "\x00"))
            n += len(part[-1])
        size = np.array([len(p) for p in part])
        h = grams(codes_of("".join(part)), width)
        first = np.cumsum(size) - size
        count = size - width + 1
        # the grams that run over the end of a line are left out
        inside = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        x = (h[inside] >> np.uint64(32)).astype(np.uint32)
        starts = np.cumsum(count) - count
        y = np.empty_like(x)
        for k, (f, m) in enumerate(zip(factors, masks, strict=True)):
            np.bitwise_xor(x, m, out=y)
            np.multiply(y, f, out=y)
            out[at:at + len(part), k] = np.minimum.reduceat(y, starts)
        at += len(part)
    keys = np.zeros((len(lines), bands), np.uint64)
    with np.errstate(over="ignore"):
        for b in range(bands):
            h = np.full(len(lines), b + 1, np.uint64)
            for r in range(rows):
                h = (h ^ out[:, b * rows + r]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            keys[:, b] = h
    return keys.view(np.int64)


def linked(lines: list[str], least: float = SIMILARITY) -> list[tuple[int, int]]:
    """(line, first line of its component) over all pairs of similarity >= least."""
    hashes, n = shingle_hashes(lines), len(lines)
    if n < FEW:
        sets = [frozenset(h.tolist()) for h in hashes]
        pairs = [(i, j) for i in range(n) for j in range(i) if _similar(len(sets[i]), len(sets[j]), least)
                 and _similar_by(len(sets[i] & sets[j]), len(sets[i]), len(sets[j]), least)]
        i, j = np.array(pairs, np.int64).reshape(-1, 2).T
    else:
        line = np.repeat(np.arange(n), [len(h) for h in hashes])
        words, at = np.unique(np.concatenate(hashes), return_inverse=True)
        both, size = np.zeros((n, n), np.float32), np.zeros(n)
        for c in range(0, len(words), COLUMNS):    # shared shingles by a product of incidence matrices
            mine = (at >= c) & (at < c + COLUMNS)
            has = np.zeros((n, min(COLUMNS, len(words) - c)), np.float32)
            has[line[mine], at[mine] - c] = 1
            both += has @ has.T
            size += has.sum(axis=1)
        i, j = np.nonzero(np.tril(_similar_by(both, size[:, None], size[None, :], least), -1))
    label = spanning(n, i, j)
    return [(x, int(label[x])) for x in np.flatnonzero(label != np.arange(n)).tolist()]


def _similar(a, b, least):
    return min(a, b) >= least * max(a, b)


def _similar_by(both, a, b, least):
    return both >= least * (a + b - both)


def occurrences(docs: DataFrame) -> DataFrame:
    """(id, doc_id, line_no, dk, line) of every line that is not blank."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .select("doc_id", F.xxhash64("text").alias("dk"), F.posexplode(F.split("text", "\n")).alias("line_no", "line")) \
        .where(F.col("line").rlike(r"\S")).withColumn("id", F.xxhash64("line"))


def distinct_lines(docs: DataFrame) -> DataFrame:
    """(id, doc_id, line_no, dk, line, clash): the first occurrence of every line."""
    second = F.xxhash64(F.lit(SEED), "line")
    return occurrences(docs).groupBy("id").agg(
        F.min(F.struct("doc_id", "line_no", "dk", "line")).alias("x"), F.min(second).alias("lo"), F.max(second).alias("hi")) \
        .select("id", "x.*", (F.col("lo") != F.col("hi")).alias("clash"))


def bucketed(lines: DataFrame) -> tuple[str, str]:
    """Write the lines bucketed by id in the shared folder: (table, path)."""
    spark = lines.sparkSession
    name = f"wattline_lines_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/{name}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines.write.bucketBy(n, "id").option("path", path).option("compression", "zstd").saveAsTable(name)
    return name, path


def buckets(placed: DataFrame, tile: int) -> DataFrame:
    """(k, c, large, ids) from (k, id): lines of equal k, two at least.

    Rows stream by in the order of k; a bucket of over ``tile`` lines leaves in
    chunks c = 0, 1, ... marked large, so no bucket is held whole.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now, c = np.empty(0, np.int64), None, 0
        out: list[tuple[int, int, bool, np.ndarray]] = []

        def close():
            if c or len(held) > 1:
                out.append((now, c, c > 0, held))

        def batch():
            rows = pa.RecordBatch.from_arrays([
                pa.array([k for k, *_ in out], pa.int64()), pa.array([n for _, n, *_ in out], pa.int64()),
                pa.array([x for *_, x, _ in out], pa.bool_()), pa.array([np.sort(i) for *_, i in out], pa.list_(pa.int64()))],
                ["k", "c", "large", "ids"])
            out.clear()
            return rows
        for b in batches:
            k, ids = b.column(0).to_numpy(), b.column(1).to_numpy()
            if not len(k):
                continue
            start = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
            end = np.append(start[1:], len(k))
            # singles inside the batch go at once; the first and the last may go on outside
            more = (end - start > 1) | (start == 0) | (end == len(k))
            for s, e in zip(start[more].tolist(), end[more].tolist(), strict=True):
                if k[s] != now:
                    close()
                    held, now, c = ids[s:e], int(k[s]), 0
                else:
                    held = np.concatenate([held, ids[s:e]])
                while len(held) > tile:
                    out.append((now, c, True, held[:tile]))
                    held, c = held[tile:], c + 1
            yield batch()
        close()
        yield batch()

    return placed.repartition("k").sortWithinPartitions("k").mapInArrow(run, "k long, c long, large boolean, ids array<long>")


def kept_lines(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, tile: int = TILE) -> DataFrame:
    """(doc_id, dk, kept): numbers of the lines that stay, blank ones aside; dk is a hash of the text."""
    spark = docs.sparkSession
    lines = distinct_lines(docs)
    name, path = bucketed(lines)
    lines = spark.read.schema(lines.schema).parquet(path)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = band_keys(b.column(1).to_pylist(), bands, rows)
            ids = np.repeat(b.column(0).to_numpy(), bands)
            yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)), pa.array(ids)], ["k", "id"])

    placed = lines.where(~F.col("clash")).select("id", "line").mapInArrow(hashed, "k long, id long")
    met = cut(buckets(placed, tile), "line-buckets")
    zero = F.lit(0).cast("long")
    small = met.where(~F.col("large")).groupBy("ids").agg(F.min("k").alias("k")) \
        .select("k", zero.alias("ti"), zero.alias("tj"), F.explode("ids").alias("id"))
    large = met.where(F.col("large"))
    large = large.join(large.groupBy("k").agg(F.max("c").alias("last")), "k") \
        .select("k", "c", "ids", F.explode(F.sequence(zero, F.col("last"))).alias("o")) \
        .select("k", F.least("c", "o").alias("ti"), F.greatest("c", "o").alias("tj"), F.explode("ids").alias("id"))
    by = ["k", "ti", "tj"]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, by):
            keys = np.stack([t.column(c).to_numpy() for c in by])
            start = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)]))
            ids, texts = t.column("id").to_numpy(), t.column("line").to_pylist()
            a, b = [], []
            for s, e in zip(start, np.append(start[1:], len(ids)), strict=True):
                for i, j in linked(texts[s:e]):
                    a.append(ids[s + i])
                    b.append(ids[s + j])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    meeting = spark.table(name).select("id", "line").join(small.unionByName(large), "id") \
        .repartition(*by).sortWithinPartitions(*by)
    roots = components(meeting.mapInArrow(verify, "a long, b long"))
    spark.sql(f"DROP TABLE {name}")                # the files stay
    place = F.struct("doc_id", "line_no", "dk")
    low = lines.where(~F.col("clash")).select("id", place.alias("at")) \
        .join(roots.withColumnRenamed("node", "id"), "id", "left") \
        .groupBy(F.coalesce("root", "id")).agg(F.min("at").alias("at")).select("at.*")
    clash = lines.where("clash").select("id")
    if not clash.isEmpty():
        low = low.unionByName(occurrences(docs).join(clash, "id", "left_semi").select(*low.columns).distinct())
    return low.groupBy("doc_id", "dk").agg(F.sort_array(F.collect_list("line_no")).alias("kept"))


def dedup_lines(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, text, n_lines, kept): documents without the lines that go, one row per document.

    ``n_lines`` counts the lines that are not blank, ``kept`` are the numbers
    of those that stay; ``text`` has them and the blank ones.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .withColumn("dk", F.xxhash64("text"))
    kept = kept_lines(docs, **options)
    rows = texts.withColumn("all", F.split("text", "\n")).join(
        kept.select(F.col("doc_id").alias("d"), F.col("dk").alias("k"), "kept"),
        F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("dk") == F.col("k")), "left") \
        .withColumn("kept", F.coalesce("kept", F.array().cast("array<int>")))
    stays = F.filter("all", lambda line, i: ~line.rlike(r"\S") | F.array_contains("kept", i))
    return rows.select("doc_id", F.array_join(stays, "\n").alias("text"),
                       F.coalesce(F.size(F.filter("all", lambda line: line.rlike(r"\S"))), F.lit(0)).alias("n_lines"),
                       "kept", "dk").dropDuplicates(["doc_id", "dk"]).drop("dk")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, n_lines, n_kept, kept) of every document."""
    docs = table(spark, sf_dir, "documents")
    n = F.regexp_count(F.concat(F.lit("\n"), F.col("text")), F.lit(r"\n[^\n]*?[^\s]"))
    sizes = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("dk"),
                        F.coalesce(n, F.lit(0)).alias("n_lines")).distinct()
    kept = kept_lines(docs).select(F.col("doc_id").alias("d"), F.col("dk").alias("k"), "kept")
    return sizes.join(kept, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("dk") == F.col("k")), "left").select(
        "doc_id", "n_lines", F.coalesce(F.size("kept"), F.lit(0)).alias("n_kept"),
        F.coalesce("kept", F.array().cast("array<int>")).alias("kept"))
