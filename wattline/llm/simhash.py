"""SimHash near-dedup by bit-sliced comparison.

Fingerprints come from one pass over the texts. Equal fingerprints collapse
before any comparison, so a group of copies costs one row however large it
is. Distinct fingerprints meet in blocks: the 64 bits are cut into radius + 2
pieces, two fingerprints within the radius agree on at least two of them, and
a block holds the fingerprints that agree on one pair of pieces. Blocks over
TILE rows are cut into tiles that meet pairwise in separate tasks.

Inside a block the bits are stored as planes of 64 lanes. All distances of a
fingerprint to 64 others advance together through a carry-save counter of
plane-wise bit operations; a word of lanes is abandoned once every lane has
passed the radius. A tile emits a spanning forest of its links, not its pairs.

Nulls and empty texts have fingerprint zero and link like any other; a null
doc_id is never a component's smallest id unless all are null. Repeated rows
give repeated rows. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm.common import components, cut, spread_join, table, whole_groups

SEED = 42
#: Rows of a block that one task compares with as many others.
TILE = 1024
#: (row, word) entries compared at once.
CHUNK = 1 << 18
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: bytes | None, width: int) -> int:
    """The unsigned 64-bit SimHash of a UTF-8 text."""
    words = (text or b"").lower().split()
    n = len(words)
    if not n:
        return 0
    if n < width:
        shingles, n = iter([b" ".join(words)]), 1
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
        n -= width - 1
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    while part := [digest(s, SEED) for s in islice(shingles, 1 << 15)]:
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 3, carry: bool = False) -> DataFrame:
    """(doc_id, fp): one row per document, fp as a signed long; with ``carry`` its text, too."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t, width) for t in b.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.array(fps, np.uint64).view(np.int64)), *[b.column(1)] * carry], ["doc_id", "fp", *["text"] * carry])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, fp long" + ", text string" * carry)


def planes_of(fps: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vertical bit planes: (words, 64) planes and the first word of each block."""
    words = (size + 63) // 64
    first = np.concatenate([[0], np.cumsum(words)[:-1]])
    lane = np.arange(len(fps)) - np.repeat(start, size)
    word = np.repeat(first, size) + lane // 64
    planes = np.zeros((int(words.sum()), 64), np.uint64)
    bit = np.uint64(1) << (lane % 64).astype(np.uint64)
    for p in range(64):
        on = np.flatnonzero((fps >> np.uint64(p)) & np.uint64(1))
        np.bitwise_or.at(planes[:, p], word[on], bit[on])
    return planes, first


def close_pairs(fps: np.ndarray, start: np.ndarray, size: np.ndarray, radius: int
                ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs i > j of rows of one block at distance <= radius, in chunks."""
    planes, first = planes_of(fps, start, size)
    words = (size + 63) // 64
    block = np.repeat(np.arange(len(size)), size)
    reach = words[block]                       # each row meets every word of its block
    ends = np.cumsum(reach)
    digits = max(1, int(radius).bit_length())
    at = 0
    while at < len(fps):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK, "right")))
        rows = np.repeat(np.arange(at, to), reach[at:to])
        offset = np.arange(len(rows)) - np.repeat(ends[at:to] - reach[at:to] - (ends[at - 1] if at else 0), reach[at:to])
        word = first[block[rows]] + offset
        # lanes that hold no row count as beyond the radius from the start
        left = np.clip(size[block[rows]] - offset * 64, 0, 64)
        over = np.where(left >= 64, np.uint64(0), FULL << (left % 64).astype(np.uint64))
        count = [np.zeros(len(rows), np.uint64) for _ in range(digits)]
        mine = fps[rows]
        for p in range(64):
            flip = np.uint64(0) - ((mine >> np.uint64(p)) & np.uint64(1))
            carry = planes[word, p] ^ flip
            for d in range(digits):            # carry-save addition of one bit per lane
                count[d], carry = count[d] ^ carry, count[d] & carry
            over |= carry
            if radius + 1 < 1 << digits:       # the counter can hold more than the radius
                over |= _above(count, radius)
            if p % 8 == 7:
                keep = np.flatnonzero(over != FULL)
                if len(keep) < len(rows):
                    rows, word, offset, over, mine = (x[keep] for x in (rows, word, offset, over, mine))
                    count = [c[keep] for c in count]
            if not len(rows):
                break
        if len(rows):
            near = np.unpackbits((~over).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            r, lane = np.nonzero(near)
            i, j = rows[r], start[block[rows[r]]] + offset[r] * 64 + lane
            yield i[i > j], j[i > j]
        at = to


def _above(count: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counter exceeds the radius."""
    more = np.zeros_like(count[0])
    equal = np.full_like(count[0], FULL)
    for d in reversed(range(len(count))):
        if radius >> d & 1:
            equal = equal & count[d]
        else:
            more, equal = more | (equal & count[d]), equal & ~count[d]
    return more


def spanning(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest row reachable from each of n rows over the links i - j."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, label[i], low)
        np.minimum.at(label, label[j], low)
        while (label[label] != label).any():
            label = label[label]
        apart = label[i] != label[j]
        i, j = i[apart], j[apart]
    return label


def _starts(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    start = np.flatnonzero(new)
    return start, np.diff(np.append(start, len(new)))


def links(distinct: DataFrame, radius: int = 3, tile: int = TILE) -> DataFrame:
    """(a, b): a spanning forest, per block, of fingerprints within the radius."""
    pieces = radius + 2
    edge = [64 * i // pieces for i in range(pieces + 1)]
    def piece(i):
        return F.shiftrightunsigned(F.col("fp"), edge[i]).bitwiseAND(F.lit((1 << edge[i + 1] - edge[i]) - 1))
    keys = [F.xxhash64(F.lit(n), piece(i), piece(j)) for n, (i, j) in enumerate(combinations(range(pieces), 2))]
    rows = cut(distinct.select("fp", F.explode(F.array(*keys)).alias("k")), "simhash-keys")
    many = rows.groupBy("k").agg(F.count("*").alias("n")).where("n > 1")
    part = F.ceil(F.col("n") / tile)
    mine = F.pmod(F.xxhash64("fp", F.lit(7)), part)
    tiles = rows.join(many, "k").select("k", "fp", mine.alias("c"), F.explode(
        F.sequence(F.lit(0).cast("long"), part - 1)).alias("o")) \
        .select("k", F.least("c", "o").alias("ti"), F.greatest("c", "o").alias("tj"), "fp")
    by = ["k", "ti", "tj"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, by):
            fps = t.column("fp").to_numpy().view(np.uint64)
            start, size = _starts(*(t.column(k).to_numpy() for k in by))
            found = list(close_pairs(fps, start, size, radius))
            i, j = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.empty(0, int),) * 2
            label = spanning(len(fps), i, j)
            at = np.flatnonzero(label != np.arange(len(fps)))
            signed = fps.view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(signed[at]), pa.array(signed[label[at]])], ["a", "b"])

    return tiles.repartition(*by).sortWithinPartitions(*by).mapInArrow(run, "a long, b long")


def clustered(marked: DataFrame, radius: int) -> DataFrame:
    """(fp, root, component_id) of the fingerprints of ``marked`` (doc_id, fp): the component, and its smallest doc_id."""
    distinct = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-distinct")
    roots = components(links(distinct, radius))
    placed = cut(distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
                 .select("fp", "low", F.coalesce("root", "fp").alias("root")), "simhash-placed")
    lowest = cut(placed.groupBy("root").agg(F.min("low").alias("component_id"), F.count("*").alias("n")), "simhash-lowest")
    return spread_join(placed, lowest.drop("n"), "root", lowest.select("root", "n")).select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, width: int = 3, radius: int = 3) -> DataFrame:
    """(doc_id, fp, root, component_id): component_id is the smallest doc_id reachable, root names the component."""
    marked = cut(fingerprints(docs, width), "simhash")
    counts = marked.groupBy("fp").agg(F.count("*").alias("n"))
    return spread_join(marked, clustered(marked, radius), "fp", counts).select("doc_id", "fp", "root", "component_id")


def drop_near_duplicates(docs: DataFrame, width: int = 3, radius: int = 3) -> DataFrame:
    """The rows of docs that stand for their component: one row of its smallest doc_id.

    Rows that repeat a doc_id are judged each by its own text: texts of different components all
    stand for theirs, of texts of one component the first in binary order does (null before all), of equal
    rows one. So reruns agree, and no text without a near copy is lost. Rows without a doc_id stay.
    """
    stay = cut(near_duplicates(docs, width, radius).where("doc_id = component_id").groupBy("doc_id", "fp", "root").count(), "stay")
    rows = docs.where("doc_id is not null")
    repeated = cut(rows.groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    once = rows.join(repeated, "doc_id", "left_anti").join(stay.select("doc_id").distinct(), "doc_id", "left_semi").select(*docs.columns)
    again = rows.join(repeated, "doc_id", "left_semi").select(*docs.columns)
    texts = fingerprints(again.select("doc_id", "text").distinct(), width, carry=True)
    first = texts.join(stay, ["doc_id", "fp"]).groupBy("doc_id", "root").agg(
        F.min(F.struct(F.col("text").isNotNull(), "text")).alias("t")).select(F.col("doc_id").alias("_id"), F.col("t.text").alias("_text")).distinct()
    own = again.join(first, (F.col("doc_id") == F.col("_id")) & F.col("text").eqNullSafe(F.col("_text")))
    pick = F.min_by(F.struct(*docs.columns), F.to_json(F.struct(*docs.columns)))
    chosen = own.groupBy("_id", "_text").agg(pick.alias("_row")).select("_row.*")
    return once.unionByName(chosen).unionByName(docs.where("doc_id is null"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
