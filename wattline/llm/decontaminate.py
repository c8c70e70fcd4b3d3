"""Benchmark decontamination by q-gram lemma filtering.

Texts are lower-cased and runs of white space become one space. Benchmark
items of over LONG characters are cut into segments of equal length; a
document is contaminated if a region of it is within the edit budget, EDITS of
the segment's length, of some segment. An occurrence of a segment of m
characters with at most e edits shares m + 1 - q (e + 1) q-grams with it, on
diagonals that span at most e. So a document's q-grams are looked up in the
benchmark's, places where too few lie close together are left, the rest are
counted per segment in overlapping bands of 2 (e + 1) diagonals, bands that
reach the bound are retained, and banded alignment verifies each of them.

The index of the benchmark goes to the tasks in slices of at most SLICE
characters, each a pass over the documents, so what is broadcast is bounded
however large the benchmark is.

Null texts count as empty. Empty items, and items shorter than q, match
nothing. A repeated document gets repeated rows, a repeated item id counts
once per text. Empty tables give an empty result. Texts of any length are
read whole, in pieces that overlap by the longest region.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm.common import table

Q = 10
EDITS = 0.08
LONG = 200
SLICE = 2_000_000
#: Characters looked up at once.
CHUNK = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
BITS = 22


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


def grams(c: np.ndarray, q: int) -> np.ndarray:
    """Hash of the q codes from every position, by doubling."""
    if len(c) < q:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        out, width, power, part, left = None, 0, BASE, c, q
        size = 1
        while left:
            if left & size:
                # append a run of `size` codes to what is hashed so far
                out = part[:len(c) - q + 1 + (q - size)] if out is None else \
                    out[:len(c) - width - size + 1] * power + part[width:width + len(c) - width - size + 1]
                width += size
                left &= ~size
            if left:
                part = part[:-size] * power + part[size:]
                power = power * power
                size *= 2
        return _mixed(out[:len(c) - q + 1])


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


@dataclass
class Index:
    """Segments of benchmark items with their q-grams."""
    q: int
    items: np.ndarray           # item id of each segment
    texts: list[str]
    size: np.ndarray
    edits: np.ndarray
    bound: np.ndarray           # q-grams that an occurrence shares at least
    keys: np.ndarray            # sorted distinct q-grams
    first: np.ndarray           # postings of a key: first and number
    many: np.ndarray
    segment: np.ndarray         # postings: segment and offset in it
    offset: np.ndarray

    def bitmap(self) -> np.ndarray:
        seen = np.zeros(1 << BITS, bool)
        seen[self.keys >> np.uint64(64 - BITS)] = True
        return seen


def build(items: list[tuple[int, str]], q: int = Q, share: float = EDITS) -> Index:
    ids, texts = [], []
    for i, t in sorted({(i, normal(t)) for i, t in items}):
        n = max(1, len(t) // (LONG // 2)) if len(t) > LONG else 1
        cuts = [len(t) * k // n for k in range(n + 1)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b - a >= q:
                ids.append(i)
                texts.append(t[a:b])
    size = np.array([len(t) for t in texts], np.int64)
    edits = np.minimum((size * share).astype(np.int64), np.maximum(size // q - 1, 0))
    found = [grams(codes_of(t), q) for t in texts]
    n = np.array([len(f) for f in found], np.int64)
    h = np.concatenate([*found, np.empty(0, np.uint64)])
    segment = np.repeat(np.arange(len(texts)), n)
    offset = np.arange(len(h)) - np.repeat(np.cumsum(n) - n, n)
    order = np.argsort(h, kind="stable")
    keys, first, many = np.unique(h[order], return_index=True, return_counts=True)
    return Index(q, np.array(ids, np.int64), texts, size, edits, size + 1 - q * (edits + 1),
                 keys, first, many, segment[order], offset[order])


def align(pattern: np.ndarray, text: np.ndarray, lo: int, hi: int) -> tuple[int, int]:
    """(least edits, end in text) of the pattern over diagonals lo to hi, both text ends free."""
    width, m = hi - lo + 1, len(pattern)
    k = np.arange(width)
    far = np.int64(1 << 30)
    # padded[x] is the text code at x + lo - 1; outside the text nothing matches
    padded = np.full(m + width + 1, -1, np.int64)
    a, b = max(0, lo), min(len(text), m + hi)
    if b > a:
        padded[a - lo + 1 - 1:b - lo + 1 - 1] = text[a:b]
    row = np.zeros(width, np.int64)
    row[(k + lo < 0) | (k + lo > len(text))] = far
    for i in range(m):
        best = row + (padded[i:i + width] != pattern[i])
        best[:-1] = np.minimum(best[:-1], row[1:] + 1)
        row = np.minimum.accumulate(best - k) + k
        row[(k + lo + i + 1 < 0) | (k + lo + i + 1 > len(text))] = far
    end = int(np.argmin(row))
    return int(row[end]), end + lo + m


def verified(index: Index, s: int, text: np.ndarray, lo: int, hi: int, as_text: str) -> tuple[int, int, int] | None:
    """(start, end, edits) of the segment between diagonals lo and hi, or None."""
    pattern, e = index.texts[s], int(index.edits[s])
    a, b = max(0, lo - e), min(len(text), hi + len(pattern) + e)
    at = as_text.find(pattern, a, b)
    if at >= 0:
        return at, at + len(pattern), 0
    codes, window = codes_of(pattern).astype(np.int64), text[a:b].astype(np.int64)
    cost, end = align(codes, window, lo - a - e, hi - a + e)
    if cost > e:
        return None
    back = window[:end][::-1]
    _, start = align(codes[::-1], back, -e, e)
    return a + max(0, end - start), a + end, cost


def regions(index: Index, texts: list[str], bitmap: np.ndarray) -> list[list[tuple[int, int, int, int]]]:
    """Per text, (segment, start, end, edits) of its regions within the edit budget."""
    out: list[list[tuple[int, int, int, int]]] = [[] for _ in texts]
    if not len(index.keys):
        return out
    longest, q = int((index.size + index.edits).max()), index.q
    least = int(index.bound.min())
    pieces, number, base, held = [], [], [], 0

    def flush():
        nonlocal held
        if pieces:
            _scan(index, pieces, number, base, bitmap, longest, least, q, out)
        pieces.clear(), number.clear(), base.clear()
        held = 0

    for n, t in enumerate(texts):
        at = 0
        while True:
            piece = t[at:at + CHUNK + 2 * longest]
            pieces.append(piece)
            number.append(n)
            base.append(at)
            held += len(piece)
            if held >= CHUNK:
                flush()
            at += CHUNK
            if at >= len(t) or len(t) <= CHUNK + 2 * longest:
                break
    flush()
    return [sorted(set(r)) for r in out]


def _scan(index, pieces, number, base, bitmap, longest, least, q, out) -> None:
    joined = "\x00".join(pieces)
    codes = codes_of(joined)
    h = grams(codes, q)
    pos = np.flatnonzero(bitmap[h >> np.uint64(64 - BITS)])
    key = np.minimum(np.searchsorted(index.keys, h[pos]), len(index.keys) - 1)
    real = index.keys[key] == h[pos]
    pos, key = pos[real], key[real]
    if len(pos) < least:
        return
    close = np.flatnonzero(pos[least - 1:] - pos[:len(pos) - least + 1] <= longest - q)
    dense = np.zeros(len(pos) + 1, np.int64)
    np.add.at(dense, close, 1)
    np.add.at(dense, close + least, -1)
    keep = np.cumsum(dense)[:-1] > 0
    pos, key = pos[keep], key[keep]
    if not len(pos):
        return
    many = index.many[key]
    post = np.repeat(index.first[key] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
    start = np.concatenate([[0], np.cumsum([len(p) + 1 for p in pieces])])
    where = np.repeat(pos, many)
    piece = np.searchsorted(start, where, "right") - 1
    segment = index.segment[post]
    diagonal = where - start[piece] - index.offset[post]
    step = index.edits[segment] + 1
    band = diagonal // step
    rows = np.concatenate([np.stack([piece, segment, band]), np.stack([piece, segment, band - 1])], axis=1)
    rows = rows[:, np.lexsort(rows[::-1])]
    new = np.flatnonzero(np.concatenate([[True], (rows[:, 1:] != rows[:, :-1]).any(axis=0)]))
    count = np.diff(np.append(new, rows.shape[1]))
    for i in np.flatnonzero(count >= index.bound[rows[1, new]]):
        p, s, b = (int(x) for x in rows[:, new[i]])
        w = int(index.edits[s]) + 1
        found = verified(index, s, codes[start[p]:start[p] + len(pieces[p])], b * w, (b + 2) * w - 1, pieces[p])
        if found:
            out[number[p]].append((s, base[p] + found[0], base[p] + found[1], found[2]))


def slices(benchmark: DataFrame, limit: int = SLICE) -> Iterator[Index]:
    """Indexes over the benchmark's items, each of about ``limit`` characters at most."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")) \
        .where("text is not null").distinct()
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-chars // limit)
    for i in range(n):
        part = items.where(F.pmod(F.xxhash64("text"), F.lit(n)) == i)
        yield build([(r.item_id if r.item_id is not None else -1, r.text) for r in part.collect()])


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_regions, edits, start, end) of each document and item it contains.

    ``edits``, ``start`` and ``end`` are of the region with the fewest edits,
    in code points of the normalized text.
    """
    names = ["doc_id", "item_id", "n_regions", "edits", "start", "end"]
    schema = "doc_id long, item_id long, n_regions int, edits int, start long, end long"
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def scan(index: Index) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = shared.value
            bitmap = index.bitmap()
            for b in batches:
                rows = []
                ids = b.column(0).to_pylist()
                for d, found in zip(ids, regions(index, [normal(t) for t in b.column(1).to_pylist()], bitmap), strict=True):
                    for item in sorted({int(index.items[s]) for s, *_ in found}):
                        mine = [r for r in found if index.items[r[0]] == item]
                        _, start, end, edits = min(mine, key=lambda r: (r[3], r[1], r[2]))
                        rows.append((d, item, len(mine), edits, start, end))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], pa.int32() if i in (2, 3) else pa.int64()) for i in range(6)], names)
        return texts.mapInArrow(run, schema)

    parts = [scan(x) for x in slices(benchmark)]
    return reduce(DataFrame.unionByName, parts) if parts else docs.sparkSession.createDataFrame([], schema)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, columns as they are, without a region of the benchmark."""
    at = docs.columns.index("text")

    def clean(docs: DataFrame, index: Index) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = shared.value
            bitmap = index.bitmap()
            for b in batches:
                found = regions(index, [normal(t) for t in b.column(at).to_pylist()], bitmap)
                yield b.filter(pa.array([not f for f in found], pa.bool_()))
        return docs.mapInArrow(run, docs.schema)

    return reduce(clean, slices(benchmark), docs)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
