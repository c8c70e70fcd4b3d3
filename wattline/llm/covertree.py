"""Exact top-k inner products by dual-tree search over cover trees.

Vectors are quantized to integers, so scores are exact. A bounded sample of
vectors serves as the top level of the tree: every vector belongs to the
group of its nearest pivot, a group of over GROUP rows is cut into several by
a hash, and each group is a subtree with a center and a covering radius.

Queries search the groups of their own pivot first. The worst kth score that
each has then prunes whole groups: a group can hold nothing better for query q
than <q, c> + |q| r. Queries are sent on to the groups that remain, in waves of
bounded size, and meet them there: cover trees over the queries and over the
group's rows are traversed together, and a pair of nodes is left if
<cq, cr> + rq |cr| + rr |cq| + rq rr is under the worst kth score of all
queries below the query node. Leaves are scored together.

A cover tree node has a center, a radius that covers all below it, and up to
FANOUT children, whose centers are chosen farthest first and lie more than
half that radius apart.

Vectors that are null, or hold null or non-finite components, and rows without
a vec_id take no part; vectors meet those of their own length only. Repeated
rows are candidates each; a query id that repeats counts once, by its smallest
vector. Fewer than k candidates give fewer rows, an empty table none. A product
beyond a long counts as the longest one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattline.llm.common import cut, table

SCALE = 256
#: Rows of a group, about, and the most pivots.
GROUP, PIVOTS = 4096, 4096
#: Queries that one task meets a group with.
WAVE = 16_384
LEAF = 256
#: Most children of a node; in many dimensions hardly any point covers others closely.
FANOUT = 8
SEED = 42
#: Products below this are exact in double arithmetic.
EXACT = float(1 << 53)


def quantized(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, dim, v): v the integer components as little-endian longs."""
    x = F.col("embedding")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("embedding").cast("array<double>").alias("embedding")) \
        .where(F.col("vec_id").isNotNull() & x.isNotNull()).where(F.coalesce(finite, F.lit(False))) \
        .select("vec_id", F.size(x).alias("dim"), F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("q"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = [np.array(q, "<i8").tobytes() for q in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(v, pa.binary())], ["vec_id", "dim", "v"])
    return rows.mapInArrow(pack, "vec_id long, dim int, v binary")


def matrix(column, dim: int) -> np.ndarray:
    joined = b"".join(column)
    return np.frombuffer(joined, "<i8").reshape(len(column), dim) if joined else np.zeros((len(column), dim), np.int64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of all rows of a with all of b."""
    if not a.shape[1]:
        return np.zeros((len(a), len(b)), np.int64)
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if top < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    wide = a.astype(object) @ b.astype(object).T
    return np.clip(wide, -(1 << 63), (1 << 63) - 1).astype(np.int64)


class Node:
    __slots__ = ("center", "length", "radius", "rows", "children")

    def __init__(self, center, radius, rows, children):
        self.center, self.radius, self.rows, self.children = center, radius, rows, children
        self.length = float(np.linalg.norm(center))


def tree(points: np.ndarray, rows: np.ndarray | None = None, leaf: int = LEAF) -> Node:
    """Cover tree of the rows: children's centers lie over half the radius apart."""
    rows = np.arange(len(points)) if rows is None else rows
    own = points[rows]
    center = own[0]
    away = np.linalg.norm(own - center, axis=1)
    radius = float(away.max())
    if len(rows) <= leaf or radius == 0.0:
        return Node(center, radius, rows, ())
    nearest, by = away, np.zeros(len(rows), np.int64)
    heads = [0]
    while nearest.max() > radius / 2:
        far = int(nearest.argmax())                 # the next center is the farthest point
        d = np.linalg.norm(own - own[far], axis=1)
        closer = d < nearest
        by[closer], nearest = len(heads), np.minimum(nearest, d)
        heads.append(far)
        if len(heads) == FANOUT:
            break                                   # points on all sides: children cover less well
    by[heads] = -1                                  # a center comes first among its rows
    return Node(center, radius, rows, [
        tree(points, np.concatenate([rows[h:h + 1], rows[by == c]]), leaf) for c, h in enumerate(heads)])


class Best:
    """The k best (score, id) of every query, and the worst of them."""

    def __init__(self, queries: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor
        self.score = np.full((queries, k), np.iinfo(np.int64).min)
        self.id = np.full((queries, k), np.iinfo(np.int64).max)
        self.have = np.zeros(queries, np.int64)

    def worst(self, rows: np.ndarray) -> float:
        own = np.where(self.have[rows] >= self.k, self.score[rows, -1].astype(np.float64), -np.inf)
        return float(np.maximum(own, self.floor[rows]).min())

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, valid: np.ndarray) -> None:
        valid = valid & (scores >= np.maximum(self.score[rows, -1].astype(np.float64), self.floor[rows])[:, None])
        some = np.flatnonzero(valid.any(axis=1))    # queries that gain a result here
        if not len(some):
            return
        rows, scores, valid = rows[some], scores[some], valid[some]
        use = np.flatnonzero(valid.any(axis=0))
        scores, valid, ids = scores[:, use], valid[:, use], ids[use]
        low = np.iinfo(np.int64).min
        scores = np.where(valid, scores, low)
        all_s = np.concatenate([self.score[rows], scores], axis=1)
        all_i = np.concatenate([self.id[rows], np.where(valid, ids[None, :], np.iinfo(np.int64).max)], axis=1)
        order = np.lexsort((all_i, -all_s.astype(np.float64) if np.abs(scores[valid]).max(initial=0) < EXACT else _descending(all_s)), axis=1)
        order = order[:, :self.k]
        self.score[rows] = np.take_along_axis(all_s, order, 1)
        self.id[rows] = np.take_along_axis(all_i, order, 1)
        self.have[rows] = np.minimum(self.k, self.have[rows] + valid.sum(axis=1))


def _descending(x: np.ndarray) -> np.ndarray:
    return np.bitwise_not(x)


def search(queries: np.ndarray, query_ids: np.ndarray, data: np.ndarray, data_ids: np.ndarray, k: int,
           floor: np.ndarray) -> Best:
    """Dual-tree search; scores under ``floor`` of a query may be left out."""
    best = Best(len(queries), k, floor)
    if not len(queries) or not len(data):
        return best
    fq, fd = queries.astype(np.float64), data.astype(np.float64)
    slack = 1e-9                                    # of the bound's size, for its rounding
    stack = [(tree(fq), tree(fd), np.inf)]
    while stack:
        q, r, bound = stack.pop()
        if bound < best.worst(q.rows):
            continue
        if not q.children and not r.children:
            best.add(q.rows, products(queries[q.rows], data[r.rows]), data_ids[r.rows],
                     query_ids[q.rows][:, None] != data_ids[r.rows][None, :])
            continue
        pairs = [(a, b) for a in (q.children or (q,)) for b in (r.children or (r,))]
        more = []
        for a, b in pairs:
            size = (a.length + a.radius) * (b.length + b.radius)
            more.append((a, b, float(a.center @ b.center) + a.radius * b.length + b.radius * a.length
                         + a.radius * b.radius + slack * size))
        more.sort(key=lambda x: x[2])               # the most promising pair comes off first
        stack += more
    return best


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, group: int = GROUP) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest products of each query with other rows.

    ``vectors`` and ``queries`` have vec_id and embedding.
    """
    data = cut(quantized(vectors), "vectors")
    asked = quantized(queries).groupBy("vec_id").agg(F.min(F.struct("dim", "v")).alias("x")).select(
        F.col("vec_id").alias("query_id"), "x.dim", "x.v")
    asked = cut(asked, "queries")
    rows, n_queries = data.count(), asked.count()

    # the top of the tree: pivots from a bounded sample, by hash of the vec_id
    want = max(1, min(-(-rows // group), PIVOTS))
    picked = data.groupBy("dim", "v").agg(F.min("vec_id").alias("vec_id")) \
        .orderBy(F.xxhash64("vec_id", F.lit(SEED)), "vec_id", "dim", "v").limit(want).collect()
    dims = sorted({r.dim for r in data.select("dim").distinct().collect()})   # lengths of vectors: a few
    pivots = {d: matrix([r.v for r in picked if r.dim == d] or [bytes(8 * d)], d).astype(np.float64) for d in dims}

    def nearest(dim: np.ndarray, v: list) -> tuple[np.ndarray, np.ndarray]:
        pivot, away = np.zeros(len(v), np.int64), np.zeros(len(v))
        for d in np.unique(dim):
            at = np.flatnonzero(dim == d)
            p = pivots.get(int(d))
            if p is None:
                continue
            x = matrix([v[i] for i in at], int(d)).astype(np.float64)
            for s in range(0, len(at), 4096):
                square = (x[s:s + 4096] ** 2).sum(1)[:, None] + (p ** 2).sum(1)[None, :] - 2 * x[s:s + 4096] @ p.T
                pivot[at[s:s + 4096]] = square.argmin(1)
            away[at] = np.linalg.norm(x - p[pivot[at]], axis=1)
        return pivot, away

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pivot, away = nearest(b.column(1).to_numpy(), b.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(pivot), pa.array(away)], [*b.schema.names, "pivot", "away"])

    data = cut(data.mapInArrow(assign, "vec_id long, dim int, v binary, pivot long, away double"), "groups")
    asked = asked.select(F.col("query_id").alias("vec_id"), "dim", "v").mapInArrow(
        assign, "vec_id long, dim int, v binary, pivot long, away double").select(
        F.col("vec_id").alias("query_id"), "dim", "v", "pivot")
    groups = data.groupBy("dim", "pivot").agg(F.count("*").alias("n"), F.max("away").alias("radius"))
    groups = cut(groups.withColumn("parts", F.ceil(F.col("n") / group).cast("long")), "group-sizes")  # at most PIVOTS a length
    known = {(r.dim, r.pivot): (r.radius, r.parts) for r in groups.collect()}
    waves = max(1, -(-n_queries // WAVE))

    salted = data.join(F.broadcast(groups.select("dim", "pivot", "parts")), ["dim", "pivot"]) \
        .withColumn("part", F.pmod(F.xxhash64("vec_id", F.lit(SEED + 1)), "parts")) \
        .withColumn("wave", F.explode(F.sequence(F.lit(0), F.lit(waves - 1)))) \
        .select("dim", "pivot", "part", "wave", "vec_id", "v")
    salted = cut(salted, "group-rows") if waves == 1 else salted

    def meet(key, asked: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        d = int(key[0])
        if not len(asked) or not len(rows):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        ids = rows["vec_id"].to_numpy(np.int64)
        qids = asked["query_id"].to_numpy(np.int64)
        best = search(matrix(asked["v"], d), qids, matrix(rows["v"], d), ids, k, asked["floor"].to_numpy(np.float64))
        q, c = np.nonzero(np.arange(k)[None, :] < best.have[:, None])
        return pd.DataFrame({"query_id": qids[q], "vec_id": best.id[q, c], "score": best.score[q, c]})

    def met(sent: DataFrame) -> DataFrame:
        by = ["dim", "pivot", "part", "wave"]
        sent = sent.withColumn("wave", F.pmod(F.xxhash64("query_id"), F.lit(waves)).cast("int"))
        return sent.groupBy(*by).cogroup(salted.groupBy(*by)).applyInPandas(meet, "query_id long, vec_id long, score long")

    # first the groups of the query's own pivot
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    home = asked.join(F.broadcast(groups.select("dim", "pivot", "parts")), ["dim", "pivot"]) \
        .select("query_id", "dim", "v", "pivot", parts.alias("part"), F.lit(float("-inf")).alias("floor"))
    found = cut(met(home), "home")
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    worst = found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") == k).select(
        "query_id", F.col("score").cast("double").alias("floor"))
    asked = asked.join(worst, "query_id", "left").select(
        "query_id", "dim", "v", "pivot", F.coalesce("floor", F.lit(float("-inf"))).alias("floor"))

    # then all groups whose bound reaches the query's worst score
    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = b.to_pandas()
            for d, own in t.groupby("dim"):
                numbers = [p for dd, p in known if dd == d]
                if not numbers:
                    continue
                radius = np.array([known[d, p][0] for p in numbers])
                parts = np.array([known[d, p][1] for p in numbers])
                c = pivots[d][numbers]
                x = matrix(own["v"], int(d)).astype(np.float64)
                length = np.linalg.norm(x, axis=1)
                bound = x @ c.T + length[:, None] * radius[None, :]
                bound += 1e-9 * (1 + length[:, None] * (np.linalg.norm(c, axis=1) + radius)[None, :])
                go = (bound >= own["floor"].to_numpy()[:, None]) & (np.array(numbers)[None, :] != own["pivot"].to_numpy()[:, None])
                q, g = np.nonzero(go)
                yield pa.RecordBatch.from_arrays([
                    pa.array(own["query_id"].to_numpy()[q]), pa.array(np.full(len(q), d, np.int32)),
                    pa.array([own["v"].iloc[i] for i in q], pa.binary()), pa.array(np.array(numbers, np.int64)[g]),
                    pa.array(parts[g].astype(np.int64)), pa.array(own["floor"].to_numpy()[q])],
                    ["query_id", "dim", "v", "pivot", "parts", "floor"])

    sent = asked.mapInArrow(route, "query_id long, dim int, v binary, pivot long, parts long, floor double") \
        .select("query_id", "dim", "v", "pivot", parts.alias("part"), "floor")
    return found.unionByName(met(sent)).withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k) \
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 50 = 0"))


SQL = """
WITH e AS (
  SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""
