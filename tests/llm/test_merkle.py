"""Merkle manifest: against its SQL in DuckDB and against a plain recursion, with odd rows."""

import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from wattline.llm import merkle

COLS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(nodes):
    """Top of a tree and, for each node of the bottom, its steps (slot, run) to the top."""
    if len(nodes) == 1:
        return nodes[0], [[]]
    runs = [nodes[i:i + 16] for i in range(0, len(nodes), 16)]
    top, above = tree([h(r) for r in runs])
    return top, [[(i % 16, runs[i // 16]), *above[i // 16]] for i in range(len(nodes))]


def brute(rows):
    def leaf(row):
        return h(["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])

    def low(text):
        return text and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    rows = [(d, s, lang, n, t) for d, t, lang, s, n in rows]
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    own = {s: sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for s in sources}
    trees = {s: tree([leaf(r) for r in own[s]]) for s in sources}
    root, upper = tree([trees[s][0] for s in sources])
    out = []
    for i, s in enumerate(sources):
        for r, path in zip(own[s], trees[s][1], strict=True):
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            folded, shown = leaf((*r[:4], low(r[4]))) if tampered else leaf(r), []
            for slot, run in [*path, *upper[i]]:
                shown += run[:slot] + run[slot + 1:]
                folded = h([*run[:slot], folded, *run[slot + 1:]])
            out.append((r[0], leaf(r), trees[s][0], root, h(shown), folded, folded == root))
    return sorted(out, key=repr)


def many(sizes):
    """Rows of sources with so many documents, doc_ids falling."""
    i, out = 0, []
    for s, n in sizes.items():
        for k in range(n):
            i += 1
            out.append((100_000 - 7 * i, f"Text {k} OF {s}" if k % 3 else f"text {k}", "en", s, k))
    return out


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 16}, {"a": 17, None: 1}, {"b": 300, "a": 256, None: 257, "": 2, "é": 1},
                                   {"hot": 4500, **{f"s{i}": 1 for i in range(290)}}])
def test_against_recursion(spark, odd, sizes):
    rows = many(sizes)
    got = merkle.manifest(odd(rows)).select(*COLS).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_odd_rows(spark, odd):
    """Nulls, repeated rows and doc_ids, long texts, clashing columns: as the recursion, and as the SQL."""
    from conftest import ODD
    rows = [*ODD, *ODD[:2], (5, "Upper", None, None, None), (10, "ABC", None, None, 3), (11, None, None, None, 3)]
    docs = odd(rows)
    got = sorted(map(tuple, merkle.manifest(docs).select(*COLS).collect()), key=repr)
    assert got == brute(rows)
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "lang", "source", "n_chars").toPandas().convert_dtypes())
    assert sorted(con.sql(merkle.SQL).fetchall(), key=repr) == got


def test_tampering_shows(spark, odd):
    rows = [(i, "With Capitals", "en", "s", 1) for i in range(60)]
    got = {r.doc_id: r for r in merkle.manifest(odd(rows)).collect()}
    for i, r in got.items():
        assert r.verified == (zlib.crc32(str(i).encode()) % 5 != 0) and r.verified == (r.folded_root == r.root)
    assert len({r.root for r in got.values()}) == 1


def test_empty(spark, odd):
    got = merkle.manifest(odd([]))
    assert got.columns == COLS and not got.collect()


def test_a_large_source_is_spread(spark, odd):
    """The runs of one source lie in many partitions, a task sees some of them only."""
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("one").alias("source"), F.lit(None).cast("string").alias("lang"),
                                      F.lit(1).alias("n_chars"), F.lit("t").alias("text"))
    bottom = merkle.numbered(merkle.leaves(docs), "tree", ["doc_id"])
    assert bottom.selectExpr("min(pos)", "max(pos)", "count(distinct pos)").first()[:] == (0, 19_999, 20_000)
    run = F.floor(F.col("pos") / merkle.RUN)
    assert bottom.select("tree", run.alias("run")).repartitionByRange(4, "tree", "run").select(
        F.spark_partition_id().alias("p")).groupBy("p").count().agg(F.max("count")).first()[0] < 8_000
