"""SimHash near-dedup against an all-pairs brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from wattline.llm import simhash
from wattline.llm.common import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string"


def brute(rows, width=3, radius=3):
    fps = []
    for _, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        sh = [" ".join(w[i:i + width]) for i in range(len(w) - width + 1)] if len(w) >= width else [" ".join(w)] if w else []
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
        fps.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted(((d, fps[i], low.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def run(spark, rows):
    df = spark.createDataFrame([(d, t, None, "s", 1, "x") for d, t in rows], SCHEMA)
    return sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(df).collect()), key=str)


def corpus(seed, n):
    rng = random.Random(seed)
    vocab = ["ab", "Cd", "ef", "gh", "É", "ij", "kl", "mn"]
    rows = []
    for i in range(n):
        if rows and rng.random() < .5:
            w = (rng.choice(rows)[1] or "").split()
            if w:
                w[rng.randrange(len(w))] = rng.choice(vocab)
            rows.append((i, "  ".join(w)))
        else:
            rows.append((i, " ".join(rng.choice(vocab) for _ in range(rng.choice([0, 1, 2, 3, 8, 60])))))
    return rows


def test_against_brute_force(spark):
    rows = corpus(1, 150) + [(7, None), (None, "a b c"), (500, ""), (501, " \t\n"), (501, " \t\n"), (502, "x " * 40000),
                             (503, "A b c\x0bd")]
    assert run(spark, rows) == brute(rows)


def test_tiles_lose_no_link(spark):
    rng = random.Random(3)
    base = rng.getrandbits(64)
    fps = sorted({base ^ (1 << rng.randrange(20)) ^ (1 << rng.randrange(20)) ^ (1 << rng.randrange(20)) for _ in range(400)})
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    got = {r.node % (1 << 64): r.root % (1 << 64) for r in components(simhash.links(df, tile=32)).collect()}
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    mine = [got.get(f, f) for f in fps]
    assert {(mine[i], find(i)) for i in range(len(fps))} == {(got.get(fps[find(i)], fps[find(i)]), find(i)) for i in range(len(fps))}
    assert len(set(mine)) == len({find(i) for i in range(len(fps))})


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 4, 6])
def test_bit_slices_are_exact(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    fps = np.concatenate([base[rng.integers(0, 12, 300)] ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64))])
    size = np.array([130, 1, 64, 105])
    start = np.concatenate([[0], np.cumsum(size)[:-1]])
    got = set()
    for i, j in simhash.close_pairs(fps, start, size, radius):
        got |= set(zip(i.tolist(), j.tolist(), strict=True))
    want = {(i, j) for s, n in zip(start, size, strict=True) for i in range(s, s + n) for j in range(s, i)
            if (int(fps[i]) ^ int(fps[j])).bit_count() <= radius}
    assert got == want


def test_empty_table(spark):
    assert run(spark, []) == []


def test_one_of_each_group_stays(spark):
    rows = corpus(5, 60)
    df = spark.createDataFrame([(d, t, None, "s", 1, "x") for d, t in [*rows, rows[0], (None, "q")]], SCHEMA)
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    want = {c for _, _, c in brute([*rows, (None, "q")]) if c is not None}
    got = [r.doc_id for r in kept.collect()]
    assert sorted(x for x in got if x is not None) == sorted(want) and got.count(None) == 1


def test_a_star_is_spread(spark):
    """A node with very many neighbours: its minimum goes to them, they do not gather at it."""
    from pyspark.sql import functions as F
    from wattline.llm.common import spread_join
    star = spark.range(1, 60_001, numPartitions=8).selectExpr("id AS a", "0L AS b")
    roots = components(star.unionByName(spark.createDataFrame([(70_001, 70_000)], "a long, b long")))
    assert sorted((r.root, r.n) for r in roots.groupBy("root").agg(F.count("*").alias("n")).collect()) == [(0, 60_000), (70_000, 1)]
    left = star.selectExpr("b AS u", "a AS v").unionByName(spark.range(500).selectExpr("id + 1 AS u", "-id AS v"))
    right = spark.range(600).selectExpr("id AS u", "id * 2 AS m")
    out = spread_join(left, right, "u", left.groupBy("u").agg(F.count("*").alias("n")))
    assert out.count() == 60_500 and out.where("m <> u * 2").isEmpty()
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 12_000


def test_repeated_doc_ids_keep_texts_that_have_no_copy(spark):
    """One doc_id over different texts: each text is judged by its own component, and reruns agree."""
    far = ["one two three four five six", "alpha beta gamma delta epsilon zeta eta", "uno dos tres cuatro cinco seis siete ocho"]
    rows = [(1, far[0]), (1, far[1]), (1, far[1]), (2, far[0]), (3, far[2]), (3, None), (3, None), (4, ""), (None, far[0])]
    df = spark.createDataFrame([(d, t, None, "s", i, "x") for i, (d, t) in enumerate(rows)], SCHEMA)
    want = sorted([(1, far[0]), (1, far[1]), (3, far[2]), (3, None), (None, far[0])], key=repr)
    for parts in (1, 5):
        kept = simhash.drop_near_duplicates(df.repartition(parts)).collect()
        assert sorted(((r.doc_id, r.text) for r in kept), key=repr) == want
        assert [r.n_chars for r in kept if r.text == far[1]] == [1]
