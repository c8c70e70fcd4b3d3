"""Shards: near equal bytes, gapless slots, texts together, hot texts spread."""

import zlib
from collections import Counter

import pytest

from tests_llm_util import collected
from wattline.llm import shard


def check(rows, shards=8, near=None):
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r)
        assert 0 <= r.shard < shards
    for s in by.values():
        assert sorted(r.slot for r in s) == list(range(len(s)))
    if near is not None:
        total = sum(r["size"] for r in rows)
        load = Counter({s: sum(r["size"] for r in x) for s, x in by.items()})
        assert len(load) == shards and max(abs(v - total / shards) for v in load.values()) <= near * total / shards


def test_odd_rows(odd):
    rows = shard.digest(shard.shard(odd())).collect()
    assert len(rows) == 12
    check(rows)
    texts = {r.doc.doc_id: r.doc.text for r in shard.shard(odd()).collect()}
    for r in rows:
        if r.doc_id is not None:
            t = (texts[r.doc_id] or "").encode()
            assert (r["size"], r.text_crc32) == (len(t) + 1, zlib.crc32(t))
    assert shard.digest(shard.shard(odd([]))).count() == 0
    assert collected(shard.digest(shard.shard(odd(), carry=["doc_id"]))) == collected(shard.digest(shard.shard(odd())))


@pytest.mark.parametrize("ranges", [16, 1024])
def test_equal_bytes_with_a_hot_text(odd, ranges):
    rows = [(i, "hot text of very many copies " * 3 if i % 3 == 0 else f"text {i // 4} " * (1 + i % 37), "en", "a", 1) for i in range(3000)]
    got = shard.shard(odd(rows), ranges=ranges, carry=["doc_id", "text"]).select("doc.*", "size", "shard", "slot").collect()
    assert len(got) == 3000
    check(got, near=0.08)
    homes = {}
    for r in got:
        homes.setdefault(r.text, set()).add(r.shard)
    assert len(homes.pop("hot text of very many copies " * 3)) > 1
    assert all(len(h) == 1 for h in homes.values())


def test_splitters_are_searched_right(spark):
    from pyspark.sql import functions as F
    cuts = [-5, 0, 7, 7_000_000_000]
    for cut in (cuts, cuts[:1], cuts[:3], []):
        keys = [-9, -5, -1, 0, 6, 7, 8, 2 ** 62]
        got = spark.createDataFrame([(k,) for k in keys], "k long").select("k", shard.range_of(F.col("k"), cut).alias("r")).collect()
        assert {r.k: r.r for r in got} == {k: sum(c <= k for c in cut) for k in keys}


def test_a_group_under_the_limit_across_a_border_stays_together(odd):
    """3 % of a shard is more than two ranges, so the text is cut into pieces; it lies across a border."""
    rows = [(i, f"text {i} " + "x" * 40, "en", "a", 1) for i in range(8000)]
    total = sum(len(t) + 1 for _, t, *_ in rows)
    texts = [f"copy {i} " + "y" * 40 for i in range(400)]
    size = len(texts[0]) + 1
    n = round(0.03 * total / 8 / size)
    spark = odd([]).sparkSession
    from pyspark.sql import functions as F
    keys = dict(spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.xxhash64("t")).collect())
    share = {t: (k + 2 ** 63) / 2 ** 64 * 8 for t, k in keys.items()}
    hashes = sorted(r.h for r in spark.createDataFrame([(r[1],) for r in rows], "t string").select(F.xxhash64("t").alias("h")).collect())

    def off(t):
        """Distance of the group's middle from the nearest border, in shards."""
        below = sum(h < keys[t] for h in hashes) / len(hashes) * total
        at = (below + n * size / 2) / (total + n * size) * 8
        return abs(at - round(at)) if 0.5 < share[t] < 7.5 else 1.0
    hot = min(texts, key=off)
    assert off(hot) < 0.01                          # the group reaches 0.015 shards to both sides
    rows += [(10000 + i, hot, "en", "a", 1) for i in range(n)]
    got = shard.shard(odd(rows), carry=["doc_id", "text"]).select("doc.*", "size", "shard", "slot").collect()
    check(got, near=0.08)
    assert len({r.shard for r in got if r.text == hot}) == 1
