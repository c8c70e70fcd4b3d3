"""Mixing against a plain heap apportionment and the shared SQL."""

import heapq
import random
import re

import duckdb
import pytest

from tests_llm_util import collected
from wattline.llm import mix


def plain_targets(sizes, weights=(1, 2, 3), repeat=3):
    """Round by round: whoever is above the cap stays there, the others share the rest."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        rest, all_w = total - sum(fixed.values()), sum(w[s] for s in free)
        over = [s for s in free if rest * w[s] / all_w > repeat * sizes[s]]
        if not over:
            return {**fixed, **{s: rest * w[s] / all_w for s in free}}
        fixed.update({s: repeat * sizes[s] for s in over})


def plain_quotas(targets, blocks):
    heap = [(-t, i, 0) for i, t in enumerate(targets) if t > 0]
    heapq.heapify(heap)
    got = [0] * len(targets)
    for _ in range(blocks if heap else 0):
        _, i, k = heapq.heappop(heap)
        got[i] += 1
        heapq.heappush(heap, (-targets[i] / (2 * k + 3), i, k + 1))
    return got


@pytest.mark.parametrize("seed", range(4))
def test_quotas_are_sainte_lague(spark, seed):
    rng = random.Random(seed)
    sizes = [rng.choice([0, 1, 5, 100, 1000, 30000]) for _ in range(rng.randint(1, 30))]
    total = sum(sizes)
    df = spark.createDataFrame([(f"s{i:02}", f"{i:02}", s) for i, s in enumerate(sizes)], "src string, source string, source_size long")
    t = mix.targets(df)
    rows = sorted(t.collect(), key=lambda r: r["rank"])
    want = plain_targets({r.source: r.source_size for r in rows}) if total else {r.source: 0 for r in rows}
    assert [r.target for r in rows] == pytest.approx([want[r.source] for r in rows])
    blocks = -(-total // 16)
    q = mix.quotas(t, blocks, 5).collect()
    for s in range(1, 6):
        got = {r["rank"]: r.upto for r in q if r.shard == s}
        assert [got[i + 1] for i in range(len(rows))] == plain_quotas([r.target for r in rows], blocks * s // 5)


def test_odd_rows(odd):
    rows = mix.mix(odd(), carry=["doc_id"]).select("doc.doc_id", "size", "source_size", "target", "taken").collect()
    assert len(rows) == 12
    size = {r.doc_id: r["size"] for r in rows}
    assert size[3] == size[4] == size[5] == 0 and size[6] == 200000 and size[7] == len(re.findall(r"[^\x20\x09-\x0D]+", "Straße é́ \U0001f600  x\x1fy"))
    assert all(0 <= r.taken <= 3 * r["size"] for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.target, [r.source_size, 0])[1] += r.taken
    assert all(abs(taken - target) <= 32 for target, (_, taken) in by.items())
    assert collected(mix.mix(odd(), carry=["doc_id"])) == collected(mix.mix(odd(), carry=["doc_id"]).repartition(5))
    assert collected(mix.mix(odd())) and mix.mix(odd([]), carry=["doc_id"]).count() == 0


def test_blocks_go_to_the_shards_of_their_quotas(odd):
    """The ring of each source, word by word: its blocks go to shards by plain quotas."""
    rng = random.Random(3)
    docs = [(i, "w " * rng.randint(0, 90), "en", rng.choice("aaaaabcd"), 1) for i in range(150)]
    rows = mix.mix(odd(docs), shards=5, carry=["doc_id", "source"]).collect()
    by = {}
    for r in rows:
        assert len(r.by_shard) == 5 and sum(r.by_shard) == r.taken
        by.setdefault(r.doc.source, []).append(r)
    names, blocks = sorted(by), -(-sum(r["size"] for r in rows) // 16)
    upto = [plain_quotas([by[s][0].target for s in names], blocks * k // 5) for k in range(6)]
    for i, s in enumerate(names):
        ring = [r.doc.doc_id for r in sorted(by[s], key=lambda r: (r.pos, r["size"])) for _ in range(r["size"])]
        got = {(r.doc.doc_id, k): n for r in by[s] for k, n in enumerate(r.by_shard) if n}
        want = {}
        for k in range(5):
            for w in range(min(upto[k][i] * 16, 3 * len(ring)), min(upto[k + 1][i] * 16, 3 * len(ring))):
                want[ring[w % len(ring)], k] = want.get((ring[w % len(ring)], k), 0) + 1
        assert got == want


def test_documents_of_the_mix(odd):
    df = odd([(i, "w " * (10 + i), "en", "abc"[i % 3], 1) for i in range(60)])
    plan = {r.doc.doc_id: r.taken / r["size"] for r in mix.mix(df).collect()}
    out = mix.mixed_documents(df)
    assert out.columns == df.columns
    n = {}
    for r in out.collect():
        n[r.doc_id] = n.get(r.doc_id, 0) + 1
    assert all(abs(n.get(d, 0) - x) <= 0.5 for d, x in plan.items())


def test_same_rows_as_sql(spark):
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{d}/documents.parquet'")
    want = sorted(con.sql(mix.SQL).fetchall())
    got = sorted(tuple(r) for r in mix.query(spark, d).collect())
    assert got == want
