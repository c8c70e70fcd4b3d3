"""Line dedup against comparing all pairs of lines."""

import random

import numpy as np
import pytest

from wattline.llm import lines
from tests_llm_util import collected


def brute(rows):
    """{(doc_id, text): kept line numbers}, by all pairs of lines."""
    docs = sorted({(d, t) for d, t in rows if t is not None}, key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    places = [(d, n, t, line) for d, t in docs for n, line in enumerate(t.split("\n")) if line.strip()]
    root = list(range(len(places)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    sets = [lines.shingles(p[3]) for p in places]
    for i in range(len(places)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both / (len(sets[i]) + len(sets[j]) - both) >= 0.8:
                root[find(i)] = find(j)
    out = {(d, t): [] for d, t in rows}
    for c in {find(i) for i in range(len(places))}:
        d, n, t, _ = min((places[i] for i in range(len(places)) if find(i) == c), key=lambda p: (p[0] is not None, p[0] or 0, p[1]))
        out[d, t].append(n)
    return {k: sorted(v) for k, v in out.items()}


def check(df, texts, **options):
    want = brute(texts)
    got = lines.dedup_lines(df, **options).collect()
    assert len(got) == len(want)
    for r in got:
        mine = [(k, v) for k, v in want.items() if k[0] == r.doc_id and v == r.kept]
        assert mine, (r.doc_id, r.kept)
    by = {r.doc_id: r for r in got}
    for (d, t), kept in want.items():
        if d is not None and t is not None and len([k for k in want if k[0] == d]) == 1:
            assert by[d].text == "\n".join(x for n, x in enumerate(t.split("\n")) if not x.strip() or n in kept)
            assert by[d].n_lines == sum(bool(x.strip()) for x in t.split("\n"))


def corpus(seed, n):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    pool = []
    rows = []
    for i in range(n):
        doc = []
        for _ in range(rng.randint(0, 6)):
            kind = rng.random()
            if pool and kind < .6:
                words = rng.choice(pool).split(" ")
                for _ in range(rng.choice([0, 1, 1, 3])):
                    words[rng.randrange(len(words))] = rng.choice(vocab)
                line = " ".join(words)
            else:
                line = " ".join(rng.choice(vocab) for _ in range(rng.choice([1, 4, 30, 60])))
            pool.append(line)
            doc.append(rng.choice([line, line, line + "  ", "", line.upper()]))
        rows.append((i, "\n".join(doc)))
    return rows


@pytest.mark.parametrize("tile", [256, 3])
def test_against_all_pairs(odd, tile):
    """Bands enough to bring every similar pair of this corpus together."""
    rows = corpus(tile, 60)
    check(odd([(d, t, "en", "s", 1) for d, t in rows]), rows, bands=40, rows=2, tile=tile)


def test_odd_rows(odd):
    from conftest import ODD
    rows = [(r[0], r[1]) for r in ODD if r[0] != 6] + [(50, "alpha beta gamma\n\n \nALPHA  beta gamma"), (51, "z" * 100000)]
    check(odd([r for r in ODD if r[0] != 6] + [(d, t, "x", None, 1) for d, t in rows[-2:]]), rows)
    assert lines.dedup_lines(odd([])).count() == 0
    assert collected(lines.dedup_lines(odd())) == collected(lines.dedup_lines(odd().repartition(3)))


def test_banding_recall():
    rng = random.Random(1)
    found = n = 0
    while n < 300:
        a = "".join(rng.choice("abcdefgh ") for _ in range(300))
        b = list(a)
        for _ in range(rng.randint(2, 4)):
            b[rng.randrange(300)] = "z"
        b = "".join(b)
        x, y = lines.shingles(a), lines.shingles(b)
        if 0.8 <= len(x & y) / len(x | y) < 0.88:
            k = lines.band_keys([a, b])
            found += bool((k[0] == k[1]).any())
            n += 1
    assert found / n >= 0.985


def near_threshold(seed, n):
    """n pairs of lines of similarity 0.8 to 0.82."""
    rng, out = random.Random(seed), []
    while len(out) < n:
        a = "".join(rng.choice("abcdefgh ") for _ in range(300))
        b = list(a)
        for _ in range(rng.randint(3, 4)):
            b[rng.randrange(300)] = "z"
        b = "".join(b)
        x, y = lines.shingles(a), lines.shingles(b)
        if 0.8 <= len(x & y) / len(x | y) < 0.82:
            out.append((a, b))
    return out


def test_production_banding_at_the_threshold():
    assert 1 - (1 - lines.SIMILARITY ** lines.ROWS) ** lines.BANDS >= 0.998
    pairs = near_threshold(5, 2000)
    a, b = lines.band_keys([a for a, _ in pairs]), lines.band_keys([b for _, b in pairs])
    assert (a == b).any(axis=1).mean() >= 0.998


def test_production_banding_against_all_pairs(odd):
    """Default parameters on a corpus and on pairs just over the threshold."""
    rows = corpus(7, 60) + [(1000 + i, f"{a}\n{b}") for i, (a, b) in enumerate(near_threshold(6, 60))]
    check(odd([(d, t, "en", "s", 1) for d, t in rows]), rows)


def test_minhash_estimates_jaccard():
    rng = random.Random(2)
    a = "".join(rng.choice("abcdefgh ") for _ in range(400))
    b = a[:200] + "".join(rng.choice("abcdefgh ") for _ in range(200))
    x, y = lines.shingles(a), lines.shingles(b)
    k = lines.band_keys([a, b], bands=2000, rows=1)
    assert abs(np.mean(k[0] == k[1]) - len(x & y) / len(x | y)) < 0.04


def test_large_buckets_stream_in_chunks(spark):
    rng = random.Random(3)
    rows = [(k, i) for i, k in enumerate(rng.choice([1, 2, 2, 2, 2, 5, 7, 8, 9, 10, 11]) for _ in range(500))] + [(99, 1000)]
    got = lines.buckets(spark.createDataFrame(rows, "k long, id long"), 20).collect()
    by = {}
    for r in got:
        by.setdefault(r.k, []).append(r)
    assert 99 not in by
    for k, parts in by.items():
        assert sorted(i for r in parts for i in r.ids) == sorted(i for x, i in rows if x == k)
        assert sorted(r.c for r in parts) == list(range(len(parts))) and all(len(r.ids) <= 20 for r in parts)
        assert all(r.large == (len(parts) > 1) for r in parts)


def test_lines_that_share_a_hash_all_stay(odd, monkeypatch):
    import pyspark.sql.functions as F
    real = lines.occurrences
    monkeypatch.setattr(lines, "occurrences", lambda docs: real(docs).withColumn(
        "id", F.when(F.col("line").startswith("same"), 5).otherwise(F.col("id"))))
    got = {r.doc_id: r.kept for r in lines.dedup_lines(odd([(1, "same one\nother", "en", "s", 1), (2, "other\nsame two\nlast", "en", "s", 1)])).collect()}
    assert got == {1: [0, 1], 2: [1, 2]}


@pytest.mark.parametrize("n", [2, 5, 8, 60])
def test_linked_groups(n, monkeypatch):
    monkeypatch.setattr(lines, "COLUMNS", 100)
    rng = random.Random(n)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(200)) for _ in range(3)]
    texts = []
    for _ in range(n):
        t = list(rng.choice(base))
        for _ in range(rng.randint(0, 6)):
            t[rng.randrange(len(t))] = rng.choice("xyz")
        texts.append("".join(t))
    sets = [lines.shingles(t) for t in texts]
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(n):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                root[max(find(i), find(j))] = min(find(i), find(j))
    assert dict(lines.linked(texts)) == {i: find(i) for i in range(n) if find(i) != i}
