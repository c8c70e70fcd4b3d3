"""Deleted interpolation against a plain-Python model, the base score exactly, odd rows."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from wattline.llm import interpolate as lm

HELD = 1


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def part(i):
    return 0 if i is None else zlib.crc32(str(i).encode()) % 5


def histories(ws, k):
    padded = ["^"] * (k - 1) + ws
    return [(tuple(padded[i:i + k - 1]), w) for i, w in enumerate(ws)]


def brute(rows, order):
    """Scores by counts in dictionaries and EM over single events, a row of results per document."""
    docs = [(i, part(i), words(t)) for i, t in rows]
    parts = [p for p in range(5) if p != HELD]
    gram = {(k, p): Counter(h for _, q, ws in docs if q == p for h in histories(ws, k)) for k in range(1, order + 1) for p in parts}
    context = {key: Counter() for key in gram}
    for key, c in gram.items():
        for (h, _), n in c.items():
            context[key][h] += n
    known = {w for p in parts for (_, w) in gram[1, p]}

    def estimate(k, h, w, without):
        use = [p for p in parts if p != without]
        n = sum(context[k, p][h] for p in use)
        return (sum(gram[k, p][h, w] for p in use) / n if n else 0.0), math.frexp(n)[1] if n else 0

    weights = []

    def mixture(ws, i, without, upto):
        p = 1 / (len(known) + 1)
        for k in range(1, upto):
            h, w = histories(ws, k)[i]
            ml, b = estimate(k, h, w, without)
            v = weights[k - 1].get(b, 0.0)
            p = v * ml + (1 - v) * p
        return p

    for k in range(1, order + 1):
        events = defaultdict(list)
        for _, q, ws in docs:
            if q != HELD:
                for i, (h, w) in enumerate(histories(ws, k)):
                    ml, b = estimate(k, h, w, q)
                    events[b].append(ml / mixture(ws, i, q, k))
        weights.append({})
        for b, r in events.items():
            if b:
                v, r = 0.5, np.array(r)
                for _ in range(500):
                    v = ((v * r / (v * r + 1 - v)).sum() + 1) / (len(r) + 2)
                weights[-1][b] = v
    size = sum(len(ws) for _, q, ws in docs if q != HELD)
    out = []
    for i, q, ws in docs:
        c = [sum(gram[1, p][(), w] for p in parts) for w in ws]
        base = sum(math.log10((x + .5) / (size + .5 * (len(known) + 1))) for x in c)
        score = sum(math.log10(mixture(ws, j, None, order + 1)) for j in range(len(ws)))
        out.append((i, q == HELD and i is not None, len(ws), sum(x > 0 for x in c), size, base, score))
    return out


def corpus(n):
    rng = np.random.default_rng(5)
    w = [f"W{int(i)}" for i in np.minimum(rng.zipf(1.5, 4000), 300)]
    out = []
    for i in range(n):
        at = int(rng.integers(0, 3900))
        out.append((i, " ".join(w[at:at + int(rng.integers(0, 60))])))
    return out


def close(got, want):
    got, want = (sorted(x, key=repr) for x in (got, want))
    assert len(got) == len(want)
    key = sorted(((r[:5], r[5], r[6]) for r in want), key=lambda r: (repr(r[0]), r[1]))
    own = sorted(((tuple(r[:5]), r[5], r[6]) for r in got), key=lambda r: (repr(r[0]), r[1]))
    for a, b in zip(own, key, strict=True):
        assert a[0] == b[0] and math.isclose(a[1], b[1], rel_tol=1e-12, abs_tol=1e-12), (a, b)
        assert math.isclose(a[2], b[2], rel_tol=1e-4, abs_tol=1e-4), (a, b)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_against_counting(spark, order, monkeypatch):
    """Several blocks, several places."""
    monkeypatch.setattr(lm, "PLACE", 2_000)
    rows = corpus(150)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    close(lm.scores(docs, order).collect(), brute(rows, order))


def test_odd_rows(spark, odd):
    from conftest import ODD
    rows = [r for r in ODD if r[0] != 6] + [(6, "the quick brown fox " * 200, "en", "c", 1)] + [(i, "x Y z\x0bx\x85y", "en", "s", 1) for i in range(20, 40)]
    got = lm.scores(odd(rows))
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    close(got.collect(), brute([r[:2] for r in rows], 3))


def test_long_text_is_whole(spark, odd):
    from conftest import LONG
    rows = [(6, LONG, None, None, 0), *[(i, "the quick brown fox jumps", None, None, 0) for i in range(20, 30)]]
    got = {r.doc_id: r for r in lm.scores(odd(rows)).collect()}
    assert got[6].n_tokens == len(LONG.split()) + 1 and got[6].score > got[6].base_score


def test_empty_and_untrained(spark, odd):
    assert lm.scores(odd([])).count() == 0
    held = next(i for i in range(100) if part(i) == HELD)
    r = lm.scores(odd([(held, "a b", "en", "s", 3)])).first()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (True, 3, 0, 0, 0.0, 0.0)


def test_packing():
    low = np.sort(np.random.default_rng(1).integers(0, 1 << 40, 20_000).astype(np.uint64))
    assert (lm.undeltas(lm.deltas(low), 20_000) == low).all() and len(lm.deltas(low)) < 80_000
    wide = np.array([5, (1 << 40) - 1], np.uint64)
    assert (lm.undeltas(lm.deltas(wide), 2) == wide).all()
    for top in (3, 300, 70_000, 1 << 40):
        x = np.array([0, top, 1])
        assert (lm.large(lm.small(x), 3) == x).all()


def test_sparse_keys_stay_short():
    """The fewer n-grams of a block live at a place, the wider their differences: a byte more, not four."""
    low = np.sort(np.random.default_rng(1).integers(0, 1 << 40, 500).astype(np.uint64))
    assert (lm.undeltas(lm.deltas(low), 500) == low).all() and len(lm.deltas(low)) < 5 * 500
    assert (lm.undeltas(lm.deltas(low[:0]), 0) == low[:0]).all()


def test_totals_by_ranges(monkeypatch):
    """Sums over cells do not depend on the ranges of keys that are added up at a time."""
    rng = np.random.default_rng(3)
    keys = [np.unique(rng.integers(0, 1 << 63, 400).astype(np.uint64) >> np.uint64(rng.integers(0, 2) * 54)) for _ in range(6)] + [np.empty(0, np.uint64)]
    counts = [rng.integers(0, 3, (lm.LANES, len(k))).astype(np.int32) for k in keys]
    want = {}
    for k, x in zip(keys, counts, strict=True):
        for j, key in enumerate(k.tolist()):
            want[key] = want.get(key, 0) + x[:, j].astype(np.int64)
    for ranges in (1 << 20, 100, 7):
        monkeypatch.setattr(lm, "RANGE_OF", ranges)
        got, known = lm.totals(keys, [lm.lanes_packed(x) for x in counts])
        assert known == sum(bool(x.any()) for x in want.values())
        for k, raw in zip(keys, got, strict=True):
            assert (lm.lanes_read(raw, len(k)).T.tolist()) == [want[x].tolist() for x in k.tolist()]


def test_cells_follow_the_text(spark):
    """Rows that travel are blocks times places: few, however the documents lie."""
    text = " ".join(f"w{i}" for i in range(200_000))
    docs = spark.createDataFrame([(i, text) for i in range(4)], "doc_id long, text string").coalesce(1)
    chars = 4 * len(text)
    assert chars > 5 << 20 and lm.tokenized(docs).count() == 1
    places = max(1, -(-chars * lm.ORDER // (6 * lm.PLACE)))
    assert lm.requests(docs, places, lm.ORDER).count() == 1


def test_histogram_is_fine_enough():
    """Weights from binned ratios and from single ones."""
    rng = np.random.default_rng(2)
    r = np.where(rng.random(5000) < 0.4, 0.0, np.exp(rng.normal(1, 3, 5000)))
    at = np.where(r > 0, 1 + np.rint((np.log(np.maximum(r, 1e-300)) + lm.RANGE) * ((lm.BINS - 2) / (2 * lm.RANGE))), 0).astype(int)
    events, logs = np.zeros((2, lm.BUCKETS, lm.BINS))
    events[3] = np.bincount(at, minlength=lm.BINS)
    logs[3] = np.bincount(at, weights=np.log(np.maximum(r, 1e-300)), minlength=lm.BINS)
    w = 0.5
    for _ in range(500):
        w = ((w * r / (w * r + 1 - w)).sum() + 1) / (len(r) + 2)
    assert abs(lm.em(events, logs)[3] - w) < 1e-5


def test_ranked():
    """One sort of keys with their places gives what np.unique gives, also where keys and places exceed 64 bits."""
    rng = np.random.default_rng(5)
    close = (rng.integers(0, 50, 4000).astype(np.uint64) << np.uint64(40)) | rng.integers(0, 8, 4000).astype(np.uint64)
    for x in (np.empty(0, np.uint64), np.array([7], np.int64), rng.integers(0, 300, 5000), rng.integers(0, 1 << 40, 5000),
              rng.integers(0, 1 << 64, 5000, dtype=np.uint64), close, close << np.uint64(15),
              np.array([(1 << 64) - 1, 0, (1 << 64) - 2, (1 << 64) - 1], np.uint64)):
        got, index = lm.ranked(x)
        want, place = np.unique(x, return_inverse=True)
        assert got.dtype == x.dtype and got.tolist() == want.tolist() and index.tolist() == place.tolist()


def test_a_pass_reads_the_orders_it_needs():
    x = np.random.default_rng(6).integers(0, 3, (lm.LANES, 500))
    raw = lm.lanes_packed(x)
    for upto in (0, 1, 200, 500):
        assert lm.lanes_upto(raw, 500, upto).tolist() == x[:, :upto].tolist()
