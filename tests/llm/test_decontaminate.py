"""Q-gram filtering against alignment of every item to every text."""

import random

import numpy as np
import pytest

from wattline.llm import decontaminate as dc


def least_edits(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def edited(rng, text, n):
    for _ in range(n):
        i = rng.randrange(len(text))
        text = rng.choice([text[:i] + "z" + text[i:], text[:i] + text[i + 1:], text[:i] + "y" + text[i + 1:]])
    return text


def sentence(rng, n):
    return " ".join("".join(rng.choice(["an", "er", "tion", "ha", "ou", "st"]) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.mark.parametrize("q", [1, 2, 3, 7, 10, 16])
def test_grams_are_equal_where_texts_are(q):
    rng = random.Random(q)
    t = "".join(rng.choice("ab") for _ in range(300))
    h = dc.grams(dc.codes_of(t), q)
    seen = {}
    for i in range(len(t) - q + 1):
        assert seen.setdefault(t[i:i + q], h[i]) == h[i]
    assert len(set(seen.values())) == len(seen) and len(h) == len(t) - q + 1
    assert len(dc.grams(dc.codes_of("a" * (q - 1)), q)) == 0


@pytest.mark.parametrize("seed", range(3))
def test_no_region_is_lost(seed):
    rng = random.Random(seed)
    items = [(i, sentence(rng, rng.choice([4, 9, 20, 40, 60]))) for i in range(12)]
    index = dc.build(items)
    texts = []
    for _ in range(60):
        i, t = rng.choice(items)
        texts.append(dc.normal(sentence(rng, rng.randint(0, 30)) + " " + edited(rng, t, rng.choice([0, 1, 3, 8, 14, 25])) + " " + sentence(rng, rng.randint(0, 30))))
    got = dc.regions(index, texts, index.bitmap())
    for text, found in zip(texts, got, strict=True):
        want = {s for s, p in enumerate(index.texts) if least_edits(p, text) <= index.edits[s]}
        assert {s for s, *_ in found} == want
        for s, a, b, e in found:
            assert least_edits(index.texts[s], text[a:b]) <= e <= index.edits[s]


def test_alignment():
    rng = random.Random(5)
    for _ in range(200):
        p = "".join(rng.choice("abc") for _ in range(rng.randint(1, 12)))
        t = "".join(rng.choice("abc") for _ in range(rng.randint(0, 15)))
        cost, end = dc.align(dc.codes_of(p).astype(np.int64), dc.codes_of(t).astype(np.int64), -len(p), len(t))
        assert cost == least_edits(p, t) and 0 <= end <= len(t)


def test_very_long_text_is_read_whole(monkeypatch):
    monkeypatch.setattr(dc, "CHUNK", 1000)
    rng = random.Random(9)
    items = [(1, sentence(rng, 30)), (2, sentence(rng, 30))]
    filler = sentence(rng, 3000)
    index = dc.build(items)
    for at in range(0, 3000, 251):
        text = dc.normal(filler[:at] + " " + items[0][1] + " " + filler[at:])
        assert {index.items[s] for s, *_ in dc.regions(index, [text], index.bitmap())[0]} == {1}


def test_odd_rows(odd, spark, monkeypatch):
    bench = spark.createDataFrame([(1, "alpha beta gamma", 3), (2, None, 3), (3, "", 3), (4, "short", 3), (None, "negative  ID second LINE", 3),
                                   (5, "the quick brown fox jumps over a lazy dog again. " * 20, 3), (1, "alpha beta gamma", 3)],
                                  "item_id long, text string, doc_id long")
    want = {(1, 1), (2, 1), (-8, -1), (6, 5)}
    got = dc.contaminated(odd(), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == 5
    monkeypatch.setattr(dc, "SLICE", 500)
    assert {(r.doc_id, r.item_id) for r in dc.contaminated(odd(), bench).collect()} == want
    kept = dc.drop_contaminated(odd(), bench)
    assert kept.columns == odd().columns and {r.doc_id for r in kept.collect()} == {3, 4, 5, None, 7, 2 ** 62} and kept.count() == 7
    assert dc.contaminated(odd([]), bench).count() == 0 and dc.contaminated(odd(), bench.limit(0)).count() == 0
    assert dc.drop_contaminated(odd(), bench.limit(0)).count() == 12
