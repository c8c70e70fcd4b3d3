"""Token files: the code against brute force, the round trip against the library."""

import heapq
import random
import tempfile
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tests_llm_util import collected
from wattline.llm import huffman


def optimum(weights):
    heap = list(weights)
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        a = heapq.heappop(heap) + heapq.heappop(heap)
        cost += a
        heapq.heappush(heap, a)
    return cost


def limited_optimum(weights, limit):
    """Least cost over all non-decreasing length sequences that satisfy Kraft."""
    weights, best = sorted(weights, reverse=True), [float("inf")]

    def go(i, least, room, cost):
        if i == len(weights):
            best[0] = min(best[0], cost)
            return
        for n in range(least, limit + 1):
            if (len(weights) - i) * 2.0 ** -limit <= room and 2.0 ** -n <= room:
                go(i + 1, n, room - 2.0 ** -n, cost + n * weights[i])
    go(0, 1, 1.0, 0)
    return best[0]


@pytest.mark.parametrize("seed", range(6))
def test_code_is_optimal(seed):
    rng = random.Random(seed)
    counts = np.array([rng.choice([0, 1, 2, 3, 50, 1000]) for _ in range(60)])
    n = huffman.code_lengths(counts, 40)
    assert ((n > 0) == (counts > 0)).all() and int((n * counts).sum()) == optimum(counts[counts > 0].tolist())
    few = np.array([rng.randint(1, 100) ** 2 for _ in range(7)])
    n = huffman.code_lengths(few, 4)
    assert n.max() <= 4 and int((n * few).sum()) == limited_optimum(few.tolist(), 4)


@pytest.mark.parametrize("seed", range(4))
def test_round_trip(seed):
    rng = np.random.default_rng(seed)
    n = rng.choice([1, 2, 511, 512, 513, 1024, 3000], 30)
    ids = (rng.pareto(0.5, int(n.sum())) * 3).clip(0, 49999).astype(np.uint32)
    lengths = huffman.code_lengths(np.bincount(ids, minlength=50000))
    payload, byte, marks, blocks = huffman.pack(ids, n, huffman.canonical(lengths), lengths)
    at = marks + np.repeat(byte[:-1] * 8, blocks)
    assert (huffman.unpack(payload[:byte[-1]], at, n, huffman.decoder(lengths)) == ids).all()
    assert sum(int(lengths[i]) for i in ids) <= byte[-1] * 8


def test_files_give_the_library_s_ids(odd, monkeypatch):
    monkeypatch.setattr(huffman, "SEGMENT", 600)
    monkeypatch.setattr(huffman, "PART", 3)
    rng = random.Random(1)
    words = ["naïve", "Ünïcode", "don't", "we'll", "İx", "ΣΑΣ", "áb", "<|endoftext|>", "x<|startoftext|>y", "12a3", " ", " q",
             "\x1c", "\t", "\r\n", "\n\n", "  ", "漢字", "\U0001f600", "!!!", "\x00", "̸", "ﬁ", "K", "Éa.", "éA***",
             "İstanbul", "straße,", "½x", "a_b", "x'", "'s", "Naïve's", "ĲǄ", "aͅb", "word-word", "(word)", "word...", "#", "日本語word"]
    rows = [(i * 7 % 97 - 40, "".join(rng.choice(words) + rng.choice([" ", "", "\n"]) for _ in range(rng.randint(0, 60))), "en", "s", 1)
            for i in range(90)]
    from conftest import ODD
    df = odd(rows + ODD)
    out = tempfile.mkdtemp(prefix="ids-") + "/ids"
    huffman.write_ids(df, huffman.word_tokenizer(), out)
    got = huffman.read_ids(df.sparkSession, out, with_ids=True).orderBy("start").collect()
    t = Tokenizer.from_file(huffman.word_tokenizer())
    want = [(r.doc_id, [*t.encode(r.text or "", add_special_tokens=False).ids, 1]) for r in df.collect()]
    assert sorted(((r.doc_id, r.ids) for r in got), key=repr) == sorted(want, key=repr)
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda x: (x is not None, x))
    at = 0
    for r in got:
        assert (r.start, r.n_tokens) == (at, len(r.ids))
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens
    again = huffman.read_ids(df.sparkSession, out)
    assert collected(again) == collected(df.sparkSession.createDataFrame(got).select(*again.columns))


def test_empty_table(odd):
    out = tempfile.mkdtemp(prefix="ids-") + "/ids"
    huffman.write_ids(odd([]), huffman.word_tokenizer(), out)
    assert huffman.read_ids(odd([]).sparkSession, out).count() == 0
