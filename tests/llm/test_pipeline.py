"""The pipeline's stages against plain versions of each, on a small table."""

import os
import tempfile
from collections import Counter

import corpus_pipeline
from test_decontaminate import least_edits, sentence
from test_simhash import brute

from wattline.llm import decontaminate


def small(spark, rng):
    """A folder with documents, labels and benchmark."""
    items = [(i, sentence(rng, 30)) for i in range(4)]
    rows = []
    for i in range(120):
        t = sentence(rng, rng.choice([3, 30, 80]))
        if i % 10 == 3:
            t += " you idiot. " + sentence(rng, 5)
        if i % 10 == 5:
            t += " " + items[i % 4][1] + " " + sentence(rng, 5)
        if i % 10 == 7:
            t = rows[i - 1][1]
        rows.append((i, t, "en", f"s{i % 3}", len(t)))
    rows += [(200, None, None, None, None), (201, "", "en", "s1", 0), (None, "without an id at all", None, None, 3)]
    d = tempfile.mkdtemp(prefix="small-")
    spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, shard int") \
        .write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, int("idiot" in (t or ""))) for i, t, *_ in rows if i is not None], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d, rows, items


def test_stages(spark):
    import random
    d, rows, items = small(spark, random.Random(6))
    docs = spark.read.parquet(f"{d}/documents.parquet")
    want = [r for r in rows if "idiot" not in (r[1] or "")]
    columns = docs.columns
    index = decontaminate.build(items)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, d)
        path = os.path.join(d, name)
        out.write.parquet(path)
        out = spark.read.schema(out.schema).parquet(path)
        if name != "shard":
            assert out.columns == columns
            got = sorted((tuple(r)[:5] for r in out.collect()), key=repr)
        if name == "near_dedup":
            stay = {c for _, _, c in brute([r[:2] for r in want])}
            want = [r for r in want if r[0] is None or r[0] in stay]
        if name == "decontaminate":
            want = [r for r in want if all(least_edits(p, decontaminate.normal(r[1])) > index.edits[s] for s, p in enumerate(index.texts))]
        if name in ("toxicity", "near_dedup", "decontaminate"):
            assert got == sorted(want, key=repr)
        if name == "mix":
            assert set(got) <= set(want) and max(Counter(got).values()) <= 3
            words = Counter()
            for r in got:
                words[r[3]] += len((r[1] or "").split())
            size = Counter()
            for r in want:
                size[r[3]] += len((r[1] or "").split())
            weight = {s: w for s, w in zip(sorted(x for x in size if x), [1, 2, 3], strict=True)}
            free = sum(size.values()) - 3 * size[None]
            for s, w in weight.items():
                target = min(3 * size[s], free * w / 6)
                assert abs(words[s] - target) < 90
            kept = got
        if name == "shard":
            assert sorted((r.doc_id for r in out.collect()), key=str) == sorted((r[0] for r in kept), key=str)
            for s in range(8):
                slots = sorted(r.slot for r in out.collect() if r.shard == s)
                assert slots == list(range(len(slots)))
        docs = out


def test_run(spark):
    import random
    d, *_ = small(spark, random.Random(8))
    out = corpus_pipeline.run(spark, d)
    assert out.count() > 0 and set(out.columns) >= {"doc_id", "shard", "slot"}
    again = corpus_pipeline.run(spark, d)
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(map(tuple, again.collect()), key=repr)
