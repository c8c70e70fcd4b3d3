"""Grammar on clauses, held-out accuracy on the test tables."""

import zlib

import pytest

from wattline.llm import toxicity
from wattline.llm.common import table
from wattline.llm.toxicity import Model


def test_grammar_weighs_clauses():
    m = Model({"idiot": 0.9, "scum": 0.9}, {"lowei": 0.9})
    plain, aimed = m.score("the idiot went home."), m.score("you idiot went home.")
    negated, told = m.score("he is simply not an idiot."), m.score("he said that idiot went home.")
    assert m.base < negated < plain < aimed and told < plain
    assert m.score("not here. the idiot went home.") == pytest.approx(plain)      # negation ends with its clause
    assert m.score('the "idiot" went home.') < plain
    assert m.score("I will kill you") > 0.4 > m.score("to kill a process") and m.score("kind words") == m.base
    assert m.score("IDIOT%%% x") > 0.5 and m.score("loweischaft") > 0.5 > m.score("lowe") and m.score("idiotproof") == m.base
    assert m.score("idiot. scum.") > plain


def test_composition_is_the_product():
    parts = [toxicity.threat(0.35), toxicity.target(0.3), toxicity.negation(0.3), toxicity.reported(0.5)]
    g = toxicity.Grammar(*parts)
    state, states = g.start, [p.start for p in parts]
    for c in "wyintqiqrtywni":
        state, factor, extra = g.arc(state, c)
        steps = [p.step(s, c) for p, s in zip(parts, states, strict=True)]
        states = [s for s, _, _ in steps]
        f = x = 1.0
        for _, a, b in steps:
            f, x = f * a, x * (1 - b)
        assert state == tuple(states) and factor == f and extra == pytest.approx(1 - x)


def test_words_need_evidence(spark):
    """A general insult is no verdict by itself, at a target it is one; threats weigh at a target."""
    rows = [(i, f"to feed the {"zorgish" if i % 2 else "calm"} farmer, a dinner, a process, text {i}", i % 2) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    m = toxicity.learn(docs, docs.select("doc_id", "toxic"))
    for text in ("farmer feed a pig", "jerk chicken for dinner", "to kill a process", "a calm day"):
        assert m.score(text) < 0.5, text
    for text in ("I will kill you", "you are a pig", "so zorgish"):
        assert m.score(text) >= 0.5, text
    assert m.score("he is not a pig") < m.score("he is a pig") and m.score("not zorgish") < m.score("zorgish")


def test_rare_entries_are_learned_at_every_size():
    """Evidence admits an entry, not its share of the sample; clean uses keep one out."""
    many = [["common"]] * 4000 + [["rare"]] * 5 + [["both"]] * 5
    clean = [["both"]] * 6 + [["other"]] * 3000
    assert toxicity.greedy(many, clean) == {"common", "rare"}
    assert toxicity.lower_bound(5, 0) > 0.7 > 0.5 > toxicity.lower_bound(5, 6) and toxicity.lower_bound(0, 0) == 0


def test_held_out_accuracy(spark):
    """The table's labels are noisy: some toxic ones hang on texts without any toxic word."""
    d = "/root/testdata/sf0.1"
    got = toxicity.query(spark, d).join(table(spark, d, "labels"), "doc_id").where("held_out").collect()
    good = sum(r.predicted == r.toxic for r in got) / len(got)
    found = [r.predicted for r in got if r.toxic]
    assert good >= 0.97 and sum(found) / len(found) >= 0.84
    lang = {r.doc_id: r.lang for r in table(spark, d, "documents").select("doc_id", "lang").collect()}
    for language in ("en", "fr", "de", "es"):
        own = [r for r in got if lang[r.doc_id] == language]
        caught = [r.predicted for r in own if r.toxic]
        assert len(caught) < 15 or sum(caught) / len(caught) >= 0.6, language
        assert sum(r.predicted for r in own if not r.toxic) <= 0.03 * len(own)
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in got)
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in got)


def test_odd_rows(odd, spark):
    labels = spark.createDataFrame([(1, 1, None), (1, 0, 1), (2, None, 0), (None, 1, 1), (3, 1, 0), (99, 1, 1), (6, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    model = toxicity.learn(odd(), labels)
    got = toxicity.scores(odd(), model).collect()
    assert len(got) == 12 and all(0 <= r.score <= 1 for r in got)
    assert toxicity.scores(odd([]), toxicity.learn(odd([]), labels.limit(0))).count() == 0
    kept = toxicity.drop_toxic(odd([(1, "you idiot", "en", "s", 1), (2, "kind", "en", "s", 1), (None, None, None, None, None)]), labels.limit(0))
    assert kept.columns == odd().columns and sorted(str(r.doc_id) for r in kept.collect()) == ["2", "None"]
