"""Toxicity by a weighted finite-state pattern grammar.

Words map to symbols (insult, threat, target, negation, reported speech,
quote, other). Five small transducers read a clause's symbols side by side;
their composition weighs each insult or threat in its clause: a target near it
raises it, a negation before it or reported speech around it lowers it. A
clause scores the noisy-or of its matches, a document that of its clauses.

The lexicon grows from labels: words and word stems over-represented in toxic
rows of a bounded sample (SAMPLE rows of each label, by hash of the doc_id), chosen
greedily by the rows that others don't explain. An entry is admitted by
evidence alone, whatever the table's size: SUPPORT such rows, and a lower confidence
bound of more than a half for the share of toxic rows among those that it explains. Words of good
odds whose rows others explain weigh HINT: one of them decides nothing. General insults
are known beforehand, but without evidence one weighs less than a half unless it is aimed at a target.
The weights of entries and of the grammar's arcs (threat, threat at a target, insult at a
target, negation, reported speech, no match) are
estimated on the same sample, each from the rows that it decides, with priors of PRIOR_ROWS rows. Rows whose crc32(doc_id) mod 5 is 0 are never
learned from, and scores read the text alone.

Null and empty texts score as texts without a match. A row without a doc_id is
scored like any other; its label is never used. Documents labelled twice count
as toxic if any label says so. Repeated rows give repeated rows, empty tables
an empty result, and without labels the general lexicon stands alone.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm.common import cut, table

#: Labelled rows of each label that the lexicon is learned from.
SAMPLE = 6000
#: Candidate words and stems, the least toxic rows that one must explain, and the confidence (in deviations) of its odds.
CANDIDATES, SUPPORT, SURE = 3000, 3, 1.28
STEMS = range(3, 9)

INSULTS = ("idiot idiots moron morons stupid scum trash loser losers pathetic worthless disgusting clown clowns imbecile "
           "bastard bitch asshole dumbass jerk freak pig vermin filth retard whore slut coward").split()
THREATS = "kill hurt stab shoot burn destroy beat punch strangle murder attack smash".split()
TARGETS = ("you your yours yourself u ur he she they them him her his their this these those people everyone "
           "du dich dir ihr sie tu toi vous ton votre ils tú usted ustedes ellos tus").split()
NEGATIONS = ("not never neither nor hardly isn aren wasn weren ain don doesn didn won nicht kein keine niemals pas "
             "jamais aucun nunca jamás ningún tampoco").split()
REPORTED = ("said says say told tells called calls calling claimed claims wrote writes quoted reported allegedly accused "
            "sagte sagt behauptet dit affirme dijo dice afirma").split()

CLAUSE = re.compile(r"[.!?;:\n]+")
TOKEN = re.compile(r"\w+|[\"“”«»]")
WORD = re.compile(r"\w+")
NEAR = 3                        # tokens within which target and negation bind
#: Priors of the arcs: chance that a text is toxic whose match is negated, reported, a threat, a threat at a target, a
#: general insult, one at a target.
PRIOR_NEGATED, PRIOR_REPORTED, PRIOR_ROWS = 0.3, 0.5, 4.0
HINT = 0.4                      # of a word that does not decide alone
PRIOR_THREAT, PRIOR_AIMED, PRIOR_INSULT, PRIOR_TARGET = 0.1, 0.75, 0.4, 0.65


@dataclass
class Transducer:
    """step(state, symbol) -> (state, factor on a match at this symbol, extra match weight)."""
    start: int
    step: object


def matcher() -> Transducer:
    return Transducer(0, lambda s, c: (0, 1.0, 0.0))


def extra(aimed: float, plain: float) -> float:
    """What a target adds, so that plain and extra together weigh ``aimed``."""
    return max(0.0, 1 - (1 - aimed) / (1 - plain))


def threat(weight: float) -> Transducer:
    """A threat verb weighs fully only if a target follows or precedes it closely."""
    def step(s, c):
        if c == "t":
            return NEAR, 1.0, 0.0
        if c == "y" and s > 0:
            return 0, 1.0, weight
        return max(0, s - 1), 1.0, 0.0
    return Transducer(0, step)


def target(weight: float) -> Transducer:
    """Positive states: a match was near; negative: a target was near."""
    def step(s, c):
        if c == "y":
            return (0, 1.0, weight) if s > 0 else (-NEAR, 1.0, 0.0)
        if c == "i":
            return (NEAR, 1.0, weight) if s < 0 else (NEAR, 1.0, 0.0)
        return (s - 1 if s > 0 else s + 1 if s < 0 else 0), 1.0, 0.0
    return Transducer(0, step)


def negation(factor: float) -> Transducer:
    def step(s, c):
        if c == "n":
            return NEAR, 1.0, 0.0
        if c in "it" and s > 0:
            return 0, factor, 0.0
        return max(0, s - 1), 1.0, 0.0
    return Transducer(0, step)


def reported(factor: float) -> Transducer:
    """State bits: 1 after a verb of saying, 2 inside quotation marks."""
    def step(s, c):
        if c == "r":
            return s | 1, 1.0, 0.0
        if c == "q":
            return s ^ 2, 1.0, 0.0
        return s, factor if s and c in "it" else 1.0, 0.0
    return Transducer(0, step)


class Grammar:
    """Composition of transducers; product states and arcs are made once met."""

    def __init__(self, *parts: Transducer):
        self.parts = parts
        self.start = tuple(p.start for p in parts)
        self.arcs: dict = {}

    def arc(self, state: tuple, symbol: str) -> tuple[tuple, float, float]:
        if (known := self.arcs.get((state, symbol))) is None:
            steps = [p.step(s, symbol) for p, s in zip(self.parts, state, strict=True)]
            known = self.arcs[state, symbol] = (
                tuple(s for s, _, _ in steps), math.prod(f for _, f, _ in steps), 1 - math.prod(1 - x for _, _, x in steps))
        return known


@dataclass
class Model:
    words: dict[str, float]                       # insult -> weight
    stems: dict[str, float] = field(default_factory=dict)
    negated: float = PRIOR_NEGATED
    reported: float = PRIOR_REPORTED
    base: float = 0.02                            # a text without a match
    threat: float = PRIOR_THREAT
    aimed: float = PRIOR_AIMED                    # a threat at a target
    target: float = extra(PRIOR_TARGET, PRIOR_INSULT)

    def __post_init__(self):
        self.symbols = {w: s for s, ws in (("y", TARGETS), ("n", NEGATIONS), ("r", REPORTED), ("t", THREATS)) for w in ws}
        self.heads = {w[:STEMS.start] for w in self.stems}
        self.rare = set(self.words) | set(THREATS)
        self.grammar = Grammar(matcher(), threat(extra(self.aimed, self.threat)), target(self.target), negation(self.negated), reported(self.reported))

    def weight(self, word: str) -> float:
        w = self.words.get(word, 0.0)
        if word[:STEMS.start] in self.heads:
            w = max([w, *(self.stems.get(word[:n], 0.0) for n in STEMS if n < len(word))])
        return w

    def clause(self, text: str) -> float:
        """Noisy-or of the clause's matches, each weighed by the grammar."""
        state, clean, last = self.grammar.start, 1.0, 0.0
        for token in TOKEN.findall(text):
            weight = self.weight(token)
            symbol = "i" if weight else self.symbols.get(token, "q" if token in '"“”«»' else "w")
            state, factor, extra = self.grammar.arc(state, symbol)
            if symbol in "it":
                last = factor
                clean *= 1 - (weight or self.threat) * factor
            clean *= 1 - extra * last
        return 1 - clean

    def score(self, text: str | None) -> float:
        low = (text or "").lower()
        words = set(WORD.findall(low))
        heads, n = self.heads, STEMS.start
        if self.rare.isdisjoint(words) and not any(w[:n] in heads for w in words):
            return self.base
        clean = 1 - self.base
        for c in CLAUSE.split(low):
            clean *= 1 - self.clause(c)
        return 1 - clean


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def features(text: str) -> set[str]:
    """Words and, marked by a trailing *, their stems."""
    words = set(WORD.findall(text.lower()))
    return words | {w[:n] + "*" for w in words for n in STEMS if len(w) > n}


def sample(docs: DataFrame, labels: DataFrame, rows: int) -> tuple[DataFrame, float, float]:
    """(toxic, text) of up to ``rows`` rows of each label, and how many each row stands for."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")) \
        .where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id"))) \
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = cut(known, "toxic-labels")
    n = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    picked = None
    for y in (1, 0):
        part = known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        picked = part if picked is None else picked.unionByName(part)
    picked = cut(picked, "toxic-sample")           # at most 2 * rows
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    out = cut(texts.join(F.broadcast(picked), "doc_id").select("toxic", "text"), "toxic-texts")
    return out, max(1.0, n.get(1, 0) / rows), max(1.0, n.get(0, 0) / rows)


def learn(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> Model:
    """Fit lexicon and weights on the bounded sample."""
    texts, per_toxic, per_clean = sample(docs, labels, rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = Counter(), Counter()
        for b in batches:
            for y, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                seen[y == 1].update(features(t))
        toxic, clean = seen[1], seen[0]
        yield pa.RecordBatch.from_arrays([
            pa.array(list(toxic), pa.string()), pa.array(list(toxic.values()), pa.int64()),
            pa.array([clean.get(f, 0) for f in toxic], pa.int64())], ["feature", "toxic", "clean"])
        rest = [f for f in clean if f not in toxic]
        yield pa.RecordBatch.from_arrays([
            pa.array(rest, pa.string()), pa.array([0] * len(rest), pa.int64()), pa.array([clean[f] for f in rest], pa.int64())],
            ["feature", "toxic", "clean"])

    odds = F.col("toxic") * per_toxic / (F.col("toxic") * per_toxic + F.col("clean") * per_clean)    # most promising first
    strong = texts.mapInArrow(count, "feature string, toxic long, clean long").groupBy("feature") \
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")) \
        .where((F.col("toxic") >= SUPPORT) & (odds > 0.5)) \
        .orderBy(F.desc("toxic"), "feature").limit(CANDIDATES).collect()
    known = {r.feature for r in strong} | set(INSULTS)

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [sorted(features(t) & known) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.string()))], ["toxic", "found"])

    seen = [(r.toxic == 1, r.found) for r in texts.mapInArrow(hits, "toxic int, found array<string>").collect()]
    toxic, clean = Counter(), Counter()
    for y, found in seen:
        (toxic if y else clean).update(found)
    # rows as the sample has them; where it was cut, clean rows stand for more or fewer than toxic ones
    chosen = greedy([f for y, f in seen if y], [f for y, f in seen if not y], per_clean / per_toxic)

    hints = seconds(toxic, clean, per_clean / per_toxic) - chosen

    def weight(f):
        t, c = toxic[f] * per_toxic, clean[f] * per_clean
        if f in chosen:
            return (t + 3) / (t + c + 3.5)
        if f in hints:
            return HINT
        return (t + PRIOR_INSULT * PRIOR_ROWS) / (t + c + PRIOR_ROWS)
    entries = chosen | hints | set(INSULTS)
    model = Model({f: weight(f) for f in entries if not f.endswith("*")},
                  {f[:-1]: weight(f) for f in entries if f.endswith("*")})
    return calibrated(model, texts, per_toxic, per_clean)


def lower_bound(t: float, c: float, z: float = SURE) -> float:
    """Wilson's lower bound of t / (t + c)."""
    n = t + c
    if not n:
        return 0.0
    p = t / n
    return (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def greedy(toxic: list[list[str]], clean: list[list[str]], each: float = 1.0) -> set[str]:
    """Entries by the toxic rows that no other entry explains, less the clean rows (of weight ``each``) that it would accuse."""
    holders: dict[str, set[int]] = {}
    accused: dict[str, set[int]] = {}
    for rows, into in ((toxic, holders), (clean, accused)):
        for i, found in enumerate(rows):
            for f in found:
                into.setdefault(f, set()).add(i)
    left, free, chosen = set(range(len(toxic))), set(range(len(clean))), set()
    order = sorted(holders, key=lambda f: (f.endswith("*"), -len(f), f))    # of equal gain words before stems, long ones first
    while order:
        def gain(f):
            return len(holders[f] & left) - 2 * each * len(accused.get(f, set()) & free)
        best = max(order, key=gain)
        if gain(best) < SUPPORT:
            break
        order.remove(best)
        t, c = len(holders[best] & left), each * len(accused.get(best, set()) & free)
        whole = lower_bound(len(holders[best]), each * len(accused.get(best, set())))
        if t < SUPPORT or lower_bound(t, c) <= 0.5 or whole <= 0.5:
            continue
        chosen.add(best)
        left -= holders[best]
        free -= accused.get(best, set())
    return chosen


def seconds(toxic: Counter, clean: Counter, each: float = 1.0) -> set[str]:
    """Words of good odds in rows that other entries explain, too (copies of one text give such words): hints, not verdicts."""
    return {f for f in toxic if not f.endswith("*") and toxic[f] >= 2 * SUPPORT and lower_bound(toxic[f], each * clean[f], 2.0) > 0.7}


def calibrated(model: Model, texts: DataFrame, per_toxic: float, per_clean: float) -> Model:
    """The model with the arcs weighed on the rows of the sample that each of them decides."""
    def kinds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = {"words": model.words, "stems": model.stems, "base": 0.0, "threat": 0.0, "aimed": 0.0, "target": 0.0}
        sure = Model(**{**lexicon, "negated": 1.0, "reported": 1.0})
        plain = Model(**{**lexicon, "negated": 0.0, "reported": 1.0}), Model(**{**lexicon, "negated": 1.0, "reported": 0.0})
        threats = [Model({}, {}, 0.0, 0.0, 0.0, *w) for w in ((0.0, 0.9, 0.0), (0.9, 0.9, 0.0))]
        for b in batches:
            out = []
            for t in b.column(1).to_pylist():
                out.append("aimed" if sure.score(t) < 0.3 and threats[0].score(t) > 0.3 else
                           "threat" if sure.score(t) < 0.3 and threats[1].score(t) > 0.3 else
                           "none" if sure.score(t) < 0.3 else
                           "negated" if plain[0].score(t) < 0.3 else
                           "reported" if plain[1].score(t) < 0.3 else "match")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], ["toxic", "kind"])

    n = {(r.kind, r.toxic): r["count"] for r in texts.mapInArrow(kinds, "toxic int, kind string").groupBy("kind", "toxic").count().collect()}

    def rate(kind, prior):
        t, c = n.get((kind, 1), 0) * per_toxic, n.get((kind, 0), 0) * per_clean
        return (t + prior * PRIOR_ROWS) / (t + c + PRIOR_ROWS)
    alone = min(0.45, rate("threat", PRIOR_THREAT))
    return Model(model.words, model.stems, rate("negated", PRIOR_NEGATED), rate("reported", PRIOR_REPORTED),
                 min(0.45, rate("none", 0.02)), alone, max(alone, rate("aimed", PRIOR_AIMED)), model.target)


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted): one row per document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = [model.score(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], ["doc_id", "score"])

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs, columns as they are, that score under 0.5."""
    model, at = learn(docs, labels), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = [model.score(t) < 0.5 for t in b.column(at).to_pylist()]
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scores(docs, learn(docs, table(spark, sf_dir, "labels")))
