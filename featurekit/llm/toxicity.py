"""Toxicity by a weighted finite-state pattern grammar over clauses.

A word transducer rewrites each word of a clause into a class (insult, threat, target, negation, report) with a
weight. Five small transducers read these classes one after the other - insult, threat, target, negation, reported
speech - and are composed into one machine. Its path through a clause adds up a weight for what is said in it: an
insult about somebody weighs more, a negated or quoted one less. A clause without a match weighs nothing, whatever
single words it holds. The document's score is the probability that at least one of its matched clauses is toxic.

The insult words, and how much negation, reported speech and targets change, are learned from labelled documents.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurekit.llm.common import bucket_of, sampled, small_batches

THRESHOLD = 0.3
HELD_OUT = 2

# Bounds of what is learned from: labelled documents per class, candidate patterns looked at, patterns kept.
DOCS_PER_CLASS = 3000
CANDIDATES = 2000
PATTERNS = 400

# A pattern has to be this unlikely (as the negative decimal logarithm) to meet toxic documents only by chance.
SURPRISE = 7.0
PREFIXES = (4, 5, 6, 7, 8)

# Words by class, in the languages of the corpus.
NEGATIONS = "not no never none n't don't isn't aren't nicht kein keine keinen nie niemals pas jamais aucun aucune ni nunca jamás ningún sin".split()
REPORTS = "said says wrote writes quoted called claims claimed reported sagte schrieb nannte dit écrit appelle dijo escribió llamó".split()
TARGETS = "you your you're u he she they him her them these those people du dich dir ihr euch sie er tu te toi vous il elle ils tú usted ustedes él ella ellos".split()
THREATS = "kill hurt destroy beat smash shoot töten schlagen vernichten tuer frapper détruire matar golpear destruir".split()
SEEDS = "idiot moron scum loser stupid worthless trash pathetic disgusting clown dumb imbecile dummkopf trottel abschaum imbécile crétin ordure estúpido imbécil basura".split()

INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER = "insult", "threat", "target", "negation", "report", "other"
HIT, AIMED = "hit", "aimed hit"  # what the insult and threat transducers make of a match

_TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
CLAUSE_ENDS = ".!?;:,\n\r"
_CLAUSE_END = re.compile(f"[{CLAUSE_ENDS}]")

SEED_WEIGHT = 3.0
CAUTION = 2.0  # taken off the prior log-odds, because every document holds many clauses
NO_MATCH = 0.01


@dataclass(frozen=True)
class Modifiers:
    """Log-odds that a target, a negation or reported speech adds to a match, and the bias of any match."""

    bias: float = -2.0
    threat: float = 3.0
    target: float = 1.0
    negation: float = -2.5
    report: float = -1.5


@dataclass(frozen=True)
class Transducer:
    """Arcs (state, symbol) -> (next state, symbol written, weight); without an arc a symbol passes as it is."""

    arcs: dict[tuple[int, str], tuple[int, str, float]]
    states: int

    def step(self, state: int, symbol: str) -> tuple[int, str, float]:
        return self.arcs.get((state, symbol), (state, symbol, 0.0))

    def compose(self, after: Transducer) -> Transducer:
        """The machine that feeds what this one writes to ``after``; weights add up."""
        symbols = {s for _, s in self.arcs} | {s for _, s in after.arcs} | {w for _, w, _ in self.arcs.values()}
        arcs = {}
        for a in range(self.states):
            for b in range(after.states):
                for symbol in symbols:
                    a2, written, w1 = self.step(a, symbol)
                    b2, out, w2 = after.step(b, written)
                    arcs[a * after.states + b, symbol] = (a2 * after.states + b2, out, w1 + w2)
        return Transducer(arcs, self.states * after.states)


def grammar(m: Modifiers) -> Transducer:
    """The composed machine. Targets count before and after a match, once; an even number of negations cancels out."""
    insult = Transducer({(0, INSULT): (0, HIT, m.bias)}, 1)
    threat = Transducer({(0, THREAT): (1, THREAT, 0.0), (1, TARGET): (0, AIMED, m.bias + m.threat)}, 2)
    target = Transducer({
        (0, TARGET): (1, TARGET, 0.0), (0, HIT): (2, HIT, 0.0), (1, HIT): (3, AIMED, m.target),
        (2, TARGET): (3, TARGET, m.target), (0, AIMED): (3, AIMED, 0.0), (1, AIMED): (3, AIMED, 0.0), (2, AIMED): (3, AIMED, 0.0),
    }, 4)
    negation = Transducer({
        (0, NEGATION): (1, NEGATION, 0.0), (1, NEGATION): (0, NEGATION, 0.0),
        (1, HIT): (1, HIT, m.negation), (1, AIMED): (1, AIMED, m.negation),
    }, 2)
    report = Transducer({
        (0, REPORT): (1, REPORT, 0.0), (1, HIT): (1, HIT, m.report), (1, AIMED): (1, AIMED, m.report),
    }, 2)
    return insult.compose(threat).compose(target).compose(negation).compose(report)


@dataclass(frozen=True)
class Model:
    """``stems`` are patterns that match words from their start, ``words`` whole words; both with their log-odds."""

    words: dict[str, float]
    stems: dict[str, float]
    modifiers: Modifiers = field(default_factory=Modifiers)

    @cached_property
    def _classes(self) -> dict[str, str]:
        listed = {OTHER: (), REPORT: REPORTS, TARGET: TARGETS, THREAT: THREATS, NEGATION: NEGATIONS}
        return {w: c for c, ws in listed.items() for w in ws}

    @cached_property
    def _machine(self) -> Transducer:
        return grammar(self.modifiers)

    @cached_property
    def _trigger(self) -> re.Pattern:
        """Finds the words that can start a match; texts without one are done after a single search."""
        parts = [rf"{re.escape(s)}" for s in self.stems] + [rf"(?:{re.escape(w)})(?![^\W_])" for w in [*self.words, *THREATS]]
        return re.compile(rf"(?<![^\W_])(?:{'|'.join(parts)})")

    def classify(self, word: str) -> tuple[str, float]:
        """The word transducer: a class and, for insults, a weight."""
        weight = self.words.get(word)
        if weight is None and self.stems:
            weight = next((self.stems[word[:n]] for n in range(len(word), 2, -1) if word[:n] in self.stems), None)
        if weight is not None:
            return INSULT, weight
        return self._classes.get(word, OTHER), 0.0

    def clauses(self, text: str) -> Iterator[Iterator[tuple[str, float]]]:
        """The clauses of a lower-cased text that hold a trigger, from end to end, as streams of classes."""
        end = 0
        for hit in self._trigger.finditer(text):
            if hit.start() < end:
                continue
            start = max(end, *(text.rfind(c, end, hit.start()) + 1 for c in CLAUSE_ENDS))
            after = _CLAUSE_END.search(text, hit.end())
            end = after.start() if after else len(text)
            yield (self.classify(m.group()) for m in _TOKEN.finditer(text, start, end))

    def weigh(self, clause: Iterable[tuple[str, float]]) -> float | None:
        """The weight of the path through the composed machine, whose state is all it keeps; None if nothing matched."""
        state, total, best, matched = 0, 0.0, 0.0, False
        for symbol, weight in clause:
            state, written, added = self._machine.step(state, symbol)
            total += added
            if written in (HIT, AIMED):
                matched = True
                best = max(best, weight)
        return total + best if matched else None

    def score(self, text: str | None) -> tuple[float, int]:
        """The probability that a matched clause is toxic, and how many clauses matched."""
        clean, matched = 1.0 - NO_MATCH, 0
        for clause in self.clauses((text or "").lower()):
            weight = self.weigh(clause)
            if weight is not None:
                matched += 1
                clean *= 1.0 - 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, weight))))
        return 1.0 - clean, matched


def seed_model() -> Model:
    return Model({w: SEED_WEIGHT for w in SEEDS}, {})


def labelled_sample(docs: DataFrame, labels: DataFrame, docs_per_class: int = DOCS_PER_CLASS) -> DataFrame:
    """Rows (text, toxic) of at most about ``docs_per_class`` labelled documents of each class that are not held out."""
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (bucket_of("doc_id", 4) != HELD_OUT))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    parts = [
        sampled(known.where(F.col("toxic") == c), min(1.0, docs_per_class / n), "doc_id", seed=11) for c, n in counts.items()
    ]
    if not parts:
        return docs.select("text", F.lit(0).alias("toxic")).limit(0)
    chosen = parts[0] if len(parts) == 1 else parts[0].union(parts[1])
    # The sample is bounded by its parameter, so it may be broadcast.
    return docs.where(F.col("text").isNotNull()).select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic")


def _keys(text: str) -> set[tuple[str, bool]]:
    words = {w for w in _TOKEN.findall(text.lower()) if len(w) > 2}
    return {(w, False) for w in words} | {(w[:n], True) for w in words for n in PREFIXES if len(w) >= n}


def _surprise(t: float, c: float, share: float) -> float:
    """Negative decimal logarithm of the chance (Chernoff bound) of t or more toxic ones among t + c."""
    n, q = t + c, t / (t + c)
    if q <= share:
        return 0.0
    divergence = q * math.log10(q / share) + ((1 - q) * math.log10((1 - q) / (1 - share)) if q < 1 else 0.0)
    return n * divergence


def learn(docs: DataFrame, labels: DataFrame, docs_per_class: int = DOCS_PER_CLASS) -> Model:
    """Learn insult patterns and modifiers from labelled documents (doc_id, text) and (doc_id, toxic).

    Words and word beginnings are counted per document and class on the executors; only the ``CANDIDATES`` that speak
    most for toxicity come to the driver. A pattern counts the different neighbours it occurs between, not its
    documents, so that copies of one document do not make its words suspicious.
    """
    small_batches(docs.sparkSession)
    sample = labelled_sample(docs, labels, docs_per_class)
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    toxic_docs, clean_docs = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic_docs or not clean_docs:
        return seed_model()
    share = toxic_docs / (toxic_docs + clean_docs)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            seen = {0: Counter(), 1: Counter()}
            for text, toxic in zip(rows["text"], rows["toxic"]):
                seen[int(toxic == 1)].update(_keys(text))
            keys = [k for k in seen[1].keys() | seen[0].keys() if len(k[0]) < 64]
            yield pd.DataFrame({
                "key": [k for k, _ in keys], "stem": [s for _, s in keys],
                "toxic": [seen[1][k] for k in keys], "clean": [seen[0][k] for k in keys],
            })

    counted = (
        sample.mapInPandas(count, "key string, stem boolean, toxic long, clean long")
        .groupBy("key", "stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )
    gain = F.col("toxic") * F.log((F.col("toxic") + 0.5) / (toxic_docs + 1.0) * (clean_docs + 1.0) / (F.col("clean") + 0.5))
    rows = counted.where((F.col("toxic") >= 3) & (F.col("clean") * 10 < F.col("toxic") * clean_docs / toxic_docs)).orderBy(
        gain.desc(), "key", "stem").limit(CANDIDATES).collect()
    stats = {(r["key"], r["stem"]): (r["toxic"], r["clean"]) for r in rows}
    if not stats:
        return seed_model()

    def neighbours(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = set()
            for text in rows["text"]:
                words = ["", *_TOKEN.findall(text.lower()), ""]
                for i, w in enumerate(words[1:-1], 1):
                    for key in ((w, False), *((w[:n], True) for n in PREFIXES if len(w) >= n)):
                        if key in stats:
                            out.add((*key, f"{words[i - 1]} {words[i + 1]}", w))
            yield pd.DataFrame(list(out), columns=["key", "stem", "around", "word"])

    found = (
        sample.where("toxic = 1").mapInPandas(neighbours, "key string, stem boolean, around string, word string")
        .groupBy("key", "stem").agg(F.countDistinct("around").alias("around"), F.countDistinct("word").alias("words")).collect()
    )
    patterns = {}
    for r in found:
        key = (r["key"], r["stem"])
        toxic, clean = stats[key]
        backed = min(toxic, r["around"])
        if backed >= 3 and _surprise(backed, clean, share) >= SURPRISE * (1.0 if toxic_docs >= 200 else 0.75):
            # One standard error less than the counts say: the patterns were picked for looking best.
            low, high = backed - math.sqrt(backed), clean + math.sqrt(clean)
            weight = math.log((low + 0.5) / (toxic_docs + 1) * (clean_docs + 1) / (high + 0.5))
            patterns[key] = (weight, backed, r["words"])
    model = Model(*_thin(patterns))
    modifiers = _modifiers(sample, model, share)
    unseen = {w: max(SEED_WEIGHT, -modifiers.bias) for w in SEEDS if (w, False) not in patterns and w in model.words}
    return Model({**model.words, **unseen}, model.stems, modifiers)


def _thin(patterns: dict) -> tuple[dict[str, float], dict[str, float]]:
    """Drop what another pattern says as well: of like stems the longest or clearest stays, and covers what begins with it."""
    words: dict[str, float] = {}
    stems: dict[str, float] = {}
    best = sorted(patterns.items(), key=lambda x: (-x[1][1], x[0][1], -len(x[0][0]), x[0][0]))
    for (key, stem), (weight, backed, variants) in best:
        if stem:
            longer = [
                k for (k, s), p in patterns.items() if k.startswith(key) and (len(k) > len(key) or not s)
                and (s and p[1] >= 0.95 * backed or p[1] >= 0.7 * backed and p[0] > weight + 1.0)
            ]
            if longer or variants < 2 or any(key.startswith(s) for s in stems):
                continue
            stems[key] = weight
        elif not any(key.startswith(s) for s in stems):
            words[key] = weight
        if len(words) + len(stems) >= PATTERNS:
            break
    words = {w: x for w, x in words.items() if not any(w.startswith(s) for s in stems)}
    for seed in SEEDS:
        if seed not in words and not any(seed.startswith(s) for s in stems):
            words[seed] = SEED_WEIGHT
    return words, stems


def _modifiers(sample: DataFrame, model: Model, share: float) -> Modifiers:
    """Log-odds of a toxic document given a matched clause with and without each modifier, drawn towards the defaults."""
    base = Modifiers()

    def flags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            seen: Counter = Counter()
            for text, toxic in zip(rows["text"], rows["toxic"]):
                for clause in model.clauses(text.lower()):
                    held = {symbol for symbol, _ in clause}
                    if INSULT in held:
                        seen[int(toxic == 1), TARGET in held, NEGATION in held, REPORT in held] += 1
            yield pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["toxic", "target", "negation", "report", "n"])

    kind = "toxic int, target boolean, negation boolean, report boolean, n long"
    rows = sample.mapInPandas(flags, kind).groupBy("toxic", "target", "negation", "report").agg(F.sum("n").alias("n")).collect()

    def log_odds(chosen) -> tuple[float, int]:
        t = sum(r["n"] for r in rows if chosen(r) and r["toxic"])
        c = sum(r["n"] for r in rows if chosen(r) and not r["toxic"])
        return math.log((t + 1) / (c + 1)), t + c

    plain, _ = log_odds(lambda r: not (r["target"] or r["negation"] or r["report"]))
    out = {}
    for name in ("target", "negation", "report"):
        value, n = log_odds(lambda r, name=name: r[name])
        # With few observations both sides are far from certain; differences of sure things do not count.
        observed = min(max(value, -5.0), 3.0) - min(max(plain, -5.0), 3.0)
        out[name] = (n * observed + 20 * getattr(base, name)) / (n + 20)
    return Modifiers(bias=math.log(max(share, 0.05) / (1 - min(share, 0.95))) - CAUTION, threat=base.threat, **out)


def assess(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted, clauses.

    Null and empty texts score like texts without a match. A clause is read as a whole, however long it is. A null doc_id counts as empty text for held_out. Repeated
    rows repeat, other columns are ignored.
    """
    small_batches(docs.sparkSession)

    @F.pandas_udf("score double, clauses int")
    def weigh(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([model.score(t) for t in texts], columns=["score", "clauses"])

    found = docs.select("doc_id", "text").withColumn("found", weigh("text"))
    return found.select(
        "doc_id", (bucket_of("doc_id", 4) == HELD_OUT).alias("held_out"), F.col("found.score").alias("score"),
        (F.col("found.score") >= threshold).cast("int").alias("predicted"), F.col("found.clauses").alias("clauses"),
    )
