"""The n-gram model against a plain calculation, and the verdicts."""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest
from frames import AWKWARD, clashing, documents
from pyspark.sql import functions as F

from featurekit.llm import kneser_ney as k
from featurekit.llm.common import table

TEXTS = ["abracadabra and a cat", "The cat sat on the mat", "a dog and the cat", "bananas, bananas!", "the end of it 12",
         "Кошка сидит на окне, кошка спит", "Η γάτα κάθεται", "猫坐在垫子上。猫在睡觉。", "emoji 😀😀 too \x00 ￿"]


def plain_grams(text):
    low = "".join("�" if c in "\x00￿" else c for c in (text or "").lower())
    s = k.EDGE * (k.ORDER - 1) + low + k.EDGE
    return [s[i : i + k.ORDER] for i in range(len(s) - k.ORDER + 1)]


def plain_model(texts):
    """Recursive interpolated modified Kneser-Ney over characters, straight from its definition."""
    counts = {k.ORDER: Counter(g for t in texts for g in plain_grams(t))}
    for n in range(k.ORDER - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    tables = {}
    for n, c in counts.items():
        times = Counter(c.values())
        follow = defaultdict(dict)
        for g, v in c.items():
            follow[g[:-1]][g[-1]] = v
        tables[n] = (k._discounts({f"n{i}": times[i] for i in (1, 2, 3, 4)}), follow)

    def p(gram):
        context, symbol, n = gram[:-1], gram[-1], len(gram)
        below = p(gram[1:]) if n > 1 else 1 / (len(counts[1]) + 1)
        discount, follow = tables[n]
        seen = follow.get(context)
        if not seen:
            return below
        total = sum(seen.values())
        v = seen.get(symbol, 0)
        own = (v - discount[min(v, 3) - 1]) / total if v else 0.0
        return own + sum(discount[min(x, 3) - 1] for x in seen.values()) / total * below

    return p


def fitted(spark, texts, unseen=()):
    rows = documents(spark, [(i, t, "en", "s") for i, t in enumerate([*texts, *unseen])])
    known = F.col("doc_id") < len(texts)
    return k.blocks(rows.withColumn("trusted", known).withColumn("fitted", known))


@pytest.mark.parametrize("block", [k.BLOCK, 40])
def test_perplexity_equals_the_definition(spark, monkeypatch, block):
    monkeypatch.setattr(k, "BLOCK", block)
    unseen = ["the dog sat", "Собака спит", "犬在睡觉", "zzz qqq", None, ""]
    rows = {r.doc_id: r for r in k.perplexities(fitted(spark, TEXTS, unseen)).collect()}
    p = plain_model(TEXTS)
    for i, text in enumerate([*TEXTS, *unseen]):
        grams = plain_grams(text)
        assert rows[i].symbols == len(grams)
        assert rows[i].perplexity == pytest.approx(np.exp(-np.mean([np.log(p(g)) for g in grams])), rel=1e-5)


def test_probabilities_add_up_to_one(spark):
    counts = k.gram_counts(fitted(spark, TEXTS)).where("n > 0")
    letters = sorted({g[-1] for t in TEXTS for g in plain_grams(t)}) + ["\u0001"]  # the last stands for all unknown ones
    for context in ("the", "кош", "猫在睡", k.EDGE * 3, "xyz"):
        asked = spark.createDataFrame([(context + c,) for c in letters], "gram string")
        assert sum(r.p for r in k.probabilities(asked, counts).collect()) == pytest.approx(1.0, abs=1e-9)


@pytest.mark.parametrize("dense", [k._DENSE, 1])
def test_ranks_and_pieces_hold_every_gram_once(monkeypatch, dense):
    monkeypatch.setattr(k, "_PIECE", 7)
    monkeypatch.setattr(k, "_DENSE", dense)
    cut = [p for t in TEXTS for p in k.pieces(t)]
    ranks = k.Ranks(np.concatenate(cut), np.array([len(p) for p in cut]))
    grams = ranks.grams()
    assert len(set(grams)) == len(grams)
    assert [grams[i] for i in ranks.positions] == [g for t in TEXTS for g in plain_grams(t)]


def test_long_texts_in_pieces_equal_whole_ones(spark, monkeypatch):
    texts = [TEXTS[0] * 9, TEXTS[1] * 7, TEXTS[5] * 5]
    whole = {r.doc_id: r.perplexity for r in k.perplexities(fitted(spark, texts)).collect()}
    monkeypatch.setattr(k, "_PIECE", 11)
    monkeypatch.setattr(k, "BLOCK", 100)
    assert {r.doc_id: r.perplexity for r in k.perplexities(fitted(spark, texts)).collect()} == pytest.approx(whole, rel=1e-9)


def test_texts_are_not_shuffled(spark):
    stored = fitted(spark, TEXTS)
    plan = k.perplexities(stored)._jdf.queryExecution().toString()
    assert "Bucketed: true" in plan


def test_junk_is_told_from_trusted_text(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    rows = k.classify(table(spark, sf_dir, "documents"), labels).join(labels, "doc_id").collect()
    good = [r.good for r in rows if r.quality == 1]
    bad = [r.good for r in rows if r.quality == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.5 * len(bad)


def test_awkward_rows(spark):
    docs = clashing(documents(spark, AWKWARD))
    labels = spark.createDataFrame([(1, 1, 0), (None, 1, 0), (4, None, None), (1, 0, 1)], "doc_id long, quality int, toxic int")
    rows = k.classify(docs, labels).collect()
    assert len(rows) == len(AWKWARD)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[2].symbols == by_id[3].symbols == 1 and by_id[2].good == 0 and by_id[1].good == 1
    assert all(r.perplexity > 0 for r in rows)
    unlabelled = k.classify(docs, labels.limit(0)).collect()
    assert {r.good for r in unlabelled if r.symbols > 1} == {1} and {r.high for r in unlabelled} == {None}
    assert {r.perplexity for r in unlabelled} == {1.0}
    assert k.classify(docs.limit(0), labels).count() == 0
