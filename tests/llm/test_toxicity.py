"""Toxicity grammar: composition, clauses, learning, awkward rows."""

from __future__ import annotations

import pytest
from frames import AWKWARD, clashing, documents

from featurekit.llm import toxicity as t
from featurekit.llm.common import table


def test_composition_equals_running_one_after_the_other():
    parts = t.grammar(t.Modifiers())
    single = t.seed_model()
    assert parts.states == 1 * 2 * 4 * 2 * 2
    score = lambda s: single.score(s)[0]
    assert score("you are an idiot") > score("an idiot") > score("he is not an idiot, no") > 0
    assert score("idiot here") > score("the teacher said idiot")
    assert score("not never an idiot here") == pytest.approx(score("an idiot here"))
    assert score("i will kill you") > 0.3 > score("they kill time") == score("") == score("plain words") == pytest.approx(t.NO_MATCH)


def test_clauses_end_at_punctuation():
    m = t.seed_model()
    assert m.score("that is not good. what an idiot")[0] == pytest.approx(m.score("what an idiot")[0])
    assert m.score("idiot, " * 3)[1] == 3
    assert m.score("idiotic")[1] == 0


def test_long_texts_are_read_to_their_end():
    assert t.seed_model().score("word " * 300_000 + "you idiot")[0] > 0.3


@pytest.mark.parametrize("gap", [0, 120, 5000])
def test_a_clause_is_read_as_a_whole(gap):
    score = lambda s: t.seed_model().score(s)[0]
    between = "word " * gap
    assert score(f"not {between}an idiot") == pytest.approx(score("not an idiot"))
    assert score(f"idiot {between}you") == pytest.approx(score("idiot you"))
    assert t.seed_model().score(f"idiot {'x' * 390} {between}moron here. scum")[1] == 2


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return t.learn(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def test_held_out_documents(spark, sf_dir, model):
    found = t.assess(table(spark, sf_dir, "documents"), model).join(table(spark, sf_dir, "labels"), "doc_id").where("held_out")
    rows = [(r.toxic, r.predicted, r.lang) for r in found.join(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id").collect()]
    assert sum(p for y, p, _ in rows if y == 0) <= 0.02 * len(rows)
    english = [p for y, p, g in rows if y == 1 and g == "en"]
    assert sum(english) >= 0.85 * len(english)


def test_made_up_insults_are_learned_from_their_contexts(spark):
    import random

    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    rows, labels = [], []
    for i in range(600):
        words = [word() for _ in range(40)]
        if i % 4 == 0:
            words[rng.randrange(40)] = rng.choice(("zurgab", "zurgol", "zurgem", "blort"))
        rows.append((i, " ".join(words), "en", "s"))
        labels.append((i, 1, int(i % 4 == 0)))
    copied = "these are quite ordinary words repeated over many copies of one document"
    rows += [(1000 + i, copied + " blort", "en", "s") for i in range(60)]
    labels += [(1000 + i, 1, 1) for i in range(60)]
    learned = t.learn(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    score = lambda s: learned.score(s)[0]
    assert score("a zurgix there") >= 0.3 and score("the blort there") >= 0.3
    assert score(copied) < 0.3


def test_awkward_rows(spark, model):
    docs = clashing(documents(spark, AWKWARD))
    rows = t.assess(docs, model).collect()
    assert len(rows) == len(AWKWARD)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    labels = spark.createDataFrame([(1, None, 1), (None, 1, 1), (2, 1, None), (1, 1, 0)], "doc_id long, quality int, toxic int")
    assert t.learn(docs, labels).words
    assert t.learn(docs.limit(0), labels.limit(0)) == t.seed_model()
    assert t.assess(docs.limit(0), model).count() == 0
