"""Containment search against brute force."""

from __future__ import annotations

import random
import re

from frames import AWKWARD, clashing, documents

from featurekit.llm import decontaminate as d


def plain(docs, items, n=5, bound=0.8):
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    cut = lambda w, m: {tuple(w[i : i + m]) for i in range(len(w) - m + 1)}
    out = set()
    for i, text in items:
        w = words(text)
        if not w:
            continue
        m = min(n, len(w))
        wanted = cut(w, m)
        for doc_id, t, *_ in docs:
            shared = len(wanted & cut(words(t), m))
            if shared / len(wanted) >= bound:
                out.add((doc_id, i, shared, len(wanted)))
    return out


def test_equals_brute_force(spark):
    rng = random.Random(1)
    vocabulary = [f"v{i}" for i in range(40)]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.choice((1, 3, 4, 5, 6, 9, 30, 60))))) for k in range(60)]
    docs = []
    for i in range(150):
        w = rng.choices(vocabulary, k=rng.randint(0, 80))
        if i % 2:
            passage = rng.choice(items)[1].split()
            for _ in range(rng.randint(0, 3)):  # some passages are changed, up to and past the bound
                passage[rng.randrange(len(passage))] = "changed"
            at = rng.randint(0, len(w))
            w[at:at] = [p.upper() + "," for p in passage]
        docs.append((i, " ".join(w), "en", "s"))
    got = d.contained_items(documents(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    expected = plain(docs, items)
    assert {(r.doc_id, r.item_id, r.shared, r.item_shingles) for r in got} == expected
    assert len(got) == len(expected) > 50


def test_awkward_rows(spark):
    items = clashing(spark.createDataFrame(
        [(1, None), (2, ""), (None, "words that is long enough to hold"), (3, "one"), (4, " ".join(f"word{i}" for i in range(900, 940)))],
        "item_id long, text string"))
    docs = clashing(documents(spark, AWKWARD))
    got = {(r.doc_id, r.item_id) for r in d.contained_items(docs, items).collect()}
    assert got == {(1, None), (6, 3), (4, 4)}
    left = d.without_contaminated(docs, items)
    assert left.columns == docs.columns
    assert sorted((r.doc_id for r in left.collect()), key=lambda i: (i is None, i)) == [2, 3, 5, 7, None]
    assert d.contained_items(docs.limit(0), items).count() == 0
    assert d.contained_items(docs, items.limit(0)).count() == 0
    assert d.without_contaminated(docs, items.limit(0)).count() == len(AWKWARD)


def test_no_python_in_the_plan(spark):
    items = spark.createDataFrame([(1, "some words of an item that is tested here")], "item_id long, text string")
    plan = d.contained_items(documents(spark, AWKWARD), items)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
