"""The near-duplicates stage: one row per group of linked fingerprints, against brute force."""

from __future__ import annotations

import random

from frames import documents
from test_simhash import grouped, plain_fingerprint

import corpus_pipeline


def test_one_row_per_group_stays(spark):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(2000)]
    rows = []
    for i in range(40):
        base = rng.choices(vocabulary, k=rng.randint(60, 300))
        for k in range(5):
            words = list(base)
            for _ in range(k * k // 2):
                words[rng.randrange(len(words))] = f"changed{rng.randrange(10**6)}"
            rows.append((10 * i + k, " ".join(words)))
    rows += [(7000, "One two three"), (7001, "one two  three"), (7002, None), (7003, "")]
    expected = grouped({i: plain_fingerprint(t) for i, t in rows})
    kept = corpus_pipeline.near_duplicates(spark, documents(spark, [(*r, "en", "s") for r in rows]), "").collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(expected.values()))
    assert 40 < len(kept) < 200


def test_rows_are_told_apart_by_id_and_text(spark):
    far = "another text under an id that is taken already, of words not seen elsewhere"
    rows = [(1, "a first text of some words that stay as they are"), (1, far), (2, far)] + [(3, "one more text that occurs " * 9)] * 5
    kept = corpus_pipeline.near_duplicates(spark, documents(spark, [(*r, "en", "s") for r in rows]), "").collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted([rows[0], rows[1], rows[3]])
