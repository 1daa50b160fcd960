"""Weighted SimHash, its edits and its search against plain versions."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
import xxhash
from frames import AWKWARD, LONG, clashing, documents
from pyspark.sql import functions as F

from featurekit.llm import fingerprints as f
from featurekit.llm.common import table


def plain_fingerprint(text):
    words = [w for w in re.split(r"[ \t\n\v\f\r]+", (text or "").lower()) if w]
    votes, total = [0] * 64, 0
    for a, b in zip(words, [*words[1:], None]):
        h = xxhash.xxh64_intdigest(a.encode(), 42)
        h = h if b is None else xxhash.xxh64_intdigest(b.encode(), h)
        weight = min(len(a) + len(b or ""), 24)
        total += weight
        for i in range(64):
            votes[i] += weight * (h >> i & 1)
    return sum(1 << i for i in range(64) if 2 * votes[i] > total)


def plain_edits(rows):
    order = sorted(set(rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for at, (i, text) in enumerate(order):
        text, following = text or "", order[(at + 1) % len(order)][1] or ""
        lent = len(text) // 3
        edited = text[: len(text) - lent] + following[:lent]
        a, b, c = map(plain_fingerprint, (text, edited, following))
        out[i, text] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), f"{a:016x}", f"{b:016x}",
                        1 - (a ^ b).bit_count() / 64, 1 - (a ^ c).bit_count() / 64)
    return out


def test_query_equals_the_plain_version(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    expected, got = plain_edits(rows), f.edited_fingerprints(docs).collect()
    assert len(got) == len(rows)
    for r, (i, text) in zip(sorted(got), sorted(rows)):
        assert tuple(r) == (i, *expected[i, text])
    near = sorted(r.near_edited for r in got)
    assert near[len(near) // 20] > 0.55 and sum(r.near_next for r in got) / len(got) < 0.6


def test_awkward_rows(spark):
    rows = [(i, t) for i, t, _, _ in AWKWARD if i is not None] + [(8, "ab"), (9, "漢字 und Ärger" * 5), (10, " x y " * 9)]
    docs = clashing(documents(spark, [(i, t, "en", "s") for i, t in rows]))
    expected = plain_edits(rows)
    got = f.edited_fingerprints(docs).collect()
    assert sorted(map(tuple, got)) == sorted((i, *expected[i, t or ""]) for i, t in rows)
    assert f.edited_fingerprints(docs.limit(0)).count() == 0
    alone = f.edited_fingerprints(docs.where("doc_id = 8")).collect()
    assert [(r.near_next, r.near_edited) for r in alone] == [(1.0, 1.0)]


def test_ids_that_repeat_or_are_missing(spark):
    rows = [(1, "one text of a few words here"), (1, "one more text of a few words"), (None, "no name"), (None, None), (2, "the second of them all")]
    docs = documents(spark, [(i, t, "en", "s") for i, t in rows] * 3).repartition(5)
    got = f.edited_fingerprints(docs).collect()
    assert len(got) == 15 and len({tuple(r) for r in got}) == 5
    again = f.edited_fingerprints(docs.repartition(3)).collect()
    assert {tuple(r) for r in got} == {tuple(r) for r in again}


def test_very_long_text(spark):
    text = LONG * 3 + " short tail"
    got = f.document_fingerprints(documents(spark, [(1, text, "en", "s"), (2, text, "en", "s")])).collect()
    assert {r.fp & (1 << 64) - 1 for r in got} == {plain_fingerprint(text)}


@pytest.mark.parametrize("radius", [0, 1, 3, 7])
def test_search_finds_every_pair_once(spark, radius):
    rng = random.Random(radius)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = base + [b ^ sum(1 << i for i in rng.sample(range(64), rng.randint(0, 9))) for b in base for _ in range(6)] + [0, (1 << 64) - 1]
    queries = rng.sample(fps, 90)
    as_table = lambda x: spark.createDataFrame([(signed(v),) for v in x] + [(None,)], "fp long")
    got = [tuple(r) for r in f.within_radius(as_table(queries), as_table(fps), radius).collect()]
    expected = {(signed(q), signed(v), (q ^ v).bit_count()) for q in queries for v in fps if (q ^ v).bit_count() <= radius}
    assert set(got) == expected and len(got) == len(expected)


def test_radius_query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    prints = {r.doc_id: plain_fingerprint(r.text) for r in docs.select("doc_id", "text").collect()}
    got = f.near_documents(docs, F.col("doc_id") % 20 == 0).collect()
    assert {r.doc_id for r in got} == {i for i in prints if i % 20 == 0}
    for r in got:
        near = [p for p in prints.values() if (p ^ prints[r.doc_id]).bit_count() <= 3]
        assert (r.fingerprint, r.near_fingerprints, r.near_documents) == (f"{prints[r.doc_id]:016x}", len(set(near)), len(near))


def test_no_python_in_the_plan(spark):
    docs = documents(spark, AWKWARD)
    for made in (f.edited_fingerprints(docs), f.near_documents(docs, F.col("doc_id") > 0)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
