"""SimHash groups against brute force, and the awkward rows."""

from __future__ import annotations

import numpy as np
import pytest
import xxhash
from frames import AWKWARD, LONG, clashing, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from featurekit.llm import simhash
from featurekit.llm.components import components


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    span = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + span]), 42) for i in range(len(words) - span + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(prints: dict[int, int], distance=3):
    root = {i: i for i in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= distance:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@given(st.text(max_size=60))
@settings(max_examples=60, deadline=None)
def test_fingerprint_equals_the_plain_one(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_long_text_is_read_whole():
    assert simhash.fingerprint(LONG * 4) == plain_fingerprint(LONG * 4)


@pytest.mark.parametrize("seed", [0, 1])
def test_trie_join_finds_every_pair(seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, 1500, dtype=np.uint64)
    near = base[:200] ^ (np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64))
    values = np.unique(np.concatenate([base, near, near[:50] ^ np.uint64(5), np.arange(200, dtype=np.uint64)]))
    found = {(i, j) for a, b in simhash.trie_join(values, None, 0, 3) for i, j in zip(a.tolist(), b.tolist())}
    far = np.bitwise_count(values[:, None] ^ values[None, :])
    assert found == set(zip(*(x.tolist() for x in np.where(np.triu(far <= 3, 1)))))


def test_groups_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(0, 240, 4):
        text = list(rng.choice(words, 120))
        for k in range(4):
            rows.append((i + k, " ".join([*text[: 119 - k], f"new{k}"]), "en", "s"))
    rows += [(1000 + k, None if k % 2 else "", "en", "s") for k in range(4)]
    docs = documents(spark, rows)
    expected = grouped({i: plain_fingerprint(t) for i, t, _, _ in rows})
    got = {r.doc_id: r for r in simhash.near_duplicate_groups(docs).collect()}
    assert {i: r.component_id for i, r in got.items()} == expected
    assert all(got[i].fingerprint == f"{plain_fingerprint(t):016x}" for i, t, _, _ in rows)
    assert len(set(expected.values())) < len(rows)


def test_awkward_rows(spark):
    docs = clashing(documents(spark, AWKWARD))
    rows = simhash.near_duplicate_groups(docs).collect()
    assert len(rows) == len(AWKWARD)
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, set()).add((r.fingerprint, r.component_id))
    assert by_id[2] == by_id[3] == by_id[5] == {("0" * 16, 2)}
    assert len(by_id[1]) == 1
    assert {c for _, c in by_id[None]} == {None}
    kept = simhash.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=lambda i: (i is None, i)) == [1, 2, 4, 6, 7, None]
    assert simhash.near_duplicate_groups(docs.limit(0)).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(400)]
    star = [(5000, 5000 + i) for i in range(1, 300)]
    found = components(spark.createDataFrame(chain + star + [(9, 9), (3, 2)], "a long, b long")).collect()
    roots = {}
    for r in found:
        roots.setdefault(r.root, set()).add(r.node)
    assert sorted(map(len, roots.values())) == [300, 401]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
