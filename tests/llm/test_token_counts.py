"""Token attribution: exact sums, every rule, awkward rows."""

from __future__ import annotations

import pytest
import regex
from frames import AWKWARD, clashing, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from featurekit.llm import token_counts as t

COUNTER = t.Counter.once(t.load_ranks())

CUTTERS = {shortest: t.Counter(t.load_ranks()) for shortest in (1, 2, 3)}
for _shortest, _counter in CUTTERS.items():
    _counter.runs = regex.compile(rf"\p{{White_Space}}{{{_shortest},}}")


@given(st.text(max_size=80))
@settings(max_examples=80, deadline=None)
def test_offsets_and_sums(text):
    ids = COUNTER.encoding.encode_ordinary(text)
    first, last = COUNTER.offsets(text)
    assert len(first) == len(ids) and (first <= last).all()
    spans = t.line_sections(text)
    assert "".join(text[s:e] for s, e, _ in spans) == text
    for rule in t.RULES:
        tokens, crossing, total = COUNTER.attribute(text, spans, rule)
        assert tokens.sum() == total == len(ids) and (crossing <= tokens).all()


@given(st.text(max_size=40), st.integers(0, 40))
@settings(max_examples=60, deadline=None)
def test_owner_by_rule(text, cut):
    spans = [(0, min(cut, len(text)), "a"), (min(cut, len(text)), len(text), "b")]
    first, last = COUNTER.offsets(text)
    edge = spans[1][0]
    assert COUNTER.attribute(text, spans, "start")[0][0] == (first < edge).sum()
    assert COUNTER.attribute(text, spans, "end")[0][0] == (last < edge).sum()
    assert COUNTER.attribute(text, spans, "most")[0][0] == ((edge - first >= last + 1 - edge) & (first < edge) | (last < edge)).sum()


def test_characters_of_several_bytes():
    first, last = COUNTER.offsets("a😀b")
    assert first[0] == 0 and last[-1] == 2 and set(first[1:-1]) == {1}


def test_gaps_belong_to_nobody():
    tokens, crossing, total = COUNTER.attribute("one two three", [(4, 7, "x")])
    assert total == 3 and tokens.tolist() == [1] and crossing.tolist() == [1]  # " two" starts in the gap


def test_awkward_rows(spark):
    rows = t.count_tokens(clashing(documents(spark, AWKWARD))).collect()
    assert sum(r.section == 0 for r in rows) == len(AWKWARD)
    assert {(r.tokens, r.kind) for r in rows if r.doc_id in (2, 3)} == {(0, "empty")}
    assert t.count_tokens(documents(spark, AWKWARD).limit(0)).count() == 0
    with pytest.raises(ValueError):
        t.count_tokens(documents(spark, AWKWARD), rule="other")


def test_other_sections(spark):
    docs = documents(spark, [(1, "title\nbody text here", "en", "s")])
    rows = t.count_tokens(docs, sections=lambda text: [(0, 5, "title"), (5, len(text), "rest")], rule="most").collect()
    assert [(r.kind, r.start, r.length) for r in rows] == [("title", 0, 5), ("rest", 5, 15)]


@given(st.lists(st.sampled_from([" ", "\n", "\t", "　", "\x1c", "a", "7", "!", "'s", "é", "  "]), max_size=40).map("".join))
@settings(max_examples=300, deadline=None)
def test_cutting_runs_changes_no_token(text):
    for shortest, counter in CUTTERS.items():
        assert counter.encode(text) == COUNTER.encoding.encode_ordinary(text), shortest


def test_blank_runs_of_any_length(spark):
    blank = " " * 1_000_000
    docs = documents(spark, [(1, blank + "x", "en", "s"), (2, "x" + blank, "en", "s"), (3, blank + "\n" + blank, "en", "s")])
    rows = t.count_tokens(docs).collect()
    totals = {r.doc_id: r.doc_tokens for r in rows}
    assert set(totals) == {1, 2, 3} and min(totals.values()) > 0
    for i in totals:
        assert sum(r.tokens for r in rows if r.doc_id == i) == totals[i]
