"""Conversation repair against an exhaustive search and a plain version of the damage."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest
from frames import clashing

from featurekit.llm import conversations as c
from featurekit.llm.common import table

SCHEMA = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\v\f\r"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        drawn = zlib.crc32(key.encode()) % 20
        if drawn == 0:
            continue
        text = "" if drawn == 1 else re.sub("[.!?]", "", text) if drawn == 2 else text
        out += [(conv, turn, "user" if drawn == 4 else role, text)] * (2 if drawn == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        solid = text.strip(WHITE)
        out.append("b" if not solid else "d" if (role, text) in seen else "t" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def plain_repair(rows, found):
    """Dijkstra over (rows done, pattern state), with the audit in the key: cheapest first, then ASCII-least."""
    following = {"": "u", "s": "u", "u": "a", "a": "u"}
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, said = heapq.heappop(heap)
        if i == len(rows) and state in ("", "a"):
            return cost, audit, "\n".join(said)
        if (i, state) in done:
            continue
        done.add((i, state))
        name = {"u": "user", "a": "assistant"}[following[state]]
        heapq.heappush(heap, (cost + 5, audit + "I", i, following[state], (*said, f"{name}:")))
        if i == len(rows):
            continue
        _, _, role, text = rows[i]
        heapq.heappush(heap, (cost + 2, audit + "D", i + 1, state, said))
        if found[i] in ("b", "d"):
            continue
        extra = 5 if found[i] == "t" else 0
        heapq.heappush(heap, (cost + 1 + extra, audit + "R", i + 1, following[state], (*said, f"{name}:{text}")))
        if role[:1] == following[state] or (role[:1] == "s" and not state):
            heapq.heappush(heap, (cost + extra, audit + "K", i + 1, role[:1], (*said, f"{role}:{text}")))
    raise AssertionError


def plain(rows, damage=True):
    groups = defaultdict(list, {r[0]: [] for r in rows})
    for r in plain_damage(rows) if damage else [(a, b, *(" " if x is None else x for x in (d, e))) for a, b, d, e in rows]:
        groups[r[0]].append(r)
    out = {}
    for conv, members in groups.items():
        members.sort(key=lambda r: (r[1] is not None, r[1] or 0))
        found, turns = faults(members), [r[1] for r in members if r[1] is not None]
        initials = [r[2][:1] for r in members]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, said = plain_repair(members, found)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, found.count("b"), found.count("d"), found.count("t"), illegal, cost, audit,
                     hashlib.sha256(said.encode()).hexdigest())
    return out


def collected(df):
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r)[1:] for r in rows}


@pytest.mark.parametrize("seed", range(8))
def test_audits_equal_an_exhaustive_search(seed):
    rng = random.Random(seed)
    for _ in range(150):
        rows = [(1, i, rng.choice(["user", "assistant", "assistant", "system", "tool", ""]), rng.choice(["x.", "y.", "z", ""]) + "q" * (i % 3) + rng.choice(".. "))
                for i in range(rng.randint(0, 9))]
        found = faults(rows)
        runs = c.Runs()
        for r, f in zip(rows, found):
            runs.add(c.symbol(r[2][:1], {"b": c.BAD, "d": c.BAD, "t": c.CUT, "": c.SOUND}[f]))
        cost, audit, said = plain_repair(rows, found)
        assert c.repair(runs) == (cost, audit)
        edits = c._Edits(audit)
        for r in rows:
            edits.apply(r[2], r[3])
        assert edits.digest() == hashlib.sha256(said.encode()).hexdigest()
        assert re.fullmatch("(s?(ua)+)?", "".join(line[:1] for line in said.split("\n")))


def test_runs_longer_than_a_block():
    rng = random.Random(1)
    rows = []
    while len(rows) < 6000:
        kind = rng.choice(["user", "assistant", "tool"])
        rows += [(1, len(rows) + i, kind, f"{len(rows) + i}." if rng.random() < 0.999 else "") for i in range(rng.choice([1, 2, 2500]))]
    found = faults(rows)
    runs = c.Runs()
    for r, f in zip(rows, found):
        runs.add(c.symbol(r[2][:1], {"b": c.BAD, "": c.SOUND}[f]))
    cost, audit = c.repair(runs)
    # The plain forward pass over costs alone.
    at = {"": 0}
    for r, f in zip(rows, found):
        then = {}
        for _ in range(4):
            for s, v in list(at.items()):
                n = "a" if s == "u" else "u"
                at[n] = min(at.get(n, 1 << 60), v + 5)
        for s, v in at.items():
            n = "a" if s == "u" else "u"
            options = [(v + 2, s)] + ([] if f else [(v + 1, n)] + ([(v, n)] if r[2][0] == n else []))
            for cost_, to in options:
                then[to] = min(then.get(to, 1 << 60), cost_)
        at = then
    assert cost == min(at.get("", 1 << 60), at.get("a", 1 << 60), at.get("u", 1 << 60) + 5)
    assert len(audit.replace("I", "")) == len(rows)


def test_query_equals_the_plain_version(spark, sf_dir):
    conversations = table(spark, sf_dir, "conversations")
    rows = [tuple(r) for r in conversations.select("conv_id", "turn", "role", "text").collect()]
    got = collected(c.repair_damaged(conversations))
    assert got == plain(rows)
    assert any(v[6] for v in got.values()) and len(got) == len({r[0] for r in rows})


def test_made_conversations_with_every_fault(spark):
    rng = random.Random(4)
    texts = ["Yes.", "No!", "Why?", "and then", "", " \t\n", None, "Ok. ", "é!", "a.b"]
    rows = [(i, t, rng.choice(["user", "assistant", "system", "user", "assistant", None, "tool"]), rng.choice(texts))
            for i in range(300) for t in rng.sample(range(20), rng.randint(1, 9))]
    df = spark.createDataFrame(rows, SCHEMA)
    assert collected(c.repair_damaged(df.repartition(9))) == plain(rows)
    assert collected(c.repair_conversations(df)) == plain(rows, damage=False)


def test_awkward_rows(spark):
    rows = [(None, None, None, None), (1, None, "user", "One."), (1, 4, "assistant", "Two."), (1, 2, "user", "Three."), (2, 9, None, ""),
            (3, 1, "user", "word. " * 200_000), (3, 2, "assistant", "Yes.")] + [(4, 1, "user", "Same.")] * 50
    df = clashing(spark.createDataFrame(rows, SCHEMA))
    got = collected(c.repair_conversations(df))
    assert got == plain(rows, damage=False)
    empty = hashlib.sha256(b"").hexdigest()
    assert got[None] == (0, 1, 0, 0, 0, 2, "D", empty) and got[2][6:] == ("D", empty)
    assert got[4][2] == 49 and set(got[3][6]) == {"K"}
    assert c.repair_conversations(df.limit(0)).count() == 0
    assert c.repair_damaged(df).count() == 5


def test_names_of_any_type(spark):
    rows = spark.createDataFrame([("x", 1, "user", "Hi."), ("x", 2, "assistant", "Ho.")], "conv_id string, turn int, role string, text string")
    assert [(r.conv_id, r.audit) for r in c.repair_conversations(rows).collect()] == [("x", "KK")]


def test_one_conversation_that_holds_most_rows(spark):
    rows = [(7, i, "user" if i % 2 == 0 else "assistant", f"Line {i}.") for i in range(9000)] + [(i, 0, "user", "Alone.") for i in range(20, 60)]
    got = collected(c.repair_conversations(spark.createDataFrame(rows, SCHEMA)))
    said = "\n".join(f"{r}:{t}" for _, _, r, t in rows[:9000])
    assert got[7] == (0, 0, 0, 0, 0, 0, "K" * 9000, hashlib.sha256(said.encode()).hexdigest())
    assert len(got) == 41
