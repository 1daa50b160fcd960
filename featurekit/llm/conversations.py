"""Conversation structure repair: the cheapest edits that make the roles of a conversation alternate.

A conversation is read as a word of symbols, one per row: the initial of its role and what is wrong with it. Equal
consecutive symbols are one run. A run's effect on the four states of the wanted pattern ``(s?(ua)+)?`` is a power of
the symbol's min-plus transition matrix, built from cached binary powers; going through the runs backwards gives the
cost to the end from every state, and walking forwards again picks the edits.

Spark brings every conversation together in order, first without its texts (symbols), then with them (hash of the
repaired text); both times the rows are streamed, so what a task holds is one byte or so per row of one conversation,
as much as its audit, and never its texts.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from featurekit.llm.common import small_batches
from featurekit.operators.lookup import WEIGHT, attach
from featurekit.session import materialize

KEEP, REROLE, DELETE, INSERT = 0, 1, 2, 5
TRUNCATED = 5  # added to a truncated row that is not deleted

# States: nothing yet, after the system turn, after a user turn, after an assistant turn. A conversation may end in 0 or 3.
STATES, ENDS = 4, (0, 3)
_TURN = {0: ("u", 2), 1: ("u", 2), 2: ("a", 3), 3: ("u", 2)}  # the turn that may come next, and the state after it
_NEVER = 1 << 60

# A symbol is the role's initial (any other is "x") and one of these.
SOUND, CUT, BAD = 0, 1, 2
_INITIALS = "suax"
_LEGAL = {"su", "ua", "au"}

# Rows whose costs to the end are held at once while edits are chosen.
BLOCK = 1024

_WHITE = " \t\n\v\f\r"


def symbol(initial: str, fault: int) -> int:
    return _INITIALS.find(initial if initial and initial in _INITIALS else "x") * 3 + fault


def _steps(sym: int, state: int) -> Iterator[tuple[str, int, int]]:
    """The edits of a row of this symbol in this state, but for insertions: letter, cost and state after, in ASCII order."""
    initial, fault = _INITIALS[sym // 3], sym % 3
    yield "D", DELETE, state
    if fault == BAD:
        return
    extra = TRUNCATED if fault == CUT else 0
    wanted, after = _TURN[state]
    if initial == wanted:
        yield "K", KEEP + extra, after
    elif initial == "s" and state == 0:
        yield "K", KEEP + extra, 1
    yield "R", REROLE + extra, after


def _times(a: tuple, b: tuple) -> tuple:
    return tuple(tuple(min(a[i][k] + b[k][j] for k in range(STATES)) for j in range(STATES)) for i in range(STATES))


def _on(matrix: tuple, costs: tuple) -> tuple:
    return tuple(min(m + c for m, c in zip(row, costs)) for row in matrix)


def _inserting() -> tuple:
    """Cheapest insertions from state to state."""
    rows = []
    for state in range(STATES):
        cost, at, row = 0, state, [_NEVER] * STATES
        while row[at] > cost:
            row[at] = cost
            cost, at = cost + INSERT, _TURN[at][1]
        rows.append(tuple(row))
    return tuple(rows)


_INSERTING = _inserting()
_END = _on(_INSERTING, tuple(0 if s in ENDS else _NEVER for s in range(STATES)))


@cache
def power(sym: int, exponent: int) -> tuple:
    """The min-plus matrix of ``2 ** exponent`` rows of one symbol, insertions before each of them included."""
    if exponent:
        half = power(sym, exponent - 1)
        return _times(half, half)
    single = [[_NEVER] * STATES for _ in range(STATES)]
    for state in range(STATES):
        for _, cost, after in _steps(sym, state):
            single[state][after] = min(single[state][after], cost)
    return _times(_INSERTING, tuple(map(tuple, single)))


def before_run(sym: int, length: int, costs: tuple) -> tuple:
    """Costs to the end before a run, from those after it."""
    exponent = 0
    while length:
        if length & 1:
            costs = _on(power(sym, exponent), costs)
        length >>= 1
        exponent += 1
    return costs


class Runs:
    """Run-length encoded symbols, in arrays of plain numbers; no run is longer than ``BLOCK``, so a long one is several."""

    def __init__(self):
        self.symbols, self.lengths = bytearray(), array("i")

    def add(self, sym: int) -> None:
        if self.symbols and self.symbols[-1] == sym and self.lengths[-1] < BLOCK:
            self.lengths[-1] += 1
        else:
            self.symbols.append(sym)
            self.lengths.append(1)


def repair(runs: Runs) -> tuple[int, str]:
    """The least cost and, of all cheapest edit sequences, the letters of the ASCII-least one (D, I, K, R)."""
    count, costs, marks = len(runs.symbols), _END, {}
    for i in range(count - 1, -1, -1):
        if (i + 1) % BLOCK == 0 or i == count - 1:
            marks[i] = costs  # after this run
        costs = before_run(runs.symbols[i], runs.lengths[i], costs)
    total, state, letters = costs[0], 0, []
    for low in range(0, count, BLOCK):
        high = min(low + BLOCK, count)
        after = [marks[high - 1]]
        for i in range(high - 1, low, -1):
            after.append(before_run(runs.symbols[i], runs.lengths[i], after[-1]))
        for i in range(low, high):
            state = _choose(runs.symbols[i], runs.lengths[i], after[high - 1 - i], state, letters)
    while state not in ENDS:
        letters.append("I")
        state = _TURN[state][1]
    return total, "".join(letters)


def _choose(sym: int, length: int, costs: tuple, state: int, letters: list[str]) -> int:
    """Walk one run forwards: the first letter in ASCII order that still reaches the end at the least cost."""
    after = [costs]
    for _ in range(length):
        after.append(_on(power(sym, 0), after[-1]))
    for left in range(length, 0, -1):
        while True:
            best = after[left][state]
            options = list(_steps(sym, state))
            options.insert(1, ("I", INSERT, _TURN[state][1]))
            for letter, cost, then in options:
                rest = after[left][then] if letter == "I" else after[left - 1][then]
                if cost + rest == best:
                    break
            letters.append(letter)
            state = then
            if letter != "I":
                break
    return state


def _text(column: str) -> Column:
    """The column as text; null is one space."""
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text) after the planted faults, each drawn by crc32 of ``conv_id:turn`` modulo 20.

    0 drops the row, 1 empties its text, 2 removes its full stops, exclamation and question marks, 3 repeats it, 4
    makes it a user's. Null roles and texts, and nulls inside the drawn text, are one space.
    """
    fault = F.crc32(F.concat(_text("conv_id"), F.lit(":"), _text("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", _text("role").alias("role"), _text("text").alias("text"), fault.alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    return rows.where(F.col("fault") != 0).select(
        "conv_id", "turn", role.alias("role"), text.alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[column.to_pylist() for column in batch.columns])


def _in_batches(rows: Iterator[tuple], schema: pa.Schema, limit: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Result batches of bounded size: audits may be long."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 100 + len(row[AUDIT])
        if size > limit:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
AUDIT = 1 + len(COUNTS)


def _schemas(rows: DataFrame) -> tuple[T.StructType, T.StructType]:
    """Types of the audits, and of the audits with their hash."""
    fields = [T.StructField("conv_id", rows.schema["conv_id"].dataType), *[T.StructField(c, T.LongType()) for c in COUNTS],
              T.StructField("audit", T.StringType())]
    return T.StructType(fields), T.StructType([*fields, T.StructField("repaired_sha256", T.StringType())])


class _Read:
    """What is known of a conversation while its rows go by."""

    def __init__(self, conv):
        self.conv, self.counts, self.turns = conv, [0, 0, 0, 0], None
        self.runs, self.last, self.content = Runs(), None, None

    def add(self, turn: int | None, initial: str, blank: bool, cut: bool, here: bool, content: int | None) -> None:
        if turn is not None:
            low, high, distinct = self.turns or (turn, None, 0)
            self.turns = (low, turn, distinct + (turn != high))
        # A row that is not the first of its role and text in the turn where these occur first is a duplicate.
        repeated = not here or (content is not None and content == self.content)
        found = [blank, repeated, cut]
        if any(found):
            self.counts[found.index(True)] += 1
        if self.last is not None and self.last + initial not in _LEGAL:
            self.counts[3] += 1
        self.last, self.content = initial, content
        self.runs.add(symbol(initial, BAD if blank or repeated else CUT if cut else SOUND))

    def result(self) -> tuple:
        gaps = self.turns[1] - self.turns[0] + 1 - self.turns[2] if self.turns else 0
        cost, audit = repair(self.runs)
        return self.conv, gaps, *self.counts, cost, audit


def _audits(rows: DataFrame) -> DataFrame:
    """Counted faults, cost and audit of every conversation.

    Takes (conv_id, named, ...) in order, where a row that is ``named`` opens a conversation.
    """
    schema = _schemas(rows)[0]
    arrow = to_arrow_schema(schema)

    def conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        read = None
        for conv, named, *row in _records(batches):
            if named:
                if read is not None:
                    yield read.result()
                read = _Read(conv)
            else:
                read.add(*row)
        if read is not None:
            yield read.result()

    return rows.mapInArrow(lambda batches: _in_batches(conversations(batches), arrow), schema)


def _hashed(rows: DataFrame) -> DataFrame:
    """The audits with the hash of the repaired text; a conversation's audit comes before its rows."""
    schema = _schemas(rows)[1]
    arrow = to_arrow_schema(schema)

    def conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        found = edits = None
        for *audit, role, text in _records(batches):
            if audit[AUDIT] is not None:
                if found is not None:
                    yield *found, edits.digest()
                found, edits = audit, _Edits(audit[AUDIT])
            else:
                edits.apply(role, text)
        if found is not None:
            yield *found, edits.digest()

    return rows.mapInArrow(lambda batches: _in_batches(conversations(batches), arrow), schema)


class _Edits:
    """An audit that is carried out row by row, and the running hash of the ``role:text`` lines it gives."""

    names = {"u": "user", "a": "assistant"}

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, 0
        self.hash, self.any = hashlib.sha256(), False

    def apply(self, role: str, text: str) -> None:
        self._insertions()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "R":
            self._turn(text)
        elif letter == "K":
            self._say(role, text)
            self.state = 1 if role[:1] == "s" else _TURN[self.state][1]

    def digest(self) -> str:
        self._insertions()
        return self.hash.hexdigest()

    def _insertions(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self._turn("")
            self.at += 1

    def _turn(self, text: str) -> None:
        wanted, self.state = _TURN[self.state]
        self._say(self.names[wanted], text)

    def _say(self, role: str, text: str) -> None:
        self.hash.update(f"{chr(10) if self.any else ''}{role}:{text}".encode())
        self.any = True


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """One row per conv_id (null is one too): gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256.

    Rows are (conv_id, turn, role, text), taken by turn, nulls first; rows of one turn come by role, then by a hash of
    the text, and equal rows one after the other. A null role or text is one space. The first fault of a row counts:
    blank (nothing but white space), duplicate (role and text came earlier), truncated (the last solid character ends
    no sentence). ``gaps`` are turn numbers missing between the smallest and the largest, ``illegal`` neighbours whose
    role initials are not su, ua or au. Edits are Keep, Rerole to user or assistant, Delete and Insert of an empty user or
    assistant turn, at the costs above; the roles of the result match ``(s?(ua)+)?``. A conversation without rows,
    or of blank rows alone, becomes the empty one. Other columns are ignored. No rows give no rows.
    """
    return _repair(conversations, conversations.select("conv_id", "turn", _text("role").alias("role"), _text("text").alias("text")))


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """:func:`repair_conversations` of the rows that :func:`damaged` makes; every conv_id of the table stays in the result."""
    return _repair(conversations, damaged(conversations))


def _repair(named: DataFrame, rows: DataFrame) -> DataFrame:
    small_batches(named.sparkSession)
    ids = named.select("conv_id").distinct().withColumn("named", F.lit(True))
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text", F.xxhash64("role", "text").alias("content"))
    solid = F.rtrim("text", F.lit(_WHITE))
    signs = rows.select(
        "conv_id", F.lit(False).alias("named"), "turn", "role", "content", F.substring("role", 1, 1).alias("initial"),
        (solid == "").alias("blank"), (~F.right(solid, F.lit(1)).isin(".", "!", "?")).alias("cut"))

    # Only what several rows of a conversation hold can be a duplicate; a null turn comes before all numbers.
    first = F.when(F.count_if(F.col("turn").isNull()) == 0, F.min("turn")).alias("first_turn")
    repeats = signs.where(~F.col("blank")).groupBy("conv_id", "content").agg(F.count(F.lit(1)).alias(WEIGHT), first)
    again = repeats.where(F.col(WEIGHT) > 1).withColumn("again", F.lit(True))
    known = attach(signs, again, ["conv_id", "content"])
    headed = known.withColumns({
        "here": F.col("again").isNull() | F.col("turn").eqNullSafe(F.col("first_turn")),
        "shared": F.when(F.col("again"), F.col("content")),
    }).unionByName(ids, allowMissingColumns=True)
    order = [F.asc_nulls_first("turn"), "role", "content"]
    opened = headed.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("named"), *order)
    audits = materialize(_audits(opened.select("conv_id", "named", "turn", "initial", "blank", "cut", "here", "shared")))

    told = rows.unionByName(audits, allowMissingColumns=True)
    opened = told.repartition("conv_id").sortWithinPartitions("conv_id", F.col("audit").isNull(), *order)
    return _hashed(opened.select("conv_id", *COUNTS, "audit", "role", "text"))
