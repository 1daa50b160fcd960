"""Token counts per section: whole documents are encoded once and their tokens attributed by character offsets.

A byte-level vocabulary loses nothing, so the lengths of the tokens give the byte, and from it the character, at which
each one starts and ends. Sections are character spans; a token belongs to the section that holds it, and one that
crosses a boundary is allocated by an explicit rule.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurekit.llm.common import small_batches

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

# Fixed value: how this vocabulary's text is cut into pieces before they are encoded.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# The matcher of this pattern steps back over a run of white space on its stack, which a very long run overflows. Such
# runs are cut out first, where the pattern cuts too: all of the run but its last character, which goes with what follows.
LONG_RUN = 10_000

# Who gets a token that lies in several sections: the one with its first character, with its last, or with most of it
# (the earlier one of equals).
RULES = ("start", "end", "most")

Span = tuple[int, int, str]


def load_ranks(path: str = VOCABULARY) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


def line_sections(text: str) -> list[Span]:
    """One section per non-empty line, with its line break; blank lines belong to the line before them."""
    spans: list[Span] = []
    start = 0
    for line in text.splitlines(keepends=True):
        end = start + len(line)
        if line.strip() or not spans:
            spans.append((start, end, _kind(line)))
        else:
            spans[-1] = (spans[-1][0], end, spans[-1][2])
        start = end
    return spans


def _kind(line: str) -> str:
    low = line.lower()
    if "license" in low or "copyright" in low:
        return "license"
    if line.count("|") >= 2:
        return "table"
    return "body" if line.strip() else "blank"


class Counter:
    """An encoder with its token lengths, built once per Python worker."""

    _built: dict[int, Counter] = {}

    def __init__(self, ranks: dict[bytes, int]):
        self.encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.one_piece = tiktoken.Encoding("own_piece", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})
        self.runs = regex.compile(rf"\p{{White_Space}}{{{LONG_RUN},}}")
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)

    @classmethod
    def once(cls, ranks: dict[bytes, int]) -> Counter:
        if len(ranks) not in cls._built:
            cls._built[len(ranks)] = cls(ranks)
        return cls._built[len(ranks)]

    def encode(self, text: str) -> list[int]:
        """The tokens of a text with white space runs of any length."""
        ids, at = [], 0
        for run in self.runs.finditer(text):
            end = run.end() if run.end() == len(text) else run.end() - 1
            ids += self.encoding.encode_ordinary(text[at : run.start()])
            ids += self.one_piece.encode_ordinary(text[run.start() : end])
            at = end
        return ids + self.encoding.encode_ordinary(text[at:])

    def offsets(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The first and the last character of every token; parts of a character count as that character."""
        ids = self.encode(text)
        ends = np.cumsum(self.lengths[np.array(ids, np.int64)]) if ids else np.zeros(0, np.int64)
        raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
        character = np.cumsum((raw & 0xC0) != 0x80) - 1
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if ids else ends
        return character[starts], character[ends - 1]

    def attribute(self, text: str, spans: list[Span], rule: str = "start") -> tuple[np.ndarray, np.ndarray, int]:
        """Tokens and boundary-crossing tokens per section, and the tokens of the whole text.

        ``spans`` are ordered, do not overlap and may leave gaps; what lies in a gap belongs to no section.
        """
        first, last = self.offsets(text)
        starts, ends = np.array([s for s, _, _ in spans], np.int64), np.array([e for _, e, _ in spans], np.int64)
        counts, crossing = np.zeros(len(spans), np.int64), np.zeros(len(spans), np.int64)
        if not len(spans) or not len(first):
            return counts, crossing, len(first)
        low = np.searchsorted(ends, first, side="right")  # the interval join: sections low .. high meet the token
        high = np.searchsorted(starts, last, side="right") - 1
        owner = np.where(low <= high, low, -1)
        multiple = np.flatnonzero(high > low)
        for t in multiple:
            parts = np.arange(low[t], high[t] + 1)
            if rule == "end":
                owner[t] = parts[-1]
            elif rule == "most":
                held = np.minimum(ends[parts], last[t] + 1) - np.maximum(starts[parts], first[t])
                owner[t] = parts[held.argmax()]
        # Besides other sections a token may also reach into a gap.
        inside = owner >= 0
        cut = inside & ((first < starts[owner]) | (last >= ends[owner]))
        np.add.at(counts, owner[inside], 1)
        np.add.at(crossing, owner[cut], 1)
        return counts, crossing, len(first)


def count_tokens(
    docs: DataFrame,
    vocabulary: str = VOCABULARY,
    sections: Callable[[str], list[Span]] = line_sections,
    rule: str = "start",
) -> DataFrame:
    """One row per section of every row of ``docs`` (doc_id, text):
    doc_id, section, kind, start, length, tokens, crossing, doc_tokens.

    Offsets count characters from 0, sections from 0. A null or empty text has the one section (0, "empty") of length
    and tokens 0. Texts and runs of white space may have any length. Repeated rows repeat, a null doc_id is carried along, other columns are ignored. ``tokens`` of the
    sections add up to doc_tokens where the sections cover the text.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    small_batches(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast(load_ranks(vocabulary))  # a vocabulary of some megabytes
    names = ["doc_id", "section", "kind", "start", "length", "tokens", "crossing", "doc_tokens"]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = Counter.once(shipped.value)
        for rows in batches:
            out = []
            for doc_id, text in zip(rows["doc_id"].astype("Int64"), rows["text"]):
                if not text:
                    out.append((doc_id, 0, "empty", 0, 0, 0, 0, 0))
                    continue
                spans = sections(text)
                tokens, crossing, total = counter.attribute(text, spans, rule)
                out += [(doc_id, i, kind, s, e - s, n, c, total)
                        for i, ((s, e, kind), n, c) in enumerate(zip(spans, tokens.tolist(), crossing.tolist()))]
            frame = pd.DataFrame(out, columns=names)
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(
        count, "doc_id long, section int, kind string, start long, length long, tokens long, crossing long, doc_tokens long")
