"""SimHash fingerprints of whole texts and the groups they form within a Hamming distance.

The self-join walks a binary trie of the distinct fingerprints against itself: a pair of nodes carries the number
of bits in which their prefixes differ and is given up when that exceeds the budget. The first levels are walked by
Spark, which sends each fingerprint to the pairs of top-level subtrees it belongs to; the levels below are walked
inside one task per pair of subtrees, as NumPy arrays of node ranges.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import ceil, log2

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurekit.llm.common import small_batches
from featurekit.llm.components import components
from featurekit.operators.lookup import WEIGHT, attach
from featurekit.session import materialize

SEED = 42
BITS = 64
SHINGLE_WORDS = 3
MAX_DISTANCE = 3

# Levels of the trie that are dealt out as tasks: enough for BLOCK_ROWS fingerprints per subtree, at least MIN_LEVELS.
BLOCK_ROWS = 1 << 20
MIN_LEVELS = 4

# Inside a task: node pairs walked at once, and pairs of leaves under a node pair that are compared directly.
FRONTIER = 1 << 19
DIRECT = 16

_CHUNK = 1 << 16
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The SimHash of one text: bit i is set when it is set in over half of the shingle hashes.

    A-Z are lower-cased, words are runs of non-white-space (ASCII), shingles keep their repeats, fewer words than a
    shingle make one shingle, and no word at all (or null) gives zero.
    """
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    span = min(shingle_words, len(words))
    first, last = starts[: len(words) - span + 1], ends[span - 1 :]
    digest, set_bits = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, len(first), _CHUNK):  # bounds the memory that very long texts take
        ranges = zip(first[at : at + _CHUNK].tolist(), last[at : at + _CHUNK].tolist())
        hashes = np.array([digest(joined[s:e], SEED) for s, e in ranges], dtype=">u8").view(np.uint8).reshape(-1, 8)
        counts = np.stack([np.bincount(hashes[:, i], minlength=256) for i in range(8)])
        set_bits += (counts @ _BYTE_BITS).ravel()
    return int.from_bytes(np.packbits(set_bits * 2 > len(first)).tobytes(), "big")


def with_fingerprint(df: DataFrame, text: str = "text", name: str = "fp", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """Add the fingerprint as a signed long (the same 64 bits)."""
    small_batches(df.sparkSession)

    @F.pandas_udf("long")
    def signed(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(np.array([fingerprint(t, shingle_words) for t in batch], np.uint64).view(np.int64))

    return df.withColumn(name, signed(F.col(text).cast("string")))


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _reordered(values: np.ndarray, order: list[int]) -> np.ndarray:
    """The same bits with bit ``order[0]`` first; distances stay what they are."""
    out = np.zeros(len(values), np.uint64)
    for bit in order:
        out = (out << np.uint64(1)) | ((values >> np.uint64(bit)) & np.uint64(1))
    return out


def _spanning(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member of each item's component under the links (a, b)."""
    label = np.arange(size)
    while len(a):
        la, lb = label[a], label[b]
        differ = la != lb
        a, b = a[differ], b[differ]
        np.minimum.at(label, np.maximum(la, lb)[differ], np.minimum(la, lb)[differ])
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label = jumped
    return label


class _Trie:
    """Node ranges over a sorted array; the ones before a position, per level, tell where a node splits."""

    def __init__(self, values: np.ndarray):
        self.values, self._ones = values, {}

    def split(self, low: np.ndarray, high: np.ndarray, level: int) -> np.ndarray:
        if level not in self._ones:
            bit = (self.values >> np.uint64(BITS - 1 - level)) & np.uint64(1)
            self._ones[level] = np.concatenate([[0], np.cumsum(bit, dtype=np.int64)]).astype(np.int32)
        ones = self._ones[level]
        return high - (ones[high] - ones[low])


def trie_join(left: np.ndarray, right: np.ndarray | None, level: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of all pairs of two sorted arrays that differ in at most ``budget`` bits after the first ``level``.

    ``right`` None joins the array with itself; then each unordered pair of different positions comes once.
    """
    own = right is None
    a, b = _Trie(left), None
    b = a if own else _Trie(right)
    root = [np.array([x]) for x in (0, len(left), 0, len(b.values), budget)]
    stack = [(level, *root)]
    while stack:
        depth, alo, ahi, blo, bhi, left_over = stack.pop()
        if len(alo) > FRONTIER:
            half = len(alo) // 2
            stack.append((depth, *[x[:half] for x in (alo, ahi, blo, bhi, left_over)]))
            stack.append((depth, *[x[half:] for x in (alo, ahi, blo, bhi, left_over)]))
            continue
        na, nb = ahi - alo, bhi - blo
        small = (na * nb <= DIRECT) | (depth == BITS)
        for at in _batches(na[small] * nb[small]):
            yield from _leaves(a, b, *[x[small][at] for x in (alo, ahi, blo, bhi)], own, budget, level)
        alo, ahi, blo, bhi, left_over = (x[~small] for x in (alo, ahi, blo, bhi, left_over))
        if not len(alo):
            continue
        amid, bmid = a.split(alo, ahi, depth), b.split(blo, bhi, depth)
        one_less = left_over - 1
        twice = (alo != blo) | (ahi != bhi) if own else np.ones(len(alo), bool)  # a node with itself has one mixed pair
        children = [
            (alo, amid, blo, bmid, left_over), (amid, ahi, bmid, bhi, left_over), (alo, amid, bmid, bhi, one_less),
            tuple(x[twice] for x in (amid, ahi, blo, bmid, one_less)),
        ]
        alo, ahi, blo, bhi, left_over = (np.concatenate(x) for x in zip(*children))
        alive = (alo < ahi) & (blo < bhi) & (left_over >= 0)
        stack.append((depth + 1, *[x[alive] for x in (alo, ahi, blo, bhi, left_over)]))


def _batches(work: np.ndarray) -> Iterator[slice]:
    """Consecutive slices with a bounded sum of ``work``."""
    if len(work):
        part = np.cumsum(work) // (FRONTIER * 4)
        edges = np.flatnonzero(np.diff(part)) + 1
        yield from (slice(s, e) for s, e in zip([0, *edges], [*edges, len(work)]))


def _leaves(a, b, alo, ahi, blo, bhi, own, budget, level):
    nb = bhi - blo
    count = (ahi - alo) * nb
    node = np.repeat(np.arange(len(alo)), count)
    nth = np.arange(len(node)) - np.repeat(np.cumsum(count) - count, count)
    i, j = alo[node] + nth // nb[node], blo[node] + nth % nb[node]
    if own:
        i, j = i[i < j], j[i < j]
    below = np.uint64((1 << (BITS - level)) - 1)
    near = np.bitwise_count((a.values[i] ^ b.values[j]) & below) <= budget
    if near.any():
        yield i[near], j[near]


def _subtree_links(left: np.ndarray, right: np.ndarray | None, level: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links: enough for components, and never more rows than fingerprints."""
    values = left if right is None else np.concatenate([left, right])
    shift, kept, held = 0 if right is None else len(left), [], 0
    label = np.arange(len(values))
    for i, j in trie_join(left, right, level, budget):
        kept.append((i, j + shift))
        held += len(i)
        if held > 4 * FRONTIER:
            label = _joined(label, kept)
            kept, held = [], 0
    label = _joined(label, kept)
    child = np.flatnonzero(label != np.arange(len(label)))
    return values[child], values[label[child]]


def _joined(label: np.ndarray, kept: list) -> np.ndarray:
    own = np.flatnonzero(label != np.arange(len(label)))
    a = np.concatenate([own, *[x for x, _ in kept]])
    b = np.concatenate([label[own], *[y for _, y in kept]])
    return _spanning(len(label), a, b)


def hamming_links(fingerprints: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that connect exactly what lies within ``max_distance``.

    Of every pair of subtrees only a spanning forest of its links is returned. Bits that are set most evenly come
    first in the trie, so subtrees are of like size.
    """
    total = fingerprints.agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.getbit("fp", F.lit(i))).cast("long").alias(f"b{i}") for i in range(BITS)]
    ).first()
    rows = total["n"]
    order = sorted(range(BITS), key=lambda i: (abs(2 * (total[f"b{i}"] or 0) - rows), i))
    levels = max(MIN_LEVELS, ceil(log2(max(rows, 1) / BLOCK_ROWS)) if rows else 0)

    prefix = reduce(lambda x, i: x * 2 + F.getbit("fp", F.lit(i)).cast("long"), order[:levels], F.lit(0).cast("long"))
    masks = [m for m in range(1 << levels) if m.bit_count() <= max_distance]
    other = F.explode(F.array(*[F.lit(m).cast("long") for m in masks])) if levels else None
    dealt = (
        fingerprints.select("fp", prefix.alias("subtree")).withColumn("mask", other)
        .withColumn("pair", F.least("subtree", F.col("subtree").bitwiseXOR(F.col("mask"))))
    )

    def walk(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        low, mask = key
        values = _reordered(rows["fp"].to_numpy().view(np.uint64), order)
        first = (values >> np.uint64(BITS - levels)) == np.uint64(low)
        back = [order.index(BITS - 1 - k) for k in range(BITS)]  # undoes the reordering
        left = np.sort(values[first])
        right = None if mask == 0 else np.sort(values[~first])
        budget = max_distance - int(mask).bit_count()
        a, b = _subtree_links(left, right, levels, budget) if len(left) and (right is None or len(right)) else (left[:0],) * 2
        undo = [BITS - 1 - x for x in back]
        return pd.DataFrame({"a": _reordered(a, undo).view(np.int64), "b": _reordered(b, undo).view(np.int64)})

    return dealt.select("pair", "mask", "fp").groupBy("pair", "mask").applyInPandas(walk, "a long, b long")


def near_duplicate_groups(docs: DataFrame, max_distance: int = MAX_DISTANCE, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, fingerprint (hex) and component_id.

    component_id is the smallest doc_id that can be reached over links of at most ``max_distance`` differing bits;
    equal fingerprints are linked. Null texts and texts without words have fingerprint zero and are linked like any
    other. A null doc_id names nothing: such a row takes the smallest id of its group, null if the group has none.
    Repeated rows stay repeated. Other columns are ignored. No rows give no rows.
    """
    rows = materialize(with_fingerprint(docs.select("doc_id", "text"), shingle_words=shingle_words).select("doc_id", "fp"))
    distinct = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies")))
    rooted = components(hamming_links(distinct.select("fp"), max_distance))
    linked = distinct.join(rooted.withColumnRenamed("node", "fp"), "fp")
    smallest = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    # Only fingerprints with copies or links need a look-up; any other row is its own component.
    grouped = linked.join(smallest, "root").select("fp", "component_id", F.col("copies").alias(WEIGHT))
    alone = distinct.where("copies > 1").join(rooted.select(F.col("node").alias("fp")), "fp", "left_anti")
    named = grouped.union(alone.select("fp", F.col("first_id").alias("component_id"), F.col("copies").alias(WEIGHT)))
    found = attach(rows, named.withColumn("grouped", F.lit(True)), "fp")
    component = F.when(F.col("grouped"), F.col("component_id")).otherwise(F.col("doc_id"))
    return found.select("doc_id", hexadecimal(F.col("fp")).alias("fingerprint"), component.alias("component_id"))


def keep_one_per_group(docs: DataFrame, max_distance: int = MAX_DISTANCE, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """Drop near-duplicates: of every group of linked fingerprints the row with the smallest doc_id stays, once, with all its columns.

    Rows are told apart by doc_id and text; of several texts under the smallest doc_id of a group the one with the
    smallest hash stays. Rows without a doc_id cannot be named and stay. No rows give no rows.
    """
    rows = with_fingerprint(docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text"), shingle_words=shingle_words)
    units = materialize(
        rows.groupBy("fp", "doc_id", F.xxhash64("text").alias("text_hash")).agg(F.count(F.lit(1)).alias("repeats")))
    distinct = materialize(units.groupBy("fp").agg(F.count(F.lit(1)).alias("texts")))
    rooted = components(hamming_links(distinct.select("fp"), max_distance)).withColumnRenamed("node", "fp")
    first = F.min(F.struct("doc_id", "text_hash", "repeats")).alias("first")
    # Any text that is its own group needs no look-up: one key per unlinked fingerprint.
    named = distinct.join(rooted, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), F.col("texts").alias(WEIGHT))
    kept = attach(units, named, "fp").groupBy("root").agg(first).select(
        F.col("first.doc_id").alias("__id"), F.col("first.text_hash").alias("__text"), F.col("first.repeats").alias("__repeats"))
    keyed = docs.select("*", F.col("doc_id").alias("__id"), F.xxhash64("text").alias("__text"))
    found = attach(keyed.where(F.col("__id").isNotNull()), kept, ["__id", "__text"])
    once = found.where(F.col("__repeats") == 1)
    repeated = found.where(F.col("__repeats") > 1).dropDuplicates(["__id", "__text"])
    return once.unionByName(repeated).select(*docs.columns).unionByName(docs.where(F.col("doc_id").isNull()))
