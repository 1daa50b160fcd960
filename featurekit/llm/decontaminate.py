"""Benchmark decontamination: MinHash containment search, verified on exact word shingles.

Containment of a short item in a long document says nothing about their Jaccard similarity, so the two sides are
sketched differently. An item with n distinct shingles keeps its bottom-k MinHash
sketch, its k smallest hashes, where k is one more than the shingles that may be missing at the wanted containment:
a document that contains enough of the item must hold at least one of these k. A document's sketch is what
it has below the largest hash that any item with shingles of that length keeps; size partitions are merged into it. So nothing can be missed,
documents of any length are searched whole, and only hashes below that bound leave the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurekit.operators.lookup import attach
from featurekit.session import materialize

SHINGLE_WORDS = 5
CONTAINMENT = 0.8

_NOT_A_WORD = r"[^\p{L}\p{N}]+"


def words(text: str | Column) -> Column:
    """Lower-cased runs of letters and digits; null has none."""
    parts = F.array_remove(F.split(F.lower(text), _NOT_A_WORD), "")
    return F.coalesce(parts, F.array().cast("array<string>"))


def _starts(length: Column | int) -> Column:
    """The positions in ``w`` at which a run of ``length`` words starts."""
    return F.when(F.size("w") >= length, F.sequence(F.lit(1), F.size("w") - length + 1)).otherwise(F.array().cast("array<int>"))


def shingle_hashes(length: int) -> Column:
    """Hashes of the runs of ``length`` words of the column ``w``."""
    w = F.col("w")
    return F.transform(_starts(length), lambda i: F.xxhash64(*[F.element_at(w, i + k) for k in range(length)]))


def shingle_texts(length: Column | int) -> Column:
    return F.transform(_starts(length), lambda i: F.concat_ws(" ", F.slice("w", i, length)))


def _up_to(hashes: Column, top: int) -> Column:
    return F.filter(hashes, lambda h: h <= F.lit(top))


def _item_set() -> Column:
    """The items of a group; they are wrapped, because collected sets leave plain nulls out."""
    return F.collect_set(F.struct("item_id"))


def item_sketches(items: DataFrame, shingle_words: int, containment: float) -> DataFrame:
    """One row per item that has words: item_id, length (words per shingle), texts, partition and sketch (k smallest hashes).

    Items of fewer words than a shingle are one shingle of their own length.
    """
    length = F.least(F.size("w"), F.lit(shingle_words))
    hashed = F.when(
        F.size("w") >= shingle_words, F.array_distinct(shingle_hashes(shingle_words))
    ).otherwise(F.array(F.lit(0).cast("long")))
    for short in range(1, shingle_words):
        hashed = F.when(F.size("w") == short, shingle_hashes(short)).otherwise(hashed)
    listed = (
        items.select("item_id", words("text").alias("w")).where(F.size("w") > 0)
        .withColumn("length", length).withColumn("hashes", F.sort_array(hashed))
        .withColumn("texts", F.array_distinct(shingle_texts(F.col("length")))).drop("w")
    )
    n = F.size("texts")
    needed = F.ceil(n * F.lit(containment) - 1e-9)
    return (
        listed.withColumn("needed", needed).withColumn("partition", F.floor(F.log2(n)).cast("int"))
        .withColumn("sketch", F.slice("hashes", F.lit(1), (n - F.col("needed") + 1).cast("int"))).drop("hashes")
    )


def contained_items(
    docs: DataFrame, items: DataFrame, shingle_words: int = SHINGLE_WORDS, containment: float = CONTAINMENT
) -> DataFrame:
    """Pairs (doc_id, text_hash, item_id, shared, item_shingles, containment) with containment of the item >= the bound.

    Words are lower-cased runs of letters and digits. Items of fewer than ``shingle_words`` words have to occur as a
    whole. Null or empty texts hold nothing and items without words are held by nothing. A null item_id or doc_id
    is a value like any other; rows are told apart by doc_id and the hash of the text, and repeated rows count once.
    Other columns are ignored.
    """
    listed = materialize(item_sketches(items.select("item_id", "text"), shingle_words, containment))
    bounds = listed.groupBy("length", "partition").agg(F.max(F.array_max("sketch")).alias("top")).collect()  # sizes are few
    row_key = ["doc_id", F.xxhash64("text").alias("text_hash")]

    # The partitions' bounds are merged to the loosest per length: sketches below smaller bounds lie inside that one.
    tops: dict[int, int] = {}
    for b in bounds:
        tops[b["length"]] = max(b["top"], tops.get(b["length"], b["top"]))
    sketch = F.array().cast("array<long>")
    for length, top in sorted(tops.items()):
        sketch = F.concat(sketch, _up_to(shingle_hashes(length), top))
    probes = (
        docs.select(*row_key, words("text").alias("w")).select("doc_id", "text_hash", F.explode(sketch).alias("hash"))
    )
    kept = listed.select("item_id", F.explode("sketch").alias("hash")).groupBy("hash").agg(_item_set().alias("items"))
    met = attach(probes, kept, "hash").where(F.col("items").isNotNull())
    candidates = materialize(met.select("doc_id", "text_hash", F.explode("items.item_id").alias("item_id")).distinct())

    per_doc = candidates.groupBy("doc_id", "text_hash").agg(_item_set().alias("items"))
    found = attach(docs.select("text", *row_key), per_doc, ["doc_id", "text_hash"]).where(F.col("items").isNotNull())
    pairs = found.dropDuplicates(["doc_id", "text_hash"]).select(
        "doc_id", "text_hash", words("text").alias("w"), F.explode("items.item_id").alias("item_id")
    )
    known = attach(pairs, listed.select("item_id", "texts", "length", "needed"), "item_id")
    shared = F.size(F.array_intersect(shingle_texts(F.col("length")), F.col("texts")))
    return (
        known.select("doc_id", "text_hash", "item_id", shared.alias("shared"), F.size("texts").alias("item_shingles"), "needed")
        .where(F.col("shared") >= F.col("needed"))
        .select("doc_id", "text_hash", "item_id", "shared", "item_shingles",
                (F.col("shared") / F.col("item_shingles")).alias("containment"))
    )


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Drop the documents that contain an item; all others stay as they are."""
    bad = contained_items(docs, items).select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__text")).distinct().withColumn("__held", F.lit(True))
    keyed = docs.select("*", F.col("doc_id").alias("__id"), F.xxhash64("text").alias("__text"))
    return attach(keyed, bad, ["__id", "__text"]).where(F.col("__held").isNull()).select(*docs.columns)
