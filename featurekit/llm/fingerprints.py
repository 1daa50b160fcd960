"""Document fingerprints: SimHash with weighted terms, and the search for fingerprints within a Hamming radius.

Every word with the word after it is a term. Its 64-bit hash votes on each bit with a weight, the letters of the pair (at
most ``MAX_WEIGHT``), so that pairs of short function words count little; a bit is set if the votes for it outweigh those
against. The search keeps one table per choice of blocks: fingerprints within the radius agree on all bits of some choice.

Everything is built from DataFrame functions. Votes on three bits share a long while they are added up, for at most
``RUN`` terms of a text, and are then taken apart, so texts of any length fit.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurekit.operators.lookup import attach
from featurekit.operators.ordering import counted_ordinals
from featurekit.session import materialize

BITS = 64
MAX_WEIGHT = 24
RADIUS = 3

# Blocks beyond the radius: a table's key are that many blocks, half of all bits for a radius of 3.
SPARE_BLOCKS = 3

# Votes on bits i, i + 22 and i + 44 share a long; 2^14 terms of at most 24 stay below 2^19.
_LANES, _RUN_BITS = 22, 14
_LANE = 1 | 1 << _LANES | 1 << 2 * _LANES
_SLOT = (1 << _LANES) - 1


def words(text: Column) -> Column:
    """Lower-cased runs of anything but white space."""
    return F.array_remove(F.split(F.lower(text), r"\s+"), "")


def _terms(texts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, run, hash and weight: one row per term; a text without words gives one row of weight 0."""
    w = F.col("w")
    pairs = F.arrays_zip(w.alias("a"), F.slice("w", 2, F.greatest(F.size("w"), F.lit(1))).alias("b"))
    listed = texts.select(*keys, words(F.col("text")).alias("w")).select(*keys, F.posexplode_outer(pairs).alias("at", "pair"))
    length = F.coalesce(F.length("pair.a"), F.lit(0)) + F.coalesce(F.length("pair.b"), F.lit(0))
    return listed.select(
        *keys, F.shiftright(F.coalesce("at", F.lit(0)), _RUN_BITS).alias("run"), F.xxhash64("pair.a", "pair.b").alias("hash"),
        F.least(length, F.lit(MAX_WEIGHT)).cast("long").alias("weight"))


def fingerprints(texts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys and ``fp``, the fingerprint as a signed long, for rows of keys and ``text``.

    Equal keys must have equal texts; repeated rows change nothing, as all votes grow alike. Rows that are already
    partitioned by the keys are not shuffled, others are after their votes are added up. A text without words (or null)
    has fingerprint 0.
    """
    hashed, weight = F.col("hash"), F.col("weight")
    lanes = [F.sum(F.shiftrightunsigned(hashed, i).bitwiseAND(F.lit(_LANE)) * weight).alias(f"v{i}") for i in range(_LANES)]
    runs = _terms(texts, keys).groupBy(*keys, "run").agg(*lanes, F.sum(weight).alias("all"))
    votes = [
        F.sum(F.shiftrightunsigned(F.col(f"v{i % _LANES}"), i // _LANES * _LANES).bitwiseAND(F.lit(_SLOT))).alias(f"b{i}") for i in range(BITS)
    ]
    added = runs.groupBy(*keys).agg(*votes, F.sum("all").alias("all"))
    one = F.lit(1).cast("long")
    bits = [F.when(F.col(f"b{i}") * 2 > F.col("all"), F.shiftleft(one, i)).otherwise(F.lit(0).cast("long")) for i in range(BITS)]
    return added.select(*keys, reduce(lambda a, b: a.bitwiseOR(b), bits).alias("fp"))


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), BITS // 4, "0"))


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b)).cast("int")


def likeness(a: Column, b: Column) -> Column:
    """The share of equal bits."""
    return 1 - distance(a, b) / F.lit(float(BITS))


def _blocks(radius: int) -> list[int]:
    """One mask per block; the blocks cut the bits into even parts."""
    count = min(BITS, radius + SPARE_BLOCKS)
    edges = [BITS * i // count for i in range(count + 1)]
    return [(1 << high) - (1 << low) for low, high in zip(edges, edges[1:])]


def block_tables(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Every row of ``fps`` once per table, with ``table`` and ``key``, the bits that are kept there.

    A table keeps all but ``radius`` blocks, so two fingerprints that differ in at most so many bits meet in one.
    """
    blocks = _blocks(radius)
    kept = combinations(range(len(blocks)), len(blocks) - radius)
    masks = F.array(*[F.lit(_signed(sum(blocks[i] for i in chosen))) for chosen in kept])
    return fps.select("*", F.posexplode(masks).alias("table", "__mask")).withColumn(
        "key", F.col("fp").bitwiseAND(F.col("__mask"))).drop("__mask")


def _signed(mask: int) -> int:
    mask &= (1 << BITS) - 1
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def within_radius(queries: DataFrame, fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """All pairs (query_fp, fp, distance) of a fingerprint asked for and a stored one that differ in at most ``radius`` bits.

    Both tables have a column ``fp``; repeated and null fingerprints count once and not at all. The two meet in the
    permuted block tables; a pair that shares several of them is returned by the first one only.
    """
    def distinct(df: DataFrame) -> DataFrame:
        return df.where(F.col("fp").isNotNull()).select("fp").distinct()

    asked = block_tables(distinct(queries), radius).withColumnRenamed("fp", "query_fp")
    met = asked.join(block_tables(distinct(fps), radius), ["table", "key"])
    near = met.withColumn("distance", distance(F.col("query_fp"), F.col("fp"))).where(F.col("distance") <= radius)

    # The tables are the choices of blocks in lexicographic order: the first one that both are in keeps the first equal blocks.
    blocks = _blocks(radius)
    differ = F.col("query_fp").bitwiseXOR(F.col("fp"))
    equal = F.array(*[F.when(differ.bitwiseAND(F.lit(_signed(m))) == 0, F.lit(i)) for i, m in enumerate(blocks)])
    first = F.slice(F.array_compact(equal), 1, len(blocks) - radius)
    order = F.array(*[F.array(*map(F.lit, c)) for c in combinations(range(len(blocks)), len(blocks) - radius)])
    return near.where(F.array_position(order, first) - 1 == F.col("table")).select("query_fp", "fp", "distance")


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp of every row of ``docs`` (doc_id, text). Repeated rows stay repeated; other columns are ignored."""
    rows = _named(docs)
    prints = fingerprints(rows.select("u1", "u2", "text"), ["u1", "u2"])
    return attach(rows.select("doc_id", "u1", "u2"), prints, ["u1", "u2"]).select("doc_id", "fp")


def near_documents(docs: DataFrame, asked: Column, radius: int = RADIUS) -> DataFrame:
    """For the rows of ``docs`` where ``asked`` holds: doc_id, fingerprint, near_fingerprints and near_documents.

    These are the different fingerprints within ``radius`` bits, its own included, and the rows of ``docs`` that have them.
    """
    prints = materialize(document_fingerprints(docs))
    held = materialize(prints.groupBy("fp").agg(F.count(F.lit(1)).alias("held")))
    queries = prints.where(asked)
    met = within_radius(queries, held, radius)
    counts = attach(met, held, "fp").groupBy("query_fp").agg(
        F.count(F.lit(1)).alias("near_fingerprints"), F.sum("held").alias("near_documents"))
    found = attach(queries, counts.withColumnRenamed("query_fp", "fp"), "fp")
    return found.select("doc_id", hexadecimal(F.col("fp")).alias("fingerprint"), "near_fingerprints", "near_documents")


def _named(docs: DataFrame) -> DataFrame:
    """doc_id and text, and 128 bits that stand for both."""
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.select("*", F.xxhash64("doc_id", "text").alias("u1"), F.xxhash64(F.lit(1), "doc_id", "text").alias("u2"))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """How fingerprints answer to an edit: one row per row of ``docs`` (doc_id, text).

    The edited text of a document has its last third (floor of its code points / 3) replaced by the first as many code
    points, or all, of the next document. Next is the one with the next smaller doc_id, null last, and after the last
    comes the first; documents of one doc_id follow each other by a hash of their text, and rows with equal doc_id and
    text are one document. Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and
    near_next, the share of bits in which the fingerprint equals that of the edited text and that of the next document.
    Null texts count as empty. Other columns are ignored. No rows give no rows.

    Only keys and sizes are put in order. Texts are shuffled once by their key, and the pieces they lend to others once.
    """
    rows, key = _named(docs), ["u1", "u2"]
    units = rows.groupBy(*key).agg(F.first("doc_id").alias("doc_id"), F.first(F.length("text")).cast("long").alias("n_chars"))
    ordered = units.withColumns({"none": F.col("doc_id").isNull(), "down": F.bitwise_not(F.col("doc_id").cast("long"))})
    placed, total = counted_ordinals(ordered, ["none", "down", *key], name="place")
    lent = F.floor(F.col("n_chars") / 3)
    before = placed.select(
        F.pmod(F.col("place") + 1, F.lit(max(total, 1))).alias("place"), lent.cast("int").alias("asked"), F.col("u1").alias("to1"), F.col("u2").alias("to2"))
    link = materialize(placed.select("place", *key).join(before, "place").select(*key, "asked", "to1", "to2"))

    texts = rows.groupBy(*key).agg(F.first("text").alias("text"))  # equal rows are one before the shuffle
    heads = texts.join(link, key).select(
        F.col("to1").alias("u1"), F.col("to2").alias("u2"), F.substr("text", F.lit(1), F.col("asked")).alias("head"),
        F.col("u1").alias("next1"), F.col("u2").alias("next2"))
    size = F.length("text")
    stays = F.substr("text", F.lit(1), size - F.floor(size / 3).cast("int"))
    both = texts.join(heads, key).select(*key, "next1", "next2", "text", F.concat(stays, "head").alias("edited"))
    versions = both.select(*key, "next1", "next2", F.explode(F.array(
        F.struct(F.lit(False).alias("changed"), F.col("text"), F.lit(None).cast("string").alias("sha")),
        F.struct(F.lit(True).alias("changed"), F.col("edited").alias("text"), F.sha2(F.col("edited").cast("binary"), 256).alias("sha")),
    )).alias("v")).select(*key, "next1", "next2", "v.*")
    prints = fingerprints(versions, [*key, "next1", "next2", "changed", "sha"])
    pick = lambda c, changed: F.max(F.when(F.col("changed") == changed, F.col(c)))
    found = materialize(prints.groupBy(*key, "next1", "next2").agg(
        pick("fp", False).alias("fp"), pick("fp", True).alias("edited_fp"), F.max("sha").alias("edited_sha256")))
    following = found.select(F.col("u1").alias("next1"), F.col("u2").alias("next2"), F.col("fp").alias("next_fp"))
    known = found.join(following, ["next1", "next2"]).select(
        *key, "edited_sha256", hexadecimal(F.col("fp")).alias("fingerprint"), hexadecimal(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))
    told = attach(rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), *key), known, key)
    return told.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
