"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featurekit.llm.common import WORD
from featurekit.operators.lookup import attach, store
from featurekit.operators.ordering import ordinals, running_sums
from featurekit.session import materialize

SEED = 17
MAX_COPIES = 3
WEIGHTS = (1.0, 2.0, 3.0)


_EXACT = 1e-9

# The gap is first looked for in this many times its own words of the order; windows without enough grow by GROWTH.
SPAN = 64
GROWTH = 8


def text_hash() -> Column:
    return F.xxhash64("text")


def word_count(text: str | Column = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, max_copies: int = MAX_COPIES, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """Add ``target`` to one row per source (source, source_size).

    Sources in code-point order, null last, weigh ``weights``, repeating, and share the sum of all sizes; a target
    stops at ``max_copies`` times its source's size and the excess is shared again by weight until none is above.
    That ends where target = min(cap, level * weight) for one level: in order of cap / weight the sources up to some
    point are capped, and running sums tell which. No rows give no rows; a source of size zero has target zero.
    """
    ordered = ordinals(
        sources.withColumn("last", F.col("source").isNull()).withColumn("key", F.coalesce("source", F.lit(""))),
        ["last", "key"],
    )
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("ordinal") % len(weights) + 1).cast("int"))
    capped = ordered.withColumn("weight", weight).withColumn("cap", F.col("source_size").cast("double") * max_copies)
    summed = running_sums(
        capped.withColumn("full_at", F.col("cap") / F.col("weight")), ["full_at", "ordinal"], ["cap", "weight", "source_size"]
    )
    # The level if exactly the sources before this one are capped; the true one is the first that is below full_at.
    before = F.col("cum_cap") - F.col("cap")
    open_weight = F.col("total_weight") - F.col("cum_weight") + F.col("weight")
    level = (F.col("total_source_size") - before) / open_weight
    stored = materialize(summed.withColumn("level", level))
    settled = stored.where(F.col("level") <= F.col("full_at")).agg(
        F.min(F.struct("full_at", "ordinal", "level"))["level"].alias("level")
    ).first()["level"]
    target = F.least(F.col("cap"), F.lit(settled) * F.col("weight")) if settled is not None else F.col("cap")
    return stored.select("source", "source_size", target.cast("double").alias("target"))


def fill_gaps(listed: DataFrame, gaps: DataFrame, span: int = SPAN) -> tuple[DataFrame, DataFrame]:
    """Go on down the order behind the first document that did not fit: what is taken, and (source, gap) left over.

    ``listed`` has source, none and key (its sort key), rank, doc_id, text_hash, words and cum_words, the running sum
    along the order; ``gaps`` has source, gap and after, the cum_words of the document that did not fit. From there
    documents of at most half the gap are taken in order while they fit. The first that does not halves the limit
    again: it is passed over for good, and only documents of at most half of what is then missing go on. So the
    rounds, which all sources share, grow with the logarithm of the gap. A round sorts a window of the order only; a
    window that ends the search of no source is followed by a longer one, until no document of the allowed size is
    left. Larger documents are left to the filler: at most one of them can still fit.
    """
    order = ["rank", "doc_id", "text_hash"]
    narrow = listed.select("source", *order, "words", F.col("cum_words").alias("at"))
    state, size = store(gaps.select(
        "source", "gap", F.col("after").cast("double").alias("after"), (F.col("gap") / 2).alias("limit"),
        F.greatest(F.col("gap") * span, F.lit(1.0)).alias("span")), ["source"])
    known = ["gap", "after", "limit", "span"]
    taken = narrow.select("source", *order).limit(0)
    while True:
        allowed = (F.col("at") > F.col("after")) & (F.col("words") <= F.col("limit"))
        opened, found = store(
            attach(narrow, state, "source", size=size).where(allowed).groupBy("source")
            .agg(F.min("at").alias("start"), *[F.max(c).alias(c) for c in known]), ["source"])
        if not found.rows:
            return taken, state.select("source", "gap")
        inside = (F.col("at") >= F.col("start")) & (F.col("at") <= F.col("start") + F.col("span"))
        window = attach(narrow, opened, "source", size=found).where(inside & (F.col("words") <= F.col("limit")))
        # A window holds a multiple of the gap in words, however long the order of its source is.
        so_far = Window.partitionBy("source").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        summed = materialize(window.withColumn("cum_words", F.sum("words").over(so_far)).select(
            "source", *order, "at", "start", "cum_words", (F.col("cum_words") <= F.col("gap")).alias("fits")))
        taken = taken.union(summed.where("fits").select("source", *order))
        # One row per source on either side; a source without a window stays as it is.
        none = F.lit(None).cast("double")
        steps = summed.groupBy("source").agg(
            F.max(F.when(F.col("fits"), F.col("cum_words"))).cast("double").alias("used"),
            F.min(F.when(~F.col("fits"), F.col("at"))).cast("double").alias("stop"), F.max("start").cast("double").alias("start"))
        both = state.select("source", *known, *[none.alias(c) for c in ("used", "stop", "start")]).union(
            steps.select("source", *[none.alias(c) for c in known], "used", "stop", "start"))
        gap = F.col("gap") - F.coalesce(F.col("used"), F.lit(0))
        moved = both.groupBy("source").agg(*[F.max(c).alias(c) for c in both.columns[1:]]).select(
            "source", gap.alias("gap"), F.coalesce(F.col("stop"), F.floor(F.col("start") + F.col("span")), F.col("after")).cast("double").alias("after"),
            F.when(F.col("stop").isNull(), F.col("limit")).otherwise(gap / 2).alias("limit"),
            F.when(F.col("stop").isNull(), F.col("span") * GROWTH).otherwise(F.col("span")).alias("span"))
        state, size = store(moved, ["source"])


def pareto_sample(
    docs: DataFrame,
    *,
    weight: str | None = None,
    max_copies: int = MAX_COPIES,
    seed: int = SEED,
    source_weights: tuple[float, ...] = WEIGHTS,
) -> DataFrame:
    """How often the mix takes each document: doc_id, source, text_hash, repeats, size, source_size, target, copies.

    A document is expected in the mix as often as its source's target holds its source's size, times its ``weight``
    relative to the source's mean (a column of positive numbers; null or no column: 1), at most ``max_copies`` times.
    The whole part are certain copies. The rest is an inclusion probability p: with a random u per document, those
    with the lowest [u / (1 - u)] / [p / (1 - p)] get one more copy, in this order, for as long as they fit into the
    words still wanted (the sample has a fixed size in words). A document that does not fit is passed over and the
    order goes on with smaller ones (:func:`fill_gaps`). What is then missing is filled by the one document left whose
    size comes nearest to it, if that helps. u is a hash of the row, so reruns agree.

    Null or empty texts have size 0 and are never drawn for an extra copy. Null sources are one source. Rows with the
    same doc_id, source and text are drawn together: one result row, ``repeats`` says how many there are, and size is
    that of one. Other columns are ignored. No rows give no rows.
    """
    share = F.coalesce(F.col(weight).cast("double"), F.lit(1.0)) if weight else F.lit(1.0)
    units = materialize(
        docs.select("doc_id", "source", word_count().alias("size"), share.alias("share"), text_hash().alias("text_hash"))
        .groupBy("doc_id", "source", "text_hash").agg(
            F.count(F.lit(1)).alias("repeats"), F.max("size").alias("size"), F.max("share").alias("share"))
        .withColumn("words", F.col("size") * F.col("repeats"))
    )
    sums = materialize(units.groupBy("source").agg(
        F.sum("words").alias("source_size"), F.sum(F.col("words") * F.col("share")).alias("weighted_size")))
    targets = attach(sums, source_targets(sums.select("source", "source_size"), max_copies, source_weights)
                     .select("source", "target"), "source")
    known = attach(units, targets, "source")

    rate = F.when(F.col("weighted_size") > 0, F.col("target") / F.col("weighted_size")).otherwise(0.0)
    expected = F.least(rate * F.col("share"), F.lit(float(max_copies)))
    certain = F.floor(expected + _EXACT)  # a number of copies within rounding of a whole one is whole
    p = F.greatest(expected - certain, F.lit(0.0))
    u = (F.pmod(F.xxhash64(F.lit(seed), "doc_id", "source", "text_hash"), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    odds = F.when((p > _EXACT) & (F.col("size") > 0), (u / (1 - u)) / (p / (1 - p)))
    ranked = materialize(known.withColumn("copies", certain).withColumn("rank", odds))

    fixed = ranked.groupBy("source").agg(F.sum(F.col("copies") * F.col("words")).alias("fixed_words"))
    listed = attach(ranked.where("rank IS NOT NULL"), fixed, "source")
    listed = listed.withColumn("none", F.col("source").isNull()).withColumn("key", F.coalesce("source", F.lit("")))
    listed = materialize(
        running_sums(listed, ["rank", "doc_id", "text_hash"], ["words"], ["none", "key"])
        .withColumn("missing", F.col("target") - F.col("fixed_words"))
        .withColumn("drawn", F.col("cum_words") <= F.col("missing"))
    )
    # A source whose documents all fit has nothing left to go on with.
    gaps = listed.groupBy("source").agg(
        (F.max("missing") - F.coalesce(F.max(F.when(F.col("drawn"), F.col("cum_words"))), F.lit(0))).alias("gap"),
        F.min(F.when(~F.col("drawn"), F.col("cum_words"))).alias("after"),
    ).where("after IS NOT NULL")
    taken, left = fill_gaps(listed, gaps)
    order = ["rank", "doc_id", "text_hash"]
    listed = attach(listed, taken.withColumn("went_on", F.lit(True)), ["source", *order])
    listed = listed.withColumn("drawn", F.col("drawn") | F.coalesce(F.col("went_on"), F.lit(False))).drop("went_on")
    identity = F.struct(*order)
    fill = F.when(~F.col("drawn") & (F.abs(F.col("gap") - F.col("words")) < F.col("gap")),
                  F.struct(F.abs(F.col("gap") - F.col("words")).alias("off"), identity.alias("unit")))
    fills = attach(listed, left, "source").groupBy("source").agg(F.min(fill)["unit"].alias("filler"))
    extra = F.col("drawn") | F.coalesce(F.col("filler") == identity, F.lit(False))
    result = ["doc_id", "source", "text_hash", "repeats", "size", "source_size", "target"]
    drawn = attach(listed, fills, "source").select(*result, (F.col("copies") + extra.cast("long")).alias("copies"))
    return drawn.unionByName(ranked.where("rank IS NULL").select(*result, "copies"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as :func:`pareto_sample` takes it, with all its columns."""
    copies = pareto_sample(docs, **options).where("copies > 0").select("doc_id", "source", "text_hash", "copies")
    named = copies.select(
        F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("text_hash").alias("__text"),
        F.col("copies").alias("__copies"),
    )
    keyed = docs.select("*", F.col("doc_id").alias("__id"), F.col("source").alias("__source"), text_hash().alias("__text"))
    found = attach(keyed, named, ["__id", "__source", "__text"]).where(F.col("__copies").isNotNull())
    repeated = found.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))))
    return repeated.select(*docs.columns)
