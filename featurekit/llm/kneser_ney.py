"""Quality by perplexity under an interpolated modified Kneser-Ney n-gram model of trusted text.

The n-grams are of characters of any script; the model stays in tables that Spark shards by n-gram, so it may grow with
the corpus. Tasks put texts together in blocks and list the different n-grams of each block with their trusted counts.
The counts are added up in shards and joined, by context and by suffix, to the probability of every n-gram that occurs;
joins bring these back to the blocks, where they are added up per document. A block moves each of its n-grams once
however often it holds it, and blocks lie in buckets, so that texts are not shuffled. Thresholds are quantiles per
language of the perplexity of trusted documents that the model has not seen.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurekit.llm.common import bucket_of, small_batches
from featurekit.operators.lookup import attach
from featurekit.session import materialize, scratch_path

ORDER = 4  # two pairs of characters, see Ranks
LOW_QUANTILE, HIGH_QUANTILE = 0.005, 0.995
ACCURACY = 10_000

# Trusted documents whose crc32 modulo FOLDS is this one set the thresholds, the others the model.
FOLDS, THRESHOLD_FOLD = 5, 0
MIN_HELD_OUT = 50  # with fewer of them in a language an outer quantile would be no more than their extreme

# Before, and once after, every text stands a character that no text may hold; in a text it, and NUL, are unknown ones.
EDGE = "￿"
_UNKNOWN = 0xFFFD

BLOCK = 4_000_000  # characters
_PIECE = 1 << 20
_DENSE = 1 << 25

# One piece of a text: which row it is of, and how many characters, those that its first n-gram needs included.
_PIECES = "pieces array<struct<row:long,doc_id:long,lang:string,trusted:boolean,fitted:boolean,length:int>>"


def pieces(text: str | None) -> Iterator[np.ndarray]:
    """The code points of a lower-cased text with its edges, cut so that every n-gram lies in exactly one piece."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)
    codes = np.where((codes == 0) | (codes == ord(EDGE)), _UNKNOWN, codes).astype(np.uint32)
    edge = np.full(ORDER - 1, ord(EDGE), np.uint32)
    whole = np.concatenate([edge, codes, edge[:1]])
    for at in range(0, len(whole) - ORDER + 1, _PIECE):
        yield whole[at : at + _PIECE + ORDER - 1]


def _ranked(keys: np.ndarray, space: int) -> tuple[np.ndarray, np.ndarray]:
    """The different keys, ascending, and the position of every key among them; keys lie below ``space``."""
    if space > _DENSE:
        return np.unique(keys, return_inverse=True)
    seen = np.zeros(space, bool)
    seen[keys] = True
    found = np.flatnonzero(seen)
    position = np.empty(space, np.int32)
    position[found] = np.arange(len(found), dtype=np.int32)
    return found, position[keys]


class Ranks:
    """The different n-grams of a block of pieces, in order, and the position among them of every n-gram."""

    def __init__(self, codes: np.ndarray, lengths: np.ndarray):
        alphabet, symbols = _ranked(codes.astype(np.int64), 0x110000)
        pairs, pair = _ranked(symbols[:-1].astype(np.int64) * len(alphabet) + symbols[1:], len(alphabet) ** 2)
        keys = pair[:-2].astype(np.int64) * len(pairs) + pair[2:]
        inside = np.ones(len(codes), bool)  # n-grams that start at the end of a piece would reach into the next
        ends = np.cumsum(lengths)
        for k in range(1, ORDER):
            inside[ends - k] = False
        found, self.positions = _ranked(keys[inside[: len(keys)]], len(pairs) ** 2)
        self.counts = lengths - (ORDER - 1)  # n-grams per piece
        first, last = pairs[found // len(pairs)], pairs[found % len(pairs)]
        n = len(alphabet)
        self._points = alphabet[np.stack([first // n, first % n, last // n, last % n], axis=1)].astype("<u4")

    def grams(self) -> list[str]:
        return np.ascontiguousarray(self._points).view(f"<U{ORDER}").ravel().tolist()


def blocks(rows: DataFrame) -> DataFrame:
    """Texts in blocks: block, payload, pieces, grams (the different n-grams) and counts (theirs in fitted rows).

    ``rows`` has doc_id, text, lang, trusted and fitted. The table lies in buckets by block in the shared folder.
    """
    spark = rows.sparkSession
    small_batches(spark)

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get().partitionId() << 33
        row, block, held, about, size = task, task, [], [], 0

        def whole() -> pd.DataFrame:
            lengths = np.array([len(p) for p in held])
            codes = np.concatenate(held)
            ranks = Ranks(codes, lengths)
            grams = ranks.grams()
            fitted = np.repeat(np.array([a["fitted"] for a in about]), ranks.counts)
            counts = np.bincount(ranks.positions[fitted], minlength=len(grams)).astype(np.int32)
            payload = zstandard.compress(codes.tobytes().decode("utf-32-le").encode(), 3)
            return pd.DataFrame({"block": [block], "payload": [payload], "pieces": [about], "grams": [grams], "counts": [counts]})

        for batch in batches:
            ids = batch["doc_id"].astype("Int64")
            for doc_id, text, lang, trusted, fitted in zip(ids, batch["text"], batch["lang"], batch["trusted"], batch["fitted"]):
                for piece in pieces(text):
                    held.append(piece)
                    about.append({"row": row, "doc_id": None if doc_id is pd.NA else int(doc_id), "lang": lang,
                                  "trusted": bool(trusted), "fitted": bool(fitted), "length": len(piece)})
                    size += len(piece)
                    if size >= BLOCK:
                        yield whole()
                        block, held, about, size = block + 1, [], [], 0
                row += 1
        if held:
            yield whole()

    schema = f"block long, payload binary, {_PIECES}, grams array<string>, counts array<int>"
    chosen = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                         F.col("lang").cast("string").alias("lang"), "trusted", "fitted")
    name = f"blocks_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # A task writes a file per bucket it has a block for, so there are never more files than blocks.
    (chosen.mapInPandas(build, schema).write.option("path", scratch_path(spark, name))
     .bucketBy(buckets, "block").format("parquet").saveAsTable(name))
    return spark.table(name)


def gram_counts(stored: DataFrame) -> DataFrame:
    """(gram, n) for every n-gram of all blocks, n being its count in the fitted rows."""
    each = stored.select(F.explode(F.arrays_zip("grams", "counts")).alias("g"))
    return each.groupBy(F.col("g.grams").alias("gram")).agg(F.sum("g.counts").alias("n"))


def continuation_tables(counts: DataFrame) -> list[tuple[int, DataFrame]]:
    """For every order from the highest down: (length, rows (gram, n)), n being counts at the top and below it the
    number of different characters that precede the n-gram."""
    tables = [(ORDER, counts)]
    for length in range(ORDER - 1, 0, -1):
        shorter = tables[-1][1].select(F.expr("substring(gram, 2)").alias("gram"))
        tables.append((length, materialize(shorter.groupBy("gram").agg(F.count(F.lit(1)).alias("n")))))
    return tables


def _discounts(row) -> tuple[float, float, float]:
    """The three discounts of modified Kneser-Ney from the numbers of n-grams seen once to four times."""
    n1, n2, n3, n4 = (row[f"n{i}"] or 0 for i in (1, 2, 3, 4))
    if not (n1 and n2):
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    d1 = 1 - 2 * y * n2 / n1
    d2 = 2 - 3 * y * n3 / n2
    d3 = 3 - 4 * y * n4 / n3 if n3 else d2
    return min(max(d1, 0.0), 1.0), min(max(d2, 0.0), 2.0), min(max(d3, 0.0), 3.0)


def probabilities(grams: DataFrame, counts: DataFrame) -> DataFrame:
    """(gram, p): the probability of the last character after the others for different n-grams (gram), under ``counts``.

    Per order the counts are joined, by context, with the context's total and its numbers of continuations seen once,
    twice and more often; these give the discounted probability and the weight of the next lower order. The lowest
    order is interpolated with the uniform distribution over the model's characters and one for all unknown ones.
    Without counts everything is an unknown character and has probability 1. A context is followed by no more different
    n-grams than there are characters, which bounds the rows per key of every join.
    """
    asked = [grams]
    for _ in range(ORDER - 1):
        asked.append(materialize(asked[-1].select(F.expr("substring(gram, 2)").alias("gram")).distinct()))
    below = None
    for (length, table), wanted in zip(reversed(continuation_tables(counts)), reversed(asked)):
        ones = [F.count_if(F.col("n") == i).alias(f"n{i}") for i in (1, 2, 3, 4)]
        row = table.agg(*ones, F.count(F.lit(1)).alias("size")).first()
        d1, d2, d3 = _discounts(row)
        keyed = table.withColumn("context", F.substring("gram", 1, length - 1))
        rest = (d1 * F.count_if(F.col("n") == 1) + d2 * F.count_if(F.col("n") == 2) + d3 * F.count_if(F.col("n") > 2)) / F.sum("n")
        contexts = keyed.groupBy("context").agg(F.sum("n").alias("total"), rest.alias("rest"))
        discount = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        own = keyed.join(contexts.drop("rest"), "context").select("gram", ((F.col("n") - discount) / F.col("total")).alias("own"))
        found = wanted.join(own, "gram", "left")
        if below is None:  # the one context of single characters is the empty one
            whole = contexts.select("rest").first()
            weight, lower = F.lit(whole["rest"] if whole else 1.0), F.lit(1.0 / (row["size"] + 1))
        else:
            found = found.withColumn("context", F.substring("gram", 1, length - 1)).withColumn("suffix", F.expr("substring(gram, 2)"))
            found = found.join(contexts.drop("total"), "context", "left").join(below, "suffix")
            weight, lower = F.coalesce("rest", F.lit(1.0)), F.col("below")
        level = found.select("gram", (F.coalesce("own", F.lit(0.0)) + weight * lower).alias("p"))
        below = level.select(F.col("gram").alias("suffix"), F.col("p").alias("below"))
    return level


def perplexities(stored: DataFrame) -> DataFrame:
    """One row per row of the blocks: doc_id, lang, trusted, fitted, symbols (characters and the end), perplexity."""
    spark = stored.sparkSession
    small_batches(spark)
    grams = materialize(gram_counts(stored))  # one shuffle gives both the n-grams asked for and the counts of the model
    known = probabilities(grams.select("gram"), grams.where("n > 0"))
    model = materialize(known.select("gram", F.ln("p").cast("float").alias("lp")))
    each = stored.select("block", F.posexplode("grams").alias("pos", "gram")).join(model, "gram")
    listed = each.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("pos", "lp")))["lp"].alias("values"))
    placed = stored.select("block", "payload", "pieces").join(listed, "block")

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for payload, about, values in zip(batch["payload"], batch["pieces"], batch["values"]):
                codes = np.frombuffer(zstandard.decompress(payload).decode().encode("utf-32-le"), np.uint32)
                ranks = Ranks(codes, np.array([a["length"] for a in about]))
                found = np.asarray(values, np.float32)[ranks.positions].astype(np.float64)
                starts = np.cumsum(ranks.counts) - ranks.counts
                frame = pd.DataFrame(list(about)).drop(columns="length")
                frame["doc_id"] = frame["doc_id"].astype("Int64")
                frame["symbols"], frame["total"] = ranks.counts, np.add.reduceat(found, starts)
                yield frame

    kept = "row long, doc_id long, lang string, trusted boolean, fitted boolean"
    parts = placed.select("payload", "pieces", "values").mapInPandas(judge, f"{kept}, symbols long, total double")
    facts = [F.first(c).alias(c) for c in ("doc_id", "lang", "trusted", "fitted")]
    rows = parts.groupBy("row").agg(*facts, F.sum("symbols").alias("symbols"), F.sum("total").alias("total"))
    return rows.select("doc_id", "lang", "trusted", "fitted", "symbols", F.exp(-F.col("total") / F.col("symbols")).alias("perplexity"))


def trusted_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, lang) with ``trusted``: whether any label of the document says quality 1, and ``fitted``:
    whether it is also one of those that the model learns from."""
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct().withColumn("trusted", F.lit(True))
    found = attach(docs.select("doc_id", "text", "lang"), good, "doc_id")
    trusted = F.coalesce("trusted", F.lit(False))
    return found.withColumn("fitted", trusted & (bucket_of("doc_id", FOLDS) != THRESHOLD_FOLD)).withColumn("trusted", trusted)


def classify(docs: DataFrame, labels: DataFrame, low: float = LOW_QUANTILE, high: float = HIGH_QUANTILE) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang, symbols, perplexity, low and high threshold, good.

    A document is good if its perplexity lies between the ``low`` and ``high`` quantile (approximate, to one part in
    10 000 of the ranks) of the trusted documents of its language that the model has not learnt from, or of all trusted
    documents of a language that has fewer than MIN_HELD_OUT of those. Languages without trusted documents, and null, use
    the quantiles over all languages. With no trusted document thresholds are null and everything is good. A label is
    trusted if its quality is 1; null ids match nothing. Null and empty texts consist of their end only and are not
    good; texts of any length are read whole, in pieces. Repeated rows repeat; other columns are ignored.
    """
    stored = blocks(trusted_rows(docs, labels))
    scored = materialize(perplexities(stored))
    trusted = scored.where("trusted AND symbols > 1")
    unseen = F.when(~F.col("fitted"), F.col("perplexity"))
    cut = [F.when(F.count(unseen) >= MIN_HELD_OUT, F.percentile_approx(unseen, q, ACCURACY))
           .otherwise(F.percentile_approx("perplexity", q, ACCURACY)).alias(name) for q, name in ((low, "low"), (high, "high"))]
    general = trusted.agg(*cut).first()
    own = trusted.where("lang IS NOT NULL").groupBy("lang").agg(*cut)
    found = attach(scored, own, "lang")
    bounds = {n: F.coalesce(F.col(n), F.lit(general[n]).cast("double")) for n in ("low", "high")}
    good = F.coalesce(F.col("perplexity").between(bounds["low"], bounds["high"]), F.lit(True)) & (F.col("symbols") > 1)
    return found.select("doc_id", "lang", "symbols", "perplexity", bounds["low"].alias("low"), bounds["high"].alias("high"),
                        good.cast("int").alias("good"))
