"""The registered queries of the corpus operators and the SQL statements that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurekit.llm import (
    conversations, decontaminate, fingerprints, html, kneser_ney, langid, mixing, resample, secret_scan, simhash, token_counts, topk,
    toxicity,
)
from featurekit.llm.common import bucket_of, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(build):
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return register


@query()
def op4_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    drawn = mixing.pareto_sample(table(spark, sf_dir, "documents"))
    per_row = drawn.withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("repeats"))))
    return per_row.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


@query("""
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
      FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.vec_id AS query_id, b.vec_id,
        CAST(coalesce(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""")
def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every vector whose id is divisible by 50, against all vectors."""
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors.where(F.col("vec_id") % 50 == 0), vectors)


# Every shingle of five words (or the whole of a shorter item) of an item, looked up in the shingles of all documents.
_SHINGLES = """
    list_filter(string_split_regex(lower({text}), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w"""


@query(f"""
    WITH items AS (SELECT item_id, {_SHINGLES.format(text='text')} FROM benchmark),
    sized AS (SELECT item_id, w, least(len(w), 5) AS m FROM items WHERE len(w) > 0),
    parts AS (SELECT DISTINCT item_id, m, array_to_string(list_slice(w, i, i + m - 1), ' ') AS s
      FROM (SELECT *, unnest(range(1, CAST(len(w) - m + 2 AS BIGINT))) AS i FROM sized)),
    totals AS (SELECT item_id, count(*) AS n FROM parts GROUP BY item_id),
    texts AS (SELECT doc_id, {_SHINGLES.format(text='text')} FROM documents),
    held AS (SELECT DISTINCT doc_id, m, array_to_string(list_slice(w, i, i + m - 1), ' ') AS s
      FROM (SELECT doc_id, w, m, unnest(range(1, CAST(len(w) - m + 2 AS BIGINT))) AS i
        FROM texts, (SELECT DISTINCT m FROM sized) WHERE len(w) >= m)),
    shared AS (SELECT doc_id, item_id, count(*) AS c FROM held JOIN parts USING (m, s) GROUP BY doc_id, item_id)
    SELECT doc_id, item_id, CAST(c AS INTEGER) AS shared, CAST(n AS INTEGER) AS item_shingles,
      CAST(c AS DOUBLE) / n AS containment
    FROM shared JOIN totals USING (item_id) WHERE c >= 0.8 * n
""")
def op8_contained_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and a benchmark item of which it holds at least 80 % of the five-word shingles."""
    pairs = decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return pairs.select("doc_id", "item_id", "shared", "item_shingles", "containment")


@query()
def op9_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SimHash fingerprint of every document and the near-duplicate group it belongs to."""
    return simhash.near_duplicate_groups(table(spark, sf_dir, "documents"))


@query()
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything in a document that looks like a secret, with the forest's verdict."""
    docs = table(spark, sf_dir, "documents")
    return secret_scan.scan(docs, secret_scan.learn(docs))


@query()
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document."""
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs.select("doc_id", "text"), langid.learn(docs))
    held_out = (bucket_of("doc_id", 5) == 0).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", "score")


@query()
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, with patterns learned from the labelled ones that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.assess(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


@query()
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity and verdict of every document, under a model of the documents labelled good."""
    return kneser_ney.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tokens of every line of every document."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


@query()
def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return html.extract(pages, html.learn(pages))


@query()
def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint of every document and of its edited text, and how alike they are."""
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


@query()
def op11_radius_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every document whose id is divisible by 20: how many fingerprints lie within three bits of its own, and whose."""
    return fingerprints.near_documents(table(spark, sf_dir, "documents"), F.col("doc_id") % 20 == 0)


@query()
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the documents of 20 words and more, drawn towards the words of the benchmark."""
    ranked = resample.importance_ranks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return ranked.select("doc_id", "n_features", "weight", "score", "rank")


@query()
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cheapest repair of every conversation after planted damage."""
    return conversations.repair_damaged(table(spark, sf_dir, "conversations"))
