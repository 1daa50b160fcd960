"""Language identification: held-out accuracy and the awkward rows."""

from __future__ import annotations

from frames import AWKWARD, clashing, documents
from pyspark.sql import functions as F

from featurekit.llm import langid
from featurekit.llm.common import bucket_of, table
from featurekit.llm.queries import QUERIES


def test_held_out_accuracy(spark, sf_dir):
    rows = QUERIES["op10_language_id"](spark, sf_dir).join(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    held = rows.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")).alias("hit"), F.count("*").alias("n")).first()
    assert held["n"] > 100 and held["hit"] >= 0.95
    assert rows.where(~F.col("score").between(0, 1)).count() == 0


def test_held_out_rows_follow_crc32(spark):
    import zlib

    ids = spark.range(50).withColumnRenamed("id", "doc_id").withColumn("b", bucket_of("doc_id", 5)).collect()
    assert all(r.b == zlib.crc32(str(r.doc_id).encode()) % 5 for r in ids)


def network():
    texts = ["the cat and the dog were there with that hat", "der hund und die katze sind nicht im haus gewesen"]
    return langid.train([t[i:] for i in range(12) for t in texts], ["en", "de"] * 12, langid.Settings(epochs=30))


def test_awkward_rows(spark):
    docs = clashing(documents(spark, AWKWARD))
    rows = langid.identify(docs, network()).collect()
    assert len(rows) == len(AWKWARD)
    for r in rows:
        readable = r.text is not None and any(c.isalpha() for c in r.text)
        assert (r.lang_pred in ("en", "de") and 0 < r.score <= 1) if readable else (r.lang_pred == "und" and r.score == 0)
    kept = langid.keep_identified(docs, network())
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} <= {1, 4, 6, None}
    assert langid.identify(docs.limit(0), network()).count() == 0


def test_nothing_to_learn_from(spark):
    docs = documents(spark, [(1, "text", None, "s"), (2, None, "en", "s")])
    assert langid.learn(docs) is None
    assert [r.lang_pred for r in langid.identify(docs, None).collect()] == ["und", "und"]


def test_all_windows_of_a_long_text_count():
    net = network()
    text = "the cat and the dog were there with that hat " * 4000 + "der hund und die katze sind nicht im haus gewesen " * 8000
    best, _ = net.classify([text, "the cat and the dog"])
    assert [net.languages[i] for i in best] == ["de", "en"]
