"""Importance resampling against a plain version of the whole computation."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

from frames import AWKWARD, LONG, clashing, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from featurekit.llm import resample as r
from featurekit.llm.common import table


def plain_words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain_features(text):
    w = plain_words(text)
    return w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def plain_bucket(feature):
    return zlib.crc32(feature.encode()) % 10000


def plain(docs, targets):
    source, wanted = Counter(), Counter()
    features = [[plain_bucket(f) for f in plain_features(t)] for _, t in docs]
    for f in features:
        source.update(f)
    for t in targets:
        wanted.update(map(plain_bucket, plain_features(t)))
    s_all, t_all = sum(source.values()), sum(wanted.values())
    gain = {b: math.floor(1000 * math.log((wanted[b] + 1) * (s_all + 10000) / ((source[b] + 1) * (t_all + 10000)))) for b in range(10000)}
    rows = []
    for (i, t), f in zip(docs, features):
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(f), weight, score, None, len(plain_words(t)) >= 20])
    able = sorted((x for x in rows if x[5]), key=lambda x: (-x[3], x[0] is None, x[0] or 0, -x[2]))
    for rank, row in enumerate(able[: 25 * len(able) // 100], 1):
        row[4] = rank
    return sorted((tuple(x[:5]) for x in rows), key=str)


def ranked(docs, targets):
    df = r.importance_ranks(docs, targets).select("doc_id", "n_features", "weight", "score", "rank")
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["bigint"] * 5
    return sorted((tuple(x) for x in df.collect()), key=str)


@given(st.text(st.sampled_from("aB9 é-_\n\x00\x7fŁ漢\x85\xa0"), max_size=60) | st.text(st.characters(exclude_categories=['Cs']), max_size=80))
@settings(max_examples=200, deadline=None)
def test_spans_equal_joined_words(text):
    words, found = r.ngram_buckets(text.encode())
    assert sorted(found.tolist()) == sorted(plain_bucket(f) for f in plain_features(text)) and words == len(plain_words(text))


def test_longer_ngrams():
    words = b"a bb a bb a ccc".split()
    spans = [b" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    assert sorted(r._checksums(b" " + b" ".join(words) + b" ", r.ngram_pattern(3))) == sorted(map(zlib.crc32, spans))


def test_query_equals_the_plain_version(spark, sf_dir):
    docs, targets = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    rows = [(x.doc_id, x.text) for x in docs.select("doc_id", "text").collect()]
    got = ranked(docs, targets)
    assert got == plain(rows, [x.text for x in targets.collect()])
    assert sum(x[4] is not None for x in got) > 200


def test_awkward_rows(spark):
    rows = [(i, t) for i, t, _, _ in AWKWARD] + [(50 + i, LONG[: 300 + 7 * i]) for i in range(30)] + [(None, LONG[:900]), (50, LONG[:300])]
    docs = clashing(documents(spark, [(i, t, "en", None) for i, t in rows]))
    targets = clashing(spark.createDataFrame([(1, None), (2, ""), (3, "word1 word2 word3")], "item_id long, text string"))
    assert ranked(docs, targets) == plain(rows, [None, "", "word1 word2 word3"])
    assert ranked(docs, targets.limit(0)) == plain(rows, [])
    assert ranked(docs.limit(0), targets) == []


def test_drawn_rows_keep_their_columns(spark):
    rows = [(i, LONG[: 200 + 11 * i], "en", "s") for i in range(40)] + [(99, LONG[:500], "en", "s")] * 7 + [(None, LONG[:450], None, None)]
    docs = clashing(documents(spark, rows))
    targets = spark.createDataFrame([(LONG[:500],)], "text string")
    drawn = Counter(x.doc_id for x in r.importance_ranks(docs, targets, percent=40).collect() if x.rank)
    kept = r.resample(docs, targets, percent=40)
    assert kept.columns == docs.columns
    assert Counter(x.doc_id for x in kept.collect()) == drawn and sum(drawn.values()) == 40 * len(rows) // 100


def test_the_draw_moves_towards_the_target(spark):
    rows = [(i, " ".join(f"{'near' if i % 2 else 'far'}{j % 7}" for j in range(700)), "en", "s") for i in range(400)]
    targets = spark.createDataFrame([(" ".join(f"near{j % 7}" for j in range(90_000)),)], "text string")
    picked = [x.doc_id % 2 for x in r.importance_ranks(documents(spark, rows), targets).collect() if x.rank]
    assert len(picked) == 100 and sum(picked) > 80
