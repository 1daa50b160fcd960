"""Pareto order sampling: targets against the plain procedure, limits, repeatability, awkward rows."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from frames import AWKWARD, clashing, documents

from featurekit.llm import mixing


def plain_targets(sizes: dict) -> dict:
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {n: (1, 2, 3)[i % 3] for i, n in enumerate(names)}
    left, open_names, target = sum(sizes.values()), set(names), {}
    while open_names:
        level = left / sum(weight[n] for n in open_names)
        over = [n for n in open_names if level * weight[n] > 3 * sizes[n]]
        if not over:
            target.update({n: level * weight[n] for n in open_names})
            break
        for n in over:
            target[n] = 3.0 * sizes[n]
            left -= target[n]
            open_names.remove(n)
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 10, "c": 1, None: 5}, {"a": 1000, "b": 1, "c": 1, "d": 1, "e": 0}, {"é": 7, "z": 7, "Z": 7, "": 7}, {"x": 0},
])
def test_targets(spark, sizes):
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(rows).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def corpus(spark):
    rng = random.Random(5)
    rows = []
    for i in range(1500):
        source = "hot" if i % 3 == 0 else f"s{i % 7}"
        rows.append((i, " ".join(["w"] * rng.randint(1, 60)), "en", source))
    return documents(spark, rows)


def test_mix_comes_near_its_targets_and_repeats(spark):
    docs = corpus(spark)
    rows = mixing.pareto_sample(docs).collect()
    sums, target = defaultdict(int), {}
    for r in rows:
        assert 0 <= r.copies <= 3
        sums[r.source] += r.copies * r["size"]
        target[r.source] = r.target
    assert len(rows) == 1500
    for s, t in target.items():
        assert abs(sums[s] - t) <= max(30, 0.01 * t)
    again = mixing.pareto_sample(docs.repartition(13)).collect()
    assert {(r.doc_id, r.copies) for r in rows} == {(r.doc_id, r.copies) for r in again}


@pytest.mark.parametrize("seed", range(4))
def test_a_long_document_does_not_keep_a_source_from_its_target(spark, seed):
    # The source "b" may hold three times its size at most, which leaves 9000 words to "a".
    rows = [(i, " ".join(["w"] * 100), "en", "a") for i in range(100)] + [(100, " ".join(["w"] * 20_000), "en", "a")]
    rows += [(200 + i, " ".join(["w"] * 60), "en", "b") for i in range(3)]
    taken = mixing.pareto_sample(documents(spark, rows), seed=seed, source_weights=(3.0, 7.0)).where("source = 'a'").collect()
    assert len(taken) == 101
    assert abs(sum(r.copies * r["size"] for r in taken) - taken[0].target) <= 100


def plain_fill(words: list[int], missing: float) -> tuple[set[int], float]:
    """One source, document by document: positions taken behind the first that does not fit, and what is then missing."""
    gap, at = missing, 0
    while at < len(words) and words[at] <= gap:
        gap -= words[at]
        at += 1
    limit, taken = gap / 2, set()
    for i in range(at + 1, len(words)):
        if words[i] > limit:
            continue
        if words[i] <= gap:
            gap -= words[i]
            taken.add(i)
        else:
            limit = gap / 2
    return taken, gap


@pytest.mark.parametrize("span", [1, 64])
def test_gaps_are_filled_as_a_plain_walk_fills_them(spark, span):
    from itertools import accumulate

    rng = random.Random(11)
    rows, gaps, wanted, left = [], [], set(), {}
    for source in ("a", "b", "c", None):
        words = [rng.choice((1, 3, rng.randint(1, 50), rng.randint(1, 3000))) for _ in range(300)]
        sums, missing = list(accumulate(words)), rng.uniform(500, 9000)
        drawn = [c for c in sums if c <= missing]
        taken, rest = plain_fill(words, missing)
        wanted |= {(source, i) for i in taken}
        left[source] = pytest.approx(rest)
        rows += [(source, source is None, source or "", float(i), i, 0, w, c) for i, (w, c) in enumerate(zip(words, sums))]
        gaps.append((source, missing - max(drawn, default=0), sums[len(drawn)]))
    listed = spark.createDataFrame(
        rows, "source string, none boolean, key string, rank double, doc_id long, text_hash long, words long, cum_words long")
    got, rest = mixing.fill_gaps(listed, spark.createDataFrame(gaps, "source string, gap double, after long"), span)
    assert {(r.source, r.doc_id) for r in got.collect()} == wanted
    assert {r.source: r.gap for r in rest.collect()} == left


def test_a_round_takes_few_jobs(spark):
    """Every job leaves its plans with the driver, whose memory bounds how many rounds a pipeline can take."""
    words = [1000] + [50, 30, 10, 5, 3, 2, 1] * 10
    rows = [("a", False, "a", float(i), i, 0, w, sum(words[: i + 1])) for i, w in enumerate(words)]
    listed = spark.createDataFrame(
        rows, "source string, none boolean, key string, rank double, doc_id long, text_hash long, words long, cum_words long").localCheckpoint()
    spark.sparkContext.setJobGroup("rounds", "rounds")
    got, _ = mixing.fill_gaps(listed, spark.createDataFrame([("a", 99.0, 1000)], "source string, gap double, after long"))
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("rounds")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {r.doc_id for r in got.collect()} == plain_fill(words, 99.0)[0]
    assert len(jobs) <= 20


def test_weights_shift_the_sample(spark):
    from pyspark.sql import functions as F

    docs = corpus(spark).where("source = 's1' OR source = 's2'").withColumn("pref", F.when(F.col("doc_id") % 2 == 0, 5.0).otherwise(0.5))
    rows = mixing.pareto_sample(docs, weight="pref").collect()
    taken = Counter()
    for r in rows:
        taken[r.doc_id % 2] += r.copies
    assert taken[0] > 2 * taken[1]


def test_mix_repeats_whole_rows(spark):
    docs = clashing(documents(spark, AWKWARD))
    drawn = {(r.doc_id, r.text_hash): r for r in mixing.pareto_sample(docs).collect()}
    assert len(drawn) == len(AWKWARD) - 1
    assert [r.repeats for (i, _), r in drawn.items() if i == 1] == [2]
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r.copies * r.repeats for r in drawn.values())
    assert mixing.pareto_sample(docs.limit(0)).count() == 0
    assert mixing.mix(docs.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = mixing.mix(corpus(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
