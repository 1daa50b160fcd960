"""Exact top-k search by inner product with no-random-access aggregation over sorted lists.

Every dimension of a block of candidates is a list sorted by value. A query reads the lists of its positive
components from the top and those of its negative ones from the bottom, all to the same depth. What it has not yet
read of a list is at most the value reached and at least the list's end, which bounds every candidate's score from
both sides. Reading stops when the k-th lower bound is above the upper bound of all but a few candidates; the scores
of those are then resolved. The bounds of all queries of a block are matrix products.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featurekit.session import materialize

TOP = 5
SCALE = 256
QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 8192

# Shares of the lists that are read before the bounds are compared, and how many candidates may then be left.
DEPTHS = (0.125, 0.5)
FEW = 0.05

_EXACT_DOUBLE = float(1 << 53)


def quantized(embedding: str = "embedding", scale: int = SCALE) -> Column:
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def usable(embedding: str = "embedding") -> Column:
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(F.col(embedding).isNotNull() & ~bad, F.lit(False))


def _matrix(rows: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def nra_top(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int):
    """For each query the positions and scores of its ``k`` best rows, ties to the smaller id; its own id is left out."""
    count, largest = len(rows), max(np.abs(rows).max(initial=0), 1) * max(np.abs(queries).max(initial=0), 1)
    exact = float(largest) * max(rows.shape[1], 1) < _EXACT_DOUBLE
    x = rows.astype(np.float64)
    ordered = np.sort(x, axis=0)
    positive, negative = np.maximum(queries, 0).astype(np.float64), np.minimum(queries, 0).astype(np.float64)
    open_queries = np.arange(len(queries))
    for share in DEPTHS:
        depth = int(count * share)
        if not exact or depth < 4 * k or not len(open_queries):
            continue
        high, low = ordered[count - depth], ordered[depth - 1]  # the values reached from the top and from the bottom
        p, n = positive[open_queries], negative[open_queries]
        upper = p @ np.maximum(x, high).T + n @ np.minimum(x, low).T
        lower = p @ np.where(x >= high, x, ordered[0]).T + n @ np.where(x <= low, x, ordered[-1]).T
        own = query_ids[open_queries][:, None] == ids[None, :]
        lower[own] = -np.inf
        bar = np.partition(lower, count - k, axis=1)[:, count - k]
        alive = (upper >= bar[:, None]) & ~own
        done = (alive.sum(axis=1) <= max(k, FEW * count)) & np.isfinite(bar)
        for q, left in zip(open_queries[done], alive[done]):
            yield q, *_best(queries[q], np.flatnonzero(left), rows, ids, k)
        open_queries = open_queries[~done]
    for at in range(0, len(open_queries), 128):  # lists read to their end
        part = open_queries[at : at + 128]
        scores = (queries[part].astype(np.float64) @ x.T).astype(np.int64) if exact else queries[part] @ rows.T
        for q, score in zip(part, scores):
            if count > 4 * k:  # all rows at or above the k-th best besides the query's own row(s)
                other = ids != query_ids[q]
                valid = score[other]
                if len(valid) > k:
                    bar = np.partition(valid, len(valid) - k)[len(valid) - k]
                    left = np.flatnonzero(other & (score >= bar))
                else:
                    left = np.flatnonzero(other)
            else:
                left = np.flatnonzero(ids != query_ids[q])
            best = left[np.lexsort((ids[left], -score[left]))[:k]]
            yield q, best, score[best]


def _best(query, left, rows, ids, k):
    score = rows[left] @ query
    order = np.lexsort((ids[left], -score))[:k]
    return left[order], score[order]


def top_k(queries: DataFrame, candidates: DataFrame, k: int = TOP, scale: int = SCALE) -> DataFrame:
    """The ``k`` highest inner products of every query (vec_id, embedding): query_id, rank, vec_id, score.

    Components become floor(scale * x). Ties go to the smaller vec_id; a candidate with the query's own vec_id is left
    out. Rows with a null vec_id, a null vector or a null, NaN or infinite component take no part. Vectors of unlike
    length are compared as if zeros followed; an empty vector scores zero. Repeated candidates count as the rows they
    are, a query that repeats is answered once. Scores have to fit a long. Queries and candidates are dealt into blocks; every pair of blocks is
    one task, so neither side is ever held whole.
    """
    clean = lambda df: df.where(usable() & F.col("vec_id").isNotNull()).select("vec_id", quantized(scale=scale).alias("v"))
    rows = materialize(clean(candidates))
    asked = materialize(clean(queries).dropDuplicates(["vec_id"]))
    n_rows, n_asked = rows.count(), asked.count()
    row_blocks, query_blocks = max(1, ceil(n_rows / CANDIDATE_BLOCK)), max(1, ceil(n_asked / QUERY_BLOCK))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    block = lambda n, *keys: F.pmod(F.xxhash64(*keys), F.lit(n)).cast("long")
    left = rows.withColumn("row_block", block(row_blocks, "vec_id", "v")).withColumn("query_block", every(query_blocks))
    right = asked.withColumn("query_block", block(query_blocks, "vec_id")).withColumn("row_block", every(row_blocks))

    def search(key: tuple, block: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(block) and len(asks):
            width = max(block["v"].map(len).max(), asks["v"].map(len).max())
            x, ids = _matrix(block["v"], width), block["vec_id"].to_numpy()
            q, query_ids = _matrix(asks["v"], width), asks["vec_id"].to_numpy()
            for at in range(0, len(q), 128):
                for i, best, scores in nra_top(q[at : at + 128], query_ids[at : at + 128], x, ids, k):
                    out += [(query_ids[at + i], ids[b], s) for b, s in zip(best, scores)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    local = (
        left.groupBy("row_block", "query_block").cogroup(right.groupBy("row_block", "query_block"))
        .applyInPandas(search, "query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = local.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
