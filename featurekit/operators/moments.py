"""Moments of many columns in one pass: tasks measure, and what they found is merged per column."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def column_moments(numbers: DataFrame) -> DataFrame:
    """``at, n, nulls, zeros, min, max, mean, std``: one row per column of numbers, named by its place; null and NaN are missing.

    One pass whatever the number of columns, whose plan does not grow with them. No rows give figures of an empty column.
    """
    width, kinds = len(numbers.columns), "at int, n long, nulls long, zeros long, low double, high double, mean double, spread double"

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = _measured(np.empty((0, width)))
        for batch in batches:
            total = _merged(total, _measured(batch.to_numpy(np.float64, na_value=np.nan)))
        yield pd.DataFrame({"at": range(width), **total})

    def merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[int, dict] = {}
        for batch in batches:
            for row in batch.to_dict("records"):
                at = row.pop("at")
                figures = {k: np.array([v]) for k, v in row.items()}
                found[at] = _merged(found[at], figures) if at in found else figures
        names = ["n", "nulls", "zeros", "low", "high", "mean", "spread"]
        yield pd.DataFrame([(at, *[m[k][0] for k in names]) for at, m in found.items()], columns=["at", *names])

    # A table without any task still has a row per column.
    least = numbers.sparkSession.range(width).selectExpr(
        "CAST(id AS INT) AS at", "0L AS n", "0L AS nulls", "0L AS zeros", "double('inf') AS low", "double('-inf') AS high", "0D AS mean", "0D AS spread")
    parts = numbers.mapInPandas(measured, kinds).union(least).repartition("at").mapInPandas(merged, kinds)
    known = F.col("n") - F.col("nulls")
    figure = lambda c, name: F.when(known > 0, F.col(c)).alias(name)
    return parts.select(
        "at", "n", "nulls", "zeros", figure("low", "min"), figure("high", "max"), figure("mean", "mean"),
        F.when(known > 1, F.sqrt(F.col("spread") / F.greatest(known - 1, F.lit(1)))).alias("std"))


def _measured(x: np.ndarray) -> dict[str, np.ndarray]:
    there = ~np.isnan(x)
    known = there.sum(axis=0)
    mean = np.where(there, x, 0.0).sum(axis=0) / np.maximum(known, 1)
    return {"n": np.full(x.shape[1], len(x)), "nulls": len(x) - known, "zeros": (x == 0).sum(axis=0), "low": np.where(there, x, np.inf).min(axis=0, initial=np.inf),
            "high": np.where(there, x, -np.inf).max(axis=0, initial=-np.inf), "mean": mean, "spread": (np.where(there, x - mean, 0.0) ** 2).sum(axis=0)}


def _merged(a: dict[str, np.ndarray], b: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    ka, kb = a["n"] - a["nulls"], b["n"] - b["nulls"]
    both, gap = np.maximum(ka + kb, 1), b["mean"] - a["mean"]
    return {**{k: a[k] + b[k] for k in ("n", "nulls", "zeros")}, "low": np.minimum(a["low"], b["low"]), "high": np.maximum(a["high"], b["high"]),
            "mean": (a["mean"] * ka + b["mean"] * kb) / both, "spread": a["spread"] + b["spread"] + gap * gap * ka * kb / both}
