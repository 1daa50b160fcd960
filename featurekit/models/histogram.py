"""Gradient boosting on histograms: many boosters at once, leaf-wise growth, and the AUC of every round.

Rows are cut into bins once and stored. A pass over them adds up gradient, hessian and rows per (booster, node, feature,
bin) inside each task; the tasks' sums are dealt out by node and feature, where they are added and searched, and only the
best splits reach the driver. All boosters of a call - folds, or feature sets that are compared - share every pass.
Gradients are whole multiples of 2^-28, so sums are exact and a model does not depend on how rows are dealt out.

Training goes in chunks of rounds. After a chunk the margins of all rows are stored, and the AUC of each of its rounds on
the validation rows tells whether to go on; so neither plans nor passes get longer with the number of rounds.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from featurekit.operators.encoders import value_table
from featurekit.session import materialize, scratch_path

NULL = 65535
UNIT = 1 << 28

# Rounds between two stored margins, and histogram cells that one pass may hold per task.
CHUNK = 16
MAX_CELLS = 4_000_000

# Margins are told apart in steps of 1/1024 between -32 and 32 when an AUC is counted.
_STEP, _REACH = 1024.0, 32.0

# Booster parameters by their usual names, and those that may only say what is done anyway.
_NAMES = {
    "n_estimators": "rounds", "num_boost_round": "rounds", "learning_rate": "learning_rate", "num_leaves": "num_leaves",
    "max_depth": "max_depth", "max_bin": "max_bin", "min_data_in_leaf": "min_data_in_leaf", "min_child_weight": "min_child_weight",
    "min_sum_hessian_in_leaf": "min_child_weight", "lambda_l1": "lambda_l1", "lambda_l2": "lambda_l2",
    "min_gain_to_split": "min_gain_to_split", "bagging_fraction": "bagging_fraction", "bagging_freq": "bagging_freq",
    "subsample_freq": "bagging_freq", "feature_fraction": "feature_fraction", "seed": "seed", "bagging_seed": "seed",
    "early_stopping_round": "patience", "early_stopping_rounds": "patience",
}
_GIVEN = {"boosting_type": "gbdt", "objective": "binary", "metric": "auc", "tree_learner": "serial"}
_SILENT = {"verbosity", "verbose_eval", "nthread"}


@dataclass(frozen=True)
class Settings:
    rounds: int = 100
    learning_rate: float = 0.1
    num_leaves: int = 31
    max_depth: int = -1
    max_bin: int = 255
    min_data_in_leaf: int = 20
    min_child_weight: float = 1e-3
    lambda_l1: float = 0.0
    lambda_l2: float = 0.0
    min_gain_to_split: float = 0.0
    bagging_fraction: float = 1.0
    bagging_freq: int = 0
    feature_fraction: float = 1.0
    seed: int = 0
    patience: int | None = None

    @staticmethod
    def of(params: Mapping[str, object]) -> Settings:
        """From booster parameters; an unknown one, or another task than binary trees by AUC, is an error."""
        for name, value in params.items():
            if name in _GIVEN and value != _GIVEN[name] or name not in _NAMES and name not in _GIVEN and name not in _SILENT:
                raise ValueError(f"no counterpart for {name}={value}")
        return Settings(**{_NAMES[k]: v for k, v in params.items() if k in _NAMES})


@dataclass
class Tree:
    """Nodes in lists; ``feature`` is -1 at a leaf, a row goes left if its bin is at most ``cut`` or missing and ``null_left``."""

    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    null_left: list[bool] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)

    def add(self) -> int:
        for values, empty in ((self.feature, -1), (self.cut, 0), (self.null_left, False), (self.left, -1), (self.right, -1),
                              (self.value, 0.0), (self.gain, 0.0)):
            values.append(empty)
        return len(self.feature) - 1

    def route(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of every row."""
        feature, cut, nulls = np.array(self.feature), np.array(self.cut), np.array(self.null_left)
        left, right = np.array(self.left), np.array(self.right)
        at = np.zeros(len(bins), np.int64)
        rows = np.arange(len(bins)) if feature[0] >= 0 else np.arange(0)
        while len(rows):
            node = at[rows]
            found = bins[rows, feature[node]]
            at[rows] = node = np.where(np.where(found == NULL, nulls[node], found <= cut[node]), left[node], right[node])
            rows = rows[feature[node] >= 0]
        return at

    def margins(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.route(bins)]


@dataclass(frozen=True)
class Model:
    """What one booster reads: its features, the part of the rows it must not train on, and the one it is checked on."""

    name: str
    features: tuple[str, ...]
    left_out: int | None = None
    valid: int | None = None


@dataclass
class Booster:
    """A trained ensemble: the bin edges of its features, the margin it starts from and the trees it kept."""

    name: str
    features: list[str]
    edges: list[list[float]]
    start: float
    trees: list[Tree]

    def bins(self, frame: pd.DataFrame) -> np.ndarray:
        return _binned(frame, self.edges)

    def margins(self, bins: np.ndarray) -> np.ndarray:
        total = np.full(len(bins), self.start)
        for tree in self.trees:
            total += tree.margins(bins)
        return total

    def importance(self) -> list[tuple[str, float, int]]:
        """(feature, total gain, number of splits)."""
        gain, splits = np.zeros(len(self.features)), np.zeros(len(self.features), int)
        for tree in self.trees:
            for f, g in zip(tree.feature, tree.gain):
                if f >= 0:
                    gain[f] += g
                    splits[f] += 1
        return [(f, float(g), int(n)) for f, g, n in zip(self.features, gain, splits)]


def _binned(frame: pd.DataFrame, edges: Sequence[Sequence[float]]) -> np.ndarray:
    """Bin numbers, row by row; a value falls into the first bin whose upper edge it does not exceed."""
    out = np.empty((len(frame), len(edges)), np.uint16)
    for i, upper in enumerate(edges):
        x = frame.iloc[:, i].to_numpy(np.float64, na_value=np.nan)
        out[:, i] = np.where(np.isnan(x), NULL, np.searchsorted(np.asarray(upper, np.float64), x))
    return out


def bin_edges(df: DataFrame, features: Sequence[str], max_bin: int) -> dict[str, list[float]]:
    """Upper bin edges per feature: every value but the largest if there are few, else quantiles. The last bin is open."""
    def known(c: str) -> Column:
        x = F.col(c).cast("double")
        return F.when(~F.isnan(x), x)

    share = [i / max_bin for i in range(1, max_bin)]
    seen = df.agg(
        *[F.approx_count_distinct(known(c), 0.02).alias(f"n{i}") for i, c in enumerate(features)],
        *[F.percentile_approx(known(c), share, 10_000).alias(f"q{i}") for i, c in enumerate(features)],
    ).first()
    edges = {c: sorted(set(seen[f"q{i}"] or [])) for i, c in enumerate(features)}
    few = [c for i, c in enumerate(features) if seen[f"n{i}"] <= max_bin * 1.1]
    values: dict[str, set[float]] = {c: set() for c in few}
    if few:  # at most about max_bin values each
        for row in value_table(df.select(*[known(c).alias(c) for c in few]), few).where(F.col("value").isNotNull()).collect():
            values[row["column"]].add(float(row["value"]))
    edges.update({c: sorted(v)[:-1] for c, v in values.items() if len(v) <= max_bin})
    return edges


def _mixed(salt: np.ndarray, *numbers: int) -> np.ndarray:
    """A 64-bit hash of a row's salt and some numbers, as a share of 1."""
    x = salt.astype(np.uint64)
    for n in numbers:
        x = (x ^ np.uint64(n & 0xFFFFFFFF)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
    return x.astype(np.float64) / float(1 << 64)


@dataclass
class _Node:
    path: int
    depth: int
    g: float
    h: float
    n: int
    split: dict | None = None  # None: not looked for yet; empty: none is allowed
    children: tuple[_Node, _Node] | None = None

    @property
    def gain(self) -> float:
        return self.split["gain"]


class _Grower:
    """One tree in the making. Nodes whose split is known may have children before the tree takes them."""

    def __init__(self, settings: Settings, features: list[int]):
        self.settings, self.features = settings, features
        self.root = _Node(1, 0, 0.0, 0.0, 1 << 62)
        self.done = False

    def wanted(self) -> list[_Node]:
        """Nodes to be looked at next: without them the next leaf to split is unknown, or will be soon."""
        leaves, taken = [self.root], 1
        while taken < self.settings.num_leaves:
            if any(self._open(x) for x in leaves):
                break
            able = [x for x in leaves if x.split]
            if not able:
                break
            best = min(able, key=lambda x: (-x.gain, x.path))
            leaves.remove(best)
            leaves += self._children(best)
            taken += 1
        unknown = [x for x in leaves if self._open(x)]
        if taken == self.settings.num_leaves or not unknown:
            self.done = True
            return []
        able = sorted((x for x in leaves if x.split), key=lambda x: (-x.gain, x.path))
        for node in able[: self.settings.num_leaves - taken]:
            unknown += [x for x in self._children(node) if self._open(x)]
        return unknown

    def _open(self, node: _Node) -> bool:
        if node.split is None and (node.depth == self.settings.max_depth or node.n < 2 * self.settings.min_data_in_leaf):
            node.split = {}
        return node.split is None

    def _children(self, node: _Node) -> tuple[_Node, _Node]:
        if node.children is None:
            s = node.split
            node.children = (
                _Node(2 * node.path, node.depth + 1, s["left_g"], s["left_h"], s["left_n"]),
                _Node(2 * node.path + 1, node.depth + 1, node.g - s["left_g"], node.h - s["left_h"], node.n - s["left_n"]))
        return node.children

    def spread(self) -> tuple[Tree, dict[int, int]]:
        """A tree down to all known nodes, and the path of each of its leaves."""
        tree, paths = Tree(), {}

        def visit(node: _Node) -> int:
            i = tree.add()
            if node.children:
                self._fill(tree, i, node)
                tree.left[i], tree.right[i] = visit(node.children[0]), visit(node.children[1])
            else:
                paths[i] = node.path
            return i

        visit(self.root)
        return tree, paths

    @staticmethod
    def _fill(tree: Tree, i: int, node: _Node) -> None:
        s = node.split
        tree.feature[i], tree.cut[i], tree.null_left[i], tree.gain[i] = s["feature"], s["bin"], s["null_left"], s["gain"]

    def tree(self) -> Tree:
        """The finished tree: of the known splits the best ones, leaf by leaf."""
        leaves, taken = [self.root], set()
        while len(leaves) < self.settings.num_leaves:
            able = [x for x in leaves if x.split]
            if not able:
                break
            best = min(able, key=lambda x: (-x.gain, x.path))
            taken.add(best.path)
            leaves.remove(best)
            leaves += self._children(best)
        tree = Tree()

        def visit(node: _Node) -> int:
            i = tree.add()
            if node.path in taken:
                self._fill(tree, i, node)
                tree.left[i], tree.right[i] = visit(node.children[0]), visit(node.children[1])
            else:
                g = math.copysign(max(abs(node.g) - self.settings.lambda_l1, 0.0), node.g)
                weight = node.h + self.settings.lambda_l2
                tree.value[i] = -g / weight * self.settings.learning_rate if weight > 0 else 0.0
            return i

        visit(self.root)
        return tree


# One stored row holds a block of rows, every column packed, so that a pass handles arrays and not rows.
_STORED = "bins binary, y binary, part binary, salt binary, margins binary"


def _packed(*arrays: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame([[np.ascontiguousarray(a).tobytes() for a in arrays]], columns=["bins", "y", "part", "salt", "margins"])


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[np.ndarray, ...]]:
    for batch in batches:
        for bins, y, part, salt, margins in zip(*[batch[c] for c in ("bins", "y", "part", "salt", "margins")]):
            y = np.frombuffer(y, np.float64)
            yield (np.frombuffer(bins, np.uint16).reshape(len(y), -1), y, np.frombuffer(part, np.int32), np.frombuffer(salt, np.int64),
                   np.frombuffer(margins, np.float64).reshape(len(y), -1))


class _Training:
    """The stored rows of a call, and the passes over them."""

    def __init__(self, df: DataFrame, label: str, part: str | None, key: str | None, models: Sequence[Model], settings: Settings):
        self.spark, self.models, self.settings = df.sparkSession, list(models), settings
        self.features = list(dict.fromkeys(f for m in models for f in m.features))
        self.columns = [[self.features.index(f) for f in m.features] for m in models]
        number = F.coalesce(F.col(part).cast("int"), F.lit(-1)) if part else F.lit(0)
        salt = F.xxhash64(key) if key else F.xxhash64(*self.features)
        rows = materialize(df.where(F.col(label).isNotNull()).select(  # what is behind df is computed once
            F.col(label).cast("double").alias("__y"), number.alias("__part"), salt.alias("__salt"),
            *[F.col(f).cast("double").alias(f) for f in self.features]))
        self.edges = bin_edges(rows, self.features, settings.max_bin)
        self.bin_count = 1 + max(map(len, self.edges.values()), default=0)
        sizes = rows.groupBy("__part").agg(F.count(F.lit(1)).alias("n"), F.sum("__y").alias("pos")).collect()
        self.start = []
        for m in models:
            n = sum(r["n"] for r in sizes if r["__part"] not in (-1, m.left_out, m.valid))
            pos = sum(r["pos"] for r in sizes if r["__part"] not in (-1, m.left_out, m.valid))
            share = min(max(pos / n, 1e-12), 1 - 1e-12) if n else 0.5
            self.start.append(math.log(share / (1 - share)))
        edges, start = [self.edges[f] for f in self.features], np.array(self.start)

        def binned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                if len(b):
                    yield _packed(_binned(b.iloc[:, 3:], edges), b["__y"].to_numpy(np.float64), b["__part"].to_numpy(np.int32),
                                  b["__salt"].to_numpy(np.int64), np.tile(start, (len(b), 1)))

        self.table = self._write(rows.mapInPandas(binned, _STORED))

    def _write(self, df: DataFrame) -> DataFrame:
        self.path = scratch_path(self.spark, "binned")
        df.write.parquet(self.path)
        return self.spark.read.schema(_STORED).parquet(self.path)

    def splits(self, growers: dict[int, _Grower], fresh: list[list[Tree]], number: int) -> None:
        """One pass: look for the best split of every node that the growers want."""
        wanted = {k: g.wanted() for k, g in growers.items()}
        wanted = {k: w for k, w in wanted.items() if w}
        width = self.bin_count + 1
        while wanted:
            now, cells = {}, 0
            for k in list(wanted):
                size = len(growers[k].features) * width
                room = max(1 if not cells else 0, (MAX_CELLS - cells) // size)
                if room:
                    now[k], wanted[k] = wanted[k][:room], wanted[k][room:]
                    cells += size * len(now[k])
                if not wanted[k]:
                    del wanted[k]
            self._split_pass({k: growers[k] for k in now}, now, fresh, number)

    def _split_pass(self, growers: dict[int, _Grower], wanted: dict[int, list[_Node]], fresh: list[list[Tree]], number: int) -> None:
        models, settings, width = self.models, self.settings, self.bin_count + 1
        jobs = []
        for k, nodes in wanted.items():
            tree, paths = growers[k].spread()
            slot = np.full(len(tree.feature), -1)
            for i, path in paths.items():
                slot[i] = next((j for j, x in enumerate(nodes) if x.path == path), -1)
            jobs.append((k, tree, slot, growers[k].features, len(nodes)))

        def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = {k: np.zeros((3, len(features), n * width), np.int64) for k, _, _, features, n in jobs}
            for bins, y, part, salt, margins in _blocks(batches):
                drawn = np.ones(len(y), bool)
                if settings.bagging_freq > 0 and settings.bagging_fraction < 1:
                    drawn = _mixed(salt, settings.seed, number // settings.bagging_freq) < settings.bagging_fraction
                for k, tree, slot, features, n in jobs:
                    m = models[k]
                    rows = np.flatnonzero(drawn & (part >= 0) & (part != (-1 if m.left_out is None else m.left_out)) & (part != (-1 if m.valid is None else m.valid)))
                    at = slot[tree.route(bins[rows])]
                    rows, at = rows[at >= 0], at[at >= 0]
                    own = bins[rows]
                    margin = margins[rows, k]
                    for t in fresh[k]:
                        margin = margin + t.margins(own)
                    p = 1 / (1 + np.exp(-margin))
                    measures = np.rint((p - y[rows]) * UNIT), np.rint(p * (1 - p) * UNIT), None
                    for j, f in enumerate(features):
                        cell = at * width + np.minimum(own[:, f], width - 1)
                        for i, w in enumerate(measures):
                            total[k][i, j] += np.bincount(cell, w, n * width).astype(np.int64)
            for k, _, _, features, n in jobs:
                held = total[k].reshape(3, len(features), n, width).transpose(1, 2, 0, 3)
                f, node = np.nonzero(held[:, :, 2].any(axis=2))
                yield pd.DataFrame({"model": k, "node": node, "feature": np.array(features)[f], "sums": [held[i, j].tobytes() for i, j in zip(f, node)]})

        counted = self.table.mapInPandas(summed, "model int, node int, feature int, sums binary")
        found: dict[tuple[int, int], tuple] = {}
        for r in best_splits(counted, width, settings).collect():  # per task one row for every node that is asked for
            at = r["model"], r["node"]
            found[at] = min(found.get(at, tuple(r)[2:]), tuple(r)[2:])
        for (k, i), (loss, feature, cut, nulls_right, *sums) in found.items():
            node = wanted[k][i]
            g, h, n, left_g, left_h, left_n = sums
            if node.path == 1:
                node.g, node.h, node.n = g / UNIT, h / UNIT, n
            node.split = {} if loss >= -settings.min_gain_to_split else {
                "gain": -loss, "feature": feature, "bin": cut, "null_left": not nulls_right,
                "left_g": left_g / UNIT, "left_h": left_h / UNIT, "left_n": left_n}
        for nodes in wanted.values():  # no row at all
            for node in nodes:
                node.split = {} if node.split is None else node.split

    def auc(self, active: Sequence[int], fresh: list[list[Tree]], done: int) -> list[tuple[int, int, float]]:
        """(model, round, auc) on the validation rows for every round since the margins were stored, from one pass."""
        models = self.models

        def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for bins, y, part, _, margins in _blocks(batches):
                for k in active:
                    rows = np.flatnonzero(part == models[k].valid)
                    if not len(rows):
                        continue
                    own, positive, margin = bins[rows], y[rows] > 0.5, margins[rows, k].copy()
                    for i, tree in enumerate(fresh[k]):
                        margin += tree.margins(own)
                        cell = np.floor((np.clip(margin, -_REACH, _REACH) + _REACH) * _STEP).astype(np.int64)
                        held, at = np.unique(cell, return_inverse=True)
                        yield pd.DataFrame({"model": k, "round": done + i + 1, "cell": held, "pos": np.bincount(at, positive, len(held)).astype(np.int64),
                                            "neg": np.bincount(at, ~positive, len(held)).astype(np.int64)})

        cells = self.table.mapInPandas(
            counted, "model int, round int, cell long, pos long, neg long")
        sums = cells.groupBy("model", "round", "cell").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        # A window holds at most one row per cell, which is 64 * 1024.
        before = Window.partitionBy("model", "round").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        won = F.col("pos") * (F.coalesce(F.sum("neg").over(before), F.lit(0)) + F.col("neg") / 2.0)
        ranked = sums.select("model", "round", "pos", "neg", won.alias("won")).groupBy("model", "round").agg(
            F.sum("won").alias("won"), F.sum("pos").cast("double").alias("pos"), F.sum("neg").alias("neg"))
        found = ranked.select("model", "round", F.try_divide("won", F.col("pos") * F.col("neg")).alias("auc")).collect()
        return [(r["model"], r["round"], r["auc"]) for r in found]

    def settle(self, fresh: list[list[Tree]]) -> None:
        """Store the rows again with the margins that the fresh trees give."""

        def moved(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for bins, y, part, salt, margins in _blocks(batches):
                margins = margins.copy()
                for k, trees in enumerate(fresh):
                    for tree in trees:
                        margins[:, k] += tree.margins(bins)
                yield _packed(bins, y, part, salt, margins)

        old = self.path
        self.table = self._write(self.table.mapInPandas(moved, _STORED))
        self.drop(old)

    def drop(self, path: str | None = None) -> None:
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path or self.path)
        folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def best_splits(counted: DataFrame, width: int, settings: Settings) -> DataFrame:
    """Per task and (model, node): the split of highest gain, then of the first feature and bin, nulls left before right.

    ``counted`` has, per (model, node, feature) and task, the sums of g, h and rows for ``width`` bins as packed 64-bit numbers;
    the last bin is that of missing values. Columns: model, node, loss (the negative gain), feature, bin, null_right, the node's
    sums, and the sums that go left.
    """
    allowed_h = settings.min_child_weight * UNIT

    def score(g: np.ndarray, h: np.ndarray) -> np.ndarray:
        kept, weight = np.maximum(np.abs(g / UNIT) - settings.lambda_l1, 0.0), h / UNIT + settings.lambda_l2
        return np.divide(kept * kept, weight, out=np.zeros(kept.shape), where=weight > 0)

    def searched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple[int, int, int], np.ndarray] = {}
        for b in batches:
            for key, packed in zip(zip(b["model"], b["node"], b["feature"]), b["sums"]):
                cells = np.frombuffer(packed, np.int64).reshape(3, width)
                sums[key] = sums[key] + cells if key in sums else cells
        best: dict[tuple[int, int], tuple] = {}
        for (model, node, feature), cells in sums.items():
            whole = cells.sum(axis=1)
            low, nulls = np.cumsum(cells[:, :-1], axis=1), cells[:, -1:]
            option = (0.0, feature, 0, False, *whole.tolist(), 0, 0, 0)
            for null_right, left in ((False, low + nulls), (True, low)):
                right = whole[:, None] - left
                able = (np.minimum(left[2], right[2]) >= max(1, settings.min_data_in_leaf)) & (np.minimum(left[1], right[1]) >= allowed_h)
                loss = np.where(able, score(whole[0], whole[1]) - score(left[0], left[1]) - score(right[0], right[1]), np.inf)
                cut = int(np.argmin(loss)) if len(loss) else 0
                if len(loss) and able[cut]:
                    option = min(option, (float(loss[cut]), feature, cut, null_right, *whole.tolist(), *left[:, cut].tolist()))
            best[model, node] = min(best.get((model, node), option), option)
        yield pd.DataFrame([(*k, *v) for k, v in best.items()], columns=names)

    kinds = {"model": "int", "node": "int", "loss": "double", "feature": "int", "bin": "int", "null_right": "boolean",
             **{c: "long" for c in ("g", "h", "n", "left_g", "left_h", "left_n")}}
    names = list(kinds)
    return counted.repartition("model", "node", "feature").mapInPandas(searched, ", ".join(f"{c} {t}" for c, t in kinds.items()))


def train(
    df: DataFrame, label: str, models: Sequence[Model], settings: Settings, part: str | None = None, key: str | None = None
) -> tuple[list[Booster], DataFrame]:
    """Train all models together; returns boosters and ``model, round, auc`` of every round on each model's validation rows.

    Rows with a null label take no part. ``part`` numbers the rows' parts from 0 (null: in no part); a model trains on all but
    the one it leaves out and the one it is checked on. ``key`` names a column that tells rows apart for sampling. With
    ``patience`` a model stops after so many rounds without a better AUC and keeps its best round; without, or without
    validation rows, it keeps all rounds.
    """
    data = _Training(df, label, part, key, models, settings)
    kept: list[list[Tree]] = [[] for _ in models]
    history: list[tuple[int, int, float]] = []
    active = list(range(len(models)))
    chunk = min(CHUNK, settings.patience or CHUNK)
    done = 0
    while active and done < settings.rounds:
        size = min(chunk, settings.rounds - done)
        fresh: list[list[Tree]] = [[] for _ in models]
        for number in range(done, done + size):
            growers = {k: _Grower(settings, _drawn(data.columns[k], settings, k, number)) for k in active}
            while not all(g.done for g in growers.values()):
                data.splits({k: g for k, g in growers.items() if not g.done}, fresh, number)
            for k, g in growers.items():
                fresh[k].append(g.tree())
        for k in active:
            kept[k] += fresh[k]
        checked = [k for k in active if models[k].valid is not None]
        if checked:
            history += data.auc(checked, fresh, done)
        done += size
        if settings.patience is not None:
            active = [k for k in active if done - _best(history, k, done) < settings.patience]
        if active and done < settings.rounds:
            data.settle(fresh)
    data.drop()
    boosters = []
    for k, m in enumerate(models):
        rounds = _best(history, k, len(kept[k])) if settings.patience is not None else len(kept[k])
        trees = [_renumbered(t, data.columns[k]) for t in kept[k][:rounds]]
        boosters.append(Booster(m.name, list(m.features), [data.edges[f] for f in m.features], data.start[k], trees))
    table = df.sparkSession.createDataFrame([(models[k].name, r, a) for k, r, a in sorted(history)], "model string, round int, auc double")
    return boosters, table


def _best(history: Sequence[tuple[int, int, float]], k: int, default: int) -> int:
    """The first round of the highest AUC."""
    own = [(-a, r) for i, r, a in history if i == k and a is not None]
    return min(own)[1] if own else default


def _drawn(columns: list[int], settings: Settings, k: int, number: int) -> list[int]:
    if settings.feature_fraction >= 1:
        return columns
    rng = np.random.default_rng([settings.seed, k, number])
    count = max(1, round(settings.feature_fraction * len(columns)))
    return sorted(rng.choice(columns, count, replace=False).tolist())


def _renumbered(tree: Tree, columns: list[int]) -> Tree:
    """Features by their place in the model instead of in the stored rows."""
    place = {f: i for i, f in enumerate(columns)}
    return Tree(**{**asdict(tree), "feature": [place.get(f, -1) for f in tree.feature]})


def fit_folds(
    df: DataFrame, features: Sequence[str], label: str, settings: Settings, k: int, fold: str = "fold", fixed: bool = False, key: str | None = None
) -> tuple[list[Booster], DataFrame]:
    """One booster per left-out fold (0 to k - 1), checked on that fold, or with ``fixed`` on the rows of fold ``k``.

    Returns the boosters, named by their fold, and ``fold, round, auc``.
    """
    models = [Model(str(i), tuple(features), i, k if fixed else i) for i in range(k)]
    boosters, history = train(df, label, models, settings, fold, key)
    return boosters, history.select(F.col("model").cast("int").alias("fold"), "round", "auc")


def score(df: DataFrame, boosters: Sequence[Booster], names: Sequence[str]) -> DataFrame:
    """Add each booster's probability of a positive label, all in one pass over the rows."""
    features = list(dict.fromkeys(f for b in boosters for f in b.features))
    schema = ", ".join(f"p{i} double" for i in range(len(boosters)))
    models = list(boosters)

    @F.pandas_udf(schema)
    def probabilities(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({f"p{i}": 1 / (1 + np.exp(-b.margins(b.bins(frame[[f"f{features.index(f)}" for f in b.features]])))) for i, b in enumerate(models)})

    cells = F.struct(*[F.col(f).cast("double").alias(f"f{i}") for i, f in enumerate(features)])
    scored = df.withColumn("__p", probabilities(cells))
    return scored.select(*df.columns, *[F.col(f"__p.p{i}").alias(n) for i, n in enumerate(names)])


def ensemble_mean(boosters: Sequence[Booster], df: DataFrame, name: str = "score") -> DataFrame:
    """Add the mean probability of all boosters."""
    names = [f"__s{i}" for i in range(len(boosters))]
    total = sum((F.col(n) for n in names), F.lit(0.0))
    return score(df, boosters, names).select(*df.columns, (total / len(boosters)).alias(name))


def out_of_fold(boosters: Sequence[Booster], df: DataFrame, fold: str = "fold", name: str = "score") -> DataFrame:
    """Score every row with the booster that is named like its fold, so did not see it."""
    names = [f"__s{i}" for i in range(len(boosters))]
    own = F.coalesce(*[F.when(F.col(fold).cast("string") == b.name, F.col(n)) for b, n in zip(boosters, names)])
    return score(df, boosters, names).select(*df.columns, own.alias(name))


def importances(spark: SparkSession, boosters: Sequence[Booster]) -> DataFrame:
    """``model, feature, gain, splits``: total gain and number of splits."""
    return spark.createDataFrame([(b.name, *row) for b in boosters for row in b.importance()], "model string, feature string, gain double, splits int")


def compare_features(
    df: DataFrame, sets: Mapping[str, Sequence[str]], label: str, settings: Settings, part: str, valid: int = 0, key: str | None = None
) -> DataFrame:
    """``model, auc``: the hold-out AUC of one booster per set of features; all are trained in the same passes."""
    models = [Model(name, tuple(features), None, valid) for name, features in sets.items()]
    boosters, history = train(df, label, models, settings, part, key)
    last = df.sparkSession.createDataFrame([(b.name, len(b.trees)) for b in boosters], "model string, round int")
    return last.join(F.broadcast(history), ["model", "round"], "left").select("model", "auc")


def save(boosters: Sequence[Booster], spark: SparkSession, path: str) -> None:
    """Store boosters, one JSON line each."""
    lines = [(b.name, json.dumps(asdict(b))) for b in boosters]
    spark.createDataFrame(lines, "name string, booster string").write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> list[Booster]:
    found = {r["name"]: json.loads(r["booster"]) for r in spark.read.parquet(path).collect()}
    return [Booster(**{**b, "trees": [Tree(**t) for t in b["trees"]]}) for _, b in sorted(found.items())]
