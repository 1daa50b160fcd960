"""Language identification with a byte convolutional network trained and applied in NumPy.

A text is cut into windows of a fixed number of UTF-8 bytes. Filters of several widths slide over a window, each
keeps its maximum, and a softmax layer turns the maxima into language probabilities. A text's language is the one
with the highest sum of log-probabilities over all its windows, weighted by the bytes they hold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurekit.llm.common import bucket_of, sampled, small_batches

UNDETERMINED = "und"
REJECT_BELOW = 0.4


@dataclass(frozen=True)
class Settings:
    """``docs_per_language`` and ``windows_per_doc`` bound the labelled sample that reaches the driver."""

    window: int = 256
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 12
    embedding: int = 8
    docs_per_language: int = 400
    windows_per_doc: int = 4
    epochs: int = 8
    batch: int = 64
    rate: float = 0.01
    seed: int = 7


@dataclass(frozen=True)
class Network:
    """Trained filters, folded with the byte embedding: ``tables[k]`` maps a byte to what it adds at offset k.

    The columns of all widths lie side by side, widest first, so that offset k concerns the first columns only.
    """

    languages: tuple[str, ...]
    tables: tuple[np.ndarray, ...]
    bias: np.ndarray
    weights: np.ndarray
    offsets: np.ndarray
    window: int

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        """One row per window of bytes (uint8)."""
        count, length = windows.shape
        best = np.empty((count, len(self.bias)), np.float32)
        for at in range(0, count, 64):  # keeps the activations in the processor's cache
            part = windows[at : at + 64]
            # Past the end of a window lie zero bytes, which add nothing.
            padded = np.pad(part, ((0, 0), (0, len(self.tables) - 1)))
            response = np.take(self.tables[0], padded[:, :length], axis=0, mode="clip")
            for k, table in enumerate(self.tables[1:], 1):
                response[:, :, : table.shape[1]] += np.take(table, padded[:, k : k + length], axis=0, mode="clip")
            best[at : at + 64] = response.max(axis=1)
        logits = np.maximum(best + self.bias, 0) @ self.weights + self.offsets
        logits -= logits.max(axis=1, keepdims=True)
        return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))

    def classify(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Index of the most likely language and its probability, per text."""
        raw = [np.frombuffer((t or "").encode("utf-8", "replace").lower(), np.uint8) for t in texts]
        sizes = np.array([len(r) for r in raw])
        counts = np.maximum(1, -(-sizes // self.window))
        total = np.zeros((len(texts), len(self.languages)))
        first, group = 0, []
        for i in range(len(raw)):
            # A few megabytes of windows at a time, whatever the length of a text.
            for part in range(0, counts[i], 4096):
                windows = min(4096, counts[i] - part)
                chunk = raw[i][part * self.window : (part + windows) * self.window]
                group.append((i, windows, chunk))
                first += windows
                if first >= 4096:
                    self._add(group, total)
                    first, group = 0, []
        if group:
            self._add(group, total)
        mean = total / np.maximum(sizes, 1)[:, None]
        mean -= mean.max(axis=1, keepdims=True)
        p = np.exp(mean)
        p /= p.sum(axis=1, keepdims=True)
        best = total.argmax(axis=1)
        return best, p[np.arange(len(texts)), best]

    def _add(self, group: list, total: np.ndarray) -> None:
        flat = np.zeros(sum(n for _, n, _ in group) * self.window, np.uint8)
        held = np.zeros(len(flat) // self.window)
        at = 0
        for _, n, chunk in group:
            flat[at * self.window : at * self.window + len(chunk)] = chunk
            held[at : at + n] = np.clip(len(chunk) - np.arange(n) * self.window, 0, self.window)
            at += n
        scores = self.log_probabilities(flat.reshape(-1, self.window)) * held[:, None]
        at = 0
        for i, n, _ in group:
            total[i] += scores[at : at + n].sum(axis=0)
            at += n


def train(windows: list[str], labels: list[str], settings: Settings = Settings()) -> Network | None:
    """Fit the network by Adam on windows of text; half of them are shortened, so that short texts are known too."""
    languages = tuple(sorted(set(labels)))
    if not languages:
        return None
    rng = np.random.default_rng(settings.seed)
    size = settings.window
    x = np.zeros((len(windows), size), np.uint8)
    for i, text in enumerate(windows):
        raw = text.encode("utf-8", "replace").lower()[: size if i % 2 else int(rng.integers(12, size))]
        x[i, : len(raw)] = np.frombuffer(raw, np.uint8)
    y = np.searchsorted(languages, labels)
    widths, f, e = settings.widths, settings.filters, settings.embedding
    p = {"emb": rng.normal(0, 0.3, (256, e)), "v": rng.normal(0, 0.1, (f * len(widths), len(languages))),
         "c": np.zeros(len(languages)), "b": np.zeros(f * len(widths))}
    for w in widths:
        p[f"w{w}"] = rng.normal(0, 1 / np.sqrt(w * e), (w, e, f))
    p = {k: v.astype(np.float32) for k, v in p.items()}
    p["emb"][0] = 0
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    step = 0
    for _ in range(settings.epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(order), settings.batch):
            rows = order[at : at + settings.batch]
            step += 1
            for name, gradient in _gradients(p, x[rows], y[rows], widths, f).items():
                m, v = moments[name]
                m += 0.1 * (gradient - m)
                v += 0.001 * (gradient * gradient - v)
                p[name] -= settings.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            p["emb"][0] = 0
    widest = sorted(range(len(widths)), key=lambda i: -widths[i])
    columns = np.concatenate([np.arange(i * f, (i + 1) * f) for i in widest])
    tables = tuple(
        np.concatenate([p["emb"] @ p[f"w{widths[i]}"][k] for i in widest if widths[i] > k], axis=1).astype(np.float32)
        for k in range(max(widths))
    )
    return Network(languages, tables, p["b"][columns], p["v"][columns], p["c"], size)


def _gradients(p: dict, x: np.ndarray, y: np.ndarray, widths: tuple[int, ...], f: int) -> dict:
    emb = p["emb"][np.pad(x, ((0, 0), (0, max(widths) - 1)))]
    count, length = x.shape
    tops, places = [], []
    for w in widths:
        response = sum(emb[:, k : k + length] @ p[f"w{w}"][k] for k in range(w))
        place = response.argmax(axis=1)
        places.append(place)
        tops.append(np.take_along_axis(response, place[:, None], axis=1)[:, 0])
    before = np.concatenate(tops, axis=1) + p["b"]
    hidden = np.maximum(before, 0)
    logits = hidden @ p["v"] + p["c"]
    q = np.exp(logits - logits.max(axis=1, keepdims=True))
    q /= q.sum(axis=1, keepdims=True)
    q[np.arange(count), y] -= 1
    q /= count
    back = (q @ p["v"].T) * (before > 0)
    out = {"v": hidden.T @ q, "c": q.sum(axis=0), "b": back.sum(axis=0), "emb": np.zeros_like(p["emb"])}
    padded, rows = np.pad(x, ((0, 0), (0, max(widths) - 1))), np.arange(count)[:, None]
    for i, w in enumerate(widths):
        d = back[:, i * f : (i + 1) * f]
        g = np.empty_like(p[f"w{w}"])
        for k in range(w):
            at = places[i] + k
            g[k] = np.einsum("bfe,bf->ef", emb[rows, at], d)
            np.add.at(out["emb"], padded[rows, at], d[:, :, None] * p[f"w{w}"][k].T[None])
        out[f"w{w}"] = g
    return out


def labelled_windows(docs: DataFrame, settings: Settings) -> tuple[list[str], list[str]]:
    """A bounded sample of windows of the labelled rows that are not held out, spread over each document."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (bucket_of("doc_id", 5) != 0))
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return [], []
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, settings.docs_per_language / n))).otherwise(share)
    drawn = F.pmod(F.xxhash64(F.lit(settings.seed), "doc_id", "lang"), F.lit(1 << 30)) < share * float(1 << 30)
    k = settings.windows_per_doc
    room = F.greatest(F.length("text") - settings.window, F.lit(0))
    windows = F.array_distinct(F.array(*[
        F.substring("text", (room * i / max(1, k - 1)).cast("int") + 1, F.lit(settings.window)) for i in range(k)]))
    rows = (
        known.where(drawn).select("lang", F.explode(windows).alias("piece"))
        .where(F.col("piece").rlike(r"\p{L}")).orderBy(F.xxhash64("piece"), "piece", "lang")
        .limit(2 * k * settings.docs_per_language * len(counts)).collect()
    )
    return [r["piece"] for r in rows], [r["lang"] for r in rows]


def identify(docs: DataFrame, network: Network | None) -> DataFrame:
    """Add lang_pred and score to every row of ``docs`` (text).

    Null texts and texts without a letter, and all texts when nothing could be learned, are ``und`` with score 0.
    Columns of these two names are replaced, all others are kept.
    """
    small_batches(docs.sparkSession)

    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            best, score = network.classify(list(texts))
            yield pd.DataFrame({"lang": [network.languages[i] for i in best], "score": score})

    readable = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    base = docs.drop("lang_pred", "score")
    if network is None:
        return base.withColumn("lang_pred", F.lit(UNDETERMINED)).withColumn("score", F.lit(0.0))
    found = base.withColumn("__readable", readable).withColumn("__found", predict(F.col("text").cast("string")))
    return (
        found.withColumn("lang_pred", F.when(F.col("__readable"), F.col("__found.lang")).otherwise(UNDETERMINED))
        .withColumn("score", F.when(F.col("__readable"), F.col("__found.score")).otherwise(0.0))
        .drop("__readable", "__found")
    )


def learn(docs: DataFrame, settings: Settings = Settings()) -> Network | None:
    """Train on the labelled rows of ``docs`` (doc_id, text, lang) whose crc32 bucket of five is not 0."""
    return train(*labelled_windows(docs, settings), settings)


def keep_identified(docs: DataFrame, network: Network | None, reject_below: float = REJECT_BELOW) -> DataFrame:
    """Drop rows whose language cannot be told: ``und``, or a probability under ``reject_below``."""
    found = identify(docs.select(*docs.columns), network)
    kept = found.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= reject_below))
    return kept.select(*docs.columns)
