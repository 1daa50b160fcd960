"""Secret scans: patterns list candidates, a random forest removes the false positives.

Findings with known labels do not come with a corpus, so they are made: secrets of common formats and things that
merely look like them (identifiers, checksums, card and phone numbers, paths, placeholders, long words) are written
into pieces of the corpus's own documents, where the same patterns have to find them. The forest sees length,
character classes and transitions, coverage by dictionary words, paths and the neighbouring words of a candidate.
"""

from __future__ import annotations

import json
import math
import random
import re
import string
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurekit.llm.common import small_batches
from featurekit.llm.forest import Forest, grow, grow_one

DICTIONARY = "/opt/tokenizers/byte_bpe_50k.json"
ACCEPT = 0.5
REDACTED = "[SECRET]"
FINDINGS = 4000
TREES = 40
NEAR = 48

# Names that announce a secret, words that speak against one, and prefixes of issued keys.
ANNOUNCE = ("password", "passwd", "passphrase", "pwd", "secret", "token", "api_key", "api-key", "apikey", "access_key",
            "access-key", "credential", "auth", "private_key", "bearer")
AGAINST = ("example", "sample", "placeholder", "dummy", "test", "fake", "your", "changeme", "commit", "sha", "checksum",
           "digest", "uuid", "guid", "md5", "hash", "integrity", "revision", "isbn", "phone", "card", "order", "version",
           "redacted", "xxxx")
PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "github_pat_", "glpat-", "xoxb-", "xoxp-", "sk_live_", "sk-", "AIza", "eyJ", "ya29.")

_NAME = "|".join(re.escape(a) for a in ANNOUNCE)
# The quantifiers of white space give nothing back, so that a long blank run is read once.
_ASSIGNED = re.compile(
    rf"(?i)(?:{_NAME})[\w\-]{{0,64}}[\"']?(?:\s*+(?:=>|:=|=|:)\s*+|\s++)(?:(?:bearer|basic|token)\s++)?"
    r"(?:\"(?P<double>[^\s\"]{4,})\"|'(?P<single>[^\s']{4,})'|[\"']?(?P<bare>[^\s\"',;<>()][^\s,;<>()]{3,}))")
_TOKEN = re.compile(r"(?<![\w+/=.\-@])[A-Za-z0-9_+/=.\-]{16,}")
_LOGIN = re.compile(r"://[^\s/:@]*:([^\s/@]{3,})@")
_BLOCK = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----.*?-----END [A-Z ]*PRIVATE KEY-----", re.DOTALL)
_UUID = re.compile(r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}")
_HEX = re.compile(r"[0-9a-fA-F]+")
_PATH = re.compile(r"https?://|www\.|\w/\w|\\\w|\.(?:py|js|json|ya?ml|txt|md|html?|png|jpe?g|css|lock|env|cfg|ini)\b")
_LETTERS = re.compile(r"[A-Za-z]+")
_WORDS = re.compile(r"[^\W\d_]{3,}")


def candidates(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of everything that may be a secret, in order and without overlap; the whole text is read."""
    if not text:
        return []
    found = []
    low = text.lower()
    if any(a in low for a in ANNOUNCE):
        for m in _ASSIGNED.finditer(text):
            start, end = m.span(m.lastgroup)
            while end > start and text[end - 1] in "\"'":
                end -= 1
            found.append((start, end, "assigned"))
    if "://" in text:
        found += [(*m.span(1), "login") for m in _LOGIN.finditer(text)]
    if "-----BEGIN" in text:
        found += [(*m.span(), "key block") for m in _BLOCK.finditer(text)]
    # An assigned value or a key block is cut out more exactly than the run of characters it lies in.
    tokens = [(*m.span(), "token") for m in _TOKEN.finditer(text)]
    if found:
        found.sort(key=lambda x: (x[0], -x[1]))
        firsts = [s for s, _, _ in found]
        tokens = [t for t in tokens if not any(
            e > t[0] for _, e, _ in found[max(0, bisect_left(firsts, t[1]) - 2) : bisect_left(firsts, t[1])])]
    out, end = [], -1
    for s, e, kind in sorted(found + tokens, key=lambda x: (x[0], -x[1])):
        while e > s and text[e - 1] in ".,":
            e -= 1
        if s >= end and e - s >= (3 if kind == "login" else 4):
            out.append((s, e, kind))
            end = e
    return out


@dataclass(frozen=True)
class Scanner:
    """What scoring needs; ``dictionary`` holds lower-case words of four letters or more."""

    dictionary: frozenset[str]
    transitions: np.ndarray
    forest: Forest | None = None

    @cached_property
    def _longest(self) -> int:
        return max(map(len, self.dictionary), default=0)

    def coverage(self, text: str) -> float:
        """The share of characters inside dictionary words, longest match first."""
        covered = 0
        for run in _LETTERS.findall(text.lower()):
            at = 0
            while at + 4 <= len(run):
                step = next((n for n in range(min(self._longest, len(run) - at), 3, -1) if run[at : at + n] in self.dictionary), 0)
                covered += step
                at += step or 1
        return covered / max(1, len(text))

    def features(self, text: str, start: int, end: int, kind: str) -> list[float]:
        value = text[start:end]
        before, after = text[max(0, start - NEAR) : start], text[end : end + NEAR]
        n = len(value)
        codes = np.array([_class(c) for c in value])
        counts = np.bincount(codes, minlength=4) / n
        entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
        symbols = [_symbol(c) for c in value]
        steps = self.transitions[symbols[:-1], symbols[1:]].mean() if len(symbols) > 1 else 0.0
        run = max(len(m.group()) for m in re.finditer(r"(.)\1*", value, re.DOTALL))
        near = (before[-24:] + " " + after[:16]).lower()
        own = value.lower()
        name = re.search(rf"({_NAME})[\w\-]*[\"']?\s*(=>|:=|=|:|\s)\s*[\"']?$", before, re.IGNORECASE)
        return [
            n, entropy, *counts, (np.diff(codes) != 0).mean() if len(codes) > 1 else 0.0, steps, self.coverage(value), run,
            len(set(value)) / n, bool(_HEX.fullmatch(value)), bool(_UUID.fullmatch(value)), value.isdigit(),
            value.startswith(PREFIXES), name is not None, name is not None and not name.group(2).isspace(),
            before[-1:] in "\"'" and before != "", bool(_PATH.search(before[-20:] + value)), "@" in before[-1:] + after[:1],
            sum(w in near for w in AGAINST), sum(w in own for w in AGAINST), sum(a in before.lower() for a in ANNOUNCE),
            value.count("/") + value.count("."), value.count("-"), value.endswith("="), kind == "key block", kind == "login",
        ]

    def score(self, text: str | None) -> list[tuple[int, int, str, float]]:
        spans = candidates(text)
        if not spans or self.forest is None:
            return []
        x = np.array([self.features(text, *s) for s in spans], np.float64)
        return [(*s, float(p)) for s, p in zip(spans, self.forest.predict(x))]

    def redact(self, text: str | None) -> str | None:
        if text is None:
            return None
        for start, end, _, p in reversed(self.score(text)):
            if p >= ACCEPT:
                text = text[:start] + REDACTED + text[end:]
        return text


def _class(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.isupper() else 2 if c.isalpha() else 3


def _symbol(c: str) -> int:
    c = c.lower()
    return ord(c) - 97 if "a" <= c <= "z" else 26 if c.isdigit() else 27


def load_dictionary(path: str = DICTIONARY) -> frozenset[str]:
    """The plain words of four letters or more in the vocabulary file of a public tokenizer."""
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    plain = (w.removeprefix("Ġ").lower() for w in vocabulary)
    return frozenset(w for w in plain if len(w) >= 4 and w.isascii() and w.isalpha())


def transition_table(words: list[str], steps: np.ndarray | None = None) -> np.ndarray:
    """Log-probability of one letter, digit or other character after another, learned from words and counted ``steps``."""
    counts = np.full((28, 28), 0.5) + (0.0 if steps is None else steps)
    for word in words:
        s = [_symbol(c) for c in word]
        np.add.at(counts, (s[:-1], s[1:]), 1.0)
    return np.log(counts / counts.sum(axis=1, keepdims=True))


def _pick(rng: random.Random, alphabet: str, n: int) -> str:
    return "".join(rng.choice(alphabet) for _ in range(n))


def _secret(rng: random.Random, words: list[str]) -> str:
    alnum, hexa, b64 = string.ascii_letters + string.digits, "0123456789abcdef", string.ascii_letters + string.digits + "+/"
    name = rng.choice(ANNOUNCE[:-1]) if rng.random() < 0.8 else rng.choice(words) + "_" + rng.choice(ANNOUNCE[:-1])
    value = rng.choice([
        lambda: _pick(rng, hexa, rng.choice((16, 18, 20, 24, 32, 40, 64))), lambda: _pick(rng, alnum, rng.randint(10, 44)),
        lambda: _pick(rng, alnum + "!#$%&*_-", rng.randint(8, 20)), lambda: _pick(rng, b64, rng.choice((27, 43, 86))) + "=",
        lambda: _pick(rng, string.ascii_letters, rng.randint(10, 32)), lambda: _pick(rng, alnum, rng.randint(5, 9)),
        lambda: _pick(rng, alnum, 4) + rng.choice("@!'") + _pick(rng, alnum, rng.randint(4, 10)),
    ])()
    host = f"{rng.choice(words)}.example.com"
    return rng.choice([
        lambda: rng.choice(("AKIA", "ASIA")) + _pick(rng, string.ascii_uppercase + "234567", 16),
        lambda: rng.choice(("AKIA", "ASIA")) + _pick(rng, string.ascii_uppercase, 16),
        lambda: f"{rng.choice(('https', 'postgres', 'ftp'))}://{rng.choice(words)}:{_pick(rng, alnum, rng.randint(6, 20))}@{host}/{rng.choice(words)}",
        lambda: f"Authorization: Bearer {_pick(rng, string.ascii_letters, rng.randint(20, 40))}", lambda: f"{name} {value}",
        lambda: rng.choice(PREFIXES[2:9]) + _pick(rng, alnum, rng.randint(20, 40)),
        lambda: "AIza" + _pick(rng, alnum + "-_", 35),
        lambda: "eyJ" + ".".join(_pick(rng, alnum + "-_", rng.randint(20, 60)) for _ in range(3)),
        lambda: f"{name}={value}", lambda: f'{name} = "{value}"', lambda: f"{name}: {value}", lambda: f"{name}='{value}'",
        lambda: f"Authorization: Bearer {_pick(rng, alnum + '-_', rng.randint(24, 60))}",
        lambda: "-----BEGIN PRIVATE KEY-----\n" + _pick(rng, b64, 256) + "\n-----END PRIVATE KEY-----",
    ])()


def _lookalike(rng: random.Random, words: list[str]) -> str:
    hexa, digits = "0123456789abcdef", string.digits
    name, word = rng.choice(ANNOUNCE[:-1]), lambda: rng.choice(words)
    uuid = "-".join(_pick(rng, hexa, n) for n in (8, 4, 4, 4, 12))
    return rng.choice([
        lambda: uuid, lambda: f"uuid: {uuid}", lambda: f"commit {_pick(rng, hexa, 40)}", lambda: f"sha256:{_pick(rng, hexa, 64)}",
        lambda: f"md5 {_pick(rng, hexa, 32)}", lambda: f"integrity sha512-{_pick(rng, string.ascii_letters + digits + '+/', 86)}==",
        lambda: _pick(rng, digits, rng.randint(16, 19)), lambda: "-".join(_pick(rng, digits, 4) for _ in range(4)),
        lambda: "978-" + _pick(rng, digits, 10), lambda: f"{word()}.{_pick(rng, digits, 2)}@mail{_pick(rng, digits, 2)}.example.com",
        lambda: f"https://www.{word()}.example.com/{word()}/{_pick(rng, digits, 6)}/{word()}-{word()}.html",
        lambda: f"/usr/{word()}/{word()}{_pick(rng, digits, 2)}/{word()}.py", lambda: f"{word()}-{word()}-{_pick(rng, digits, 4)}-{word()}",
        lambda: f"{word()}_{word()}_v{_pick(rng, digits, 2)}.tar.gz", lambda: f"2024-0{rng.randint(1, 9)}-1{rng.randint(0, 9)}T10:{_pick(rng, digits, 2)}:00.000Z",
        lambda: f"{name}={rng.choice(('changeme', 'your_token_here', 'xxxxxxxxxxxx', '<redacted>', 'example-1234', 'test-password1', '${SECRET_1}'))}",
        lambda: f"AKIA{_pick(rng, string.ascii_uppercase, 9)}EXAMPLE", lambda: f"{name} {word()}", lambda: f"{name}: {word()}{word()}",
        lambda: f"{name}={word()}_{word()}", lambda: f"{word()}{word()}{word()}{rng.randint(1, 9)}", lambda: "1.2.3-beta." + _pick(rng, digits, 8),
        lambda: word() + "".join(word().title() for _ in range(3)), lambda: "_".join(word().upper() for _ in range(3)),
        lambda: "-".join(word() for _ in range(4)), lambda: "".join(word() for _ in range(3)), lambda: f"{name} {word()}: {_pick(rng, digits, 4)}",
        lambda: f"{name}: {rng.choice(('string', 'None', 'true', 'null', 'required', 'str,'))}", lambda: f"the {name} {word()} {word()}, {name}: {word()}",
        lambda: f"http://{word()}.example.com:8080/{word()}@{word()}", lambda: f"https://{word()}:{rng.choice(('password', 'changeme', 'example'))}@host",
    ])()


def labelled_findings(pieces: list[str], words: list[str], count: int, seed: int = 3) -> list[tuple[str, int, int, str, int]]:
    """Made findings (text, start, end, kind, label) that the patterns themselves have picked out of a piece of text."""
    rng = random.Random(seed)
    out: list[tuple[str, int, int, str, int]] = []
    attempts = 0
    while len(out) < count and attempts < 6 * count:
        attempts += 1
        piece, label = rng.choice(pieces), rng.random() < 0.45
        planted = (_secret if label else _lookalike)(rng, words)
        cut = rng.randint(0, len(piece))
        head = piece[:cut].rstrip() + " " if cut else ""
        text = head + planted + " " + piece[cut:].lstrip()
        span = (len(head), len(head) + len(planted))
        out += [(text, s, e, kind, int(label)) for s, e, kind in candidates(text) if s >= span[0] and e <= span[1]]
        if rng.random() < 0.2:  # what else the patterns find in a piece cannot be told and is left out, unless harmless
            out += [(text, s, e, kind, 0) for s, e, kind in candidates(text) if e <= span[0] and text[s:e].isalpha()]
    return out


def letter_steps(texts: DataFrame) -> np.ndarray:
    """How often one symbol follows another inside the words of all texts (column ``text``)."""
    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(28 * 28, np.int64)
        for rows in batches:
            for text in rows["text"]:
                codes = np.frombuffer(" ".join(_WORDS.findall(text.lower())).encode("utf-32-le"), np.uint32)
                symbols = np.where((codes >= 97) & (codes <= 122), codes - 97, 27).astype(np.int64)
                inside = (codes[:-1] != 32) & (codes[1:] != 32)
                total += np.bincount(symbols[:-1][inside] * 28 + symbols[1:][inside], minlength=28 * 28)
        yield pd.DataFrame({"step": np.flatnonzero(total), "n": total[total > 0]})

    found = texts.select("text").where("text IS NOT NULL").mapInPandas(counted, "step int, n long").groupBy("step").agg(F.sum("n").alias("n"))
    steps = np.zeros(28 * 28)
    for r in found.collect():  # at most 784 rows
        steps[r["step"]] = r["n"]
    return steps.reshape(28, 28)


def learn(docs: DataFrame, dictionary_path: str = DICTIONARY, findings: int = FINDINGS, trees: int = TREES) -> Scanner:
    """Fit the forest on findings made in a piece of 400 characters of every document.

    Letter steps are counted over all words of all texts. Few documents get several findings each, so that there are
    ``findings`` at least; many are dealt to the trees, each of which has ``findings`` at least and sees other documents.
    """
    small_batches(docs.sparkSession)
    texts = docs.where(F.col("text").isNotNull())
    dictionary = load_dictionary(dictionary_path)
    plain = sorted(dictionary)
    some = random.Random(1).sample(plain, min(len(plain), 2000))
    learnt = Scanner(dictionary, transition_table(plain, letter_steps(texts)))
    count = texts.count()
    each = -(-findings // max(1, count))
    copies = min(trees, -(-trees * findings // max(1, count * each)))
    shipped = docs.sparkSession.sparkContext.broadcast((learnt, some))

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner, some = shipped.value
        for rows in batches:
            out = []
            for key, piece in zip(rows["key"], rows["piece"]):
                words = some + sorted(set(_WORDS.findall(piece.lower())))
                for at, (t, s, e, kind, label) in enumerate(labelled_findings([piece], words, each, seed=int(key))):
                    x = scanner.features(t, s, e, kind)
                    out += [((int(key) + at + i * trees // copies) % trees, int(key), at, label, x) for i in range(copies)]
            yield pd.DataFrame(out, columns=["tree", "key", "at", "label", "x"])

    def grown(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["key", "at"], kind="stable")
        number = int(rows["tree"].iloc[0])
        parts = grow_one(np.stack(rows["x"].to_list()).astype(np.float64), rows["label"].to_numpy(np.float64), number)
        return pd.DataFrame([(number, *[p.tolist() for p in parts])], columns=["tree", "feature", "threshold", "child", "share"])

    start = F.greatest(F.lit(1), (F.length("text") / 2).cast("int") - 200)
    pieces = texts.select(F.xxhash64("doc_id", "text").alias("key"), F.substring("text", start, F.lit(400)).alias("piece"))
    dealt = pieces.mapInPandas(made, "tree int, key long, at int, label int, x array<double>").repartition(trees, "tree")
    forest = dealt.groupBy("tree").applyInPandas(
        grown, "tree int, feature array<long>, threshold array<double>, child array<long>, share array<double>").collect()
    if not forest:
        labelled = labelled_findings([""], some, findings)
        x = np.array([learnt.features(t, s, e, kind) for t, s, e, kind, _ in labelled], np.float64)
        return Scanner(dictionary, learnt.transitions, grow(x, np.array([label for *_, label in labelled], np.float64)))
    kept = sorted(forest, key=lambda r: r["tree"])
    return Scanner(dictionary, learnt.transitions, Forest(tuple(
        (np.array(r["feature"]), np.array(r["threshold"]), np.array(r["child"]), np.array(r["share"])) for r in kept)))


def scan(docs: DataFrame, scanner: Scanner) -> DataFrame:
    """All candidates of ``docs`` (doc_id, text): doc_id, start, length, kind, candidate, score, is_secret.

    Offsets count characters from 0. Texts and candidates are read whole. Null and empty texts have none, repeated rows repeat theirs, a null doc_id is
    carried along. Other columns are ignored.
    """
    small_batches(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast(scanner)  # as large as the dictionary and the trees

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["doc_id", "start", "length", "kind", "candidate", "score", "is_secret"]
        for rows in batches:
            ids = rows["doc_id"].astype(object).where(rows["doc_id"].notna(), None)
            out = [(i, s, e - s, kind, t[s:e], p, int(p >= ACCEPT)) for i, t in zip(ids, rows["text"])
                   for s, e, kind, p in shipped.value.score(t)]
            frame = pd.DataFrame(out, columns=names)
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(
        find, "doc_id long, start long, length long, kind string, candidate string, score double, is_secret int")


def redact(docs: DataFrame, scanner: Scanner) -> DataFrame:
    """Replace every accepted secret in ``text`` and bring ``n_chars`` up to date, if there is one; no row is dropped."""
    small_batches(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast(scanner)

    @F.pandas_udf("string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([shipped.value.redact(t) for t in texts], dtype=object)

    out = docs.withColumn("text", clean("text"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast(kind)))
    return out.select(*docs.columns)
