"""Toxicity by a noisy channel: restore disguised words, then score the restored text.

A character model (trigrams counted over all documents) says what words look
like. A disguised token is a lattice: digits and signs may stand for letters,
repeated letters for one or two, single letters in a row for words. Viterbi
decoding finds the likeliest text. A logistic model over words and word
beginnings of restored texts, fitted on a bounded sample of labelled rows,
gives the score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxoffice.llm.common import column_of, cut, number_columns, restore_columns

# Production parameters. The classifier is fitted on so many labelled rows of
# each class at most (those with the smallest hashes of their ids).
SAMPLE_OF_CLASS, SAMPLE_SEED = 4_000, 11
THRESHOLD = 0.7
MIN_DOCS, MIN_RATIO, MOST_FEATURES = 5, 6.0, 8_192
PENALTY, STEPS = 0.05, 300
REMEMBERED_WORDS, REMEMBERED_CHARS = 100_000, 40

# Signs and the letters that they may stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
# Costs (negative logarithms): a sign as a letter or as itself, letters left
# out of a run, a gap between single letters closed or kept.
AS_LETTER, AS_SIGN, SHORTENED, CLOSED, KEPT = 1.5, 8.0, 2.0, 0.2, 1.0

# The model's symbols: 0 is everything but letters, then a-z, then the other
# lower-case letters of Latin-1.
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
SYMBOLS = 64
SYMBOL = {c: i + 1 for i, c in enumerate(LETTERS)}
SYMBOL_TABLE = np.array([SYMBOL.get(chr(c), 0) for c in range(0x100)] + [0], dtype=np.int64)

SPACED = re.compile(r"(?<!\S)\S(?:\x20\S){3,}(?!\S)")
DOTTED = re.compile(r"[^\W_](?:[._*~-][^\W_]){3,}")
RUN = re.compile(r"(.)\1\1")
HAS_LETTER = re.compile(r"[^\W\d_]")
HAS_SIGN = re.compile("[" + re.escape("".join(LEET)) + "]")
STRIPPED = ".,;:?!\"'“”«»()[]{}<>#%&*_-/\\="
TRAILING = STRIPPED.replace("(", "")


def symbol_counts(texts: list[str]) -> np.ndarray:
    """Trigram counts of texts, each between two non-letters."""
    joined = ("  " + "  ".join(t.lower() for t in texts) + "  ").encode("utf-32-le")
    codes = SYMBOL_TABLE[np.minimum(np.frombuffer(joined, dtype="<u4"), 0x100)]
    index = (codes[:-2] * SYMBOLS + codes[1:-1]) * SYMBOLS + codes[2:]
    return np.bincount(index, minlength=SYMBOLS ** 3)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SYMBOLS ** 3, dtype=np.int64)
    for batch in batches:
        total += symbol_counts(batch.column(0).to_pylist())
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["trigram", "n"])


def character_model(text: DataFrame) -> np.ndarray:
    """Log probabilities of a symbol after two, from the one text column of a table.

    Counted over all rows; what reaches the driver is a count for each of at
    most 64^3 trigrams.
    """
    counts = np.zeros(SYMBOLS ** 3)
    found = text.mapInArrow(_counted, "trigram long, n long").groupBy("trigram").agg(F.sum("n").alias("n")).collect()
    for trigram, n in found:
        counts[trigram] = n
    three = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    two, one = three.sum(axis=0), three.sum(axis=(0, 1))
    p1 = (one + 0.1) / (one + 0.1).sum()
    p2 = (two + 20 * p1) / (two.sum(axis=1, keepdims=True) + 20)
    p3 = (three + 20 * p2) / (three.sum(axis=2, keepdims=True) + 20)
    return np.log(p3).astype(np.float32)


class Restorer(dict):
    """Tokens to their restored forms (words joined by a space); remembers short ones."""

    def __init__(self, model: np.ndarray) -> None:
        super().__init__()
        self.cost = (-model.astype(np.float64)).tolist()

    @staticmethod
    def choices(char: str, length: int) -> list[tuple[str, float]]:
        """What a run of a character may stand for, with costs; a space is a non-letter."""
        if char in LEET:
            once = [(letter, AS_LETTER) for letter in LEET[char]] + [(" ", AS_SIGN)]
            twice = [(letter * 2, AS_LETTER) for letter in LEET[char]]
            return once + (twice if length > 1 else [])
        if length == 1:
            return [(char, 0.0)]
        return [(char * 2, 0.0 if length == 2 else SHORTENED), (char, SHORTENED)]

    def decode(self, runs: list[tuple[str, int]], gap: float | None = None) -> str:
        """Viterbi over a lattice of runs; with ``gap``, each border may hold a space at that cost."""
        best = {(0, 0): (0.0, None)}  # last two symbols -> cost, (text, what came before)
        get = SYMBOL.get
        for k, (char, length) in enumerate(runs):
            options = self.choices(char, length)
            if gap is not None and k:
                options = [(o, c + CLOSED) for o, c in options] + [(" " + o, c + gap) for o, c in options]
            following: dict[tuple[int, int], tuple] = {}
            for (a, b), (cost, path) in best.items():
                for option, extra in options:
                    total, x, y = cost + extra, a, b
                    for c in option:
                        z = get(c, 0)
                        total += self.cost[x][y][z]
                        x, y = y, z
                    if (x, y) not in following or total < following[x, y][0]:
                        following[x, y] = total, (option, path)
            best = following
        ends = [(cost + self.cost[a][b][0], path) for (a, b), (cost, path) in best.items()]
        path = min(ends, key=lambda end: end[0])[1]
        out = []
        while path:
            out.append(path[0])
            path = path[1]
        return " ".join("".join(reversed(out)).split())

    @staticmethod
    def runs(chars: str) -> list[tuple[str, int]]:
        return [(m[0][0], len(m[0])) for m in re.finditer(r"(.)\1*", chars, re.DOTALL)]

    def __missing__(self, token: str) -> str:
        core = token.lstrip(STRIPPED.replace("(", "").replace("!", "")).rstrip(TRAILING)
        if DOTTED.fullmatch(core):
            word = self.decode([(c, 1) for c in core[::2]], KEPT + 2)
        elif HAS_LETTER.search(core) and (HAS_SIGN.search(core) or RUN.search(core)):
            word = self.decode(self.runs(core))
        else:
            word = core
        if len(token) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED_WORDS:
                self.clear()
            self[token] = word
        return word

    def words(self, text: str | None) -> set[str]:
        """The different words of the restored text."""
        lower = (text or "").lower()
        found = {word for token in set(lower.split()) for word in self[token].split()}
        for run in SPACED.finditer(lower):
            found.update(self.decode([(c, 1) for c in run[0][::2]], KEPT).split())
        return found

    def restore(self, text: str) -> str:
        """The restored text, its words joined by spaces (lower case)."""
        spaced = SPACED.sub(lambda m: self.decode([(c, 1) for c in m[0][::2]], KEPT), text.lower())
        return " ".join(filter(None, (self[t] for t in spaced.split())))


def features_of(word: str) -> tuple[str, ...]:
    """A word and its beginnings; they mark words that differ in their endings."""
    return (word, *(f"{word[:k]}-" for k in range(4, 9) if len(word) > k))


class Features(dict):
    """Words to the numbers of the features that the model knows; remembers short words."""

    def __init__(self, known: dict[str, int]) -> None:
        super().__init__()
        self.known = known

    def __missing__(self, word: str) -> tuple[int, ...]:
        found = tuple(self.known[f] for f in features_of(word) if f in self.known)
        if len(word) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED_WORDS:
                self.clear()
            self[word] = found
        return found

    def of(self, words: set[str]) -> list[int]:
        return sorted({n for found in map(self.__getitem__, words) if found for n in found})


# What a worker keeps between batches: the restorer and feature table of the latest model.
_KEPT: dict[str, tuple] = {}


def _kept(kind: str, value, build):
    """``build()`` once for each ``value`` that a worker is sent."""
    held = _KEPT.get(kind)
    if held is None or held[0] is not value:
        held = _KEPT[kind] = value, build()
    return held[1]


def fit(rows: list[tuple[list[int], int]], size: int, odds: float) -> tuple[np.ndarray, float]:
    """Weights and offset of a logistic model of presence, by gradient steps with momentum.

    ``odds``: the class's logarithmic odds among all labelled rows, for which
    the offset of the balanced fit is corrected.
    """
    weights, bias = np.zeros(size), 0.0
    if not rows:
        return weights, odds
    of = np.repeat(np.arange(len(rows)), [len(r) for r, _ in rows])
    at = np.array([n for r, _ in rows for n in r], dtype=np.int64)
    y = np.array([label for _, label in rows], dtype=float)
    share = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    speed, speed_bias = np.zeros(size), 0.0
    for _ in range(STEPS):
        z = np.bincount(of, weights[at], len(rows)) + bias
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * share
        speed = 0.9 * speed - 4.0 * (np.bincount(at, error[of], size) + PENALTY / len(rows) * weights)
        speed_bias = 0.9 * speed_bias - 0.5 * error.sum()
        weights, bias = weights + speed, bias + speed_bias
    return weights, bias + odds


def learn(docs: DataFrame, labels: DataFrame, model: np.ndarray) -> tuple[dict[str, int], np.ndarray, float]:
    """Features, weights and offset from the labelled rows that may be learned from.

    ``docs``: (doc_id, text); ``labels``: (doc_id, toxic). Rows without a doc_id
    or a label, and those held out, are not used.
    """
    may = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy(
        "doc_id").agg(F.max("toxic").alias("toxic"))
    totals = {r.toxic: r["count"] for r in may.groupBy("toxic").count().collect()}
    chosen = [may.filter(F.col("toxic") == c).orderBy(F.xxhash64(F.lit(SAMPLE_SEED), "doc_id"), "doc_id").limit(SAMPLE_OF_CLASS)
              for c in (0, 1)]
    sample = cut(docs.join(F.broadcast(cut(chosen[0].union(chosen[1]))), "doc_id").select("doc_id", "text", "toxic"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Restorer(model).words
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                seen[label].update({f for w in words(text) for f in features_of(w)})
        found = list(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([seen[1][f] for f in found], pa.int64()),
                                          pa.array([seen[0][f] for f in found], pa.int64())], names=["feature", "bad", "good"])

    n = {c: min(totals.get(c, 0), SAMPLE_OF_CLASS) or 1 for c in (0, 1)}
    ratio = (F.col("bad") + 0.5) / (F.col("good") + 0.5) * (n[0] / n[1])
    strong = sample.mapInArrow(counted, "feature string, bad long, good long").groupBy("feature").agg(
        F.sum("bad").alias("bad"), F.sum("good").alias("good")).filter((F.col("bad") >= MIN_DOCS) & (ratio >= MIN_RATIO))
    top = strong.orderBy((F.col("bad") - F.col("good") * (n[1] / n[0])).desc(), "feature").limit(MOST_FEATURES).collect()
    known = {r.feature: i for i, r in enumerate(sorted(top, key=lambda r: r.feature))}

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def numbered(texts: pd.Series) -> pd.Series:
        words = _kept("restorer", model, lambda: Restorer(model)).words
        of = _kept("features", known, lambda: Features(known)).of
        return pd.Series([of(words(t)) for t in texts], dtype=object)

    rows = sample.select("doc_id", "toxic", numbered("text").alias("f")).dropDuplicates(["doc_id"]).select("f", "toxic").collect()
    odds = math.log((totals.get(1, 0) + 0.5) / (totals.get(0, 0) + 0.5))
    weights, bias = fit([(r.f, r.toxic) for r in rows], max(len(known), 1), odds)
    return known, weights, bias


def held_out(doc_id: Column) -> Column:
    """Whether a row's label must not be learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def scorer(docs: DataFrame, labels: DataFrame):
    """A function from a text column to its score, fitted on these tables."""
    model = character_model(docs.select(F.coalesce("text", F.lit("")).alias("text")))
    known, weights, bias = learn(docs, labels, model)

    @F.pandas_udf(T.DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        words = _kept("restorer", model, lambda: Restorer(model)).words
        of = _kept("features", known, lambda: Features(known)).of
        return pd.Series([1 / (1 + math.exp(-min(max(float(weights[of(words(t))].sum()) + bias, -30), 30))) for t in texts])

    return score


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs`` (doc_id, text).

    Null and empty texts get the score of a text without any known feature, as
    does every text if there is nothing to learn from. Repeated rows repeat; an
    empty table stays empty.
    """
    score = scorer(docs, labels)
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score("text").alias("score")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int"))


def reject_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows predicted to be toxic."""
    df, names = number_columns(docs)
    score = scorer(df.select(column_of(names, "doc_id").alias("doc_id"), column_of(names, "text").alias("text")), labels)
    return restore_columns(df.filter(score(column_of(names, "text")) < THRESHOLD), names)
