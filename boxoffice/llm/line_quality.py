"""Quality rules by line labelling.

A linear-chain conditional random field over a text's lines has two labels,
boilerplate and content. Viterbi decoding labels every line of a whole text;
the words in content lines, as a share of all, decide whether it stays. Simple
counts and two rules on them come first.
"""

from __future__ import annotations

from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxoffice.llm.common import cut

# Production parameters. The field is fitted on so many labelled rows of each
# class at most (those with the smallest hashes of their ids), of at most so many lines.
SAMPLE_OF_CLASS, SAMPLE_LINES, SAMPLE_SEED = 1_000, 60, 23
PENALTY, STEPS, RATE = 1e-3, 150, 0.1
CONTENT_SHARE = 0.5
WINDOW, MIN_WORDS, REPEATED_PERCENT = 5, 10, 20
LONG_TEXT = 100_000  # words from which windows are compared as numbers

SYMBOLS = b"#*$%&|<>"
UPPER, DIGITS, SPACE = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\n\x0b\x0c\r"
FEATURES = ("one", "words", "upper", "symbols", "bars", "shouts", "digits", "stutter", "repeats",
            "ended", "length", "seen", "blank")


def count_of(data: bytes, chars: bytes) -> int:
    return len(data) - len(data.translate(None, chars))


def repeated_words(words: list) -> int:
    """Words within windows of five words that occur twice or more in the list."""
    if len(words) <= WINDOW:
        return 0
    if len(words) < LONG_TEXT:
        windows = list(zip(*(words[k:] for k in range(WINDOW))))
        counts: dict = {}
        if len(set(windows)) == len(windows):
            return 0
        for w in windows:
            counts[w] = counts.get(w, 0) + 1
        starts = [i for i, w in enumerate(windows) if counts[w] > 1]
    else:
        number = {}
        ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
        rank = ids
        for k in range(1, WINDOW):  # ranks of windows, a word longer each time
            rank = np.unique(rank[:len(ids) - k] * len(number) + ids[k:], return_inverse=True)[1]
        starts = np.flatnonzero(np.bincount(rank)[rank] > 1).tolist()
    total = end = 0
    for s in starts:
        total += WINDOW if s >= end else s + WINDOW - end
        end = s + WINDOW
    return total


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    text = text or ""
    data = text.encode()
    words = data.split()
    seen, dup = set(), 0
    for line in data.split(b"\n"):
        if line in seen:
            dup += 1
        elif line.translate(None, SPACE):
            seen.add(line)
    return len(words), len(text) - count_of(data, SPACE), count_of(data, SYMBOLS), dup, repeated_words(words)


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """A row of FEATURES for each line, and each line's words."""
    rows, sizes, seen = [], [], set()
    for line in text.encode().split(b"\n"):
        words = line.split()
        n, size = len(words), max(len(line), 1)
        sizes.append(n)
        if not n:
            rows.append((1.0,) + (0.0,) * 11 + (1.0,))
            continue
        rows.append((
            1.0, min(np.log1p(n) / 5, 2.0), count_of(line, UPPER) / size, min(count_of(line, SYMBOLS) / n, 2.0),
            min(line.count(b"|") / n, 1.0), min(line.count(b"!") / n, 2.0), count_of(line, DIGITS) / size,
            sum(map(eq, words, words[1:])) / n, 1 - len(set(words)) / n, float(words[-1][-1:] in (b".", b"!", b"?")),
            min(size / n / 10, 3.0), float(line in seen), 0.0))
        seen.add(line)
    return np.array(rows), np.array(sizes)


class Field:
    """Weights of the field: ``emit`` scores a line as content rather than boilerplate, ``move`` a pair of labels."""

    def __init__(self, emit: np.ndarray, move: np.ndarray) -> None:
        self.emit, self.move = emit, move

    def viterbi(self, scores: list[float]) -> list[int]:
        """The likeliest labels (0 boilerplate, 1 content) for lines with these content scores; ties to content."""
        (a, b), (c, d) = self.move.tolist()
        zero, one, back = 0.0, scores[0], []
        for s in scores[1:]:
            from_zero, from_one = zero + b, one + d
            stay_zero, stay_one = zero + a, one + c
            back.append((int(stay_one >= stay_zero), int(from_one >= from_zero)))
            zero, one = max(stay_zero, stay_one), max(from_zero, from_one) + s
        label = int(one >= zero)
        labels = [label]
        for step in reversed(back):
            label = step[label]
            labels.append(label)
        return labels[::-1]

    def labels(self, text: str) -> tuple[list[int], np.ndarray]:
        features, sizes = line_features(text)
        return self.viterbi((features @ self.emit).tolist()), sizes

    def content_share(self, text: str) -> float:
        """Words in content lines as a share of all; 0 without words."""
        labels, sizes = self.labels(text)
        total = sizes.sum()
        return float(sizes @ np.array(labels)) / total if total else 0.0


def log_likelihood(field: Field, x: np.ndarray, mask: np.ndarray, y: np.ndarray):
    """Mean log likelihood of label sequences, and its gradient, by the forward-backward recursion.

    ``x``: (rows, lines, features); ``mask``: lines that exist (from the first
    on); ``y``: one label for all lines of a row.
    """
    n, length, _ = x.shape
    score = np.stack([np.zeros((n, length)), x @ field.emit], axis=2)
    add = lambda a, axis: np.logaddexp(*np.moveaxis(a, axis, 0))
    forward, backward = np.empty((n, length, 2)), np.zeros((n, length, 2))
    forward[:, 0] = score[:, 0]
    for t in range(1, length):
        step = add(forward[:, t - 1, :, None] + field.move, 1) + score[:, t]
        forward[:, t] = np.where(mask[:, t, None], step, forward[:, t - 1])
    for t in range(length - 2, -1, -1):
        step = add(field.move + (score[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
        backward[:, t] = np.where(mask[:, t + 1, None], step, 0.0)
    total = add(forward[:, -1], 1)
    p = np.exp(forward + backward - total[:, None, None]) * mask[:, :, None]
    pairs = np.exp(forward[:, :-1, :, None] + field.move + (score + backward)[:, 1:, None, :] - total[:, None, None, None])
    pairs *= mask[:, 1:, None, None]
    lines = mask.sum(axis=1)
    gold = (score[:, :, 1] * mask).sum(axis=1) * y + (lines - 1) * field.move[y, y]
    weight = 1 / np.maximum(lines, 1) / n
    emit = np.einsum("nt,ntf,n->f", (y[:, None] - p[:, :, 1]) * mask, x, weight)
    move = -np.einsum("ntab,n->ab", pairs, weight)
    for label in (0, 1):
        move[label, label] += ((lines - 1) * weight)[y == label].sum()
    return ((gold - total) * weight).sum(), emit, move


def fit(rows: list[tuple[np.ndarray, int]]) -> Field:
    """A field fitted by gradient steps with adaptive rates to texts whose lines all have one label.

    Without rows of both classes every line counts as content.
    """
    if len({y for _, y in rows}) < 2:
        return Field(np.array([1.0] + [0.0] * (len(FEATURES) - 1)), np.zeros((2, 2)))
    length = max(len(f) for f, _ in rows)
    x = np.zeros((len(rows), length, len(FEATURES)))
    mask = np.zeros((len(rows), length), dtype=bool)
    y = np.array([label for _, label in rows])
    for i, (f, _) in enumerate(rows):
        x[i, :len(f)], mask[i, :len(f)] = f, True
    theta = np.zeros(len(FEATURES) + 4)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, STEPS + 1):
        _, emit, move = log_likelihood(Field(theta[:-4], theta[-4:].reshape(2, 2)), x, mask, y)
        g = np.concatenate([emit, move.ravel()]) - PENALTY * theta
        first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g
        theta = theta + RATE * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.99 ** t)) + 1e-8)
    return Field(theta[:-4], theta[-4:].reshape(2, 2))


def learn(docs: DataFrame, labels: DataFrame) -> Field:
    """The field fitted on a bounded sample of labelled rows.

    ``docs``: (doc_id, text); ``labels``: (doc_id, quality). A good text's lines
    are taken as content, a bad one's as boilerplate. Rows without a doc_id or a
    label, and texts of more than SAMPLE_LINES lines, are not sampled.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(
        F.min("quality").alias("quality"))
    order = [F.xxhash64(F.lit(SAMPLE_SEED), "doc_id"), F.col("doc_id")]
    chosen = [known.filter(F.col("quality") == c).orderBy(*order).limit(SAMPLE_OF_CLASS) for c in (0, 1)]

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def flat(texts: pd.Series) -> pd.Series:
        return pd.Series([line_features(t)[0].ravel() for t in texts], dtype=object)

    lines = F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1
    rows = (docs.filter(F.col("text").isNotNull() & (lines <= SAMPLE_LINES))
            .join(F.broadcast(cut(chosen[0].union(chosen[1]))), "doc_id")
            .select("doc_id", "quality", flat("text").alias("x")).groupBy("doc_id", "quality").agg(F.min("x").alias("x"))
            .orderBy("doc_id").collect())
    return fit([(np.array(r.x).reshape(-1, len(FEATURES)), r.quality) for r in rows])


RESULT = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [T.StructField("base_failed", T.BooleanType()), T.StructField("content_share", T.DoubleType()),
       T.StructField("kept", T.BooleanType())])


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, content_share and kept of every row of ``docs`` (doc_id, text).

    Null and empty texts have no words and fail the base rules. Repeated rows
    repeat; an empty table stays empty.
    """
    field = learn(docs, labels)
    emit, move = field.emit, field.move

    @F.pandas_udf(RESULT)
    def judged(texts: pd.Series) -> pd.DataFrame:
        own, rows = Field(emit, move), []
        for text in texts:
            counts = base_counts(text)
            failed = counts[0] < MIN_WORDS or 100 * counts[4] > REPEATED_PERCENT * counts[0]
            share = own.content_share(text or "")
            rows.append((*counts, failed, share, not failed and share >= CONTENT_SHARE))
        return pd.DataFrame(rows, columns=RESULT.names)

    return docs.select("doc_id", judged("text").alias("r")).select("doc_id", "r.*")
