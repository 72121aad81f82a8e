"""Secret scans: keyword automaton, anchored expressions near its hits, checksums.

An Aho-Corasick automaton over the lower-cased text finds every keyword in one
pass. Only there is the kind's expression tried, anchored at the keyword. Kinds
whose tokens carry a checksum are reported only if it agrees. Runs of hex
digits have no keyword; they are found by their own expression.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxoffice.llm.common import column_of, number_columns, restore_columns

# The kinds in the order in which spans at one start are listed.
KINDS = ("assign", "access", "hex", "github", "npm")
BASE_KINDS = KINDS[:3]
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{%d,}" % MIN_HEX)
# A prefix, 30 random characters and 6 that hold their CRC-32 in base 62; no
# further letter or digit may follow.
GITHUB = re.compile(r"(gh[pousr]_)([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
NPM = re.compile(r"(npm_)([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")

BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

# What the automaton looks for (lower case), and the kind to try there.
KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign",
    "apikey": "assign", "api_key": "assign", "akia": "access",
    "ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github",
    "npm_": "npm",
}
EXPRESSIONS = {"assign": ASSIGN, "access": ACCESS, "github": GITHUB, "npm": NPM}

ASCII_LOWER = {upper: upper + 32 for upper in range(ord("A"), ord("Z") + 1)}


def checksum62(body: str) -> str:
    """CRC-32 of ``body`` in six base-62 digits."""
    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits


def accepted(kind: str, match: re.Match) -> bool:
    """Whether a match of the kind's expression counts."""
    if kind == "assign":
        return len(match[2]) >= MIN_VALUE
    if kind == "access":
        return len(match[0]) >= MIN_ACCESS
    return checksum62(match[2]) == match[3]


@lru_cache(maxsize=1)
def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def find_secrets(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every secret, by start and then kind; code points, end exclusive."""
    if not text:
        return []
    lower = text.lower()
    if len(lower) != len(text):  # some letters have a longer lower case
        lower = text.translate(ASCII_LOWER)
    spans = [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    free_from = dict.fromkeys(EXPRESSIONS, 0)
    for last, (kind, length) in automaton().iter(lower):
        start = last - length + 1
        if start < free_from[kind]:
            continue
        match = EXPRESSIONS[kind].match(text, start)
        if match:
            free_from[kind] = match.end()
            if accepted(kind, match):
                spans.append((kind, start, match.end()))
    spans.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return spans


def redact(text: str | None, mark: str = "[secret]") -> str | None:
    """``text`` with every span (overlapping ones as one) replaced by ``mark``.

    A mark can bring two pieces together; it is repeated until nothing is found.
    """
    while spans := find_secrets(text):
        parts, at = [], 0
        for _, start, end in spans:
            if start >= at:
                parts += [text[at:start], mark]
            at = max(at, end)
        text = "".join(parts) + text[at:]
    return text


@F.pandas_udf(T.StringType())
def _spans_of(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: ",".join(f"{k}:{a}:{b}" for k, a, b in find_secrets(t)))


@F.pandas_udf(T.StringType())
def _redacted(texts: pd.Series) -> pd.Series:
    return texts.map(redact)


def secret_spans(text: Column) -> Column:
    """All spans of a text as ``kind:start:end`` joined by commas.

    Null and empty texts have none (empty string). Nothing depends on other
    rows, so repeated rows, ties and empty tables need no rule.
    """
    return _spans_of(F.coalesce(text, F.lit("")))


def redact_secrets(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """``docs`` with secrets replaced by a mark in ``text``.

    Rows without a secret come back unchanged; null texts stay null. ``length``
    (if the table has it) is set anew, in code points, where the text changed.
    """
    df, names = number_columns(docs)
    old = column_of(names, text)
    has = F.coalesce(old, F.lit("")) != ""
    df = df.withColumn("_xnew", F.when(has, _redacted(F.coalesce(old, F.lit("")))).otherwise(old))
    changed = {text: F.col("_xnew")}
    if length in names:
        changed[length] = F.when(~F.col("_xnew").eqNullSafe(old), F.length("_xnew").cast(
            docs.schema[length].dataType)).otherwise(column_of(names, length))
    return restore_columns(df, names, **changed)


def secret_report(docs: DataFrame) -> DataFrame:
    """One row per document: counts of the base kinds, a digest of their spans, all spans."""
    spans = F.split("spans", ",")
    of = lambda kind: F.filter(spans, lambda s: s.startswith(f"{kind}:"))
    base = F.filter(spans, lambda s: F.substring_index(s, ":", 1).isin(*BASE_KINDS))
    found = docs.select("doc_id", secret_spans(F.col("text")).alias("spans"))
    return found.select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(F.array_join(base, ",").cast("binary"), 256).alias("base_sha256"),
        "spans")
