"""Substring dedup by hashing lines or paragraphs.

Units are normalised and hashed; digests are grouped over all documents. Of
equal units the earliest is kept, ranked by doc_id, then a digest of the text,
then position. The others go, and their places in the original text are kept.

A short line that many texts have by chance is no copied passage, so units are
judged in runs: adjacent units that each occur elsewhere too (units without
words between them don't end a run). Only a run of enough words in all loses
the units of which an earlier occurrence is kept.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxoffice.llm.common import cut, join_classes

# Production parameters: what ends a unit ("\n\n" makes paragraphs), and the words of a run that counts.
SEPARATOR, MIN_RUN_WORDS = "\n", 20


def unit_words(text: str, separator: str = SEPARATOR) -> list[list[bytes]]:
    """The words of each unit, A-Z lower-cased."""
    return [unit.encode().lower().split() for unit in text.split(separator)]


def unit_digests(text: str, separator: str = SEPARATOR) -> list[bytes | None]:
    """Digest of each normalised unit (white space as one space); None if it has no words."""
    return [hashlib.blake2b(b" ".join(words), digest_size=16).digest() if words else None for words in unit_words(text, separator)]


def counting_units(words: list[int], repeated: set[int], min_run_words: int) -> list[int]:
    """Of the units with so many words each, the repeated ones in runs of ``min_run_words`` or more."""
    out, run, total = [], [], 0
    for i, n in enumerate([*words, -1]):
        if i in repeated:
            run.append(i)
            total += n
        elif n:  # neither repeated nor without words
            out += run if total >= min_run_words else []
            run, total = [], 0
    return out


def without_units(text: str, gone: set[int], separator: str = SEPARATOR) -> tuple[str, list[tuple[int, int]]]:
    """``text`` without the units numbered in ``gone`` (each with the separator after it), and the spans removed."""
    kept, spans, at = [], [], 0
    units = text.split(separator)
    for i, unit in enumerate(units):
        piece = unit if i == len(units) - 1 else unit + separator
        if i not in gone:
            kept.append(piece)
        elif spans and spans[-1][1] == at:
            spans[-1] = (spans[-1][0], at + len(piece))
        else:
            spans.append((at, at + len(piece)))
        at += len(piece)
    return "".join(kept), [s for s in spans if s[0] < s[1]]


COUNTS = ("n_bytes", "n_units", "n_removed", "n_spans", "n_repeated_words")
RESULT = T.StructType([T.StructField(n, T.LongType()) for n in COUNTS]
                      + [T.StructField("kept", T.StringType()), T.StructField("spans", T.StringType())])


def dedup_units(docs: DataFrame, separator: str = SEPARATOR, min_run_words: int = MIN_RUN_WORDS) -> DataFrame:
    """doc_id, text, kept and spans (``start:end`` in code points, joined by commas) of every row,
    with n_bytes, n_units, n_removed (bytes), n_spans (maximal removed runs) and n_repeated_words
    (words of all units in runs that count, those that are kept here included).

    A unit is repeated if its digest occurs twice or more in all documents, the
    same document included. A run counts if its repeated units have
    ``min_run_words`` words or more in all; in such runs every unit goes that
    is not the earliest of its digest. So a copy of each unit stays somewhere.

    A null doc_id ranks after all others. A null text counts as empty. Rows
    with equal doc_id and text are ranked in any order: one of them loses what
    others hold, the rest are repeated throughout. An empty table stays empty.
    """
    @F.pandas_udf(T.ArrayType(T.BinaryType()))
    def digests(texts: pd.Series) -> pd.Series:
        return pd.Series([unit_digests(t, separator) for t in texts], dtype=object)

    @F.pandas_udf(RESULT)
    def rebuilt(texts: pd.Series, repeated: pd.Series, later: pd.Series, again: pd.Series) -> pd.DataFrame:
        rows = []
        for text, numbers, after, whole in zip(texts, repeated, later, again):
            units = text.split(separator)
            words = [len(w) for w in unit_words(text, separator)]
            seen = {i for i, n in enumerate(words) if n} if whole else set(np.asarray(numbers).tolist())
            gone = seen if whole else set(np.asarray(after).tolist())
            counting = counting_units(words, seen, min_run_words)
            kept, spans = without_units(text, gone.intersection(counting), separator)
            n = len(text.encode())
            rows.append((n, len(units), n - len(kept.encode()), len(spans), sum(words[i] for i in counting), kept,
                         ",".join(f"{a}:{b}" for a, b in spans)))
        return pd.DataFrame(rows, columns=RESULT.names)

    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    base = base.withColumn("t", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    units = base.select("doc_id", "t", F.posexplode(digests("text")).alias("unit", "digest")).filter(F.col("digest").isNotNull())
    rank = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "t", "unit")
    classes = cut(units.groupBy("digest").agg(F.min(rank).alias("first"), F.count("*").alias("n")).filter("n > 1"))
    marked = join_classes(units, classes, "digest", "n", ["doc_id", "t", "unit"]).withColumn("later", ~rank.eqNullSafe(F.col("first")))
    marked = marked.groupBy(F.col("doc_id").alias("d"), F.col("t").alias("s")).agg(
        F.collect_set("unit").alias("repeated"), F.collect_set(F.when(F.col("later"), F.col("unit"))).alias("later"))
    rows = base.groupBy("doc_id", "t").agg(F.any_value("text").alias("text"), F.count("*").alias("n"))
    none = lambda c: F.coalesce(c, F.array().cast("array<int>")).alias(c)
    rows = rows.join(marked, rows.doc_id.eqNullSafe(marked.d) & (rows.t == marked.s), "left").select(
        "doc_id", "text", none("repeated"), none("later"), F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("copy"))
    return rows.select("doc_id", "text", rebuilt("text", "repeated", "later", F.col("copy") > 1).alias("r")).select("doc_id", "text", "r.*")


def dedup_report(docs: DataFrame) -> DataFrame:
    """``dedup_units`` with a digest in place of the texts."""
    return dedup_units(docs).select(
        "doc_id", *COUNTS, F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"), "spans")


# The same in DuckDB (tables with distinct rows).
DEDUP_SQL = r"""
WITH lists AS (
  SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lined AS (SELECT doc_id, text, len(lines) AS n, unnest(lines) AS line, generate_subscripts(lines, 1) AS no FROM lists),
units AS (
  SELECT doc_id, text, no, line || CASE WHEN no < n THEN chr(10) ELSE '' END AS piece,
         trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[\x20\x09-\x0D]+', ' ', 'g')) AS norm
  FROM lined),
counted AS (
  SELECT *, CASE WHEN norm = '' THEN 0 ELSE len(string_split(norm, ' ')) END AS words,
         norm <> '' AND count(*) OVER (PARTITION BY norm) > 1 AS repeated,
         row_number() OVER (PARTITION BY norm ORDER BY doc_id NULLS LAST, sha256(text), no) > 1 AS later FROM units),
grouped AS (
  SELECT *, sum(CASE WHEN norm <> '' AND NOT repeated THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, text ORDER BY no) AS part FROM counted),
judged AS (
  SELECT *, repeated AND sum(CASE WHEN repeated THEN words ELSE 0 END) OVER (PARTITION BY doc_id, text, part) >= 20 AS counting FROM grouped),
marked AS (
  SELECT *, counting AND later AS gone,
         coalesce(sum(length(piece)) OVER (PARTITION BY doc_id, text ORDER BY no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
  FROM judged),
runs AS (
  SELECT *, sum(CASE WHEN gone THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, text ORDER BY no) AS run FROM marked),
spans AS (
  SELECT doc_id, text, count(*) AS n_spans,
         string_agg(a::BIGINT || ':' || b::BIGINT, ',' ORDER BY a) AS spans
  FROM (SELECT doc_id, text, run, min(pos) AS a, max(pos + length(piece)) AS b FROM runs WHERE gone GROUP BY ALL)
  GROUP BY ALL),
kept AS (
  SELECT doc_id, text, count(*) AS n_units, sum(CASE WHEN counting THEN words ELSE 0 END)::BIGINT AS n_repeated_words,
         coalesce(string_agg(piece, '' ORDER BY no) FILTER (WHERE NOT gone), '') AS kept
  FROM runs GROUP BY ALL)
SELECT k.doc_id, strlen(k.text)::BIGINT AS n_bytes, k.n_units, (strlen(k.text) - strlen(k.kept))::BIGINT AS n_removed,
       coalesce(s.n_spans, 0)::BIGINT AS n_spans, k.n_repeated_words, sha256(k.kept) AS kept_sha256, coalesce(s.spans, '') AS spans
FROM kept k LEFT JOIN spans s ON k.doc_id IS NOT DISTINCT FROM s.doc_id AND k.text = s.text
"""
