"""Ranked lexical search by scanning the documents with an Aho-Corasick automaton.

The terms of all items form one automaton. Each is guarded by a space on either
side, and in a scanned text everything that is no part of a term is a space, so
an output is a whole term of the text. There is no document index: a first scan
counts the documents of each term, a second scores every document for the items
that its outputs map to. A partition keeps each item's best documents only.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from boxoffice.llm.common import cut
from boxoffice.llm.terms import SPACE, WITH_DIGITS, terms_of

# Production parameters: documents of an item, and UTF-8 bytes of item texts in one automaton.
K, BLOCK_BYTES = 10, 1 << 20
# Scores held at once, items reached at once, and found documents held before they are cut to the best.
CELLS, REACHED, HELD = 1 << 20, 1 << 21, 1 << 16
# Parts in which an item's lists are merged first.
MERGE_PARTS = 64

# Rows of the first scan that are no term's.
DOCUMENTS, TERMS = -1, -2

FOUND = "item long, doc_id long, score long"


class Items:
    """Terms of a block of items, and for each term the items that hold it and how often (as CSR)."""

    def __init__(self, texts: list[str | None]):
        rows = [(t, i) for i, text in enumerate(texts) for t in terms_of(text, WITH_DIGITS)]
        self.n = len(texts)
        self.terms = sorted({t for t, _ in rows})
        number = {t: j for j, t in enumerate(self.terms)}
        pairs = np.array([(number[t], i) for t, i in rows], np.int64).reshape(-1, 2)
        pairs, self.times = np.unique(pairs, axis=0, return_counts=True)
        self.items = pairs[:, 1]
        self.starts = np.searchsorted(pairs[:, 0], np.arange(len(self.terms) + 1))

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for j, term in enumerate(self.terms):
            found.add_word(f" {term.decode('latin-1')} ", j)  # a byte is a letter
        if self.terms:
            found.make_automaton()
        return found


def scanned(text: str | None, automaton) -> tuple[int, np.ndarray]:
    """The number of a text's terms, and the item terms that it holds, in order of place with repeats."""
    if not text:
        return 0, np.empty(0, np.int64)
    guarded = b" " + text.encode().translate(WITH_DIGITS) + b" "
    gap = np.frombuffer(guarded, np.uint8) == SPACE
    n = int(np.count_nonzero(gap[:-1] & ~gap[1:]))
    if not n or not len(automaton):
        return n, np.empty(0, np.int64)
    return n, np.fromiter((j for _, j in automaton.iter(guarded.decode("latin-1"))), np.int64)


def _counted(items: Items) -> Callable:
    """Documents of each item term, and at DOCUMENTS and TERMS the totals, of a partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, df, n_docs, n_terms = items.automaton(), np.zeros(len(items.terms), np.int64), 0, 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                n, hits = scanned(text, automaton)
                df[np.unique(hits)] += 1
                n_docs, n_terms = n_docs + (n > 0), n_terms + n
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(seen, [DOCUMENTS, TERMS])), pa.array(np.append(df[seen], [n_docs, n_terms]))],
                                         names=["term", "n"])
    return run


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Best:
    """The ``k`` best documents of each item: highest score, then smallest doc_id (null last)."""

    def __init__(self, n: int, k: int):
        self.k, self.floor = k, np.zeros(n, np.int64)
        self.rows = np.empty((0, 4), np.int64)  # item, score, whether doc_id is null, doc_id
        self.new: list[np.ndarray] = []

    def add(self, item: np.ndarray, score: np.ndarray, null: np.ndarray, doc_id: np.ndarray) -> None:
        self.new.append(np.stack([item, score, null, doc_id], axis=1))
        if sum(map(len, self.new)) >= HELD:
            self.settle()

    def settle(self) -> None:
        rows = np.concatenate([self.rows, *self.new])
        rows = rows[np.lexsort((rows[:, 3], rows[:, 2], -rows[:, 1], rows[:, 0]))]
        first = np.searchsorted(rows[:, 0], rows[:, 0])
        place = np.arange(len(rows)) - first
        last = place == self.k - 1
        self.floor[rows[last, 0]] = rows[last, 1]
        self.rows, self.new = rows[place < self.k], []


def _scored(items: Items, weights: list[int], n_docs: int, n_terms: int, k: int) -> Callable:
    """The ``k`` best documents of a partition for each item."""
    weights = np.array(weights, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, best = items.automaton(), Best(items.n, k)
        step = max(1, CELLS // max(items.n, 1))
        for batch in batches:
            ids = batch.column("doc_id")
            null = ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
            ids = ids.fill_null(0).to_numpy()
            texts = batch.column("text").to_pylist()
            for at in range(0, len(texts), step):
                hold(texts[at:at + step], ids[at:at + step], null[at:at + step], automaton, best)
        best.settle()
        item, score, null, doc_id = best.rows.T
        yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(doc_id, mask=null.astype(bool)), pa.array(score)],
                                         names=["item", "doc_id", "score"])

    def hold(texts: list[str | None], ids: np.ndarray, null: np.ndarray, automaton, best: Best) -> None:
        parts = []
        for d, text in enumerate(texts):
            n, hits = scanned(text, automaton)
            if len(hits):
                term, tf = np.unique(hits, return_counts=True)
                m = 25 + 75 * n * n_docs // n_terms  # of any size: Python's integers
                parts.append((np.full(len(term), d), term, weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))))
        if not parts:
            return
        doc, term, value = (np.concatenate(x) for x in zip(*parts))
        many = items.starts[term + 1] - items.starts[term]
        score = np.zeros(len(texts) * items.n, np.int64)
        # the items of the terms, in pieces of bounded size
        ends = np.cumsum(many)
        cuts = np.searchsorted(ends, np.arange(REACHED, ends[-1] + REACHED, REACHED))
        for a, b in zip(np.append(0, cuts[:-1] + 1), cuts + 1):
            part = many[a:b]
            pair = np.repeat(np.arange(a, min(b, len(term))), part)
            place = items.starts[term[pair]] + np.arange(len(pair)) - np.repeat(np.cumsum(part) - part, part)
            np.add.at(score, doc[pair] * items.n + items.items[place], value[pair] * items.times[place])
        score = score.reshape(len(texts), items.n)
        d, i = np.nonzero((score > 0) & (score >= best.floor))
        best.add(i, score[d, i], null[d], ids[d])

    return run


def search(docs: DataFrame, items: DataFrame, k: int = K, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """For every item its ``k`` documents with the highest score above 0: item_id, rank, doc_id, score.

    ``docs`` has (doc_id, text), ``items`` (item_id, text). A term's weight is
    ``floor(1000 ln((2N+2) / (2df+1)))``; a document's score sums, over the
    item's terms with repeats, weight times ``10^9 tf div (1000 tf + 8 m)``
    with ``m = 25 + 75 n N div L``. Equal scores go by doc_id, null last.

    Every row of ``docs`` is a document of its own, so repeated rows rank one
    after the other. Rows of ``items`` with the same item_id and text count
    once; those that share only the id have a list each. Null and empty texts
    have no terms: as documents they count nowhere, as items they find nothing.
    Empty tables give an empty result. Items beyond ``block_bytes`` are taken
    in blocks, each against all documents; only a block goes to the tasks.
    """
    text = F.coalesce("text", F.lit(""))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = items.select(F.col("item_id").cast("long").alias("item_id"), text.alias("text")).distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // block_bytes) or 1
    if blocks > 1:
        items = cut(items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))))
    else:
        items = items.withColumn("block", F.lit(0))
    return reduce(DataFrame.unionByName, [
        _search_block(docs, items.filter(F.col("block") == b).orderBy("item_id", "text").collect(), k) for b in range(blocks)])


def _search_block(docs: DataFrame, rows: list, k: int) -> DataFrame:
    """``search`` for the items of one block."""
    items = Items([r.text for r in rows])
    counts = dict(docs.select("text").mapInArrow(_counted(items), "term long, n long").groupBy("term").agg(F.sum("n")).collect())
    n_docs, n_terms = counts.get(DOCUMENTS, 0), counts.get(TERMS, 0)
    weights = [weight(n_docs, counts.get(j, 0)) for j in range(len(items.terms))]
    found = docs.mapInArrow(_scored(items, weights, n_docs, n_terms, k), FOUND)
    for part in ([F.pmod(F.xxhash64("doc_id"), F.lit(MERGE_PARTS))], []):
        order = Window.partitionBy("item", *part).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    ids = docs.sparkSession.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)],
                                            T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", T.LongType())]))
    return found.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")


# The same in DuckDB (tables with distinct rows).
SEARCH_SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
tfs AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM words GROUP BY ALL),
lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tfs GROUP BY ALL),
totals AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM lengths),
ms AS (SELECT doc_id, 100 - 75 + ((75 * n * n_docs) // n_terms) AS m FROM lengths, totals),
wanted AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
times AS (SELECT item_id, term, count(*)::BIGINT AS times FROM wanted GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM tfs, totals WHERE term IN (SELECT term FROM times) GROUP BY term, n_docs),
scores AS (
  SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM times JOIN tfs USING (term) JOIN weights USING (term) JOIN ms USING (doc_id) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10
"""
