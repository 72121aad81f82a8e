import math
import re
from collections import Counter

import numpy as np
import pytest

from boxoffice.llm import lexical_search as ls
from boxoffice.llm.common import pick
from tests.conftest import SF_MID, SF_SMALL
from tests.oracle_compare import compare

ITEMS = "item_id long, text string"


def terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute(docs, items, k=10):
    """Every item against every document, term by term."""
    tfs = [(d, Counter(terms(t))) for d, t in docs]
    lengths = [sum(c.values()) for _, c in tfs]
    n_docs, n_terms = sum(n > 0 for n in lengths), sum(lengths)
    df = Counter(w for _, c in tfs for w in c)
    out = []
    for item, text in sorted(set((i, t or "") for i, t in items), key=lambda x: (x[0] is not None, x)):
        scored = []
        for (d, tf), n in zip(tfs, lengths):
            if not n:
                continue
            m = 100 - 75 + (75 * n * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10 ** 9 * tf[w] // (1000 * tf[w] + 8 * m)) for w in terms(text) if tf[w])
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return Counter(out)


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_query_equals_sql(spark, sf):
    ok, msg = compare(spark, "op12_lexical_search", sf)
    assert ok, msg


DOCS = [(1, "The quick brown fox. The END"), (2, None), (3, ""), (4, "...\n\t "), (5, "fox fox FOX fox2 2fox"), (6, "füchse FÜCHSE füchse"),
        (7, "the the the the"), (None, "quick fox"), (None, "quick fox"), (8, "quick fox"), (8, "quick fox"), (9, "a b a\x7fb a_b a-b"),
        (10, "word " * 20_000 + "rare"), (11, "日本 日本語"), (12, "quick\x00fox \x85 end")]
QUERIES = [(1, "The fox"), (2, "fox fox quick end"), (3, None), (4, ""), (5, "Füchse füchse"), (6, "nowhere"), (7, "word rare b 日本"), (None, "fox"),
           (1, "The fox"), (1, "rare"), (8, "?!"), (9, "a b \x85")]


@pytest.mark.parametrize("block", [1 << 20, 12])
def test_odd_rows(spark, make, clash, block):
    docs = pick(clash(make(DOCS)), "doc_id", "text")
    got = ls.search(docs, spark.createDataFrame(QUERIES, ITEMS), block_bytes=block)
    assert Counter(map(tuple, got.collect())) == brute(DOCS, QUERIES)


def test_many_ties_and_small_pieces(spark, make, monkeypatch):
    """Copies beyond what is held at once, scored for few items at a time."""
    for name, value in (("CELLS", 7), ("REACHED", 5), ("HELD", 16), ("MERGE_PARTS", 3)):
        monkeypatch.setattr(ls, name, value)
    docs = [(i, "same words in every copy" if i % 3 else f"own {i % 7} words") for i in range(300)]
    items = [(i, t) for i, t in enumerate(["same copy", "own 3", "words words own", "every 6 6 same"])]
    got = ls.search(make(docs), spark.createDataFrame(items, ITEMS), k=4)
    assert Counter(map(tuple, got.collect())) == brute(docs, items, 4)


def test_empty_tables(spark, make):
    items = spark.createDataFrame(QUERIES, ITEMS)
    assert ls.search(make([]), items).count() == 0
    assert ls.search(make(DOCS), items.limit(0)).count() == 0
    assert ls.search(make(DOCS[1:4]), items).count() == 0


def test_automaton_finds_whole_terms_only():
    items = ls.Items(["ab", "abc bc", "c"])
    n, hits = ls.scanned("abc,ab-bc c.abcd", items.automaton())
    assert n == 5 and [items.terms[j] for j in hits] == [b"abc", b"ab", b"bc", b"c"]


def test_best_keeps_the_first_of_equal_scores():
    best = ls.Best(1, 2)
    for ids in ([9, 4], [7], [1]):
        best.add(np.zeros(len(ids), np.int64), np.full(len(ids), 5), np.zeros(len(ids), np.int64), np.array(ids))
        best.settle()
    assert best.rows[:, 3].tolist() == [1, 4] and best.floor.tolist() == [5]
