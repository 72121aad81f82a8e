import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from boxoffice.llm import divergence as dg
from boxoffice.llm.common import pick
from tests.conftest import SF_MID, SF_SMALL
from tests.oracle_compare import compare

SCHEMA = "text string, lang string, source string"


def brute(docs, k=200):
    """Every source against every other, term by term, in Python's integers."""
    counts, df = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in docs:
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        counts[lang or "", source or ""].update(words)
        df[lang or ""].update(set(words))
    out = []
    for lang in df:
        kept = [w for w, n in df[lang].items() if n >= 3]
        sources = [s for la, s in counts if la == lang]
        n_of = {s: sum(counts[lang, s][w] for w in kept) for s in sources}
        every = {w: sum(counts[lang, s][w] for s in sources) for w in kept}
        share = lambda c, n: 1 + 10 ** 9 * (c + 1) // (n + len(kept))
        f = lambda p, q: (p - q) ** 2 // q
        for s in sources:
            p = {w: share(counts[lang, s][w], n_of[s]) for w in kept}
            pairs = [(-sum(f(p[w], share(counts[lang, o][w], n_of[o])) for w in kept), o.encode()) for o in sources if o != s]
            q = {w: share(every[w], sum(every.values())) for w in kept}
            words = [(-f(p[w], q[w]), w.encode()) for w in kept if counts[lang, s][w] and p[w] > q[w]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(words)[:k])):
                out += [(lang, s, part, item.decode(), -v, r) for r, (v, item) in enumerate(found, 1)]
    return Counter(out)


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_query_equals_sql(spark, sf):
    ok, msg = compare(spark, "op13_source_divergence", sf)
    assert ok, msg


WORDS = ["the", "of", "Haus", "haus", "élan", "日本", "x1y", "fox", "und", "le"]


def _docs(seed, n, sources):
    rng = np.random.default_rng(seed)
    return [(" ".join(rng.choice(WORDS, rng.integers(0, 12))), ["en", "de"][i % 2], f"s{rng.integers(sources)}") for i in range(n)]


ODD = [(None, None, None), ("", "en", "empty"), ("the the of of", "en", None), ("...", "xx", "alone"), ("the of", None, "s1"), ("the of", None, "s2"),
       ("the", "", "s1"), ("of " * 20_000, "en", "s0"), ("one two", "yy", "a"), ("three", "yy", "b")]


@pytest.mark.parametrize("per_block,rows", [(128, 100_000), (2, 3)])
def test_odd_rows_and_blocks(spark, clash, monkeypatch, per_block, rows):
    docs = _docs(1, 200, 7) + ODD + ODD[2:4]
    df = pick(clash(spark.createDataFrame(docs, SCHEMA)), "text", "lang", "source")
    got = dg.audit(df, per_block=per_block, rows=rows)
    assert Counter(map(tuple, got.collect())) == brute(docs)
    assert dg.audit(df.limit(0)).count() == 0


def test_few_ranks_from_merged_skybands(spark, monkeypatch):
    for name, value in (("HELD", 20), ("GATHERED", 8), ("GATHERED_ALL", 30), ("COMPARED", 4), ("MERGED", 2), ("CELLS", 16), ("TOGETHER", 16)):
        monkeypatch.setattr(dg, name, value)
    rng = np.random.default_rng(2)
    words = [f"w{'abcdefghij'[i % 10]}{'abcdefghij'[i // 10]}" for i in range(100)]
    docs = [(" ".join(rng.choice(words, 20, p=np.arange(1, 101) / 5050)), "en", f"s{i % 5}") for i in range(150)]
    got = dg.audit(spark.createDataFrame(docs, SCHEMA).repartition(6), k=4)
    assert Counter(map(tuple, got.collect())) == brute(docs, 4)


@pytest.mark.parametrize("k", [1, 3, 20])
def test_skyband_equals_counting_all_dominators(k):
    rng = np.random.default_rng(k)
    n, everywhere, place = rng.integers(1, 12, 600), rng.integers(3, 40, 600), rng.permutation(600)
    dominated = [((n >= n[i]) & (everywhere <= everywhere[i]) & (place < place[i])).sum() for i in range(600)]
    assert sorted(dg.skyband(n, everywhere, place, k).tolist()) == [i for i in range(600) if dominated[i] < k]
    assert len(dg.skyband(n[:0], everywhere[:0], place[:0], k)) == 0


def test_shares_of_large_counts():
    counts, total = np.array([0, 5, 10 ** 12, 8 * 10 ** 14]), np.full(4, 9 * 10 ** 14)
    assert dg.shares(counts, total).tolist() == [1 + 10 ** 9 * (c + 1) // (9 * 10 ** 14) for c in counts.tolist()]
    assert dg.shares(counts[:2], np.array([7, 7])).tolist() == [1 + 10 ** 9 // 7, 1 + 6 * 10 ** 9 // 7]


def test_counts_of_a_task(monkeypatch):
    monkeypatch.setattr(dg, "HELD", 2)
    batch = pa.RecordBatch.from_pydict({"text": ["a b a", None, "b"], "lang": ["en"] * 3, "source": ["s", "s", "t"]})
    rows = Counter()
    for out in dg._counted(iter([batch, batch])):
        for r in out.to_pylist():
            rows[r["lang"], r["source"], r["term"]] += r["n"] * 100 + r["docs"]
    assert rows == {("en", "s", "a"): 402, ("en", "s", "b"): 202, ("en", "t", "b"): 202}
