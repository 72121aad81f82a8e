import itertools
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from boxoffice.llm import toxicity as tx
from boxoffice.llm.common import pick, table
from tests.conftest import SF_MID, SF_SMALL


@pytest.fixture(scope="module")
def model(spark):
    return tx.character_model(table(spark, SF_MID, "documents").select("text"))


def test_trigram_counts_cover_all_documents(spark):
    texts = [r.text for r in table(spark, SF_SMALL, "documents").select("text").collect()]
    want = Counter()
    for t in texts:
        codes = [0, 0, *(tx.SYMBOL.get(c, 0) for c in t.lower()), 0, 0]
        want.update(zip(codes, codes[1:], codes[2:]))
    got = sum(tx.symbol_counts([t]) for t in texts)
    for (a, b, c), n in want.items():
        assert got[(a * 64 + b) * 64 + c] == n


def path_cost(restorer, text):
    codes = [0, 0, *(tx.SYMBOL.get(c, 0) for c in text), 0]
    return sum(restorer.cost[a][b][c] for a, b, c in zip(codes, codes[1:], codes[2:]))


@pytest.mark.parametrize("token", ["1d10t", "stuuupid", "m0r0nnn", "$cum", "a1!", "x0x", "lll1"])
def test_viterbi_finds_the_cheapest_path(model, token):
    restorer = tx.Restorer(model)
    runs = restorer.runs(token)
    best = min(itertools.product(*(restorer.choices(c, n) for c, n in runs)),
               key=lambda p: sum(c for _, c in p) + path_cost(restorer, "".join(o for o, _ in p)))
    assert restorer.decode(runs) == " ".join("".join(o for o, _ in best).split())


def test_restoration(model):
    r = tx.Restorer(model)
    assert r.restore("you are st00pid... really") .startswith("you are")
    assert r.restore("p4th3t1c cl0wn l0s3r") == "pathetic clown loser"
    assert r.restore("stuuuuupid") == "stupid" and r.restore("s.t.u.p.i.d") == "stupid"
    assert r.restore("plain words stay, as 555-5132 does") == "plain words stay as 555-5132 does"
    assert r.words("") == set() and r.words(None) == set()
    assert r.restore("a" * 50_000 + "1") != ""


def test_query_on_held_out_rows(spark):
    from boxoffice.llm.queries import QUERIES

    rows = QUERIES["op9_toxicity"](spark, SF_MID).collect()
    assert len(rows) == table(spark, SF_MID, "documents").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    truth = {r.doc_id: r.toxic for r in table(spark, SF_MID, "labels").collect()}
    held = [(truth[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in truth]
    found = sum(t and p for t, p in held)
    assert found >= 0.6 * sum(t for t, _ in held)
    assert found >= 0.9 * sum(p for _, p in held)


def test_scores_recomputed(spark):
    """Every score again from the learned weights: words decoded token by token, their beginnings, a logistic sum."""
    docs = pick(table(spark, SF_MID, "documents"), "doc_id", "text")
    labels = pick(table(spark, SF_MID, "labels"), "doc_id", "toxic")
    model = tx.character_model(docs.select(F.coalesce("text", F.lit("")).alias("text")))
    known, weights, bias = tx.learn(docs, labels, model)
    restorer, want = tx.Restorer(model), {}
    for r in docs.collect():
        lower = (r.text or "").lower()
        words = {w for token in lower.split() for w in restorer[token].split()}
        for run in tx.SPACED.finditer(lower):
            words.update(restorer.decode([(c, 1) for c in run[0][::2]], tx.KEPT).split())
        features = {f for w in words for f in [w] + [w[:k] + "-" for k in range(4, 9) if len(w) > k]}
        z = bias + sum(weights[known[f]] for f in features if f in known)
        want[r.doc_id] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    got = {r.doc_id: r.score for r in tx.toxicity(docs, labels).collect()}
    assert got.keys() == want.keys() and len(known) > 0
    assert [got[i] for i in sorted(got)] == pytest.approx([want[i] for i in sorted(got)], abs=1e-9)


def test_held_out_labels_are_never_used(spark):
    docs = pick(table(spark, SF_SMALL, "documents"), "doc_id", "text")
    labels = pick(table(spark, SF_SMALL, "labels"), "doc_id", "toxic")
    other = labels.withColumn("toxic", F.when(tx.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert sorted(map(tuple, tx.toxicity(docs, labels).collect())) == sorted(map(tuple, tx.toxicity(docs, other).collect()))


def test_odd_rows(spark, make, clash):
    bad = [(i, f"this is a plain line number w{i} you idiot") for i in range(40)]
    good = [(100 + i, f"this is a plain line number v{i} of mine") for i in range(40)]
    odd = [(None, "you 1d10t"), (200, None), (201, ""), (202, "what an i d i o t he is"), (202, "repeated id"), (203, "id!0t " * 4000)]
    df = clash(make(bad + good + odd))
    labels = spark.createDataFrame([(i, 1) for i, _ in bad] + [(i, 0) for i, _ in good] + [(None, 1), (200, None)], "doc_id long, toxic int")
    rows = tx.toxicity(pick(df, "doc_id", "text"), labels).collect()
    assert len(rows) == len(bad + good + odd)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append((r.predicted, r.held_out))
    assert by[None] == [(1, False)] and by[200][0][0] == 0 and by[201][0][0] == 0 and by[203][0][0] == 1
    assert sorted(p for p, _ in by[202]) == [0, 1]
    kept = tx.reject_toxic(df, labels)
    assert kept.schema == df.schema and kept.count() == len(good) + 3
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert np.isfinite([r.score for r in tx.toxicity(make([(1, "x")]), none).collect()]).all()
    assert tx.toxicity(make([]), none).count() == 0
