import numpy as np
import pytest

from boxoffice.llm import neighbours as nn

SCHEMA = "vec_id long, vector array<double>"


def cosine(v, w):
    v, w = np.array(v) / max(map(abs, v)), np.array(w) / max(map(abs, w))
    return float(np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w))


def brute(rows, queries, k=5):
    """{(query_id, vector): [(vec_id, score)]} comparing all with all."""
    def good(r):
        return r[0] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])
    rows = sorted({(r[0], tuple(r[1])) for r in rows if good(r)})
    out = []
    for q, v in sorted({(r[0], tuple(r[1])) for r in queries if good(r)}):
        scored = [(-cosine(v, w), i) for i, w in rows if i != q and len(w) == len(v)]
        scored = sorted((round(s, 12), i) for s, i in scored)[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scored, 1)]
    return sorted(out)


def check(spark, rows, queries, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(tuple(r) for r in nn.nearest(df, spark.createDataFrame(queries, SCHEMA), **options).collect())
    want = brute(rows, queries)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want], abs=1e-12)


def test_random_blocks(spark):
    rng = np.random.default_rng(5)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(700, 24)).tolist())]
    check(spark, rows, rows[::10], query_block=30, candidate_block=150)


def test_many_equal_and_parallel_vectors(spark):
    rng = np.random.default_rng(6)
    base = rng.integers(-3, 4, size=(12, 8)).astype(float).tolist()
    rows = [(i, base[i % 12] if i % 3 else base[0]) for i in range(400)]
    rows += [(1000 + i, [2 * x for x in base[i]]) for i in range(12)]
    check(spark, rows, [r for r in rows if r[0] % 50 == 0], query_block=4, candidate_block=64)


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [float("nan"), 1.0]), (4, [1.0, None]), (5, []),
            (None, [1.0, 1.0]), (6, [1.0, 1.0, 1.0]), (50, [1.0, 2.0]), (50, [1.0, 2.0]), (50, [2.0, -1.0]),
            (7, [1e-300, 1e-300]), (8, [1e300, -1e300]), (9, [float("inf"), 0.0]), (-50, [3.0, 1.0])]
    check(spark, rows, [r for r in rows if r[0] is not None and r[0] % 50 == 0])
    assert nn.nearest(spark.createDataFrame([], SCHEMA), spark.createDataFrame([], SCHEMA)).count() == 0


def test_clashing_extra_columns(spark, clash):
    from boxoffice.llm.common import pick

    rng = np.random.default_rng(8)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(60, 4)).tolist())]
    df = spark.createDataFrame(rows, SCHEMA)
    extra = pick(clash(df.withColumnsRenamed({"vec_id": "doc_id", "vector": "text"})), "doc_id", "text").toDF("vec_id", "vector")
    asked = extra.filter("vec_id % 10 = 0")
    assert [tuple(r)[:3] for r in sorted(nn.nearest(extra, asked).collect())] == [w[:3] for w in brute(rows, rows[::10])]


def test_merging_in_steps(spark, monkeypatch):
    monkeypatch.setattr(nn, "MERGED_LISTS", 4)
    rng = np.random.default_rng(7)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(200, 6)).tolist())]
    check(spark, rows, rows[::20], candidate_block=5)


def test_query(spark):
    from boxoffice.llm.queries import QUERIES
    from tests.conftest import SF_SMALL

    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    got = sorted(tuple(r) for r in QUERIES["op3_neighbours"](spark, SF_SMALL).collect())
    want = brute(rows, [r for r in rows if r[0] % 50 == 0])
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want], abs=1e-12)
