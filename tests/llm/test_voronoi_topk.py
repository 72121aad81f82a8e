import math

import numpy as np
import pytest

from boxoffice.llm import voronoi_topk as vt
from tests.conftest import SF_MID, SF_SMALL
from tests.oracle_compare import compare

SCHEMA = "vec_id long, vector array<double>"


def brute(rows, queries, k=5, scale=256):
    """[(query_id, rank, vec_id, score)] comparing all with all in Python's integers."""
    def good(r):
        return r[0] is not None and r[1] is not None and all(x is not None and math.isfinite(x) and math.isfinite(x * scale) for x in r[1])
    whole = lambda v: [math.floor(x * scale) if abs(x * scale) < 2 ** 53 else int(x * scale) for x in v]
    rows = sorted({(r[0], tuple(whole(r[1]))) for r in rows if good(r)})
    out = []
    for q, v in sorted({(r[0], tuple(whole(r[1]))) for r in queries if good(r)}):
        scored = sorted((-min(max(sum(a * b for a, b in zip(v, w)), vt.LONG_LEAST), vt.LONG_MOST), i) for i, w in rows if i != q and len(w) == len(v))
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def check(spark, rows, queries, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(tuple(r) for r in vt.top_products(df, spark.createDataFrame(queries, SCHEMA), **options).collect())
    assert got == brute(rows, queries, options.get("k", 5))


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_query_equals_sql(spark, sf):
    ok, msg = compare(spark, "op11_topk_search", sf)
    assert ok, msg


def test_many_groups_and_tiles(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16)) * 4
    rows = [(i, (centres[i % 12] + rng.normal(size=16) * 0.2).tolist()) for i in range(900)]
    check(spark, rows, rows[::9], query_block=20, data_block=100)
    check(spark, rows, rows[::9], query_block=7, data_block=2_000, most_pivots=3, k=2)


def test_clusters_are_pruned():
    """Far clusters cannot reach the bound of a query cell, so their vectors get no copy."""
    rng = np.random.default_rng(4)
    near, far = (c + rng.normal(size=(50, 8)) * 0.1 for c in (np.full(8, 5.0), np.full(8, -5.0)))
    pivots = vt.Pivots([(i, v.tolist()) for i, v in enumerate(np.concatenate([near[:5], far[:5]]))])
    least = pivots.kth_best(np.arange(100, 110), near[40:], 3).min()
    cell = vt.QueryCell(near[0], np.sqrt(((near[40:] - near[0]) ** 2).sum(axis=1)).max(), least, np.sqrt((near[40:] ** 2).sum(axis=1)).max(), 10)
    assert not vt.vector_pairs(far, [cell]).any() and vt.vector_pairs(near, [cell]).any()
    assert vt.cell_pairs(np.stack([near[0], far[0]]), np.array([1.0, 1.0]), [cell])[:, 0].tolist() == [True, False]


def test_bounds_lose_no_neighbour():
    """Whatever the group, what is not copied scores below every query's k-th best."""
    rng = np.random.default_rng(5)
    data = np.rint(rng.normal(size=(400, 6)) * 20 * rng.random((400, 1)))
    pivots = vt.Pivots([(i, v.tolist()) for i, v in enumerate(data[:15])])
    queries = np.rint(rng.normal(size=(60, 6)) * 20)
    cell, dist = pivots.nearest(queries)
    least = pivots.kth_best(np.arange(1000, 1060), queries, 4)
    for c in np.unique(cell):
        own = cell == c
        point = pivots.of(6)[1][pivots.of(6)[0] == c][0]
        q = vt.QueryCell(point, dist[own].max(), least[own].min(), vt.norms(queries[own]).max(), own.sum())
        out = ~vt.vector_pairs(data, [q])[:, 0]
        kth = np.sort(queries[own] @ data.T, axis=1)[:, -4]
        assert (queries[own] @ data[out].T < kth[:, None]).all()


def test_ties_copies_and_hot_cells(spark):
    rng = np.random.default_rng(6)
    base = rng.integers(-3, 4, size=(9, 5)).astype(float).tolist()
    rows = [(i, base[0] if i % 3 == 0 else base[i % 9]) for i in range(500)] + [(i, [0.0] * 5) for i in range(600, 640)]
    check(spark, rows, [r for r in rows if r[0] % 10 == 0], query_block=8, data_block=64)


def test_odd_rows(spark, clash):
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [float("nan"), 1.0]), (4, [1.0, None]), (5, []), (55, []),
            (None, [1.0, 1.0]), (6, [1.0, 1.0, 1.0]), (50, [1.0, 2.0]), (50, [1.0, 2.0]), (50, [2.0, -1.0]),
            (7, [1e-300, 1e-300]), (8, [1e300, -1e300]), (9, [float("inf"), 0.0]), (10, [1e308, 0.0]), (-50, [3.0, 1.0]),
            (11, [-0.001, 0.999]), (100, [1e9, 1e9]), (12, [123456789.125, 3.0])]
    check(spark, rows, [r for r in rows if r[0] is None or r[0] % 5 == 0])
    assert vt.top_products(spark.createDataFrame([], SCHEMA), spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame(rows, SCHEMA)
    extra = clash(df)
    assert sorted(map(tuple, vt.top_products(extra.select("vec_id", "vector"), df.filter("vec_id = 50")).collect())) == brute(rows, [r for r in rows if r[0] == 50])


def test_merging_in_steps(spark, monkeypatch):
    monkeypatch.setattr(vt, "MERGED_LISTS", 4)
    rng = np.random.default_rng(7)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(200, 6)).tolist())]
    check(spark, rows, rows[::20], data_block=5)
