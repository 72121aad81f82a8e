"""Nearest neighbours by a block matrix join with int8 tiles.

Queries and candidates are dealt into blocks; a tile is a pair of blocks. In a
tile, unit vectors are rounded to int8 codes, and one integer matrix product
gives all cosines up to a bound that follows from the rounding errors' norms.
Only pairs that can still be among a query's nearest are computed again from
the original vectors in double precision; heaps keep the best of a tile, and
merge the tiles' lists.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxoffice.llm.common import cut

# Production parameters: neighbours of each query; vectors in a block.
K, EVERY = 5, 50
QUERY_BLOCK, CANDIDATE_BLOCK = 8_192, 16_384
# Candidates that one matrix product covers, and lists that one merge task gets for a query at most.
STRIP, MERGED_LISTS = 2_048, 256

RESULT = "query_id long, query_key long, vec_id long, score double"


def usable(vector: Column) -> Column:
    """Not null, without null or non-finite components, and not zero (nor empty)."""
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return vector.isNotNull() & F.coalesce(F.forall(vector, good), F.lit(False)) & F.coalesce(
        F.exists(vector, lambda x: x != 0), F.lit(False))


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Each row times a power of two (so, exactly) that keeps its squares from under- or overflow."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])


def codes(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors as int8 codes, scales, and the norms of the rounding errors (a little more)."""
    unit = scaled(vectors)
    unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
    scale = np.abs(unit).max(axis=1, keepdims=True) / 127
    code = np.rint(unit / scale)
    error = np.sqrt(((unit - scale * code) ** 2).sum(axis=1))
    return code.astype(np.int8), scale[:, 0], error * (1 + 1e-9) + 1e-9


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact a @ b.T of int8 codes, as doubles.

    Single precision holds the sums of 1024 products of codes exactly, and has
    the faster matrix product; longer vectors are taken in such pieces.
    """
    out = np.zeros((len(a), len(b)))
    for at in range(0, a.shape[1], 1024):
        out += a[:, at:at + 1024].astype(np.float32) @ b[:, at:at + 1024].astype(np.float32).T
    return out


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of the rows of ``a`` and ``b``, pair by pair, in double precision."""
    a, b = scaled(a), scaled(b)
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def tile(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> Iterator[tuple]:
    """(query row, score, vec_id) of the ``k`` nearest in a tile for each query; all of one dimension.

    Equal vectors stand for each other: only their smallest k + 1 ids can count
    (one may be the query's own).
    """
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], np.ascontiguousarray(vectors[order])
    rows = vectors.view(np.dtype((np.void, vectors.dtype.itemsize * vectors.shape[1])))[:, 0]
    _, first, group = np.unique(rows, return_index=True, return_inverse=True)
    members = np.split(ids[np.argsort(group, kind="stable")], np.cumsum(np.bincount(group))[:-1])
    members = [m[:k + 1].tolist() for m in members]
    distinct = vectors[first]
    q_code, q_scale, q_error = codes(queries)
    c_code, c_scale, c_error = codes(distinct)
    best: list[list[tuple[float, int]]] = [[] for _ in queries]  # heaps, the worst first
    for at in range(0, len(distinct), STRIP):
        to = slice(at, at + STRIP)
        near = product(q_code, c_code[to]) * q_scale[:, None] * c_scale[to]
        # |<u,v> - <u',v'>| <= |u| |v - v'| + |v'| |u - u'|
        slack = c_error[to] + q_error[:, None] * (1 + c_error[to])
        low = near - slack
        # the k-th largest lower bound; a query's own vector may be one of them
        m = min(k + 1, low.shape[1])
        floor = np.partition(low, low.shape[1] - m, axis=1)[:, low.shape[1] - m] if m == k + 1 else np.full(len(low), -2.0)
        held = np.array([h[0][0] if len(h) == k else -2.0 for h in best])
        # scores computed twice may differ in the last digits
        q, c = np.nonzero(near + slack >= np.maximum(floor, held)[:, None] - 1e-12)
        for part in range(0, len(q), 1 << 16):
            own, other = q[part:part + (1 << 16)], c[part:part + (1 << 16)] + at
            for i, j, score in zip(own.tolist(), other.tolist(), cosines(queries[own], distinct[other]).tolist()):
                heap = best[i]
                for vec_id in members[j]:
                    if vec_id == query_ids[i]:
                        continue
                    entry = (score, -vec_id)
                    if len(heap) < k:
                        heapq.heappush(heap, entry)
                    elif entry > heap[0]:
                        heapq.heapreplace(heap, entry)
                    else:
                        break
    for i, heap in enumerate(best):
        for score, negative in sorted(heap, reverse=True):
            yield i, score, -negative


def _matrix(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Flat values and lengths of a list column without nulls."""
    array = column.combine_chunks()
    if isinstance(array, pa.ChunkedArray):
        array = pa.concat_arrays(array.chunks)
    return array.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.diff(array.offsets.to_numpy())


def _by_dimension(ids: np.ndarray, flat: np.ndarray, lengths: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Row numbers and matrix of the vectors of each dimension."""
    starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    out = {}
    for d in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == d)
        out[d] = rows, flat[starts[rows][:, None] + np.arange(d)]
    return out


def _tiles(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if left.num_rows and right.num_rows:
            q_ids, q_keys = (left.column(c).to_numpy() for c in ("query_id", "query_key"))
            ids = right.column("vec_id").to_numpy()
            queries = _by_dimension(q_ids, *_matrix(left.column("vector")))
            candidates = _by_dimension(ids, *_matrix(right.column("vector")))
            for d in queries.keys() & candidates.keys():
                rows, matrix = queries[d]
                others, vectors = candidates[d]
                for i, score, vec_id in tile(q_ids[rows], matrix, ids[others], vectors, k):
                    found.append((q_ids[rows[i]], q_keys[rows[i]], vec_id, score))
        columns = list(zip(*found)) or [[], [], [], []]
        return pa.table({"query_id": pa.array(columns[0], pa.int64()), "query_key": pa.array(columns[1], pa.int64()),
                         "vec_id": pa.array(columns[2], pa.int64()), "score": pa.array(columns[3], pa.float64())})
    return run


def _merged(k: int, ranked: bool):
    """The k best of a group of queries' lists, by a heap for each query."""
    def run(lists: pa.Table) -> pa.Table:
        heaps: dict[tuple[int, int], list] = {}
        for q, key, vec_id, score in zip(*(lists.column(c).to_pylist() for c in ("query_id", "query_key", "vec_id", "score"))):
            heap = heaps.setdefault((q, key), [])
            entry = (score, -vec_id)
            if len(heap) < k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
        rows = [(q, key, -n, score, r) for (q, key), heap in heaps.items()
                for r, (score, n) in enumerate(sorted(heap, reverse=True), 1)]
        columns = list(zip(*rows)) or [[], [], [], [], []]
        data = {"query_id": pa.array(columns[0], pa.int64()), "query_key": pa.array(columns[1], pa.int64()),
                "vec_id": pa.array(columns[2], pa.int64()), "score": pa.array(columns[3], pa.float64())}
        if ranked:
            data["rank"] = pa.array(columns[4], pa.int32())
        return pa.table(data)
    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, query_block: int = QUERY_BLOCK,
            candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """For every row of ``queries`` the ``k`` rows of ``vectors`` with the largest cosine.

    Both have (vec_id, vector). Returns query_id, rank, vec_id and score; ties go
    to the smaller vec_id. Rows without an id or a usable vector take no part.
    A query is not compared with rows of its own vec_id, nor with vectors of
    another length. Equal rows count once; rows that share only the vec_id are
    vectors of their own (as queries, each gets its list). Empty tables give an
    empty result.
    """
    clean = lambda df: df.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("vector").cast("array<double>").alias("vector")).filter(
        F.col("vec_id").isNotNull() & usable(F.col("vector"))).dropDuplicates()
    key = F.xxhash64("vec_id", "vector")
    candidates = cut(clean(vectors))
    asked = cut(clean(queries).select(F.col("vec_id").alias("query_id"), "vector", key.alias("query_key")))
    n_candidates, n_queries = candidates.count(), asked.count()
    rows, columns = -(-n_queries // query_block) or 1, -(-n_candidates // candidate_block) or 1
    part = lambda c, n: F.pmod(c, F.lit(n)).cast("int")
    left = asked.select("*", part(F.col("query_key"), rows).alias("row"),
                        F.explode(F.sequence(F.lit(0), F.lit(columns - 1))).alias("column"))
    right = candidates.select("*", part(key, columns).alias("column"),
                              F.explode(F.sequence(F.lit(0), F.lit(rows - 1))).alias("row"))
    lists = left.groupBy("row", "column").cogroup(right.groupBy("row", "column")).applyInArrow(_tiles(k), RESULT)
    # a query has a list for each column of tiles: merged in steps of bounded size
    group = F.pmod(F.col("query_key"), F.lit(-(-n_queries // 64) or 1)).alias("group")
    while columns > MERGED_LISTS:
        columns = -(-columns // MERGED_LISTS)
        lists = lists.groupBy(group, F.pmod(F.xxhash64("vec_id"), F.lit(columns)).alias("part")).applyInArrow(_merged(k, False), RESULT)
    out = lists.groupBy(group).applyInArrow(_merged(k, True), RESULT + ", rank int")
    return out.select("query_id", "rank", "vec_id", "score")
