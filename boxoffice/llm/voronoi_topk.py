"""Exact top-k inner products by a Voronoi join.

Pivots, a sample of the data, cut the space into cells. Queries and data are
assigned to the cell of their nearest pivot; each cell is summarised (radius,
largest norm, and for queries the least k-th best product that the pivots
themselves give, which no query of the cell can fall below). From the summaries
follows which pairs of cells can matter, and for a single vector, from its
product with a query cell's pivot, which query cells need it. Only these get a
copy. Query cells are joined to groups of bounded size, and a tile of one group
and one share of its data is solved by itself; the tiles' lists are merged.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from boxoffice.llm.common import cut

# Production parameters: neighbours, the queries' ids, units of a component; pivots at most; vectors in a tile.
K, EVERY, SCALE = 5, 50, 256
MOST_PIVOTS, QUERY_BLOCK, DATA_BLOCK = 1_024, 4_096, 16_384
# Rows that one matrix product covers, rows taken together in a task, and lists of a query merged at once.
STRIP, TOGETHER, MERGED_LISTS = 1_024, 8_192, 256
# Below this a score and a place in a strip share a double exactly.
EXACT = 2.0 ** 41

LONG_MOST, LONG_LEAST = 2 ** 63 - 1, -(2 ** 63)

ASSIGNED = "vec_id long, key long, vector array<double>, cell long, dist double"
SOLVED = "query_id long, query_key long, vec_id long, score long"


def units(vector: Column, scale: float = SCALE) -> Column:
    """floor(scale * x) of every component, as doubles; null if the vector is unusable."""
    def floored(x: Column) -> Column:
        scaled = x * F.lit(float(scale))
        # from 2^53 on a double is whole
        return F.when(F.abs(scaled) < 2.0 ** 53, F.floor(scaled).cast("double")).otherwise(scaled)
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * F.lit(float(scale))) != float("inf"))
    vector = vector.cast("array<double>")
    return F.when(F.coalesce(F.forall(vector, good), F.lit(False)), F.transform(vector, floored))


def norms(m: np.ndarray) -> np.ndarray:
    return np.sqrt((m * m).sum(axis=1))


def by_length(vectors: pa.Array | pa.ChunkedArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and matrix of the vectors of each length."""
    array = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    flat, lengths = array.flatten().to_numpy(zero_copy_only=False), array.value_lengths().to_numpy()
    starts = np.cumsum(lengths) - lengths
    for d in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == d)
        yield rows, flat[starts[rows][:, None] + np.arange(d)]


class Pivots:
    """Cells: a number and a vector for each different pivot, by length; the sampled rows with their ids.

    A length without a pivot has one cell of its own, around zero.
    """

    def __init__(self, rows: list[tuple[int, list[float]]]):
        self.cells: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.sample: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        at = 0
        for d in sorted({len(v) for _, v in rows}):
            own = [(i, v) for i, v in rows if len(v) == d]
            matrix = np.array([v for _, v in own], np.float64).reshape(len(own), d)
            different = np.unique(matrix, axis=0)
            self.cells[d] = np.arange(at, at + len(different)), different
            self.sample[d] = np.array([i for i, _ in own]), matrix
            at += len(different)

    def of(self, d: int) -> tuple[np.ndarray, np.ndarray]:
        return self.cells.get(d) or (np.array([-1 - d]), np.zeros((1, d)))

    def nearest(self, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell and distance of the nearest pivot."""
        numbers, pivots = self.of(m.shape[1])
        with np.errstate(all="ignore"):
            apart = (pivots * pivots).sum(axis=1) - 2 * (m @ pivots.T)
            best = np.argmin(np.nan_to_num(apart, nan=np.inf), axis=1)
            return numbers[best], norms(m - pivots[best])

    def kth_best(self, ids: np.ndarray, m: np.ndarray, k: int) -> np.ndarray:
        """A lower bound of each row's k-th best product: that with the sampled rows of another id."""
        if m.shape[1] not in self.sample:
            return np.full(len(m), -np.inf)
        others, rows = self.sample[m.shape[1]]
        with np.errstate(all="ignore"):
            product = np.where(others == ids[:, None], -np.inf, m @ rows.T)
        if product.shape[1] < k:
            return np.full(len(m), -np.inf)
        return np.partition(np.nan_to_num(product, nan=-np.inf, posinf=np.inf, neginf=-np.inf), -k, axis=1)[:, -k]


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches put together to some thousand rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= TOGETHER:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


def _assigned(pivots: Pivots, k: int | None) -> Callable:
    """Cell and distance of every row; with ``k`` (queries) the bound and norm too."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _joined(batches):
            cell, dist = np.zeros(len(rows), np.int64), np.zeros(len(rows))
            least, norm = np.zeros(len(rows)), np.zeros(len(rows))
            ids = rows.column("vec_id").to_numpy()
            for own, m in by_length(rows.column("vector")):
                cell[own], dist[own] = pivots.nearest(m)
                if k:
                    least[own], norm[own] = pivots.kth_best(ids[own], m, k), norms(m)
            out = rows.append_column("cell", pa.array(cell)).append_column("dist", pa.array(dist))
            if k:
                out = out.append_column("least", pa.array(least)).append_column("norm", pa.array(norm))
            yield from out.to_batches()
    return run


class QueryCell:
    """Summary of the queries of one cell."""

    def __init__(self, pivot: np.ndarray, radius: float, least: float, norm: float, n: int):
        self.pivot, self.radius, self.least, self.norm, self.n = pivot, radius, least, norm, n
        self.group, self.shares = 0, 1


def needed(products: np.ndarray, spread: np.ndarray, cells: list[QueryCell]) -> np.ndarray:
    """Whether ``products`` (vectors or pivots x query cells) plus ``spread`` can reach the cells' bounds.

    What can't be told (overflow) counts as needed.
    """
    with np.errstate(all="ignore"):
        top = products + spread
        slack = 1e-9 * (np.abs(products) + np.abs(spread)) + 1e-6
        return ~(top + slack < np.array([c.least for c in cells]))


def cell_pairs(own: np.ndarray, radius: np.ndarray, cells: list[QueryCell]) -> np.ndarray:
    """Which query cells the data cells around ``own`` with ``radius`` can matter for.

    <q,x> = <p,o> + <q-p,o> + <p,x-o> + <q-p,x-o>.
    """
    with np.errstate(all="ignore"):
        u, p = np.array([c.radius for c in cells]), np.array([c.pivot for c in cells])
        return needed(own @ p.T, u * norms(own)[:, None] + norms(p) * radius[:, None] + u * radius[:, None], cells)


def vector_pairs(m: np.ndarray, cells: list[QueryCell]) -> np.ndarray:
    """Which query cells the vectors ``m`` can matter for: <q,x> <= <p,x> + |q-p| |x|, and <= |q| |x|."""
    with np.errstate(all="ignore"):
        size, p = norms(m)[:, None], np.array([c.pivot for c in cells])
        near = m @ p.T
        spread = np.minimum(np.array([c.radius for c in cells]) * size, np.array([c.norm for c in cells]) * size - near)
        return needed(near, np.nan_to_num(spread, nan=np.inf), cells)


def halves(cells: list[QueryCell], most: int) -> Iterator[list[QueryCell]]:
    """Neighbouring cells together, up to ``most`` queries unless a cell alone has more."""
    if len(cells) == 1 or sum(c.n for c in cells) <= most:
        yield cells
        return
    p = np.array([c.pivot for c in cells])
    with np.errstate(all="ignore"):
        one = np.argmax(np.nan_to_num(norms(p - p[0])))
        along = np.nan_to_num(p @ (p[one] - p[np.argmax(np.nan_to_num(norms(p - p[one])))]))
    order = np.argsort(along, kind="stable")
    n = np.cumsum([cells[i].n for i in order])
    at = int(np.clip(np.searchsorted(n, n[-1] / 2), 1, len(cells) - 1))
    yield from halves([cells[i] for i in order[:at]], most)
    yield from halves([cells[i] for i in order[at:]], most)


def _copies(pivots: Pivots, query_cells: dict[int, QueryCell], radius: dict[int, float]) -> Callable:
    """Every data row once for each group of queries that needs it."""
    by_d: dict[int, list[QueryCell]] = {}
    for c in query_cells.values():
        by_d.setdefault(len(c.pivot), []).append(c)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs: dict[int, dict[int, np.ndarray]] = {}
        for rows in _joined(batches):
            cell_of = rows.column("cell").to_numpy()
            for own, m in by_length(rows.column("vector")):
                cells = by_d.get(m.shape[1])
                if not cells:
                    continue
                if m.shape[1] not in pairs:
                    numbers, points = pivots.of(m.shape[1])
                    table = cell_pairs(points, np.array([radius.get(n, 0.0) for n in numbers.tolist()]), cells)
                    pairs[m.shape[1]] = {n: np.flatnonzero(t) for n, t in zip(numbers.tolist(), table)}
                group = np.array([c.group for c in cells])
                for cell in np.unique(cell_of[own]).tolist():
                    can = pairs[m.shape[1]][cell]
                    if not len(can):
                        continue
                    mine = np.flatnonzero(cell_of[own] == cell)
                    row, c = np.nonzero(vector_pairs(m[mine], [cells[i] for i in can]))
                    wanted = np.unique(np.stack([own[mine[row]], group[can[c]]], axis=1), axis=0)
                    shares = {cells[i].group: cells[i].shares for i in can}
                    many = np.array([shares[g] for g in wanted[:, 1].tolist()], np.int64)
                    wanted = np.repeat(wanted, many, axis=0)
                    share = np.arange(len(wanted)) - np.repeat(np.cumsum(many) - many, many)
                    for at in range(0, len(wanted), TOGETHER):
                        to = slice(at, at + TOGETHER)
                        picked = rows.select(["vec_id", "key", "vector"]).take(pa.array(wanted[to, 0]))
                        out = pa.table({"query_group": pa.array(wanted[to, 1] + share[to]), **{n: picked.column(n) for n in picked.column_names}})
                        yield from out.to_batches()
    return run


def _solve_small(ids: np.ndarray, queries: np.ndarray, others: np.ndarray, data: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores and ids of the k best (rows of ``others`` ascending), where doubles are exact; -inf beyond the last."""
    score, found = np.full((len(ids), k), -np.inf), np.zeros((len(ids), k), np.int64)
    for at in range(0, len(others), STRIP):
        part = others[at:at + STRIP]
        n = len(part)
        near = queries @ data[at:at + STRIP].T
        a, b = np.searchsorted(part, ids, "left"), np.searchsorted(part, ids, "right")
        for i in np.flatnonzero(a < b).tolist():
            near[i, a[i]:b[i]] = -np.inf
        rank = near * n + np.arange(n - 1, -1, -1)  # equal scores: the smaller id first
        top = np.argpartition(-rank, min(k, n) - 1, axis=1)[:, :k] if n > k else np.broadcast_to(np.arange(n), (len(ids), n))
        top = np.take_along_axis(top, np.argsort(-np.take_along_axis(rank, top, 1), axis=1, kind="stable"), 1)
        both = np.concatenate([score, np.take_along_axis(near, top, 1)], axis=1)
        names = np.concatenate([found, part[top]], axis=1)
        best = np.argsort(-both, axis=1, kind="stable")[:, :k]  # ids of earlier strips are smaller
        score, found = np.take_along_axis(both, best, 1), np.take_along_axis(names, best, 1)
    return score, found


def solve(ids: np.ndarray, queries: np.ndarray, others: np.ndarray, data: np.ndarray, k: int) -> Iterator[tuple[int, int, int]]:
    """(row of the query, vec_id, score) of each query's ``k`` best in a tile; all of one length, ``others`` ascending.

    Where products may be too large for doubles, Python's integers are used;
    scores beyond the range of long become its ends.
    """
    with np.errstate(all="ignore"):
        bound = norms(queries).max() * norms(data).max()
    if bound < EXACT:
        for at in range(0, len(ids), STRIP):
            score, found = _solve_small(ids[at:at + STRIP], queries[at:at + STRIP], others, data, k)
            i, j = np.nonzero(score > -np.inf)
            yield from zip((at + i).tolist(), found[i, j].tolist(), score[i, j].astype(np.int64).tolist())
        return
    whole = [[int(x) for x in v] for v in data.tolist()]
    for i, q in enumerate(queries.tolist()):
        q = [int(x) for x in q]
        scores = [(-min(max(sum(a * b for a, b in zip(q, v)), LONG_LEAST), LONG_MOST), n) for n, v in zip(others.tolist(), whole) if n != ids[i]]
        for s, n in sorted(scores)[:k]:
            yield i, n, -s


def _tiles(k: int) -> Callable:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if left.num_rows and right.num_rows:
            right = right.sort_by([("vec_id", "ascending"), ("key", "ascending")])
            data = {m.shape[1]: (rows, m) for rows, m in by_length(right.column("vector"))}
            ids, keys = right.column("vec_id").to_numpy(), right.column("key").to_numpy()
            q_ids, q_keys = left.column("vec_id").to_numpy(), left.column("key").to_numpy()
            for own, queries in by_length(left.column("vector")):
                if queries.shape[1] not in data:
                    continue
                rows, m = data[queries.shape[1]]
                # repeated rows lie together: one counts
                new = np.ones(len(rows), bool)
                new[1:] = (ids[rows[1:]] != ids[rows[:-1]]) | (keys[rows[1:]] != keys[rows[:-1]]) | (m[1:] != m[:-1]).any(axis=1)
                found += [(q_ids[own[i]], q_keys[own[i]], n, s) for i, n, s in solve(q_ids[own], queries, ids[rows[new]], m[new], k)]
        columns = list(zip(*found)) or [[]] * 4
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "query_key", "vec_id", "score"), columns)})
    return run


def top_products(vectors: DataFrame, queries: DataFrame, k: int = K, scale: float = SCALE, most_pivots: int = MOST_PIVOTS,
                 query_block: int = QUERY_BLOCK, data_block: int = DATA_BLOCK) -> DataFrame:
    """For every row of ``queries`` the ``k`` rows of ``vectors`` with the largest inner product.

    Both have (vec_id, vector). A component x counts as floor(scale * x);
    products are exact. Returns query_id, rank, vec_id and score; ties go to the
    smaller vec_id. Rows without an id, null vectors, and vectors with a null
    or non-finite component (also after scaling) take no part; zero and empty
    vectors do. A query is not compared with rows of its own vec_id, nor with
    vectors of another length. Equal rows count once; rows that share only the
    vec_id are vectors of their own (as queries, each gets its list). Scores
    beyond the range of long become its ends. Empty tables give an empty result.

    What reaches the driver: ``most_pivots`` vectors at most, and a summary for
    each of their cells. The result does not depend on the pivots.
    """
    clean = lambda df: df.select(F.col("vec_id").cast("long").alias("vec_id"), units(F.col("vector"), scale).alias("vector")).filter(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).select("vec_id", F.xxhash64("vec_id", "vector").alias("key"), "vector")
    data, asked = clean(vectors), clean(queries).dropDuplicates(["vec_id", "vector"])
    n = data.count()
    want = min(most_pivots, int(n ** 0.5 / 2) + 1)
    pivots = Pivots([(r.vec_id, r.vector) for r in data.orderBy("key").limit(want).collect()])
    data = cut(data.mapInArrow(_assigned(pivots, None), ASSIGNED))
    asked = cut(asked.mapInArrow(_assigned(pivots, k), ASSIGNED + ", least double, norm double"))

    radius = dict(data.groupBy("cell").agg(F.max("dist")).collect())
    cells = {}
    for r in asked.groupBy("cell").agg(F.max("dist").alias("radius"), F.min("least").alias("least"), F.max("norm").alias("norm"),
                                       F.count("*").alias("n"), F.any_value(F.size("vector")).alias("d")).collect():
        numbers, points = pivots.of(r.d)
        cells[r.cell] = QueryCell(points[np.flatnonzero(numbers == r.cell)[0]], r.radius, r.least, r.norm, r.n)
    group = 0
    for d in sorted({len(c.pivot) for c in cells.values()}):
        for together in halves([c for _, c in sorted(cells.items()) if len(c.pivot) == d], query_block):
            shares = -(-sum(c.n for c in together) // query_block) or 1
            for c in together:
                c.group, c.shares = group, shares
            group += shares

    columns = -(-n // data_block) or 1
    places = asked.sparkSession.createDataFrame([(i, c.group, c.shares) for i, c in cells.items()] or [(0, 0, 1)], "cell long, query_group long, shares int")
    spread = F.col("query_group") + F.pmod("key", "shares")
    left = asked.join(F.broadcast(places), "cell").select(
        "vec_id", "key", "vector", spread.alias("query_group"), F.explode(F.sequence(F.lit(0), F.lit(columns - 1))).alias("column"))
    right = data.mapInArrow(_copies(pivots, cells, radius), "query_group long, vec_id long, key long, vector array<double>").withColumn(
        "column", F.pmod(F.xxhash64("key"), F.lit(columns)).cast("int"))
    lists = left.groupBy("query_group", "column").cogroup(right.groupBy("query_group", "column")).applyInArrow(_tiles(k), SOLVED)
    steps = [[]]
    while columns > MERGED_LISTS:  # a query has a list for each column of tiles: merged in steps of bounded size
        columns = -(-columns // MERGED_LISTS)
        steps.insert(-1, [F.pmod(F.xxhash64("vec_id"), F.lit(columns))])
    for part in steps:
        order = Window.partitionBy("query_id", "query_key", *part).orderBy(F.col("score").desc(), "vec_id")
        lists = lists.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return lists.select("query_id", "rank", "vec_id", "score")


# The same in DuckDB (tables with distinct rows and vectors of one length).
TOPK_SQL = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM usable q JOIN usable c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""
