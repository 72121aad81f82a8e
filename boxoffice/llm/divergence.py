"""Source divergence audit: how far each source's terms are from the others' and from its language's.

Terms are counted in the partitions, then over all documents. Kept terms lie in
rows of a language, a term and a block of sources. From these come

* the pairs: blocks of terms times two blocks of sources as matrices of counts,
  in which every pair of sources is summed;
* the terms: a term's value grows with its count in the group and falls with
  that in the language, so only terms that fewer than k others dominate (higher
  group count, lower language count, earlier in UTF-8) can be among the first k.
  Partitions keep this skyband, skybands are merged, and the last is ranked
  exactly.
"""

from __future__ import annotations

import os
import uuid
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from boxoffice.llm.terms import LETTERS, terms_of
from boxoffice.session import checkpoint_dir

# Production parameters: documents that a kept term needs, and terms that are ranked.
MIN_DOCS, K = 3, 200
# Fixed value: the unit of shares.
UNIT = 1_000_000_000
# Entries that a counting task holds; sources in a block; rows of terms in a task; cells of a matrix.
HELD, SOURCES, ROWS, CELLS = 800_000, 128, 100_000, 1 << 16
# Rows grouped together in a task; rows of a group gathered before they are cut to a skyband, and rows of all groups; rows compared at once;
# skybands merged at once.
TOGETHER, GATHERED, GATHERED_ALL, COMPARED, MERGED = 1 << 14, 1 << 14, 1 << 20, 512, 64

COUNTED = "lang string, source string, term string, n long, docs long"
BAND = "lang string, source string, term string, n long, all long"


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder."""
    spark = df.sparkSession
    at = os.path.join(checkpoint_dir(spark), f"audit-{uuid.uuid4().hex}")
    df.write.parquet(at)
    return spark.read.schema(df.schema).parquet(at)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term by language and source, summed within the task."""
    groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def rows() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in groups.items():
            terms, times = list(n), list(n.values())
            for at in range(0, len(terms), 1 << 16):
                to = slice(at, at + (1 << 16))
                some = terms[to]
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(lang, len(some)), pa.repeat(source, len(some)), pa.array(some, pa.binary()).cast(pa.string()),
                     pa.array(times[to], pa.int64()), pa.array(map(docs.__getitem__, some), pa.int64(), size=len(some))],
                    names=["lang", "source", "term", "n", "docs"])
        groups.clear()

    for batch in batches:
        for text, lang, source in zip(*(batch.column(c).to_pylist() for c in ("text", "lang", "source"))):
            terms = terms_of(text, LETTERS)
            if terms:
                n, docs = groups.setdefault((lang, source), (Counter(), Counter()))
                n.update(terms)
                docs.update(set(terms))
        if sum(len(n) for n, _ in groups.values()) >= HELD:
            yield from rows()
    yield from rows()


def shares(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(UNIT * (count + 1) / total), exactly (count below total, total below 9e15)."""
    rest, out = counts + 1, 0
    if rest.size and int(rest.max()) < 2 ** 63 // UNIT:
        return 1 + UNIT * rest // total
    for _ in range(3):  # three digits each
        digits, rest = np.divmod(rest * 1000, total)
        out = out * 1000 + digits
    return 1 + out


def value(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / q) of shares."""
    apart = p - q
    return ((apart * apart).astype(np.uint64) // q.astype(np.uint64)).astype(np.int64)


# --- terms -------------------------------------------------------------------

def skyband(n: np.ndarray, everywhere: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
    """Rows that fewer than ``k`` others dominate.

    A row dominates another if its ``n`` is as high, its ``everywhere`` as low
    and its ``place`` (different for all rows) lower. Rows are taken by falling
    ``n``; only kept rows need to be compared, as a row that k others dominate
    has k dominators in the skyband.
    """
    if not len(n):
        return np.empty(0, np.int64)
    order = np.lexsort((place, everywhere, -n))
    x, y = everywhere[order], place[order]
    kept_x, kept_y, kept = np.empty(0, x.dtype), np.empty(0, y.dtype), []
    # a coarse grid of the kept rows settles most: what lies in lower bins on both axes dominates
    edges_x, edges_y = np.unique(np.quantile(x, np.linspace(0, 1, 65), method="lower")), np.unique(np.quantile(y, np.linspace(0, 1, 65), method="lower"))
    bin_x, bin_y = np.searchsorted(edges_x, x, "right"), np.searchsorted(edges_y, y, "right")
    grid = np.zeros((len(edges_x) + 1, len(edges_y) + 1), np.int64)
    for at in range(0, len(x), COMPARED):
        rows = np.arange(at, min(at + COMPARED, len(x)))
        below = np.zeros((grid.shape[0] + 1, grid.shape[1] + 1), np.int64)
        below[1:, 1:] = grid.cumsum(axis=0).cumsum(axis=1)
        rows = rows[below[bin_x[rows], bin_y[rows]] < k]
        if not len(rows):
            continue
        own = (kept_x[None, :] <= x[rows, None]) & (kept_y[None, :] < y[rows, None])
        found = own.sum(axis=1)
        rows, found = rows[found < k], found[found < k]
        # among themselves: earlier ones with as low ``everywhere`` and lower place
        inner = (x[rows][None, :] <= x[rows, None]) & (y[rows][None, :] < y[rows, None]) & (np.arange(len(rows))[None, :] < np.arange(len(rows))[:, None])
        keep = rows[found + inner.sum(axis=1) < k]
        kept_x, kept_y = np.append(kept_x, x[keep]), np.append(kept_y, y[keep])
        np.add.at(grid, (bin_x[keep], bin_y[keep]), 1)
        kept.append(keep)
    return order[np.concatenate(kept)] if kept else np.empty(0, np.int64)


def _band_of(rows: pa.Table, k: int) -> pa.Table:
    """The skyband of one group's rows (term, n, all)."""
    terms = rows.column("term").combine_chunks()
    place = np.empty(len(rows), np.int64)
    place[pc.sort_indices(terms.cast(pa.binary())).to_numpy()] = np.arange(len(rows))
    return rows.take(pa.array(skyband(rows.column("n").to_numpy(), rows.column("all").to_numpy(), place, k)))


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches put together to some thousand rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= TOGETHER:
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _bands(k: int) -> Callable:
    """The skybands of all groups within a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], list[pa.Table]] = {}
        new: Counter = Counter()  # rows of a group since its last cut
        total = 0

        def flushed() -> Iterator[pa.RecordBatch]:
            for (lang, source), parts in held.items():
                band = _band_of(pa.concat_tables(parts), k)
                for name, text in (("source", source), ("lang", lang)):
                    band = band.add_column(0, name, pa.repeat(text, len(band)))
                yield from band.to_batches()
            held.clear()
            new.clear()

        for rows in _together(batches):
            flat = pc.list_parent_indices(rows.column("counts")).combine_chunks()
            rows = pa.table({"lang": rows.column("lang").take(flat), "source": pc.list_flatten(rows.column("sources")),
                             "term": rows.column("term").take(flat), "n": pc.list_flatten(rows.column("counts")),
                             "all": rows.column("all").take(flat)}).combine_chunks()
            codes = [rows.column(c).combine_chunks().dictionary_encode() for c in ("lang", "source")]
            group = codes[0].indices.to_numpy().astype(np.int64) * len(codes[1].dictionary) + codes[1].indices.to_numpy()
            order = np.argsort(group, kind="stable")
            rows = rows.take(pa.array(order))
            starts = np.flatnonzero(np.append(True, np.diff(group[order]) != 0)) if len(order) else []
            for a, b in zip(starts, np.append(starts[1:], len(order))):
                key = rows.column("lang")[int(a)].as_py(), rows.column("source")[int(a)].as_py()
                held.setdefault(key, []).append(rows.slice(a, b - a).select(["term", "n", "all"]))
                new[key] += int(b - a)
                total += int(b - a)
                if new[key] >= GATHERED:
                    gathered = pa.concat_tables(held[key])
                    held[key], new[key] = [_band_of(gathered, k)], 0
                    total -= len(gathered) - len(held[key][0])
            if total >= GATHERED_ALL:
                yield from flushed()
                total = 0
        yield from flushed()
    return run


def _ranked(k: int) -> Callable:
    """The first ``k`` terms of a group, from the skyband of its last skybands."""
    def run(rows: pa.Table) -> pa.Table:
        rows = _band_of(rows, k)
        first = {c: rows.column(c)[0].as_py() for c in ("lang", "source", "n_group", "n_lang", "v")}
        n, everywhere = rows.column("n").to_numpy(), rows.column("all").to_numpy()
        p = shares(n, np.full(len(n), first["n_group"] + first["v"]))
        q = shares(everywhere, np.full(len(n), first["n_lang"] + first["v"]))
        terms = [t.encode() for t in rows.column("term").to_pylist()]
        over = np.flatnonzero(p > q).tolist()
        f = value(p, q)
        best = sorted((-int(f[i]), terms[i]) for i in over)[:k]
        return pa.table({"lang": pa.array([first["lang"]] * len(best), pa.string()), "source": pa.array([first["source"]] * len(best), pa.string()),
                         "item": pa.array([t for _, t in best], pa.binary()).cast(pa.string()),
                         "value": pa.array([-v for v, _ in best], pa.int64()), "rank": pa.array(range(1, len(best) + 1), pa.int32())})
    return run


# --- pairs -------------------------------------------------------------------

def _paired(key: tuple, terms: pa.Table, sources: pa.Table) -> pa.Table:
    """Sums over a share of the terms for every two sources of two blocks (or of one)."""
    lang, a_block, b_block = key[0].as_py(), key[1].as_py(), key[2].as_py()
    names = sources.column("source").to_pylist()
    number = {s: i for i, s in enumerate(names)}
    block = sources.column("block").to_numpy()
    total = sources.column("n_group").to_numpy() + sources.column("v").to_numpy()
    left, right = np.flatnonzero(block == a_block), np.flatnonzero(block == b_block)
    out = np.zeros((len(names), len(names)), np.int64)
    seen = 0
    if terms.num_rows and len(names):
        terms = terms.sort_by("term")
        different = terms.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
        lists = terms.column("counts").combine_chunks()
        row = np.repeat(different, lists.value_lengths().to_numpy())
        source = np.array([number[s] for s in terms.column("sources").combine_chunks().flatten().to_pylist()], np.int64)
        count = lists.flatten().to_numpy()
        seen = int(different[-1]) + 1
        step = max(1, CELLS // len(names))
        for at in range(0, seen, step):
            a, b = np.searchsorted(row, [at, at + step])
            counts = np.zeros((len(names), min(step, seen - at)), np.int64)
            counts[source[a:b], row[a:b] - at] = count[a:b]
            p = shares(counts, total[:, None])
            for i in left.tolist():
                out[i, right] += value(p[i], p[right]).sum(axis=1)
            if a_block != b_block:
                for i in right.tolist():
                    out[i, left] += value(p[i], p[left]).sum(axis=1)
    i, j = np.nonzero((block[:, None] == a_block) & (block == b_block) | (block[:, None] == b_block) & (block == a_block))
    i, j = i[i != j], j[i != j]
    return pa.table({"lang": pa.array([lang] * len(i), pa.string()), "source": pa.array([names[x] for x in i.tolist()], pa.string()),
                     "item": pa.array([names[x] for x in j.tolist()], pa.string()), "value": pa.array(out[i, j]),
                     "seen": pa.array(np.full(len(i), seen, np.int64))})


def _pairs(kept: DataFrame, sizes: DataFrame, blocks: int, parts: int) -> DataFrame:
    """Every other source of a language with its value, for each of its sources."""
    every = F.sequence(F.lit(0), F.lit(blocks - 1))
    # a block meets itself and each other block once
    tiles = F.explode(F.transform(every, lambda j: F.struct(F.least(j, F.col("block")).alias("a"), F.greatest(j, F.col("block")).alias("b"))))
    share = F.pmod(F.xxhash64("term"), F.lit(parts)).cast("int")
    terms = kept.select("lang", "term", "sources", "counts", tiles.alias("tile"), share.alias("part")).select("*", "tile.a", "tile.b")
    ends = sizes.select("lang", "source", "n_group", "v", "block", tiles.alias("tile")).select(
        "*", "tile.a", "tile.b", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    keys = ["lang", "a", "b", "part"]
    sums = terms.drop("tile").groupBy(*keys).cogroup(ends.drop("tile").groupBy(*keys)).applyInArrow(
        _paired, "lang string, source string, item string, value long, seen long")
    sums = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    q = sizes.select(F.col("lang").alias("_l"), F.col("source").alias("_s"), F.col("n_group").alias("n_item"))
    p = sizes.select(F.col("lang").alias("_k"), F.col("source").alias("_t"), "n_group", "v")
    both = sums.join(q, (F.col("lang") == F.col("_l")) & (F.col("item") == F.col("_s"))).join(
        p, (F.col("lang") == F.col("_k")) & (F.col("source") == F.col("_t")))
    # terms that are in neither block
    none = lambda n: F.expr(f"1 + if(v = 0, 0, {UNIT} div ({n} + v))")
    both = both.withColumns({"_p": none("n_group"), "_q": none("n_item")})
    rest = F.expr("(v - seen) * (((_p - _q) * (_p - _q)) div _q)")
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return both.withColumn("value", F.col("value") + rest).select(
        "lang", "source", "item", "value", F.row_number().over(order).alias("rank"))


def audit(docs: DataFrame, k: int = K, min_docs: int = MIN_DOCS, per_block: int = SOURCES, rows: int = ROWS) -> DataFrame:
    """lang, source, part, item, value, rank for every occurring (lang, source) of ``docs`` (text, lang, source).

    A language keeps the terms in at least ``min_docs`` of its documents (V of
    them). With N the sum of a group's counts of kept terms, a term's share is
    ``p = 1 + floor(10^9 (count + 1) / (N + V))``. Part ``pair``: the other
    sources of the language, by the sum of ``floor((p - q)^2 / q)`` over all
    kept terms, q being the other's share (0 without kept terms). Part ``term``:
    the ``k`` terms that occur in the group with p above the language's share
    q, by the same value. Ranks are by falling value, then UTF-8 of the item.

    Null text, lang and source count as empty strings; repeated rows count as
    often as they occur; a group without terms has pairs only, and one that is
    alone in its language no pair. An empty table gives an empty result.
    """
    blank = lambda c: F.coalesce(c, F.lit("")).alias(c)
    docs = docs.select(blank("text"), blank("lang"), blank("source"))
    spark = docs.sparkSession
    groups = written(docs.groupBy("lang", "source").agg(F.count("*").alias("n_docs")))
    most = groups.groupBy("lang").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    blocks = -(-most // per_block) or 1
    block = F.pmod(F.xxhash64("source"), F.lit(blocks)).cast("int")

    counts = docs.mapInArrow(_counted, COUNTED).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    # one shuffle by language and term serves the sums over the sources and the lists of a block
    of_term = Window.partitionBy("lang", "term")
    counts = counts.withColumn("block", block).withColumns({
        "all": F.sum("n").over(of_term), "all_docs": F.sum("docs").over(of_term), "first": F.min("block").over(of_term)})
    listed = F.sort_array(F.collect_list(F.struct("source", "n")))
    kept = counts.filter(F.col("all_docs") >= min_docs).groupBy("lang", "term", "block", "first", "all").agg(listed.alias("l"))
    kept = written(kept.select("lang", "term", "block", (F.col("block") == F.col("first")).alias("once"), "all",
                               F.col("l.source").alias("sources"), F.col("l.n").alias("counts")))

    flat = kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("c"))
    n_group = flat.groupBy("lang", "c.sources").agg(F.sum("c.counts").alias("n")).withColumnsRenamed({"lang": "_l", "sources": "_s"})
    of_lang = kept.filter("once").groupBy("lang").agg(F.sum("all").alias("n_lang"), F.count("*").alias("v")).withColumnRenamed("lang", "_k")
    sizes = groups.join(n_group, (F.col("lang") == F.col("_l")) & (F.col("source") == F.col("_s")), "left").join(
        of_lang, F.col("lang") == F.col("_k"), "left")
    or_zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    sizes = written(sizes.select("lang", "source", or_zero("n").alias("n_group"), or_zero("n_lang").alias("n_lang"),
                                 or_zero("v").alias("v"), block.alias("block")))

    parts = -(-kept.count() // rows) or 1
    pairs = _pairs(kept, sizes, blocks, parts)

    band = kept.mapInArrow(_bands(k), BAND)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    while buckets > MERGED:  # skybands of many tasks, merged in steps of bounded size
        buckets = -(-buckets // MERGED)
        band = band.withColumn("bucket", F.pmod(F.xxhash64("term"), F.lit(buckets))).groupBy("lang", "source", "bucket").applyInArrow(
            _merged(k), BAND)
    of = sizes.select(F.col("lang").alias("_l"), F.col("source").alias("_s"), "n_group", "n_lang", "v")
    terms = band.join(of, (F.col("lang") == F.col("_l")) & (F.col("source") == F.col("_s"))).drop("_l", "_s").groupBy(
        "lang", "source").applyInArrow(_ranked(k), "lang string, source string, item string, value long, rank int")
    columns = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    return columns(pairs, "pair").unionByName(columns(terms, "term"))


def _merged(k: int) -> Callable:
    def run(rows: pa.Table) -> pa.Table:
        band = _band_of(rows.select(["term", "n", "all"]), k)
        for name in ("source", "lang"):
            band = band.add_column(0, name, pa.array([rows.column(name)[0].as_py()] * len(band), pa.string()))
        return band
    return run


# The same in DuckDB.
AUDIT_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS no, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
words AS (SELECT no, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*)::HUGEINT AS n FROM words GROUP BY ALL HAVING count(DISTINCT no) >= 3),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS n_lang FROM kept GROUP BY ALL),
counts AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS n_group FROM (SELECT DISTINCT lang, source FROM docs)
           LEFT JOIN counts USING (lang, source) GROUP BY ALL),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000 * (coalesce(c.n, 0) + 1)) // (g.n_group + l.v) AS p,
         1 + (1000000000 * (k.n + 1)) // (l.n_lang + l.v) AS q
  FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (((p - q) * (p - q)) // q)::BIGINT FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
FROM found QUALIFY part = 'pair' OR rank <= 200
"""
