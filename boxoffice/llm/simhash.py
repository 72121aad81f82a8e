"""SimHash near-duplicates by segment popcounts and a grid join.

A 64-bit fingerprint is cut into 32 segments of two bits; the counts of set
bits embed it in a grid. The Manhattan distance of two embeddings is never
above the Hamming distance of the fingerprints, so fingerprints within three
bits lie within three steps, and in one half of the segments within one step.
Each half's counts are a cell: a fingerprint is at home in its two cells and
visits the cells one step up. Whoever is at home meets those at home and the
visitors; the whole Manhattan distance and then the exact bit distance decide.

Only different fingerprints are compared. Of the links found in a cell, a
spanning forest is kept: components lose nothing, and a dense group costs as
many rows as it has members.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxoffice.llm.common import column_of, cut, join_classes, number_columns, restore_columns
from boxoffice.llm.components import components

# Production parameters.
SHINGLE, SEED, MAX_BITS = 3, 42, 3
# Members of a cell that one task compares; larger cells are cut into tiles.
CELL_LIMIT = 20_000
BROADCAST_CELLS = 100_000
PAIRS_AT_ONCE = 1 << 21

EVEN = 0x5555555555555555
SEGMENTS = 16  # of two bits, in a half


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned SimHash of a text's word shingles (repeats count); 0 without words."""
    import xxhash

    words = (text or "").encode().lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return 0
    if len(words) < shingle:
        return int(xxhash.xxh64_intdigest(b" ".join(words), seed))
    one, join = xxhash.xxh64_intdigest, b" ".join
    total, bits = len(words) - shingle + 1, np.zeros(64, dtype=np.int64)
    for at in range(0, total, 1 << 16):
        part = words[at:at + (1 << 16) + shingle - 1]
        hashes = np.array([one(join(s), seed) for s in zip(*(part[k:] for k in range(shingle)))], dtype="<u8")
        bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > total, bitorder="little").view("<u8")[0])


def fingerprints(text: Column, shingle: int = SHINGLE, seed: int = SEED) -> Column:
    """The fingerprint as a (signed) long. Null and empty texts, and texts without words, give 0."""

    @F.pandas_udf(T.LongType())
    def computed(texts: pd.Series) -> pd.Series:
        own = np.array([fingerprint(t, shingle, seed) for t in texts], dtype=np.uint64)
        return pd.Series(own.view(np.int64))

    return computed(text)


def thermometer(x: np.ndarray) -> np.ndarray:
    """The embedding in unary: the bit distance of two of these is their Manhattan distance."""
    high, low = (x >> np.uint64(1)) & np.uint64(EVEN), x & np.uint64(EVEN)
    return (high | low) | ((high & low) << np.uint64(1))


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links -> links of every node to the smallest one of its component."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[:len(a)], ends[len(a):]
    label = np.arange(len(nodes))
    while True:
        before = label.copy()
        np.minimum.at(label, x, before[y])
        np.minimum.at(label, y, before[x])
        label = np.minimum(label, label[label])
        if np.array_equal(label, before):
            break
    away = label != np.arange(len(nodes))
    return nodes[away], nodes[label[away]]


def cell_links(cell: np.ndarray, fp: np.ndarray, visits: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links within runs of equal ``cell``, those at home before the visitors."""
    ends = np.flatnonzero(np.append(cell[1:] != cell[:-1], True)) + 1
    end_of = np.repeat(ends, np.diff(ends, prepend=0))
    home = np.flatnonzero(~visits)
    partners = end_of[home] - home - 1
    home, partners = home[partners > 0], partners[partners > 0]
    before = np.cumsum(partners)
    at = 0
    while at < len(home):
        upto = max(at + 1, int(np.searchsorted(before, (before[at - 1] if at else 0) + PAIRS_AT_ONCE, "right")))
        own, n = home[at:upto], partners[at:upto]
        i = np.repeat(own, n)
        j = np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + i + 1
        a, b = fp[i], fp[j]
        near = np.flatnonzero(np.bitwise_count(thermometer(a) ^ thermometer(b)) <= most)
        a, b = a[near], b[near]
        near = np.bitwise_count(a ^ b) <= most
        if near.any():
            yield forest(a[near], b[near])
        at = upto


def _linked(most: int):
    """Sorted (cell, fp, visits) batches of a partition -> links."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []  # the cell that may go on in the next batch

        def out(parts):
            for a, b in cell_links(*parts, most):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            tile, fp, visits = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            new = (tile, fp.view(np.uint64), visits)
            cuts = np.flatnonzero(tile[1:] != tile[:-1]) + 1
            if held and held[-1][0][-1] != tile[0]:
                yield from out([np.concatenate(x) for x in zip(*held)])
                held = []
            if len(cuts):
                yield from out([np.concatenate(x) for x in zip(*held, [x[:cuts[-1]] for x in new])])
                held = [tuple(x[cuts[-1]:] for x in new)]
            else:
                held.append(new)
        if held:
            yield from out([np.concatenate(x) for x in zip(*held)])
    return run


def _counts(half: Column) -> Column:
    """Two-bit counts of set bits in each segment of two; ``half`` has 32 bits."""
    return half.bitwiseAND(EVEN >> 32) + F.shiftrightunsigned(half, 1).bitwiseAND(EVEN >> 32)


def _up(cell: Column) -> Column:
    """The cells one step up from a cell (half * 2^32 + 16 counts)."""
    steps = F.array(*[F.lit(1 << 2 * k).cast("long") for k in range(SEGMENTS)])
    may = F.filter(steps, lambda s: cell.bitwiseAND(s * 2) == 0)  # counts go to 2
    return F.transform(may, lambda s: cell + s)


def near_links(distinct: DataFrame, most: int = MAX_BITS, limit: int = CELL_LIMIT) -> DataFrame:
    """Links (a, b) that connect all fingerprints of column ``fp`` within ``most`` (up to 3) differing bits.

    Not every pair: what is left out follows from those kept.
    """
    if not 0 <= most <= 3:
        raise ValueError("the halves of the grid serve up to three bits")
    low = _counts(F.col("fp").bitwiseAND(0xFFFFFFFF))
    high = _counts(F.shiftrightunsigned("fp", 32)) + (1 << 32)
    home = distinct.select("fp", F.explode(F.array(low, high)).alias("cell"))
    rows = home.withColumn("visits", F.lit(False)).unionByName(
        home.select("fp", F.explode(_up(F.col("cell"))).alias("cell"), F.lit(True).alias("visits")))

    # Cells whose members and visitors are too many for a task. What small
    # neighbours (16 at most) add stays below half the limit.
    big = cut(home.groupBy("cell").agg(F.count("*").alias("n")).filter(F.col("n") > limit // 32))
    crowded = cut(big.union(big.select(F.explode(_up(F.col("cell"))).alias("cell"), "n"))
                  .groupBy("cell").agg(F.sum("n").alias("n")).filter(F.col("n") > limit)
                  .select("cell", F.ceil(F.col("n") / limit).cast("int").alias("tiles")))
    n_crowded = crowded.count()
    if n_crowded:
        side = F.broadcast(crowded) if n_crowded <= BROADCAST_CELLS else crowded
        block = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
        others = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1),
                             lambda k: F.least(block, k) * F.col("tiles") + F.greatest(block, k))
        rows = rows.join(side, "cell", "left").select(
            "fp", "cell", "visits", F.explode(F.when(F.col("tiles").isNull(), F.array(F.lit(0))).otherwise(others)).alias("tile"))
        key = ["cell", "tile"]
        tile = F.xxhash64("cell", "tile")
    else:
        key, tile = ["cell"], F.col("cell")
    dealt = rows.repartition(*key).select(tile.alias("tile"), "fp", "visits").sortWithinPartitions("tile", "visits")
    return dealt.mapInArrow(_linked(most), "a long, b long")


def roots_of(prints: DataFrame, most: int = MAX_BITS) -> DataFrame:
    """One row per different ``fp``: n (its rows), first (smallest doc_id) and root, the smallest fingerprint of its component."""
    distinct = cut(prints.groupBy("fp").agg(F.count("*").alias("n"), F.min("doc_id").alias("first")))
    roots = components(near_links(distinct.select("fp"), most))
    return cut(distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "n", "first", F.coalesce("root", "fp").alias("root")))


def near_duplicates(docs: DataFrame, most: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (smallest doc_id reachable) of every row.

    Null doc_ids do not count; a component of nothing else has a null
    component_id. Repeated rows repeat; an empty table stays empty.
    """
    prints = cut(docs.select("doc_id", fingerprints(F.col("text")).alias("fp")))
    roots = roots_of(prints, most)
    least = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = cut(roots.join(least, "root").select("fp", "n", "component_id"))
    return join_classes(prints, classes, "fp", "n", ["doc_id"]).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, most: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: that of the smallest doc_id.

    A null doc_id comes after all others. Rows that share the smallest doc_id
    are told apart by a hash of all their columns; equal rows become one.
    """
    df, names = number_columns(docs)
    text = column_of(names, "text")
    doc_id = column_of(names, "doc_id")
    df = df.withColumn("_xrow", F.xxhash64(*[F.to_json(F.struct(f"_c{i}")) for i in range(len(names))]))
    prints = cut(df.select(doc_id.alias("doc_id"), "_xrow", fingerprints(text).alias("fp")))
    rows = prints.groupBy("fp", "doc_id", "_xrow").agg(F.count("*").alias("copies"))
    ranked = join_classes(rows, roots_of(prints, most).select("fp", "n", "root"), "fp", "n", ["doc_id", "_xrow"])
    first = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "_xrow", "copies")
    stay = cut(ranked.groupBy("root").agg(F.min(first).alias("s")).select("s.doc_id", "s._xrow", "s.copies"))
    same = doc_id.eqNullSafe(F.col("doc_id")) & (df["_xrow"] == stay["_xrow"])
    once = df.join(stay.filter("copies = 1"), same, "left_semi")
    several = df.join(stay.filter("copies > 1"), same, "left_semi").dropDuplicates()
    return restore_columns(once.unionByName(several), names)
