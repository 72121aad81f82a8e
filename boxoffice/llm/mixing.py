"""Mixing sources to target weights.

Every document gets a hash-random key. The (slim) rows are range-sorted by
source and key; sums per partition, summed up over the partitions, and running
sums within one give each row its place in its source's order of words. A
source's budget is so many whole epochs and a rest; the rest ends at one place
of the order, the cut. Cuts are one row per source, and a document's share
follows from comparing its own key with its source's cut, so texts are never
sorted or moved for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from boxoffice.llm.common import WORD_PATTERN, column_of, cut, number_columns, restore_columns

# Production parameters: weights in order of the sources, repeating; the mix's
# words as a share of all; the most often that a document is repeated.
WEIGHTS, SHARE, MOST_EPOCHS, SEED = (3, 1, 2), 1.5, 2, 1729
ORDER = ["_xkey", "_xid", "_xsize"]
# Cuts (a row per source) are broadcast up to so many; beyond, they are joined by a shuffle.
BROADCAST_SOURCES = 100_000


def word_count(text: Column) -> Column:
    """Words of a text; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def _numbered(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` with ``n``, its rows' number from 0 in this order.

    The rows are range-sorted and written; what the driver sees is one count
    for each partition.
    """
    place = cut(df.orderBy(*order).withColumn("_xat", F.monotonically_increasing_id()))
    part = F.shiftright("_xat", 33)
    counts = sorted(tuple(r) for r in place.groupBy(part.alias("p")).count().collect())
    starts, total = {}, 0
    for p, n in counts:
        starts[p], total = total, total + n
    if not starts:
        return place.withColumn("n", F.lit(0).cast("long")).drop("_xat")
    start = F.element_at(F.create_map(*[F.lit(x).cast("long") for kv in starts.items() for x in kv]), part)
    return place.withColumn("n", start + F.col("_xat").bitwiseAND((1 << 33) - 1)).drop("_xat")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                   most: int = MOST_EPOCHS) -> DataFrame:
    """(source, source_size) -> also ``target`` in words.

    Sources in order of code points, null last, get the weights in turn and
    share ``share`` times all sizes by weight. A target stops at ``most`` times
    its source's size and the excess is shared among the others by weight,
    again until none is above. A round needs two sums over the sources not yet
    stopped.
    """
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("n") % len(weights) + 1).cast("int"))
    left = cut(_numbered(sizes, F.col("source").asc_nulls_last()).select(
        "source", "source_size", turn.alias("w"), (F.col("source_size") * most).cast("double").alias("cap")))
    done = left.limit(0).select("source", "source_size", "cap")
    budget = share * (left.agg(F.sum("source_size")).first()[0] or 0)
    while True:
        weight = left.agg(F.sum("w")).first()[0] or 0.0
        level = budget / weight if weight else 0.0
        over = left.filter(F.col("cap") < F.col("w") * level)
        taken = over.agg(F.sum("cap"), F.count("*")).first()
        if not taken[1]:
            break
        budget -= taken[0]
        done = done.union(over.select("source", "source_size", "cap"))
        left = left.filter(F.col("cap") >= F.col("w") * level)
    rest = left.select("source", "source_size", (F.col("w") * level).alias("target"))
    return cut(rest.union(done.withColumnRenamed("cap", "target")))


def source_cuts(slim: DataFrame, targets: DataFrame) -> DataFrame:
    """Where each source's rest ends: its whole epochs, and the key and share of the row it ends in.

    ``slim`` has one row for each different (source, key, id, size) with the
    number of its copies ``_xn``. Copies of the row at the cut take equal shares.
    """
    plan = targets.select(
        "source", "source_size", "target", F.round("target").cast("long").alias("budget")).select(
        "*", F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(0)
        .cast("long").alias("epochs"))
    plan = plan.withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size"))
    words = (F.col("_xsize") * F.col("_xn")).alias("_xwords")
    # written once: both passes below must see the same partitions
    dealt = cut(slim.filter("_xsize > 0").repartitionByRange(F.col("source").asc_nulls_last(), *ORDER)
                .select("source", *ORDER, "_xn", words, F.spark_partition_id().alias("_xpart")))
    sums = dealt.groupBy("source", "_xpart").agg(F.sum("_xwords").alias("_xsum"))
    upto = Window.partitionBy("source").orderBy("_xpart").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(F.col("source").alias("s"), F.col("_xpart").alias("p"), "_xsum",
                         F.coalesce(F.sum("_xsum").over(upto), F.lit(0)).alias("_xstart"))
    plan = plan.withColumnRenamed("source", "s")
    # only the partition in which a source's rest ends is looked at row by row
    ends = starts.join(plan, starts.s.eqNullSafe(plan.s)).drop(plan.s).filter(
        "_xstart <= rest and rest < _xstart + _xsum").select("s", "p", "_xstart", "rest")
    inside = dealt.join(ends, dealt.source.eqNullSafe(ends.s) & (dealt._xpart == ends.p))
    running = Window.partitionBy("s", "p").orderBy(*ORDER)
    before = F.col("_xstart") + F.sum("_xwords").over(running) - F.col("_xwords")
    cuts = inside.select("s", *ORDER, "_xn", "_xwords", "rest", before.alias("_xbefore")).filter(
        "_xbefore <= rest and rest < _xbefore + _xwords").select(
        F.col("s").alias("cs"), *[F.col(c).alias(f"c{c}") for c in ORDER],
        F.floor((F.col("rest") - F.col("_xbefore")) / F.col("_xn")).cast("long").alias("share"))
    return cut(plan.join(cuts, plan.s.eqNullSafe(cuts.cs), "left").select(
        F.col("s").alias("_xs"), "source_size", "target", "epochs", "rest", *[f"c{c}" for c in ORDER], "share"))


def _before(own: list[Column], other: list[Column]) -> Column:
    """``own`` comes before ``other`` in the sort order (nulls first)."""
    less = lambda a, b: (a.isNull() & b.isNotNull()) | F.coalesce(a < b, F.lit(False))
    out = F.lit(False)
    for a, b in reversed(list(zip(own, other))):
        out = less(a, b) | (a.eqNullSafe(b) & out)
    return out


def _taken(df: DataFrame, names: list[str], weights, share, most, seed) -> DataFrame:
    """``df`` (numbered columns) with _xsize, source_size, target and taken."""
    doc_id, source = column_of(names, "doc_id"), column_of(names, "source")
    df = df.select("*", F.xxhash64(F.lit(seed), doc_id).alias("_xkey"), doc_id.alias("_xid"),
                   word_count(column_of(names, "text")).alias("_xsize"))
    slim = cut(df.groupBy(source.alias("source"), *ORDER).agg(F.count("*").alias("_xn")))
    sizes = slim.groupBy("source").agg(F.sum(F.col("_xsize") * F.col("_xn")).alias("source_size"))
    cuts = source_cuts(slim, source_targets(sizes, weights, share, most))
    own, at = [F.col(c) for c in ORDER], [F.col(f"c{c}") for c in ORDER]
    extra = (F.when(F.col("share").isNull(), 0)
             .when(_before(own, at), F.col("_xsize"))
             .when(own[0].eqNullSafe(at[0]) & own[1].eqNullSafe(at[1]) & own[2].eqNullSafe(at[2]), F.col("share"))
             .otherwise(0))
    taken = F.col("epochs") * F.col("_xsize") + F.when(F.col("_xsize") > 0, extra).otherwise(0)
    side = F.broadcast(cuts) if cuts.count() <= BROADCAST_SOURCES else cuts
    return df.join(side, source.eqNullSafe(F.col("_xs"))).withColumn("taken", taken.cast("long"))


def mixture(docs: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST_EPOCHS, seed=SEED) -> DataFrame:
    """doc_id, source, size, source_size, target and taken (words the mix takes) of every row.

    Null texts have size 0 and, like empty ones, take nothing; null sources
    form one source, the last. Rows with the same doc_id, source and size count
    as copies; at the cut they share evenly (a source then falls short by less
    than a word for each copy, else it takes its rounded target exactly). An
    empty table stays empty.
    """
    df, names = number_columns(docs)
    out = _taken(df, names, weights, share, most, seed)
    return out.select(column_of(names, "doc_id").alias("doc_id"), column_of(names, "source").alias("source"),
                      F.col("_xsize").alias("size"), "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST_EPOCHS, seed=SEED,
                    length: str = "n_chars") -> DataFrame:
    """The mix itself: a row for each time a document is taken.

    Where a source's budget ends within a document, that copy holds its first
    words up to there (with the white space before them). ``length``, if the
    table has it, is set anew for it.
    """
    df, names = number_columns(docs)
    out = _taken(df, names, weights, share, most, seed)
    whole = F.floor(F.col("taken") / F.col("_xsize")).cast("int")
    part = F.col("taken") - whole * F.col("_xsize")
    copies = F.when(F.col("taken") > 0, F.concat(
        F.array_repeat(F.lit(-1).cast("long"), whole), F.filter(F.array(part), lambda p: p > 0)))
    text = column_of(names, "text")
    rows = out.withColumn("_xcopy", F.explode(copies))
    pieces = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*" + WORD_PATTERN), F.lit(0))
    new = F.when(F.col("_xcopy") < 0, text).otherwise(
        F.array_join(F.slice(pieces, F.lit(1), F.greatest(F.col("_xcopy"), F.lit(1)).cast("int")), ""))
    changed = {"text": new}
    if length in names and isinstance(docs.schema[length].dataType, T.IntegralType):
        changed[length] = F.when(F.col("_xcopy") < 0, column_of(names, length)).otherwise(
            F.length(new).cast(docs.schema[length].dataType))
    return restore_columns(rows, names, **changed)
