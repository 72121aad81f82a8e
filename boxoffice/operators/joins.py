"""Equi-join of a large table with the events, whose key may be hot.

One event can hold a large share of all orders (a festival night). A plain
shuffled join sends all of that event's orders to one task. Here the rows of a
hot event are spread over sub-keys by a hash of a column that varies within it
(the order id; a hash, not a random number, so a retried task sees the same
split), and the event's own row is repeated once per sub-key.

Hot is what holds more than a partition's fair share of the rows, as counted
when the tables were landed: fewer events than there are shuffle partitions
can be hot, so their list may be broadcast. An event gets as many sub-keys as
it holds fair shares; all others keep their one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hot_keys(sizes: DataFrame, key: str, rows: str, total: str, partitions: int) -> DataFrame:
    """(hot_key, hot_buckets) of keys with more than ``total / partitions`` rows; below ``partitions`` rows."""
    share = F.col(rows) * partitions / F.col(total)
    return sizes.filter(F.col(rows) * partitions > F.col(total)).select(
        F.col(key).alias("hot_key"), F.ceil(share).cast("int").alias("hot_buckets"))


def salted_join(big: DataFrame, dim: DataFrame, big_key: str, dim_key: str, spread_by: list[str],
                hot: DataFrame, how: str = "inner") -> DataFrame:
    """``big JOIN dim ON big_key = dim_key`` with the rows of the ``hot`` keys split.

    ``how`` is ``inner`` or ``left`` (rows of ``big`` are kept either way, each
    matching exactly the one copy of its dimension row in its bucket).
    """
    few = F.broadcast(hot)
    salt = F.when(F.col("hot_buckets").isNull(), 0).otherwise(F.pmod(F.xxhash64(*spread_by), F.col("hot_buckets")))
    b = big.join(few, big[big_key] == few.hot_key, "left").withColumn("_big_salt", salt.cast("int")).drop("hot_key", "hot_buckets")
    d = dim.join(few, dim[dim_key] == few.hot_key, "left").withColumn("_dim_salt", F.explode(F.sequence(
        F.lit(0), F.coalesce("hot_buckets", F.lit(1)) - 1))).drop("hot_key", "hot_buckets")
    cond: Column = (b[big_key] == d[dim_key]) & (b["_big_salt"] == d["_dim_salt"])
    return b.join(d, cond, how).drop("_big_salt", "_dim_salt")
