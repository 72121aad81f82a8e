"""Numbers of rows in a global order, without a window over one partition.

Rows are range-sorted and written once with their place in their partition;
the partitions' counts, one row each, give the offsets.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxoffice.session import checkpoint_dir

# monotonically_increasing_id(): the partition above, the place within it below.
PLACE_BITS = 33


def numbered(df: DataFrame, order: list[str | Column], name: str = "row_no") -> DataFrame:
    """``df`` with its rows numbered from 1 in ``order``; rows equal in ``order`` in any order."""
    spark = df.sparkSession
    at = os.path.join(checkpoint_dir(spark), f"ordinals-{uuid.uuid4().hex[:12]}")
    df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()).write.parquet(at)
    rows = spark.read.parquet(at).withColumn("_part", F.shiftright("_id", PLACE_BITS))
    offsets, before = [], 0
    for part, n in sorted(rows.groupBy("_part").count().collect()):  # a row per shuffle partition
        offsets.append((part, before))
        before += n
    offset = spark.createDataFrame(offsets, "_part long, _before long")
    place = F.col("_id").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return rows.join(F.broadcast(offset), "_part").withColumn(name, F.col("_before") + place + 1).drop("_id", "_part", "_before")
