"""A small table kept as a log of changes.

Every version is a folder of its own, written once; a version written again (a
retried batch) replaces itself. The table's state is the last change of each
key, or of each attribute of a key. ``fold`` writes the state as a folder that
stands for everything up to its version and removes what it replaces, so the
log does not grow with the number of versions. A fold counts from its success
mark on; until then the older folders stay, so a job that stops in between
loses nothing.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxoffice.sources.files import exists, folders_in, remove_all

VERSION = "version"
# Folders of a log before ``append`` folds it.
MOST_FOLDERS = 24


def _folders(spark: SparkSession, at: str) -> tuple[dict[int, str], dict[int, str]]:
    """Folders of changes and of folds, by version; only those written to the end."""
    changes, folds = {}, {}
    for name, _ in folders_in(spark, at):
        m = re.fullmatch(r"(changes|fold)-(\d+)", name)
        if m and exists(spark, f"{at}/{name}/_SUCCESS"):
            (changes if m[1] == "changes" else folds)[int(m[2])] = f"{at}/{name}"
    return changes, folds


def last_version(spark: SparkSession, at: str) -> int:
    """The newest version of the log; -1 of one that is empty."""
    changes, folds = _folders(spark, at)
    return max([*changes, *folds, -1])


def entries(spark: SparkSession, at: str, schema: T.StructType, before: int | None = None) -> DataFrame:
    """All changes (with their ``version``) that the log still holds, of versions below ``before``."""
    changes, folds = _folders(spark, at)
    below = lambda v: before is None or v < before
    base = max((v for v in folds if below(v)), default=-1)
    paths = [folds[base]] if base >= 0 else []
    paths += [path for v, path in sorted(changes.items()) if v > base and below(v)]
    full = T.StructType([*schema.fields, T.StructField(VERSION, T.LongType())])
    return spark.read.schema(full).parquet(*paths) if paths else spark.createDataFrame([], full)


def append(rows: DataFrame, at: str, version: int | None = None) -> int:
    """Write ``rows`` as ``version`` (the next one, if none is given); returns it."""
    spark = rows.sparkSession
    if version is None:
        version = last_version(spark, at) + 1
    rows.withColumn(VERSION, F.lit(version).cast("long")).write.mode("overwrite").parquet(f"{at}/changes-{version}")
    return version


def latest(log: DataFrame, *key: str) -> DataFrame:
    """The last change of each key, with its ``version``; combines map-side."""
    rest = [c for c in log.columns if c not in key]
    return log.groupBy(*key).agg(F.max_by(F.struct(*rest), VERSION).alias("s")).select(*key, "s.*")


def fold(spark: SparkSession, at: str, schema: T.StructType, state, upto: int | None = None, most: int | None = None) -> bool:
    """Fold the versions up to ``upto`` (all) if they have more than ``most`` folders.

    ``state`` makes the rows to keep (with their ``version``) of the entries. A
    stream folds what lies before its running batch only, so that the batch can
    be run again from the same state.
    """
    changes, folds = _folders(spark, at)
    upto = max([*changes, *folds, -1]) if upto is None else upto
    old = [p for v, p in changes.items() if v <= upto] + [p for v, p in folds.items() if v < upto]
    if len(old) <= (MOST_FOLDERS if most is None else most) or upto in folds:
        return False
    state(entries(spark, at, schema, upto + 1)).write.mode("overwrite").parquet(f"{at}/fold-{upto}")
    remove_all(spark, old)
    return True
