"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
import pathlib
import re
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxoffice.operators.joins import hot_keys, salted_join

# A word is a run of anything but ASCII white space; bytes.split() splits exactly there.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

# Rows per Arrow batch: bounds what one Python worker holds when texts are long.
ARROW_ROWS = 256

_SENT: set[str] = set()  # applications whose workers have been sent the package


def prepare(spark: SparkSession) -> None:
    """Settings of the session, and this package for its Python workers if their path lacks it."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    package = pathlib.Path(__file__).parents[1]
    sc = spark.sparkContext
    if sc.applicationId in _SENT or str(package.parent) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    _SENT.add(sc.applicationId)
    archive = pathlib.Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"  # the driver serves it
    with zipfile.ZipFile(archive, "w") as out:
        for f in sorted(package.rglob("*.py")):
            out.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(archive))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` below ``sf_dir`` (any file system Spark reads)."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the columns ``names``, by exact name (the first, if a name repeats).

    Extra columns whose names clash (also in another case) do no harm.
    """
    place = {n: df.columns.index(n) for n in names}
    return df.toDF(*[f"_c{i}" for i in range(len(df.columns))]).select(
        *[F.col(f"_c{i}").alias(n) for n, i in place.items()])


def number_columns(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """``df`` with its columns renamed ``_c0 ...``, and the old names in order.

    Operators that add columns to a whole table work on the renamed one, so
    that nothing in it can clash with their own names (``_x...``).
    """
    return df.toDF(*[f"_c{i}" for i in range(len(df.columns))]), list(df.columns)


def column_of(names: list[str], name: str) -> Column:
    """The column ``name`` of a table renamed by ``number_columns``."""
    return F.col(f"_c{names.index(name)}")


def restore_columns(df: DataFrame, names: list[str], **changed: Column) -> DataFrame:
    """Undo ``number_columns``; ``changed`` replaces columns by name."""
    first = {n: names.index(n) for n in changed}
    return df.select(*[(changed[n] if first.get(n) == i else F.col(f"_c{i}")).alias(f"_c{i}")
                       for i, n in enumerate(names)]).toDF(*names)


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder.

    The folder is the session's ``spark.checkpoint.dir``. Only a local session
    without that setting (tests) gets a folder of its own.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not re.match(r"local(\[|$)", sc.master):
                raise RuntimeError("spark.checkpoint.dir must name a shared folder")
            folder = tempfile.mkdtemp(prefix="corpus-checkpoint-")
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def join_classes(rows: DataFrame, classes: DataFrame, key: str, count: str, spread_by: list[str], how: str = "inner") -> DataFrame:
    """``rows`` joined with the one row that ``classes`` has for their ``key``.

    ``count`` in ``classes``: how many rows have the key. The rows of keys with
    more than a shuffle partition's fair share are spread over several tasks;
    there are fewer such keys than partitions. ``classes`` should be a written
    table, as it is read three times.
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = classes.agg(F.sum(count)).first()[0] or 0
    hot = hot_keys(classes.withColumn("_xtotal", F.lit(total).cast("long")), key, count, "_xtotal", partitions)
    return salted_join(rows, classes.withColumnRenamed(key, "_xkey"), key, "_xkey", spread_by, hot, how).drop("_xkey")


def vocabulary_path(name: str) -> str:
    """The file of a public tokenizer; $TOKENIZER_DIR overrides its place."""
    folder = os.environ.get("TOKENIZER_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)
