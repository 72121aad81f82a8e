"""File listings through Spark's file systems (any store that Spark reads)."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

# Requests to a store that are under way at once.
AT_ONCE = 16


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p)


def files_below(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(name below ``path``, size, time of change) of a file, or of all files of a folder; sorted."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return []
    out, it = [], fs.listFiles(p, True)
    while it.hasNext():
        f = it.next()
        out.append((f.getPath().toString().split(p.getName(), 1)[-1], f.getLen(), f.getModificationTime()))
    return sorted(out)


def folders_in(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, time of change) of the folders directly in ``path``."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [(f.getPath().getName(), f.getModificationTime()) for f in fs.listStatus(p) if f.isDirectory()]


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, written at once."""
    p, fs = _fs(spark, path)
    fs.create(p, True).close()


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library has made."""
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def remove_all(spark: SparkSession, paths: list[str]) -> None:
    """``remove`` of many folders, several at once."""
    with ThreadPoolExecutor(AT_ONCE) as pool:
        list(pool.map(lambda p: remove(spark, p), paths))


def existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those of ``paths`` that are there; several requests at once."""
    with ThreadPoolExecutor(AT_ONCE) as pool:
        return [p for p, there in zip(paths, pool.map(lambda p: exists(spark, p), paths)) if there]


def matching(spark: SparkSession, patterns: list[str]) -> list[str]:
    """The folders that a glob pattern matches; several requests at once."""
    def one(pattern: str) -> list[str]:
        p, fs = _fs(spark, pattern)
        return [f.getPath().toString() for f in fs.globStatus(p) or []]

    with ThreadPoolExecutor(AT_ONCE) as pool:
        return sorted({x for found in pool.map(one, patterns) for x in found})


def name_files(spark: SparkSession, names: dict[str, str]) -> None:
    """Give the one part file of each folder the name that ``names`` has for it; several at once."""
    def rename(item: tuple[str, str]) -> None:
        p, fs = _fs(spark, item[0])
        for f in fs.listStatus(p) if fs.exists(p) else []:
            if f.getPath().getName().startswith("part-"):
                fs.rename(f.getPath(), spark._jvm.org.apache.hadoop.fs.Path(p, item[1]))

    with ThreadPoolExecutor(AT_ONCE) as pool:
        list(pool.map(rename, names.items()))
