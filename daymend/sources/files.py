"""Folders and files of the shared storage, through the file system that Spark itself uses for a path.

Listings and deletions of whole folders are calls of the driver and no Spark jobs; file contents are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

_CALLS = 16  # deletions at a time


def _opened(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _opened(spark, path)
    return bool(system.exists(where))


def entries(spark: SparkSession, path: str) -> Iterator[tuple[str, str, bool]]:
    """Name, path and whether it is a folder of each entry directly below a folder; hidden ones and a missing folder give none."""
    system, where = _opened(spark, path)
    if not system.exists(where):
        return
    for entry in system.listStatus(where):
        name = entry.getPath().getName()
        if not name.startswith((".", "_")):
            yield name, entry.getPath().toString(), bool(entry.isDirectory())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file with a given name, as markers are."""
    system, where = _opened(spark, path)
    out = system.create(where, True)
    out.write(bytearray(text.encode()))
    out.close()


def delete(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete folders with all they hold; what is missing already is no error."""
    def gone(path: str) -> None:
        system, where = _opened(spark, path)
        system.delete(where, True)

    with ThreadPoolExecutor(_CALLS) as pool:
        list(pool.map(gone, paths))


def replace(spark: SparkSession, moves: Iterable[tuple[str, str]]) -> None:
    """Put folders in the place of others: (from, to). What is not there any more was moved by a run that died, and stays."""
    def moved(pair: tuple[str, str]) -> None:
        system, source = _opened(spark, pair[0])
        _, target = _opened(spark, pair[1])
        if system.exists(source):
            system.mkdirs(target.getParent())
            system.delete(target, True)
            if not system.rename(source, target):
                raise OSError(f"{pair[0]} could not be moved to {pair[1]}")

    with ThreadPoolExecutor(_CALLS) as pool:
        list(pool.map(moved, moves))


def drops(spark: SparkSession, folder: str) -> Iterator[tuple[str, str]]:
    """Name and path of each daily drop: a file or folder ``<name>.csv`` (also ``key=<name>.csv``), at any depth.

    Folders that are drops are not listed, so the cost is that of the drops and not of their part files.
    """
    for name, path, is_folder in entries(spark, folder):
        if name.endswith(".csv"):
            yield name[:-4].rsplit("=", 1)[-1], path
        elif is_folder:
            yield from drops(spark, path)
