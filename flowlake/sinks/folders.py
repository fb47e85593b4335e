"""Folders of tables: listing, moving and removing them through Hadoop's file systems."""

from __future__ import annotations

from pyspark.sql import SparkSession

DONE = "_SUCCESS"


def _open(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def children(spark: SparkSession, path: str, prefix: str = "") -> list[str]:
    """Names right below ``path`` that begin with ``prefix``, without it; none where there is no folder."""
    system, place = _open(spark, path)
    if not system.exists(place):
        return []
    names = sorted(status.getPath().getName() for status in system.listStatus(place))
    return [name[len(prefix):] for name in names if name.startswith(prefix)]


def numbered(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers of the folders ``<prefix><number>`` below ``path``, ascending."""
    return sorted(int(name) for name in children(spark, path, prefix))


def is_whole(spark: SparkSession, path: str) -> bool:
    """Whether the job that wrote this folder came to its end."""
    system, place = _open(spark, f"{path}/{DONE}")
    return system.exists(place)


def make(spark: SparkSession, path: str) -> None:
    system, place = _open(spark, path)
    system.mkdirs(place)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder with all below it; nothing where there is none."""
    system, place = _open(spark, path)
    system.delete(place, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Put the folder ``source`` in the place of ``target``. A rename, where the store has it."""
    system, place = _open(spark, source)
    _, new = _open(spark, target)
    system.delete(new, True)
    system.mkdirs(new.getParent())
    if not system.rename(place, new):
        raise OSError(f"cannot move {source} to {target}")


def stamp_in_order(spark: SparkSession, path: str) -> None:
    """Give the files of a folder modification times in the order of their names.

    A file stream takes older files first, and tasks end in any order.
    """
    system, place = _open(spark, path)
    files = sorted((s for s in system.listStatus(place) if s.isFile()), key=lambda s: s.getPath().getName())
    newest = max((s.getModificationTime() for s in files), default=0)
    for i, status in enumerate(files):
        system.setTimes(status.getPath(), newest - 1000 * (len(files) - i), -1)
