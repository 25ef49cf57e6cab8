"""Names in shared folders, by the file system that Spark uses for a path."""

from __future__ import annotations

from typing import Any

from pyspark.sql import SparkSession

# For JSON and text files that only Spark reads: it opens them by their ending.
COMPRESSED_TEXT = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
# For tables of whole texts.
COMPRESSED_TABLE = {"compression": "zstd"}


def _place(spark: SparkSession, path: str) -> tuple[Any, Any]:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _place(spark, path)
    return system.exists(place)


def names(spark: SparkSession, path: str) -> list[str]:
    """Folders directly below a folder; none if it does not exist."""
    system, place = _place(spark, path)
    if not system.exists(place):
        return []
    return [s.getPath().getName() for s in system.listStatus(place) if s.isDirectory()]


def listed(spark: SparkSession, path: str, suffix: str) -> list[str]:
    """Files directly in a folder."""
    system, place = _place(spark, path)
    found = [s.getPath().toString() for s in system.listStatus(place) if s.isFile()]
    return [f for f in found if f.endswith(suffix)]


def below(spark: SparkSession, path: str, suffix: str) -> list[str]:
    """Files at any depth below a folder, in order of their names."""
    system, place = _place(spark, path)
    found, walk = [], system.listFiles(place, True)
    while walk.hasNext():
        found.append(walk.next().getPath().toString())
    return sorted(f for f in found if f.endswith(suffix))


def make_folder(spark: SparkSession, path: str) -> None:
    system, place = _place(spark, path)
    system.mkdirs(place)


def remove(spark: SparkSession, path: str) -> None:
    system, place = _place(spark, path)
    system.delete(place, True)
