"""Keys that were seen, in folders by bucket of their hash.

A lookup opens only the folders of the buckets that a batch touches, whose
numbers, bounded by the number of buckets, come to the driver; so its cost
follows the batch where batches are small, and a batch that touches all of them
reads the keys once. Every row has the tag of the batch that brought it, and of
the attempt: what earlier attempts at a batch added doesn't count. Files are
only added; a folder of many files is written anew as one, and its old files go
afterwards, which a crash between leaves as repeated keys, not as lost ones.

The number of buckets is chosen with ``create``, or ``BUCKETS``, and stays: about
as many as give each some million keys in the end.

Beside ``keys`` there are empty folders that say what counts: ``begun`` has the
attempts of each batch, ``stale`` those that were followed by another, and
``added`` the batches that are completely on the list.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from newslake.sources import files

BUCKETS = 64
MOST_FILES = 32


def create(spark: SparkSession, path: str, buckets: int = BUCKETS) -> None:
    """An empty list; not needed unless the number of buckets is another."""
    files.make_folder(spark, f"{path}/buckets/{buckets}")


def _buckets(spark: SparkSession, path: str) -> int:
    if not (told := files.names(spark, f"{path}/buckets")):
        create(spark, path)
    return int(told[0]) if told else BUCKETS


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def touched(rows: DataFrame, keys: Sequence[str], buckets: int) -> list[int]:
    """The buckets of the rows; at most ``buckets`` numbers."""
    found = rows.select(bucket_of(keys, buckets).alias("bucket")).distinct().collect()
    return sorted(r.bucket for r in found)


def _folders(spark: SparkSession, path: str, buckets: Iterable[int] | None = None) -> list[str]:
    there = set(files.names(spark, f"{path}/keys"))
    wanted = there if buckets is None else {f"bucket={b}" for b in buckets}
    return [f"{path}/keys/{name}" for name in sorted(there & wanted)]


def lookup(
    rows: DataFrame,
    path: str,
    keys: Sequence[str],
    tag: str,
    everywhere: bool = False,
) -> DataFrame:
    """Keys that other batches have put on the list, from the buckets that the
    rows touch. The rows are read to know these, so the caller caches them, or
    says that they are ``everywhere``."""
    spark = rows.sparkSession
    marks = [StructField(c, StringType()) for c in ("batch", "attempt")]
    schema = StructType([*(rows.schema[k] for k in keys), *marks])
    folders = _folders(spark, path, None if everywhere else touched(rows, keys, _buckets(spark, path)))
    if not folders:
        return spark.createDataFrame([], schema).select(*keys)
    stored = spark.read.schema(schema).parquet(*folders).where(F.col("batch") != tag)
    return _counting(spark, path, stored).select(*keys)


def _counting(spark: SparkSession, path: str, stored: DataFrame) -> DataFrame:
    """Without attempts that were followed by another; repeated batches are rare."""
    stale = files.names(spark, f"{path}/stale")
    return stored.where(~F.col("attempt").isin(stale)) if stale else stored


def add(rows: DataFrame, path: str, keys: Sequence[str], tag: str) -> None:
    """Put the rows' keys on the list, in place of all that earlier attempts at
    the batch put there; one file per bucket that they touch. Each time another
    ``MOST_FILES`` batches are listed, folders of more files are compacted."""
    spark = rows.sparkSession
    attempt = uuid.uuid4().hex
    for before in files.names(spark, f"{path}/begun/{tag}"):
        files.make_folder(spark, f"{path}/stale/{before}")
    files.make_folder(spark, f"{path}/begun/{tag}/{attempt}")
    buckets = _buckets(spark, path)
    new = rows.select(
        *keys, F.lit(tag).alias("batch"), F.lit(attempt).alias("attempt"), bucket_of(keys, buckets).alias("bucket")
    )
    new.repartition("bucket").write.mode("append").partitionBy("bucket").parquet(f"{path}/keys")
    files.make_folder(spark, f"{path}/added/{tag}")
    if len(added(spark, path)) % MOST_FILES == 0:
        compact(spark, path, MOST_FILES)


def added(spark: SparkSession, path: str) -> set[str]:
    """Tags of the batches that are completely on the list."""
    return set(files.names(spark, f"{path}/added"))


def forget(spark: SparkSession, path: str, tag: str) -> None:
    """A batch is about to be written again: until then it isn't complete."""
    files.remove(spark, f"{path}/added/{tag}")


def compact(spark: SparkSession, path: str, most: int = MOST_FILES) -> int:
    """Write folders of more than ``most`` files anew, as one file each; how
    many there were. Not while another job adds to the list."""
    full = {f: listed for f in _folders(spark, path) if len(listed := files.listed(spark, f, ".parquet")) > most}
    if full:
        old = [file for listed in full.values() for file in listed]
        whole = _counting(spark, path, spark.read.option("basePath", f"{path}/keys").parquet(*old)).distinct()
        whole.repartition("bucket").write.mode("append").partitionBy("bucket").parquet(f"{path}/keys")
        for file in old:
            files.remove(spark, file)
    return len(full)
