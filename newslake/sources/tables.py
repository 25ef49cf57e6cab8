"""Stored tables: scans, inserts of new keys, and replaced snapshots.

Two layouts, both plain Spark datasets:

* insert-only: one folder ``batch=<tag>`` per load. A load that is repeated
  under the same tag replaces its own folder and nothing else. ``_seen`` below
  the table lists its keys by bucket, see ``newslake.sources.seen``.
* replaced: every version is a new folder below ``data/``; a one-row file
  below ``published/`` makes it current. Two such files are written in turn,
  so the one that counts is never touched and readers never see a half-written
  version. Publishing removes all older folders but the one before, for its
  readers. A table that is kept up by key (``upsert``) is cut into buckets of
  keys; a version holds only those that it changes, and its file names the
  version that holds each bucket.

One writer per table at a time is assumed.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from newslake.operators.merge import require_unique, unmatched, unmatched_in_large
from newslake.sources import files, seen

_PUBLISHED = (
    "version long, folder string, batch string, applied map<string, long>, "
    "schema string, bucket_count int, buckets map<string, string>"
)
_BUCKET = "_bucket"
BUCKETS = 64
_STREAM_BATCH = "stream-(.*)-([0-9]+)"


def scan(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None
) -> DataFrame:
    """A stored table; with a schema, no file is opened to find it out."""
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema else reader).load(path)


def scan_sql(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The same scan as SQL, by path."""
    return spark.sql(f"select * from {fmt}.`{path}`")


def scan_if_exists(
    spark: SparkSession, path: str, schema: StructType | None = None
) -> DataFrame | None:
    return scan(spark, path, schema=schema) if files.exists(spark, path) else None


# Insert-only tables


def read_inserted(spark: SparkSession, path: str, keep_batch: bool = False) -> DataFrame:
    """Rows of an insert-only table, with the tag of their load if asked for."""
    rows = scan(spark, path)
    return rows.withColumn("batch", F.col("batch").cast("string")) if keep_batch else rows.drop("batch")


def stream_batch(tag: str | None) -> tuple[str, int] | None:
    """Stream and number of a micro-batch's tag; none for other loads."""
    found = re.fullmatch(_STREAM_BATCH, tag or "")
    return (found[1], int(found[2])) if found else None


def last_batches(rows: DataFrame) -> dict[str, int]:
    """Per stream, the highest micro-batch among rows with their ``batch``."""
    part = lambda i: F.regexp_extract("batch", f"^{_STREAM_BATCH}$", i)
    named = rows.where(F.col("batch").rlike(f"^{_STREAM_BATCH}$"))
    per_stream = named.groupBy(part(1).alias("stream")).agg(F.max(part(2).cast("long")).alias("n"))
    return {r.stream: r.n for r in per_stream.collect()}


def new_tag() -> str:
    return f"load-{uuid.uuid4().hex}"


def read_batch(
    spark: SparkSession, path: str, batch: str, schema: StructType | None = None
) -> DataFrame:
    return scan(spark, f"{path}/batch={batch}", schema=schema)


def by_day(spark: SparkSession, path: str) -> bool | None:
    """Whether an insert-only table is laid out in days; unknown without rows."""
    for load in files.names(spark, path):
        if load.startswith("batch="):
            if any(name.startswith("day=") for name in files.names(spark, f"{path}/{load}")):
                return True
            if files.listed(spark, f"{path}/{load}", ".parquet"):
                return False
    return None


def _list_loads(spark: SparkSession, path: str, keys: Sequence[str], but: str) -> bool:
    """Put loads on the list of keys that are not there yet, as after a crash;
    whether there is any other load."""
    loads = {n.removeprefix("batch=") for n in files.names(spark, path) if n.startswith("batch=")} - {but}
    for load in sorted(loads - seen.added(spark, f"{path}/_seen")):
        if by_day(spark, path) is not None:
            seen.add(read_batch(spark, path, load), f"{path}/_seen", keys, load)
    return bool(loads)


def insert_new(
    src: DataFrame,
    path: str,
    keys: Sequence[str],
    batch: str | None = None,
    small_batch: bool = False,
    day: Column | None = None,
    watch: tuple[Observation, Sequence[Column]] | None = None,
) -> str:
    """Add the rows whose key is not stored yet; stored rows never change.

    ``src`` has one row per key, and no null key. Rows of an earlier attempt
    at the same batch do not count as stored. ``small_batch`` says that
    ``src`` is cached and small beside the table; then only the buckets of keys
    are opened that it touches. With ``day``, the load is laid
    out in folders ``day=``, one file each unless a day is large, and the table
    has that column. ``watch`` takes counts of the rows that are written, in the
    job that writes them. Returns the batch tag.
    """
    spark = src.sparkSession
    batch = batch or new_tag()
    schema = src.schema
    if _list_loads(spark, path, keys, batch):
        others = seen.lookup(src, f"{path}/_seen", keys, batch, everywhere=not small_batch)
        pick = unmatched_in_large if small_batch else unmatched
        src = pick(src, others, keys, null_safe=False)
    seen.forget(spark, f"{path}/_seen", batch)
    if watch:
        src = src.observe(watch[0], *watch[1])
    writer = src.write
    if day is not None:
        writer = src.withColumn("day", day).hint("rebalance", "day").write.partitionBy("day")
    writer.mode("overwrite").options(**files.COMPRESSED_TABLE).parquet(f"{path}/batch={batch}")
    seen.add(read_batch(spark, path, batch, schema), f"{path}/_seen", keys, batch)
    return batch


# Replaced tables


def current(spark: SparkSession, path: str) -> Row | None:
    """Version, folder, batch and applied micro-batches of the published
    snapshot, if any."""
    if not files.exists(spark, f"{path}/published"):
        return None
    reader = spark.read.schema(_PUBLISHED).option("ignoreMissingFiles", "true")
    log = reader.json(f"{path}/published")
    return log.orderBy(F.desc("version")).first()


def read_snapshot(spark: SparkSession, path: str, part: str = "") -> DataFrame:
    now = current(spark, path)
    if now is None:
        raise FileNotFoundError(f"no published snapshot at {path}")
    return read_part(spark, path, now, part)


def _read_buckets(spark: SparkSession, path: str, now: Row, buckets: Iterable[str] | None = None) -> DataFrame:
    """Rows of some or all buckets; no other is opened."""
    schema = StructType.fromJson(json.loads(now.schema))
    wanted = now.buckets.keys() if buckets is None else now.buckets.keys() & set(buckets)
    places = [f"{path}/data/{now.buckets[b]}/{b}" for b in sorted(wanted)]
    return spark.read.schema(schema).parquet(*places) if places else spark.createDataFrame([], schema)


def read_part(
    spark: SparkSession, path: str, now: Row, part: str = "", schema: StructType | None = None
) -> DataFrame:
    if now.schema:
        return _read_buckets(spark, path, now)
    return scan(spark, f"{path}/data/{now.folder}/{part}", schema=schema)


def has_applied(now: Row | None, batch: str | None) -> bool:
    """Whether the snapshot already holds what a batch brings."""
    told = stream_batch(batch)
    if not now or batch is None:
        return False
    if told is None:
        return now.batch == batch
    return (now.applied or {}).get(told[0], -1) >= told[1]


def publish(
    parts: dict[str, DataFrame | Callable[[str], None]],
    path: str,
    now: Row | None,
    batch: str | None = None,
    covered: Mapping[str, int] | None = None,
    spark: SparkSession | None = None,
) -> int:
    """Write the snapshot after ``now`` and make it current.

    The parts, tables or functions that write one to a place, are written side
    by side and become current together. With the
    snapshot goes, per stream, the highest micro-batch that it holds: those of
    ``now``, that of ``batch``, and those that are ``covered``.
    """
    version = now.version + 1 if now else 1
    folder = f"v{version:06d}-{uuid.uuid4().hex}"

    def write(part: str) -> None:
        place, rows = f"{path}/data/{folder}/{part}", parts[part]
        if callable(rows):
            rows(place)
        else:
            rows.write.mode("errorifexists").parquet(place)

    with ThreadPoolExecutor(len(parts)) as pool:
        list(pool.map(write, parts))
    spark = spark or next(iter(parts.values())).sparkSession
    _announce(spark, path, now, folder, batch, covered)
    return version


def _announce(
    spark: SparkSession,
    path: str,
    now: Row | None,
    folder: str,
    batch: str | None,
    covered: Mapping[str, int] | None = None,
    schema: StructType | None = None,
    bucket_count: int | None = None,
    buckets: dict[str, str] | None = None,
) -> None:
    """Make a written version current, and remove what neither it nor the one
    before needs."""
    applied = dict((now.applied if now else None) or {})
    told = stream_batch(batch)
    for stream, n in [*(covered or {}).items(), *([told] if told else [])]:
        applied[stream] = max(n, applied.get(stream, -1))
    version = now.version + 1 if now else 1
    fields = {
        "version": version, "folder": folder, "batch": batch, "applied": applied,
        "schema": schema.json() if schema else None, "bucket_count": bucket_count, "buckets": buckets,
    }
    entry = spark.range(0, 1, numPartitions=1).select(
        F.from_json(F.lit(json.dumps(fields)), _PUBLISHED).alias("entry")
    )
    entry.select("entry.*").write.mode("overwrite").json(f"{path}/published/slot={version % 2}")
    before = (now.buckets if now else None) or {}
    held = {folder, now.folder if now else folder, *before.values(), *(buckets or {}).values()}
    for name in files.names(spark, f"{path}/data"):
        if name not in held:
            files.remove(spark, f"{path}/data/{name}")
        elif buckets:
            needed = {b for b, f in [*before.items(), *buckets.items()] if f == name}
            for bucket in files.names(spark, f"{path}/data/{name}"):
                if bucket.startswith(_BUCKET) and bucket not in needed:
                    files.remove(spark, f"{path}/data/{name}/{bucket}")


def upsert_parts(
    parts: dict[str, tuple[DataFrame, Sequence[str]]],
    path: str,
    batch: str | None = None,
    covered: Mapping[str, int] | None = None,
) -> int:
    """Update rows with a known key, insert the others, in every part.

    ``parts`` gives the source and its key columns. A source with two rows for
    one key fails the job. A batch that the snapshot holds is not applied again.
    """
    spark = next(src for src, _ in parts.values()).sparkSession
    now = current(spark, path)
    if has_applied(now, batch):
        return now.version

    def writer(part: str) -> Callable[[str], None]:
        src, keys = parts[part]

        def write(place: str) -> None:
            # Once written, the source is read again for its keys only.
            src.write.mode("errorifexists").parquet(place)
            fresh = scan(spark, place, schema=src.schema)
            require_unique(fresh, keys)
            if now:
                old = read_part(spark, path, now, part, src.schema)
                unmatched(old, fresh, keys).write.mode("append").parquet(place)

        return write

    writers = {part: writer(part) for part in parts}
    return publish(writers, path, now, batch, covered, spark)


def upsert(
    src: DataFrame,
    path: str,
    keys: Sequence[str],
    batch: str | None = None,
    buckets: int = BUCKETS,
    by: Sequence[str] = (),
    merged: Callable[[DataFrame], DataFrame] | None = None,
) -> int:
    """Update rows with a known key, insert the others, in a table of its own.

    Only the buckets that the source has keys in are read and written; their
    number is fixed by the first load. Buckets are those of the key, or of the
    part of it that ``by`` names, such as a date, so that a load of some days
    touches few. ``merged`` makes one row per key of stored and new rows, where a
    new row doesn't replace the stored one. Otherwise as ``upsert_parts``.
    """
    spark = src.sparkSession
    now = current(spark, path)
    if has_applied(now, batch):
        return now.version
    version = now.version + 1 if now else 1
    count = (now.bucket_count if now else None) or buckets
    bucket = seen.bucket_of(by or keys, count)
    folder = f"v{version:06d}-{uuid.uuid4().hex}"
    place = f"{path}/data/{folder}"

    def write(rows: DataFrame, mode: str) -> list[str]:
        dealt = rows.withColumn(_BUCKET, bucket)
        dealt.repartition(_BUCKET).write.mode(mode).partitionBy(_BUCKET).parquet(place)
        return [name for name in files.names(spark, place) if name.startswith(_BUCKET)]

    def stored(touched: list[str]) -> DataFrame:
        # A table of one piece goes into buckets once.
        return read_part(spark, path, now) if now.schema is None else _read_buckets(spark, path, now, touched)

    if merged:
        found = src.select(bucket.alias("bucket")).distinct().collect()
        if now:
            src = merged(stored([f"{_BUCKET}={r.bucket}" for r in found]).unionByName(src))
        written = write(src, "errorifexists")
    else:
        written = write(src, "errorifexists")
        if written:
            # Once written, the source is read again for its keys only.
            fresh = spark.read.schema(src.schema).parquet(*(f"{place}/{b}" for b in written))
            require_unique(fresh, keys)
            if now:
                written = write(unmatched(stored(written), fresh, keys), "append")
        elif now and now.schema is None:
            written = write(read_part(spark, path, now), "append")
    held = ((now.buckets if now else None) or {}) | {b: folder for b in written}
    schema = StructType([StructField(f.name, f.dataType) for f in src.schema])
    _announce(spark, path, now, folder, batch, None, schema, count, held)
    return version


def verify(spark: SparkSession, path: str, rows: int = 5) -> tuple[int, list[Row]]:
    """Row count and a few rows of a stored table, for a look after a load."""
    stored = scan(spark, path)
    return stored.count(), stored.limit(rows).collect()
