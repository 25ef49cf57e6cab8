"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_unset_roots: dict[str, str] = {}


def build_session(app: str = "newslake", **conf: str) -> SparkSession:
    """Session with the settings the jobs rely on.

    Shuffle width is left to the cluster (or ``conf``): adaptive execution
    merges small partitions and splits skewed join partitions at run time.
    Stream state is kept on disk, so it may outgrow an executor's memory.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared ``spark.checkpoint.dir``.

    A local session without that setting gets a folder of its own; on a
    cluster the setting is required, because executors must all see the files.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        app = spark.conf.get("spark.app.id")
        root = _unset_roots.get(app) or _unset_roots.setdefault(
            app, tempfile.mkdtemp(prefix="newslake-")
        )
    return f"{root.rstrip('/')}/newslake/{name}-{uuid.uuid4().hex}"
