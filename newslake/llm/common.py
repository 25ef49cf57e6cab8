"""Helpers that the operators share."""

from __future__ import annotations

import sys
from collections.abc import Callable
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from newslake.session import shared_dir

# Sent along with the jobs: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


ROWS_PER_BATCH = 1000


def to_python(texts: DataFrame) -> DataFrame:
    """The table, whose whole texts are about to go to Python: from now on the
    session sends no more than ``ROWS_PER_BATCH`` rows at a time, or what was
    set before if that is less. Spark's default of ten thousand long texts takes
    its place several times over, in the JVM and in every worker."""
    conf, key = texts.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(conf.get(key))
    if now <= 0 or now > ROWS_PER_BATCH:
        conf.set(key, ROWS_PER_BATCH)
    return texts


def once_per_worker(key: tuple, make: Callable[[], Any]) -> Any:
    """What ``make`` returns, kept as long as the Python worker lives."""
    kept = sys.__dict__.setdefault("_newslake_kept", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


def unused(df: DataFrame, stem: str) -> str:
    """A column name that the table doesn't have, in any letter case."""
    taken = {c.lower() for c in df.columns}
    while stem in taken:
        stem += "_"
    return stem


def checkpointed(df: DataFrame) -> DataFrame:
    """The table, computed now and stored in the shared checkpoint folder."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        root = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(root or shared_dir(df.sparkSession, "checkpoints"))
    return df.checkpoint()
