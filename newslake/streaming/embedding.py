"""Vectors of new articles, load by load."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from newslake.functions.embedding import Embedder
from newslake.operators.approximate import HashTables
from newslake.operators.vectors import write_vectors
from newslake.sources import files, tables

FILES_PER_TRIGGER = 1000


def _content(spark: SparkSession, silver: str, load: str) -> str:
    """A name for the files that a load has now; files are never changed in place."""
    found = files.below(spark, f"{silver}/batch={load}", ".parquet")
    return hashlib.sha256("\n".join(found).encode()).hexdigest()


def vector_writer(
    spark: SparkSession,
    silver: str,
    path: str,
    checkpoint: str,
    factory: Callable[[], Embedder] | None = None,
    max_files: int = FILES_PER_TRIGGER,
    rejects: str | None = None,
    by: HashTables | None = None,
) -> DataStreamWriter:
    """Stream that embeds the loads added to Silver since its last run.

    New files only tell which loads are new. Each load is embedded whole, from
    its own folder, and its vectors replace those of the same load. So a load
    that Silver wrote again, or a micro-batch that is run again, leaves one
    vector per URL: Silver has each URL in one load. No join, no shuffle. Which
    files of a load were embedded is noted below ``path``, so that a load whose
    files come in several micro-batches is embedded once, unless it is changed.
    Articles that the model fails on go to ``rejects``, if given; with hash tables
    ``by``, keys are stored with the vectors.
    """
    schema = tables.scan(spark, silver).schema
    added = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(silver)

    def step(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        loads = [r.batch for r in batch.select("batch").distinct().collect()]
        for load in loads:
            content, noted = _content(session, silver, load), f"{path}/_embedded/{load}"
            if files.names(session, noted) == [content]:
                continue
            files.remove(session, noted)
            write_vectors(tables.read_batch(session, silver, load), path, load, factory, rejects, by)
            files.make_folder(session, f"{noted}/{content}")

    return added.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
