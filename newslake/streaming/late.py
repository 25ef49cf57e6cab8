"""Late data: counts per window and duplicates, with a watermark."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from newslake.sources import files, tables
from newslake.streaming.batches import batch_tags

SALTS = 64


def window_counts(stream: DataFrame, time: str, delay: str, width: str = "1 day") -> DataFrame:
    """Rows per closed time window; in append mode a window comes out once the
    watermark has passed its end."""
    counted = stream.withWatermark(time, delay).groupBy(F.window(time, width)).agg(
        F.count("*").alias("total_articles")
    )
    return counted.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "total_articles",
    )


def without_repeats(stream: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """First row per key among rows no further apart than ``delay``.

    Rows of a key are first thinned out per salt, the number of the input
    split, so a key that holds a large part of the stream is worked on by many
    tasks; the second step then sees at most ``SALTS`` rows of it.
    """
    salted = stream.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    return (
        salted.withWatermark(time, delay)
        .dropDuplicatesWithinWatermark([key, "_salt"])
        .dropDuplicatesWithinWatermark([key])
        .drop("_salt")
    )


def _reached(spark: SparkSession, notes: str, tag: str) -> dt.datetime | None:
    """The latest time that batches before this one had seen."""
    before = max((n for n in files.names(spark, notes) if n < f"batch={tag}"), default=None)
    return spark.read.schema("upto timestamp").json(f"{notes}/{before}").first().upto if before else None


def split_late(stream: DataFrame, time: str, delay: str, path: str, checkpoint: str) -> DataStreamWriter:
    """Stream that writes every row, those behind the watermark apart.

    A row is late if its time lies more than ``delay`` before the latest time of
    the batches before; windows and duplicate removals with that watermark would
    drop it in silence. The table at ``path`` has folders ``late=``, so that
    either kind is read without the other. Rows without a time are not late. The
    latest time comes out of the write itself, without another pass.
    """
    tag_of = batch_tags(checkpoint)
    notes = f"{path}/_latest"

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        tag = tag_of(spark, batch_id)
        before = _reached(spark, notes, tag)
        mark = F.lit(before).cast("timestamp") - F.expr(f"interval {delay}")
        seen = Observation()
        split = batch.withColumn("late", F.coalesce(F.col(time) < mark, F.lit(False)))
        watched = split.observe(seen, F.max(time).alias("upto"))
        watched.write.mode("overwrite").partitionBy("late").parquet(f"{path}/batch={tag}")
        upto = max((t for t in (before, seen.get["upto"]) if t is not None), default=None)
        note = spark.range(1).select(F.lit(upto).cast("timestamp").alias("upto"))
        note.coalesce(1).write.mode("overwrite").json(f"{notes}/batch={tag}")

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)


def read_split(spark: SparkSession, path: str, late: bool) -> DataFrame:
    return tables.read_inserted(spark, path).where(F.col("late") == late).drop("late")
