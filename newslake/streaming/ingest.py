"""Topic messages to the raw article table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from newslake.functions.messages import decode, rejected, stamp


def raw_articles(messages: DataFrame, keep_raw: bool = False) -> DataFrame:
    """Decoded messages with their arrival time; stateless, batch or stream."""
    return stamp(decode(messages, keep_raw))


def reject_writer(messages: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append the payloads that are no articles to a table of their own."""
    return bronze_writer(stamp(rejected(messages)), path, checkpoint)


def bronze_writer(
    articles: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", by_day: bool = False
) -> DataStreamWriter:
    """Append to the raw table; the checkpoint makes restarts exact. With
    ``by_day``, there is a folder, and a column, ``ingest_day`` per day of
    arrival, and a question about some days opens only theirs."""
    if by_day:
        dated = articles.withColumn("ingest_day", F.to_date("ingested_at"))
        return bronze_writer(dated, path, checkpoint, fmt).partitionBy("ingest_day")
    return (
        articles.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
    )
