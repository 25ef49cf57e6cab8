"""Landed headline responses to topic messages, each URL once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from newslake.sources import headlines, topics
from newslake.streaming.batches import batch_tags
from newslake.streaming.late import without_repeats

REMEMBERED = "30 days"
RESPONSE = "language string, category string, body string"


def read_responses(
    spark: SparkSession, path: str, max_files: int | None = topics.FILES_PER_TRIGGER
) -> DataFrame:
    """Landed responses as a stream; each line has the request's language and
    category and the response body."""
    reader = spark.readStream.schema(RESPONSE)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def to_files(path: str) -> Callable[[DataFrame, str], None]:
    """Messages as lines of text, one folder per batch."""
    return lambda articles, tag: topics.publish_files(articles, f"{path}/batch={tag}", "overwrite")


def to_topic(options: dict[str, str], topic: str = topics.TOPIC) -> Callable[[DataFrame, str], None]:
    return lambda articles, tag: topics.publish(articles, options, topic)


def first_sent(articles: DataFrame, remembered: str = REMEMBERED) -> DataFrame:
    """Articles whose URL did not come within the time that is remembered, by
    the clock of the batches; and all without a URL, which can't be told apart.

    The URLs are state of the stream, on disk with ``build_session``: it grows
    with the URLs of that time, not with all there were, and is what a restart
    goes on from.
    """
    clock = "_fetched"
    named = articles.where("url is not null").withColumn(clock, F.current_timestamp())
    once = without_repeats(named, "url", clock, remembered).drop(clock)
    return once.unionByName(articles.where("url is null"))


def producer(
    responses: DataFrame,
    send: Callable[[DataFrame, str], None],
    checkpoint: str,
    remembered: str = REMEMBERED,
) -> DataStreamWriter:
    """Stream that sends the articles of new responses whose URL is new.

    A batch that fails is run again from the state before it, so its URLs are
    sent, again if need be.
    """
    tag_of = batch_tags(checkpoint)

    def step(batch: DataFrame, batch_id: int) -> None:
        send(batch, tag_of(batch.sparkSession, batch_id))

    fresh = first_sent(headlines.flattened(headlines.fetched(responses)), remembered)
    return fresh.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
