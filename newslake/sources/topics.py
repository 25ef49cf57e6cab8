"""Message topics: Kafka where its package is there, files otherwise."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from newslake.functions.messages import encode
from newslake.sources import files

# Fixed value: the name of the topic.
TOPIC = "raw_news"
# What a micro-batch takes at most; a first run over a long history is cut up.
OFFSETS_PER_TRIGGER = 1_000_000
FILES_PER_TRIGGER = 1000
_LOGIN = "org.apache.kafka.common.security.plain.PlainLoginModule"


def connection(servers: str, user: str | None = None, password: str | None = None) -> dict[str, str]:
    """Kafka options; with a user, SASL/PLAIN over TLS."""
    options = {"kafka.bootstrap.servers": servers}
    if user is not None:
        options |= {
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config": (
                f'{_LOGIN} required username="{user}" password="{password}";'
            ),
        }
    return options


def read_topic(
    spark: SparkSession,
    options: dict[str, str],
    topic: str = TOPIC,
    starting_offsets: str = "earliest",
    max_offsets: int | None = OFFSETS_PER_TRIGGER,
) -> DataFrame:
    """Topic as a stream with a binary ``value``; the starting offsets count
    on the first run only, later runs go on from the checkpoint."""
    reader = (
        spark.readStream.format("kafka")
        .options(**options)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    if max_offsets is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load()


def read_message_files(
    spark: SparkSession, path: str, max_files: int | None = FILES_PER_TRIGGER
) -> DataFrame:
    """Files of one message per line, at any depth, as the same kind of stream."""
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def publish(articles: DataFrame, options: dict[str, str], topic: str = TOPIC) -> None:
    """Send articles as keyless JSON messages."""
    messages = articles.select(encode(articles).alias("value"))
    messages.write.format("kafka").options(**options).option("topic", topic).save()


def publish_files(articles: DataFrame, path: str, mode: str = "append") -> None:
    """Messages as lines of text; compressed, because JSON is several times its texts' size."""
    messages = articles.select(encode(articles).alias("value"))
    messages.write.mode(mode).options(**files.COMPRESSED_TEXT).text(path)


def run(writer: DataStreamWriter, every: str | None = None):
    """Start a stream: drain what is there and stop, or repeat ``every`` so
    often (``"60 seconds"``)."""
    if every is None:
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        return query
    return writer.trigger(processingTime=every).start()
