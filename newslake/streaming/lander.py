"""Topic messages to the JSON landing area, each URL once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import DataStreamWriter

from newslake.functions.messages import decode
from newslake.operators.refine import usable
from newslake.sources import landing
from newslake.sources import seen as index
from newslake.streaming.batches import batch_tags
from newslake.streaming.once import new_urls, remember


def remember_landed(landed: DataFrame, seen: str) -> None:
    """Start the list of seen URLs from objects landed earlier."""
    if not index.added(landed.sparkSession, seen):
        remember(landing.stored_urls(landed), seen, "landed-earlier")


def lander(
    messages: DataFrame,
    path: str,
    seen: str,
    checkpoint: str,
    arrived: Column | None = None,
    rejects: str | None = None,
) -> DataStreamWriter:
    """Stream that lands articles whose URL is new.

    The URLs seen are listed by bucket at ``seen``; each batch writes one folder
    at ``path``, and a replayed batch writes the same folder again. Articles without title or URL are not landed and not remembered;
    their payloads, and those that are no articles, go to ``rejects``, if given.
    """
    tag_of = batch_tags(checkpoint)

    def land(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        tag = tag_of(spark, batch_id)
        if rejects:
            bad = landing.not_landed(decode(batch, keep_raw=True)).select("_raw")
            bad.write.mode("overwrite").parquet(f"{rejects}/batch={tag}")
        rows = landing.one_per_url(usable(decode(batch))).persist()
        out = f"{path}/batch={tag}"
        fresh = landing.landing_rows(new_urls(rows, seen, tag), arrived)
        landing.land(fresh, out, mode="overwrite")
        remember(landing.read_landed(spark, out), seen, tag)
        rows.unpersist()

    return messages.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
