"""Each URL once, over batches and restarts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from newslake.operators.merge import unmatched_in_large
from newslake.sources import seen as index


def new_urls(rows: DataFrame, seen: str, tag: str) -> DataFrame:
    """Rows, one per URL, whose URL no other batch has put on the list, of
    which only the buckets that the rows touch are opened.

    ``rows`` is used several times, so the caller caches it.
    """
    return unmatched_in_large(rows, index.lookup(rows, seen, ["url"], tag), ["url"])


def remember(urls: DataFrame, seen: str, tag: str) -> None:
    """Put the URLs of a batch on the list; those of a replay count once."""
    index.add(urls, seen, ["url"], tag)
