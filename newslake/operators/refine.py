"""Raw articles to cleaned articles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.functions.text import or_unknown
from newslake.operators.dedup import first_per_key, row_hash


def usable(articles: DataFrame) -> DataFrame:
    return articles.where(F.col("title").isNotNull() & F.col("url").isNotNull())


def clean(articles: DataFrame) -> DataFrame:
    """Typed and trimmed columns; a date that cannot be read becomes null."""
    return articles.withColumns(
        {
            "published_at": F.try_to_timestamp("published_at"),
            "title": F.trim("title"),
            "author": or_unknown(F.col("author")),
            "source": or_unknown(F.col("source")),
            "content_length": F.length("content"),
            "has_content": F.col("content").isNotNull(),
        }
    )


def refine(
    bronze: DataFrame, arrival: Sequence[str] = ("ingested_at",), total_order: bool = False
) -> DataFrame:
    """Cleaned articles, one per URL: the first usable arrival.

    Unusable rows go first, so a URL is never lost to a survivor without a
    title. Ties in arrival are decided by the hash of the raw row; with
    ``total_order`` there are none, and the hash is left out. Everything is
    computed before the shuffle: where only lengths or flags are read later,
    the article text is not shuffled at all.
    """
    rows = usable(bronze)
    if total_order:
        return first_per_key(clean(rows), ["url"], arrival)
    hashed = clean(rows.withColumn("_tie", row_hash(rows.columns)))
    return first_per_key(hashed, ["url"], [*arrival, "_tie"]).drop("_tie")
