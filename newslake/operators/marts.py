"""The marts as aggregates of one finer state that loads add to.

Days, sources and authors that differ can't be counted by adding up counts, so
the state has a row per day, source and author, with sums and extremes. It is
merged load by load, in the buckets of the days that a load touches, and all
three marts are exact aggregates of it, far smaller than the articles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.operators.gold import Measure, Rollup, known_authors

KEYS = ("published_date", "source", "author")

states = Rollup(
    keys=KEYS,
    measures=(
        Measure("total_articles", "*", F.count, F.sum),
        Measure("length_sum", "content_length", F.sum, F.sum),
        Measure("length_count", "content_length", F.count, F.sum),
        Measure("earliest_article", "published_at", F.min, F.min),
        Measure("latest_article", "published_at", F.max, F.max),
    ),
    rows=lambda staged: staged,
    shown=lambda found: found,
)


def by_source(found: DataFrame) -> DataFrame:
    mean = F.try_divide(F.sum("length_sum"), F.sum("length_count"))
    return found.groupBy("source").agg(
        F.sum("total_articles").alias("total_articles"),
        F.round(mean, 2).alias("avg_content_length"),
        F.min("earliest_article").alias("earliest_article"),
        F.max("latest_article").alias("latest_article"),
        F.count_distinct("published_date").alias("active_days"),
    )


def by_date(found: DataFrame) -> DataFrame:
    return found.groupBy(
        "published_date",
        F.year("published_date").alias("published_year"),
        F.month("published_date").alias("published_month"),
    ).agg(
        F.sum("total_articles").alias("total_articles"),
        F.count_distinct("source").alias("unique_sources"),
        F.count_distinct("author").alias("unique_authors"),
    )


def by_author(found: DataFrame) -> DataFrame:
    return known_authors(found).groupBy("author", "source").agg(
        F.sum("total_articles").alias("total_articles"),
        F.min("earliest_article").alias("first_article"),
        F.max("latest_article").alias("latest_article"),
        F.count_distinct("published_date").alias("active_days"),
    )


MARTS = {
    "mart_articles_by_source": by_source,
    "mart_articles_by_date": by_date,
    "mart_articles_by_author": by_author,
}
