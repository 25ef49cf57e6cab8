"""Landed responses of a headline service."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.schemas import HEADLINES

# What the service is asked for.
LANGUAGE = "en"
CATEGORY = "technology"
PAGE_SIZE = 20


def fetched(
    responses: DataFrame, language: str = LANGUAGE, category: str = CATEGORY, page: int | None = None
) -> DataFrame:
    """Articles of the successful responses to the wanted request.

    ``responses`` has the request's ``language`` and ``category`` and the JSON
    ``body``. A response gives all of its articles, however many the service
    sent, or the first ``page`` of them, such as ``PAGE_SIZE``; one with another
    status than ``ok`` gives none.
    """
    articles = F.col("response.articles")
    wanted = responses.where((F.col("language") == language) & (F.col("category") == category))
    parsed = wanted.withColumn("response", F.from_json("body", HEADLINES))
    return parsed.where("response.status = 'ok'").select(
        F.explode(F.slice(articles, 1, page) if page else articles).alias("article")
    )


def flattened(fetched_articles: DataFrame) -> DataFrame:
    """The seven message fields; a missing part, the source included, is null."""
    a = F.col("article")
    return fetched_articles.select(
        a["title"].alias("title"),
        a["description"].alias("description"),
        a["content"].alias("content"),
        a["url"].alias("url"),
        a["source"]["name"].alias("source"),
        a["publishedAt"].alias("published_at"),
        a["author"].alias("author"),
    )
