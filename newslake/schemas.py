"""Declared schemas; nothing in the package infers one from data."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names of a topic message, in message order.
ARTICLE_FIELDS = (
    "title",
    "description",
    "content",
    "url",
    "source",
    "published_at",
    "author",
)

ARTICLE = T.StructType([T.StructField(name, T.StringType()) for name in ARTICLE_FIELDS])

# One response of the headline service, as landed.
HEADLINES = T.StructType(
    [
        T.StructField("status", T.StringType()),
        T.StructField(
            "articles",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("title", T.StringType()),
                        T.StructField("description", T.StringType()),
                        T.StructField("content", T.StringType()),
                        T.StructField("url", T.StringType()),
                        T.StructField(
                            "source", T.StructType([T.StructField("name", T.StringType())])
                        ),
                        T.StructField("publishedAt", T.StringType()),
                        T.StructField("author", T.StringType()),
                    ]
                )
            ),
        ),
    ]
)

# Fields kept beside each vector.
METADATA_FIELDS = ("title", "description", "url", "source", "published_at", "author")
