"""Landing area: articles as JSON objects in day folders."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslake.functions.text import URL_TAG_CHARS, object_key, url_tag, utc
from newslake.operators.dedup import first_per_key, row_hash
from newslake.operators.refine import usable
from newslake.schemas import ARTICLE, ARTICLE_FIELDS

LANDED = T.StructType(
    [
        *ARTICLE.fields,
        T.StructField("article_url", T.StringType()),
        T.StructField("object_key", T.StringType()),
    ]
)


def landing_rows(articles: DataFrame, arrived: Column | None = None) -> DataFrame:
    """What is stored of each article, with its day and object name.

    Articles without title or URL cannot be named and are left out; see
    ``not_landed``.
    """
    when = F.current_timestamp() if arrived is None else arrived
    return usable(articles).select(
        *ARTICLE_FIELDS,
        url_tag(F.col("url")).alias("article_url"),
        object_key(F.col("title"), when).alias("object_key"),
        F.date_format(utc(when), "yyyy").alias("year"),
        F.date_format(utc(when), "MM").alias("month"),
        F.date_format(utc(when), "dd").alias("day"),
    )


def not_landed(articles: DataFrame) -> DataFrame:
    return articles.where(F.col("title").isNull() | F.col("url").isNull())


def land(rows: DataFrame, path: str, mode: str = "append") -> None:
    """Write landing rows; one file holds many articles, its name is Spark's.
    Rows of a day are brought together first, or each task would write a file
    per day; adaptive execution splits a day that is large."""
    (
        rows.hint("rebalance", "year", "month", "day")
        .write.mode(mode)
        .partitionBy("year", "month", "day")
        .option("ignoreNullFields", "false")
        .json(path)
    )


def read_landed(
    spark: SparkSession, path: str, first: dt.date | None = None, last: dt.date | None = None
) -> DataFrame:
    """Landed articles; with a first or last day, only the folders from or up
    to that day are opened."""
    rows = spark.read.schema(LANDED).json(path)
    day = F.make_date("year", "month", "day")
    for wanted in ([day >= first] if first else []) + ([day <= last] if last else []):
        rows = rows.where(wanted)
    return rows.select(*LANDED.names)


def read_objects(spark: SparkSession, path: str) -> DataFrame:
    """Landed objects as ``body`` text and ``article_url``, whatever else the
    bodies hold; unreadable ones come with a null tag."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    tag = F.get_json_object("value", "$.article_url")
    return lines.select(tag.alias("article_url"), F.col("value").alias("body"))


def stored_urls(landed: DataFrame) -> DataFrame:
    """URLs already stored, once each, from ``article_url`` and the ``body``.

    The tag holds the first characters only; a full-length tag may be cut, so
    there the body decides, and so it does where there is no tag. Rows that
    give no whole URL are skipped: a cut tag is none.
    """
    tag, in_body = F.col("article_url"), F.get_json_object("body", "$.url")
    cut = F.length(tag) >= URL_TAG_CHARS
    whole = F.when((tag != "") & ~cut, tag)
    url = F.coalesce(whole, F.when(in_body != "", in_body))
    return landed.select(url.alias("url")).where("url is not null").distinct()


def one_per_url(articles: DataFrame) -> DataFrame:
    """Copies of a URL inside a batch go; which one stays does not depend on
    the order of arrival, which topics do not define."""
    hashed = articles.withColumn("_tie", row_hash(articles.columns))
    return first_per_key(hashed, ["url"], ["_tie"]).drop("_tie")
