"""The models in Spark's catalog: staging as views, marts as tables.

A view is its SQL text, so it shows what Silver holds whenever it is read. A mart
is an external table: a rebuilt one is written to a folder of its own and becomes
the table at once, by the table's location, so that no reader finds it half
written. The folder before it stays for its readers until the next run.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from newslake.plans.models import MODELS
from newslake.sources import files

_STAGING = {
    "stg_news_silver": """
select title, description, url, source, author, published_at, content_length, has_content,
       to_date(published_at) as published_date, year(published_at) as published_year,
       month(published_at) as published_month
from {silver}
where title is not null and url is not null""",
    "stg_news_sources": """
select source, count(*) as total_articles from {silver} where source is not null group by source""",
}
_MARTS = {
    "mart_articles_by_source": """
select source, count(*) as total_articles, round(avg(content_length), 2) as avg_content_length,
       min(published_at) as earliest_article, max(published_at) as latest_article,
       count(distinct published_date) as active_days
from {staged} group by source""",
    "mart_articles_by_date": """
select published_date, published_year, published_month, count(*) as total_articles,
       count(distinct source) as unique_sources, count(distinct author) as unique_authors
from {staged} group by published_date, published_year, published_month""",
    "mart_articles_by_author": """
select author, source, count(*) as total_articles, min(published_at) as first_article,
       max(published_at) as latest_article, count(distinct published_date) as active_days
from {staged} where author <> 'Unknown' group by author, source""",
}


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_views(spark: SparkSession, silver: str, database: str, fmt: str = "parquet") -> None:
    """Make or replace the staging views over the Silver table at a path, with
    the models' descriptions as comments."""
    for name, query in _STAGING.items():
        model, body = MODELS[name], query.format(silver=f"{fmt}.`{silver}`")
        columns = [
            f"{c} comment {_text(model.columns[c])}" if c in model.columns else c for c in spark.sql(body).columns
        ]
        spark.sql(
            f"create or replace view {database}.{name} ({', '.join(columns)}) "
            f"comment {_text(model.about)} as {body}"
        )


def rebuild_marts(spark: SparkSession, database: str, path: str) -> None:
    """Build the marts from the staging view, below ``path``, and swap them in."""
    for name, query in _MARTS.items():
        table, folder = f"{database}.{name}", f"load-{uuid.uuid4().hex}"
        place = f"{path}/{name}/{folder}"
        spark.sql(query.format(staged=f"{database}.stg_news_silver")).write.parquet(place)
        if spark.catalog.tableExists(table):
            before = spark.sql(f"describe table extended {table}").where("col_name = 'Location'").first().data_type
            spark.sql(f"alter table {table} set location {_text(place)}")
            spark.catalog.refreshTable(table)
        else:
            before = place
            spark.sql(f"create table {table} using parquet location {_text(place)}")
        for old in files.names(spark, f"{path}/{name}"):
            if old != folder and old != before.rstrip("/").rsplit("/", 1)[-1]:
                files.remove(spark, f"{path}/{name}/{old}")


def store(spark: SparkSession, silver: str, database: str, path: str) -> None:
    """All models over a stored Silver table, in dependency order."""
    spark.sql(f"create database if not exists {database} location {_text(path + '/catalog')}")
    create_views(spark, silver, database)
    rebuild_marts(spark, database, path)
