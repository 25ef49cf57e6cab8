"""Reporting models: two staging views, three marts, and their checks."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake.operators import quality
from newslake.operators.gold import known_authors
from newslake.operators.refine import usable
from newslake.sources import tables


def stg_news_silver(silver: DataFrame) -> DataFrame:
    """Cleaned articles without their text, with date parts."""
    return usable(silver).select(
        "title",
        "description",
        "url",
        "source",
        "author",
        "published_at",
        "content_length",
        "has_content",
        F.to_date("published_at").alias("published_date"),
        F.year("published_at").alias("published_year"),
        F.month("published_at").alias("published_month"),
    )


def stg_news_sources(silver: DataFrame) -> DataFrame:
    sources = silver.where(F.col("source").isNotNull()).groupBy("source")
    return sources.agg(F.count("*").alias("total_articles"))


def mart_articles_by_source(staged: DataFrame) -> DataFrame:
    return staged.groupBy("source").agg(
        F.count("*").alias("total_articles"),
        F.round(F.avg("content_length"), 2).alias("avg_content_length"),
        F.min("published_at").alias("earliest_article"),
        F.max("published_at").alias("latest_article"),
        F.count_distinct("published_date").alias("active_days"),
    )


def mart_articles_by_date(staged: DataFrame) -> DataFrame:
    """One row per date; ``Unknown`` counts as an author."""
    return staged.groupBy("published_date", "published_year", "published_month").agg(
        F.count("*").alias("total_articles"),
        F.count_distinct("source").alias("unique_sources"),
        F.count_distinct("author").alias("unique_authors"),
    )


def mart_articles_by_author(staged: DataFrame) -> DataFrame:
    return known_authors(staged).groupBy("author", "source").agg(
        F.count("*").alias("total_articles"),
        F.min("published_at").alias("first_article"),
        F.max("published_at").alias("latest_article"),
        F.count_distinct("published_date").alias("active_days"),
    )


@dataclass(frozen=True)
class Model:
    build: Callable[[DataFrame], DataFrame]
    reads: str
    kept_as: str  # "view" or "table"
    about: str = ""
    columns: dict[str, str] = field(default_factory=dict)
    required: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()


# Each model stands after the one it reads; "silver" is the stored table.
MODELS = {
    "stg_news_silver": Model(
        stg_news_silver,
        reads="silver",
        kept_as="view",
        about="Cleaned articles, one per URL",
        columns={
            "url": "Address of the article, its key",
            "title": "Headline",
            "source": "Name of the news source",
            "published_at": "Time of publication",
        },
        required=("url", "title", "source", "published_at"),
        unique=("url",),
    ),
    "stg_news_sources": Model(
        stg_news_sources,
        reads="silver",
        kept_as="view",
        about="News sources with their article counts",
        columns={"source": "Name of the news source"},
        required=("source",),
        unique=("source",),
    ),
    "mart_articles_by_source": Model(
        mart_articles_by_source, reads="stg_news_silver", kept_as="table"
    ),
    "mart_articles_by_date": Model(
        mart_articles_by_date, reads="stg_news_silver", kept_as="table"
    ),
    "mart_articles_by_author": Model(
        mart_articles_by_author, reads="stg_news_silver", kept_as="table"
    ),
}


def described(df: DataFrame, model: Model) -> DataFrame:
    """``df`` with the model's column descriptions as column comments."""
    return df.select(
        *[
            F.col(c).alias(c, metadata={"comment": model.columns[c]}) if c in model.columns
            else F.col(c)
            for c in df.columns
        ]
    )


def build_models(silver: DataFrame) -> dict[str, DataFrame]:
    """All models over one Silver table, nothing stored."""
    built = {"silver": silver}
    for name, model in MODELS.items():
        built[name] = described(model.build(built[model.reads]), model)
    del built["silver"]
    return built


def store_models(spark: SparkSession, silver: DataFrame, path: str) -> dict[str, DataFrame]:
    """Register views and rebuild tables below ``path``; all can then be
    queried by name. A rebuilt table becomes current at once and whole."""
    stored = build_models(silver)
    for name, df in stored.items():
        if MODELS[name].kept_as == "table":
            place = f"{path}/{name}"
            tables.publish({"": df}, place, tables.current(spark, place))
            stored[name] = tables.read_snapshot(spark, place)
        stored[name].createOrReplaceTempView(name)
    return stored


def save_marts(silver: DataFrame, database: str) -> None:
    """Rebuild the marts as managed tables of the catalog. Each is written whole
    under another name first; see ``newslake.plans.catalog`` for tables that are
    swapped in one step."""
    spark = silver.sparkSession
    for name, df in build_models(silver).items():
        if MODELS[name].kept_as == "table":
            table, following = f"{database}.{name}", f"{database}.{name}_next"
            df.write.mode("overwrite").saveAsTable(following)
            spark.sql(f"drop table if exists {table}")
            spark.sql(f"alter table {following} rename to {table}")


def checked(built: dict[str, DataFrame]) -> DataFrame:
    """Report of every declared check."""
    found = []
    for name, df in built.items():
        found += quality.checks(df, name, MODELS[name].required, MODELS[name].unique)
    return quality.report(found)
