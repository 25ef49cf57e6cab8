"""Aggregates of cleaned articles by source, by date and by author.

Each aggregate is a mergeable state (counts, sums, extremes) and a report made
from that state. Computed at once over a whole table or merged load by load,
the result is the same. Counting is partial before every shuffle, so a source
or author with a third of all articles is no hot spot.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake.functions.text import UNKNOWN

Aggregate = Callable[[str], Column]


@dataclass(frozen=True)
class Measure:
    """A state column: how it is first counted and how two states combine."""

    name: str
    of: str
    count: Aggregate
    merge: Aggregate


@dataclass(frozen=True)
class Rollup:
    keys: tuple[str, ...]
    measures: tuple[Measure, ...]
    rows: Callable[[DataFrame], DataFrame]
    shown: Callable[[DataFrame], DataFrame]

    def states(self, silver: DataFrame) -> DataFrame:
        grouped = self.rows(silver).groupBy(*self.keys)
        return grouped.agg(*[m.count(m.of).alias(m.name) for m in self.measures])

    def merged(self, states: DataFrame) -> DataFrame:
        grouped = states.groupBy(*self.keys)
        return grouped.agg(*[m.merge(m.name).alias(m.name) for m in self.measures])

    def report(self, states: DataFrame) -> DataFrame:
        return self.shown(states)

    def __call__(self, silver: DataFrame) -> DataFrame:
        return self.report(self.states(silver))


_articles = Measure("total_articles", "*", F.count, F.sum)
_latest = Measure("latest_article", "published_at", F.max, F.max)


def known_authors(articles: DataFrame) -> DataFrame:
    return articles.where(F.col("author") != UNKNOWN)


def _by_day(silver: DataFrame) -> DataFrame:
    """``date`` is a timestamp at midnight in the session's zone."""
    return silver.withColumn("date", F.date_trunc("day", "published_at"))


def _source_report(states: DataFrame) -> DataFrame:
    mean = F.try_divide("length_sum", "length_count")
    return states.select(
        "source", "total_articles", F.round(mean, 2).alias("avg_content_length"),
        "earliest_article", "latest_article",
    )


by_source = Rollup(
    keys=("source",),
    measures=(
        _articles,
        Measure("length_sum", "content_length", F.sum, F.sum),
        Measure("length_count", "content_length", F.count, F.sum),
        Measure("earliest_article", "published_at", F.min, F.min),
        _latest,
    ),
    rows=lambda silver: silver,
    shown=_source_report,
)

# ``total_authors`` counts articles whose author is not null, and cleaning
# leaves none null: it is not a distinct count.
by_date = Rollup(
    keys=("date",),
    measures=(_articles, Measure("total_authors", "author", F.count, F.sum)),
    rows=_by_day,
    shown=lambda states: states,
)

by_author = Rollup(
    keys=("author", "source"),
    measures=(_articles, _latest),
    rows=known_authors,
    shown=lambda states: states,
)

ROLLUPS = {"by_source": by_source, "by_date": by_date, "by_author": by_author}


def largest_first(report: DataFrame, *ties: str) -> DataFrame:
    """Reading order of a report; stored tables are not sorted."""
    return report.orderBy(F.desc("total_articles"), *ties)


def newest_first(report: DataFrame, date: str) -> DataFrame:
    return report.orderBy(F.desc(date))


def reconciled(by_source_report: DataFrame, silver: DataFrame) -> DataFrame:
    """Articles counted by source beside the articles there are."""
    total = by_source_report.agg(F.sum("total_articles").alias("total_articles_sum"))
    rows = silver.agg(F.count("*").alias("silver_rows"))
    # Two one-row results side by side, without a join.
    both = total.unionByName(rows, allowMissingColumns=True).agg(
        F.max("total_articles_sum").alias("total_articles_sum"),
        F.max("silver_rows").alias("silver_rows"),
    )
    return both.withColumn("matches", F.col("total_articles_sum") == F.col("silver_rows"))
