"""Data-quality checks as one report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _entries(totals: DataFrame, model: str, checks: dict[str, tuple[str, str]]) -> DataFrame:
    """One row per check from a single row of counts; ``checks`` maps the
    name of a count to its check and column."""
    rows = F.array(
        *[
            F.struct(
                F.lit(check).alias("check"),
                F.lit(model).alias("model"),
                F.lit(column).alias("column"),
                F.coalesce(count, F.lit(0)).alias("failing_rows"),
            )
            for count, (check, column) in checks.items()
        ]
    )
    return totals.select(F.inline(rows))


def _null_counts(columns: Sequence[str]):
    return {f"null_{c}": F.count_if(F.col(c).isNull()) for c in columns}


def not_null(df: DataFrame, model: str, columns: Sequence[str]) -> DataFrame:
    """Null rows of each column, counted in a single pass."""
    counts = _null_counts(columns)
    totals = df.agg(*[how.alias(name) for name, how in counts.items()])
    return _entries(totals, model, {f"null_{c}": ("not_null", c) for c in columns})


def unique_and_not_null(
    df: DataFrame, model: str, key: str, required: Sequence[str] = ()
) -> DataFrame:
    """Values of ``key`` that occur more than once, nulls not counting as
    values, together with the null rows of the required columns.

    Both come from one grouping by the key, which needs no shuffle of its own
    where the rows are already spread by that key.
    """
    counts = _null_counts(required)
    per_key = df.groupBy(F.col(key).alias("_key")).agg(
        F.count("*").alias("_rows"), *[how.alias(name) for name, how in counts.items()]
    )
    repeated = F.col("_key").isNotNull() & (F.col("_rows") > 1)
    totals = per_key.agg(
        F.count_if(repeated).alias("repeated"), *[F.sum(name).alias(name) for name in counts]
    )
    checks = {f"null_{c}": ("not_null", c) for c in required}
    return _entries(totals, model, {"repeated": ("unique", key)} | checks)


def checks(
    df: DataFrame, model: str, required: Sequence[str], unique: Sequence[str]
) -> list[DataFrame]:
    """The checks of one model, in as few passes as it has unique columns."""
    if not unique:
        return [not_null(df, model, required)] if required else []
    first, *others = unique
    return [
        unique_and_not_null(df, model, first, required),
        *[unique_and_not_null(df, model, key) for key in others],
    ]


def watched(required: Sequence[str]) -> list[Column]:
    """Counts for a write to take along: its rows, and the null ones by column."""
    return [F.count("*").alias("rows"), *(how.alias(name) for name, how in _null_counts(required).items())]


def of_load(
    counts: Mapping[str, int], load: DataFrame, known: DataFrame, model: str, required: Sequence[str], key: str
) -> DataFrame:
    """The checks of one load: null rows as counted when it was written, and
    values of ``key`` that it has twice or that other loads, ``known``, have."""
    spark = load.sparkSession
    nulls = [("not_null", model, c, int(counts[f"null_{c}"])) for c in required]
    told = spark.createDataFrame(nulls, "check string, model string, column string, failing_rows long")
    per_key = load.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_rows"))
    there = known.select(F.col(key).alias("_key")).distinct()
    again = per_key.join(there, F.col(key) == F.col("_key"), "left").agg(
        F.count_if((F.col("_rows") > 1) | F.col("_key").isNotNull()).alias("repeated")
    )
    return told.unionByName(_entries(again, model, {"repeated": ("unique", key)}))


def report(found: Sequence[DataFrame]) -> DataFrame:
    rows = reduce(DataFrame.unionByName, found)
    return rows.withColumn("passed", F.col("failing_rows") == 0)
