"""The batch run over stored tables: raw, cleaned, aggregated."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake.operators.gold import ROLLUPS, reconciled
from newslake.operators.refine import refine
from newslake.sources import delta, tables


def day_of_silver(spark: SparkSession, path: str, by_day: bool) -> Column | None:
    """How the next load is laid out: as the loads before it, if there are any."""
    stored = tables.by_day(spark, path)
    return F.to_date("published_at") if (by_day if stored is None else stored) else None


def load_silver(
    bronze: DataFrame,
    path: str,
    arrival: Sequence[str] = ("ingested_at",),
    batch: str | None = None,
    fmt: str = "parquet",
    by_day: bool = False,
) -> str | None:
    """Refine the raw table and insert the URLs that Silver does not have;
    returns the tag of the load, which Delta tables have no use for. With
    ``by_day``, a new Silver is laid out by published date, in its column ``day``."""
    rows = refine(bronze, arrival)
    if fmt == "delta":
        return delta.insert_new(rows, path, ["url"])
    day = day_of_silver(bronze.sparkSession, path, by_day)
    return tables.insert_new(rows, path, ["url"], batch, day=day)


def load_gold(silver: DataFrame, path: str, fmt: str = "parquet") -> int | None:
    """Recompute the aggregates and merge them into the stored ones, which are
    one snapshot, or, as Delta, one table each.

    If the rows come with the tag of their load, ``batch``, the micro-batches
    among them are noted as held, and a stream that works on the same tables
    does not add them a second time.
    """
    if fmt == "delta":
        for name, rollup in ROLLUPS.items():
            delta.upsert(rollup.states(silver), f"{path}/{name}", rollup.keys)
        return None
    covered = tables.last_batches(silver) if "batch" in silver.columns else None
    parts = {name: (rollup.states(silver), rollup.keys) for name, rollup in ROLLUPS.items()}
    return tables.upsert_parts(parts, path, covered=covered)


def read_gold(spark: SparkSession, path: str, name: str, fmt: str = "parquet") -> DataFrame:
    """One of the stored aggregates, loaded in a batch run or by the stream."""
    if fmt == "delta":
        return ROLLUPS[name].report(tables.scan(spark, f"{path}/{name}", fmt))
    return ROLLUPS[name].report(tables.read_snapshot(spark, path, name))


def check_gold(spark: SparkSession, silver: str, gold: str) -> DataFrame:
    return reconciled(read_gold(spark, gold, "by_source"), tables.read_inserted(spark, silver))
