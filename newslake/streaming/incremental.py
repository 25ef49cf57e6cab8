"""Raw articles to cleaned and aggregated tables, new rows only."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from newslake.operators import marts, quality
from newslake.operators.gold import ROLLUPS
from newslake.operators.refine import refine
from newslake.plans import medallion, models
from newslake.sources import seen as listed
from newslake.sources import tables
from newslake.streaming.batches import batch_tags


def add_to_rollups(fresh: DataFrame, gold: str, batch: str) -> None:
    """Merge the states of new rows into the stored ones, once per batch; the
    three aggregates move on together."""
    spark = fresh.sparkSession
    now = tables.current(spark, gold)
    if tables.has_applied(now, batch):
        return
    parts = {name: rollup.states(fresh) for name, rollup in ROLLUPS.items()}
    if now:
        for name, states in parts.items():
            old = tables.read_part(spark, gold, now, name, states.schema)
            parts[name] = ROLLUPS[name].merged(old.unionByName(states))
    tables.publish(parts, gold, now, batch)


def add_to_marts(fresh: DataFrame, path: str, batch: str) -> None:
    """Merge a load's states into those of the marts, once per batch; only the
    days of the load are read and written."""
    staged = models.stg_news_silver(fresh)
    found = marts.states.states(staged)
    tables.upsert(found, path, marts.KEYS, batch, by=["published_date"], merged=marts.states.merged)


def write_checks(counts: dict, fresh: DataFrame, others: DataFrame, path: str) -> None:
    """The declared checks of one load: nulls from the write's own counts, keys
    against the list of those that other loads brought."""
    model = models.MODELS["stg_news_silver"]
    found = quality.of_load(counts, fresh, others, "stg_news_silver", model.required, *model.unique)
    sources = models.MODELS["stg_news_sources"]
    by_source = quality.checks(models.stg_news_sources(fresh), "stg_news_sources", sources.required, sources.unique)
    reduce(DataFrame.unionByName, [found, *by_source]).write.mode("overwrite").parquet(path)


def read_checks(spark: SparkSession, path: str) -> DataFrame:
    """All loads' checks as one report."""
    per_check = tables.scan(spark, path).groupBy("check", "model", "column")
    return quality.report([per_check.agg(F.sum("failing_rows").alias("failing_rows"))])


def refiner(
    bronze: DataFrame,
    silver: str,
    gold: str,
    checkpoint: str,
    arrival: Sequence[str] = ("ingested_at",),
    total_order: bool = False,
    fmt: str = "parquet",
    by_day: bool = False,
    mart_states: str | None = None,
    checks: str | None = None,
) -> DataStreamWriter:
    """Stream that refines each batch of the raw table and adds it to Silver
    and to the aggregates. Across batches the first arrival of a URL stays.
    A Silver that is there keeps its layout; a new one is laid out ``by_day`` if
    asked for. With a place for ``mart_states``, the marts are kept up too, see
    ``newslake.operators.marts``; with one for ``checks``, the quality checks of
    each load are written there, see ``read_checks``.

    Delta tables keep no note of batches: there the aggregates are counted
    anew from all of Silver, which a replay does not change.
    """
    tag_of = batch_tags(checkpoint)

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if fmt == "delta":
            medallion.load_silver(batch, silver, arrival, fmt=fmt)
            medallion.load_gold(tables.scan(spark, silver, fmt), gold, fmt)
            return
        tag = tag_of(spark, batch_id)
        rows = refine(batch, arrival, total_order).persist()
        day = medallion.day_of_silver(spark, silver, by_day)
        seen = Observation()
        required = models.MODELS["stg_news_silver"].required
        watch = (seen, quality.watched(required)) if checks else None
        tables.insert_new(rows, silver, ["url"], tag, small_batch=True, day=day, watch=watch)
        rows.unpersist()
        fresh = tables.read_batch(spark, silver, tag, rows.schema).select(rows.columns)
        add_to_rollups(fresh, gold, tag)
        if mart_states:
            add_to_marts(fresh, mart_states, tag)
        if checks:
            others = listed.lookup(fresh, f"{silver}/_seen", ["url"], tag)
            write_checks(seen.get, fresh, others, f"{checks}/batch={tag}")

    return bronze.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
