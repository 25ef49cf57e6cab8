"""From hits to context, prompts and source lists."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.functions.text import NO_ARTICLES, context_block, prompt, source_link


def contexts(hits: DataFrame) -> DataFrame:
    """Per question the hits in rank order and their context text.

    A question has at most ``k`` hits, so the collected list is short.
    """
    entry = F.struct("rank", "id", "score", "metadata")
    ordered = F.sort_array(F.collect_list(entry))
    blocks = F.transform("matches", lambda m: context_block(m["rank"], m["metadata"]))
    return (
        hits.groupBy("q_id")
        .agg(ordered.alias("matches"))
        .withColumn("context", F.array_join(blocks, "\n"))
    )


def prompts(questions: DataFrame, hits: DataFrame) -> DataFrame:
    """One row per question; without hits there is no prompt but a fixed answer."""
    joined = questions.select("q_id", "question").join(contexts(hits), "q_id", "left")
    found = F.col("context").isNotNull()
    return joined.select(
        "q_id",
        "question",
        F.when(found, prompt(F.col("context"), F.col("question"))).alias("prompt"),
        F.when(~found, F.lit(NO_ARTICLES)).alias("fallback_answer"),
        "matches",
    )


def sources_used(prompted: DataFrame) -> DataFrame:
    """Per question the sources of its hits, best first."""
    names = F.transform("matches", lambda m: m["metadata"]["source"])
    return prompted.select("q_id", "question", names.alias("sources"))


def answered(asked: DataFrame, answer: Callable[[pd.Series], pd.Series]) -> DataFrame:
    """Answers from a user-given service; it is not called without a prompt,
    and a filter on the answers does not call it twice."""

    @F.pandas_udf("string")
    def call(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out = pd.Series(None, index=texts.index, dtype=object)
            some = texts.notna()
            if some.any():
                out[some] = answer(texts[some])
            yield out

    return asked.withColumn("answer", F.coalesce("fallback_answer", call.asNondeterministic()("prompt")))


def source_list(hits: DataFrame) -> DataFrame:
    """What is shown as an answer's sources, best first per question."""
    m = F.col("metadata")
    return hits.select(
        "q_id",
        "rank",
        m["title"].alias("title"),
        m["url"].alias("url"),
        m["source"].alias("source"),
        m["published_at"].alias("published_at"),
        source_link(m["title"], m["url"], m["source"]).alias("link"),
    )
