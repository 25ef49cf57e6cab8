"""Corpus cleaning as a row of stages, each written to Parquet and read again.

Every stage works on all rows that the one before it kept. All but the last
return the columns of their input, in order; where a text changes, ``n_chars``
follows it. The last one packs what is left into sequences of tokens.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake.llm import linededup, packing, pii, simhash, toxicity
from newslake.llm.common import table
from newslake.llm.queries import toxicity_model
from newslake.session import shared_dir


def _counted(docs: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like``, with the number of characters of the new text."""
    if "n_chars" in like.columns:
        length = F.length("text").cast(like.schema["n_chars"].dataType)
        docs = docs.withColumn("n_chars", length)
    return docs.select(like.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold stay as they are."""
    return toxicity.clean(docs, toxicity_model(docs, sf_dir))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier line of the corpus has almost word for word go."""
    # Without the column that changes anyway, the table is shuffled only once.
    return _counted(linededup.deduplicated(docs.drop("n_chars")), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.one_of_each(docs, shingle=4, distance=4)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by the name of its kind."""
    return _counted(pii.masked(docs), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of 1024 tokens."""
    path, pattern = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
    return packing.packed(docs, path, pattern)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near-duplicates", drop_near_duplicates),
    ("personal data", mask_personal_data),
    ("packing", pack),
]

#: The first stage learns a classifier, which SQL can't express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; the result of the last one."""
    docs = table(spark, sf_dir, "documents")
    root = shared_dir(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{root}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
