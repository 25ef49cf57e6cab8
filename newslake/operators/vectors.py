"""Articles to vectors with metadata."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake.functions.embedding import Embedder, hashed_words, vector, vector_or_error
from newslake.functions.text import embedding_text, iso_text
from newslake.operators.approximate import HashTables, with_keys
from newslake.operators.merge import unmatched
from newslake.schemas import METADATA_FIELDS
from newslake.sources import files, tables


def embeddable(silver: DataFrame) -> DataFrame:
    """Articles with a URL and a title, neither null nor empty."""
    return silver.where((F.col("url") != "") & (F.col("title") != ""))


def metadata() -> Column:
    """The display fields as strings; a missing one is empty."""

    def text(name: str) -> Column:
        c = iso_text(F.col(name)) if name == "published_at" else F.col(name)
        return F.coalesce(c, F.lit("")).alias(name)

    return F.struct(*[text(name) for name in METADATA_FIELDS])


def embedded(silver: DataFrame, factory: Callable[[], Embedder] | None = None) -> DataFrame:
    """``id`` (the URL), ``values``, ``metadata`` and ``error`` of each usable
    article; where the embedder fails on one, its vector is null."""
    text = embedding_text(F.col("title"), F.col("description"), F.col("content"))
    rows = embeddable(silver).select(
        F.col("url").alias("id"), text.alias("text"), metadata().alias("metadata")
    )
    if factory is None:
        found = hashed_words(rows, F.col("text")).withColumn("error", F.lit(None).cast("string"))
    else:
        both = rows.withColumn("embedded", vector_or_error(F.col("text"), factory))
        found = both.select("id", "metadata", "embedded.*")
    return found.select("id", "values", "metadata", "error")


def article_vectors(
    silver: DataFrame, factory: Callable[[], Embedder] | None = None
) -> DataFrame:
    """``id`` (the URL), ``values`` and ``metadata`` of each usable article.

    Articles that the embedder fails on are left out; see ``write_vectors``.
    """
    return embedded(silver, factory).where(F.col("values").isNotNull()).drop("error")


def write_vectors(
    silver: DataFrame,
    path: str,
    batch: str,
    factory: Callable[[], Embedder] | None = None,
    rejects: str | None = None,
    by: HashTables | None = None,
) -> None:
    """Write the vectors of a load to its own folder below ``path`` and, if a
    place for ``rejects`` is given, the URLs that failed there, with errors. With
    hash tables ``by``, the vectors are stored with their keys, which
    ``approximate.nearest`` searches."""
    found = embedded(silver, factory)
    if rejects and factory:
        found = found.persist()
    good = found.where(F.col("values").isNotNull()).drop("error")
    if by:
        good = with_keys(good, by)
    good.write.mode("overwrite").options(**files.COMPRESSED_TABLE).parquet(f"{path}/batch={batch}")
    if rejects and factory:
        bad = found.where("error is not null").select(F.col("id").alias("url"), "error")
        bad.write.mode("overwrite").parquet(f"{rejects}/batch={batch}")
        found.unpersist()


def not_embedded(silver: DataFrame, vectors: DataFrame) -> DataFrame:
    """URLs of usable articles that have no vector."""
    known = vectors.select(F.col("id").alias("url"))
    return unmatched(embeddable(silver).select("url"), known, ["url"], null_safe=False)


def question_vectors(
    questions: DataFrame, factory: Callable[[], Embedder] | None = None
) -> DataFrame:
    """Questions (``q_id``, ``question``) with vectors of the same kind."""
    if factory is None:
        return hashed_words(questions, F.col("question"))
    return questions.withColumn("values", vector(F.col("question"), factory))


def store_vectors(
    silver: DataFrame,
    path: str,
    factory: Callable[[], Embedder] | None = None,
    batch: str | None = None,
) -> int:
    """Upsert the vectors of all articles by id; the last write wins."""
    return tables.upsert(article_vectors(silver, factory), path, ["id"], batch)


def store_new_vectors(
    silver: DataFrame,
    path: str,
    factory: Callable[[], Embedder] | None = None,
    batch: str | None = None,
    rejects: str | None = None,
    by: HashTables | None = None,
) -> str:
    """Embed and add only the articles that have no vector yet.

    Stored articles never change, so this gives the table that
    ``store_vectors`` gives, without running the model on old articles again.
    Finding the new ones takes a join; where Silver grows in loads,
    ``newslake.streaming.embedding`` does without.
    """
    spark = silver.sparkSession
    stored = tables.scan_if_exists(spark, path)
    if stored is not None:
        others = stored if batch is None else stored.where(F.col("batch") != batch)
        known = others.select(F.col("id").alias("url"))
        silver = unmatched(silver, known, ["url"], null_safe=False)
    batch = batch or tables.new_tag()
    write_vectors(silver, path, batch, factory, rejects, by)
    return batch


def vector_count(spark: SparkSession, path: str) -> int:
    """Vectors in a stored table of either layout; none if it does not exist."""
    now = tables.current(spark, path)
    stored = tables.read_part(spark, path, now) if now else tables.scan_if_exists(spark, path)
    return 0 if stored is None else stored.count()
