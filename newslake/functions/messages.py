"""Topic messages: JSON text to columns and back."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslake.schemas import ARTICLE, ARTICLE_FIELDS

_CORRUPT = "_corrupt"
_PARSED = T.StructType([*ARTICLE.fields, T.StructField(_CORRUPT, T.StringType())])


def encode(articles: DataFrame) -> Column:
    """The seven article fields of a row as JSON, nulls written out."""
    fields = F.struct(*[articles[name] for name in ARTICLE_FIELDS])
    return F.to_json(fields, {"ignoreNullFields": "false"})


def decode(messages: DataFrame, keep_raw: bool = False) -> DataFrame:
    """Article columns of each message; a payload that is not an article
    becomes a row of nulls. ``keep_raw`` keeps the payload as ``_raw``."""
    text = F.col("value").cast("string")
    kept = [text.alias("_raw")] if keep_raw else []
    return messages.select(F.from_json(text, ARTICLE).alias("data"), *kept).select(
        "data.*", *(["_raw"] if keep_raw else [])
    )


def decode_with(messages: DataFrame, extra: Mapping[str, tuple[str, str]]) -> DataFrame:
    """The article columns and, by name, fields that the schema doesn't know:
    ``extra`` gives each one's path and type, as ``("$.meta.tags[0]", "string")``.

    A payload is parsed once more for them, as a whole. A field that is missing
    or of another type is null, and so are those of a payload that is no JSON.
    """
    whole = F.try_parse_json(F.col("value").cast("string"))
    parsed = messages.withColumn("_whole", whole)
    found = [F.try_variant_get("_whole", path, kind).alias(name) for name, (path, kind) in extra.items()]
    data = F.from_json(F.col("value").cast("string"), ARTICLE).alias("data")
    return parsed.select(data, *found).select("data.*", *extra)


def rejected(messages: DataFrame) -> DataFrame:
    """Payloads that could not be read as an article."""
    text = F.col("value").cast("string")
    parsed = F.from_json(text, _PARSED, {"columnNameOfCorruptRecord": _CORRUPT})
    # An empty payload parses to null, a broken one leaves its text behind.
    bad = messages.where(parsed.isNull() | parsed[_CORRUPT].isNotNull())
    return bad.select(text.alias("_raw"))


def stamp(df: DataFrame) -> DataFrame:
    """Arrival time: constant within a batch or micro-batch."""
    return df.withColumn("ingested_at", F.current_timestamp())
