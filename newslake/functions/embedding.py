"""Text to vectors.

The built-in vectors count hashed words, by built-in functions. They find shared
words, not shared meaning. For that, pass a factory around a sentence model: an
embedder turns a series of texts into a matrix, one row per text, and a factory
makes one in each Python worker, so a model is loaded there once.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.feature import CountVectorizerModel, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sent along with the jobs: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Embedder = Callable[[pd.Series], np.ndarray]
DIMENSIONS = 256


_BREAKS = r"[\s\p{Z}\x1c-\x1f\x85]+"


def hashed_words(
    df: DataFrame, text: Column, to: str = "values", dimensions: int = DIMENSIONS
) -> DataFrame:
    """The table with vectors of its texts: counts of lower-case words by hash,
    scaled to unit length. A word's place is the first four hex digits of its
    MD5, modulo ``dimensions``; a text without words has a vector of zeros."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), _BREAKS)
    place = lambda w: F.conv(F.substring(F.md5(w), 1, 4), 16, 10).cast("int") % dimensions
    places = F.transform(F.filter(words, lambda w: w != ""), lambda w: place(w).cast("string"))
    held, counts, unit = "_hashed_places", "_hashed_counts", "_hashed_unit"
    counter = CountVectorizerModel.from_vocabulary(
        [str(i) for i in range(dimensions)], inputCol=held, outputCol=counts
    )
    scaled = Normalizer(inputCol=counts, outputCol=unit, p=2.0)
    counted = scaled.transform(counter.transform(df.withColumn(held, places)))
    return counted.withColumn(to, vector_to_array(unit, "float32")).drop(held, counts, unit)


def _one_by_one(embedder: Embedder, texts: pd.Series) -> tuple[list, list]:
    """Vectors and errors of a batch that failed as a whole. If all of several
    texts fail, it isn't the texts: the job stops."""
    rows, errors, last = [], [], None
    for at in range(len(texts)):
        try:
            rows.append(np.asarray(embedder(texts.iloc[at : at + 1]), dtype=np.float32)[0])
            errors.append(None)
        except Exception as error:
            rows.append(None)
            errors.append(f"{type(error).__name__}: {error}")
            last = error
    if len(texts) > 1 and None not in errors:
        raise RuntimeError("the embedder failed on every text of a batch") from last
    return rows, errors


def vector_or_error(text: Column, factory: Callable[[], Embedder]) -> Column:
    """Struct of a text's vector, ``values``, and, where the embedder fails on
    the text, the ``error`` instead; a factory that fails stops the job.

    Arrow batches, the only Python in the plan. Marked as not deterministic, so
    that a filter on the vector does not run the model a second time.
    """

    @F.pandas_udf("values array<float>, error string")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        embedder = factory()
        for texts in batches:
            texts = texts.fillna("")
            try:
                rows = list(np.asarray(embedder(texts), dtype=np.float32))
                errors = [None] * len(rows)
            except Exception:
                rows, errors = _one_by_one(embedder, texts)
            yield pd.DataFrame(
                {"values": pd.Series(rows, dtype=object), "error": pd.Series(errors, dtype=object)}
            )

    return encode.asNondeterministic()(text)


def vector(text: Column, factory: Callable[[], Embedder]) -> Column:
    """Vector of a text column; null where the embedder fails on a text."""
    return vector_or_error(text, factory)["values"]
