"""The operators as queries over the whole benchmark tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake.llm import (
    bpe, license, linededup, merkle, packing, permindex, perplexity, pii, ranked, repair,
    simhash, toxicity, warc,
)
from newslake.llm.common import table


def op1_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permindex.nearest(table(spark, sf_dir, "embeddings"), F.expr("vec_id % 20 = 0"))


def held_out() -> Column:
    """The fold from which nothing is learnt."""
    fold = F.crc32(F.col("doc_id").cast("string")) % 4
    return F.coalesce(fold == 2, F.lit(False))


def toxicity_model(docs: DataFrame, sf_dir: str) -> toxicity.Model:
    return toxicity.train(docs, table(docs.sparkSession, sf_dir, "labels"), ~held_out())


def op2_toxicity_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.scored(docs, toxicity_model(docs, sf_dir))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op3_min_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
    return packing.packed(table(spark, sf_dir, "documents"), path, pattern)


def op4_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derived(warc.responses(table(spark, sf_dir, "pages")))


def op5_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scanned(table(spark, sf_dir, "documents"))


def op6_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.compared(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digests(simhash.near_duplicates(table(spark, sf_dir, "documents")))


def op8_pii_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.digests(pii.with_spans(docs))


def op9_line_neighbourhoods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    ids = bpe.encoded(table(spark, sf_dir, "documents"), path, pattern)
    return bpe.digests(bpe.decoded(ids, path, pattern))


def op11_norm_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_run_length_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repairs(repair.damaged(table(spark, sf_dir, "conversations")))


def op13_perplexity_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.judged(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_permutation_index": op1_permutation_index,
    "op2_toxicity_pu": op2_toxicity_pu,
    "op3_min_bin_slack": op3_min_bin_slack,
    "op4_warc_derivatives": op4_warc_derivatives,
    "op5_license_diagonals": op5_license_diagonals,
    "op6_merkle": op6_merkle,
    "op7_simhash": op7_simhash,
    "op8_pii_anchors": op8_pii_anchors,
    "op9_line_neighbourhoods": op9_line_neighbourhoods,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_norm_buckets": op11_norm_buckets,
    "op12_run_length_repair": op12_run_length_repair,
    "op13_perplexity_bands": op13_perplexity_bands,
}
ORACLE: dict[str, str] = {
    "op4_warc_derivatives": warc.DERIVED_SQL,
    "op5_license_diagonals": license.SCANNED_SQL,
    "op6_merkle": merkle.COMPARED_SQL,
    "op9_line_neighbourhoods": linededup.DEDUPLICATED_SQL,
    "op11_norm_buckets": ranked.RANKED_SQL,
    "op12_run_length_repair": repair.REPAIRS_SQL,
}
