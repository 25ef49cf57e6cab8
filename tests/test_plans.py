"""What the plans must and must not do at scale."""

import re

import pytest

from newslake.operators import merge
from newslake.plans import queries

LAZY = (
    "silver_articles", "gold_by_source", "gold_by_date", "gold_by_author", "row_counts",
    "stg_news_silver", "stg_news_sources", "mart_articles_by_source", "mart_articles_by_date",
    "mart_articles_by_author", "dq_report", "dq_report_raw", "anti_join_seen", "encode_json",
    "decode_json", "rejected_messages", "flatten_api", "existing_urls", "object_key",
    "embedding_text", "vector_metadata", "embed_hashed", "topk_similar",
)
IN_PYTHON = {"topk_similar"}


@pytest.fixture
def plan(spark, sf):
    def of(name):
        # Plans as for tables too large to send to every task.
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            df = queries.QUERIES[name](spark, sf)
            return df._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

    return of


@pytest.mark.parametrize("name", LAZY)
def test_no_pairs_and_no_stray_python(plan, name):
    text = plan(name)
    assert not re.search("CartesianProduct|BroadcastNestedLoop|BroadcastExchange", text)
    python = bool(re.search("EvalPython|MapInArrow|MapInPandas|CoGroup", text))
    assert python == (name in IN_PYTHON)


def test_the_text_is_read_but_not_shuffled_by_date(plan):
    text = plan("gold_by_date")
    assert "content#" not in text
    moved = [line for line in text.splitlines() if re.search(r"SortMergeJoin|Window ", line)]
    assert moved and "text#" not in "".join(moved)


def test_the_anti_join_uses_the_partitioning_by_url(plan):
    text = plan("anti_join_seen")
    assert text.count("Exchange hashpartitioning(url") == 2
    assert "Exchange hashpartitioning(_url" not in text


def test_the_key_check_needs_no_shuffle_of_its_own(plan):
    assert "Exchange hashpartitioning(_key" not in plan("dq_report")


def test_ranking_is_limited_before_the_shuffle(plan):
    text = plan("topk_similar")
    assert "WindowGroupLimit" in text[text.index("Exchange hashpartitioning(q_id"):]


def test_filters_reach_the_scan(plan):
    assert "EqualTo(lang,en)" in plan("anti_join_seen")


def test_a_small_batch_spares_the_large_table_a_shuffle(spark, tmp_path, monkeypatch):
    big = str(tmp_path / "big")
    spark.range(30000).selectExpr("concat('u', id) as url").write.parquet(big)
    stored = spark.read.parquet(big)
    batch = stored.where("url like '%99'").union(spark.createDataFrame([("new",)], "url string"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for limit, sent in ((merge.BROADCAST_KEY_BYTES, True), (100, False)):
            monkeypatch.setattr(merge, "BROADCAST_KEY_BYTES", limit)
            fresh = merge.unmatched_in_large(batch, stored, ["url"], null_safe=False)
            text = fresh._jdf.queryExecution().executedPlan().toString()
            # Only the keys that were found are shuffled, once each, never the scan.
            moved = text.splitlines()
            below = [moved[i + 1] for i, x in enumerate(moved) if "Exchange hashpartitioning" in x]
            assert all("HashAggregate" in x for x in below) == sent
            assert ("SortMergeJoin" not in text) == sent
            assert ("BroadcastHashJoin" in text) == sent
            assert [r.url for r in fresh.collect()] == ["new"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
