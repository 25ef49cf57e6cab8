"""Readers of whole texts: the same rows as before, the texts moved and stored small."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from newslake import fixtures
from newslake.operators import vectors
from newslake.plans import queries
from newslake.sources import tables, topics


@pytest.fixture
def odd(spark, tmp_path):
    """Documents and events with nulls and repeated keys, and documents without an event."""
    words = [f"First {i}. Second {'word ' * 300}{i}." for i in range(130)]
    documents = [(i, w, ("en", "de", None)[i % 3], f"src{i % 4}") for i, w in enumerate(words)]
    documents += [(7, words[7], "en", "src3"), (7, "Another. text", "en", None), (None, "No number.", "en", "src1")]
    documents += [(131, None, "en", "src1"), (132, words[3], "de", "src1"), (133, "", None, None)]
    at = dt.datetime(2024, 1, 1)
    kinds = ("error", "signup", "view", "buy", None)
    events = [(i, at + dt.timedelta(hours=i), i * 7, kinds[i % 5]) for i in range(0, 400, 3)]
    events += [(6, at, 1, "buy"), (None, at, 2, "buy"), (9, None, None, "buy")]
    spark.createDataFrame(documents, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(events, "event_id long, ts timestamp, user_id long, event_type string").write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


@pytest.fixture
def no_broadcast(spark):
    """As where the events are too many to be sent to all."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def rows(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def exchanged(df):
    """Per exchange of the plan, the names of the columns that go through it."""
    text = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return [re.findall(r"(\w+)#\d+", m) for m in re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", text)]


def test_the_readers_give_the_rows_of_articles(spark, odd):
    known = fixtures.articles(spark, odd)
    assert rows(fixtures.whole_articles(spark, odd)) == rows(known)
    paged = fixtures.paged_articles(spark, odd, 50)
    assert rows(paged.drop("page")) == rows(known)
    assert not paged.where("not (page <=> floor(ingest_seq / 50))").count()
    digest = F.md5(F.concat_ws("|", "title", "description", "content"))
    expected = known.select("ingest_seq", digest.alias("digest"), "url", "source", "published_at", "author", "lang")
    assert rows(fixtures.digested_articles(spark, odd, digest)) == rows(expected)


def test_a_text_is_shuffled_once_to_its_page(spark, odd, no_broadcast):
    wide = [c for c in exchanged(queries._responses(spark, odd)) if {"text", "content", "title"} & set(c)]
    assert len(wide) == 1 and "content" not in wide[0]


def test_a_text_meets_its_event_unsorted_and_uncut(spark, odd, no_broadcast):
    met = fixtures.whole_articles(spark, odd)
    assert [c for c in exchanged(met) if {"title", "description", "content"} & set(c)] == []
    assert "SortMergeJoin" not in met._jdf.queryExecution().toString()


def test_the_comparison_shuffles_no_text_and_sees_a_word(spark, odd, no_broadcast):
    rows_sent = fixtures.articles(spark, odd).where("url is not null and description is not null")
    rows_sent.drop("ingest_seq", "lang").write.parquet(f"{odd}/sent")
    sent = spark.read.parquet(f"{odd}/sent")
    found = queries._whole(spark, odd, sent)
    assert not [c for c in exchanged(found) if {"text", "title", "description", "content"} & set(c)]
    assert found.where("not whole").count() == 0 and found.count() == sent.count()
    for changed in ("title", "description", "content", "author"):
        other = sent.withColumn(changed, F.concat(F.coalesce(changed, F.lit("")), F.lit("x")))
        assert queries._whole(spark, odd, other).where("whole").count() == 0
    moved = sent.withColumns({"content": F.col("description"), "description": F.col("content")}).where("not (content <=> description)")
    assert queries._whole(spark, odd, moved).where("whole").count() == 0


def test_messages_are_stored_smaller_than_their_json(spark, odd, tmp_path):
    sent = fixtures.articles(spark, odd)
    topics.publish_files(sent, f"{tmp_path}/topic")
    stored = sum(f.stat().st_size for f in (tmp_path / "topic").glob("part-*"))
    lines = spark.read.text(f"{tmp_path}/topic")
    assert lines.count() == sent.count()
    assert 0 < 2 * stored < lines.agg(F.sum(F.octet_length("value"))).first()[0]


def test_tables_of_texts_and_vectors_are_stored_with_zstd(spark, odd, tmp_path):
    silver = queries._silver(spark, odd)
    tables.insert_new(silver, f"{tmp_path}/silver", ["url"], "a")
    vectors.write_vectors(silver, f"{tmp_path}/vectors", "a")
    for name in ("silver", "vectors"):
        parts = list((tmp_path / name / "batch=a").glob("part-*"))
        assert parts and all(".zstd." in p.name for p in parts)
    assert rows(tables.read_inserted(spark, f"{tmp_path}/silver")) == rows(silver)
