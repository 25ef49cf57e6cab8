"""Article-shaped view over the benchmark tables ``documents`` and ``events``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Runs unchanged in Spark SQL and in the checking engine. Every event belongs to
# a document, one of its events gives its date and author. A title is a text's first
# sentence, the description is the rest; where the content is taken away, the
# description stays.
_CUT = """case when doc_id % 11 = 0 then null else ' ' || split_part(text, '.', 1) || ' ' end as title,
             case when doc_id % 5 = 0 and doc_id % 7 <> 0 then null
                  else substr(text, length(split_part(text, '.', 1)) + 2) end as description,
             case when doc_id % 7 = 0 then null else text end as content,
             case when doc_id % 13 = 0 then null
                  when md5(text) < '1' then 'https://news.example/' || md5(text) || repeat('/part', 100)
                  else 'https://news.example/' || md5(text) end as url,
             case when source = 'src0' then null else ' ' || source end as source,
             lang"""
_EVENTS = """select event_id % (select max(doc_id) + 1 from {documents}) as doc_id,
                  min_by(ts, md5(cast(event_id as varchar(20)))) as ts,
                  min_by(event_type, md5(cast(event_id as varchar(20)))) as event_type,
                  min_by(user_id, md5(cast(event_id as varchar(20)))) as user_id
           from {events} group by 1"""
_DATED = """case when d.doc_id % 17 = 0 then 'not-a-date' else cast(e.ts as varchar(40)) end as published_at,
       case when e.event_type = 'error'  then null
            when e.event_type = 'signup' then ' Unknown '
            when e.event_type = 'view'   then '  '
            else 'user' || cast(e.user_id % 20 as varchar(20)) end as author,
       d.lang"""
ARTICLES_SQL = f"""
select d.doc_id as ingest_seq, d.title, d.description, d.content, d.url, d.source,
       {_DATED}
from (select doc_id,
             {_CUT}
      from {{documents}}) d
left join ({_EVENTS}) e on e.doc_id = d.doc_id
"""
_TEXTS = ("title", "description", "content")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as articles; ``ingest_seq`` stands for arrival order."""
    return spark.sql(
        ARTICLES_SQL,
        documents=table(spark, sf_dir, "documents"),
        events=table(spark, sf_dir, "events"),
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event of each document, as the struct ``e``."""
    found = spark.sql(
        _EVENTS, documents=table(spark, sf_dir, "documents"), events=table(spark, sf_dir, "events")
    )
    return found.select("doc_id", F.struct("ts", "event_type", "user_id").alias("e"))


def _met(documents: DataFrame, events: DataFrame, key: str) -> DataFrame:
    """Documents with their events. The events are hashed in every task, so the
    texts are not sorted, and the driver has none of either."""
    return documents.join(events.hint("shuffle_hash"), key, "left")


def _dated(met: DataFrame, *names: str) -> DataFrame:
    """Articles of documents that have met their event; ``names`` are their other columns."""
    columns = ", ".join(f"d.{name}" for name in names)
    return met.sparkSession.sql(
        f"select d.doc_id as ingest_seq, {columns}, {_DATED} from {{met}} d", met=met
    )


def _cut(documents: DataFrame, *more: str) -> DataFrame:
    kept = "".join(f", {name}" for name in more)
    return documents.sparkSession.sql(f"select doc_id, {_CUT}{kept} from {{documents}}", documents=documents)


def whole_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``articles``, for readers of the whole texts: a text is shuffled
    once, and title, description and content are cut from it afterwards."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    met = _met(documents, _events(spark, sf_dir), "doc_id")
    return _dated(_cut(met, "e"), *_TEXTS, "url", "source")


def paged_articles(spark: SparkSession, sf_dir: str, size: int) -> DataFrame:
    """The rows of ``whole_articles``, with the ``page`` of ``size`` numbers that each
    is in. They meet their events by page, so to group them by page takes no further
    shuffle of the texts."""
    page = F.floor(F.col("doc_id") / size).alias("page")
    events = _events(spark, sf_dir).where("doc_id is not null")
    by_page = events.groupBy(page).agg(
        F.map_from_entries(F.collect_list(F.struct("doc_id", "e"))).alias("found")
    )
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang", page)
    met = _met(documents, by_page, "page").withColumn("e", F.col("found")[F.col("doc_id")])
    return _dated(_cut(met, "e", "page"), *_TEXTS, "url", "source", "page")


def digested_articles(spark: SparkSession, sf_dir: str, digest: Column) -> DataFrame:
    """The rows of ``articles`` with a digest of their title, description and content,
    made before any shuffle, in place of these."""
    cut = _cut(table(spark, sf_dir, "documents")).withColumn("digest", digest).drop(*_TEXTS)
    return _dated(_met(cut, _events(spark, sf_dir), "doc_id"), "digest", "url", "source")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The articles as topic messages; every 19th payload is not JSON."""
    from newslake.functions.messages import encode

    rows = articles(spark, sf_dir)
    body = encode(rows)
    return rows.select(
        "ingest_seq",
        F.when(F.col("ingest_seq") % 19 == 0, "not json").otherwise(body).alias("value"),
    )
