"""Every operator as a query over the benchmark tables."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from newslake.fixtures import articles, digested_articles, messages, paged_articles, table, whole_articles
from newslake.functions import text
from newslake.functions.messages import decode, decode_with, encode, rejected
from newslake.operators import answers, approximate, gold, marts, quality, search, vectors
from newslake.operators.merge import unmatched
from newslake.operators.refine import refine, usable
from newslake.plans import catalog, medallion, models
from newslake.schemas import ARTICLE_FIELDS
from newslake.session import shared_dir
from newslake.sources import files, headlines, landing, tables, topics
from newslake.streaming import embedding, incremental, ingest, late, producer
from newslake.streaming.lander import lander

# The questions asked as a trial.
QUESTIONS = (
    (1, "What is the latest news about Apple?"),
    (2, "What's happening with AI this week?"),
    (3, "Any news about gaming?"),
)

ARRIVAL = ("ingest_seq",)


def _silver(spark: SparkSession, sf: str) -> DataFrame:
    return refine(articles(spark, sf), ARRIVAL, total_order=True)


def _first_load(spark: SparkSession, sf: str, read=articles) -> DataFrame:
    return read(spark, sf).where("lang = 'en'")


def _later_load(spark: SparkSession, sf: str, read=articles) -> DataFrame:
    return read(spark, sf).where("not (lang <=> 'en')")


def _staged(spark: SparkSession, sf: str) -> DataFrame:
    return models.stg_news_silver(_silver(spark, sf))


# Cleaning and aggregates


def silver_articles(spark, sf):
    return _silver(spark, sf)


def gold_by_source(spark, sf):
    return gold.largest_first(gold.by_source(_silver(spark, sf)), "source")


def gold_by_date(spark, sf):
    return gold.newest_first(gold.by_date(_silver(spark, sf)), "date")


def gold_by_author(spark, sf):
    return gold.largest_first(gold.by_author(_silver(spark, sf)), "author", "source")


def gold_total_check(spark, sf):
    """The whole batch run over stored tables, then its reconciliation."""
    root = shared_dir(spark, "medallion")
    bronze = articles(spark, sf)
    medallion.load_silver(bronze, f"{root}/silver", ARRIVAL)
    medallion.load_gold(tables.read_inserted(spark, f"{root}/silver", True), f"{root}/gold")
    return medallion.check_gold(spark, f"{root}/silver", f"{root}/gold")


def row_counts(spark, sf):
    rows = articles(spark, sf)
    return rows.agg(
        F.count("*").alias("bronze_rows"),
        F.count_if(F.col("title").isNotNull() & F.col("url").isNotNull()).alias("usable_rows"),
    )


# Models and checks


def stg_news_silver(spark, sf):
    return _staged(spark, sf)


def stg_news_sources(spark, sf):
    return models.stg_news_sources(_silver(spark, sf))


def mart_articles_by_source(spark, sf):
    return gold.largest_first(models.mart_articles_by_source(_staged(spark, sf)), "source")


def mart_articles_by_date(spark, sf):
    return gold.newest_first(models.mart_articles_by_date(_staged(spark, sf)), "published_date")


def mart_articles_by_author(spark, sf):
    mart = models.mart_articles_by_author(_staged(spark, sf))
    return gold.largest_first(mart, "author", "source")


def models_stored(spark, sf):
    """All models in the catalog, over a Silver table stored in two loads; the
    marts are rebuilt after each, the views follow by themselves."""
    root = shared_dir(spark, "models")
    database = f"models_{root.rsplit('-', 1)[-1]}"
    for load in (_first_load, articles):
        tables.insert_new(refine(load(spark, sf), ARRIVAL, True), f"{root}/silver", ["url"])
        catalog.store(spark, f"{root}/silver", database, root)
    found = [spark.table(f"{database}.{name}").withColumn("model", F.lit(name)) for name in models.MODELS]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)


def load_verified(spark, sf):
    """Rows counted in the job that wrote them, beside those of a look afterwards."""
    path = shared_dir(spark, "silver")
    seen = Observation()
    tables.insert_new(_silver(spark, sf), path, ["url"], watch=(seen, quality.watched(["published_at"])))
    stored, shown = tables.verify(spark, path)
    rows = [(seen.get["rows"], seen.get["null_published_at"], stored, len(shown))]
    return spark.createDataFrame(rows, "written long, undated long, stored long, shown long")


def dq_report(spark, sf):
    return models.checked(models.build_models(_silver(spark, sf)))


def dq_report_raw(spark, sf):
    """The same checks on uncleaned articles, where they have much to report."""
    raw = articles(spark, sf).select(
        "url", "title", "source", F.try_to_timestamp("published_at").alias("published_at")
    )
    return models.checked({"stg_news_silver": raw, "stg_news_sources": raw})


# Merges


def upsert_insert_only(spark, sf):
    """English articles first, then all: known URLs keep their first row."""
    path = shared_dir(spark, "silver")
    tables.insert_new(refine(_first_load(spark, sf), ARRIVAL, True), path, ["url"])
    tables.insert_new(_silver(spark, sf), path, ["url"])
    return tables.read_inserted(spark, path)


def _upserted(spark, sf, rollup):
    """An aggregate of the English articles, then that of all merged into it:
    groups are updated, added or left as they were."""
    path = shared_dir(spark, "gold")
    first = refine(_first_load(spark, sf), ARRIVAL, True)
    for silver in (first, _silver(spark, sf)):
        tables.upsert(rollup(silver), path, rollup.keys)
    return tables.read_snapshot(spark, path)


def upsert_update_insert(spark, sf):
    """Grain and key are author and source."""
    return _upserted(spark, sf, gold.by_author)


def upsert_null_key(spark, sf):
    """The null date is one key, updated like the others."""
    return _upserted(spark, sf, gold.by_date)


def anti_join_seen(spark, sf):
    """Later articles whose URL the first load does not have."""
    seen = usable(_first_load(spark, sf)).select("url").distinct()
    new = unmatched(_silver(spark, sf), seen, ["url"], null_safe=False)
    return new.select("url", "title", "ingest_seq")


# Messages, responses, landing


def encode_json(spark, sf):
    rows = articles(spark, sf)
    return rows.select("ingest_seq", encode(rows).alias("value"))


def decode_json(spark, sf):
    return decode(messages(spark, sf).select("value"))


def decode_variant(spark, sf):
    """Messages with fields that the schema doesn't know, some of them nested."""
    rows = articles(spark, sf)
    names = F.array("source", "author")
    whole = F.struct(*ARTICLE_FIELDS, F.col("ingest_seq").alias("seq"), F.struct("lang", names.alias("names")).alias("meta"))
    sent = rows.select(
        F.when(F.col("ingest_seq") % 19 == 0, "not json").otherwise(F.to_json(whole)).alias("value")
    )
    fields = {
        "seq": ("$.seq", "bigint"), "lang": ("$.meta.lang", "string"),
        "second": ("$.meta.names[1]", "string"), "none": ("$.meta.none", "string"),
    }
    return decode_with(sent, fields)


def rejected_messages(spark, sf):
    bad = rejected(messages(spark, sf))
    return bad.groupBy("_raw").agg(F.count("*").alias("messages"))


def _responses(spark: SparkSession, sf: str) -> DataFrame:
    """Articles packed into responses of fifty, more than were asked for; every
    fifth is an error."""
    rows = paged_articles(spark, sf, 50)
    entry = F.struct(
        "ingest_seq", "title", "description", "content", "url",
        F.when(F.col("source").isNotNull(), F.struct(F.col("source").alias("name"))).alias("source"),
        F.col("published_at").alias("publishedAt"), "author",
    )
    packed = rows.groupBy("page").agg(F.sort_array(F.collect_list(entry)).alias("articles"))
    status = F.when(F.col("page") % 5 == 4, "error").otherwise("ok")
    return packed.select(
        F.lit(headlines.LANGUAGE).alias("language"),
        F.lit(headlines.CATEGORY).alias("category"),
        F.to_json(F.struct(status.alias("status"), "articles")).alias("body"),
    )


def flatten_api(spark, sf):
    return headlines.flattened(headlines.fetched(_responses(spark, sf)))


def flatten_api_page(spark, sf):
    """Only as many articles of a response as were asked for."""
    asked = headlines.fetched(_responses(spark, sf), page=headlines.PAGE_SIZE)
    return headlines.flattened(asked)


def existing_urls(spark, sf):
    """URLs of landed objects; every third has no tag, only its body."""
    rows = usable(articles(spark, sf))
    tag = F.when(F.col("ingest_seq") % 3 != 0, text.url_tag(F.col("url")))
    return landing.stored_urls(rows.select(tag.alias("article_url"), encode(rows).alias("body")))


def _arrived():
    """The published date stands for the arrival; undated articles have one too."""
    return F.coalesce(
        F.try_to_timestamp("published_at"), F.lit("2024-01-01 00:00:00").cast("timestamp")
    )


def object_key(spark, sf):
    rows = usable(articles(spark, sf))
    return rows.select(
        "ingest_seq",
        text.object_key(F.col("title"), _arrived()).alias("object_key"),
        text.url_tag(F.col("url")).alias("article_url"),
        text.preview(F.col("title")).alias("preview"),
    )


def landed_articles(spark, sf):
    """Articles written to the landing area and read back."""
    path = shared_dir(spark, "landed")
    landing.land(landing.landing_rows(articles(spark, sf), _arrived()), path)
    return landing.read_landed(spark, path)


# Streams


def _send(rows: DataFrame, path: str) -> None:
    rows.select("value").write.mode("append").text(path)


def stream_bronze(spark, sf):
    root = shared_dir(spark, "bronze")
    _send(messages(spark, sf), f"{root}/topic")
    stream = topics.read_message_files(spark, f"{root}/topic")
    topics.run(
        ingest.bronze_writer(ingest.raw_articles(stream), f"{root}/table", f"{root}/checkpoint")
    )
    return tables.scan(spark, f"{root}/table").drop("ingested_at")


def _whole(spark, sf, sent):
    """Messages beside the articles: which of a URL's copies stays is open, but
    it has to be one of them, word for word. The texts are compared by a SHA-256 of
    the three, so they are read but not shuffled."""
    texts = ("title", "description", "content")
    digest = F.sha2(F.to_json(F.struct(*texts), {"ignoreNullFields": "false"}), 256)
    told = [c for c in ARTICLE_FIELDS if c not in texts]
    known = digested_articles(spark, sf, digest).select("digest", *told).distinct().withColumn("whole", F.lit(True))
    sent = sent.select(digest.alias("digest"), *told)
    same = reduce(and_, (sent[c].eqNullSafe(known[c]) for c in sent.columns))
    return sent.join(known, same, "left").select(sent.url, F.coalesce("whole", F.lit(False)).alias("whole"))


def stream_produce(spark, sf):
    """Two deliveries of the same responses; each URL is sent once, and every
    article without one. The second delivery is a copy of the first one's files."""
    root = shared_dir(spark, "producer")
    for again in (False, True):
        stored = spark.read.schema(producer.RESPONSE)
        responses = stored.json(f"{root}/responses") if again else _responses(spark, sf)
        responses.write.mode("append").options(**files.COMPRESSED_TEXT).json(f"{root}/responses")
        topics.run(
            producer.producer(
                producer.read_responses(spark, f"{root}/responses"),
                producer.to_files(f"{root}/topic"), f"{root}/checkpoint",
            )
        )
    sent = decode(spark.read.option("recursiveFileLookup", "true").text(f"{root}/topic"))
    return _whole(spark, sf, sent)


def stream_land(spark, sf):
    """Two loads of messages, landed by one stream that restarts between."""
    root = shared_dir(spark, "lander")
    for load in (_first_load, _later_load):
        topics.publish_files(load(spark, sf, whole_articles), f"{root}/topic")
        stream = topics.read_message_files(spark, f"{root}/topic")
        topics.run(lander(stream, f"{root}/landed", f"{root}/seen", f"{root}/checkpoint"))
    landed = landing.read_landed(spark, f"{root}/landed")
    return _whole(spark, sf, landed).join(landed.select("url", "article_url"), "url")


def stream_rejects(spark, sf):
    """Payloads that are no articles, from one stream, and those that could not
    be landed, from another."""
    root = shared_dir(spark, "rejects")
    _send(messages(spark, sf), f"{root}/topic")
    stream = topics.read_message_files(spark, f"{root}/topic")
    topics.run(ingest.reject_writer(stream, f"{root}/unread", f"{root}/checkpoint-1"))
    topics.run(
        lander(stream, f"{root}/landed", f"{root}/seen", f"{root}/checkpoint-2", rejects=f"{root}/unlanded")
    )
    kinds = [tables.scan(spark, f"{root}/{k}").select(F.lit(k).alias("kind"), "_raw") for k in ("unread", "unlanded")]
    return kinds[0].union(kinds[1])


def _incremental(spark, sf, **more):
    root = shared_dir(spark, "incremental")
    for load in (_first_load, _later_load):
        load(spark, sf).write.mode("append").parquet(f"{root}/bronze")
        bronze = spark.readStream.schema(articles(spark, sf).schema).parquet(f"{root}/bronze")
        topics.run(
            incremental.refiner(
                bronze, f"{root}/silver", f"{root}/gold", f"{root}/checkpoint", ARRIVAL, True,
                **{name: f"{root}/{place}" for name, place in more.items()},
            )
        )
    return root


def stream_silver(spark, sf):
    return tables.read_inserted(spark, f"{_incremental(spark, sf)}/silver")


def stream_gold_by_source(spark, sf):
    return medallion.read_gold(spark, f"{_incremental(spark, sf)}/gold", "by_source")


def stream_gold_by_date(spark, sf):
    return medallion.read_gold(spark, f"{_incremental(spark, sf)}/gold", "by_date")


def stream_gold_by_author(spark, sf):
    return medallion.read_gold(spark, f"{_incremental(spark, sf)}/gold", "by_author")


def _stream_mart(spark, sf, name):
    root = _incremental(spark, sf, mart_states="marts")
    return marts.MARTS[name](tables.read_snapshot(spark, f"{root}/marts"))


def stream_mart_by_source(spark, sf):
    return _stream_mart(spark, sf, "mart_articles_by_source")


def stream_mart_by_date(spark, sf):
    return _stream_mart(spark, sf, "mart_articles_by_date")


def stream_mart_by_author(spark, sf):
    return _stream_mart(spark, sf, "mart_articles_by_author")


def stream_dq(spark, sf):
    """The checks of both loads as the stream wrote them, as one report."""
    return incremental.read_checks(spark, f"{_incremental(spark, sf, checks='checks')}/checks")


def late_windows(spark, sf):
    """Daily counts of events once their day is closed."""
    root = shared_dir(spark, "windows")
    schema = table(spark, sf, "events").schema
    # A pattern, because a stream cannot be opened on the path of a single file.
    events = spark.readStream.schema(schema).parquet(f"{sf.rstrip('/')}/event[s].parquet")
    counts = late.window_counts(events.withColumn("ts", F.col("ts").cast("timestamp")), "ts", "1 day")
    topics.run(
        counts.writeStream.format("parquet")
        .option("path", f"{root}/table")
        .option("checkpointLocation", f"{root}/checkpoint")
    )
    return spark.read.schema(counts.schema).parquet(f"{root}/table")


def late_rejects(spark, sf):
    """Every event of two loads, and whether it came behind the watermark."""
    root = shared_dir(spark, "split")
    rows = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    for part in range(2):
        rows.where(F.col("event_id") % 2 == part).write.mode("append").parquet(f"{root}/events")
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/events")
        topics.run(late.split_late(stream, "ts", "5 days", f"{root}/split", f"{root}/checkpoint"))
    kinds = [late.read_split(spark, f"{root}/split", kind).withColumn("late", F.lit(kind)) for kind in (False, True)]
    return kinds[0].union(kinds[1]).select("event_id", "late")


def late_dedup(spark, sf):
    """Distinct URLs of articles, with bounded state."""
    root = shared_dir(spark, "repeats")
    dated = usable(articles(spark, sf)).select("url", _arrived().alias("published_at"))
    dated.write.parquet(f"{root}/bronze")
    stream = spark.readStream.schema("url string, published_at timestamp").parquet(f"{root}/bronze")
    kept = late.without_repeats(stream, "url", "published_at", "40 days").select("url")
    topics.run(
        kept.writeStream.format("parquet")
        .option("path", f"{root}/table")
        .option("checkpointLocation", f"{root}/checkpoint")
    )
    return spark.read.schema("url string").parquet(f"{root}/table")


# Vectors and answers


def embedding_text(spark, sf):
    return vectors.embeddable(_silver(spark, sf)).select(
        "url",
        text.embedding_text(F.col("title"), F.col("description"), F.col("content")).alias("text"),
    )


def vector_metadata(spark, sf):
    meta = vectors.metadata().alias("metadata")
    return vectors.embeddable(_silver(spark, sf)).select(meta).select("metadata.*")


def embed_hashed(spark, sf):
    """Non-zero places of each article's vector."""
    built = vectors.article_vectors(_silver(spark, sf))
    places = built.select("id", F.posexplode("values").alias("place", "weight"))
    return places.where("weight <> 0")


def _weights(stored):
    """Non-zero places of stored vectors, with the source they are stored with."""
    places = stored.select(
        "id", F.col("metadata.source").alias("source"), F.posexplode("values").alias("place", "weight")
    )
    return places.where("weight <> 0")


def vector_upsert(spark, sf):
    """Vectors of a first load, then of all."""
    path = shared_dir(spark, "vectors")
    first = refine(_first_load(spark, sf), ARRIVAL, True)
    vectors.store_vectors(first, path)
    vectors.store_vectors(_silver(spark, sf), path)
    return _weights(tables.read_snapshot(spark, path))


def vector_counts(spark, sf):
    """How many vectors each of the two layouts holds."""
    root = shared_dir(spark, "vectors")
    vectors.store_vectors(_silver(spark, sf), f"{root}/replaced")
    vectors.store_new_vectors(_silver(spark, sf), f"{root}/inserted")
    counts = [(n, vectors.vector_count(spark, f"{root}/{n}")) for n in ("replaced", "inserted")]
    return spark.createDataFrame(counts, "layout string, vectors long")


def stream_vectors(spark, sf):
    """Vectors added after each load of Silver; the first load is written again
    in the middle, as after a crash."""
    root = shared_dir(spark, "vectors")
    first, later = _first_load(spark, sf, whole_articles), whole_articles(spark, sf)
    for name, load in (("first", first), ("first", first), ("later", later)):
        tables.insert_new(refine(load, ARRIVAL, True), f"{root}/silver", ["url"], name)
        topics.run(
            embedding.vector_writer(
                spark, f"{root}/silver", f"{root}/vectors", f"{root}/checkpoint"
            )
        )
    return _weights(tables.scan(spark, f"{root}/vectors"))


def _label_means(rows):
    mean = Summarizer.mean(array_to_vector(F.col("embedding").cast("array<double>")))
    return rows.groupBy(F.col("label").alias("q_id")).agg(vector_to_array(mean).alias("values"))


def topk_similar(spark, sf):
    """Nearest vectors to the mean vector of each label, among vectors of which
    some are null, zero, or hold something that is no number."""
    rows = table(spark, sf, "embeddings")
    topics_ = _label_means(rows)
    stored = rows.select(F.col("vec_id").alias("id"), F.col("embedding").alias("values"))
    broken = (
        F.when(F.col("vec_id") % 4 == 0, F.transform("embedding", lambda x: x * float("nan")))
        .when(F.col("vec_id") % 4 == 1, F.transform("embedding", lambda x: x * 0))
        .when(F.col("vec_id") % 4 == 2, F.transform("embedding", lambda x, i: F.when(i > 0, x)))
    )
    odd = rows.select((-1 - F.col("vec_id")).alias("id"), broken.cast("array<float>").alias("values"))
    return search.nearest(stored.union(odd), topics_, k=10)


def topk_lsh(spark, sf):
    """Vectors found by hash tables near every fortieth vector, whose keys are
    stored with them. No table is small enough here for an exact search."""
    path = shared_dir(spark, "keyed")
    rows = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("values"))
    approximate.with_keys(rows).write.parquet(path)
    asked = rows.where("id % 40 = 0").select(F.col("id").alias("q_id"), "values")
    return approximate.nearest(tables.scan(spark, path), asked, k=10, exact_rows=0)


def _questions(spark):
    return spark.createDataFrame(QUESTIONS, "q_id int, question string")


def _hits(spark, sf):
    path = shared_dir(spark, "vectors")
    vectors.store_new_vectors(_silver(spark, sf), path)
    stored = tables.read_inserted(spark, path)
    found = search.nearest(stored, vectors.question_vectors(_questions(spark)))
    return search.with_metadata(found, stored)


def rag_context(spark, sf):
    return answers.contexts(_hits(spark, sf)).select("q_id", "context")


def rag_prompt(spark, sf):
    asked = answers.prompts(_questions(spark), _hits(spark, sf))
    return asked.select("q_id", "question", "prompt", "fallback_answer")


def rag_sources(spark, sf):
    asked = answers.prompts(_questions(spark), _hits(spark, sf))
    return answers.sources_used(asked).select("q_id", "question", F.array_join("sources", "; ").alias("sources"))


def source_links(spark, sf):
    return answers.source_list(_hits(spark, sf))


QUERIES = {
    f.__name__: f
    for f in (
        silver_articles, gold_by_source, gold_by_date, gold_by_author, gold_total_check,
        row_counts, stg_news_silver, stg_news_sources, mart_articles_by_source,
        mart_articles_by_date, mart_articles_by_author, models_stored, load_verified, dq_report, dq_report_raw,
        upsert_insert_only, upsert_update_insert, upsert_null_key, anti_join_seen,
        encode_json, decode_json, decode_variant, rejected_messages, flatten_api, flatten_api_page, existing_urls, object_key,
        landed_articles, stream_bronze, stream_produce, stream_land, stream_silver, stream_gold_by_source,
        stream_gold_by_date, stream_gold_by_author, stream_mart_by_source, stream_mart_by_date,
        stream_mart_by_author, stream_rejects, vector_counts,
        stream_dq, late_windows, late_rejects, late_dedup, embedding_text, vector_metadata, embed_hashed, vector_upsert, stream_vectors,
        topk_similar, topk_lsh, rag_context, rag_prompt, rag_sources, source_links,
    )
}
