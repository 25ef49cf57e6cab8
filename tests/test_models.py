from pyspark.sql import functions as F

from newslake.operators import quality
from newslake.operators.refine import refine
from newslake.plans import models

COLUMNS = "url string, title string, source string"


def checks(df):
    return {(r.check, r.model, r.column): (r.failing_rows, r.passed) for r in df.collect()}


def test_checks_count_what_is_wrong(spark):
    df = spark.createDataFrame(
        [("a", "t", None), ("a", "t", None), ("a", None, "s"), ("b", "t", "s"), ("b", "t", "s"),
         ("c", "t", "s"), (None, "t", "s"), (None, "t", "s")], COLUMNS,
    )
    found = quality.report(quality.checks(df, "m", ["url", "title", "source"], ["url", "title"]))
    assert checks(found) == {
        ("unique", "m", "url"): (2, False),
        ("unique", "m", "title"): (1, False),
        ("not_null", "m", "url"): (2, False),
        ("not_null", "m", "title"): (1, False),
        ("not_null", "m", "source"): (2, False),
    }


def test_checks_on_an_empty_table(spark):
    df = spark.createDataFrame([], COLUMNS)
    found = checks(quality.report(quality.checks(df, "m", ["url"], ["url"])))
    assert set(found.values()) == {(0, True)}
    found = checks(quality.report(quality.checks(df, "m", ["url"], [])))
    assert found == {("not_null", "m", "url"): (0, True)}


def test_unreadable_dates_show_in_the_report(bronze):
    silver = refine(bronze(
        {"url": "1", "title": "t", "published_at": "bad"},
        {"url": "2", "title": "t", "published_at": "2024-01-01"},
    ))
    found = checks(models.checked(models.build_models(silver)))
    assert found[("not_null", "stg_news_silver", "published_at")] == (1, False)
    assert len(found) == 7 and sum(ok for _, ok in found.values()) == 6


def silver_of(bronze):
    return refine(bronze(
        {"url": "1", "title": "t", "author": "Unknown", "source": "s", "published_at": "2024-01-01"},
        {"url": "2", "title": "t", "author": "a", "source": "s", "published_at": "2024-01-01"},
        {"url": "3", "title": "t", "author": "a", "source": "s", "published_at": "2024-01-02"},
        {"url": "4", "title": "t", "author": "", "source": "r", "content": "1234"},
    ))


def test_marts(spark, bronze):
    built = models.build_models(silver_of(bronze))
    by_date = {str(r.published_date): tuple(r)[3:] for r in built["mart_articles_by_date"].collect()}
    assert by_date == {"2024-01-01": (2, 1, 2), "2024-01-02": (1, 1, 1), "None": (1, 1, 1)}
    by_source = {r.source: (r.total_articles, r.active_days, r.avg_content_length)
                 for r in built["mart_articles_by_source"].collect()}
    assert by_source == {"s": (3, 2, None), "r": (1, 0, 4.0)}
    authors = {(r.author, r.source): (r.total_articles, r.active_days)
               for r in built["mart_articles_by_author"].collect()}
    assert authors == {("a", "s"): (2, 2), ("", "r"): (1, 0)}


def test_models_can_be_queried_by_name(spark, bronze, tmp_path):
    for _ in range(2):
        models.store_models(spark, silver_of(bronze), str(tmp_path))
    assert spark.sql("select sum(total_articles) from stg_news_sources").first()[0] == 4
    assert spark.sql("select count(*) from mart_articles_by_date").first()[0] == 3
    comments = {f.name: f.metadata.get("comment") for f in spark.table("stg_news_silver").schema}
    assert comments["url"] and comments["author"] is None
    spark.sql("create database if not exists marts_test")
    for _ in range(2):
        models.save_marts(silver_of(bronze), "marts_test")
    assert spark.table("marts_test.mart_articles_by_source").count() == 2
    spark.sql("drop database marts_test cascade")


def test_descriptions_stay_out_of_the_rows(bronze):
    silver = silver_of(bronze)
    plain = models.stg_news_silver(silver)
    described = models.described(plain, models.MODELS["stg_news_silver"])
    assert plain.exceptAll(described.select(*[F.col(c) for c in plain.columns])).count() == 0
