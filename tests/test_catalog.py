from newslake.operators.refine import refine
from newslake.plans import catalog, models
from newslake.sources import tables


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_catalog_models_follow_silver(spark, bronze, tmp_path):
    root = str(tmp_path)
    load = lambda n: refine(bronze(*[
        {"url": f"u{n}{i}", "title": "it's", "source": f"s{i % 2}", "author": "a", "published_at": f"2024-01-0{i + 1}"} for i in range(3)
    ]))
    for n in range(3):
        tables.insert_new(load(n), f"{root}/silver", ["url"])
        catalog.store(spark, f"{root}/silver", "models_test", root)
        built = models.build_models(tables.read_inserted(spark, f"{root}/silver"))
        for name, expected in built.items():
            stored = spark.table(f"models_test.{name}")
            assert stored.columns == expected.columns
            assert rows(stored) == rows(expected), name
    # Views follow by themselves, marts when they are rebuilt, by a folder of their own.
    mart = spark.table("models_test.mart_articles_by_source")
    tables.insert_new(load(3), f"{root}/silver", ["url"])
    assert spark.table("models_test.stg_news_silver").count() == 12
    assert sum(r.total_articles for r in mart.collect()) == 9
    assert len(list((tmp_path / "mart_articles_by_source").iterdir())) == 2
    kinds = {t.name: t.tableType for t in spark.catalog.listTables("models_test")}
    assert kinds["stg_news_silver"] == kinds["stg_news_sources"] == "VIEW"
    assert kinds["mart_articles_by_date"] == "EXTERNAL"
    comments = {c.name: c.description for c in spark.catalog.listColumns("models_test.stg_news_silver")}
    assert comments["url"] == models.MODELS["stg_news_silver"].columns["url"] and not comments["author"]
    assert spark.catalog.getTable("models_test.stg_news_sources").description == models.MODELS["stg_news_sources"].about
    spark.sql("drop database models_test cascade")
