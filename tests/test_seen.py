import glob

import pytest
from newslake.plans import medallion
from newslake.sources import seen, tables, topics
from newslake.streaming import incremental
from newslake.streaming.once import new_urls, remember
from pyspark.sql import functions as F


def urls(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "url string")


def found(df):
    return sorted(r.url for r in df.collect())


def test_files_opened_follow_the_batch(spark, tmp_path):
    path = str(tmp_path / "seen")
    seen.create(spark, path, 128)
    for load in range(3):
        ids = spark.range(2000 * load, 2000 * (load + 1))
        remember(ids.select(F.concat(F.lit("u"), "id").alias("url")), path, f"load-{load}")
    everything = len(glob.glob(f"{path}/keys/*/*.parquet"))
    assert everything == 3 * 128
    few = urls(spark, "u5", "u4000", "new")
    stored = seen.lookup(few, path, ["url"], "now")
    assert 3 <= len(stored.inputFiles()) <= 9
    assert found(new_urls(few, path, "now")) == ["new"]
    assert len(seen.lookup(few, path, ["url"], "now", everywhere=True).inputFiles()) == everything


def test_an_attempt_counts_in_place_of_those_before(spark, tmp_path):
    path = str(tmp_path / "seen")
    remember(urls(spark, "a", "b"), path, "one")
    remember(urls(spark, "a"), path, "one")
    assert found(new_urls(urls(spark, "a", "b", "c"), path, "two")) == ["b", "c"]
    assert found(new_urls(urls(spark, "a", "b", "c"), path, "one")) == ["a", "b", "c"]
    assert seen.added(spark, path) == {"one"}


def test_compacting_keeps_all_keys(spark, tmp_path):
    path = str(tmp_path / "seen")
    for load in range(6):
        remember(urls(spark, *(f"u{i}" for i in range(load, load + 40))), path, f"load-{load}")
    remember(urls(spark, "u3"), path, "load-0")  # its 39 other keys count no longer
    assert seen.compact(spark, path, most=2) > 0
    assert all(len(glob.glob(f"{d}/*.parquet")) <= 2 for d in glob.glob(f"{path}/keys/*"))
    assert seen.compact(spark, path, most=2) == 0
    asked = urls(spark, *(f"u{i}" for i in range(60)))
    assert found(new_urls(asked, path, "now")) == sorted(["u0", *(f"u{i}" for i in range(45, 60))])


def test_loads_of_a_lost_run_are_listed_later(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "silver")
    add, lost = seen.add, []

    def lose(*args, **kwargs):
        lost.append(args)
        raise RuntimeError("lost")

    monkeypatch.setattr(seen, "add", lose)
    with pytest.raises(RuntimeError):
        tables.insert_new(urls(spark, "a", "b"), path, ["url"], "one")
    monkeypatch.setattr(seen, "add", add)
    tables.insert_new(urls(spark, "b", "c"), path, ["url"], "two", small_batch=True)
    assert found(tables.read_inserted(spark, path)) == ["a", "b", "c"]


def test_a_load_that_is_replaced_frees_its_keys(spark, tmp_path):
    path = str(tmp_path / "silver")
    tables.insert_new(urls(spark, "a", "b"), path, ["url"], "one")
    tables.insert_new(urls(spark, "a"), path, ["url"], "one")
    tables.insert_new(urls(spark, "a", "b"), path, ["url"], "two")
    assert found(tables.read_inserted(spark, path)) == ["a", "b"]


def test_tables_without_a_list_get_one(spark, tmp_path):
    path = str(tmp_path / "silver")
    urls(spark, "a").write.parquet(f"{path}/batch=old")
    urls(spark).write.parquet(f"{path}/batch=empty")
    tables.insert_new(urls(spark, "a", "b"), path, ["url"], "new", small_batch=True)
    assert found(tables.read_inserted(spark, path)) == ["a", "b"]
    assert {"old", "new"} <= seen.added(spark, f"{path}/_seen")


@pytest.mark.parametrize("first", ["batch", "stream"])
def test_batch_and_stream_share_a_silver_by_day(spark, bronze, tmp_path, first):
    root = str(tmp_path)
    dated = lambda url, day, at: {"url": url, "title": "t", "published_at": f"2024-01-0{day} 10:00:00", "at": at}
    bronze(dated("a", 1, 0), dated("b", 2, 1)).write.mode("append").parquet(f"{root}/bronze")

    def batch():
        medallion.load_silver(spark.read.parquet(f"{root}/bronze"), f"{root}/silver", by_day=True)

    def stream():
        rows = spark.readStream.schema(spark.read.parquet(f"{root}/bronze").schema).parquet(f"{root}/bronze")
        topics.run(incremental.refiner(rows, f"{root}/silver", f"{root}/gold", f"{root}/mark", by_day=first == "stream"))

    runs = [batch, stream] if first == "batch" else [stream, batch]
    runs[0]()
    bronze(dated("c", 3, 2), dated("a", 3, 3)).write.mode("append").parquet(f"{root}/bronze")
    runs[1]()
    stored = tables.read_inserted(spark, f"{root}/silver")
    assert found(stored) == ["a", "b", "c"]
    assert {str(r.day) for r in stored.select("day").collect()} == {"2024-01-01", "2024-01-02", "2024-01-03"}


def test_small_files_do_not_pile_up(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "seen")
    monkeypatch.setattr(seen, "MOST_FILES", 3)
    seen.create(spark, path, 2)
    for load in range(9):
        remember(urls(spark, f"a{load}", f"b{load}", f"c{load}"), path, f"load-{load}")
    assert max(len(glob.glob(f"{d}/*.parquet")) for d in glob.glob(f"{path}/keys/*")) <= 4
    asked = [f"{c}{load}" for c in "abc" for load in range(9)]
    assert found(new_urls(urls(spark, *asked, "new"), path, "now")) == ["new"]
