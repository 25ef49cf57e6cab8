import random

import pytest
from pyspark.sql import functions as F

from newslake.operators import gold
from newslake.operators.merge import require_unique, unmatched, unmatched_in_large
from newslake.operators.refine import refine
from newslake.plans import medallion
from newslake.sources import delta, tables

ROWS = "k string, v int"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_upsert_updates_and_inserts(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.upsert(spark.createDataFrame([("a", 1), (None, 2), ("c", 3)], ROWS), path, ["k"])
    src = spark.createDataFrame([("a", 10), (None, 20), ("d", 40)], ROWS)
    for _ in range(3):
        tables.upsert(src, path, ["k"])
        got = rows(tables.read_snapshot(spark, path))
        assert got == rows(spark.createDataFrame([("a", 10), (None, 20), ("c", 3), ("d", 40)], ROWS))
    assert tables.current(spark, path).version == 4


def test_two_rows_for_a_key_fail(spark, tmp_path):
    src = spark.createDataFrame([("a", 1), ("a", 2)], ROWS)
    with pytest.raises(Exception, match="several rows in the merge source"):
        tables.upsert(src, str(tmp_path / "t"), ["k"])
    assert tables.current(spark, str(tmp_path / "t")) is None
    require_unique(spark.createDataFrame([("a", 1), (None, 1)], ROWS), ["k"])
    with pytest.raises(ValueError, match="several rows"):
        require_unique(spark.createDataFrame([(None, 1), (None, 2)], ROWS), ["k"])


def test_a_failed_write_leaves_the_published_version(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.upsert(spark.createDataFrame([("a", 1)], ROWS), path, ["k"])
    bad = spark.createDataFrame([("b", 1)], ROWS).withColumn(
        "v", F.raise_error(F.lit("lost")).cast("int")
    )
    with pytest.raises(Exception, match="lost"):
        tables.upsert(bad, path, ["k"])
    assert rows(tables.read_snapshot(spark, path)) == [("a", 1)]


def test_a_batch_is_applied_once(spark, tmp_path):
    path = str(tmp_path / "t")
    src = spark.createDataFrame([("a", 1)], ROWS)
    assert tables.upsert(src, path, ["k"], "b-1") == 1
    assert tables.upsert(src, path, ["k"], "b-1") == 1
    assert tables.upsert(src, path, ["k"], "b-2") == 2


def test_insert_only_replay_replaces_its_own_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.insert_new(spark.createDataFrame([("a", 1)], ROWS), path, ["k"], "b-1")
    second = spark.createDataFrame([("a", 9), ("b", 2)], ROWS)
    for small in (False, True, False):
        tables.insert_new(second, path, ["k"], "b-2", small_batch=small)
        assert rows(tables.read_inserted(spark, path)) == [("a", 1), ("b", 2)]
    tables.insert_new(second, path, ["k"])
    assert rows(tables.read_inserted(spark, path)) == [("a", 1), ("b", 2)]
    assert tables.verify(spark, path)[0] == 2


def test_both_anti_joins_agree(spark):
    src = spark.createDataFrame([("a", 1), (None, 2), ("c", 3)], ROWS)
    target = spark.createDataFrame([("a", 5), (None, 6)], ROWS)
    for pick in (unmatched, unmatched_in_large):
        assert rows(pick(src, target, ["k"])) == [("c", 3)]
        assert rows(pick(src, target, ["k"], null_safe=False)) == [("c", 3), (None, 2)]


def test_an_author_with_two_sources_keeps_both(spark, bronze, tmp_path):
    silver = refine(bronze(
        {"url": "1", "title": "t", "author": "a", "source": "x"},
        {"url": "2", "title": "t", "author": "a", "source": "y"},
        {"url": "3", "title": "t", "author": "b", "published_at": "bad"},
    ))
    root = str(tmp_path)
    for _ in range(2):
        medallion.load_gold(silver, root)
    authors = medallion.read_gold(spark, root, "by_author")
    assert rows(authors.select("author", "source", "total_articles")) == [
        ("a", "x", 1), ("a", "y", 1), ("b", "Unknown", 1),
    ]
    dates = medallion.read_gold(spark, root, "by_date")
    assert rows(dates) == [(None, 3, 3)]


def test_merged_gold_is_recomputed_gold(spark, bronze, tmp_path):
    first = [{"url": str(i), "title": "t", "author": f"a{i % 3}", "source": f"s{i % 4}",
              "content": "x" * i, "published_at": f"2024-01-{1 + i % 5:02d}"} for i in range(20)]
    more = [{**r, "url": r["url"] + "m", "published_at": None} for r in first]
    silver, root = str(tmp_path / "silver"), str(tmp_path / "gold")
    for load in (first, first + more):
        medallion.load_silver(bronze(*load), silver)
        medallion.load_gold(tables.read_inserted(spark, silver), root)
    stored = tables.read_inserted(spark, silver)
    for name, rollup in gold.ROLLUPS.items():
        assert rows(medallion.read_gold(spark, root, name)) == rows(rollup(stored))
    check = medallion.check_gold(spark, silver, root).first()
    assert (check.total_articles_sum, check.silver_rows, check.matches) == (40, 40, True)


def test_mean_of_no_lengths_is_null(spark, bronze):
    report = gold.by_source(refine(bronze({"url": "1", "title": "t", "source": "s"})))
    assert report.first().avg_content_length is None


def test_delta_says_what_it_needs(spark, tmp_path):
    if delta.DeltaTable is not None:
        pytest.skip("delta is there")
    with pytest.raises(RuntimeError, match="delta-spark"):
        delta.upsert(spark.range(1), str(tmp_path / "d"), ["id"])


def test_delta_tables_go_through_the_same_run(spark, monkeypatch):
    """The package isn't here: only that rows and keys reach its two merges."""
    from newslake.operators import gold
    from newslake.sources import delta

    calls = []
    merge_ = lambda src, path, keys: calls.append((path, tuple(keys), src.count()))
    monkeypatch.setattr(delta, "insert_new", merge_)
    monkeypatch.setattr(delta, "upsert", merge_)
    empty = (f"cast(null as string) as {c}" for c in ("description", "content", "published_at", "author"))
    raw = spark.createDataFrame(
        [("t", "u", "s"), ("t", "u", "s"), ("t", "v", "r")], "title string, url string, source string"
    ).selectExpr("*", *empty, "current_timestamp() as ingested_at")
    medallion.load_silver(raw, "silver", fmt="delta")
    medallion.load_gold(refine(raw), "gold", fmt="delta")
    assert calls == [
        ("silver", ("url",), 2), ("gold/by_source", gold.by_source.keys, 2),
        ("gold/by_date", gold.by_date.keys, 1), ("gold/by_author", gold.by_author.keys, 0),
    ]


def test_old_snapshots_are_removed(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(4):
        tables.upsert_parts({"": (spark.createDataFrame([(i, "x")], "k int, v string"), ["k"])}, path)
    assert len(list((tmp_path / "t" / "data").iterdir())) == 2
    assert tables.read_snapshot(spark, path).count() == 4


def test_verify_shows_a_few_rows(spark, tmp_path):
    spark.range(20).write.parquet(str(tmp_path / "t"))
    count, found = tables.verify(spark, str(tmp_path / "t"))
    assert count == 20 and len(found) == 5


def test_silver_by_published_date(spark, bronze, tmp_path):
    path = str(tmp_path / "silver")
    days = [{"url": f"u{i}", "title": "t", "published_at": f"2024-01-0{1 + i % 3}"} for i in range(12)]
    medallion.load_silver(bronze(*days, {"url": "x", "title": "t"}).repartition(4), path, batch="a", by_day=True)
    medallion.load_silver(bronze(*days, {"url": "y", "title": "t"}), path, batch="b", by_day=True)
    stored = tables.read_inserted(spark, path)
    assert stored.count() == 14
    found = stored.where("day = date'2024-01-02'")
    assert found.count() == 4
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert len(list((tmp_path / "silver" / "batch=a" / "day=2024-01-02").glob("part-*"))) == 1


def test_an_upsert_writes_only_the_buckets_of_its_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    state = {f"k{i}": i for i in range(500)} | {None: -1}
    frame = lambda some: spark.createDataFrame([*some.items()], ROWS)
    tables.upsert(frame(state), path, ["k"], buckets=16)
    before = tables.current(spark, path).buckets
    assert len(before) == 16
    tables.upsert(frame({"k7": 700}), path, ["k"])
    after = tables.current(spark, path).buckets
    changed = {b for b in after if after[b] != before[b]}
    assert len(changed) == 1
    folder = after[changed.pop()]
    assert len([d for d in (tmp_path / "t" / "data" / folder).iterdir() if d.is_dir()]) == 1
    state["k7"] = 700
    rng = random.Random(1)
    for _ in range(4):
        some = {f"k{rng.randrange(520)}": rng.randrange(1000) for _ in range(5)} | {None: rng.randrange(9)}
        tables.upsert(frame(some), path, ["k"])
        state |= some
        stored = tables.read_snapshot(spark, path)
        assert stored.columns == ["k", "v"] and dict(map(tuple, stored.collect())) == state
    # Buckets that no reader may need any more are gone.
    kept = [d for d in (tmp_path / "t" / "data").glob("*/_bucket=*")]
    assert len(kept) <= 2 * 16


def test_a_table_of_one_piece_goes_into_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.upsert_parts({"": (spark.createDataFrame([("a", 1), ("b", 2)], ROWS), ["k"])}, path)
    tables.upsert(spark.createDataFrame([("a", 3), ("c", 4)], ROWS), path, ["k"])
    assert rows(tables.read_snapshot(spark, path)) == [("a", 3), ("b", 2), ("c", 4)]
    tables.upsert(spark.createDataFrame([], ROWS), path, ["k"])
    assert rows(tables.read_snapshot(spark, path)) == [("a", 3), ("b", 2), ("c", 4)]


def test_an_empty_first_upsert(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.upsert(spark.createDataFrame([], ROWS), path, ["k"])
    assert tables.read_snapshot(spark, path).columns == ["k", "v"]
    tables.upsert(spark.createDataFrame([("a", 1)], ROWS), path, ["k"])
    assert rows(tables.read_snapshot(spark, path)) == [("a", 1)]
