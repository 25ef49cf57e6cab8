from newslake.operators.refine import refine
from newslake.plans import medallion
from newslake.sources import tables


def by_url(df):
    return {r.url: r for r in df.collect()}


def test_a_copy_without_title_does_not_lose_the_url(bronze):
    rows = by_url(refine(bronze(
        {"url": "u", "title": None, "at": 1}, {"url": "u", "title": "T", "at": 2},
        {"url": None, "title": "no address"}, {"url": "v", "title": None},
    )))
    assert set(rows) == {"u"} and rows["u"].title == "T"


def test_first_arrival_wins(bronze):
    rows = by_url(refine(bronze(
        {"url": "u", "title": "late", "at": 9}, {"url": "u", "title": "early", "at": 3},
    )))
    assert rows["u"].title == "early"


def test_ties_do_not_depend_on_order(bronze):
    copies = [{"url": "u", "title": f"t{i}", "author": None if i % 2 else "a"} for i in range(20)]
    one = by_url(refine(bronze(*copies)))
    other = by_url(refine(bronze(*reversed(copies)).repartition(5)))
    assert one == other


def test_nulls_in_different_columns_are_told_apart(spark, bronze):
    from newslake.operators.dedup import row_hash

    df = bronze({"title": "x"}, {"description": "x"}).select("title", "description")
    assert len({r[0] for r in df.select(row_hash(df.columns)).collect()}) == 2


def test_dates(bronze):
    texts = ["not-a-date", "", "2024-01-05T03:04:05Z", "2024-01-05T03:04:05+02:00", "2024-01-05", None]
    df = refine(bronze(*[{"url": str(i), "title": "t", "published_at": t} for i, t in enumerate(texts)]))
    got = {u: r.published_at and r.published_at.isoformat() for u, r in by_url(df).items()}
    assert got == {
        "0": None, "1": None, "2": "2024-01-05T03:04:05", "3": "2024-01-05T01:04:05",
        "4": "2024-01-05T00:00:00", "5": None,
    }


def test_blanks(bronze):
    row = by_url(refine(bronze({
        "url": " u ", "title": "  ", "author": " ", "source": None, "content": "",
    })))[" u "]
    assert (row.title, row.author, row.source) == ("", "", "Unknown")
    assert (row.content_length, row.has_content) == (0, True)
    tab = by_url(refine(bronze({"url": "u", "title": "\tt ", "author": " Unknown "})))["u"]
    assert (tab.title, tab.author, tab.content_length, tab.has_content) == ("\tt", "Unknown", None, False)


def test_stored_rows_never_change(spark, bronze, tmp_path):
    path = str(tmp_path / "silver")
    medallion.load_silver(bronze({"url": "u", "title": "old"}), path)
    medallion.load_silver(bronze({"url": "u", "title": "new"}, {"url": "v", "title": "v"}), path)
    got = {r.url: r.title for r in tables.read_inserted(spark, path).collect()}
    assert got == {"u": "old", "v": "v"}


def test_a_hot_url_is_thinned_out_before_the_shuffle(spark, bronze):
    """A third of all rows share a URL; few of them reach the shuffle."""
    rows = spark.range(0, 30000, numPartitions=8).selectExpr(
        "concat('t', id) as title", "'d' as description", "'c' as content",
        "if(id % 3 = 0, 'hot', concat('u', id)) as url", "'s' as source",
        "'2024-01-01' as published_at", "'a' as author", "timestamp_seconds(id) as ingested_at",
    )
    plan = refine(rows)._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange hashpartitioning(url"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle
    got = by_url(refine(rows))
    assert len(got) == 20001 and got["hot"].title == "t0"
