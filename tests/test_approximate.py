import numpy as np
import pytest
from newslake.operators import approximate, search
from pyspark.sql import functions as F


def frame(spark, rows, names):
    return spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in rows], names)


def crowd(rng, n, dims, noise):
    """Vectors around common centres, as articles on common subjects are."""
    centres = rng.normal(size=(n // 12 + 1, dims))
    rows = centres[rng.integers(0, len(centres), n)] + noise * rng.normal(size=(n, dims))
    return rows.astype(np.float32)


def pairs(df):
    return {(r.q_id, r["rank"]): (r.id, r.score) for r in df.collect()}


def test_recall_and_work(spark):
    rng = np.random.default_rng(1)
    vectors = crowd(rng, 6000, 48, 0.5)
    stored = approximate.with_keys(frame(spark, enumerate(vectors), "id long, values array<float>"))
    asked = frame(spark, ((i, vectors[i]) for i in range(0, 6000, 60)), "q_id long, values array<float>")
    exact = pairs(search.nearest(stored, asked, 10))
    found = pairs(approximate.nearest(stored, asked, 10, exact_rows=0))
    assert len(found) == len(exact) == 1000
    by = lambda hits: {(q, i) for (q, _), (i, _) in hits.items()}
    assert len(by(found) & by(exact)) / 1000 >= 0.9
    assert {k: v for k, v in found.items() if k[1] == 1} == {k: v for k, v in exact.items() if k[1] == 1}
    # The share of pairs that any bucket brings together.
    keys = np.array([r["keys"] for r in stored.orderBy("id").collect()])
    met = np.mean([(keys == keys[i]).any(axis=1).mean() for i in range(0, 6000, 60)])
    assert met < 0.25


def test_no_pair_of_all_with_all_is_planned(spark):
    rng = np.random.default_rng(2)
    stored = approximate.with_keys(frame(spark, enumerate(crowd(rng, 200, 16, 0.3)), "id long, values array<float>"))
    asked = approximate.with_keys(stored.where("id % 50 = 0").select(F.col("id").alias("q_id"), "values"))
    plan = approximate.candidates(stored, asked, 3)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_crowded_buckets_are_cut(spark, monkeypatch):
    rng = np.random.default_rng(3)
    vectors = np.concatenate([np.repeat(crowd(rng, 1, 8, 0.1), 300, axis=0), crowd(rng, 300, 8, 0.4)])
    stored = approximate.with_keys(frame(spark, enumerate(vectors), "id long, values array<float>"))
    asked = frame(spark, ((i, vectors[i]) for i in range(0, 600, 9)), "q_id long, values array<float>")
    whole = pairs(approximate.nearest(stored, asked, 7, exact_rows=0))
    monkeypatch.setattr(search, "NUMBERS_PER_BLOCK", 8 * 50)
    monkeypatch.setattr(approximate, "QUESTIONS_PER_PART", 4)
    posted, wanted = approximate._postings(stored, "id"), approximate._postings(approximate.with_keys(asked), "q_id")
    cut = approximate._buckets(posted, wanted, 50).agg(F.max("v_parts"), F.max("q_parts")).first()
    assert cut[0] > 5 and cut[1] > 5
    assert pairs(approximate.nearest(stored, asked, 7, exact_rows=0)) == whole
    assert [whole[0, r][0] for r in range(1, 8)] == list(range(7))


@pytest.mark.parametrize("exact_rows", [0, 1000])
def test_few_finds_are_completed(spark, exact_rows):
    """With few and small buckets, a question that meets too few is searched exactly."""
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(60, 24))
    by = approximate.HashTables(tables=1, bits=12)
    stored = approximate.with_keys(frame(spark, enumerate(vectors), "id long, values array<double>"), by)
    asked = frame(spark, ((i, vectors[i]) for i in range(0, 60, 7)), "q_id long, values array<double>")
    found = pairs(approximate.nearest(stored, asked, 5, by, exact_rows))
    assert found == pairs(search.nearest(stored, asked, 5))


def test_unusable_vectors_and_empty_tables(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [0.0, 0.0]), (6, [1.0, None]), (7, [1.0, 0.1])]
    vectors = spark.createDataFrame(rows, "id long, values array<double>")
    stored = approximate.with_keys(approximate.with_keys(vectors))
    assert sorted(r.id for r in stored.where("keys is null").collect()) == [2, 3, 4, 6]
    asked = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [nan, nan])], "q_id long, values array<double>")
    found = pairs(approximate.nearest(stored, asked, 2, exact_rows=0))
    assert found == {(1, 1): (1, 1.0), (1, 2): (7, round(1 / 1.01**0.5, 6))}
    assert approximate.nearest(stored.limit(0), asked, exact_rows=0).count() == 0
    assert approximate.nearest(stored, asked.limit(0), exact_rows=0).count() == 0


def test_stored_articles_are_found_by_their_keys(spark, bronze, tmp_path):
    """Vectors stored with keys answer as an exact search does, with their metadata."""
    from newslake.operators import vectors
    from newslake.operators.refine import refine
    from newslake.sources import tables

    words = "market court storm match vote film phone train".split()
    loaded = refine(bronze(*[
        {"url": f"u{i:02d}", "title": f"{words[i % 8]} {words[i % 8]} report", "description": f"{words[i % 8]} day {i}"} for i in range(40)
    ]))
    path = str(tmp_path / "vectors")
    vectors.store_new_vectors(loaded, path, by=approximate.HashTables())
    stored = tables.read_inserted(spark, path)
    asked = vectors.question_vectors(spark.createDataFrame([(1, "court report"), (2, "film")], "q_id int, question string"))
    found = approximate.nearest(stored, asked, 5, exact_rows=0)
    assert pairs(found) == pairs(search.nearest(stored, asked, 5))
    shown = search.with_metadata(found, stored).where("q_id = 1").collect()
    assert len(shown) == 5 and all(r.metadata.title == "court court report" for r in shown)
