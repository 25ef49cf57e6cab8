import numpy as np
import pytest
from pyspark.sql import functions as F

from newslake.functions.embedding import hashed_words, vector
from newslake.operators import answers, search, vectors
from newslake.operators.refine import refine
from newslake.sources import tables

DIMS = 8


def brute_force(ids, matrix, q_ids, asked, k):
    def unit(m):
        n = np.sqrt((m * m).sum(axis=1))
        return m / np.where(n == 0, 1, n)[:, None]

    scores = np.round(unit(asked) @ unit(matrix).T, search.SCORE_DIGITS) + 0.0
    out = []
    for q, row in zip(q_ids, scores):
        best = sorted(zip(-row, ids))[:k]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(best, 1)]
    return sorted(out)


def frame(spark, ids, matrix, name, kind):
    data = [(i, [float(x) for x in row]) for i, row in zip(ids, matrix)]
    return spark.createDataFrame(data, f"{name} {kind}, `values` array<double>")


@pytest.fixture
def sample(spark):
    rng = np.random.default_rng(7)
    matrix = rng.normal(size=(300, DIMS)).round(2)
    matrix[100:200] = matrix[0]  # a third of all rows are copies
    matrix[250] = 0
    asked = np.vstack([matrix[0], rng.normal(size=(11, DIMS)).round(2), np.zeros(DIMS)])
    return matrix, asked


@pytest.mark.parametrize("bound", [100, 5, 1])
@pytest.mark.parametrize("kind", ["long", "string"])
def test_both_ways_find_the_same(spark, sample, bound, kind, monkeypatch):
    monkeypatch.setattr(search, "NUMBERS_PER_BLOCK", 512)
    matrix, asked = sample
    ids = [i if kind == "long" else f"id{i}" for i in range(len(matrix))]
    q_ids = list(range(len(asked)))
    found = search.nearest(
        frame(spark, ids, matrix, "id", kind).repartition(7),
        frame(spark, q_ids, asked, "q_id", "int"), k=6, broadcast_numbers=bound * DIMS,
    )
    got = sorted((r.q_id, r["rank"], r.id, r.score) for r in found.collect())
    assert got == brute_force(ids, matrix, q_ids, asked, 6)


def test_fewer_vectors_than_k_and_none_at_all(spark, sample):
    matrix, asked = sample
    questions = frame(spark, [1, 2], asked[:2], "q_id", "int")
    few = frame(spark, [1, 2, 3], matrix[:3], "id", "long")
    for bound in (10, 1):
        numbers = bound * DIMS
        assert search.nearest(few, questions, broadcast_numbers=numbers).count() == 6
        assert search.nearest(few.where("false"), questions, broadcast_numbers=numbers).count() == 0
    assert search.nearest(few, questions.where("false")).count() == 0
    gaps = few.withColumn("values", F.when(F.col("id") > 1, F.col("values")))
    unasked = questions.withColumn("values", F.when(F.col("q_id") > 1, F.col("values")))
    assert {(r.q_id, r.id) for r in search.nearest(gaps, unasked).collect()} == {(2, 2), (2, 3)}


def test_hashed_words(spark):
    texts = spark.createDataFrame(
        [(0, "Apple apple PIE"), (1, " apple pie\u00a0apple\n"), (2, ""), (3, "pear"), (4, None)], "i int, t string"
    )
    built = hashed_words(texts, F.col("t"), dimensions=16).orderBy("i").collect()
    out = np.array([r["values"] for r in built])
    assert out.shape == (5, 16) and not out[4].any()
    assert np.allclose(out[0], out[1]) and out[0].any() and not out[2].any()
    assert np.allclose(np.linalg.norm(out[[0, 3]], axis=1), 1)


def test_a_model_is_made_once_per_task(spark):
    def factory():
        made = np.random.default_rng().integers(1 << 40)
        return lambda texts: np.full((len(texts), 2), float(made % 1000003))

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        df = spark.range(0, 100, numPartitions=2).select(F.col("id").cast("string").alias("t"))
        got = df.select(F.spark_partition_id().alias("p"), vector(F.col("t"), factory)[0].alias("v"))
        assert {r.n for r in got.groupBy("p").agg(F.count_distinct("v").alias("n")).collect()} == {1}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def silver_of(bronze):
    return refine(bronze(
        {"url": "u1", "title": "apple pie", "description": "sweet", "content": "apple",
         "source": "s", "published_at": "2024-01-02 03:04:05.25", "author": "a"},
        {"url": "u2", "title": "pear", "published_at": "2024-01-02 03:04:05"},
        {"url": "u3", "title": "  "}, {"url": "", "title": "no address"},
    ))


def test_vectors_and_metadata(spark, bronze, tmp_path):
    got = {r.id: r for r in vectors.article_vectors(silver_of(bronze)).collect()}
    assert set(got) == {"u1", "u2"}
    assert got["u1"].metadata.asDict() == {
        "title": "apple pie", "description": "sweet", "url": "u1", "source": "s",
        "published_at": "2024-01-02T03:04:05.250000+00:00", "author": "a",
    }
    assert got["u2"].metadata.description == ""
    assert got["u2"].metadata.published_at == "2024-01-02T03:04:05+00:00"


def test_no_date_is_empty_text(bronze):
    silver = refine(bronze({"url": "u", "title": "t", "published_at": "bad"}))
    assert vectors.article_vectors(silver).first().metadata.published_at == ""


def test_stored_vectors(spark, bronze, tmp_path):
    upserted, inserted = str(tmp_path / "u"), str(tmp_path / "i")
    assert vectors.vector_count(spark, inserted) == 0
    silver = silver_of(bronze)
    for part in (silver.where("url = 'u1'"), silver, silver):
        vectors.store_vectors(part, upserted)
        vectors.store_new_vectors(part, inserted)
    assert vectors.vector_count(spark, inserted) == 2
    columns = ["id", "values", "metadata"]
    assert sorted(tables.read_snapshot(spark, upserted).select(columns).collect()) == sorted(
        tables.read_inserted(spark, inserted).select(columns).collect()
    )


def test_only_new_articles_are_embedded(spark, bronze, tmp_path):
    def ones():
        return lambda texts: np.ones((len(texts), 2))

    def refuse():
        def embed(texts):
            raise RuntimeError("embedded again")

        return embed

    path, silver = str(tmp_path / "v"), silver_of(bronze)
    vectors.store_new_vectors(silver, path, ones, "b-1")
    vectors.store_new_vectors(silver, path, refuse, "b-2")
    vectors.store_new_vectors(silver, path, ones, "b-1")
    assert vectors.vector_count(spark, path) == 2


def hits(spark):
    meta = "struct<title:string,description:string,url:string,source:string,published_at:string,author:string>"
    return spark.createDataFrame(
        [
            (1, 2, "b", 0.5, ("T2", None, "b", "S2", "", "")),
            (1, 1, "a", 0.9, ("T1", "D1", "a", "S1", "2024", "")),
        ],
        f"q_id int, rank int, id string, score double, metadata {meta}",
    )


CONTEXT = (
    "\nArticle 1:\nTitle: T1\nSource: S1\nPublished: 2024\nDescription: D1\nURL: a\n"
    "\n"
    "\nArticle 2:\nTitle: T2\nSource: S2\nPublished: \nDescription: \nURL: b\n"
)


def test_context_and_prompts(spark):
    assert answers.contexts(hits(spark)).first().context == CONTEXT
    questions = spark.createDataFrame([(1, "Why?"), (2, "What?")], "q_id int, question string")
    got = {r.q_id: r for r in answers.prompts(questions, hits(spark)).collect()}
    assert got[1].prompt.endswith(f"News Articles:\n{CONTEXT}\n\nQuestion: Why?\n\nAnswer:")
    assert got[1].prompt.startswith("You are a helpful news assistant.")
    assert got[1].fallback_answer is None and [m.id for m in got[1].matches] == ["a", "b"]
    assert got[2].prompt is None and got[2].matches is None
    assert got[2].fallback_answer == "No relevant articles found."


def test_a_service_answers_only_prompts(spark):
    questions = spark.createDataFrame([(1, "Why?"), (2, "What?")], "q_id int, question string")
    asked = answers.prompts(questions, hits(spark))
    got = answers.answered(asked, lambda texts: "to: " + texts.str.slice(0, 9)).collect()
    assert {r.q_id: r.answer for r in got} == {1: "to: You are a", 2: "No relevant articles found."}


def test_links(spark):
    got = sorted(answers.source_list(hits(spark)).collect(), key=lambda r: r["rank"])
    assert [r.link for r in got] == ["- [T1](a) — **S1**", "- [T2](b) — **S2**"]


def test_a_text_that_fails_is_left_out_and_reported(bronze):
    def picky():
        def embed(texts):
            if texts.str.contains("pear").any():
                raise ValueError("no pears")
            return np.ones((len(texts), 2))

        return embed

    def broken():
        raise RuntimeError("no model")

    silver = refine(bronze(*[{"url": t, "title": t} for t in ("apple", "pear", "plum", "  ")]))
    built = vectors.article_vectors(silver, picky)
    assert sorted(r.id for r in built.collect()) == ["apple", "plum"]
    assert [r.url for r in vectors.not_embedded(silver, built).collect()] == ["pear"]
    with pytest.raises(Exception, match="no model"):
        vectors.article_vectors(silver, broken).collect()


def test_failed_urls_are_written(spark, bronze, tmp_path):
    def picky():
        def embed(texts):
            if texts.str.contains("pear").any():
                raise ValueError("no pears")
            return np.ones((len(texts), 2))

        return embed

    silver = refine(bronze(*[{"url": t, "title": t} for t in ("apple", "pear", "plum")]))
    path, rejects = str(tmp_path / "v"), str(tmp_path / "r")
    vectors.store_new_vectors(silver, path, picky, "b-1", rejects)
    assert vectors.vector_count(spark, path) == 2
    bad = tables.scan(spark, rejects).collect()
    assert [(r.url, "no pears" in r.error) for r in bad] == [("pear", True)]

    def useless():
        def embed(texts):
            raise MemoryError("too large")

        return embed

    with pytest.raises(Exception, match="every text"):
        vectors.article_vectors(silver.coalesce(1), useless).collect()


def test_vectors_that_cannot_be_compared(spark):
    nan = float("nan")
    many = spark.range(1000).selectExpr("id", "array(float(1), float(id)) as values")
    odd = spark.createDataFrame(
        [(-1, [nan, 1.0]), (-2, None), (-3, [None, 1.0]), (-4, [float("inf"), 1.0])], "id long, values array<float>"
    )
    asked = spark.createDataFrame([(1, [0.0, 1.0]), (2, [nan, 1.0])], "q_id int, values array<float>")
    stored = many.union(odd).coalesce(1)
    for numbers in (1000, 2):
        found = search.nearest(stored, asked, k=3, broadcast_numbers=numbers)
        assert [tuple(r) for r in found.select("q_id", "rank", "id").orderBy("rank").collect()] == [
            (1, 1, 999), (1, 2, 998), (1, 3, 997),
        ]
    assert sorted(r.id for r in search.unusable(stored).collect()) == [-4, -3, -2, -1]
    ragged = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0] * 4)], "id long, values array<float>")
    with pytest.raises(Exception, match="of 2 and of 4 numbers"):
        search.nearest(ragged.coalesce(1), asked).collect()


def test_nearly_equal_scores_rank_by_score(spark):
    rows = [(i, [1.0, 1e-4 + i * 1e-6]) for i in range(50)]
    stored = spark.createDataFrame(rows, "id long, values array<double>")
    asked = spark.createDataFrame([(1, [0.0, 1.0])], "q_id int, values array<double>")
    found = search.nearest(stored, asked, k=3).orderBy("rank").collect()
    assert [r.id for r in found] == [49, 48, 47]


def test_a_hit_has_one_row_of_metadata(spark):
    hits = spark.createDataFrame([(1, 1, "a", 0.5)], "q_id int, rank int, id string, score double")
    stored = spark.createDataFrame([("a", "m"), ("a", "m")], "id string, metadata string")
    for most in (100, 0):
        assert search.with_metadata(hits, stored, most).count() == 1


def test_the_model_runs_once_per_text(bronze):
    ones = lambda: lambda texts: np.ones((len(texts), 2))
    built = vectors.article_vectors(refine(bronze({"url": "u", "title": "t"})), ones)
    plan = built._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_sources_used(spark):
    questions = spark.createDataFrame([(1, "Why?"), (2, "What?")], "q_id int, question string")
    got = answers.sources_used(answers.prompts(questions, hits(spark))).collect()
    assert {r.q_id: r.sources for r in got} == {1: ["S1", "S2"], 2: None}
