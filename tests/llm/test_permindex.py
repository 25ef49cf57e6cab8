import numpy as np
import pytest
from newslake.llm import permindex, queries
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, rank string"


def brute(ids, rows, query, k):
    scores = (rows * rows[ids == query][0]).sum(axis=1)
    order = [i for i in np.lexsort((ids, -scores)) if ids[i] != query][:k]
    return [(int(ids[i]), scores[i]) for i in order]


def recall(found, ids, rows, k):
    by_query = {}
    for r in found:
        by_query.setdefault(r.query_id, []).append(r)
    shares = []
    for query, own in by_query.items():
        own.sort(key=lambda r: r.rank)
        best = brute(ids, rows, query, k)
        assert [r.rank for r in own] == list(range(1, len(best) + 1))
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)
        for r in own:
            assert r.score == pytest.approx(float(rows[ids == query][0] @ rows[ids == r.vec_id][0]), abs=1e-12)
        floor = best[-1][1] - 1e-12
        shares.append(sum(r.score >= floor for r in own) / len(best))
    return np.mean(shares)


@pytest.mark.parametrize("kind", ["random", "crowd", "lengths"])
def test_recall_with_more_blocks_than_one(spark, monkeypatch, kind):
    for name, value in (("BLOCK", 1500), ("QUERIES", 40)):
        monkeypatch.setattr(permindex, name, value)
    rng = np.random.default_rng(1)
    n, ids = 4000, np.arange(4000)
    rows = rng.normal(size=(n, 16))
    if kind == "crowd":
        rows[: n // 3] = rows[0] + rng.normal(size=(n // 3, 16)) * 1e-3
    rows /= np.linalg.norm(rows, axis=1)[:, None]
    if kind == "lengths":
        rows *= rng.uniform(0.5, 2, size=(n, 1))
    rows = rows.astype(np.float32).astype(np.float64)
    table = spark.createDataFrame([(int(i), r.tolist(), "x") for i, r in zip(ids, rows)], SCHEMA)
    found = permindex.nearest(table, F.expr("vec_id % 40 = 0"), 10).collect()
    assert len(found) == 1000
    assert recall(found, ids, rows, 10) >= 0.9


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], "x"), (1, [1.0, 0.0], "x"), (2, [1.0, 0.0], None), (3, [0.5, 0.5], "x"), (4, None, "x"),
        (5, [0.0, 0.0], "x"), (6, [nan, 1.0], "x"), (7, [inf, 1.0], "x"), (8, [None, 1.0], "x"), (9, [1.0], "x"),
        (None, [1.0, 1.0], "x"), (3, [0.5, 0.5], "y"), (20, [-1.0, 0.0], "x"), (10, [], "x"),
    ]
    found = permindex.nearest(spark.createDataFrame(rows, SCHEMA), F.expr("vec_id % 20 = 0"), 3)
    assert [tuple(r) for r in found.orderBy("query_id", "rank").collect()] == [
        (0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 3, 0.5), (20, 1, 3, -0.5), (20, 2, 0, -1.0), (20, 3, 1, -1.0),
    ]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert permindex.nearest(empty, F.lit(True)).count() == 0
    one = spark.createDataFrame([(0, [1.0], "x")], SCHEMA)
    assert permindex.nearest(one, F.lit(True)).count() == 0
    assert permindex.nearest(one, F.lit(False)).count() == 0


def test_query_over_the_whole_table(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").toPandas()
    ids, rows = table.vec_id.to_numpy(), np.stack(table.embedding).astype(float)
    found = queries.op1_permutation_index(spark, sf).collect()
    assert len(found) == (ids % 20 == 0).sum() * min(20, len(ids) - 1)
    assert recall(found, ids, rows, 20) >= 0.9


def test_few_postings_are_met_and_few_rows_ranked():
    rng = np.random.default_rng(2)
    rows = rng.normal(size=(6000, 24))
    rows /= np.linalg.norm(rows, axis=1)[:, None]
    pivots = rows[rng.choice(6000, permindex.PIVOTS, replace=False)]
    block = permindex.Block(np.arange(6000), rows, pivots, 1.0)
    assert len(block.rows) == 6000 * permindex.POSTED
    hits = 0
    for q in range(0, 6000, 100):
        found, _ = block.search(q, rows[q], 20)
        best = {i for i, _ in brute(np.arange(6000), rows, q, 20)}
        hits += len(best & set(found.tolist()))
    assert hits / (60 * 20) >= 0.9
    # Of all postings, and beside the numbers that a plain scan multiplies.
    assert block.opened / (60 * len(block.rows)) < 0.1
    assert block.opened / (60 * 6000) < 4 and permindex.SHARE < 0.2


def test_footrule_of_lists_that_are_cut_off():
    """What shared pivots are worth is what they take off the written-out distance."""
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(300, 6))
    rows /= np.linalg.norm(rows, axis=1)[:, None]
    block = permindex.Block(np.arange(300), rows, rows[:120], 1.0)
    seen = permindex.orders(permindex.lengthened(rows, 1.0), block.pivots, permindex.POSTED)
    most = permindex.POSTED
    place = [{p: i for i, p in enumerate(own)} for own in seen.tolist()]
    far = lambda a, b: sum(abs(a.get(p, most) - b.get(p, most)) for p in a.keys() | b.keys())
    for q in range(0, 300, 37):
        near, whole = block.nearness(rows[q])
        strangers = 2 * sum(most - i for i in range(most))
        assert whole == strangers and near[q] == whole
        assert [strangers - n for n in near] == [far(place[q], own) for own in place]


@pytest.mark.parametrize("size", [1e200, 1e-200])
def test_components_of_any_size(spark, size):
    rows = [(i, [size * x for x in v], "x") for i, v in enumerate([[1.0, 0.0], [0.5, 1.0], [0.25, 3.0], [-1.0, 0.5], [0.75, 0.0]])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank string")
    found = permindex.nearest(table, F.lit(True), 4).where("query_id = 0").orderBy("rank").collect()
    assert [r.vec_id for r in found] == [4, 1, 2, 3]
    assert found[0].score == size * size * 0.75


def test_rows_that_take_no_part_are_listed(spark):
    rows = [(1, [1.0, 0.0], "x"), (2, [1.0, 0.5], "x"), (3, [1.0], "x"), (4, None, "x"), (None, [1.0, 1.0], "x"), (5, [0.0, 0.0], "x")]
    left = permindex.left_out(spark.createDataFrame(rows, SCHEMA))
    assert sorted((r.vec_id or 0) for r in left.collect()) == [0, 3, 4, 5]
