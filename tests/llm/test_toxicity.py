import zlib

import numpy as np
import pytest
from newslake.llm import queries, toxicity
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, score string"
BAD = ("grolk", "snarvel", "blemps")


def corpus(spark, n=3000):
    rng = np.random.default_rng(1)
    docs, labels = [], []
    for i in range(n):
        words = [f"w{rng.integers(400)}x" for _ in range(rng.integers(5, 60))]
        toxic = i % 9 == 0
        if toxic:
            words.insert(int(rng.integers(len(words))), BAD[i % 3] + "s" * int(rng.integers(2)))
        docs.append((i, " ".join(words).replace("x", "abc"[i % 3]), "s"))
        if i % 2 == 0:
            labels.append((i, int(toxic)))
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_accuracy(spark):
    docs, labels = corpus(spark)
    model = toxicity.train(docs, labels, F.col("doc_id") % 4 != 1)
    found = toxicity.scored(docs.where("doc_id % 4 = 1"), model).collect()
    toxic = np.array([r.doc_id % 9 == 0 for r in found])
    predicted = np.array([r.predicted == 1 for r in found])
    assert predicted[toxic].mean() > 0.97 and predicted[~toxic].mean() < 0.02
    assert all(0 <= r.score <= 1 for r in found)


def test_risk_takes_no_unlabelled_text_for_clean():
    """Although a tenth of the unlabelled rows is toxic, they score as toxic."""
    rng = np.random.default_rng(2)
    clean = [rng.choice(np.arange(1, 50), 5, replace=False) for _ in range(900)]
    bad = lambda n: [np.append(rng.choice(np.arange(1, 50), 5, replace=False), 0) for _ in range(n)]
    weights, bias = toxicity.fit(bad(50), clean + bad(100), 50, 0.1)
    margin = lambda row: weights[row].sum() + bias
    assert np.mean([margin(r) > np.log(0.3 / 0.7) for r in bad(100)]) > 0.95
    assert np.mean([margin(r) > np.log(0.3 / 0.7) for r in clean]) < 0.05


def test_labels_of_other_rows_change_nothing(spark):
    docs, labels = corpus(spark, 600)
    learnable = F.col("doc_id") % 4 != 2
    flipped = labels.withColumn(
        "toxic", F.when(F.col("doc_id") % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic"))
    )
    assert toxicity.train(docs, labels, learnable) == toxicity.train(docs, flipped, learnable)


def test_odd_tables(spark):
    docs, labels = corpus(spark, 900)
    model = toxicity.train(docs, labels.union(labels).union(spark.sql("select null, 1 union select 5, null")), F.lit(True))
    rows = [(1, None, "x"), (1, "", "x"), (None, "grolk " * 50_000, "x"), (2, "grolk", "x"), (2, "grolk", "x")]
    odd = spark.createDataFrame(rows, DOCS)
    found = toxicity.scored(odd, model).collect()
    assert len(found) == 5 and found[0].score == found[1].score
    assert [r.predicted for r in found] == [0, 0, 1, 1, 1]
    assert toxicity.clean(odd, model).columns == odd.columns
    assert toxicity.clean(odd, model).count() == 2
    assert toxicity.clean(odd.limit(0), model).count() == 0
    unknown = toxicity.train(docs, labels.where("toxic = 0"), F.lit(True))
    assert toxicity.clean(odd, unknown).count() == 5
    nothing = toxicity.train(docs.limit(0), labels.limit(0), F.lit(True))
    assert toxicity.scored(docs.limit(0), nothing).count() == 0
    assert toxicity.train(docs.limit(0), labels, F.lit(True)).score("grolk") <= 1


def test_query_over_the_whole_table(spark, sf):
    found = queries.op2_toxicity_pu(spark, sf).collect()
    assert len(found) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert r.predicted == int(r.score >= 0.3)


def test_features_reach_the_whole_of_long_runs():
    long = "x" * 30 + "stem" + "y" * 30
    assert "~stem" in toxicity.features(long) and long[:24] in toxicity.features(long)
    assert {"~\u574f\u4eba", "\u4f60\u662f\u574f\u4eba"} <= toxicity.features("\u4f60\u662f\u574f\u4eba")
    assert not any(f[0] == "~" for f in toxicity.features("short words \u00e9t\u00e9 stra\u00dfe"))
    model = toxicity.Model({"~\u574f\u4eba": 4.0}, -2.0)
    clause = "\u7684" * 40
    assert model.score(clause + "\u574f\u4eba") > 0.5 > model.score(clause)


@pytest.mark.parametrize("prior, backward", [(0.05, 1.0), (0.45, 0.5)])
def test_fit_follows_the_plain_risk(prior, backward):
    """The same steps by a written-out risk and its differences, also where the
    corrected part falls below zero and the steps turn."""
    rng = np.random.default_rng(1)
    width, steps, rate, decay = 5, 24, 0.2, 1e-3
    toxic = [np.flatnonzero(rng.random(width) < 0.7) for _ in range(9)]
    others = [np.flatnonzero(rng.random(width) < 0.3) for _ in range(14)]
    loss = lambda margin: float(np.logaddexp(0, -margin))
    turned = []

    def parts(theta):
        margin = lambda rows: sum(theta[f] for f in rows) + theta[-1]
        confirmed = prior * sum(loss(margin(t)) for t in toxic) / len(toxic)
        as_clean = prior * sum(loss(-margin(t)) for t in toxic) / len(toxic)
        return confirmed, sum(loss(-margin(o)) for o in others) / len(others) - as_clean

    def gradient(theta):
        """Row by row, and beside it by differences."""
        forward = parts(theta)[1] >= 0
        turned.append(not forward)
        chance = lambda rows: 1 / (1 + np.exp(-sum(theta[f] for f in rows) - theta[-1]))
        on, rest = np.zeros(width + 1), np.zeros(width + 1)
        for t in toxic:
            for f in [*t, width]:
                on[f] += prior * (chance(t) - 1) / len(toxic)
                rest[f] -= prior * chance(t) / len(toxic)
        for o in others:
            for f in [*o, width]:
                rest[f] += chance(o) / len(others)
        found = on + rest if forward else -backward * rest

        def aim(t):
            confirmed, corrected = parts(t)
            return confirmed + corrected if forward else -backward * corrected

        for i, step in enumerate(1e-5 * np.eye(width + 1)):
            assert found[i] == pytest.approx((aim(theta + step) - aim(theta - step)) / 2e-5, abs=1e-8)
        return found + decay * np.append(theta[:-1], 0)

    theta = np.zeros(width + 1)
    theta[-1] = np.log(prior / (1 - prior))
    first, second, later = np.zeros(width + 1), np.zeros(width + 1), []
    for n in range(1, steps + 1):
        slope = gradient(theta)
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        theta = theta - rate * (first / (1 - 0.9**n)) / (np.sqrt(second / (1 - 0.999**n)) + 1e-8)
        if n > steps // 2:
            later.append(theta)
    assert any(turned) and not all(turned)  # both signs of the corrected part
    weights, bias = toxicity.fit(toxic, others, width, prior, steps, rate, decay, backward)
    assert np.append(weights, bias) == pytest.approx(np.mean(later, axis=0), abs=1e-6)
