"""Exact AUC against a brute-force rank sum, winner choice and accuracy."""

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator

from riskloom.operators import evaluate


def brute_auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


@pytest.mark.parametrize("parts", [1, 3, 64])
def test_auc_exact_matches_brute_force(spark, parts):
    rnd = random.Random(3)
    rows = []
    for g in ("a", "b"):
        for _ in range(700):
            s = round(rnd.random(), 2)          # many ties
            rows.append((g, s, 1 if rnd.random() < s else 0))
    # a hot score holding a third of group a
    rows += [("a", 0.5, i % 2) for i in range(700)]
    df = spark.createDataFrame(rows, "g string, s double, y int").repartition(parts)
    got = {r.g: r.auc for r in evaluate.auc_exact(df, "s", "y", by=["g"]).collect()}
    for g in ("a", "b"):
        assert got[g] == pytest.approx(brute_auc([(s, y) for gg, s, y in rows if gg == g]), abs=1e-12)


def test_auc_matches_spark_evaluator_exact_mode(spark):
    rnd = random.Random(5)
    rows = [(rnd.random(), 1.0 if rnd.random() < 0.4 else 0.0) for _ in range(2000)]
    df = spark.createDataFrame(rows, "s double, y double")
    ours = evaluate.auc_exact(df, "s", "y").first().auc
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql import functions as F
    raw = df.select(array_to_vector(F.array(-F.col("s"), F.col("s"))).alias("rawPrediction"), F.col("y").alias("label"))
    spark_auc = BinaryClassificationEvaluator(numBins=0).evaluate(raw)
    assert ours == pytest.approx(spark_auc, abs=1e-9)


def test_auc_single_class_is_null(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 1)], "s double, y int")
    assert evaluate.auc_exact(df, "s", "y").first().auc is None


def test_pick_best_tie_goes_to_lr(spark):
    m = spark.createDataFrame([("d", "logistic_regression", 0.8), ("d", "random_forest", 0.8),
                               ("h", "logistic_regression", 0.7), ("h", "random_forest", 0.71)],
                              "task string, model string, auc double")
    best = {(r.task, r.model) for r in evaluate.pick_best(m).where("is_best").collect()}
    assert best == {("d", "logistic_regression"), ("h", "random_forest")}


def test_accuracy(spark):
    df = spark.createDataFrame([(1, 1), (0, 1), (1, None), (0, 0)], "p int, y int")
    r = evaluate.accuracy(df, "p", "y").first()
    assert r.accuracy == pytest.approx(2 / 3) and r.n == 3


def test_auc_has_no_task_that_sees_all_rows(spark, sf_small):
    from riskloom.plans.catalog import rule_scores_long

    rows = rule_scores_long(spark, sf_small)
    counts = evaluate.score_counts(rows, "score", "label", ["task"])
    plans = [counts, evaluate.auc_exact(rows, "score", "label", by=["task"])]
    for df in plans:
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in text and "percentile" not in text
    # one scan a table: the input is reduced to counts once
    assert plans[0]._jdf.queryExecution().executedPlan().toString().count("FileScan") == 2
    assert "events.parquet" not in plans[1]._jdf.queryExecution().executedPlan().toString()
