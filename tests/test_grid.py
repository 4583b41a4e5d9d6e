"""Joint fits of a grid: against Spark's own fits, whatever the tasks, and in how many jobs."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegressionModel, RandomForestClassificationModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from riskloom.operators import blocks as block_rows
from riskloom.operators import forest, logistic
from riskloom.plans import training


@pytest.fixture(scope="module")
def rows(spark):
    """3,000 rows in four buckets: a column of few values, a constant one, two continuous ones, one skewed."""
    rng = np.random.default_rng(7)
    x = np.column_stack([rng.integers(0, 5, 3000), np.full(3000, 2.0), rng.normal(size=3000), rng.normal(size=3000), rng.exponential(size=3000) ** 3])
    y = (x[:, 0] + 2 * x[:, 2] - x[:, 3] + rng.normal(size=3000) > 2).astype(float)
    data = [(i, [float(v) for v in x[i]], float(y[i]), i % 3) for i in range(3000)]
    df = spark.createDataFrame(data, "k int, x array<double>, label double, fold int")
    df = df.repartition(4, "k").sortWithinPartitions("k").select(array_to_vector("x").alias("features"), "label", "fold")
    df = df.persist()
    yield df
    df.unpersist()


@pytest.fixture(scope="module")
def packed(rows):
    held = training.packed(rows, "label", 3, 3)
    yield held
    held.release()


def test_logistic_fits_are_sparks(rows, packed):
    wanted = [(0, 0.0, 0.0), (0, 0.1, 0.0), (1, 0.01, 0.5), (2, 0.05, 1.0), (None, 0.3, 0.5), (None, 0.5, 1.0)]
    for (fold, reg, net), (coefficients, intercept) in zip(wanted, logistic.fit(packed, wanted, 10, 1e-6)):
        own = training.lr_estimator("label", regParam=reg, elasticNetParam=net).fit(rows if fold is None else rows.where(F.col("fold") != fold))
        assert np.allclose(coefficients, own.coefficients.toArray(), rtol=0, atol=1e-9) and abs(intercept - own.intercept) < 1e-9


def test_a_grid_takes_few_jobs(spark, rows, packed):
    """Jobs follow the slowest fit, not the grid points; the best model and the means are near Spark's cross-validation."""
    for est, grid_of, kind in ((training.lr_estimator("label"), training.lr_grid, LogisticRegressionModel), (training.rf_estimator("label"), training.rf_grid, RandomForestClassificationModel)):
        spark.sparkContext.setJobGroup(f"grid-{est.uid}", "tuning")
        cvm = training.tune(est, grid_of(est), rows, "label", blocks=packed)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"grid-{est.uid}")) < 80
        assert len(cvm.avgMetrics) == len(cvm.getEstimatorParamMaps()) and isinstance(cvm.bestModel, kind)
        best = max(range(len(cvm.avgMetrics)), key=cvm.avgMetrics.__getitem__)
        assert all(cvm.bestModel.getOrDefault(p.name) == v for p, v in cvm.getEstimatorParamMaps()[best].items())
        some = [0, best] if best else [0, 1]
        own = training.tune(est, [grid_of(est)[i] for i in some], rows, "label", tasks=3)
        assert np.allclose([cvm.avgMetrics[i] for i in some], own.avgMetrics, atol=1e-3 if "Logistic" in est.uid else 0.02)
        ours, theirs = (BinaryClassificationEvaluator(labelCol="label").evaluate(m.bestModel.transform(rows)) for m in (cvm, own))
        assert abs(ours - theirs) < 0.02


def test_forests_share_trees_and_do_not_depend_on_tasks(spark, rows, packed):
    grown = forest.fit(packed, [0, None], 4, 6, 42)
    small = forest.fit(packed, [None], 2, 3, 42)[None]
    assert small.nodes(2, 3) == grown[None].nodes(2, 3)
    alone = training.packed(rows, "label", 1, 1)
    assert forest.fit(alone, [0], 4, 6, 42)[0].nodes(4, 6) == grown[0].nodes(4, 6)
    alone.release()
    est = training.rf_estimator("label", numTrees=4, maxDepth=6)
    model = forest.model(spark, est, grown[None], 4, 6)
    assert model.getNumTrees == 4 and model.getOrDefault("maxDepth") == 6 and model.numFeatures == 5
    importance = model.featureImportances.toArray()
    assert abs(importance.sum() - 1) < 1e-9 and importance[1] == 0 and importance.argmax() == 2
    # the model's area is the one counted over the blocks of a fold
    held = forest.model(spark, est, grown[0], 4, 6)
    spark_auc = BinaryClassificationEvaluator(labelCol="label", numBins=0).evaluate(held.transform(rows.where("fold = 0")))
    assert forest.fold_aucs(packed, {0: grown[0]}, [(4, 6)])[(0, 4, 6)] == pytest.approx(spark_auc, abs=1e-5)


def test_bags_are_poisson():
    often = np.concatenate([forest.bag(42, b, 0, 3, 65_535) for b in range(8)])
    assert abs(often.mean() - 1) < 0.01 and abs(often.var() - 1) < 0.01 and abs((often == 0).mean() - np.exp(-1)) < 0.005


def test_area_of_crowded_and_equal_scores(packed):
    """Scores within a millionth of one another are told apart; equal ones count as ties."""
    def scorer(b, names):
        v = b.values(2)
        for name in names:
            yield name, {"near": 0.3 + 1e-8 * np.tanh(v), "plain": 0.5 + 0.4 * np.tanh(v), "same": np.full(len(v), 0.25)}[name]

    found = block_rows.aucs(packed, ["near", "plain", "same"], scorer)
    assert found["same"] == 0.5 and found["plain"] > 0.8 and found["near"] == pytest.approx(found["plain"], abs=1e-4)


def test_blocks_keep_every_row(spark, rows, packed, monkeypatch):
    """Whatever the size of a block and of an Arrow batch, values come back as they were."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")
    try:
        again = training.packed(rows, "label", 2, 2)
        assert {f: (p.n, p.pos) for f, p in again.folds.items()} == {f: (p.n, p.pos) for f, p in packed.folds.items()}
        back = np.sort(np.concatenate([b.matrix().T for b in block_rows.opened(again.rdd.collect())]), axis=0)
        again.release()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert np.array_equal(back, np.sort(np.array([r.features.toArray() for r in rows.collect()]), axis=0))


def test_what_joint_fits_do_not_know_goes_to_spark(rows):
    assert training.packed(rows.where("label = 1 or fold = 0"), "label", 2, 2) is None  # one class without fold 0
    assert training.packed(rows.where("fold < 2"), "label", 2, 2) is None
    assert training.packed(rows.withColumn("label", F.col("label") * 2), "label", 2, 2) is None
    for est in (training.lr_estimator("label", fitIntercept=False), training.rf_estimator("label", maxBins=8)):
        assert training._points(est, [{}]) is None
    forests = training.rf_estimator("label")
    assert sorted(training._points(forests, training.rf_grid(forests))) == [(10, 5), (10, 10), (20, 5), (20, 10)]
