"""Model training and tuning (O-32 .. O-36, O-39, O-40, O-43).

Spark ML estimators are already distributed (tree aggregates for the
logistic loss, per-node histograms for forests), so the plan here is
about *what* is fitted and on which rows:

* the split and the CV folds are key hashes (``split``);
* the training rows are dealt by a hash of all their columns to buckets and
  sorted by key in each.  The number of buckets follows from the row count
  alone and is kept in the registry.  Forests seed their bagging and split
  samples per partition, so the fitted trees do not depend on the input's
  files, the cores or which executors survived, and a key that many rows
  share does not fill one bucket;
* feature stages (impute, encode, assemble, scale) are fitted once on the
  training rows with order-independent sums, and the featurised training set
  is persisted for the many passes of tuning, then unpersisted;
* tuning packs these rows once into blocks by bucket and fold and moves all
  fits of a grid forward together (``operators.blocks``, ``logistic``,
  ``forest``): a pass over the blocks serves every grid point and fold.  The
  logistic fits are Spark ML's step by step, the forests of a fold share
  their trees.  Models come out as Spark ML models;
* other estimators or parameters, labels beyond 0 and 1, folds without rows
  or without both classes, and Connect go through ``CrossValidator`` with
  ``foldCol`` and ``parallelism``; its logistic fits and evaluations read the
  buckets in no more tasks than there are cores (``pass_tasks``);
* the winner is refit on all training rows and stored together with the
  feature stages as one ``PipelineModel``.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom import schemas
from riskloom.operators import forest, logistic
from riskloom.operators.blocks import Blocks
from riskloom.operators.split import assign_folds, with_split
from riskloom.plans import feature_plans
from riskloom.session import cores as n_cores

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference for identical tuning).
# ---------------------------------------------------------------------------
LR_MAX_ITER = 10
LR_REG_PARAMS = [0.01, 0.1, 0.3]
LR_ELASTIC_NET = [0.0, 0.5, 1.0]
RF_SEED = 42
RF_NUM_TREES = [10, 20]
RF_MAX_DEPTH = [5, 10]
CV_FOLDS = 3
SPLIT_FRACTION = 0.8
SPLIT_SEED = 42
# ---------------------------------------------------------------------------

#: Buckets of the training rows: so many rows each while there are few buckets, then up to ``MOST_ROWS``.
LEAST_ROWS, FEW_BUCKETS, MOST_ROWS = 16_384, 64, 1_000_000
#: Grid points fitted at once (measured at 15,000 rows: README).
PARALLELISM = 4

MODEL_KEYS = {"lr": "logistic_regression", "rf": "random_forest"}


def buckets(rows: int) -> int:
    """Number of training buckets for a row count: part of a model's definition like a seed."""
    return max(1, min(FEW_BUCKETS, -(-rows // LEAST_ROWS)), -(-rows // MOST_ROWS))


def pass_tasks(partitions: int, rows: int, cores: int) -> int:
    """Tasks of a pass whose result does not depend on the buckets: one a core, or one a ``MOST_ROWS`` rows if that is more."""
    return min(partitions, max(cores, -(-rows // MOST_ROWS)))


class NarrowEvaluator(BinaryClassificationEvaluator):
    """Spark's evaluator (binned AUC) in ``tasks`` tasks: it runs five short jobs over the distinct scores."""

    def __init__(self, label: str, tasks: int):
        super().__init__(labelCol=label)
        self.tasks = tasks

    def _evaluate(self, dataset: DataFrame) -> float:
        return super()._evaluate(dataset.coalesce(self.tasks))


def lr_estimator(label: str, features: str = "features", **params) -> LogisticRegression:
    return LogisticRegression(featuresCol=features, labelCol=label, maxIter=params.pop("maxIter", LR_MAX_ITER), **params)


def rf_estimator(label: str, features: str = "features", seed: int = RF_SEED, **params) -> RandomForestClassifier:
    return RandomForestClassifier(featuresCol=features, labelCol=label, seed=seed, cacheNodeIds=params.pop("cacheNodeIds", True), **params)


def lr_grid(lr: LogisticRegression) -> list:
    """O-34: regParam x elasticNetParam, 9 points."""
    return ParamGridBuilder().addGrid(lr.regParam, LR_REG_PARAMS).addGrid(lr.elasticNetParam, LR_ELASTIC_NET).build()


def rf_grid(rf: RandomForestClassifier) -> list:
    """O-35: numTrees x maxDepth, 4 points."""
    return ParamGridBuilder().addGrid(rf.numTrees, RF_NUM_TREES).addGrid(rf.maxDepth, RF_MAX_DEPTH).build()


def _points(est, grid: list) -> list[tuple] | None:
    """(regParam, elasticNetParam) or (numTrees, maxDepth) of each grid point; None where a parameter is set that the joint fits do not know."""
    if type(est) is LogisticRegression:
        names, known = ("regParam", "elasticNetParam"), {"featuresCol", "labelCol", "maxIter", "tol"}
    elif type(est) is RandomForestClassifier:
        names, known = ("numTrees", "maxDepth"), {"featuresCol", "labelCol", "seed", "cacheNodeIds"}
    else:
        return None
    if not {p.name for p in est._paramMap} <= known | set(names) or not all({p.name for p in m} <= set(names) for m in grid):
        return None
    out = [tuple(m.get(est.getParam(n), est.getOrDefault(n)) for n in names) for m in grid]
    return out if names[0] == "regParam" or all(t > 1 and 0 < d <= forest.DEEPEST for t, d in out) else None


def packed(data: DataFrame, label: str, tasks: int, cores: int, k: int = CV_FOLDS, fold_col: str = "fold") -> Blocks | None:
    """The training rows as blocks, or None where they do not allow joint fits."""
    try:
        data.sparkSession.sparkContext  # noqa: B018 - Connect has none
    except Exception:  # noqa: BLE001
        return None
    blocks = Blocks(data, label, fold_col, tasks, cores)
    if blocks.complete(k):
        return blocks
    blocks.release()
    return None


def tune(est, grid: list, train: DataFrame, label: str, k: int = CV_FOLDS, fold_col: str = "fold",
         parallelism: int = 4, seed: int = SPLIT_SEED, tasks: int | None = None, blocks: Blocks | None = None):
    """O-36: k-fold CV by AUC over ``grid``; the best is refit on all of
    ``train``.  Folds come from ``fold_col`` (keyed), not a random split.
    With ``blocks`` (``packed`` rows of ``train``) all fits go forward together;
    ``tasks`` bounds the tasks of an evaluation without them."""
    cv = CrossValidator(estimator=est, estimatorParamMaps=grid,
                        evaluator=NarrowEvaluator(label, tasks) if tasks else BinaryClassificationEvaluator(labelCol=label),
                        numFolds=k, foldCol=fold_col, parallelism=parallelism, seed=seed)
    points = _points(est, grid)
    if blocks is None or points is None:
        return cv.fit(train)
    spark, folds = train.sparkSession, range(k)
    if isinstance(est, LogisticRegression):
        most, tol = est.getMaxIter(), est.getTol()
        wanted = [(f, *p) for f in folds for p in points]
        aucs = logistic.fold_aucs(blocks, {(f, i): fit for (f, i), fit in zip(
            [(f, i) for f in folds for i in range(len(points))], logistic.fit(blocks, wanted, most, tol))})
        means = [sum(aucs[(f, i)] for f in folds) / k for i in range(len(points))]
    else:
        trees, depth = (max(p[i] for p in points) for i in (0, 1))
        aucs = forest.fold_aucs(blocks, forest.fit(blocks, list(folds), trees, depth, est.getSeed()), sorted(set(points)))
        means = [sum(aucs[(f, *p)] for f in folds) / k for p in points]
    best = max(range(len(points)), key=means.__getitem__)
    tuned = est.copy(grid[best])
    if isinstance(est, LogisticRegression):
        model = logistic.model(spark, tuned, *logistic.fit(blocks, [(None, *points[best])], most, tol)[0])
    else:
        model = forest.model(spark, tuned, forest.fit(blocks, [None], *points[best], est.getSeed())[None], *points[best])
    return cv._copyValues(CrossValidatorModel(model, means))


def cv_report(spark: SparkSession, cv_model, model_name: str, fit_seconds: float) -> DataFrame:
    """O-39/O-43: one row per grid point (params, mean AUC, best flag, fit time)."""
    maps = cv_model.getEstimatorParamMaps()
    metrics = list(cv_model.avgMetrics)
    best = max(range(len(metrics)), key=lambda i: metrics[i])
    rows = []
    for i, (pm, m) in enumerate(zip(maps, metrics)):
        params = ",".join(f"{p.name}={v}" for p, v in sorted(pm.items(), key=lambda kv: kv[0].name))
        rows.append((model_name, i, params, float(m), i == best, float(fit_seconds)))
    return spark.createDataFrame(
        rows, "model string, grid_index int, params string, mean_auc double, is_best boolean, fit_seconds double")


def feature_importance(spark: SparkSession, model, cols: list[str]) -> DataFrame:
    """O-40: (feature, importance) of a fitted forest."""
    imp = model.featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(cols, [float(x) for x in imp])), "feature string, importance double")


@dataclass
class TaskFit:
    """Everything one training run of a task produces."""
    models: dict = field(default_factory=dict)        # short name -> PipelineModel
    reports: dict = field(default_factory=dict)       # short name -> cv report DataFrame
    classifiers: dict = field(default_factory=dict)   # short name -> fitted classifier
    test: DataFrame | None = None
    train: DataFrame | None = None
    feature_names: list = field(default_factory=list)
    n_train: int = 0
    partitions: int = 1


def fit_task(spark: SparkSession, df: DataFrame, key: str, label: str, task: str = "diabetes",
             features: list[str] | None = None, models=("lr", "rf"), tune_models: bool = True,
             fit_scope: str = "train", parallelism: int | None = None,
             partitions: int | None = None) -> TaskFit:
    """Split by key, fit feature stages, tune each model, assemble pipelines.

    ``fit_scope="all"`` fits imputation/scaling on every row (the reference's
    behaviour, which leaks test rows into the scaler); the default fits on
    the training split only.
    """
    if features is None:
        features = schemas.DIABETES_FEATURES if task == "diabetes" else feature_plans.dynamic_features(df, label, key)
    split = with_split(df, key, SPLIT_FRACTION, SPLIT_SEED)
    train = assign_folds(split.where(F.col("split") == "train"), key, CV_FOLDS, SPLIT_SEED)
    n_train = train.count()
    partitions = buckets(n_train) if partitions is None else partitions
    test = split.where(F.col("split") == "test")
    if task == "diabetes":
        stages = feature_plans.zero_impute_stages(features, [c for c in schemas.ZERO_AS_MISSING if c in features])
    else:
        gcol = schemas.HEART_ENCODED[0]
        is_text = gcol in df.columns and df.schema[gcol].dataType.typeName() == "string"
        enc = schemas.HEART_ENCODED if gcol in features and is_text else None
        stages = feature_plans.null_drop_stages(features, enc)
    from pyspark.ml import Pipeline
    feat_model = Pipeline(stages=stages).fit(df if fit_scope == "all" else train)
    dealt = train.select(key, *[c for c in features if c != key], label, "fold")
    dealt = dealt.repartition(partitions, *dealt.columns).sortWithinPartitions(*dealt.columns)
    data = feat_model.transform(dealt).select("features", F.col(label).cast("double").alias(label), "fold")
    cores = n_cores(spark)
    out = TaskFit(test=test, train=train, feature_names=list(features), n_train=n_train, partitions=partitions)
    tasks = pass_tasks(partitions, n_train, cores)
    blocks = packed(data, label, tasks, cores) if tune_models else None
    if blocks is None:
        data = data.persist(StorageLevel.MEMORY_AND_DISK)  # both models pass over these rows many times
    try:
        for name in models:
            est = lr_estimator(label) if name == "lr" else rf_estimator(label)
            rows = data.coalesce(tasks) if name == "lr" else data
            t0 = time.time()
            if tune_models:
                grid = lr_grid(est) if name == "lr" else rf_grid(est)
                par = parallelism or max(1, min(len(grid), cores, PARALLELISM))
                cvm = tune(est, grid, rows, label, parallelism=par, tasks=tasks, blocks=blocks)
                clf = cvm.bestModel
                out.reports[name] = cv_report(spark, cvm, MODEL_KEYS[name], time.time() - t0)
            else:
                clf = est.fit(rows)
            out.classifiers[name] = clf
            out.models[name] = PipelineModel(stages=list(feat_model.stages) + [clf])
    finally:
        (data.unpersist if blocks is None else blocks.release)()
    return out
