"""The three stages of a run as library jobs: prepare, train, serve.

Each takes the caller's session and paths on the shared file system; each
is a handful of DataFrame / Spark ML calls, so a scheduler can run them as
separate steps and a failed step can be rerun from the files of the last.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom import schemas
from riskloom.operators import evaluate, scoring
from riskloom.plans import feature_plans, training
from riskloom.session import scratch_path
from riskloom.sources import files, models as model_io, registry, versions

MODEL_DIRS = {"lr": "model_lr", "rf": "model_rf"}


def task_spec(task: str, df: DataFrame, key: str | None) -> tuple[str, list[str]]:
    """(label, feature names) of a task, bound by name."""
    if task == "diabetes":
        return schemas.DIABETES_LABEL, [c for c in schemas.DIABETES_FEATURES if c in df.columns]
    label = schemas.HEART_LABEL
    return label, feature_plans.dynamic_features(df.drop(*[c for c in schemas.HEART_ID_COLUMNS if c != key]),
                                                 label, key)


def prepare(df: DataFrame, task: str, out_path: str, key: str | None = None) -> DataFrame:
    """Stage 1: clean and featurise (imputation/encoding, vector, z-scores)
    and write ``(key, features, label)`` parquet.  Returns the written frame.

    Like the reference this fits on every row; ``train`` refits the
    feature stages on the training split for the served pipeline.
    """
    label, feats = task_spec(task, df, key)
    if task == "diabetes":
        src = df
        stages = feature_plans.zero_impute_stages(feats, [c for c in schemas.ZERO_AS_MISSING if c in feats])
    else:
        src = feature_plans.null_drop_prepare(df, label, schemas.HEART_ID_COLUMNS, key)
        text = src.schema[schemas.HEART_ENCODED[0]].dataType.typeName() == "string" \
            if schemas.HEART_ENCODED[0] in src.columns else False
        stages = feature_plans.null_drop_stages(feats, schemas.HEART_ENCODED if text else None)
    model = Pipeline(stages=stages).fit(src)
    keep = ([key] if key else []) + ["features", label]
    out = model.transform(src).select(*keep)
    files.write_processed(out, out_path)
    return files.read_processed(out.sparkSession, out_path)


def train(spark: SparkSession, df: DataFrame, task: str, models_dir: str, key: str,
          fit_scope: str = "train", partitions: int | None = None) -> DataFrame:
    """Stage 2: drop rows with nulls (heart task), split by key, tune LR and
    RF, save both pipelines, the CV reports and the importances, score the
    held-out rows, pick the winner (a tie keeps LR) and write the registry.

    All of it goes to a folder of its own, which is published last: until
    then, and if the run fails, readers find the version before.

    Returns the registry ``(task, model, auc, auc_binned, accuracy, n_train,
    n_test, partitions, path, is_best)``.
    """
    label, feats = task_spec(task, df, key)
    if task != "diabetes":
        df = feature_plans.null_drop_prepare(df, label, schemas.HEART_ID_COLUMNS, key)
    fit = training.fit_task(spark, df, key, label, task, features=feats, fit_scope=fit_scope, partitions=partitions)
    folder = versions.new_folder(models_dir, task)
    paths = {name: model_io.save_model(pipe, f"{folder}/{MODEL_DIRS[name]}") for name, pipe in fit.models.items()}
    reports = list(fit.reports.values())
    for r in reports[1:]:
        reports[0] = reports[0].unionByName(r)
    reports[0].coalesce(1).write.mode("overwrite").parquet(f"{folder}/cv_report")
    importances = training.feature_importance(spark, fit.classifiers["rf"], fit.feature_names)
    importances.coalesce(1).write.mode("overwrite").parquet(f"{folder}/importances")
    out = register(spark, task, fit.test, paths, label, f"{folder}/registry", fit.n_train, fit.partitions)
    versions.publish(spark, models_dir, task, folder)
    return out


def register(spark: SparkSession, task: str, test: DataFrame, paths: dict, label: str, registry_path: str,
             n_train: int, partitions: int) -> DataFrame:
    """Score the held-out rows with the saved pipelines in one pass, reduce
    them to counts per (model, score, class, label), written once, and take
    exact AUC, accuracy and Spark's binned AUC from the counts; mark the
    winner and write the registry table.

    ``auc_binned`` is Spark's evaluator with its default 1000 bins, the
    number the reference prints; the winner is chosen on the exact AUC.
    """
    scored = scoring.score(test, {name: model_io.load_model(path) for name, path in paths.items()})
    # accuracy uses the model's own class (argmax, p > 0.5), not the served 0.3 cut-off
    long = scored.select(F.explode(F.array(*[
        F.struct(F.lit(training.MODEL_KEYS[n]).alias("model"), F.lit(path).alias("path"), F.col(f"{n}_prob").alias("score"),
                 (F.col(f"{n}_prob") > 0.5).cast("int").alias("pred"), F.col(label).cast("int").alias("label"))
        for n, path in paths.items()])).alias("m")).select("m.*")
    counts = long.groupBy("model", "path", "score", "pred", "label").agg(F.count("*").alias("rows"))
    counts_path = scratch_path(spark, "test-counts")
    counts.write.parquet(counts_path)
    counts = spark.read.schema(counts.schema).parquet(counts_path)
    auc = evaluate.auc_exact(counts, "score", "label", by=["model", "path"], weight="rows")
    right = F.when(F.col("pred").isNotNull() & F.col("label").isNotNull(), (F.col("pred") == F.col("label")).cast("int"))
    acc = counts.groupBy("model").agg(
        (F.sum(right * F.col("rows")) / F.sum(F.when(right.isNotNull(), F.col("rows")))).alias("accuracy"))
    binned = spark.createDataFrame(
        [(m, evaluate.auc_binned(evaluate.score_counts(counts.where(F.col("model") == m), "score", "label", [], "rows")))
         for m in (training.MODEL_KEYS[n] for n in paths)], "model string, auc_binned double")
    metrics = evaluate.pick_best(
        auc.withColumnRenamed("n", "n_test").join(acc, "model").join(binned, "model")
        .select(F.lit(task).alias("task"), "model", "auc", "auc_binned", "accuracy", F.lit(n_train).cast("long").alias("n_train"),
                "n_test", F.lit(partitions).alias("partitions"), "path"))
    registry.write_registry(metrics, registry_path)
    return registry.read_registry(spark, registry_path)


def load_models(spark: SparkSession, folder: str | None) -> dict:
    """Both models of a version's folder with their status; all absent without one."""
    return {n: model_io.load_with_status(spark, folder and f"{folder}/{d}") for n, d in MODEL_DIRS.items()}


def serve(spark: SparkSession, df: DataFrame, task: str, models_dir: str, key: str) -> DataFrame:
    """Stage 3: score rows with whichever models of the current version can be loaded
    (``lr_status``, ``rf_status`` say which), fall back to the rules where
    none answers, and add the verdict and its texts."""
    models = load_models(spark, versions.current(spark, models_dir, task)[1])
    return scoring.score_all(df, task, models, key)


def serve_checked(spark: SparkSession, df: DataFrame, task: str, models_dir: str, key: str,
                  bounds: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """Stage 3 behind the entry form's bounds: rows inside every bound (and
    without nulls in a bounded input) are scored; the others come back
    unscored with the names of the inputs they violate.  Both are lazy and
    come from one range-check projection (no shuffle)."""
    from riskloom.operators.clean import range_split
    if bounds is None:
        bounds = schemas.DIABETES_BOUNDS if task == "diabetes" else schemas.HEART_BOUNDS
    valid, rejected = range_split(df, {c: b for c, b in bounds.items() if c in df.columns})
    return serve(spark, valid, task, models_dir, key), rejected
