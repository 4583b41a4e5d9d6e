"""Winner registry (O-42) and artefact status (O-60).

The registry is a small parquet table ``(task, model, auc, path, is_best)``
written next to a version's models (``versions``); status is a left join of the expected
artefacts against it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.sources import versions

# The artefacts a complete training run leaves behind.
EXPECTED_ARTEFACTS = [
    ("diabetes", "logistic_regression"), ("diabetes", "random_forest"),
    ("heart", "logistic_regression"), ("heart", "random_forest"),
    ("diabetes", "best"), ("heart", "best"),
]


def write_registry(metrics: DataFrame, path: str) -> None:
    """Write ``(task, model, auc[, accuracy], path, is_best)`` as one small
    parquet file (a handful of rows: one per trained model)."""
    cols = [c for c in ("task", "model", "auc", "auc_binned", "accuracy", "n_train", "n_test", "partitions", "path", "is_best") if c in metrics.columns]
    metrics.select(*cols).coalesce(1).write.mode("overwrite").parquet(path)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def registry_status(expected: DataFrame, registry: DataFrame) -> DataFrame:
    """Expected ``(task, model)`` rows with ``present`` and ``is_best``.

    A ``best`` entry is present when the task has a winner row.
    """
    rows = registry.select("task", "model", F.col("is_best"))
    best = registry.where("is_best").select("task", F.lit("best").alias("model"), F.lit(True).alias("is_best"))
    have = rows.unionByName(best).groupBy("task", "model").agg(F.max(F.col("is_best").cast("int")).alias("b"))
    j = expected.join(have, ["task", "model"], "left")
    return j.select("task", "model", F.col("b").isNotNull().alias("present"),
                    F.coalesce(F.col("b") == 1, F.lit(False)).alias("is_best"))


def expected_frame(spark: SparkSession, expected=None) -> DataFrame:
    return spark.createDataFrame(EXPECTED_ARTEFACTS if expected is None else expected, "task string, model string")


def artefact_status(spark: SparkSession, models_dir: str, tasks=("diabetes", "heart")) -> DataFrame:
    """O-60 on the file system: which models and registry each task's current
    version under ``models_dir`` has (a fixed handful of paths, checked through
    the cluster's file system from the driver; no data is read)."""
    from riskloom.plans.jobs import MODEL_DIRS
    from riskloom.sources.models import path_exists
    rows = []
    for t in tasks:
        _, folder = versions.current(spark, models_dir, t)
        for n, d in {**MODEL_DIRS, "registry": "registry"}.items():
            rows.append((t, n, folder and f"{folder}/{d}", bool(folder) and path_exists(spark, f"{folder}/{d}")))
    return spark.createDataFrame(rows, "task string, artefact string, path string, present boolean")
