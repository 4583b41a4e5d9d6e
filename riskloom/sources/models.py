"""Model sink and source (O-07, O-08, O-53).

A model is a whole ``PipelineModel`` (feature stages + classifier), loaded
once per job and applied to any number of rows.
"""

from __future__ import annotations

import logging

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql.utils import AnalysisException


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence on the cluster file system (driver-side metadata call).

    Faults of the store are raised, not taken for absence.  Without a JVM
    gateway (Connect) a read of the path tells.
    """
    try:
        context = spark.sparkContext
        jvm = context._jvm
    except Exception:  # noqa: BLE001 - Connect has no SparkContext
        jvm = None
    if jvm is None:
        try:
            spark.read.text(path).limit(0).collect()
            return True
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return False
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return bool(jpath.getFileSystem(context._jsc.hadoopConfiguration()).exists(jpath))


def load_with_status(spark: SparkSession, path: str | None) -> tuple[PipelineModel | None, str]:
    """(model, ``loaded``), (None, ``absent``) or (None, ``failed``).

    A model that is there but cannot be read (damaged, of another kind, or
    its store does not answer) fails alone; the other model still answers,
    and the status stands in the scored rows.
    """
    if path is None:
        return None, "absent"
    try:
        if not path_exists(spark, path):
            return None, "absent"
        return load_model(path), "loaded"
    except Exception as e:  # noqa: BLE001 - whatever keeps this model from loading must not stop the other
        logging.getLogger(__name__).warning("model %s cannot be loaded: %s", path, str(e).split("\n")[0])
        return None, "failed"
