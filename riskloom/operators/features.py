"""Vectors, assembly and standardisation (O-18 .. O-20).

Vectors are Spark ML ``VectorUDT`` inside ML stages and ``array<double>``
at table edges; conversion uses the JVM built-ins ``array_to_vector`` /
``vector_to_array`` (no Python worker).  Scaler statistics are sums
that do not depend on the order of rows (``exact``): two aggregate passes
whatever the row count.
"""

from __future__ import annotations

import uuid

from pyspark.ml import Estimator
from pyspark.ml.common import _py2java
from pyspark.ml.feature import StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators import exact


def to_vector(df: DataFrame, c: str, out: str | None = None) -> DataFrame:
    """array<float|double> -> dense vector.

    A column stored as the vector's struct form (``type, size, indices,
    values``) is rebuilt properly, sparse ones included, with built-in
    higher-order functions.
    """
    dtype = df.schema[c].dataType
    src = F.col(c)
    if isinstance(dtype, T.StructType):
        dense = src["values"]
        sparse = F.transform(
            F.sequence(F.lit(0), src["size"] - 1),
            lambda i: F.coalesce(F.element_at(F.map_from_arrays(src["indices"], src["values"]), i), F.lit(0.0)))
        arr = F.when(src["type"] == 1, dense).otherwise(sparse)
        return df.withColumn(out or c, F.when(src.isNotNull(), array_to_vector(arr)))
    if isinstance(dtype, T.ArrayType) and not isinstance(dtype.elementType, T.DoubleType):
        src = src.cast("array<double>")
    # array_to_vector is not null-safe: a null array stays a null vector.
    return df.withColumn(out or c, F.when(src.isNotNull(), array_to_vector(src)))


def to_array(df: DataFrame, c: str, out: str | None = None) -> DataFrame:
    """vector -> array<double> (a null vector stays null)."""
    v = F.col(c)
    return df.withColumn(out or c, F.when(v.isNotNull(), vector_to_array(v, "float64")))


def vector_columns(df: DataFrame, vec: str, names: list[str], keep: list[str] | None = None) -> DataFrame:
    """Split a vector column into one double column per name."""
    arr = F.when(F.col(vec).isNotNull(), vector_to_array(F.col(vec), "float64"))
    keep = [c for c in df.columns if c != vec] if keep is None else keep
    return df.select(*keep, *[arr[i].alias(n) for i, n in enumerate(names)])


def assembler(cols: list[str], out: str = "features", handle_invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=handle_invalid)


def assemble(df: DataFrame, cols: list[str], out: str = "features", handle_invalid: str = "error") -> DataFrame:
    """O-19: numeric columns -> one vector, in the given order.

    ``error`` (the default) fails on a null at action time; ``keep`` emits
    NaN (scoring masks such rows); ``skip`` drops them.
    """
    return assembler(cols, out, handle_invalid).transform(df)


class ExactScaler(Estimator):
    """Fits a ``StandardScalerModel`` (centred, unit deviation) on exact sums.

    The same rows give the same model bit for bit, whatever their order and
    partitions.  Over Connect, where the model cannot be built from its
    numbers, Spark's own estimator is fitted.
    """

    def __init__(self, inp: str, out: str):
        super().__init__()
        self.inp, self.out = inp, out

    def _fit(self, dataset: DataFrame) -> StandardScalerModel:
        params = {"inputCol": self.inp, "outputCol": self.out, "withMean": True, "withStd": True}
        try:
            context = dataset.sparkSession.sparkContext
        except Exception:  # noqa: BLE001 - Connect has no SparkContext
            return StandardScaler(**params).fit(dataset)
        size = dataset.schema[self.inp].metadata.get("ml_attr", {}).get("num_attrs")
        if size is None:
            first = dataset.select(self.inp).first()
            size = len(first[0]) if first else 0
        values = dataset.select(vector_to_array(F.col(self.inp)).alias("v"))
        _, found = exact.moments(values, {str(i): F.col("v")[i] for i in range(size)})
        stats = [exact.mean_std(*found[str(i)]) for i in range(size)]
        vector = lambda k: _py2java(context, Vectors.dense([s[k] for s in stats]))
        name = f"StandardScaler_{uuid.uuid4().hex[:12]}"
        model = StandardScalerModel(context._jvm.org.apache.spark.ml.feature.StandardScalerModel(name, vector(1), vector(0)))
        model._resetUid(name)
        model._set(**params)
        model._transfer_params_to_java()
        return model


def scaler(inp: str = "features_unscaled", out: str = "features") -> ExactScaler:
    return ExactScaler(inp, out)


def standardize(df: DataFrame, cols: list[str], out: str = "features",
                fit_on: DataFrame | None = None) -> tuple[DataFrame, StandardScalerModel]:
    """O-20: ``(x - mean) / std`` per column (sample std; zero std -> 0).

    Fits on ``fit_on`` (e.g. the training split) or on ``df`` itself.
    Returns the transformed frame (with ``out`` vector) and the model.
    """
    tmp = f"__{out}_unscaled"
    vec = assemble(df, cols, tmp)
    model = scaler(tmp, out).fit(vec if fit_on is None else assemble(fit_on, cols, tmp))
    return model.transform(vec).drop(tmp), model


def scaler_model_stats(model: StandardScalerModel, cols: list[str]) -> list[tuple[str, float, float]]:
    """(column, mean, std) held by a fitted scaler (driver-side, tiny)."""
    return list(zip(cols, model.mean.toArray().tolist(), model.std.toArray().tolist()))
