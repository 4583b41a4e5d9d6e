"""Feature preparation as Spark ML stages (O-21, O-22).

The whole chain (imputation, encoding, assembly, scaling, classifier) is
one ``PipelineModel`` so that scoring applies exactly what training fitted;
saving it keeps the scaler, which removes the train/serve skew of feeding
raw values to a model fitted on standardised ones.

``ZeroMeanImputer`` is an ``Estimator`` whose fitted form is a built-in
``SQLTransformer`` with the means as literals, so a saved pipeline reloads
with stock Spark readers only.
"""

from __future__ import annotations

from pyspark.ml import Estimator, Pipeline
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from riskloom import schemas
from riskloom.operators.clean import drop_ids, drop_null_rows, feature_cols, nonzero_means
from riskloom.operators.features import assembler, scaler

IMPUTED_SUFFIX, ENCODED_SUFFIX = schemas.IMPUTED_SUFFIX, schemas.ENCODED_SUFFIX


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _dlit(v) -> str:
    return "CAST(NULL AS DOUBLE)" if v is None else f"CAST('{float(v)!r}' AS DOUBLE)"


def impute_statement(means: dict, suffix: str = IMPUTED_SUFFIX) -> str:
    """SQL adding ``<c><suffix>``: 0 -> mean, else the value (as double)."""
    parts = [
        f"CASE WHEN {_q(c)} = 0 THEN {_dlit(m)} ELSE CAST({_q(c)} AS DOUBLE) END AS {_q(c + suffix)}"
        for c, m in means.items()
    ]
    return "SELECT *, " + ", ".join(parts) + " FROM __THIS__"


class ZeroMeanImputer(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Zero-as-missing imputer: fit = the non-zero means of its columns."""

    inputCols = Param(Params._dummy(), "inputCols", "columns where 0 means missing",
                      typeConverter=TypeConverters.toListString)
    suffix = Param(Params._dummy(), "suffix", "output column suffix", typeConverter=TypeConverters.toString)

    def __init__(self, inputCols=None, suffix=IMPUTED_SUFFIX):  # noqa: N803 - Spark ML naming
        super().__init__()
        self._setDefault(suffix=IMPUTED_SUFFIX)
        if inputCols is not None:
            self._set(inputCols=list(inputCols))
        self._set(suffix=suffix)

    def _fit(self, dataset: DataFrame) -> SQLTransformer:
        cols = self.getOrDefault(self.inputCols)
        row = nonzero_means(dataset, cols).first()  # |cols| doubles
        means = {c: row[c] for c in cols}
        return SQLTransformer(statement=impute_statement(means, self.getOrDefault(self.suffix)))


def encode_statement(c: str, positive: str, suffix: str = ENCODED_SUFFIX) -> str:
    return (f"SELECT *, CASE WHEN {_q(c)} = '{positive}' THEN 1 ELSE 0 END AS {_q(c + suffix)} "
            "FROM __THIS__")


def zero_impute_stages(features: list[str] | None = None, zero_cols: list[str] | None = None,
                       handle_invalid: str = "error", out: str = "features") -> list:
    """O-21 stages: impute zeros -> assemble -> standardise."""
    features = schemas.DIABETES_FEATURES if features is None else features
    zero_cols = schemas.ZERO_AS_MISSING if zero_cols is None else zero_cols
    inputs = [c + IMPUTED_SUFFIX if c in zero_cols else c for c in features]
    return [
        ZeroMeanImputer(inputCols=zero_cols),
        assembler(inputs, f"{out}_unscaled", handle_invalid),
        scaler(f"{out}_unscaled", out),
    ]


def zero_impute_plan(features=None, zero_cols=None, classifier=None, handle_invalid="error") -> Pipeline:
    stages = zero_impute_stages(features, zero_cols, handle_invalid)
    return Pipeline(stages=stages + ([classifier] if classifier is not None else []))


def null_drop_prepare(df: DataFrame, label: str, ids: list[str], key: str | None = None) -> DataFrame:
    """O-22 row preparation: drop identifiers, then rows with any null.

    Identifiers go first so a null only in an identifier keeps its row.
    The key (if any) is carried along but is not an identifier to drop.
    """
    kept = drop_ids(df, [c for c in ids if c != key])
    subset = [c for c in kept.columns if c != key]
    return drop_null_rows(kept, subset)


def null_drop_stages(features: list[str], encoded: tuple[str, str] | None = schemas.HEART_ENCODED,
                     handle_invalid: str = "error", out: str = "features") -> list:
    """O-22 stages: binary-encode one string column -> assemble -> standardise."""
    stages = []
    inputs = list(features)
    if encoded is not None and encoded[0] in features:
        c, positive = encoded
        stages.append(SQLTransformer(statement=encode_statement(c, positive)))
        inputs = [c + ENCODED_SUFFIX if x == c else x for x in inputs]
    stages += [assembler(inputs, f"{out}_unscaled", handle_invalid), scaler(f"{out}_unscaled", out)]
    return stages


def null_drop_plan(features: list[str], classifier=None, encoded=schemas.HEART_ENCODED,
                   handle_invalid: str = "error") -> Pipeline:
    stages = null_drop_stages(features, encoded, handle_invalid)
    return Pipeline(stages=stages + ([classifier] if classifier is not None else []))


def dynamic_features(df: DataFrame, label: str, key: str | None = None) -> list[str]:
    """O-15 for a prepared table: all columns but the label and the key."""
    return [c for c in feature_cols(df, label) if c != key]
