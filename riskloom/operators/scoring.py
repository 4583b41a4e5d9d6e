"""Batch scoring, fallback gate, consensus verdict and report tables.

Scoring is a chain of narrow projections: each fitted ``PipelineModel``
is applied in turn, only its positive-class probability is kept, and the
rule score, gate and verdict are plain column expressions.  No shuffle,
no collect; the fitted models are shipped to executors once per job.
"""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom import schemas
from riskloom.functions.columns import (
    label_text, mean_prob, percent_text, positive_prob, py_ge, risk_text,
    threshold, vote_count,
)

MODEL_NAMES = {"lr": "Logistic Regression", "rf": "Random Forest"}


def _any_null(cols) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols], F.lit(False))


def for_scoring(model: PipelineModel) -> PipelineModel:
    """Copy of a fitted pipeline whose assemblers keep rows with nulls
    (training fails on them; scoring masks them instead)."""
    stages = [s.copy({s.handleInvalid: "keep"}) if isinstance(s, VectorAssembler) else s for s in model.stages]
    return PipelineModel(stages=stages)


def model_inputs(model: PipelineModel) -> list[str]:
    """Columns that a fitted pipeline reads: its assemblers' inputs by the
    names they have before imputation and encoding."""
    names = [c for s in model.stages if isinstance(s, VectorAssembler) for c in s.getInputCols()]
    return list(dict.fromkeys(c.removesuffix(schemas.IMPUTED_SUFFIX).removesuffix(schemas.ENCODED_SUFFIX) for c in names))


def misfits(model: PipelineModel, df: DataFrame) -> list[str]:
    """Inputs of a fitted pipeline that ``df`` lacks or has in a type that its stages cannot take.

    Such a model would fail while it transforms, when the job already runs.
    """
    assembled = [c for s in model.stages if isinstance(s, VectorAssembler) for c in s.getInputCols()]
    out = []
    for c in assembled:
        name = c.removesuffix(schemas.IMPUTED_SUFFIX).removesuffix(schemas.ENCODED_SUFFIX)
        kind = df.schema[name].dataType if name in df.columns else None
        wanted = T.StringType if c.endswith(schemas.ENCODED_SUFFIX) else (T.NumericType, T.BooleanType)
        if not isinstance(kind, wanted):
            out.append(name)
    return out


def score(df: DataFrame, models: dict, input_cols: list[str] | None = None,
          t: float = schemas.MODEL_THRESHOLD) -> DataFrame:
    """Apply each fitted model; add ``<name>_prob``, ``<name>_pred`` and ``<name>_status``.

    ``models`` maps a short name (``lr``, ``rf``) to a ``PipelineModel``, to
    ``None`` or to ``(model or None, status)`` as ``load_with_status`` gives
    it.  A model that is absent, cannot be read or does not fit the columns
    (one is missing, or is text where a number is wanted) leaves typed nulls and says so in its status (``absent``, ``failed``),
    so the other model still answers.

    Rows with a null in any input of a model (read from its own fitted
    pipeline, or ``input_cols`` besides) get null outputs from it: an
    assembler in ``keep`` mode would feed NaN to the model and some models
    (forests) return an ordinary-looking number for it.  Feature stages
    that several models share run once.
    """
    out, keep = df, list(df.columns)
    groups: dict[tuple, list] = {}
    for name, given in models.items():
        model, status = given if isinstance(given, tuple) else (given, "loaded" if given is not None else "absent")
        if model is not None:
            wrong = misfits(model, df)
            if wrong:
                logging.getLogger(__name__).warning("model %s does not fit the columns %s", name, ", ".join(wrong))
                model, status = None, "failed"
        if model is None:
            out = out.withColumns({f"{name}_prob": F.lit(None).cast("double"), f"{name}_pred": F.lit(None).cast("int")})
        else:
            groups.setdefault(tuple(s.uid for s in model.stages[:-1]), []).append((name, model))
        out = out.withColumn(f"{name}_status", F.lit(status))
    for members in groups.values():
        have = out.columns
        first = members[0][1]
        featured = for_scoring(PipelineModel(stages=first.stages[:-1])).transform(out)
        for name, model in members:
            nulls = _any_null(dict.fromkeys(model_inputs(model) + list(input_cols or [])))
            base = featured.columns
            scored = model.stages[-1].transform(featured)
            prob = F.when(nulls, F.lit(None).cast("double")).otherwise(positive_prob("probability"))
            featured = scored.select(*[F.col(c) for c in base], prob.alias(f"{name}_prob"))
            featured = featured.withColumn(f"{name}_pred", threshold(f"{name}_prob", t))
        out = featured.select(*have, *[f"{n}_{x}" for n, _ in members for x in ("prob", "pred")])
    return out.select(*keep, *[f"{n}_{x}" for n in models for x in ("prob", "pred", "status")])


def fallback_gate(df: DataFrame, rule_pred: str = "rule_pred", rule_prob: str = "rule_prob",
                  rule_status: str | None = "rule_status",
                  model_preds=("lr_pred", "rf_pred")) -> DataFrame:
    """Keep the rule score only where no model answered.

    Adds ``source``: ``models`` if any model answered, else ``rules``, or
    ``last_resort`` where the rule itself failed (scored (0, 0.5)).
    """
    none = reduce(lambda a, b: a & b, [F.col(p).isNull() for p in model_preds])
    failed = (F.col(rule_status) == "failed") if rule_status and rule_status in df.columns else F.lit(False)
    return df.withColumns({
        rule_pred: F.when(none, F.col(rule_pred)),
        rule_prob: F.when(none, F.col(rule_prob)),
        "source": F.when(~none, F.lit("models")).when(failed, F.lit("last_resort")).otherwise(F.lit("rules")),
    })


def verdict(df: DataFrame, probs=("lr_prob", "rf_prob"), preds=("lr_pred", "rf_pred"),
            rule_pred: str = "rule_pred", rule_prob: str = "rule_prob",
            t: float = schemas.CONSENSUS_THRESHOLD) -> DataFrame:
    """Consensus verdict per row (after ``fallback_gate``).

    Models path: ``votes`` = models voting 1, ``risk_prob`` = mean of the
    answering models; High if any vote or the mean is >= t.  Rule path:
    High if the rule class is 1 or its probability is >= t.
    """
    models = F.col("source") == "models"
    votes = vote_count(*preds)
    mean = mean_prob(*probs)
    high_models = (votes > 0) | py_ge(mean, t)
    high_rules = (F.col(rule_pred) == 1) | py_ge(F.col(rule_prob), t)
    return df.withColumns({
        "votes": F.when(models, votes),
        "risk_prob": F.when(models, mean).otherwise(F.col(rule_prob)),
        "verdict": F.when(F.when(models, high_models).otherwise(high_rules), F.lit("High")).otherwise(F.lit("Low")),
    })


def consensus(df: DataFrame, **kw) -> DataFrame:
    """``fallback_gate`` then ``verdict``."""
    return verdict(fallback_gate(df), **kw)


def comparison(df: DataFrame, key: str, names: dict | None = None) -> DataFrame:
    """Long comparison table: one row per (key, model that answered)."""
    names = MODEL_NAMES if names is None else names
    parts = [
        F.struct(F.lit(label).alias("model"), F.col(f"{n}_pred").alias("pred"), F.col(f"{n}_prob").alias("prob"))
        for n, label in names.items()
    ]
    long = df.select(F.col(key), F.explode(F.array(*parts)).alias("m")).where(F.col("m.pred").isNotNull())
    return long.select(
        F.col(key),
        F.col("m.model").alias("model"),
        label_text("m.pred").alias("prediction"),
        risk_text("m.pred").alias("risk_level"),
        F.col("m.prob").alias("probability"),
        percent_text("m.prob").alias("probability_text"),
    )


# ---------------------------------------------------------------------------
# Texts shown to users per (task, verdict) and per task.
# ---------------------------------------------------------------------------
RECOMMENDATIONS = {
    ("diabetes", "High"): "Further clinical tests are recommended.",
    ("diabetes", "Low"): "Maintain a healthy lifestyle and regular check-ups.",
    ("heart", "High"): "Immediate consultation with a cardiologist is advised.",
    ("heart", "Low"): "Continue with regular health check-ups and maintain a healthy lifestyle.",
}
HEADLINES = {"diabetes": " Risk of Diabetes", "heart": " Risk of Heart Attack"}
FALLBACK_HEADLINE = " (Fallback Prediction)"
MESSAGES = {
    "models": "The models predict an average ",
    "fallback": "The fallback prediction indicates a ",
    "diabetes": " probability of diabetes.",
    "heart": " probability of heart attack risk.",
}
# ---------------------------------------------------------------------------


def recommend(df: DataFrame, task: str | Column, verdict_col: str = "verdict") -> Column:
    """Recommendation text for ``task`` and the row's verdict (a ``when`` chain)."""
    tcol = F.lit(task) if isinstance(task, str) else task
    expr = None
    for (tk, vd), text in RECOMMENDATIONS.items():
        cond = (tcol == tk) & (F.col(verdict_col) == vd)
        expr = F.when(cond, F.lit(text)) if expr is None else expr.when(cond, F.lit(text))
    return expr


def headline(task: str, verdict_col: str = "verdict", source_col: str = "source") -> Column:
    """Short verdict heading, e.g. ``High Risk of Diabetes (Fallback Prediction)``."""
    base = F.concat(F.col(verdict_col), F.lit(HEADLINES[task]))
    return F.when(F.col(source_col) == "models", base).otherwise(F.concat(base, F.lit(FALLBACK_HEADLINE)))


def message(task: str, prob_col: str = "risk_prob", source_col: str = "source") -> Column:
    """Verdict message with the probability as Python's ``{p:.1%}`` writes
    it: the models' mean, or the fallback rule's value."""
    lead = F.when(F.col(source_col) == "models", F.lit(MESSAGES["models"])).otherwise(F.lit(MESSAGES["fallback"]))
    return F.concat(lead, percent_text(prob_col), F.lit(MESSAGES[task]))


def score_all(df: DataFrame, task: str, models: dict, key: str | None = None) -> DataFrame:
    """Full per-row result: models, rule fallback, verdict and text.

    Every input row is kept (one output row per input row); ``key``, if
    given, leads the output columns.
    """
    from riskloom.functions.rules import rule_score_a, rule_score_b
    inputs = schemas.DIABETES_FEATURES if task == "diabetes" else schemas.HEART_FEATURES
    scored = score(df, models, [c for c in inputs if c in df.columns])  # the form's inputs and the model's own
    encoded = schemas.HEART_ENCODED[0] if task != "diabetes" else None
    text = [c for c in inputs if c in df.columns and c != encoded and isinstance(df.schema[c].dataType, T.StringType)]
    if text:  # the rules take what reads as a number; other texts count as null, which the rules answer
        scored = scored.withColumnsRenamed({c: f"__text_{c}" for c in text}).withColumns({c: F.col(f"__text_{c}").try_cast("double") for c in text})
    if task == "diabetes":
        ruled = rule_score_a(scored, with_status=True)
    else:
        g, positive = schemas.HEART_ENCODED
        text_gender = g in df.columns and df.schema[g].dataType.typeName() == "string"
        if text_gender:  # rules read the form's 1 = male flag
            scored = scored.withColumnRenamed(g, "__gender_text").withColumn(
                g, F.when(F.col("__gender_text") == positive, 1).otherwise(0))
        ruled = rule_score_b(scored, with_status=True)
        if text_gender:
            ruled = ruled.drop(g).withColumnRenamed("__gender_text", g)
    if text:
        ruled = ruled.drop(*text).withColumnsRenamed({f"__text_{c}": c for c in text})
    out = consensus(ruled)
    out = out.withColumns({"recommendation": recommend(out, task), "headline": headline(task),
                           "message": message(task)})
    return out.select(key, *[c for c in out.columns if c != key]) if key else out
