"""Registered queries: one callable per operator of the inventory.

Each takes ``(spark, sf_dir)`` and returns a lazy ``DataFrame`` over the
driver's tables (or data Spark derives from them).  Column names and
double rounding match ``oracle.ORACLE`` for the value-checked ones.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

from pyspark.ml.feature import SQLTransformer, StandardScalerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyspark.ml.functions import array_to_vector

from riskloom import schemas
from riskloom.functions import columns as fcols
from riskloom.functions.columns import decode_flag
from riskloom.functions.columns import threshold as fcols_threshold
from riskloom.functions.rules import rule_score_a, rule_score_b
from riskloom.operators import clean, evaluate, features, profile, scoring, split
from riskloom.plans import feature_plans, jobs, training, views
from riskloom.session import app_id, checkpoint_root, scratch_path
from riskloom.sources import files, registry, versions
from riskloom.sources import models as model_io
from riskloom.streaming.score_stream import read_stream, score_stream, score_stream_refreshing

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__.removeprefix("q_")] = fn
    return fn


def r6(c, name=None):
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, 6).alias(name) if name else F.round(c, 6)


# --- rule scores, gate, consensus ------------------------------------------

@query
def q_rule_score_a(spark, sf):
    p = views.diabetes_inputs(views.patient_view(spark, sf)).withColumns({
        "blood_pressure": F.nullif(F.col("blood_pressure"), F.lit(99)),
        "insulin": F.nullif(F.col("insulin"), F.lit(7)),
        "bmi": F.nullif(F.col("bmi"), F.lit(20.0)),
    })
    r = rule_score_a(p, with_status=True)
    return r.select("k", "rule_pred", r6("rule_prob", "rule_prob"), "rule_status")


@query
def q_rule_score_b(spark, sf):
    p = views.heart_view(spark, sf).withColumns({
        "cholesterol": F.nullif(F.col("cholesterol"), F.lit(150)),
        "diastolic_bp": F.nullif(F.col("diastolic_bp"), F.lit(61)),
        "gender": F.nullif(F.col("gender"), F.lit(1)),
    })
    r = rule_score_b(p, with_status=True)
    return r.select("k", "rule_pred", r6("rule_prob", "rule_prob"), "rule_status")


def scored_patients(spark, sf) -> DataFrame:
    """Stand-in model outputs + thresholds + rule fallback + verdict, per event."""
    p = views.diabetes_inputs(views.patient_outputs_view(spark, sf))
    p = p.withColumns({"lr_pred": fcols_threshold("lr_prob"), "rf_pred": fcols_threshold("rf_prob")})
    return scoring.consensus(rule_score_a(p, with_status=True))


@query
def q_consensus(spark, sf):
    c = scored_patients(spark, sf)
    return c.select("k", "lr_prob", "lr_pred", "rf_prob", "rf_pred", "rule_pred", r6("rule_prob", "rule_prob"),
                    "source", "votes", r6("risk_prob", "risk_prob"), "verdict")


@query
def q_fallback_gate(spark, sf):
    c = scoring.fallback_gate(rule_score_a(
        views.diabetes_inputs(views.patient_outputs_view(spark, sf)).withColumns(
            {"lr_pred": fcols_threshold("lr_prob"), "rf_pred": fcols_threshold("rf_prob")}),
        with_status=True))
    return c.select("k", "rule_pred", r6("rule_prob", "rule_prob"), "source")


@query
def q_verdict_counts(spark, sf):
    return scored_patients(spark, sf).groupBy("source", "verdict").agg(F.count(F.lit(1)).alias("n"))


# --- projections, cleaning ------------------------------------------------



@query
def q_select_features(spark, sf):
    cust = clean.drop_ids(views.table(spark, sf, "customer"), ["c_name"])
    feats = clean.feature_cols(cust, "c_mktsegment")
    return clean.select_cols(cust, feats + ["c_mktsegment"])


@query
def q_drop_ids(spark, sf):
    return clean.drop_ids(views.table(spark, sf, "customer"), ["c_name", "c_mktsegment"])


def documents_labelled(spark, sf) -> DataFrame:
    """documents LEFT JOIN labels: unlabelled documents carry nulls."""
    docs = views.table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return docs.join(views.table(spark, sf, "labels"), "doc_id", "left")


@query
def q_drop_null_rows(spark, sf):
    return clean.drop_null_rows(documents_labelled(spark, sf))


@query
def q_nonzero_mean(spark, sf):
    li = profile.nonzero_mean(views.table(spark, sf, "lineitem"), ["l_discount", "l_tax"])
    pv = profile.nonzero_mean(views.patient_view(spark, sf), ["glu", "bp"])
    both = li.withColumn("source", F.lit("lineitem")).unionByName(pv.withColumn("source", F.lit("patients")))
    return both.select("source", "column_name", r6("nonzero_mean", "nonzero_mean"), "n_nonzero")


@query
def q_zero_impute(spark, sf):
    li = views.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_tax")
    out = clean.zero_impute(li, ["l_discount", "l_tax"])
    return out.select("l_orderkey", "l_linenumber", r6("l_discount", "l_discount"), r6("l_tax", "l_tax"))


@query
def q_zero_impute_patients(spark, sf):
    out = clean.zero_impute(views.patient_view(spark, sf).select("k", "glu", "bp", "skin"), ["glu", "bp", "skin"])
    return out.select("k", *[r6(c, c) for c in ("glu", "bp", "skin")])


@query
def q_binary_encode(spark, sf):
    o = views.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return clean.binary_encode(o, "o_orderstatus", "F", out="status_flag").select("o_orderkey", "status_flag")


# Form bounds narrowed for the derived heart view so the check rejects rows.
NARROWED_HEART_BOUNDS = {**schemas.HEART_BOUNDS, "cholesterol": (120, 280), "systolic_bp": (100, 180)}
ACCTBAL_BOUNDS = {"c_acctbal": (0, 9000)}


@query
def q_range_check(spark, sf):
    checked = clean.range_check(views.heart_view(spark, sf), NARROWED_HEART_BOUNDS)
    return checked.select("k", F.array_join("violations", ",").alias("violations"), "valid")


def _reject_counts(checked: DataFrame, source: str) -> DataFrame:
    """Rows per violated column plus ``__valid__`` / ``__rejected__`` totals,
    in one pass: the row's marker rides along in the exploded array."""
    marker = F.when(F.col("valid"), F.lit("__valid__")).otherwise(F.lit("__rejected__"))
    items = F.explode(F.concat(F.col("violations"), F.array(marker))).alias("item")
    return (checked.select(items).groupBy("item").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("source", F.lit(source)))


@query
def q_range_reject_counts(spark, sf):
    heart = clean.range_check(views.heart_view(spark, sf), NARROWED_HEART_BOUNDS)
    cust = clean.range_check(views.table(spark, sf, "customer"), ACCTBAL_BOUNDS)
    return _reject_counts(heart, "heart").unionByName(_reject_counts(cust, "customer")).select("source", "item", "n")


@query
def q_fill_absent(spark, sf):
    h = views.heart_view(spark, sf).drop("stress", "family_history")
    filled = clean.fill_absent(h)
    r = rule_score_b(filled)
    return r.select("k", "stress", "family_history", "rule_pred", r6("rule_prob", "rule_prob"))


@query
def q_decode_flags(spark, sf):
    h = views.heart_view(spark, sf)
    flags = [decode_flag(c).alias(c) for c in schemas.HEART_YES_NO_FLAGS]
    return h.select("k", decode_flag("gender", "Male", "Female").alias("gender"), *flags)


# --- vectors, assembly, scaling ---------------------------------------------

@query
def q_vector_roundtrip(spark, sf):
    e = views.table(spark, sf, "embeddings").select("vec_id", "embedding")
    back = features.to_array(features.to_vector(e, "embedding", "v"), "v", "a")
    return back.select(
        "vec_id", F.size("a").alias("n"),
        r6(F.aggregate("a", F.lit(0.0), lambda acc, x: acc + x), "total"),
        r6(F.col("a")[0], "first"))


PATIENT_FEATURES = ["preg", "glu", "bp", "skin", "ins", "bmi", "dpf", "age"]


@query
def q_assemble(spark, sf):
    pv = views.patient_view(spark, sf)
    vec = features.assemble(pv, PATIENT_FEATURES, "features")
    return features.vector_columns(vec, "features", PATIENT_FEATURES, keep=["k"])


@query
def q_standardize(spark, sf):
    pv = views.patient_view(spark, sf).withColumn("const", F.lit(1))
    cols = PATIENT_FEATURES + ["const"]
    scaled, _ = features.standardize(pv, cols, "z")
    out = features.vector_columns(scaled.select("k", "z"), "z", cols, keep=["k"])
    return out.select("k", *[r6(c, c) for c in cols])


@query
def q_scaler_stats(spark, sf):
    part = views.table(spark, sf, "part").withColumn("const", F.lit(7))
    st = profile.scaler_stats(part, ["p_size", "p_retailprice", "const"])
    return st.select("column_name", r6("mean", "mean"), r6("std", "std"))


@query
def q_scaler_model_stats(spark, sf):
    """O-27 as the fitted ``StandardScaler`` holds it (Spark ML's summarizer):
    one row per feature; a handful of numbers come back from the fit."""
    pv = views.patient_view(spark, sf)
    _, model = features.standardize(pv, PATIENT_FEATURES, "z")
    rows = [(c, float(m), float(sd)) for c, m, sd in features.scaler_model_stats(model, PATIENT_FEATURES)]
    st = spark.createDataFrame(rows, "column_name string, mean double, std double")
    return st.select("column_name", r6("mean", "mean"), r6("std", "std"))


@query
def q_features_zero_imputed(spark, sf):
    pv = views.diabetes_inputs(views.patient_view(spark, sf))
    model = feature_plans.zero_impute_plan().fit(pv)
    out = features.vector_columns(model.transform(pv).select("k", "features"), "features",
                                  schemas.DIABETES_FEATURES, keep=["k"])
    return out.select("k", *[r6(c, c) for c in schemas.DIABETES_FEATURES])


@query
def q_features_null_dropped(spark, sf):
    raw = documents_labelled(spark, sf)
    prepared = feature_plans.null_drop_prepare(raw, "toxic", ids=["source"], key="doc_id")
    feats = feature_plans.dynamic_features(prepared, "toxic", key="doc_id")
    model = feature_plans.null_drop_plan(feats, encoded=("lang", "en")).fit(prepared)
    out = features.vector_columns(model.transform(prepared).select("doc_id", "toxic", "features"),
                                  "features", feats, keep=["doc_id", "toxic"])
    return out.select("doc_id", "toxic", *[r6(c, c) for c in feats])


# --- statistics ----------------------------------------------------------------

@query
def q_dataset_profile(spark, sf):
    pv = views.patient_view(spark, sf)
    p = profile.dataset_profile(pv, PATIENT_FEATURES + ["outcome"])
    return p.select("column_name", "n", "n_null", "n_zero", "min_value", "max_value", r6("mean_value", "mean_value"))


@query
def q_sample_head(spark, sf):
    return profile.sample_head(views.patient_view(spark, sf), "k", 5)


@query
def q_row_count(spark, sf):
    return profile.row_count(views.table(spark, sf, "lineitem"))


# --- splits and folds ---------------------------------------------------------



@query
def q_hash_split(spark, sf):
    o = views.table(spark, sf, "orders").select("o_orderkey")
    return split.with_split(o, "o_orderkey").select("o_orderkey", "split")


@query
def q_split_counts(spark, sf):
    o = split.with_split(views.table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")
    return o.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query
def q_fold_assign(spark, sf):
    o = views.table(spark, sf, "orders").select("o_orderkey")
    train, _ = split.hash_split(o, "o_orderkey")
    return split.assign_folds(train, "o_orderkey").select("o_orderkey", "fold")


# --- evaluation -----------------------------------------------------------------

def rule_scores_long(spark, sf) -> DataFrame:
    """(task, k, score, pred, label) for both rule scores over the derived views."""
    a = rule_score_a(views.diabetes_inputs(views.patient_view(spark, sf)))
    b = rule_score_b(views.heart_view(spark, sf))
    cols = ["k", F.col("rule_prob").alias("score"), F.col("rule_pred").alias("pred"), F.col("outcome").alias("label")]
    return (a.select(F.lit("diabetes").alias("task"), *cols)
            .unionByName(b.select(F.lit("heart").alias("task"), *cols)))


@query
def q_auc_exact(spark, sf):
    r = evaluate.auc_exact(rule_scores_long(spark, sf), "score", "label", by=["task"])
    return r.select("task", r6("auc", "auc"), "n", "n_pos")


@query
def q_accuracy(spark, sf):
    r = evaluate.accuracy(rule_scores_long(spark, sf), "pred", "label", by=["task"])
    return r.select("task", r6("accuracy", "accuracy"), "n")


def candidate_scores(spark, sf) -> DataFrame:
    """(task, model, score, label): stand-in model outputs and rule scores
    over the derived views, in long form; the ``tie_check`` task scores
    both models with the same column, so its AUCs tie exactly."""
    p = rule_score_a(views.diabetes_inputs(views.patient_outputs_view(spark, sf)))
    h = rule_score_b(views.heart_view(spark, sf))

    def cand(df, triples):  # one pass per table: every candidate of a row from one explode
        return df.select(F.col("outcome").alias("label"), F.explode(F.array(*[
            F.struct(F.lit(t).alias("task"), F.lit(m).alias("model"), F.col(c).cast("double").alias("score"))
            for t, m, c in triples])).alias("m"))

    long = (cand(p, [("diabetes", "logistic_regression", "lr_prob"), ("diabetes", "random_forest", "rf_prob"),
                     ("tie_check", "logistic_regression", "rule_prob"), ("tie_check", "random_forest", "rule_prob")])
            .unionByName(cand(h, [("heart", "logistic_regression", "rule_prob"),
                                  ("heart", "random_forest", "rule_pred")])))
    return long.select("m.task", "m.model", "m.score", "label")


def model_metrics(spark, sf) -> DataFrame:
    m = evaluate.auc_exact(candidate_scores(spark, sf), "score", "label", by=["task", "model"])
    return evaluate.pick_best(m.select("task", "model", r6("auc", "auc")))


@query
def q_best_model(spark, sf):
    return model_metrics(spark, sf).select("task", "model", "auc", "is_best")


@query
def q_registry_status(spark, sf):
    metrics = model_metrics(spark, sf).withColumn(
        "path", F.concat(F.lit("models/"), F.col("task"), F.lit("_"), F.col("model")))
    path = scratch_path(spark, "registry")
    registry.write_registry(metrics, path)
    return registry.registry_status(registry.expected_frame(spark), registry.read_registry(spark, path))


# --- per-row scalar functions ---------------------------------------------------

LINEAR_COEF = {"intercept": -4.0, "glu": 0.02, "bmi": 0.05, "age": 0.015, "dpf": 0.8}


@query
def q_linear_score(spark, sf):
    pv = views.patient_view(spark, sf)
    z = F.lit(LINEAR_COEF["intercept"])
    for c in ("glu", "bmi", "age", "dpf"):
        z = z + F.lit(LINEAR_COEF[c]) * F.col(c)
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
    vec = pv.select("k", array_to_vector(F.array(F.lit(1.0) - p, p)).alias("probability"))
    return vec.select("k", r6(fcols.positive_prob("probability"), "p"))


@query
def q_threshold(spark, sf):
    m = views.model_output_view(spark, sf)
    return m.select("k", fcols.threshold("lr_prob").alias("lr_pred"), fcols.threshold("rf_prob").alias("rf_pred"))


@query
def q_clamp(spark, sf):
    m = views.model_output_view(spark, sf)
    return m.select("k", r6(fcols.clamp("lr_prob"), "lr_clamped"), r6(fcols.clamp("rf_prob"), "rf_clamped"))


@query
def q_model_comparison(spark, sf):
    c = scoring.comparison(scored_patients(spark, sf), "k")
    return c.select("k", "model", "prediction", "risk_level", "probability", "probability_text")


def heart_rule_path(spark, sf) -> DataFrame:
    """Heart rows with no model answering: rule score, gate and verdict."""
    h = views.heart_view(spark, sf).withColumns({
        "lr_prob": F.lit(None).cast("double"), "rf_prob": F.lit(None).cast("double"),
        "lr_pred": F.lit(None).cast("int"), "rf_pred": F.lit(None).cast("int")})
    return scoring.consensus(rule_score_b(h, with_status=True))


@query
def q_verdict_text(spark, sf):
    """O-54/O-56 texts: heading and message with the percentage."""
    c = scored_patients(spark, sf)
    return c.select("k", "verdict", scoring.headline("diabetes").alias("headline"),
                    scoring.message("diabetes").alias("message"))


@query
def q_recommendation(spark, sf):
    d = scored_patients(spark, sf)
    d = d.select(F.lit("diabetes").alias("task"), "k", "verdict", scoring.recommend(d, "diabetes").alias("recommendation"),
                 scoring.headline("diabetes").alias("headline"))
    h = heart_rule_path(spark, sf)
    h = h.select(F.lit("heart").alias("task"), "k", "verdict", scoring.recommend(h, "heart").alias("recommendation"),
                 scoring.headline("heart").alias("headline"))
    return d.unionByName(h)


# --- sources and sinks ------------------------------------------------------------

@query
def q_csv_roundtrip(spark, sf):
    part = views.table(spark, sf, "part")
    path = scratch_path(spark, "part-csv")
    files.write_csv(part, path)
    return files.read_csv(spark, path, part.schema)


@query
def q_csv_by_name(spark, sf):
    """The same table from files whose columns stand in another order."""
    part = views.table(spark, sf, "part")
    path = scratch_path(spark, "part-csv")
    files.write_csv(part.select(*reversed(part.columns)), path)
    return files.read_csv(spark, path, part.schema)


@query
def q_csv_quarantine(spark, sf):
    """Rows of a CSV by whether they fit: each bad row once, quoted line ends
    and quotes inside read as they were written."""
    part = views.table(spark, sf, "part")
    key = F.col("p_partkey")
    name = F.when(key % 7 == 0, F.concat(F.lit("two\nlines, \""), "p_name", F.lit("\""))).otherwise(F.col("p_name"))
    size = F.when(key % 17 == 0, F.lit("n/a")).otherwise(F.col("p_size").cast("string"))
    path = scratch_path(spark, "part-odd-csv")
    files.write_csv(part.select(size.alias("p_size"), name.alias("p_name"), "p_partkey"), path)
    good, bad = files.read_checked_csv(spark, path, T.StructType([part.schema["p_partkey"], part.schema["p_name"], part.schema["p_size"]]),
                                       scratch_path(spark, "part-bad"), multi_line=True)
    kept = good.select("p_partkey", F.lit(True).alias("fits"), "p_size", F.sha2("p_name", 256).alias("name_sha256"))
    apart = bad.select("read_as.p_partkey", F.lit(False).alias("fits"), F.lit(None).cast("int").alias("p_size"), F.sha2("read_as.p_name", 256).alias("name_sha256"))
    return kept.unionByName(apart)


@query
def q_heart_csv_roundtrip(spark, sf):
    """The heart reader: names from the header, in the file's spelling and order, types from ours."""
    h = views.heart_training_view(spark, sf).withColumns({"gender": F.when(F.col("gender") == 1, "Male").otherwise("Female"), "state_name": F.lit("Kerala")})
    spelled = h.select(*[F.col(c).alias("_".join(w.capitalize() for w in ("patient_id" if c == "k" else c).split("_"))) for c in reversed(h.columns)])
    path = scratch_path(spark, "heart-csv")
    files.write_csv(spelled, path)
    back = files.read_heart_csv(spark, path)
    return back.select(F.col("patient_id").cast("long").alias("k"), "state_name", *schemas.HEART_FEATURES, schemas.HEART_LABEL)


@query
def q_processed_roundtrip(spark, sf):
    part = views.table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    vec = features.assemble(part, ["p_size", "p_retailprice"], "features").select("p_partkey", "features")
    path = scratch_path(spark, "part-processed")
    files.write_processed(vec, path)
    back = files.read_processed(spark, path)
    return features.vector_columns(back, "features", ["p_size", "p_retailprice"], keep=["p_partkey"])


# --- training, tuning, persistence, scoring -----------------------------------


def patient_inputs(spark, sf) -> DataFrame:
    """Diabetes inputs with canonical names, key ``k`` and the planted label ``outcome``."""
    return views.diabetes_training_view(spark, sf)


def _task_frame(spark, sf, task: str) -> DataFrame:
    return patient_inputs(spark, sf) if task == "diabetes" else views.heart_training_view(spark, sf)


def trained(spark, sf, task: str = "diabetes") -> str:
    """Folder with the task's tuned models, CV report, importances and registry.

    The training job writes it once per application and state of the input
    below the shared checkpoint folder and publishes it when it is whole.
    Changed input files have another identity, so the job runs again.
    Queries read what they need from it.
    """
    models_dir = _models_dir(spark, sf, task)
    if versions.current(spark, models_dir, task)[1] is None:
        jobs.train(spark, _task_frame(spark, sf, task), task, models_dir, "k")
    return versions.current(spark, models_dir, task)[1]


def _models_dir(spark, sf, task: str) -> str:
    df = views.table(spark, sf, "events" if task == "diabetes" else "orders")
    name = hashlib.md5(f"{app_id(spark)}|{files.identity(df)}".encode()).hexdigest()[:12]
    return f"{checkpoint_root(spark)}/riskloom/trained-{name}"


def _load(spark, base: str, task: str) -> dict:
    return jobs.load_models(spark, base)


def _single_fit(spark, sf, model: str):
    df = patient_inputs(spark, sf)
    fit = training.fit_task(spark, df, "k", schemas.DIABETES_LABEL, "diabetes", models=(model,), tune_models=False)
    return fit, fit.n_train


@query
def q_train_lr(spark, sf):
    """Terms of one logistic fit on the training split.  Values are fitted,
    so the checked columns are what must hold for any right fit: finite
    terms, and positive weights for the two features the label follows."""
    fit, n = _single_fit(spark, sf, "lr")
    lr = fit.classifiers["lr"]
    rows = [("intercept", float(lr.intercept))] + list(zip(fit.feature_names, map(float, lr.coefficients.toArray())))
    df = spark.createDataFrame(rows, "term string, coefficient double")
    ok = ~F.isnan("coefficient") & (F.abs("coefficient") < 1e6)
    followed = F.when(F.col("term").isin("glucose", "age"), F.col("coefficient") > 0.1).otherwise(F.lit(True))
    return df.select("term", ok.alias("finite"), followed.alias("sign_ok"), F.lit(n).cast("long").alias("n_train"))


@query
def q_train_rf(spark, sf):
    """Trees of one forest fit: their number, depth bound and that each splits."""
    fit, n = _single_fit(spark, sf, "rf")
    rows = [(i, t.depth <= 5, t.numNodes >= 3) for i, t in enumerate(fit.classifiers["rf"].trees)]
    return spark.createDataFrame(rows, "tree int, depth_ok boolean, splits boolean").withColumn("n_train", F.lit(n).cast("long"))


#: Mean AUC that every cross-validated grid point and held-out AUC that every model must reach on the planted label.
LEAST_CV_AUC, LEAST_TEST_AUC = 0.5, 0.85


def _report(spark, sf, model: str | None = None) -> DataFrame:
    """Grid points of the tuning; the best is the one with the highest mean AUC and is above the test bound."""
    r = spark.read.parquet(f"{trained(spark, sf)}/cv_report")
    r = r if model is None else r.where(F.col("model") == model)
    top = F.max("mean_auc").over(Window.partitionBy("model"))  # at most nine grid points a model
    best_ok = F.when(F.col("is_best"), (F.col("mean_auc") == top) & (top >= LEAST_TEST_AUC)).otherwise(F.lit(True))
    n_best = F.sum(F.col("is_best").cast("int")).over(Window.partitionBy("model"))
    return r.select("model", "grid_index", "params", F.col("mean_auc").between(LEAST_CV_AUC, 1.0).alias("auc_ok"),
                    (best_ok & (n_best == 1)).alias("best_ok"), (F.col("fit_seconds") > 0).alias("timed"))


@query
def q_tune_lr(spark, sf):
    return _report(spark, sf, "logistic_regression")


@query
def q_tune_rf(spark, sf):
    return _report(spark, sf, "random_forest")


@query
def q_cv_metrics(spark, sf):
    return _report(spark, sf)


@query
def q_feature_importance(spark, sf):
    """Importances of the tuned forest: non-negative, adding to 1, and the two features the label follows on top."""
    imp = spark.read.parquet(f"{trained(spark, sf)}/importances")
    every = Window.partitionBy(F.lit(1))  # eight features
    place = F.rank().over(Window.partitionBy(F.lit(1)).orderBy(F.col("importance").desc()))
    return imp.select("feature", (F.col("importance") >= 0).alias("non_negative"),
                      (F.abs(F.sum("importance").over(every) - 1) < 1e-9).alias("adds_to_one"), (place <= 2).alias("top_two"))


def _score_cols():
    return ["k", "lr_prob", "lr_pred", "lr_status", "rf_prob", "rf_pred", "rf_status", "rule_pred", "rule_prob",
            "source", "votes", "risk_prob", "verdict", "recommendation"]


def _sigmoid_of(model, df: DataFrame) -> Column:
    """The logistic model's probability worked out from its stored numbers and the raw inputs."""
    lr, scaler = model.stages[-1], next(s for s in model.stages if isinstance(s, StandardScalerModel))
    inputs = next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()
    imputed = next((s for s in model.stages if isinstance(s, SQLTransformer)), None)
    z = F.lit(float(lr.intercept))
    for c, w, m, d in zip(inputs, lr.coefficients.toArray(), scaler.mean.toArray(), scaler.std.toArray()):
        raw = c.removesuffix(schemas.IMPUTED_SUFFIX)
        x = F.col(raw).cast("double")
        if raw != c:
            mean = next(float(v) for v in re.findall(rf"WHEN `?{raw}`? = 0 THEN CAST\('([^']+)'", imputed.getStatement()))
            x = F.when(F.col(raw) == 0, F.lit(mean)).otherwise(x)
        z = z + F.lit(float(w)) * ((x - F.lit(float(m))) / F.lit(float(d)) if d else F.lit(0.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def _consistent(scored: DataFrame, lr_prob=None) -> DataFrame:
    """k and whether each output follows from the row's own probabilities."""
    lp, rp = F.col("lr_prob"), F.col("rf_prob")
    mean = (lp + rp) / 2
    votes = (lp >= 0.3).cast("int") + (rp >= 0.3).cast("int")
    high = (votes > 0) | (mean >= 0.3)
    flags = {
        "in_range": lp.between(0, 1) & rp.between(0, 1),
        "pred_ok": (F.col("lr_pred") == (lp >= 0.3).cast("int")) & (F.col("rf_pred") == (rp >= 0.3).cast("int")),
        "votes_ok": F.col("votes") == votes,
        "mean_ok": F.abs(F.col("risk_prob") - mean) < 1e-12,
        "verdict_ok": (F.col("verdict") == "High") == high,
        "no_rule": F.col("rule_pred").isNull() & F.col("rule_prob").isNull(),
    }
    if lr_prob is not None:
        flags["sigmoid_ok"] = F.abs(lp - lr_prob) < 1e-9
    return scored.select("k", "source", "lr_status", "rf_status", *[F.coalesce(f, F.lit(False)).alias(n) for n, f in flags.items()])


@query
def q_batch_score(spark, sf):
    models = _load(spark, trained(spark, sf), "diabetes")
    df = patient_inputs(spark, sf)
    return _consistent(scoring.score_all(df, "diabetes", models, "k"), _sigmoid_of(models["lr"][0], df))


@query
def q_heart_batch_score(spark, sf):
    models = _load(spark, trained(spark, sf, "heart"), "heart")
    df = views.heart_view(spark, sf).drop("outcome")
    return _consistent(scoring.score_all(df, "heart", models, "k"), _sigmoid_of(models["lr"][0], df))


@query
def q_partial_models(spark, sf):
    """LR's folder is damaged, RF is whole; some inputs are null.  RF answers
    where its inputs are all there, rules take the other rows."""
    base = trained(spark, sf)
    damaged = scratch_path(spark, "damaged-model")
    spark.createDataFrame([("not a model",)], "value string").coalesce(1).write.text(f"{damaged}/metadata")
    models = {"lr": model_io.load_with_status(spark, damaged),
              "rf": model_io.load_with_status(spark, f"{base}/{jobs.MODEL_DIRS['rf']}")}
    df = patient_inputs(spark, sf).withColumn("glucose", F.nullif(F.col("glucose"), F.lit(100)))
    s = scoring.score_all(df, "diabetes", models, "k")
    return s.select("k", "source", "lr_status", "rf_status", F.col("lr_prob").isNotNull().alias("lr_answered"),
                    F.col("rf_prob").isNotNull().alias("rf_answered"), "rule_pred", r6("rule_prob", "rule_prob"))


@query
def q_own_inputs(spark, sf):
    """A heart model trained with one more input than the form has: where
    that input is null at serving, the model does not answer."""
    df = _task_frame(spark, sf, "heart").withColumn("extra", F.col("k") % 13)
    fit = training.fit_task(spark, feature_plans.null_drop_prepare(df, schemas.HEART_LABEL, [], "k"), "k",
                            schemas.HEART_LABEL, "heart", models=("lr", "rf"), tune_models=False)
    served = views.heart_view(spark, sf).drop("outcome").withColumn("extra", F.nullif(F.col("k") % 13, F.lit(5)))
    s = scoring.score_all(served, "heart", fit.models, "k")
    return s.select("k", F.col("lr_prob").isNotNull().alias("lr_answered"), F.col("rf_prob").isNotNull().alias("rf_answered"), "source")


@query
def q_model_roundtrip(spark, sf):
    fit, _ = _single_fit(spark, sf, "lr")
    df, live = patient_inputs(spark, sf), fit.models["lr"]
    loaded = model_io.load_model(model_io.save_model(live, scratch_path(spark, "roundtrip-lr")))
    both = scoring.score(df, {"live": live, "loaded": loaded})
    return both.select("k", (F.abs(F.col("live_prob") - F.col("loaded_prob")) <= 1e-12).alias("same"))


@query
def q_stream_score(spark, sf):
    """A stateless stream over the table's files scores their rows with the
    saved pipelines into a parquet sink (trigger availableNow).  The path
    is a glob: a stream takes a plain path for a folder."""
    models = _load(spark, trained(spark, sf), "diabetes")
    raw = read_stream(spark, f"{sf}/{{events.parquet}}", views.table(spark, sf, "events").schema)
    out, ckpt = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    score_stream(views.diabetes_inputs(views.patients(raw)), "diabetes", models, "k", out, ckpt).awaitTermination()
    return _consistent(spark.read.parquet(out))


@query
def q_stream_refresh(spark, sf):
    """A stream over two halves of the table, with a retraining between them:
    each half is scored by the version that was current then."""
    events = views.table(spark, sf, "events")
    folder, out, ckpt, models = (scratch_path(spark, f"refresh-{n}") for n in ("in", "out", "ckpt", "models"))
    df = patient_inputs(spark, sf)
    for half in (0, 1):
        fit = training.fit_task(spark, df, "k", schemas.DIABETES_LABEL, "diabetes", models=("lr",), tune_models=False, fit_scope=("train", "all")[half])
        new = versions.new_folder(models, "diabetes")
        model_io.save_model(fit.models["lr"], f"{new}/{jobs.MODEL_DIRS['lr']}")
        versions.publish(spark, models, "diabetes", new)
        events.where(F.col("event_id") % 2 == half).write.mode("append").parquet(folder)
        rows = views.diabetes_inputs(views.patients(read_stream(spark, folder, events.schema)))
        score_stream_refreshing(rows, "diabetes", models, "k", out, ckpt).awaitTermination()
    back = spark.read.parquet(out)
    return back.select("k", "model_version", "lr_status", "rf_status", "source", F.col("lr_prob").isNotNull().alias("lr_answered"))


@query
def q_wrong_type(spark, sf):
    """Glucose arrives as text: both models' status is failed before the job
    runs, and the rules answer with what reads as a number."""
    text = F.when(F.col("k") % 11 == 0, F.lit("unknown")).otherwise(F.col("glucose").cast("string"))
    base = trained(spark, sf)
    s = scoring.score_all(patient_inputs(spark, sf).withColumn("glucose", text), "diabetes", _load(spark, base, "diabetes"), "k")
    return s.select("k", "glucose", "lr_status", "rf_status", "source", "rule_pred", r6("rule_prob", "rule_prob"))


@query
def q_model_registry(spark, sf):
    """Registry of both tasks' training jobs: row counts of the split (heart
    rows with nulls are dropped before it), AUC bounds, one winner."""
    out = None
    for task in ("diabetes", "heart"):
        r = registry.read_registry(spark, f"{trained(spark, sf, task)}/registry")
        out = r if out is None else out.unionByName(r)
    w = Window.partitionBy("task")  # two models a task
    best = F.max("auc").over(w)
    won = F.when(F.col("is_best"), F.col("auc") == best).otherwise(F.lit(True))
    return out.select("task", "model", "n_train", "n_test", "partitions", (F.col("auc") >= LEAST_TEST_AUC).alias("auc_ok"),
                      (F.abs(F.col("auc") - F.col("auc_binned")) < 0.01).alias("binned_near"),
                      (F.col("accuracy") >= 0.75).alias("accuracy_ok"),
                      (won & (F.sum(F.col("is_best").cast("int")).over(w) == 1)).alias("winner_ok"))


@query
def q_artefact_status(spark, sf):
    """Models and registry of the diabetes training job on the store, and that none of another task is there."""
    trained(spark, sf)
    return registry.artefact_status(spark, _models_dir(spark, sf, "diabetes")).select("task", "artefact", "present")


def flagship(spark, sf) -> DataFrame:
    """The whole serving path on real models: LR and RF fitted (single fits)
    on the keyed training split, then every row scored by both pipelines,
    with rule fallback, consensus verdict and texts."""
    df = patient_inputs(spark, sf)
    fit = training.fit_task(spark, df, "k", "outcome", "diabetes", tune_models=False)
    return scoring.score_all(df, "diabetes", fit.models, "k").select(*_score_cols(), "headline")
