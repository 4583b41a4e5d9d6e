"""Gate and verdict over model-result rows (fixture F5)."""

import pytest
from riskloom.functions.columns import clamp, mean_prob, percent_text, threshold, vote_count
from riskloom.operators import scoring

F5 = [
    # k, lr, rf, rule_pred, rule_prob, rule_status, votes, mean, source, verdict
    (1, 0.10, 0.20, 0, 0.9, "scored", 0, 0.15, "models", "Low"),
    (2, 0.30, 0.05, 0, 0.9, "scored", 1, 0.175, "models", "High"),
    (3, None, 0.29, 0, 0.9, "scored", 0, 0.29, "models", "Low"),
    (4, 0.60, None, 0, 0.9, "scored", 1, 0.60, "models", "High"),
    (5, None, None, 0, 0.20, "default_input", None, 0.20, "rules", "Low"),
    (6, None, None, 0, 0.45, "scored", None, 0.45, "rules", "High"),
    (7, None, None, 0, 0.50, "failed", None, 0.50, "last_resort", "High"),
]


def test_f5_rows(spark):
    df = spark.createDataFrame([r[:6] for r in F5],
                               "k int, lr_prob double, rf_prob double, rule_pred int, rule_prob double, rule_status string")
    df = df.withColumns({"lr_pred": threshold("lr_prob"), "rf_pred": threshold("rf_prob")})
    got = {r.k: r for r in scoring.consensus(df).collect()}
    for k, *_, votes, mean, source, verdict in F5:
        r = got[k]
        assert (r.votes, r.source, r.verdict) == (votes, source, verdict), k
        assert r.risk_prob == pytest.approx(mean, abs=1e-12)
        if source == "models":
            assert r.rule_pred is None and r.rule_prob is None


def test_scalar_helpers(spark):
    nan = float("nan")
    df = spark.createDataFrame([(0.3, None, 0.0625), (0.2999, 0.4, 1.2), (nan, 0.8, None)],
                               "a double, b double, c double")
    r = df.select(threshold("a").alias("t"), vote_count(threshold("a"), threshold("b")).alias("v"),
                  mean_prob("a", "b").alias("m"), clamp("c").alias("c"), percent_text("b").alias("p")).collect()
    assert [x.t for x in r] == [1, 0, 0]          # NaN >= 0.3 is False, as in Python
    assert [x.v for x in r] == [1, 1, 1]
    assert r[0].m == 0.3 and r[1].m == pytest.approx(0.34995)
    assert [x.c for x in r] == [0.0625, 0.95, None]  # null stays null
    assert r[1].p == "40.0%"
    assert spark.createDataFrame([(None, None)], "a double, b double").select(mean_prob("a", "b")).first()[0] == 0.5


def test_comparison_only_answering_models(spark):
    df = spark.createDataFrame([(1, 0.6, 1, None, None), (2, None, None, None, None)],
                               "k int, lr_prob double, lr_pred int, rf_prob double, rf_pred int")
    rows = scoring.comparison(df, "k").collect()
    assert [(r.k, r.model, r.prediction, r.risk_level) for r in rows] == [(1, "Logistic Regression", "Positive", "High Risk")]


def test_recommendation_and_headline(spark):
    df = spark.createDataFrame([("High", "models"), ("Low", "rules")], "verdict string, source string")
    out = df.select(scoring.recommend(df, "heart").alias("r"), scoring.headline("heart").alias("h")).collect()
    assert out[0].r == scoring.RECOMMENDATIONS[("heart", "High")]
    assert out[1].h == "Low Risk of Heart Attack (Fallback Prediction)"


def test_percent_text_rounds_like_python(spark):
    vals = [0.0625, 0.0635, 0.0005, 0.0015, 0.00125, 0.999, 1.0, 0.33335, 12.3456]
    df = spark.createDataFrame([(v,) for v in vals], "p double")
    assert [r[0] for r in df.select(percent_text("p")).collect()] == [f"{v:.1%}" for v in vals]
