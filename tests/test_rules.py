"""Golden rows and band edges of the two rule scores, with the null and NaN
rules of the reference's Python semantics."""

import math

import pytest
from pyspark.sql import types as T

from riskloom.functions.rules import fill_absent, rule_score_a, rule_score_b

DIAB = T.StructType([
    T.StructField("k", T.IntegerType()),
    T.StructField("pregnancies", T.IntegerType()), T.StructField("glucose", T.DoubleType()),
    T.StructField("blood_pressure", T.IntegerType()), T.StructField("skin_thickness", T.IntegerType()),
    T.StructField("insulin", T.IntegerType()), T.StructField("bmi", T.DoubleType()),
    T.StructField("dpf", T.DoubleType()), T.StructField("age", T.IntegerType()),
])


def score_a(spark, rows):
    df = spark.createDataFrame(rows, DIAB)
    out = rule_score_a(df, with_status=True).orderBy("k").collect()
    return [(r.rule_pred, r.rule_prob, r.rule_status) for r in out]


def test_diabetes_golden_rows(spark):
    # Sample rows of the diabetes file (label dropped).
    rows = [
        (1, 6, 148.0, 72, 35, 0, 33.6, 0.627, 50),
        (2, 1, 85.0, 66, 29, 0, 26.6, 0.351, 31),
        (3, 0, 137.0, 40, 35, 168, 43.1, 2.288, 33),
        (4, 5, 116.0, 74, 0, 0, 25.6, 0.201, 30),
    ]
    got = score_a(spark, rows)
    assert got[0][:2] == (1, 0.95)            # 1.17 clamped
    assert got[1][0] == 0 and got[1][1] == pytest.approx(0.2, abs=1e-12)
    assert got[2][0] == 1 and got[2][1] == pytest.approx(0.9, abs=1e-12)
    assert got[3][0] == 0 and got[3][1] == pytest.approx(0.45, abs=1e-12)
    assert all(s == "scored" for *_, s in got)


def test_diabetes_band_edges(spark):
    # glucose 90, bmi 25, age 35, dpf 0.5, bp 140, insulin 15: every edge
    # falls into the band above the comparison.
    got = score_a(spark, [(1, 0, 90.0, 140, 20, 15, 25.0, 0.5, 35)])
    assert got[0][0] == 0
    assert got[0][1] == ((((((0.1 + 0.05) + 0.1) + 0.0) + 0.0) + 0.0) + 0.0)


def test_diabetes_default_form_and_failures(spark):
    rows = [
        (1, 0, 120.0, 70, 20, 80, 25.0, 0.5, 30),      # untouched form
        (2, 1, None, 66, 29, 0, 26.6, 0.351, 31),       # null glucose -> failure
        (3, None, 85.0, 66, None, 0, 26.6, 0.351, 31),  # nulls only in unused inputs
        (4, 1, 85.0, 66, 29, None, 26.6, 0.351, 31),    # null insulin -> failure
    ]
    got = score_a(spark, rows)
    assert got[0] == (0, 0.2, "default_input")
    assert got[1] == (0, 0.5, "failed")
    assert got[2][2] == "scored" and got[2][1] == pytest.approx(0.2, abs=1e-12)
    assert got[3] == (0, 0.5, "failed")


def test_diabetes_nan_follows_python(spark):
    nan = float("nan")
    rows = [
        (1, 1, 100.0, 70, 20, 50, 22.0, nan, 40),   # NaN dpf: both '>' bands false
        (2, 1, 100.0, 70, 20, 50, 22.0, 0.3, 40),
        (3, 1, nan, 70, 20, 5, 22.0, 0.3, 40),      # NaN glucose: else band, no insulin term
    ]
    got = score_a(spark, rows)
    assert got[0] == got[1]
    assert got[2][1] == pytest.approx(0.85, abs=1e-12) and got[2][0] == 1


def test_diabetes_short_input(spark):
    df = spark.createDataFrame([(1, 120.0)], "k int, glucose double")
    r = rule_score_a(df, with_status=True).first()
    assert (r.rule_pred, r.rule_prob, r.rule_status) == (0, 0.2, "short_input")


HEART = ("k int, age int, gender int, diabetes int, hypertension int, obesity int, smoking int, "
         "alcohol int, physical_activity int, diet_score int, cholesterol int, triglycerides int, ldl int, "
         "hdl int, systolic_bp int, diastolic_bp int, pollution int, family_history int, stress int, "
         "healthcare int")


def heart_row(k, **kw):
    base = dict(age=50, gender=0, diabetes=0, hypertension=0, obesity=0, smoking=0, alcohol=0,
                physical_activity=0, diet_score=5, cholesterol=180, triglycerides=150, ldl=100, hdl=50,
                systolic_bp=120, diastolic_bp=80, pollution=0, family_history=0, stress=5, healthcare=0)
    base.update(kw)
    return (k, *base.values())


def score_b(spark, rows):
    out = rule_score_b(spark.createDataFrame(rows, HEART), with_status=True).orderBy("k").collect()
    return [(r.rule_pred, r.rule_prob, r.rule_status) for r in out]


def test_heart_border_below_half(spark):
    # The exact sum is 0.5, the double sum is just below: class 0.
    row = heart_row(1, age=30, gender=1, hypertension=1, obesity=1, cholesterol=220, hdl=70, ldl=100,
                    systolic_bp=120, diastolic_bp=70, stress=5)
    (pred, prob, status), = score_b(spark, [row])
    assert prob == 0.49999999999999994 and pred == 0 and status == "scored"


def test_heart_defaults_failures_and_flags(spark):
    rows = [
        heart_row(1, age=40, cholesterol=None),            # default form wins over the null
        heart_row(2, systolic_bp=150, diastolic_bp=None),  # 'or' short-circuits: scored
        heart_row(3, systolic_bp=120, diastolic_bp=None),  # diastolic is read: failure
        heart_row(4, gender=None),                         # None == 1 is False
        heart_row(5, gender=0),
        heart_row(6, hdl=None),
    ]
    got = score_b(spark, rows)
    assert got[0] == (0, 0.2, "default_input")
    assert got[1][2] == "scored"
    assert got[2] == (0, 0.5, "failed")
    assert got[3] == got[4]
    assert got[5] == (0, 0.5, "failed")


def test_heart_fill_absent_matches_explicit_defaults(spark):
    short = spark.createDataFrame([(1, 55, 1, 1, 0, 0, 1, 0, 0, 6)],
                                  "k int, age int, gender int, diabetes int, hypertension int, obesity int, "
                                  "smoking int, alcohol int, physical_activity int, diet_score int")
    filled = fill_absent(short)
    assert {"cholesterol", "stress", "family_history", "systolic_bp"} <= set(filled.columns)
    a = rule_score_b(short).first()
    full = heart_row(1, age=55, gender=1, diabetes=1, smoking=1, diet_score=6, cholesterol=200,
                     hdl=50, ldl=100, systolic_bp=120, diastolic_bp=80, family_history=0, stress=5)
    b = score_b(spark, [full])[0]
    assert (a.rule_pred, a.rule_prob) == b[:2]
    assert "cholesterol" not in rule_score_b(short).columns


def test_probability_bounds(spark):
    import random
    rnd = random.Random(7)
    rows = [(i, rnd.randint(0, 17), float(rnd.randint(0, 250)), rnd.randint(0, 200), rnd.randint(0, 99),
             rnd.randint(0, 900), rnd.uniform(0, 70), rnd.uniform(0, 3), rnd.randint(0, 120)) for i in range(500)]
    for pred, prob, status in score_a(spark, rows):
        assert 0.05 <= prob <= 0.95 and not math.isnan(prob)
        assert pred == (1 if prob >= 0.5 else 0) or status != "scored"
