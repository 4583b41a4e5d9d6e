"""Banded rule scores (the fallback when no model answers).

Each score starts from a base value and adds one increment per term, in a
fixed order.  Terms are evaluated top-down, first matching band wins.  The
additions are built as a left-deep chain of double ``+`` so the rounding
is the same as adding the increments one by one: reordering the terms or
switching to DECIMAL moves a few rows across the 0.5 and 0.3 borders.

Everything is a plain ``Column``; the scores stay inside whole-stage
codegen and cost nothing but a projection.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom import schemas
from riskloom.functions.columns import dlit, py_ge, py_gt, py_le, py_lt

_CMP = {"<": py_lt, "<=": py_le, ">": py_gt, ">=": py_ge}

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference for identical results).
# A band is (input, comparison, bound, increment); the bands of one term
# are tried in order and the term's ``else`` increment applies when none
# matches.  Terms are added in the order listed.
# ---------------------------------------------------------------------------
DIABETES_BASE = 0.1
DIABETES_TERMS = [
    ("glucose", [("<=", 90, 0.05), ("<=", 110, 0.15), ("<=", 125, 0.3),
                 ("<=", 140, 0.45), ("<=", 160, 0.55), ("<=", 180, 0.65)], 0.75),
    ("bmi", [("<", 18.5, 0.05), ("<", 25, 0.0), ("<", 30, 0.1),
             ("<", 35, 0.15), ("<", 40, 0.2)], 0.25),
    ("age", [("<", 35, -0.05), ("<", 45, 0.0), ("<", 55, 0.1), ("<", 65, 0.15)], 0.2),
    ("dpf", [(">", 0.8, 0.15), (">", 0.5, 0.07)], 0.0),
    ("blood_pressure", [(">", 140, 0.1)], 0.0),
    # insulin < 15 and glucose > 125
    ("insulin_resistance", [], 0.0),
]
DIABETES_INSULIN_RESISTANCE = (15, 125, 0.2)
# Input values of the untouched form; an exact match scores (0, 0.20).
DIABETES_FORM_DEFAULTS = {
    "pregnancies": 0, "glucose": 120, "blood_pressure": 70, "skin_thickness": 20,
    "insulin": 80, "bmi": 25.0, "dpf": 0.5, "age": 30,
}
# A null in any of these makes the reference raise, which ends in (0, 0.5).
DIABETES_REQUIRED = ["glucose", "bmi", "age", "dpf", "blood_pressure", "insulin"]

HEART_BASE = 0.15
HEART_TERMS = [
    ("age", [("<", 40, -0.05), ("<", 50, 0.05), ("<", 60, 0.15), ("<", 70, 0.25)], 0.3),
    ("gender", [("==", 1, 0.1)], 0.0),
    ("diabetes", [("==", 1, 0.15)], 0.0),
    ("hypertension", [("==", 1, 0.15)], 0.0),
    ("obesity", [("==", 1, 0.1)], 0.0),
    ("smoking", [("==", 1, 0.2)], 0.0),
    ("cholesterol", [(">", 240, 0.15), (">", 200, 0.1)], 0.0),
    ("hdl", [("<", 40, 0.1), (">", 60, -0.05)], 0.0),
    ("ldl", [(">", 160, 0.15), (">", 130, 0.1)], 0.0),
    # systolic >= 140 or diastolic >= 90: +0.15; systolic >= 130 or diastolic >= 85: +0.1
    ("blood_pressure", [], 0.0),
    ("family_history", [("==", 1, 0.15)], 0.0),
    ("stress", [(">", 7, 0.1)], 0.0),
    ("physical_activity", [("==", 1, -0.1)], 0.0),
]
HEART_BP_BANDS = [((140, 90), 0.15), ((130, 85), 0.1)]
HEART_FORM_DEFAULTS = {
    "age": 40, "gender": 0, "diabetes": 0, "hypertension": 0, "obesity": 0,
    "smoking": 0, "alcohol": 0, "physical_activity": 0, "diet_score": 5,
}
HEART_REQUIRED = ["age", "cholesterol", "hdl", "ldl", "systolic_bp", "stress"]
# ---------------------------------------------------------------------------


def _floating(df: DataFrame) -> set[str]:
    return {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}


def _cmp(op: str, c: str, bound, floating: set[str]) -> Column:
    """Python-semantics comparison; the NaN guard only where NaN can occur."""
    x = F.col(c)
    if op == "==":
        return x == bound
    if op in (">", ">=") and c in floating:
        return _CMP[op](x, bound)
    return {"<": x < bound, "<=": x <= bound, ">": x > bound, ">=": x >= bound}[op]


def _band_term(c: str, bands, otherwise: float, floating: set[str]) -> Column:
    # A null condition falls through a CASE like false: Python's
    # ``None == 1`` is False, and nulls in ordered comparisons are rows the
    # failure rule replaces anyway.
    expr = None
    for op, bound, inc in bands:
        cond = _cmp(op, c, bound, floating)
        expr = F.when(cond, dlit(inc)) if expr is None else expr.when(cond, dlit(inc))
    return dlit(otherwise) if expr is None else expr.otherwise(dlit(otherwise))


def _all_equal(values: dict) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k) == v for k, v in values.items()])


def _any_null(names) -> Column:
    return reduce(lambda a, b: a | b, [F.col(n).isNull() for n in names])


def diabetes_rule_sum(floating: set[str] = frozenset(("bmi", "dpf"))) -> Column:
    """Unclamped diabetes rule sum, additions in reference order."""
    p = dlit(DIABETES_BASE)
    for name, bands, otherwise in DIABETES_TERMS:
        if name == "insulin_resistance":
            ins_lt, glu_gt, inc = DIABETES_INSULIN_RESISTANCE
            cond = _cmp("<", "insulin", ins_lt, floating) & _cmp(">", "glucose", glu_gt, floating)
            term = F.when(cond, dlit(inc)).otherwise(dlit(0.0))
        else:
            term = _band_term(name, bands, otherwise, floating)
        p = p + term
    return p


def heart_rule_sum(floating: set[str] = frozenset()) -> Column:
    """Unclamped heart rule sum, additions in reference order."""
    p = dlit(HEART_BASE)
    for name, bands, otherwise in HEART_TERMS:
        if name == "blood_pressure":
            expr = None
            for (sys_t, dia_t), inc in HEART_BP_BANDS:
                cond = _cmp(">=", "systolic_bp", sys_t, floating) | _cmp(">=", "diastolic_bp", dia_t, floating)
                expr = F.when(cond, dlit(inc)) if expr is None else expr.when(cond, dlit(inc))
            term = expr.otherwise(dlit(0.0))
        else:
            term = _band_term(name, bands, otherwise, floating)
        p = p + term
    return p


_TMP = ("__rule_sum", "__rule_default", "__rule_failed", "__rule_p")


def _finish(df: DataFrame, rule_sum: Column, is_default: Column, failed: Column, pred_col: str,
            prob_col: str, with_status: bool, status_col: str) -> DataFrame:
    """Clamp, threshold and apply the default/failure overrides.

    The sum, the flags and the clamped value are separate projections:
    each is read more than once, so Catalyst keeps them apart, and every
    generated method stays small enough for the JIT.
    """
    lo, hi = schemas.PROB_CLAMP
    fail_pred, fail_prob = schemas.RULE_FAILURE
    dflt_pred, dflt_prob = schemas.RULE_DEFAULT_INPUT
    s, d, f, p = (F.col(c) for c in _TMP)
    staged = (df.withColumns({_TMP[0]: rule_sum, _TMP[1]: is_default, _TMP[2]: failed})
              .withColumn(_TMP[3], F.greatest(dlit(lo), F.least(dlit(hi), s))))
    cols = {
        pred_col: F.when(d, F.lit(dflt_pred)).when(f, F.lit(fail_pred))
        .when(p >= schemas.RULE_THRESHOLD, F.lit(1)).otherwise(F.lit(0)),
        prob_col: F.when(d, dlit(dflt_prob)).when(f, dlit(fail_prob)).otherwise(p),
    }
    if with_status:
        cols[status_col] = (F.when(d, F.lit("default_input")).when(f, F.lit("failed"))
                            .otherwise(F.lit("scored")))
    return staged.withColumns(cols).drop(*_TMP)


def rule_score_a(df: DataFrame, pred_col: str = "rule_pred", prob_col: str = "rule_prob",
                 with_status: bool = False, status_col: str = "rule_status") -> DataFrame:
    """Diabetes rule score per row: adds ``rule_pred`` int and ``rule_prob`` double.

    Inputs by name: ``DIABETES_FEATURES``.  If any is absent from the
    schema the whole job scores (0, 0.20), as the reference does for a short
    input list.  A null in a compared input scores (0, 0.5).
    """
    if any(c not in df.columns for c in schemas.DIABETES_FEATURES):
        lo_pred, lo_prob = schemas.RULE_DEFAULT_INPUT
        cols = {pred_col: F.lit(lo_pred), prob_col: dlit(lo_prob)}
        if with_status:
            cols[status_col] = F.lit("short_input")
        return df.withColumns(cols)
    return _finish(df, diabetes_rule_sum(_floating(df)), _all_equal(DIABETES_FORM_DEFAULTS),
                   _any_null(DIABETES_REQUIRED), pred_col, prob_col, with_status, status_col)


def fill_absent(df: DataFrame, defaults: dict | None = None) -> DataFrame:
    """Add a literal column for every input absent from the schema.

    Present columns are left alone, nulls included (a null is not an
    absent input).
    """
    defaults = schemas.HEART_ABSENT_DEFAULTS if defaults is None else defaults
    missing = {k: F.lit(v) for k, v in defaults.items() if k not in df.columns}
    return df.withColumns(missing) if missing else df


def rule_score_b(df: DataFrame, pred_col: str = "rule_pred", prob_col: str = "rule_prob",
                 with_status: bool = False, status_col: str = "rule_status") -> DataFrame:
    """Heart rule score per row: adds ``rule_pred`` int and ``rule_prob`` double.

    Absent inputs take the stated defaults first (``fill_absent``); the
    default-form check runs before the failure check, so default form
    values with a null cholesterol still score (0, 0.20).
    """
    work = fill_absent(df)
    added = [c for c in work.columns if c not in df.columns]
    floating = _floating(work)
    failed = _any_null(HEART_REQUIRED) | (
        F.col("diastolic_bp").isNull() & ~F.coalesce(_cmp(">=", "systolic_bp", 140, floating), F.lit(False)))
    out = _finish(work, heart_rule_sum(floating), _all_equal(HEART_FORM_DEFAULTS), failed,
                  pred_col, prob_col, with_status, status_col)
    return out.drop(*added) if added else out
