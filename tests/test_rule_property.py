"""Rule scores on adversarial rows (band edges +-1, nulls) agree between
Spark and the hand-written SQL run by DuckDB."""

import random

import duckdb
import pandas as pd

from riskloom.functions.rules import rule_score_a, rule_score_b
from riskloom.plans.oracle import rule_a_sql, rule_b_sql

EDGES_A = {
    "pregnancies": [0, 1, 5], "glucose": [0, 89, 90, 91, 110, 111, 125, 126, 140, 141, 160, 161, 180, 181, 120],
    "blood_pressure": [0, 70, 139, 140, 141], "skin_thickness": [0, 20, 35], "insulin": [0, 14, 15, 16, 80],
    "bmi": [0.0, 18.4, 18.5, 24.9, 25.0, 29.9, 30.0, 34.9, 35.0, 39.9, 40.0], "dpf": [0.5, 0.49, 0.51, 0.8, 0.81],
    "age": [30, 34, 35, 44, 45, 54, 55, 64, 65],
}
EDGES_B = {
    "age": [39, 40, 49, 50, 59, 60, 69, 70], "gender": [0, 1], "diabetes": [0, 1], "hypertension": [0, 1],
    "obesity": [0, 1], "smoking": [0, 1], "alcohol": [0, 1], "physical_activity": [0, 1], "diet_score": [5, 4],
    "cholesterol": [200, 201, 240, 241], "triglycerides": [150], "ldl": [130, 131, 160, 161],
    "hdl": [39, 40, 60, 61], "systolic_bp": [129, 130, 139, 140], "diastolic_bp": [84, 85, 89, 90],
    "pollution": [0], "family_history": [0, 1], "stress": [7, 8], "healthcare": [0],
}


def rows(edges, n, seed, null_rate=0.04):
    rnd = random.Random(seed)
    out = []
    for k in range(n):
        r = {"k": k}
        for c, vals in edges.items():
            r[c] = None if rnd.random() < null_rate else rnd.choice(vals)
        out.append(r)
    return pd.DataFrame(out)


def compare(spark, pdf, scorer, sql_ctes, cte_name, schema):
    sdf = scorer(spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), schema), with_status=True)
    got = sorted(tuple(r) for r in sdf.select("k", "rule_pred", "rule_prob", "rule_status").collect())
    con = duckdb.connect()
    con.register("src_pdf", pdf)
    casts = ", ".join(f"CAST({c} AS {'DOUBLE' if t == 'double' else 'BIGINT'}) AS {c}"
                      for c, t in (f.split() for f in schema.split(", ")))
    want = con.execute(f"WITH src AS (SELECT {casts} FROM src_pdf), {sql_ctes} "
                       f"SELECT k, rule_pred, rule_prob, rule_status FROM {cte_name}").fetchall()
    assert got == sorted(tuple(r) for r in want)


def test_rule_a_matches_sql(spark):
    schema = "k bigint, " + ", ".join(f"{c} {'double' if c in ('bmi', 'dpf') else 'bigint'}" for c in EDGES_A)
    compare(spark, rows(EDGES_A, 4000, 11), rule_score_a, rule_a_sql("src"), "ra", schema)


def test_rule_b_matches_sql(spark):
    schema = "k bigint, " + ", ".join(f"{c} bigint" for c in EDGES_B)
    compare(spark, rows(EDGES_B, 4000, 12), rule_score_b, rule_b_sql("src"), "rb", schema)
