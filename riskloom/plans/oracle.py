"""Independent SQL (DuckDB dialect, ANSI where possible) for every
value-checked query in ``catalog``.  Hand-written, not generated from the
Spark code, so that it checks the Spark plans rather than echoing them.

Double literals are written as ``CAST(x AS DOUBLE)``: bare ``0.1`` is a
DECIMAL in SQL, and exact decimal sums move rows across the 0.5 border.
"""

from __future__ import annotations


def D(x) -> str:  # noqa: N802 - reads like a literal in the SQL text
    return f"CAST({x} AS DOUBLE)"


F4 = """f4 AS (
  SELECT event_id AS k,
         event_id*7%18 AS preg,
         CASE WHEN event_id%23=0 THEN 0 ELSE 60+event_id*37%141 END AS glu,
         CASE WHEN event_id%19=0 THEN 0 ELSE 50+event_id*13%101 END AS bp,
         event_id*29%61 AS skin,
         event_id*53%401 AS ins,
         CAST(150+event_id*41%301 AS DOUBLE)/CAST(10 AS DOUBLE) AS bmi,
         CAST(80+event_id*17%1401 AS DOUBLE)/CAST(1000 AS DOUBLE) AS dpf,
         21+event_id*11%61 AS age,
         CASE WHEN (event_id*31+event_id*37%141)%100<35 THEN 1 ELSE 0 END AS outcome
  FROM events)"""

F4B = """f4b AS (
  SELECT o_orderkey AS k,
         20+o_orderkey*7%61 AS age, o_orderkey*3%2 AS gender,
         o_orderkey%3%2 AS diabetes, o_orderkey%5%2 AS hypertension,
         o_orderkey%7%2 AS obesity, o_orderkey%11%2 AS smoking,
         o_orderkey%13%2 AS alcohol, o_orderkey%17%2 AS physical_activity,
         o_orderkey*5%11 AS diet_score, 100+o_orderkey*37%201 AS cholesterol,
         50+o_orderkey*41%251 AS triglycerides, 50+o_orderkey*29%151 AS ldl,
         20+o_orderkey*23%81 AS hdl, 90+o_orderkey*31%111 AS systolic_bp,
         60+o_orderkey*19%61 AS diastolic_bp, o_orderkey%19%2 AS pollution,
         o_orderkey%23%2 AS family_history, 1+o_orderkey*13%10 AS stress,
         o_orderkey%29%2 AS healthcare,
         CASE WHEN o_orderstatus='F' THEN 1 ELSE 0 END AS outcome
  FROM orders)"""

F4C = """f4c AS (
  SELECT event_id AS k,
         CASE WHEN event_id%5=0 THEN NULL
              ELSE CAST(event_id*37%1000 AS DOUBLE)/CAST(1000 AS DOUBLE) END AS lr_prob,
         CASE WHEN event_id%5=0 OR event_id%7=0 THEN NULL
              ELSE CAST(event_id*53%700 AS DOUBLE)/CAST(1000 AS DOUBLE) END AS rf_prob
  FROM events)"""

# Patient view with the canonical diabetes names.
DIAB = """diab AS (
  SELECT k, preg AS pregnancies, glu AS glucose, bp AS blood_pressure,
         skin AS skin_thickness, ins AS insulin, bmi, dpf, age, outcome
  FROM f4)"""


def rule_a_sql(src: str) -> str:
    """CTEs ``ra_raw`` and ``ra`` scoring the diabetes rule over ``src``.

    ``ra`` has every column of ``src`` plus rule_pred, rule_prob, rule_status.
    """
    return f"""ra_raw AS (
  SELECT *,
    COALESCE(pregnancies = 0 AND glucose = 120 AND blood_pressure = 70 AND skin_thickness = 20
             AND insulin = 80 AND bmi = 25.0 AND dpf = 0.5 AND age = 30, FALSE) AS a_default,
    (glucose IS NULL OR bmi IS NULL OR age IS NULL OR dpf IS NULL
     OR blood_pressure IS NULL OR insulin IS NULL) AS a_failed,
    greatest({D(0.05)}, least({D(0.95)},
      {D(0.1)}
      + CASE WHEN glucose <= 90 THEN {D(0.05)} WHEN glucose <= 110 THEN {D(0.15)}
             WHEN glucose <= 125 THEN {D(0.3)} WHEN glucose <= 140 THEN {D(0.45)}
             WHEN glucose <= 160 THEN {D(0.55)} WHEN glucose <= 180 THEN {D(0.65)}
             ELSE {D(0.75)} END
      + CASE WHEN bmi < 18.5 THEN {D(0.05)} WHEN bmi < 25 THEN {D(0.0)} WHEN bmi < 30 THEN {D(0.1)}
             WHEN bmi < 35 THEN {D(0.15)} WHEN bmi < 40 THEN {D(0.2)} ELSE {D(0.25)} END
      + CASE WHEN age < 35 THEN {D(-0.05)} WHEN age < 45 THEN {D(0.0)} WHEN age < 55 THEN {D(0.1)}
             WHEN age < 65 THEN {D(0.15)} ELSE {D(0.2)} END
      + CASE WHEN dpf > 0.8 THEN {D(0.15)} WHEN dpf > 0.5 THEN {D(0.07)} ELSE {D(0.0)} END
      + CASE WHEN blood_pressure > 140 THEN {D(0.1)} ELSE {D(0.0)} END
      + CASE WHEN insulin < 15 AND glucose > 125 THEN {D(0.2)} ELSE {D(0.0)} END)) AS a_prob
  FROM {src}),
ra AS (
  SELECT * EXCLUDE (a_default, a_failed, a_prob),
    CASE WHEN a_default THEN 0 WHEN a_failed THEN 0 WHEN a_prob >= 0.5 THEN 1 ELSE 0 END AS rule_pred,
    CASE WHEN a_default THEN {D(0.2)} WHEN a_failed THEN {D(0.5)} ELSE a_prob END AS rule_prob,
    CASE WHEN a_default THEN 'default_input' WHEN a_failed THEN 'failed' ELSE 'scored' END AS rule_status
  FROM ra_raw)"""


def rule_b_sql(src: str) -> str:
    """CTEs ``rb_raw`` and ``rb`` scoring the heart rule over ``src``."""
    return f"""rb_raw AS (
  SELECT *,
    COALESCE(age = 40 AND gender = 0 AND diabetes = 0 AND hypertension = 0 AND obesity = 0
             AND smoking = 0 AND alcohol = 0 AND physical_activity = 0 AND diet_score = 5, FALSE) AS b_default,
    (age IS NULL OR cholesterol IS NULL OR hdl IS NULL OR ldl IS NULL OR systolic_bp IS NULL
     OR stress IS NULL OR (diastolic_bp IS NULL AND NOT COALESCE(systolic_bp >= 140, FALSE))) AS b_failed,
    greatest({D(0.05)}, least({D(0.95)},
      {D(0.15)}
      + CASE WHEN age < 40 THEN {D(-0.05)} WHEN age < 50 THEN {D(0.05)} WHEN age < 60 THEN {D(0.15)}
             WHEN age < 70 THEN {D(0.25)} ELSE {D(0.3)} END
      + CASE WHEN gender = 1 THEN {D(0.1)} ELSE {D(0.0)} END
      + CASE WHEN diabetes = 1 THEN {D(0.15)} ELSE {D(0.0)} END
      + CASE WHEN hypertension = 1 THEN {D(0.15)} ELSE {D(0.0)} END
      + CASE WHEN obesity = 1 THEN {D(0.1)} ELSE {D(0.0)} END
      + CASE WHEN smoking = 1 THEN {D(0.2)} ELSE {D(0.0)} END
      + CASE WHEN cholesterol > 240 THEN {D(0.15)} WHEN cholesterol > 200 THEN {D(0.1)} ELSE {D(0.0)} END
      + CASE WHEN hdl < 40 THEN {D(0.1)} WHEN hdl > 60 THEN {D(-0.05)} ELSE {D(0.0)} END
      + CASE WHEN ldl > 160 THEN {D(0.15)} WHEN ldl > 130 THEN {D(0.1)} ELSE {D(0.0)} END
      + CASE WHEN systolic_bp >= 140 OR diastolic_bp >= 90 THEN {D(0.15)}
             WHEN systolic_bp >= 130 OR diastolic_bp >= 85 THEN {D(0.1)} ELSE {D(0.0)} END
      + CASE WHEN family_history = 1 THEN {D(0.15)} ELSE {D(0.0)} END
      + CASE WHEN stress > 7 THEN {D(0.1)} ELSE {D(0.0)} END
      + CASE WHEN physical_activity = 1 THEN {D(-0.1)} ELSE {D(0.0)} END)) AS b_prob
  FROM {src}),
rb AS (
  SELECT * EXCLUDE (b_default, b_failed, b_prob),
    CASE WHEN b_default THEN 0 WHEN b_failed THEN 0 WHEN b_prob >= 0.5 THEN 1 ELSE 0 END AS rule_pred,
    CASE WHEN b_default THEN {D(0.2)} WHEN b_failed THEN {D(0.5)} ELSE b_prob END AS rule_prob,
    CASE WHEN b_default THEN 'default_input' WHEN b_failed THEN 'failed' ELSE 'scored' END AS rule_status
  FROM rb_raw)"""


def consensus_sql() -> str:
    """CTE ``cons``: F4c joined to F4, rule fallback, gate and verdict."""
    return f"""{F4}, {F4C}, {DIAB},
j AS (SELECT f4c.k, f4c.lr_prob, f4c.rf_prob, diab.* EXCLUDE (k) FROM f4c JOIN diab ON f4c.k = diab.k),
{rule_a_sql('j')},
m AS (
  SELECT *,
    CASE WHEN lr_prob IS NULL THEN NULL WHEN lr_prob >= 0.3 THEN 1 ELSE 0 END AS lr_pred,
    CASE WHEN rf_prob IS NULL THEN NULL WHEN rf_prob >= 0.3 THEN 1 ELSE 0 END AS rf_pred
  FROM ra),
g AS (
  SELECT *,
    (lr_pred IS NULL AND rf_pred IS NULL) AS no_model,
    (CASE WHEN lr_pred = 1 THEN 1 ELSE 0 END) + (CASE WHEN rf_pred = 1 THEN 1 ELSE 0 END) AS n_votes,
    (CASE WHEN lr_prob IS NOT NULL THEN 1 ELSE 0 END) + (CASE WHEN rf_prob IS NOT NULL THEN 1 ELSE 0 END) AS n_ans
  FROM m),
h AS (
  SELECT *,
    CASE WHEN n_ans = 0 THEN {D(0.5)}
         ELSE ({D(0.0)} + COALESCE(lr_prob, {D(0.0)}) + COALESCE(rf_prob, {D(0.0)})) / n_ans END AS mean_p
  FROM g),
cons AS (
  SELECT k, outcome, lr_prob, lr_pred, rf_prob, rf_pred,
    CASE WHEN no_model THEN rule_pred END AS rule_pred,
    CASE WHEN no_model THEN rule_prob END AS rule_prob,
    CASE WHEN NOT no_model THEN 'models' WHEN rule_status = 'failed' THEN 'last_resort' ELSE 'rules' END AS source,
    CASE WHEN NOT no_model THEN n_votes END AS votes,
    CASE WHEN NOT no_model THEN mean_p ELSE rule_prob END AS risk_prob,
    CASE WHEN (NOT no_model AND (n_votes > 0 OR mean_p >= 0.3))
           OR (no_model AND (rule_pred = 1 OR rule_prob >= 0.3)) THEN 'High' ELSE 'Low' END AS verdict
  FROM h)"""


ORACLE: dict[str, str] = {}


def _q(name: str, sql: str) -> None:
    ORACLE[name] = sql.strip()


_q("rule_score_a", f"""
WITH {F4},
p AS (
  SELECT k, preg AS pregnancies, glu AS glucose, nullif(bp, 99) AS blood_pressure,
         skin AS skin_thickness, nullif(ins, 7) AS insulin,
         nullif(bmi, {D(20.0)}) AS bmi, dpf, age
  FROM f4),
{rule_a_sql('p')}
SELECT k, rule_pred, round(rule_prob, 6) AS rule_prob, rule_status FROM ra""")

_q("rule_score_b", f"""
WITH {F4B},
p AS (
  SELECT * EXCLUDE (cholesterol, diastolic_bp, gender),
         nullif(cholesterol, 150) AS cholesterol, nullif(diastolic_bp, 61) AS diastolic_bp,
         nullif(gender, 1) AS gender
  FROM f4b),
{rule_b_sql('p')}
SELECT k, rule_pred, round(rule_prob, 6) AS rule_prob, rule_status FROM rb""")

_q("consensus", f"""
WITH {consensus_sql()}
SELECT k, lr_prob, lr_pred, rf_prob, rf_pred, rule_pred, round(rule_prob, 6) AS rule_prob,
       source, votes, round(risk_prob, 6) AS risk_prob, verdict
FROM cons""")

_q("fallback_gate", f"""
WITH {consensus_sql()}
SELECT k, rule_pred, round(rule_prob, 6) AS rule_prob, source FROM cons""")

_q("verdict_counts", f"""
WITH {consensus_sql()}
SELECT source, verdict, count(*) AS n FROM cons GROUP BY source, verdict""")


# --- projections, cleaning ------------------------------------------------

_q("select_features", "SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer")

_q("drop_ids", "SELECT c_custkey, c_nationkey, c_acctbal FROM customer")

DOCS_LABELLED = """dl AS (
  SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

_q("drop_null_rows", f"""
WITH {DOCS_LABELLED}
SELECT * FROM dl
WHERE doc_id IS NOT NULL AND lang IS NOT NULL AND source IS NOT NULL AND n_chars IS NOT NULL
  AND quality IS NOT NULL AND toxic IS NOT NULL""")


def _nz(src: str, tbl: str, c: str) -> str:
    return (f"SELECT '{src}' AS source, '{c}' AS column_name, "
            f"round(avg(CASE WHEN {c} <> 0 THEN {c} END), 6) AS nonzero_mean, "
            f"count(CASE WHEN {c} <> 0 THEN 1 END) AS n_nonzero FROM {tbl}")


_q("nonzero_mean", f"""
WITH {F4}
{_nz('lineitem', 'lineitem', 'l_discount')}
UNION ALL {_nz('lineitem', 'lineitem', 'l_tax')}
UNION ALL {_nz('patients', 'f4', 'glu')}
UNION ALL {_nz('patients', 'f4', 'bp')}""")

_q("zero_impute", """
WITH m AS (SELECT avg(CASE WHEN l_discount <> 0 THEN l_discount END) AS md,
                  avg(CASE WHEN l_tax <> 0 THEN l_tax END) AS mt FROM lineitem)
SELECT l_orderkey, l_linenumber,
       round(CASE WHEN l_discount = 0 THEN md ELSE l_discount END, 6) AS l_discount,
       round(CASE WHEN l_tax = 0 THEN mt ELSE l_tax END, 6) AS l_tax
FROM lineitem CROSS JOIN m""")

_q("zero_impute_patients", f"""
WITH {F4},
m AS (SELECT avg(CASE WHEN glu <> 0 THEN glu END) AS mg, avg(CASE WHEN bp <> 0 THEN bp END) AS mb,
             avg(CASE WHEN skin <> 0 THEN skin END) AS ms FROM f4)
SELECT k,
       round(CASE WHEN glu = 0 THEN mg ELSE CAST(glu AS DOUBLE) END, 6) AS glu,
       round(CASE WHEN bp = 0 THEN mb ELSE CAST(bp AS DOUBLE) END, 6) AS bp,
       round(CASE WHEN skin = 0 THEN ms ELSE CAST(skin AS DOUBLE) END, 6) AS skin
FROM f4 CROSS JOIN m""")

_q("binary_encode", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS status_flag FROM orders""")

# Heart-form bounds with cholesterol and systolic narrowed, in form order.
_HEART_NARROWED = [
    ("age", 0, 120), ("gender", 0, 1), ("diabetes", 0, 1), ("hypertension", 0, 1),
    ("obesity", 0, 1), ("smoking", 0, 1), ("alcohol", 0, 1), ("physical_activity", 0, 1),
    ("diet_score", 0, 10), ("cholesterol", 120, 280), ("triglycerides", 50, 300),
    ("ldl", 50, 200), ("hdl", 20, 100), ("systolic_bp", 100, 180), ("diastolic_bp", 60, 120),
    ("pollution", 0, 1), ("family_history", 0, 1), ("stress", 1, 10), ("healthcare", 0, 1),
]


def _bad(c, lo, hi):
    return f"NOT COALESCE({c} BETWEEN {lo} AND {hi}, FALSE)"


_q("range_check", f"""
WITH {F4B}
SELECT k,
  concat_ws(',', {', '.join(f"CASE WHEN {_bad(c, lo, hi)} THEN '{c}' END" for c, lo, hi in _HEART_NARROWED)}) AS violations,
  NOT ({' OR '.join(_bad(c, lo, hi) for c, lo, hi in _HEART_NARROWED)}) AS valid
FROM f4b""")

_q("range_reject_counts", f"""
WITH {F4B},
per_col AS (
  {' UNION ALL '.join(f"SELECT 'heart' AS source, '{c}' AS item, count(*) AS n FROM f4b WHERE {_bad(c, lo, hi)}"
                     for c, lo, hi in _HEART_NARROWED)}
  UNION ALL SELECT 'customer', 'c_acctbal', count(*) FROM customer WHERE {_bad('c_acctbal', 0, 9000)}),
totals AS (
  SELECT 'heart' AS source,
         CASE WHEN {' OR '.join(_bad(c, lo, hi) for c, lo, hi in _HEART_NARROWED)} THEN '__rejected__'
              ELSE '__valid__' END AS item, count(*) AS n
  FROM f4b GROUP BY 2
  UNION ALL
  SELECT 'customer', CASE WHEN {_bad('c_acctbal', 0, 9000)} THEN '__rejected__' ELSE '__valid__' END, count(*)
  FROM customer GROUP BY 2)
SELECT source, item, n FROM per_col WHERE n > 0
UNION ALL SELECT source, item, n FROM totals""")

_q("fill_absent", f"""
WITH {F4B},
p AS (SELECT * EXCLUDE (stress, family_history), 5 AS stress, 0 AS family_history FROM f4b),
{rule_b_sql('p')}
SELECT k, stress, family_history, rule_pred, round(rule_prob, 6) AS rule_prob FROM rb""")

_FLAGS = ["diabetes", "hypertension", "obesity", "smoking", "alcohol", "physical_activity",
          "pollution", "family_history", "healthcare"]

_q("decode_flags", f"""
WITH {F4B}
SELECT k, CASE WHEN gender = 1 THEN 'Male' WHEN gender IS NOT NULL THEN 'Female' END AS gender,
  {', '.join(f"CASE WHEN {c} = 1 THEN 'Yes' WHEN {c} IS NOT NULL THEN 'No' END AS {c}" for c in _FLAGS)}
FROM f4b""")


# --- vectors, assembly, scaling ---------------------------------------------

_q("vector_roundtrip", """
SELECT vec_id, CAST(len(embedding) AS INTEGER) AS n,
       round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS total,
       round(CAST(embedding[1] AS DOUBLE), 6) AS first
FROM embeddings""")

_PV = ["preg", "glu", "bp", "skin", "ins", "bmi", "dpf", "age"]

_q("assemble", f"""
WITH {F4}
SELECT k, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in _PV)} FROM f4""")


def _zscore(src: str, key: str, cols: list[str], extra_keys: str = "") -> str:
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in cols)
    # ``+ 0.0`` turns a rounded -0.0 (a tiny negative residue) into 0.0.
    zs = ", ".join(f"round(CASE WHEN s_{c} = 0 THEN {D(0.0)} ELSE ({c} - m_{c}) / s_{c} END, 6) + {D(0.0)} AS {c}"
                   for c in cols)
    return f"SELECT {key}{extra_keys}, {zs} FROM {src} CROSS JOIN (SELECT {stats} FROM {src}) st"


_q("standardize", f"""
WITH {F4}, s AS (SELECT k, {', '.join(_PV)}, 1 AS const FROM f4)
{_zscore('s', 'k', _PV + ['const'])}""")

_q("scaler_stats", """
SELECT 'p_size' AS column_name, round(avg(p_size), 6) AS mean, round(stddev_samp(p_size), 6) AS std FROM part
UNION ALL SELECT 'p_retailprice', round(avg(p_retailprice), 6), round(stddev_samp(p_retailprice), 6) FROM part
UNION ALL SELECT 'const', round(avg(7), 6), round(stddev_samp(7), 6) FROM part""")

_q("scaler_model_stats", f"""
WITH {F4}
{' UNION ALL '.join(f"SELECT '{c}' AS column_name, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std FROM f4"
                    for c in _PV)}""")

_DIAB_FEATURES = ["pregnancies", "glucose", "blood_pressure", "skin_thickness", "insulin", "bmi", "dpf", "age"]
_ZERO = ["glucose", "blood_pressure", "skin_thickness", "insulin", "bmi"]

_q("features_zero_imputed", f"""
WITH {F4}, {DIAB},
m AS (SELECT {', '.join(f'avg(CASE WHEN {c} <> 0 THEN {c} END) AS nz_{c}' for c in _ZERO)} FROM diab),
imp AS (
  SELECT k, {', '.join((f'CASE WHEN {c} = 0 THEN nz_{c} ELSE CAST({c} AS DOUBLE) END AS {c}' if c in _ZERO
                        else f'CAST({c} AS DOUBLE) AS {c}') for c in _DIAB_FEATURES)}
  FROM diab CROSS JOIN m)
{_zscore('imp', 'k', _DIAB_FEATURES)}""")

_q("features_null_dropped", f"""
WITH {DOCS_LABELLED},
kept AS (
  SELECT doc_id, toxic, CASE WHEN lang = 'en' THEN 1 ELSE 0 END AS lang, n_chars, quality FROM dl
  WHERE lang IS NOT NULL AND n_chars IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL)
{_zscore('kept', 'doc_id', ['lang', 'n_chars', 'quality'], ', toxic')}""")


# --- statistics ----------------------------------------------------------------

def _prof(c: str) -> str:
    return (f"SELECT '{c}' AS column_name, count(*) AS n, count(CASE WHEN {c} IS NULL THEN 1 END) AS n_null, "
            f"count(CASE WHEN {c} = 0 THEN 1 END) AS n_zero, CAST(min({c}) AS DOUBLE) AS min_value, "
            f"CAST(max({c}) AS DOUBLE) AS max_value, round(avg({c}), 6) AS mean_value FROM f4")


_q("dataset_profile", f"""
WITH {F4}
{' UNION ALL '.join(_prof(c) for c in _PV + ['outcome'])}""")

_q("sample_head", f"""
WITH {F4}
SELECT * FROM f4 ORDER BY k LIMIT 5""")

_q("row_count", "SELECT count(*) AS n FROM lineitem")


# --- splits and folds ---------------------------------------------------------

def _bucket(key: str, salt: str, mod: int) -> str:
    return f"(('0x' || substr(md5(CAST({key} AS VARCHAR) || '{salt}'), 1, 8))::BIGINT % {mod})"


_q("hash_split", f"""
SELECT o_orderkey, CASE WHEN {_bucket('o_orderkey', ':42', 100)} < 80 THEN 'train' ELSE 'test' END AS split
FROM orders""")

_q("split_counts", f"""
SELECT CASE WHEN {_bucket('o_orderkey', ':42', 100)} < 80 THEN 'train' ELSE 'test' END AS split, count(*) AS n
FROM orders GROUP BY 1""")

_q("fold_assign", f"""
SELECT o_orderkey, CAST({_bucket('o_orderkey', ':42:fold', 3)} AS INTEGER) AS fold
FROM orders WHERE {_bucket('o_orderkey', ':42', 100)} < 80""")


# --- evaluation -----------------------------------------------------------------

def _rules_long() -> str:
    return f"""{F4}, {DIAB}, {F4B},
{rule_a_sql('diab')},
{rule_b_sql('f4b')},
lng AS (
  SELECT 'diabetes' AS task, k, rule_prob AS score, rule_pred AS pred, outcome AS label FROM ra
  UNION ALL SELECT 'heart', k, rule_prob, rule_pred, outcome FROM rb)"""


def _auc(src: str, by: str) -> str:
    """Rank-sum AUC per group with average ranks for ties."""
    return f"""rk AS (
  SELECT {by}, label,
         rank() OVER (PARTITION BY {by} ORDER BY score)
           + (count(*) OVER (PARTITION BY {by}, score) - 1) / 2.0 AS r
  FROM {src} WHERE score IS NOT NULL AND label IS NOT NULL),
auc AS (
  SELECT {by}, count(*) AS n, CAST(sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_pos,
         sum(CASE WHEN label = 1 THEN r ELSE 0 END) AS rs
  FROM rk GROUP BY {by})"""


_q("auc_exact", f"""
WITH {_rules_long()},
{_auc('lng', 'task')}
SELECT task,
  round(CASE WHEN n_pos > 0 AND n > n_pos
        THEN (rs - n_pos * (n_pos + 1) / 2.0) / (CAST(n_pos AS DOUBLE) * CAST(n - n_pos AS DOUBLE)) END, 6) AS auc,
  n, n_pos
FROM auc""")

_q("accuracy", f"""
WITH {_rules_long()}
SELECT task, round(avg(CASE WHEN pred = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy, count(*) AS n
FROM lng GROUP BY task""")


def _candidates() -> str:
    return f"""{F4}, {F4C}, {DIAB}, {F4B},
j AS (SELECT f4c.k, f4c.lr_prob, f4c.rf_prob, diab.* EXCLUDE (k) FROM f4c JOIN diab ON f4c.k = diab.k),
{rule_a_sql('j')},
{rule_b_sql('f4b')},
cand AS (
  SELECT 'diabetes' AS task, 'logistic_regression' AS model, lr_prob AS score, outcome AS label FROM ra
  UNION ALL SELECT 'diabetes', 'random_forest', rf_prob, outcome FROM ra
  UNION ALL SELECT 'heart', 'logistic_regression', rule_prob, outcome FROM rb
  UNION ALL SELECT 'heart', 'random_forest', CAST(rule_pred AS DOUBLE), outcome FROM rb
  UNION ALL SELECT 'tie_check', 'logistic_regression', rule_prob, outcome FROM ra
  UNION ALL SELECT 'tie_check', 'random_forest', rule_prob, outcome FROM ra),
grp AS (SELECT task || '|' || model AS g, task, model, score, label FROM cand),
{_auc('grp', 'g')},
met AS (
  SELECT split_part(g, '|', 1) AS task, split_part(g, '|', 2) AS model,
         round(CASE WHEN n_pos > 0 AND n > n_pos
               THEN (rs - n_pos * (n_pos + 1) / 2.0) / (CAST(n_pos AS DOUBLE) * CAST(n - n_pos AS DOUBLE)) END, 6) AS auc
  FROM auc),
best AS (
  SELECT *, row_number() OVER (PARTITION BY task ORDER BY auc DESC NULLS LAST,
                               CASE WHEN model = 'logistic_regression' THEN 0 ELSE 1 END, model) = 1 AS is_best
  FROM met)"""


_q("best_model", f"""
WITH {_candidates()}
SELECT task, model, auc, is_best FROM best""")

_q("registry_status", f"""
WITH {_candidates()},
expected(task, model) AS (VALUES ('diabetes', 'logistic_regression'), ('diabetes', 'random_forest'),
  ('heart', 'logistic_regression'), ('heart', 'random_forest'), ('diabetes', 'best'), ('heart', 'best')),
have AS (
  SELECT task, model, max(CAST(is_best AS INTEGER)) AS b FROM (
    SELECT task, model, is_best FROM best
    UNION ALL SELECT task, 'best', TRUE FROM best WHERE is_best) x
  GROUP BY task, model)
SELECT e.task, e.model, h.b IS NOT NULL AS present, COALESCE(h.b = 1, FALSE) AS is_best
FROM expected e LEFT JOIN have h ON e.task = h.task AND e.model = h.model""")


# --- per-row scalar functions ---------------------------------------------------

_q("linear_score", f"""
WITH {F4}
SELECT k, round(1.0 / (1.0 + exp(-({D(-4.0)} + {D(0.02)} * glu + {D(0.05)} * bmi + {D(0.015)} * age
                                     + {D(0.8)} * dpf))), 6) AS p
FROM f4""")

_q("threshold", f"""
WITH {F4C}
SELECT k, CASE WHEN lr_prob IS NULL THEN NULL WHEN lr_prob >= 0.3 THEN 1 ELSE 0 END AS lr_pred,
          CASE WHEN rf_prob IS NULL THEN NULL WHEN rf_prob >= 0.3 THEN 1 ELSE 0 END AS rf_pred
FROM f4c""")

_q("clamp", f"""
WITH {F4C}
SELECT k, round(CASE WHEN lr_prob IS NULL THEN NULL ELSE greatest({D(0.05)}, least({D(0.95)}, lr_prob)) END, 6) AS lr_clamped,
          round(CASE WHEN rf_prob IS NULL THEN NULL ELSE greatest({D(0.05)}, least({D(0.95)}, rf_prob)) END, 6) AS rf_clamped
FROM f4c""")

_q("model_comparison", f"""
WITH {consensus_sql()},
lng AS (
  SELECT k, 'Logistic Regression' AS model, lr_pred AS pred, lr_prob AS prob FROM cons WHERE lr_pred IS NOT NULL
  UNION ALL SELECT k, 'Random Forest', rf_pred, rf_prob FROM cons WHERE rf_pred IS NOT NULL)
SELECT k, model,
  CASE WHEN pred = 1 THEN 'Positive' ELSE 'Negative' END AS prediction,
  CASE WHEN pred = 1 THEN 'High Risk' ELSE 'Low Risk' END AS risk_level,
  prob AS probability, printf('%.1f%%', prob * 100) AS probability_text
FROM lng""")


_q("verdict_text", f"""
WITH {consensus_sql()}
SELECT k, verdict,
  verdict || ' Risk of Diabetes' || CASE WHEN source = 'models' THEN '' ELSE ' (Fallback Prediction)' END AS headline,
  CASE WHEN source = 'models' THEN 'The models predict an average '
       ELSE 'The fallback prediction indicates a ' END || printf('%.1f%%', risk_prob * 100)
    || ' probability of diabetes.' AS message
FROM cons""")


# The texts shown to users.
def _recommend(task_sql: str) -> str:
    return f"""CASE WHEN {task_sql} = 'diabetes' AND verdict = 'High' THEN 'Further clinical tests are recommended.'
       WHEN {task_sql} = 'diabetes' AND verdict = 'Low' THEN 'Maintain a healthy lifestyle and regular check-ups.'
       WHEN {task_sql} = 'heart' AND verdict = 'High' THEN 'Immediate consultation with a cardiologist is advised.'
       WHEN {task_sql} = 'heart' AND verdict = 'Low' THEN 'Continue with regular health check-ups and maintain a healthy lifestyle.' END"""


_q("recommendation", f"""
WITH {consensus_sql()}, {F4B},
{rule_b_sql('f4b')},
hv AS (SELECT k, CASE WHEN rule_pred = 1 OR rule_prob >= 0.3 THEN 'High' ELSE 'Low' END AS verdict FROM rb),
both_ AS (
  SELECT 'diabetes' AS task, k, verdict,
         verdict || ' Risk of Diabetes' || CASE WHEN source = 'models' THEN '' ELSE ' (Fallback Prediction)' END AS headline
  FROM cons
  UNION ALL SELECT 'heart', k, verdict, verdict || ' Risk of Heart Attack (Fallback Prediction)' FROM hv)
SELECT task, k, verdict, {_recommend('task')} AS recommendation, headline FROM both_""")


# --- sources and sinks ------------------------------------------------------------

_q("csv_roundtrip", "SELECT * FROM part")
_q("csv_by_name", "SELECT * FROM part")
_q("csv_quarantine", """
SELECT p_partkey, p_partkey % 17 <> 0 AS fits, CASE WHEN p_partkey % 17 <> 0 THEN p_size END AS p_size,
  sha256(CASE WHEN p_partkey % 7 = 0 THEN 'two' || chr(10) || 'lines, "' || p_name || '"' ELSE p_name END) AS name_sha256
FROM part""")

_q("processed_roundtrip", """
SELECT p_partkey, CAST(p_size AS DOUBLE) AS p_size, p_retailprice FROM part""")


# --- training, tuning, persistence, scoring -----------------------------------
# Fitted numbers are not SQL; these queries return what must hold for any
# right fit, and the keys, counts and rule results that SQL can state.

_TRAIN_K = _bucket("event_id", ":42", 100)
_DIAB_NAMES = ["pregnancies", "glucose", "blood_pressure", "skin_thickness", "insulin", "bmi", "dpf", "age"]


def _values(rows: list[str], cols: str) -> str:
    return f"(VALUES {', '.join(rows)}) AS v({cols})"


_n_train = f"(SELECT count(*) FROM events WHERE {_TRAIN_K} < 80) AS n_train"
_q("train_lr", f"""
SELECT term, true AS finite, true AS sign_ok, {_n_train}
FROM {_values([f"('{t}')" for t in ["intercept", *_DIAB_NAMES]], "term")}""")

_q("train_rf", f"SELECT CAST(i AS INTEGER) AS tree, true AS depth_ok, true AS splits, {_n_train} FROM range(20) AS r(i)")

_LR_POINTS = [f"('logistic_regression', {i}, 'elasticNetParam={e},regParam={r}')"
              for i, (r, e) in enumerate((r, e) for r in (0.01, 0.1, 0.3) for e in (0.0, 0.5, 1.0))]
_RF_POINTS = [f"('random_forest', {i}, 'maxDepth={d},numTrees={t}')"
              for i, (t, d) in enumerate((t, d) for t in (10, 20) for d in (5, 10))]


def _points(rows: list[str]) -> str:
    return ("SELECT model, CAST(grid_index AS INTEGER) AS grid_index, params, true AS auc_ok, true AS best_ok, true AS timed FROM "
            + _values(rows, "model, grid_index, params"))


_q("tune_lr", _points(_LR_POINTS))
_q("tune_rf", _points(_RF_POINTS))
_q("cv_metrics", _points(_LR_POINTS + _RF_POINTS))
_q("feature_importance", "SELECT feature, true AS non_negative, true AS adds_to_one, feature IN ('glucose', 'age') AS top_two FROM "
   + _values([f"('{f}')" for f in _DIAB_NAMES], "feature"))
_q("model_roundtrip", "SELECT event_id AS k, true AS same FROM events")

_FLAGS = ", ".join(f"true AS {f}" for f in ("in_range", "pred_ok", "votes_ok", "mean_ok", "verdict_ok", "no_rule"))
_BOTH = "'models' AS source, 'loaded' AS lr_status, 'loaded' AS rf_status"
_q("batch_score", f"SELECT event_id AS k, {_BOTH}, {_FLAGS}, true AS sigmoid_ok FROM events")
_q("heart_batch_score", f"SELECT o_orderkey AS k, {_BOTH}, {_FLAGS}, true AS sigmoid_ok FROM orders")
_q("stream_score", f"SELECT event_id AS k, {_BOTH}, {_FLAGS} FROM events")

_q("stream_refresh", """
SELECT event_id AS k, CAST(1 + event_id % 2 AS BIGINT) AS model_version, 'loaded' AS lr_status, 'absent' AS rf_status, 'models' AS source, true AS lr_answered
FROM events""")

_q("wrong_type", f"""
WITH {F4}, {DIAB},
src AS (SELECT * REPLACE (CASE WHEN k % 11 <> 0 THEN CAST(glucose AS DOUBLE) END AS glucose) FROM diab),
{rule_a_sql('src')}
SELECT k, CASE WHEN k % 11 = 0 THEN 'unknown' ELSE CAST(CAST(glucose AS INTEGER) AS VARCHAR) END AS glucose, 'failed' AS lr_status, 'failed' AS rf_status,
  CASE WHEN rule_status = 'failed' THEN 'last_resort' ELSE 'rules' END AS source, rule_pred, round(rule_prob, 6) AS rule_prob
FROM ra""")

_q("partial_models", f"""
WITH {F4}, {DIAB},
src AS (SELECT * REPLACE (nullif(glucose, 100) AS glucose) FROM diab),
{rule_a_sql('src')}
SELECT k, CASE WHEN glucose IS NOT NULL THEN 'models' WHEN rule_status = 'failed' THEN 'last_resort' ELSE 'rules' END AS source,
  'failed' AS lr_status, 'loaded' AS rf_status, false AS lr_answered, glucose IS NOT NULL AS rf_answered,
  CASE WHEN glucose IS NULL THEN rule_pred END AS rule_pred, CASE WHEN glucose IS NULL THEN round(rule_prob, 6) END AS rule_prob
FROM ra""")

_q("own_inputs", """
SELECT o_orderkey AS k, o_orderkey % 13 <> 5 AS lr_answered, o_orderkey % 13 <> 5 AS rf_answered,
  CASE WHEN o_orderkey % 13 <> 5 THEN 'models' ELSE 'rules' END AS source
FROM orders""")

_KEPT = "o_orderkey % 50 <> 0 AND o_orderkey % 70 <> 0"
_ORDER_K = _bucket("o_orderkey", ":42", 100)
_q("model_registry", f"""
WITH n AS (
  SELECT 'diabetes' AS task, count(*) FILTER (WHERE {_TRAIN_K} < 80) AS n_train, count(*) FILTER (WHERE {_TRAIN_K} >= 80) AS n_test FROM events
  UNION ALL
  SELECT 'heart', count(*) FILTER (WHERE {_ORDER_K} < 80), count(*) FILTER (WHERE {_ORDER_K} >= 80) FROM orders WHERE {_KEPT})
SELECT task, model, n_train, n_test, CAST(greatest(1, least(64, (n_train + 16383) // 16384), (n_train + 999999) // 1000000) AS INTEGER) AS partitions,
  true AS auc_ok, true AS binned_near, true AS accuracy_ok, true AS winner_ok
FROM n, (VALUES ('logistic_regression'), ('random_forest')) AS m(model)""")

_q("artefact_status", """
SELECT task, artefact, present FROM (VALUES ('diabetes', 'lr', true), ('diabetes', 'rf', true),
  ('diabetes', 'registry', true), ('heart', 'lr', false), ('heart', 'rf', false), ('heart', 'registry', false)) AS v(task, artefact, present)""")

_HEART = ["age", "gender", "diabetes", "hypertension", "obesity", "smoking", "alcohol", "physical_activity", "diet_score", "cholesterol",
          "triglycerides", "ldl", "hdl", "systolic_bp", "diastolic_bp", "pollution", "family_history", "stress", "healthcare"]
_q("heart_csv_roundtrip", f"""
WITH {F4B}
SELECT k, 'Kerala' AS state_name, {", ".join({"gender": "CASE WHEN gender = 1 THEN 'Male' ELSE 'Female' END AS gender", "cholesterol": "CASE WHEN k % 50 <> 0 THEN cholesterol END AS cholesterol"}.get(c, c) for c in _HEART)},
  CASE WHEN k % 70 <> 0 THEN CASE WHEN 2 * age + cholesterol + 60 * hypertension + k * 7919 % 97 >= 400 THEN 1 ELSE 0 END END AS heart_attack_risk
FROM f4b""")
