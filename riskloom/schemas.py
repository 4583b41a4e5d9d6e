"""Schemas, feature orders and the fixed values the scores depend on.

Features are bound by *name* everywhere in this package; the positional
orders below only matter where a vector is assembled, and they are the
same at fit time and at score time because the whole fitted pipeline is
persisted together.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference for identical results).
# Diabetes table: CSV header names and our canonical names, in file order.
# ---------------------------------------------------------------------------
DIABETES_CSV_COLUMNS = [
    ("Pregnancies", "pregnancies", T.IntegerType()),
    ("Glucose", "glucose", T.IntegerType()),
    ("BloodPressure", "blood_pressure", T.IntegerType()),
    ("SkinThickness", "skin_thickness", T.IntegerType()),
    ("Insulin", "insulin", T.IntegerType()),
    ("BMI", "bmi", T.DoubleType()),
    ("DiabetesPedigreeFunction", "dpf", T.DoubleType()),
    ("Age", "age", T.IntegerType()),
    ("Outcome", "outcome", T.IntegerType()),
]
DIABETES_FEATURES = [
    "pregnancies", "glucose", "blood_pressure", "skin_thickness",
    "insulin", "bmi", "dpf", "age",
]
DIABETES_LABEL = "outcome"
# Columns where a zero means "not measured".
ZERO_AS_MISSING = ["glucose", "blood_pressure", "skin_thickness", "insulin", "bmi"]

# Heart table: the 19 scoring inputs in form order, identifier columns,
# the string column that is binary-encoded and its positive value.
HEART_FEATURES = [
    "age", "gender", "diabetes", "hypertension", "obesity", "smoking",
    "alcohol", "physical_activity", "diet_score", "cholesterol",
    "triglycerides", "ldl", "hdl", "systolic_bp", "diastolic_bp",
    "pollution", "family_history", "stress", "healthcare",
]
HEART_LABEL = "heart_attack_risk"
HEART_ID_COLUMNS = ["patient_id", "state_name"]
HEART_ENCODED = ("gender", "Male")

# Defaults used when a heart rule input is absent from the schema.
HEART_ABSENT_DEFAULTS = {
    "age": 50, "gender": 0, "diabetes": 0, "hypertension": 0, "obesity": 0,
    "smoking": 0, "alcohol": 0, "physical_activity": 0, "diet_score": 5,
    "cholesterol": 200, "hdl": 50, "ldl": 100, "systolic_bp": 120,
    "diastolic_bp": 80, "family_history": 0, "stress": 5,
}

# Input bounds (inclusive) of the entry form.
DIABETES_BOUNDS = {
    "pregnancies": (0, 20), "glucose": (0, 300), "blood_pressure": (0, 200),
    "skin_thickness": (0, 100), "insulin": (0, 900), "bmi": (0.0, 70.0),
    "dpf": (0.0, 3.0), "age": (0, 120),
}
HEART_BOUNDS = {
    "age": (0, 120), "gender": (0, 1), "diabetes": (0, 1),
    "hypertension": (0, 1), "obesity": (0, 1), "smoking": (0, 1),
    "alcohol": (0, 1), "physical_activity": (0, 1), "diet_score": (0, 10),
    "cholesterol": (100, 300), "triglycerides": (50, 300), "ldl": (50, 200),
    "hdl": (20, 100), "systolic_bp": (90, 200), "diastolic_bp": (60, 120),
    "pollution": (0, 1), "family_history": (0, 1), "stress": (1, 10),
    "healthcare": (0, 1),
}

# Model-score cut-off, rule cut-off, and the fallback when rules fail.
MODEL_THRESHOLD = 0.3
RULE_THRESHOLD = 0.5
CONSENSUS_THRESHOLD = 0.3
NO_MODEL_MEAN = 0.5
RULE_FAILURE = (0, 0.5)
RULE_DEFAULT_INPUT = (0, 0.20)
PROB_CLAMP = (0.05, 0.95)

# Flag columns of the heart form shown as Yes/No; gender is Male/Female.
HEART_YES_NO_FLAGS = [
    "diabetes", "hypertension", "obesity", "smoking", "alcohol",
    "physical_activity", "pollution", "family_history", "healthcare",
]
# ---------------------------------------------------------------------------


def diabetes_csv_schema() -> T.StructType:
    """Explicit schema of the diabetes CSV (header names as in the file)."""
    return T.StructType([T.StructField(src, t, True) for src, _, t in DIABETES_CSV_COLUMNS])


def diabetes_rename_map() -> dict[str, str]:
    return {src: dst for src, dst, _ in DIABETES_CSV_COLUMNS}


def heart_schema(int_type: T.DataType = T.IntegerType()) -> T.StructType:
    """Schema of the heart table with our column names.

    The file itself is not available, so this is the binding we score by;
    callers with other spellings rename before use.
    """
    fields = [
        T.StructField("patient_id", T.StringType(), True),
        T.StructField("state_name", T.StringType(), True),
    ]
    for c in HEART_FEATURES:
        t = T.StringType() if c == "gender" else int_type
        fields.append(T.StructField(c, t, True))
    fields.append(T.StructField(HEART_LABEL, T.IntegerType(), True))
    return T.StructType(fields)

# Suffixes of the columns that the feature stages add beside their inputs.
IMPUTED_SUFFIX = "__imputed"
ENCODED_SUFFIX = "__encoded"
