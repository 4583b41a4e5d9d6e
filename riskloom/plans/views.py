"""Derived test views over the driver's tables.

The testdata has no clinical table, so the scoring inputs are derived from
real keys in integer arithmetic (identical in every SQL engine).  These
are plain projections: they add no shuffle and scale with the source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _patient_cols(e):
    return [
        (e * 7 % 18).alias("preg"),
        F.when(e % 23 == 0, F.lit(0)).otherwise(60 + e * 37 % 141).alias("glu"),
        F.when(e % 19 == 0, F.lit(0)).otherwise(50 + e * 13 % 101).alias("bp"),
        (e * 29 % 61).alias("skin"),
        (e * 53 % 401).alias("ins"),
        ((150 + e * 41 % 301).cast("double") / F.lit(10.0)).alias("bmi"),
        ((80 + e * 17 % 1401).cast("double") / F.lit(1000.0)).alias("dpf"),
        (21 + e * 11 % 61).alias("age"),
        F.when((e * 31 + e * 37 % 141) % 100 < 35, F.lit(1)).otherwise(F.lit(0)).alias("outcome"),
    ]


def _model_output_cols(e):
    return [
        F.when(e % 5 == 0, F.lit(None).cast("double"))
        .otherwise((e * 37 % 1000).cast("double") / F.lit(1000.0)).alias("lr_prob"),
        F.when((e % 5 == 0) | (e % 7 == 0), F.lit(None).cast("double"))
        .otherwise((e * 53 % 700).cast("double") / F.lit(1000.0)).alias("rf_prob"),
    ]


def patient_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Diabetes-shaped view over ``events`` (key ``k``, label ``outcome``)."""
    return patients(table(spark, sf_dir, "events"))


def patients(events: DataFrame) -> DataFrame:
    """The patient view of an ``events`` table or stream."""
    e = F.col("event_id")
    return events.select(e.alias("k"), *_patient_cols(e))


def patient_outputs_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patient view and stand-in model outputs of the same event, in one scan.

    Equal to joining the two views on the unique ``event_id``, without the
    self-join shuffle.
    """
    e = F.col("event_id")
    return table(spark, sf_dir, "events").select(e.alias("k"), *_patient_cols(e), *_model_output_cols(e))


# View column -> canonical diabetes feature name.
PATIENT_TO_DIABETES = {
    "preg": "pregnancies", "glu": "glucose", "bp": "blood_pressure",
    "skin": "skin_thickness", "ins": "insulin", "bmi": "bmi", "dpf": "dpf", "age": "age",
}


def diabetes_inputs(patients: DataFrame) -> DataFrame:
    """Rename the patient view to the canonical diabetes feature names."""
    return patients.withColumnsRenamed(PATIENT_TO_DIABETES)


def heart_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heart-shaped view with the 19 inputs over ``orders``."""
    o = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        o.alias("k"),
        (20 + o * 7 % 61).alias("age"),
        (o * 3 % 2).alias("gender"),
        (o % 3 % 2).alias("diabetes"),
        (o % 5 % 2).alias("hypertension"),
        (o % 7 % 2).alias("obesity"),
        (o % 11 % 2).alias("smoking"),
        (o % 13 % 2).alias("alcohol"),
        (o % 17 % 2).alias("physical_activity"),
        (o * 5 % 11).alias("diet_score"),
        (100 + o * 37 % 201).alias("cholesterol"),
        (50 + o * 41 % 251).alias("triglycerides"),
        (50 + o * 29 % 151).alias("ldl"),
        (20 + o * 23 % 81).alias("hdl"),
        (90 + o * 31 % 111).alias("systolic_bp"),
        (60 + o * 19 % 61).alias("diastolic_bp"),
        (o % 19 % 2).alias("pollution"),
        (o % 23 % 2).alias("family_history"),
        (1 + o * 13 % 10).alias("stress"),
        (o % 29 % 2).alias("healthcare"),
        F.when(F.col("o_orderstatus") == "F", F.lit(1)).otherwise(F.lit(0)).alias("outcome"),
    )


def model_output_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed stand-in model probabilities over ``events`` (null = no answer)."""
    e = F.col("event_id")
    return table(spark, sf_dir, "events").select(e.alias("k"), *_model_output_cols(e))


def _noise(k, m: int):
    """Integer noise in [0, m) from a key, the same in every engine."""
    return k * 7919 % m


def diabetes_training_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical diabetes inputs with a planted label: it follows glucose and
    age, so a model that mixes up features or labels cannot reach the
    held-out AUC that the checks ask for."""
    p = diabetes_inputs(patient_view(spark, sf_dir))
    signal = F.col("glucose") + 2 * F.col("age") + _noise(F.col("k"), 97)
    return p.withColumn("outcome", F.when(signal >= 290, 1).otherwise(0))


def heart_training_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heart inputs with a planted label that follows age, cholesterol and
    hypertension; one row in 50 has a null cholesterol, one in 70 a null label."""
    k = F.col("k")
    signal = 2 * F.col("age") + F.col("cholesterol") + 60 * F.col("hypertension") + _noise(k, 97)
    h = heart_view(spark, sf_dir).drop("outcome")
    h = h.withColumn("heart_attack_risk", F.when(k % 70 == 0, F.lit(None).cast("int")).otherwise(F.when(signal >= 400, 1).otherwise(0)))
    return h.withColumn("cholesterol", F.when(k % 50 == 0, F.lit(None)).otherwise(F.col("cholesterol")))
