"""Cleaning operators: imputation, null rows, encoding, range checks (F2)."""

from pyspark.sql import functions as F

from riskloom import schemas
from riskloom.operators import clean, profile
from riskloom.plans import feature_plans


def test_zero_impute_semantics(spark):
    df = spark.createDataFrame([(1, 0, 0, 4), (2, 10, 0, None), (3, 20, 0, 0)], "k int, a int, z int, n int")
    out = {r.k: r for r in clean.zero_impute(df, ["a", "z", "n"]).collect()}
    assert out[1].a == 15.0 and out[2].a == 10.0        # int -> double, mean of non-zero
    assert out[1].z is None                              # all-zero column: zeros become null
    assert out[2].n is None and out[3].n == 4.0          # null stays null
    assert dict(clean.zero_impute(df, ["a"], means={"a": 1.5}).select("k", "a").collect())[1] == 1.5


def test_nonzero_means_single_pass(spark):
    df = spark.createDataFrame([(0.0, 2.0), (4.0, 0.0), (None, 6.0)], "a double, b double")
    r = clean.nonzero_means(df, ["a", "b"]).first()
    assert (r.a, r.b) == (4.0, 4.0)
    long = {r.column_name: (r.nonzero_mean, r.n_nonzero) for r in profile.nonzero_mean(df, ["a", "b"]).collect()}
    assert long == {"a": (4.0, 1), "b": (4.0, 2)}


def heart_table(spark):
    schema = schemas.heart_schema()
    base = {c: 1 for c in schemas.HEART_FEATURES}
    rows = []
    for pid, state, gender, overrides, label in [
        ("p1", "S", "Male", {}, 1),
        ("p2", "S", "Female", {"cholesterol": None}, 0),   # null feature: dropped
        ("p3", None, "Male", {}, 0),                        # null only in an id: kept
        ("p4", "S", "male", {}, 1),                         # lower case: encodes to 0
        ("p5", "S", "Male", {}, None),                      # null label: dropped
    ]:
        vals = {**base, **overrides, "gender": gender}
        rows.append((pid, state, *[vals[c] for c in schemas.HEART_FEATURES], label))
    return spark.createDataFrame(rows, schema)


def test_heart_preparation_f2(spark):
    prepared = feature_plans.null_drop_prepare(heart_table(spark), schemas.HEART_LABEL, schemas.HEART_ID_COLUMNS)
    assert "patient_id" not in prepared.columns and "state_name" not in prepared.columns
    assert prepared.count() == 3
    enc = clean.binary_encode(prepared, "gender", "Male")
    assert sorted(r.gender for r in enc.collect()) == [0, 1, 1]
    feats = feature_plans.dynamic_features(prepared, schemas.HEART_LABEL)
    assert feats == schemas.HEART_FEATURES


def test_binary_encode_null(spark):
    df = spark.createDataFrame([("F",), ("O",), (None,), ("f",)], "s string")
    assert [r.s for r in clean.binary_encode(df, "s", "F").collect()] == [1, 0, 0, 0]


def test_range_check_inclusive_and_null(spark):
    df = spark.createDataFrame([(1, 0, 10), (2, -1, 10), (3, None, 11), (4, 5, 0)], "k int, a int, b int")
    out = {r.k: (r.violations, r.valid) for r in clean.range_check(df, {"a": (0, 5), "b": (1, 10)}).collect()}
    assert out == {1: ([], True), 2: (["a"], False), 3: (["a", "b"], False), 4: (["b"], False)}
    ok, bad = clean.range_split(df, {"a": (0, 5), "b": (1, 10)})
    assert ok.count() == 1 and bad.count() == 3


def test_drop_null_rows_nan(spark):
    df = spark.createDataFrame([(1, 1.0), (2, float("nan")), (3, None)], "k int, x double")
    assert [r.k for r in clean.drop_null_rows(df).collect()] == [1]


def test_profile_and_head(spark):
    df = spark.range(10).withColumn("x", F.when(F.col("id") < 3, F.lit(0)).otherwise(F.col("id")))
    p = {r.column_name: r for r in profile.dataset_profile(df, ["x"]).collect()}
    assert (p["x"].n, p["x"].n_zero, p["x"].min_value, p["x"].max_value) == (10, 3, 0.0, 9.0)
    assert [r.id for r in profile.sample_head(df, "id", 3).collect()] == [0, 1, 2]
    assert profile.row_count(df).first().n == 10
    assert ("x", "bigint", False) in profile.schema_report(df)
