"""The three jobs end to end on views of the driver's tables, and the heart path on a small table."""

import pytest
from pyspark.sql import functions as F

from riskloom import schemas
from riskloom.functions.rules import rule_score_a
from riskloom.operators import clean
from riskloom.plans import jobs, training, views
from riskloom.session import scratch_path
from riskloom.sources import files, registry, versions
from riskloom.sources import models as model_io


@pytest.fixture(scope="module")
def diabetes(spark, sf_small):
    return views.diabetes_training_view(spark, sf_small)


def test_profile_of_the_view(diabetes):
    rows = diabetes.collect()
    means = clean.nonzero_means(diabetes, schemas.ZERO_AS_MISSING).first()
    for c in schemas.ZERO_AS_MISSING:
        held = [r[c] for r in rows if r[c]]
        assert means[c] == pytest.approx(sum(held) / len(held), abs=1e-9)
    share = sum(r.outcome for r in rows) / len(rows)
    assert 0.2 < share < 0.6


def test_rule_counts_over_the_view(diabetes):
    r = rule_score_a(diabetes).agg(
        F.sum((F.col("rule_prob") >= 0.5).cast("int")).alias("ge5"),
        F.sum((F.col("rule_prob") >= 0.3).cast("int")).alias("ge3"), F.count("*").alias("n")).first()
    assert 0 < r.ge5 < r.ge3 <= r.n


def test_prepare_train_serve(spark, diabetes):
    out, n = scratch_path(spark, "test-jobs"), diabetes.count()
    prepared = jobs.prepare(diabetes, "diabetes", f"{out}/processed", key="k")
    assert prepared.count() == n and set(prepared.columns) == {"k", "features", "outcome"}
    reg = jobs.train(spark, diabetes, "diabetes", f"{out}/models", key="k").collect()
    assert sorted(r.model for r in reg) == ["logistic_regression", "random_forest"]
    assert sum(r.is_best for r in reg) == 1 and all(r.auc >= 0.85 for r in reg)
    assert all(r.n_train + r.n_test == n and r.partitions == training.buckets(r.n_train) for r in reg)
    served = jobs.serve(spark, diabetes, "diabetes", f"{out}/models", key="k")
    assert served.count() == n and served.where("source <> 'models'").count() == 0
    status = {(r.task, r.artefact): r.present for r in registry.artefact_status(spark, f"{out}/models").collect()}
    assert status[("diabetes", "lr")] and status[("diabetes", "rf")] and status[("diabetes", "registry")]
    assert not status[("heart", "lr")] and not status[("heart", "rf")] and not status[("heart", "registry")]


def _numbers(fit):
    """Every number of a fitted pipeline with a forest, as it is."""
    imputer, _, scaler, forest = fit.models["rf"].stages
    return imputer.getStatement(), scaler.mean.toArray().tolist(), scaler.std.toArray().tolist(), [t.toDebugString.split("\n", 1)[1] for t in forest.trees]


@pytest.mark.parametrize("partitions", [None, 3])
def test_forest_does_not_depend_on_the_layout(spark, diabetes, partitions):
    """Imputer means, scaler numbers and trees are equal bit for bit."""
    hot = diabetes.withColumn("k", F.when(F.col("k") % 3 == 0, F.lit(3)).otherwise(F.col("k")))  # one key in a third of the rows
    for df in (diabetes, hot):
        fits = [training.fit_task(spark, df.repartition(n), "k", "outcome", models=("rf",), tune_models=False, partitions=partitions) for n in (1, 4, 8)]
        assert _numbers(fits[0]) == _numbers(fits[1]) == _numbers(fits[2])


def test_buckets_grow_with_the_rows():
    rows = [0, 1, 16_384, 16_385, 12_000_000, 64_000_001, 10**11]
    assert [training.buckets(n) for n in rows] == [1, 1, 1, 2, 64, 65, 100_000]
    assert all(n / training.buckets(n) <= training.MOST_ROWS for n in rows)


def test_short_passes_do_not_follow_the_buckets(spark, diabetes, monkeypatch):
    """Logistic fits and evaluations run in as many tasks as there are cores, the forest on its buckets."""
    class Seen(Exception):
        pass

    def tuned(est, grid, train, label, **kw):
        raise Seen(train.rdd.getNumPartitions(), kw["tasks"])

    monkeypatch.setattr(training, "tune", tuned)
    cores = training.n_cores(spark)
    for model, tasks in (("lr", cores), ("rf", cores + 3)):
        with pytest.raises(Seen) as seen:
            training.fit_task(spark, diabetes, "k", schemas.DIABETES_LABEL, models=(model,), partitions=cores + 3)
        assert seen.value.args == (tasks, cores)
    assert training.pass_tasks(5, 80_000, 12) == 5 and training.pass_tasks(100, 90_000_000, 12) == 90


def test_a_run_that_dies_leaves_the_old_version(spark, diabetes, monkeypatch):
    models = scratch_path(spark, "test-publish")

    def quick(*args, **kw):
        return fit_task(*args, **{**kw, "models": ("lr", "rf"), "tune_models": False})

    fit_task = training.fit_task
    monkeypatch.setattr(training, "fit_task", quick)
    monkeypatch.setattr(training, "cv_report", None)
    report = spark.createDataFrame([("x", 0)], "model string, grid_index int")

    def reported(*args, **kw):
        fit = quick(*args, **kw)
        fit.reports = {"lr": report, "rf": report}
        return fit

    monkeypatch.setattr(training, "fit_task", reported)
    jobs.train(spark, diabetes, "diabetes", models, key="k")
    number, folder = versions.current(spark, models, "diabetes")
    before = sorted(map(tuple, jobs.serve(spark, diabetes, "diabetes", models, key="k").select("k", "lr_prob", "rf_prob").collect()))
    save = model_io.save_model

    def dies(model, path):
        if path.endswith("model_rf"):
            raise OSError("lost")
        return save(model, path)

    monkeypatch.setattr(model_io, "save_model", dies)
    with pytest.raises(OSError, match="lost"):
        jobs.train(spark, diabetes.where("k % 2 = 0"), "diabetes", models, key="k")
    assert versions.current(spark, models, "diabetes") == (number, folder)
    served = jobs.serve(spark, diabetes, "diabetes", models, key="k")
    assert sorted(map(tuple, served.select("k", "lr_prob", "rf_prob").collect())) == before
    monkeypatch.setattr(model_io, "save_model", save)
    jobs.train(spark, diabetes.where("k % 2 = 0"), "diabetes", models, key="k")
    assert versions.current(spark, models, "diabetes")[0] == number + 1
    assert versions.prune(spark, models, "diabetes", keep=1) == [folder.rpartition("/")[2]]
    assert not model_io.path_exists(spark, folder) and versions.current(spark, models, "diabetes")[0] == number + 1


def test_versions_published_at_once(spark):
    models = scratch_path(spark, "test-versions")
    assert versions.current(spark, models, "t") == (0, None)
    assert versions.publish(spark, models, "t", f"{models}/versions/t-a") == 1
    assert versions.publish(spark, models, "t", f"{models}/versions/t-b") == 2
    assert versions.current(spark, models, "t") == (2, f"{models}/versions/t-b") and versions.current(spark, models, "u") == (0, None)
    with pytest.raises(ValueError, match="stays"):
        versions.prune(spark, models, "t", keep=0)


def test_changed_files_have_another_identity(spark):
    path = scratch_path(spark, "test-identity")
    spark.range(5).write.parquet(path)
    first = files.identity(spark.read.parquet(path))
    assert first == files.identity(spark.read.parquet(path))
    spark.range(1).write.mode("append").parquet(path)
    assert files.identity(spark.read.parquet(path)) != first


def test_csv_columns_are_bound_by_name(spark):
    path, schema = scratch_path(spark, "test-csv"), schemas.diabetes_csv_schema()
    names = [f.name for f in schema.fields]
    swapped = ["BloodPressure" if n == "Glucose" else "Glucose" if n == "BloodPressure" else n for n in names]
    row = {n: i + 1 for i, n in enumerate(names)}
    spark.createDataFrame([tuple(str(row[n]) for n in swapped)], swapped).coalesce(1).write.option("header", True).csv(path)
    got = files.read_diabetes_csv(spark, path).first()
    assert (got.glucose, got.blood_pressure) == (row["Glucose"], row["BloodPressure"])
    other = scratch_path(spark, "test-csv-missing")
    spark.createDataFrame([("1",)], ["Glucose"]).coalesce(1).write.option("header", True).csv(other)
    with pytest.raises(ValueError, match="lacks"):
        files.read_diabetes_csv(spark, other)
    spark.createDataFrame([tuple(str(row[n]) for n in names)], names).coalesce(1).write.mode("append").option("header", True).csv(path)
    with pytest.raises(Exception, match="(?i)header"):  # the second file has another order
        files.read_diabetes_csv(spark, path).collect()


def test_bad_rows_are_kept_apart(spark):
    path = scratch_path(spark, "test-bad-csv")
    spark.createDataFrame([("a,b\n1,x\nz,y\n3\n4,q,r\n,\n",)], "value string").coalesce(1).write.text(path)
    schema = "a int, b string"
    good, bad = files.read_checked_csv(spark, path, spark.createDataFrame([], schema).schema, scratch_path(spark, "test-bad"))
    assert [tuple(r) for r in good.collect()] == [(1, "x"), (None, None)]
    assert sorted(r.row for r in bad.collect()) == ["3", "4,q,r", "z,y"] and good.select("b").count() == 2


def test_heart_training_drops_rows_with_nulls(spark, sf_small):
    df = views.heart_training_view(spark, sf_small)
    whole = df.dropna().count()
    assert whole < df.count()
    fit = training.fit_task(spark, df.dropna(), "k", schemas.HEART_LABEL, "heart", models=("lr",), tune_models=False)
    assert fit.train.count() + fit.test.count() == whole
    with pytest.raises(Exception, match="null"):
        training.fit_task(spark, df, "k", schemas.HEART_LABEL, "heart", models=("lr",), tune_models=False)


def test_store_faults_are_not_absence(spark):
    assert model_io.load_with_status(spark, None) == (None, "absent")
    assert model_io.load_with_status(spark, scratch_path(spark, "none")) == (None, "absent")
    assert model_io.load_with_status(spark, "nosuchfs://host/model")[1] == "failed"
    with pytest.raises(Exception, match="nosuchfs"):
        model_io.path_exists(spark, "nosuchfs://host/model")


def test_heart_prepare_and_rule_serving(spark):
    rows = []
    for i in range(60):
        vals = [30 + i % 50, "Male" if i % 2 else "Female", i % 2, (i // 2) % 2, (i // 3) % 2, (i // 5) % 2,
                0, i % 2, i % 11, 150 + i, 100 + i, 80 + i, 30 + i % 50, 100 + i, 70 + i % 40, 0, i % 2,
                1 + i % 10, 1]
        rows.append((f"p{i}", "S", *vals, i % 3 % 2))
    df = spark.createDataFrame(rows, schemas.heart_schema())
    out = scratch_path(spark, "test-heart")
    prepared = jobs.prepare(df, "heart", f"{out}/processed", key="patient_id")
    assert prepared.count() == 60
    served = jobs.serve(spark, df, "heart", f"{out}/absent-models", key="patient_id")
    assert served.where("source = 'models'").count() == 0
    # the gender string is encoded for the rules (1 = male)
    male = served.where("gender = 'Male'").select("rule_prob").limit(1).collect()
    assert male and served.schema["gender"].dataType.typeName() == "string"


def test_heart_csv_names_and_types(spark):
    header = ["Patient_ID", "State_Name", "Age", "Gender", "Diabetes", "Cholesterol_Level", "Heart_Attack_Risk"]
    rows = [["P1", "Kerala", "54", "Male", "1", "231", "1"], ["P2", "", "61", "Female", "0", "190", "0"]]
    path = scratch_path(spark, "test-heart-csv")
    spark.createDataFrame(rows, header).coalesce(1).write.option("header", True).csv(path)
    df = files.read_heart_csv(spark, path, rename={"cholesterol_level": "cholesterol"})
    assert df.columns == ["patient_id", "state_name", "age", "gender", "diabetes", "cholesterol",
                          "heart_attack_risk"]
    assert dict(df.dtypes)["age"] == "int" and dict(df.dtypes)["gender"] == "string"
    prepared = jobs.prepare(df, "heart", scratch_path(spark, "test-heart-prep"), key="patient_id")
    assert prepared.count() == 2        # the null state name is an id: the row is kept


def test_serve_checked_splits_out_of_range_rows(spark):
    rows = [(1, 1, 120, 70, 20, 80, 25.0, 0.5, 30), (2, 1, 350, 70, 20, 80, 25.0, 0.5, 30),
            (3, 1, 100, 70, 20, 80, 25.0, 4.0, 150)]
    df = spark.createDataFrame(rows, "k int, pregnancies int, glucose int, blood_pressure int, skin_thickness int, "
                                     "insulin int, bmi double, dpf double, age int")
    scored, rejected = jobs.serve_checked(spark, df, "diabetes", scratch_path(spark, "no-models"), key="k")
    assert [r.k for r in scored.collect()] == [1]
    assert {r.k: r.violations for r in rejected.collect()} == {2: ["glucose"], 3: ["dpf", "age"]}
