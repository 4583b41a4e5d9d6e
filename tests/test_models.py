"""Training, tuning, scoring and streaming on the small driver tables."""

import pytest

import __spark_entry__ as entry
from riskloom.operators import scoring
from riskloom.plans import catalog, views
from riskloom.session import scratch_path
from riskloom.streaming.score_stream import read_stream, score_stream


@pytest.fixture(scope="module")
def q():
    return entry.queries()


def test_entry_smoke(spark):
    df = entry.entry(spark)
    n = df.count()
    assert n > 0 and {"verdict", "source", "risk_prob"} <= set(df.columns)


def test_scores_follow_from_stored_models(spark, sf_small, q):
    """Values are checked against SQL in test_oracle; here that the stream gives what the batch gives."""
    base = catalog.trained(spark, sf_small)
    models = catalog._load(spark, base, "diabetes")
    assert [m[1] for m in models.values()] == ["loaded", "loaded"]
    df = catalog.patient_inputs(spark, sf_small)
    batch = scoring.score_all(df, "diabetes", models, "k")
    landing = scratch_path(spark, "test-stream-in")
    df.repartition(3).write.parquet(landing)
    out = scratch_path(spark, "test-stream-out")
    score_stream(read_stream(spark, landing, df.schema), "diabetes", models, "k", out, scratch_path(spark, "test-ckpt")).awaitTermination()
    rows = lambda x: {r.k: (r.lr_prob, r.rf_prob, r.verdict) for r in x.collect()}
    assert rows(spark.read.parquet(out)) == rows(batch)


def test_shared_stages_run_once(spark, sf_small):
    models = catalog._load(spark, catalog.trained(spark, sf_small), "diabetes")
    plan = scoring.score(catalog.patient_inputs(spark, sf_small), models)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("AS features_unscaled#") == 1


def test_a_model_that_does_not_fit_fails_alone(spark, sf_small):
    models = catalog._load(spark, catalog.trained(spark, sf_small), "diabetes")
    heart = views.heart_view(spark, sf_small)
    r = scoring.score(heart, {"lr": models["lr"], "rf": (None, "absent")}).first()
    assert (r.lr_status, r.rf_status, r.lr_prob, r.rf_prob) == ("failed", "absent", None, None)


def test_stream_resumes_without_rescoring(spark, tmp_path):
    """A rerun on the same checkpoint scores only files that are new."""
    from riskloom.plans import catalog
    from riskloom.streaming.score_stream import read_stream, score_stream
    src = catalog.patient_inputs(spark, "/root/testdata/sf0.001")
    landing, out, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    src.where("k % 2 = 0").write.mode("append").parquet(landing)
    score_stream(read_stream(spark, landing, src.schema), "diabetes", {"lr": None, "rf": None}, "k",
                 out, ckpt).awaitTermination()
    first = spark.read.parquet(out).count()
    src.where("k % 2 = 1").write.mode("append").parquet(landing)
    score_stream(read_stream(spark, landing, src.schema), "diabetes", {"lr": None, "rf": None}, "k",
                 out, ckpt).awaitTermination()
    total = spark.read.parquet(out)
    assert total.count() == src.count() and first < total.count()
    assert total.groupBy("k").count().where("count > 1").count() == 0
