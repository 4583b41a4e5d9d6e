"""Scale probe (not a registered query): N synthetic rows from ``range``.

1. exact AUC where one score value holds a third of all rows, against
   Spark's exact ``BinaryClassificationEvaluator(numBins=0)``;
2. rule score + gate + verdict + counts over the same number of rows;
3. both fitted pipelines (LR, RF; fitted on the sf0.01 patient view) +
   rules + verdict over the same rows.

Usage: python tools/scale_probe.py [N]  (default 10,000,000)
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.ml.evaluation import BinaryClassificationEvaluator  # noqa: E402
from pyspark.ml.functions import array_to_vector  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from riskloom.functions.columns import threshold  # noqa: E402
from riskloom.functions.rules import rule_score_a  # noqa: E402
from riskloom.operators import evaluate, scoring  # noqa: E402
from riskloom.session import local_session  # noqa: E402


def main() -> None:
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 10_000_000
    spark = local_session(shuffle_partitions=64)
    e = F.col("id")
    df = spark.range(0, n, 1, 32).select(
        F.when(e % 3 == 0, F.lit(0.5)).otherwise((F.xxhash64(e) % 1000000).cast("double") / 1e6).alias("score"),
        (F.abs(F.xxhash64(e, F.lit(7))) % 100 < 35).cast("int").alias("label"))
    t = time.time()
    ours = evaluate.auc_exact(df, "score", "label").first().auc
    a = time.time() - t
    raw = df.select(array_to_vector(F.array(-F.col("score"), F.col("score"))).alias("rawPrediction"),
                    F.col("label").cast("double").alias("label"))
    t = time.time()
    ref = BinaryClassificationEvaluator(numBins=0).evaluate(raw)
    b = time.time() - t
    print(f"auc_exact {ours:.12f} {a:.1f}s | spark exact {ref:.12f} {b:.1f}s | diff {abs(ours - ref):.1e}")

    pv = spark.range(0, n, 1, 32).select(
        e.alias("k"), (e * 7 % 18).alias("pregnancies"),
        F.when(e % 23 == 0, 0).otherwise(60 + e * 37 % 141).alias("glucose"),
        F.when(e % 19 == 0, 0).otherwise(50 + e * 13 % 101).alias("blood_pressure"),
        (e * 29 % 61).alias("skin_thickness"), (e * 53 % 401).alias("insulin"),
        ((150 + e * 41 % 301) / 10.0).alias("bmi"), ((80 + e * 17 % 1401) / 1000.0).alias("dpf"),
        (21 + e * 11 % 61).alias("age"),
        F.when(e % 5 == 0, None).otherwise((e * 37 % 1000) / 1000.0).alias("lr_prob"),
        F.when((e % 5 == 0) | (e % 7 == 0), None).otherwise((e * 53 % 700) / 1000.0).alias("rf_prob"))
    c = scoring.consensus(rule_score_a(
        pv.withColumns({"lr_pred": threshold("lr_prob"), "rf_pred": threshold("rf_prob")}), with_status=True))
    t = time.time()
    rows = c.groupBy("source", "verdict").count().collect()
    print(f"verdict counts over {n:,} rows {time.time() - t:.1f}s", sorted(tuple(r) for r in rows))

    from riskloom.plans import catalog, training
    fit = training.fit_task(spark, catalog.patient_inputs(spark, "/root/testdata/sf0.01"), "k", "outcome",
                            "diabetes", tune_models=False)
    scored = scoring.score_all(pv.drop("lr_prob", "rf_prob"), "diabetes", fit.models, "k")
    t = time.time()
    rows = scored.groupBy("source", "verdict").count().collect()
    print(f"LR+RF pipelines + rules + verdict over {n:,} rows {time.time() - t:.1f}s", sorted(tuple(r) for r in rows))


if __name__ == "__main__":
    main()
