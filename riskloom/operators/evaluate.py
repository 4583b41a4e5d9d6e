"""Model evaluation: exact AUC, accuracy, winner choice (O-37, O-38, O-41).

Exact AUC without one task that sees all rows
---------------------------------------------
AUC = sum over positives of (negatives scored lower + half the negatives
scored equal) / (P * N), which is the rank-sum statistic with tied ranks
averaged.  It needs, for every distinct score, the number of negatives
below it: a prefix sum in score order.

1. collapse to distinct scores, ``(group, score) -> (count, positives)``;
   a partial aggregate, so a score that holds a third of all rows becomes
   one row per task before the shuffle;
2. range-partition these by (group, score) and write them with the number
   of their partition.  Spark bounds the sample it takes for the ranges;
   the input is evaluated once, and a rerun cannot renumber anything;
3. prefix sums inside each (group, partition) by a window, then offsets
   over the partitions' totals (groups x partitions rows);
4. sum the contributions per group.

Contributions are summed twofold as ``decimal(38,0)``, so the sums are
exact and the one division at the end is the only rounding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import scratch_path

_EXACT = "decimal(38,0)"


def score_counts(df: DataFrame, score: str, label: str, by: list[str], weight: str | None = None) -> DataFrame:
    """(*by, __s, c, p): rows and positives of each distinct score; null scores or labels are ignored.

    ``weight`` names a column of row counts, where ``df`` is counted already.
    """
    w = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    rows = (df.select(*by, F.col(score).cast("double").alias("__s"), F.col(label).cast("double").alias("__y"), w.alias("__w"))
            .where(F.col("__s").isNotNull() & F.col("__y").isNotNull()))
    return rows.groupBy(*by, "__s").agg(F.sum("__w").alias("c"),
                                        F.sum(F.when(F.col("__y") == 1, F.col("__w")).otherwise(0)).alias("p"))


def auc_exact(df: DataFrame, score: str, label: str, by: list[str] | None = None, out: str = "auc",
              weight: str | None = None) -> DataFrame:
    """Exact area under ROC per group of ``by`` (one row per group).

    Columns: ``*by, out, n, n_pos``.  Label 1 is positive; null scores or
    labels are ignored; a group without both classes gets a null AUC.
    """
    by = list(by or [])
    spark = df.sparkSession
    counts = score_counts(df, score, label, by, weight).repartitionByRange(*by, "__s").withColumn("__b", F.spark_partition_id())
    path = scratch_path(spark, "auc-scores")
    counts.write.parquet(path)
    pts = spark.read.schema(counts.schema).parquet(path).withColumn("neg", F.col("c") - F.col("p"))

    # Inside each partition: negatives at lower scores; ties count half.
    w_in = Window.partitionBy(*by, "__b").orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("neg").over(w_in), F.lit(0))
    twice = F.col("p").cast("decimal(18,0)") * (2 * below + F.col("neg")).cast("decimal(19,0)")
    per_part = (pts.withColumn("u", twice.cast(_EXACT)).groupBy(*by, "__b")
                .agg(F.sum("u").alias("u"), F.sum("p").alias("pb"), F.sum("neg").alias("nb"), F.sum("c").alias("cb")))

    # Across partitions: positives of one are above every negative of the earlier ones.
    w_b = Window.partitionBy(*by).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("nb").over(w_b), F.lit(0))
    above = (F.col("pb").cast("decimal(18,0)") * (2 * before).cast("decimal(19,0)")).cast(_EXACT)
    agg = per_part.withColumn("u", F.col("u") + above).groupBy(*by).agg(
        F.sum("u").alias("__u"), F.sum("cb").alias("n"), F.sum("pb").alias("n_pos"))
    pairs = (F.col("n_pos").cast("decimal(18,0)") * (F.col("n") - F.col("n_pos")).cast("decimal(18,0)")).cast(_EXACT)
    value = F.col("__u").cast("double") / (2 * pairs).cast("double")
    return agg.select(*by, F.when(pairs > 0, value).alias(out), "n", "n_pos")


def auc_binned(counts: DataFrame, num_bins: int = 1000) -> float:
    """Spark's ``BinaryClassificationEvaluator`` AUC (approximate above
    ``num_bins`` distinct scores) from (__s, c, p) counts: one number."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.functions import array_to_vector
    s = F.col("__s")
    kinds = F.array(F.struct(F.lit(1.0).alias("label"), F.col("p").cast("double").alias("w")),
                    F.struct(F.lit(0.0).alias("label"), (F.col("c") - F.col("p")).cast("double").alias("w")))
    raw = counts.select(array_to_vector(F.array(-s, s)).alias("rawPrediction"), F.explode(kinds).alias("x"))
    raw = raw.select("rawPrediction", "x.label", "x.w").where("w > 0")
    return float(BinaryClassificationEvaluator(numBins=num_bins, weightCol="w").evaluate(raw))


def accuracy(df: DataFrame, pred: str, label: str, by: list[str] | None = None, out: str = "accuracy") -> DataFrame:
    """Share of rows with ``pred == label`` per group (null pairs ignored)."""
    by = list(by or [])
    ok = F.when(F.col(pred).isNull() | F.col(label).isNull(), F.lit(None)).otherwise(
        (F.col(pred).cast("double") == F.col(label).cast("double")).cast("double"))
    return df.groupBy(*by).agg(F.avg(ok).alias(out), F.count(ok).alias("n"))


def pick_best(metrics: DataFrame, task: str = "task", model: str = "model", metric: str = "auc",
              preferred: str = "logistic_regression") -> DataFrame:
    """Add ``is_best``: highest metric per task; on a tie ``preferred`` wins
    (another model must be strictly better to replace it)."""
    w = Window.partitionBy(task).orderBy(F.col(metric).desc_nulls_last(),
                                         F.when(F.col(model) == preferred, 0).otherwise(1), F.col(model))
    return metrics.withColumn("is_best", F.row_number().over(w) == 1)
