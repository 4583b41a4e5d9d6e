"""riskloom: risk-scoring analytics on Spark.

Cleaning, feature pipelines, keyed splits, tuned LR / RF models, exact
evaluation, rule-based fallback scores and consensus verdicts, as
DataFrame, Spark ML and Structured Streaming operations.  Operators take the
caller's ``SparkSession`` / ``DataFrame`` and return lazy DataFrames.

Entry points: ``riskloom.plans.jobs`` (prepare / train / serve),
``riskloom.operators.scoring.score_all``, ``riskloom.functions.rules``,
``riskloom.operators.evaluate.auc_exact``.
"""

__version__ = "0.1.0"
