"""Dataset statistics (O-23 .. O-27).

Every statistic is a fixed number of aggregate passes: partial aggregates
per task, a single-row merge.  Long (one row per column) outputs come from ``stack``
over that single row, never from a loop of jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.columns import nonzero_values
from riskloom.operators import exact


def row_count(df: DataFrame) -> DataFrame:
    """O-23: one row, ``n``."""
    return df.agg(F.count(F.lit(1)).alias("n"))


def _stack(wide: DataFrame, cols: list[str], stats: list[str]) -> DataFrame:
    parts = ", ".join(
        f"'{c}', " + ", ".join(f"`{c}__{s}`" for s in stats) for c in cols)
    names = ", ".join(["column_name"] + stats)
    return wide.selectExpr(f"stack({len(cols)}, {parts}) AS ({names})")


def nonzero_mean(df: DataFrame, cols: list[str]) -> DataFrame:
    """O-24 long form: (column_name, nonzero_mean, n_nonzero)."""
    counts = df.agg(*[F.count(nonzero_values(c)).alias(f"{c}__n_nonzero") for c in cols])
    m = exact.means(df, {c: nonzero_values(c) for c in cols})
    wide = counts.withColumn("__m", m).withColumns({f"{c}__nonzero_mean": F.col("__m")[c] for c in cols})
    return _stack(wide, cols, ["nonzero_mean", "n_nonzero"])


def schema_report(df: DataFrame) -> list[tuple[str, str, bool]]:
    """O-25: (name, type, nullable) per column.  Metadata only, no job."""
    return [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]


def dataset_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """O-23/O-25 numbers: per numeric column n, nulls, zeros, min, max, mean."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    aggs = []
    for c in cols:
        x = F.col(c)
        aggs += [
            F.count(F.lit(1)).alias(f"{c}__n"),
            F.count(F.when(x.isNull(), F.lit(1))).alias(f"{c}__n_null"),
            F.count(F.when(x == 0, F.lit(1))).alias(f"{c}__n_zero"),
            F.min(x).cast("double").alias(f"{c}__min_value"),
            F.max(x).cast("double").alias(f"{c}__max_value"),
            F.avg(x).cast("double").alias(f"{c}__mean_value"),
        ]
    return _stack(df.agg(*aggs), cols, ["n", "n_null", "n_zero", "min_value", "max_value", "mean_value"])


def sample_head(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """O-26: first ``n`` rows by ``key`` (top-k per task, then a merge)."""
    return df.orderBy(F.col(key)).limit(n)


def scaler_stats(df: DataFrame, cols: list[str]) -> DataFrame:
    """O-27 long form: (column_name, mean, std) with sample std.

    Deviations are taken from the mean, so nothing cancels; both sums are
    independent of the order of rows.
    """
    m = exact.means(df, {c: F.col(c) for c in cols})
    apart = df.withColumn("__m", m)
    squares = exact.means(apart, {c: (F.col(c).cast("double") - F.col("__m")[c]) * (F.col(c).cast("double") - F.col("__m")[c]) for c in cols})
    wide = df.agg(*[F.count(c).alias(f"{c}__n") for c in cols]).withColumns({"__m": m, "__s": squares})
    for c in cols:
        n = F.col(f"{c}__n")
        wide = wide.withColumns({f"{c}__mean": F.col("__m")[c], f"{c}__std": F.when(n > 1, F.sqrt(F.col("__s")[c] * n / (n - 1)))})
    return _stack(wide, cols, ["mean", "std"])
