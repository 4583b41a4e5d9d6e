"""Projections, filters and cleaning (O-09 .. O-17).

All of these are narrow (map-side) except ``zero_impute`` without given
means, which needs one global aggregate: a partial aggregate per task and
a one-row final merge, used as a scalar subquery, so the plan stays lazy,
has no join, and nothing is collected by our code.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.columns import binary_encode as _binary_encode_col
from riskloom.functions.columns import nonzero_values
from riskloom.operators import exact
from riskloom.functions.rules import fill_absent  # noqa: F401  (re-exported, O-17)


def select_cols(df: DataFrame, cols: list[str]) -> DataFrame:
    """O-09: keep ``cols`` by name, in that order."""
    return df.select(*[F.col(c) for c in cols])


def drop_ids(df: DataFrame, cols: list[str]) -> DataFrame:
    """O-10: drop identifier columns (absent names are ignored)."""
    return df.drop(*cols)


def drop_null_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """O-11: drop rows with a null (or NaN) in any column of ``subset``
    (default: every column, label included).

    Same rows as ``df.na.drop(how="any")``, but written as ``IS NOT NULL``
    predicates, which Catalyst can use: after an outer join they turn it
    into an inner join and reach the parquet scans as pushed filters.
    """
    cols = df.columns if subset is None else subset
    types = dict(df.dtypes)
    conds = []
    for c in cols:
        cond = F.col(c).isNotNull()
        if types.get(c) in ("double", "float"):
            cond = cond & ~F.isnan(F.col(c))
        conds.append(cond)
    return df.where(reduce(lambda a, b: a & b, conds)) if conds else df


def feature_cols(df: DataFrame, label: str) -> list[str]:
    """O-15: every column except the label, in schema order."""
    return [c for c in df.columns if c != label]


def nonzero_means(df: DataFrame, cols: list[str]) -> DataFrame:
    """O-24: one row, one column per input: mean of the non-zero values.

    All columns together (they are independent), not one job per column;
    the sums do not depend on the order of rows.
    """
    stats = exact.means(df, {c: nonzero_values(c) for c in cols})
    return df.sparkSession.range(1).select(stats.alias("m")).select("m.*")


def _impute_expr(c: str, mean: Column) -> Column:
    # null == 0 is null, so ``otherwise`` keeps a null input null.
    return F.when(F.col(c) == 0, mean).otherwise(F.col(c))


def zero_impute(df: DataFrame, cols: list[str], means: dict | None = None) -> DataFrame:
    """O-13: replace 0 by the column's mean of non-zero values.

    With ``means`` given (e.g. fitted on the training split) this is a pure
    projection.  Without, all means come from one scalar subquery over
    ``df`` (a struct with one field per column) whose single row is inlined
    into the projection (no join); see ``exact`` for its passes.  A
    column that is all zero gets a null mean, so its zeros become null.
    Imputed columns are double.
    """
    if means is not None:
        return df.withColumns({c: _impute_expr(c, F.lit(means.get(c)).cast("double")) for c in cols})
    stats = exact.means(df, {c: nonzero_values(c) for c in cols})
    # Project the struct once: every column then reads the same subquery.
    staged = df.withColumn("__nz_means", stats)
    return staged.withColumns({c: _impute_expr(c, F.col("__nz_means")[c]) for c in cols}).drop("__nz_means")


def binary_encode(df: DataFrame, c: str, positive: str, out: str | None = None) -> DataFrame:
    """O-14: ``positive`` -> 1, anything else (null too) -> 0."""
    return df.withColumn(out or c, _binary_encode_col(c, positive))


def violations(bounds: dict) -> Column:
    """Array of the names of columns outside their inclusive bounds.

    A null counts as a violation (it is not a valid form input)."""
    flags = [F.when(~F.coalesce(F.col(c).between(lo, hi), F.lit(False)), F.lit(c)) for c, (lo, hi) in bounds.items()]
    return F.filter(F.array(*flags), lambda x: x.isNotNull())


def range_check(df: DataFrame, bounds: dict, out: str = "violations") -> DataFrame:
    """O-16: add the violated column names (``array<string>``) and ``valid``."""
    return df.withColumn(out, violations(bounds)).withColumn("valid", F.size(F.col(out)) == 0)


def range_split(df: DataFrame, bounds: dict) -> tuple[DataFrame, DataFrame]:
    """O-16: (valid rows, rejected rows with their violations)."""
    checked = range_check(df, bounds)
    return checked.where("valid").drop("violations", "valid"), checked.where(~F.col("valid"))
