"""Sums that do not depend on the order of rows."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from riskloom.operators import exact, features, profile


def test_means_do_not_depend_on_the_layout(spark):
    rnd = random.Random(1)
    rows = [(rnd.uniform(-1, 1) * 10.0 ** rnd.randint(-9, 9), rnd.gauss(0, 1e-200), i * 3, None if i % 2 else 0.1) for i in range(3000)]
    df = spark.createDataFrame(rows, "a double, b double, c long, d double")
    cols = {c: F.col(c) for c in "abcd"}
    seen = []
    for n in (1, 4, 8):
        d = df.repartition(n)
        row = d.sparkSession.range(1).select(exact.means(d, cols).alias("m")).first().m
        n_rows, m = exact.moments(d, {c: F.col(c) for c in "acd"})
        seen.append((*row, n_rows, *[exact.mean_std(*x) for x in m.values()], *map(tuple, profile.scaler_stats(d, ["a", "c", "d"]).collect())))
    assert seen[0] == seen[1] == seen[2]
    for k, c in enumerate("abc"):
        held = [Fraction(r[k]) for r in rows]
        assert row[c] == pytest.approx(float(sum(held) / len(held)), rel=1e-13)
    assert row.d == 0.1
    mean, std = exact.mean_std(*m["a"])
    held = [r[0] for r in rows]
    assert std == pytest.approx(math.sqrt(sum((x - mean) ** 2 for x in held) / (len(held) - 1)), rel=1e-12)


def test_means_of_odd_values(spark):
    df = spark.createDataFrame([(0.0, None, math.inf, math.nan, 5e-324, 1.7e308), (-0.0, None, 1.0, 1.0, 5e-324, 1.7e308)], "z double, n double, i double, q double, t double, h double")
    m = spark.range(1).select(exact.means(df, {c: F.col(c) for c in df.columns}).alias("m")).first().m
    assert m.z == 0 and m.n is None and m.i == math.inf and math.isnan(m.q) and abs(m.t) < 1e-300 and m.h == pytest.approx(1.7e308)
    empty = spark.range(1).select(exact.means(df.limit(0), {c: F.col(c) for c in df.columns}).alias("m")).first().m
    assert all(x is None for x in empty)
    with pytest.raises(ValueError, match="infinite"):
        exact.moments(df, {"i": F.col("i")})


def test_scaler_is_the_same_from_any_layout(spark):
    df = spark.range(500).select(F.col("id").alias("k"), (F.sin("id") * 1e6).alias("a"), F.lit(7).alias("c"))
    made = [features.standardize(df.repartition(n), ["a", "c"])[1] for n in (1, 4, 8)]
    assert len({(tuple(m.mean), tuple(m.std)) for m in made}) == 1
    assert made[0].std[1] == 0 and made[0].mean[1] == 7


def test_scaling_bits(spark):
    rows = spark.createDataFrame([(0.0,), (1.0,), (0.75,), (3.0,), (1e308,), (1e-320,), (None,), (math.inf,)], "x double")
    assert [r[0] for r in rows.select(exact.scale_bits(F.col("x"))).collect()] == [0, 1, 0, 2, 1000, -900, 0, 0]
