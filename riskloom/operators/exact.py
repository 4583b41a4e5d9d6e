"""Sums that do not depend on the order of rows (O-13, O-20, O-27).

A sum of doubles depends on the order in which partial results arrive, so
means and deviations, and all that is fitted on them, could differ in the
last bit between runs.  Here every value is cut into whole numbers
("limbs") of ``LIMB_BITS`` bits against one power of two at or above the
largest absolute value, and the limbs are summed as longs, which is exact
in any order.  ``LIMBS`` limbs keep 88 bits below the largest value; what
a value has beneath that is rounded off the same way wherever its row is.

``moments`` takes two aggregate passes, each with partial aggregation and a
single row as result: the largest absolute values (and the row count), then
the limbs.  ``means`` takes one: each value is cut against the next power of
2**LIMB_BITS above itself, so its limbs lie on one grid whatever the largest
value is, and nothing is rounded off; limbs are summed by column and power
(some hundred rows), then by their place on the grid.
Longs hold the limbs of 2**40 rows.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LIMB_BITS = 22
LIMBS = 4
_STEP = float(1 << LIMB_BITS)
#: Powers of two that may scale a double without running out of its range.
_LEAST, _MOST = -900, 1000


def scale_bits(largest: Column) -> Column:
    """Exponent of a power of two that is not much below ``largest``; 0 for 0, null, NaN and infinity."""
    usable = (largest > 0) & (largest < F.lit(math.inf))
    bits = F.floor(F.log2(F.when(usable, largest))) + 1
    return F.least(F.greatest(F.coalesce(bits, F.lit(0)), F.lit(_LEAST)), F.lit(_MOST)).cast("int")


def limbs(x: Column, bits: Column) -> list[Column]:
    """The limbs of ``x``, highest first (null stays null)."""
    y, out = x.cast("double") * F.pow(F.lit(2.0), -bits), []
    for _ in range(LIMBS):
        y = y * F.lit(_STEP)
        whole = F.rint(y)
        out.append(whole.cast("long"))
        y = y - whole
    return out


def _finite(x: Column) -> Column:
    """``x`` where it can be summed exactly."""
    return F.when(~F.isnan(x) & (F.abs(x) < F.lit(math.inf)), x)


def means(df: DataFrame, cols: dict[str, Column]) -> Column:
    """A lazy scalar subquery: struct of the mean of each expression over its non-null values.

    Whole-number columns take one pass, sums of longs.  NaN and infinite
    values give what adding them up gives.
    """
    names = list(cols)
    staged = df.select(*[e.alias(f"x_{i}") for i, e in enumerate(cols.values())])
    whole = [isinstance(f.dataType, T.IntegralType) for f in staged.schema.fields]
    if all(whole):  # longs add up exactly as they are
        one = staged.agg(*[F.sum(f"x_{i}").alias(f"s_{i}") for i in range(len(names))], *[F.count(f"x_{i}").alias(f"n_{i}") for i in range(len(names))])
        out = [(F.col(f"s_{i}").cast("double") / F.nullif(F.col(f"n_{i}"), F.lit(0))).alias(c) for i, c in enumerate(names)]
        return one.select(F.struct(*out)).scalar()
    none = F.lit(None)
    pairs = [F.struct((F.col(f"x_{i}") if w else none).cast("long").alias("w"), (none if w else F.col(f"x_{i}")).cast("double").alias("v")) for i, w in enumerate(whole)]
    each = staged.select(F.posexplode(F.array(*pairs)).alias("i", "x")).select("i", "x.w", "x.v").where("w is not null or v is not null")
    each = each.withColumn("top", grid_top(_finite(F.col("v"))))
    sums = [F.sum(limb).alias(f"s_{j}") for j, limb in enumerate(limbs(_finite(F.col("v")), F.col("top") * LIMB_BITS))]
    odd = F.sum(F.when(_finite(F.col("v")).isNull(), F.col("v"))).alias("odd")
    held = each.groupBy("i", "top").agg(F.count("*").alias("n"), F.sum("w").alias("w"), odd, *sums)
    held = held.select("i", "top", "n", "w", "odd", F.array(*[f"s_{j}" for j in range(LIMBS)]).alias("s"))
    one = held.agg(F.collect_list(F.struct("i", "top", "n", "w", "odd", "s")).alias("all"))
    out = []
    for i, c in enumerate(names):
        mine = _of_column(i)
        n = F.nullif(_total(mine, "n", "long"), F.lit(0))
        total = _total(mine, "w", "long").cast("double") / n if whole[i] else mean_on_grid(mine, n) + _total(mine, "odd", "double")
        out.append(total.alias(c))
    return one.select(F.struct(*out)).scalar()


def grid_top(x: Column) -> Column:
    """The power of 2**LIMB_BITS that is next above ``x``."""
    bits = scale_bits(F.abs(x))
    return F.least(F.greatest(F.ceil(bits / LIMB_BITS), F.lit(_LEAST // LIMB_BITS + 1)), F.lit(_MOST // LIMB_BITS + 1)).cast("int")


def _of_column(i: int) -> Column:
    return F.filter("all", lambda r: r["i"] == i)


def _total(rows: Column, field: str, kind: str) -> Column:
    return F.aggregate(rows, F.lit(0).cast(kind), lambda so_far, r: so_far + F.coalesce(r[field], F.lit(0).cast(kind)))


def mean_on_grid(rows: Column, n: Column) -> Column:
    """The mean that limbs summed by ``top`` stand for, worked out from the lowest place of the grid up."""
    tops = F.transform(rows, lambda r: r["top"])
    high = F.array_max(tops)
    places = F.sequence(F.array_min(tops) - (LIMBS - 1), high)

    def there(place):
        inside = F.filter(rows, lambda r: (r["top"] >= place) & (r["top"] - place < LIMBS))
        return F.aggregate(inside, F.lit(0).cast("long"), lambda so_far, r: so_far + F.coalesce(r["s"][r["top"] - place], F.lit(0).cast("long")))

    y = F.aggregate(places, F.lit(0.0), lambda so_far, place: (so_far + there(place).cast("double")) / F.lit(_STEP))
    return y / n * F.pow(F.lit(2.0), high * LIMB_BITS)


def moments(df: DataFrame, cols: dict[str, Column]) -> tuple[int, dict[str, tuple[int, Fraction, Fraction]]]:
    """(rows, {name: (non-null values, sum, sum of squares)}) as exact fractions, by two aggregate jobs.

    Squares are doubles rounded once.  A NaN or infinite value is an error.
    """
    x = {c: e.cast("double") for c, e in cols.items()}
    names = list(x)
    staged = df.select(*[e.alias(f"x_{i}") for i, e in enumerate(x.values())])
    v = [F.col(f"x_{i}") for i in range(len(names))]
    first = staged.agg(F.count(F.lit(1)), *[F.max(F.abs(_finite(c))) for c in v], *[F.count(F.when(_finite(c).isNull() & c.isNotNull(), F.lit(1))) for c in v]).first()
    rows, largest, odd = first[0], first[1 : len(v) + 1], first[len(v) + 1 :]
    for c, n in zip(names, odd):
        if n:
            raise ValueError(f"{n} values of {c} are NaN or infinite")
    bits = [min(max(math.frexp(m)[1], _LEAST // 2), _MOST // 2) if m else 0 for m in largest]
    aggs = []
    for c, b in zip(v, bits):
        aggs += [F.sum(p) for p in limbs(c, F.lit(b))] + [F.sum(p) for p in limbs(c * c, F.lit(2 * b))] + [F.count(c)]
    second, out, at = staged.agg(*aggs).first() if names else (), {}, 0
    for c, b in zip(names, bits):
        held = [x or 0 for x in second[at : at + 2 * LIMBS + 1]]
        at += 2 * LIMBS + 1
        whole = lambda sums, e: Fraction(sum(s << (LIMB_BITS * (LIMBS - 1 - j)) for j, s in enumerate(sums))) * Fraction(2) ** (e - LIMB_BITS * LIMBS)
        out[c] = (held[-1], whole(held[:LIMBS], b), whole(held[LIMBS : 2 * LIMBS], 2 * b))
    return rows, out


def mean_std(n: int, total: Fraction, squares: Fraction) -> tuple[float, float]:
    """Mean and sample deviation from exact moments, rounded once (deviation 0 below two values)."""
    if not n:
        return math.nan, math.nan
    spread = max(Fraction(0), squares - total * total / n)
    return float(total / n), math.sqrt(spread / (n - 1)) if n > 1 else 0.0
