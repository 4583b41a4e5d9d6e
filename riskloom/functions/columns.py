"""Column -> Column helpers (all JVM-side built-ins, codegen friendly).

Comparisons that the reference makes in Python follow Python's rules for
NaN: every ordered comparison with NaN is false.  Spark orders NaN above
every number, so the ``>``/``>=`` helpers guard with ``isnan``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.ml.functions import vector_to_array

from riskloom import schemas


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _nan(c: Column) -> Column:
    # isnan is false for null and for non-floating values.
    return F.isnan(c)


def py_gt(c, v) -> Column:
    c = col(c)
    return (c > v) & ~_nan(c)


def py_ge(c, v) -> Column:
    c = col(c)
    return (c >= v) & ~_nan(c)


def py_lt(c, v) -> Column:
    return col(c) < v


def py_le(c, v) -> Column:
    return col(c) <= v


def dlit(v: float) -> Column:
    """A double literal (SQL text would make a DECIMAL)."""
    return F.lit(float(v)).cast("double")


def nonzero(c) -> Column:
    """``c != 0``; null stays null, which a filter treats as false."""
    return col(c) != 0


def nonzero_values(c) -> Column:
    """``c`` where it is not zero, else null."""
    return F.when(nonzero(c), col(c))


def binary_encode(c, positive: str) -> Column:
    """1 where ``c`` equals ``positive`` (case-sensitive), else 0; null -> 0."""
    return F.when(col(c) == F.lit(positive), F.lit(1)).otherwise(F.lit(0))


def positive_prob(c="probability") -> Column:
    """Positive-class probability: element 1 of the probability vector."""
    return vector_to_array(col(c))[1]


def threshold(p, t: float = schemas.MODEL_THRESHOLD) -> Column:
    """1 if ``p >= t`` else 0, as Python would decide; null stays null."""
    p = col(p)
    return F.when(p.isNull(), F.lit(None).cast("int")).when(py_ge(p, t), F.lit(1)).otherwise(F.lit(0))


def clamp(p, lo: float = schemas.PROB_CLAMP[0], hi: float = schemas.PROB_CLAMP[1]) -> Column:
    """``max(lo, min(hi, p))``; null stays null (``greatest`` would skip it)."""
    p = col(p)
    return F.when(p.isNull(), F.lit(None).cast("double")).otherwise(
        F.greatest(dlit(lo), F.least(dlit(hi), p)))


def mean_prob(*probs, default: float = schemas.NO_MODEL_MEAN) -> Column:
    """Mean of the non-null probabilities; ``default`` when none answered."""
    cols = [col(p) for p in probs]
    n = sum((F.when(c.isNotNull(), F.lit(1)).otherwise(F.lit(0)) for c in cols), F.lit(0))
    s = F.lit(0.0)
    for c in cols:
        s = s + F.coalesce(c, F.lit(0.0))
    return F.when(n == 0, dlit(default)).otherwise(s / n)


def vote_count(*preds) -> Column:
    """Number of models whose thresholded prediction is 1."""
    return sum((F.when(col(p) == 1, F.lit(1)).otherwise(F.lit(0)) for p in preds), F.lit(0))


def label_text(pred, yes: str = "Positive", no: str = "Negative") -> Column:
    p = col(pred)
    return F.when(p == 1, F.lit(yes)).when(p.isNotNull(), F.lit(no))


def risk_text(pred) -> Column:
    return label_text(pred, "High Risk", "Low Risk")


def percent_text(p) -> Column:
    """``{p:.1%}`` text as Python writes it: ``p * 100`` in doubles, then
    rounded on its exact binary value, exact ties to even (0.0625 -> 6.2%,
    0.0635 -> 6.3%, 0.0005 -> 0.1%).  ``format_number`` (Java's
    ``DecimalFormat``) rounds that way; ``format_string`` and ``bround`` round
    the shortest decimal form instead and differ near ties.  Grouping commas
    (only above 1000%) are removed."""
    return F.concat(F.regexp_replace(F.format_number(col(p) * F.lit(100.0), 1), ",", ""), F.lit("%"))


def decode_flag(c, yes: str = "Yes", no: str = "No") -> Column:
    c = col(c)
    return F.when(c == 1, F.lit(yes)).when(c.isNotNull(), F.lit(no))
