"""Addition order of the heart rule over its whole band grid.

Every combination of bands (5 age bands, 8 two-way terms, 4 three-way
terms = 103,680 points) is built in Spark from one ``range`` by mixed-radix
digits.  The score must equal adding the chosen increments left to right in
doubles, and the number of points where that double sum and the exact
decimal sum fall on different sides of 0.5 (0.3) must be 23 (15).
"""

from fractions import Fraction

from pyspark.sql import functions as F

from riskloom.functions.rules import rule_score_b

# Input value per band, and the increment that band adds, in term order.
AGE = [(30, -0.05), (45, 0.05), (55, 0.15), (65, 0.25), (75, 0.3)]
TWO_WAY = {  # column: (value that adds, increment)
    "gender": (1, 0.1), "diabetes": (1, 0.15), "hypertension": (1, 0.15), "obesity": (1, 0.1),
    "smoking": (1, 0.2), "family_history": (1, 0.15), "physical_activity": (1, -0.1),
}
CHOL = [(250, 0.15), (220, 0.1), (180, 0.0)]
HDL = [(30, 0.1), (70, -0.05), (50, 0.0)]
LDL = [(170, 0.15), (140, 0.1), (100, 0.0)]
BP = [((150, 80), 0.15), ((135, 80), 0.1), ((120, 70), 0.0)]
STRESS = [(9, 0.1), (5, 0.0)]
ORDER = ["age", "gender", "diabetes", "hypertension", "obesity", "smoking", "cholesterol", "hdl", "ldl",
         "bp", "family_history", "stress", "physical_activity"]
RADIX = {"age": 5, "cholesterol": 3, "hdl": 3, "ldl": 3, "bp": 3, "stress": 2, **{c: 2 for c in TWO_WAY}}


def digits(i: int) -> dict:
    out = {}
    for name in ORDER:
        out[name] = i % RADIX[name]
        i //= RADIX[name]
    return out


def increments(d: dict) -> list[float]:
    incs = []
    for name in ORDER:
        if name == "age":
            incs.append(AGE[d[name]][1])
        elif name in TWO_WAY:
            incs.append(TWO_WAY[name][1] if d[name] == 0 else 0.0)
        else:
            table = {"cholesterol": CHOL, "hdl": HDL, "ldl": LDL, "bp": BP, "stress": STRESS}[name]
            incs.append(table[d[name]][1])
    return incs


def test_heart_grid_addition_order(spark):
    n = 1
    for name in ORDER:
        n *= RADIX[name]
    assert n == 103680
    i = F.col("id")
    cols, div = {}, 1
    for name in ORDER:
        cols[name] = (i / div).cast("long") % RADIX[name]
        div *= RADIX[name]
    g = spark.range(n).select("id", *[c.alias(f"d_{k}") for k, c in cols.items()])

    def pick(digit, values):
        expr = None
        for j, v in enumerate(values):
            expr = F.when(F.col(digit) == j, F.lit(v)) if expr is None else expr.when(F.col(digit) == j, F.lit(v))
        return expr

    inputs = {
        "age": pick("d_age", [v for v, _ in AGE]),
        **{c: pick(f"d_{c}", [v, 1 - v]) for c, (v, _) in TWO_WAY.items()},
        "cholesterol": pick("d_cholesterol", [v for v, _ in CHOL]),
        "hdl": pick("d_hdl", [v for v, _ in HDL]), "ldl": pick("d_ldl", [v for v, _ in LDL]),
        "systolic_bp": pick("d_bp", [s for (s, _), _ in BP]), "diastolic_bp": pick("d_bp", [d for (_, d), _ in BP]),
        "stress": pick("d_stress", [v for v, _ in STRESS]),
        "alcohol": F.lit(0), "diet_score": F.lit(3), "triglycerides": F.lit(150), "pollution": F.lit(0),
        "healthcare": F.lit(0),
    }
    scored = rule_score_b(g.select("id", *[c.alias(k) for k, c in inputs.items()]), with_status=True)
    got = {r.id: (r.rule_prob, r.rule_status) for r in scored.select("id", "rule_prob", "rule_status").collect()}

    flips_05 = flips_03 = 0
    for idx in range(n):
        incs = increments(digits(idx))
        s = 0.15
        for x in incs:
            s = s + x
        exact = Fraction("0.15") + sum(Fraction(str(x)) for x in incs)
        prob, status = got[idx]
        assert status == "scored"
        assert prob == max(0.05, min(0.95, s)), idx
        flips_05 += (s >= 0.5) != (exact >= Fraction(1, 2))
        flips_03 += (s >= 0.3) != (exact >= Fraction(3, 10))
    assert (flips_05, flips_03) == (23, 15)
