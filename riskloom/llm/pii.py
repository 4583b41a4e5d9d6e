"""Personal data (operator 3): patterns propose, checksums confirm, context words adjust.

Built-in SQL functions only; every text is one row of a projection, with
no shuffle.  Base kinds are email, ip, card and phone; the method adds
``iban`` (mod-97) and ``ssn`` (kept only where a context word stands near).

Each span has a score: a start value by kind, more where a checksum holds,
more where a context word stands within ``CONTEXT_CHARS`` code points
before or after it.  Base spans stay whatever their score; added ones need
``MIN_SCORE``.

Defined results: null text counts as empty; an empty text has no spans and
the digest of the empty string; repeated rows are scanned row by row; an
empty table gives an empty table; only the named columns are read, so
extra columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.spans import cut, joined, replaced, spans, without

CONTEXT_CHARS = 40
MIN_SCORE = 0.6

#: Digits with single separators between: what lies between such chains.  The
#: text is padded with two letters on each side, so chains never touch an end.
_BETWEEN_CHAINS = r"[^0-9]{2,}+|[^0-9 -]"

_DIGITS = "translate(m, ' -', '')"
_LUHN = (
    f"aggregate(sequence(1, length({_DIGITS})), 0, (a, i) -> a + "
    f"if(i % 2 = 1, int(substr({_DIGITS}, length({_DIGITS}) - i + 1, 1)), "
    f"int((2 * int(substr({_DIGITS}, length({_DIGITS}) - i + 1, 1))) / 10) + (2 * int(substr({_DIGITS}, length({_DIGITS}) - i + 1, 1))) % 10)) % 10 = 0"
)
_IBAN = "translate(m, ' ', '')"
_MOD97 = (
    f"aggregate(split(concat(substr({_IBAN}, 5), substr({_IBAN}, 1, 4)), ''), 0, (a, c) -> "
    "if(c = '', a, if(c between '0' and '9', (a * 10 + ascii(c) - 48) % 97, (a * 100 + ascii(c) - 55) % 97))) = 1"
)

#: kind -> (pattern, condition on the match m).  The first four are the base kinds, in order.
KINDS: dict[str, tuple[str, str]] = {
    "email": (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "true"),
    "ip": (
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        "forall(split(m, '[.]'), p -> length(ltrim('0', p)) <= 3 and int(right(p, 3)) <= 255)",
    ),
    "card": ("", f"case when length(m) between 16 and 37 and length({_DIGITS}) between 16 and 19 then {_LUHN} else false end"),
    "phone": (r"\+[0-9][ ().0-9-]+[0-9]", "length(translate(m, '+ ().-', '')) between 8 and 15"),
    "iban": (
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
        f"case when length({_IBAN}) between 15 and 34 then {_MOD97} else false end",
    ),
    "ssn": (r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])", "substr(m, 1, 3) not in ('000', '666') and substr(m, 1, 1) <> '9'"),
}
BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn")

#: kind -> (score of a valid match, added with a context word near, the words).
SCORES: dict[str, tuple[float, float, tuple[str, ...]]] = {
    "email": (0.8, 0.2, ("mail", "contact", "write")),
    "ip": (0.5, 0.4, ("ip", "server", "host", "address")),
    "card": (0.8, 0.2, ("card", "visa", "credit", "pay")),
    "phone": (0.6, 0.3, ("phone", "call", "tel", "mobile", "fax")),
    "iban": (0.9, 0.1, ("iban", "bank", "account")),
    "ssn": (0.3, 0.5, ("ssn", "social security", "social insurance")),
}


def _cuts(text: str, kind: str) -> Column:
    return cut(text, KINDS[kind][0]) if kind != "card" else cut(f"concat('xx', {text}, 'xx')", _BETWEEN_CHAINS)


def _turned(name: str) -> Column:
    """The card pattern cuts out what lies between chains: matches and parts change places."""
    return F.expr(f"named_struct('parts', {name}.found, 'found', slice({name}.parts, 2, size({name}.found) - 1))")


def _scored(found: str, kind: str) -> Column:
    start, more, words = SCORES[kind]
    near = f"lower(substring(text, greatest(s.start + 1 - {CONTEXT_CHARS}, 1), least(s.start, {CONTEXT_CHARS}) + s.end - s.start + {CONTEXT_CHARS}))"
    hit = " or ".join(f"contains({near}, '{w}')" for w in words)
    return F.expr(f"transform({found}, s -> struct(s.kind as kind, s.start as start, s.end as end, cast({start} + if({hit}, {more}, 0) as double) as score))")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, base, all): spans of each text as arrays of struct(kind, start, end, score).

    ``base`` holds the base kinds, ``all`` also the added ones that reach
    ``MIN_SCORE``; both by kind as listed, then start.
    """
    df = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kinds = BASE + ADDED
    df = df.select("*", *(_cuts("text", k).alias(f"c_{k}") for k in kinds))
    df = df.withColumn("c_card", _turned("c_card"))
    df = df.select("doc_id", "text", *(spans(f"c_{k}", k, KINDS[k][1], shift=2 * (k == "card")).alias(f"s_{k}") for k in kinds))
    df = df.select("doc_id", "text", *(_scored(f"s_{k}", k).alias(k) for k in kinds))
    added = F.filter(F.concat(*ADDED), lambda s: s["score"] >= MIN_SCORE)
    return df.select("doc_id", "text", F.concat(*BASE).alias("base"), F.concat(*BASE, added).alias("all"))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, the digest of the base spans and all spans of every document."""
    df = find(docs, id_col, text_col)
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) as long)").alias(f"n_{k}") for k in BASE]
    return df.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("all").alias("spans"), F.expr("transform(all, s -> s.score)").alias("scores"))


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every accepted span of the text replaced by ``[KIND]``; all other columns stay.

    The text is cut at all spans of ``find()``; overlapping ones go as one,
    under the kind of the first.  A null text stays null.  What only a
    replacement lets stand alone (a card number once the address before it
    is gone) is replaced after that, kind by kind; ``ssn`` is not, as its
    context words count in the whole text only.
    """
    columns, tmp = docs.columns, "riskloom_pii_cuts"
    rows = docs.select(F.struct(*(docs[f"`{c}`"] for c in columns)).alias("row"), docs[f"`{text_col}`"].alias("text"))
    out = find(rows, "row").select(F.col("doc_id").alias("row"), F.when(F.size("all") > 0, without("text", "all")).alias("text"))
    for kind in BASE + ("iban",):
        out = out.withColumn(tmp, _cuts("text", kind))
        if kind == "card":
            out = out.withColumn(tmp, _turned(tmp))
        out = out.withColumn(f"{tmp}_new", replaced(tmp, KINDS[kind][1], f"[{kind.upper()}]"))
        new = F.col(f"{tmp}_new")
        if kind == "card":  # the padding of two letters on each side goes again
            new = F.expr(f"substr({tmp}_new, 3, char_length({tmp}_new) - 4)")
        out = out.withColumn("text", F.when(F.size(F.col(f"{tmp}.found")) == 0, F.col("text")).otherwise(new)).select("row", "text")
    old = {c: F.col("row").getField(c) for c in columns}
    return out.select(*((F.coalesce("text", old[c]) if c == text_col else old[c]).alias(c) for c in columns))
