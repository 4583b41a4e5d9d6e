"""Secret scans (operator 8): a trigram index picks the texts that each rule's pattern must read.

From each rule's pattern a Boolean query over trigrams is derived: every
match must contain, for each fixed stretch of the pattern, all trigrams of
one of the stretch's spellings.  The inverted index (trigram, document)
covers the trigrams that the rules ask for, lower-cased.  Postings are
intersected per document, the rules whose query holds become its
candidates, and only those patterns run on its text.  A rule without a
fixed stretch of three characters (here ``hex``) scans every text.

Built-in SQL functions only.  The index is written to the shared folder,
one folder per trigram, so a new rule over known trigrams reads just its
postings.  A trigram that a third of all texts contain is many small rows
keyed by document, never one list.

Defined results: null text counts as empty and has no spans; repeated rows
(also of one doc_id with different texts) are candidates together and
verified one by one; a null doc_id is a key like any other; an empty table
gives an empty table; only the named columns are read.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as parser

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.spans import cut, joined, spans
from riskloom.session import scratch_path

#: kind -> (pattern, group whose length counts, least length of it).  The first three are the base kinds, in order.
RULES: dict[str, tuple[str, int, int]] = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    "access": (r"AKIA[A-Z0-9]{16,}+", 0, 20),
    "hex": (r"[0-9a-f]{24,}+", 0, 24),
    "pem": (r"-----BEGIN (?:RSA |EC |OPENSSH |DSA )?PRIVATE KEY-----", 0, 1),
    "hosted": (r"(?<![A-Za-z0-9])gh[pousr]_[A-Za-z0-9]{36,}+", 0, 40),
}
BASE = ("assign", "access", "hex")

_MAX_SPELLINGS = 64


def _spell(node, limit: int = _MAX_SPELLINGS) -> set[str] | None:
    """All strings that a parsed piece can match, or None if they are not few."""
    op, arg = node
    if op is sre.LITERAL:
        return {chr(arg)}
    if op is sre.IN:
        if any(k is not sre.LITERAL for k, _ in arg) or len(arg) > 4:
            return None
        return {chr(v) for _, v in arg}
    if op is sre.SUBPATTERN:
        return _spell_all(arg[3], limit)
    if op is sre.BRANCH:
        found: set[str] = set()
        for x in arg[1]:
            one = _spell_all(x, limit)
            if one is None:
                return None
            found |= one
        return found if len(found) <= limit else None
    if op in (sre.MAX_REPEAT, sre.POSSESSIVE_REPEAT, sre.MIN_REPEAT) and arg[1] == 1:
        one = _spell_all(arg[2], limit)
        return None if one is None else one | ({""} if arg[0] == 0 else set())
    return {""} if op in (sre.ASSERT, sre.ASSERT_NOT, sre.AT) else None


def _spell_all(nodes, limit: int) -> set[str] | None:
    out = {""}
    for x in nodes:
        one = _spell(x, limit)
        if one is None or len(out) * len(one) > limit:
            return None
        out = {a + b for a in out for b in one}
    return out


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """AND over stretches of OR over spellings of the trigrams (lower case) that a match must contain.

    An empty list: no stretch is fixed for three characters, so the rule
    has no mandatory trigram and must scan.
    """
    query, run = [], {""}

    def close() -> None:
        if run != {""} and min(map(len, run)) >= 3:
            low = {x.lower() for x in run}
            query.append([frozenset(x[i : i + 3] for i in range(len(x) - 2)) for x in sorted(low)])

    for node in parser.parse(pattern):
        one = _spell(node)
        if one is None or len(run) * len(one) > _MAX_SPELLINGS:
            close()
            run = {""} if one is None else one
        else:
            run = {a + b for a in run for b in one}
    close()
    return query


def needed(rules: dict[str, tuple[str, int, int]] = RULES) -> list[str]:
    return sorted({t for p, *_ in rules.values() for s in trigram_query(p) for x in s for t in x})


def _quote(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def build_index(texts: DataFrame, trigrams: list[str]) -> str:
    """Write the postings (doc_id by trigram) of ``texts`` (doc_id, text); returns the path."""
    path = scratch_path(texts.sparkSession, "trigram-index")
    has = ", ".join(f"if(contains(low, {_quote(t)}), {_quote(t)}, null)" for t in trigrams)
    (
        texts.select("doc_id", F.lower("text").alias("low"))
        .select("doc_id", F.explode(F.expr(f"array_compact(array({has}))")).alias("trigram"))
        .write.partitionBy("trigram").parquet(path)
    )
    return path


def candidates(spark: SparkSession, path: str, rules: dict[str, tuple[str, int, int]] = RULES) -> DataFrame:
    """(doc_id, rules): per document the rules whose trigram query its postings satisfy.

    Per document at most as many postings meet as the rules have trigrams.
    """
    queries = {k: trigram_query(p) for k, (p, *_) in rules.items()}
    postings = spark.read.schema("doc_id long, trigram string").parquet(path)
    have = postings.groupBy("doc_id").agg(F.collect_set("trigram").alias("have"))
    hold = []
    for k, q in queries.items():
        if q:
            sets = [" or ".join("(" + " and ".join(f"array_contains(have, {_quote(t)})" for t in sorted(x)) + ")" for x in s) for s in q]
            hold.append(f"if({' and '.join(f'({s})' for s in sets)}, '{k}', null)")
    return have.select("doc_id", F.expr(f"array_compact(array({', '.join(hold)}))").alias("rules")).where(F.size("rules") > 0)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: dict[str, tuple[str, int, int]] = RULES) -> DataFrame:
    """(doc_id, text, all): accepted spans as array of struct(start, rank, end, kind, found), by start, then kind as listed."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    picked = candidates(docs.sparkSession, build_index(texts, needed(rules)), rules).select(F.col("doc_id").alias("c_id"), "rules")
    df = texts.join(picked.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("c_id")), "left").select("doc_id", "text", F.coalesce("rules", F.array().cast("array<string>")).alias("rules"))
    cols = []
    for k, (p, group, _) in rules.items():
        reads = f"if(array_contains(rules, '{k}'), text, '')" if trigram_query(p) else "text"
        cols.append(cut(reads, p, group).alias(f"c_{k}"))
    df = df.select("doc_id", "text", *cols)
    cols = []
    for rank, (k, (_, group, least)) in enumerate(rules.items()):
        cols.append(spans(f"c_{k}", k, f"length(c_{k}.inner[i]) >= {least}" if group else f"length(m) >= {least}", rank=rank))
    return df.select("doc_id", "text", F.array_sort(F.concat(*cols)).alias("all"))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, the digest of the base spans and all spans of every document."""
    df = find(docs, id_col, text_col)
    df = df.select("doc_id", "all", F.filter("all", lambda s: s["kind"].isin(*BASE)).alias("base"))
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) as long)").alias(f"n_{k}") for k in BASE]
    return df.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("all").alias("spans"))
