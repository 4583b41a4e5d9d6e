"""Quality rules (operator 5): cross-document line frequency.

Lines are normalised (ASCII lower case, single spaces) and hashed.  Per
host the distinct documents that carry a line are counted; a line above
the limit, carried by documents that are otherwise unlike one another, is
boilerplate and is removed.  A document of which too little is left is
rejected, and so is one that fails the base rules.

"Unlike one another": copies and near copies of one document all carry
all its lines, which does not make them boilerplate.  Each document has
``LIKE_KEYS`` keys, each made of ``LIKE_HASHES`` MinHashes over its 2-word
shingles.  Of documents that share a part t of their shingles and nothing
else, about t ** 6 have one key and all others a key of their own, so a
line counts as boilerplate if its documents have, as a mean over the keys,
at least ``unlike_share`` as many different keys as texts.  At half that
divides at t = 0.89, which is a similarity of 0.8: a template of up to
four fifths of a text is boilerplate, and documents that are near copies
to operator 2 are near copies here.  Only lines above the limit by plain
distinct documents are held against the keys.

Defined results: a null or empty text has no words and no lines, fails
the word minimum and is not kept; null hosts form one host; repeated rows
are separate rows of one document text (counted once per line); an empty
table gives an empty table; other columns are ignored, whatever their
names.  A very long text is one row of a task; ``judge`` never shuffles
texts, ``clean`` does so once, to meet their verdicts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import WHITE, WordHashes, materialize, mix, shingle_hashes, signed

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A line in more distinct documents of one host than this is above the limit.
MAX_LINE_DOCS = 20
#: Different MinHash keys among those documents, as a share of them.
UNLIKE_SHARE = 0.5
#: Keys of a document, and MinHashes that make one key.
LIKE_KEYS, LIKE_HASHES = 8, 6
#: Share of the word characters that must be left after the removal of lines.
MIN_LEFT = 0.5

_SYMBOLS = b"#*$%&|<>"

_PROFILE = (
    "doc_id long, host string, text_key long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, like_keys array<long>, line_hash array<long>, line_chars array<long>"
)
#: Spark's xxhash64 of a string is XXH64 with this seed.
_SEED = 42
#: Odd factors: each orders the (mixed) shingle hashes anew.
_FACTORS = np.random.Generator(np.random.PCG64(11)).integers(1, 1 << 63, (LIKE_KEYS * LIKE_HASHES, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Shingles whose hashes are worked out at a time.
_STRETCH = 1 << 12


def repeat_words(ids: np.ndarray, distinct: int, size: int = 3) -> int:
    """Words that lie in a window of ``size`` words found twice or more; ``ids`` numbers equal words alike."""
    n = len(ids)
    if n <= size:
        return 0
    m, key, span = n - size + 1, ids[: n - size + 1], distinct
    for j in range(1, size):
        if span * distinct >> 62:  # renumbered, so that the keys stay exact
            key, span = np.unique(key, return_inverse=True)[1], m
        key, span = key * distinct + ids[j : m + j], span * distinct
    order = np.argsort(key, kind="stable")
    same = np.diff(key[order]) == 0
    again = np.zeros(m, bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for j in range(size):
        covered[j : n - size + 1 + j] |= again
    return int(covered.sum())


def normal_line(line: bytes) -> bytes:
    return b" ".join(line.lower().split())


def like_keys(shingles: np.ndarray) -> list[int]:
    """The MinHash keys of a document's shingles; zeros if there are none."""
    if not len(shingles):
        return [0] * LIKE_KEYS
    x, low = mix(shingles), np.full(LIKE_KEYS * LIKE_HASHES, np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(x), _STRETCH):
        low = np.minimum(low, (x[at : at + _STRETCH] * _FACTORS).min(axis=1))
    key = np.zeros(LIKE_KEYS, np.uint64)
    for column in low.reshape(LIKE_KEYS, LIKE_HASHES).T:
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + column)
    return key.view(np.int64).tolist()


def _code_points(b: bytes) -> int:
    return len(b) if b.isascii() else len(b.decode())


def profile_text(b: bytes, hashes: WordHashes) -> tuple:
    """The profile of one text, without its id, host and key (fields as in ``_PROFILE``)."""
    words = b.split()
    number = dict(zip(d := dict.fromkeys(words), range(len(d)), strict=True))
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    bare = b.translate(None, WHITE)
    lines = [x for x in b.split(b"\n") if x.strip(WHITE)]
    of_line = Counter()
    for x in lines:
        of_line[signed(xxhash.xxh64_intdigest(normal_line(x), _SEED))] += _code_points(x.translate(None, WHITE))
    low = hashes.of(b"\n".join(number).lower().split())
    return (
        len(words),
        _code_points(bare),
        len(b) - len(b.translate(None, _SYMBOLS)),
        len(lines) - len(set(lines)),
        repeat_words(ids, len(number)),
        like_keys(shingle_hashes(low[ids], 2)),
        list(of_line),
        list(of_line.values()),
    )


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    kinds = [pa.int64()] * 5 + [pa.list_(pa.int64())] * 3
    names = [x.split()[0] for x in _PROFILE.split(", ")]
    for batch in batches:
        rows = [profile_text(t or b"", hashes) for t in batch.column(3).cast(pa.binary()).to_pylist()]
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 8
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=names
        )


def profile(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One row per document: the base counts and its distinct normalised lines (hash, word characters)."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(host_col).cast("string").alias("host"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    return rows.mapInArrow(_profiles, _PROFILE)


def frequent_lines(profiles: DataFrame, max_docs: int = MAX_LINE_DOCS, unlike_share: float = UNLIKE_SHARE) -> DataFrame:
    """(host, line): the normalised lines above the limit.  Counted over all documents of each host.

    The distinct counts aggregate per task before they shuffle, so a line
    in a third of all documents arrives as few rows.
    """
    lines = profiles.select("host", "text_key", F.explode("line_hash").alias("line"))
    many = lines.groupBy("host", "line").agg(F.count_distinct("text_key").alias("docs")).where(F.col("docs") > max_docs)
    many = materialize(many.select(F.col("host").alias("m_host"), F.col("line").alias("m_line"), "docs"), "quality-many")
    held = profiles.select("host", "like_keys", F.explode("line_hash").alias("line"))
    held = held.join(many, F.col("host").eqNullSafe(F.col("m_host")) & (F.col("line") == F.col("m_line")))
    keys = held.select("host", "line", "docs", F.posexplode("like_keys").alias("number", "key"))
    n = keys.groupBy("host", "line", "docs", "number").agg(F.count_distinct("key").alias("kinds"))
    n = n.groupBy("host", "line", "docs").agg(F.sum("kinds").alias("kinds"))
    return n.where(F.col("kinds") >= unlike_share * LIKE_KEYS * F.col("docs")).select("host", "line")


def removed_chars(profiles: DataFrame, frequent: DataFrame) -> DataFrame:
    """(doc_id, text_key, host, removed, lines): word characters in lines above the limits and their hashes, for documents that have such."""
    z = F.explode(F.arrays_zip("line_hash", "line_chars")).alias("z")
    lines = profiles.select("doc_id", "text_key", "host", z).select("doc_id", "text_key", "host", F.col("z.line_hash").alias("line"), F.col("z.line_chars").alias("chars"))
    f = frequent.select(F.col("host").alias("f_host"), F.col("line").alias("f_line"))
    hit = lines.join(f, F.col("host").eqNullSafe(F.col("f_host")) & (F.col("line") == F.col("f_line")), "left_semi")
    once = hit.groupBy("doc_id", "text_key", "host", "line").agg(F.max("chars").alias("chars"))
    return once.groupBy("doc_id", "text_key", "host").agg(F.sum("chars").alias("removed"), F.collect_list("line").alias("lines"))


def judge(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    max_docs: int = MAX_LINE_DOCS,
    unlike_share: float = UNLIKE_SHARE,
    min_left: float = MIN_LEFT,
) -> DataFrame:
    """Verdict per document, with the hashes of the lines to remove (null if there are none).

    The profiles are written once (no texts in them) and read for the
    counting and for the verdicts.
    """
    p = materialize(profile(docs, id_col, text_col, host_col), "quality-profile")
    frequent = materialize(frequent_lines(p, max_docs, unlike_share), "quality-lines")
    r = removed_chars(p, frequent).select(F.col("doc_id").alias("r_id"), F.col("text_key").alias("r_key"), F.col("host").alias("r_host"), "removed", "lines")
    out = p.drop("line_hash", "line_chars", "like_keys").join(
        r, F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("text_key") == F.col("r_key")) & F.col("host").eqNullSafe(F.col("r_host")), "left"
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    left = F.col("word_chars") - F.coalesce("removed", F.lit(0))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & (left >= min_left * F.col("word_chars"))).alias("kept"),
        F.coalesce("removed", F.lit(0)).alias("removed_chars"), "text_key", "host", "lines",
    )


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", **limits) -> DataFrame:
    """``docs`` without rejected rows and, in the kept texts, without the lines above the limits."""
    v = judge(docs, id_col, text_col, host_col, **limits).where("kept").select(
        F.col("doc_id").alias("v_id"), F.col("text_key").alias("v_key"), F.col("host").alias("v_host"), F.col("lines").alias("v_lines")
    ).dropDuplicates(["v_id", "v_key", "v_host"])
    v = materialize(v, "quality-kept")
    # The row goes along as one column, so its names cannot meet ours.
    rows = docs.select(F.struct("*").alias("row"))
    part = lambda c: F.col("row").getField(c)
    text = part(text_col).cast("string")
    rows = rows.select("row", part(id_col).cast("long").alias("r_id"), F.xxhash64(text).alias("r_key"), part(host_col).cast("string").alias("r_host"))
    found = rows.join(v.hint("shuffle_hash"), F.col("r_id").eqNullSafe(F.col("v_id")) & (F.col("r_key") == F.col("v_key")) & F.col("r_host").eqNullSafe(F.col("v_host")))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    norm = f"trim(regexp_replace(translate(x, '{upper}', '{lower}'), r'[\\x20\\t\\x0B\\f\\r]+', ' '))"
    left = F.expr(f"array_join(filter(split(cast(row.`{text_col}` as string), '\\n', -1), x -> not array_contains(v_lines, xxhash64({norm}))), '\\n')")
    new = F.when(F.col("v_lines").isNull(), text).otherwise(left)
    return found.select(*(new.alias(c) if c == text_col else part(c).alias(c) for c in docs.columns))
