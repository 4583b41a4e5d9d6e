"""Source divergence audit (operator 11): how each source's terms differ from its language's.

*Chunk factorization.*  A term never crosses white space, so texts need not
be tokenized one by one.  Each task splits its documents on ASCII white
space (A-Z lower-cased) and numbers the chunks; each chunk that it holds is
then tokenized once and its terms are joined back to the documents.

*Distinct documents.*  A document with "foo" and "foo," holds the term foo
once, so documents of chunks do not add up to documents of terms.  A
document lies in one task as a whole, which sorts its (term, document)
pairs: documents of a term are exact there and add up over tasks.  Only
terms leave a task, in one shuffle by term and language that sees which are
kept and sums their occurrences by source.

*Divergence.*  Groups and terms have integer shares; all arithmetic is on
integers (decimals where a product may pass 64 bits).  A group holds no
rows for its absent terms: the sum over all kept terms of a pair of sources
is put together from each source's histogram of shares against the other's
share of an absent term, and corrected on the terms that both hold.  The
join behind that correction has no more rows than kept terms times the
pairs of sources, which are themselves asked for.

Bounds: a task holds the chunks of ``TASK_CHUNKS`` places (or four bytes of
text for each) as numbers, whole documents only; a text over ``LONG_TEXT``
bytes is split in stretches.  A term in a third of all rows arrives as one
row a task and flush, with its sources beside it.

Defined results: null text, lang and source count as empty strings; every
row is a document (repeated ids and rows too); an empty text has no terms
but its group occurs; ties go by UTF-8 order of the item; an empty table
gives an empty table; only the named columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import materialize, release

MIN_DOCS = 10
TOP = 10
SCALE = 1_000_000_000
PRIOR = 2
#: Counts below this times SCALE stay within 64 bits.
_SMALL = 9_000_000_000
#: Term bytes (A-Z lower-cased) as they are, all others a space: terms are `[^\x00-\x40\x5B-\x60\x7B-\x7F]+`.
_TERM = bytes(x + 32 if 0x41 <= x <= 0x5A else x if 0x61 <= x <= 0x7A or x >= 0x80 else 0x20 for x in range(256))
TASK_CHUNKS = 8_000_000
LONG_TEXT = 1 << 22
_WHITE = re.compile(rb"[\x20\x09-\x0D]")
_COUNTS = "lang string, term string, docs long, times long, sources array<string>, counts array<long>"


def _stretches(text: bytes) -> list[bytes]:
    """A long text cut at white space, into stretches of ``LONG_TEXT`` bytes or a chunk more."""
    out, at = [], 0
    while at < len(text):
        white = _WHITE.search(text, at + LONG_TEXT)
        to = white.start() if white else len(text)
        out.append(text[at:to])
        at = to
    return out


def _terms(chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """For each chunk the number of its terms; the terms of all as numbers, in order; and the numbered terms."""
    data = chunks.buffers()[2]
    plain = pa.Array.from_buffers(chunks.type, len(chunks), [None, chunks.buffers()[1], pa.py_buffer((data.to_pybytes() if data else b"").translate(_TERM))], offset=chunks.offset)
    found = pc.ascii_split_whitespace(plain)
    of, term = pc.list_parent_indices(found), found.flatten()
    some = pc.greater(pc.binary_length(term), 0)
    numbered = term.filter(some).dictionary_encode()
    return np.bincount(of.filter(some).to_numpy(), minlength=len(chunks)), numbered.indices.to_numpy().astype(np.int64), numbered.dictionary


class _Task:
    """Some documents of a task: their chunks as numbers, their languages and sources."""

    def __init__(self):
        self.chunks: list[pa.DictionaryArray] = []
        self.sizes: list[np.ndarray] = []  # chunks of each document
        self.langs: list[pa.Array] = []
        self.sources: list[pa.Array] = []
        self.held = 0

    def add(self, text: pa.Array, lang: pa.Array, source: pa.Array) -> None:
        """Documents; or one, in stretches."""
        found = pc.ascii_split_whitespace(pc.ascii_lower(text))  # A-Z only
        size = pc.list_value_length(found).to_numpy().astype(np.int64)
        self.chunks.append(found.flatten().dictionary_encode())
        self.sizes.append(size if len(lang) == len(text) else size.sum(keepdims=True))
        self.langs.append(lang)
        self.sources.append(source)
        self.held += max(int(size.sum()), pc.sum(pc.binary_length(text)).as_py() // 4)

    def rows(self) -> Iterator[pa.RecordBatch]:
        """A row for each (lang, term): documents, occurrences, and occurrences by source."""
        if not self.chunks:
            return
        lang, source = (pa.chunked_array(x).combine_chunks().dictionary_encode() for x in (self.langs, self.sources))
        names = source.dictionary
        group = lang.indices.to_numpy().astype(np.int64) * len(names) + source.indices.to_numpy()
        order = np.argsort(group, kind="stable")
        place = np.empty(len(group), np.int64)  # documents in the order of their groups
        place[order] = np.arange(len(group))
        group = group[order]

        numbered = pa.chunked_array(self.chunks).unify_dictionaries().chunks
        self.chunks.clear()
        n, term, terms = _terms(numbered[0].dictionary)
        first = np.cumsum(n) - n
        keys, documents = [], 0
        for chunks, size in zip(numbered, self.sizes, strict=True):
            chunk = chunks.indices.to_numpy()
            here = n[chunk]
            at = np.arange(here.sum()) + np.repeat(first[chunk] - np.cumsum(here) + here, here)
            document = np.repeat(place[documents : documents + len(size)], size)
            keys.append(term[at] * len(group) + np.repeat(document, here))
            documents += len(size)
        key = np.concatenate(keys)
        del numbered, keys
        if not len(key):
            return
        key.sort()
        head = _heads(key)  # one for each (term, document)
        times, key = np.diff(head, append=len(key)), key[head]
        of_term, at = np.divmod(key, len(group))
        cell = _heads(of_term, group[at])
        of_term, of_group, counts = of_term[cell], group[at[cell]], np.add.reduceat(times, cell)
        of_lang = of_group // len(names)
        row = _heads(of_term, of_lang)
        list_ends = pa.array(np.append(row, len(cell)), pa.int32())
        cols = [
            lang.dictionary.take(pa.array(of_lang[row])), terms.take(pa.array(of_term[row])),
            pa.array(np.diff(cell[row], append=len(key))), pa.array(np.add.reduceat(counts, row)),
            pa.ListArray.from_arrays(list_ends, names.take(pa.array(of_group % len(names)))), pa.ListArray.from_arrays(list_ends, pa.array(counts)),
        ]
        yield from pa.Table.from_arrays(cols, names=[x.split()[0] for x in _COUNTS.split(", ")]).to_batches(max_chunksize=100_000)


def _heads(*keys: np.ndarray) -> np.ndarray:
    """Where a run of equal keys begins."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _counter(task_chunks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = _Task()
        for b in batches:
            text, lang, source = b.columns
            size = pc.binary_length(text).to_numpy()
            ends = np.cumsum(size, dtype=np.int64)
            at = 0
            while at < b.num_rows:
                most = min(LONG_TEXT, 4 * max(1, task_chunks - task.held))
                to = max(at + 1, int(np.searchsorted(ends, ends[at] - size[at] + most, "right")))  # a long text is alone
                part = text.slice(at, to - at)
                if size[at] > LONG_TEXT:
                    part = pa.array(_stretches(part.cast(pa.binary() if part.type == pa.string() else pa.large_binary())[0].as_py()), pa.binary()).cast(part.type)
                task.add(part, lang.slice(at, to - at), source.slice(at, to - at))
                at = to
                if task.held >= task_chunks:
                    yield from task.rows()
                    task = _Task()
        yield from task.rows()

    return run


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", task_chunks: int = TASK_CHUNKS) -> DataFrame:
    """A row for each task, language and term: documents, occurrences, and occurrences by source."""
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(plain(text_col).alias("text"), plain(lang_col).alias("lang"), plain(source_col).alias("source"))
    return rows.mapInArrow(_counter(task_chunks), _COUNTS)


def kept_counts(counts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, all, source, count) of the terms in at least ``min_docs`` documents; ``all`` over all sources."""
    # One shuffle serves the window and the sums. Keys begin with the term: rows are sorted by what tells them apart.
    same = Window.partitionBy("term", "lang")
    kept = counts.withColumn("docs", F.sum("docs").over(same)).withColumn("all", F.sum("times").over(same)).where(F.col("docs") >= min_docs)
    kept = kept.select("term", "lang", "all", F.explode(F.arrays_zip("sources", "counts")).alias("x"))
    return kept.groupBy("term", "lang", "all", F.col("x.sources").alias("source")).agg(F.sum("x.counts").alias("count"))


def _share(count: Column | str, total: str = "total", terms: str = "terms") -> Column:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * terms)); null where no term is kept."""
    count = F.col(count) if isinstance(count, str) else count
    whole = F.nullif(F.col(total) + PRIOR * F.col(terms), F.lit(0).cast("long"))
    small = F.call_function("div", (count + PRIOR) * F.lit(SCALE).cast("long"), whole)
    large = F.call_function("div", (count + PRIOR).cast("decimal(28,0)") * F.lit(SCALE).cast("decimal(10,0)"), whole.cast("decimal(28,0)"))
    return F.lit(1).cast("long") + F.when(count < _SMALL, small).otherwise(large)


def _apart(p: str, q: str) -> Column:
    """floor((p-q)**2 / (p+q)); shares are below 2**31."""
    d = F.col(p) - F.col(q)
    return F.call_function("div", d * d, F.col(p) + F.col(q))


def audit(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = MIN_DOCS, top: int = TOP, task_chunks: int = TASK_CHUNKS
) -> DataFrame:
    """(lang, source, part, item, value, rank): other sources by divergence (``pair``), and the terms that stand out (``term``)."""
    found = materialize(kept_counts(term_counts(docs, text_col, lang_col, source_col, task_chunks), min_docs), "divergence-found")

    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    groups = docs.select(plain(lang_col).alias("lang"), plain(source_col).alias("source")).distinct()
    terms = found.select("term", "lang").distinct().groupBy("lang").agg(F.count("*").alias("terms"))
    totals = found.groupBy("lang", "source").agg(F.sum("count").alias("total"), F.count("*").alias("present"))
    groups = groups.join(terms, "lang", "left").join(totals, ["lang", "source"], "left").na.fill(0, ["terms", "total", "present"])
    groups = materialize(groups.withColumn("absent", _share(F.lit(0).cast("long"))), "divergence-groups")
    whole = groups.groupBy("lang").agg(F.sum("total").alias("in_lang"))
    shares = found.join(groups.join(whole, "lang"), ["lang", "source"])
    shares = shares.select("lang", "source", "term", _share("count").alias("p"), _share("all", "in_lang").alias("q"), "absent")
    shares = materialize(shares, "divergence-shares")
    release(found)

    out = shares.where("p > q")
    out = out.select("lang", "source", F.col("term").alias("item"), _apart("p", "q").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    term_part = out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).withColumn("part", F.lit("term"))

    a = groups.select("lang", F.col("source").alias("a"), F.col("absent").alias("a0"), F.col("present").alias("a_n"), "terms")
    b = groups.select("lang", F.col("source").alias("b"), F.col("absent").alias("b0"), F.col("present").alias("b_n"))
    pairs = materialize(a.join(b, "lang").where("a <> b"), "divergence-pairs")  # the pairs that are asked for
    histogram = shares.groupBy("lang", F.col("source").alias("a"), "p").agg(F.count("*").alias("n"))
    one_side = histogram.join(pairs.select("lang", "a", "b", "b0"), ["lang", "a"]).groupBy("lang", "a", "b").agg(F.sum(F.col("n") * _apart("p", "b0")).alias("side"))
    x = shares.select("lang", "term", F.col("source").alias("a"), F.col("p").alias("pa"), F.col("absent").alias("a0"))
    y = shares.select("lang", "term", F.col("source").alias("b"), F.col("p").alias("pb"), F.col("absent").alias("b0"))
    fix = _apart("pa", "pb") - _apart("pa", "b0") - _apart("a0", "pb") + _apart("a0", "b0")
    both = x.join(y, ["term", "lang"]).where("a < b").groupBy("lang", "a", "b").agg(F.sum(fix).alias("fix"))
    turned = lambda df: df.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), df.columns[-1])
    sums = one_side.unionByName(turned(one_side)).groupBy("lang", "a", "b").agg(F.sum("side").alias("sides"))
    both = both.unionByName(turned(both))
    whole = pairs.join(sums, ["lang", "a", "b"], "left").join(both, ["lang", "a", "b"], "left")
    rest = F.when(F.col("terms") > 0, (F.col("terms") - F.col("a_n") - F.col("b_n")) * _apart("a0", "b0")).otherwise(F.lit(0))
    value = F.coalesce("sides", F.lit(0)) + F.coalesce("fix", F.lit(0)) + rest
    pair_part = whole.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), value.cast("long").alias("value"))
    pair_part = pair_part.withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit("pair"))
    return pair_part.unionByName(term_part).select("lang", "source", "part", "item", "value", "rank")
