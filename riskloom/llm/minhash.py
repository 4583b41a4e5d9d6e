"""MinHash near-dedup (operator 2): one-permutation hashing, optimal densification, banded buckets, star edges.

One pass over the texts makes each document's shingle set, a digest of
the set, and a signature: shingle hashes fall into ``BINS`` bins, each bin
keeps its minimum, and an empty bin takes the value of the first filled bin
in its own fixed random order (optimal densification).  ``ROWS``
consecutive bins form a band; documents that agree on a band share a bucket.

Links are confirmed on full sets: 100 * intersection >= 80 * union.

1. Documents with equal sets are one class; only one of each goes on.
2. In each bucket the smallest class is the centre and the others are
   edges to it, so n members give n - 1 edges, and all buckets of a centre
   form one star.  Each class is confirmed against the centre it shares
   most bands with, and components are formed.
3. A star may still hold several components (copies edited apart from one
   another).  Its members meet in blocks of about ``BLOCK``, cut by root:
   a component that fills a block has blocks of its own, the members of
   the others share blocks, and two blocks meet once unless both are of
   one component.  A task works out all intersections of two blocks as
   matrix products and gives only the links that join components, fewer
   than members.  So two documents that share a bucket and are not linked
   already are always compared, no pair of them becomes a row, and a star
   that is one component (copies of a text) is left out.

Two sets with similarity 0.8 share no band with probability 5e-9 (48 bands
of 5 rows); nothing is capped.

Tables between the steps are written to the shared folder; the texts of
candidates travel zstd-compressed.  Nothing but counts and checksums
reaches the driver.

Defined results: a null text, or one without words, has an empty set, is
linked with nothing and is its own component; a text with fewer words than
a shingle has one shingle, the whole sequence; repeated rows are one class;
``component_id`` is the smallest non-null doc_id of the component, null if
all are null; an empty table gives an empty table; only the named columns
are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from riskloom.llm.common import WordHashes, components, materialize, mix, release, shingle_hashes

BANDS = 48
ROWS = 5
PERCENT = 80
#: Members of a star that one block holds on average.
BLOCK = 256
#: Shingles of its members, on average; what bounds a block of long texts.
BLOCK_SHINGLES = 1 << 21
_MEETING = ["star", "x_group", "x_block", "y_group", "y_block"]
_STRETCH = 1 << 12
_SIGNED = [
    StructField("doc_id", LongType()), StructField("n_shingles", LongType()), StructField("set_id", BinaryType()),
    StructField("bands", ArrayType(LongType())), StructField("z", BinaryType()),
]


def shingle_set(text: bytes, hashes: WordHashes, k: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a text (A-Z lower-cased)."""
    return np.unique(shingle_hashes(hashes.of(text.lower().split()), k))


@lru_cache
def _donors(bins: int) -> np.ndarray:
    """For each bin the order in which it looks for a filled one: a fixed permutation of its own."""
    random = np.random.Generator(np.random.PCG64(20))
    return np.argsort(random.random((bins, bins)), axis=1)


def signature(shingles: np.ndarray, bins: int) -> np.ndarray:
    """One-permutation signature, densified; ``shingles`` must not be empty."""
    h = mix(shingles ^ np.uint64(0x5851F42D4C957F2D))
    place = ((h >> np.uint64(40)) * np.uint64(bins)) >> np.uint64(24)
    sig = np.full(bins, np.uint64(0xFFFFFFFFFFFFFFFF))
    np.minimum.at(sig, place.astype(np.int64), h & np.uint64((1 << 40) - 1))
    filled = sig != np.uint64(0xFFFFFFFFFFFFFFFF)
    if not filled.all():
        empty = np.flatnonzero(~filled)
        order = _donors(bins)[empty]
        sig[empty] = sig[order[np.arange(len(empty)), filled[order].argmax(axis=1)]]
    return sig


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band of ``rows`` consecutive bins; bands never share keys by place."""
    table = sig.reshape(-1, rows)
    key = np.arange(len(table), dtype=np.uint64) + np.uint64(1)
    for j in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + table[:, j])
    return key


def _signer(k: int, bands: int, rows: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, pack = WordHashes(), zstandard.ZstdCompressor(level=1)
        for b in batches:
            n, sets, keys, z = [], [], [], []
            for t in b.column(1).cast(pa.binary()).to_pylist():
                s = shingle_set(t or b"", hashes, k)
                n.append(len(s))
                sets.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                keys.append(band_keys(signature(s, bands * rows), rows).view(np.int64) if len(s) else None)
                z.append(None if t is None else pack.compress(t))
            made = [b.column(0), pa.array(n, pa.int64()), pa.array(sets, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(z, pa.binary())]
            yield pa.RecordBatch.from_arrays(made + b.columns[2:], names=[f.name for f in _SIGNED] + b.schema.names[2:])

    return sign


def _confirmer(k: int, percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, unpack = WordHashes(), zstandard.ZstdDecompressor()
        last, last_set = None, None
        for b in batches:
            ok = []
            for a, za, zb in zip(*(b.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
                if a != last:
                    last, last_set = a, shingle_set(unpack.decompress(za), hashes, k)
                other = shingle_set(unpack.decompress(zb), hashes, k)
                both = len(np.intersect1d(last_set, other, assume_unique=True))
                ok.append(100 * both >= percent * (len(last_set) + len(other) - both))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ok, pa.bool_())], names=["a", "b", "linked"])

    return confirm


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections of some sets of hashes.

    Products of 0/1 matrices over the hashes that at least two sets hold,
    a bounded stretch of hashes at a time.
    """
    n = len(sets)
    values, owner = np.concatenate(sets), np.repeat(np.arange(n), [len(x) for x in sets])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    head = np.concatenate([[True], values[1:] != values[:-1]])
    number = np.cumsum(head) - 1
    often = np.bincount(number) > 1
    keep = often[number]
    number, owner = (np.cumsum(often) - 1)[number[keep]], owner[keep]
    out = np.zeros((n, n), np.int64)
    for begin in range(0, int(often.sum()), _STRETCH):
        a, b = np.searchsorted(number, [begin, begin + _STRETCH])
        m = np.zeros((n, _STRETCH), np.float32)
        m[owner[a:b], number[a:b] - begin] = 1
        out += np.rint(m @ m.T).astype(np.int64)
    return out


def _block_links(k: int, percent: int):
    """Links across components in each pair of blocks: as many as join components, not all of them."""

    def links(rows: list[tuple], hashes: WordHashes, unpack) -> list[tuple[int, int]]:
        if len({r[6] for r in rows}) < 2:
            return []
        sets = [shingle_set(unpack.decompress(r[7]), hashes, k) for r in rows]
        size = np.array([len(x) for x in sets])
        both = intersections(sets)
        root = np.unique([r[6] for r in rows], return_inverse=True)[1]
        ok = (100 * both >= percent * (size[:, None] + size[None, :] - both)) & (root[:, None] < root[None, :])
        out = []
        for a, b in zip(*np.nonzero(ok), strict=True):
            if root[a] != root[b]:
                out.append((rows[a][5], rows[b][5]))
                root[root == root[b]] = root[a]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, unpack = WordHashes(), zstandard.ZstdDecompressor()
        rows: list[tuple] = []

        def found() -> pa.RecordBatch:
            cols = list(zip(*links(rows, hashes, unpack), strict=True)) or [[], []]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["a", "b"])

        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if rows and r[:5] != rows[0][:5]:
                    yield found()
                    rows = []
                rows.append(r)
        if rows:
            yield found()

    return run


def meetings(members: DataFrame) -> DataFrame:
    """Every block of a mixed star that each member has to meet, from (star, node, n, root).

    Members of a root that fills a block by itself stand in blocks of that
    root (``group`` is the root); the members of all other roots share
    blocks (``group`` -1).  Two blocks of one root have nothing to compare,
    so a star of one large component and a few strays gives each member
    about one row.
    """
    roots = members.groupBy("star", "root").agg(F.count("*").alias("members"), F.sum("n").alias("shingles"))
    mixed = roots.groupBy("star").agg(F.count("*").alias("roots")).where("roots > 1").select("star")
    fills = (F.col("members") >= BLOCK) | (F.col("shingles") >= BLOCK_SHINGLES)
    roots = roots.join(mixed, "star", "left_semi").withColumn("group", F.when(fills, F.col("root")).otherwise(F.lit(-1)))
    blocks = F.ceil(F.greatest(F.sum("members") / BLOCK, F.sum("shingles") / BLOCK_SHINGLES)).cast("int")
    groups = roots.groupBy("star", "group").agg(blocks.alias("blocks"))
    groups = roots.select("star", "root", "group").join(groups, ["star", "group"])
    own = members.join(groups.hint("merge"), ["star", "root"]).select("star", "node", "root", "group", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"))
    others = groups.select("star", F.col("group").alias("g"), "blocks").distinct()
    met = own.join(others.hint("merge"), "star").where((F.col("group") != F.col("g")) | (F.col("g") == -1))
    met = met.withColumn("b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    here, there = F.struct(F.col("group").alias("g"), F.col("block").alias("b")), F.struct("g", "b")
    met = met.select("star", "node", "root", F.least(here, there).alias("x"), F.greatest(here, there).alias("y"))
    return met.select("star", F.col("x.g").alias("x_group"), F.col("x.b").alias("x_block"), F.col("y.g").alias("y_group"), F.col("y.b").alias("y_block"), "node", "root")


def sign(docs: DataFrame, shingle_words: int, bands: int, rows: int, id_col: str, text_col: str, carried: list[str]) -> DataFrame:
    """The written table of signed rows, numbered by ``row``; carried columns follow as x0, x1, ..."""
    more = [docs[f"`{c}`"].alias(f"x{i}") for i, c in enumerate(carried)]
    texts = docs.select(docs[f"`{id_col}`"].cast("long").alias("doc_id"), docs[f"`{text_col}`"].cast("string").alias("text"), *more)
    schema = StructType(_SIGNED + [StructField(f.name, f.dataType) for f in texts.schema.fields[2:]])
    return materialize(texts.mapInArrow(_signer(shingle_words, bands, rows), schema).withColumn("row", F.monotonically_increasing_id()), "minhash-rows")


def link(t: DataFrame, shingle_words: int, percent: int) -> DataFrame:
    """(row, doc_id, n_shingles, component_id, stays) for every row of a signed table.

    ``stays`` marks one row of each component, the first with its smallest doc_id.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("low")
    classes = materialize(t.where("n_shingles > 0").groupBy("set_id").agg(F.min("row").alias("node"), first), "minhash-classes")

    reps = t.join(classes.select(F.col("node").alias("row")), "row").select(F.col("row").alias("node"), F.col("n_shingles").alias("n"), "bands")
    bucket = materialize(reps.select("node", "n", F.explode("bands").alias("key")), "minhash-bands")
    centre = bucket.groupBy("key").agg(F.min("node").alias("centre"), F.count("*").alias("members"), F.min_by("n", "node").alias("centre_n")).where("members > 1")
    star = bucket.join(centre.hint("merge"), "key").where(F.col("node") != F.col("centre"))
    star = star.groupBy(F.col("centre").alias("a"), F.col("node").alias("b")).agg(F.count("*").alias("shared"), F.first("n").alias("nb"), F.first("centre_n").alias("na"))
    star = materialize(star, "minhash-stars")
    release(bucket)
    nodes = star.select(F.col("a").alias("node")).unionByName(star.select(F.col("b").alias("node"))).distinct()
    z = materialize(t.select(F.col("row").alias("node"), "z").join(nodes.hint("shuffle_hash"), "node", "left_semi"), "minhash-texts")

    # Each class and the centre it shares most bands with; sizes alone can rule a link out.
    fits = F.least("na", "nb") * 100 >= percent * F.greatest("na", "nb")
    best = star.where(fits).groupBy("b").agg(F.max_by("a", F.struct("shared", -F.col("a"))).alias("a"))
    za, zb = z.select(F.col("node").alias("a"), F.col("z").alias("za")), z.select(F.col("node").alias("b"), F.col("z").alias("zb"))
    both = best.join(zb.hint("merge"), "b").join(za.hint("merge"), "a").select("a", "b", "za", "zb").sortWithinPartitions("a")
    confirmed = materialize(both.mapInArrow(_confirmer(shingle_words, percent), "a long, b long, linked boolean"), "minhash-first")
    first = confirmed.where("linked").select("a", "b")
    root = components(first, "minhash-components")

    def rooted(df: DataFrame, node: str, out: str) -> DataFrame:
        r = root.select(F.col("node").alias(node), F.col("root").alias("r"))
        return df.join(r, node, "left").withColumn(out, F.coalesce("r", node)).drop("r")

    # Stars that still hold several components: blocks of them meet where they hold different roots.
    members = star.select(F.col("a").alias("star"), F.col("b").alias("node"), F.col("nb").alias("n"))
    members = members.unionByName(star.select(F.col("a").alias("star"), F.col("a").alias("node"), F.col("na").alias("n")).distinct())
    members = materialize(rooted(members, "node", "root"), "minhash-members")
    meeting = meetings(members).join(z.hint("merge"), "node").repartition(*_MEETING).sortWithinPartitions(*_MEETING).select(*_MEETING, "node", "root", "z")
    more = materialize(meeting.mapInArrow(_block_links(shingle_words, percent), "a long, b long"), "minhash-second")
    if not more.isEmpty():
        root = components(first.unionByName(more), "minhash-components")
    for written in (star, z, confirmed, members, more):
        release(written)

    group = rooted(classes, "node", "root")
    lowest = group.groupBy("root").agg(F.min("low").alias("low"))
    named = group.select("set_id", "root").join(lowest, "root").select(F.col("set_id").alias("s"), "low")
    out = t.select("row", "doc_id", "n_shingles", "set_id").join(named, F.col("set_id") == F.col("s"), "left")
    alone = F.col("set_id").isNull()
    return out.select(
        "row", "doc_id", "n_shingles", F.when(alone, F.col("doc_id")).otherwise(F.col("low.doc_id")).alias("component_id"), (alone | (F.col("row") == F.col("low.row"))).alias("stays")
    )


def report(docs: DataFrame, shingle_words: int = 2, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document."""
    t = sign(docs, shingle_words, bands, rows, id_col, text_col, [])
    return link(t, shingle_words, percent).select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor()
    for b in batches:
        text = [None if z is None else unpack.decompress(z) for z in b.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(text, pa.binary()).cast(pa.string()), *b.columns[1:]], names=["text", *b.schema.names[1:]])


def deduplicate(docs: DataFrame, shingle_words: int = 5, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component, all columns as they were."""
    carried = [c for c in docs.columns if c != text_col]
    t = sign(docs, shingle_words, bands, rows, id_col, text_col, carried)
    stays = link(t, shingle_words, percent).where("stays").select("row")
    x = [f"x{i}" for i in range(len(carried))]
    kept = t.select("row", "z", *x).join(stays.hint("shuffle_hash"), "row", "left_semi").select("z", *x)
    schema = StructType([StructField("text", docs.schema[text_col].dataType)] + [StructField(f, kept.schema[f].dataType) for f in x])
    back = kept.mapInArrow(_unpacked, schema)
    named = {c: f"x{i}" for i, c in enumerate(carried)} | {text_col: "text"}
    return back.select(*(F.col(named[c]).alias(c) for c in docs.columns))
