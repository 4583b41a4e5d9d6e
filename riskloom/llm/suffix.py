"""Suffix-array dedup (operator 7): bytes of 400-byte strings that start anywhere else are removed.

*Sharding.*  Each start of a 400-byte string gets a class: the smallest
hash among the 64-byte grams inside the string.  Equal strings have equal
classes, whatever stands around them, so all copies of a string meet in
one class and no shard must look into all others.  Neighbouring starts
with one class form a range of about 170 starts, whose context is the
bytes from its first start to the end of its last string.  A range has at
most ``RANGE_STARTS`` starts: where a text repeats itself (one byte, a short
period) its smallest gram comes again and again, and the range is cut into
pieces of one class, most of them with equal contexts.  Only classes with
two ranges (or a range with two places of its smallest gram) go on.  Equal
contexts of a class are one, with a count.

*Shards.*  Distinct contexts are gathered class by class into shards of
about ``SHARD_BYTES``.  Each shard's suffix array is made by Larsson and
Sadakane's refinement in numpy (sorted by 8 bytes first, then only groups
that are still unsorted, by the ranks h places on, h doubling up to the
string length), common prefixes by Kasai's pass, run in step over all
contexts, eight bytes at a time.  A start whose neighbour shares 400 bytes
is a copy.

*Merging.*  A class with more than ``CLASS_CONTEXTS`` distinct contexts, of
at most ``RANGE_STARTS`` + 399 bytes each, is spread over several shards.  Those shards also give a 128-bit digest of
each distinct string; the digests are shuffled, and
binary search in each sorted run finds those that occur in another shard.

Texts equal to another one's as a whole, of 400 bytes or more, are removed
whole; one of them takes part for all.

Defined results: null text counts as empty; texts shorter than 400 bytes
hold no such string and lose nothing; repeated rows are copies of one another; very long texts are hashed in
stretches of ``STRETCH`` starts, whose strings overlap; an empty table gives an empty table; only the named columns
are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import materialize, mix, release

LENGTH = 400
GRAM = 64
SHARD_BYTES = 3 << 19
CLASS_CONTEXTS = 4096
#: Most starts of a range; only a range whose smallest gram comes again has more than LENGTH - GRAM + 1.
RANGE_STARTS = 4096
#: Starts of a long text that are hashed at once.
STRETCH = 1 << 20
_GROUP_BYTES = 1 << 20
_BODIES = 4096
_MERGE_ROWS = 200_000
_SCANNED = "doc_id long, n_bytes long, text_id binary, sha string, z binary, hash array<long>, first array<long>, last array<long>, own array<boolean>"
_RANGE = "class long, context binary, node long, first long, last long, own boolean"
_BODY = "class long, context binary, copies long, own boolean, part int, body binary"
_FOUND = "class long, context binary, part int, runs array<long>, digests array<binary>, digest_at array<long>"


@lru_cache
def _letters() -> np.ndarray:
    return np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 2 * _GROUP_BYTES)
        step = lambda b: np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(size - 1, np.uint64(b))]))
        _POWERS[:] = [step(_BASE), step(pow(_BASE, -1, 1 << 64))]
    return _POWERS[0][:n], _POWERS[1][:n]


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of each ``gram`` bytes, by prefix sums of a polynomial."""
    n = len(data)
    if n < gram:
        return np.empty(0, np.uint64)
    up, down = _powers(n)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_letters()[data] * up)])
    return mix((sums[gram:] - sums[:-gram]) * down[: n - gram + 1])


def sliding_min(a: np.ndarray, window: int) -> np.ndarray:
    """Minimum of each ``window`` neighbours, by doubling."""
    size = 1
    while size * 2 <= window:
        a = np.minimum(a[:-size], a[size:])
        size *= 2
    return a if size == window else np.minimum(a[: len(a) - (window - size)], a[window - size :])


def _pieces(first: np.ndarray, last: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges cut into pieces of at most ``most`` starts: the range of each piece, its first and last start."""
    n = (last - first) // most + 1
    of = np.repeat(np.arange(len(first)), n)
    begin = first[of] + (np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)) * most
    return of, begin, np.minimum(last[of], begin + most - 1)


def long_ranges(text: bytes, length: int, gram: int, most: int, stretch: int) -> tuple[np.ndarray, ...]:
    """``ranges`` of one text, ``stretch`` starts at a time."""
    out = []
    for at in range(0, max(1, len(text) - length + 1), stretch):
        value, first, last, own = ranges([text[at : at + stretch + length - 1]], length, gram, most)[0]
        out.append((value, np.array(first, np.int64) + at, np.array(last, np.int64) + at, own))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def ranges(texts: list[bytes], length: int, gram: int, most: int = RANGE_STARTS) -> list[tuple[list[int], list[int], list[int], list[bool]]]:
    """For each text the classes, first and last starts of its ranges, and whether a range can hold copies by itself."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    out: list = [([], [], [], [])] * len(texts)
    window = length - gram + 1
    if len(data) < length:
        return out
    grams = gram_hashes(data, gram)
    least = sliding_min(grams, window)
    base = np.cumsum(sizes) - sizes
    for i in np.flatnonzero(sizes >= length).tolist():
        at, starts = int(base[i]), int(sizes[i]) - length + 1
        m = least[at : at + starts]
        first = np.concatenate([[0], np.flatnonzero(m[1:] != m[:-1]) + 1])
        last = np.concatenate([first[1:] - 1, [starts - 1]])
        _, first, last = _pieces(first, last, most)
        value = m[first]
        own = [int(np.count_nonzero(grams[at + a : at + b + window] == v)) > 1 for a, b, v in zip(first.tolist(), last.tolist(), value, strict=True)]
        out[i] = (value.view(np.int64), first, last, own)
    return out


def _scanner(length: int, gram: int, most: int, stretch: int):
    names = [x.split()[0] for x in _SCANNED.split(", ")]
    lists = [pa.list_(pa.int64())] * 3 + [pa.list_(pa.bool_())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for b in batches:
            texts = [t or b"" for t in b.column(1).cast(pa.binary()).to_pylist()]
            at = 0
            while at < len(texts):
                to, size = at, 0
                while to < len(texts) and (to == at or size + len(texts[to]) <= min(_GROUP_BYTES, stretch)):  # a long text is alone
                    size += len(texts[to])
                    to += 1
                part = texts[at:to]
                found = [long_ranges(part[0], length, gram, most, stretch)] if len(part[0]) >= stretch + length else ranges(part, length, gram, most)
                cols = [
                    b.column(0).slice(at, to - at), pa.array(map(len, part), pa.int64()), pa.array(map(xxhash.xxh3_128_digest, part), pa.binary()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in part]), pa.array(map(pack.compress, part), pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(cols + [pa.array([f[j] for f in found], k) for j, k in enumerate(lists)], names=names)
                at = to

    return run


def _range_digests(length: int):
    names = [x.split()[0] for x in _RANGE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            for i in range(b.num_rows):
                node, text = b.column(0)[i].as_py(), unpack.decompress(b.column(1)[i].as_py())
                rs = b.column(2)[i].as_py()
                cols = [[r[k] for r in rs] for k in ("class", "first", "last", "own")]
                dig = [xxhash.xxh3_128_digest(text[f : e + length]) for f, e in zip(cols[1], cols[2], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int64()), pa.array(dig, pa.binary()), pa.array([node] * len(rs), pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.bool_())], names=names
                )

    return run


def _bodies(length: int):
    names = [x.split()[0] for x in _BODY.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            for i in range(b.num_rows):
                text = unpack.decompress(b.column(0)[i].as_py())
                rs = b.column(1)[i].as_py()
                kinds = (pa.int64(), pa.binary(), pa.int64(), pa.bool_(), pa.int32())
                for at in range(0, len(rs), _BODIES):
                    part = rs[at : at + _BODIES]
                    cols = [pa.array([r[k] for r in part], t) for k, t in zip(names, kinds, strict=False)]
                    yield pa.RecordBatch.from_arrays([*cols, pa.array([text[r["first"] : r["last"] + length] for r in part], pa.binary())], names=names)

    return run


def eight_bytes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one big-endian number (zeros after the end)."""
    key = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    n = len(data)
    for width in (1, 2, 4):
        key = (key[:-width] << np.uint64(8 * width)) | key[width:] if width == 1 else (key[: len(key) - width] << np.uint64(8 * width)) | key[width:]
    return key[:n]


def suffix_array(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes sorted by their first ``length`` bytes or more, and the eight-byte keys."""
    n = len(data)
    key = eight_bytes(data)
    sa = np.argsort(key, kind="stable")
    in_order = key[sa]
    head = np.concatenate([[True], in_order[1:] != in_order[:-1]])
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1  # past the end: smallest
    place = np.flatnonzero(head)
    group = place[np.cumsum(head) - 1]
    rank[sa] = group
    h = 8
    while h < length:
        size = np.diff(np.append(place, n))
        unsorted_ = np.repeat(size > 1, size)
        at = np.flatnonzero(unsorted_)  # places in the array that are still in groups
        if not len(at):
            break
        of = sa[at]
        second = rank[np.minimum(of + h, n)] + 1
        both = group[at] * (n + 1) + second
        order = np.argsort(both, kind="stable")
        both = both[order]
        sa[at] = of[order]
        new = np.concatenate([[True], both[1:] != both[:-1]])
        head[at] = new | head[at]
        place = np.flatnonzero(head)
        group = place[np.cumsum(head) - 1]
        rank[sa[at]] = group[at]
        h *= 2
    return sa, key


def neighbours_share(data: np.ndarray, key: np.ndarray, order: np.ndarray, first: np.ndarray, count: np.ndarray, length: int) -> np.ndarray:
    """Common prefix, up to ``length``, of each start with the start before it in ``order`` (Kasai's pass).

    Kasai's invariant (a start one further on shares at least one byte
    less) holds along each context, so all contexts advance in step.  It
    needs the place after the neighbour to be a start too, and to stand
    before the start in ``order``: not so where the neighbour is the last of
    its context, or where a tie beyond the sorted bytes turns round.  There
    the comparison begins at the first byte.
    """
    before = np.full(len(data) + 1, -1, np.int64)
    before[order[1:]] = order[:-1]
    place = np.full(len(data) + 1, -1, np.int64)
    place[order] = np.arange(len(order))
    lcp = np.zeros(len(data), np.int64)
    longest = np.argsort(-count, kind="stable")
    first, count = first[longest], count[longest]
    share, other = np.zeros(len(first), np.int64), np.full(len(first), -1)
    wide = np.concatenate([key, np.zeros(length + 8, np.uint64)])
    narrow = np.concatenate([data, np.zeros(length + 8, np.uint8)])
    for j in range(int(count.max(initial=0))):
        live = np.searchsorted(-count, -j, "left")  # contexts with more than j starts
        at = first[:live] + j
        after = place[other[:live] + 1]
        other = before[at]
        kept = (after >= 0) & (after < place[at])
        share = np.where((other >= 0) & kept, np.maximum(share[:live] - 1, 0), 0)
        run = np.flatnonzero((other >= 0) & (share + 8 <= length))
        while len(run):
            run = run[wide[at[run] + share[run]] == wide[other[run] + share[run]]]
            share[run] += 8
            run = run[share[run] + 8 <= length]
        run = np.flatnonzero((other >= 0) & (share < length))
        while len(run):
            run = run[narrow[at[run] + share[run]] == narrow[other[run] + share[run]]]
            share[run] += 1
            run = run[share[run] < length]
        lcp[at] = share
    return lcp


def copies_in_shard(bodies: list[bytes], counts: list[int], length: int) -> list[np.ndarray]:
    """For each context which of its starts have a copy in the shard (or in an equal context)."""
    data = np.frombuffer(b"".join(bodies), np.uint8)
    size = np.fromiter(map(len, bodies), np.int64, len(bodies))
    first, starts = np.cumsum(size) - size, size - length + 1
    sa, key = suffix_array(data, length)
    is_start = np.zeros(len(data) + 1, np.int64)
    is_start[first] += 1
    is_start[first + starts] -= 1
    order = sa[np.cumsum(is_start[:-1])[sa] > 0]
    lcp = neighbours_share(data, key, order, first, starts, length)
    copy = np.zeros(len(data), bool)
    same = lcp[order] >= length
    copy[order[same]] = True
    copy[order[:-1][same[1:]]] = True
    return [np.ones(n, bool) if c > 1 else copy[f : f + n] for f, n, c in zip(first.tolist(), starts.tolist(), counts, strict=True)]


def _sharder(length: int, shard_bytes: int):
    names = [x.split()[0] for x in _FOUND.split(", ")]

    def solve(rows: list[dict]) -> pa.RecordBatch:
        out = []
        alone = [len(r) == 1 and not r[0]["own"] for r in _by_class(rows)]
        for single, group in zip(alone, _by_class(rows), strict=True):
            if single:  # one distinct context: all its starts are copies or none is
                group[0]["flags"] = np.full(len(group[0]["body"]) - length + 1, group[0]["copies"] > 1)
        rest = [r for r in rows if "flags" not in r]
        if rest:
            for r, flags in zip(rest, copies_in_shard([r["body"] for r in rest], [r["copies"] for r in rest], length), strict=True):
                r["flags"] = flags
        seen: set[bytes] = set()
        for r in rows:
            flags = np.concatenate([[False], r["flags"], [False]])
            edges = np.flatnonzero(flags[1:] != flags[:-1])
            digests, at = [], []
            if r["part"] >= 0:  # a class in several shards: each distinct string may have a copy in another
                for a in range(len(r["flags"])):
                    d = xxhash.xxh3_128_digest(r["body"][a : a + length])
                    if not r["flags"][a] or d not in seen:
                        digests.append(d)
                        at.append(a)
                        if r["flags"][a]:
                            seen.add(d)
            if len(edges) or digests:
                out.append((r["class"], r["context"], r["part"], edges, digests, at))
        cols = list(zip(*out, strict=True)) or [[]] * 6
        kinds = (pa.int64(), pa.binary(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        size, last = 0, None
        for b in batches:
            for r in b.to_pylist():
                if size >= shard_bytes and (r["class"], r["part"]) != last:
                    yield solve(rows)
                    rows, size = [], 0
                rows.append(r)
                size += len(r["body"])
                last = (r["class"], r["part"])
        if rows:
            yield solve(rows)

    return run


def _by_class(rows: list[dict]) -> list[list[dict]]:
    out: list[list[dict]] = []
    for r in rows:
        if out and (out[-1][0]["class"], out[-1][0]["part"]) == (r["class"], r["part"]):
            out[-1].append(r)
        else:
            out.append([r])
    return out


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests come sorted: binary search finds those that occur twice, a bounded stretch of whole digests at a time."""
    held = None

    def twice(t: pa.Table, d: np.ndarray) -> Iterator[pa.RecordBatch]:
        more = np.searchsorted(d, d, "right") - np.searchsorted(d, d, "left") > 1
        yield from t.select(["class", "context", "at"]).filter(pa.array(more)).combine_chunks().to_batches()

    def digests(t: pa.Table) -> np.ndarray:
        return np.array(t.column("digest").to_pylist(), "S16")

    for b in batches:
        held = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
        if held.num_rows >= _MERGE_ROWS:
            d = digests(held)
            end = int(np.searchsorted(d, d[-1], "left"))  # the last digest may go on
            yield from twice(held.slice(0, end), d[:end])
            held = held.slice(end)
    if held is not None:
        yield from twice(held, digests(held))


def _finisher(length: int):
    names = ["node", "n_removed", "n_spans", "kept_sha"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            out = []
            for node, z, begin, end in zip(*(c.to_pylist() for c in b.columns), strict=True):
                text = unpack.decompress(z)
                spans: list[list[int]] = []
                for s, e in sorted(zip(begin, end, strict=True)):
                    if spans and s <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], e)
                    else:
                        spans.append([s, e])
                kept, at = hashlib.sha256(), 0
                for s, e in spans:
                    kept.update(text[at:s])
                    at = e
                kept.update(text[at:])
                out.append((node, sum(e - s for s, e in spans), len(spans), kept.hexdigest()))
            cols = list(zip(*out, strict=True)) or [[]] * 4
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    return run


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES, class_contexts: int = CLASS_CONTEXTS,
    range_starts: int = RANGE_STARTS, stretch: int = STRETCH,
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, has_repeats) of every document."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    t = materialize(texts.mapInArrow(_scanner(length, gram, range_starts, stretch), _SCANNED).withColumn("row", F.monotonically_increasing_id()), "suffix-rows")
    same = materialize(t.groupBy("text_id").agg(F.min("row").alias("node"), F.count("*").alias("rows")), "suffix-texts")
    nodes = same.select(F.col("node").alias("row"))

    zipped = F.explode(F.arrays_zip("hash", "first", "last", "own")).alias("r")
    r = t.select("row", "hash", "first", "last", "own").join(nodes, "row", "left_semi").select(F.col("row").alias("node"), zipped)
    r = materialize(r.select("node", F.col("r.hash").alias("class"), "r.first", "r.last", "r.own"), "suffix-ranges")
    meet = r.groupBy("class").agg(F.count("*").alias("n"), F.max("own").alias("o")).where("n > 1 or o").select("class")
    meeting = r.join(meet, "class", "left_semi")
    per_node = materialize(meeting.groupBy("node").agg(F.collect_list(F.struct("class", "first", "last", "own")).alias("ranges")), "suffix-meeting")
    release(r)
    with_text = materialize(t.select(F.col("row").alias("node"), "z").join(per_node, "node").select("node", "z", "ranges"), "suffix-meeting-texts")
    ctx = materialize(with_text.mapInArrow(_range_digests(length), _RANGE), "suffix-contexts")

    rep = ctx.groupBy("class", "context").agg(F.min(F.struct("node", "first", "last")).alias("r"), F.count("*").alias("copies"), F.max("own").alias("own"))
    rep = rep.select("class", "context", "r.node", "r.first", "r.last", "copies", "own")
    rep = distinct = materialize(rep, "suffix-distinct")
    crowd = materialize(rep.groupBy("class").agg(F.count("*").alias("n")).where(F.col("n") > class_contexts).select("class", F.ceil(F.col("n") / class_contexts).cast("int").alias("parts")), "suffix-crowds")
    part = F.when(F.col("parts").isNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64("context"), F.col("parts")).cast("int"))
    rep = rep.join(crowd, "class", "left").withColumn("part", part)
    per = rep.groupBy("node").agg(F.collect_list(F.struct("class", "context", "copies", "own", "part", "first", "last")).alias("ranges"))
    body = with_text.select("node", "z").join(per, "node").select("z", "ranges").mapInArrow(_bodies(length), _BODY)
    shard = body.repartition(F.col("class"), F.col("part")).sortWithinPartitions("class", "part", "context")
    found = materialize(shard.mapInArrow(_sharder(length, shard_bytes), _FOUND), "suffix-found")

    runs = found.where(F.size("runs") > 0).select("class", "context", F.explode(F.expr("transform(sequence(0, size(runs) div 2 - 1), i -> struct(runs[2 * i] as a, runs[2 * i + 1] as b))")).alias("x"))
    runs = runs.select("class", "context", "x.a", "x.b")
    written = [per_node, with_text, ctx, distinct, crowd, found]
    if not crowd.isEmpty():
        d = found.where("part >= 0").select("class", "context", F.explode(F.arrays_zip("digests", "digest_at")).alias("x"))
        d = d.select("class", "context", F.col("x.digests").alias("digest"), F.col("x.digest_at").alias("at"))
        across = d.repartition(F.col("digest")).sortWithinPartitions("digest").mapInArrow(_merge, "class long, context binary, at long")
        written.append(materialize(across, "suffix-merged"))
        runs = runs.unionByName(written[-1].select("class", "context", F.col("at").alias("a"), (F.col("at") + 1).alias("b")))
    spans = ctx.select("class", "context", "node", "first").join(runs, ["class", "context"])
    spans = spans.select("node", (F.col("first") + F.col("a")).alias("begin"), (F.col("first") + F.col("b") - 1 + length).alias("end"))
    spans = spans.groupBy("node").agg(F.collect_list(F.struct("begin", "end")).alias("s"))
    cut = with_text.select("node", "z").join(spans, "node").select("node", "z", F.col("s.begin").alias("begin"), F.col("s.end").alias("end"))
    cut = materialize(cut.mapInArrow(_finisher(length), "node long, n_removed long, n_spans long, kept_sha string"), "suffix-cut")
    for table in written:
        release(table)

    out = t.select("doc_id", "n_bytes", "text_id", "sha").join(same, "text_id").join(cut, "node", "left")
    whole = (F.col("rows") > 1) & (F.col("n_bytes") >= length)
    return out.select(
        "doc_id", "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.lit(hashlib.sha256().hexdigest())).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256"),
        (whole | F.col("n_removed").isNotNull()).alias("has_repeats"),
    )
