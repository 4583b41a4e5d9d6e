"""Target-distribution importance resampling (operator 12) with a position-table CRC.

Features are word n-grams, hashed into buckets by CRC-32.  A bucket's gain
is the log ratio of its smoothed frequency in the target texts to that in
all documents; a document's weight is the sum of its features' gains, and
adding Gumbel noise that depends on its id alone makes the highest scores a
draw without replacement.

*Position-table CRC.*  CRC-32 is linear over XOR: the value of a span is
the XOR of one term for each byte, which depends on the byte and on how far
it stands from the end, and of a constant for the span's length.  The table
of terms covers ``DISTANCE`` places; all spans of a stretch of text are
hashed at once by a gather and ``bitwise_xor.reduceat``.  A longer span is
cut into blocks of ``DISTANCE`` bytes from its end, whose values are folded
in pairs: a table for each doubling moves a value over that many bytes.

*Counting.*  Each task adds its documents' buckets into one array and sends
one row a bucket it saw, so counts and gains have as many rows as there are
buckets, a parameter; the gains go to the tasks as one array of that size.

*Drawing.*  Rows are range-partitioned and sorted by (eligible, score, id),
written with their place, and ranked by the place plus the rows of the
ranges before: nothing is sorted in one task or sent to the driver.

Bounds: texts are taken in stretches of ``STRETCH`` bytes, cut between
words; only a single word longer than that is taken as one piece.

Defined results: a null or empty text has no features and weight 0; a null
id takes noise from the empty id and stands after all ids in ties; equal
ids tie and are put in order of weight and feature count, so repeated rows
take neighbouring ranks; with no documents or no target texts all counts
are 0 and the smoothing alone decides; an empty table gives an empty table;
only the named columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import materialize, release

BUCKETS = 10_000
WORDS = 1
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
DISTANCE = 64
STRETCH = 1 << 20
_POLYNOMIAL = 0xEDB88320  # CRC-32 of IEEE 802.3, reflected: a fixed value
_SPACE = 0x20


# --- the checksum ----------------------------------------------------------------------


@lru_cache
def _byte_table() -> np.ndarray:
    """CRC register after one byte, from an empty register."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> np.uint32(1)) ^ np.uint32(_POLYNOMIAL), t >> np.uint32(1))
    return t


@lru_cache
def position_table() -> np.ndarray:
    """[distance from the end, byte] -> that byte's term of the register."""
    step, rows = _byte_table(), [_byte_table()]
    for _ in range(DISTANCE - 1):
        t = rows[-1]
        rows.append((t >> np.uint32(8)) ^ step[t & np.uint32(255)])
    return np.stack(rows)


@lru_cache
def _length_constants() -> np.ndarray:
    return np.array([zlib.crc32(bytes(n)) for n in range(DISTANCE + 1)], np.uint32)


def _length_constant(n: int) -> int:
    """CRC of n zero bytes: what the register's start and final inversion add for a span of n bytes."""
    value, block = 0, bytes(1 << 16)
    for _ in range(n >> 16):
        value = zlib.crc32(block, value)
    return zlib.crc32(block[: n & 0xFFFF], value)


@lru_cache
def _mover(level: int) -> np.ndarray:
    """[byte of the register, its value] -> the register moved over DISTANCE * 2**level zero bytes."""
    if level == 0:
        t = position_table()[DISTANCE - 1]  # moved over DISTANCE bytes, counting the byte itself
        out = [t]  # the register's lowest byte is the one that meets the next byte first
        step = _byte_table()
        for b in range(1, 4):
            r = np.arange(256, dtype=np.uint32) << np.uint32(8 * b)
            for _ in range(DISTANCE):
                r = (r >> np.uint32(8)) ^ step[r & np.uint32(255)]
            out.append(r)
        return np.stack(out)
    return np.stack([_moved(_moved(np.arange(256, dtype=np.uint32) << np.uint32(8 * b), level - 1), level - 1) for b in range(4)])


def _moved(registers: np.ndarray, level: int) -> np.ndarray:
    t = _mover(level)
    return t[0][registers & np.uint32(255)] ^ t[1][(registers >> np.uint32(8)) & np.uint32(255)] ^ t[2][(registers >> np.uint32(16)) & np.uint32(255)] ^ t[3][registers >> np.uint32(24)]


def _long_crc(data: np.ndarray) -> int:
    """CRC of one span longer than the table: blocks from its end, folded in pairs."""
    table, blocks = position_table(), -(-len(data) // DISTANCE)
    values, distances = np.empty(blocks, np.uint32), np.arange(DISTANCE - 1, -1, -1)
    head = len(data) - (blocks - 1) * DISTANCE
    values[0] = np.bitwise_xor.reduce(table[distances[DISTANCE - head :], data[:head]])
    for a in range(0, blocks - 1, 4096):  # a bounded gather at a time
        part = data[head + a * DISTANCE : head + min(blocks - 1, a + 4096) * DISTANCE].reshape(-1, DISTANCE)
        values[a + 1 : a + 1 + len(part)] = np.bitwise_xor.reduce(table[distances, part], axis=1)
    level = 0
    while len(values) > 1:
        if len(values) % 2:
            values = np.concatenate([np.zeros(1, np.uint32), values])  # an empty block before adds nothing
        values = _moved(values[0::2], level) ^ values[1::2]
        level += 1
    return int(values[0]) ^ _length_constant(len(data))


def span_crcs(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """CRC-32 of ``data[first[i]:last[i]]`` for spans in order that are not empty."""
    out = np.empty(len(first), np.uint32)
    size = last - first
    short = np.flatnonzero(size <= DISTANCE)
    if len(short):
        f, n = first[short], size[short]
        ends = np.cumsum(n)
        starts = ends - n
        place = np.arange(int(ends[-1])) - np.repeat(starts, n)
        terms = position_table()[np.repeat(n, n) - 1 - place, data[np.repeat(f, n) + place]]
        out[short] = np.bitwise_xor.reduceat(terms, starts) ^ _length_constants()[n]
    for i in np.flatnonzero(size > DISTANCE).tolist():
        out[i] = _long_crc(data[int(first[i]) : int(last[i])])
    return out


# --- features --------------------------------------------------------------------------


@lru_cache
def _letters() -> np.ndarray:
    """Byte -> itself, A-Z as a-z, or 0 where no word goes on."""
    t = np.zeros(256, np.uint8)
    for a, b in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
        t[a : b + 1] = np.arange(a, b + 1)
    t[0x41:0x5B] = np.arange(0x61, 0x7B)
    return t


def _stretch_features(texts: list[bytes], seen: list[int], words: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(index of the text, CRC) of every run of up to ``words`` words of some pieces of texts, and how many are single words.

    The first ``seen`` words of a piece have been counted with the piece before.
    """
    data = _letters()[np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)]
    inside = data != 0
    edge = np.diff(np.concatenate([[False], inside]).astype(np.int8))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    of = np.searchsorted(ends, first, "right")
    new = np.arange(len(of)) - np.searchsorted(of, of, "left") >= np.array(seen, np.int64)[of]
    found, owner = [span_crcs(data, first[new], last[new])], [of[new]]
    if words > 1 and len(of):  # runs of words, one space between
        n = last - first
        starts = np.cumsum(n + 1) - (n + 1)
        joined = np.full(int(starts[-1] + n[-1]), _SPACE, np.uint8)
        place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        joined[np.repeat(starts, n) + place] = data[np.repeat(first, n) + place]
        for k in range(2, words + 1):
            whole = np.flatnonzero((of[: len(of) - k + 1] == of[k - 1 :]) & new[k - 1 :])
            found.append(span_crcs(joined, starts[whole], starts[whole + k - 1] + n[whole + k - 1]))
            owner.append(of[whole])
    return np.concatenate(owner), np.concatenate(found), int(new.sum())


def _stretches(text: bytes, words: int) -> Iterator[tuple[bytes, int]]:
    """A text in pieces cut between words, each after the first with the ``words`` - 1 words before it (their number besides)."""
    if len(text) <= STRETCH:
        yield text, 0
        return
    view, at, back, seen, table = np.frombuffer(text, np.uint8), 0, 0, 0, _letters()
    while at < len(text):
        end = min(len(text), at + STRETCH)
        while end < len(text) and table[view[end]]:  # a word goes on: to its end
            more = np.flatnonzero(table[view[end : end + STRETCH]] == 0)
            end = end + int(more[0]) if len(more) else min(len(text), end + STRETCH)
        yield text[at - back : end], seen
        if words > 1:
            inside = np.concatenate([[False], table[view[at - back : end]] != 0])
            first = np.flatnonzero(inside[1:] & ~inside[:-1])[-(words - 1) :]
            seen = len(first)
            back = end - (at - back) - int(first[0]) if seen else 0
        at = end


def features(texts: list[bytes], words: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(index of the text, bucket) arrays, a bounded stretch at a time; the first so many are single words."""
    held: list[bytes] = []
    number: list[int] = []
    before: list[int] = []
    size = 0

    def flush() -> tuple[np.ndarray, np.ndarray, int]:
        of, crc, single = _stretch_features(held, before, words)
        return np.array(number, np.int64)[of], crc.astype(np.int64) % buckets, single

    for i, text in enumerate(texts):
        for piece, seen in _stretches(text, words):
            if held and size + len(piece) > STRETCH:
                yield flush()
                held, number, before, size = [], [], [], 0
            held.append(piece)
            number.append(i)
            before.append(seen)
            size += len(piece)
    if held:
        yield flush()


# --- jobs ------------------------------------------------------------------------------


def _count_buckets(words: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for _, bucket, _ in features([t or b"" for t in b.column(0).cast(pa.binary()).to_pylist()], words, buckets):
                total += np.bincount(bucket, minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, text_col: str = "text", words: int = WORDS, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all texts."""
    rows = texts.select(F.col(text_col).cast("string").alias("text")).mapInArrow(_count_buckets(words, buckets), "bucket long, n long")
    return rows.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text_col: str = "text", target_text_col: str = "text", words: int = WORDS, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) of every bucket: floor(1000 ln of the ratio of smoothed frequencies)."""
    s = bucket_counts(docs, text_col, words, buckets).select("bucket", F.col("n").alias("s"))
    t = bucket_counts(target, target_text_col, words, buckets).select("bucket", F.col("n").alias("t"))
    every = docs.sparkSession.range(buckets).select(F.col("id").alias("bucket"))
    cells = materialize(every.join(s, "bucket", "left").join(t, "bucket", "left").na.fill(0, ["s", "t"]), "resample-buckets")
    total = cells.agg(F.struct(F.sum("s").alias("s"), F.sum("t").alias("t"))).scalar()
    both = cells.withColumn("all", total)
    ratio = ((F.col("t") + 1).cast("double") * (F.col("all.s") + buckets)) / ((F.col("s") + 1).cast("double") * (F.col("all.t") + buckets))
    return both.select("bucket", F.floor(F.lit(1000.0) * F.log(ratio)).cast("long").alias("gain"))


def _weigh(gain: np.ndarray, words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or b"" for t in b.column(1).cast(pa.binary()).to_pylist()]
            n, n_words, weight = (np.zeros(len(texts), np.int64) for _ in range(3))
            for of, bucket, single in features(texts, words, len(gain)):
                n += np.bincount(of, minlength=len(texts))
                n_words += np.bincount(of[:single], minlength=len(texts))
                weight += np.bincount(of, gain[bucket], len(texts)).astype(np.int64)  # whole numbers far below 2**53
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n), pa.array(n_words), pa.array(weight)], names=["doc_id", "n_features", "n_words", "weight"])

    return run


def scores(docs: DataFrame, gain: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, n_words, weight, score) of every document."""
    table = np.array([r.gain for r in gain.orderBy("bucket").collect()], np.int64)  # one number a bucket
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.mapInArrow(_weigh(table, words), "doc_id long, n_features long, n_words long, weight long")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")
    return rows.withColumn("score", F.col("weight") + noise)


def draw(scored: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """``scored`` with ``rank``: the highest scores of the eligible rows, ties to smaller ids; null if not drawn."""
    order = [F.desc("eligible"), F.desc("score"), F.asc_nulls_last("doc_id"), F.desc("weight"), F.desc("n_features")]
    rows = materialize(scored.withColumn("eligible", F.col("n_words") >= min_words), "resample-scores")
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    placed = materialize(placed, "resample-places")  # (range, place in it) in one number, fixed by the file
    release(rows)
    placed = placed.withColumn("part", F.shiftright("place", 33))
    # One row a range of the sort.
    per = placed.groupBy("part").agg(F.count("*").alias("n"), F.sum(F.col("eligible").cast("long")).alias("e"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), F.sum("e").over(Window.partitionBy(F.lit(0))).alias("all"))
    rank = F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    drawn = F.col("eligible") & (rank <= F.call_function("div", F.col("all") * percent, F.lit(100)))
    return placed.join(per, "part").select("doc_id", "n_features", "weight", "score", F.when(drawn, rank).cast("long").alias("rank"))


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text",
    words: int = WORDS, buckets: int = BUCKETS, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document."""
    gain = gains(docs, target, text_col, target_text_col, words, buckets)
    return draw(scores(docs, gain, id_col, text_col, words, seed), percent, min_words)
