"""Packing (operator 4): minimum bin slack over the lengths that are left.

Each document becomes token ids and an end id.  Every full window of a
long document is a sequence of its own; the rests (1 to window - 1 ids)
are packed.  What matters for packing is only how many rests have each
length, at most window - 1 numbers, so the driver plans on this histogram
however many documents there are:

* the longest length left opens a sequence, and a bitset subset-sum over
  the lengths left (with their counts) finds the multiset that fills it
  closest to the window, traced back to counts per length;
* that pattern is repeated as often as the counts allow, which uses up at
  least one length, so there are at most window - 1 patterns;
* a length with which no multiset fills a sequence exactly is set aside
  with all its rests.  Those are laid end to end and cut at every window,
  and the last, shorter stretch is cut into powers of two, which need no
  padding.

Rests of one length are numbered in chunks (so a length that a third of
all documents share is not numbered in one task), and rest ``i`` of a
length finds its sequence and offset by binary search in the plan's ranges.

Defined results: null text is empty and yields only the end id; repeated
rows are packed one by one; very long texts are tokenised whole and give
one row a piece; an empty table gives an empty table; only the named
columns are read.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskloom.llm.common import materialize

# One task has one core; the library's own threads would only add to it.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

WINDOW = 4096
END_ID = 2
VOCABULARY = "word_bpe_49k.json"
CHUNK_ROWS = 50_000
#: Words whose ids a Python worker remembers before a new generation starts; two are kept.
MEMO_WORDS = 600_000
_GROUP_BYTES = 4 << 20

_TOKENIZED = "doc_id long, n long, crcs array<long>, ids binary"
_PLACED = "row long, doc_id long, n long, start long, length long, crc long, sequence_id long, offset long"


class WordTokenizer:
    """Ids of UTF-8 texts by a tokenizer that lower-cases and whose tokens never span white space.

    The library is asked once for each word: lower-cased in A-Z and without
    the ASCII punctuation and symbols around it, which such a tokenizer always
    cuts off where a letter or digit stands next to it (an apostrophe is not
    taken for punctuation, as it begins contractions).  Texts with ``<|``, which may
    hold special strings, go to the library whole.
    """

    _LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
    _MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
    _ALNUM = frozenset(b"abcdefghijklmnopqrstuvwxyz0123456789")

    @staticmethod
    def _latin(two: bytes) -> bool:
        """Whether two bytes are one letter from U+00C0 to U+024F."""
        return len(two) == 2 and 0xC3 <= two[0] <= 0xC9 and 0x80 <= two[1] <= 0xBF and two.decode().isalpha()

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.memo: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _pieces(self, word: bytes) -> tuple[bytes, ...]:
        """A word cut at its marks if that is exact, else the word."""
        core = word.strip(self._MARKS)
        if len(core) == len(word) or not core:
            return (word,)
        if not (core[0] in self._ALNUM or self._latin(core[:2])) or not (core[-1] in self._ALNUM or self._latin(core[-2:])):
            return (word,)
        at = word.index(core)
        return tuple(x for x in (word[:at], core, word[at + len(core) :]) if x)

    def _known(self, words: list[bytes]) -> list[bytes]:
        """Ids of each of some distinct words."""
        if len(self.memo) > MEMO_WORDS:  # words not met again in the next generation go
            self.old, self.memo = self.memo, {}
        memo, old = self.memo, self.old
        fresh = [w for w in words if w not in memo]
        if old:
            for w in fresh:
                if w in old:
                    memo[w] = old[w]
            fresh = [w for w in fresh if w not in memo]
        fresh = [(w, self._pieces(w)) for w in fresh]
        bare = list({p for _, x in fresh for p in x if p not in memo})
        for w, e in zip(bare, self.tokenizer.encode_batch_fast([x.decode() for x in bare], add_special_tokens=False), strict=True):
            memo[w] = array("I", e.ids).tobytes()
        for w, x in fresh:
            if len(x) > 1:
                memo[w] = b"".join([memo[y] for y in x])
        return [memo[w] for w in words]

    def _plain(self, texts: list[bytes]) -> list[bytes]:
        """Ids of texts without special strings: Arrow cuts and numbers their words, each distinct word is looked up once."""
        cut = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.binary()).cast(pa.large_string())))
        number = cut.values.dictionary_encode()
        words = number.dictionary.cast(pa.large_binary()).to_pylist()
        ids = self._known([w for w in words if w])
        if len(ids) < len(words):  # white space at either end leaves empty words
            ids.insert(words.index(b""), b"")
        size = np.array([len(x) // 4 for x in ids], np.int64)
        flat, begin = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(size) - size
        word = number.indices.to_numpy()
        many = size[word]
        end = np.cumsum(many)
        out = flat[np.repeat(begin[word] - end + many, many) + np.arange(many.sum())]
        at = np.concatenate([[0], end])[cut.offsets.to_numpy()]
        return [out[a:b].tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]

    def of(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        plain = iter(self._plain([t for t in texts if b"<|" not in t]))
        whole = lambda t: array("I", self.tokenizer.encode(t.decode(), add_special_tokens=False).ids).tobytes()
        return [whole(t) if b"<|" in t else next(plain) for t in texts]


_TOKENIZERS: dict[str, WordTokenizer] = {}  # of this Python worker


def word_tokenizer(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def _groups(texts: list[bytes]) -> Iterator[list[bytes]]:
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= _GROUP_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part


def _tokenize(path: str, window: int, end_id: int):
    end = np.array([end_id], "<u4").tobytes()
    names = [x.split()[0] for x in _TOKENIZED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_tokenizer(path)
        for b in batches:
            at = 0
            for part in _groups([t or b"" for t in b.column(1).cast(pa.binary()).to_pylist()]):
                n, crcs, kept = [], [], []
                for ids in words.of(part):
                    ids += end
                    n.append(len(ids) // 4)
                    crcs.append([zlib.crc32(ids[i : i + 4 * window]) for i in range(0, len(ids), 4 * window)])
                    kept.append(_shrunk(ids[len(ids) - len(ids) % (4 * window) :]))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, len(part)), pa.array(n, pa.int64()), pa.array(crcs, pa.list_(pa.int64())), pa.array(kept, pa.binary())], names=names
                )
                at += len(part)

    return run


def _shrunk(ids: bytes) -> bytes:
    """32-bit ids, in 16 bits each after a 0 byte where all of them fit."""
    a = np.frombuffer(ids, "<u4")
    return b"\0" + a.astype("<u2").tobytes() if len(a) == 0 or a.max() < 1 << 16 else b"\1" + ids


def _grown(data: bytes) -> bytes:
    return data[1:] if data[:1] == b"\1" else np.frombuffer(data[1:], "<u2").astype("<u4").tobytes()


def closest_fill(capacity: int, lengths: list[int], counts: dict[int, int]) -> dict[int, int]:
    """The multiset of ``lengths`` (descending; at most ``counts`` of each) with the largest sum up to ``capacity``.

    Bit s of the set is on if some multiset sums to s.  Copies are taken
    in powers of two; the sets between them are kept for the way back.
    """
    full = (1 << (capacity + 1)) - 1
    reach, steps, goal = 1, [], 1 << capacity
    for length in lengths:
        if length > capacity:
            continue
        left, copies = min(counts[length], capacity // length), 1
        while left > 0:
            take = min(copies, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & full
            left -= take
            copies *= 2
        if reach & goal:
            break
    total, used = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            used[length] = used.get(length, 0) + take
            total -= length * take
    return used


class Plan:
    """Where rest ``i`` of each length goes; built from the counts by length alone."""

    def __init__(self, counts: dict[int, int], window: int = WINDOW, first_sequence: int = 0):
        left = {k: v for k, v in counts.items() if v > 0}
        self.window, taken, ranges, sequence = window, dict.fromkeys(left, 0), {k: [] for k in left}, first_sequence
        lengths, aside = sorted(left, reverse=True), []
        while lengths:
            top = lengths[0]
            left[top] -= 1
            used = closest_fill(window - top, lengths, left)
            left[top] += 1
            used[top] = used.get(top, 0) + 1
            if sum(k * v for k, v in used.items()) < window:
                aside.append(top)  # less is left later, so it will not fill then either
                lengths = lengths[1:]
                continue
            times, offset = min(left[k] // v for k, v in used.items()), 0
            for k, v in sorted(used.items(), reverse=True):
                ranges[k].append((taken[k], v, sequence, offset))
                taken[k] += times * v
                left[k] -= times * v
                offset += k * v
            sequence += times
            lengths = [k for k in lengths if left[k]]
        # The rests that no multiset fills exactly: end to end, in order of length.
        self.stream_base, self.stream_sequence, at = {}, sequence, 0
        for k in aside:
            self.stream_base[k] = at
            at += k * left[k]
        self.taken, self.stream_length = taken, at
        self.ranges = {k: np.array(v, np.int64).reshape(-1, 4) for k, v in ranges.items()}
        whole = at - at % window
        self.tail = [whole]  # starts of the sequences after the last full window
        for bit in reversed(range(window.bit_length())):
            if (at % window) >> bit & 1:
                self.tail.append(self.tail[-1] + (1 << bit))

    def place(self, length: int, number: int) -> list[tuple[int, int, int, int]]:
        """(start in the rest, length, sequence, offset) of each piece of a rest."""
        if number < self.taken[length]:
            r = self.ranges[length]
            first, uses, sequence, offset = r[np.searchsorted(r[:, 0], number, "right") - 1].tolist()
            times, k = divmod(number - first, uses)
            return [(0, length, sequence + times, offset + k * length)]
        at, out, done = self.stream_base[length] + (number - self.taken[length]) * length, [], 0
        while done < length:
            p = at + done
            if p < self.tail[0]:
                k, begin, end = p // self.window, p - p % self.window, p - p % self.window + self.window
            else:
                j = max(i for i, x in enumerate(self.tail) if x <= p)
                k, begin, end = self.tail[0] // self.window + j, self.tail[j], self.tail[j + 1]
            size = min(length - done, end - p)
            out.append((done, size, self.stream_sequence + k, p - begin))
            done += size
        return out


def _placer(plan: Plan):
    names = [x.split()[0] for x in _PLACED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for row, doc, n, start, length, crc, number in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if length == plan.window:
                    rows.append((row, doc, n, start, length, crc, number, 0))
                    continue
                pieces = plan.place(length, number)
                rows += [(row, doc, n, start + s, size, crc if len(pieces) == 1 else None, q, o) for s, size, q, o in pieces]
            cols = list(zip(*rows, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=names)

    return run


def _rest_crcs(window: int):
    names = [x.split()[0] for x in _PLACED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            crc = []
            for start, length, ids in zip(*(b.column(i).to_pylist() for i in (3, 4, 8)), strict=True):
                at = 4 * (start % window)
                crc.append(zlib.crc32(_grown(ids)[at : at + 4 * length]))
            cols = list(b.columns[:8])
            cols[5] = pa.array(crc, pa.int64())
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def pack(docs: DataFrame, window: int = WINDOW, end_id: int = END_ID, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text", chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every piece.

    ``vocabulary`` is the path of a tokenizers file whose tokens never
    span white space, by default the public one named above.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    t = materialize(texts.mapInArrow(_tokenize(path, window, end_id), _TOKENIZED).withColumn("row", F.monotonically_increasing_id()), "pack-ids")

    pieces = t.select("row", "doc_id", "n", F.posexplode("crcs").alias("i", "crc"))
    pieces = pieces.select("row", "doc_id", "n", (F.col("i").cast("long") * window).alias("start"), F.least(F.lit(window), F.col("n") - F.col("i") * window).cast("long").alias("length"), "crc")
    total = t.agg(F.count("*")).first()[0]
    chunks = max(1, -(-total // chunk_rows))
    pieces = pieces.withColumn("chunk", F.pmod(F.xxhash64("row"), F.lit(chunks)).cast("int"))
    counts = materialize(pieces.groupBy("length", "chunk").agg(F.count("*").alias("pieces")), "pack-counts")
    histogram = {r.length: r.pieces for r in counts.groupBy("length").agg(F.sum("pieces").alias("pieces")).collect()}
    whole = histogram.pop(window, 0)
    plan = Plan(histogram, window, first_sequence=whole)

    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "chunk", F.coalesce(F.sum("pieces").over(before), F.lit(0)).alias("first"))
    local = F.row_number().over(Window.partitionBy("length", "chunk").orderBy("row", "start")) - 1
    numbered = pieces.withColumn("local", local).join(offsets.hint("merge"), ["length", "chunk"])
    numbered = numbered.select("row", "doc_id", "n", "start", "length", "crc", (F.col("first") + F.col("local")).cast("long").alias("number"))
    placed = materialize(numbered.mapInArrow(_placer(plan), _PLACED), "pack-placed")
    # Cut rests need the checksums of their parts; Spark broadcasts them only if their file is small.
    cut = materialize(placed.where("crc is null"), "pack-cut")
    mended = cut.join(t.select("row", "ids"), "row").select(*cut.columns, "ids").mapInArrow(_rest_crcs(window), _PLACED)
    out = placed.where("crc is not null").unionByName(mended)
    return out.select("doc_id", "start", "length", F.col("crc").alias("ids_crc32"), F.col("n").alias("doc_tokens"), "sequence_id", "offset")
