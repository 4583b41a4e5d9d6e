"""Token counts (operator 1): a tokenizer compiled to two deterministic transducers.

*Cutter.*  The pattern that cuts a text into pretokens is a transducer over
eleven character classes and twelve states; its transitions emit where a
pretoken starts (at the character read, or at the one before, where the
pattern looks one ahead).  Texts are cut into chunks of ``CHUNK``
characters; for each chunk the map from every entry state to the exit
state is worked out for all chunks at once, the maps are composed by a
parallel prefix scan (a text's first chunk maps every state to one, so
texts do not mix), and each chunk is then run from its known entry state.

*Counter.*  Byte-pair merges are a transducer over bytes whose transitions
carry the change in the number of tokens emitted so far (it can be
negative when a byte joins earlier tokens).  A token sequence is what the
merges give exactly if each neighbouring pair is, so a state needs only
the starts from which a token can still end: for each the place in the
token trie, the token before it and its count.  States and transitions are
compiled when first needed and forgotten together beyond ``MAX_STATES``.

Special strings inside a text are single tokens, as the library has it by
default, and end the text before them.

Defined results: null text counts as empty, with 0 bytes and 0 tokens;
repeated rows are counted one by one; very long texts are counted whole,
in groups of about a million characters; an empty table gives an empty
table; only the named columns are read.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 512
CHUNK = 256
MAX_STATES = 1 << 18
MEMO_PRETOKENS = 1 << 18
_GROUP_CHARS = 1 << 20
_COUNTED = "doc_id long, n_bytes long, n_tokens long"

# Classes of the cutter: letters, with those of the contractions 's 't 'm 'd 're 've 'll apart.
L, STMD, R, V, LL, E, N, APOSTROPHE, SPACE, WHITE, OTHER, PAD = range(12)
# Its states: before a pretoken; in letters, numbers, others; after an apostrophe that may
# begin a contraction, and after 'r 'v 'l; one white character (a space or not); several, by the last.
NEW, LETTERS, NUMBERS, OTHERS, APO, APO_R, APO_V, APO_L, SPACE1, WHITE1, SPACES, WHITES = range(12)
#: Emitted: a pretoken starts here; one starts at the character before.
HERE, BEFORE = 1, 2

_WHITE_SPACE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@cache
def classes() -> np.ndarray:
    """Class of each code point."""
    kinds = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x110000):
        k = unicodedata.category(chr(c))[0]
        if k == "L":
            kinds[c] = L
        elif k == "N":
            kinds[c] = N
    kinds[_WHITE_SPACE] = WHITE
    for chars, k in (("stmd", STMD), ("r", R), ("v", V), ("l", LL), ("e", E), ("'", APOSTROPHE), (" ", SPACE)):
        for c in chars:
            kinds[ord(c)] = k
    return kinds


@cache
def cutter() -> tuple[np.ndarray, np.ndarray]:
    """next[class, state] and emitted[class, state]."""
    letters = (L, STMD, R, V, LL, E)

    def start(c: int) -> tuple[int, int]:
        """A pretoken starts with a character of class c."""
        to = LETTERS if c in letters else {N: NUMBERS, OTHER: OTHERS, APOSTROPHE: APO, SPACE: SPACE1, WHITE: WHITE1}[c]
        return to, HERE

    def follow(c: int) -> tuple[int, int]:
        """A pretoken that began with a space goes on with class c."""
        return (LETTERS if c in letters else NUMBERS if c == N else OTHERS), 0

    def step(s: int, c: int) -> tuple[int, int]:
        if c == PAD:
            return s, 0
        if s in (SPACE1, WHITE1, SPACES, WHITES):
            if c in (SPACE, WHITE):
                return (SPACES if c == SPACE else WHITES), 0
            to, out = follow(c) if s in (SPACE1, SPACES) else start(c)
            return to, out | (BEFORE if s in (SPACES, WHITES) else 0)
        if s == APO and c in (STMD, R, V, LL):
            return {STMD: NEW, R: APO_R, V: APO_V, LL: APO_L}[c], 0
        if s in (APO_R, APO_V, APO_L):
            if c == (LL if s == APO_L else E):
                return NEW, 0
            to, out = step(LETTERS, c)
            return to, out | BEFORE
        if (s == LETTERS and c in letters) or (s == NUMBERS and c == N):
            return s, 0
        if s in (OTHERS, APO) and c in (OTHER, APOSTROPHE):
            return OTHERS, 0
        return start(c)

    table = np.array([[step(s, c) for s in range(12)] for c in range(12)], np.uint8)
    return np.ascontiguousarray(table[..., 0]), np.ascontiguousarray(table[..., 1])


def pretoken_starts(text: str, lengths: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """Where pretokens start in ``text``, the concatenation of parts of the given lengths (in characters)."""
    nxt, emits = cutter()
    kinds = classes()[np.frombuffer(text.encode("utf-32-le"), "<u4")]
    lengths = lengths[lengths > 0]
    ends = np.cumsum(lengths)
    per = -(-lengths // chunk)
    first = np.cumsum(per) - per  # each part's first chunk
    part = np.repeat(np.arange(len(lengths)), per)
    begin = (ends - lengths)[part] + (np.arange(len(part)) - first[part]) * chunk
    size = np.minimum(chunk, ends[part] - begin)
    place = begin[:, None] + np.arange(chunk)
    cls = np.where(np.arange(chunk) < size[:, None], kinds[np.minimum(place, len(kinds) - 1)], PAD)
    by_step = np.ascontiguousarray(cls.T)

    # Each chunk's state map, for all entry states at once.
    maps = np.broadcast_to(np.arange(12, dtype=np.uint8), (len(part), 12))
    flat, row = nxt.ravel(), by_step.astype(np.uint16) * 12
    for j in range(chunk):
        maps = flat[row[j][:, None] + maps]
    maps[first] = maps[first][:, [NEW]]  # a part begins anew, whatever stood before
    # Parallel prefix scan of the maps: after it, row i maps an entry state before chunk 0 to the exit of chunk i.
    d = 1
    while d < len(maps):
        maps = np.concatenate([maps[:d], np.take_along_axis(maps[d:], maps[:-d], axis=1)])
        d *= 2
    state = np.concatenate([[NEW], maps[:-1, NEW]]).astype(np.uint16)
    state[first] = NEW

    out = np.empty((chunk, len(part)), np.uint8)
    flat_emits = emits.ravel()
    for j in range(chunk):
        at = row[j] + state
        out[j], state = flat_emits[at], flat[at].astype(np.uint16)
    starts = np.zeros(len(kinds), bool)
    out = out.T
    starts[place[(out & HERE) > 0]] = True
    starts[place[(out & BEFORE) > 0] - 1] = True
    last = first + per - 1  # a part that ends in 'r, 'v or 'l: that letter is a pretoken
    open_end = np.isin(state[last], (APO_R, APO_V, APO_L))
    starts[ends[open_end] - 1] = True
    return np.flatnonzero(starts)


class MergeCounter:
    """The counting transducer of byte-pair merges, compiled as texts ask for its states.

    Tokens are numbered: bytes first, then the merges by rank.
    """

    def __init__(self, merges: list[tuple[bytes, bytes]]):
        number = {bytes([b]): b for b in range(256)}
        self.halves: list[tuple[int, int] | None] = [None] * 256
        self.merge: dict[tuple[int, int], int] = {}
        for a, b in merges:
            if a + b in number:
                raise ValueError("two merges make the same token")
            pair = (number[a], number[b])
            self.merge[pair] = number[a + b] = len(number)
            self.halves.append(pair)
        # Trie of the tokens: child[node][byte]; the token that ends at a node, -1 for none.
        self.child: list[dict[int, int]] = [{}]
        self.ends = [-1]
        for t, n in number.items():
            node = 0
            for b in t:
                if b not in self.child[node]:
                    self.child[node][b] = len(self.child)
                    self.child.append({})
                    self.ends.append(-1)
                node = self.child[node][b]
            self.ends[node] = n
        self.bytes_of = list(number)
        self.forget()

    def forget(self) -> None:
        """Back to the first state: nothing read, no token before."""
        self.states: list[tuple] = [((0, -1, 0),)]
        self.number = {self.states[0]: 0}
        self.step: dict[int, tuple[int, int]] = {}
        self.pairs: dict[int, bool] = {}
        self.alone: dict[int, bool] = {}
        self.edges: dict[int, list[tuple[int, int]]] = {}

    def merged(self, data: bytes) -> list[int]:
        """Tokens of a short string by its merges, lowest rank first, leftmost first."""
        parts = list(data)
        while True:
            found = [(m, i) for i, pair in enumerate(zip(parts, parts[1:], strict=False)) if (m := self.merge.get(pair)) is not None]
            if not found:
                return parts
            m, i = min(found)
            parts[i : i + 2] = [m]

    def edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The parts that stand at one edge of a token while it is made (side 0: left, 1: right), each with the token that takes it up."""
        key = token * 2 + side
        if key not in self.edges:
            out, taken = [], 1 << 60
            while True:
                out.append((token, taken))
                if self.halves[token] is None:
                    break
                token, taken = self.halves[token][side], token
            self.edges[key] = out
        return self.edges[key]

    def goes(self, before: int, token: int) -> bool:
        """Whether the merges leave ``token`` whole after ``before`` (-1: at the start).

        Not if some merge joins a part at the right edge of ``before`` and
        one at the left edge of ``token`` while both still stand; of equal
        ranks the merge further left comes first.
        """
        whole = self.alone.get(token)
        if whole is None:
            whole = self.alone[token] = self.merged(self.bytes_of[token]) == [token]
        if before < 0 or not whole:
            return whole
        key = before << 24 | token
        known = self.pairs.get(key)
        if known is None:
            get = self.merge.get
            right = self.edge(token, 0)
            known = self.pairs[key] = not any(
                (m := get((a, b))) is not None and m < a_taken and m <= b_taken for a, a_taken in self.edge(before, 1) for b, b_taken in right
            )
        return known

    def _compile(self, state: int, byte: int) -> tuple[int, int]:
        items, last, change = [], -1, 0
        for node, before, count in self.states[state]:
            node = self.child[node].get(byte)
            if node is None:
                continue
            token = self.ends[node]
            if token >= 0 and last < 0 and self.goes(before, token):
                last, change = token, count + 1
            if self.child[node]:
                items.append((node, before, count))
        # Counts are kept relative to the tokens emitted so far.
        key = (*((n, b, c - change) for n, b, c in items), (0, last, 0))
        if key not in self.number:
            self.number[key] = len(self.states)
            self.states.append(key)
        self.step[state << 8 | byte] = out = (self.number[key], change)
        return out

    def count(self, data: bytes) -> int:
        if len(self.states) > MAX_STATES:
            self.forget()
        state = total = 0
        step = self.step
        for b in data:
            to = step.get(state << 8 | b) or self._compile(state, b)
            state = to[0]
            total += to[1]
        return total


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: themselves if printable, else from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Counter(dict):
    """Token counts of texts by a byte-level tokenizer file; remembers pretokens."""

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))  # noqa: SIM115
        letters = byte_letters()
        raw = lambda s: bytes(letters[c] for c in s)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.merges = MergeCounter([(raw(a), raw(b)) for a, b in merges])
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None

    def __missing__(self, pretoken: str) -> int:
        if len(self) >= MEMO_PRETOKENS:
            self.clear()
        n = self[pretoken] = self.merges.count(pretoken.encode())
        return n

    def of(self, texts: list[str]) -> np.ndarray:
        parts, owner, total = [], [], np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            cut = self.special.split(t) if self.special else [t]
            total[i] += len(cut) - 1
            parts += cut
            owner += [i] * len(cut)
        text = "".join(parts)
        if text:
            lengths = np.fromiter(map(len, parts), np.int64, len(parts))
            starts = pretoken_starts(text, lengths)
            edges = starts.tolist()
            counts = np.fromiter(map(self.__getitem__, map(text.__getitem__, map(slice, edges, [*edges[1:], len(text)]))), np.int64, len(edges))
            part = np.searchsorted(np.cumsum(lengths), starts, "right")
            np.add.at(total, np.array(owner)[part], counts)
        return total


_COUNTERS: dict[str, Counter] = {}  # of this Python worker


def counter(path: str) -> Counter:
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for b in batches:
            texts, n, at = ["" if t is None else t for t in b.column(1).to_pylist()], [], 0
            while at < len(texts):
                to, size = at, 0
                while to < len(texts) and (to == at or size + len(texts[to]) <= _GROUP_CHARS):
                    size += len(texts[to])
                    to += 1
                n.append(c.of(texts[at:to]))
                at = to
            n_bytes = pa.array([len(t.encode()) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), n_bytes, pa.array(np.concatenate([[], *n]).astype(np.int64))], names=["doc_id", "n_bytes", "n_tokens"])

    return run


def count_tokens(docs: DataFrame, vocabulary: str | None = None, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every document, by a byte-level tokenizers file."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(_count(path), _COUNTED).withColumn("over_limit", F.col("n_tokens") > limit)
