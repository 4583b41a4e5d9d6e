"""Sharding (operator 10): minimax contiguous partition of whole groups, law ``bytes``.

Rows with equal texts are one atomic group.  Groups are ordered by their
text hash; the smallest capacity for which a greedy pass over the ordered
sizes needs no more than the given shards is found by binary search, and
the order is cut where that pass cuts.  A group larger than the mean of
what is left gets a shard of its own first (any plan's largest shard is at
least that large), and the rest is partitioned over the remaining shards.

The driver never sees the groups.  It works on cells, ranges of the hash
order with their bytes and their largest group: 4,096 at first.  A greedy
shard that ends inside a cell ends at most its largest group before the
capacity, which gives a lower and an upper bound of every cut and so of the
capacity.  Only cells in which a cut can fall between those bounds are split
(16 ways, an equi-join with the parents' numbers and one aggregate), at most
``SPLIT_CELLS`` a round, until the bounds meet.  A round sends 4,096 rows at
the most, whatever the input; large groups only make for more rounds.

Built-in functions only.  Slots count rows within (shard, chunk), where
chunks hold about ``CHUNK_ROWS`` rows each, plus the rows of the chunks
before, so a hot shard is never numbered in one task.

Defined results: null text has size 16 (no bytes) and checksum 0, and all
null texts are one group, as are all empty texts; repeated rows are rows
of one group with slots of their own; an empty table gives an empty table;
only the named columns are read.
"""

from __future__ import annotations

from bisect import bisect_right
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import materialize

ROW_BYTES = 16
CHUNK_ROWS = 50_000
#: Cells that one round splits; each gives at most 2**_MORE_BITS rows.
SPLIT_CELLS = 256
_FIRST_BITS = 12
_MORE_BITS = 4


class Cell(NamedTuple):
    """The groups whose hashes agree but for the last ``shift`` bits."""

    low: int
    high: int
    bytes: int
    largest: int
    shift: int

    @property
    def single(self) -> bool:
        return self.low == self.high


class Cells:
    """Cells in order, and bounds of what a greedy pass over their groups does."""

    def __init__(self, cells: list[Cell]):
        self.cells = sorted(cells)
        self.ends, self.total = [], 0
        for c in self.cells:
            self.total += c.bytes
            self.ends.append(self.total)

    def reach(self, at: int, high: bool) -> int:
        """Where a shard ends that may go up to byte ``at``: a bound of the last group's end."""
        k = bisect_right(self.ends, at)
        start = self.ends[k - 1] if k else 0
        if k == len(self.cells) or self.cells[k].single or at == start:
            return start  # exact: the end of whole cells
        return at if high else max(start, at - self.cells[k].largest + 1)

    def ends_of(self, capacity: int, shards: int, high: bool) -> list[int]:
        """Bounds of the shards' ends (bytes from the start)."""
        at, out = 0, []
        for _ in range(shards):
            at = max(at, self.reach(at + capacity, high))
            out.append(at)
        return out

    def least(self, shards: int, high: bool) -> int:
        """Least capacity that suffices by the bound: too small by the high one, enough by the low one."""
        low, top = max(1, -(-self.total // shards)), max(1, self.total)
        while low < top:
            mid = (low + top) // 2
            if self.ends_of(mid, shards, high)[-1] >= self.total:
                top = mid
            else:
                low = mid + 1
        return low

    def between(self, small: int, large: int, shards: int) -> list[int]:
        """Cells of several groups in which a cut may fall, in order, for capacities from ``small`` to ``large``."""
        a, b, out = 0, 0, {}
        for _ in range(shards):
            first, last = bisect_right(self.ends, a + small), min(bisect_right(self.ends, b + large), len(self.cells) - 1)
            out.update(dict.fromkeys(k for k in range(first, last + 1) if not self.cells[k].single and (first < last or a + small > self.ends[k] - self.cells[k].bytes or b + large > a + small)))
            a, b = max(a, self.reach(a + small, False)), max(b, self.reach(b + large, True))
        return list(out)


def _cell_rows(groups: DataFrame, shift: int) -> DataFrame:
    rows = groups.groupBy(F.shiftright("h", shift).alias("cell")).agg(F.min("h").alias("low"), F.max("h").alias("high"), F.sum("bytes").alias("bytes"), F.max("bytes").alias("largest"))
    return rows.select("low", "high", "bytes", "largest", F.lit(shift).alias("shift"))


def _split(groups: DataFrame, cells: list[Cell]) -> list[Cell]:
    """The cells' parts, by one job: an equi-join with the numbers of the cells of each width."""
    spark, parts = groups.sparkSession, None
    for shift in sorted({c.shift for c in cells}):
        numbers = spark.createDataFrame([(c.low >> shift,) for c in cells if c.shift == shift], "number long")
        inside = groups.join(F.broadcast(numbers), F.shiftright("h", shift) == F.col("number"), "left_semi")  # SPLIT_CELLS rows at most
        rows = _cell_rows(inside, max(0, shift - _MORE_BITS))
        parts = rows if parts is None else parts.unionByName(rows)
    out = [Cell(*r) for r in parts.collect()]
    if len(out) > len(cells) << _MORE_BITS:
        raise AssertionError(f"{len(out)} parts of {len(cells)} cells")
    return out


def minimax_cuts(groups: DataFrame, shards: int, split_cells: int = SPLIT_CELLS) -> tuple[list[int], int]:
    """Highest hash of each shard in order, and the least capacity, for ``groups`` (h, bytes), one row a group."""
    cells = Cells([Cell(*r) for r in _cell_rows(groups, 64 - _FIRST_BITS).collect()])
    if not cells.cells:
        return [], 0
    while True:
        small, large = cells.least(shards, high=True), cells.least(shards, high=False)
        ends = cells.ends_of(large, shards, high=False)
        if small == large and ends == cells.ends_of(large, shards, high=True):
            break
        where = cells.between(small, large, shards)
        if len(where) > split_cells:  # one capacity at a time, its first cuts first
            mid = (small + large) // 2
            where = (cells.between(mid, mid, shards) or where)[:split_cells]
        chosen = [cells.cells[k] for k in where]
        rest = set(where)
        cells = Cells([c for k, c in enumerate(cells.cells) if k not in rest] + _split(groups, chosen))
    out = []
    for e in ends:
        if not out or e > out[-1]:
            out.append(e)
    return [cells.cells[bisect_right(cells.ends, e) - 1].high for e in out], large


def heavy_groups(groups: DataFrame, shards: int, total: int) -> list[tuple[int, int]]:
    """(h, bytes) of groups larger than the mean of what the shards left must hold; fewer than ``shards``."""
    out: list[tuple[int, int]] = []
    for r in groups.orderBy(F.desc("bytes"), "h").limit(shards).collect():
        if shards - len(out) < 2 or r.bytes * (shards - len(out)) <= total:
            break
        out.append((r.h, r.bytes))
        total -= r.bytes
    return out


def assign(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row."""
    text = F.col(text_col).cast("string")
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("h"),
    )
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "shard-rows")
    groups = materialize(rows.groupBy("h").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")), "shard-groups")
    sums = groups.agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).first()
    total, n = sums.bytes or 0, sums.n or 0
    heavy = heavy_groups(groups, shards, total)
    alone = [h for h, _ in heavy]
    cuts, _ = minimax_cuts(groups.where(~F.col("h").isin(alone)) if alone else groups, shards - len(alone))
    # Groups of their own take the last shards, the cut order the first.
    shard = F.lit(0)
    for high in cuts[:-1]:
        shard = shard + (F.col("h") > high).cast("int")
    for k, h in enumerate(alone):
        shard = F.when(F.col("h") == h, F.lit(shards - len(alone) + k)).otherwise(shard)
    chunks = max(1, -(-n // chunk_rows))
    rows = rows.select("doc_id", "size", "text_crc32", shard.cast("int").alias("shard"), F.pmod(F.xxhash64("row"), F.lit(chunks)).cast("int").alias("chunk"), "row")
    counts = rows.groupBy("shard", "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    local = F.row_number().over(Window.partitionBy("shard", "chunk").orderBy("row")) - 1
    out = rows.withColumn("local", local).join(offsets.hint("merge"), ["shard", "chunk"])
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("offset") + F.col("local")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
