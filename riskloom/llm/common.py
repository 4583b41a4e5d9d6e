"""Helpers shared by the operators: written intermediate tables, word hashes, components.

Words are runs of anything but ASCII white space (``[^\\x20\\x09-\\x0D]+``),
which is exactly what ``bytes.split()`` cuts on UTF-8 bytes.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import scratch_path

#: ASCII white space between words.
WHITE = b" \t\n\x0b\x0c\r"

_MASK = (1 << 64) - 1
#: Most words whose hashes a Python worker remembers; beyond it the memory starts anew.
MEMO_WORDS = 1 << 16


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage: a lost executor never makes a later step recompute
    (or renumber) what stands before.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def release(written: DataFrame) -> None:
    """Delete a table of ``materialize`` that nothing reads any more."""
    try:
        context = written.sparkSession.sparkContext
    except Exception:  # noqa: BLE001 - Connect has no SparkContext; the table stays
        return
    path = context._jvm.org.apache.hadoop.fs.Path(written.written_to)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


class WordHashes(dict):
    """Word bytes -> 64-bit hash, remembered up to ``MEMO_WORDS`` words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (bijective), elementwise on uint64."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word shingles in order; of fewer words, the whole sequence is one."""
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint64)
    k = min(n, k)
    out = np.full(n - k + 1, np.uint64(k), np.uint64)
    for j in range(k):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + words[j : n - k + 1 + j])
    return out


def signed(x: int) -> int:
    """An unsigned 64-bit number as Spark's long."""
    x &= _MASK
    return x - (1 << 64) if x >> 63 else x


def _swap(e: DataFrame) -> DataFrame:
    return e.select(F.col("b").alias("a"), F.col("a").alias("b"))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root): the smallest node reachable, for every node of ``edges`` (a, b).

    Alternates the large-star and small-star steps until the edges form
    stars; each step is a grouped minimum (partial aggregation) joined
    back, so a hot node is a skewed join that Spark splits, never a list.
    Every round is written to the shared folder.
    """
    e = materialize(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    state = None
    while True:
        both = e.unionByName(_swap(e))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        e = both.where(F.col("b") > F.col("a")).join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = e.groupBy("a").agg(F.min("b").alias("m"))
        j = e.join(low, "a")
        e = j.select("a", F.col("m").alias("b")).unionByName(j.where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct()
        e = materialize(e, name)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
