"""Keyed, reproducible splits (O-30, O-31).

``randomSplit`` depends on the partitioning of its input (the same seed
gives different rows for 1, 4 and 7 partitions), so a rerun after an
executor loss or a re-partitioning can move rows between train and test.
Here a row's side is a pure function of its key: the first 8 hex digits
of ``md5("<key>:<seed><salt>")`` modulo 100 (or k for folds).  It is a
narrow projection, needs no shuffle, and any SQL engine computes it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_bucket(key: str, modulus: int, seed: int = 42, salt: str = "") -> Column:
    """``conv(substr(md5(key:seed salt), 1, 8), 16, 10) % modulus``."""
    text = F.concat(F.col(key).cast("string"), F.lit(f":{seed}{salt}"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % F.lit(modulus)


def with_split(df: DataFrame, key: str, frac: float = 0.8, seed: int = 42, out: str = "split") -> DataFrame:
    """Add ``split`` = ``train`` for ``frac`` of the keys, else ``test``."""
    cut = int(round(frac * 100))
    return df.withColumn(out, F.when(hash_bucket(key, 100, seed) < cut, F.lit("train")).otherwise(F.lit("test")))


def hash_split(df: DataFrame, key: str, frac: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test) by key hash; a partition of the rows, stable under
    any re-partitioning."""
    cut = int(round(frac * 100))
    b = hash_bucket(key, 100, seed)
    return df.where(b < cut), df.where(b >= cut)


def assign_folds(df: DataFrame, key: str, k: int = 3, seed: int = 42, out: str = "fold") -> DataFrame:
    """Add an int fold id in [0, k) from the key (own salt, independent of
    the train/test split); used as ``CrossValidator(foldCol=...)``."""
    return df.withColumn(out, hash_bucket(key, k, seed, ":fold").cast("int"))
