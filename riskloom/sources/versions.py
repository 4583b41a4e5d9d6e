"""Atomic publication of trained models (O-07, O-42).

A training run writes everything below a folder of its own,
``<models>/versions/<task>-<unique>``, and publishes it last by creating
one empty file, ``<models>/current/<task>/<number>.<folder>``.  The highest
number is the current version.  The name says all, so the file is never
seen half written, nothing is renamed or overwritten, and a run that dies
half-way leaves the old version in place and only an unlisted folder
behind.  Two runs that publish at once get the same number; the later
folder name wins for every reader alike.

These are metadata calls on the cluster's file system; no data passes
through the driver.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    context = spark.sparkContext
    p = context._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(context._jsc.hadoopConfiguration()), p


def _pointers(spark: SparkSession, models_dir: str, task: str) -> list[tuple[int, str]]:
    fs, folder = _fs(spark, f"{models_dir}/current/{task}")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted((int(n), v) for n, _, v in (x.partition(".") for x in names) if n.isdigit() and v)


def new_folder(models_dir: str, task: str) -> str:
    """A folder for one training run's results, not yet published."""
    return f"{models_dir}/versions/{task}-{uuid.uuid4().hex[:12]}"


def publish(spark: SparkSession, models_dir: str, task: str, folder: str) -> int:
    """Make ``folder`` (of ``new_folder``) the current version; returns its number."""
    held = _pointers(spark, models_dir, task)
    number = held[-1][0] + 1 if held else 1
    name = folder.rstrip("/").rpartition("/")[2]
    fs, path = _fs(spark, f"{models_dir}/current/{task}/{number:08d}.{name}")
    if not fs.createNewFile(path):
        raise FileExistsError(str(path))
    return number


def current(spark: SparkSession, models_dir: str, task: str) -> tuple[int, str | None]:
    """(number, folder) of the current version; (0, None) before the first."""
    held = _pointers(spark, models_dir, task)
    return (held[-1][0], f"{models_dir}/versions/{held[-1][1]}") if held else (0, None)


def prune(spark: SparkSession, models_dir: str, task: str, keep: int = 2) -> list[str]:
    """Delete the folders of all but the newest ``keep`` versions (their pointers first); returns their names."""
    if keep < 1:
        raise ValueError("the current version stays")
    old = _pointers(spark, models_dir, task)[:-keep]
    for number, name in old:
        for path in (f"{models_dir}/current/{task}/{number:08d}.{name}", f"{models_dir}/versions/{name}"):
            fs, p = _fs(spark, path)
            fs.delete(p, True)
    return [name for _, name in old]
