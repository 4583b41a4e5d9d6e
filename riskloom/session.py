"""Session helpers: scratch paths under the cluster's checkpoint folder.

Operators never build or stop a session; they take the caller's.  Paths
for intermediate tables, saved models and stream checkpoints go under the
shared folder named by ``spark.checkpoint.dir``.  Only when that is unset
(local tests) do we choose a folder of our own and record it in the
session so every later caller sees the same one.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def _conf_dir(spark: SparkSession) -> str | None:
    for get in (lambda: spark.conf.get(_CKPT_KEY, None),
                lambda: spark.sparkContext.getConf().get(_CKPT_KEY, None)):
        try:
            v = get()
        except Exception:  # noqa: BLE001 - some confs are not readable over Connect
            v = None
        if v:
            return v
    return None


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    ``spark.checkpoint.dir`` if the cluster names one; else the folder
    already given to ``SparkContext.setCheckpointDir``; else, on a local
    master only, a new temporary folder, which becomes the context's
    checkpoint dir so later calls find it again and is removed when the
    process ends.  On a cluster without such a folder executors would write
    to their own disks, so that is an error.
    """
    root = _conf_dir(spark)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect has no SparkContext
        sc = None
    if not root and sc is not None:
        current = sc.getCheckpointDir()
        if current:
            return current.rstrip("/")
    if not root:
        master = sc.master if sc is not None else ""
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError(f"set {_CKPT_KEY} to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="riskloom-ckpt-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    if sc is not None and not sc.getCheckpointDir():
        try:
            sc.setCheckpointDir(root)
            if not _conf_dir(spark):
                return sc.getCheckpointDir().rstrip("/")
        except Exception:  # noqa: BLE001
            pass
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the checkpoint folder."""
    return f"{checkpoint_root(spark)}/riskloom/{name}-{uuid.uuid4().hex[:12]}"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the bench (the library itself never calls this)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("riskloom")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("RISKLOOM_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def app_id(spark: SparkSession) -> str:
    """Identifier of the running application (stable for a session)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - Connect has no SparkContext
        try:
            return spark.conf.get("spark.app.id", None) or str(id(spark))
        except Exception:  # noqa: BLE001
            return str(id(spark))


def cores(spark: SparkSession) -> int:
    """Default parallelism of the cluster (task slots)."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001
        try:
            return int(spark.conf.get("spark.default.parallelism", None) or
                       spark.conf.get("spark.sql.shuffle.partitions", "200"))
        except Exception:  # noqa: BLE001
            return 8
