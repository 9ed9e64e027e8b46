"""Session settings the operators rely on.

``configure(spark)`` only sets values that are still at their defaults, so a
cluster's own settings (shuffle partitions, checkpoint directory) win.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every operator needs for exact results.
REQUIRED_CONF = {
    # RFC3339 text is rendered and parsed in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Duplicate JSON keys: the last one wins (as encoding/json decoders do),
    # instead of the whole document failing to parse.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Recursive queries over documents and payloads have as many rows as these
    # have nodes: no bound on their number (the depth is bounded).
    "spark.sql.cteRecursionRowLimit": "-1",
}

# Settings that only tune execution; applied when unset.
TUNING_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply REQUIRED_CONF (always) and TUNING_CONF (when unset)."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    for k, v in TUNING_CONF.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (set by the cluster).  Only when it is
    unset — local runs and tests — a scratch folder is created and recorded on
    the session so every later call agrees.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="sluice-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint root."""
    return os.path.join(checkpoint_root(spark), *parts)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "sluice") -> SparkSession:
    """Session for tests and the bench (local mode, UI off)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


# -- shared-storage helpers (Hadoop FileSystem: local, HDFS, object stores) --

def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def fs_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p))


def fs_delete(spark: SparkSession, path: str) -> None:
    """Remove a folder this library wrote (a superseded version of its state)."""
    fs, p = _fs_path(spark, path)
    fs.delete(p, True)


def fs_children(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries directly under ``path`` ([] when it does not exist)."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p)]


def new_run_dir(spark: SparkSession, prefix: str) -> str:
    """A fresh folder name under the shared checkpoint root."""
    import uuid
    return scratch_path(spark, f"{prefix}-{uuid.uuid4().hex[:12]}")

