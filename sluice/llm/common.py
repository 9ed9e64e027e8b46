"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.session import checkpoint_root

#: Words are runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

_MULT = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_HALF = np.uint64(32)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, with Arrow batches of 1,000 rows in its session unless the session
    names a size: texts are long, and a batch is held on both sides at once."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if df.sparkSession.conf.get(key, None) is None:
        df.sparkSession.conf.set(key, "1000")
    return df


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, which bound a task's Python memory."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def words(data: bytes) -> list[bytes]:
    """ASCII-lower-cased words of UTF-8 text; ``bytes.split`` cuts at exactly the
    white space ``WORD`` leaves out."""
    return data.lower().split()


def word_hashes(data: bytes) -> np.ndarray:
    ws = words(data)
    return np.fromiter(map(xxhash.xxh3_64_intdigest, ws), np.uint64, len(ws))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _HALF)) * _MIX
    return x ^ (x >> _HALF)


def ngram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """64-bit hash of every run of ``n`` word hashes, in text order."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    s = np.full(len(h) - n + 1, np.uint64(n))
    for j in range(n):
        s = s * _MULT + h[j:len(h) - n + 1 + j]
    return mix(s)


def shingle_set(data: bytes, n: int) -> np.ndarray:
    """Sorted distinct ``n``-word shingle hashes; a shorter text is one shingle."""
    h = word_hashes(data)
    return np.unique(ngram_hashes(h, min(n, len(h)))) if len(h) else h


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components: ``(node, comp)``, comp the smallest node reached.

    Each round takes the smallest label among a node's neighbours and then the
    label of that label, so long chains shorten geometrically.  Labels go
    through partial aggregates, so a hub node is combined map-side.
    """
    both = cut(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
               .union(edges.select(F.col(b), F.col(a))).distinct())
    lab = both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m")) \
              .select("node", F.least("node", "m").alias("comp"))
    lab = cut(lab)
    while True:
        near = (both.join(lab, both.v == lab.node).groupBy(F.col("u").alias("node"))
                .agg(F.min("comp").alias("near")))
        step = (lab.withColumnRenamed("comp", "old").join(near, "node")
                .select("node", "old", F.least("old", "near").alias("to")))
        jump = lab.select(F.col("node").alias("to"), F.col("comp").alias("next"))
        new = cut(step.join(jump, "to").select("node", "old", F.least("to", "next").alias("comp")))
        moved = new.where("old != comp").limit(1).count()
        lab = new.drop("old")
        if not moved:
            return lab
