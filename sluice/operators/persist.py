"""Persistence: item upsert, write outcome, chunked external writes (SNK-2, JOIN-2, AGG-2/3, STR-6).

Target rows are items ``(id, timestamp, origin, schemaURI, data)`` keyed by
``(id, timestamp)`` plus ``seq`` (arrival order of the write).  A later write
of the same key replaces the earlier one.

``upsert_table`` keeps the target as parquet partitioned by the item's day
and a hash bucket of the key, and rewrites only the partitions a batch
touches (dynamic partition overwrite), so a micro-batch costs in proportion
to the recent partitions it lands in, not to the size of the table.
"""

from __future__ import annotations

import os
import random
import time
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_root, fs_exists

ITEM_COLUMNS = ["id", "timestamp", "origin", "schemaURI", "data"]
KEY = ["id", "timestamp"]


def latest_per_key(rows: DataFrame, key: list[str] | None = None, order: str = "seq") -> DataFrame:
    """Keep the row with the greatest ``order`` per key (partial aggregate)."""
    key = key or KEY
    rest = [c for c in rows.columns if c not in key]
    return (rows.groupBy(*key)
            .agg(F.max_by(F.struct(*rest), F.col(order)).alias("__r"))
            .select(*key, *[F.col(f"__r.{c}").alias(c) for c in rest]))


def upsert(target: DataFrame | None, items: DataFrame) -> DataFrame:
    """New target state: ``target ∪ items``, the latest write per key winning."""
    allrows = items if target is None else target.unionByName(items)
    return latest_per_key(allrows)


def key_bucket(n_buckets: int) -> F.Column:
    return F.pmod(F.xxhash64(*[F.col(c) for c in KEY]), F.lit(n_buckets)).cast("int")


PARTITIONS = ["day", "bucket"]


def partition_columns(items: DataFrame, n_buckets: int) -> DataFrame:
    """Target partitions: the item's day (from its RFC3339 timestamp) and a
    hash bucket of the key inside the day.  Events arrive roughly in time
    order, so a micro-batch touches the recent days only."""
    return (items.withColumn("day", F.substring("timestamp", 1, 10))
            .withColumn("bucket", key_bucket(n_buckets)))


def upsert_table(spark: SparkSession, items: DataFrame, path: str, staging_root: str,
                 n_buckets: int = 1) -> None:
    """Merge ``items`` into the parquet table at ``path`` partitioned by
    ``(day, bucket)``.

    1. find the partitions the batch touches (a few rows) and read only those
       from the target (a semi join on the partition columns: Spark prunes
       the partitions it does not need);
    2. keep the latest row per key and write the merged partitions to a
       staging folder (the target cannot be overwritten while being read);
    3. overwrite just those partitions from staging (dynamic partition
       overwrite); every other partition is left untouched.

    The cost of a batch is the size of the partitions it touches, not the
    size of the table.  ``n_buckets`` splits a day when days are large.
    """
    b = partition_columns(items, n_buckets)
    if fs_exists(spark, path):
        old = spark.read.parquet(path)
        touched = b.select(*PARTITIONS).distinct()
        old = old.join(touched, PARTITIONS, "left_semi")  # the optimizer broadcasts it by its size
        merged = latest_per_key(old.unionByName(b), key=KEY + PARTITIONS)
    else:
        merged = latest_per_key(b, key=KEY + PARTITIONS)
    stage = os.path.join(staging_root, f"merge-{uuid.uuid4().hex}")
    merged.write.mode("overwrite").partitionBy(*PARTITIONS).parquet(stage)
    (spark.read.parquet(stage).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*PARTITIONS).parquet(path))


# -- merge-on-read target (streams) ------------------------------------------

def _committed(spark: SparkSession, path: str, prefix: str) -> list[int]:
    from ..session import fs_children
    out = []
    for name in fs_children(spark, path):
        if name.startswith(prefix) and fs_exists(spark, os.path.join(path, name, "_SUCCESS")):
            out.append(int(name[len(prefix):]))
    return sorted(out)


def append_items(items: DataFrame, path: str, batch_id: int) -> None:
    """Write one batch's items as a delta: ``<path>/deltas/batch=<id>/``.

    The batch owns its folder and overwrites it, so a re-run of the batch
    replaces its own files.  Cost is the size of the batch only (no
    partitioning by time: historical replays would scatter a batch over
    thousands of tiny folders).
    """
    items.write.mode("overwrite").parquet(os.path.join(path, "deltas", f"batch={batch_id}"))


def _deltas(spark: SparkSession, path: str) -> list[str]:
    """Committed delta folder names (``batch=<id>``)."""
    from ..session import fs_children
    root = os.path.join(path, "deltas")
    return sorted(n for n in fs_children(spark, root)
                  if n.startswith("batch=") and fs_exists(spark, os.path.join(root, n, "_SUCCESS")))


def _latest_base(spark: SparkSession, path: str) -> tuple[int, set[str]] | None:
    """Newest base version whose list of covered deltas is committed."""
    for v in reversed(_committed(spark, os.path.join(path, "base"), "v=")):
        cov = os.path.join(path, "covered", f"v={v}")
        if fs_exists(spark, os.path.join(cov, "_SUCCESS")):
            return v, {r["delta"] for r in spark.read.parquet(cov).collect()}  # folder names only
    return None


def merged_state(spark: SparkSession, path: str) -> DataFrame | None:
    """Current target: latest base version ∪ the deltas it does not cover,
    latest row per key.

    ``max_by`` per key is a partial aggregate, so duplicate deliveries of one
    key are combined map-side.
    """
    base = _latest_base(spark, path)
    covered = base[1] if base else set()
    parts = []
    if base:
        parts.append(spark.read.parquet(os.path.join(path, "base", f"v={base[0]}")))
    deltas = [d for d in _deltas(spark, path) if d not in covered]
    if deltas:
        parts.append(spark.read.parquet(*[os.path.join(path, "deltas", d) for d in deltas]))
    if not parts:
        return None
    allrows = parts[0]
    for p in parts[1:]:
        allrows = allrows.unionByName(p)
    return latest_per_key(allrows)


def compact(spark: SparkSession, path: str) -> int | None:
    """Fold the base and all committed deltas into a new base version and
    record exactly which delta folders it covers; later reads skip those."""
    deltas = _deltas(spark, path)
    base = _latest_base(spark, path)
    if not deltas or (base and set(deltas) <= base[1]):
        return None
    state = merged_state(spark, path)
    versions = _committed(spark, os.path.join(path, "base"), "v=")
    v = (versions[-1] + 1) if versions else 0
    state.write.mode("overwrite").parquet(os.path.join(path, "base", f"v={v}"))
    (spark.createDataFrame([(d,) for d in deltas], "delta string").coalesce(1)
     .write.mode("overwrite").parquet(os.path.join(path, "covered", f"v={v}")))
    return v


# -- outcome of a write ------------------------------------------------------

def split_by_failures(batch: DataFrame, failed_ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(persisted, unpersisted) rows of a batch given the ids that failed (JOIN-2)."""
    f = failed_ids.select("id").distinct()  # copies collapse map-side; see buffer.unique_ids
    return batch.join(f, "id", "left_anti"), batch.join(f, "id", "left_semi")


def batch_outcome(batch: DataFrame, failed_ids: DataFrame,
                  batches: DataFrame | None = None) -> DataFrame:
    """One row per ``batch_id``: counts and verdict (AGG-2, AGG-3).

    ``batch`` holds ``(batch_id, id)``; ``failed_ids`` the ``(batch_id, id)``
    the sink returned as unprocessed.  Verdict: ``failed`` when nothing
    persisted, ``partial`` when some did not, ``ok`` otherwise, and ``empty``
    for a listed batch without rows.  Id lists are not gathered into arrays
    (a batch may be arbitrarily large); use ``split_by_failures`` for them.
    """
    f = failed_ids.select("batch_id", "id").dropDuplicates().withColumn("__failed", F.lit(True))
    marked = batch.select("batch_id", "id").join(f, ["batch_id", "id"], "left")
    out = (marked.groupBy("batch_id")
           .agg(F.count(F.lit(1)).alias("n"),
                F.count_if(F.col("__failed").isNull()).alias("persisted_count"),
                F.count_if(F.col("__failed")).alias("unpersisted_count")))
    if batches is not None:
        out = batches.select("batch_id").distinct().join(out, "batch_id", "left").fillna(
            0, ["n", "persisted_count", "unpersisted_count"])
    verdict = (F.when(F.col("n") == 0, "empty")
               .when(F.col("persisted_count") == 0, "failed")
               .when(F.col("unpersisted_count") > 0, "partial")
               .otherwise("ok"))
    return out.withColumn("verdict", verdict)


def outcome_ids(batch: DataFrame, failed_ids: DataFrame, digits: int = 1) -> DataFrame:
    """Persisted and unpersisted ids of every batch as lists (AGG-2).

    One row per ``batch_id``, ``state`` and ``bucket``: the first ``digits`` digits of the
    id's MD5 deal a batch's ids to 16 ** digits lists of about equal length, so a list
    stays as short as wanted however large the batch.  Ids are sorted and distinct.
    """
    f = failed_ids.select("batch_id", "id").dropDuplicates().withColumn("__failed", F.lit(True))
    marked = batch.select("batch_id", "id").dropDuplicates().join(f, ["batch_id", "id"], "left")
    state = F.when(F.col("__failed"), "unpersisted").otherwise("persisted")
    return (marked.groupBy("batch_id", state.alias("state"), F.substring(F.md5("id"), 1, digits).alias("bucket"))
            .agg(F.array_sort(F.collect_list("id")).alias("ids")))


# -- chunked writes to an external store -------------------------------------

def chunked_writer(write_chunk: Callable[[list[dict]], list[str]], chunk_size: int = 25,
                   attempts: int = 5, max_backoff: float = 10.0, base_backoff: float = 0.05):
    """Build a ``mapInPandas`` function that writes items in chunks (SNK-2, STR-6).

    ``write_chunk(items) -> unprocessed ids`` is called per chunk; unprocessed
    items are retried with jittered exponential back-off up to ``attempts``
    times.  Yields the ids still unprocessed after the last attempt.  Writes
    must be idempotent puts: a task re-run after an executor loss repeats them.
    """
    import pandas as pd

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            failed: list[str] = []
            recs = pdf.to_dict("records")
            for i in range(0, len(recs), chunk_size):
                todo = recs[i:i + chunk_size]
                for attempt in range(attempts):
                    left = set(write_chunk(todo) or [])
                    todo = [r for r in todo if r["id"] in left]
                    if not todo:
                        break
                    if attempt + 1 < attempts:
                        time.sleep(min(max_backoff, base_backoff * (2 ** attempt)) * random.random())
                failed.extend(r["id"] for r in todo)
            yield pd.DataFrame({"id": pd.Series(failed, dtype="object")})
    return run


def write_external(items: DataFrame, write_chunk, **kw) -> DataFrame:
    """Items -> frame of ids the store left unprocessed after retries.

    The writes happen here, once: the answer is checkpointed in the shared
    folder, so using the frame again does not write again."""
    checkpoint_root(items.sparkSession)
    return items.mapInPandas(chunked_writer(write_chunk, **kw), "id string").checkpoint(eager=True)
