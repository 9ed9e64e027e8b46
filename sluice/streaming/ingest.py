"""Ingest flow: Kafka records -> envelope -> validate -> buffer + rejects (§3.1, STR-1/4, SNK-1/6).

One ``foreachBatch`` per micro-batch:

* the registry is re-read each batch and recompiled only when its
  fingerprint changes (a long-running stream picks up new schemas);
* the batch is validated once and written once, partitioned by ``status``:
  ``status=valid`` is the buffer, the other partitions are the reject
  output.  Each batch writes its own ``run=<stream id>/batch=<id>`` folder
  once: a batch Spark re-runs after a failure replaces what it left unfinished
  and leaves a committed folder as it is, and a fresh checkpoint starts a new
  run folder;
* the stream's offsets are committed only after this function returns
  (at-least-once delivery, exactly-once effect on the output).
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import buffer as buf
from ..operators import envelope as env
from ..operators import validate as val
from ..operators.rules import rules_by_uri, validate_rules
from ..session import fs_exists
from .progress import PartitionLog, watched


class RegistryCache:
    """Compiled registry, recompiled when the registry's content changes."""

    def __init__(self, load: Callable[[], DataFrame], design: str = "auto"):
        self.load = load
        self.design = design
        self._fp = None
        self._compiled = None
        self._frame = None
        self._rules = None

    def validate(self, messages: DataFrame) -> DataFrame:
        reg = self.load()
        fp = val.registry_fingerprint(reg)
        if fp != self._fp:
            self._fp, self._frame = fp, reg
            size = val.registry_size(reg)
            n, b = size
            use_compiled = self.design == "compiled" or (
                self.design == "auto" and n <= val.MAX_COMPILED_SCHEMAS and b <= val.MAX_COMPILED_BYTES)
            self._compiled = val.compile_registry(reg, size=size) if use_compiled else None
            self._rules = None if use_compiled else rules_by_uri(reg)
        if self._compiled is not None:
            return val.validate_compiled(messages, self._compiled)
        return validate_rules(messages, self._frame, rules=self._rules)


def _run_id(spark: SparkSession, checkpoint: str) -> str:
    """The stream's id, kept in its checkpoint (stable across restarts of the
    same checkpoint, new for a fresh one)."""
    return spark.read.json(os.path.join(checkpoint, "metadata")).first()["id"]


def ingest_batch(records: DataFrame, batch_id: int, registry: RegistryCache, out: str,
                 partitions: PartitionLog | None = None) -> None:
    """Validate one micro-batch of Kafka records and write it under ``out``
    (``out`` already names the run: ``<root>/run=<stream id>``).

    A batch whose folder is committed is not written again: a stream that tails
    the folder may have listed its files already."""
    folder = os.path.join(out, f"batch={batch_id}")
    if fs_exists(records.sparkSession, os.path.join(folder, "_SUCCESS")):
        return
    envelopes = env.to_envelope(env.skip_tombstones(records))
    checked = registry.validate(envelopes)
    entries = buf.assign_ids(checked).select(
        "id", "seq", "origin", "partition", "offset", "schemaURI", "timestamp", "data",
        "status", "reason", "errors")
    if partitions is not None:
        entries, seen = watched(entries)
    entries.write.mode("overwrite").partitionBy("status").parquet(folder)
    if partitions is not None:
        partitions.add(batch_id, seen)


def start_ingest(records: DataFrame, registry_loader: Callable[[], DataFrame], out: str,
                 checkpoint: str, trigger: dict | None = None, design: str = "auto",
                 partitions: PartitionLog | None = None):
    """Start the ingest stream; ``trigger`` defaults to a 1 s processing interval.
    ``partitions`` receives the counts of every topic partition."""
    cache = RegistryCache(registry_loader, design)
    run: dict = {}

    def per_batch(df: DataFrame, bid: int) -> None:
        # Output goes to run=<stream id>/batch=<id>: a re-run of a batch
        # replaces its own folder, and a fresh checkpoint on the same folder
        # starts a new run instead of overwriting earlier batches.
        if "dir" not in run:
            run["dir"] = os.path.join(out, f"run={_run_id(df.sparkSession, checkpoint)}")
        ingest_batch(df, bid, cache, run["dir"], partitions)

    w = (records.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint))
    w = w.trigger(**(trigger or {"processingTime": "1 second"}))
    return w.start()


def read_buffer(spark: SparkSession, out: str) -> DataFrame:
    """The buffer written by the ingest stream: valid records only (partition pruned)."""
    return (spark.read.parquet(out).where(F.col("status") == "valid")
            .select(*buf.ENTRY_COLUMNS))


def read_outcomes(spark: SparkSession, out: str) -> DataFrame:
    """Every ingested record with its outcome (valid and rejected)."""
    return spark.read.parquet(out)
