"""Persist flow: buffer -> target table -> acknowledge (§3.2, STR-5/6/7, SNK-2, JOIN-2/3, AGG-2/3).

Layout under ``root`` (a folder in the shared checkpoint location):

* ``target/deltas/batch=<n>/``  items persisted by batch n (append only)
* ``target/base/v=<n>/``  compacted state up to batch n (``compact``)
* ``pending/v=<seq>_b=<batch>/``  entries read but not yet persisted (one version per
  batch; the last two are kept)
* ``outcomes/batch=<n>/`` one outcome row per batch

One ``foreachBatch`` call:

1. read group = new entries ∪ latest pending version, unique by id (pending
   wins), each list optionally capped (entries beyond the cap stay pending);
2. empty read → no-op;
3. write the items; the store's ``writer`` (or ``fail``, a test hook) names
   ids left unprocessed; persisted items are appended as the batch's own delta
   (merge on read: a batch costs its own size, never a table rewrite);
4. persisted = read group minus failed ids; nothing persisted → the batch is
   ``failed`` and nothing is acknowledged;
5. a new pending version = the unpersisted entries with ``attempts + 1``;
   written as a new version (``seq`` orders versions in time), never over the
   version being read;
6. one outcome row.

A batch id already present in ``outcomes/`` is skipped, so a re-run of a
batch after a failure has no second effect.  Entries left pending when the
stream stops are redelivered by ``drain``.
"""

from __future__ import annotations

import logging
import os
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import buffer as buf
from ..operators import envelope as env
from ..operators import persist as per
from ..session import checkpoint_root, fs_children, fs_delete, fs_exists

log = logging.getLogger(__name__)

def _versions(spark: SparkSession, path: str) -> list[tuple[int, int, str]]:
    """Committed pending versions ``v=<seq>_b=<batch>`` as (seq, batch, name),
    oldest first.  ``seq`` orders versions in time, whatever the batch ids."""
    out = []
    for name in fs_children(spark, path):
        if name.startswith("v=") and "_b=" in name and fs_exists(spark, os.path.join(path, name, "_SUCCESS")):
            seq, batch = name[2:].split("_b=")
            out.append((int(seq), int(batch), name))
    return sorted(out)


class PersistFlow:
    """State and per-batch logic of the persist flow."""

    def __init__(self, spark: SparkSession, root: str, read_count: int | None = None,
                 fail: Callable[[DataFrame], DataFrame] | None = None,
                 writer: Callable[[list[dict]], list[str]] | None = None,
                 write: Callable[[DataFrame, int], DataFrame] | None = None, **writer_options):
        """``write(items, batch id) -> frame of unprocessed ids`` puts a batch into an
        external store (``sources.store.put_batch``: a batch counts once), and
        ``writer(items) -> unprocessed ids`` a chunk (chunks, retries and back-off:
        ``persist.chunked_writer``, which takes ``writer_options``); the items then
        live there instead of in ``target/``.  ``fail(items) -> failed ids`` injects write failures
        (tests, chaos runs)."""
        self.spark = spark
        self.root = root
        self.read_count = read_count
        self.fail = fail
        self.writer, self.writer_options = writer, writer_options
        self.write = write
        self.external = writer is not None or write is not None
        self.target = os.path.join(root, "target")
        self.pending = os.path.join(root, "pending")
        self.outcomes = os.path.join(root, "outcomes")
        checkpoint_root(spark)

    # -- state ----------------------------------------------------------
    def pending_frame(self, exclude_batch: int | None = None) -> DataFrame | None:
        """Latest committed pending version; a re-run of batch n skips the
        version batch n wrote itself and reads the one before it."""
        vs = [v for v in _versions(self.spark, self.pending) if v[1] != exclude_batch]
        if not vs:
            return None
        return self.spark.read.parquet(os.path.join(self.pending, vs[-1][2]))

    def _next_pending_name(self, batch_id: int) -> str:
        vs = _versions(self.spark, self.pending)
        return f"v={(vs[-1][0] + 1) if vs else 0}_b={batch_id}"

    def done(self, batch_id: int) -> bool:
        return fs_exists(self.spark, os.path.join(self.outcomes, f"batch={batch_id}", "_SUCCESS"))

    # -- one batch --------------------------------------------------------
    def run_batch(self, new: DataFrame, batch_id: int) -> None:
        if self.done(batch_id):
            return  # replayed batch: its effect is already recorded
        new = new.select(*buf.ENTRY_COLUMNS).withColumn("attempts", F.lit(1))
        pending = self.pending_frame(exclude_batch=batch_id)
        if pending is None:
            pending = new.limit(0)
        group = buf.read_group(new, pending, self.read_count)
        # The read group is used several times below: keep it for this batch.
        # If an executor is lost, Spark recomputes it deterministically from
        # the batch's source files and the pending table.
        group = group.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self._finish_batch(new, pending, group, batch_id)
        finally:
            group.unpersist()

    def _finish_batch(self, new: DataFrame, pending: DataFrame, group: DataFrame, batch_id: int) -> None:
        if group.isEmpty():
            return
        items = env.item(group, keep=["seq"])
        if self.fail is None and not self.external:
            failed = group.limit(0).select("id")
        else:
            # The store's answer is taken once and recorded (writes have side
            # effects).  A store error is a write without a response: every id
            # counts as unpersisted, nothing is acknowledged, and the stream
            # carries on (failure isolation).
            fpath = os.path.join(self.root, "failed", f"batch={batch_id}")
            try:
                left = (self.fail(group) if self.fail is not None else self.write(items, batch_id) if self.write is not None
                        else per.write_external(items, self.writer, **self.writer_options))
                left.select("id").write.mode("overwrite").parquet(fpath)
            except Exception as exc:  # noqa: BLE001 - any store failure fails the batch, not the stream
                log.warning("persist batch %s: store write failed, nothing persisted: %s", batch_id, exc)
                group.select("id").write.mode("overwrite").parquet(fpath)
            failed = self.spark.read.parquet(fpath)
        persisted, unpersisted = per.split_by_failures(group, failed)
        if not self.external and not persisted.isEmpty():
            per.append_items(items.join(persisted.select("id"), "id", "left_semi"), self.target, batch_id)
        next_pending = unpersisted.withColumn("attempts", F.col("attempts") + 1)
        if self.read_count is not None:
            # Entries beyond the read cap were not read this time; they stay
            # pending (unchanged attempts) so the next read picks them up.
            unread = buf.read_group(new, pending).join(group.select("id"), "id", "left_anti")
            next_pending = next_pending.unionByName(unread)
        next_pending.write.mode("overwrite").parquet(os.path.join(self.pending, self._next_pending_name(batch_id)))
        outcome = per.batch_outcome(group.select(F.lit(batch_id).cast("bigint").alias("batch_id"), "id"),
                                    failed.select(F.lit(batch_id).cast("bigint").alias("batch_id"), "id"))
        outcome.write.mode("overwrite").parquet(os.path.join(self.outcomes, f"batch={batch_id}"))
        # A batch's own version and the one before it are all a re-run needs.
        for _, _, name in _versions(self.spark, self.pending)[:-2]:
            fs_delete(self.spark, os.path.join(self.pending, name))

    DRAIN_BASE = 1 << 40  # drain rounds get ids far above any stream batch id

    def _next_drain_id(self) -> int:
        from ..session import fs_children
        used = [int(n.split("=", 1)[1]) for n in fs_children(self.spark, self.outcomes)
                if n.startswith("batch=") and int(n.split("=", 1)[1]) >= self.DRAIN_BASE]
        pend = [v[1] for v in _versions(self.spark, self.pending) if v[1] >= self.DRAIN_BASE]
        return max(used + pend + [self.DRAIN_BASE - 1]) + 1

    def drain(self, max_rounds: int | None = None) -> int:
        """Redeliver pending entries with no new input until none are left.

        A round that persists nothing ends the drain (the store refuses all it
        was given); what is left stays pending, see ``pending_frame``.  Rounds
        are numbered after the last round ever run, so a later drain never
        mistakes its rounds for ones already done."""
        empty = self.spark.createDataFrame([], env.ENVELOPE_SCHEMA).select(
            F.lit(None).cast("string").alias("id"), F.lit(None).cast("bigint").alias("seq"),
            "origin", "schemaURI", "timestamp", "data").limit(0)
        rounds = 0
        p = self.pending_frame()
        left = p.count() if p is not None else 0
        while left and (max_rounds is None or rounds < max_rounds):
            self.run_batch(empty, self._next_drain_id())
            rounds += 1
            before, left = left, self.pending_frame().count()
            if left >= before:
                log.warning("drain stopped: a round persisted none of %s pending entries", left)
                break
        return rounds

    def start(self, entries: DataFrame, checkpoint: str, trigger: dict | None = None):
        w = (entries.writeStream.foreachBatch(lambda df, bid: self.run_batch(df, bid))
             .option("checkpointLocation", checkpoint))
        return w.trigger(**(trigger or {"processingTime": "1 second"})).start()

    def target_frame(self) -> DataFrame:
        """Current target state (merge on read)."""
        state = per.merged_state(self.spark, self.target)
        if state is None:
            return self.spark.createDataFrame([], "id string, timestamp string, origin string, "
                                                  "schemaURI string, data string, seq bigint")
        return state

    def compact(self) -> int | None:
        """Fold deltas into a new base version (run between batches or as a job)."""
        return per.compact(self.spark, self.target)

    def outcome_frame(self) -> DataFrame:
        return self.spark.read.parquet(self.outcomes)
