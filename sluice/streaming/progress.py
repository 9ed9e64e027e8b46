"""Per-batch and per-partition progress and failure reporting for streams (STR-9, AGG-4).

``ProgressLog`` is a ``StreamingQueryListener`` that keeps, per query, the
batch id, input rows, rows/s and trigger duration of every micro-batch, and
the exception text of a query that stopped with an error.  Attach it with
``spark.streams.addListener(log)``.

``watched`` counts the records of every (topic, partition, status) while a batch is
written, as an observed metric of the same job; ``PartitionLog`` adds them up and
names the partitions that bring errors while the others progress.
"""

from __future__ import annotations

import threading
from collections import defaultdict

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


class ProgressLog(StreamingQueryListener):
    def __init__(self):
        self._lock = threading.Lock()
        self.batches: list[dict] = []
        self.failures: list[dict] = []

    def onQueryStarted(self, event):  # noqa: N802 - listener API
        pass

    def onQueryProgress(self, event):  # noqa: N802
        p = event.progress
        with self._lock:
            self.batches.append({
                "id": str(p.id), "batch_id": p.batchId, "input_rows": p.numInputRows,
                "rows_per_sec": p.processedRowsPerSecond,
                "trigger_ms": (p.durationMs or {}).get("triggerExecution"),
            })

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        if event.exception:
            with self._lock:
                self.failures.append({"id": str(event.id), "error": event.exception})


def stop_after_current_batch(query, poll: float = 0.1, timeout: float = 60.0) -> None:
    """Graceful stop (STR-8): wait until no trigger is running, then stop, so
    the batch in flight commits its offsets before the query ends."""
    import time
    deadline = time.time() + timeout
    while query.isActive and query.status.get("isTriggerActive") and time.time() < deadline:
        time.sleep(poll)
    query.stop()


#: Distinct (topic, partition, status) an observed metric counts exactly.
MAX_PARTITIONS = 100_000


def watched(outcomes: DataFrame, name: str = "partitions") -> tuple[DataFrame, Observation]:
    """``outcomes`` (origin, partition, status, ...), observed, and its observation.

    The counts come with the job that runs the frame: a bounded table per task,
    merged by the driver; no pass, shuffle or row of their own."""
    seen = Observation(name)
    key = F.to_json(F.struct("origin", F.col("partition").cast("string").alias("partition"), "status"))
    counts = F.call_function("approx_top_k", key, F.lit(MAX_PARTITIONS), F.lit(2 * MAX_PARTITIONS))
    return outcomes.observe(seen, counts.alias("by_partition"), F.count(F.lit(1)).alias("n")), seen


class PartitionLog:
    """Records by (topic, partition) and status over all batches of a stream."""

    def __init__(self):
        self._lock = threading.Lock()
        self._batches: dict[int, dict[tuple, int]] = {}

    def add(self, batch_id: int, seen: Observation) -> None:
        import json
        rows = {}
        for r in seen.get["by_partition"] or ():
            k = json.loads(r["item"])
            rows[k.get("origin"), None if "partition" not in k else int(k["partition"]), k.get("status")] = r["count"]
        with self._lock:
            self._batches[batch_id] = rows  # a batch that is run again counts once

    def counts(self) -> list[tuple[str, int, str, int]]:
        """(topic, partition, status, records), sorted."""
        total: dict[tuple, int] = defaultdict(int)
        with self._lock:
            for rows in self._batches.values():
                for k, n in rows.items():
                    total[k] += n
        return sorted(((*k, n) for k, n in total.items()), key=lambda r: (str(r[0]), -1 if r[1] is None else r[1], str(r[2])))

    def failing(self, share: float = 0.5) -> list[tuple[str, int]]:
        """Partitions of whose records at least ``share`` are errors."""
        by: dict[tuple, list[int]] = defaultdict(lambda: [0, 0])
        for topic, partition, status, n in self.counts():
            by[topic, partition][0] += n * (status == "error")
            by[topic, partition][1] += n
        return sorted(k for k, (bad, n) in by.items() if bad >= share * n)
