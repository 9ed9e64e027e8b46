"""Replayable buffer: append, group read, ack, delete (SNK-1, SRC-2, SET-1, AGG-1, LIM-1, JOIN-3/4).

The buffer is an append-only table of entries ``(id, seq, origin, schemaURI,
timestamp, data)``; ``seq`` is arrival order.  A consumer group's progress is
the set of entries it has read but not acknowledged (``pending``).  Reading
returns new entries plus pending ones, unique by id.

Ids are deterministic (``<topic>-<unix millis>-<partition>-<offset>``, partition
and offset zero-padded) so a replayed append writes the same ids and the upsert
downstream stays idempotent.  Arrival order is ``(seq, id)``: the record's time in
microseconds, then topic, partition and offset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ENTRY_COLUMNS = ["id", "seq", "origin", "schemaURI", "timestamp", "data"]


def assign_ids(envelopes: DataFrame) -> DataFrame:
    """Envelope with Kafka coordinates -> the same frame with ``id`` and ``seq``."""
    return envelopes.withColumns({
        "id": F.concat_ws("-", "origin", F.unix_millis("timestamp").cast("string"),
                          F.lpad(F.col("partition").cast("string"), 6, "0"),
                          F.lpad(F.col("offset").cast("string"), 19, "0")),
        "seq": F.unix_micros("timestamp")})


def append(entries: DataFrame, path: str, partition_by: str | None = "origin") -> None:
    """Append entries to the buffer table at ``path`` (SNK-1, batch form).

    Partitioned by ``origin`` so per-topic reads prune directories.
    """
    w = entries.write.mode("append").format("parquet")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.save(path)


def dedupe_last(entries: DataFrame, order_cols: list[str] | None = None) -> DataFrame:
    """Unique by ``id``, the last occurrence winning (AGG-1).

    ``max_by`` over a struct is a partial aggregate: duplicates of a hot id
    are combined map-side before the shuffle.
    """
    order_cols = order_cols or ["seq"]
    cols = [c for c in entries.columns if c != "id"]
    order = F.struct(*[F.col(c) for c in order_cols])
    return (entries.groupBy("id")
            .agg(F.max_by(F.struct(*cols), order).alias("__e"))
            .select("id", *[F.col(f"__e.{c}").alias(c) for c in cols]))


def first_n(entries: DataFrame, n: int | None) -> DataFrame:
    """The first ``n`` entries by arrival order (LIM-1); all when ``n`` is None.

    A bounded top-n: each partition keeps its own n first, so only
    ``n × partitions`` rows meet in the final task.
    """
    if n is None:
        return entries
    return entries.orderBy("seq", "id").limit(n)


def read_group(new: DataFrame, pending: DataFrame, count: int | None = None) -> DataFrame:
    """New plus pending entries, unique by id, pending winning (SRC-2, SET-1).

    ``count`` caps each of the two lists separately, like a per-stream read
    count; ``None`` reads everything.
    """
    tagged = (first_n(new, count).withColumn("__src", F.lit(0))
              .unionByName(first_n(pending, count).withColumn("__src", F.lit(1))))
    return dedupe_last(tagged, ["__src", "seq"]).drop("__src")


def unique_ids(ids: DataFrame) -> DataFrame:
    """Distinct ids.  The distinct is a partial aggregate: copies of one id
    (even a third of the list) collapse map-side, so the id side of the anti
    join below is never skewed — a skew split can only cut the *left* side of
    an anti/semi join."""
    return ids.select("id").distinct()


def ack(pending: DataFrame, acked_ids: DataFrame) -> DataFrame:
    """Pending entries minus acknowledged ids (JOIN-3)."""
    return pending.join(unique_ids(acked_ids), "id", "left_anti")


def delete(buffer: DataFrame, ids: DataFrame) -> DataFrame:
    """Buffer minus deleted ids (JOIN-4)."""
    return buffer.join(unique_ids(ids), "id", "left_anti")
