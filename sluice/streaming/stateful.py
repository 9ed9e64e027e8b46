"""Keyed state over streams: duplicates, redelivery and the registry (AGG-1, STR-5/6, AGG-7, SRC-4).

The state lives in Spark's state store under the stream's checkpoint, so it is
versioned with the offsets, survives lost executors and is bounded by what is
unfinished: ids inside the watermark, entries not yet acknowledged, live
registry keys.
"""

from __future__ import annotations

import logging
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.semver import DEFAULT_KEY_PREFIX, parse_semver, registry_key
from ..operators import buffer as buf
from ..operators import envelope as env
from ..operators import persist as per
from ..operators.nodes import with_admission
from ..operators.registry import request_ok
from ..session import fs_exists

log = logging.getLogger(__name__)

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_state_store(spark: SparkSession) -> None:
    """Keyed state variables and timers need the RocksDB state store."""
    if "RocksDB" not in (spark.conf.get(_PROVIDER, "") or ""):
        spark.conf.set(_PROVIDER, _ROCKSDB)


def unique_stream(entries: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Streamed form of the unique read (AGG-1): the first entry of every id.

    A copy up to ``delay`` later in event time is dropped; the ids of older entries
    leave the state, so it never grows with the stream.  (The batch form keeps the
    last copy; redelivered copies are equal.)
    """
    return entries.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(["id"])


# -- redelivery -----------------------------------------------------------------

_BODY = "seq long, origin string, schemaURI string, timestamp timestamp, data string"
DELIVERY = f"id string, {_BODY}, attempts int"


def back_off_ms(key: str, attempts: int, base: int, most: int) -> int:
    """Wait before the next delivery: doubles with every attempt, spread by up to a half per key."""
    wait = min(most, base << min(attempts - 1, 30))
    return wait // 2 + zlib.crc32(f"{key} {attempts}".encode()) % (wait // 2 + 1)


#: Ids are dealt to so many groups.  A group keeps its open entries as one row of state
#: and is worked through as columns: a Python call for a group, not for an entry.
BUCKETS = 4096
#: ``seq`` goes as text, as pandas would make it a float next to nulls.
OPEN = pa.schema([("id", pa.string()), ("seq", pa.string()), ("origin", pa.string()), ("schemaURI", pa.string()),
                  ("timestamp", pa.timestamp("us")), ("data", pa.string()), ("attempts", pa.int32()), ("due", pa.int64())])


def _packed(entries: pd.DataFrame) -> bytes:
    out = pa.BufferOutputStream()
    table = pa.Table.from_pandas(entries, schema=OPEN, preserve_index=False)
    with pa.ipc.new_stream(out, OPEN) as w:
        w.write_table(table)
    return out.getvalue().to_pybytes()


def _unpacked(held: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(held).read_all().to_pandas()


def _with_numbers(entries: pd.DataFrame) -> pd.DataFrame:
    return entries.assign(seq=pd.array([None if pd.isna(x) else int(x) for x in entries["seq"]], dtype="Int64"))


def redelivery(base_ms: int, most_ms: int):
    """Delivers the entries of a bucket until they are acknowledged.

    Rows ``(kind, id, seq, origin, schemaURI, timestamp, data)``: an ``entry`` is
    delivered at once and again whenever it is due; an ``ack`` ends it.  An
    acknowledgement beats entries of its id in the same batch.  The bucket's timer
    is that of its first entry due.
    """
    def deliver(key, rows: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        now = state.getCurrentProcessingTimeMs()
        held = _unpacked(state.get[0]) if state.exists else OPEN.empty_table().to_pandas()
        fresh = held.iloc[:0]
        if not state.hasTimedOut:
            new = pd.concat(list(rows))
            acked = new.loc[new["kind"] == "ack", "id"]
            held = held[~held["id"].isin(acked)]
            fresh = new[(new["kind"] == "entry") & ~new["id"].isin(acked) & ~new["id"].isin(held["id"])].drop_duplicates("id")
            fresh = fresh.assign(attempts=0, due=now)[OPEN.names]
        late = held["due"] <= now
        out = pd.concat([held[late], fresh]) if len(fresh) else held[late]
        out = out.assign(attempts=out["attempts"] + 1)
        out = out.assign(due=[now + back_off_ms(i, int(n), base_ms, most_ms) for i, n in zip(out["id"], out["attempts"])])
        held = pd.concat([held[~late], out]) if len(out) else held[~late]
        if len(held):
            state.update((_packed(held),))
            state.setTimeoutDuration(max(1, int(held["due"].min()) - now))
        elif state.exists:
            state.remove()
        yield _with_numbers(out).drop(columns="due")

    return deliver


class RedeliveryFlow:
    """Buffer -> target with per-entry redelivery: no table of pending entries.

    The stream's input is the entries and the acknowledgements this flow wrote
    itself.  Deliveries of a micro-batch are written to the store; ids it did not
    leave unprocessed are acknowledged, the others come again from the state, each
    by its own timer.  A store error acknowledges nothing.  A batch that ran is not
    run again, and an entry delivered twice is put twice under the same key.

    Folders under ``root``: ``acks/``, ``target/deltas/`` (merge on read), ``outcomes/``.
    """

    def __init__(self, spark: SparkSession, root: str, fail: Callable[[DataFrame], DataFrame] | None = None,
                 write: Callable[[DataFrame, int], DataFrame] | None = None, base_ms: int = 1000, most_ms: int = 10_000):
        """``write(items, batch id) -> unprocessed ids`` puts items into an external store
        (see ``sluice.sources.store``); ``fail(deliveries) -> failed ids`` injects failures."""
        self.spark, self.root, self.fail, self.write = spark, root, fail, write
        self.base_ms, self.most_ms = base_ms, most_ms
        self.target, self.acks, self.outcomes = f"{root}/target", f"{root}/acks", f"{root}/outcomes"
        use_state_store(spark)
        if not fs_exists(spark, self.acks):
            spark.createDataFrame([], "id string").write.parquet(f"{self.acks}/batch=-1")

    def _input(self, entries: DataFrame) -> DataFrame:
        acks = self.spark.readStream.schema("id string").parquet(f"{self.acks}/*").select(
            F.lit("ack").alias("kind"), "id", *[F.lit(None).cast(t).alias(c) for c, t in (
                ("seq", "string"), ("origin", "string"), ("schemaURI", "string"), ("timestamp", "timestamp"), ("data", "string"))])
        own = entries.withColumn("seq", F.col("seq").cast("string")).select(F.lit("entry").alias("kind"), *buf.ENTRY_COLUMNS)
        return own.unionByName(acks).withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(BUCKETS)))

    def run_batch(self, deliveries: DataFrame, batch_id: int) -> None:
        if fs_exists(self.spark, f"{self.outcomes}/batch={batch_id}/_SUCCESS"):
            return
        deliveries = deliveries.persist()
        try:
            if deliveries.isEmpty():
                return
            items = env.item(deliveries, keep=["seq"])
            place = f"{self.root}/failed/batch={batch_id}"
            if not fs_exists(self.spark, f"{place}/_SUCCESS"):  # the store is asked once
                try:
                    left = (self.fail(deliveries) if self.fail else self.write(items, batch_id) if self.write
                            else deliveries.limit(0))
                    left.select("id").write.mode("overwrite").parquet(place)
                except Exception as exc:  # noqa: BLE001 - a store error fails the batch, not the stream
                    log.warning("batch %s: store write failed, nothing acknowledged: %s", batch_id, exc)
                    deliveries.select("id").write.mode("overwrite").parquet(place)
            failed = self.spark.read.schema("id string").parquet(place)
            persisted, _ = per.split_by_failures(deliveries, failed)
            if self.write is None:
                per.append_items(items.join(persisted.select("id"), "id", "left_semi"), self.target, batch_id)
            persisted.select("id").write.mode("overwrite").parquet(f"{self.acks}/batch={batch_id}")
            number = F.lit(batch_id).cast("bigint").alias("batch_id")
            outcome = per.batch_outcome(deliveries.select(number, "id"), failed.select(number, "id"))
            outcome.write.mode("overwrite").parquet(f"{self.outcomes}/batch={batch_id}")
        finally:
            deliveries.unpersist()

    def start(self, entries: DataFrame, checkpoint: str, trigger: dict | None = None):
        deliveries = self._input(entries).groupBy("bucket").applyInPandasWithState(
            redelivery(self.base_ms, self.most_ms), DELIVERY, "open binary", "append", "ProcessingTimeTimeout")
        w = deliveries.writeStream.foreachBatch(self.run_batch).option("checkpointLocation", checkpoint)
        return w.trigger(**(trigger or {"processingTime": "1 second"})).start()

    def open_frame(self, checkpoint: str) -> DataFrame:
        """Entries delivered and not yet acknowledged, read from the state store."""
        state = self.spark.read.format("statestore").load(checkpoint).select(F.col("value.groupState.open").alias("open"))

        def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for held in batches:
                yield from (_with_numbers(_unpacked(x)) for x in held["open"])

        return state.mapInPandas(rows, f"{DELIVERY}, due long")

    def run_until_acknowledged(self, entries: DataFrame, checkpoint: str, timeout: float = 600.0,
                               trigger: dict | None = None) -> None:
        """Run the stream until its input is read and every entry is acknowledged."""
        import time
        query, deadline = self.start(entries, checkpoint, trigger or {"processingTime": "0 seconds"}), time.time() + timeout
        first = None
        try:
            while query.isActive and time.time() < deadline:
                time.sleep(0.2)
                p = query.lastProgress
                # the first batch may be one planned before a restart, without what came since
                first = p.batchId if p and first is None else first
                if p and p.batchId > max(0, first) and p.numInputRows == 0 and not query.status["isDataAvailable"] \
                        and sum(s.numRowsTotal for s in p.stateOperators) == 0:
                    break
            else:
                raise TimeoutError(f"entries still open after {timeout} s") if query.isActive else query.exception()
        finally:
            query.stop()

    def target_frame(self) -> DataFrame:
        state = per.merged_state(self.spark, self.target)
        if state is None:
            return self.spark.createDataFrame([], "id string, timestamp string, origin string, schemaURI string, data string, seq bigint")
        return state

    def outcome_frame(self) -> DataFrame:
        return self.spark.read.parquet(self.outcomes)


# -- the registry over a stream -------------------------------------------------------

ANSWER = "seq long, op string, name string, version string, key string, outcome string, body string"


class RegistryState(StatefulProcessor):
    """Answers requests of one registry key in order of ``seq``; the state is its live document."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.document = handle.getValueState("document", "schema string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802,N803
        held = self.document.get()[0] if self.document.exists() else None
        before, out = held, []
        for r in pd.concat(list(rows)).sort_values("seq", kind="stable").itertuples(index=False):
            outcome, body = "bad_request", None
            if r.op == "add" and r.good:
                outcome, held = "created", r.schema
            elif r.op in ("get", "del"):
                outcome = "not_found" if held is None else "ok" if r.op == "get" else "deleted"
                body = '{"schema":' + held + "}" if outcome == "ok" else None
                held = None if r.op == "del" else held
            out.append((r.seq, r.op, r.name, r.version, key[0], outcome, body))
        if held is None and before is not None:
            self.document.clear()
        elif held is not None and held != before:
            self.document.update((held,))
        yield pd.DataFrame(out, columns=["seq", "op", "name", "version", "key", "outcome", "body"])

    def close(self) -> None:
        pass


def answer_request_stream(requests: DataFrame, root: str, checkpoint: str, prefix: str = DEFAULT_KEY_PREFIX,
                          trigger: dict | None = None):
    """Start answering a stream of requests ``(seq, op, name, version, schema)``.

    Same outcomes as the batch form (``registry.answer_requests``) for requests that
    arrive in order; answers go to ``root/answers``.  Two streams: the first judges
    keys and documents per micro-batch and writes the judged requests, in order of
    arrival; the second keeps the live document of every key as state and answers
    from it, so a get costs its own key and not the registry.
    """
    spark = requests.sparkSession
    use_state_store(spark)
    judged = f"{root}/judged"

    def judge(df: DataFrame, batch_id: int) -> None:
        place = f"{judged}/batch={batch_id}"
        if fs_exists(spark, f"{place}/_SUCCESS"):
            return
        key_ok = request_ok("name", "version")
        adds = df.withColumn("__text", F.when((F.col("op") == "add") & key_ok, F.col("schema")))
        rows = with_admission(adds, "__text", "good")
        rows.select("seq", "op", "name", "version", "schema", "good",
                    F.when(key_ok, registry_key("name", parse_semver("version"), prefix)).alias("key")).write.mode("overwrite").parquet(place)

    first = (requests.writeStream.foreachBatch(judge).option("checkpointLocation", f"{checkpoint}/judge")
             .trigger(**(trigger or {"processingTime": "1 second"})).start())
    if trigger and trigger.get("availableNow"):
        first.awaitTermination()
    elif not fs_exists(spark, judged):
        spark.createDataFrame([], JUDGED).write.parquet(f"{judged}/batch=-1")
    rows = spark.readStream.schema(JUDGED).option("maxFilesPerTrigger", "1000000").parquet(f"{judged}/*")
    # requests without a usable key need no state, and are no group of their own
    refused = rows.where("key IS NULL").select("seq", "op", "name", "version", "key", F.lit("bad_request").alias("outcome"),
                                               F.lit(None).cast("string").alias("body"))
    answers = (rows.where("key IS NOT NULL").groupBy("key")
               .transformWithStateInPandas(RegistryState(), ANSWER, "Append", "None").unionByName(refused))
    second = (answers.writeStream.format("parquet").option("path", f"{root}/answers")
              .option("checkpointLocation", f"{checkpoint}/answer").trigger(**(trigger or {"processingTime": "1 second"})).start())
    return first, second


JUDGED = "seq long, op string, name string, version string, schema string, good boolean, key string"
