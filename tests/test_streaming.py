"""Stream = batch, restart adds nothing, persist flow redelivery and replay skip."""

import os

from pyspark.sql import functions as F

from sluice.operators import envelope as env
from sluice.operators import validate as val
from sluice.plans.queries import _replay_files, corpus_registry
from sluice.session import new_run_dir
from sluice.sources import testdata as td
from sluice.sources.kafka import read_replay_stream
from sluice.streaming.ingest import read_buffer, read_outcomes, start_ingest
from sluice.streaming.persist import PersistFlow

SF = "/root/testdata/sf0.001"


def test_ingest_stream_equals_batch_and_restart_adds_nothing(spark):
    run = new_run_dir(spark, "t-ingest")
    src, out, ck = (os.path.join(run, p) for p in ("src", "out", "ck"))
    recs = td.order_records(spark, SF)
    _replay_files(recs, src, 3, "offset")

    def go():
        q = start_ingest(read_replay_stream(spark, src, 1), lambda: corpus_registry(spark), out, ck,
                         trigger={"availableNow": True})
        q.awaitTermination()
        return q

    q = go()
    assert q.lastProgress is not None
    streamed = read_outcomes(spark, out).select("offset", "status", "reason")
    batch = val.validate(env.to_envelope(recs), corpus_registry(spark)).select("offset", "status", "reason")
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch).count() == 0
    n_valid = read_buffer(spark, out).count()
    assert n_valid == batch.where("status = 'valid'").count()
    def files():
        return sorted(os.path.join(d, f) for d, _, fs in os.walk(out) for f in fs)
    before = files()
    go()  # same checkpoint: nothing new to read
    assert files() == before
    assert read_outcomes(spark, out).count() == streamed.count()


def test_persist_flow_redelivers_and_skips_replayed_batches(spark):
    run = new_run_dir(spark, "t-persist")
    entries = td.buffer_entries(spark, SF)
    flow = PersistFlow(spark, os.path.join(run, "state"),
                       fail=lambda g: g.where((F.col("seq") % 5 == 0) & (F.col("attempts") == 1)))
    first = entries.where("seq < 500")
    flow.run_batch(first, 0)
    o0 = flow.outcome_frame().where("batch_id = 0").first()
    assert o0["verdict"] == "partial" and o0["unpersisted_count"] == first.where("seq % 5 = 0").count()
    assert flow.pending_frame().count() == o0["unpersisted_count"]
    flow.run_batch(first, 0)  # replay of a committed batch: skipped
    assert flow.outcome_frame().count() == 1
    flow.run_batch(entries.where("seq >= 500"), 1)
    assert flow.pending_frame().count() == entries.where("seq >= 500 and seq % 5 = 0").count()
    flow.drain()
    assert flow.pending_frame().count() == 0
    t = flow.target_frame()
    assert t.count() == entries.count()
    assert t.select("id").distinct().count() == entries.count()


def test_all_failed_batch_acks_nothing(spark):
    run = new_run_dir(spark, "t-persist-fail")
    entries = td.buffer_entries(spark, SF).where("seq < 50")
    flow = PersistFlow(spark, os.path.join(run, "state"), fail=lambda g: g.select("id"))
    flow.run_batch(entries, 0)
    o = flow.outcome_frame().first()
    assert o["verdict"] == "failed" and o["persisted_count"] == 0
    assert flow.pending_frame().count() == 50


def test_progress_log_records_batches(spark):
    from sluice.streaming.progress import ProgressLog
    log = ProgressLog()
    spark.streams.addListener(log)
    try:
        run = new_run_dir(spark, "t-progress")
        src = os.path.join(run, "src")
        _replay_files(td.order_records(spark, SF), src, 2, "offset")
        q = start_ingest(read_replay_stream(spark, src, 1), lambda: corpus_registry(spark),
                         os.path.join(run, "out"), os.path.join(run, "ck"), trigger={"availableNow": True})
        q.awaitTermination()
        import time
        for _ in range(50):
            if sum(b["input_rows"] for b in log.batches if b["id"] == str(q.id)) >= 1500:
                break
            time.sleep(0.1)
        rows = sum(b["input_rows"] for b in log.batches if b["id"] == str(q.id))
        assert rows == td.order_records(spark, SF).count()
        assert log.failures == []
    finally:
        spark.streams.removeListener(log)


def test_compaction_keeps_state(spark):
    run = new_run_dir(spark, "t-compact")
    entries = td.buffer_entries(spark, SF)
    flow = PersistFlow(spark, os.path.join(run, "state"))
    flow.run_batch(entries.where("seq < 400"), 0)
    flow.run_batch(entries.where("seq >= 300"), 1)  # overlap: redelivered entries
    before = flow.target_frame()
    assert before.count() == entries.count()
    assert flow.compact() is not None
    flow.run_batch(entries.where("seq < 10"), 2)
    after = flow.target_frame()
    assert after.count() == entries.count()
    assert before.select("id", "data").exceptAll(after.select("id", "data")).count() == 0


def test_registry_refresh_between_batches(spark):
    """A schema registered while the stream runs is used from the next batch on."""
    import json as _json
    from sluice.operators import registry as reg_ops
    run = new_run_dir(spark, "t-refresh")
    src, out = os.path.join(run, "src"), os.path.join(run, "out")
    uri = "http://schema-repository:8080/schemas/late/1.0.0"
    rows = [(None, b'{"a":1}', "late-topic", 0, i, None, 0, [("schemaURI", uri.encode())]) for i in range(4)]
    from sluice.operators.envelope import KAFKA_SCHEMA
    recs = spark.createDataFrame(rows, KAFKA_SCHEMA)
    recs.where("offset < 2").write.parquet(os.path.join(src, "f1"))
    docs = [corpus_registry(spark)]
    q = start_ingest(read_replay_stream(spark, os.path.join(src, "*"), 1), lambda: docs[0], out,
                     os.path.join(run, "ck"), trigger={"availableNow": True})
    q.awaitTermination()
    late = reg_ops.registry_of(reg_ops.corpus_from_texts(spark, [("late.json", _json.dumps(
        {"$id": uri, "type": "object", "required": ["a"]}))]))
    docs[0] = corpus_registry(spark).unionByName(late)
    recs.where("offset >= 2").write.parquet(os.path.join(src, "f2"))
    q = start_ingest(read_replay_stream(spark, os.path.join(src, "*"), 1), lambda: docs[0], out,
                     os.path.join(run, "ck"), trigger={"availableNow": True})
    q.awaitTermination()
    got = {r["offset"]: r["reason"] for r in read_outcomes(spark, out).collect()}
    assert got == {0: "schema_not_found", 1: "schema_not_found", 2: "ok", 3: "ok"}


def test_generator_stream_and_graceful_stop(spark):
    from sluice.sources.generator import generate_stream
    from sluice.streaming.progress import stop_after_current_batch
    name = "gen_stream_test"
    q = (generate_stream(spark, rows_per_second=50).writeStream.format("memory").queryName(name)
         .trigger(processingTime="200 milliseconds").start())
    try:
        import time
        for _ in range(100):
            if spark.table(name).count() >= 9:
                break
            time.sleep(0.2)
    finally:
        stop_after_current_batch(q)
    assert not q.isActive
    got = spark.table(name)
    assert got.count() >= 9 and got.select("schemaURI").distinct().count() >= 2


def test_store_error_fails_the_batch_not_the_stream(spark):
    run = new_run_dir(spark, "t-store-error")
    entries = td.buffer_entries(spark, SF).where("seq < 40")

    def broken(group):
        raise RuntimeError("store unavailable")
    flow = PersistFlow(spark, os.path.join(run, "state"), fail=broken)
    flow.run_batch(entries, 0)
    o = flow.outcome_frame().first()
    assert o["verdict"] == "failed" and o["unpersisted_count"] == 40
    assert flow.pending_frame().count() == 40
    flow.fail = None  # the store is back: the next delivery persists everything
    flow.drain()
    assert flow.target_frame().count() == 40


def test_ingest_with_rules_design_equals_batch(spark):
    run = new_run_dir(spark, "t-ingest-rules")
    src, out, ck = (os.path.join(run, p) for p in ("src", "out", "ck"))
    recs = td.order_records(spark, SF)
    _replay_files(recs, src, 3, "offset")
    q = start_ingest(read_replay_stream(spark, src, 1), lambda: corpus_registry(spark), out, ck,
                     trigger={"availableNow": True}, design="rules")
    q.awaitTermination()
    streamed = read_outcomes(spark, out).select("offset", "status", "reason")
    batch = val.validate(env.to_envelope(recs), corpus_registry(spark)).select("offset", "status", "reason")
    assert streamed.exceptAll(batch).count() == 0 and streamed.count() == batch.count()


def test_read_cap_defers_instead_of_dropping(spark):
    run = new_run_dir(spark, "t-cap")
    entries = td.buffer_entries(spark, SF).where("seq < 50")
    flow = PersistFlow(spark, os.path.join(run, "state"), read_count=10)
    flow.run_batch(entries, 0)
    o = flow.outcome_frame().first()
    assert o["n"] == 10
    assert flow.pending_frame().count() == 40
    rounds = flow.drain(max_rounds=20)
    assert rounds >= 4
    assert flow.target_frame().count() == 50


def test_repeated_drains_and_compaction_with_later_batches(spark):
    run = new_run_dir(spark, "t-drain-compact")
    entries = td.buffer_entries(spark, SF)
    flaky = {"on": True}
    flow = PersistFlow(spark, os.path.join(run, "state"),
                       fail=lambda g: g.where("seq % 4 = 0 AND attempts = 1") if flaky["on"] else g.limit(0))
    flow.run_batch(entries.where("seq < 300"), 0)
    flow.drain()
    assert flow.compact() is not None
    flow.run_batch(entries.where("seq >= 300 AND seq < 600"), 1)  # stream batch after a drain
    flow.drain()                                                  # a second drain
    flow.run_batch(entries.where("seq >= 600"), 2)
    flow.drain()
    assert flow.pending_frame().count() == 0
    assert flow.target_frame().count() == entries.count()
    assert flow.compact() is not None
    assert flow.target_frame().count() == entries.count()


def test_fresh_checkpoint_starts_a_new_run_folder(spark):
    run = new_run_dir(spark, "t-ingest-fresh")
    src, out = os.path.join(run, "src"), os.path.join(run, "out")
    _replay_files(td.order_records(spark, SF), src, 2, "offset")
    for ck in ("ck1", "ck2"):
        q = start_ingest(read_replay_stream(spark, src, 1), lambda: corpus_registry(spark), out,
                         os.path.join(run, ck), trigger={"availableNow": True})
        q.awaitTermination()
    runs = [d for d in os.listdir(out) if d.startswith("run=")]
    assert len(runs) == 2
    o = read_outcomes(spark, out)
    n = td.order_records(spark, SF).count()
    assert o.count() == 2 * n and o.select("id").distinct().count() == n
