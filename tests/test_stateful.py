"""Keyed state, cursor reads, the store sink and partition metrics."""

import datetime as dt
import json
import time

import pytest
from pyspark.sql import functions as F

from sluice.operators.sequence import numbered
from sluice.session import new_run_dir
from sluice.sources.cursor import append_in_order, read_capped
from sluice.sources.store import put_batch, register_store, stored
from sluice.streaming.progress import PartitionLog, stop_after_current_batch, watched
from sluice.streaming.stateful import (RedeliveryFlow, answer_request_stream, back_off_ms, unique_stream, use_state_store)

NOW = {"availableNow": True}
ENTRY = "id string, seq long, origin string, schemaURI string, timestamp timestamp, data string"


def entries(spark, ids, start=dt.datetime(2024, 1, 1)):
    rows = [(f"e{i}", i, "t", "u", start + dt.timedelta(seconds=i), json.dumps({"n": i})) for i in ids]
    return spark.createDataFrame(rows, ENTRY)


def append(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def one_by_one(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(path)


def test_unique_stream_drops_copies_and_forgets_old_ids(spark):
    run = new_run_dir(spark, "t-unique")
    use_state_store(spark)
    for ids in (range(0, 50), range(25, 75), range(10_000, 10_010), range(20_000, 20_005)):
        append(entries(spark, ids), f"{run}/src")
    q = (unique_stream(one_by_one(spark, f"{run}/src", ENTRY), "10 minutes").writeStream.format("parquet")
         .option("path", f"{run}/out").option("checkpointLocation", f"{run}/ck").trigger(**NOW).start())
    q.awaitTermination()
    got = sorted(r.id for r in spark.read.parquet(f"{run}/out").collect())
    assert got == sorted(f"e{i}" for i in [*range(75), *range(10_000, 10_010), *range(20_000, 20_005)])
    # 75 + 10 older ids have left the state
    assert q.lastProgress.stateOperators[0].numRowsTotal == 5


def test_redelivery_until_acknowledged(spark):
    run = new_run_dir(spark, "t-redelivery")
    append(entries(spark, range(40)), f"{run}/src")
    append(entries(spark, range(0, 40, 4)), f"{run}/src")
    flow = RedeliveryFlow(spark, f"{run}/state", fail=lambda g: g.where("seq % 5 = 0 AND attempts < 3"), base_ms=50, most_ms=200)
    flow.run_until_acknowledged(one_by_one(spark, f"{run}/src", ENTRY), f"{run}/ck", timeout=120)
    assert sorted(r.seq for r in flow.target_frame().collect()) == list(range(40))
    assert flow.open_frame(f"{run}/ck").isEmpty()
    done = {r.batch_id: r for r in flow.outcome_frame().collect()}
    assert done[0].verdict == "partial" and sum(r.unpersisted_count for r in done.values()) == 16  # eight ids, two refusals each
    # a second stream on the same folders goes on where the first ended
    append(entries(spark, [100]), f"{run}/src")
    flow.run_until_acknowledged(one_by_one(spark, f"{run}/src", ENTRY), f"{run}/ck", timeout=120)
    assert flow.target_frame().count() == 41


def test_store_errors_acknowledge_nothing_and_the_stream_goes_on(spark):
    run = new_run_dir(spark, "t-store-error")
    append(entries(spark, range(6)), f"{run}/src")
    calls = []

    def fail(group):
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("store down")
        return group.limit(0)

    flow = RedeliveryFlow(spark, f"{run}/state", fail=fail, base_ms=50, most_ms=100)
    flow.run_until_acknowledged(one_by_one(spark, f"{run}/src", ENTRY), f"{run}/ck", timeout=120)
    rows = flow.outcome_frame().orderBy("batch_id").collect()
    assert rows[0].verdict == "failed" and rows[-1].verdict == "ok" and flow.target_frame().count() == 6


def test_back_off_doubles_to_a_bound():
    waits = [back_off_ms("k", n, 100, 1000) for n in range(1, 40)]
    assert all(50 <= waits[0] <= 100 and 500 <= w <= 1000 for w in waits[5:]) and waits == [back_off_ms("k", n, 100, 1000) for n in range(1, 40)]


def test_registry_requests_across_batches(spark):
    run = new_run_dir(spark, "t-requests")
    doc = '{"type":"string"}'
    rows = [("get", "a", "1", None, "not_found"), ("add", "a", "1.0", doc, "created"), ("get", "a", "1.0.0", None, "ok"),
            ("add", "a", "1", '{"type":"x"}', "bad_request"), ("get", "a", "1", None, "ok"), ("del", "a", "1", None, "deleted"),
            ("del", "a", "1", None, "not_found"), ("get", "", "1", None, "bad_request"), ("get", "a", "x", None, "bad_request"),
            ("add", "b", "2", "true", "created"), ("put", "b", "2", None, "bad_request"), ("get", "b", "2", None, "ok")]
    schema = "seq long, op string, name string, version string, schema string"
    for i in range(0, len(rows), 5):
        append(spark.createDataFrame([(j, *rows[j][:4]) for j in range(i, min(i + 5, len(rows)))], schema), f"{run}/src")
    for q in answer_request_stream(one_by_one(spark, f"{run}/src", schema), run, f"{run}/ck", trigger=NOW):
        q.awaitTermination()
    got = {r.seq: (r.outcome, r.body) for r in spark.read.parquet(f"{run}/answers").collect()}
    assert {s: o for s, (o, _) in got.items()} == {i: r[4] for i, r in enumerate(rows)}
    assert got[2][1] == '{"schema":' + doc + "}" and got[11][1] == '{"schema":true}'


def flaky(items, attempt):
    return [i["id"] for i in items if i["seq"] == 3 or i["seq"] % 2 and attempt == 1]


def test_store_sink_commits_once_and_aborts_whole(spark):
    path = f"{new_run_dir(spark, 't-store')}/s"
    register_store(spark, flaky, "t_store")
    items = entries(spark, range(20)).select("id", "seq", "data")
    for _ in range(2):  # a batch that is put again counts once
        left = put_batch(items.repartition(3), path, 7, "t_store", attempts=2, chunkSize=4, baseBackoff=0)
        assert [r.id for r in left.collect()] == ["e3"]
    got = stored(spark, path).collect()
    assert sorted(r.seq for r in got) == [i for i in range(20) if i != 3] and {r.batch for r in got} == {7}

    def broken(items, attempt):
        if any(i["seq"] == 5 for i in items):
            raise RuntimeError("no")
        return []

    register_store(spark, broken, "t_broken")
    with pytest.raises(Exception):
        put_batch(items.repartition(3), path, 8, "t_broken")
    assert {r.batch for r in stored(spark, path).collect()} == {7}
    from sluice.sources.files import open_path
    from pyarrow import fs
    system, p = open_path(path)
    assert [f for f in system.get_file_info(fs.FileSelector(f"{p}/staging")) if f.type == fs.FileType.Directory] == []


def test_store_as_streaming_sink(spark):
    run = new_run_dir(spark, "t-store-stream")
    register_store(spark, flaky, "t_store")
    for ids in (range(0, 5), range(5, 9)):
        append(entries(spark, ids), f"{run}/src")
    q = (one_by_one(spark, f"{run}/src", ENTRY).select("id", "seq").writeStream.format("t_store").option("path", f"{run}/s")
         .option("attempts", "2").option("baseBackoff", "0").option("checkpointLocation", f"{run}/ck").trigger(**NOW).start())
    q.awaitTermination()
    got = {(r.seq, r.batch) for r in stored(spark, f"{run}/s").collect()}
    assert {s for s, _ in got} == set(range(9)) - {3} and {b for _, b in got} == {0, 1}


def test_cursor_read_moves_on_and_restarts(spark):
    run = new_run_dir(spark, "t-cursor")
    append_in_order(entries(spark, range(0, 23)), f"{run}/buf", 0)
    sizes = []

    def keep(df, batch_id):
        df.write.mode("overwrite").parquet(f"{run}/out/b={batch_id}")
        sizes.append(df.count())

    def run_once():
        q = (read_capped(spark, f"{run}/buf", ENTRY, f"{run}/ck", count=10).writeStream.foreachBatch(keep)
             .option("checkpointLocation", f"{run}/ck").trigger(processingTime="0 seconds").start())
        q.processAllAvailable()
        q.stop()

    run_once()
    append_in_order(entries(spark, range(23, 50)), f"{run}/buf", 1)
    run_once()
    got = spark.read.parquet(f"{run}/out").collect()
    assert sorted(r.seq for r in got) == list(range(50))
    assert max(sizes) <= 10 and [r.seq for r in sorted(got, key=lambda r: (r.b, r.seq))] == list(range(50))


def test_cursor_cost_does_not_depend_on_the_backlog(spark, tmp_path):
    """Row counts are read for the files of the batch only."""
    from sluice.sources.cursor import CursorReader
    for n in (3, 60):
        path = tmp_path / str(n)
        for i in range(n):
            f = path / f"batch={i:020d}"
            f.mkdir(parents=True)
            entries(spark, [i]).toPandas().to_parquet(f / "part-0.parquet")
        r = CursorReader({"path": str(path), "count": "2", "cursor": str(path / "_c" / "cursor.json")}, None)
        end = r.latestOffset()
        assert end["file"].startswith(f"batch={1:020d}") and len(r.rows) == 2
        assert len(r.partitions(r.initialOffset(), end)) == 2 and r.latestOffset()["file"].startswith("batch=") and len(r.rows) <= 4


def test_partition_log_names_the_bad_partition(spark):
    rows = [("t", p, "error" if p == 3 else "valid") for p in range(5) for _ in range(10)] + [("t", 1, "error"), (None, None, "valid")]
    log = PartitionLog()
    for batch in (0, 0, 1):
        df, seen = watched(spark.createDataFrame(rows, "origin string, partition int, status string").repartition(4))
        df.write.format("noop").mode("overwrite").save()
        log.add(batch, seen)
    assert log.failing() == [("t", 3)]
    assert ("t", 1, "valid", 20) in log.counts() and (None, None, "valid", 2) in log.counts()


def test_numbered_places_every_row(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5000).alias("x"), (F.col("id") % 2).alias("at"))
    out = numbered(df, ["x"], "n")
    assert out.where("n != x").isEmpty() and out.count() == 5000
    assert numbered(df.limit(0), ["x"], "n").count() == 0


def test_a_trigger_takes_many_numbered_reads(spark):
    """A backlog costs a few triggers, not one for every read; no read is above its cap."""
    run = new_run_dir(spark, "t-reads")
    for i, ids in enumerate((range(0, 23), range(23, 24), range(24, 70))):
        append_in_order(entries(spark, ids), f"{run}/buf", i)
    triggers = []

    def keep(df, trigger):
        df.write.mode("overwrite").parquet(f"{run}/out/t={trigger}")
        triggers.append(trigger)

    def run_once():
        q = (read_capped(spark, f"{run}/buf", ENTRY, f"{run}/ck", count=5, reads=6, number="read").writeStream.foreachBatch(keep)
             .option("checkpointLocation", f"{run}/ck").trigger(processingTime="0 seconds").start())
        q.processAllAvailable()
        q.stop()

    run_once()
    assert len(triggers) == 3
    append_in_order(entries(spark, range(70, 72)), f"{run}/buf", 3)
    run_once()
    got = {r.seq: r.read for r in spark.read.parquet(f"{run}/out").collect()}
    assert got == {i: i // 5 for i in range(72)}


def test_open_entries_of_a_bucket_are_one_row_of_state(spark, monkeypatch):
    """Many ids share a group and a timer; every one is delivered and acknowledged by itself."""
    from sluice.streaming import stateful
    monkeypatch.setattr(stateful, "BUCKETS", 2)
    run = new_run_dir(spark, "t-buckets")
    big = 2**60
    append(entries(spark, range(30)).withColumn("seq", F.col("seq") + F.lit(big)), f"{run}/src")
    flow = RedeliveryFlow(spark, f"{run}/state", fail=lambda g: g.where("seq % 3 = 0"), base_ms=50, most_ms=100)
    q = flow.start(one_by_one(spark, f"{run}/src", ENTRY), f"{run}/ck", {"processingTime": "0 seconds"})
    end = time.time() + 60
    while time.time() < end and (q.lastProgress is None or q.lastProgress.batchId < 2):
        time.sleep(0.1)
    stop_after_current_batch(q)
    held = flow.open_frame(f"{run}/ck").collect()
    assert {r.seq for r in held} == {big + i for i in range(30) if (big + i) % 3 == 0} and min(r.attempts for r in held) >= 1
    assert q.lastProgress.stateOperators[0].numRowsTotal <= 2
    flow = RedeliveryFlow(spark, f"{run}/state", base_ms=50, most_ms=100)
    flow.run_until_acknowledged(one_by_one(spark, f"{run}/src", ENTRY), f"{run}/ck", timeout=60)
    assert sorted(r.seq for r in flow.target_frame().collect()) == [big + i for i in range(30)]
    assert flow.open_frame(f"{run}/ck").isEmpty()
