"""Buffer (append, read group, ack, delete) and persistence (upsert, outcome, chunked writes)."""

import datetime as dt
import os

from pyspark.sql import functions as F

from sluice.operators import buffer as buf
from sluice.operators import envelope as env
from sluice.operators import persist as per
from sluice.session import new_run_dir

TS = dt.datetime(2024, 1, 2, 3, 4, 5)


def _entries(spark, ids_seqs):
    return spark.createDataFrame([(i, s, "o", "u", TS, '{"x":%d}' % s) for i, s in ids_seqs],
                                 "id string, seq bigint, origin string, schemaURI string, timestamp timestamp, data string")


def test_append_read_ack_delete_sequence(spark):
    path = new_run_dir(spark, "buffer")
    buf.append(_entries(spark, [("b-17-3", 1)]), path)
    stored = spark.read.parquet(path)
    empty = stored.limit(0)
    got = buf.read_group(stored, empty).collect()
    assert len(got) == 1 and got[0]["schemaURI"] == "u" and got[0]["data"] == '{"x":1}'
    pending = buf.ack(stored, stored.select("id"))
    assert pending.count() == 0
    remaining = buf.delete(stored, stored.select("id"))
    assert buf.read_group(remaining, pending).count() == 0


def test_read_group_cases(spark):
    new = _entries(spark, [("a", 1), ("b", 2), ("c", 3)])
    pending = _entries(spark, [("b", 2), ("z", 0)])
    g = buf.read_group(new, pending)
    assert sorted(r["id"] for r in g.collect()) == ["a", "b", "c", "z"]
    assert buf.read_group(new.limit(0), pending.limit(0)).count() == 0
    capped = buf.read_group(new, pending, count=1)
    assert sorted(r["id"] for r in capped.collect()) == ["a", "z"]


def test_ack_of_unknown_id_is_harmless(spark):
    pending = _entries(spark, [("a", 1), ("b", 2)])
    acks = spark.createDataFrame([("b",), ("nope",), ("b",)], "id string")
    assert [r["id"] for r in buf.ack(pending, acks).collect()] == ["a"]


def test_dedupe_last(spark):
    df = _entries(spark, [("a", 1), ("a", 5), ("b", 2)])
    got = {r["id"]: r["seq"] for r in buf.dedupe_last(df).collect()}
    assert got == {"a": 5, "b": 2}


OUTCOME_CASES = [  # batch, size, failed count, verdict, acked
    (0, 0, 0, "empty", 0),
    (1, 5, 0, "ok", 5),
    (2, 5, 2, "partial", 3),
    (3, 5, 5, "failed", 0),
]


def test_batch_outcome_case_table(spark):
    rows, failed = [], []
    for b, size, nfail, _, _ in OUTCOME_CASES:
        for i in range(size):
            rows.append((b, f"{b}-{i}"))
            if i < nfail:
                failed.append((b, f"{b}-{i}"))
    batch = spark.createDataFrame(rows, "batch_id bigint, id string")
    fails = spark.createDataFrame(failed, "batch_id bigint, id string")
    batches = spark.createDataFrame([(b,) for b, *_ in OUTCOME_CASES], "batch_id bigint")
    out = {r["batch_id"]: r for r in per.batch_outcome(batch, fails, batches).collect()}
    for b, size, nfail, verdict, acked in OUTCOME_CASES:
        assert out[b]["verdict"] == verdict
        assert out[b]["persisted_count"] == acked
        assert out[b]["unpersisted_count"] == nfail
    persisted, unpersisted = per.split_by_failures(batch, fails)
    assert persisted.count() + unpersisted.count() == batch.count()
    assert persisted.join(unpersisted, "id").count() == 0


def test_upsert_is_idempotent_and_latest_wins(spark):
    items = env.item(_entries(spark, [("a", 1), ("b", 2)]), keep=["seq"])
    later = items.where("id = 'a'").withColumn("seq", F.lit(9)).withColumn("data", F.lit("new"))
    s1 = per.upsert(None, items)
    s2 = per.upsert(s1, later)
    s3 = per.upsert(s2, later)  # replay
    assert sorted((r["id"], r["data"]) for r in s3.collect()) == [("a", "new"), ("b", '{"x":2}')]
    assert s2.exceptAll(s3).count() == 0


def test_upsert_table_touches_only_its_buckets(spark):
    root = new_run_dir(spark, "upsert")
    path, stage = os.path.join(root, "t"), os.path.join(root, "s")
    first = env.item(_entries(spark, [(f"id{i}", i) for i in range(200)]), keep=["seq"])
    per.upsert_table(spark, first, path, stage, n_buckets=16)
    second = first.where("seq < 10").withColumn("seq", F.col("seq") + 1000).withColumn("data", F.lit("v2"))
    per.upsert_table(spark, second, path, stage, n_buckets=16)
    per.upsert_table(spark, second, path, stage, n_buckets=16)  # replay
    t = spark.read.parquet(path)
    assert t.count() == 200
    assert t.where("data = 'v2'").count() == 10
    assert set(t.columns) >= {"day", "bucket"}


def test_chunked_writer_retries(spark):
    calls = {"n": 0}

    def write_chunk(items):
        calls["n"] += 1
        # the first attempt of every chunk leaves odd ids unprocessed; "stuck" never succeeds
        return [r["id"] for r in items if r["id"] == "stuck" or (calls["n"] % 2 == 1 and r["id"].endswith(("1", "3")))]

    run = per.chunked_writer(write_chunk, chunk_size=3, attempts=3, base_backoff=0.0)
    import pandas as pd
    out = list(run(iter([pd.DataFrame({"id": ["a1", "a2", "a3", "stuck"]})])))
    assert sorted(out[0]["id"]) == ["stuck"]


def test_hot_key_is_combined_before_the_shuffle(spark):
    """A key holding a third of the rows is reduced map-side (partial aggregate)."""
    rows = [("hot" if i % 3 == 0 else f"k{i}", i) for i in range(3000)]
    df = _entries(spark, rows)
    out = buf.dedupe_last(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan
    got = {r["id"]: r["seq"] for r in out.collect()}
    assert got["hot"] == 2997 and len(got) == 2001
    up = per.upsert(None, env.item(df, keep=["seq"]))
    assert "partial_max_by" in up._jdf.queryExecution().executedPlan().toString()
