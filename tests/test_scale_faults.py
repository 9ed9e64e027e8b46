"""Faults that only larger inputs show: many schemas, many partitions, topics, caps."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from sluice.operators import buffer as buf
from sluice.operators import registry as reg
from sluice.operators import validate as val
from sluice.session import new_run_dir
from sluice.streaming.persist import PersistFlow
from tests.conftest import envelopes


@pytest.mark.parametrize("partitions", ["1", "8", "200"])
def test_entry_at_any_number_of_shuffle_partitions(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    val._MEMO.clear()
    try:
        assert E.entry(spark).count() > 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def registry_of(spark, n):
    docs = [(f"http://t/schemas/s{i}/1.0.0", json.dumps({"type": "object", "required": [f"f{i}"]})) for i in range(n)]
    return spark.createDataFrame(docs, "schemaURI string, schema string").repartition(7)


def test_fingerprint_follows_content_of_a_large_registry(spark):
    a, b = registry_of(spark, 500), registry_of(spark, 499)
    assert val.registry_fingerprint(a) == val.registry_fingerprint(a.repartition(3)) != val.registry_fingerprint(b)


def test_ingest_with_thirty_schemas(spark):
    from sluice.streaming.ingest import RegistryCache, ingest_batch, read_outcomes
    rows = [(None, b'{"f3":1}' if i % 2 else None, "t", 0, i, dt.datetime(2024, 1, 1), 0,
             [("schemaURI", b"http://t/schemas/s3/1.0.0")]) for i in range(10)]
    records = spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, offset bigint, "
                                          "timestamp timestamp, timestampType int, headers array<struct<key:string,value:binary>>")
    out = new_run_dir(spark, "t-thirty")
    ingest_batch(records, 0, RegistryCache(lambda: registry_of(spark, 30)), out)
    got = read_outcomes(spark, out).select("status", "offset").collect()
    assert {(r.status, r.offset) for r in got} == {("valid", i) for i in range(1, 10, 2)}  # tombstones are skipped


def test_topics_keep_their_records_apart_and_arrival_order_holds(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("a", 0, 9, t), ("b", 0, 9, t), ("a", 0, 10, t), ("a", 1, 2, t - dt.timedelta(seconds=1))]
    e = spark.createDataFrame(rows, "origin string, partition int, offset bigint, timestamp timestamp") \
             .withColumn("schemaURI", F.lit("u")).withColumn("data", F.lit("{}"))
    entries = buf.assign_ids(e).select(*buf.ENTRY_COLUMNS, "offset")
    assert buf.read_group(entries, entries.limit(0)).count() == 4
    order = [(r.origin, r.offset) for r in entries.orderBy("seq", "id").collect()]
    assert order == [("a", 2), ("a", 9), ("a", 10), ("b", 9)]
    assert {r.offset for r in buf.first_n(entries, 2).collect()} == {2, 9}


def entries_of(spark, n):
    return envelopes(spark, [(str(i), "u", "{}") for i in range(n)]).select(
        F.concat(F.lit("e"), "k").alias("id"), F.col("k").cast("bigint").alias("seq"), "origin", "schemaURI", "timestamp", "data")


def test_drain_with_a_small_read_count_leaves_nothing(spark):
    flow = PersistFlow(spark, new_run_dir(spark, "t-cap"), read_count=4)
    flow.run_batch(entries_of(spark, 60), 0)
    assert flow.drain() == 14
    assert flow.pending_frame().isEmpty() and flow.target_frame().count() == 60


def test_drain_stops_when_the_store_refuses_everything(spark):
    flow = PersistFlow(spark, new_run_dir(spark, "t-refuse"), fail=lambda g: g)
    flow.run_batch(entries_of(spark, 3), 0)
    assert flow.drain() == 1 and flow.pending_frame().count() == 3


def test_registry_keeps_the_documents_own_host_and_path_order(spark):
    doc = lambda title: json.dumps({"$id": "https://schemas.example.com/schemas/x/1.0.0", "title": title})
    corpus = reg.corpus_from_texts(spark, [("b.json", doc("second")), ("a.json", doc("first"))]).repartition(3)
    (row,) = reg.registry_of(corpus).collect()
    assert row.schemaURI == "https://schemas.example.com/schemas/x/1.0.0" and "second" in row.schema
    out = val.validate(envelopes(spark, [("m", row.schemaURI, "{}")]), reg.registry_of(corpus)).first()
    assert out.reason == "ok"


def test_pending_state_stays_small_over_many_batches(spark):
    from sluice.session import fs_children
    flow = PersistFlow(spark, new_run_dir(spark, "t-many"), fail=lambda g: g.where("seq % 2 = 0 AND attempts = 1"))
    for i in range(12):
        flow.run_batch(entries_of(spark, 4).withColumn("id", F.concat(F.lit(f"b{i}-"), "id")), i)
        assert len(fs_children(spark, flow.pending)) <= 2
    flow.drain()
    assert flow.pending_frame().isEmpty() and flow.target_frame().count() == 48


def test_every_corpus_document_projects_to_its_type(spark):
    from sluice.operators.compile import struct_type_of
    kinds = {"string": "string", "integer": "bigint", "number": "double", "boolean": "boolean"}
    rows = reg.load_corpus(spark).collect()
    assert len(rows) == 9
    for r in rows:
        doc = json.loads(r.schema)
        got = {f.name: (f.dataType.simpleString(), f.nullable) for f in struct_type_of(doc).fields}
        want = {k: (kinds.get(p["type"]) or f"array<{kinds[p['items']['type']]}>", k not in doc["required"])
                for k, p in doc["properties"].items()}
        assert got == want, r.path
        text = json.dumps({k: {"string": "s", "integer": 7, "number": 1.5, "boolean": True}.get(p["type"], [])
                           for k, p in doc["properties"].items()})
        one = spark.createDataFrame([(text,)], "t string").select(F.from_json("t", struct_type_of(doc)).alias("x")).first().x
        assert one.asDict() == json.loads(text)


def test_last_before_on_times_carries_across_narrow_buckets(spark):
    import random
    from sluice.operators.sequence import last_before
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    rows = [(rnd.choice(["hot", "hot", "cold", None]), base + dt.timedelta(seconds=rnd.randrange(10**6), microseconds=i),
             rnd.choice([None, i])) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, t timestamp, v int")
    got = {(r.k, r.t): r.p for r in last_before(df, ["k"], "t", "v", "p").collect()}
    for k, t, _ in rows:
        before = [(u, w) for j, u, w in rows if j == k and u < t and w is not None]
        assert got[k, t] == (max(before)[1] if before else None)


def test_bulk_registration_of_versions_past_one_part(spark, tmp_path):
    keys = [0, 49, 51_199, 51_200, 60_000]
    spark.createDataFrame([(k, f"s{k}") for k in keys], "s_suppkey bigint, s_name string").coalesce(1).write.parquet(str(tmp_path / "supplier.parquet"))
    got = {r.required: r.key for r in E.queries()["q50_bulk_register"](spark, str(tmp_path)).collect()}
    assert got == {"s0": "schema:supplier0:1.0.0", "s49": "schema:supplier49:1.0.0", "s51199": "schema:supplier49:1.1023.0",
                   "s51200": "schema:supplier0:1.0.1", "s60000": "schema:supplier0:1.176.1"}
