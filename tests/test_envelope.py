"""Envelope construction and its other forms (reference model tests as case tables)."""

import datetime as dt

from pyspark.sql import functions as F

from sluice.functions import rfc3339
from sluice.operators import envelope as env


def _records(spark, headers_list):
    rows = [(None, b'{"a":1}', "t", 0, i, dt.datetime(2024, 1, 2, 3, 4, 5), 0, h)
            for i, h in enumerate(headers_list)]
    return spark.createDataFrame(rows, env.KAFKA_SCHEMA)


def test_first_schema_header_wins(spark):
    hs = [
        [],
        [("schemaURI", b"u1")],
        [("x", b"y"), ("schemaURI", b"u1"), ("schemaURI", b"u2")],
        [("schemauri", b"u1")],
    ]
    e = env.to_envelope(_records(spark, hs)).orderBy("offset")
    assert [r["schemaURI"] for r in e.collect()] == ["", "u1", "u1", ""]
    r = e.first()
    assert r["origin"] == "t" and r["data"] == '{"a":1}' and r["offset"] == 0


def test_skip_tombstones(spark):
    rows = [(None, None, "t", 0, 0, None, 0, []), (None, b"{}", "t", 0, 1, None, 0, [])]
    df = spark.createDataFrame(rows, env.KAFKA_SCHEMA)
    assert env.skip_tombstones(df).count() == 1


def test_field_list_order_and_empty_message(spark):
    df = spark.createDataFrame(
        [("kafka", "u", dt.datetime(2024, 1, 2, 3, 4, 5), '{"a":1}'), (None, None, None, None)],
        env.ENVELOPE_SCHEMA)
    got = [r[0] for r in df.select(env.field_list(df)).collect()]
    assert got[0] == ["origin", "kafka", "schemaURI", "u", "timestamp", "2024-01-02T03:04:05Z", "data", '{"a":1}']
    assert got[1] == ["origin", "", "schemaURI", "", "timestamp", "0001-01-01T00:00:00Z", "data", ""]


DECODE_CASES = [
    # stored fields -> (origin, schemaURI, timestamp text, data, envelope ok)
    ({"origin": "o", "schemaURI": "u", "timestamp": "2024-01-02T03:04:05Z", "data": "{}"},
     ("o", "u", "2024-01-02T03:04:05Z", "{}", True)),
    ({"schemaURI": "u", "timestamp": "2024-01-02T03:04:05Z", "data": "{}"},
     ("", "u", "2024-01-02T03:04:05Z", "{}", False)),
    ({"origin": "o", "timestamp": "2024-01-02T03:04:05Z", "data": "{}"},
     ("o", "", "2024-01-02T03:04:05Z", "{}", False)),
    ({"origin": "o", "schemaURI": "u", "timestamp": "2024-01-02T03:04:05Z"},
     ("o", "u", "2024-01-02T03:04:05Z", "", False)),
    ({"origin": "o", "schemaURI": "u", "data": "{}"},
     ("o", "u", "0001-01-01T00:00:00Z", "{}", False)),
    ({"origin": "o", "schemaURI": "u", "timestamp": "nope", "data": "{}"},
     ("o", "u", "0001-01-01T00:00:00Z", "{}", False)),
    ({"origin": "o", "schemaURI": "u", "timestamp": "2024-01-02", "data": "{}"},
     ("o", "u", "0001-01-01T00:00:00Z", "{}", False)),
    ({"origin": "o", "schemaURI": "u", "timestamp": "2024-01-02T03:04:05.5+02:00", "data": "{}"},
     ("o", "u", "2024-01-02T01:04:05Z", "{}", True)),
    ({"origin": "o", "schemaURI": "u", "timestamp": "2024-01-02T03:04:05Z", "data": "not json"},
     ("o", "u", "2024-01-02T03:04:05Z", "not json", False)),
]


def test_decode_case_table(spark):
    df = spark.createDataFrame([(i, m) for i, (m, _) in enumerate(DECODE_CASES)], "i int, m map<string,string>")
    dec = df.select("i", *env.from_field_map("m")).select(
        "i", "origin", "schemaURI", rfc3339("timestamp").alias("ts"), "data", env.envelope_ok().alias("ok"))
    got = {r["i"]: (r["origin"], r["schemaURI"], r["ts"], r["data"], r["ok"]) for r in dec.collect()}
    for i, (_, want) in enumerate(DECODE_CASES):
        assert got[i] == want, i


def test_field_list_round_trip(spark):
    df = spark.createDataFrame([("kafka", "u", dt.datetime(2024, 1, 2, 3, 4, 5), '{"a":1}')], env.ENVELOPE_SCHEMA)
    fl = df.select(env.field_list(df).alias("fl"))
    back = fl.select(*env.from_field_map(env.from_field_list("fl"))).first()
    assert (back["origin"], back["schemaURI"], back["data"]) == ("kafka", "u", '{"a":1}')
    assert back["timestamp"] == dt.datetime(2024, 1, 2, 3, 4, 5)


def test_field_pairs_has_four_rows(spark):
    df = spark.createDataFrame([("kafka", "u", dt.datetime(2024, 1, 2), "{}")], env.ENVELOPE_SCHEMA)
    assert sorted(r["name"] for r in env.field_pairs(df).collect()) == sorted(env.FIELD_NAMES)


def test_item_projection(spark):
    data = '{"sku": 7, "label": "lamp"}'
    df = spark.createDataFrame([("item-4", "kafka", "http://schema-repo/user/1.0.0",
                                 dt.datetime(2024, 1, 2, 3, 4, 5), data)],
                               "id string, origin string, schemaURI string, timestamp timestamp, data string")
    it = env.item(df)
    assert it.columns == ["id", "timestamp", "origin", "schemaURI", "data"]
    assert dict(it.schema.fields and [(f.name, f.dataType.simpleString()) for f in it.schema.fields]) == \
        {c: "string" for c in it.columns}
    r = it.first()
    assert r["id"] == "item-4" and r["data"] == data and r["timestamp"] == "2024-01-02T03:04:05Z"
