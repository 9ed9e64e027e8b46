"""Scalar functions: versions, RFC3339 text, routes (case tables)."""

import pytest
from pyspark.sql import functions as F

from sluice.functions import (parse_rfc3339, parse_semver, registry_key, rfc3339, schema_uri,
                              semver_text, topic_of, uri_name, uri_version)

SEMVER_CASES = [
    ("1", "1.0.0"), ("1.2", "1.2.0"), ("01.0", "1.0.0"), ("1023.0.0", "1023.0.0"),
    ("1.2.3", "1.2.3"), ("0", "0.0.0"), ("007.010.0001", "7.10.1"),
    ("1024", None), ("1.", None), ("", None), ("1.2.3.4", None), ("-1", None), ("+1", None),
    ("1_0", None), ("1" * 41, None), ("0" * 40 + "1", "1.0.0"), ("invalid", None), (".1", None),
    ("1..2", None), (" 1", None), ("1.1024", None),
]


def test_semver_case_table(spark):
    df = spark.createDataFrame([(t,) for t, _ in SEMVER_CASES], "t string")
    got = {r["t"]: r["v"] for r in df.select("t", semver_text(parse_semver("t")).alias("v")).collect()}
    for text, want in SEMVER_CASES:
        if want is None:
            assert got[text] in (None, ""), text
        else:
            assert got[text] == want, text


def test_registry_key_uses_normalised_version(spark):
    df = spark.createDataFrame([("1",), ("1.0.0",), ("01.0",)], "v string")
    keys = {r[0] for r in df.select(registry_key(F.lit("user"), parse_semver("v"))).collect()}
    assert keys == {"schema:user:1.0.0"}


def test_rfc3339_format_and_zero_time(spark):
    df = spark.sql("select timestamp'2024-01-02 03:04:05.678' t union all select null")
    got = sorted(r[0] for r in df.select(rfc3339("t")).collect())
    assert got == ["0001-01-01T00:00:00Z", "2024-01-02T03:04:05Z"]


@pytest.mark.parametrize("text,want", [
    ("2024-01-02T03:04:05Z", "2024-01-02T03:04:05Z"),
    ("2024-01-02T03:04:05+02:00", "2024-01-02T01:04:05Z"),
    ("2024-01-02T03:04:05.123456Z", "2024-01-02T03:04:05Z"),
    ("2024-01-02T03:04:05-01:30", "2024-01-02T04:34:05Z"),
    ("2024-01-02", "0001-01-01T00:00:00Z"),
    ("2024-01-02 03:04:05", "0001-01-01T00:00:00Z"),
    ("2024-01-02T03:04:05", "0001-01-01T00:00:00Z"),
    ("nope", "0001-01-01T00:00:00Z"),
    ("", "0001-01-01T00:00:00Z"),
    (None, "0001-01-01T00:00:00Z"),
])
def test_rfc3339_parse(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(rfc3339(parse_rfc3339("t"))).first()[0] == want


def test_routes(spark):
    df = spark.createDataFrame([("order", "2.0.0")], "n string, v string")
    r = df.select(topic_of("n").alias("t"), schema_uri("n", "v").alias("u")).first()
    assert r["t"] == "order-topic"
    assert r["u"] == "http://schema-repository:8080/schemas/order/2.0.0"
    u = spark.createDataFrame([(r["u"],), ("http://x/schemas/only",), ("http://x/other/a/b",)], "u string")
    got = [(x[0], x[1]) for x in u.select(uri_name("u"), uri_version("u")).collect()]
    assert got == [("order", "2.0.0"), (None, None), (None, None)]


def test_json_text_helpers(spark):
    from sluice.functions import split_csv, text_of_bytes, try_json, valid_utf8
    df = spark.createDataFrame([(bytearray(b'{"a":1}'), "b1:9092,b2:9092", '{"x":'),
                                (bytearray(b"\xff\xfe"), "t", "[1]")], "b binary, csv string, j string")
    rows = df.select(text_of_bytes("b").alias("t"), valid_utf8("b").alias("u"), split_csv("csv").alias("s"),
                     try_json("j").isNotNull().alias("ok")).collect()
    assert rows[0]["t"] == '{"a":1}' and rows[0]["u"] == '{"a":1}'
    assert rows[1]["u"] is None
    assert rows[0]["s"] == ["b1:9092", "b2:9092"] and rows[1]["s"] == ["t"]
    assert [r["ok"] for r in rows] == [False, True]
