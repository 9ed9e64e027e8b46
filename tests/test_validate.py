"""Validation: reference validator cases, fault cases on order 2.0.0, $ref, both designs."""

import json

import pytest
from pyspark.sql import functions as F

from sluice.operators import validate as val
from tests.conftest import envelopes

ORDER = "http://schema-repository:8080/schemas/order/2.0.0"
DESIGNS = ["compiled", "rules"]


def _reg(spark, docs: dict):
    return spark.createDataFrame([(u, json.dumps(d)) for u, d in docs.items()], "schemaURI string, schema string")


def _run(spark, registry, rows, design):
    out = val.validate(envelopes(spark, rows), registry, design=design)
    return {r["k"]: (r["status"], r["reason"], sorted(r["errors"] or [])) for r in out.collect()}


NAME_AGE = {"type": "object", "properties": {"name": {"type": "string"}, "age": {"type": "number"}},
            "required": ["name"]}
NAME_AGE_NOREQ = {"type": "object", "properties": {"name": {"type": "string"}, "age": {"type": "number"}}}


@pytest.mark.parametrize("design", DESIGNS)
def test_valid_missing_and_mistyped(spark, design):
    reg = _reg(spark, {"http://t/schemas/a/1": NAME_AGE, "http://t/schemas/b/1": NAME_AGE_NOREQ})
    got = _run(spark, reg, [
        ("valid", "http://t/schemas/a/1", '{"name":"Ada","age":41}'),
        ("missing", "http://t/schemas/a/1", '{"age":41}'),
        ("wrongtype", "http://t/schemas/b/1", '{"name":"Ada","age":"old"}'),
    ], design)
    assert got["valid"][0] == "valid"
    assert got["missing"] == ("invalid", "schema_violation", ["required:name"])
    assert got["wrongtype"] == ("invalid", "schema_violation", ["type:age"])


ORDER_CASES = [
    # key, data, expected status, expected errors
    ("ok", '{"orderId":1,"userId":2,"productIds":[3],"total":1.5,"status":"pending"}', "valid", []),
    ("ids_null", '{"orderId":1,"userId":2,"productIds":null,"total":1.5}', "invalid", ["type:productIds"]),
    ("ids_text", '{"orderId":1,"userId":2,"productIds":[1,"x"],"total":1.5}', "invalid", ["type:productIds[]"]),
    ("no_total", '{"orderId":1,"userId":2,"productIds":[1]}', "invalid", ["required:total"]),
    ("status_null", '{"orderId":1,"userId":2,"productIds":[1],"total":1,"status":null}', "invalid",
     ["enum:status", "type:status"]),
    ("status_bad", '{"orderId":1,"userId":2,"productIds":[1],"total":1,"status":"lost"}', "invalid", ["enum:status"]),
    ("id_1_0", '{"orderId":1.0,"userId":2,"productIds":[1],"total":1}', "valid", []),
    ("id_1e3", '{"orderId":1e3,"userId":2,"productIds":[1],"total":1}', "valid", []),
    ("id_1_5", '{"orderId":1.5,"userId":2,"productIds":[1],"total":1}', "invalid", ["type:orderId"]),
    ("id_text", '{"orderId":"1","userId":2,"productIds":[1],"total":1}', "invalid", ["type:orderId"]),
    ("id_20dig", '{"orderId":12345678901234567890,"userId":2,"productIds":[1],"total":1}', "valid", []),
    ("extra", '{"orderId":1,"userId":2,"productIds":[],"total":1,"other":{"x":1}}', "valid", []),
    ("root_array", "[1,2]", "invalid", ["type:$"]),
    ("dup_key", '{"orderId":"x","orderId":1,"userId":2,"productIds":[1],"total":1}', "valid", []),
    ("ws_root", ' \n {"orderId":1,"userId":2,"productIds":[1],"total":1}', "valid", []),
]


@pytest.mark.parametrize("design", DESIGNS)
def test_order_fault_cases(spark, registry, design):
    rows = [(k, ORDER, d) for k, d, _, _ in ORDER_CASES]
    got = _run(spark, registry, rows, design)
    for k, _, status, errors in ORDER_CASES:
        assert got[k][0] == status, k
        assert got[k][2] == errors, k


@pytest.mark.parametrize("design", DESIGNS)
def test_error_outcomes(spark, registry, design):
    good = '{"orderId":1,"userId":2,"productIds":[1],"total":1}'
    got = _run(spark, registry, [
        ("truncated", ORDER, '{"orderId":1'),
        ("empty", ORDER, ""),
        ("null_data", ORDER, None),
        ("no_header", "", good),
        ("null_header", None, good),
        ("unknown", "http://schema-repository:8080/schemas/nope/1.0.0", good),
        ("short_version", "http://schema-repository:8080/schemas/order/2", good),
    ], design)
    assert got["truncated"] == ("error", "invalid_json", [])
    assert got["empty"][1] == "invalid_json"
    assert got["null_data"][1] == "invalid_json"
    assert got["no_header"][1] == "missing_schema_uri"
    assert got["null_header"][1] == "missing_schema_uri"
    assert got["unknown"][1] == "schema_not_found"
    assert got["short_version"][0] == "valid"


@pytest.mark.parametrize("design", DESIGNS)
def test_ref_and_minimum(spark, registry, design):
    acct = "http://schema-repository:8080/schemas/account/1.0.0"
    got = _run(spark, registry, [
        ("ok", acct, '{"id":1,"balance":0,"owner":{"name":"a"}}'),
        ("neg", acct, '{"id":1,"balance":-0.5,"owner":{"name":"a"}}'),
        ("owner_bad", acct, '{"id":1,"balance":2,"owner":{"name":5}}'),
        ("owner_noname", acct, '{"id":1,"balance":2,"owner":{}}'),
        ("owner_notobj", acct, '{"id":1,"balance":2,"owner":"x"}'),
    ], design)
    assert got["ok"][0] == "valid"
    assert got["neg"][2] == ["minimum:balance"]
    assert got["owner_bad"][2] == ["type:owner.name"]
    assert got["owner_noname"][2] == ["required:owner.name"]
    assert got["owner_notobj"][2] == ["type:owner"]


@pytest.mark.parametrize("design", DESIGNS)
def test_unresolved_ref_is_error(spark, design):
    reg = _reg(spark, {"http://t/schemas/r/1.0.0": {
        "type": "object", "properties": {"user": {"$ref": "http://t/schemas/missing/1.0.0"}}}})
    got = _run(spark, reg, [("x", "http://t/schemas/r/1.0.0", '{"user":{}}')], design)
    assert got["x"][:2] == ("error", "unresolved_ref")


def test_email_format_is_opt_in(spark, registry):
    user = "http://schema-repository:8080/schemas/user/1.0.0"
    rows = [("bad", user, '{"id":1,"name":"n","email":"not-an-email"}')]
    assert _run(spark, registry, rows, "compiled")["bad"][0] == "valid"
    out = val.validate(envelopes(spark, rows), registry, design="compiled", assert_email=True)
    assert out.first()["errors"] == ["format:email"]


def test_counts_add_up_and_designs_agree(spark, registry):
    from sluice.operators import envelope as env
    from sluice.sources import testdata as td
    msgs = env.to_envelope(td.order_records(spark, "/root/testdata/sf0.001"))
    a = val.validate(msgs, registry, design="compiled")
    b = val.validate(msgs, registry, design="rules")
    n = msgs.count()
    counts = {r["status"]: r["count"] for r in a.groupBy("status").count().collect()}
    assert sum(counts.values()) == n
    key = ["offset", "status", "reason", F.array_join(F.array_sort("errors"), ",").alias("e")]
    assert a.select(*key).exceptAll(b.select(*key)).count() == 0


def test_status_filter_stays_above_the_checks(spark, registry):
    """A filter on the outcome must not be pushed into the payload checks."""
    msgs = envelopes(spark, [("a", ORDER, "{}")])
    plan = val.valid_only(val.validate(msgs, registry, design="compiled"))._jdf.queryExecution() \
        .optimizedPlan().toString()
    filt = plan[:plan.index("Generate")]
    assert "try_parse_json" not in filt and "schema_of_variant" not in filt


def test_salted_join_matches_broadcast(spark, registry):
    from sluice.operators import envelope as env
    from sluice.operators.rules import validate_rules
    from sluice.sources import testdata as td
    msgs = env.to_envelope(td.order_records(spark, "/root/testdata/sf0.001"))
    key = ["offset", "status", "reason", F.array_join("errors", ",").alias("e")]
    a = validate_rules(msgs, registry, broadcast=True).select(*key)
    b = validate_rules(msgs, registry, broadcast=False).select(*key)
    assert a.count() == b.count() == msgs.count()
    assert a.exceptAll(b).count() == 0


@pytest.mark.parametrize("design", DESIGNS)
def test_memo_follows_registry_content(spark, design):
    """Compilations are reused per registry content; a changed document is recompiled."""
    u = "http://t/schemas/memo/1.0.0"
    loose = _reg(spark, {u: {"type": "object"}})
    strict = _reg(spark, {u: {"type": "object", "required": ["a"]}})
    rows = [("x", u, '{"b":1}')]
    assert _run(spark, loose, rows, design)["x"][0] == "valid"
    assert _run(spark, strict, rows, design)["x"] == ("invalid", "schema_violation", ["required:a"])
    assert _run(spark, loose, rows, design)["x"][0] == "valid"
