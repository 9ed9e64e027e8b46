"""Registry: corpus load, admission, change-log fold, request outcomes, skew-safe lag."""

import random

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from sluice.functions import semver_text
from sluice.operators import registry as reg
from sluice.operators.sequence import last_before

USER_V1 = '{"type":"object","properties":{"name":{"type":"string"}}}'
USER_V12 = '{"type":"object","properties":{"name":{"type":"string"},"age":{"type":"integer"}}}'


def test_corpus_has_nine_documents(spark):
    c = reg.load_corpus(spark)
    rows = {(r["name"], r["version"]) for r in c.collect()}
    assert len(rows) == 9
    assert ("order", "2.0.0") in rows and ("user", "1.0.0") in rows
    assert reg.reject_documents(c).count() == 0


def test_admission(spark):
    cases = [('{"type": "string"}', True), ("{invalid}", False), ('{"type":"object"', False),
             ("true", True), ('{"type":"objekt"}', False), ('{"type":["string","null"]}', True),
             ('{"required":"name"}', False), ('{"properties":[]}', False), ('{"items":1}', False),
             ('{"enum":"a"}', False), ("[1]", False), (USER_V1, True)]
    df = spark.createDataFrame(cases, "s string, want boolean")
    bad = reg.with_admission(df, "s", "ok").where("ok != want").collect()
    assert bad == []


def _requests(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                                 "seq bigint, op string, name string, version string, schema string")


def test_request_outcomes(spark):
    rows = [
        ("add", "user", "1.0.0", USER_V1),          # created
        ("add", "user", "1.2.0", USER_V12),         # created
        ("add", "user", "2.0.0", '{"type":"object"'),  # bad_request (truncated)
        ("add", "user", "invalid", USER_V1),        # bad_request (version)
        ("get", "user", "1", None),                 # ok (same key as 1.0.0)
        ("get", "user", "9.9.9", None),             # not_found
        ("get", "user", "x.y", None),               # bad_request
        ("del", "user", "1.2", None),               # deleted
        ("del", "user", "1.2.0", None),             # not_found (already deleted)
        ("del", "user", "1.", None),                # bad_request
        ("get", "user", "1.2.0", None),             # not_found
        ("add", "", "1.0.0", USER_V1),              # bad_request (no name)
    ]
    out = reg.answer_requests(_requests(spark, rows), bucket_width=2).orderBy("seq").collect()
    assert [r["outcome"] for r in out] == [
        "created", "created", "bad_request", "bad_request", "ok", "not_found", "bad_request",
        "deleted", "not_found", "bad_request", "not_found", "bad_request"]
    assert reg_body(spark, out[4]["body"]) == USER_V1


def reg_body(spark, body):
    return spark.createDataFrame([(body,)], "b string").select(reg.unwrap_body("b")).first()[0]


def test_fold_last_writer_wins_and_delete(spark):
    log = spark.createDataFrame([
        (1, "set", "a", "1", '{"title":"one"}'),
        (2, "set", "a", "1.0.0", '{"title":"two"}'),
        (3, "set", "b", "1.0", "{}"),
        (4, "del", "b", "1.0.0", None),
        (5, "set", "c", "bad", "{}"),
    ], "seq bigint, op string, name string, version string, schema string")
    state = reg.fold_log(log).select("key", semver_text("version").alias("v"), "schema", "schemaURI").collect()
    assert [(r["key"], r["v"], r["schema"]) for r in state] == [("schema:a:1.0.0", "1.0.0", '{"title":"two"}')]
    assert state[0]["schemaURI"] == "http://schema-repository:8080/schemas/a/1.0.0"


def test_lookup(spark, registry):
    assert reg.lookup(registry, "order", "2").count() == 1
    assert reg.lookup(registry, "order", "3").count() == 0


def test_last_before_matches_plain_window(spark):
    rnd = random.Random(7)
    # one hot key holding most rows, plus a few others; values sometimes NULL
    rows = [(("hot" if rnd.random() < 0.6 else f"k{rnd.randint(0, 5)}"), i,
             None if rnd.random() < 0.3 else rnd.randint(0, 99)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, seq bigint, v int")
    got = last_before(df, ["k"], "seq", "v", "prev", bucket_width=37)
    w = Window.partitionBy("k").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("prev", F.last("v", ignorenulls=True).over(w))
    assert got.select("k", "seq", "prev").exceptAll(want.select("k", "seq", "prev")).count() == 0
    assert got.count() == 3000


def test_register_corpus_all_or_nothing(spark, tmp_path):
    from sluice.operators.registry import RegistrationError, register_corpus
    good = register_corpus(spark)
    assert good.count() == 9
    d = tmp_path / "corpus"
    d.mkdir()
    (d / "a-1.0.0.json").write_text('{"$id":"http://r/schemas/a/1.0.0","type":"object"}')
    (d / "b-1.0.0.json").write_text('{"$id":"http://r/schemas/b/1.0.0","type":"objekt"}')
    try:
        register_corpus(spark, str(d))
        raise AssertionError("expected a refusal")
    except RegistrationError as e:
        assert "b-1.0.0.json" in str(e)


def test_named_checks(spark):
    from sluice.functions.checks import check, install, passes, register_check, registered
    assert {"json_schema", "email", "version"} <= set(registered())
    df = spark.createDataFrame([('{"type":"string"}',), ("{invalid}",), (None,)], "s string")
    assert {r.s: r.ok for r in passes(df, "json_schema", "s", "ok").collect()} == {'{"type":"string"}': True, "{invalid}": False, None: False}
    register_check("short", "length(x) < 10", replace=True)
    assert [r.ok for r in passes(df, "short", "s", "ok").collect()] == [False, True, False]
    register_check("braces", lambda d, c, out: d.withColumn(out, F.col(c).startswith("{")), replace=True)
    assert [r.ok for r in passes(df, "braces", "s", "ok").collect()] == [True, True, False]
    with pytest.raises(ValueError):
        register_check("short", "true")
    with pytest.raises(ValueError):
        register_check("x; DROP", "true")
    assert "check_short" in install(spark)
    df.createOrReplaceTempView("named_checks_t")
    got = spark.sql("SELECT count_if(check_short(s)) AS a, count_if(check_json(s)) AS b, count_if(check_required(s)) AS c FROM named_checks_t")
    assert tuple(got.first()) == (1, 1, 2)
    plan = df.select(check("short", "s"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_sql_checks_agree_with_the_functions(spark):
    from sluice.functions.checks import install
    from sluice.functions.semver import parse_semver
    install(spark)
    texts = ["1", "1.2", "1.2.3", "01.0", "1023.1023.1023", "1024", "1.2.3.4", "", "1..2", "-1", "9" * 41, "0" * 41, "a", None]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    rows = df.select("s", F.expr("check_version(s)").alias("sql"), parse_semver("s").isNotNull().alias("fn")).collect()
    assert [r for r in rows if r["sql"] != r["fn"]] == []


def test_last_before_with_timestamp_order(spark):
    import datetime as dt
    base = dt.datetime(2024, 1, 1)
    rows = [("k", base + dt.timedelta(seconds=i), i) for i in range(50)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, v int")
    got = {r["v"]: r["prev"] for r in last_before(df, ["k"], "ts", "v", "prev", bucket_width=7_000_000).collect()}
    assert got[0] is None and all(got[i] == i - 1 for i in range(1, 50))
