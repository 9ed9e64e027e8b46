"""Keywords beyond SQL checks, admission, and agreement of all designs with a plain evaluator."""

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sluice.operators import nodes
from sluice.operators import validate as val
from tests import plain_json_schema as js
from tests.conftest import envelopes

BASE = "http://t/schemas"
OTHER = {"type": "object", "required": ["id"], "$defs": {"small": {"maximum": 5}}}
TREE = {"type": "object", "required": ["v"], "properties": {"v": {"type": "integer"}, "kids": {
    "type": "array", "items": {"$ref": "#"}}}}

# (schema, payload text, labels)
CASES = [
    ({"items": {"type": "object", "required": ["id"], "properties": {"id": {"minLength": 2}}}}, '[{"id":"x"},{}]',
     ["minLength:$[].id", "required:$[].id"]),
    ({"items": {"minLength": 2}}, '["ab","c"]', ["minLength:$[]"]),
    ({"items": {"items": {"type": "string"}}}, "[[1],[\"a\"]]", ["type:$[][]"]),
    ({"prefixItems": [{"type": "string"}], "items": False}, '["a",1]', ["items:$[]"]),
    ({"prefixItems": [{"type": "string"}, {"type": "number"}]}, "[1,2]", ["type:$[0]"]),
    ({"contains": {"const": 1}}, "[2,3]", ["contains:$"]),
    ({"contains": {"const": 1}, "minContains": 2, "maxContains": 2}, "[1,1]", []),
    ({"additionalProperties": {"type": "string"}, "properties": {"a": {}}}, '{"a":1,"b":2}', ["type:*"]),
    ({"patternProperties": {"^x-": {"type": "integer"}}, "additionalProperties": False}, '{"x-a":"s","y":1}',
     ["additionalProperties:$", "type:*"]),
    ({"propertyNames": {"maxLength": 2}}, '{"abc":1}', ["propertyNames:$"]),
    ({"dependentSchemas": {"a": {"required": ["b"]}}}, '{"a":1}', ["required:b"]),
    ({"$ref": "#/$defs/n", "$defs": {"n": {"type": "number"}}}, '"x"', ["type:$"]),
    (TREE, '{"v":1,"kids":[{"v":2,"kids":[{"v":"x"}]},{}]}', ["required:kids[].v", "type:kids[].kids[].v"]),
    ({"properties": {"o": {"$ref": f"{BASE}/other/1.0.0"}}}, '{"o":{}}', ["required:o.id"]),
    ({"items": {"$ref": f"{BASE}/other/1"}}, "[{}]", ["required:$[].id"]),
    ({"properties": {"n": {"$ref": f"{BASE}/other/1.0.0#/$defs/small"}}}, '{"n":6}', ["maximum:n"]),
    ({"const": {"b": 1, "a": 2}}, '{"a":2,"b":1.0}', []),
    ({"enum": [["\u00e9"]]}, '["\u00e9"]', []),
    ({"enum": [9007199254740993]}, "9007199254740992", ["enum:$"]),
    ({"multipleOf": 0.01}, "19.99", []),
    ({"multipleOf": 0.01}, "19.999", ["multipleOf:$"]),
    ({"uniqueItems": True}, "[1,1.0]", ["uniqueItems:$"]),
    ({"pattern": "(?:a|b){2}$"}, '"abc"', ["pattern:$"]),
    ({"anyOf": [{"$ref": "#/$defs/a"}, {"type": "null"}], "$defs": {"a": {"items": {"minimum": 3}}}}, "[1]", ["anyOf:$"]),
    (False, "1", ["false:$"]),
    (True, "1", []),
]


@pytest.mark.parametrize("doc,text,want", CASES)
def test_evaluator(doc, text, want):
    resolve = {f"{BASE}/other/1.0.0": OTHER, f"{BASE}/other/1": OTHER}.get
    assert js.well_formed(js.loads(json.dumps(doc)))
    assert sorted(js.Evaluator(js.loads(json.dumps(doc)), resolve).errors(js.loads(text))) == want


@pytest.mark.parametrize("design", ["compiled", "rules"])
def test_designs_give_the_evaluators_labels(spark, design):
    docs = [(f"{BASE}/c{i}/1.0.0", json.dumps(d)) for i, (d, _, _) in enumerate(CASES)]
    docs += [(f"{BASE}/other/1.0.0", json.dumps(OTHER))]
    reg = spark.createDataFrame(docs, "schemaURI string, schema string")
    rows = [(str(i), f"{BASE}/c{i}/1", t) for i, (_, t, _) in enumerate(CASES)]
    got = {r["k"]: sorted(r["errors"]) for r in val.validate(envelopes(spark, rows), reg, design=design).collect()}
    assert got == {str(i): w for i, (_, _, w) in enumerate(CASES)}


@pytest.mark.parametrize("design", ["compiled", "rules"])
def test_a_bad_document_leaves_the_others_alone(spark, design):
    docs = [(f"{BASE}/good/1.0.0", '{"type":"object"}'), (f"{BASE}/kind/1.0.0", '{"properties":{"a":{"type":"objekt"}}}'),
            (f"{BASE}/pattern/1.0.0", '{"pattern":"["}'), (f"{BASE}/text/1.0.0", '{"type":'),
            (f"{BASE}/ref/1.0.0", f'{{"items":{{"$ref":"{BASE}/gone/1.0.0"}}}}'),
            (f"{BASE}/to-bad/1.0.0", f'{{"$ref":"{BASE}/text/1.0.0"}}')]
    reg = spark.createDataFrame(docs, "schemaURI string, schema string")
    rows = [(u.split("/")[-2], u, "{}") for u, _ in docs]
    got = {r["k"]: r["reason"] for r in val.validate(envelopes(spark, rows), reg, design=design).collect()}
    assert got == {"good": "ok", "kind": "invalid_schema", "pattern": "invalid_schema", "text": "invalid_schema",
                   "ref": "unresolved_ref", "to-bad": "unresolved_ref"}


def test_long_reference_chain_and_cycle(spark):
    docs = [(f"{BASE}/r{i}/1.0.0", json.dumps({"$ref": f"{BASE}/r{i + 1}/1.0.0"})) for i in range(12)]
    docs += [(f"{BASE}/r12/1.0.0", '{"type":"string"}'), (f"{BASE}/loop/1.0.0", f'{{"$ref":"{BASE}/loop/1.0.0"}}')]
    reg = spark.createDataFrame(docs, "schemaURI string, schema string")
    rows = [("deep", f"{BASE}/r0/1.0.0", "1"), ("loop", f"{BASE}/loop/1.0.0", "1")]
    for design in ("compiled", "rules"):
        got = {r["k"]: (r["reason"], r["errors"]) for r in val.validate(envelopes(spark, rows), reg, design=design).collect()}
        assert got == {"deep": ("schema_violation", ["type:$"]), "loop": ("ok", [])}


ADMISSION = [
    ({"type": "objekt"}, False), ({"properties": {"a": {"type": "objekt"}}}, False), ({"pattern": "["}, False),
    ({"items": {"required": [1]}}, False), ({"enum": 3}, False), ({"minLength": 1.5}, False), ({"multipleOf": 0}, False),
    ({"anyOf": [3]}, False), ({"$ref": 1}, False), ({"unevaluatedProperties": False}, False), ([], False), (3, False),
    ({"x-unknown": {"type": "objekt"}}, True), ({"dependentRequired": {"a": ["b"]}}, True), (False, True)]


@pytest.mark.parametrize("doc,ok", ADMISSION)
def test_plain_admission(doc, ok):
    assert js.admissible_text(json.dumps(doc)) is ok


def test_admission_walks_the_document(spark):
    deep = "true"
    for _ in range(60):
        deep = '{"items":' + deep + "}"
    texts = [(json.dumps(d), ok) for d, ok in ADMISSION] + [(json.dumps(d), True) for d, _, _ in CASES]
    texts += [(deep, True), (deep.replace("true", "3"), False), ("", False), (None, False), (texts[0][0], texts[0][1])]
    df = spark.createDataFrame(texts, "s string, want boolean")
    out = nodes.with_admission(df, "s", "ok")
    assert [r for r in out.collect() if r.ok != r.want] == [] and out.count() == len(texts)


@pytest.mark.parametrize("pattern,ok", [
    ("^[a-z]+$", True), ("[", False), ("a{2}", True), ("a{5,2}", False), ("(?:a|b){2}$", True), ("(a(b(c)?)+)*", True), ("(a", False),
    ("a)", False), ("[z-a]", False), ("[a-z0-9_.-]", True), (r"\d+\.\d*", True), ("*a", False), ("a**", False), ("(?<=a)b", False),
    (r"\q", False), ("", True), (r"^(\([^)]*\))+$", True), ("a|b|", True), ("[]", False), ("x{,3}", False), ("\\", False)])
def test_pattern_syntax(spark, pattern, ok):
    df = spark.createDataFrame([(pattern, "sample")], "p string, s string")
    assert df.select(F.expr(nodes.pattern_ok("p")).alias("ok")).first().ok is ok
    if ok:
        df.select(F.expr("s RLIKE p")).collect()  # Java accepts it too


def test_exact_numbers():
    assert js.same(Decimal("1.50"), Decimal("1.5")) and not js.same(True, 1) and js.same([{"a": 1}], [{"a": Decimal(1)}])
    assert js.is_type(Decimal("3.0"), "integer") and not js.is_type(Decimal("3.1"), "integer")


def labels(spark, docs, payloads, design):
    """Labels of every payload under every schema: {(schema, payload): labels}."""
    reg = spark.createDataFrame([(f"{BASE}/d{i}/1.0.0", json.dumps(d)) for i, d in enumerate(docs)], "schemaURI string, schema string")
    rows = [(f"{i} {j}", f"{BASE}/d{i}/1", t) for i in range(len(docs)) for j, t in enumerate(payloads)]
    return {r.k: r.errors for r in val.validate(envelopes(spark, rows), reg, design=design).collect()}


BRANCHES = [
    {"anyOf": [{"type": "string"}, {"allOf": [{"type": "array"}, {"not": {"contains": {"type": "null"}}}]}]},
    {"oneOf": [{"minimum": 3}, {"type": "integer"}, {"$ref": "#/oneOf/1"}]},
    {"if": {"properties": {"a": {"const": 1}}, "required": ["a"]}, "then": {"required": ["b"]},
     "else": {"propertyNames": {"not": {"pattern": "^z"}}}},
    {"not": {"anyOf": [{"type": "null"}, {"items": {"oneOf": [{"type": "integer"}, {"minimum": 2}]}}]}},
    {"contains": {"anyOf": [{"const": 1}, {"required": ["a"]}]}, "minContains": 2, "maxContains": 3},
    {"$defs": {"t": {"anyOf": [{"type": "integer"}, {"type": "array", "items": {"$ref": "#/$defs/t"}}]}}, "$ref": "#/$defs/t"},
    {"anyOf": [{"$ref": "#"}, {"type": "object"}]},
    {"x-part": {"y": {"maxItems": 1}}, "$ref": "#/x-part/y"},
    {"dependentSchemas": {"a": {"dependentSchemas": {"b": {"maxProperties": 2}}}}, "patternProperties": {"^a": {"type": "integer"}, "b$": {"minimum": 2}},
     "additionalProperties": {"enum": [[1, {"c": None}], "x"]}},
    {"uniqueItems": True, "prefixItems": [{"type": "integer"}], "items": {"uniqueItems": True}},
]
PAYLOADS = ["1", "4", "2.5", '"s"', "null", "[]", "[1,null]", "[1,1.0]", "[[1],[1]]", "[[1,[2,[3]]],5]", "[[1,[\"x\"]]]", "{}", '{"a":1}',
            '{"a":1,"b":2}', '{"a":"q","ab":1,"c":[1.0,{"c":null}]}', '{"z1":1}', '[{"a":1},1,1]', '[{"a":1},1,1,{"a":2}]', "[3,[2,2]]",
            "[1e1,10]", '{"a":1,"b":2,"c":"x"}', "true", '"z"', "[2,2.5]"]


@pytest.mark.parametrize("design", ["compiled", "rules"])
def test_scopes_match_the_plain_evaluator(spark, design):
    got = labels(spark, BRANCHES, PAYLOADS, design)
    want = {f"{i} {j}": sorted(js.Evaluator(js.loads(json.dumps(d))).errors(js.loads(t)))
            for i, d in enumerate(BRANCHES) for j, t in enumerate(PAYLOADS)}
    assert {k: v for k, v in got.items() if v != want[k]} == {} and len(got) == len(want)


def test_no_python_and_no_join_for_other_messages(spark):
    docs = [(f"{BASE}/plain/1.0.0", '{"type":"object"}'), (f"{BASE}/tree/1.0.0", json.dumps(TREE))]
    reg = spark.createDataFrame(docs, "schemaURI string, schema string")
    rows = envelopes(spark, [("a", f"{BASE}/plain/1", "{}"), ("b", f"{BASE}/tree/1", '{"v":1,"kids":[{}]}')])
    for design in ("compiled", "rules"):
        out = val.validate(rows, reg, design=design)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan
        assert {r.k: r.errors for r in out.collect()} == {"a": [], "b": ["required:kids[].v"]}


def test_repeated_and_null_payloads(spark):
    reg = spark.createDataFrame([(f"{BASE}/tree/1.0.0", json.dumps(TREE))], "schemaURI string, schema string")
    texts = ['{"v":"x"}'] * 5 + [None, "", "{", '{"v":1}', '{"v":1,"kids":[' + ",".join(['{"v":0}'] * 2000) + "]}"]
    out = val.validate(envelopes(spark, [(str(i), f"{BASE}/tree/1", t) for i, t in enumerate(texts)]), reg).collect()
    got = {int(r.k): (r.reason, r.errors) for r in out}
    assert len(out) == len(texts) and all(got[i] == ("schema_violation", ["type:v"]) for i in range(5))
    assert [got[i][0] for i in (5, 6, 7)] == ["invalid_json"] * 3 and got[8] == got[9] == ("ok", [])


def test_deep_payload_and_deep_document(spark):
    """Depth alone makes neither a document nor a payload invalid."""
    text = '{"v":1}'
    for _ in range(20):
        text = '{"v":1,"kids":[' + text + "]}"
    deep = {"type": "integer"}
    for _ in range(45):
        deep = {"properties": {"a": deep}}
    payload = "1.5"
    for _ in range(45):
        payload = '{"a":' + payload + "}"
    docs = [(f"{BASE}/tree/1.0.0", json.dumps(TREE)), (f"{BASE}/deep/1.0.0", json.dumps(deep))]
    reg = spark.createDataFrame(docs, "schemaURI string, schema string")
    rows = [("t", f"{BASE}/tree/1", text.replace('{"v":1}]', '{"v":"x"}]')), ("d", f"{BASE}/deep/1", payload)]
    got = {r.k: r.errors for r in val.validate(envelopes(spark, rows), reg).collect()}
    assert got == {"t": ["type:" + "kids[]." * 20 + "v"], "d": ["type:" + ".".join("a" * 45)]}


def test_reference_chain_of_200_to_nothing(spark):
    docs = [(f"{BASE}/r{i}/1.0.0", json.dumps({"$ref": f"{BASE}/r{i + 1}/1.0.0"})) for i in range(200)]
    docs += [(f"{BASE}/loop{i}/1.0.0", json.dumps({"items": {"$ref": f"{BASE}/loop{(i + 1) % 3}/1.0.0"}})) for i in range(3)]
    _, flags, folder = val.walked_documents(spark.createDataFrame(docs, "schemaURI string, schema string"))
    table = nodes.schema_table(folder, flags)
    assert {r.uri for r in table.unresolved.collect()} == {f"{BASE}/r{i}/1.0.0" for i in range(200)}


def test_more_nodes_than_the_default_bound_of_recursive_queries(spark):
    """A million pairs and more, in one payload table."""
    reg = spark.createDataFrame([(f"{BASE}/tree/1.0.0", json.dumps(TREE))], "schemaURI string, schema string")
    text = '{"v":1,"kids":[' + ",".join(['{"v":0}'] * 400 + ['{"v":"x"}']) + "]}"
    rows = spark.range(700).select(F.col("id").cast("string").alias("k"), F.lit("t").alias("origin"), F.lit(f"{BASE}/tree/1").alias("schemaURI"),
                                   F.current_timestamp().alias("timestamp"), F.concat(F.lit(text[:-1] + ',"n":'), F.col("id"), F.lit("}")).alias("data"))
    out = val.validate(rows, reg)
    assert out.where("errors = array('type:kids[].v')").count() == 700


def test_payloads_are_validated_inside_their_rows(spark, monkeypatch):
    """Documents that end by themselves need no table of pairs; nested judgements fold as in ``violations``."""
    docs = {"a": {"properties": {"x": {"anyOf": [{"type": "string"}, {"not": {"oneOf": [{"minimum": 5}, {"multipleOf": 2}]}}]},
                                 "l": {"contains": {"required": ["q"]}, "maxContains": 1, "items": {"if": {"required": ["q"]}, "then": {"maxProperties": 1}, "else": {"minProperties": 1}}}},
                  "propertyNames": {"maxLength": 2}},
            "b": {"$defs": {"n": {"enum": [1, "1", None]}}, "items": {"$ref": "#/$defs/n"}, "minItems": 1, "contains": False}}
    reg = spark.createDataFrame([(f"{BASE}/{k}/1.0.0", json.dumps(d)) for k, d in docs.items()], "schemaURI string, schema string")
    texts = {"a": ['{"x":6}', '{"x":7}', '{"x":4}', '{"x":"s","long":1}', '{"l":[]}', '{"l":[{"q":1,"r":2},{}]}', '{"l":[{"q":1},{"q":2}]}', "null", "{", '{"l":[{"q":1},{"r":1}]}'],
             "b": ["[1, 1.0, null]", "[]", "[2]", '"x"']}
    rows = [(f"{k}{i}", f"{BASE}/{k}/1", t) for k, ts in texts.items() for i, t in enumerate(ts)]
    msgs = envelopes(spark, rows)

    def outcome():
        val._MEMO.clear()
        return {r.k: (r.status, r.errors) for d in ("compiled", "rules") for r in val.validate(msgs, reg, design=d).collect()}

    monkeypatch.setattr(nodes, "WHOLE_NODES", 0)  # all as rows
    want = outcome()
    monkeypatch.undo()
    monkeypatch.setattr(val, "violations", None)  # none as rows
    assert outcome() == want and {s for s, _ in want.values()} == {"valid", "invalid", "error"}


def test_deep_documents_are_judged_whole(spark):
    def nested(n, inner):
        return inner if n == 0 else '{"items":' + nested(n - 1, inner) + "}"

    rows = [(i, nested(n, t), ok) for i, (n, t, ok) in enumerate(
        (n, t, ok) for n in (0, 3, 23, 24, 25, 60) for t, ok in (('{"type":"string"}', True), ('{"type":"x"}', False)))]
    df = spark.createDataFrame([*rows, (99, None, False), (98, "{", False)], "i int, s string, want boolean")
    assert nodes.with_admission(df, "s", "ok").where("ok IS NULL OR ok != want").isEmpty()
    assert nodes.with_admission(df.where("i < 4"), "s", "ok").where("ok IS NULL OR ok != want").isEmpty()
