"""Random payloads: both validation designs against a plain-Python check of
the same keywords (type, enum, required, properties, items.type)."""

import json

from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.operators import validate as val
from tests.conftest import envelopes

ORDER = "http://schema-repository:8080/schemas/order/2.0.0"
DOC = json.load(open(__file__.rsplit("/tests/", 1)[0] + "/sluice/schemas/order-2.0.0.json"))


def is_type(v, name):
    if name == "string":
        return isinstance(v, str)
    if name == "boolean":
        return isinstance(v, bool)
    if name == "null":
        return v is None
    if name == "array":
        return isinstance(v, list)
    if name == "object":
        return isinstance(v, dict)
    if isinstance(v, bool):
        return False
    if name == "number":
        return isinstance(v, (int, float))
    if name == "integer":
        return isinstance(v, int) or (isinstance(v, float) and v.is_integer())
    raise ValueError(name)


def brute(doc, value) -> list[str]:
    errs = []
    if not is_type(value, doc["type"]):
        return ["type:$"]
    for name, sub in doc["properties"].items():
        if name not in value:
            continue
        x = value[name]
        if "type" in sub and not is_type(x, sub["type"]):
            errs.append(f"type:{name}")
        if "enum" in sub and not (isinstance(x, str) and x in sub["enum"]):
            errs.append(f"enum:{name}")
        if "items" in sub and isinstance(x, list):
            if not all(is_type(e, sub["items"]["type"]) for e in x):
                errs.append(f"type:{name}[]")
    errs += [f"required:{n}" for n in doc["required"] if n not in value]
    return sorted(errs)


SCALARS = st.one_of(
    st.integers(-10**6, 10**6), st.integers(10**19, 10**20),
    st.floats(allow_nan=False, allow_infinity=False, width=32).map(lambda f: round(f, 3)),
    st.sampled_from([1.0, 2.5, 1e3, -0.0]),
    st.text(alphabet="abcdelnpstvy", max_size=9),
    st.sampled_from(["pending", "shipped", "delivered", "cancelled", "Pending"]),
    st.booleans(), st.none())
VALUES = st.one_of(SCALARS, st.lists(SCALARS, max_size=3), st.dictionaries(st.sampled_from("ab"), SCALARS, max_size=2))
PAYLOADS = st.one_of(
    st.fixed_dictionaries({}, optional={k: VALUES for k in ["orderId", "userId", "productIds", "total", "status", "x"]}),
    st.lists(SCALARS, max_size=2))


@settings(max_examples=6, deadline=None)
@given(st.lists(PAYLOADS, min_size=20, max_size=40))
def test_designs_match_brute_force(spark, registry, docs):
    rows = [(str(i), ORDER, json.dumps(d)) for i, d in enumerate(docs)]
    want = {str(i): brute(DOC, d) for i, d in enumerate(docs)}
    for design in ("compiled", "rules"):
        out = val.validate(envelopes(spark, rows), registry, design=design)
        got = {r["k"]: sorted(r["errors"] or []) for r in out.collect()}
        for k in want:
            assert got[k] == want[k], (design, rows[int(k)][2])
