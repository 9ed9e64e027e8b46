"""JSON Schema keywords that no fixed SQL expression covers, evaluated per payload.

Schemas with recursive references, nested element schemas and the like are
checked by ``Evaluator`` inside an Arrow-batched UDF; every other schema keeps
its SQL checks (see ``sluice.operators.compile``).  Both give the same labels,
``keyword:path`` with ``[]`` for array elements and ``*`` for properties the
schema does not name.  ``well_formed`` walks a schema document for admission.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from decimal import Decimal

# The seven JSON Schema type names.
TYPE_NAMES = ("string", "integer", "number", "boolean", "null", "array", "object")
EMAIL_SHAPE = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"

#: Patterns that mean the same, and are valid, for Java and Python.
_ATOM = (r"(?:[A-Za-z0-9 _@,:;/#%&=<>~!'\"-]|\\[dws.+*?()|/\\^$\[\]{}-]|\."
         r"|\[\^?(?:a-z|A-Z|0-9|[A-Za-z0-9_ .,:;@#%&=/+*]|\\[dws.-])+-?\])")
PORTABLE_PATTERN = rf"^\^?(?:{_ATOM}(?:[*+?]|\{{[0-9]{{1,3}}(?:,[0-9]{{1,3}})?\}})?)*\$?$"

_SUBSCHEMA = ("additionalProperties", "contains", "else", "if", "items", "not", "propertyNames", "then")
_SUBSCHEMA_LISTS = ("allOf", "anyOf", "oneOf", "prefixItems")
_SUBSCHEMA_MAPS = ("$defs", "definitions", "dependentSchemas", "patternProperties", "properties")
#: Keywords that change validity and are not evaluated anywhere; documents with them are refused.
REFUSED = ("$dynamicRef", "$recursiveRef", "unevaluatedItems", "unevaluatedProperties")


def is_number(x) -> bool:
    return isinstance(x, (int, Decimal)) and not isinstance(x, bool)


def loads(text: str):
    return json.loads(text, parse_float=Decimal)


def same(a, b) -> bool:
    """JSON equality: numbers by value, objects without order, no bool as a number."""
    if is_number(a) and is_number(b):
        return a == b
    if type(a) is not type(b):
        return False
    if isinstance(a, list):
        return len(a) == len(b) and all(map(same, a, b))
    if isinstance(a, dict):
        return a.keys() == b.keys() and all(same(v, b[k]) for k, v in a.items())
    return a == b


def is_type(x, name: str) -> bool:
    if name == "integer":
        return is_number(x) and x == x // 1
    return {"string": isinstance(x, str), "number": is_number(x), "boolean": isinstance(x, bool), "null": x is None,
            "array": isinstance(x, list), "object": isinstance(x, dict)}[name]


def subschemas(node: dict) -> Iterator[object]:
    for k in _SUBSCHEMA:
        if k in node:
            yield node[k]
    for k in _SUBSCHEMA_LISTS:
        yield from node[k] if isinstance(node.get(k), list) else ()
    for k in _SUBSCHEMA_MAPS:
        yield from node[k].values() if isinstance(node.get(k), dict) else ()


def references(node) -> Iterator[str]:
    """Every ``$ref`` of a schema document, at any depth."""
    if isinstance(node, dict):
        if isinstance(node.get("$ref"), str):
            yield node["$ref"]
        for sub in subschemas(node):
            yield from references(sub)


def well_formed(doc) -> bool:
    """Does a parsed document compile as a JSON Schema, at every depth."""
    if isinstance(doc, bool):
        return True
    if not isinstance(doc, dict) or any(k in doc for k in REFUSED):
        return False
    strings = lambda v: isinstance(v, list) and all(isinstance(s, str) for s in v)
    kinds = doc.get("type", "object")
    if not (isinstance(kinds, str) or strings(kinds) and kinds) or not {*([kinds] if isinstance(kinds, str) else kinds)} <= {*TYPE_NAMES}:
        return False
    whole = lambda v: is_number(v) and v >= 0 and v == v // 1
    tests: dict[str, Callable[[object], bool]] = {
        "required": strings, "enum": lambda v: isinstance(v, list), "$ref": lambda v: isinstance(v, str),
        "uniqueItems": lambda v: isinstance(v, bool), "multipleOf": lambda v: is_number(v) and v > 0,
        "pattern": _compiles, "dependentRequired": lambda v: isinstance(v, dict) and all(map(strings, v.values())),
        **{k: is_number for k in ("minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum")},
        **{k: whole for k in ("minLength", "maxLength", "minItems", "maxItems", "minProperties", "maxProperties",
                              "minContains", "maxContains")},
        **{k: lambda v: isinstance(v, (dict, bool)) for k in _SUBSCHEMA},
        **{k: lambda v: isinstance(v, list) for k in _SUBSCHEMA_LISTS},
        **{k: lambda v: isinstance(v, dict) for k in _SUBSCHEMA_MAPS}}
    if not all(ok(doc[k]) for k, ok in tests.items() if k in doc):
        return False
    if not all(map(_compiles, doc.get("patternProperties", {}))):
        return False
    return all(map(well_formed, subschemas(doc)))


def admissible_text(text: str | None) -> bool:
    try:
        return text is not None and well_formed(loads(text))
    except (ValueError, RecursionError):
        return False


def _compiles(pattern) -> bool:
    try:
        return isinstance(pattern, str) and bool(re.compile(pattern, re.ASCII) or True)
    except (re.error, OverflowError, RecursionError):
        return False


def pointer(doc, fragment: str):
    """The part of ``doc`` a JSON pointer fragment names; KeyError if none."""
    for part in fragment.split("/")[1:]:
        key = part.replace("%25", "%").replace("~1", "/").replace("~0", "~")
        doc = doc[int(key)] if isinstance(doc, list) else doc[key]
    return doc


class Evaluator:
    """Violated labels of a payload under one schema document.

    ``resolve(uri)`` serves references to other documents; a reference that it
    does not know, or a fragment that names nothing, is ``unresolved``.
    """

    def __init__(self, doc, resolve: Callable[[str], object | None] = lambda uri: None, assert_email: bool = False):
        self.doc, self.resolve, self.assert_email = doc, resolve, assert_email
        self.unresolved = not self._reachable(doc, doc, set())

    def _target(self, ref: str, root):
        """(schema, its root document) of a reference."""
        uri, _, fragment = ref.partition("#")
        if uri:
            root = self.resolve(uri)
            if root is None:
                raise KeyError(uri)
        if fragment and not fragment.startswith("/"):
            raise KeyError(ref)
        return pointer(root, fragment), root

    def _reachable(self, node, root, seen: set[int]) -> bool:
        if not isinstance(node, dict) or id(node) in seen:
            return True
        seen.add(id(node))
        if isinstance(node.get("$ref"), str):
            try:
                target, at = self._target(node["$ref"], root)
            except (KeyError, IndexError, ValueError, TypeError):
                return False
            if not self._reachable(target, at, seen):
                return False
        return all(self._reachable(s, root, seen) for k in node if k not in ("$defs", "definitions")
                   for s in subschemas({k: node[k]}))

    def errors(self, value) -> list[str]:
        out: dict[str, None] = {}
        self._check(self.doc, self.doc, value, "", out, frozenset())
        return list(out)

    def _valid(self, node, root, x, path: str, active) -> bool:
        out: dict[str, None] = {}
        self._check(node, root, x, path, out, active)
        return not out

    def _check(self, node, root, x, path: str, out: dict[str, None], active) -> None:
        label = path or "$"

        def need(keyword: str, ok: bool, at: str = "") -> None:
            if not ok:
                out[f"{keyword}:{at or label}"] = None

        if node is False:
            need("false", False)
        if not isinstance(node, dict) or (id(node), id(x)) in active:
            return  # a reference that leads back to itself at one value adds nothing
        active |= {(id(node), id(x))}
        inside = lambda key: f"{path}.{key}" if path else key

        if isinstance(node.get("$ref"), str):
            target, at = self._target(node["$ref"], root)
            self._check(target, at, x, path, out, active)
        if "type" in node:
            need("type", any(is_type(x, t) for t in ([node["type"]] if isinstance(node["type"], str) else node["type"])))
        if isinstance(node.get("enum"), list):
            need("enum", any(same(x, v) for v in node["enum"]))
        if "const" in node:
            need("const", same(x, node["const"]))
        if is_number(x):
            for k, ok in (("minimum", lambda b: x >= b), ("maximum", lambda b: x <= b),
                          ("exclusiveMinimum", lambda b: x > b), ("exclusiveMaximum", lambda b: x < b),
                          ("multipleOf", lambda b: _multiple(x, b))):
                if is_number(node.get(k)):
                    need(k, ok(node[k]))
        if isinstance(x, str):
            self._sizes(node, ("minLength", "maxLength"), len(x), need)
            if isinstance(node.get("pattern"), str):
                need("pattern", re.search(node["pattern"], x, re.ASCII) is not None)
            if self.assert_email and node.get("format") == "email":
                need("format", re.search(EMAIL_SHAPE, x) is not None)
        if isinstance(x, list):
            self._array(node, root, x, path, out, active, need)
        if isinstance(x, dict):
            self._object(node, root, x, path, out, active, need, inside)

        for sub in node.get("allOf") or ():
            self._check(sub, root, x, path, out, active)
        for k, ok in (("anyOf", lambda n: n > 0), ("oneOf", lambda n: n == 1)):
            if node.get(k):
                need(k, ok(sum(self._valid(s, root, x, path, active) for s in node[k])))
        if "not" in node:
            need("not", not self._valid(node["not"], root, x, path, active))
        if "if" in node and ("then" in node or "else" in node):
            side = "then" if self._valid(node["if"], root, x, path, active) else "else"
            need("if", self._valid(node.get(side, True), root, x, path, active))

    @staticmethod
    def _sizes(node, keywords: tuple[str, str], n: int, need) -> None:
        for k, ok in zip(keywords, (lambda b: n >= b, lambda b: n <= b)):
            if is_number(node.get(k)):
                need(k, ok(node[k]))

    def _array(self, node, root, x, path, out, active, need) -> None:
        each = (path or "$") + "[]"
        self._sizes(node, ("minItems", "maxItems"), len(x), need)
        if node.get("uniqueItems") is True:
            need("uniqueItems", not any(same(a, b) for i, a in enumerate(x) for b in x[:i]))
        prefix = node.get("prefixItems") or []
        for i, (sub, v) in enumerate(zip(prefix, x)):
            self._check(sub, root, v, f"{path or '$'}[{i}]", out, active)
        if node.get("items") is False:
            need("items", len(x) <= len(prefix), each)
        elif "items" in node:
            for v in x[len(prefix):]:
                self._check(node["items"], root, v, each, out, active)
        if "contains" in node:
            n = sum(self._valid(node["contains"], root, v, each, active) for v in x)
            need("contains", node.get("minContains", 1) <= n <= node.get("maxContains", len(x)))

    def _object(self, node, root, x, path, out, active, need, inside) -> None:
        self._sizes(node, ("minProperties", "maxProperties"), len(x), need)
        for name in node.get("required") or ():
            need("required", name in x, inside(name))
        for trigger, names in (node.get("dependentRequired") or {}).items():
            for name in names if trigger in x else ():
                need("dependentRequired", name in x, inside(name))
        for trigger, sub in (node.get("dependentSchemas") or {}).items():
            if trigger in x:
                self._check(sub, root, x, path, out, active)
        props = node.get("properties") if isinstance(node.get("properties"), dict) else {}
        patterns = node.get("patternProperties") or {}
        rest = node.get("additionalProperties", True)
        for name, v in x.items():
            if "propertyNames" in node:
                need("propertyNames", self._valid(node["propertyNames"], root, name, path, active))
            if name in props:
                self._check(props[name], root, v, inside(name), out, active)
            fit = [sub for p, sub in patterns.items() if re.search(p, name, re.ASCII)]
            for sub in fit:
                self._check(sub, root, v, inside("*"), out, active)
            if name not in props and not fit:
                if rest is False:
                    need("additionalProperties", False)
                else:
                    self._check(rest, root, v, inside("*"), out, active)


def _multiple(x, b) -> bool:
    x, b = Decimal(x), Decimal(b)
    if abs(x.adjusted() - b.adjusted()) < 27:
        return x % b == 0
    from fractions import Fraction
    return (Fraction(x) / Fraction(b)).denominator == 1


def expressible(doc) -> bool:
    """Whether the SQL checks cover ``doc`` exactly (references are judged by
    the caller, which knows what they lead to)."""
    if not isinstance(doc, dict):
        return True
    plain = lambda v: (isinstance(v, (str, bool)) or v is None or
                       is_number(v) and abs(v) <= 1 << 53)
    if any(k in doc for k in ("contains", "prefixItems", "patternProperties", "propertyNames", "dependentSchemas",
                              "$defs", "definitions")) or doc.get("uniqueItems") is True:
        return False
    if not all(map(plain, [*(doc.get("enum") or ()), doc.get("const")])):
        return False
    if "multipleOf" in doc and not (isinstance(doc["multipleOf"], int) and abs(doc["multipleOf"]) < 1 << 31):
        return False
    if any(is_number(doc.get(k)) and abs(doc[k]) > 1 << 53 for k in (
            "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum")):
        return False
    if "pattern" in doc and not re.fullmatch(PORTABLE_PATTERN, doc["pattern"]):
        return False
    if isinstance(doc.get("additionalProperties"), dict) and doc["additionalProperties"]:
        return False
    if isinstance(doc.get("items"), dict):
        known = {"type", "enum", "title", "description", "$comment", "minimum", "maximum", "exclusiveMinimum",
                 "exclusiveMaximum"}
        if not {*doc["items"]} <= known or not expressible(doc["items"]):
            return False
    return all(map(expressible, subschemas(doc)))
