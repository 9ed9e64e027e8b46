"""JSON Schema document -> Catalyst checks and Spark types (VAL-*, PRJ-12).

A schema document is compiled once, on the driver, into Spark SQL expression
text over the parsed payload (a VARIANT column) and the raw payload text.
The validation then runs entirely in the JVM; no payload row reaches Python.
The checks are emitted as SQL text and parsed once (``F.expr``), rather than
assembled from thousands of ``Column`` objects, so building the plan costs a
parse, not thousands of driver round trips — this matters per micro-batch.

Keywords as SQL checks (draft 2020-12): ``type`` (single or list),
``properties``, ``required``, ``items`` (any of these keywords per element,
nested), ``enum``, ``const``, ``minimum``/``maximum`` and their exclusive
forms, ``multipleOf``, ``minLength``/``maxLength``, ``pattern``,
``minItems``/``maxItems``, ``uniqueItems``, ``minProperties``/
``maxProperties``, ``additionalProperties: false``, ``dependentRequired``,
``allOf``/``anyOf``/``oneOf``/``not``, ``if``/``then``/``else``, ``$ref``
(resolved through the registry at compile time), boolean schemas and, opt-in,
``format: email``.  Schemas with anything further (``contains``, ``prefixItems``, ``patternProperties``, ``propertyNames``,
``dependentSchemas``, local and recursive references, ``enum``/``const`` of arrays
and objects, exact decimals) are validated as rows, see ``nodes``.  Annotations
(``title``, ``description``, ``$schema``, ``$id``, ``format`` when not asserted) and
unknown keywords are ignored, as the draft prescribes for unknown keywords.

Each check is a pair ``(label, ok_sql)``; ``label`` is ``keyword:path`` with
the dotted property path (``$`` for the root, ``[]`` for array elements).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .nodes import EMAIL_SHAPE, SUBSCHEMA, SUBSCHEMA_LISTS, SUBSCHEMA_MAPS

# A JSON text whose first non-blank character is '{' and that parses is an object.
OBJECT_TEXT = r"^[ \t\n\r]*\{"

# Column names the checks refer to: the parsed payload and its text.
V = "__v"
D = "data"


def sql_str(s: str) -> str:
    """A Spark SQL string literal for ``s``."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def variant_path(parts: list[str]) -> str:
    """['a', 'b'] -> $["a"]["b"] (bracket form: keys may hold dots)."""
    out = "$"
    for p in parts:
        if '"' in p:
            out += "['" + p.replace("'", "\\'") + "']"
        else:
            out += '["' + p + '"]'
    return out


def label_path(parts: list[str], prefix: str = "") -> str:
    return ".".join([prefix, *parts] if prefix else parts) or "$"


# -- type tests (SQL text) ---------------------------------------------------

def get(x: str, typ: str) -> str:
    return f"try_variant_get({x}, '$', '{typ}')"


def vtype_sql(x: str) -> str:
    """Variant type name: BIGINT, DECIMAL(p,s), DOUBLE, STRING, BOOLEAN, VOID,
    ARRAY<..>, OBJECT<..>; NULL when ``x`` is absent."""
    return f"schema_of_variant({x})"


def type_sql(t: str, x: str, name: str) -> str:
    """Does variant ``x`` with type text ``t`` match JSON type ``name``."""
    if name == "string":
        return f"({t} = 'STRING')"
    if name == "boolean":
        return f"({t} = 'BOOLEAN')"
    if name == "null":
        return f"({t} = 'VOID')"
    if name == "array":
        return f"({t} LIKE 'ARRAY%')"
    if name == "object":
        return f"({t} LIKE 'OBJECT%')"
    if name == "number":
        return f"({t} IN ('BIGINT', 'DOUBLE', 'FLOAT') OR {t} LIKE 'DECIMAL%')"
    if name == "integer":
        # integral double: ``% 1.0`` is exact for every finite double, whereas
        # floor() returns a BIGINT that saturates above 2^63
        d = get(x, "double")
        return (f"({t} = 'BIGINT' OR {t} RLIKE '^DECIMAL\\\\([0-9]+,0\\\\)$' OR ({t} = 'DOUBLE' "
                f"AND NOT isnan({d}) AND abs({d}) != double('infinity') AND {d} % 1.0 = 0.0))")
    raise ValueError(f"unknown JSON type {name!r}")


def types_sql(t: str, x: str, names: list[str]) -> str:
    return "(" + " OR ".join(type_sql(t, x, n) for n in names) + ")"


def vtype(x: Column) -> Column:
    return F.schema_of_variant(x)


def type_matches_col(x: str, name: str) -> Column:
    """Column testing the variant column named ``x`` against JSON type ``name``."""
    return F.expr(type_sql(vtype_sql(x), x, name))


def _literal_sql(t: str, x: str, value) -> str:
    """Does variant ``x`` equal the JSON literal ``value`` (type-aware)."""
    if value is None:
        return f"({t} = 'VOID')"
    if isinstance(value, bool):
        return f"({t} = 'BOOLEAN' AND {get(x, 'boolean')} = {str(value).lower()})"
    if isinstance(value, (int, float)):
        return f"({type_sql(t, x, 'number')} AND {get(x, 'double')} = double({float(value)!r}))"
    if isinstance(value, str):
        return f"({t} = 'STRING' AND {get(x, 'string')} = {sql_str(value)})"
    raise ValueError("arrays and objects are compared as rows")


def _enum_sql(t: str, x: str, values: list) -> str:
    strings = [v for v in values if isinstance(v, str)]
    others = [v for v in values if not isinstance(v, str)]
    conds = []
    if strings:
        conds.append(f"({t} = 'STRING' AND {get(x, 'string')} IN ({', '.join(sql_str(v) for v in strings)}))")
    conds.extend(_literal_sql(t, x, v) for v in others)
    return "(" + " OR ".join(conds) + ")" if conds else "false"


def _cmp(a: str, bound: float, op: str) -> str:
    sym = {"ge": ">=", "le": "<=", "gt": ">", "lt": "<"}[op]
    return f"({a} {sym} double({bound!r}))"


BOUNDS = (("minimum", "ge"), ("maximum", "le"), ("exclusiveMinimum", "gt"), ("exclusiveMaximum", "lt"))


def _num(node: dict, k: str):
    x = node.get(k)
    return float(x) if isinstance(x, (int, float)) and not isinstance(x, bool) else None


@dataclass
class CompiledSchema:
    """Checks of one schema document."""

    uri: str
    checks: list[tuple[str, str]] = field(default_factory=list)
    unresolved: list[str] = field(default_factory=list)
    # More than SQL checks cover: validated as rows.
    beyond: bool = False
    broken: bool = False

    def errors_sql(self) -> str:
        """SQL for the ARRAY<STRING> of violated labels (empty when valid)."""
        if not self.checks:
            return "CAST(array() AS ARRAY<STRING>)"
        items = ", ".join(f"CASE WHEN NOT coalesce({ok}, true) THEN {sql_str(label)} END"
                          for label, ok in self.checks)
        return f"array_compact(array({items}))"

    def errors(self) -> Column:
        return F.expr(self.errors_sql())


class SchemaCompiler:
    """Compile schema documents; ``resolve(uri) -> dict | None`` serves ``$ref``."""

    def __init__(self, resolve: Callable[[str], object | None] | None = None,
                 assert_email: bool = False):
        self.resolve = resolve or (lambda uri: None)
        self.assert_email = assert_email

    def compile(self, uri: str, doc) -> CompiledSchema:
        """SQL checks of a document that they cover exactly."""
        out = CompiledSchema(uri=uri)
        self._node(doc, [], out, ())
        return out

    # -- node compilation ------------------------------------------------
    def _node(self, node, parts: list[str], out: CompiledSchema, chain: tuple[str, ...], base: str = V, prefix: str = "") -> None:
        """Checks of ``node`` at the property path ``parts`` below the variant ``base``:
        the payload, or an array element (a lambda variable) with its label ``prefix``."""
        lbl = label_path(parts, prefix)
        root = not parts and not prefix
        x = f"try_variant_get({base}, {sql_str(variant_path(parts))}, 'variant')" if parts else base
        t = vtype_sql(x)

        def add(kw: str, ok: str) -> None:
            # keyword checks on a property apply only when it is present
            out.checks.append((f"{kw}:{lbl}", f"({x} IS NULL OR {ok})" if parts else ok))

        if node is True or node == {}:
            return
        if node is False:
            add("false", "false")
            return
        if not isinstance(node, dict):
            return

        if "$ref" in node:
            ref = node["$ref"]
            target = None if ref in chain else self.resolve(ref)
            if target is None:
                out.unresolved.append(ref)
            else:
                self._node(target, parts, out, (*chain, ref), base, prefix)

        types = node.get("type")
        if types is not None:
            names = [types] if isinstance(types, str) else list(types)
            if root and names == ["object"]:
                add("type", f"({D} RLIKE {sql_str(OBJECT_TEXT)})")
            else:
                add("type", types_sql(t, x, names))

        if isinstance(node.get("enum"), list):
            add("enum", _enum_sql(t, x, node["enum"]))
        if "const" in node:
            add("const", _literal_sql(t, x, node["const"]))

        num = type_sql(t, x, "number")
        for kw, op in BOUNDS:
            if _num(node, kw) is not None:
                add(kw, f"(NOT {num} OR {_cmp(get(x, 'double'), _num(node, kw), op)})")
        m = _num(node, "multipleOf")
        if m is not None and m > 0:
            add("multipleOf", f"(NOT {num} OR {get(x, 'double')} % double({m!r}) = 0)")

        if self.assert_email and node.get("format") == "email":
            add("format", f"({t} <> 'STRING' OR {get(x, 'string')} RLIKE {sql_str(EMAIL_SHAPE)})")

        for kw, op in (("minLength", "ge"), ("maxLength", "le")):
            if _num(node, kw) is not None:
                length = f"length({get(x, 'string')})"
                add(kw, f"({t} <> 'STRING' OR {_cmp(length, _num(node, kw), op)})")
        if isinstance(node.get("pattern"), str):
            add("pattern", f"({t} <> 'STRING' OR {get(x, 'string')} RLIKE {sql_str(node['pattern'])})")
        for kw, op, typ, like in (("minItems", "ge", "array<variant>", "ARRAY%"),
                                  ("maxItems", "le", "array<variant>", "ARRAY%"),
                                  ("minProperties", "ge", "map<string,variant>", "OBJECT%"),
                                  ("maxProperties", "le", "map<string,variant>", "OBJECT%")):
            if _num(node, kw) is not None:
                size = f"size({get(x, typ)})"
                add(kw, f"({t} NOT LIKE '{like}' OR {_cmp(size, _num(node, kw), op)})")
        if node.get("uniqueItems") is True:
            arr = get(x, "array<variant>")
            add("uniqueItems",
                f"coalesce(size(array_distinct(transform({arr}, e -> to_json(e)))) = size({arr}), true)")

        props = node.get("properties") if isinstance(node.get("properties"), dict) else {}
        if node.get("additionalProperties") is False:
            allowed = ", ".join(sql_str(k) for k in props)
            add("additionalProperties",
                f"coalesce(size(array_except(map_keys({get(x, 'map<string,variant>')}), "
                f"CAST(array({allowed}) AS ARRAY<STRING>))) = 0, true)")
        if isinstance(node.get("dependentRequired"), dict):
            for trig, needed in node["dependentRequired"].items():
                for name in needed if isinstance(needed, list) else []:
                    tp = sql_str(variant_path(parts + [trig]))
                    np_ = sql_str(variant_path(parts + [name]))
                    out.checks.append((f"dependentRequired:{label_path(parts + [name], prefix)}",
                                       f"(try_variant_get({base}, {tp}, 'variant') IS NULL "
                                       f"OR try_variant_get({base}, {np_}, 'variant') IS NOT NULL)"))

        # combinators: each subschema is compiled at the same path into one
        # validity flag; allOf simply adds the subschemas' own checks
        all_of = node.get("allOf")
        for sub in all_of if isinstance(all_of, list) else []:
            self._node(sub, parts, out, chain, base, prefix)

        def flag(sub) -> str:
            return self._valid_flag(sub, parts, out, chain, base, prefix)

        if isinstance(node.get("anyOf"), list) and node["anyOf"]:
            flags = [flag(s) for s in node["anyOf"]]
            add("anyOf", "(" + " OR ".join(flags) + ")")
        if isinstance(node.get("oneOf"), list) and node["oneOf"]:
            flags = [flag(s) for s in node["oneOf"]]
            add("oneOf", "((" + " + ".join(f"CASE WHEN {f} THEN 1 ELSE 0 END" for f in flags) + ") = 1)")
        if "not" in node:
            add("not", f"(NOT {flag(node['not'])})")
        if "if" in node and ("then" in node or "else" in node):
            c, th, el = flag(node["if"]), flag(node.get("then", True)), flag(node.get("else", True))
            add("if", f"(CASE WHEN {c} THEN {th} ELSE {el} END)")

        items = node.get("items")
        if isinstance(items, dict) or items is False:
            self._items(items, lbl, x, out, chain)

        req = node.get("required")
        if (isinstance(req, list) and req) or props:
            is_obj = f"({D} RLIKE {sql_str(OBJECT_TEXT)})" if root else f"({t} LIKE 'OBJECT%')"
            for name in req if isinstance(req, list) else []:
                child = sql_str(variant_path(parts + [name]))
                out.checks.append((f"required:{label_path(parts + [name], prefix)}",
                                   f"(NOT {is_obj} OR try_variant_get({base}, {child}, 'variant') IS NOT NULL)"))
            # A property path only resolves inside an object parent, so the
            # child's own presence guard covers the non-object case.
            for name, sub in props.items():
                self._node(sub, parts + [name], out, chain, base, prefix)

    def _valid_flag(self, sub, parts, out: CompiledSchema, chain: tuple[str, ...], base: str, prefix: str) -> str:
        """Compile ``sub`` at ``parts`` into one flag: TRUE when all its checks pass."""
        tmp = CompiledSchema(uri=out.uri)
        self._node(sub, parts, tmp, chain, base, prefix)
        out.unresolved.extend(tmp.unresolved)
        if not tmp.checks:
            return "true"
        return "(" + " AND ".join(f"coalesce({ok}, true)" for _, ok in tmp.checks) + ")"

    def _items(self, items, label: str, x: str, out: CompiledSchema, chain: tuple[str, ...]) -> None:
        """An element schema: its checks over a lambda variable, each for all elements."""
        each, arr = label + "[]", get(x, "array<variant>")
        if items is False:
            out.checks.append((f"items:{each}", f"coalesce(size({arr}) = 0, true)"))
            return
        element = f"e{label.count('[]')}"
        tmp = CompiledSchema(uri=out.uri)
        self._node(items, [], tmp, chain, element, each)
        out.unresolved.extend(tmp.unresolved)
        for name, check in tmp.checks:
            out.checks.append((name, f"coalesce(forall({arr}, {element} -> coalesce({check}, true)), true)"))


def references(doc) -> list[str]:
    """Every ``$ref`` of a schema document, at any depth."""
    out, todo = [], [doc]
    while todo:
        node = todo.pop()
        if not isinstance(node, dict):
            continue
        if isinstance(node.get("$ref"), str):
            out.append(node["$ref"])
        todo += [node[k] for k in SUBSCHEMA if k in node]
        todo += [s for k in SUBSCHEMA_LISTS for s in (node[k] if isinstance(node.get(k), list) else ())]
        todo += [s for k in SUBSCHEMA_MAPS for s in (node[k].values() if isinstance(node.get(k), dict) else ())]
    return out


# -- schema document -> Spark type (PRJ-12) -------------------------------

def struct_type_of(doc, resolve: Callable[[str], object | None] | None = None) -> T.DataType:
    """Type mapping: integer->long, number->double, string->string,
    boolean->boolean, array->array(items), object->struct(properties).

    Properties outside ``required`` are nullable; required ones are declared
    non-nullable (readers relax this, so validation stays a separate step).
    """
    resolve = resolve or (lambda uri: None)

    def conv(node, chain=()) -> T.DataType:
        if isinstance(node, dict) and "$ref" in node and node["$ref"] not in chain:
            tgt = resolve(node["$ref"])
            if tgt is not None:
                return conv(tgt, (*chain, node["$ref"]))
        if not isinstance(node, dict):
            return T.StringType()
        t = node.get("type")
        if isinstance(t, list):
            non_null = [x for x in t if x != "null"]
            t = non_null[0] if len(non_null) == 1 else None
        if t == "integer":
            return T.LongType()
        if t == "number":
            return T.DoubleType()
        if t == "boolean":
            return T.BooleanType()
        if t == "string":
            return T.StringType()
        if t == "array":
            return T.ArrayType(conv(node.get("items", {}), chain))
        if t == "object" or "properties" in node:
            req = set(node.get("required", []) or [])
            return T.StructType([
                T.StructField(k, conv(v, chain), nullable=k not in req)
                for k, v in (node.get("properties") or {}).items()])
        return T.StringType()  # untyped: keep the JSON text

    return conv(doc)
