"""Validation with rules as rows (design B, for registries of any size).

The registry is flattened *by Spark* into rules ``(label, path, kind, types,
enum_json, bound)``: for the root and every property (two levels) its
``type``, ``enum``/``const``, ``items.type``, numeric bounds, ``multipleOf``,
string length and ``pattern``, array/object sizes; every ``required`` name.
Each document becomes its rule array in one projection of higher-order functions
(no union, no explode/regroup).

Documents that rules do not express (references, combinators, deeper nesting
and so on) keep no rules; their messages are validated as rows (``nodes``), so
there is no bound on the number, size or depth of schemas and the outcome never
depends on the registry's size.

The arrays are joined to the messages on the normalised URI.  When the table is
under ``BROADCAST_MAX_BYTES`` it is broadcast (a map-side join: no shuffle of
the messages); above that the join is salted so a hot URI is split over
``SALT_BUCKETS`` tasks.  Each rule is evaluated with higher-order functions over
the parsed payload.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.routes import normalise_uri
from .nodes import SchemaTable, schema_table
from .validate import _status, emit_outcome, walked_documents, with_violations

BROADCAST_MAX_BYTES = 64 << 20
SALT_BUCKETS = 64

_NULL_ARR = "CAST(NULL AS ARRAY<STRING>)"
_NULL_DBL = "CAST(NULL AS DOUBLE)"
_NODE_T = "STRUCT<parts: ARRAY<STRING>, node: VARIANT>"


def _types(n: str, key: str = "$.type") -> str:
    """JSON ``type`` (a name or a list of names) of node ``n`` as ARRAY<STRING>."""
    return (f"CASE WHEN schema_of_variant(try_variant_get({n}, '{key}', 'variant')) = 'STRING' "
            f"THEN array(try_variant_get({n}, '{key}', 'string')) "
            f"ELSE try_variant_get({n}, '{key}', 'array<string>') END")


def _path(parts: str) -> str:
    return f"concat('$', array_join(transform({parts}, q -> concat('[\"', q, '\"]')), ''))"


def _rule(label: str, path: str, kind: str, types: str = _NULL_ARR, enum: str = _NULL_ARR,
          bound: str = _NULL_DBL) -> str:
    return (f"named_struct('label', {label}, 'path', {path}, 'kind', '{kind}', 'types', {types}, "
            f"'enum_json', {enum}, 'bound', {bound})")


def _is_num(x: str) -> str:
    t = f"schema_of_variant({x})"
    return f"({t} IN ('BIGINT','DOUBLE','FLOAT') OR {t} LIKE 'DECIMAL%')"


def _node_rules(x: str, assert_email: bool) -> str:
    """Keyword rules of one property node ``x`` (struct of parts and node)."""
    n, path = f"{x}.node", _path(f"{x}.parts")
    lbl = f"CASE WHEN size({x}.parts) = 0 THEN '$' ELSE array_join({x}.parts, '.') END"
    enum = f"transform(try_variant_get({n}, '$.enum', 'array<variant>'), e -> to_json(e))"
    items = _types(n, "$.items.type")
    parts = [
        f"CASE WHEN {_types(n)} IS NOT NULL THEN "
        f"{_rule(f'concat(\'type:\', {lbl})', path, 'type', types=_types(n))} END",
        f"CASE WHEN {enum} IS NOT NULL THEN {_rule(f'concat(\'enum:\', {lbl})', path, 'enum', enum=enum)} END",
        f"CASE WHEN {items} IS NOT NULL THEN "
        f"{_rule(f'concat(\'type:\', {lbl}, \'[]\')', path, 'items_type', types=items)} END",
    ]
    for k in ("minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "multipleOf",
              "minLength", "maxLength", "minItems", "maxItems", "minProperties", "maxProperties"):
        b = f"try_variant_get({n}, '$.{k}', 'variant')"
        parts.append(f"CASE WHEN {_is_num(b)} THEN {_rule(f'concat(\'{k}:\', {lbl})', path, k, bound=f'try_variant_get({b}, \'$\', \'double\')')} END")
    const = f"try_variant_get({n}, '$.const', 'variant')"
    parts.append(f"CASE WHEN {const} IS NOT NULL THEN "
                 f"{_rule(f'concat(\'const:\', {lbl})', path, 'enum', enum=f'array(to_json({const}))')} END")
    pat = f"try_variant_get({n}, '$.pattern', 'string')"
    parts.append(f"CASE WHEN {pat} IS NOT NULL THEN "
                 f"{_rule(f'concat(\'pattern:\', {lbl})', path, 'pattern', enum=f'array({pat})')} END")
    if assert_email:
        parts.append(f"CASE WHEN try_variant_get({n}, '$.format', 'string') = 'email' THEN "
                     f"{_rule(f'concat(\'format:\', {lbl})', path, 'email')} END")
    return f"filter(array({', '.join(parts)}), r -> r IS NOT NULL)"


def _required_rules(x: str) -> str:
    """``required`` rules of one object node ``x``; the parent path rides in ``types``."""
    parent = _path(f"{x}.parts")
    label = f"concat('required:', array_join(concat({x}.parts, array(nm)), '.'))"
    path = f"concat({parent}, '[\"', nm, '\"]')"
    return (f"transform(coalesce(try_variant_get({x}.node, '$.required', 'array<string>'), {_NULL_ARR.replace('NULL', 'array()')}), "
            f"nm -> {_rule(label, path, 'required', types=f'array({parent})')})")


# Keywords the rule arrays do not evaluate; schemas using any are validated as rows.
_UNSUPPORTED = ("allOf", "anyOf", "oneOf", "not", "if", "dependentRequired", "prefixItems",
                "contains", "patternProperties", "propertyNames", "dependentSchemas",
                "unevaluatedProperties", "unevaluatedItems")


def _unsupported(x: str) -> str:
    n = f"{x}.node"
    conds = [f"try_variant_get({n}, '$[\"{k}\"]', 'variant') IS NOT NULL" for k in (*_UNSUPPORTED, "$ref")]
    conds.append(f"try_variant_get({n}, '$.additionalProperties', 'variant') IS NOT NULL AND NOT "
                 f"coalesce(try_variant_get({n}, '$.additionalProperties', 'boolean'), false)")
    # element schemas: only ``type`` is evaluated per element
    conds.append(f"try_variant_get({n}, '$.items', 'variant') IS NOT NULL AND "
                 f"size(array_except(coalesce(map_keys(try_variant_get({n}, '$.items', 'map<string,variant>')), "
                 f"array('?')), array('type', 'title', 'description', '$comment'))) > 0")
    return "(" + " OR ".join(conds) + ")"


def _too_deep(x: str) -> str:
    """Object keywords on a second-level node would need a third level."""
    n = f"{x}.node"
    return (f"(try_variant_get({n}, '$.properties', 'variant') IS NOT NULL "
            f"OR try_variant_get({n}, '$.required', 'variant') IS NOT NULL "
            f"OR try_variant_get({n}, '$.additionalProperties', 'variant') IS NOT NULL)")


def _children(x: str) -> str:
    """Property nodes directly under node ``x``."""
    return (f"transform(coalesce(map_entries(try_variant_get({x}.node, '$.properties', 'map<string,variant>')), "
            f"CAST(array() AS ARRAY<STRUCT<key: STRING, value: VARIANT>>)), "
            f"e -> named_struct('parts', concat({x}.parts, array(e.key)), 'node', e.value))")


def _rules_sql(assert_email: bool) -> tuple[str, str, str]:
    """SQL pieces: root node, first- and second-level property nodes."""
    root = f"named_struct('parts', CAST(array() AS ARRAY<STRING>), 'node', doc)"
    lvl1 = _children("__root")
    lvl2 = f"flatten(transform(__lvl1, p -> {_children('p')}))"
    return root, lvl1, lvl2


def flatten_registry(registry: DataFrame, assert_email: bool = False) -> tuple[DataFrame, SchemaTable | None]:
    """Registry ``(schemaURI, schema)`` -> one row per normalised URI,
    ``__uri, __rules, __beyond, __unresolved, __broken``, and the schema table if
    some document has no rules."""
    docs, flags, folder = walked_documents(registry)
    staged = docs.join(flags.withColumnRenamed("doc", "uri"), "uri").select(
        F.col("uri").alias("__uri"), "broken", (F.col("beyond") | F.col("refs")).alias("beyond"), F.col("node").alias("doc"))
    root, lvl1, lvl2 = _rules_sql(assert_email)
    staged = staged.select("*", F.expr(root).alias("__root"))
    staged = staged.select("*", F.expr(lvl1).alias("__lvl1"))
    staged = staged.select("*", F.expr(lvl2).alias("__lvl2"))
    rules = F.expr(
        f"concat(flatten(transform(concat(array(__root), __lvl1, __lvl2), x -> {_node_rules('x', assert_email)})), "
        f"flatten(transform(concat(array(__root), __lvl1), x -> {_required_rules('x')})))")
    unsupported = F.expr(f"schema_of_variant(doc) NOT LIKE 'OBJECT%' OR exists(concat(array(__root), __lvl1, __lvl2), x -> {_unsupported('x')}) "
                         f"OR exists(__lvl2, x -> {_too_deep('x')})")
    beyond = ~F.col("broken") & (F.col("beyond") | F.coalesce(unsupported, F.lit(False)))
    flat = staged.select("__uri", F.col("broken").alias("__broken"), beyond.alias("__beyond"),
                         F.when(~F.col("broken") & ~beyond, rules).alias("__rules")).checkpoint()
    if flat.where("__beyond").isEmpty():
        return flat.withColumn("__unresolved", F.lit(False)), None
    table = schema_table(folder, flat.where("not __broken").select(F.col("__uri").alias("doc")))
    dangling = table.unresolved.select(F.col("uri").alias("__uri"), F.lit(True).alias("__dangling"))
    return (flat.join(dangling, "__uri", "left")
            .select("__uri", "__rules", "__beyond", (F.col("__beyond") & F.coalesce("__dangling", F.lit(False))).alias("__unresolved"),
                    "__broken"), table)


# SQL for one rule against the payload ``__v``; TRUE when satisfied.  Each rule
# is first bound to its value ``x``, type text ``t`` and numeric value ``d``
# (one path lookup and one type probe per rule), then checked.
_MATCH = """(CASE {n}
  WHEN 'string' THEN {t} = 'STRING'
  WHEN 'boolean' THEN {t} = 'BOOLEAN'
  WHEN 'null' THEN {t} = 'VOID'
  WHEN 'array' THEN {t} LIKE 'ARRAY%'
  WHEN 'object' THEN {t} LIKE 'OBJECT%'
  WHEN 'number' THEN {t} IN ('BIGINT','DOUBLE','FLOAT') OR {t} LIKE 'DECIMAL%'
  WHEN 'integer' THEN {t} = 'BIGINT' OR {t} RLIKE '^DECIMAL\\\\([0-9]+,0\\\\)$'
       OR ({t} = 'DOUBLE' AND NOT isnan({d}) AND abs({d}) != double('infinity') AND {d} % 1.0 = 0.0)
  ELSE false END)"""

_BIND = """transform(coalesce(__rules, array()), r -> named_struct(
  'r', r,
  'x', CASE WHEN r.path = '$' THEN __v ELSE try_variant_get(__v, r.path, 'variant') END,
  'p', CASE WHEN r.kind <> 'required' THEN true WHEN r.types[0] = '$' THEN __root_obj
            ELSE schema_of_variant(try_variant_get(__v, r.types[0], 'variant')) LIKE 'OBJECT%' END))"""

_TYPED = """transform({bound}, b -> named_struct(
  'r', b.r, 'x', b.x, 'p', b.p, 't', schema_of_variant(b.x), 'd', try_variant_get(b.x, '$', 'double')))"""


def _rule_ok_sql() -> str:
    t, x, d = "s.t", "s.x", "s.d"
    num = f"({t} IN ('BIGINT','DOUBLE','FLOAT') OR {t} LIKE 'DECIMAL%')"
    elem = _MATCH.format(n="n", t="schema_of_variant(e)", d="try_variant_get(e, '$', 'double')")
    return f"""(CASE s.r.kind
  WHEN 'type' THEN {x} IS NULL OR (CASE WHEN s.r.path = '$' AND s.r.types = array('object') THEN __root_obj
                   ELSE exists(s.r.types, n -> {_MATCH.format(n='n', t=t, d=d)}) END)
  WHEN 'required' THEN NOT s.p OR {x} IS NOT NULL
  WHEN 'enum' THEN {x} IS NULL OR array_contains(s.r.enum_json, to_json({x}))
  WHEN 'items_type' THEN coalesce(forall(try_variant_get({x}, '$', 'array<variant>'),
                   e -> exists(s.r.types, n -> {elem})), true)
  WHEN 'minimum' THEN {x} IS NULL OR NOT {num} OR {d} >= s.r.bound
  WHEN 'maximum' THEN {x} IS NULL OR NOT {num} OR {d} <= s.r.bound
  WHEN 'exclusiveMinimum' THEN {x} IS NULL OR NOT {num} OR {d} > s.r.bound
  WHEN 'exclusiveMaximum' THEN {x} IS NULL OR NOT {num} OR {d} < s.r.bound
  WHEN 'multipleOf' THEN {x} IS NULL OR NOT {num} OR {d} % s.r.bound = 0
  WHEN 'minLength' THEN {x} IS NULL OR {t} <> 'STRING' OR length(try_variant_get({x}, '$', 'string')) >= s.r.bound
  WHEN 'maxLength' THEN {x} IS NULL OR {t} <> 'STRING' OR length(try_variant_get({x}, '$', 'string')) <= s.r.bound
  WHEN 'minItems' THEN {x} IS NULL OR {t} NOT LIKE 'ARRAY%' OR size(try_variant_get({x}, '$', 'array<variant>')) >= s.r.bound
  WHEN 'maxItems' THEN {x} IS NULL OR {t} NOT LIKE 'ARRAY%' OR size(try_variant_get({x}, '$', 'array<variant>')) <= s.r.bound
  WHEN 'minProperties' THEN {x} IS NULL OR {t} NOT LIKE 'OBJECT%' OR size(try_variant_get({x}, '$', 'map<string,variant>')) >= s.r.bound
  WHEN 'maxProperties' THEN {x} IS NULL OR {t} NOT LIKE 'OBJECT%' OR size(try_variant_get({x}, '$', 'map<string,variant>')) <= s.r.bound
  WHEN 'pattern' THEN {x} IS NULL OR {t} <> 'STRING' OR try_variant_get({x}, '$', 'string') RLIKE s.r.enum_json[0]
  WHEN 'email' THEN {x} IS NULL OR {t} <> 'STRING'
                   OR try_variant_get({x}, '$', 'string') RLIKE '^[^@\\\\s]+@[^@\\\\s]+\\\\.[^@\\\\s]+$'
  ELSE true END)"""


def _errors_sql() -> str:
    typed = _TYPED.format(bound=_BIND)
    return (f"filter(transform({typed}, s -> CASE WHEN NOT coalesce({_rule_ok_sql()}, true) "
            "THEN s.r.label END), x -> x IS NOT NULL)")


def rules_by_uri(registry: DataFrame, assert_email: bool = False) -> tuple[DataFrame, int, SchemaTable | None]:
    """(per-URI rules, their bytes, the schema table if some URI needs it),
    materialised once.

    One row per schema; checkpointed into the shared checkpoint folder so the
    flattening runs once and the table survives executor loss.
    """
    from ..session import checkpoint_root
    checkpoint_root(registry.sparkSession)
    flat, table = flatten_registry(registry, assert_email)
    per_uri = flat.withColumn("__known", F.lit(True)).checkpoint(eager=True)
    size = F.coalesce(F.length(F.to_json("__rules")), F.lit(0)) + F.length("__uri")
    return per_uri, int(per_uri.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]), table


def validate_rules(messages: DataFrame, registry: DataFrame, assert_email: bool = False,
                   broadcast: bool | None = None,
                   rules: tuple[DataFrame, int, SchemaTable | None] | None = None) -> DataFrame:
    """Design B: same output as ``validate_compiled``.

    ``rules`` takes a ``rules_by_uri`` result to reuse across micro-batches.
    """
    per_uri, n_bytes, table = rules or rules_by_uri(registry, assert_email)
    barred = broadcast is False
    if broadcast is None:
        broadcast = n_bytes <= BROADCAST_MAX_BYTES
    cols = messages.columns
    m = messages.select(*cols, normalise_uri(F.coalesce("schemaURI", F.lit(""))).alias("__uri"),
                        F.try_parse_json("data").alias("__v"),
                        F.col("data").rlike(r"^[ \t\n\r]*\{").alias("__root_obj"))
    if broadcast:
        j = m.join(F.broadcast(per_uri), "__uri", "left")
    else:
        # A hot schema URI may carry a third of all messages: salt the message
        # side and replicate each URI's (small) rule row once per salt.
        m = m.withColumn("__salt", F.pmod(F.xxhash64("data", "__uri"), F.lit(SALT_BUCKETS)))
        salted = per_uri.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALT_BUCKETS - 1))))
        j = m.join(salted, ["__uri", "__salt"], "left")

    def flag(c: str):
        return F.coalesce(F.col(c), F.lit(False)).alias(c)

    j = j.select(*cols, "__uri", "__v", "__rules", "__root_obj", flag("__known"), flag("__unresolved"), flag("__broken"), flag("__beyond"))
    errs = F.when(F.col("__known") & F.col("__v").isNotNull(), F.expr(_errors_sql()))
    as_rows = F.col("__beyond") & ~F.col("__unresolved")
    state = [*cols, "__uri", "__v", "__known", "__unresolved", "__broken"]
    if table is None:
        checked = j.select(*state, errs.alias("__errors"))
    else:
        checked = j.where(~as_rows).select(*state, errs.alias("__errors")).union(
            with_violations(j.where(as_rows), table, assert_email, not barred).select(*state, "__errors"))
    status, reason = _status(F.col("__uri"), F.col("__known"), F.col("__unresolved"), F.col("__v"), F.col("__errors"),
                             F.col("__broken"))
    return emit_outcome(checked, cols, status, reason,
                        F.when(reason.isin("ok", "schema_violation"), F.array_sort("__errors")))
