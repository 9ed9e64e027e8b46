"""JSON Schema as rows: documents and payloads are walked, joined and folded by Spark.

Schema documents of any depth, with local, remote and recursive references, need
no fixed expression here.  A recursive query walks the documents into *schema
nodes*; admission is a test of every node's keywords, and the nodes with their
edges (keyword, name, child) are the table payloads are joined to.  A second
recursive query pairs values with schema nodes: it starts with the payload and
the root of its schema, and every edge yields the values it applies to (members,
elements, names, or the value itself).  An edge back to a schema node that is
already active at the same value adds nothing, so recursive schemas end with the
payload.

Each pair tests its own keywords.  What a keyword only *judges* (``anyOf``,
``oneOf``, ``not``, ``if``, ``contains``, ``propertyNames``) lies in a scope of its
own; scopes form a tree that grouped aggregates fold from the deepest level: a
scope is valid if no pair of it and no judgement in it failed.  Places and scopes
are told apart, within one payload, by 64-bit hashes of the way to them.

Numbers compare as DECIMAL(38, 18) where they fit and as doubles beyond.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import configure, new_run_dir
from ..functions.routes import normalise_uri

# Keywords of draft 2020-12 by what they hold.
TYPE_NAMES = ("string", "integer", "number", "boolean", "null", "array", "object")
SUBSCHEMA = ("additionalProperties", "contains", "else", "if", "items", "not", "propertyNames", "then")
SUBSCHEMA_LISTS = ("allOf", "anyOf", "oneOf", "prefixItems")
SUBSCHEMA_MAPS = ("$defs", "definitions", "dependentSchemas", "patternProperties", "properties")
NUMBERS = ("minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum")
COUNTS = ("minLength", "maxLength", "minItems", "maxItems", "minProperties", "maxProperties", "minContains", "maxContains")
#: Keywords that change validity and are not evaluated anywhere; documents with them are refused.
REFUSED = ("$dynamicRef", "$recursiveRef", "unevaluatedItems", "unevaluatedProperties")
EMAIL_SHAPE = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"

#: Edges that leave the value where it is, and keywords that judge what lies below them.
_SAME_VALUE = ("$ref", "allOf", "anyOf", "oneOf", "not", "if", "then", "else")
_JUDGING = ("anyOf", "oneOf", "not", "if", "then", "else", "contains", "propertyNames")

MAX_LEVELS = 5000
BROADCAST_BYTES = 64 << 20


def _in(names: tuple[str, ...]) -> str:
    return "(" + ", ".join(f"'{n}'" for n in names) + ")"


def literal(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _get(x: str, key: str, kind: str = "variant") -> str:
    return f"try_variant_get({x}, '$[\"{key}\"]', '{kind}')"


def _step(name: str) -> str:
    return f"replace(replace({name}, '~', '~0'), '/', '~1')"


# -- numbers and equality -----------------------------------------------------

def _plain_number(text: str) -> str:
    """One spelling for every JSON number (text in, text out)."""
    return (f"coalesce(regexp_replace(CAST(try_cast({text} AS DECIMAL(38, 18)) AS STRING), '\\\\.?0+$', ''), "
            f"CAST(try_cast({text} AS DOUBLE) AS STRING))")


def canonical(x: str) -> str:
    """Text that is equal for equal JSON values: members in order, numbers in one spelling."""
    token = r'"(?:[^"\\]|\\.)*"|-?[0-9][0-9.eE+-]*|[^"0-9-]+'
    return (f"array_join(transform(regexp_extract_all(to_json({x}), {literal(token)}, 0), "
            f"q -> CASE WHEN q RLIKE '^-?[0-9]' THEN {_plain_number('q')} ELSE q END), '')")


# -- patterns -------------------------------------------------------------------

_QUANTIFIER = r"(?:(?:[*+?]|\{\d{1,4}(?:,\d{0,4})?\})[?+]?)?"
_FLAT = rf"(?:[^()\[{{*+?|^$\\]{_QUANTIFIER}|[|^$])*"


def pattern_ok(p: str) -> str:
    """SQL: is ``p`` a regular expression whose syntax is understood.

    Escapes and character classes become single letters, then groups do, from the
    inside out; what is left must be a plain sequence.  Look-behind, named groups
    and back-references are not understood and so refused.
    """
    escapes = r"\\(?:[dDwWsSbBtnrfv]|u[0-9A-Fa-f]{4}|x[0-9A-Fa-f]{2}|[^A-Za-z0-9])"
    plain = f"regexp_replace({p}, {literal(escapes)}, 'e')"
    classes = r"\[\^?[^\[\]&^][^\[\]&]*\]"
    ranges = (f"forall(regexp_extract_all({p}, {literal(classes)}, 0), c -> NOT c RLIKE {literal(r'\\[bBdDwWsS]-[^]]|\\[bB]')} AND "
              f"forall(regexp_extract_all(regexp_replace(c, {literal(escapes)}, ''), {literal(r'[^\[\]^-]-[^\[\]]')}, 0), "
              "r -> ascii(substr(r, 1, 1)) <= ascii(substr(r, 3, 1))))")
    bounds = (f"forall(arrays_zip(regexp_extract_all({p}, {literal(r'\{(\d{1,4}),(\d{1,4})\}')}, 1), "
              f"regexp_extract_all({p}, {literal(r'\{(\d{1,4}),(\d{1,4})\}')}, 2)), b -> int(b['0']) <= int(b['1']))")
    flat = f"regexp_replace({plain}, {literal(classes)}, 'c')"
    group = literal(rf"\((?:\?[:=!])?{_FLAT}\)")
    reduced = (f"aggregate(sequence(1, length({p}) - length(replace({p}, '(', '')) + 1), {flat}, "
               f"(acc, i) -> regexp_replace(acc, {group}, 'g'))")
    return f"({ranges} AND {bounds} AND {reduced} RLIKE {literal('^' + _FLAT + '$')})"


# -- walking schema documents ------------------------------------------------------

def walk(docs: DataFrame) -> DataFrame:
    """Every JSON position of schema documents ``(doc, at, node)``.

    ``at`` is a JSON pointer, ``role`` what stands there: ``schema``, a ``list`` or
    ``map`` of schemas, or ``data``; ``owner``, ``kw`` and ``name`` say how a schema
    hangs below the schema around it.
    """
    all_of = SUBSCHEMA + SUBSCHEMA_LISTS + SUBSCHEMA_MAPS
    return configure(docs.sparkSession).sql(f"""
WITH RECURSIVE walk(doc, at, role, owner, kw, name, node) MAX RECURSION LEVEL {MAX_LEVELS} AS (
  SELECT doc, at, 'schema', CAST(NULL AS STRING), CAST(NULL AS STRING), CAST(NULL AS STRING), node FROM {{docs}}
  UNION ALL
  SELECT w.doc, concat(w.at, '/', {_step("coalesce(c.key, CAST(c.pos AS STRING))")}),
    CASE WHEN w.role = 'schema' AND c.key IN {_in(SUBSCHEMA)} THEN 'schema'
         WHEN w.role = 'schema' AND c.key IN {_in(SUBSCHEMA_LISTS)} THEN 'list'
         WHEN w.role = 'schema' AND c.key IN {_in(SUBSCHEMA_MAPS)} THEN 'map'
         WHEN w.role = 'list' AND c.key IS NULL OR w.role = 'map' AND c.key IS NOT NULL THEN 'schema' ELSE 'data' END,
    CASE WHEN w.role = 'schema' AND c.key IN {_in(all_of)} THEN w.at WHEN w.role IN ('list', 'map') THEN w.owner END,
    CASE WHEN w.role = 'schema' AND c.key IN {_in(all_of)} THEN c.key WHEN w.role IN ('list', 'map') THEN w.kw END,
    CASE WHEN w.role IN ('list', 'map') THEN coalesce(c.key, CAST(c.pos AS STRING)) END, c.value
  FROM walk w, LATERAL variant_explode(w.node) c)
SELECT * FROM walk""", docs=docs)


def _kind(x: str) -> str:
    return f"schema_of_variant({x})"


def _is_number(x: str) -> str:
    return f"({_kind(x)} IN ('BIGINT', 'DOUBLE', 'FLOAT') OR {_kind(x)} LIKE 'DECIMAL%')"


def _strings(x: str) -> str:
    return f"coalesce({_kind(x)} LIKE 'ARRAY%' AND forall(try_variant_get({x}, '$', 'array<variant>'), e -> {_kind('e')} = 'STRING'), false)"


def _node_ok() -> str:
    """SQL: does schema node ``node`` hold values of their kind for all its keywords."""
    def when(key: str, test: str) -> str:
        return f"({_get('node', key)} IS NULL OR coalesce({test}, false))"

    def number(key: str) -> str:
        return _is_number(_get("node", key))

    kinds = _get("node", "type")
    listed = f"try_variant_get({kinds}, '$', 'array<string>')"
    tests = [f"{_get('node', k)} IS NULL" for k in REFUSED]
    tests += [when("type", f"({_kind(kinds)} = 'STRING' AND {_get('node', 'type', 'string')} IN {_in(TYPE_NAMES)}) OR "
                           f"({_strings(kinds)} AND size({listed}) > 0 AND forall({listed}, e -> e IN {_in(TYPE_NAMES)}))")]
    tests += [when("required", _strings(_get("node", "required"))), when("enum", f"{_kind(_get('node', 'enum'))} LIKE 'ARRAY%'"),
              when("$ref", f"{_kind(_get('node', '$ref'))} = 'STRING'"),
              when("uniqueItems", f"{_kind(_get('node', 'uniqueItems'))} = 'BOOLEAN'"),
              when("multipleOf", f"{number('multipleOf')} AND {_get('node', 'multipleOf', 'double')} > 0"),
              when("pattern", f"{_kind(_get('node', 'pattern'))} = 'STRING' AND {pattern_ok(_get('node', 'pattern', 'string'))}"),
              when("dependentRequired", f"{_kind(_get('node', 'dependentRequired'))} LIKE 'OBJECT%' AND forall(map_values("
                                        f"{_get('node', 'dependentRequired', 'map<string,variant>')}), d -> {_strings('d')})"),
              when("patternProperties", f"forall(map_keys({_get('node', 'patternProperties', 'map<string,variant>')}), k -> {pattern_ok('k')})")]
    tests += [when(k, number(k)) for k in NUMBERS]
    tests += [when(k, f"{number(k)} AND {_get('node', k, 'double')} >= 0 AND {_get('node', k, 'double')} % 1.0 = 0.0") for k in COUNTS]
    tests += [when(k, f"{_kind(_get('node', k))} LIKE 'ARRAY%'") for k in SUBSCHEMA_LISTS]
    tests += [when(k, f"{_kind(_get('node', k))} LIKE 'OBJECT%'") for k in SUBSCHEMA_MAPS]
    return f"({_kind('node')} = 'BOOLEAN' OR ({_kind('node')} LIKE 'OBJECT%' AND {' AND '.join(tests)}))"


#: Deeper documents are not turned into one SQL expression.
EXPRESSION_DEPTH = 40


def _beyond_expressions() -> str:
    """SQL: does ``node`` need more than the SQL checks of ``compile`` cover exactly."""
    def plain(e: str) -> str:
        return (f"({_kind(e)} IN ('STRING', 'BOOLEAN', 'VOID') OR {_is_number(e)} AND "
                f"abs(try_variant_get({e}, '$', 'double')) < {float(1 << 53)!r}D)")

    has = [f"{_get('node', k)} IS NOT NULL" for k in
           ("contains", "prefixItems", "patternProperties", "propertyNames", "dependentSchemas", "$defs", "definitions")]
    more = f"{_get('node', 'multipleOf')}"
    return "(" + " OR ".join([
        *has, f"coalesce({_get('node', 'uniqueItems', 'boolean')}, false)",
        f"exists(coalesce({_get('node', 'enum', 'array<variant>')}, array()), e -> NOT {plain('e')})",
        f"({_get('node', 'const')} IS NOT NULL AND NOT {plain(_get('node', 'const'))})",
        f"({more} IS NOT NULL AND NOT ({_kind(more)} = 'BIGINT' AND {_get('node', 'multipleOf', 'bigint')} < {1 << 31}))",
        *[f"coalesce(abs({_get('node', k, 'double')}) >= {float(1 << 53)!r}D, false)" for k in NUMBERS],
        f"coalesce(size({_get('node', 'additionalProperties', 'map<string,variant>')}) > 0, false)",
        f"size(split(at, '/')) > {EXPRESSION_DEPTH}"]) + ")"


def judged(docs: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """``(doc, broken, beyond, refs)`` of documents ``(doc, node)``; a null node is broken.

    ``broken``: some schema of it holds a value of the wrong kind; ``beyond``: some
    schema of it is more than the SQL checks cover; ``refs``: it has references.
    ``nodes`` is a ``walk`` of the documents, if there is one.
    """
    if nodes is None:
        nodes = walk(docs.where("node IS NOT NULL").select("doc", F.lit("").alias("at"), "node"))
    flags = nodes.where("role = 'schema'").groupBy("doc").agg(
        F.bool_or(~F.expr(_node_ok())).alias("broken"), F.bool_or(F.expr(f"coalesce({_beyond_expressions()}, false)")).alias("beyond"),
        F.bool_or(F.expr(f"{_get('node', '$ref')} IS NOT NULL")).alias("refs"))
    return docs.select("doc").join(flags, "doc", "left").select(
        "doc", F.coalesce("broken", F.lit(True)).alias("broken"), F.coalesce("beyond", F.lit(False)).alias("beyond"),
        F.coalesce("refs", F.lit(False)).alias("refs"))


#: Steps into a document that one expression takes; what lies deeper is walked by a recursive query.
ADMISSION_STEPS = 24


def _places(w: str) -> str:
    """SQL: the schemas, lists and maps of schemas right below place ``w`` (struct of role and node)."""
    members = f"map_entries(try_variant_get({w}.node, '$', 'map<string,variant>'))"
    role = (f"CASE WHEN {w}.role = 'map' OR x.key IN {_in(SUBSCHEMA)} THEN 'schema' WHEN x.key IN {_in(SUBSCHEMA_LISTS)} THEN 'list' ELSE 'map' END")
    return f"""coalesce(CASE {w}.role
  WHEN 'schema' THEN transform(filter({members}, x -> x.key IN {_in(SUBSCHEMA + SUBSCHEMA_LISTS + SUBSCHEMA_MAPS)}), x -> named_struct('role', {role}, 'node', x.value))
  WHEN 'map' THEN transform({members}, x -> named_struct('role', {role}, 'node', x.value))
  ELSE transform(try_variant_get({w}.node, '$', 'array<variant>'), x -> named_struct('role', 'schema', 'node', x)) END,
  CAST(array() AS ARRAY<STRUCT<role: STRING, node: VARIANT>>))"""


def _inside(df: DataFrame, schema: str, out: str) -> DataFrame:
    """``df`` with ``out``: the verdict on the text in ``schema``; null where the
    text goes deeper than ``ADMISSION_STEPS`` and nothing above is broken."""
    places = [f"__places_{i}" for i in range(ADMISSION_STEPS + 1)]
    staged = df.withColumn("__node", F.try_parse_json(schema)).withColumn(places[0], F.expr(
        "CASE WHEN __node IS NULL THEN CAST(array() AS ARRAY<STRUCT<role: STRING, node: VARIANT>>) ELSE array(named_struct('role', 'schema', 'node', __node)) END"))
    for last, here in zip(places, places[1:]):
        staged = staged.withColumn(here, F.expr(f"flatten(transform({last}, w -> {_places('w')}))"))
    staged = staged.withColumn("__schemas", F.expr(f"transform(filter(concat({', '.join(places[:-1])}), w -> w.role = 'schema'), w -> w.node)"))
    broken = f"exists(__schemas, node -> NOT coalesce({_node_ok()}, true))"
    verdict = f"CASE WHEN __node IS NULL OR {broken} THEN false WHEN size({places[-1]}) = 0 THEN true END"
    return staged.withColumn(out, F.expr(verdict)).drop("__node", "__schemas", *places)


def with_admission(df: DataFrame, schema: str = "schema", out: str = "admissible") -> DataFrame:
    """``df`` with ``out``: does the text in column ``schema`` compile as a JSON Schema (PRD-3/PRD-7).

    The whole document is walked: every subschema is an object or a boolean, every
    keyword has a value of its kind, patterns have a syntax that is understood, and
    keywords that would change validity but are evaluated nowhere are refused.  Null
    and text that is no JSON are refused.  A text is walked inside its row; only
    texts deeper than ``ADMISSION_STEPS`` go through a recursive query, each once.
    """
    # a deeper text has more opening brackets
    deep = F.length(schema) - F.length(F.translate(schema, "[{", "")) > ADMISSION_STEPS
    inside = _inside(df, schema, out)
    rest = _inside(df.where(deep).select(schema), schema, "__verdict").where("__verdict IS NULL")
    if rest.isEmpty():
        return inside
    key = f"__digest_of_{schema}"
    texts = rest.groupBy(F.sha2(schema, 256).alias(key)).agg(F.any_value(schema).alias("text"))
    folder = new_run_dir(df.sparkSession, "admission")
    judged(texts.select(F.col(key).alias("doc"), F.try_parse_json("text").alias("node"))).write.parquet(folder)
    flags = df.sparkSession.read.schema("doc string, broken boolean, beyond boolean, refs boolean").parquet(folder)
    keyed = inside.withColumn(key, F.when(F.col(out).isNull(), F.sha2(schema, 256)))
    return (keyed.join(flags.select(F.col("doc").alias(key), (~F.col("broken")).alias("__below")), key, "left")
            .withColumn(out, F.coalesce(out, "__below", F.lit(False))).select(*df.columns, out))


# -- the schema table -------------------------------------------------------------

@dataclass
class SchemaTable:
    """Schema nodes by ``sid`` (``uri#pointer``), and URIs with references to nothing.

    ``whole`` has the documents that end by themselves, one row each ``(uri, root,
    schemas)`` with their nodes in one array; a payload is at most ``steps`` edges
    and ``scopes`` judgements deep in them.  ``rest``: there are other documents.
    """

    nodes: DataFrame
    unresolved: DataFrame
    small: bool
    whole: DataFrame
    whole_small: bool
    steps: int
    scopes: int
    rest: bool


def reference(ref: Column, uri: Column) -> Column:
    """``uri#pointer`` a reference found in document ``uri`` leads to; null if it cannot."""
    base, fragment = F.substring_index(ref, "#", 1), F.when(ref.contains("#"), F.substring_index(ref, "#", -1)).otherwise("")
    target = F.when(base == "", uri).otherwise(normalise_uri(base))
    return F.when((fragment == "") | fragment.startswith("/"), F.concat(target, F.lit("#"), F.replace(fragment, F.lit("%25"), F.lit("%"))))


def walked(registry: DataFrame) -> str:
    """The walk of all documents ``(uri, node)`` of a registry, written to a folder."""
    folder = new_run_dir(registry.sparkSession, "schema-table")
    docs = registry.where("node IS NOT NULL").select(F.col("uri").alias("doc"), F.lit("").alias("at"), "node")
    walk(docs).write.parquet(f"{folder}/walk/step=0")
    return folder


def schema_table(folder: str, good: DataFrame) -> SchemaTable:
    """The nodes of the documents ``good`` (doc) of a ``walked`` registry, written once.

    References to other documents lead nowhere.  A reference may name any position
    of a document: positions that hold no schema by their keyword are walked as one
    when they are referred to.
    """
    spark = configure(good.sparkSession)
    step = 0
    while True:
        found = spark.read.parquet(f"{folder}/walk").join(good.select("doc"), "doc", "left_semi")
        schemas = found.where("role = 'schema'").withColumn("sid", F.concat("doc", F.lit("#"), "at"))
        refs = schemas.select("sid", reference(F.expr(_get("node", "$ref", "string")), F.col("doc")).alias("child"),
                              F.expr(f"{_get('node', '$ref')} IS NOT NULL").alias("has")).where("has")
        named = refs.select(F.col("child").alias("sid")).distinct().join(schemas, "sid", "left_anti")
        odd = (found.where("role <> 'schema'").withColumn("sid", F.concat("doc", F.lit("#"), "at")).join(named, "sid", "left_semi")
               .dropDuplicates(["sid"]).select("doc", "at", "node"))
        step += 1
        if odd.isEmpty():
            break
        walk(odd).where("role = 'schema'").write.parquet(f"{folder}/walk/step={step}")
    schemas = schemas.dropDuplicates(["sid"])
    edges = schemas.where("owner IS NOT NULL").select(F.concat("doc", F.lit("#"), "owner").alias("sid"), "kw", "name",
                                                      F.col("sid").alias("child"), F.expr(f"{_kind('node')} = 'BOOLEAN' AND NOT try_variant_get(node, '$', 'boolean')").alias("never"))
    used = edges.where("kw NOT IN ('$defs', 'definitions')")
    known = refs.join(schemas.select(F.col("sid").alias("child")), "child", "left_semi").select(
        "sid", F.lit("$ref").alias("kw"), F.lit(None).cast("string").alias("name"), "child", F.lit(False).alias("never"))
    used.unionByName(known).dropDuplicates(["sid", "kw", "name", "child"]).write.parquet(f"{folder}/edges")
    edges = spark.read.parquet(f"{folder}/edges")

    # references that lead nowhere, followed back to the documents that reach them
    dangling = refs.join(known.select("sid"), "sid", "left_anti").select("sid").distinct()
    if dangling.isEmpty():
        unresolved = dangling.select(F.col("sid").alias("uri"))
    else:
        unresolved = spark.sql(f"""
WITH RECURSIVE up(sid, seen) MAX RECURSION LEVEL {MAX_LEVELS} AS (
  SELECT sid, array(sid) FROM {{dangling}}
  UNION ALL
  SELECT e.sid, array_append(u.seen, e.sid) FROM up u JOIN {{edges}} e ON e.child = u.sid WHERE NOT array_contains(u.seen, e.sid))
SELECT DISTINCT substring_index(sid, '#', 1) AS uri FROM up WHERE sid LIKE '%#'""", dangling=dangling, edges=edges)
    unresolved.write.parquet(f"{folder}/unresolved")

    def keys(k: str) -> Column:
        return F.expr(f"coalesce(map_keys({_get('node', k, 'map<string,variant>')}), CAST(array() AS ARRAY<STRING>))")

    # a false schema for elements or other members is a test of their number
    followed = edges.where("NOT (never AND kw IN ('items', 'additionalProperties'))")
    listed = followed.groupBy("sid").agg(F.collect_list(F.struct("kw", "name", "child")).alias("edges"))
    branches = F.expr(f"{_get('node', 'if')} IS NOT NULL AND ({_get('node', 'then')} IS NOT NULL OR {_get('node', 'else')} IS NOT NULL)")
    (schemas.join(listed, "sid", "left").select(
        "sid", "node", F.expr("coalesce(map_keys(try_variant_get(node, '$', 'map<string,variant>')), CAST(array() AS ARRAY<STRING>))").alias("has"),
        keys("properties").alias("names"), keys("patternProperties").alias("patterns"),
        F.expr(f"coalesce(size({_get('node', 'prefixItems', 'array<variant>')}), 0)").alias("prefix"),
        F.expr(f"transform({_get('node', 'enum', 'array<variant>')}, e -> {canonical('e')})").alias("enum"),
        F.expr(f"CASE WHEN {_get('node', 'const')} IS NOT NULL THEN {canonical(_get('node', 'const'))} END").alias("const"),
        F.filter(F.coalesce("edges", F.expr("CAST(array() AS ARRAY<STRUCT<kw: STRING, name: STRING, child: STRING>>)")),
                 lambda e: ~e["kw"].isin("if", "then", "else") | branches).alias("edges"))
     .write.parquet(f"{folder}/nodes"))
    nodes = spark.read.parquet(f"{folder}/nodes")
    size = nodes.agg(F.sum(F.length(F.to_json("node")) + F.length("sid") + 64 * F.size("edges"))).first()[0] or 0
    whole, bytes_of_whole, steps, scopes, rest = _whole_documents(nodes, folder)
    return SchemaTable(nodes, spark.read.parquet(f"{folder}/unresolved"), size <= BROADCAST_BYTES,
                       whole, bytes_of_whole <= BROADCAST_BYTES, steps, scopes, rest)


#: Larger or deeper documents are not walked inside the rows of their payloads.
WHOLE_NODES, WHOLE_STEPS = 1000, 16


def _whole_documents(nodes: DataFrame, folder: str) -> tuple[DataFrame, int, int, int, bool]:
    """Documents whose edges stay inside and end after ``WHOLE_STEPS`` at most, written
    once, with their bytes, most steps, most scopes, and whether there are others."""
    named = nodes.withColumn("uri", F.substring_index("sid", "#", 1))
    sized = named.groupBy("uri").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length(F.to_json("node")) + F.length("sid") + 64 * F.size("edges")).alias("bytes"))
    fit = sized.where(F.col("n") <= WHOLE_NODES)
    listed = named.join(fit, "uri").groupBy("uri").agg(F.any_value("bytes").alias("bytes"), F.collect_list(F.struct(
        "sid", "node", "has", "names", "patterns", "prefix", "enum", "const", "edges")).alias("found"))
    listed = listed.withColumn("sids", F.expr("transform(found, f -> f.sid)"))
    listed = listed.select("uri", "bytes", F.expr("int(array_position(sids, concat(uri, '#')) - 1)").alias("root"), F.expr(
        "transform(found, f -> named_struct('node', f.node, 'has', f.has, 'names', f.names, 'patterns', f.patterns, 'prefix', f.prefix, 'enum', f.enum, "
        "'const', f.const, 'edges', transform(f.edges, e -> named_struct('kw', e.kw, 'name', e.name, 'child', int(array_position(sids, e.child) - 1)))))").alias("schemas"))
    # places are numbers: node * 64 + scopes on the way; an edge out of the document gives null, which stays null
    step = (f"flatten(transform(a.f, c -> transform(get(schemas, int(floor(c / 64))).edges, e -> "
            f"CASE WHEN e.child >= 0 THEN e.child * 64 + c % 64 + CASE WHEN e.kw IN {_in(_JUDGING)} THEN 1 ELSE 0 END END)))")
    ends = (f"aggregate(sequence(0, {WHOLE_STEPS}), named_struct('f', array(CASE WHEN root >= 0 THEN root * 64 END), 'n', 0, 'd', 0), (a, q) -> "
            f"transform(array({step}), g -> named_struct('f', array_distinct(g), 'n', a.n + CASE WHEN size(g) > 0 THEN 1 ELSE 0 END, "
            "'d', greatest(a.d, coalesce(array_max(transform(g, c -> c % 64)), 0))))[0])")
    (listed.withColumn("ends", F.expr(ends)).select("uri", "bytes", "root", "schemas", "ends.n", "ends.d", F.expr("coalesce(size(ends.f) = 0, false)").alias("whole"))
     .where("whole").write.parquet(f"{folder}/whole"))
    whole = nodes.sparkSession.read.parquet(f"{folder}/whole")
    most = whole.agg(F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0)), F.max("n"), F.max("d")).first()
    return whole.select("uri", "root", "schemas"), most[1], most[2] or 0, most[3] or 0, sized.count() > most[0]


# -- pairing values with schema nodes --------------------------------------------------

def _values() -> str:
    """SQL: the values edge ``e`` of node ``s`` applies to at value ``p.v``."""
    none = "CAST(array() AS ARRAY<STRUCT<step: STRING, pos: INT, name: STRING, v: VARIANT>>)"
    m, a = "try_variant_get(p.v, '$', 'map<string,variant>')", "try_variant_get(p.v, '$', 'array<variant>')"

    def one(step: str, v: str, name: str = "CAST(NULL AS STRING)", pos: str = "CAST(NULL AS INT)") -> str:
        return f"named_struct('step', {step}, 'pos', {pos}, 'name', {name}, 'v', {v})"

    def members(test: str) -> str:
        return f"transform(filter(map_entries({m}), x -> {test}), x -> {one(f"concat('/', {_step('x.key')})", 'x.value', 'x.key')})"

    def elements(first: str) -> str:
        return (f"filter(transform({a}, (x, i) -> {one("concat('/', CAST(i AS STRING))", 'x', pos='i')}), x -> x.pos >= {first})")

    return f"""coalesce(CASE
  WHEN e.kw IN {_in(_SAME_VALUE)} THEN array({one("''", 'p.v')})
  WHEN e.kw = 'dependentSchemas' THEN CASE WHEN map_contains_key({m}, e.name) THEN array({one("''", 'p.v')}) END
  WHEN e.kw = 'properties' THEN CASE WHEN map_contains_key({m}, e.name)
       THEN array({one(f"concat('/', {_step('e.name')})", f'{m}[e.name]', 'e.name')}) END
  WHEN e.kw = 'patternProperties' THEN {members('x.key RLIKE e.name')}
  WHEN e.kw = 'additionalProperties' THEN
       {members('NOT array_contains(s.names, x.key) AND NOT exists(s.patterns, q -> x.key RLIKE q)')}
  WHEN e.kw = 'propertyNames' THEN transform(map_keys({m}), x -> {one(f"concat('/@', {_step('x')})", 'CAST(x AS VARIANT)', 'x')})
  WHEN e.kw = 'items' THEN {elements('s.prefix')}
  WHEN e.kw = 'contains' THEN {elements('0')}
  WHEN e.kw = 'prefixItems' THEN filter({elements('0')}, x -> x.pos = int(e.name))
END, {none})"""


def _child(sid: str) -> dict[str, str]:
    """SQL: ``at``, ``label``, ``scope``, ``depth`` and ``judge`` of value ``c`` of edge ``e``
    of node ``s``, named by ``sid``, at pair ``p``."""
    inside = "concat(CASE WHEN p.label = '' THEN '' ELSE concat(p.label, '.') END, {})".format
    shown = "CASE WHEN p.label = '' THEN '$' ELSE p.label END"
    judging = f"e.kw IN {_in(_JUDGING)}"
    group = "CASE WHEN e.kw IN ('then', 'else') THEN 'if' ELSE e.kw END"
    return {
        "at": "CASE WHEN c.step = '' THEN p.at ELSE xxhash64(p.at, c.step) END",
        "label": f"""CASE WHEN e.kw = 'properties' THEN {inside('e.name')} WHEN e.kw IN ('patternProperties', 'additionalProperties') THEN {inside("'*'")}
         WHEN e.kw IN ('items', 'contains') THEN concat({shown}, '[]')
         WHEN e.kw = 'prefixItems' THEN concat({shown}, '[', e.name, ']') ELSE p.label END""",
        "scope": f"CASE WHEN {judging} THEN xxhash64(p.scope, p.at, {sid}, e.kw, coalesce(e.name, ''), c.step) ELSE p.scope END",
        "depth": f"p.depth + CASE WHEN {judging} THEN 1 ELSE 0 END",
        "judge": f"""CASE WHEN {judging} THEN named_struct('parent', p.scope, 'grp', xxhash64(p.scope, p.at, {sid}, {group}), 'kw', e.kw,
         'label', concat({group}, ':', {shown}), 'lo', coalesce({_get('s.node', 'minContains', 'double')}, 1.0D),
         'hi', {_get('s.node', 'maxContains', 'double')}) ELSE p.judge END"""}


_JUDGE = "STRUCT<parent: BIGINT, grp: BIGINT, kw: STRING, label: STRING, lo: DOUBLE, hi: DOUBLE>"


def _pairs_sql(hint: str) -> str:
    same, c = f"e.kw IN {_in(_SAME_VALUE)}", _child("p.sid")
    return f"""
WITH RECURSIVE pair(k, sid, v, at, label, scope, depth, judge, seen) MAX RECURSION LEVEL {MAX_LEVELS} AS (
  SELECT k, sid, v, 0L, '', 0L, 0, CAST(NULL AS {_JUDGE}),
    array(sid) FROM {{payloads}}
  UNION ALL
  SELECT {hint} p.k, e.child, c.v, {c['at']},
    {c['label']},
    {c['scope']},
    {c['depth']},
    {c['judge']},
    CASE WHEN {same} THEN array_append(p.seen, e.child) ELSE array(e.child) END
  FROM pair p JOIN {{nodes}} s ON s.sid = p.sid
  LATERAL VIEW explode(s.edges) edge AS e LATERAL VIEW explode({_values()}) value AS c
  WHERE NOT ({same} AND array_contains(p.seen, e.child)))
SELECT k, sid, v, label, scope, depth, judge FROM pair"""


def _own_errors(assert_email: bool, by_keyword: bool = False) -> str:
    """SQL: labels of the keywords of ``node`` that value ``v`` violates by itself.

    ``by_keyword`` goes through the keywords that the node has and evaluates their
    tests only (arrays in a row are not compiled); otherwise every test has its column."""
    def label(kw: str) -> str:
        return f"concat('{kw}:', shown)"

    def when(kw: str, bad: str, at: str | None = None) -> str:
        if by_keyword:
            return f"WHEN '{kw}' THEN CASE WHEN {bad} THEN {at or label(kw)} END"
        return f"CASE WHEN array_contains(has, '{kw}') AND {bad} THEN {at or label(kw)} END"

    def bound(k: str, test: str) -> str:
        exact, rough = _get("node", k, "decimal(38,18)"), _get("node", k, "double")
        return f"is_num AND NOT CASE WHEN dec IS NOT NULL AND {exact} IS NOT NULL THEN dec {test} {exact} ELSE dbl {test} {rough} END"

    def inside(name: str) -> str:
        return f"concat(CASE WHEN label = '' THEN '' ELSE concat(label, '.') END, {name})"

    match = ("CASE n WHEN 'string' THEN kind = 'STRING' WHEN 'boolean' THEN kind = 'BOOLEAN' WHEN 'null' THEN kind = 'VOID' "
             "WHEN 'array' THEN kind = 'ARRAY' WHEN 'object' THEN kind = 'OBJECT' WHEN 'number' THEN is_num "
             "WHEN 'integer' THEN is_num AND coalesce(dec = floor(dec), dbl % 1.0D = 0.0D) ELSE false END")
    kinds = (f"CASE WHEN {_kind(_get('node', 'type'))} = 'STRING' THEN array({_get('node', 'type', 'string')}) "
             f"ELSE {_get('node', 'type', 'array<string>')} END")
    exact, rough = _get("node", "multipleOf", "decimal(38,18)"), _get("node", "multipleOf", "double")
    size = {"minLength": "length(str)", "maxLength": "length(str)", "minItems": "size(arr)", "maxItems": "size(arr)",
            "minProperties": "size(obj)", "maxProperties": "size(obj)"}
    holder = {"L": "str", "I": "arr", "P": "obj"}
    never = "{0} IS NOT NULL AND schema_of_variant({0}) = 'BOOLEAN' AND NOT try_variant_get({0}, '$', 'boolean')".format
    checks = [
        f"CASE WHEN {never('node')} THEN {label('false')} END", when("type", f"NOT exists({kinds}, n -> {match})"),
        when("enum", f"NOT array_contains(enum, {canonical('v')})"), when("const", f"const <> {canonical('v')}"),
        *[when(k, bound(k, t)) for k, t in zip(NUMBERS, (">=", "<=", ">", "<"))],
        when("multipleOf", f"is_num AND CASE WHEN dec IS NOT NULL AND {exact} > 0 THEN dec % {exact} <> 0 ELSE dbl % {rough} <> 0 END"),
        *[when(k, f"{holder[k[3]]} IS NOT NULL AND NOT {s} {'>=' if k[:3] == 'min' else '<='} {_get('node', k, 'double')}") for k, s in size.items()],
        when("pattern", f"str IS NOT NULL AND NOT str RLIKE {_get('node', 'pattern', 'string')}"),
        *([when("format", f"{_get('node', 'format', 'string')} = 'email' AND str IS NOT NULL AND NOT str RLIKE {literal(EMAIL_SHAPE)}")]
          if assert_email else []),
        when("uniqueItems", f"{_get('node', 'uniqueItems', 'boolean')} AND size(array_distinct(transform(arr, u -> {canonical('u')}))) < size(arr)"),
        when("items", f"size(arr) > prefix AND {never(_get('node', 'items'))}", "concat('items:', shown, '[]')"),
        when("contains", f"{_get('node', 'contains')} IS NOT NULL AND size(arr) = 0 AND coalesce({_get('node', 'minContains', 'double')}, 1.0D) > 0"),
        when("additionalProperties", f"{never(_get('node', 'additionalProperties'))} AND exists(map_keys(obj), "
                                     "x -> NOT array_contains(names, x) AND NOT exists(patterns, q -> x RLIKE q))")]
    required = (f"CASE WHEN array_contains(has, 'required') THEN transform(filter({_get('node', 'required', 'array<string>')}, r -> NOT map_contains_key(obj, r)), "
                f"r -> concat('required:', {inside('r')})) END")
    depend = (f"CASE WHEN array_contains(has, 'dependentRequired') THEN transform(filter(flatten(map_values(map_filter({_get('node', 'dependentRequired', 'map<string,array<string>>')}, "
              f"(t, n) -> map_contains_key(obj, t)))), r -> NOT map_contains_key(obj, r)), r -> concat('dependentRequired:', {inside('r')})) END")
    empty = "CAST(array() AS ARRAY<STRING>)"
    if by_keyword:
        found = f"transform(has, kw -> CASE kw {' '.join(checks[1:])} END)"
        return (f"concat(array_compact(CASE WHEN size(has) = 0 THEN array({checks[0]}) ELSE {found} END), "
                f"coalesce({required}, {empty}), coalesce({depend}, {empty}))")
    return f"concat(array_compact(array({', '.join(checks)})), coalesce({required}, {empty}), coalesce({depend}, {empty}))"


def _tested(pairs: DataFrame, nodes: DataFrame, assert_email: bool) -> DataFrame:
    """``(k, scope, depth, judge, errors)``: every pair with the labels of its own keywords."""
    typed = pairs.join(nodes.select("sid", "node", "has", "names", "patterns", "prefix", "enum", "const"), "sid").select(
        "*", F.expr("CASE WHEN label = '' THEN '$' ELSE label END AS shown"),
        F.expr("try_variant_get(v, '$', 'map<string,variant>') AS obj"), F.expr("try_variant_get(v, '$', 'array<variant>') AS arr"))
    typed = typed.withColumn("kind", F.expr("CASE WHEN obj IS NOT NULL THEN 'OBJECT' WHEN arr IS NOT NULL THEN 'ARRAY' ELSE schema_of_variant(v) END"))
    typed = typed.withColumn("is_num", F.expr("kind IN ('BIGINT', 'DOUBLE', 'FLOAT') OR kind LIKE 'DECIMAL%'"))
    typed = typed.select("*", F.expr("CASE WHEN kind = 'STRING' THEN try_variant_get(v, '$', 'string') END AS str"),
                         F.expr("CASE WHEN is_num THEN try_variant_get(v, '$', 'decimal(38,18)') END AS dec"),
                         F.expr("CASE WHEN is_num THEN try_variant_get(v, '$', 'double') END AS dbl"))
    return typed.select("k", "scope", "depth", "judge", F.expr(_own_errors(assert_email)).alias("errors"))


#: When the judgement of a group of scopes, some of them bad, is an error.
_FAILED = """CASE any_value(judge.kw)
  WHEN 'anyOf' THEN count_if(NOT bad) = 0 WHEN 'oneOf' THEN count_if(NOT bad) <> 1 WHEN 'not' THEN count_if(NOT bad) > 0
  WHEN 'propertyNames' THEN count_if(bad) > 0
  WHEN 'contains' THEN count_if(NOT bad) < any_value(judge.lo) OR count_if(NOT bad) > coalesce(any_value(judge.hi), double('infinity'))
  ELSE CASE WHEN bool_or(judge.kw = 'if' AND NOT bad) THEN bool_or(judge.kw = 'then' AND bad) ELSE bool_or(judge.kw = 'else' AND bad) END END"""


def violations(payloads: DataFrame, table: SchemaTable, assert_email: bool = False) -> DataFrame | None:
    """``(k, errors)`` of payloads ``(k, sid, v)`` that violate their schema; None if
    no payload does.

    Payloads of equal ``k`` must be equal.  Labels are sorted and distinct.  The pairs
    are worked out when this is called, as the fold needs the depth of the scopes.
    """
    spark = configure(payloads.sparkSession)
    nodes = F.broadcast(table.nodes) if table.small else table.nodes
    pairs = spark.sql(_pairs_sql("/*+ BROADCAST(s) */" if table.small else ""), payloads=payloads, nodes=table.nodes)
    folder = new_run_dir(spark, "pairs")
    tested = _tested(pairs, nodes, assert_email)
    # pairs outside any judgement matter only with an error
    tested.where("depth > 0 OR size(errors) > 0").write.parquet(folder)
    tested = spark.read.schema(tested.schema).parquet(folder)
    deepest = tested.agg(F.max("depth")).first()[0]
    if deepest is None:
        return None
    failed = None  # (k, scope, label) of the judgements one level deeper
    for depth in range(deepest, 0, -1):
        rows = tested.where(F.col("depth") == depth).select("k", "scope", "judge", (F.size("errors") > 0).alias("bad"))
        if failed is not None:
            rows = rows.unionByName(failed.select("k", "scope", F.lit(None).cast(rows.schema["judge"].dataType).alias("judge"), F.lit(True).alias("bad")))
        scopes = rows.groupBy("k", "scope").agg(F.any_value("judge", F.lit(True)).alias("judge"), F.bool_or("bad").alias("bad"))
        groups = scopes.groupBy("k", F.col("judge.parent").alias("scope"), F.col("judge.grp").alias("grp")).agg(
            F.any_value("judge.label").alias("label"), F.expr(f"{_FAILED} AS failed"))
        failed = groups.where("failed").select("k", "scope", "label")
    labels = tested.where("depth = 0").select("k", F.explode("errors").alias("label"))
    if failed is not None:
        labels = labels.unionByName(failed.select("k", "label"))
    return labels.groupBy("k").agg(F.array_sort(F.collect_set("label")).alias("errors"))


# -- pairs inside the rows -------------------------------------------------------------

def _runs(x: DataFrame, rows: str, same: tuple[str, ...], out: str) -> DataFrame:
    """``x`` with ``out``: the array ``rows``, sorted and cut into runs that agree in the fields ``same``."""
    differs = " OR ".join(f"get(__sorted, i - 1).{f} <> get(__sorted, i).{f}" for f in same)
    x = x.withColumn("__sorted", F.expr(f"sort_array({rows})"))
    x = x.withColumn("__starts", F.expr(f"filter(CASE WHEN size(__sorted) > 0 THEN sequence(0, size(__sorted) - 1) ELSE CAST(array() AS ARRAY<INT>) END, i -> i = 0 OR {differs})"))
    return x.withColumn(out, F.expr("transform(__starts, (a, j) -> slice(__sorted, a + 1, coalesce(get(__starts, j + 1), size(__sorted)) - a))"))


def _fold_inside(x: DataFrame, depth: int) -> DataFrame:
    """``__failed`` of the judgements at ``depth``, from ``__failed`` of those one level deeper."""
    rows = (f"concat(transform(filter(__tested, t -> t.depth = {depth}), t -> named_struct('scope', t.scope, 'judge', t.judge, 'bad', size(t.errors) > 0)), "
            f"transform(__failed, f -> named_struct('scope', f.scope, 'judge', CAST(NULL AS {_JUDGE}), 'bad', true)))")
    x = _runs(x, rows, ("scope",), "__scopes")
    x = x.withColumn("__scopes", F.expr("transform(__scopes, g -> named_struct('judge', element_at(g, -1).judge, 'bad', exists(g, r -> r.bad)))"))
    groups = "transform(__scopes, h -> named_struct('parent', h.judge.parent, 'grp', h.judge.grp, 'judge', h.judge, 'bad', h.bad))"
    x = _runs(x, groups, ("parent", "grp"), "__groups")
    good, bad, some = "size(filter(g, r -> NOT r.bad))", "size(filter(g, r -> r.bad))", "exists(g, r -> r.judge.kw = '{}' AND {}r.bad)".format
    fails = f"""CASE g[0].judge.kw
  WHEN 'anyOf' THEN {good} = 0 WHEN 'oneOf' THEN {good} <> 1 WHEN 'not' THEN {good} > 0 WHEN 'propertyNames' THEN {bad} > 0
  WHEN 'contains' THEN {good} < g[0].judge.lo OR {good} > coalesce(g[0].judge.hi, double('infinity'))
  ELSE CASE WHEN {some('if', 'NOT ')} THEN {some('then', '')} ELSE {some('else', '')} END END"""
    return x.withColumn("__failed", F.expr(
        f"transform(filter(__groups, g -> {fails}), g -> named_struct('scope', g[0].parent, 'label', g[0].judge.label))"))


_SCHEMA = "get(__schemas, p.i)"
#: What ``_own_errors`` reads, for pair ``p``; evaluated where a test needs it.
_OF_PAIR = {"v": "p.v", "label": "p.label", "shown": "(CASE WHEN p.label = '' THEN '$' ELSE p.label END)",
            **{f: f"{_SCHEMA}.{f}" for f in ("node", "has", "names", "patterns", "prefix", "enum", "const")},
            "obj": "try_variant_get(p.v, '$', 'map<string,variant>')", "arr": "try_variant_get(p.v, '$', 'array<variant>')",
            "kind": "regexp_extract(schema_of_variant(p.v), '^[A-Z]*', 0)", "is_num": _is_number("p.v")}
_OF_PAIR |= {"str": "(CASE WHEN schema_of_variant(p.v) = 'STRING' THEN try_variant_get(p.v, '$', 'string') END)",
             "dec": f"(CASE WHEN {_OF_PAIR['is_num']} THEN try_variant_get(p.v, '$', 'decimal(38,18)') END)",
             "dbl": f"(CASE WHEN {_OF_PAIR['is_num']} THEN try_variant_get(p.v, '$', 'double') END)"}


def _of_pair(sql: str) -> str:
    """``sql`` with its columns taken from pair ``p``; texts in quotes stay."""
    parts = re.split(r"('(?:[^'\\]|\\.)*')", sql)
    names = "|".join(_OF_PAIR)
    return "".join(t if i % 2 else re.sub(rf"(?<![\w.])({names})\b(?!\s*\()", lambda m: _OF_PAIR[m[1]], t) for i, t in enumerate(parts))


def errors_inside(payloads: DataFrame, v: str, table: SchemaTable, assert_email: bool, out: str) -> DataFrame:
    """``payloads`` joined to its document of ``table.whole`` (``__root``, ``__schemas``)
    with ``out``: the sorted labels of what value ``v`` violates, null where it is null.

    Pairs, tests and the fold of the scopes are those of ``violations``, in arrays of
    the payload's own row: nothing is written, and no pair goes through a shuffle."""
    own = f"STRUCT<i: INT, v: VARIANT, at: BIGINT, label: STRING, scope: BIGINT, depth: INT, judge: {_JUDGE}>"
    first = f"named_struct('i', __root, 'v', {v}, 'at', 0L, 'label', '', 'scope', 0L, 'depth', 0, 'judge', CAST(NULL AS {_JUDGE}))"
    c = {"i": "e.child", "v": "c.v", **_child("p.i")}
    below = "named_struct(" + ", ".join(f"'{k}', {c[k]}" for k in ("i", "v", "at", "label", "scope", "depth", "judge")) + ")"
    pairs = [f"__pairs_{n}" for n in range(table.steps + 1)]
    step = re.sub(r"\bs\.", f"{_SCHEMA}.", f"flatten(transform(s.edges, e -> transform({_values()}, c -> {below})))")
    x = payloads.withColumn(pairs[0], F.expr(f"CASE WHEN {v} IS NOT NULL THEN array({first}) ELSE CAST(array() AS ARRAY<{own}>) END"))
    for last, here in zip(pairs, pairs[1:]):
        x = x.withColumn(here, F.expr(f"flatten(transform({last}, p -> {step}))"))
    errors = _of_pair(_own_errors(assert_email, by_keyword=True))
    x = x.withColumn("__tested", F.expr(f"transform(concat({', '.join(pairs)}), p -> named_struct('scope', p.scope, 'depth', p.depth, 'judge', p.judge, 'errors', {errors}))"))
    x = x.withColumn("__tested", F.expr("filter(__tested, t -> t.depth > 0 OR size(t.errors) > 0)"))
    x = x.withColumn("__failed", F.expr("CAST(array() AS ARRAY<STRUCT<scope: BIGINT, label: STRING>>)"))
    for depth in range(table.scopes, 0, -1):
        x = _fold_inside(x, depth)
    labels = "concat(flatten(transform(filter(__tested, t -> t.depth = 0), t -> t.errors)), transform(__failed, f -> f.label))"
    return x.select(*payloads.columns, F.expr(f"CASE WHEN {v} IS NOT NULL THEN array_sort(array_distinct({labels})) END").alias(out))
