"""DuckDB SQL twins of the registered queries (tables pre-registered as views).

Payload text is rebuilt with the same ``concat`` as ``sluice.sources.testdata``
so both engines see byte-identical JSON.
"""

from __future__ import annotations

BASE = "http://schema-repository:8080/schemas"
ORDER_V2 = f"{BASE}/order/2.0.0"
UNKNOWN = f"{BASE}/nope/1.0.0"


# -- JSON Schema checks in DuckDB terms -------------------------------------

def _is_int(j: str, path: str) -> str:
    t = f"json_type({j}, '{path}')"
    return (f"({t} IN ('UBIGINT','BIGINT','HUGEINT') OR ({t} = 'DOUBLE' AND "
            f"TRY_CAST(json_extract({j}, '{path}') AS DOUBLE) = floor(TRY_CAST(json_extract({j}, '{path}') AS DOUBLE))))")


def _is_num(j: str, path: str) -> str:
    return f"(json_type({j}, '{path}') IN ('UBIGINT','BIGINT','HUGEINT','DOUBLE'))"


def _is_str(j: str, path: str) -> str:
    return f"(json_type({j}, '{path}') = 'VARCHAR')"


def _present(j: str, path: str) -> str:
    return f"(json_type({j}, '{path}') IS NOT NULL)"


def _items_int(j: str, path: str) -> str:
    return (f"coalesce(list_bool_and(list_transform(json_extract({j}, '{path}[*]'), "
            f"lambda x: json_type(x) IN ('UBIGINT','BIGINT','HUGEINT') OR (json_type(x) = 'DOUBLE' "
            f"AND TRY_CAST(x AS DOUBLE) = floor(TRY_CAST(x AS DOUBLE))))), true)")


def _items_str(j: str, path: str) -> str:
    return (f"coalesce(list_bool_and(list_transform(json_extract({j}, '{path}[*]'), "
            f"lambda x: json_type(x) = 'VARCHAR')), true)")


def _err(cond_ok: str, label: str) -> str:
    return f"CASE WHEN NOT coalesce({cond_ok}, true) THEN '{label}' END"


def _errors(j: str, checks: list[tuple[str, str]]) -> str:
    items = ", ".join(_err(c, lbl) for lbl, c in checks)
    return f"array_to_string(list_sort(list_filter([{items}], lambda x: x IS NOT NULL)), ',')"


def _opt(j: str, path: str, cond: str) -> str:
    return f"(NOT {_present(j, path)} OR {cond})"


def order_v2_checks(j: str) -> list[tuple[str, str]]:
    st = "$.status"
    return [
        ("type:$", f"(json_type({j}) = 'OBJECT')"),
        ("type:orderId", _opt(j, "$.orderId", _is_int(j, "$.orderId"))),
        ("type:userId", _opt(j, "$.userId", _is_int(j, "$.userId"))),
        ("type:productIds", _opt(j, "$.productIds", f"json_type({j}, '$.productIds') = 'ARRAY'")),
        ("type:productIds[]", _items_int(j, "$.productIds")),
        ("type:total", _opt(j, "$.total", _is_num(j, "$.total"))),
        ("type:status", _opt(j, st, _is_str(j, st))),
        ("enum:status", _opt(j, st, f"({_is_str(j, st)} AND json_extract_string({j}, '{st}') "
                                    "IN ('pending','shipped','delivered','cancelled'))")),
        ("required:orderId", _present(j, "$.orderId")),
        ("required:userId", _present(j, "$.userId")),
        ("required:productIds", _present(j, "$.productIds")),
        ("required:total", _present(j, "$.total")),
    ]


ORDER_MESSAGES = f"""
  SELECT o_orderkey AS "offset", o_orderdate AS ts,
    CASE WHEN o_orderkey % 20 = 3 THEN '' WHEN o_orderkey % 20 = 4 THEN '{UNKNOWN}'
         ELSE '{ORDER_V2}' END AS schemaURI,
    CASE o_orderkey % 20
      WHEN 0 THEN '{{"orderId":' || o_orderkey
      WHEN 1 THEN '{{"orderId":' || o_orderkey || ',"userId":' || o_custkey || ',"productIds":null,"total":1.5}}'
      WHEN 2 THEN '{{"orderId":"' || o_orderkey || '","userId":' || o_custkey || ',"productIds":[1],"total":1.5}}'
      WHEN 5 THEN '{{"orderId":' || o_orderkey || ',"userId":' || o_custkey || ',"productIds":[1]}}'
      ELSE '{{"orderId":' || o_orderkey || ',"userId":' || o_custkey || ',"productIds":[' || (o_custkey % 2000)
           || '],"total":' || CAST(round(o_totalprice) AS BIGINT) || ',"status":"'
           || CASE o_orderstatus WHEN 'O' THEN 'pending' WHEN 'F' THEN 'delivered' ELSE 'partial' END || '"}}'
    END AS data
  FROM orders"""


def validated_orders_sql() -> str:
    """Per-record outcome of the order messages (the flagship's oracle)."""
    j = "j"
    return f"""
WITH m AS ({ORDER_MESSAGES}),
p AS (SELECT *, CASE WHEN json_valid(data) THEN data END AS j FROM m),
e AS (
  SELECT "offset", schemaURI, j,
    CASE WHEN schemaURI = '{ORDER_V2}' AND j IS NOT NULL THEN {_errors(j, order_v2_checks(j))} END AS errors
  FROM p),
r AS (
  SELECT "offset", schemaURI, errors,
    CASE WHEN schemaURI = '' THEN 'missing_schema_uri'
         WHEN schemaURI <> '{ORDER_V2}' THEN 'schema_not_found'
         WHEN j IS NULL THEN 'invalid_json'
         WHEN errors <> '' THEN 'schema_violation'
         ELSE 'ok' END AS reason
  FROM e)
SELECT "offset", schemaURI,
  CASE reason WHEN 'ok' THEN 'valid' WHEN 'schema_violation' THEN 'invalid' ELSE 'error' END AS status,
  reason, coalesce(errors, '') AS errors
FROM r"""


ORACLE: dict[str, str] = {}
ORACLE["q06_validate_status"] = validated_orders_sql()


# -- the other queries --------------------------------------------------------

def _ts(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%dT%H:%M:%SZ')"


def _check_list(checks: list[tuple[str, str]]) -> str:
    return _errors("j", checks)


def _status_sql(uri_ok: str, checks: list[tuple[str, str]], keycol: str, src: str) -> str:
    """Generic outcome select over ``src`` rows having ``data`` (all URIs known)."""
    return f"""
WITH p AS (SELECT *, CASE WHEN json_valid(data) THEN data END AS j FROM ({src})),
e AS (SELECT {keycol}, j, CASE WHEN j IS NOT NULL THEN {_check_list(checks)} END AS errors FROM p)
SELECT {keycol},
  CASE WHEN j IS NULL THEN 'error' WHEN errors <> '' THEN 'invalid' ELSE 'valid' END AS status,
  CASE WHEN j IS NULL THEN 'invalid_json' WHEN errors <> '' THEN 'schema_violation' ELSE 'ok' END AS reason,
  coalesce(errors, '') AS errors
FROM e"""


def _int_prop(name: str) -> tuple[str, str]:
    return (f"type:{name}", _opt("j", f"$.{name}", _is_int("j", f"$.{name}")))


def _num_prop(name: str) -> tuple[str, str]:
    return (f"type:{name}", _opt("j", f"$.{name}", _is_num("j", f"$.{name}")))


def _str_prop(name: str) -> tuple[str, str]:
    return (f"type:{name}", _opt("j", f"$.{name}", _is_str("j", f"$.{name}")))


def _req(name: str) -> tuple[str, str]:
    return (f"required:{name}", _present("j", f"$.{name}"))


ROOT_OBJ = ("type:$", "(json_type(j) = 'OBJECT')")

EVENT_ENVELOPES = f"""
  SELECT event_id, event_type || '-topic' AS origin,
    '{BASE}/' || event_type || '/1.0.0' AS schemaURI, ts, props AS data
  FROM events"""

BUFFER_ENTRIES = f"""
  SELECT CAST(epoch_us(ts) // 1000 AS VARCHAR) || '-' || event_id AS id, event_id AS seq,
    origin, schemaURI, ts, data FROM ({EVENT_ENVELOPES})"""

ORACLE["q01_record_to_envelope"] = f"""
SELECT event_id AS "offset", CAST(user_id % 10 AS INTEGER) AS "partition",
  event_type || '-topic' AS origin,
  CASE WHEN event_id % 4 IN (1, 2) THEN '{BASE}/' || event_type || '/1.0.0' ELSE '' END AS schemaURI,
  {_ts('ts')} AS "timestamp", props AS data
FROM events"""

ORACLE["q02_route_names"] = f"""
WITH u AS (
  SELECT event_id, event_type || '-topic' AS topic,
    CASE event_id % 3
      WHEN 0 THEN '{BASE}/' || event_type || '/1.0.0'
      WHEN 1 THEN '{BASE}/' || event_type
      ELSE '{BASE}/' || event_type || '/' || (user_id % 5) || '.' || (event_id % 7) END AS uri
  FROM events)
SELECT event_id, topic, uri,
  regexp_extract(uri, '/schemas/([^/]+)/([^/]+)$', 1) AS name,
  regexp_extract(uri, '/schemas/([^/]+)/([^/]+)$', 2) AS version
FROM u"""

ORACLE["q03_semver_parse"] = r"""
WITH t AS (
  SELECT p_partkey, CASE p_partkey % 8
      WHEN 0 THEN CAST(p_size AS VARCHAR)
      WHEN 1 THEN p_size || '.' || (p_partkey % 1030)
      WHEN 2 THEN '0' || p_size || '.0.' || (p_partkey % 7)
      WHEN 3 THEN p_size || '.'
      WHEN 4 THEN p_size || '.1.2.3'
      WHEN 5 THEN '-' || p_size
      WHEN 6 THEN CAST(p_partkey * 3 AS VARCHAR)
      ELSE p_size || '_0' END AS version_in
  FROM part),
p AS (
  SELECT *, regexp_full_match(version_in, '[0-9]+(\.[0-9]+){0,2}') AS shape,
    TRY_CAST(coalesce(nullif(split_part(version_in, '.', 1), ''), '0') AS HUGEINT) AS a,
    TRY_CAST(coalesce(nullif(split_part(version_in, '.', 2), ''), '0') AS HUGEINT) AS b,
    TRY_CAST(coalesce(nullif(split_part(version_in, '.', 3), ''), '0') AS HUGEINT) AS c
  FROM t),
q AS (SELECT *, coalesce(shape AND a <= 1023 AND b <= 1023 AND c <= 1023, false) AS ok FROM p)
SELECT p_partkey, version_in, CAST(ok AS INTEGER) AS ok,
  CAST(CASE WHEN ok THEN a ELSE -1 END AS INTEGER) AS major,
  CAST(CASE WHEN ok THEN b ELSE -1 END AS INTEGER) AS minor,
  CAST(CASE WHEN ok THEN c ELSE -1 END AS INTEGER) AS patch,
  CASE WHEN ok THEN a || '.' || b || '.' || c ELSE '' END AS version,
  CASE WHEN ok THEN 'schema:part:' || a || '.' || b || '.' || c ELSE '' END AS "key"
FROM q"""

CHANGE_LOG = """
  SELECT o_orderkey AS seq, CASE WHEN o_orderstatus = 'P' THEN 'del' ELSE 'set' END AS op,
    's' || (o_custkey % 50) AS name,
    CASE WHEN o_orderkey % 2 = 0 THEN '1.' || (o_custkey % 3) ELSE '1.' || (o_custkey % 3) || '.0' END AS version,
    '1.' || (o_custkey % 3) || '.0' AS norm_version,
    '{"type":"object","title":"v' || o_orderkey || '"}' AS schema
  FROM orders"""

ORACLE["q04_registry_fold"] = f"""
WITH l AS ({CHANGE_LOG}),
k AS (SELECT *, 'schema:' || name || ':' || norm_version AS "key" FROM l),
g AS (SELECT "key", arg_max(op, seq) AS op, arg_max(name, seq) AS name,
        arg_max(norm_version, seq) AS version, arg_max(schema, seq) AS schema
      FROM k GROUP BY "key")
SELECT "key", name, version, '{BASE}/' || name || '/' || version AS schemaURI, schema
FROM g WHERE op = 'set'"""


def _admissible(raw: str) -> str:
    names = "('string','integer','number','boolean','null','array','object')"
    s = f"(CASE WHEN json_valid({raw}) THEN {raw} END)"
    return f"""coalesce(json_valid({raw}) AND (json_type({s}) = 'BOOLEAN' OR (json_type({s}) = 'OBJECT'
  AND (json_type({s}, '$.type') IS NULL
       OR (json_type({s}, '$.type') = 'VARCHAR' AND json_extract_string({s}, '$.type') IN {names})
       OR (json_type({s}, '$.type') = 'ARRAY' AND coalesce(list_bool_and(list_transform(
             json_extract({s}, '$.type[*]'), lambda x: json_type(x) = 'VARCHAR'
             AND json_extract_string(x, '$') IN {names})), true)))
  AND (json_type({s}, '$.properties') IS NULL OR json_type({s}, '$.properties') = 'OBJECT')
  AND (json_type({s}, '$.required') IS NULL OR (json_type({s}, '$.required') = 'ARRAY'
       AND coalesce(list_bool_and(list_transform(json_extract({s}, '$.required[*]'),
             lambda x: json_type(x) = 'VARCHAR')), true)))
  AND (json_type({s}, '$.enum') IS NULL OR json_type({s}, '$.enum') = 'ARRAY')
  AND (json_type({s}, '$.items') IS NULL OR json_type({s}, '$.items') IN ('OBJECT', 'BOOLEAN')))), false)"""


ORACLE["q05_registry_requests"] = f"""
WITH l AS ({CHANGE_LOG}),
r AS (
  SELECT seq, CASE WHEN op = 'del' THEN 'del' WHEN seq % 2 = 0 THEN 'add' ELSE 'get' END AS op, name,
    CASE WHEN seq % 89 = 0 THEN 'invalid' ELSE version END AS version, norm_version,
    CASE WHEN seq % 97 = 0 THEN '{{"type":"object"' WHEN seq % 97 = 1 THEN '{{"type":"objekt"}}' ELSE schema END AS schema
  FROM l),
k AS (
  SELECT *, version <> 'invalid' AS key_ok,
    CASE WHEN version <> 'invalid' THEN 'schema:' || name || ':' || norm_version END AS "key"
  FROM r),
c AS (
  SELECT *, (op = 'add' AND key_ok AND {_admissible('schema')}) AS good_add FROM k),
d AS (
  SELECT *, CASE WHEN good_add THEN {{'op': 'set', 'schema': schema}}
                 WHEN op = 'del' AND key_ok THEN {{'op': 'del', 'schema': NULL}} END AS change
  FROM c),
w AS (
  SELECT *, last_value(change IGNORE NULLS) OVER (PARTITION BY "key" ORDER BY seq
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev
  FROM d)
SELECT seq, op, coalesce("key", '') AS "key",
  CASE WHEN NOT key_ok OR (op = 'add' AND NOT good_add) THEN 'bad_request'
       WHEN op = 'add' THEN 'created'
       WHEN op = 'get' AND prev.op = 'set' THEN 'ok'
       WHEN op = 'del' AND prev.op = 'set' THEN 'deleted'
       ELSE 'not_found' END AS outcome,
  CASE WHEN key_ok AND op = 'get' AND prev.op = 'set' THEN prev.schema ELSE '' END AS schema
FROM w"""

ORACLE["q07_validate_errors"] = f"""
SELECT violation, count(*) AS n FROM (
  SELECT unnest(string_split(errors, ',')) AS violation
  FROM ({validated_orders_sql()}) WHERE status = 'invalid')
GROUP BY violation"""

ORACLE["q08_type_matrix"] = """
WITH t AS (
  SELECT event_id, CASE event_id % 10
      WHEN 0 THEN CAST(user_id AS VARCHAR)
      WHEN 1 THEN user_id || '.0'
      WHEN 2 THEN user_id || '.5'
      WHEN 3 THEN user_id || 'e2'
      WHEN 4 THEN '"' || user_id || '"'
      WHEN 5 THEN 'null'
      WHEN 6 THEN CASE WHEN event_id % 20 = 6 THEN 'true' ELSE 'false' END
      WHEN 7 THEN '[' || user_id || ']'
      WHEN 8 THEN '{"k":' || user_id || '}'
      ELSE '-' || user_id END AS json
  FROM events),
y AS (SELECT *, json_type(json) AS t FROM t)
SELECT event_id, json,
  CAST(t = 'VARCHAR' AS INTEGER) AS is_string,
  CAST(t IN ('UBIGINT', 'BIGINT') OR (t = 'DOUBLE' AND TRY_CAST(json AS DOUBLE) = floor(TRY_CAST(json AS DOUBLE))) AS INTEGER) AS is_integer,
  CAST(t IN ('UBIGINT', 'BIGINT', 'DOUBLE') AS INTEGER) AS is_number,
  CAST(t = 'BOOLEAN' AS INTEGER) AS is_boolean,
  CAST(t = 'NULL' AS INTEGER) AS is_null,
  CAST(t = 'ARRAY' AS INTEGER) AS is_array,
  CAST(t = 'OBJECT' AS INTEGER) AS is_object
FROM y"""

PAYMENT_MESSAGES = """
  SELECT o_orderkey, o_orderkey % 10 AS "partition", 'payment-topic' AS origin,
    '{"paymentId":' || (o_orderkey * 10) || ',"orderId":' || o_orderkey || ',"amount":'
    || CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) || ',"method":"card"'
    || CASE WHEN o_orderkey % 13 = 0 THEN ',"status":null'
            WHEN o_orderpriority = '1-URGENT' THEN ',"status":"pending"'
            WHEN o_orderpriority = '2-HIGH' THEN ',"status":"completed"'
            WHEN o_orderpriority = '3-MEDIUM' THEN ',"status":"failed"'
            WHEN o_orderpriority = '4-NOT SPECIFIED' THEN ',"status":"unknown"'
            ELSE '' END || '}' AS data
  FROM orders"""

PAYMENT_V2_CHECKS = [
    ROOT_OBJ, _int_prop("paymentId"), _int_prop("orderId"), _num_prop("amount"), _str_prop("method"),
    _str_prop("status"),
    ("enum:status", _opt("j", "$.status", "(" + _is_str("j", "$.status")
                         + " AND json_extract_string(j, '$.status') IN ('pending','completed','failed'))")),
    _req("paymentId"), _req("orderId"), _req("amount"), _req("method"),
]

ORACLE["q09_enum_status"] = _status_sql("", PAYMENT_V2_CHECKS, "o_orderkey", PAYMENT_MESSAGES)


def product_messages(version: int) -> str:
    tags = ""
    if version == 2:
        tags = """ || CASE WHEN p_partkey % 4 = 0 THEN '' ELSE ',"tags":["' || p_brand || '","size-' || p_size || '"]' END"""
    return f"""
  SELECT p_partkey, p_partkey % 10 AS "partition", 'product-topic' AS origin,
    '{{"id":' || p_partkey
    || CASE WHEN p_partkey % 11 = 0 THEN '' ELSE ',"name":"' || p_name || '"' END
    || CASE WHEN p_partkey % 13 = 0 THEN ',"price":"' || p_retailprice || '"' ELSE ',"price":' || p_retailprice END
    || CASE WHEN p_partkey % 3 = 0 THEN '' WHEN p_partkey % 3 = 1 THEN ',"category":null'
            ELSE ',"category":"' || p_type || '"' END{tags} || '}}' AS data
  FROM part"""


PRODUCT_V1_CHECKS = [ROOT_OBJ, _int_prop("id"), _str_prop("name"), _num_prop("price"), _str_prop("category"),
                     _req("id"), _req("name"), _req("price")]
PRODUCT_V2_CHECKS = PRODUCT_V1_CHECKS + [
    ("type:tags", _opt("j", "$.tags", "json_type(j, '$.tags') = 'ARRAY'")),
    ("type:tags[]", _items_str("j", "$.tags")),
]

ORACLE["q10_required_null"] = _status_sql("", PRODUCT_V1_CHECKS, "p_partkey", product_messages(1))

ORACLE["q11_typed_projection"] = """
SELECT o_orderkey AS "offset", o_orderkey AS orderId, o_custkey AS userId,
  CAST(o_custkey % 2000 AS VARCHAR) AS productIds, CAST(round(o_totalprice) AS DOUBLE) AS total,
  CASE o_orderstatus WHEN 'O' THEN 'pending' ELSE 'delivered' END AS status
FROM orders WHERE o_orderkey % 20 > 5 AND o_orderstatus IN ('O', 'F')"""

ORACLE["q12_encode_omit_null"] = """
SELECT p_partkey,
  CAST(3 + CASE WHEN p_partkey % 3 = 2 THEN 1 ELSE 0 END + CASE WHEN p_partkey % 4 <> 0 THEN 1 ELSE 0 END AS INTEGER) AS n_keys,
  CASE WHEN p_partkey % 3 = 2 THEN p_type ELSE '' END AS category,
  CASE WHEN p_partkey % 4 <> 0 THEN p_brand || ',' || p_size ELSE '' END AS tags,
  p_name AS name
FROM part"""

ORACLE["q13_field_list"] = f"""
SELECT event_id,
  concat_ws('|', 'origin', origin, 'schemaURI', schemaURI, 'timestamp', {_ts('ts')}, 'data', data) AS fields,
  8 AS n, {_ts('ts')} AS decoded_timestamp, schemaURI AS decoded_schema_uri
FROM ({EVENT_ENVELOPES})"""

ORACLE["q14_field_pairs"] = f"""
WITH e AS ({EVENT_ENVELOPES})
SELECT event_id, 'origin' AS name, origin AS value FROM e
UNION ALL SELECT event_id, 'schemaURI', schemaURI FROM e
UNION ALL SELECT event_id, 'timestamp', {_ts('ts')} FROM e
UNION ALL SELECT event_id, 'data', data FROM e"""

ORACLE["q15_rfc3339_parse"] = f"""
SELECT event_id,
  CASE event_id % 6
    WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z'
    WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+02:00'
    WHEN 2 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.123Z'
    WHEN 3 THEN strftime(ts, '%Y-%m-%d')
    WHEN 4 THEN 'nope'
    ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS text,
  CASE event_id % 6
    WHEN 0 THEN {_ts('ts')}
    WHEN 1 THEN {_ts("ts - INTERVAL 2 HOUR")}
    WHEN 2 THEN {_ts('ts')}
    ELSE '0001-01-01T00:00:00Z' END AS parsed
FROM events"""

ORACLE["q16_envelope_required"] = f"""
SELECT event_id,
  CASE WHEN event_id % 5 = 0 THEN '' ELSE origin END AS origin,
  CASE WHEN event_id % 5 = 1 THEN '' ELSE schemaURI END AS schemaURI,
  CASE WHEN event_id % 5 = 3 THEN '0001-01-01T00:00:00Z' ELSE {_ts('ts')} END AS "timestamp",
  CASE WHEN event_id % 5 IN (0, 1, 2, 3) OR event_id % 7 = 0 THEN 0 ELSE 1 END AS ok
FROM ({EVENT_ENVELOPES})"""

ORACLE["q17_item_projection"] = f"""
SELECT id, {_ts('ts')} AS "timestamp", origin, schemaURI, data FROM ({BUFFER_ENTRIES})"""

NEW_ENTRIES = f"""
  SELECT * FROM ({BUFFER_ENTRIES})
  UNION ALL SELECT id, seq + 1000000000, 'late-topic', schemaURI, ts, data FROM ({BUFFER_ENTRIES}) WHERE seq % 5 = 0"""
PENDING_ENTRIES = f"""
  SELECT id, seq, 'pending-topic' AS origin, schemaURI, ts, data FROM ({BUFFER_ENTRIES}) WHERE seq % 3 = 0"""


def _group(new: str, pending: str) -> str:
    return f"""
WITH g AS (SELECT 0 AS src, * FROM ({new}) UNION ALL SELECT 1, * FROM ({pending})),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY src DESC, seq DESC) AS n FROM g)
SELECT * FROM r WHERE n = 1"""


ORACLE["q18_read_group"] = f"""
SELECT id, seq, origin, schemaURI, {_ts('ts')} AS "timestamp", data FROM ({_group(NEW_ENTRIES, PENDING_ENTRIES)})"""

ORACLE["q19_write_outcome"] = """
WITH b AS (SELECT event_id // 100 AS batch_id, (event_id % 7 = 0 OR event_id // 100 = 3) AS failed FROM events),
g AS (SELECT batch_id, count(*) AS n, count(*) FILTER (WHERE NOT failed) AS persisted_count,
        count(*) FILTER (WHERE failed) AS unpersisted_count FROM b GROUP BY batch_id)
SELECT *, CASE WHEN n = 0 THEN 'empty' WHEN persisted_count = 0 THEN 'failed'
               WHEN unpersisted_count > 0 THEN 'partial' ELSE 'ok' END AS verdict
FROM g"""

ORACLE["q20_ack_pending"] = f"""
SELECT id, seq FROM ({BUFFER_ENTRIES}) WHERE seq % 7 = 0"""

ORACLE["q21_delete"] = f"""
SELECT id, seq, origin FROM ({BUFFER_ENTRIES}) WHERE seq % 5 <> 0"""

UPSERT_ITEMS = f"""
  SELECT 'u' || user_id AS id, {_ts("date_trunc('day', ts)")} AS "timestamp",
    event_type || '-topic' AS origin, '{BASE}/event/1.0.0' AS schemaURI, props AS data, event_id AS seq
  FROM events"""

ORACLE["q22_upsert_latest"] = f"""
SELECT id, "timestamp", origin, schemaURI, data, seq FROM (
  SELECT *, row_number() OVER (PARTITION BY id, "timestamp" ORDER BY seq DESC) AS rn FROM ({UPSERT_ITEMS}))
WHERE rn = 1"""

ORACLE["q23_rejects_by_reason"] = f"""
SELECT status, reason, count(*) AS n FROM ({validated_orders_sql()})
WHERE status <> 'valid' GROUP BY status, reason"""

_ORDER_VALID = ("o_orderkey % 20 > 5 AND o_orderstatus IN ('O', 'F')")
ORACLE["q24_topic_partition_counts"] = f"""
WITH f AS (
  SELECT 'order-topic' AS origin, CAST(o_orderkey % 10 AS INTEGER) AS "partition", ({_ORDER_VALID}) AS ok FROM orders
  UNION ALL
  SELECT 'payment-topic', CAST(o_orderkey % 10 AS INTEGER),
    NOT (o_orderkey % 13 = 0 OR o_orderpriority = '4-NOT SPECIFIED') FROM orders
  UNION ALL
  SELECT 'product-topic', CAST(p_partkey % 10 AS INTEGER),
    (p_partkey % 11 <> 0 AND p_partkey % 13 <> 0 AND p_partkey % 3 <> 1) FROM part)
SELECT origin, "partition", count(*) AS n, count(*) FILTER (WHERE ok) AS n_valid
FROM f GROUP BY origin, "partition" """

# The answers are known per document; only residue 1 depends on the row (a part
# type is never the name of a JSON type).
ADMISSION = [
    ('{"type":"object","properties":{"n":{"type":"string"}},"required":["n"]}', 1), (None, 0),
    ('{"type":"object","properties":[1]}', 0), ('{"type":"object","required":[1,2]}', 0), ('{"type":"object"', 0),
    ("true", 1), ('{"type":["string","null"],"enum":["a",null]}', 1), ('{"type":"array","items":3}', 0),
    ('{"properties":{"a":{"items":{"type":"objekt"}}}}', 0), ('{"properties":{"a":{"pattern":"["}}}', 0),
    ('{"allOf":[{"not":{"required":"a"}}]}', 0), ('{"$defs":{"x":{"minItems":-1}}}', 0),
    ('{"items":{"contains":{"const":1},"prefixItems":[{"enum":[{}]}]},"pattern":"^[a-z]+$"}', 1)]
ORACLE["q25_schema_admission"] = f"""
WITH a(r, doc, admitted) AS (VALUES {", ".join(f"({i}, {'NULL' if d is None else repr(d)}, {ok})"
                                               for i, (d, ok) in enumerate(ADMISSION))})
SELECT p_partkey, coalesce(doc, '{{"type":"' || lower(p_type) || '"}}') AS schema, CAST(admitted AS INTEGER) AS admitted
FROM part JOIN a ON p_partkey % 13 = r"""

ORACLE["q26_generator"] = f"""
WITH s AS (SELECT event_id % 9 AS slot FROM events),
m AS (SELECT * FROM (VALUES (0, 'user', '1.0.0'), (1, 'address', '1.0.0'), (2, 'order', '1.0.0'),
        (3, 'payment', '1.0.0'), (4, 'product', '1.0.0'), (5, 'address', '2.0.0'), (6, 'order', '2.0.0'),
        (7, 'payment', '2.0.0'), (8, 'product', '2.0.0')) AS t(slot, name, version))
SELECT name || '-topic' AS origin, '{BASE}/' || name || '/' || version AS schemaURI,
  count(*) AS n, CASE WHEN m.slot = 6 THEN 0 ELSE count(*) END AS n_valid,
  CASE m.slot WHEN 6 THEN '{{"orderId":0,"userId":0,"productIds":null,"total":0}}'
              WHEN 7 THEN '{{"paymentId":0,"orderId":0,"amount":0,"method":""}}'
              WHEN 8 THEN '{{"id":0,"name":"","price":0}}' ELSE '' END AS only_text,
  CASE WHEN name = 'user' THEN count(*) ELSE 0 END AS n_email,
  CASE WHEN name = 'payment' THEN count(*) ELSE 0 END AS n_amount
FROM s JOIN m USING (slot) GROUP BY m.slot, name, version"""

ORACLE["q29_rules_as_rows"] = validated_orders_sql()

ACCOUNT_MESSAGES = """
  SELECT c_custkey, '{"id":' || c_custkey || ',"balance":' || c_acctbal || ',"segment":"' || c_mktsegment
    || '","owner":' || CASE WHEN c_custkey % 7 = 0 THEN '{"name":' || c_custkey || '}'
                            ELSE '{"name":"' || c_name || '"}' END || '}' AS data
  FROM customer"""

ACCOUNT_CHECKS = [
    ROOT_OBJ, _int_prop("id"), _num_prop("balance"),
    ("minimum:balance", _opt("j", "$.balance", "(NOT " + _is_num("j", "$.balance")
                             + " OR TRY_CAST(json_extract(j, '$.balance') AS DOUBLE) >= 0)")),
    _str_prop("segment"),
    ("type:owner", _opt("j", "$.owner", "json_type(j, '$.owner') = 'OBJECT'")),
    ("type:owner.name", _opt("j", "$.owner.name", _is_str("j", "$.owner.name"))),
    ("required:owner.name", "(json_type(j, '$.owner') <> 'OBJECT' OR " + _present("j", "$.owner.name") + ")"),
    _req("id"), _req("balance"), _req("owner"),
]

ORACLE["q30_minimum_ref"] = _status_sql("", ACCOUNT_CHECKS, "c_custkey", ACCOUNT_MESSAGES)

ORACLE["q31_read_group_capped"] = f"""
SELECT id, seq, origin FROM ({_group(*(f"SELECT * FROM ({x}) ORDER BY seq, id LIMIT 25"
                                       for x in (NEW_ENTRIES, PENDING_ENTRIES)))})"""

ORACLE["q27_stream_ingest"] = validated_orders_sql()
ORACLE["q28_stream_persist_replay"] = f"""
SELECT id, {_ts('ts')} AS "timestamp", origin, schemaURI, data, seq FROM ({BUFFER_ENTRIES})"""



def _entry_id(topic: str, partition: str, offset: str) -> str:
    return (f"{topic} || '-' || epoch_us(ts) // 1000 || '-' || lpad(CAST({partition} AS VARCHAR), 6, '0') || '-' || "
            f"lpad(CAST({offset} AS VARCHAR), 19, '0')")


ORACLE["q32_ingest_to_target"] = f"""
WITH m AS ({ORDER_MESSAGES})
SELECT {_entry_id("'order-topic'", '"offset" % 10', '"offset"')} AS id,
  {_ts('ts')} AS "timestamp", 'order-topic' AS origin, schemaURI, data
FROM m JOIN orders ON o_orderkey = "offset"
WHERE "offset" % 20 > 5 AND o_orderstatus IN ('O', 'F')"""

ORACLE["q33_external_write_outcome"] = """
WITH b AS (SELECT event_id // 1000 AS batch_id, event_id % 11 = 0 AS failed FROM events),
g AS (SELECT batch_id, count(*) AS n, count(*) FILTER (WHERE NOT failed) AS persisted_count,
        count(*) FILTER (WHERE failed) AS unpersisted_count FROM b GROUP BY batch_id)
SELECT *, CASE WHEN n = 0 THEN 'empty' WHEN persisted_count = 0 THEN 'failed'
               WHEN unpersisted_count > 0 THEN 'partial' ELSE 'ok' END AS verdict
FROM g"""

ADDRESS_MESSAGES = f"""
  SELECT c_custkey,
    '{BASE}/address/' || CASE WHEN c_custkey % 2 = 0 THEN '1.0.0' ELSE '2.0.0' END AS schemaURI,
    '{{"street":"Street ' || c_custkey || '"'
    || CASE WHEN c_custkey % 7 = 0 THEN '' ELSE ',"city":"' || n_name || '"' END
    || CASE WHEN c_custkey % 5 = 0 THEN ',"postalCode":' || c_custkey ELSE ',"postalCode":"P' || c_custkey || '"' END
    || CASE WHEN c_custkey % 2 = 1 THEN
         CASE WHEN c_custkey % 11 = 0 THEN ',"country":' || c_custkey ELSE ',"country":"' || r_name || '"' END
       ELSE '' END || '}}' AS data
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"""

_ADDR_COMMON = [ROOT_OBJ, _str_prop("street"), _str_prop("city"), _str_prop("postalCode"),
                _req("street"), _req("city"), _req("postalCode")]
_ADDR_V2 = _ADDR_COMMON + [_str_prop("country")]

ORACLE["q34_address_versions"] = f"""
WITH p AS (SELECT *, CASE WHEN json_valid(data) THEN data END AS j FROM ({ADDRESS_MESSAGES})),
e AS (SELECT c_custkey, schemaURI, j,
        CASE WHEN schemaURI LIKE '%/1.0.0' THEN {_errors('j', _ADDR_COMMON)} ELSE {_errors('j', _ADDR_V2)} END AS errors
      FROM p)
SELECT c_custkey, schemaURI,
  CASE WHEN errors <> '' THEN 'invalid' ELSE 'valid' END AS status,
  CASE WHEN errors <> '' THEN 'schema_violation' ELSE 'ok' END AS reason, errors
FROM e"""

USER_MESSAGES = """
  SELECT c_custkey, '{"id":' || c_custkey || ',"name":"' || c_name || '"'
    || CASE WHEN c_custkey % 13 = 0 THEN ''
            WHEN c_custkey % 9 = 0 THEN ',"email":"c' || c_custkey || '.example.com"'
            ELSE ',"email":"c' || c_custkey || '@example.com"' END || '}' AS data
  FROM customer"""

USER_CHECKS = [
    ROOT_OBJ, _int_prop("id"), _str_prop("name"), _str_prop("email"),
    ("format:email", _opt("j", "$.email", "(NOT " + _is_str("j", "$.email")
                          + r" OR regexp_full_match(json_extract_string(j, '$.email'), '[^@\s]+@[^@\s]+\.[^@\s]+'))")),
    _req("id"), _req("name"), _req("email"),
]

ORACLE["q35_user_email"] = _status_sql("", USER_CHECKS, "c_custkey", USER_MESSAGES)


def _labels(*pairs: tuple[str, str]) -> str:
    """Violated labels in order, comma-joined."""
    cases = ", ".join(f"CASE WHEN {cond} THEN '{label}' END" for label, cond in sorted(pairs))
    return f"concat_ws(',', {cases})"


def _verdicts(key: str, src: str) -> str:
    return f"""
SELECT {key}, CASE WHEN errors = '' THEN 'valid' ELSE 'invalid' END AS status,
  CASE WHEN errors = '' THEN 'ok' ELSE 'schema_violation' END AS reason, errors FROM ({src})"""


ORACLE["q36_schema_per_supplier"] = _verdicts("l_orderkey, l_linenumber", f"""
SELECT l_orderkey, l_linenumber, {_labels(
    ("anyOf:note", "l_linenumber % 3 = 2 OR l_linenumber % 3 = 1 AND l_linenumber * 5 < 10"),
    ("maximum:lines[].qty", "l_linenumber % 5 <> 0 AND l_quantity > l_suppkey % 41 + 10"),
    ("minimum:lines[].qty", "l_linenumber % 5 <> 0 AND l_quantity < 1"),
    ("required:lines[].qty", "l_linenumber % 5 = 0"))} AS errors FROM lineitem""")

ORACLE["q37_order_lines"] = _verdicts("l_orderkey", f"""
SELECT l_orderkey, {_labels(
    ("type:*", "l_orderkey % 4 = 0"), ("minItems:lines", "count(*) < 2"),
    ("contains:lines", "count(*) FILTER (l_linenumber % 5 <> 0 AND l_quantity >= 40) = 0"),
    ("maximum:lines[].qty", "bool_or(l_linenumber % 5 <> 0 AND l_quantity > 45)"),
    ("const:lines[].ship", "bool_or(l_linenumber % 2 <> 0 AND l_linenumber % 7 = 3)"),
    ("required:lines[].qty", "bool_or(l_linenumber % 5 = 0)"))} AS errors FROM lineitem GROUP BY l_orderkey""")

ORACLE["q38_two_topics"] = f"""
SELECT {_entry_id('t', 'user_id % 10', 'event_id')} AS id, epoch_us(ts) AS seq, t AS origin
FROM events, (VALUES ('left-topic'), ('right-topic')) AS topics(t)"""

ORACLE["q39_external_flow"] = """
WITH b AS (SELECT i AS batch_id, count(*) FILTER (event_id % 3 = i) + count(*) FILTER (event_id % 3 < i AND event_id % 11 = 0) AS n,
             count(*) FILTER (event_id % 3 <= i AND event_id % 11 = 0) AS unpersisted_count
           FROM events, range(3) AS r(i) GROUP BY i)
SELECT batch_id, n, n - unpersisted_count AS persisted_count, unpersisted_count,
       CASE WHEN unpersisted_count = n THEN 'failed' WHEN unpersisted_count > 0 THEN 'partial' ELSE 'ok' END AS verdict FROM b
UNION ALL SELECT -1, count(*), 0, count(*), 'pending' FROM events WHERE event_id % 11 = 0"""

ORACLE["q40_registry_log"] = ORACLE["q04_registry_fold"]


ORACLE["q41_stream_unique"] = f"""
SELECT id, seq, origin, schemaURI, {_ts('ts')} AS "timestamp", data FROM ({BUFFER_ENTRIES})"""

ORACLE["q42_redelivery"] = ORACLE["q28_stream_persist_replay"]

ORACLE["q43_registry_stream"] = ORACLE["q05_registry_requests"]

ORACLE["q44_external_store"] = f"""
SELECT id, CASE WHEN seq % 11 = 0 THEN -1 ELSE seq % 2 END AS batch,
  CASE WHEN seq % 11 = 0 THEN 'unprocessed' ELSE 'stored' END AS state FROM ({BUFFER_ENTRIES})"""

ORACLE["q45_sql_checks"] = r"""
WITH t AS (SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN c_custkey || '@example.com' WHEN 1 THEN (c_custkey % 1100) || '.2.3'
  WHEN 2 THEN 'http://h/schemas/user/' || c_custkey WHEN 3 THEN '{"n":' || c_custkey || '}' WHEN 4 THEN ''
  WHEN 5 THEN '^[a-z]{' || (c_custkey % 9) || ',5}$' END AS x FROM customer)
SELECT c_custkey, coalesce(x, '') AS x, (c_custkey % 7 = 0)::INTEGER AS email,
  (c_custkey % 7 = 1 AND c_custkey % 1100 <= 1023)::INTEGER AS version, (c_custkey % 7 = 2)::INTEGER AS schema_uri,
  (c_custkey % 7 = 3)::INTEGER AS json, (x IS NOT NULL AND x <> '')::INTEGER AS required,
  (x IS NOT NULL AND (c_custkey % 7 IN (0, 1, 2, 4) OR c_custkey % 7 = 5 AND c_custkey % 9 <= 5))::INTEGER AS pattern FROM t"""

ORACLE["q46_partition_outcomes"] = f"""
SELECT 'order-topic' AS topic, ("offset" % 10)::INTEGER AS partition, status, count(*) AS n
FROM ({validated_orders_sql()}) GROUP BY ALL"""

ORACLE["q47_cursor_read"] = f"""
SELECT id, seq, (row_number() OVER (ORDER BY seq, id) - 1) // 1500 AS batch_id FROM ({BUFFER_ENTRIES})"""

ORACLE["q48_tombstones"] = """
SELECT 'order-topic' AS topic, (o_orderkey % 10)::INTEGER AS partition, o_orderkey AS "offset" FROM orders WHERE o_orderkey % 6 <> 0"""

ORACLE["q49_split_csv"] = """
WITH t AS (SELECT c_custkey, string_split(c_custkey || ',' || CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_name END
  || CASE WHEN c_custkey % 5 = 0 THEN ',' ELSE '' END, ',') AS p FROM customer)
SELECT c_custkey, (i - 1)::INTEGER AS pos, p[i] AS part FROM t, range(1, len(p) + 1) AS r(i)"""

ORACLE["q50_bulk_register"] = """
SELECT 'schema:' || n || ':1.' || v || '.0' AS key, n AS name, 'https://schemas.example.com/schemas/' || n || '/1.' || v || '.0' AS schemaURI,
  s_name AS required FROM (SELECT 'supplier' || (s_suppkey % 50) AS n, s_suppkey // 50 AS v, s_name FROM supplier)"""

ORACLE["q51_failure_isolation"] = """
WITH b AS (SELECT count(*) FILTER (event_id % 3 = 0) AS n0, count(*) FILTER (event_id % 3 = 1) AS n1, count(*) FILTER (event_id % 3 = 2) AS n2 FROM events)
SELECT 0 AS batch_id, n0 AS n, n0 AS persisted_count, 0 AS unpersisted_count, 'ok' AS verdict FROM b
UNION ALL SELECT 1, n1, 0, n1, 'failed' FROM b UNION ALL SELECT 2, n1 + n2, n1 + n2, 0, 'ok' FROM b"""

ORACLE["q52_outcome_ids"] = f"""
SELECT seq // 1000 AS batch_id, CASE WHEN seq % 7 = 0 THEN 'unpersisted' ELSE 'persisted' END AS state, substr(md5(id), 1, 1) AS bucket,
  string_agg(id, ',' ORDER BY id) AS ids FROM ({BUFFER_ENTRIES}) GROUP BY ALL"""
