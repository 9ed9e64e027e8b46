"""Registered queries: one per operator group of the survey.

Each query takes ``(spark, sf_dir)``, reads the driver's tables and returns a
DataFrame whose column names match the DuckDB twin in ``sluice.plans.oracle``.
Arrays are emitted as sorted, comma-joined text and timestamps as RFC3339
text so both engines produce identical values.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.jsontext import try_json
from ..functions.routes import schema_uri, topic_of, uri_name, uri_version
from ..functions.semver import parse_semver, registry_key, semver_text
from ..functions.timefmt import parse_rfc3339, rfc3339
from ..operators import buffer as buf
from ..operators import envelope as env
from ..operators import persist as per
from ..operators import registry as reg
from ..operators import validate as val
from ..operators.compile import struct_type_of, type_matches_col
from ..session import configure
from ..sources import testdata as td

FIXTURE_SCHEMAS = os.path.join(os.path.dirname(os.path.dirname(__file__)), "fixtures", "schemas")


def _fixture_corpus(spark: SparkSession) -> DataFrame:
    """The two fixture schemas as a registry (driver-side files, handed over as rows)."""
    import glob
    docs = sorted((p, open(p).read()) for p in glob.glob(os.path.join(FIXTURE_SCHEMAS, "*.json")))
    return reg.registry_of(reg.corpus_from_texts(spark, docs))


def _joined(c: Column) -> Column:
    return F.coalesce(F.array_join(F.array_sort(c), ","), F.lit(""))


_REGISTRY_MEMO: dict = {}


def corpus_registry(spark: SparkSession, with_fixtures: bool = False) -> DataFrame:
    """Registry of the bundled corpus (plus the test fixtures when asked).

    Memoised per session: the registry is a few rows, cached once instead of
    re-reading and re-folding the corpus for every query.
    """
    key = (spark.sparkContext.applicationId, with_fixtures)
    hit = _REGISTRY_MEMO.get(key)
    if hit is not None and hit.sparkSession is spark:
        return hit
    r = reg.registry_from_corpus(spark)
    if with_fixtures:
        r = r.unionByName(_fixture_corpus(spark))
    r = r.cache()
    _REGISTRY_MEMO[key] = r
    return r


def _outcome(df: DataFrame, key: str) -> DataFrame:
    return df.select(key, "status", "reason", _joined(F.col("errors")).alias("errors"))


# -- envelope and naming ------------------------------------------------------

def q01_record_to_envelope(spark, sf_dir):
    """Kafka records -> envelope: first schemaURI header wins, RFC3339 time."""
    configure(spark)
    e = env.to_envelope(td.event_records(spark, sf_dir))
    return e.select("offset", "partition", "origin", "schemaURI",
                    rfc3339("timestamp").alias("timestamp"), "data")


def q02_route_names(spark, sf_dir):
    """Topic and URI naming and their inverse, including malformed URIs."""
    e = td.table(spark, sf_dir, "events")
    i = F.col("event_id")
    ver = F.concat((F.col("user_id") % 5).cast("string"), F.lit("."), (i % 7).cast("string"))
    uri = (F.when(i % 3 == 0, schema_uri(F.col("event_type"), F.lit("1.0.0")))
           .when(i % 3 == 1, F.concat(F.lit("http://schema-repository:8080/schemas/"), F.col("event_type")))
           .otherwise(schema_uri(F.col("event_type"), ver)))
    return e.select("event_id", topic_of("event_type").alias("topic"), uri.alias("uri")).select(
        "event_id", "topic", "uri",
        F.coalesce(uri_name("uri"), F.lit("")).alias("name"),
        F.coalesce(uri_version("uri"), F.lit("")).alias("version"))


def q03_semver_parse(spark, sf_dir):
    """Version text parsing, normalisation and registry keys, good and bad forms."""
    p = td.table(spark, sf_dir, "part")
    k, s = F.col("p_partkey"), F.col("p_size").cast("string")
    r = k % 8
    text = (F.when(r == 0, s)
            .when(r == 1, F.concat(s, F.lit("."), (k % 1030).cast("string")))
            .when(r == 2, F.concat(F.lit("0"), s, F.lit(".0."), (k % 7).cast("string")))
            .when(r == 3, F.concat(s, F.lit(".")))
            .when(r == 4, F.concat(s, F.lit(".1.2.3")))
            .when(r == 5, F.concat(F.lit("-"), s))
            .when(r == 6, (k * 3).cast("string"))
            .otherwise(F.concat(s, F.lit("_0"))))
    v = parse_semver(text)
    return p.select(k.alias("p_partkey"), text.alias("version_in"), v.alias("v")).select(
        "p_partkey", "version_in",
        F.col("v").isNotNull().cast("int").alias("ok"),
        F.coalesce(F.col("v.major"), F.lit(-1)).alias("major"),
        F.coalesce(F.col("v.minor"), F.lit(-1)).alias("minor"),
        F.coalesce(F.col("v.patch"), F.lit(-1)).alias("patch"),
        F.coalesce(semver_text("v"), F.lit("")).alias("version"),
        F.coalesce(F.when(F.col("v").isNotNull(), registry_key(F.lit("part"), F.col("v"))), F.lit("")).alias("key"))


# -- registry -----------------------------------------------------------------

def q04_registry_fold(spark, sf_dir):
    """Registry state of a set/del change log (last writer wins, delete removes)."""
    state = reg.fold_log(td.registry_change_log(spark, sf_dir))
    return state.select("key", "name", semver_text("version").alias("version"), "schemaURI", "schema")


def _requests(spark, sf_dir) -> DataFrame:
    """Registry requests from ``orders``: F→add, O→get, P→del; bad documents
    when ``o_orderkey % 97 = 0``, bad versions when ``% 89 = 0``."""
    log = td.registry_change_log(spark, sf_dir)
    k = F.col("seq")
    op = F.when(F.col("op") == "del", "del").when(F.col("seq") % 2 == 0, "add").otherwise("get")
    schema = (F.when(k % 97 == 0, F.lit('{"type":"object"'))
              .when(k % 97 == 1, F.lit('{"type":"objekt"}'))
              .otherwise(F.col("schema")))
    version = F.when(k % 89 == 0, F.lit("invalid")).otherwise(F.col("version"))
    return log.select("seq", op.alias("op"), "name", version.alias("version"), schema.alias("schema"))


def q05_registry_requests(spark, sf_dir):
    """add/get/del outcomes (created, ok, deleted, not_found, bad_request)."""
    out = reg.answer_requests(_requests(spark, sf_dir), bucket_width=1024)
    return out.select("seq", "op", F.coalesce("key", F.lit("")).alias("key"), "outcome",
                      F.coalesce(reg.unwrap_body("body"), F.lit("")).alias("schema"))


# -- validation ---------------------------------------------------------------

def _order_messages(spark, sf_dir):
    return env.to_envelope(td.order_records(spark, sf_dir))


def q06_validate_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: order records -> envelope -> lookup + validate -> per-record outcome."""
    configure(spark)
    out = val.validate(_order_messages(spark, sf_dir), corpus_registry(spark))
    return out.select("offset", "schemaURI", "status", "reason", _joined(F.col("errors")).alias("errors"))


def q07_validate_errors(spark, sf_dir):
    """Frequency of each violated keyword over the order messages."""
    configure(spark)
    out = val.validate(_order_messages(spark, sf_dir), corpus_registry(spark))
    return val.violation_counts(out)


def q08_type_matrix(spark, sf_dir):
    """JSON values of every kind against the seven JSON types."""
    configure(spark)
    e = td.table(spark, sf_dir, "events")
    i, u = F.col("event_id"), F.col("user_id").cast("string")
    r = i % 10
    text = (F.when(r == 0, u)
            .when(r == 1, F.concat(u, F.lit(".0")))
            .when(r == 2, F.concat(u, F.lit(".5")))
            .when(r == 3, F.concat(u, F.lit("e2")))
            .when(r == 4, F.concat(F.lit('"'), u, F.lit('"')))
            .when(r == 5, F.lit("null"))
            .when(r == 6, F.when(i % 20 == 6, F.lit("true")).otherwise(F.lit("false")))
            .when(r == 7, F.concat(F.lit("["), u, F.lit("]")))
            .when(r == 8, F.concat(F.lit('{"k":'), u, F.lit("}")))
            .otherwise(F.concat(F.lit("-"), u)))
    staged = e.select("event_id", text.alias("json"), try_json(text).alias("x"))
    return staged.select("event_id", "json", *[
        type_matches_col("x", n).cast("int").alias(f"is_{n}")
        for n in ("string", "integer", "number", "boolean", "null", "array", "object")])


def _payment_messages(spark, sf_dir):
    """``orders`` -> payment/2.0.0 envelopes; status from ``o_orderpriority``."""
    o = td.table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    pr = F.col("o_orderpriority")
    status = (F.when(k % 13 == 0, F.lit(',"status":null'))
              .when(pr == "1-URGENT", F.lit(',"status":"pending"'))
              .when(pr == "2-HIGH", F.lit(',"status":"completed"'))
              .when(pr == "3-MEDIUM", F.lit(',"status":"failed"'))
              .when(pr == "4-NOT SPECIFIED", F.lit(',"status":"unknown"'))
              .otherwise(F.lit("")))
    data = F.concat(F.lit('{"paymentId":'), (k * 10).cast("string"), F.lit(',"orderId":'), k.cast("string"),
                    F.lit(',"amount":'), F.col("o_totalprice").cast("decimal(18,2)").cast("string"),
                    F.lit(',"method":"card"'), status, F.lit("}"))
    return o.select(
        k.alias("o_orderkey"), F.lit("payment-topic").alias("origin"),
        (k % 10).cast("int").alias("partition"),
        F.lit("http://schema-repository:8080/schemas/payment/2").alias("schemaURI"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"), data.alias("data"))


def q09_enum_status(spark, sf_dir):
    """payment/2.0.0: status enum, null status, absent status; URI with short version."""
    configure(spark)
    out = val.validate(_payment_messages(spark, sf_dir), corpus_registry(spark))
    return _outcome(out, "o_orderkey")


def q10_required_null(spark, sf_dir):
    """product/1.0.0: required vs null vs absent, wrong types."""
    configure(spark)
    out = val.validate(td.product_records(spark, sf_dir, 1), corpus_registry(spark))
    return _outcome(out, "p_partkey")


def _order_doc() -> dict:
    import json
    with open(os.path.join(reg.corpus_dir(), "order-2.0.0.json")) as f:
        return json.load(f)


def q11_typed_projection(spark, sf_dir):
    """Valid order payloads read into the record type compiled from their schema."""
    configure(spark)
    out = val.valid_only(val.validate(_order_messages(spark, sf_dir), corpus_registry(spark)))
    typed = out.select("offset", F.from_json("data", struct_type_of(_order_doc())).alias("r"))
    return typed.select("offset", F.col("r.orderId").alias("orderId"), F.col("r.userId").alias("userId"),
                        F.array_join(F.col("r.productIds").cast("array<string>"), ",").alias("productIds"),
                        F.col("r.total").alias("total"), F.col("r.status").alias("status"))


def q12_encode_omit_null(spark, sf_dir):
    """Typed product rows -> JSON with null optionals omitted -> fields re-read."""
    p = td.table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    row = F.struct(
        k.alias("id"), F.col("p_name").alias("name"), F.col("p_retailprice").alias("price"),
        F.when(k % 3 == 2, F.col("p_type")).alias("category"),
        F.when(k % 4 != 0, F.array(F.col("p_brand"), F.col("p_size").cast("string"))).alias("tags"))
    j = p.select(k.alias("p_partkey"), F.to_json(row).alias("json"))
    return j.select(
        "p_partkey",
        F.size(F.json_object_keys("json")).alias("n_keys"),
        F.coalesce(F.get_json_object("json", "$.category"), F.lit("")).alias("category"),
        F.coalesce(F.array_join(F.from_json(F.get_json_object("json", "$.tags"), "array<string>"), ","),
                   F.lit("")).alias("tags"),
        F.get_json_object("json", "$.name").alias("name"))


# -- envelope forms -----------------------------------------------------------

def q13_field_list(spark, sf_dir):
    """Envelope -> 8-string field list -> decoded back."""
    configure(spark)
    e = td.event_envelopes(spark, sf_dir)
    fl = e.select("event_id", env.field_list(e).alias("fl"))
    dec = fl.select("event_id", "fl", F.struct(*env.from_field_map(env.from_field_list("fl"))).alias("m"))
    return dec.select("event_id", F.array_join("fl", "|").alias("fields"), F.size("fl").alias("n"),
                      rfc3339("m.timestamp").alias("decoded_timestamp"),
                      F.col("m.schemaURI").alias("decoded_schema_uri"))


def q14_field_pairs(spark, sf_dir):
    """Envelope -> (name, value) rows."""
    configure(spark)
    return env.field_pairs(td.event_envelopes(spark, sf_dir), "event_id")


def q15_rfc3339_parse(spark, sf_dir):
    """RFC3339 text variants -> timestamp (zero time when not RFC3339)."""
    configure(spark)
    e = td.table(spark, sf_dir, "events")
    i = F.col("event_id")
    base = F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss")
    r = i % 6
    text = (F.when(r == 0, F.concat(base, F.lit("Z")))
            .when(r == 1, F.concat(base, F.lit("+02:00")))
            .when(r == 2, F.concat(base, F.lit(".123Z")))
            .when(r == 3, F.date_format(F.col("ts"), "yyyy-MM-dd"))
            .when(r == 4, F.lit("nope"))
            .otherwise(F.date_format(F.col("ts"), "yyyy-MM-dd HH:mm:ss")))
    return e.select("event_id", text.alias("text")).select(
        "event_id", "text", rfc3339(parse_rfc3339("text")).alias("parsed"))


def q16_envelope_required(spark, sf_dir):
    """Stored field maps with missing fields -> envelope -> required check."""
    configure(spark)
    e = td.event_envelopes(spark, sf_dir)
    i = F.col("event_id")
    r = i % 5
    names = F.array(*[F.lit(n) for n in env.FIELD_NAMES])
    data = F.when(i % 7 == 0, F.lit("not json")).otherwise(F.col("data"))
    vals = F.array(F.col("origin"), F.col("schemaURI"), rfc3339("timestamp"), data)
    m = F.map_from_arrays(names, vals)
    m = F.map_filter(m, lambda kk, vv: ~((r == 0) & (kk == "origin")) & ~((r == 1) & (kk == "schemaURI"))
                     & ~((r == 2) & (kk == "data")) & ~((r == 3) & (kk == "timestamp")))
    dec = e.select("event_id", F.struct(*env.from_field_map(m)).alias("m")).select("event_id", "m.*")
    return dec.select("event_id", "origin", "schemaURI", rfc3339("timestamp").alias("timestamp"),
                      env.envelope_ok().cast("int").alias("ok"))


def q17_item_projection(spark, sf_dir):
    """Buffer entries -> target items of five strings."""
    configure(spark)
    return env.item(td.buffer_entries(spark, sf_dir))


# -- buffer and persistence ---------------------------------------------------

def _new_pending(spark, sf_dir):
    """Every entry arrives as new, a fifth of them once more with a later
    ``seq`` and another origin; a third (``seq % 3 = 0``) is also still pending
    from an earlier read, with an origin of its own, so it shows which copy
    wins."""
    b = td.buffer_entries(spark, sf_dir)
    late = (b.where(F.col("seq") % 5 == 0).withColumn("seq", F.col("seq") + 1_000_000_000)
            .withColumn("origin", F.lit("late-topic")))
    return b.unionByName(late), b.where(F.col("seq") % 3 == 0).withColumn("origin", F.lit("pending-topic"))


def q18_read_group(spark, sf_dir):
    """Entries new, some twice, a third also pending: one row per id, pending
    first, then the last to arrive."""
    configure(spark)
    new, pending = _new_pending(spark, sf_dir)
    g = buf.read_group(new, pending)
    return g.select("id", "seq", "origin", "schemaURI", rfc3339("timestamp").alias("timestamp"), "data")


def q19_write_outcome(spark, sf_dir):
    """Batches of 100 events; ids with ``event_id % 7 = 0`` fail, batch 3 fails whole."""
    b = td.buffer_entries(spark, sf_dir).select(
        (F.col("seq") / 100).cast("bigint").alias("batch_id"), "id", "seq")
    failed = b.where((F.col("seq") % 7 == 0) | (F.col("batch_id") == 3))
    return per.batch_outcome(b, failed)


def q20_ack_pending(spark, sf_dir):
    """Every entry pending; all but ``seq % 7 = 0`` acknowledged (with
    duplicate acks for ``seq % 3 = 0``): what stays pending."""
    configure(spark)
    pending = td.buffer_entries(spark, sf_dir)
    acks = pending.where(F.col("seq") % 7 != 0).select("id")
    acked = acks.unionByName(acks.where(F.col("id").endswith("0")))
    return buf.ack(pending, acked).select("id", "seq")


def q21_delete(spark, sf_dir):
    """Buffer minus deleted ids (``seq % 5 = 0``)."""
    configure(spark)
    b = td.buffer_entries(spark, sf_dir)
    return buf.delete(b, b.where(F.col("seq") % 5 == 0)).select("id", "seq", "origin")


def _upsert_items(spark, sf_dir) -> DataFrame:
    """Items keyed ``(u<user_id>, <day>)`` from events: many writes per key."""
    e = td.table(spark, sf_dir, "events")
    return e.select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("id"),
        rfc3339(F.date_trunc("day", F.col("ts").cast("timestamp"))).alias("timestamp"),
        F.concat(F.col("event_type"), F.lit("-topic")).alias("origin"),
        F.lit("http://schema-repository:8080/schemas/event/1.0.0").alias("schemaURI"),
        F.col("props").alias("data"),
        F.col("event_id").alias("seq"))


def q22_upsert_latest(spark, sf_dir):
    """Upsert keyed by (id, timestamp): the latest write per key remains."""
    configure(spark)
    items = _upsert_items(spark, sf_dir)
    first = items.where(F.col("seq") % 2 == 0)
    second = items.where(F.col("seq") % 2 == 1)
    state = per.upsert(per.upsert(None, first), second)
    return state.select(*per.ITEM_COLUMNS, "seq")


def q23_rejects_by_reason(spark, sf_dir):
    """Reject side output summarised by status and reason."""
    configure(spark)
    out = val.rejects(val.validate(_order_messages(spark, sf_dir), corpus_registry(spark)))
    return out.groupBy("status", "reason").agg(F.count(F.lit(1)).alias("n"))


def q24_topic_partition_counts(spark, sf_dir):
    """Order, payment and product topics in one flow; counts per (topic, partition)."""
    configure(spark)
    cols = ["origin", "partition", "schemaURI", "timestamp", "data"]
    orders = _order_messages(spark, sf_dir).select(*cols)
    pays = _payment_messages(spark, sf_dir).select(*cols)
    prods = td.product_records(spark, sf_dir, 2).withColumn(
        "partition", (F.col("p_partkey") % 10).cast("int")).select(*cols)
    flow = orders.unionByName(pays).unionByName(prods)
    return val.partition_counts(val.validate(flow, corpus_registry(spark)))


def q25_schema_admission(spark, sf_dir):
    """Candidate schema documents derived from ``part`` -> admitted or refused."""
    p = td.table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    t = F.lower(F.col("p_type"))
    r = k % 13
    doc = (F.when(r == 0, F.concat(F.lit('{"type":"object","properties":{"n":{"type":"string"}},"required":["n"]}')))
           .when(r == 1, F.concat(F.lit('{"type":"'), t, F.lit('"}')))
           .when(r == 2, F.lit('{"type":"object","properties":[1]}'))
           .when(r == 3, F.lit('{"type":"object","required":[1,2]}'))
           .when(r == 4, F.lit('{"type":"object"'))
           .when(r == 5, F.lit("true"))
           .when(r == 6, F.lit('{"type":["string","null"],"enum":["a",null]}'))
           .when(r == 7, F.lit('{"type":"array","items":3}'))
           .when(r == 8, F.lit('{"properties":{"a":{"items":{"type":"objekt"}}}}'))
           .when(r == 9, F.lit('{"properties":{"a":{"pattern":"["}}}'))
           .when(r == 10, F.lit('{"allOf":[{"not":{"required":"a"}}]}'))
           .when(r == 11, F.lit('{"$defs":{"x":{"minItems":-1}}}'))
           .otherwise(F.lit('{"items":{"contains":{"const":1},"prefixItems":[{"enum":[{}]}]},"pattern":"^[a-z]+$"}')))
    d = p.select(k.alias("p_partkey"), doc.alias("schema"))
    return reg.with_admission(d, "schema", "ok").select("p_partkey", "schema", F.col("ok").cast("int").alias("admitted"))


def q26_generator(spark, sf_dir):
    """Typed records generated from ``events`` seeds, validated; faithful mode.
    Field values: the one text of a zeroed document, generated e-mails, and
    amounts within their range."""
    from ..sources.generator import generate
    configure(spark)
    seeds = td.table(spark, sf_dir, "events").select(F.col("event_id").alias("seed"))
    recs = generate(seeds, zero_values=True)
    out = val.validate(recs, corpus_registry(spark))
    return (out.groupBy("origin", "schemaURI")
            .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == "valid").alias("n_valid"),
                 F.when(F.min("data") == F.max("data"), F.min("data")).otherwise("").alias("only_text"),
                 F.count_if(F.get_json_object("data", "$.email").rlike("^[0-9a-f]{8}@example[.]com$")).alias("n_email"),
                 F.count_if(F.get_json_object("data", "$.amount").cast("double").between(0.0, 99999.99)).alias("n_amount")))


def q29_rules_as_rows(spark, sf_dir):
    """The flagship through design B (registry flattened to rule rows)."""
    configure(spark)
    out = val.validate(_order_messages(spark, sf_dir), corpus_registry(spark), design="rules")
    return out.select("offset", "schemaURI", "status", "reason", _joined(F.col("errors")).alias("errors"))


def q30_minimum_ref(spark, sf_dir):
    """customer -> account schema with ``minimum`` and a ``$ref`` to owner."""
    configure(spark)
    out = val.validate(td.account_records(spark, sf_dir), corpus_registry(spark, with_fixtures=True))
    return _outcome(out, "c_custkey")


def q31_read_group_capped(spark, sf_dir):
    """Group read with a per-list read count of 25 (the persist service's cap)."""
    configure(spark)
    new, pending = _new_pending(spark, sf_dir)
    return buf.read_group(new, pending, count=25).select("id", "seq", "origin")


QUERIES = {
    "q01_record_to_envelope": q01_record_to_envelope,
    "q02_route_names": q02_route_names,
    "q03_semver_parse": q03_semver_parse,
    "q04_registry_fold": q04_registry_fold,
    "q05_registry_requests": q05_registry_requests,
    "q06_validate_status": q06_validate_status,
    "q07_validate_errors": q07_validate_errors,
    "q08_type_matrix": q08_type_matrix,
    "q09_enum_status": q09_enum_status,
    "q10_required_null": q10_required_null,
    "q11_typed_projection": q11_typed_projection,
    "q12_encode_omit_null": q12_encode_omit_null,
    "q13_field_list": q13_field_list,
    "q14_field_pairs": q14_field_pairs,
    "q15_rfc3339_parse": q15_rfc3339_parse,
    "q16_envelope_required": q16_envelope_required,
    "q17_item_projection": q17_item_projection,
    "q18_read_group": q18_read_group,
    "q19_write_outcome": q19_write_outcome,
    "q20_ack_pending": q20_ack_pending,
    "q21_delete": q21_delete,
    "q22_upsert_latest": q22_upsert_latest,
    "q23_rejects_by_reason": q23_rejects_by_reason,
    "q24_topic_partition_counts": q24_topic_partition_counts,
    "q25_schema_admission": q25_schema_admission,
    "q26_generator": q26_generator,
    "q29_rules_as_rows": q29_rules_as_rows,
    "q30_minimum_ref": q30_minimum_ref,
    "q31_read_group_capped": q31_read_group_capped,
}


# -- streaming ----------------------------------------------------------------

def _replay_files(df: DataFrame, path: str, files: int, order: str) -> None:
    """Store a derived frame as ``files`` parquet files in ``order`` ranges."""
    df.repartitionByRange(files, order).sortWithinPartitions(order).write.mode("overwrite").parquet(path)


def q27_stream_ingest(spark, sf_dir):
    """Order records replayed as a stream (4 micro-batches of 8 files, as 8 topic
    partitions would come) through the ingest flow."""
    import os
    from ..session import new_run_dir
    from ..sources.kafka import read_replay_stream
    from ..streaming.ingest import read_outcomes, start_ingest
    configure(spark)
    run = new_run_dir(spark, "ingest")
    src = os.path.join(run, "source")
    _replay_files(td.order_records(spark, sf_dir), src, 32, "offset")
    q = start_ingest(read_replay_stream(spark, src, max_files_per_trigger=8),
                     lambda: corpus_registry(spark), os.path.join(run, "out"),
                     os.path.join(run, "checkpoint"), trigger={"availableNow": True})
    q.awaitTermination()
    out = read_outcomes(spark, os.path.join(run, "out"))
    return out.select("offset", "schemaURI", "status", "reason", _joined(F.col("errors")).alias("errors"))


def q28_stream_persist_replay(spark, sf_dir):
    """Buffer entries through the persist flow with at-least-once delivery:
    entries with ``seq % 3 = 0`` arrive twice (the copy in the next of four files) and
    ``seq % 7 = 0`` fails on its first delivery and comes back from pending.
    The target must end with exactly one item per entry."""
    import os
    from ..session import new_run_dir
    from ..streaming.persist import PersistFlow
    configure(spark)
    run = new_run_dir(spark, "persist")
    src = os.path.join(run, "source")
    entries = td.buffer_entries(spark, sf_dir)
    once = entries.withColumn("__order", F.pmod(F.xxhash64("id"), F.lit(3)))
    again = once.where(F.col("seq") % 3 == 0).withColumn("__order", F.col("__order") + 1)
    # one append per file, so a copy is always delivered by a later one
    for i in range(4):
        once.unionByName(again).where(F.col("__order") == i).coalesce(1).write.mode("append").parquet(src)
    flow = PersistFlow(spark, os.path.join(run, "state"),
                       fail=lambda g: g.where((F.col("seq") % 7 == 0) & (F.col("attempts") == 1)))
    stream = (spark.readStream.schema(once.schema).option("maxFilesPerTrigger", "1").parquet(src)
              .drop("__order"))
    q = flow.start(stream, os.path.join(run, "checkpoint"), trigger={"availableNow": True})
    q.awaitTermination()
    flow.drain()
    return flow.target_frame().select(*per.ITEM_COLUMNS, "seq")


QUERIES["q27_stream_ingest"] = q27_stream_ingest
QUERIES["q28_stream_persist_replay"] = q28_stream_persist_replay


def q32_ingest_to_target(spark, sf_dir):
    """Order records through the ingest stream, then the buffer's valid
    entries through the persist flow into the target table (§3.1 → §3.2)."""
    import os
    from ..session import new_run_dir
    from ..sources.kafka import read_replay_stream
    from ..streaming.ingest import read_buffer, start_ingest
    from ..streaming.persist import PersistFlow
    configure(spark)
    run = new_run_dir(spark, "e2e")
    src, out = os.path.join(run, "source"), os.path.join(run, "buffer")
    _replay_files(td.order_records(spark, sf_dir), src, 16, "offset")
    q = start_ingest(read_replay_stream(spark, src, max_files_per_trigger=8),
                     lambda: corpus_registry(spark), out, os.path.join(run, "ck-ingest"),
                     trigger={"availableNow": True})
    q.awaitTermination()
    flow = PersistFlow(spark, os.path.join(run, "state"))
    stream = spark.readStream.schema(read_buffer(spark, out).schema).parquet(out)
    entries = stream.where(F.col("status") == "valid").select(*buf.ENTRY_COLUMNS)
    p = flow.start(entries, os.path.join(run, "ck-persist"), trigger={"availableNow": True})
    p.awaitTermination()
    return flow.target_frame().select(*per.ITEM_COLUMNS)


def _store(spark, path: str):
    """``write(items, batch)`` of an external item store kept in ``path``: ids with
    ``seq % 5 = 0`` are refused on their first put, ids with ``seq % 11 = 0`` for good.
    What it answers depends on the put alone, so any task may retry any item."""
    from ..sources.store import put_batch, register_store

    def put(items, attempt):
        return [i["id"] for i in items if i["seq"] % 11 == 0 or i["seq"] % 5 == 0 and attempt == 1]

    name = register_store(spark, put, "query_store")
    return lambda items, batch: put_batch(items, path, batch, name, chunkSize=25, attempts=3, baseBackoff=0.0)


def q33_external_write_outcome(spark, sf_dir):
    """Items written in chunks of 25 with retries; per-batch outcome of what
    the store still left unprocessed (batches of 1000 entries)."""
    from ..session import new_run_dir
    configure(spark)
    items = env.item(td.buffer_entries(spark, sf_dir), keep=["seq"])
    failed = _store(spark, new_run_dir(spark, "store"))(items, 0)
    batch = items.select((F.col("seq") / 1000).cast("bigint").alias("batch_id"), "id")
    f = failed.join(batch, "id")
    return per.batch_outcome(batch, f)


QUERIES["q32_ingest_to_target"] = q32_ingest_to_target
QUERIES["q33_external_write_outcome"] = q33_external_write_outcome


def _address_messages(spark, sf_dir):
    """``customer`` joined to ``nation`` and ``region`` -> address v1/v2 messages.

    v1 for even keys, v2 (with ``country``) for odd keys; faults: ``city``
    missing when ``c_custkey % 7 = 0``, ``postalCode`` a number when
    ``% 5 = 0``, ``country`` a number when ``% 11 = 0``.  The dimension joins
    are left to the optimizer (both sides are tiny and size-checked by it).
    """
    c = td.table(spark, sf_dir, "customer")
    n = td.table(spark, sf_dir, "nation")
    r = td.table(spark, sf_dir, "region")
    j = (c.join(n, c.c_nationkey == n.n_nationkey, "left")
         .join(r, n.n_regionkey == r.r_regionkey, "left"))
    k = F.col("c_custkey")
    s = lambda x: x.cast("string")
    street = F.concat(F.lit('{"street":"Street '), s(k), F.lit('"'))
    city = F.when(k % 7 == 0, F.lit("")).otherwise(F.concat(F.lit(',"city":"'), F.col("n_name"), F.lit('"')))
    postal = F.when(k % 5 == 0, F.concat(F.lit(',"postalCode":'), s(k))) \
        .otherwise(F.concat(F.lit(',"postalCode":"P'), s(k), F.lit('"')))
    country = F.when(k % 11 == 0, F.concat(F.lit(',"country":'), s(k))) \
        .otherwise(F.concat(F.lit(',"country":"'), F.col("r_name"), F.lit('"')))
    version = F.when(k % 2 == 0, F.lit("1.0.0")).otherwise(F.lit("2.0.0"))
    data = F.concat(street, city, postal, F.when(k % 2 == 1, country).otherwise(F.lit("")), F.lit("}"))
    return j.select(k.alias("c_custkey"), F.lit("address-topic").alias("origin"),
                    F.concat(F.lit("http://schema-repository:8080/schemas/address/"), version).alias("schemaURI"),
                    F.lit("2024-01-01 00:00:00").cast("timestamp").alias("timestamp"), data.alias("data"))


def q34_address_versions(spark, sf_dir):
    """Address messages of both versions (joined from three tables) validated."""
    configure(spark)
    out = val.validate(_address_messages(spark, sf_dir), corpus_registry(spark))
    return out.select("c_custkey", "schemaURI", "status", "reason", _joined(F.col("errors")).alias("errors"))


def q35_user_email(spark, sf_dir):
    """``customer`` -> user/1.0.0 messages validated with ``format: email`` asserted."""
    configure(spark)
    c = td.table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    email = (F.when(k % 13 == 0, F.lit(""))
             .when(k % 9 == 0, F.concat(F.lit(',"email":"c'), k.cast("string"), F.lit('.example.com"')))
             .otherwise(F.concat(F.lit(',"email":"c'), k.cast("string"), F.lit('@example.com"'))))
    data = F.concat(F.lit('{"id":'), k.cast("string"), F.lit(',"name":"'), F.col("c_name"), F.lit('"'), email,
                    F.lit("}"))
    msgs = c.select(k.alias("c_custkey"), F.lit("user-topic").alias("origin"),
                    F.lit("http://schema-repository:8080/schemas/user/1.0.0").alias("schemaURI"),
                    F.lit("2024-01-01 00:00:00").cast("timestamp").alias("timestamp"), data.alias("data"))
    out = val.validate(msgs, corpus_registry(spark), assert_email=True)
    return _outcome(out, "c_custkey")


QUERIES["q34_address_versions"] = q34_address_versions
QUERIES["q35_user_email"] = q35_user_email


def _base() -> str:
    from ..functions.routes import DEFAULT_REGISTRY_BASE
    return DEFAULT_REGISTRY_BASE


def q36_schema_per_supplier(spark, sf_dir):
    """One schema per supplier, folded from a change log, and one message per
    line item: arrays of objects, ``anyOf``, hundreds of schemas (``auto``)."""
    configure(spark)
    k = F.col("s_suppkey")
    log = td.table(spark, sf_dir, "supplier").select(
        k.alias("seq"), F.lit("set").alias("op"), F.concat(F.lit("supplier"), k.cast("string")).alias("name"),
        F.lit("1").alias("version"), F.concat(
            F.lit('{"type":"object","required":["lines"],"properties":{"lines":{"type":"array","items":{"type":"object",'
                  '"required":["qty"],"properties":{"qty":{"type":"integer","minimum":1,"maximum":'),
            (k % 41 + 10).cast("string"),
            F.lit('},"flag":{"enum":["A","N","R"]}}}},"note":{"anyOf":[{"type":"string","maxLength":1},'
                  '{"type":"number","minimum":10}]}}}')).alias("schema"))
    i, n = td.table(spark, sf_dir, "lineitem"), F.col("l_linenumber")
    qty = F.when(n % 5 == 0, F.lit("")).otherwise(
        F.concat(F.lit('"qty":'), F.col("l_quantity").cast("bigint").cast("string"), F.lit(",")))
    note = F.when(n % 3 == 0, F.lit('"x"')).when(n % 3 == 1, (n * 5).cast("string")).otherwise(F.lit('"long"'))
    messages = i.select(
        "l_orderkey", "l_linenumber", F.lit("lines-topic").alias("origin"),
        F.concat(F.lit(f"{_base()}/schemas/supplier"), F.col("l_suppkey").cast("string"), F.lit("/1.0")).alias("schemaURI"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("timestamp"),
        F.concat(F.lit('{"lines":[{'), qty, F.lit('"flag":"'), F.col("l_returnflag"), F.lit('"}],"note":'), note,
                 F.lit("}")).alias("data"))
    out = val.validate(messages, reg.fold_log(log).cache())
    return out.select("l_orderkey", "l_linenumber", "status", "reason", _joined(F.col("errors")).alias("errors"))


ORDER_LINES_SCHEMA = (
    '{"$defs":{"line":{"type":"object","required":["part","qty"],"properties":{"part":{"type":"integer"},'
    '"qty":{"maximum":45},"ship":{"const":{"mode":["AIR"],"fee":1.50}}}}},"type":"object","required":["lines"],'
    '"properties":{"lines":{"type":"array","minItems":2,"items":{"$ref":"#/$defs/line"},'
    '"contains":{"required":["qty"],"properties":{"qty":{"minimum":40}}}}},"additionalProperties":{"type":"string"}}')


def q37_order_lines(spark, sf_dir):
    """Each order's lines as one array of objects, against local definitions,
    ``contains``, a constant object and a schema for other properties.  Each
    design takes the orders of one parity; both must agree with the oracle."""
    configure(spark)
    n = F.col("l_linenumber")
    ship = F.when(n % 2 == 0, F.lit(',"ship":{"fee":1.5,"mode":["AIR"]}')).when(
        n % 7 == 3, F.lit(',"ship":{"fee":1.5,"mode":["RAIL"]}')).otherwise(F.lit(""))
    qty = F.when(n % 5 == 0, F.lit("")).otherwise(
        F.concat(F.lit(',"qty":'), F.col("l_quantity").cast("bigint").cast("string")))
    lines = td.table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct(
        "l_linenumber", F.concat(F.lit('{"part":'), F.col("l_partkey").cast("string"), qty, ship, F.lit("}")).alias("t")))).alias("l"))
    other = F.when(F.col("l_orderkey") % 4 == 0, F.lit("5")).otherwise(F.lit('"x"'))
    messages = lines.select(
        "l_orderkey", F.lit("lines-topic").alias("origin"), F.lit(f"{_base()}/schemas/lines/1.0.0").alias("schemaURI"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("timestamp"),
        F.concat(F.lit('{"lines":['), F.array_join(F.col("l.t"), ","), F.lit('],"other":'), other, F.lit("}")).alias("data"))
    registry = spark.createDataFrame([(f"{_base()}/schemas/lines/1.0.0", ORDER_LINES_SCHEMA)],
                                     "schemaURI string, schema string")
    parts = [val.validate(messages.where(F.col("l_orderkey") % 2 == i), registry, design=d)
             for i, d in enumerate(("compiled", "rules"))]
    return _outcome(parts[0].unionByName(parts[1]), "l_orderkey")


def q38_two_topics(spark, sf_dir):
    """Records of two topics that agree in partition, offset and time: every one
    keeps an entry of its own through ids, group read and arrival order."""
    configure(spark)
    e = td.event_records(spark, sf_dir)
    both = e.withColumn("topic", F.lit("left-topic")).unionByName(e.withColumn("topic", F.lit("right-topic")))
    entries = buf.assign_ids(env.to_envelope(both)).select(*buf.ENTRY_COLUMNS)
    group = buf.read_group(entries, entries.where(F.col("seq") % 2 == 0))
    return group.select("id", "seq", "origin")


QUERIES["q36_schema_per_supplier"] = q36_schema_per_supplier
QUERIES["q37_order_lines"] = q37_order_lines
QUERIES["q38_two_topics"] = q38_two_topics


def q39_external_flow(spark, sf_dir):
    """Entries in three batches through the persist flow into an external store
    that leaves some items unprocessed after retries: outcome per batch, and
    what is pending at the end (batch -1)."""
    import os
    from ..session import new_run_dir
    from ..streaming.persist import PersistFlow
    configure(spark)
    run = new_run_dir(spark, "external")
    flow = PersistFlow(spark, os.path.join(run, "state"), write=_store(spark, os.path.join(run, "store")))
    entries = td.buffer_entries(spark, sf_dir)
    for i in range(3):
        flow.run_batch(entries.where(F.col("seq") % 3 == i), i)
    left = flow.pending_frame().agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(-1).cast("bigint").alias("batch_id"), "n", F.lit(0).cast("bigint").alias("persisted_count"),
        F.col("n").alias("unpersisted_count"), F.lit("pending").alias("verdict"))
    return flow.outcome_frame().select(*left.columns).unionByName(left)


def q40_registry_log(spark, sf_dir):
    """The change log appended to a durable table in two runs, and read back."""
    import os
    from ..session import new_run_dir
    configure(spark)
    path = os.path.join(new_run_dir(spark, "registry-log"), "log")
    log = td.registry_change_log(spark, sf_dir)
    half = log.agg(F.percentile_approx("seq", 0.5)).first()[0]
    for part in (F.col("seq") <= half, F.col("seq") > half):
        reg.append_log(spark, path, log.where(part))
    state = reg.fold_log(reg.read_log(spark, path))
    return state.select("key", "name", semver_text("version").alias("version"), "schemaURI", "schema")


QUERIES["q39_external_flow"] = q39_external_flow
QUERIES["q40_registry_log"] = q40_registry_log

from .streamed import STREAMED  # noqa: E402 - its queries use the helpers above

QUERIES.update(STREAMED)
