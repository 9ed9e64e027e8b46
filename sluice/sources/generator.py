"""Typed synthetic records (SRC-5, PRJ-8, PRJ-10).

Seeds come from a frame (any integral column ``seed``); each seed picks one of
the nine (entity, version) pairs round-robin and gets field values from
``xxhash64(seed, field)``, so the output is deterministic and grows with the
seed frame.  Field types follow the schema documents (compiled with
``struct_type_of``); optional fields are sometimes omitted.  Payload text is
built field by field so that a required field can be an explicit ``null``
while an absent optional one is left out, as a typed encoder with
``omitempty`` on optional fields does.

``zero_values=True`` reproduces the faithful producer, which replaced the
order/payment/product v2 records with zero values: order v2 then carries
``"productIds":null`` and is the one invalid record in every nine.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.routes import DEFAULT_REGISTRY_BASE, schema_uri, topic_of
from ..operators.registry import corpus_dir

# The producer's round-robin order of (entity, version).
ROUND_ROBIN = [
    ("user", "1.0.0"), ("address", "1.0.0"), ("order", "1.0.0"), ("payment", "1.0.0"),
    ("product", "1.0.0"), ("address", "2.0.0"), ("order", "2.0.0"), ("payment", "2.0.0"),
    ("product", "2.0.0"),
]
ZEROED = {("order", "2.0.0"), ("payment", "2.0.0"), ("product", "2.0.0")}


def _docs() -> dict:
    out = {}
    for name, ver in ROUND_ROBIN:
        with open(os.path.join(corpus_dir(), f"{name}-{ver}.json")) as f:
            out[(name, ver)] = json.load(f)
    return out


def _json_of(c: Column) -> Column:
    """JSON text of a scalar or array column (``null`` for NULL)."""
    t = F.to_json(F.array(c))
    return F.substring(t, F.lit(2), F.length(t) - 2)


def _h(seed: Column, tag: str) -> Column:
    return F.xxhash64(seed, F.lit(tag))


def _value(seed: Column, field: str, node: dict) -> Column:
    t = node.get("type")
    if "enum" in node:
        vals = node["enum"]
        return F.element_at(F.array(*[F.lit(v) for v in vals]),
                            (F.pmod(_h(seed, field), F.lit(len(vals))) + 1).cast("int"))
    if t == "integer":
        return F.pmod(_h(seed, field), F.lit(1_000_000))
    if t == "number":
        return (F.pmod(_h(seed, field), F.lit(10_000_000)) / 100).cast("double")
    if t == "string":
        word = F.substring(F.hex(_h(seed, field)), 1, 8)
        if node.get("format") == "email":
            return F.concat(F.lower(word), F.lit("@example.com"))
        return F.lower(word)
    if t == "array":
        item = node.get("items", {})
        n = (F.pmod(_h(seed, field + "#n"), F.lit(3)) + 1).cast("int")
        elems = [_value(_h(seed, f"{field}#{i}"), f"{field}[{i}]", item) for i in range(3)]
        return F.slice(F.array(*elems), F.lit(1), n)
    return F.lit(None).cast("string")


def _zero(node: dict) -> Column:
    t = node.get("type")
    if t == "integer":
        return F.lit(0)
    if t == "number":
        return F.lit(0)
    if t == "string":
        return F.lit("")
    return F.lit(None).cast("string")  # nil slice / pointer


def _payload(seed: Column, doc: dict, zero: bool) -> Column:
    req = set(doc.get("required", []))
    frags = []
    for field, node in doc.get("properties", {}).items():
        name = F.lit(json.dumps(field) + ":")
        if zero:
            if field not in req:
                continue  # omitempty: zero optional fields are left out
            frags.append(F.concat(name, _json_of(_zero(node))))
            continue
        frag = F.concat(name, _json_of(_value(seed, field, node)))
        if field not in req:
            frag = F.when(F.pmod(_h(seed, field + "#opt"), F.lit(4)) != 0, frag)
        frags.append(frag)
    return F.concat(F.lit("{"), F.concat_ws(",", *frags), F.lit("}"))


def generate(seeds: DataFrame, zero_values: bool = False,
             base: str = DEFAULT_REGISTRY_BASE) -> DataFrame:
    """Seed frame -> envelopes ``(seed, origin, partition, schemaURI, timestamp, data)``."""
    docs = _docs()
    s = F.col("seed")
    slot = F.pmod(s, F.lit(len(ROUND_ROBIN)))
    name = data = version = None
    for i, (n, v) in enumerate(ROUND_ROBIN):
        p = _payload(s, docs[(n, v)], zero_values and (n, v) in ZEROED)
        name = F.when(slot == i, F.lit(n)) if name is None else name.when(slot == i, F.lit(n))
        version = F.when(slot == i, F.lit(v)) if version is None else version.when(slot == i, F.lit(v))
        data = F.when(slot == i, p) if data is None else data.when(slot == i, p)
    staged = seeds.select(s, name.alias("name"), version.alias("version"), data.alias("data"))
    return staged.select(
        "seed",
        topic_of("name").alias("origin"),
        F.pmod(F.xxhash64("seed"), F.lit(10)).cast("int").alias("partition"),
        schema_uri(F.col("name"), F.col("version"), base).alias("schemaURI"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("seed")).alias("timestamp"),
        "data")


def generate_stream(spark, rows_per_second: int = 10, zero_values: bool = False,
                    base: str = DEFAULT_REGISTRY_BASE) -> DataFrame:
    """Streaming generator: a ``rate`` source supplies the seeds (the producer's
    fixed cadence, 10 records/s by default)."""
    seeds = (spark.readStream.format("rate").option("rowsPerSecond", str(rows_per_second)).load()
             .select(F.col("value").alias("seed")))
    return generate(seeds, zero_values=zero_values, base=base)
