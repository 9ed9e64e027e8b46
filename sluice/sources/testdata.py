"""Message frames derived from the driver's tables.

Every builder reads a given table and derives Kafka-shaped records or
envelopes from it with column expressions only, so the work grows with the
table.  The DuckDB twins of these expressions live in ``sluice.plans.oracle``
and build byte-identical payload text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.routes import DEFAULT_REGISTRY_BASE

ORDER_V2_URI = f"{DEFAULT_REGISTRY_BASE}/schemas/order/2.0.0"
PRODUCT_V1_URI = f"{DEFAULT_REGISTRY_BASE}/schemas/product/1.0.0"
PRODUCT_V2_URI = f"{DEFAULT_REGISTRY_BASE}/schemas/product/2.0.0"
UNKNOWN_URI = f"{DEFAULT_REGISTRY_BASE}/schemas/nope/1.0.0"
ACCOUNT_URI = f"{DEFAULT_REGISTRY_BASE}/schemas/account/1.0.0"


# Fixed-size dimension tables: broadcast as read.
DIMENSIONS = {"nation", "region"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table.  The small test tables are one file of one row group,
    which is one input split, so such a fact table is dealt to the default
    parallelism; a table of several files is left as read."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if name in DIMENSIONS or len(df.inputFiles()) != 1:
        return df
    return df.repartition(spark.sparkContext.defaultParallelism)


def _s(c: Column) -> Column:
    return c.cast("string")


def _header(key: str, value: Column) -> Column:
    return F.struct(F.lit(key).alias("key"), value.cast("binary").alias("value"))


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` -> Kafka records on ``order-topic`` carrying order/2.0.0 payloads.

    Faults by ``o_orderkey % 20``: 0 truncated JSON, 1 null productIds,
    2 orderId as text, 3 no schemaURI header, 4 unregistered schema,
    5 missing total; otherwise a full order whose status maps O→pending,
    F→delivered, P→partial (outside the enum).  Residue 7 carries a decoy
    header first and a second schemaURI header last (first one wins).
    """
    o = table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    r = k % 20
    status = (F.when(F.col("o_orderstatus") == "O", "pending")
              .when(F.col("o_orderstatus") == "F", "delivered").otherwise("partial"))
    total = _s(F.round("o_totalprice").cast("bigint"))
    head = F.concat(F.lit('{"orderId":'), _s(k), F.lit(',"userId":'), _s(c))
    data = (F.when(r == 0, F.concat(F.lit('{"orderId":'), _s(k)))
            .when(r == 1, F.concat(head, F.lit(',"productIds":null,"total":1.5}')))
            .when(r == 2, F.concat(F.lit('{"orderId":"'), _s(k), F.lit('","userId":'), _s(c),
                                   F.lit(',"productIds":[1],"total":1.5}')))
            .when(r == 5, F.concat(head, F.lit(',"productIds":[1]}')))
            .otherwise(F.concat(head, F.lit(',"productIds":['), _s(c % 2000),
                                F.lit('],"total":'), total, F.lit(',"status":"'), status, F.lit('"}'))))
    uri = F.when(r == 4, F.lit(UNKNOWN_URI)).otherwise(F.lit(ORDER_V2_URI))
    headers = (F.when(r == 3, F.array().cast("array<struct<key:string,value:binary>>"))
               .when(r == 7, F.array(_header("traceId", _s(k)), _header("schemaURI", uri),
                                     _header("schemaURI", F.lit(UNKNOWN_URI))))
               .otherwise(F.array(_header("schemaURI", uri))))
    return o.select(
        F.lit(None).cast("binary").alias("key"),
        data.cast("binary").alias("value"),
        F.lit("order-topic").alias("topic"),
        (k % 10).cast("int").alias("partition"),
        k.alias("offset"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
        headers.alias("headers"),
    )


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` -> Kafka records: topic ``<event_type>-topic``, partition
    ``user_id % 10``, offset ``event_id``, value ``props``; headers by
    ``event_id % 4``: none / one / two schemaURI headers / a ``schemauri``
    header in another case (which does not count).
    """
    e = table(spark, sf_dir, "events")
    i = F.col("event_id")
    uri = F.concat(F.lit(f"{DEFAULT_REGISTRY_BASE}/schemas/"), F.col("event_type"), F.lit("/1.0.0"))
    headers = (F.when(i % 4 == 0, F.array().cast("array<struct<key:string,value:binary>>"))
               .when(i % 4 == 1, F.array(_header("schemaURI", uri)))
               .when(i % 4 == 2, F.array(_header("other", F.lit("x")), _header("schemaURI", uri),
                                         _header("schemaURI", F.lit("second"))))
               .otherwise(F.array(_header("schemauri", uri))))
    return e.select(
        F.lit(None).cast("binary").alias("key"),
        F.col("props").cast("binary").alias("value"),
        F.concat(F.col("event_type"), F.lit("-topic")).alias("topic"),
        (F.col("user_id") % 10).cast("int").alias("partition"),
        i.alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
        headers.alias("headers"),
    )


def event_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` -> envelope + ``event_id`` (no Kafka step)."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id"),
        F.concat(F.col("event_type"), F.lit("-topic")).alias("origin"),
        F.concat(F.lit(f"{DEFAULT_REGISTRY_BASE}/schemas/"), F.col("event_type"),
                 F.lit("/1.0.0")).alias("schemaURI"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("props").alias("data"),
    )


def buffer_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buffer entries from ``events``: ``id`` = ``<unix millis>-<event_id>``,
    ``seq`` = ``event_id`` (arrival order), plus the envelope.  (Entries of
    Kafka records get theirs from ``buffer.assign_ids``.)"""
    env = event_envelopes(spark, sf_dir)
    return env.select(
        F.concat(_s(F.unix_millis("timestamp")), F.lit("-"), _s(F.col("event_id"))).alias("id"),
        F.col("event_id").alias("seq"),
        "origin", "schemaURI", "timestamp", "data")


def product_records(spark: SparkSession, sf_dir: str, version: int = 1) -> DataFrame:
    """``part`` -> envelopes carrying product payloads.

    version 1: ``category`` absent when ``p_partkey % 3 = 0``, null when
    ``% 3 = 1``, else ``p_type``; version 2 adds ``tags`` from ``p_brand``
    (absent when ``p_partkey % 4 = 0``).  ``name`` is missing when
    ``p_partkey % 11 = 0`` and ``price`` is text when ``% 13 = 0``.
    """
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    name = F.when(k % 11 == 0, F.lit("")).otherwise(
        F.concat(F.lit(',"name":"'), F.col("p_name"), F.lit('"')))
    price = F.when(k % 13 == 0, F.concat(F.lit(',"price":"'), _s(F.col("p_retailprice")), F.lit('"'))) \
        .otherwise(F.concat(F.lit(',"price":'), _s(F.col("p_retailprice"))))
    cat = (F.when(k % 3 == 0, F.lit(""))
           .when(k % 3 == 1, F.lit(',"category":null'))
           .otherwise(F.concat(F.lit(',"category":"'), F.col("p_type"), F.lit('"'))))
    parts = [F.lit('{"id":'), _s(k), name, price, cat]
    uri = PRODUCT_V1_URI
    if version == 2:
        uri = PRODUCT_V2_URI
        parts.append(F.when(k % 4 == 0, F.lit("")).otherwise(
            F.concat(F.lit(',"tags":["'), F.col("p_brand"), F.lit('","size-'),
                     _s(F.col("p_size")), F.lit('"]'))))
    parts.append(F.lit("}"))
    return p.select(
        k.alias("p_partkey"),
        F.lit("product-topic").alias("origin"),
        F.lit(uri).alias("schemaURI"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("timestamp"),
        F.concat(*parts).alias("data"),
    )


def account_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` -> envelopes for the account schema (``minimum`` and a
    ``$ref`` to the owner schema).  Residue ``c_custkey % 7 = 0`` puts a
    number in ``owner.name``."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    owner = F.when(k % 7 == 0, F.concat(F.lit('{"name":'), _s(k), F.lit("}"))) \
        .otherwise(F.concat(F.lit('{"name":"'), F.col("c_name"), F.lit('"}')))
    data = F.concat(F.lit('{"id":'), _s(k), F.lit(',"balance":'), _s(F.col("c_acctbal")),
                    F.lit(',"segment":"'), F.col("c_mktsegment"), F.lit('","owner":'), owner, F.lit("}"))
    return c.select(
        k.alias("c_custkey"),
        F.lit("account-topic").alias("origin"),
        F.lit(ACCOUNT_URI).alias("schemaURI"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("timestamp"),
        data.alias("data"),
    )


def registry_change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` -> registry change log: seq = ``o_orderkey``, name =
    ``s<o_custkey % 50>``, version ``1.<o_custkey % 3>`` (so ``1.0`` and
    ``1.0.0`` collide after normalisation when ``o_orderkey % 2 = 0``),
    op = del when ``o_orderstatus = 'P'`` else set."""
    o = table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    ver = F.when(k % 2 == 0, F.concat(F.lit("1."), _s(c % 3)))\
        .otherwise(F.concat(F.lit("1."), _s(c % 3), F.lit(".0")))
    return o.select(
        k.alias("seq"),
        F.when(F.col("o_orderstatus") == "P", "del").otherwise("set").alias("op"),
        F.concat(F.lit("s"), _s(c % 50)).alias("name"),
        ver.alias("version"),
        F.concat(F.lit('{"type":"object","title":"v'), _s(k), F.lit('"}')).alias("schema"),
    )
