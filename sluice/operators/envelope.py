"""Kafka record -> envelope and the envelope's other forms (PRJ-1..7, PRD-2, PRD-6).

Envelope: ``origin STRING, schemaURI STRING, timestamp TIMESTAMP, data STRING``.
``data`` stays raw JSON text end to end; only the validator parses it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timefmt import ZERO_TIME, parse_rfc3339, rfc3339

# Envelope field names in their wire order, and the header name.
FIELD_NAMES = ("origin", "schemaURI", "timestamp", "data")
SCHEMA_HEADER = "schemaURI"

ENVELOPE_SCHEMA = T.StructType([
    T.StructField("origin", T.StringType()),
    T.StructField("schemaURI", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("data", T.StringType()),
])

KAFKA_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
    T.StructField("headers", T.ArrayType(T.StructType([
        T.StructField("key", T.StringType()),
        T.StructField("value", T.BinaryType()),
    ]))),
])


def first_header(headers: Column | str, name: str = SCHEMA_HEADER) -> Column:
    """Text of the first header whose key equals ``name`` (case-sensitive); '' if none (PRJ-1)."""
    h = F.col(headers) if isinstance(headers, str) else headers
    # array_position is 1-based (0 when absent); get() is NULL out of range.
    # No lambda, so the projection stays in whole-stage codegen.
    pos = F.array_position(h.getField("key"), F.lit(name))
    hit = F.get(h, (pos - 1).cast("int"))
    return F.coalesce(hit["value"].cast("string"), F.lit(""))


def skip_tombstones(records: DataFrame) -> DataFrame:
    """Drop records without a value (PRD-6)."""
    return records.where(F.col("value").isNotNull())


def to_envelope(records: DataFrame, keep_coordinates: bool = True) -> DataFrame:
    """Kafka-shaped frame -> envelope (PRJ-2).

    With ``keep_coordinates`` the record's ``partition`` and ``offset`` are
    kept: they identify the record for buffer ids and ordering.
    """
    cols = [
        F.col("topic").alias("origin"),
        first_header("headers").alias("schemaURI"),
        F.col("timestamp").cast("timestamp").alias("timestamp"),
        F.col("value").cast("string").alias("data"),
    ]
    if keep_coordinates:
        cols += [F.col("partition"), F.col("offset")]
    return records.select(*cols)


def field_list(df: DataFrame) -> Column:
    """Envelope -> 8 strings ``[name, value, ...]`` in wire order (PRJ-3)."""
    return F.array(
        F.lit("origin"), F.coalesce(F.col("origin"), F.lit("")),
        F.lit("schemaURI"), F.coalesce(F.col("schemaURI"), F.lit("")),
        F.lit("timestamp"), rfc3339("timestamp"),
        F.lit("data"), F.coalesce(F.col("data"), F.lit("")),
    )


def field_map(df: DataFrame) -> Column:
    """Envelope -> ``MAP<STRING,STRING>`` of the four fields (PRJ-4)."""
    return F.map_from_arrays(F.array(*[F.lit(n) for n in FIELD_NAMES]), F.array(
        F.coalesce(F.col("origin"), F.lit("")), F.coalesce(F.col("schemaURI"), F.lit("")),
        rfc3339("timestamp"), F.coalesce(F.col("data"), F.lit(""))))


def field_pairs(df: DataFrame, id_col: str | None = None) -> DataFrame:
    """One row per (name, value) pair of each envelope (PRJ-4, exploded)."""
    keep = [id_col] if id_col else []
    return df.select(*keep, F.explode(field_map(df)).alias("name", "value"))


def from_field_map(fields: Column | str) -> list[Column]:
    """``MAP<STRING,STRING>`` -> envelope columns; missing -> '' / zero time (PRJ-5/6)."""
    m = F.col(fields) if isinstance(fields, str) else fields

    def get(n: str) -> Column:
        return F.coalesce(m.getItem(n), F.lit(""))
    return [get("origin").alias("origin"), get("schemaURI").alias("schemaURI"),
            parse_rfc3339(m.getItem("timestamp")).alias("timestamp"), get("data").alias("data")]


def from_field_list(values: Column | str) -> Column:
    """8-string list -> ``MAP<STRING,STRING>`` (inverse of ``field_list``)."""
    v = F.col(values) if isinstance(values, str) else values
    names = F.filter(v, lambda x, i: i % 2 == 0)
    vals = F.filter(v, lambda x, i: i % 2 == 1)
    return F.map_from_arrays(names, vals)


def item(df: DataFrame, id_col: str = "id", keep: list[str] | None = None) -> DataFrame:
    """Envelope + id -> target item of 5 strings (PRJ-7), plus ``keep`` columns."""
    return df.select(
        F.col(id_col).cast("string").alias("id"),
        rfc3339("timestamp").alias("timestamp"),
        F.coalesce(F.col("origin"), F.lit("")).alias("origin"),
        F.coalesce(F.col("schemaURI"), F.lit("")).alias("schemaURI"),
        F.coalesce(F.col("data"), F.lit("")).alias("data"),
        *(keep or []),
    )


def envelope_ok() -> Column:
    """Envelope required-fields check (PRD-2): all four present, data is JSON."""
    return F.coalesce(
        (F.col("origin") != "") & (F.col("schemaURI") != "")
        & (F.col("timestamp") > ZERO_TIME())
        & F.try_parse_json(F.col("data")).isNotNull(),
        F.lit(False))
