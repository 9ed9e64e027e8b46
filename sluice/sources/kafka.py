"""Kafka source and sink (SRC-1, SNK-3, LIM-2, STR-2/3, FN-6) and file replay.

The Kafka connector is a separate package; where it is on the classpath these
helpers return ordinary Kafka frames.  Every pipeline in this package takes
any frame with the Kafka source schema, so a replay of stored records (parquet
with ``KAFKA_SCHEMA``) drives the same code in tests.

One Spark task reads one Kafka partition, ``maxOffsetsPerTrigger`` bounds a
micro-batch (the consumer's poll cap and back-pressure), and the checkpoint
holds the consumer group's progress: offsets advance only after the batch's
sink has returned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.envelope import KAFKA_SCHEMA, SCHEMA_HEADER


def source_options(brokers: str, topics: str, max_offsets_per_trigger: int | None = None,
                   starting_offsets: str = "earliest", fail_on_data_loss: bool = True,
                   extra: dict[str, str] | None = None) -> dict[str, str]:
    """Options of a Kafka read: CSV brokers, CSV topics, headers included."""
    opts = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topics,
        "includeHeaders": "true",
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger is not None:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    opts.update(extra or {})
    return opts


def read_kafka_stream(spark: SparkSession, brokers: str, topics: str, **kw) -> DataFrame:
    """Streaming Kafka frame (needs the Kafka connector on the classpath)."""
    return spark.readStream.format("kafka").options(**source_options(brokers, topics, **kw)).load()


def read_kafka_batch(spark: SparkSession, brokers: str, topics: str, **kw) -> DataFrame:
    """Batch Kafka frame over the current offsets."""
    kw.pop("max_offsets_per_trigger", None)
    return spark.read.format("kafka").options(**source_options(brokers, topics, **kw)).load()


def read_replay_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame over stored Kafka records (parquet with ``KAFKA_SCHEMA``)."""
    r = spark.readStream.schema(KAFKA_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(path)


def to_kafka_frame(envelopes: DataFrame, topic_col: str = "origin", keep: list[str] | None = None) -> DataFrame:
    """Envelope -> sink frame: topic, JSON value, ``schemaURI`` header, null key
    (SNK-3), and the ``keep`` columns."""
    return envelopes.select(
        *(keep or []),
        F.col(topic_col).alias("topic"),
        F.col("data").cast("binary").alias("value"),
        F.array(F.struct(F.lit(SCHEMA_HEADER).alias("key"),
                         F.col("schemaURI").cast("binary").alias("value"))).alias("headers"))


def write_kafka_stream(frame: DataFrame, brokers: str, checkpoint: str):
    """Start a Kafka sink for a frame built by ``to_kafka_frame``."""
    return (frame.writeStream.format("kafka")
            .option("kafka.bootstrap.servers", brokers)
            .option("checkpointLocation", checkpoint).start())
