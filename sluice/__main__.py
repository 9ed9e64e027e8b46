"""Command line: run the ingest and persist flows as Spark applications.

    python -m sluice ingest  --brokers b1:9092,b2:9092 --topics a-topic,b-topic \\
                             --registry s3a://bucket/schemas --out s3a://bucket/buffer
    python -m sluice persist --buffer s3a://bucket/buffer --state s3a://bucket/target \\
                             --read-count 25 --tick "1 second"
    python -m sluice register --registry s3a://bucket/schemas --log s3a://bucket/registry-log
    python -m sluice get      --log s3a://bucket/registry-log order 2.0.0
    python -m sluice delete   --log s3a://bucket/registry-log order 2.0.0
    python -m sluice produce  --out s3a://bucket/records --rows-per-second 10

``--replay <path>`` reads stored Kafka records (parquet with the Kafka source
schema) instead of a broker.  Checkpoints go under ``spark.checkpoint.dir``
unless ``--checkpoint`` is given.  ``--once`` processes what is available and
stops (``availableNow``); otherwise the stream runs until stopped.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .functions.routes import DEFAULT_REGISTRY_BASE


def _session() -> SparkSession:
    from .session import configure
    spark = SparkSession.builder.appName("sluice").getOrCreate()
    return configure(spark)


def _trigger(args) -> dict:
    return {"availableNow": True} if args.once else {"processingTime": args.tick}


def _registry_loader(spark: SparkSession, args):
    from .operators.registry import fold_log, read_log, registry_from_corpus
    if args.log:
        return lambda: fold_log(read_log(spark, args.log))
    return lambda: registry_from_corpus(spark, args.registry, args.base)


def cmd_ingest(args) -> int:
    from .session import scratch_path
    from .sources.kafka import read_kafka_stream, read_replay_stream
    from .streaming.ingest import start_ingest
    spark = _session()
    if args.replay:
        records = read_replay_stream(spark, args.replay, args.max_files_per_trigger)
    else:
        records = read_kafka_stream(spark, args.brokers, args.topics,
                                    max_offsets_per_trigger=args.max_poll_records)
    ck = args.checkpoint or scratch_path(spark, "ingest-checkpoint")
    q = start_ingest(records, _registry_loader(spark, args), args.out, ck, trigger=_trigger(args))
    q.awaitTermination()
    return 0


def cmd_persist(args) -> int:
    from .operators.buffer import ENTRY_COLUMNS
    from .session import scratch_path
    from .streaming.ingest import read_buffer
    from .streaming.persist import PersistFlow
    spark = _session()
    # the buffer's folders carry ``batch`` and ``status`` partitions; the file
    # stream adds them as columns, so only valid entries are selected
    reader = spark.readStream.schema(read_buffer(spark, args.buffer).schema)
    if args.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(args.max_files_per_trigger))
    if args.clean_source:
        # Retention: files of committed batches are deleted by the source (a
        # batch's files go once the next batch starts).
        # Unacknowledged entries live on in the flow's pending tables, and only
        # the valid folders are read, so reject files stay for inspection.
        entries = (reader.option("cleanSource", "delete")
                   .parquet(f"{args.buffer}/*/*/status=valid").select(*ENTRY_COLUMNS))
    else:
        entries = reader.parquet(args.buffer).where(F.col("status") == "valid").select(*ENTRY_COLUMNS)
    flow = PersistFlow(spark, args.state, read_count=args.read_count)
    ck = args.checkpoint or scratch_path(spark, "persist-checkpoint")
    q = flow.start(entries, ck, trigger=_trigger(args))
    q.awaitTermination()
    if args.once:
        flow.drain()
        left = flow.pending_frame()
        if left is not None and not left.isEmpty():
            print("entries are still pending: the store refused them", file=sys.stderr)
            return 1
    return 0


def cmd_produce(args) -> int:
    """Generated records at a fixed rate, to a broker or as stored Kafka records."""
    from .operators.envelope import KAFKA_SCHEMA
    from .session import scratch_path
    from .sources.generator import generate_stream
    from .sources.kafka import to_kafka_frame, write_kafka_stream
    spark = _session()
    records = generate_stream(spark, rows_per_second=args.rows_per_second, base=args.base or DEFAULT_REGISTRY_BASE)
    frame = to_kafka_frame(records)
    ck = args.checkpoint or scratch_path(spark, "produce-checkpoint")
    if args.out:
        names = [f.name for f in KAFKA_SCHEMA.fields]
        stored = {"key": F.lit(None).cast("binary"), "partition": F.col("partition"), "offset": F.col("seed"),
                  "timestamp": F.col("timestamp"), "timestampType": F.lit(0)}
        frame = to_kafka_frame(records, keep=["partition", "seed", "timestamp"]).withColumns(stored).select(*names)
        q = (frame.writeStream.format("parquet").option("checkpointLocation", ck)
             .trigger(processingTime=args.tick).start(args.out))
    else:
        q = write_kafka_stream(frame, args.brokers, ck)
    q.awaitTermination(args.seconds)
    from .streaming.progress import stop_after_current_batch
    stop_after_current_batch(q)
    return 0


def cmd_get(args) -> int:
    from .functions.semver import semver_text
    from .operators.registry import fold_log, lookup, read_log
    spark = _session()
    row = lookup(fold_log(read_log(spark, args.log)), args.name, args.version) \
        .select(semver_text("version").alias("v"), "schema").first()
    if row is None:
        print(f"no entry {args.name} {args.version}", file=sys.stderr)
        return 1
    print(row["schema"])
    return 0


def cmd_delete(args) -> int:
    from .operators.registry import delete_entry
    if not delete_entry(_session(), args.log, args.name, args.version):
        print(f"no entry {args.name} {args.version}", file=sys.stderr)
        return 1
    return 0


def cmd_register(args) -> int:
    from .operators.registry import RegistrationError, register_corpus
    spark = _session()
    try:
        reg = register_corpus(spark, args.registry, args.base, args.log)
    except RegistrationError as e:
        print(str(e), file=sys.stderr)
        return 1
    for r in reg.select("key", "schemaURI").orderBy("key").toLocalIterator():
        print(r["key"], r["schemaURI"])
    return 0


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="sluice")
    sub = p.add_subparsers(dest="cmd", required=True)

    i = sub.add_parser("ingest", help="Kafka records -> validated buffer + rejects")
    i.add_argument("--brokers", default="localhost:9092", help="CSV of bootstrap servers")
    i.add_argument("--topics", default="")
    i.add_argument("--replay", help="stored Kafka records instead of a broker")
    i.add_argument("--registry", help="folder of schema documents (default: bundled corpus)")
    i.add_argument("--out", required=True, help="buffer/outcome folder")
    i.add_argument("--max-poll-records", type=int, default=None, help="maxOffsetsPerTrigger")
    i.set_defaults(func=cmd_ingest)

    s = sub.add_parser("persist", help="buffer -> target table, acknowledging what persisted")
    s.add_argument("--buffer", required=True)
    s.add_argument("--state", required=True, help="target / pending / outcomes folder")
    s.add_argument("--read-count", type=int, default=None, help="cap per list and read (None: no cap)")
    s.add_argument("--clean-source", action="store_true",
                   help="delete buffer files once their batch has committed (valid folders only)")
    s.set_defaults(func=cmd_persist)

    r = sub.add_parser("register", help="check and list a schema corpus")
    r.add_argument("--registry", help="folder of schema documents (default: bundled corpus)")
    r.set_defaults(func=cmd_register)

    for name, func, text in (("get", cmd_get, "print a registered document"),
                             ("delete", cmd_delete, "remove a registered document")):
        g = sub.add_parser(name, help=text)
        g.add_argument("--log", required=True, help="change-log table of the registry")
        g.add_argument("name")
        g.add_argument("version")
        g.set_defaults(func=func)

    d = sub.add_parser("produce", help="generated records -> broker or stored records")
    d.add_argument("--brokers", default="localhost:9092", help="CSV of bootstrap servers")
    d.add_argument("--out", help="store Kafka records here instead of sending them")
    d.add_argument("--rows-per-second", type=int, default=10)
    d.add_argument("--seconds", type=int, default=None, help="stop after so long (default: run until stopped)")
    d.add_argument("--tick", default="1 second")
    d.add_argument("--checkpoint")
    d.set_defaults(func=cmd_produce)

    for sp in (i, r, d):
        sp.add_argument("--base", help="base URI of documents whose $id is relative")
    for sp in (i, r):
        sp.add_argument("--log", help="change-log table of the registry (durable)")
    for sp in (i, s):
        sp.add_argument("--max-files-per-trigger", type=int, default=None)
        sp.add_argument("--checkpoint")
        sp.add_argument("--tick", default="1 second")
        sp.add_argument("--once", action="store_true", help="process what is available, then stop")
    return p


def main(argv: list[str] | None = None) -> int:
    args = build_parser().parse_args(argv)
    return args.func(args)


if __name__ == "__main__":
    sys.exit(main())
