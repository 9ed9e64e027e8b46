"""External item store as a Spark data source (SNK-2, STR-6).

``register_store(spark, client)`` makes a batch and streaming sink of any client
``put(items, attempt) -> ids left unprocessed``.  Every task puts its items in
chunks, retries what is left with jittered exponential back-off, and returns a commit
message; the driver makes a batch visible when all its tasks are done and throws
the files of a failed one away, so a batch counts once however often it ran.

Folders under ``path``: ``items/batch=<n>/`` what the store accepted,
``unprocessed/batch=<n>/`` ids it left (one file per task, never gathered on the
driver), ``staging/`` of running batches.
"""

from __future__ import annotations

import random
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from .files import exists, open_path

Client = Callable[[list[dict], int], list[str]]
FORMAT = "item_store"
FLUSH_ROWS = 10_000


@dataclass
class Put(WriterCommitMessage):
    """What one task did: its file in the staging folder, rows accepted and left."""

    stage: str
    file: str
    accepted: int
    left: int


class _Writer:
    """Shared by the batch and the streaming sink; travels to the tasks."""

    def __init__(self, client: Client, options: dict, schema: StructType):
        self.client, self.schema, self.path = client, schema, options["path"]
        self.chunk, self.attempts = int(options.get("chunksize", 25)), int(options.get("attempts", 5))
        self.base, self.most = float(options.get("basebackoff", 0.05)), float(options.get("maxbackoff", 10.0))
        self.stage = f"{self.path}/staging/{uuid.uuid4().hex}"

    def _put(self, items: list[dict]) -> tuple[list[dict], list[str]]:
        """(accepted items, ids still unprocessed after the last attempt) of a chunk."""
        accepted, todo = [], items
        for attempt in range(1, self.attempts + 1):
            left = set(self.client(todo, attempt) or ())
            accepted += [i for i in todo if i["id"] not in left]
            todo = [i for i in todo if i["id"] in left]
            if not todo:
                break
            if attempt < self.attempts:
                time.sleep(min(self.most, self.base * 2 ** (attempt - 1)) * random.random())
        return accepted, [i["id"] for i in todo]

    def write(self, iterator: Iterator) -> Put:
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        system, stage = open_path(self.stage)
        ctx = TaskContext.get()
        name = f"part-{ctx.partitionId():05d}-{ctx.taskAttemptId()}.parquet"
        schema = to_arrow_schema(self.schema)
        ids = pa.schema([("id", pa.string())])
        for folder in ("items", "unprocessed"):
            system.create_dir(f"{stage}/{folder}", recursive=True)
        n_accepted = n_left = 0
        with system.open_output_stream(f"{stage}/items/{name}") as a, system.open_output_stream(f"{stage}/unprocessed/{name}") as b, \
                pq.ParquetWriter(a, schema) as items, pq.ParquetWriter(b, ids) as unprocessed:
            chunk, accepted, left = [], [], []

            def flush(least: int) -> None:
                nonlocal accepted, left
                if len(accepted) + len(left) >= least:
                    items.write_table(pa.Table.from_pylist(accepted, schema))
                    unprocessed.write_table(pa.Table.from_pylist([{"id": i} for i in left], ids))
                    accepted, left = [], []

            def put() -> None:
                nonlocal n_accepted, n_left, chunk
                done, refused = self._put(chunk)
                accepted.extend(done)
                left.extend(refused)
                n_accepted, n_left, chunk = n_accepted + len(done), n_left + len(refused), []

            for row in iterator:
                chunk.append(row.asDict())
                if len(chunk) >= self.chunk:
                    put()
                    flush(FLUSH_ROWS)
            if chunk:
                put()
            flush(0)
        return Put(self.stage, name, n_accepted, n_left)

    def _publish(self, batch: int, messages: list[Put | None]) -> None:
        """Make the files of the tasks that count, and no others, the batch."""
        system, path = open_path(self.path)
        done = [m for m in messages if m is not None]
        for folder in ("unprocessed", "items"):  # items last: they make the batch count
            place = f"{path}/{folder}/batch={batch}"
            if exists(system, place):
                continue
            ready = f"{path}/staging/{uuid.uuid4().hex}/{folder}"
            system.create_dir(ready, recursive=True)
            system.create_dir(f"{path}/{folder}", recursive=True)
            for m in done:
                system.move(f"{open_path(m.stage)[1]}/{folder}/{m.file}", f"{ready}/{m.file}")
            system.move(ready, place)
            system.delete_dir(ready.rsplit("/", 1)[0])
        self._discard(messages)

    def _discard(self, messages: list[Put | None]) -> None:
        for stage in {m.stage for m in messages if m is not None} | {self.stage}:
            system, folder = open_path(stage)
            if exists(system, folder):
                system.delete_dir(folder)


class _BatchWriter(_Writer, DataSourceWriter):
    def __init__(self, client, options, schema):
        super().__init__(client, options, schema)
        self.batch = int(options.get("batch", 0))

    def commit(self, messages) -> None:
        self._publish(self.batch, messages)

    def abort(self, messages) -> None:
        self._discard(messages)


class _StreamWriter(_Writer, DataSourceStreamWriter):
    def commit(self, messages, batchId: int) -> None:  # noqa: N803 - Spark's name
        self._publish(batchId, messages)

    def abort(self, messages, batchId: int) -> None:  # noqa: N803
        self._discard(messages)


def register_store(spark: SparkSession, client: Client, name: str = FORMAT) -> str:
    """Make ``client`` the store behind the sink format ``name``; options: path,
    batch (batch writes), chunkSize, attempts, baseBackoff, maxBackoff."""
    class Store(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def writer(self, schema, overwrite):
            return _BatchWriter(client, self.options, schema)

        def streamWriter(self, schema, overwrite):  # noqa: N802 - Spark's name
            return _StreamWriter(client, self.options, schema)

    spark.dataSource.register(Store)
    return name


def put_batch(items: DataFrame, path: str, batch: int, name: str = FORMAT, **options) -> DataFrame:
    """Put one batch of items; the ids the store left unprocessed.

    A batch that is there already is not put again."""
    spark = items.sparkSession
    system, folder = open_path(path)
    if not exists(system, f"{folder}/items/batch={batch}"):
        items.write.format(name).options(path=path, batch=str(batch), **{k: str(v) for k, v in options.items()}).mode("append").save()
    return spark.read.schema("id string").parquet(f"{path}/unprocessed/batch={batch}")


def stored(spark: SparkSession, path: str) -> DataFrame:
    """All items the store accepted, with the ``batch`` that brought them."""
    return spark.read.parquet(f"{path}/items")
