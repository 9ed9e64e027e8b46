"""Streaming read of the buffer with a cursor and a cap on records (LIM-1, SRC-2).

The offset of the stream is a place in the buffer: a file and a row of it.  A batch
takes the next ``count`` records after the cursor, so a cap moves the cursor and
nothing that is left is rewritten; records and row counts are read for the files of
the batch only.  Files are read in the order of their paths, so appends must name
them in order of time (``append_in_order``), and a file never changes.

A trigger of Spark costs the same whatever it reads.  With ``reads`` above 1 a trigger
that finds a backlog takes so many reads of ``count`` records at once, and ``number``
names a column that tells them apart: reads are numbered from 0 over the whole stream,
and none holds more than ``count`` records.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from .files import exists, open_path

FORMAT = "buffer_cursor"
TASK_ROWS = 100_000


class Slice(InputPartition):
    """Rows [first, last) of one file; ``at`` is the place of the first one in its trigger,
    whose reads are numbered from ``read``."""

    def __init__(self, file: str, first: int, last: int, at: int = 0, read: int = 0):
        self.file, self.first, self.last, self.at, self.read = file, first, last, at, read


class CursorReader(DataSourceStreamReader):
    def __init__(self, options: dict, schema: StructType):
        self.path, self.count, self.schema = options["path"], int(options.get("count", 25)), schema
        self.cursor = options["cursor"]
        self.reads, self.number = int(options.get("reads", 1)), options.get("number")
        self.at: dict | None = None
        self.rows: dict[str, int] = {}

    # -- on the driver --------------------------------------------------
    def initialOffset(self) -> dict:  # noqa: N802 - Spark's name
        return {"file": "", "row": 0, "read": 0}

    def _files(self, first: str) -> list[str]:
        from pyarrow import fs
        system, path = open_path(self.path)
        if not exists(system, path):
            return []
        found = system.get_file_info(fs.FileSelector(path, recursive=True))
        names = [f.path[len(path):].lstrip("/") for f in found if f.is_file and f.path.endswith(".parquet")]
        return sorted(n for n in names if n >= first and not any(p[:1] in "._" for p in n.split("/")))

    def _count(self, name: str) -> int:
        import pyarrow.parquet as pq
        if name not in self.rows:
            system, path = open_path(self.path)
            with system.open_input_file(f"{path}/{name}") as f:
                self.rows[name] = pq.ParquetFile(f).metadata.num_rows
        return self.rows[name]

    def _slices(self, start: dict, count: int | None = None, end: dict | None = None) -> Iterator[Slice]:
        left, at, read = count, 0, start.get("read", 0)
        for name in self._files(start["file"]):
            first = start["row"] if name == start["file"] else 0
            last = self._count(name)
            if end is not None:
                if name > end["file"]:
                    return
                last = min(last, end["row"]) if name == end["file"] else last
            if left is not None:
                last = min(last, first + left)
            taken = max(0, last - first)
            # a task takes whole reads, and of a file no more than TASK_ROWS, or one read
            while first < last:
                rows = min(last - first, max(TASK_ROWS, self.count) // self.count * self.count - at % self.count)
                yield Slice(name, first, first + rows, at, read)
                first, at = first + rows, at + rows
            if left is not None:
                left -= taken
                if left <= 0:
                    return

    def latestOffset(self) -> dict:  # noqa: N802
        start = self.at or self._saved() or self.initialOffset()
        end = start
        for s in self._slices(start, count=self.count * self.reads):
            end = {"file": s.file, "row": s.last, "read": s.read - (-(s.at + s.last - s.first) // self.count)}
        return end

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        # planned batches are what a restarted reader must go on from
        self.at = end
        self._save(end)
        self.rows = {k: v for k, v in self.rows.items() if k >= start["file"]}
        return list(self._slices(start, end=end))

    def _saved(self) -> dict | None:
        system, path = open_path(self.cursor)
        if not exists(system, path):
            return None
        with system.open_input_stream(path) as f:
            return json.loads(f.read().decode())

    def _save(self, at: dict) -> None:
        system, path = open_path(self.cursor)
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        with system.open_output_stream(f"{path}.new") as f:
            f.write(json.dumps(at).encode())
        system.move(f"{path}.new", path)

    # -- in the tasks ---------------------------------------------------------
    def read(self, partition: Slice):
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema
        system, path = open_path(self.path)
        schema = to_arrow_schema(self.schema)
        stored = pa.schema([f for f in schema if f.name != self.number])
        with system.open_input_file(f"{path}/{partition.file}") as f:
            file, at = pq.ParquetFile(f), 0
            for g in range(file.num_row_groups):
                n = file.metadata.row_group(g).num_rows
                lo, hi = max(partition.first - at, 0), min(partition.last - at, n)
                if lo < hi:
                    table = file.read_row_group(g, columns=stored.names).slice(lo, hi - lo)
                    columns = {c: table[c].cast(t) for c, t in zip(stored.names, stored.types)}
                    if self.number:
                        place = partition.at - partition.first + at
                        columns[self.number] = pa.array((partition.read + (place + i) // self.count for i in range(lo, hi)), schema.field(self.number).type)
                    yield from pa.table([columns[c] for c in schema.names], schema=schema).to_batches()
                at += n


class BufferCursor(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamReader(self, schema: StructType) -> CursorReader:  # noqa: N802 - Spark's name
        return CursorReader(self.options, schema)


def read_capped(spark: SparkSession, path: str, schema, checkpoint: str, count: int = 25, reads: int = 1,
                number: str | None = None) -> DataFrame:
    """Streaming frame over the buffer at ``path``, reads of ``count`` records, up to
    ``reads`` of them a trigger, with the number of the read in the column ``number``.

    ``checkpoint`` is the folder of the stream that reads it; the cursor is kept there."""
    spark.dataSource.register(BufferCursor)
    options = {"path": path, "cursor": f"{checkpoint}/cursor.json", "count": str(count), "reads": str(reads)}
    if number:
        schema = (StructType.fromDDL(schema) if isinstance(schema, str) else StructType(list(schema.fields))).add(number, "long")
        options["number"] = number
    return spark.readStream.format(FORMAT).schema(schema).options(**options).load()


def append_in_order(entries: DataFrame, path: str, number: int) -> None:
    """Append a batch of entries; a later ``number`` sorts after all earlier ones.

    Inside a batch entries go by arrival order (range partitions, one file each)."""
    (entries.repartitionByRange("seq", "id").sortWithinPartitions("seq", "id")
     .write.mode("overwrite").parquet(f"{path}/batch={number:020d}"))
