"""Sum-of-squares online packing of tokenised documents into fixed windows.

Every task packs the documents of its own input partition as they come: no
shuffle, no shared state, memory bounded by the open windows.  A document's
whole windows of ``capacity`` ids are sequences of their own; its rest goes to
the fill level that minimises the sum of squared counts of partly filled
windows, over all levels of a level array (``counts[h]`` windows filled to
``h``).  When a partition ends, or ``open_limit`` windows are open, the open
windows are closed by cutting: documents of the emptiest windows fill the gaps
of the fullest ones.  A task's last window is cut at powers of two, so it needs
no padding either.
"""

from __future__ import annotations

import os
import sys
import types
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import slices, small_batches


_PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


class WordEncoder(dict):
    """Ids of texts as the tokenizer gives them (little-endian unsigned 32-bit), word by word.

    For a tokenizer that lower-cases, drops white space, never joins characters
    across it, and hands lower-case ASCII words to its model as they are, a
    text's ids are those of its words in turn.  Each distinct word is encoded
    once and looked up after that; about ``limit`` words are kept.
    """

    def __init__(self, path: str, limit: int = 400_000):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's core is all there is
        from tokenizers import Tokenizer
        self.tokenizer, self.limit = Tokenizer.from_file(path), limit

    def __missing__(self, word: bytes) -> bytes:
        core = word.rstrip(_PUNCTUATION)
        if word.isalpha() and word.islower():
            ids = array("I", [t.id for t in self.tokenizer.model.tokenize(word.decode())]).tobytes()
        elif core != word and core[-1:].isalpha() and b"<|" not in word:
            # Punctuation after a letter is a token run of its own: "word," is
            # "word" and ",".  Special tokens are left whole.
            ids = self[core] + self[word[len(core):]]
        else:
            ids = array("I", self.tokenizer.encode(word.decode("utf-8", "replace"),
                                                   add_special_tokens=False).ids).tobytes()
        self[word] = ids
        return ids

    def encode(self, text: bytes) -> bytes:
        if len(self) > self.limit:
            self.clear()
        # Special tokens are matched before lower-casing, so texts that may
        # hold one keep their case.
        return b"".join(map(self.__getitem__, (text if b"<|" in text else text.lower()).split()))


class Packer:
    """Packs (document, start, ids) rests into windows; ``done`` holds the rows of closed ones."""

    def __init__(self, capacity: int, first: int, open_limit: int):
        self.capacity, self.next, self.open_limit = capacity, first, open_limit
        self.counts = np.zeros(capacity + 1, np.int64)
        self.windows: dict[int, list[list[tuple]]] = {}
        self.n_open = 0
        self.done: list[tuple] = []

    def close(self, window: list[tuple]) -> None:
        at = 0
        for doc, start, ids, total in window:
            self.done.append((doc, start, len(ids), zlib.crc32(ids), total, self.next, at))
            at += len(ids)
        self.next += 1

    def add(self, doc, ids: memoryview) -> None:
        cap, total = self.capacity, len(ids)
        whole = total - total % cap
        for start in range(0, whole, cap):
            self.close([(doc, start, ids[start:start + cap], total)])
        if whole < total:
            self.place((doc, whole, memoryview(ids[whole:].tobytes()).cast("I"), total))
        if self.n_open >= self.open_limit:
            self.finish(last=False)

    def place(self, piece: tuple) -> None:
        cap, size, c = self.capacity, len(piece[2]), self.counts
        # change of the sum of squares when the piece goes to level h (0: a new window)
        change = 2 * (c[size:] - c[:cap - size + 1]) + 2
        change[0] = 2 * c[size] + 1
        change[-1] = 1 - 2 * c[cap - size]
        change[1:][c[1:cap - size + 1] == 0] = np.iinfo(np.int64).max
        h = int(change.argmin())
        if h:
            window = self.windows[h].pop()
            c[h] -= 1
            self.n_open -= 1
        else:
            window = []
        window.append(piece)
        if h + size == cap:
            self.close(window)
        else:
            self.windows.setdefault(h + size, []).append(window)
            c[h + size] += 1
            self.n_open += 1

    def finish(self, last: bool = True) -> None:
        """Close the open windows: the emptiest ones are cut to fill the fullest."""
        cap = self.capacity
        order = [w for h in sorted(self.windows, reverse=True) for w in self.windows[h]]
        self.windows.clear()
        self.counts[:] = 0
        self.n_open = 0
        spare: list[tuple] = []
        while order:
            window = order.pop(0)
            gap = cap - sum(len(p[2]) for p in window)
            while gap and (spare or order):
                if not spare:
                    spare = order.pop()
                doc, start, ids, total = spare.pop()
                window.append((doc, start, ids[:gap], total))
                if len(ids) > gap:
                    spare.append((doc, start + gap, ids[gap:], total))
                gap -= min(gap, len(ids))
            if not gap:
                self.close(window)
            else:
                order, spare = [], window
        if spare and not last:
            size = sum(len(p[2]) for p in spare)
            if size == cap:
                self.close(spare)
            else:
                self.windows[size] = [spare]
                self.counts[size], self.n_open = 1, 1
            return
        while spare:
            size = 1 << (sum(len(p[2]) for p in spare).bit_length() - 1)
            window, left = [], size
            while left:
                doc, start, ids, total = spare.pop(0)
                window.append((doc, start, ids[:left], total))
                if len(ids) > left:
                    spare.insert(0, (doc, start + left, ids[left:], total))
                left -= min(left, len(ids))
            self.close(window)


def worker_encoder(path: str) -> WordEncoder:
    """The encoder of this Python worker, which keeps its words from task to task."""
    kept = sys.modules.setdefault("sluice_worker_encoders", types.ModuleType("sluice_worker_encoders")).__dict__
    if path not in kept:
        kept[path] = WordEncoder(path)
    return kept[path]


def _pack(batches: Iterator[pa.RecordBatch], schema: pa.Schema, path: str, end_id: int, capacity: int,
          open_limit: int) -> Iterator[pa.RecordBatch]:
    encoder = worker_encoder(path)
    packer = Packer(capacity, TaskContext.get().partitionId() << 40, open_limit)

    def rows() -> pa.RecordBatch:
        done, packer.done = packer.done, []
        return pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(zip(*done), schema.types)], schema=schema)

    last = array("I", [end_id]).tobytes()
    for batch in slices(batches):
        for doc, data in zip(batch.column("id").to_pylist(), batch.column("data")):
            packer.add(doc, memoryview(encoder.encode(data.as_py() or b"") + last).cast("I"))
            if len(packer.done) >= 20_000:
                yield rows()
    packer.finish()
    if packer.done:
        yield rows()


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2,
         capacity: int = 4096, open_limit: int = 1024) -> DataFrame:
    """One row per piece: ``id_col``, ``start`` (its document's ids before it),
    ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.

    ``tokenizer`` is the path of a tokenizers file that every executor can
    read.  Null and empty texts are the end id alone.  Null ids and repeated
    rows are packed as they come; other columns are ignored.  An empty table
    gives an empty result.  Sequence ids are unique; each task numbers its own.
    """
    src = small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("data"))
    kind = src.schema["id"].dataType.simpleString()
    names = (id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    from pyspark.sql.pandas.types import to_arrow_type
    schema = pa.schema([(names[0], to_arrow_type(src.schema["id"].dataType)), *[(n, pa.int64()) for n in names[1:]]])
    return src.mapInArrow(lambda it: _pack(it, schema, tokenizer, end_id, capacity, open_limit),
                          ", ".join([f"`{id_col}` {kind}", *[f"`{n}` bigint" for n in names[1:]]]))
