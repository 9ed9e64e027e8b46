"""Repeated passages found with a parse into phrases and suffixes of its dictionary.

A byte belongs to a repeated passage if some string of ``length`` bytes over it
starts at two places of the corpus.  In a suffix order of the corpus such strings
are neighbours, but only suffixes that meet the same trigger can share so many
bytes, so the order is needed only among those:

- **Parse.**  The trigger of a place is the ``GRAM`` bytes of smallest rolling hash
  among the next ``reach`` ones; it depends on the string there alone.  Places in a
  row with one trigger are a phrase; its bytes reach ``length`` past its last place.
- **Dictionary.**  Phrases are counted by content (``phrase``) and by the bytes that
  all their strings have in common from the trigger on (``core``).  A phrase whose
  core occurs once holds no repeated string; every string of a phrase that occurs
  twice is one.  So most text, and all exact repeats, need no look at its suffixes.
- **Suffixes.**  What is left are phrases that occur once and share their core with
  other phrases.  Their suffixes, and those of the phrases they share it with, are
  sorted per core; equal neighbours are repeated strings.  Cores of few phrases are
  sorted in the task that has them; cores of more than ``hot`` phrases are spread by
  the suffixes themselves, so no task gets a core however common it is.

Phrases with a hash collision of the core meet needlessly, no more; equal phrases
are told by 128 bits of hash, equal suffixes by their bytes (128 bits of hash when
spread).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import mix, slices, small_batches
from sluice.session import new_run_dir

GRAM = 8
#: Cores with more distinct phrases are spread by their suffixes.
HOT = 4096
#: Places parsed at once, and bytes of documents that are parsed together.
SEGMENT = 1 << 17
CHUNK = 1 << 20

_MULT = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64(0xFFFFFFFF)
_PRIMES = ((np.uint64(4294967291), np.uint64(0x3C6EF372)), (np.uint64(4294967279), np.uint64(0x1B873593)))


def reach_of(length: int) -> int:
    """Places that look for a trigger; the rest of ``length`` is the core."""
    return max(1, min(length * 18 // 25, length - GRAM + 1))


def triggers(data: bytes, lo: int, hi: int, reach: int) -> np.ndarray:
    """Trigger of every place in [lo, hi); ``data`` has ``reach + GRAM - 1`` bytes after the last."""
    n = hi - lo + reach - 1
    grams = np.ndarray((n,), "<u8", buffer=data, offset=lo, strides=(1,))
    m = mix(grams * _MULT) & ~_LOW
    m |= np.arange(n, dtype=np.uint64)
    width = 1
    while 2 * width <= reach:
        m = np.minimum(m[:-width], m[width:])
        width *= 2
    if width < reach:
        m = np.minimum(m[:hi - lo], m[reach - width:][:hi - lo])
    return (m & _LOW).astype(np.int64) + lo


def phrases(data: bytes, sizes: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(document, first place, last place, trigger) of all phrases of documents
    joined to ``data``; every document has ``length`` bytes at least."""
    reach, ends = reach_of(length), np.cumsum(sizes)
    begins, last = ends - sizes, len(data) - length + 1
    first, trigger, before = [begins], [], -1
    for lo in range(0, last, SEGMENT):
        t = triggers(data, lo, min(lo + SEGMENT, last), reach)
        new = np.flatnonzero(np.r_[t[0] != before, t[1:] != t[:-1]])
        first.append(new + lo)
        trigger.append((new + lo, t[new]))
        before = t[-1]
    at, of = (np.concatenate(x) for x in zip(*trigger))
    lo = np.unique(np.concatenate(first))
    lo = lo[lo < last]
    doc = np.searchsorted(ends, lo, side="right")
    hi = np.minimum(np.r_[lo[1:] - 1, last - 1], ends[doc] - length)
    keep = lo <= hi
    lo, hi, doc = lo[keep], hi[keep], doc[keep]
    return doc, lo, hi, of[np.searchsorted(at, lo, side="right") - 1]


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


def phrase_hashes(data: bytes, lo: np.ndarray, hi: np.ndarray, length: int) -> np.ndarray:
    view = memoryview(data)
    return _signed([xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(lo.tolist(), (hi + length).tolist())])


def core_hashes(data: bytes, trigger: np.ndarray, length: int) -> np.ndarray:
    view, n = memoryview(data), length - reach_of(length) + 1
    return _signed([xxhash.xxh3_64_intdigest(view[t:t + n], 1) for t in trigger.tolist()])


def _parse(length: int):
    schema = pa.schema([(x, pa.int64()) for x in ("same", "core", "phrase", "times")])

    def chunk(texts: list[bytes], same: list[int]) -> pa.RecordBatch:
        data = b"".join(texts)
        doc, lo, hi, trigger = phrases(data, np.array([len(t) for t in texts]), length)
        rows = np.stack([np.array(same, np.int64)[doc], core_hashes(data, trigger, length), phrase_hashes(data, lo, hi, length)])
        times = np.ones(len(doc), np.int64)
        if len(np.unique(rows[2])) < len(doc):
            rows, times = np.unique(rows, axis=1, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (*rows, times)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, same, held = [], [], 0
        for batch in slices(batches, 64):
            for text, s in zip(batch.column("text"), batch.column("same").to_pylist()):
                texts.append(text.as_buffer().to_pybytes())
                same.append(s)
                held += len(texts[-1])
                if held >= CHUNK:
                    yield chunk(texts, same)
                    texts, same, held = [], [], 0
        if texts:
            yield chunk(texts, same)
    return run


def _extract(length: int):
    """Bytes of the phrases asked for, once per text of a task."""
    schema = pa.schema([("core", pa.int64()), ("phrase", pa.int64()), ("times", pa.int64()), ("members", pa.int64()),
                        ("left", pa.int64()), ("data", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches, 64):
            rows = []
            for text, same, asked in zip(batch.column("text"), batch.column("same").to_pylist(), batch.column("asked").to_pylist()):
                if same in seen:
                    continue
                seen.add(same)
                wanted = {a["phrase"]: a for a in asked}
                data = text.as_buffer().to_pybytes()
                _, lo, hi, trigger = phrases(data, np.array([len(data)]), length)
                for p, a, b, t in zip(phrase_hashes(data, lo, hi, length).tolist(), lo.tolist(), hi.tolist(), trigger.tolist()):
                    if w := wanted.pop(p, None):
                        rows.append((w["core"], p, w["times"], w["members"], t - a, data[a:b + length]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)
    return run


def repeated_suffixes(core: np.ndarray, left: np.ndarray, data: list[bytes], length: int) -> list[np.ndarray]:
    """For each of some phrases, distinct within their core, which of its places
    start a string that another phrase has too."""
    n = np.array([len(d) - length + 1 for d in data])
    width = int(n.max()) + length - 1
    text = np.frombuffer(b"".join(d.ljust(width, b"\0") for d in data), np.uint8).reshape(len(data), width)
    place = np.arange(int(n.max()))
    valid = place < n[:, None]
    code = np.zeros(valid.shape, np.uint64)
    for prime, base in _PRIMES:
        h = np.zeros((width + 1, len(data)), np.uint64)
        for i in range(width):
            h[i + 1] = (h[i] * base + text[:, i] + np.uint64(1)) % prime
        power = np.uint64(pow(int(base), length, int(prime)))
        window = (h[length:length + len(place)] + prime - (h[:len(place)] * power) % prime) % prime
        code = (code << np.uint64(32)) ^ window.T
    ahead = (left[:, None] - place).astype(np.int64).view(np.uint64)
    code = mix(code ^ mix(core.view(np.uint64)[:, None] + ahead * _MULT))
    row, at = np.nonzero(valid)
    code = code[valid]
    order = np.argsort(code, kind="stable")
    row, at, code = row[order], at[order], code[order]
    pair = np.flatnonzero(code[1:] == code[:-1])
    strings = np.lib.stride_tricks.sliding_window_view(text, length, axis=1)
    out = np.zeros(valid.shape, np.bool_)
    for lo in range(0, len(pair), 1 << 14):  # neighbours in the order, told equal by their bytes
        i = pair[lo:lo + (1 << 14)]
        i = i[(strings[row[i], at[i]] == strings[row[i + 1], at[i + 1]]).all(axis=1)]
        out[row[i], at[i]] = out[row[i + 1], at[i + 1]] = True
    return [o[:k] for o, k in zip(out, n.tolist())]


_PLACES = pa.schema([("core", pa.int64()), ("phrase", pa.int64()), ("places", pa.binary())])
PLACES_DDL = "core long, phrase long, places binary"


def _sort_suffixes(length: int, rows_at_once: int = 2048):
    """Rows come sorted by core and phrase; whole cores are handled together."""
    def resolve(rows: list[tuple]) -> pa.RecordBatch:
        core, phrase, times, left, data = zip(*rows)
        found = repeated_suffixes(np.array(core, np.int64), np.array(left, np.int64), list(data), length)
        once = [(c, p, np.packbits(f).tobytes()) for c, p, t, f in zip(core, phrase, times, found) if t == 1 and f.any()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in once], f.type) for i, f in enumerate(_PLACES)], schema=_PLACES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in slices(batches):
            for row in zip(*[batch.column(x).to_pylist() for x in ("core", "phrase", "times", "left", "data")]):
                if held and row[:2] == held[-1][:2]:
                    continue
                if len(held) >= rows_at_once and row[0] != held[-1][0]:
                    yield resolve(held)
                    held = []
                held.append(row)
        if held:
            yield resolve(held)
    return run


def _spread_suffixes(length: int):
    names = ("core", "phrase", "times", "place", "h1", "h2")
    schema = pa.schema([(x, pa.int64()) for x in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 128):
            rows = []
            for core, phrase, times, data in zip(*[batch.column(x).to_pylist() for x in ("core", "phrase", "times", "data")]):
                for i in range(len(data) - length + 1):
                    h = xxhash.xxh3_128_intdigest(data[i:i + length])
                    rows.append((core, phrase, times, i, (h >> 64) - (1 << 63), (h & ((1 << 64) - 1)) - (1 << 63)))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], schema=schema)
    return run


def _bits(places: list[int]) -> bytes:
    out = np.zeros(max(places) + 1, np.bool_)
    out[places] = True
    return np.packbits(out).tobytes()


def _pack_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("core"), batch.column("phrase"),
                                          pa.array([_bits(p) for p in batch.column("at").to_pylist()], pa.binary())], schema=_PLACES)


def _remove(length: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                        ("kept_sha256", pa.string()), ("spans", pa.list_(pa.list_(pa.int64())))])

    def spans_of(data: bytes, whole: list[int], partly: dict[int, bytes]) -> np.ndarray:
        _, lo, hi, _ = phrases(data, np.array([len(data)]), length)
        of = phrase_hashes(data, lo, hi, length)
        all_of = np.isin(of, np.array(whole, np.int64))
        at = [np.stack([lo[all_of], hi[all_of]], axis=1)]
        for i in np.flatnonzero(np.isin(of, np.array(list(partly), np.int64)) & ~all_of).tolist():
            bits = np.unpackbits(np.frombuffer(partly[int(of[i])], np.uint8))[:hi[i] - lo[i] + 1]
            p = np.flatnonzero(bits) + lo[i]
            at.append(np.stack([p, p], axis=1))
        at = np.concatenate(at)
        at = at[np.argsort(at[:, 0], kind="stable")]
        if not len(at):
            return at
        end = np.maximum.accumulate(at[:, 1] + length)
        new = np.r_[True, at[1:, 0] > end[:-1]]
        return np.stack([at[new, 0], end[np.r_[np.flatnonzero(new)[1:] - 1, len(at) - 1]]], axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            rows = []
            for doc, text, whole, partly in zip(batch.column("doc_id").to_pylist(), batch.column("text"),
                                                batch.column("whole").to_pylist(), batch.column("partly").to_pylist()):
                data = text.as_buffer().to_pybytes() if text.is_valid else b""
                digest, spans = hashlib.sha256(), []
                if whole or partly:
                    spans = spans_of(data, whole or [], {p["phrase"]: p["places"] for p in partly or []}).tolist()
                at = 0
                for a, b in spans:
                    digest.update(memoryview(data)[at:a])
                    at = b
                digest.update(memoryview(data)[at:])
                rows.append((doc, len(data), sum(b - a for a, b in spans), len(spans), digest.hexdigest(), spans))
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)
    return run


def remove_repeats(docs: DataFrame, length: int = 200, hot: int = HOT) -> DataFrame:
    """What stays of every row of ``docs`` (doc_id, text) without repeated strings.

    A byte goes if a string of ``length`` UTF-8 bytes over it, inside its document,
    starts anywhere else too; overlapping occurrences count.  Returns doc_id, n_bytes,
    n_removed, n_spans, kept_sha256 and ``spans`` ([start, end) of the removed runs).
    Null texts are empty; texts shorter than ``length`` stay whole; equal rows are
    documents of their own, so their texts go; an empty table has no rows.  Other
    columns are ignored.
    """
    if length < 2 * GRAM:
        raise ValueError(f"length must be {2 * GRAM} at least")
    spark, folder = docs.sparkSession, new_run_dir(docs.sparkSession, "repeats")
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("same"))
    long_texts = small_batches(texts.where(F.octet_length("text") >= length).select("text", "same"))

    # phrases whose core occurs more than once
    parsed = long_texts.mapInArrow(_parse(length), "same long, core long, phrase long, times long")
    again = parsed.groupBy("core").agg(F.sum("times").alias("n")).where("n > 1").select("core")
    parsed.join(again, "core", "left_semi").write.parquet(f"{folder}/parse")
    parse = spark.read.parquet(f"{folder}/parse")

    # the dictionary: distinct phrases, how often and where they are
    entries = parse.groupBy("core", "phrase").agg(F.sum("times").alias("times"), F.min("same").alias("same"))
    entries.write.parquet(f"{folder}/dictionary")
    entries = spark.read.parquet(f"{folder}/dictionary")
    mixed = entries.groupBy("core").agg(F.count("*").alias("members"), F.min("times").alias("least")) \
                   .where("least = 1 AND members > 1").select("core", "members")
    open_entries = entries.join(mixed, "core")
    asked = open_entries.groupBy("same").agg(F.collect_list(F.struct("core", "phrase", "times", "members")).alias("asked"))
    asked.write.parquet(f"{folder}/asked")
    asked = spark.read.parquet(f"{folder}/asked")

    # suffixes of phrases that share a core
    (small_batches(long_texts.join(asked, "same"))
     .mapInArrow(_extract(length), "core long, phrase long, times long, members long, left long, data binary")
     .write.parquet(f"{folder}/phrases"))
    bodies = spark.read.parquet(f"{folder}/phrases")
    few = (bodies.where(F.col("members") <= hot).repartition("core").sortWithinPartitions("core", "phrase")
           .mapInArrow(_sort_suffixes(length), PLACES_DDL))
    spread = bodies.where(F.col("members") > hot).mapInArrow(
        _spread_suffixes(length), "core long, phrase long, times long, place long, h1 long, h2 long")
    shared = spread.groupBy("h1", "h2").agg(F.min("phrase").alias("a"), F.max("phrase").alias("b")).where("a != b").select("h1", "h2")
    many = (spread.where("times = 1").join(shared, ["h1", "h2"], "left_semi").groupBy("core", "phrase")
            .agg(F.collect_set("place").alias("at")).mapInArrow(_pack_places, PLACES_DDL))
    places = few.union(many)

    # back to the texts
    single = entries.where("times = 1").select("core", "phrase", "same")
    partly = places.join(single, ["core", "phrase"]).groupBy("same").agg(F.collect_list(F.struct("phrase", "places")).alias("partly"))
    whole = parse.join(entries.where("times > 1").select("core", "phrase"), ["core", "phrase"], "left_semi") \
                 .groupBy("same").agg(F.collect_set("phrase").alias("whole"))
    whole.join(partly, "same", "full_outer").write.parquet(f"{folder}/found")
    found = spark.read.parquet(f"{folder}/found")
    return small_batches(texts.join(found, "same", "left")).mapInArrow(
        _remove(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<array<long>>")


def remove_repeats_sql(length: int = 200) -> str:
    """DuckDB twin: every string of every document, grouped."""
    return f"""WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
s AS (SELECT doc_id, p, md5_number(substr(x, 2 * p + 1, {2 * length})) AS h
  FROM (SELECT doc_id, x, unnest(range(0, n - {length - 1})) AS p FROM d WHERE n >= {length})),
r AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY h) AS k FROM s) WHERE k > 1),
i AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS g FROM
  (SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= {length} THEN 0 ELSE 1 END AS new FROM r)),
g AS (SELECT doc_id, min(p) AS a, max(p) + {length} AS b FROM i GROUP BY doc_id, g),
k AS (SELECT doc_id, coalesce(lag(b) OVER w, 0) AS lo, a AS hi, b - a AS gone, 1 AS span FROM g WINDOW w AS (PARTITION BY doc_id ORDER BY a)
  UNION ALL SELECT d.doc_id, coalesce(t.b, 0), n, 0, 0 FROM d LEFT JOIN (SELECT doc_id, max(b) AS b FROM g GROUP BY 1) t USING (doc_id))
SELECT d.doc_id, any_value(n)::BIGINT AS n_bytes, sum(gone)::BIGINT AS n_removed, sum(span)::BIGINT AS n_spans,
  sha256(unhex(string_agg(substr(x, 2 * lo + 1, 2 * (hi - lo)), '' ORDER BY lo))) AS kept_sha256
FROM d JOIN k USING (doc_id) GROUP BY d.doc_id"""
