"""Quality classifier by importance resampling.

Two generative models over hashed word n-grams (unigrams and bigrams) are
counted: the target from clean labelled rows, the raw text from all documents.
A document's log weight is the sum of ``log(target / raw)`` over its n-grams.
Both models are smoothed by the same pseudo-count at the target's scale, and a
bucket weighs only as far as labelled rows bear it out: the raw model's
expected count is held to what the labelled rows of all classes show, and
buckets that do not differ significantly weigh nothing.  So words that no
labelled row has neither help nor harm a document.

That sum lets many weak words outvote a few strong ones, and holds rare words to
no account, so toxic rows have a model of their own, over the share of documents
that hold a word: a word's evidence is the log ratio of its share in toxic and in
clean labelled rows, less one posterior deviation (a word of few rows weighs
less, but not nothing), and a document's is the sum of its three strongest
words, which no other word can lessen.

Documents are then drawn by Gumbel top-k: a row's key is its log weight plus
``temperature`` times a seeded Gumbel number, and the k largest keys stay.  By
default k is the number of rows whose key reaches the bar that held-out clean
labelled rows pass but for half of ``loss`` (held low enough that a row
without evidence stays), so selecting is a filter; for a given k the k-th key is
found by counting keys in ever narrower ranges.  Rows whose toxic evidence
exceeds that of held-out clean rows but for the other half are not drawn.

The models have a fixed number of buckets; tasks ship one row per bucket they
saw, and only the summed models reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sluice.llm.common import cut, mix, ngram_hashes, slices, small_batches, word_hashes


#: Buckets of the toxic model, which only the words of toxic rows fill.
MARKS = 1 << 20


def buckets_of(h: np.ndarray, bits: int) -> np.ndarray:
    mask = np.uint64((1 << bits - 1) - 1)
    return np.concatenate([mix(h) & mask, (ngram_hashes(h, 2) & mask) + (mask + np.uint64(1))]).astype(np.int64)


def buckets(data: bytes, bits: int) -> np.ndarray:
    """Bucket of every unigram (lower half) and bigram (upper half)."""
    return buckets_of(word_hashes(data), bits)


def marks_of(h: np.ndarray) -> np.ndarray:
    """Distinct buckets of the words, in the toxic model."""
    return np.unique(mix(h) & np.uint64(MARKS - 1)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Per task: bucket, count over all rows, labelled rows, clean labelled rows;
    after these the buckets of the toxic model: 0, clean rows, toxic rows that
    hold it; and last 0, all clean rows, all toxic rows."""
    total = np.zeros((3, 1 << bits), np.int64)
    held = np.zeros((2, MARKS + 1), np.int64)
    for batch in slices(batches):
        many: list[list[np.ndarray]] = [[], [], []]
        for data, good, toxic in zip(batch.column("data"), *(batch.column(c).to_pylist() for c in ("good", "toxic"))):
            h = word_hashes(data.as_py() or b"")
            many[0 if good is None else 2 if good else 1].append(buckets_of(h, bits))
            if good or toxic:
                held[int(not good), marks_of(h)] += 1
                held[int(not good), MARKS] += 1
        for row, found in zip(total, many):
            if found:
                row += np.bincount(np.concatenate(found), minlength=len(row))
    seen = np.flatnonzero(total.any(axis=0))
    unlabelled, bad, good = total[:, seen]
    yield pa.RecordBatch.from_arrays(
        [pa.array(x) for x in (seen, unlabelled + bad + good, bad + good, good)],
        names=["bucket", "raw", "labelled", "target"])
    seen = np.flatnonzero(held.any(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(x) for x in (seen + (1 << bits), np.zeros(len(seen), np.int64), *held[:, seen])],
        names=["bucket", "raw", "labelled", "target"])


def marker_weights(clean: np.ndarray, toxic: np.ndarray, n_clean: int, n_toxic: int) -> np.ndarray:
    """Evidence for toxic of words by the clean and toxic rows that hold them:
    the log ratio of the shares less its posterior deviation, 0 at least."""
    clean, toxic = clean + 0.5, toxic + 0.5
    ratio = np.log(toxic / (n_toxic + 1)) - np.log(clean / (n_clean + 1))
    return np.maximum(0, ratio - np.sqrt(1 / toxic + 1 / clean))


def log_ratio(raw: np.ndarray, labelled: np.ndarray, target: np.ndarray, pseudo: float, least_z: float) -> np.ndarray:
    """Log weight per bucket; both halves are models of their own."""
    expected = np.empty(len(raw))
    for half in (slice(0, len(raw) // 2), slice(len(raw) // 2, None)):
        n = target[half].sum()
        expected[half] = np.minimum(*(c[half] * (n / max(1, c[half].sum())) for c in (raw, labelled)))
    out = np.log((target + pseudo) / (expected + pseudo))
    out[np.abs(target - expected) < least_z * np.sqrt(expected + 1)] = 0
    return out


def _weigh(batches: Iterator[pa.RecordBatch], at: int, schema: pa.Schema, weights: np.ndarray,
           markers: tuple[np.ndarray, np.ndarray], strongest: int = 3) -> Iterator[pa.RecordBatch]:
    bits = len(weights).bit_length() - 1
    evidence = np.zeros(MARKS)
    evidence[markers[0]] = markers[1]
    for batch in slices(batches):
        found: list[tuple[float, float]] = []
        for x in batch.column(at).cast(pa.string()).cast(pa.binary()):
            h = word_hashes(x.as_py() or b"")
            marks = np.sort(evidence[marks_of(h)])[-strongest:] if len(markers[0]) else evidence[:0]
            found.append((float(weights[buckets_of(h, bits)].sum()), float(marks.sum())))
        out = [pa.array(c, pa.float64()) for c in (zip(*found) if found else ([], []))]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.StructArray.from_arrays(out, fields=list(schema.field(len(schema) - 1).type))], schema=schema)


def weigh(docs: DataFrame, text_col: str, weights: np.ndarray, markers: tuple[np.ndarray, np.ndarray], out: str) -> DataFrame:
    """``docs`` with a struct ``out`` of the ``log_weight`` and the ``toxic``
    evidence of each row's text; ``markers`` are buckets and their evidence.

    Rows stream through Python in small batches.  (A scalar Arrow function, which
    sends the text alone, keeps rows waiting in the executor and measured over
    1 GB more there.)"""
    kept = docs.drop(out)
    both = T.StructType([T.StructField("log_weight", T.DoubleType()), T.StructField("toxic", T.DoubleType())])
    schema = T.StructType([*kept.schema.fields, T.StructField(out, both)])
    arrow, at = to_arrow_schema(schema), kept.columns.index(text_col)
    return kept.mapInArrow(lambda it: _weigh(it, at, arrow, weights, markers), schema)


def gumbel(seed: int, *of: Column) -> Column:
    """A seeded standard Gumbel number per row."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *of), 11) + 0.5) * 2.0 ** -53
    return -F.log(-F.log(u))


def kth_largest(keys: DataFrame, column: str, k: int, ranges: int = 1024, enough: int = 5000) -> float:
    """The k-th largest value, by counting values in ever narrower ranges."""
    low, high, n = keys.agg(F.min(column), F.max(column), F.count(column)).first()
    if not n or k >= n:
        return float("-inf")
    if k <= 0:
        return float("inf")
    inside = keys.where(F.col(column).isNotNull())
    while low < high and inside.limit(enough + 1).count() > enough:
        step = (high - low) / ranges
        slot = F.least(F.floor((F.col(column) - low) / step), F.lit(ranges - 1))
        for s, count, lo, hi in sorted(map(tuple, inside.groupBy(slot.alias("s")).agg(
                F.count("*"), F.min(column), F.max(column)).collect()), reverse=True):
            if k <= count:
                break
            k -= count
        low, high = lo, hi
        inside = inside.where(F.col(column).between(low, high))
    if low >= high:
        return low
    return sorted((r[0] for r in inside.select(column).collect()), reverse=True)[k - 1]


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", out: str = "quality_key",
             bits: int = 18, pseudo: float = 1.0, least_z: float = 3.0, temperature: float = 0.25, loss: float = 0.003,
             k: int | None = None, seed: int = 42, label_rows: int = 50_000, least_toxic: float = 2.0) -> DataFrame:
    """``docs`` with a struct column ``out``: ``log_weight``, ``key`` and ``kept``.

    ``labels`` has ``id_col``, quality (0 or 1) and toxic (0 or 1); rows are
    clean with quality 1 and toxic 0, and take no part with a null.  At most
    ``label_rows`` of them, those of smallest id hash, are used: seven tenths to
    fit, the rest to set the bars.  A row is kept when its key reaches its bar and
    its toxic evidence does not exceed its own (``least_toxic`` at least, so one
    weak word rejects nothing).  Without clean or without rejected labelled
    rows every document is kept.  Null and empty texts weigh 0.  Null ids and
    repeated rows are kept as rows; rows equal in id and text share their key.
    A column named ``out`` is replaced; others stay.  An empty table gives an
    empty result.  Reruns agree.
    """
    sample = cut(labels.select(F.col(id_col).alias("label of"), (
        (F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good"),
        F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("toxic"))
        .where("`label of` is not null and good is not null").groupBy("label of")
        .agg(F.min("good").alias("good"), F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64(F.lit(seed), "label of"), "label of").limit(label_rows)
        .withColumn("fit", F.pmod(F.xxhash64(F.lit(seed + 1), "label of"), F.lit(10)) < 7))
    data = F.col(text_col).cast("binary").alias("data")
    marked = small_batches(docs).select(F.col(id_col).alias("id"), data).join(
        F.broadcast(sample.where("fit")), F.col("id") == F.col("label of"), "left").select("data", "good", "toxic")
    counts = (marked.mapInArrow(lambda it: _count(it, bits), "bucket bigint, raw bigint, labelled bigint, target bigint")
              .groupBy("bucket").agg(F.sum("raw"), F.sum("labelled"), F.sum("target").alias("n"))
              .where((F.col("bucket") < 1 << bits) | (F.col("n") > 0)).toPandas().to_numpy(np.int64))
    marks, counts = counts[counts[:, 0] >= 1 << bits], counts[counts[:, 0] < 1 << bits]
    rows = marks[marks[:, 0] == (1 << bits) + MARKS]
    marks = marks[marks[:, 0] < (1 << bits) + MARKS]
    strength = marker_weights(marks[:, 2], marks[:, 3], *rows[0, 2:]) if len(rows) else np.zeros(0)
    markers = (marks[:, 0] - (1 << bits))[strength > 0], strength[strength > 0]
    raw, labelled, target = np.zeros((3, 1 << bits), np.int64)
    raw[counts[:, 0]], labelled[counts[:, 0]], target[counts[:, 0]] = counts[:, 1:].T
    usable = target.any() and (labelled > target).any()
    weights = log_ratio(raw, labelled, target, pseudo, least_z) if usable else np.zeros(1 << bits)

    names = [c for c in docs.columns if c != out]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))

    def keyed(rows: DataFrame) -> DataFrame:
        return weigh(rows, text_col, weights, markers, out).withColumn(out, F.col(out).withField(
            "key", F.col(f"{out}.log_weight") + temperature * gumbel(seed, F.col(id_col), text)))

    bar, toxic_bar = float("-inf"), float("inf")
    if usable:
        toxic_bar = least_toxic
        held = docs.select(id_col, text_col).join(F.broadcast(sample.where("not fit and good")),
                                                  F.col(id_col) == F.col("label of")).select(id_col, text_col)
        got, mark = keyed(held).agg(F.percentile_approx(f"{out}.key", loss / 2, 10_000),
                                    F.percentile_approx(f"{out}.toxic", 1 - loss / 2, 10_000)).first()
        if got is not None:
            bar, toxic_bar = min(got, -4 * temperature), max(mark, least_toxic)
    passes = F.col(f"{out}.toxic") <= toxic_bar
    if usable and k is not None:
        bar = kth_largest(cut(keyed(docs.select(id_col, text_col)).where(passes).select(f"{out}.key")), "key", k)
    return keyed(docs).withColumn(out, F.struct(f"{out}.log_weight", f"{out}.key",
                                                ((F.col(f"{out}.key") >= bar) & passes).alias("kept"))) \
                      .select(*[F.col(f"`{c}`") for c in names], out)
