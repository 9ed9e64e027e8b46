"""Ranked lexical search over bit-sliced Bloom signatures.

``build`` gives every document a Bloom signature of its terms: ``HASHES`` bits for
each term and each level of ``LEVELS`` its count reaches.  Documents of one size
class share a signature length and are dealt into blocks; a block keeps the
signatures bit-sliced: one bitmap over the documents per bit.  The slices of a
term, and-ed, hold every document with the term and a few others.  Slices
weighted by the terms' weights, level by level and with the document's length,
therefore sum to an upper bound of its score.

``search`` takes the k best bounds of each item first; the k-th best exact score
of those is a threshold, and every document whose bound reaches it is scored
exactly.  Only documents whose bound is below it, or of whose very text k rows
with smaller ids are kept, go unscored.
"""

from __future__ import annotations

import math
import string
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm.common import mix, slices, small_batches
from sluice.session import new_run_dir

#: A term has a bit set of its own for each of these counts that it reaches.
LEVELS = (1, 2, 3, 5, 9)
HASHES = 3
#: Signature bits for every key the size class may have, and bits of a block.
BITS_PER_KEY = 8
BLOCK_BITS = 1 << 19
#: Text of the items that are searched for at once, in bytes.
QUERY_BYTES = 1 << 20
#: Documents to score exactly, and their links to items, that are broadcast.
BROADCAST_ROWS = 50_000
BROADCAST_LINKS = 400_000

_KEEP = (string.ascii_letters + string.digits).encode()
_TABLE = bytes((c + 32 if 65 <= c <= 90 else c) if c >= 128 or c in _KEEP else 32 for c in range(256))

_INDEX = pa.schema([
    ("bits", pa.int64()), ("doc", pa.list_(pa.int64())), ("same", pa.list_(pa.int64())), ("n", pa.list_(pa.int64())),
    ("top", pa.list_(pa.int64())), ("slices", pa.binary()), ("terms", pa.int64())])
INDEX_DDL = "bits long, doc array<long>, same array<long>, n array<long>, top array<long>, slices binary, terms long"


def terms_of(data: bytes) -> list[bytes]:
    """Runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased."""
    return data.translate(_TABLE).split()


def keys_of(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return np.concatenate([mix(hashes[counts >= least] + np.uint64(i)) for i, least in enumerate(LEVELS)])


def places(keys: np.ndarray, bits: int) -> np.ndarray:
    """(HASHES, keys): the signature bits of each key."""
    step = (keys >> np.uint64(32)) | np.uint64(1)
    return np.stack([(keys + np.uint64(i) * step) & np.uint64(bits - 1) for i in range(HASHES)]).astype(np.int64)


def _block(bits: int, rows: list[tuple]) -> pa.RecordBatch:
    ids, same, n, top, keys = zip(*rows)
    grid = np.zeros((bits, -(-len(rows) // 8) * 8), np.bool_)
    for i, k in enumerate(keys):
        grid[places(k, bits).ravel(), i] = True
    one = lambda x: pa.array([list(x)], pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays(
        [pa.array([bits], pa.int64()), one(ids), one(same), one(n), one(top), pa.array([np.packbits(grid, axis=1).tobytes()], pa.binary()),
         pa.array([sum(n)], pa.int64())], schema=_INDEX)


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    open_blocks: dict[int, list] = {}
    for batch in slices(batches):
        ids, same = batch.column("doc_id").to_pylist(), batch.column("same").to_pylist()
        for i, text in enumerate(batch.column("text")):
            c = Counter(terms_of(text.as_buffer().to_pybytes()))
            if not c:
                continue
            counts = np.fromiter(c.values(), np.int64, len(c))
            keys = keys_of(np.fromiter(map(xxhash.xxh3_64_intdigest, c), np.uint64, len(c)), counts)
            bits = BITS_PER_KEY << max(4, (len(keys) - 1).bit_length())
            rows = open_blocks.setdefault(bits, [])
            rows.append((ids[i], same[i], int(counts.sum()), int(counts.max()), keys))
            if len(rows) >= max(8, BLOCK_BITS // bits):
                yield _block(bits, open_blocks.pop(bits))
    for bits, rows in open_blocks.items():
        yield _block(bits, rows)


def _counts(asked: frozenset[bytes]):
    """Documents of a task that hold each of the terms asked for."""
    schema = pa.schema([("term", pa.binary()), ("df", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df: Counter = Counter()
        for batch in slices(batches):
            for text in batch.column("text"):
                df.update(asked.intersection(terms_of(text.as_buffer().to_pybytes())))
        yield pa.RecordBatch.from_arrays([pa.array(list(df.keys()), pa.binary()), pa.array(list(df.values()), pa.int64())], schema=schema)
    return run


def build(docs: DataFrame) -> DataFrame:
    """The index of ``docs`` (doc_id, text), written to the shared folder.

    One row per block of documents; documents without terms are in none.
    """
    spark, folder = docs.sparkSession, new_run_dir(docs.sparkSession, "lexical-index")
    rows = docs.where("text IS NOT NULL").select("doc_id", "text", F.xxhash64("text").alias("same"))
    small_batches(rows).mapInArrow(_index, INDEX_DDL).write.option("parquet.block.size", 16 << 20).parquet(folder)
    return spark.read.schema(INDEX_DDL).parquet(folder)


class Query:
    """Items to search for, as weights of their terms; travels to the tasks."""

    def __init__(self, items: list[tuple], df: dict[bytes, int], n_docs: int, n_terms: int):
        self.items, self.n_docs, self.n_terms = [i for i, _ in items], n_docs, n_terms
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * c + 1))) for t, c in df.items()}
        self.terms = [t for t, w in weight.items() if w > 0]
        number = {t: i for i, t in enumerate(self.terms)}
        self.of = [[(number[t], n, weight[t]) for t, n in Counter(terms_of(text)).items() if t in number] for _, text in items]
        self.hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.terms), np.uint64, len(self.terms))

    def lengths(self, n: np.ndarray) -> np.ndarray:
        return 75 + (25 * n * self.n_docs) // self.n_terms

    def score(self, item: int, counts: dict[bytes, int], m: int) -> int:
        total = 0
        for t, n, w in self.of[item]:
            tf = counts.get(self.terms[t], 0)
            total += n * w * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))
        return total

    def bounds(self, bits: int, n: np.ndarray, top: np.ndarray, data: bytes) -> np.ndarray:
        """(items, documents of the block): no score is above its bound."""
        docs = len(n)
        grid = np.frombuffer(data, np.uint8).reshape(bits, -1)
        m, out, before = self.lengths(n), np.zeros((len(self.items), docs), np.int64), np.zeros(docs, np.int64)
        item = np.repeat(np.arange(len(self.of)), [len(x) for x in self.of])
        term = np.array([t for x in self.of for t, _, _ in x], np.int64)
        share = np.array([c * w for x in self.of for _, c, w in x], np.int64)
        alive = np.ones(len(self.terms), np.bool_)
        for i, _ in enumerate(LEVELS):
            most = np.minimum(top, LEVELS[i + 1] - 1) if i + 1 < len(LEVELS) else top
            gain = (1_000_000_000 * most) // (1000 * most + 12 * m)
            at = places(mix(self.hashes + np.uint64(i)), bits)
            held = grid[at[0]]
            for p in at[1:]:
                held &= grid[p]
            alive &= held.any(axis=1)
            if not alive.any():
                break
            number = np.cumsum(alive) - 1
            has = np.unpackbits(held[alive], axis=1, count=docs)
            used = alive[term]
            at_item, at_term, at_share = item[used], number[term[used]], share[used]
            step = max(1, (1 << 20) // docs)
            for lo in range(0, len(at_item), step):
                part = at_item[lo:lo + step]
                starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
                sums = np.add.reduceat(has[at_term[lo:lo + step]] * at_share[lo:lo + step, None], starts, axis=0)
                out[part[starts]] += sums * (gain - before)
            before = gain
        return out


def _blocks(batches: Iterator[pa.RecordBatch]):
    for batch in slices(batches, 1):
        c = {x: batch.column(x) for x in ("doc", "same", "n", "top")}
        doc, same, n, top = (c[x].flatten() for x in ("doc", "same", "n", "top"))
        yield doc, same.to_numpy(), batch.column("bits")[0].as_py(), n.to_numpy(), top.to_numpy(), batch.column("slices")[0].as_py()


_FOUND = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("same", pa.int64()), ("bound", pa.int64())])
FOUND_DDL = "item long, doc_id long, same long, bound long"


def _best_bounds(query: Query, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [np.empty((0, 2), np.int64) for _ in query.items]  # bound, place in kept
        kept: list = []
        for doc, same, bits, n, top, data in _blocks(batches):
            ids, bound = doc.to_pylist(), query.bounds(bits, n, top, data)
            for i, row in enumerate(bound):
                least = best[i][-1, 0] if len(best[i]) == k else 0
                at = np.flatnonzero(row > least)
                if len(at) > k:
                    at = at[np.argpartition(-row[at], k - 1)[:k]]
                if len(at):
                    new = np.stack([row[at], np.arange(len(kept), len(kept) + len(at))], axis=1)
                    kept += [(ids[j], int(same[j])) for j in at]
                    both = np.concatenate([best[i], new])
                    best[i] = both[np.argsort(-both[:, 0], kind="stable")[:k]]
            if len(kept) > 4 * k * len(best) + 10_000:  # forget what fell out
                used = np.concatenate([b[:, 1] for b in best])
                place = {int(p): j for j, p in enumerate(used)}
                kept = [kept[p] for p in used]
                best = [np.stack([b[:, 0], [place[int(p)] for p in b[:, 1]]], axis=1) if len(b) else b for b in best]
        rows = [(i, *kept[p], int(s)) for i, b in enumerate(best) for s, p in b]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], schema=_FOUND)
    return run


def _not_excluded(query: Query, least: list[int], k: int):
    floor = np.array(least, np.int64)[:, None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, same, bits, n, top, data in _blocks(batches):
            bound = query.bounds(bits, n, top, data)
            item, at = np.nonzero(bound >= floor)
            if not len(item):
                continue
            ids = doc.fill_null(np.iinfo(np.int64).max).to_numpy()
            order = np.lexsort((ids[at], same[at], item))
            item, at = item[order], at[order]
            new = np.r_[True, (item[1:] != item[:-1]) | (same[at][1:] != same[at][:-1])]
            place = np.arange(len(item))
            few = place - np.maximum.accumulate(np.where(new, place, 0)) < k
            item, at = item[few], at[few]
            yield pa.RecordBatch.from_arrays([pa.array(item.astype(np.int64)), doc.take(pa.array(at)), pa.array(same[at]), pa.array(bound[item, at])], schema=_FOUND)
    return run


def _scores(query: Query):
    schema = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            rows = []
            for doc, text, items in zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("items").to_pylist()):
                counts = Counter(terms_of(text.as_buffer().to_pybytes()))
                m = int(query.lengths(np.int64(counts.total())))
                rows += [(i, doc, s) for i in items if (s := query.score(i, counts, m)) > 0]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], schema=schema)
    return run


def _scored(docs: DataFrame, found: DataFrame, query: Query, k: int) -> DataFrame:
    """(item, doc_id, score, rank): the k best of each item by exact score."""
    spark, folder = docs.sparkSession, new_run_dir(docs.sparkSession, "lexical-found")
    (found.groupBy(F.col("doc_id").alias("id"), F.col("same").alias("like"))
          .agg(F.collect_set("item").alias("items")).write.parquet(folder))
    wanted = spark.read.parquet(folder)
    rows, links = wanted.agg(F.count("*"), F.coalesce(F.sum(F.size("items")), F.lit(0))).first()
    if rows <= BROADCAST_ROWS and links <= BROADCAST_LINKS:
        wanted = F.broadcast(wanted)
    texts = docs.where("text IS NOT NULL").select("doc_id", "text", F.xxhash64("text").alias("same"))
    texts = texts.join(wanted, (F.col("same") == F.col("like")) & F.col("doc_id").eqNullSafe(F.col("id"))).select("doc_id", "text", "items")
    scored = small_batches(texts).mapInArrow(_scores(query), "item long, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(index: DataFrame, docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of every item.

    ``docs`` are the rows the index was built from.  Items are searched for in
    blocks of about ``QUERY_BYTES`` of text; rows of ``items`` that are equal count
    once, rows of equal id and other text are items of their own.  Null or empty
    texts, and items whose terms no document holds, have no result.  Ties go to
    the smaller id, null ids last; repeated documents are results of their own.
    """
    spark = docs.sparkSession
    texts = items.select("item_id", "text").where("text IS NOT NULL").distinct()
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_docs, n_terms = index.agg(F.sum(F.size("n")), F.sum("terms")).first()
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    if not n_docs or not size:
        return out
    blocks = -(-size // QUERY_BYTES)
    for b in range(blocks):
        part = texts.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        rows = [(r.item_id, r.text.encode()) for r in part.collect()]  # about QUERY_BYTES
        asked = frozenset(t for _, x in rows for t in terms_of(x))
        counts = (small_batches(docs.where("text IS NOT NULL").select("text")).mapInArrow(_counts(asked), "term binary, df long")
                  .groupBy("term").agg(F.sum("df").alias("df")))
        query = Query(rows, {bytes(r.term): r.df for r in counts.collect()}, n_docs, n_terms)  # terms of the items
        if not query.terms:
            continue
        signatures = small_batches(index.select("bits", "doc", "same", "n", "top", "slices"))
        best = signatures.mapInArrow(_best_bounds(query, k), FOUND_DDL)
        order = Window.partitionBy("item").orderBy(F.desc("bound"), "doc_id")
        best = best.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
        kth = {r.item: r.score for r in _scored(docs, best, query, k).where(F.col("rank") == k).select("item", "score").collect()}
        least = [kth.get(i, 1) for i in range(len(rows))]
        found = signatures.mapInArrow(_not_excluded(query, least, k), FOUND_DDL)
        ids = spark.createDataFrame(list(enumerate(query.items)), "item long, item_id long")
        result = _scored(docs, found, query, k).join(F.broadcast(ids), "item")
        out = out.union(result.select("item_id", "rank", "doc_id", "score"))
    return out


def search_sql(k: int = 20) -> str:
    """DuckDB twin: every document scored."""
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    low = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

    def counted(table: str, key: str) -> str:
        return (f"SELECT {key}, t, count(*) AS tf FROM (SELECT {key}, unnest(regexp_extract_all({low}, '{pattern}')) AS t "
                f"FROM {table}) GROUP BY ALL")
    return f"""WITH d AS ({counted('documents', 'doc_id')}), q AS ({counted('benchmark', 'item_id')}),
len AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM d GROUP BY doc_id),
all_of AS (SELECT count(*) AS big_n, sum(n)::BIGINT AS big_l FROM len),
w AS (SELECT t, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM d, all_of GROUP BY t, big_n),
s AS (SELECT item_id, d.doc_id, sum(q.tf * w.w * ((1000000000 * d.tf) // (1000 * d.tf + 12 * (75 + (25 * n * big_n) // big_l))))::BIGINT AS score
  FROM q JOIN d USING (t) JOIN w USING (t) JOIN len ON len.doc_id = d.doc_id, all_of GROUP BY ALL),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM s WHERE score > 0)
SELECT * FROM r WHERE rank <= {k}"""
