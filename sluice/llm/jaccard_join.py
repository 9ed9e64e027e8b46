"""N-gram Jaccard join by vertical partitioning of the n-gram order.

Documents are sets of word shingles.  Two link when
``100 * |x & y| >= percent * |x | y|``.  The join runs in four steps.

1. **Sets.**  Every text becomes its set of 64-bit shingle hashes; equal sets
   (equal 128-bit digests) collapse to one node, so copies cost one row each.
2. **Screening.**  A linked set shares all but ``p - 1`` of any leading stretch
   of its own shingles, ``p = n - ceil(percent * n / 100) + 1``.  The stretch
   of ``depth * p`` smallest hashes is counted by shingle (partial
   aggregates), and sets with ``p`` or more shingles found nowhere else drop
   out.  Nothing that has a link is lost.
3. **Fragments.**  For the sets left, shingles found in two or more sets get a
   global order, rare first, and pivots (quantiles) cut that order into
   vertical fragments.  For a candidate pair every fragment counts its own
   partial overlap; the partial counts are summed per pair, and the sum
   decides exactly.
4. **Candidates.**  Pairs come from inverted lists of each set's leading
   shingles (prefix rule).  A list is not expanded into its pairs: each member
   meets one pivot of its list, the member with the smallest share of shingles
   of its own, and the verified links give components (further rounds meet
   other pivots).  Last, only pairs of one list that are *still in different
   components*, and whose sizes and places in the order allow a link, are
   checked, so every link between different components is found and none is
   checked inside one.

Results cover all rows; there is no cap on list lengths or partners.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import components, cut, shingle_set, slices, small_batches


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _free(n: int, percent: int) -> int:
    """p: so many of a linked set's shingles must hold a shared one."""
    return n - (percent * n + 99) // 100 + 1


def _lists(columns: list[np.ndarray]) -> pa.ListArray:
    flat = np.concatenate(columns) if columns else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum([len(x) for x in columns])].astype(np.int32)),
                                    pa.array(flat.view(np.int64)))


def _sets(batches: Iterator[pa.RecordBatch], n_words: int) -> Iterator[pa.RecordBatch]:
    """Size and digest of every row's set."""
    for batch in slices(batches):
        sets = [shingle_set(x or b"", n_words) for x in batch.column("data").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(map(len, sets), pa.int64()), pa.array(map(_digest, sets), pa.binary())],
            names=["id", "n", "key"])


def _leads(batches: Iterator[pa.RecordBatch], n_words: int, percent: int, depth: float) -> Iterator[pa.RecordBatch]:
    """Digest and leading stretch (smallest hashes) of every row's set."""
    for batch in slices(batches):
        sets = [shingle_set(x or b"", n_words) for x in batch.column("data").to_pylist()]
        sets = [s for s in sets if len(s)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(map(_digest, sets), pa.binary()),
             _lists([s[:math.ceil(_free(len(s), percent) * depth)] for s in sets])], names=["key", "lead"])


def _matching(batches: Iterator[pa.RecordBatch], n_words: int) -> Iterator[pa.RecordBatch]:
    """Shingles of the rows whose set has the digest asked for."""
    for batch in slices(batches):
        nodes, sets = [], []
        for node, key, data in zip(*(batch.column(c).to_pylist() for c in ("node", "key", "data"))):
            s = shingle_set(data or b"", n_words)
            if _digest(s) == key:
                nodes.append(node)
                sets.append(s)
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), _lists(sets)], names=["node", "tokens"])


def _free_col(n: Column, percent: int) -> Column:
    return n - F.ceil(n * percent / 100).cast("bigint") + 1


def _can_link(n: Column, m: Column, percent: int) -> Column:
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def _may_share(left: Column, sizes: Column, percent: int) -> Column:
    """Whether two sets of ``sizes`` shingles together can still link when their
    first common shingle leaves ``left``, itself included, in the shorter rest."""
    return left * (100 + percent) >= sizes * percent


def _across(live: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(x, y)`` of one list, in different components, that can link by
    size and position.  Sizes of a pair differ by a factor of at most
    ``100 / percent``, so each row meets its own class of sizes and the next."""
    step = math.log(100 / percent)
    small = live.withColumn("class", F.explode(F.array(
        F.floor(F.log("n") / step + 1e-9), F.floor(F.log("n") / step + 1e-9) + 1)))
    large = live.select("t", F.floor(F.log("n") / step + 1e-9).alias("class"),
                        *[F.col(c).alias(f"{c}2") for c in ("node", "n", "left", "comp")])
    return (small.join(large, ["t", "class"])
            .where("comp != comp2 and (n < n2 or n = n2 and node < node2)")
            .where(_can_link(F.col("n"), F.col("n2"), percent))
            .where(_may_share(F.least("left", "left2"), F.col("n") + F.col("n2"), percent))
            .select(F.col("node").alias("x"), F.col("node2").alias("y")))


def _verified(pairs: DataFrame, sets: DataFrame, cuts: list[int], percent: int) -> DataFrame:
    """Links ``(a, b)`` among ``pairs(a, b)``: every fragment of the order counts
    its partial overlap of a pair, and the partial counts are summed per pair."""
    lo, hi = [-1, *cuts], [*cuts, None]

    def fragment(tokens: str, i: int) -> Column:
        return F.filter(tokens, lambda t: (t > lo[i]) & (t <= hi[i] if hi[i] is not None else F.lit(True)))

    pieces = sets.select("node", "n", F.posexplode(F.array(
        *[fragment("tokens", i) for i in range(len(lo))])).alias("fragment", "part")).where(F.size("part") > 0)
    pa_, pb_ = (pieces.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), "fragment",
                              F.col("part").alias(f"p{x}")) for x in "ab")
    parts = (pairs.join(pa_, "a").join(pb_, ["b", "fragment"])
             .select("a", "b", "na", "nb", F.size(F.array_intersect("pa", "pb")).alias("part")))
    total = parts.groupBy("a", "b").agg(F.sum("part").alias("both"), F.min("na").alias("na"), F.min("nb").alias("nb"))
    return total.where(F.col("both") * 100 >= (F.col("na") + F.col("nb") - F.col("both")) * percent).select("a", "b")


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       n_words: int = 5, percent: int = 80, depth: float = 1.5,
                       fragments: int = 4, pivot_rounds: int = 1,
                       broadcast_rows: int = 250_000) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``n_shingles``, ``component_id``.

    ``component_id`` is the smallest id reachable over links, the row's own
    included.  Null text counts as empty; an empty document has 0 shingles and
    no link.  Rows with equal sets are linked.  A row whose id is null takes no
    part in linking and has a null ``component_id``.  Rows that repeat an id
    are kept, each with its own set.  Other columns of ``docs`` are ignored.
    An empty table gives an empty result.

    ``broadcast_rows``: lists of candidate ids (40 bytes a row) up to this
    length are broadcast; longer ones are joined by a shuffle.
    """
    src = small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("data"))
    sets = cut(src.mapInArrow(lambda it: _sets(it, n_words),
                              f"id {src.schema['id'].dataType.simpleString()}, n bigint, key binary"))
    full = sets.where("n > 0 and id is not null")

    # Screening: a shingle that only one set has in its leading stretch is free.
    # The stretches are hashed anew rather than kept: they would be the largest
    # thing on disk.
    node = F.xxhash64("key")
    leads = src.where("id is not null").select("data").mapInArrow(
        lambda it: _leads(it, n_words, percent, depth), "key binary, lead array<bigint>")
    alone = (leads.select(node.alias("k"), F.explode("lead").alias("token"))
             .groupBy("token").agg(F.min("k").alias("node"), F.max("k").alias("other"))
             .where("node = other").groupBy("node").agg(F.count("*").alias("alone")))
    nodes = cut(full.groupBy("key").agg(F.min("id").alias("id"), F.min("n").alias("n"))
                .withColumn("node", node).join(alone, "node", "left")
                .select("node", "key", "id", "n", _free_col(F.col("n"), percent).alias("p"),
                        F.coalesce("alone", F.lit(0)).alias("alone")))
    open_nodes = nodes.where("alone < p")

    # Whole sets of the candidates.
    pick = open_nodes.select("node", "key", "id")
    if pick.count() <= broadcast_rows:
        pick = F.broadcast(pick)
    whole = cut(src.where("id is not null").join(pick, "id").select("node", "key", "data").distinct()
                .mapInArrow(lambda it: _matching(it, n_words), "node bigint, tokens array<bigint>"))

    # Global order: rarity class first, then hash.  A shared shingle's number
    # has 6 bits of class and 57 of its hash, so numbers compare in that order.
    posts = whole.select("node", F.explode("tokens").alias("token"))
    shared = (posts.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
              .select("token", F.expr("shiftleft(least(63, cast(floor(4 * log2(df)) as bigint)), 57)"
                                      " + shiftrightunsigned(token, 7)").alias("num")))
    ordered = cut(posts.join(shared.hint("shuffle_hash"), "token").groupBy("node")
                  .agg(F.sort_array(F.collect_list("num")).alias("tokens"))
                  .join(nodes.select("node", "n", "p"), "node")
                  .withColumn("free", F.col("p") - (F.col("n") - F.size("tokens")))
                  .where("free > 0"))
    at = ordered.select(F.explode("tokens").alias("t")).agg(
        F.percentile_approx("t", [i / fragments for i in range(1, fragments)], 1000)).first()[0]
    cuts = sorted(set(at or []))

    # Inverted lists over the prefixes; left: shared shingles from here on.
    lists = ordered.select("node", "n", F.size("tokens").alias("m"),
                           F.posexplode(F.expr("slice(tokens, 1, cast(free as int))")).alias("i", "t")) \
                   .select("node", "n", "t", (F.col("m") - F.col("i")).alias("left"),
                           ((F.col("n") - F.col("m")) / F.col("n")).alias("odd"))
    several = lists.groupBy("t").agg(F.count("*").alias("c")).where("c > 1").select("t")
    lists = cut(lists.join(several, "t", "left_semi"))
    labels = lists.select("node", F.col("node").alias("comp")).distinct()
    for turn in range(pivot_rounds + 1):
        live = lists.join(labels, "node")
        mixed = (live.groupBy("t").agg(
            F.min("comp").alias("c1"), F.max("comp").alias("c2"),
            F.min(F.struct(F.col("odd") if turn == 0 else F.xxhash64("node", F.lit(turn)), "node", "n", "left", "comp"))
            .alias("pivot")).where("c1 != c2"))
        if turn < pivot_rounds:
            met = (live.join(mixed.select("t", "pivot"), "t").where("comp != pivot.comp")
                   .where(_can_link(F.col("n"), F.col("pivot.n"), percent))
                   .where(_may_share(F.least("left", "pivot.left"), F.col("n") + F.col("pivot.n"), percent))
                   .select(F.col("node").alias("x"), F.col("pivot.node").alias("y")))
        else:
            met = _across(live.join(mixed.select("t"), "t", "left_semi"), percent)
        pairs = met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        links = _verified(pairs, ordered, cuts, percent)
        joined = (links.join(labels.select(F.col("node").alias("a"), F.col("comp").alias("u")), "a")
                  .join(labels.select(F.col("node").alias("b"), F.col("comp").alias("v")), "b"))
        merged = components(joined.select("u", "v"), "u", "v")
        labels = cut(labels.join(merged.select(F.col("node").alias("comp"), F.col("comp").alias("to")), "comp", "left")
                     .select("node", F.coalesce("to", "comp").alias("comp")))

    # Smallest id of each component, back to every row by its set.
    named = nodes.join(labels, "node", "left").select("key", "id", F.coalesce("comp", "node").alias("comp"))
    first = named.groupBy("comp").agg(F.min("id").alias("component_id"))
    by_key = named.join(first, "comp").select("key", "component_id")
    return (sets.join(by_key, "key", "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id")))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", broadcast_rows: int = 250_000,
                **how) -> DataFrame:
    """``docs`` with one document of each component: the one of smallest id.

    Rows whose id is null, and empty documents, stay; of rows equal in id and
    text one stays.  All columns stay.  Ids to drop are broadcast up to
    ``broadcast_rows``, joined by a shuffle beyond.
    """
    found = cut(similar_components(docs, id_col, text_col, **how).where(F.col(id_col).isNotNull()))
    judged, stays, rows = "id to judge", "id stays", "rows of the id"
    odd = cut(found.groupBy(F.col(id_col).alias(judged)).agg(
        F.max(F.col("component_id") == F.col(id_col)).alias(stays), F.count("*").alias(rows))
        .where(~F.col(stays) | (F.col(rows) > 1)))
    repeated = not odd.where(F.col(rows) > 1).isEmpty()
    if odd.count() <= broadcast_rows:
        odd = F.broadcast(odd)
    joined = docs.join(odd, F.col(id_col) == F.col(judged), "left").where(F.col(stays).isNull() | F.col(stays))
    names = [F.col(f"`{c}`") for c in docs.columns]
    if not repeated:
        return joined.select(*names)
    once = F.coalesce(F.col(rows), F.lit(1)) == 1
    return joined.where(once).select(*names).unionByName(
        joined.where(~once).dropDuplicates([id_col, text_col]).select(*names))


def components_sql(n_words: int = 5, percent: int = 80) -> str:
    """The same components of ``documents(doc_id, text)`` in DuckDB SQL."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
sets AS MATERIALIZED (
  SELECT doc_id, list_distinct(CASE
    WHEN len(w) >= {n_words} THEN list_transform(range(1, len(w) - {n_words - 2}),
                                                 lambda i: array_to_string(w[i:i + {n_words - 1}], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words),
items AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets),
links AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.t = b.t AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a)
SELECT doc_id, len(s) AS n_shingles, component_id
FROM sets JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)
"""
