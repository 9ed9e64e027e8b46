"""Mixing sources to target weights by subset-sum budget fitting.

Sources get weights in code-point order and share a budget of words; a target
stops at ``cap`` times its source's size and the excess is shared again by
weight.  A source then takes every document ``full`` times and fits the rest of
its target exactly where lengths allow it:

1. documents are counted by exact length (partial aggregates);
2. every length gives its proportional share of documents, rounded down;
3. what is still missing goes to the longest lengths left until it is small,
   and a bounded-knapsack dynamic programme over the lengths left (a bit set of
   reachable sums, counts split into powers of two) fits the remainder;
4. within a (source, length) group the documents of smallest seeded hash are
   taken, by a threshold: the hash of the last one.  Its bucket is found from
   counts per hash bucket, and only that bucket's rows are ranked, so a group
   with a third of all rows is never in one task.

Only one row per source reaches the driver; length counts of one source meet
in one task (one row per distinct length).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import WORD, cut


def targets(sizes: Iterable[tuple[str | None, int]], weights: Sequence[float], share: float,
            cap: float) -> dict[str | None, float]:
    """Target per source: weights repeat over the sources in code-point order
    (null last); a target above ``cap`` times its size stops there."""
    order = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    left = share * sum(n for _, n in order)
    open_ = [(s, n, weights[i % len(weights)]) for i, (s, n) in enumerate(order)]
    out: dict[str | None, float] = {}
    while open_:
        unit = left / sum(w for *_, w in open_)
        full = [(s, cap * n) for s, n, w in open_ if unit * w > cap * n]
        if not full:
            out.update((s, unit * w) for s, _, w in open_)
            break
        out.update(full)
        left -= sum(t for _, t in full)
        open_ = [x for x in open_ if x[0] not in out]
    return out


def knapsack(lengths: Sequence[int], counts: Sequence[int], budget: int) -> list[int]:
    """How many of each length make the largest sum within ``budget``."""
    reach, steps = 1, []
    mask = (1 << (budget + 1)) - 1
    for i, (n, c) in enumerate(zip(lengths, counts)):
        c, k = min(c, budget // n) if n else 0, 1
        while c and not reach >> budget & 1:
            k = min(k, c)
            steps.append((i, k, reach))
            reach |= reach << (n * k) & mask
            c -= k
            k *= 2
    at, taken = reach.bit_length() - 1, [0] * len(lengths)
    for i, k, before in reversed(steps):
        if not before >> at & 1:
            at -= lengths[i] * k
            taken[i] += k
    return taken


def fit(lengths: Sequence[int], counts: Sequence[int], target: float, small: int = 1 << 15) -> tuple[int, list[int]]:
    """Whole rounds over all documents, and the extra documents of each length."""
    size = sum(n * c for n, c in zip(lengths, counts))
    extra = [0] * len(lengths)
    if not size:
        return 0, extra
    full, rest = divmod(int(target + 0.5), size)
    extra = [c * rest // size if n else 0 for n, c in zip(lengths, counts)]
    rest -= sum(n * k for n, k in zip(lengths, extra))
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        if rest <= small or not lengths[i]:
            break
        k = min(counts[i] - extra[i], -(-(rest - small) // lengths[i]), rest // lengths[i])
        extra[i] += k
        rest -= k * lengths[i]
    more = knapsack(lengths, [c - k for c, k in zip(counts, extra)], rest)
    return full, [a + b for a, b in zip(extra, more)]


def _fit(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by([("size", "descending")])
    full, extra = fit(rows["size"].to_pylist(), rows["count"].to_pylist(), rows["target"][0].as_py())
    return (rows.append_column("full", pa.array([full] * len(extra), pa.int64()))
            .append_column("extra", pa.array(extra, pa.int64()))
            .select(["key", "size", "count", "source_size", "target", "full", "extra"]))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[float] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, seed: int = 42,
        out: str = "mix", broadcast_rows: int = 250_000) -> DataFrame:
    """``docs`` with a struct column ``out``: ``size`` (words of the text),
    ``source_size``, ``target`` (of its source) and ``copies`` (how often the
    mix takes the row, 0 to ``cap``).

    Null text has size 0 and is taken with the whole rounds of its source; a
    null source is a source of its own, last in order.  Rows equal in id and
    text share their hash and are taken or left together where a threshold
    falls on them.  A column named ``out`` is replaced; others stay.  An empty
    table gives an empty result.  Reruns agree.

    ``broadcast_rows``: plans (one row per source and length) up to this length
    are broadcast, longer ones are joined by a shuffle.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = F.to_json(F.struct(F.col(source_col).cast("string").alias("s")))
    marked = docs.withColumn(out, F.struct(
        key.alias("key"), F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("size"),
        F.xxhash64(F.lit(seed), F.col(id_col), text).alias("h")))
    slim = cut(marked.select(F.col(out)["key"].alias("key"), F.col(out)["size"].alias("size"), F.col(out)["h"].alias("h"),
                             F.col(source_col).cast("string").alias("source")))

    lengths = cut(slim.groupBy("key", "source", "size").count())
    per_source = lengths.groupBy("key", "source").agg(F.sum(F.col("size") * F.col("count")).alias("n")).collect()
    goal = targets([(r.source, r.n) for r in per_source], weights, share, cap)
    goals = docs.sparkSession.createDataFrame(
        [(r.key, r.n, float(goal[r.source])) for r in per_source], "key string, source_size bigint, target double")
    quota = cut(lengths.select("key", "size", "count").join(goals, "key").groupBy("key").applyInArrow(
        _fit, "key string, size bigint, count bigint, source_size bigint, target double, full bigint, extra bigint"))

    # The hash of the last document taken of each (source, length).
    some = quota.where("extra > 0 and extra < count").select("key", "size", "extra")
    rows = slim.join(some, ["key", "size"]).select("key", "size", "extra", "h", F.shiftright("h", 56).alias("bucket"))
    counts = rows.groupBy("key", "size", "extra", "bucket").count()
    upto = F.sum("count").over(Window.partitionBy("key", "size").orderBy("bucket"))
    edge = (counts.withColumn("upto", upto).where("upto >= extra and upto - count < extra")
            .select("key", "size", "bucket", (F.col("extra") - F.col("upto") + F.col("count")).alias("nth")))
    nth = F.row_number().over(Window.partitionBy("key", "size", "bucket").orderBy("h"))
    last = (rows.drop("extra").join(edge, ["key", "size", "bucket"]).withColumn("n", nth).where("n = nth")
            .select("key", "size", F.col("h").alias("last")))
    plan = cut(quota.join(last, ["key", "size"], "left").select(
        F.col("key").alias("key of the plan"), F.col("size").alias("size of the plan"),
        F.struct("source_size", "target", "full",
                 F.when(F.col("extra") == F.col("count"), F.lit((1 << 63) - 1)).otherwise(F.col("last")).alias("last"))
        .alias("plan of the mix")))
    if plan.count() <= broadcast_rows:
        plan = F.broadcast(plan)
    given = F.col("plan of the mix")
    taken = given["full"] + F.when(F.col(out)["h"] <= given["last"], 1).otherwise(0)
    names = [c for c in docs.columns if c != out]
    same = (F.col(out)["key"] == F.col("key of the plan")) & (F.col(out)["size"] == F.col("size of the plan"))
    return marked.join(plan, same).select(*[F.col(f"`{c}`") for c in names], F.struct(
        F.col(out)["size"].alias("size"), given["source_size"].alias("source_size"), given["target"].alias("target"),
        taken.alias("copies")).alias(out))
