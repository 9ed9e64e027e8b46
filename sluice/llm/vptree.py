"""Maximum inner product search with vantage-point trees per shard.

A vector x is lifted by one coordinate, ``sqrt(M^2 - |x|^2)`` with M the largest
norm, and a query by 0; the Euclidean distance of lifted vectors then falls as
the inner product rises, so the triangle inequality applies.

A vantage tree over a bounded sample deals the vectors to at most ``REGIONS``
regions; each keeps the exact range of its vectors' distances from the vantage
points above it.  A region of more than ``shard_rows`` vectors is split into
shards by hash.  A task builds the tree of one shard once and streams its
queries through it, where every node stores the range of distances from its
vantage point for each child: a child is skipped for a query when
``factor * lower bound`` exceeds the distance of the query's k-th best so far.

Every query is answered by its own shard first.  The k-th score found there
then rules out regions by the same bound, and the query goes to the shards that
are left.  Vectors are not copied, unless more than ``query_rows`` queries meet
one shard.  Factor 1 is exact; larger factors prune more and may miss some.
Where the search may have cut points that tie with the k-th score, a further
walk collects all points that reach it, so ties go by id however many there are.
Equal vectors of a shard share one tree point that keeps the ids which can
appear in a result.  The nearest of all shards are merged by rank.

Scores are sums of products in a fixed order in double precision, so equal
vectors score equally wherever they are stored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import cut

#: Most regions of the upper tree, which tasks hold whole, and rows it is fitted on.
REGIONS, SAMPLE_ROWS = 1024, 16_384


def _slack(norm: np.ndarray | float) -> np.ndarray | float:
    """Bound on the rounding error of distances whose squares sum to ``norm``."""
    return 1e-7 * np.sqrt(norm)


def _vantage(points: np.ndarray, rows: np.ndarray) -> int:
    """The candidate vantage point whose distances vary most."""
    tries = rows[np.linspace(0, len(rows) - 1, 5).astype(int)]
    sample = points[rows[np.linspace(0, len(rows) - 1, min(len(rows), 64)).astype(int)]]
    return int(tries[np.argmax([np.var(np.linalg.norm(sample - points[t], axis=1)) for t in tries])])


class Tree:
    """Vantage-point tree over the rows of ``points``, in flat node lists."""

    def __init__(self, points: np.ndarray, leaf: int = 128):
        self.points, self.leaf = points, leaf
        self.nodes: list[tuple] = []  # (vantage, [(child, low, high)...]) or (None, rows)
        self.root = self._build(np.arange(len(points)))

    def _build(self, rows: np.ndarray) -> int:
        me = len(self.nodes)
        self.nodes.append(())
        if len(rows) <= self.leaf:
            self.nodes[me] = (None, rows)
            return me
        v = _vantage(self.points, rows)
        d = np.linalg.norm(self.points[rows] - self.points[v], axis=1)
        order = np.argsort(d, kind="stable")
        half = len(rows) // 2
        children = []
        for part in (order[:half], order[half:]):
            children.append((self._build(rows[part]), float(d[part[0]]), float(d[part[-1]])))
        self.nodes[me] = (v, children)
        return me

    def search(self, queries: np.ndarray, norms: np.ndarray, keep: int, factor: float,
               floor: np.ndarray | float = -np.inf) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of the ``keep`` largest inner products above ``floor``
        per query (-1: none), in no order.  ``queries`` are lifted; ``norms``
        holds ``|q|^2 + M^2``.

        A first walk takes every query to its nearest leaf only, which bounds
        its distances; the second visits each node once, with the queries that
        the bound lets through.
        """
        n = len(queries)
        rows, best = np.full((n, keep), -1), np.full((n, keep), -np.inf)
        least, home = np.full(n, floor, np.float64), np.full(n, -1)

        def take(leaf: np.ndarray, who: np.ndarray) -> None:
            score = queries[who] @ self.points[leaf].T
            better = score.max(axis=1) > least[who]
            who, score = who[better], score[better]
            if len(who):
                both = np.concatenate([best[who], score], axis=1)
                ids = np.concatenate([rows[who], np.broadcast_to(leaf, score.shape)], axis=1)
                top = np.argpartition(both, -keep, axis=1)[:, -keep:]
                best[who], rows[who] = np.take_along_axis(both, top, 1), np.take_along_axis(ids, top, 1)
                least[who] = np.maximum(least[who], best[who].min(axis=1))

        def visit(at: int, who: np.ndarray, nearest_only: bool) -> None:
            vantage, rest = self.nodes[at]
            if vantage is None:
                if nearest_only:
                    home[who] = at
                else:
                    who = who[home[who] != at]
                if len(who):
                    take(rest, who)
                return
            # Lifted points all have norm M, so |q - p|^2 = |q|^2 + M^2 - 2 q.p
            d = np.sqrt(np.maximum(norms[who] - 2 * queries[who] @ self.points[vantage], 0))
            inner = d <= (rest[0][2] + rest[1][1]) / 2
            for i, (child, low, high) in enumerate(rest):
                if nearest_only:
                    go = inner == (i == 0)
                else:
                    lower = np.maximum(np.maximum(d - high, low - d), 0)
                    reach = np.sqrt(np.maximum(norms[who] - 2 * least[who], 0))
                    go = factor * lower <= reach + _slack(norms[who])
                if go.any():
                    visit(child, who[go], nearest_only)

        for nearest_only in (True, False):
            visit(self.root, np.arange(n), nearest_only)
        return rows, best

    def reaching(self, query: np.ndarray, norm: float, floor: float, factor: float) -> np.ndarray:
        """All rows whose inner product with one lifted query is ``floor`` at least."""
        reach = np.sqrt(max(norm - 2 * floor, 0)) + _slack(norm)
        found, todo = [np.empty(0, np.int64)], [self.root]
        while todo:
            vantage, rest = self.nodes[todo.pop()]
            if vantage is None:
                found.append(rest[self.points[rest] @ query >= floor])
                continue
            d = np.sqrt(max(norm - 2 * query @ self.points[vantage], 0))
            todo += [child for child, low, high in rest if factor * max(d - high, low - d, 0) <= reach]
        return np.concatenate(found)


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * b).sum(axis=-1)


def _lift(x: np.ndarray, top: float) -> np.ndarray:
    return np.c_[x, np.sqrt(np.maximum(top - _dot(x, x), 0))]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


class Regions:
    """Vantage tree over a sample: ``above`` lists, for every leaf, the vantage
    points on its path, and ``nodes`` hold (vantage, radius, inner, outer)."""

    def __init__(self, sample: np.ndarray, leaves: int):
        self.nodes: list[tuple] = []
        self.above: list[list[int]] = []
        self.root = self._build(sample, np.arange(len(sample)), leaves, [])
        self.vantages = np.array([n[0] for n in self.nodes])
        self.depth = max(map(len, self.above))

    def _build(self, sample: np.ndarray, rows: np.ndarray, leaves: int, path: list[int]) -> int:
        """Number of a node, or ``-1 - leaf``."""
        if leaves == 1 or len(rows) < 2:
            self.above.append(path)
            return -len(self.above)
        me = len(self.nodes)
        self.nodes.append(())
        v = sample[_vantage(sample, rows)]
        d = np.linalg.norm(sample[rows] - v, axis=1)
        radius = float(np.sort(d)[len(rows) * (leaves // 2) // leaves])
        inner = self._build(sample, rows[d <= radius], leaves // 2, [*path, me])
        outer = self._build(sample, rows[d > radius], leaves - leaves // 2, [*path, me])
        self.nodes[me] = (v, radius, inner, outer)
        return me

    def place(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leaf of every lifted point and its distances from the vantage points
        above that leaf (0 where the path is shorter than the longest)."""
        leaf, dist = np.zeros(len(points), np.int32), np.zeros((len(points), self.depth))
        todo = [(self.root, np.arange(len(points)), 0)]
        while todo:
            at, who, level = todo.pop()
            if at < 0:
                leaf[who] = -1 - at
                continue
            v, radius, inner, outer = self.nodes[at]
            d = dist[who, level] = np.linalg.norm(points[who] - v, axis=1)
            todo += [(inner, who[d <= radius], level + 1), (outer, who[d > radius], level + 1)]
        return leaf, dist

    def admitted(self, queries: np.ndarray, norms: np.ndarray, floor: np.ndarray, low: np.ndarray, high: np.ndarray,
                 factor: float) -> tuple[np.ndarray, np.ndarray]:
        """(query, leaf) of all leaves that may hold a point which reaches the
        query's floor; ``low`` and ``high`` bound the distances by leaf and level."""
        d = np.sqrt(np.maximum(norms[:, None] - 2 * queries @ self.vantages.T, 0))
        bound = np.zeros((len(queries), len(self.above)))
        for leaf, path in enumerate(self.above):
            for level, v in enumerate(path):
                np.maximum(bound[:, leaf], np.maximum(d[:, v] - high[leaf, level], low[leaf, level] - d[:, v]),
                           out=bound[:, leaf])
        reach = np.sqrt(np.maximum(norms - 2 * floor, 0)) + _slack(norms)
        return np.nonzero(factor * bound <= reach[:, None])


class Shard:
    """The tree of one shard; equal vectors are one point with several ids."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, top: float):
        by_id = np.argsort(ids, kind="stable")
        x, self.ids, self.top = x[by_id], ids[by_id], top
        self.unique, of = np.unique(x, axis=0, return_inverse=True)
        self.order = np.argsort(of.ravel(), kind="stable")
        self.first = np.searchsorted(of.ravel()[self.order], np.arange(len(self.unique) + 1))
        self.tree = Tree(_lift(self.unique, top))

    def _ranked(self, me: int, vec: np.ndarray, got: np.ndarray, k: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
        score = _dot(self.unique[got], vec)
        got, score = got[score >= floor], score[score >= floor]
        members = [self.ids[self.order[self.first[r]:min(self.first[r + 1], self.first[r] + k + 1)]] for r in got]
        found = np.concatenate([np.empty(0, np.int64), *members])
        score = np.repeat(score, [len(m) for m in members])
        found, score = found[found != me], score[found != me]
        pick = np.lexsort((found, -score))[:k]
        return found[pick], score[pick]

    def answer(self, ids: np.ndarray, q: np.ndarray, floors: np.ndarray, k: int, factor: float,
               spare: int = 12) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids and scores of the ``k`` nearest that reach the floor, by query."""
        raised, sizes = np.c_[q, np.zeros(len(q))], _dot(q, q)
        norms, slack = sizes + self.top, 1e-10 * np.sqrt(sizes * self.top)
        rows, best = self.tree.search(raised, norms, k + 1 + spare, factor, floors - slack)
        for i, (me, vec, got) in enumerate(zip(ids, q, rows)):
            found, score = self._ranked(me, vec, got[got >= 0], k, floors[i])
            if got.min() >= 0:  # points beyond the kept ones may tie
                floor = score[-1] if len(score) == k else floors[i]
                if best[i].min() >= floor - slack[i]:
                    got = self.tree.reaching(raised[i], norms[i], floor - slack[i], factor)
                    found, score = self._ranked(me, vec, got, k, floors[i])
            yield found, score


def _answers(k: int, factor: float, top: float, width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Task over rows sorted by group, points first: the points of a group (a
    shard, so bounded) are kept, its queries stream by and leave with what was found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, kept, shard = None, [], None
        for batch in batches:
            groups = batch.column("group").to_numpy()
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.r_[True, (groups[1:] != groups[:-1]) | (asks[1:] != asks[:-1])])
            for lo, hi in zip(starts, np.r_[starts[1:], len(groups)]):
                if groups[lo] != group:
                    group, kept, shard = groups[lo], [], None
                if not asks[lo]:
                    part = batch.slice(lo, hi - lo)
                    kept.append((_matrix(part.column("vec"), width), part.column("id").to_numpy()))
                    continue
                if shard is None and kept:
                    shard, kept = Shard(*map(np.concatenate, zip(*kept)), top), []
                for at in range(lo, hi, 512):
                    part = batch.slice(at, min(512, hi - at))
                    near: list = [(np.empty(0, np.int64), np.empty(0))] * part.num_rows
                    if shard is not None:
                        near = list(shard.answer(part.column("id").to_numpy(), _matrix(part.column("vec"), width),
                                                 part.column("floor").to_numpy(), k, factor))
                    ends = np.cumsum([0, *(len(f) for f, _ in near)]).astype(np.int32)
                    found = pa.StructArray.from_arrays([pa.array(np.concatenate([x[j] for x in near])) for j in (0, 1)],
                                                       ["vec_id", "score"])
                    floor = pa.array([s[-1] if len(s) == k else -np.inf for _, s in near], pa.float64())
                    yield pa.RecordBatch.from_arrays(
                        [part.column("id"), part.column("vec"), part.column("home"), floor,
                         pa.ListArray.from_arrays(pa.array(ends), found)], ["id", "vec", "home", "floor", "found"])

    return run


def _search(rows: DataFrame, groups: int, run: Callable) -> DataFrame:
    """``rows`` (group, asks, id, vec, home, floor) answered group by group."""
    kind = dict(rows.dtypes)["vec"]
    dealt = rows.repartitionById(min(groups, 20_000), F.col("group") % F.lit(min(groups, 20_000)))
    return dealt.sortWithinPartitions("group", "asks").mapInArrow(
        run, f"id bigint, vec {kind}, home int, floor double, found array<struct<vec_id: bigint, score: double>>")


def usable(vec: Column) -> Column:
    """Neither null, zero nor with null or non-finite components."""
    bad = F.exists(vec, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vec.isNotNull() & ~bad & F.exists(vec, lambda v: v != 0)


def nearest(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20,
            factor: float = 1.0, shard_rows: int = 16_384, query_rows: int = 65_536) -> DataFrame:
    """The ``k`` nearest of every query: query_id, rank (from 1), vec_id, score.

    ``is_query`` is a condition on the column ``id``.  Candidates are all rows
    but the query's own id; ties go to the smaller id.  Vectors that are null,
    zero, or hold null or non-finite components, rows with a null id, and
    vectors of another length than the most frequent take no part.  Repeated
    rows (same id and vector) count once.  Other columns are ignored; an empty table
    gives an empty result.
    """
    spark = vectors.sparkSession
    kind = "float" if dict(vectors.dtypes)[vec_col] == "array<float>" else "double"
    src = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast(f"array<{kind}>").alias("vec"))
    src = cut(src.where(F.col("id").isNotNull() & usable(F.col("vec"))).distinct())
    length = src.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if length is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    width = length["d"]
    src = src.where(F.size("vec") == width).withColumn("hash", F.xxhash64("id", "vec"))
    n, top = src.agg(F.count("*"), F.max(F.aggregate(
        "vec", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double")))).first()

    span = 2 ** 62  # rows by hash, so that a common vector weighs in the sample as in the table
    sample = src.where(F.pmod("hash", F.lit(span)) < int(span * min(1.0, SAMPLE_ROWS / n))).select("vec").collect()
    lifted = _lift(np.array([r.vec for r in sample], np.float64).reshape(-1, width), top)
    regions = Regions(lifted, min(REGIONS, -(-n // shard_rows)))
    if not regions.depth:
        placed, low, high, sizes = src.withColumn("region", F.lit(0)), None, None, {0: n}
    else:
        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                leaf, dist = regions.place(_lift(_matrix(b.column("vec"), width), top))
                ends = pa.array(np.arange(len(leaf) + 1, dtype=np.int32) * regions.depth)
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, pa.array(leaf), pa.ListArray.from_arrays(ends, pa.array(dist.ravel()))],
                    ["id", "vec", "hash", "region", "dist"])
        placed = cut(src.mapInArrow(place, f"id bigint, vec array<{kind}>, hash bigint, region int, dist array<double>"))
        ranges = [f(F.col("dist")[i]) for f in (F.min, F.max) for i in range(regions.depth)]
        low, high, sizes = np.zeros((len(regions.above), regions.depth)), np.zeros((len(regions.above), regions.depth)), {}
        for r in placed.groupBy("region").agg(F.count("*"), *ranges).collect():  # REGIONS rows at most
            sizes[r[0]], low[r[0]], high[r[0]] = r[1], r[2:2 + regions.depth], r[2 + regions.depth:]
    parts = {r: -(-size // shard_rows) for r, size in sizes.items()}
    shards = sum(parts.values())

    def table(blocks: dict[int, int]) -> tuple[DataFrame, int]:
        """Regions with their shards, query blocks and the first of their groups."""
        rows, group = [], 0
        for r in sorted(blocks):
            rows.append((r, parts[r], blocks[r], group))
            group += parts[r] * blocks[r]
        return F.broadcast(spark.createDataFrame(rows, "region int, parts int, blocks int, base int")), group

    run = _answers(k, factor, top, width)
    part = F.pmod("hash", "parts").cast("int")
    blank = [F.lit(-1).alias("home"), F.lit(0.0).alias("floor")]
    flat, _ = table(dict.fromkeys(parts, 1))
    placed = placed.join(flat, "region").withColumn("shard", F.col("base") + part).select("id", "vec", "hash", "region", "shard")
    points = placed.select(F.col("shard").alias("group"), F.lit(False).alias("asks"), "id", "vec", *blank)
    own = placed.where(is_query).select(F.col("shard").alias("group"), F.lit(True).alias("asks"), "id", "vec",
                                        F.col("shard").alias("home"), F.lit(float("-inf")).alias("floor"))
    first = _search(points.union(own), shards, run)
    found = first
    if shards > 1:
        first = cut(first)

        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for at in range(0, b.num_rows, 512):
                    s = b.slice(at, 512)
                    q = _matrix(s.column("vec"), width)
                    floor = s.column("floor").to_numpy()
                    if regions.depth:
                        who, leaf = regions.admitted(np.c_[q, np.zeros(len(q))], _dot(q, q) + top, floor, low, high, factor)
                    else:
                        who, leaf = np.arange(len(q)), np.zeros(len(q))
                    yield pa.RecordBatch.from_arrays([*s.take(pa.array(who)).columns, pa.array(leaf.astype(np.int32))],
                                                     ["id", "vec", "home", "floor", "region"])

        asked = first.select("id", "vec", "home", "floor").mapInArrow(
            route, f"id bigint, vec array<{kind}>, home int, floor double, region int")
        met = {r: m for r, m in asked.groupBy("region").count().collect() if r in parts}  # REGIONS rows at most
        dealt, groups = table({r: -(-m // query_rows) for r, m in met.items()})
        copies = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        points = placed.join(dealt, "region").select("id", "vec", (F.col("base") + F.col("blocks") * part).alias("at"), copies.alias("block"))
        asked = asked.join(dealt, "region").join(flat.select("region", F.col("base").alias("of")), "region").select(
            "id", "vec", "home", "floor", "base", "blocks", "of", F.pmod(F.xxhash64("id", "vec"), "blocks").cast("int").alias("block"),
            F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).where(F.col("of") + F.col("part") != F.col("home"))
        rows = points.select((F.col("at") + F.col("block")).alias("group"), F.lit(False).alias("asks"), "id", "vec", *blank).union(
            asked.select((F.col("base") + F.col("blocks") * F.col("part") + F.col("block")).alias("group"),
                         F.lit(True).alias("asks"), "id", "vec", "home", "floor"))
        found = first.union(_search(rows, groups, run))
    hits = found.select(F.col("id").alias("query_id"), F.inline("found"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest_sql(k: int = 20, step: int = 20) -> str:
    """The same search of ``embeddings(vec_id, embedding)`` in DuckDB SQL."""
    return f"""
WITH good AS (
  SELECT DISTINCT vec_id AS id, embedding::DOUBLE[] AS vec FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
vectors AS (
  SELECT * FROM good
  WHERE len(vec) = (SELECT len(vec) FROM good GROUP BY len(vec) ORDER BY count(*) DESC, len(vec) LIMIT 1)),
pairs AS (
  SELECT q.id AS query_id, c.id AS vec_id, list_inner_product(q.vec, c.vec) AS score
  FROM vectors q, vectors c WHERE q.id % {step} = 0 AND c.id <> q.id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM pairs QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= {k}
"""
