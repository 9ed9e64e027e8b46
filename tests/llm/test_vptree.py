"""Nearest neighbours against all inner products."""

import random

import duckdb
import numpy as np
from pyspark.sql import functions as F

from sluice.llm.vptree import Regions, Tree, _lift, nearest, nearest_sql


def brute(rows, k, step):
    ok = {}
    for i, v in rows:
        if i is not None and v and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok.setdefault((i, tuple(v)), None)
    out = set()
    ids = list(ok)
    mat = np.array([v for _, v in ids], np.float64).reshape(-1, 8)
    for i, v in ids:
        if i % step == 0:
            s = (mat * np.array(v)).sum(axis=1)
            near = sorted(((-x, j) for x, (j, _) in zip(s, ids) if j != i))[:k]
            out |= {(i, r + 1, j, -x) for r, (x, j) in enumerate(near)}
    return out


def run(spark, rows, k=5, step=4, **kw):
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id bigint, embedding array<float>, shard int")
    got = nearest(df, F.col("id") % step == 0, k=k, **kw).collect()
    return {(r.query_id, r.rank, r.vec_id, r.score) for r in got}


def vectors(n, seed=1):
    rnd = random.Random(seed)
    return [(i, [float(np.float32(rnd.gauss(0, 1))) for _ in range(8)]) for i in range(n)]


def test_exact_with_ties_and_odd_rows(spark):
    rows = vectors(300)
    rows += [(1000 + i, rows[7][1]) for i in range(150)]  # one very common vector
    rows += [(None, rows[1][1]), (2000, None), (2004, [0.0] * 8), (2008, [float("nan")] + [1.0] * 7), (2012, [1.0, 2.0]),
             (2016, [None] + [1.0] * 7), (2020, []), rows[3], rows[4]]
    assert run(spark, rows, shard_rows=100, query_rows=30) == brute(rows, 5, 4)
    assert run(spark, rows, k=600, shard_rows=300) == brute(rows, 600, 4)


def test_empty_and_single(spark):
    assert run(spark, []) == set()
    assert run(spark, [(0, [1.0] * 8)]) == set()
    assert run(spark, [(1, [1.0] * 8), (0, [2.0] * 8)]) == {(0, 1, 1, 16.0)}


def test_factor_trades_recall(spark):
    x = np.array([v for _, v in vectors(3000, 4)])
    lifted = np.c_[x, np.sqrt((x * x).sum(1).max() - (x * x).sum(1))]
    q = x[:40]
    want = np.argsort(-(q @ x.T), axis=1)[:, :10]
    norms = (q * q).sum(1) + (x * x).sum(1).max()
    for factor, least in ((1.0, 1.0), (1.3, 0.6)):
        got, _ = Tree(lifted).search(np.c_[q, np.zeros(40)], norms, 10, factor)
        assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(got, want)]) >= least


def test_recall_on_the_embeddings_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = nearest(df, F.col("id") % 20 == 0).collect()
    mat = np.array([v for _, v in rows], np.float64)
    for i, v in rows:
        if i % 20 == 0:
            s = mat @ np.array(v)
            want = {j for _, j in sorted((-x, j) for x, (j, _) in zip(s, rows) if j != i)[:20]}
            assert {r.vec_id for r in got if r.query_id == i} == want


def test_ties_of_many_distinct_vectors_go_by_id(spark):
    rnd = random.Random(8)
    bits = [[float(n >> b & 1) for b in range(8)] for n in range(1, 256)]
    rows = list(zip(rnd.sample(range(5000), 500), bits + [rnd.choice(bits) for _ in range(245)]))
    for size in (1000, 150):
        assert run(spark, rows, shard_rows=size) == brute(rows, 5, 4)
    assert run(spark, rows, k=1) == brute(rows, 1, 4)


def test_regions_shards_and_query_blocks(spark):
    rnd = random.Random(5)
    heart = [[rnd.gauss(0, 4) for _ in range(8)] for _ in range(6)]
    rows = [(i, [float(np.float32(c + rnd.gauss(0, 0.2))) for c in heart[i % 6]]) for i in range(600)]
    rows += [(1000 + i, rows[9][1]) for i in range(300)]  # a third of all rows are one vector
    want = brute(rows, 5, 4)
    for shard_rows, query_rows in ((120, 10_000), (40, 25), (900, 7)):
        assert run(spark, rows, shard_rows=shard_rows, query_rows=query_rows) == want


def test_regions_are_ruled_out_and_never_wrongly():
    rnd = np.random.default_rng(2)
    x = rnd.normal(size=(8, 16))[rnd.integers(0, 8, 4000)] * 3 + rnd.normal(size=(4000, 16)) * 0.05
    top = float((x * x).sum(1).max())
    regions = Regions(_lift(x[:500], top), 16)
    leaf, dist = regions.place(_lift(x, top))
    low, high = np.zeros((len(regions.above), regions.depth)), np.zeros((len(regions.above), regions.depth))
    for r in range(len(regions.above)):
        low[r], high[r] = dist[leaf == r].min(0), dist[leaf == r].max(0)
    q = x[:100]
    score = q @ x.T
    floor = np.sort(score, axis=1)[:, -5]
    who, where = regions.admitted(np.c_[q, np.zeros(100)], (q * q).sum(1) + top, floor, low, high, 1.0)
    kept = set(zip(who.tolist(), where.tolist()))
    assert {(i, leaf[j]) for i, j in zip(*np.nonzero(score >= floor[:, None]))} <= kept
    assert len(kept) < 0.5 * 100 * len(regions.above)


def test_sql_twin(spark):
    path = "/root/testdata/sf0.01/embeddings.parquet"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}'")
    want = con.execute(nearest_sql()).fetchall()
    got = nearest(spark.read.parquet(path), F.col("id") % 20 == 0).collect()
    assert {(r[0], r[1], r[2], round(r[3], 9)) for r in got} == {(*r[:3], round(r[3], 9)) for r in want}
