"""Merkle manifest against a recursive version on the driver."""

import hashlib
import random
import string
import zlib
from collections import defaultdict

from sluice.llm.merkle import ARITY, descend, fold, manifest_of_documents, store
from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], row[1])])


def tree(nodes):
    """Root and, per node, the runs it meets on the way up: (place in run, run)."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for w, i in zip(ways, at):
            w.append((i % ARITY, nodes[i - i % ARITY:][:ARITY]))
        at = [i // ARITY for i in at]
        nodes = [h(*nodes[i:i + ARITY]) for i in range(0, len(nodes), ARITY)]
    return nodes[0], ways


def brute(rows):
    by = defaultdict(list)
    for r in rows:
        by[r[3]].append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    groups = [sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r))) for s in names]
    trees = [tree([leaf_of(r) for r in g]) for g in groups]
    root, over = tree([t[0] for t in trees])
    out = []
    for g, (subroot, ways), top in zip(groups, trees, over):
        for r, way in zip(g, ways):
            steps = way + top
            siblings = "".join("".join(run[:i] + run[i + 1:]) for i, run in steps)
            other = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                other = (r[0], r[1] and r[1].translate(LOWER), *r[2:])
            d = leaf_of(other)
            for i, run in steps:
                d = h(*run[:i], d, *run[i + 1:])
            out.append((r[0], leaf_of(r), subroot, root, h(siblings), d, d == root))
    return sorted(out, key=repr)


def got(spark, rows, parts=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    cols = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r[c] for c in cols) for r in manifest_of_documents(df).collect()), key=repr)


def test_brute_force(spark):
    rng = random.Random(5)
    sizes = {None: 3, "": 1, "a": 16, "b": 17, "Ä": 257, "z": 33, **{f"s{i}": 1 for i in range(13)}}
    rows, n = [], 0
    for source, size in sizes.items():
        for _ in range(size):
            n += 1
            text = rng.choice([None, "", "Some Text ÄÖ", "lower only", "X" * 5000])
            rows.append((rng.choice([n, -n]), text, rng.choice(["en", None]), source, rng.choice([n, None])))
    rng.shuffle(rows)
    want = brute(rows)
    assert got(spark, rows) == want
    assert {v[-1] for v in want} == {True, False}


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, "A", None, "s", 1)] * 40 + [(None, "B", "en", "s", None)] * 3 + [(1, "C", "en", "s", 1)] * 2
    assert got(spark, rows) == brute(rows)


def test_one_row_and_none(spark):
    rows = [(7, None, None, None, None)]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == []


def test_clashing_columns_are_ignored(spark):
    df = spark.createDataFrame([(i, f"T{i}", "en", "s", i) for i in range(20)], SCHEMA)
    more = df.withColumns({c: F.lit(1) for c in ("leaf", "rank", "tree", "pos", "row", "path", "digest", "size", "other")})
    assert sorted(map(tuple, manifest_of_documents(more).collect())) == sorted(map(tuple, manifest_of_documents(df).collect()))


def test_proofs_of_some_leaves(spark):
    """Requests for single leaves get only their own way down."""
    nodes = spark.range(1000).select(F.lit(0).cast("long").alias("tree"), F.col("id").alias("pos"),
                                     F.sha2(F.col("id").cast("string"), 256).alias("digest"), F.lit(1000).cast("long").alias("size"))
    levels, tops = store(nodes)
    assert len(levels) == 3 and tops.count() == 1
    none = F.array().cast("array<struct<left:string,right:string>>")
    few = nodes.where("pos in (0, 255, 256, 999)").select("tree", "pos", F.col("digest").alias("asked"))
    rows = descend(levels, tops.withColumn("path", none), few).select("pos", "asked", "digest", fold(F.col("asked"), F.col("path")).alias("root")).collect()
    root = tops.first().digest
    assert {r.pos for r in rows} == {0, 255, 256, 999} and all(r.asked == r.digest and r.root == root for r in rows)
