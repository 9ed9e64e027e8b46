"""Targets, subset sums and the mixed documents."""

import random
import re

import pytest

from sluice.llm.mixing import fit, knapsack, mix, targets

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_targets_reshare_the_excess():
    sizes = [("a", 100), ("b", 100), ("c", 100), (None, 0), ("d", 1000)]
    got = targets(sizes, (5, 2, 1), 1.5, 2)
    assert got["a"] == 200 and got[None] == 0 and sum(got.values()) == pytest.approx(1950)
    assert all(got[s] <= 2 * n + 1e-9 for s, n in sizes)
    open_ = [s for s, n in sizes if n and got[s] < 2 * n]
    w = {"a": 5, "b": 2, "c": 1, "d": 5}
    assert len({round(got[s] / w[s], 9) for s in open_}) <= 1
    assert targets([], (5, 2, 1), 1.5, 2) == {}


def test_knapsack_against_all_subsets():
    rnd = random.Random(2)
    for _ in range(300):
        lengths = rnd.sample(range(1, 30), 4)
        counts = [rnd.randint(0, 3) for _ in lengths]
        budget = rnd.randint(0, 120)
        sums = {0}
        for n, c in zip(lengths, counts):
            sums = {s + n * k for s in sums for k in range(c + 1)}
        got = knapsack(lengths, counts, budget)
        assert all(0 <= g <= c for g, c in zip(got, counts))
        assert sum(n * g for n, g in zip(lengths, got)) == max(s for s in sums if s <= budget)


def test_fit_reaches_the_target():
    lengths = list(range(400, 0, -1))
    full, extra = fit(lengths, [50] * 400, 1.37 * 50 * sum(lengths))
    assert full == 1 and all(0 <= e <= 50 for e in extra)
    assert sum(n * e for n, e in zip(lengths, extra)) + 50 * sum(lengths) == int(1.37 * 50 * sum(lengths) + 0.5)
    assert fit([0], [9], 0.0) == (0, [0])


def run(spark, rows, **kw):
    df = spark.createDataFrame([(d, t, s, 1) for d, t, s in rows], "doc_id bigint, text string, source string, size int")
    out = mix(df, **kw)
    assert out.columns == ["doc_id", "text", "source", "size", "mix"]
    return out.collect()


def test_mix_of_the_documents_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = mix(df).collect()
    assert len(rows) == df.count()
    per = {}
    for r in rows:
        assert r.mix.size == len(WORD.findall(r.text or "")) and 0 <= r.mix.copies <= 2
        p = per.setdefault(r.source, [0, 0, r.mix.target, r.mix.source_size])
        p[0] += r.mix.size
        p[1] += r.mix.size * r.mix.copies
    want = targets([(s, p[0]) for s, p in per.items()], (5, 2, 1), 1.5, 2)
    for s, (size, taken, target, said) in per.items():
        assert said == size and target == want[s]
        assert abs(taken - target) <= max(2, 0.02 * size)
    again = {(r.doc_id, r.mix.copies) for r in mix(df.repartition(5)).collect()}
    assert again == {(r.doc_id, r.mix.copies) for r in rows}


def test_edge_rows(spark):
    rows = [(1, None, "a"), (2, "", None), (3, "x y z", None), (None, "q " * 9, "b"), (4, "w", "b"), (4, "w", "b"),
            (5, "long " * 20_000, "c"), (6, "one two", "")]
    for kw in ({}, {"broadcast_rows": 0}):
        got = run(spark, rows, **kw)
        assert len(got) == len(rows)
        assert {r.mix.source_size for r in got if r.source is None} == {3}
        assert all(r.mix.size * r.mix.copies <= 2 * r.mix.size for r in got)
    assert run(spark, []) == []


def test_groups_of_one_length_are_cut_exactly(spark):
    rows = [(i, f"a{i} b c", "hot") for i in range(5000)] + [(9000 + i, "z " * 100, "other") for i in range(50)]
    got = run(spark, rows, share=0.7, weights=(1, 4))
    for s in ("hot", "other"):
        taken = sum(r.mix.size * r.mix.copies for r in got if r.source == s)
        target = next(r.mix.target for r in got if r.source == s)
        assert abs(taken - target) < {"hot": 3, "other": 100}[s]


def test_clashing_column_names(spark):
    df = spark.createDataFrame([(i, "w " * (i % 5), "s", 1, 2, 3, 4, 5, 6) for i in range(30)],
                               "doc_id bigint, text string, source string, key int, size int, target int, plan int, full int, mix int")
    out = mix(df)
    assert out.columns == df.columns
    assert sum(r.mix.size * r.mix.copies for r in out.collect()) == 90 and {r.plan for r in out.collect()} == {4}
