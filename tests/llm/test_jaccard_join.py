"""The Jaccard join against a plain comparison of all pairs of shingle sets."""

import random
import re

from sluice.llm.jaccard_join import one_of_each, similar_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    ws = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    n = min(5, len(ws))
    return {tuple(ws[i:i + n]) for i in range(len(ws) - n + 1)} if ws else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is None or rows[j][0] is None or not sets[i] or not sets[j]:
                continue
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    return sorted(((d, len(s), None if d is None else low[find(i)])
                   for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id bigint, text string, node string, n int")
    return sorted((tuple(r) for r in similar_components(df, **kw).collect()), key=str)


def test_random_groups_match_all_pairs(spark):
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(400)]
    passage = [rnd.choice(vocab) for _ in range(40)]
    rows = []
    for _ in range(12):
        base = [rnd.choice(vocab) for _ in range(rnd.randint(10, 120))]
        if rnd.random() < 0.6:
            base[3:3] = passage
        for _ in range(rnd.choice([1, 2, 12])):
            edited = list(base)
            for _ in range(rnd.randint(0, max(1, len(base) // 25))):
                edited[rnd.randrange(len(edited))] = rnd.choice(vocab)
            rows.append((rnd.randrange(10**6), " ".join(edited)))
    assert run(spark, rows, pivot_rounds=1) == brute(rows)
    assert run(spark, rows, pivot_rounds=0, broadcast_rows=0) == brute(rows)


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE\ttwo"), (6, "one two three four"),
            (7, "A b c d e"), (8, "a B c d e f"), (9, "a b c d e"), (None, "a b c d e"), (10, "x " * 5000),
            (10, "y z " * 10), (11, "y z " * 10), (11, "y z " * 10), (12, "é É ß"), (13, "é é ß")]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_shared_documents_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    assert run(spark, rows) == brute(rows)


def test_one_document_of_each_keeps_all_columns(spark):
    rows = [(1, "a b c d e f"), (2, "A b c d e f"), (3, None), (3, None), (4, ""), (None, "a b c d e f"), (5, "x y"), (5, "z w"),
            (6, "q " * 9), (6, "q " * 9)]
    df = spark.createDataFrame([(d, t, True, 7, "k") for d, t in rows],
                               "doc_id bigint, text string, stays boolean, rows int, component_id string")
    for n in (0, 10**6):
        out = one_of_each(df, broadcast_rows=n)
        assert out.columns == df.columns
        got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
        assert got == sorted([(1, rows[0][1]), (3, None), (4, ""), (None, rows[5][1]), (5, "x y"), (5, "z w"), rows[8]], key=str)
    assert one_of_each(df.limit(0)).collect() == []
