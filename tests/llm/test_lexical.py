"""Bit-sliced search against a score of every document."""

import math
import random
import re
import string
from collections import Counter

import numpy as np
import pytest

from sluice.llm import lexical
from sluice.llm.lexical import Query, build, search, terms_of

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute(docs, items, k):
    of = [(i, Counter(PATTERN.findall((t or "").translate(LOWER)))) for i, t in docs]
    of = [(i, c) for i, c in of if c]
    n, total = len(of), sum(c.total() for _, c in of)
    df = Counter(t for _, c in of for t in c)
    out = []
    for item, text in set(items):
        q, rows = Counter(PATTERN.findall((text or "").translate(LOWER))), []
        for doc, c in of:
            m, s = 100 - 25 + (25 * c.total() * n) // total, 0
            for t, times in q.items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    s += times * w * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m))
            if s > 0:
                rows.append((-s, doc is None, doc))
        out += [(item, rank, doc, -s) for rank, (s, _, doc) in enumerate(sorted(rows, key=lambda r: (r[0], r[1], r[2] or 0))[:k], 1)]
    return sorted(out, key=repr)


def got(spark, docs, items, k=20):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    i = spark.createDataFrame(items, "item_id long, text string")
    return sorted(map(tuple, search(build(d), d, i, k).collect()), key=repr)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices("abcdeéü", k=rng.randint(1, 4))) for _ in range(300)]
    text = lambda n: " ".join(vocabulary[min(int(rng.expovariate(0.02)), 299)] for _ in range(n))
    docs = [(i, text(rng.choice([1, 5, 40, 200]))) for i in range(400)]
    docs += [(1000 + i, text(3000)) for i in range(3)] + [(2000 + i, docs[7][1]) for i in range(60)]
    items = [(i, text(12)) for i in range(15)] + [(50, docs[7][1][:300]), (51, docs[1][1].upper())]
    return docs, items


def test_every_document_scored(spark, corpus):
    docs, items = corpus
    assert got(spark, docs, items) == brute(docs, items, 20)


def test_blocks_of_items_and_shuffled_join(spark, corpus, monkeypatch):
    docs, items = corpus
    monkeypatch.setattr(lexical, "QUERY_BYTES", 400)
    monkeypatch.setattr(lexical, "BROADCAST_ROWS", 0)
    assert got(spark, docs, items, 5) == brute(docs, items, 5)


def test_edges(spark):
    docs = [(1, None), (2, ""), (3, " .,; "), (4, "A-b a_B ab"), (None, "ab x"), (5, "ab x"), (5, "ab x"), (6, "É é ÀB"), (7, "z" * 5000 + " x")]
    items = [(1, "AB"), (1, "AB"), (1, "x"), (2, None), (3, ""), (4, "missing"), (5, "é à b B"), (None, "a a b"), (6, "z" * 5000)]
    assert got(spark, docs, items, 3) == brute(docs, items, 3)
    assert got(spark, [], items) == [] and got(spark, docs, []) == [] and got(spark, [(1, None)], items) == []


def test_terms():
    text = "A1b-C\x00é Ü z\x1fq\x85w  x"
    assert [t.decode() for t in terms_of(text.encode())] == PATTERN.findall(text.translate(LOWER))


def test_bounds_hold(corpus):
    """No exact score is above its bound, and bounds exclude most documents."""
    docs, items = corpus
    counts = [Counter(terms_of(t.encode())) for _, t in docs]
    df = Counter(t for c in counts for t in c)
    q = Query([(i, t.encode()) for i, t in items], df, len(docs), sum(c.total() for c in counts))
    rows = []
    for (i, _), c in zip(docs, counts):
        n = np.fromiter(c.values(), np.int64, len(c))
        h = np.fromiter(map(lexical.xxhash.xxh3_64_intdigest, c), np.uint64, len(c))
        rows.append((i, 0, int(n.sum()), int(n.max()), lexical.keys_of(h, n)))
    # a short signature makes many false positives
    for bits in (256, 1 << 14):
        block = lexical._block(bits, rows)
        n, top = (np.array(block.column(x)[0].as_py()) for x in ("n", "top"))
        bound = q.bounds(bits, n, top, block.column("slices")[0].as_py())
        exact = np.array([[q.score(j, c, int(q.lengths(np.int64(c.total())))) for c in counts] for j in range(len(items))])
        assert (bound >= exact).all()
    kth = np.sort(exact, axis=1)[:, -20]
    assert (bound >= kth[:, None]).mean() < 0.5


def test_clashing_columns(spark, corpus):
    docs, items = corpus
    d = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in docs[:50]], "doc_id long, text string, same int, n int, rank int")
    i = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, doc_id int, score int")
    assert sorted(map(tuple, search(build(d), d, i, 4).collect()), key=repr) == brute(docs[:50], items, 4)
