"""Removal of repeated strings against a count of every string."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from sluice.llm import suffix_dedup
from sluice.llm.suffix_dedup import phrases, reach_of, remove_repeats, repeated_suffixes


def brute(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[p:p + length] for _, b in texts for p in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p:p + length]] > 1:
                gone[p:p + length] = b"\1" * length
        spans, at = [], 0
        while (a := gone.find(1, at)) >= 0:
            at = gone.find(0, a) if gone.find(0, a) >= 0 else len(b)
            spans.append([a, at])
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), len(spans), hashlib.sha256(kept).hexdigest(), spans))
    return sorted(out, key=repr)


def got(spark, rows, length=200, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted(map(tuple, remove_repeats(df, length, **kw).collect()), key=repr)


def corpus(seed, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghéü", k=rng.randint(2, 8)))
    text = lambda k: " ".join(word() for _ in range(k))
    shared = [text(k) for k in (20, 38, 40, 45, 60, 200)]
    rows = []
    for i in range(n):
        parts = [text(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a = rng.randint(0, len(s) // 3)
            parts += [s[a:a + rng.randint(100, 400)], text(rng.randint(0, 40))]
        rows.append((i, rng.choice([" ", ""]).join(parts)))
    base = text(300)
    for i in range(12):  # near copies
        at = rng.randint(0, len(base) - 5)
        rows.append((100 + i, base[:at] + "#" * rng.randint(1, 4) + base[at + rng.randint(0, 3):]))
    return rows + [(200, base), (201, base), (202, text(3000)), (203, "a" * 900), (204, "ab" * 500), (205, "a" * 199), (206, None), (207, "")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_every_string_counted(spark, seed):
    rows = corpus(seed)
    want = brute(rows, 200)
    assert got(spark, rows) == want
    assert 0.1 < sum(r[2] for r in want) / sum(r[1] for r in want) < 0.9


def test_spread_cores_and_short_strings(spark):
    rows = corpus(4, 30)
    assert got(spark, rows, 200, hot=1) == brute(rows, 200)
    assert got(spark, rows, 40, hot=3) == brute(rows, 40)


def test_edges(spark):
    x = "".join(random.Random(8).choices("xyz ", k=200))
    y = "".join(random.Random(9).choices("xyz ", k=200))
    for rows in ([(1, x + "1"), (2, x + "2")],                      # just long enough
                 [(1, x[:199] + "1"), (2, x[:199] + "2")],          # one byte short
                 [(1, x + x)], [(1, x[:150] * 3)],                  # within one document, overlapping
                 [(1, x), (1, x), (None, x), (None, None)],         # repeated rows
                 [(1, x + y), (2, y + x)],                          # touching runs are one
                 [(1, x + "|" + y), (2, y + "|" + x)],
                 [(1, "é" * 100), (2, "é" * 101), (3, "a" + "é" * 100)],  # bytes, not characters
                 [(1, "z" * 60000 + x), (2, x)],
                 [(1, "")], []):
        assert got(spark, rows) == brute(rows, 200)


def test_clashing_columns(spark):
    rows = corpus(5, 20)
    df = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], "doc_id long, text string, same int, core int, whole int, spans int")
    assert sorted(map(tuple, remove_repeats(df).collect()), key=repr) == brute(rows, 200)


def test_phrases_cover_every_place_once(monkeypatch):
    rng, reach = random.Random(6), reach_of(200)
    docs = [bytes(rng.choices(range(97, 101), k=rng.choice([200, 201, 900, 5000]))) for _ in range(20)]
    data, sizes = b"".join(docs), np.array([len(d) for d in docs])
    whole = phrases(data, sizes, 200)
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 77)
    assert all((a == b).all() for a, b in zip(whole, phrases(data, sizes, 200)))
    doc, lo, hi, trigger = whole
    places = [(d, p) for d, a, b in zip(doc, lo, hi) for p in range(a, b + 1)]
    begins = np.cumsum(sizes) - sizes
    assert places == [(i, begins[i] + p) for i, d in enumerate(docs) for p in range(len(d) - 199)]
    assert (hi <= trigger).all() and (trigger - lo < reach).all()


def test_suffixes_of_some_phrases():
    a, b = b"x" * 30 + bytes(range(200)) + b"1", b"y" * 3 + b"x" * 5 + bytes(range(200)) + b"2"
    found = repeated_suffixes(np.array([5, 5]), np.array([30, 8]), [a, b], 200)
    assert [np.flatnonzero(f).tolist() for f in found] == [[25, 26, 27, 28, 29, 30], [3, 4, 5, 6, 7, 8]]
    found = repeated_suffixes(np.array([5, 6]), np.array([30, 8]), [a, b], 200)
    assert not any(f.any() for f in found)
