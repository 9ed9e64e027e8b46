"""Licences anywhere in a text against the SQL twin, a brute-force window search and by hand."""

import random
import re
from collections import Counter

import duckdb
from pyspark.sql import functions as F

from sluice.llm.licenses import TEMPLATES, scan, scan_sql, summary

SCHEMA = "doc_id bigint, text string, found string, w int, g int, hits string, start int"
DOCUMENTS = "/root/testdata/sf0.01/documents.parquet"


def run(spark, rows, **kw):
    df = spark.createDataFrame([(d, t, "x", 1, 2, "y", 3) for d, t in rows], SCHEMA)
    return {r.doc_id: [(x.license, x.start, x.n_words, x.shared, x.dice) for x in r.found] for r in scan(df, **kw).collect()}


def names(found):
    return [x[0] for x in found]


def brute(text, templates, least):
    """Best window of every template over all windows, then the better of those that overlap."""
    w = [x.lower() for x in re.findall("[A-Za-z0-9]+", text or "")]
    g = list(zip(w, w[1:]))
    hits = []
    for name, texts in templates.items():
        for t in texts:
            v = [x.lower() for x in re.findall("[A-Za-z0-9]+", t)]
            bag = Counter(zip(v, v[1:]))
            size = sum(bag.values())
            best = None
            for i in range(len(g)):
                for j in range(i, len(g)):
                    shared = sum((Counter(g[i:j + 1]) & bag).values())
                    dice = 2.0 * shared / (j - i + 1 + size) if size else 0
                    if dice >= least and (best is None or (-dice, i, j - i + 1) < best[:3]):
                        best = (-dice, i, j - i + 1, shared)
            if best:
                hits.append((-best[3], best[0], best[1], best[2], name))
    hits = sorted(set(hits))
    kept = [x for k, x in enumerate(hits) if not any(
        y[4] == x[4] or (y[2] <= x[2] + x[3] and x[2] <= y[2] + y[3]) for y in hits[:k])]
    return sorted(((x[4], x[2], x[3] + 1, -x[0], -x[1]) for x in kept), key=lambda x: x[1])


def test_notices_anywhere_and_all_of_them(spark):
    mit = TEMPLATES["MIT"][3]
    rows = [(1, "Prose here.\nReleased under the MIT License."), (2, "released UNDER the mit licence of sorts"),
            (3, "Licensed under the Apache\nLicense, Version 2.0."), (4, None), (5, ""), (6, "All rights reserved. " * 400),
            (7, "Licensed under the GNU General Public License, version 2.\nAll rights reserved."), (None, "All rights reserved!"),
            (8, "It is licensed under the MIT License and parts are licensed under the Apache License, Version 2.0, as said."),
            (9, "word " * 50_000), (10, "word " * 20_000 + "released under the MIT license" + " word" * 20_000),
            (11, "x = 1 # " + mit.replace("software", "program", 1) + " All rights reserved."), (12, "word"), (13, "\u00e9\u4e2d")]
    got = run(spark, rows)
    assert got[1] == [("MIT", 2, 5, 4, 1.0)] and got[3] == [("Apache-2.0", 0, 8, 7, 1.0)]
    assert got[2] == [("MIT", 0, 4, 3, 6 / 7)]  # the last bigram differs
    assert got[4] == got[5] == got[9] == got[12] == got[13] == []
    assert got[6] == [("reserved", 0, 3, 2, 1.0)] and names(got[None]) == ["reserved"]
    assert names(got[7]) == ["GPL-2.0", "reserved"] and got[7][1][4] == 1.0
    assert names(got[8]) == ["MIT", "Apache-2.0"]
    assert got[10] == [("MIT", 20_000, 5, 4, 1.0)]
    assert names(got[11]) == ["MIT", "reserved"] and got[11][0][2] > 100 and 0.9 < got[11][0][4] < 1
    assert run(spark, []) == {}


def test_every_template_finds_itself(spark):
    rows = [(i, t) for i, t in enumerate(x for ts in TEMPLATES.values() for x in ts)]
    own = [n for n, ts in TEMPLATES.items() for _ in ts]
    got = run(spark, rows)
    assert [names(got[i]) for i in range(len(rows))] == [[n] for n in own]


def test_all_windows_by_brute_force(spark):
    templates = {"a": ["p q r p q s t", "u v"], "b": ["p q r s t u"], "c": ["x"], "d": ["q q q r q q"]}
    rnd = random.Random(3)
    texts = [" ".join(rnd.choice("pqrstuvqq") for _ in range(rnd.randint(0, 24))) for _ in range(150)]
    texts += [t.replace("p q", "p q r p q s t", 1) for t in texts[:60]]
    rows = list(enumerate(texts)) + [(900, texts[3]), (900, texts[3])]
    for least in (0.8, 0.6):
        got = run(spark, rows, templates=templates, least=least)
        assert got == {d: brute(t, templates, least) for d, t in rows}
        assert sum(map(len, got.values())) >= 50


def test_repeated_rows_are_kept(spark):
    df = spark.createDataFrame([(1, "All rights reserved.")] * 3, "doc_id bigint, text string")
    assert scan(df).count() == 3


def test_sql_twin(spark, tmp_path):
    """The documents table, and one with notices between and within lines and null ids."""
    rnd = random.Random(4)
    parts = [t for ts in TEMPLATES.values() for t in ts]
    made = [(None if i % 50 == 7 else i, "\n".join(rnd.choice(["some words of prose.", rnd.choice(parts)]) for _ in range(4))) for i in range(120)]
    path = str(tmp_path / "made")
    spark.createDataFrame(made, "doc_id bigint, text string").coalesce(1).write.parquet(path)
    for where, least in ((DOCUMENTS, 10), (f"{path}/*.parquet", 60)):
        got = scan(spark.read.parquet(where)).select("doc_id", *summary(F.col("found"))).collect()
        con = duckdb.connect()
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{where}'")
        want = con.execute(f"SELECT doc_id, n_licenses, licenses, dice FROM ({scan_sql()})").fetchall()
        assert Counter(map(tuple, got)) == Counter(want) and sum(r[1] > 0 for r in want) > least
