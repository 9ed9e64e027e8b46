"""Spans against Python's regular expressions, and what bootstrapping adds."""

import re

from pyspark.sql import functions as F

from sluice.llm import pii

PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
            ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def good(kind, m):
    d = [int(c) for c in m if c.isdigit() and c.isascii()]
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        odd = sum(d[-1::-2]) + sum(x * 2 - 9 * (x > 4) for x in d[-2::-2])
        return 13 <= len(d) <= 19 and odd % 10 == 0
    return kind == "email" or 9 <= len(d) <= 15


def brute(text):
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS for m in re.finditer(p, text or "")
                    if good(k, m[0]))


def run(spark, rows, **how):
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id bigint, text string, spans int")
    got = pii.find(df, **how).select("doc_id", pii.as_string(F.col("base")).alias("b"),
                                     pii.as_string(F.col("spans")).alias("s"), *pii.counts(F.col("base")))
    return got.collect()


TEXTS = [None, "", "a@b.c_d@e.f x@y..z q@w.e.", "1.2.3.4.5.6.7.8 256.1.1.1 1.1.1.0255 0001.2.3.4", "😀 4111 1111 1111 1111 é",
         "4111-1111-1111-1112 378282246310005 5500 0000 0000 0004 1", "+1 (743) 555-3824, +49 30 123 +12 3 +1-----------9",
         "+1 (743) 555-3824+44 20 7946 0958 x", "9" * 20_000, "a." * 3000 + "b@c.d", "z" * 30_000 + "@", "x@" + "y." * 4000 + "z",
         "+" + " 1" * 4000, "1 " * 5000, ("12.34.56.78 " * 700), "a+b%c@d-e.f-g.h tail\nnew@line.org"]


def test_base_spans_match_regular_expressions(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "x@y.z"), (1, "")]
    for r in run(spark, rows):
        text = next(t for d, t in rows if d == r.doc_id and (d != 1 or not t))
        assert r.b == r.s == brute(text), text and text[:50]
        assert r.n_email == r.b.count("email:")


def test_documents_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = {r.doc_id: r.text for r in df.collect()}
    for r in run(spark, list(rows.items())):
        assert r.b == brute(rows[r.doc_id])


def test_patterns_discover_unseen_identifiers(spark):
    rows = [(i, f"Please write to user{i}@mail.example.org for news {i}") for i in range(20)]
    rows += [(100, "Please write to user#at#home5 for news 7"), (101, "nothing about 77 here"), (None, "call 5 now")]
    rows += [(102, "Elsewhere user#at#home5 again")]
    got = {r.doc_id: r for r in run(spark, rows)}
    assert got[100].b == "" and got[100].s == "email:16:29"
    assert got[102].s == "email:10:23"
    assert got[101].s == got[None].s == ""
    assert all(got[i].b and got[i].b in got[i].s.split(",") for i in range(20))


def test_running_sum_and_empty_table(spark):
    df = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(700)), lambda x: x % 7).alias("a"))
    got = df.select(pii.running_sum(F.col("a"), 16).alias("s")).first().s
    want, at = [], 0
    for i in range(1, 701):
        at += i % 7
        want.append(at)
    assert got == want
    assert run(spark, []) == []


def test_new_instances_induce_new_patterns(spark):
    rows = [(i, f"Please write to user{i}@mail.example.org for news") for i in range(40)]
    rows += [(100 + i, f"Please write to user#at#home{i} for news") for i in range(8)]
    rows += [(200 + i, f"our desk answers user#at#home{i} every morning") for i in range(8)]
    rows += [(300, "our desk answers other#at#work9 every morning"), (301, "other#at#work9 again"), (302, "desk 7 answers"),
             (303, "we see 77 every morning")]
    got = {r.doc_id: r.s for r in run(spark, rows)}
    assert got[107] == "email:16:29" and got[207] == "email:17:30"
    assert got[300] == "email:17:31" and got[301] == "email:0:14" and got[302] == got[303] == ""


def test_adjoining_words_are_one_instance(spark):
    rows = [(i, f"call me at +1 (743) 555-38{i} after lunch") for i in range(20, 60)]
    rows += [(100, "call me at 0743 555 3824 after lunch"), (101, "or 0743 555 3824, please"), (102, "room 0743 is open")]
    got = {r.doc_id: r for r in run(spark, rows)}
    assert got[100].b == "" and got[100].s == "phone:11:24"
    assert got[101].s == "phone:3:16" and got[102].s == ""
    # 40 numbers of one country are 40 seeds; one number 40 times is one.
    one = [(i, "call me at +1 (743) 555-3824 after lunch") for i in range(40)]
    assert {r.doc_id: r.s for r in run(spark, [*one, rows[40]])}[100] == ""
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r.doc_id: r.text for r in pii.mask(df).collect()}[100] == "call me at <phone> after lunch"


def test_runs_end_where_identifiers_do(spark):
    text = "pay 12 +1 743 555 3824 from 1.2.3.4 8080 or a1@b.c 44 55, 66 77. end"
    df = spark.createDataFrame([(text,)], "t string").select(pii.identifier_words(F.col("t")).alias("w"))
    words = df.first().w
    assert [w.word for w in words] == ["12", "1 743 555 3824", "1.2.3.4", "8080", "a1@b.c", "44 55", "66 77"]
    assert all(text[w.start:w.end] == w.word for w in words)
    assert words[1].two == "< pay 9" and words[6].around == "9, _ end"


def plain_bootstrap(docs, support=3, trust=0.8, accept=0.9):
    """The bootstrap on the driver: docs of (words, spans)."""
    import math
    from collections import defaultdict
    edges, seeds = defaultdict(set), {}
    for words, spans in docs:
        for w in words:
            kind = min((s.kind for s in spans if s.start < w.end and s.end > w.start), default=None)
            for pattern in filter(None, (w.two, w.around)):
                edges[pattern].add(w.word)
                if kind is not None:
                    seeds[w.word] = min(kind, seeds.get(w.word, kind))
    new = {}
    while True:
        score = defaultdict(float, {(w, k): 1.0 for w, k in seeds.items()})
        score.update(new)
        sure = {}
        for pattern, words in edges.items():
            for kind in range(4):
                held = [score[w, kind] for w in words if (w, kind) in score]
                if len(held) >= support and sum(held) / len(words) >= trust:
                    sure[pattern, kind] = sum(held) / len(words)
        logs = defaultdict(float)
        for (pattern, kind), c in sure.items():
            for w in edges[pattern] - seeds.keys():
                logs[w, kind] += math.log(1 - min(c, 1 - 1e-9))
        now = {k: 1 - math.exp(v) for k, v in logs.items() if 1 - math.exp(v) >= accept}
        if now.keys() == new.keys() and abs(sum(now.values()) - sum(new.values())) <= 1e-6 * max(1, len(now)):
            break
        new = now
    best = {}
    for (w, k), s in now.items():
        best[w] = max(best.get(w, (0, 0)), (s, -k))
    return {(w, -k) for w, (_, k) in best.items()}


def chain(steps):
    """Identifiers of each step stand with those of the steps before, and only the first with base matches."""
    rows = [f"please mail to u{i}@mail.example.org now" for i in range(40)] + [f"please mail to id#a{i} now" for i in range(8)]
    known = [f"id#a{i}" for i in range(8)]
    for step in "bcdefgh"[:steps]:
        new = [f"id#{step}0"]
        rows += [f"our desk{step} has{step} {x} open" for x in known + new]
        known += new
    return list(enumerate(rows)), known


def test_bootstrap_runs_to_its_fixpoint(spark):
    rows, known = chain(6)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = df.select(pii.base_spans(F.col("text")).alias("spans"), pii.identifier_words(F.col("text")).alias("words")).where("size(words) > 0")
    want = plain_bootstrap([(r.words, r.spans) for r in found.collect()])
    assert {(r.word, r.kind) for r in pii.bootstrap(found).collect()} == want
    assert set(known) <= {w for w, _ in want}


def test_bootstrap_against_the_plain_version_on_the_corpus(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = df.select(pii.base_spans(F.col("text")).alias("spans"), pii.identifier_words(F.col("text")).alias("words")).where("size(words) > 0")
    docs = [(r.words, r.spans) for r in found.collect()]
    for how in ({}, {"support": 2, "trust": 0.3, "accept": 0.3}):
        assert {(r.word, r.kind) for r in pii.bootstrap(found, **how).collect()} == plain_bootstrap(docs, **how)


def test_long_words_keep_their_patterns(spark):
    word = "Geschäftsführerunterlagen" * 12
    rows = [(i, f"{word} {word} u{i}@mail.example.org {word}") for i in range(20)] + [(100, f"{word}\t{word}\n user#at#home5 {word}")]
    assert {r.doc_id: r.s for r in run(spark, rows)}[100].startswith("email:")
