"""The classifier's models, its bar and Gumbel top-k."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm.common import word_hashes
from sluice.llm.quality import buckets, classify, gumbel, kth_largest, log_ratio

GOOD, BAD = [f"plain{i}" for i in range(300)], [f"junk{i}" for i in range(30)]


def corpus(n=1500, seed=3):
    rnd = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        kind = rnd.choice(["clean", "clean", "clean", "low", "toxic"])
        words = [rnd.choice(GOOD) for _ in range(rnd.randint(20, 80))]
        if kind != "clean":
            words[::4] = [rnd.choice(BAD if kind == "low" else ["slur", "insult"]) for _ in words[::4]]
        docs.append((i, " ".join(words), kind))
        if i % 2:
            labels.append((i, int(kind != "low"), int(kind == "toxic")))
    return docs, labels


def frames(spark, docs, labels):
    return (spark.createDataFrame([(d, t, "x", k) for d, t, k in docs], "doc_id bigint, text string, good string, kind string"),
            spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))


def test_held_out_accuracy(spark):
    docs, labels = corpus()
    rows = classify(*frames(spark, docs, labels)).collect()
    held = [r for r in rows if r.doc_id % 2 == 0]
    assert np.mean([r.quality_key.kept for r in held if r.kind == "clean"]) > 0.98
    assert np.mean([r.quality_key.kept for r in held if r.kind != "clean"]) < 0.05
    assert [f for f in rows[0].__fields__] == ["doc_id", "text", "good", "kind", "quality_key"]
    again = classify(*(f.repartition(5) for f in frames(spark, docs, labels))).collect()
    assert {(r.doc_id, r.quality_key.kept) for r in again} == {(r.doc_id, r.quality_key.kept) for r in rows}


def test_unlabelled_copies_of_new_text_stay(spark):
    docs, labels = corpus(800)
    docs += [(10_000 + i, "an unseen passage about something new altogether " * 6, "clean") for i in range(700)]
    rows = classify(*frames(spark, docs, labels)).collect()
    assert all(r.quality_key.kept for r in rows if r.doc_id >= 10_000)


def test_weights_are_the_ratio_of_the_models(spark):
    docs, labels = corpus(400)
    d, lab = frames(spark, docs, labels)
    rows = {r.doc_id: r.quality_key for r in classify(d, lab, bits=12, label_rows=10**6).collect()}
    fit = {r[0] for r in lab.where(F.pmod(F.xxhash64(F.lit(43), "doc_id"), F.lit(10)) < 7).select("doc_id").collect()}
    counts = np.zeros((3, 1 << 12), np.int64)
    clean = {i for i, q, t in labels if q and not t}
    for i, t, _ in docs:
        b = np.bincount(buckets(t.encode(), 12), minlength=1 << 12)
        counts[0] += b
        counts[1] += b * (i in fit)
        counts[2] += b * (i in fit and i in clean)
    w = log_ratio(*counts, 1.0, 3.0)
    for i, t, _ in docs[:50]:
        assert rows[i].log_weight == pytest.approx(w[buckets(t.encode(), 12)].sum())
        assert -0.25 * 5 < rows[i].key - rows[i].log_weight < 0.25 * 30


def test_given_k_takes_the_largest_keys(spark):
    docs, labels = corpus(400)
    rows = classify(*frames(spark, docs, labels), k=123).collect()
    order = sorted(rows, key=lambda r: -r.quality_key.key)
    assert {r.doc_id for r in rows if r.quality_key.kept} == {r.doc_id for r in order[:123]}


def test_kth_largest(spark):
    rnd = random.Random(1)
    vals = [rnd.gauss(0, 1) ** 3 for _ in range(3000)] + [0.5] * 500
    df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "k double")
    order = sorted(vals, reverse=True)
    for k in (1, 7, 600, 1200, 3499):
        assert kth_largest(df, "k", k, ranges=16, enough=50) == order[k - 1]
    assert kth_largest(df, "k", 10**6) == float("-inf") and kth_largest(df, "k", 0) == float("inf")
    assert kth_largest(df.limit(0), "k", 3) == float("-inf")


def test_edge_rows(spark):
    docs = [(1, None, "a"), (2, "", "a"), (None, "plain1 plain2", "a"), (4, "w " * 100_000, "a"), (5, "x", "a"), (5, "x", "a")]
    labels = [(1, 1, 0), (2, 0, 1), (None, 1, 1), (5, None, 0), (5, 1, None), (7, 1, 0)]
    rows = classify(*frames(spark, docs, labels)).collect()
    assert len(rows) == 6 and all(r.quality_key.log_weight == 0 for r in rows if not r.text)
    none = classify(*frames(spark, docs, [])).collect()
    assert all(r.quality_key.kept and r.quality_key.log_weight == 0 for r in none)
    assert classify(*frames(spark, [], labels)).collect() == []


def test_gumbel_numbers(spark):
    g = np.array([r[0] for r in spark.range(4000).select(gumbel(1, F.col("id"))).collect()])
    assert abs(g.mean() - 0.5772) < 0.1 and abs(g.std() - 1.2825) < 0.1
    assert len(word_hashes(b"A a b")) == 3 and len(buckets(b"", 12)) == 0


def test_rare_toxic_words_of_several_languages_are_not_outvoted(spark):
    rnd = random.Random(5)
    docs, labels = [], []
    for i in range(2400):
        lang = rnd.choice(["en", "en", "en", "de", "fr"])
        kind = "toxic" if rnd.random() < 0.15 else "low" if rnd.random() < 0.15 else "clean"
        words = [f"{lang}{min(rnd.randrange(300), rnd.randrange(300))}" for _ in range(rnd.randint(60, 200))]
        if kind == "low":
            words[::3] = [rnd.choice(BAD) for _ in words[::3]]
        if kind == "toxic":  # few words, each of them rare
            for at in rnd.sample(range(len(words)), 4):
                words[at] = f"slur-{lang}-{rnd.randrange(12)}"
        docs.append((i, " ".join(words), f"{lang} {kind}"))
        if i % 2:
            labels.append((i, int(kind != "low"), int(kind == "toxic")))
    rows = classify(*frames(spark, docs, labels)).collect()
    kept = {}
    for r in rows:
        if r.doc_id % 2 == 0:
            kept.setdefault(r.kind, []).append(r.quality_key.kept)
    for lang in ("en", "de", "fr"):
        assert np.mean(kept[f"{lang} toxic"]) < 0.15 and np.mean(kept[f"{lang} clean"]) > 0.97, (lang, kept[f"{lang} toxic"])


def test_toxic_recall_per_language_on_the_documents_table(spark):
    base = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{base}/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{base}/labels.parquet")
    fit = F.pmod(F.xxhash64(F.lit(43), "doc_id"), F.lit(10)) < 7
    got = classify(docs, labels).join(labels.where(~fit), "doc_id")
    n = {tuple(r)[:3]: r[3:] for r in got.groupBy("lang", "quality", "toxic").agg(
        F.count("*"), F.count_if("quality_key.kept")).collect()}
    # Of the 10 rows of Spanish, 2 are found: few toxic rows of it are there to fit.
    for lang, least in (("en", 0.9), ("de", 0.75), ("fr", 0.75), ("es", 0.1)):
        rows, kept = n[lang, 1, 1]
        assert 1 - kept / rows >= least, (lang, rows, kept)
    clean = [v for (_, q, t), v in n.items() if q and not t]
    assert sum(k for _, k in clean) >= 0.99 * sum(a for a, _ in clean)
