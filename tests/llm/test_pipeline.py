"""The pipeline's stages, each on its predecessor's rows."""

import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as C
from test_jaccard_join import brute
from test_pii import brute as spans_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    folder, docs = tmp_path_factory.mktemp("steps"), spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for i, (_, stage) in enumerate(C.STAGES):
        stage(spark, out[-1], SF).write.parquet(f"{folder}/{i}")
        out.append(spark.read.parquet(f"{folder}/{i}"))
    return out


def test_columns_and_order(steps):
    assert all(s.columns == steps[0].columns for s in steps[:5])
    assert [f for _, f in C.STAGES] == [C.quality, C.near_duplicates, C.personal_data, C.mixture, C.sequences]


def test_quality_keeps_clean_documents(spark, steps):
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    kept = {r.doc_id for r in steps[1].collect()}
    clean = [r.doc_id for r in labels if r.quality and not r.toxic]
    assert np.mean([d in kept for d in clean]) > 0.95
    more = SF.replace("0.001", "0.01")  # where labels are enough to learn from
    docs, labels = (spark.read.parquet(f"{more}/{t}.parquet") for t in ("documents", "labels"))
    kept = {r.doc_id for r in C.quality(spark, docs, more).select("doc_id").collect()}
    assert np.mean([r.doc_id in kept for r in labels.collect() if not r.quality]) < 0.2
    assert np.mean([r.doc_id in kept for r in labels.collect() if r.quality and not r.toxic]) > 0.97


def test_one_document_of_each_group(steps):
    rows = [(r.doc_id, r.text) for r in steps[1].collect()]
    assert sorted(r.doc_id for r in steps[2].collect()) == sorted({c for _, _, c in brute(rows)})


def test_personal_data_is_masked(steps):
    before = {r.doc_id: r.text for r in steps[2].collect()}
    for r in steps[3].collect():
        text, at = "", 0
        spans = sorted((int(s), int(e), k) for k, s, e in (x.split(":") for x in spans_of(before[r.doc_id]).split(",") if x))
        for s, e, k in spans:
            if s >= at:
                text += before[r.doc_id][at:s] + f"<{k}>"
            at = max(at, e)
        assert r.text == text + before[r.doc_id][at:] and r.n_chars == len(r.text)


def test_mixture_meets_its_targets(steps):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    inside, taken = Counter(), Counter()
    for r in steps[3].collect():
        inside[r.source] += size(r.text)
    for r in steps[4].collect():
        taken[r.source] += size(r.text)
    assert abs(sum(taken.values()) - 1.5 * sum(inside.values())) < 0.05 * sum(inside.values())
    assert all(taken[s] <= 2 * n for s, n in inside.items())
    copies = Counter(r.doc_id for r in steps[4].collect())
    assert max(copies.values()) <= 2


def test_sequences_hold_every_id(steps):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r.doc_id: r.text for r in steps[4].collect()}
    copies = Counter(r.doc_id for r in steps[4].collect())
    ids = {d: np.array([*tok.encode(t, add_special_tokens=False).ids, 2], "<u4") for d, t in texts.items()}
    held = Counter()
    for r in steps[5].collect():
        assert zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes()) == r.ids_crc32
        held[r.doc_id] += r.length
    assert held == Counter({d: n * len(ids[d]) for d, n in copies.items()})


def test_run_is_the_stages_in_turn(spark, steps):
    got = C.run(spark, SF)
    assert got.columns == steps[5].columns
    assert got.agg(F.sum("length")).first() == steps[5].agg(F.sum("length")).first()


def test_odd_rows_pass_through_the_stages(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    rows = [(1, "call +1 (743) 555-3824 now x@y.z", None, None, None), (1, "call +1 (743) 555-3824 now x@y.z", None, None, None),
            (None, "a b c d e f", "en", "s", 1), (3, None, "en", "s", 0), (4, "", "en", "s", 0), (5, "w " * 20_000, "en", "t", 1),
            (6, "a b c d e f", "en", "s", 1)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for _, stage in C.STAGES:
            docs = stage(spark, docs, SF)
            docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert bool(docs.count()) == bool(data)
    (masked,) = {r.text for r in C.personal_data(spark, spark.createDataFrame(rows[:2], schema), SF).collect()}
    assert masked == "call <phone> now <email>"
