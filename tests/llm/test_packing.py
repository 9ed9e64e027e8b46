"""Packing as an exact round trip of the tokenizer's ids."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sluice.llm.packing import Packer, WordEncoder, pack

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")


def verify(rows, texts, tokenizer, capacity=4096):
    ids = {d: ids_of(tokenizer, t) for d, t in texts.items()}
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r.length > 0 and r.doc_tokens == len(ids[r.doc_id])
        assert zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes()) == r.ids_crc32
        by_doc[r.doc_id].append((r.start, r.length))
        by_seq[r.sequence_id].append((r.offset, r.length))
    for groups, sizes in ((by_doc, {d: len(x) for d, x in ids.items()}), (by_seq, None)):
        for key, parts in groups.items():
            at = 0
            for start, length in sorted(parts):
                assert start == at
                at += length
            assert at == sizes[key] if sizes else at <= capacity
    padding = sum(0 if (n := sum(x for _, x in p)) & (n - 1) == 0 else capacity - n for p in by_seq.values())
    assert set(by_doc) == set(ids)
    return padding, sum(len(x) for x in ids.values())


def test_round_trip(spark, tokenizer):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in df.collect()}
    texts |= {10**6: None, 10**6 + 1: "", 10**6 + 2: "word " * 9000, 10**6 + 3: " \n"}
    src = spark.createDataFrame([(d, t, 0) for d, t in texts.items()], "doc_id bigint, text string, start int").repartition(3)
    padding, total = verify(pack(src, PATH).collect(), texts, tokenizer)
    assert padding == 0 and total > 100_000


def test_small_windows_and_open_limit(spark, tokenizer):
    texts = {i: "some words here " * (i % 23) for i in range(300)}
    src = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").coalesce(2)
    padding, total = verify(pack(src, PATH, capacity=64, open_limit=5).collect(), texts, tokenizer, 64)
    assert padding == 0


def test_null_ids_repeats_and_empty(spark):
    src = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, "c")], "doc_id bigint, text string").coalesce(1)
    rows = pack(src, PATH).collect()
    assert sum(r.length for r in rows) == 8
    assert pack(src.limit(0), PATH).collect() == []


def test_encoder_equals_the_tokenizer(tokenizer):
    enc = WordEncoder(PATH, limit=40)
    texts = ["It's O'Neill's 3rd <|endoftext|> e\u0301 \u0301x a\x0bb\x1cc\x85d\u2003e", "İΣ ΣΑΣ. $$$ 12345 \U0001f600!",
             " ".join(f"w{i}" for i in range(90)), "", "x" * 5000, "\tTab\r\nline\x0cfeed"]
    texts += ["word, word. word&&& it's, o'' e\u0301*** \u00e9, x<|endoftext|>, a'..s a'm' 9.", "<|ENDOFTEXT|> ABC", "ABC <|endoftext|>"]
    want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert [enc.encode(t.encode()) for t in texts * 2] == want * 2


def test_level_choice_is_the_least_sum_of_squares():
    rng = np.random.default_rng(3)
    packer = Packer(32, 0, 10**9)
    for i in range(400):
        size = int(rng.integers(1, 32))
        before = packer.counts.copy()
        best = None
        for h in range(0, 32 - size + 1):
            if h and not before[h]:
                continue
            c = before.copy()
            c[h] -= h > 0
            c[h + size] += h + size < 32
            best = min(x for x in (best, int((c[1:32] ** 2).sum())) if x is not None)
        packer.place((i, 0, memoryview(bytes(4 * size)).cast("I"), size))
        assert int((packer.counts[1:32] ** 2).sum()) == best
