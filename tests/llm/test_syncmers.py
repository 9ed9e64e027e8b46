"""Edited texts, hashes and fingerprints against plain Python."""

import hashlib
import math
import random
import re
import time

from pyspark.sql import functions as F

from sluice.llm import syncmers
from sluice.llm.syncmers import edit_fingerprints


def edited(rows):
    """(id, text) -> edited text, in the operator's order."""
    order = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]), reverse=True)
    out = []
    for (d, t), (_, after) in zip(order, order[1:] + order[:1]):
        cut = len(t) // 3
        out.append((d, t, t[:len(t) - cut] + after[:cut], after))
    return out


def run(spark, rows):
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id bigint, text string, bucket int, fp string")
    return edit_fingerprints(df).collect()


def check(spark, rows):
    got = sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in run(spark, rows))
    assert got == sorted((str(d), len(t), hashlib.sha256(e.encode()).hexdigest()) for d, t, e, _ in edited(rows))


def test_edited_texts_of_a_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(spark, [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])


def test_order_buckets_close_up(spark):
    rows = [(i * i, f"text {i} " * (i % 9)) for i in range(300)]
    df = spark.createDataFrame(rows, "id bigint, text string")
    order = sorted(rows, reverse=True)
    for n in (0, 10**6):
        led = syncmers.with_next(df, "id", "text", {}, bucket_rows=7, broadcast_rows=n).collect()
        assert {(r.id, r.next_text) for r in led} == {(a[0], b[1]) for a, b in zip(order, order[1:] + order[:1])}


def test_edge_rows(spark):
    rows = [(None, "no id here"), (3, None), (2, ""), (2, "b " * 50), (2, "b " * 50), (7, "ß漢字😀 one"), (9, "x" * 30_000),
            (2**63 - 1, "largest id"), (-2**63, "smallest id")]
    check(spark, rows)
    assert run(spark, []) == []
    (one,) = run(spark, [(1, "abcdef")])
    assert one.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()


def fingerprints(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return {r.i: r.f for r in df.select("i", syncmers.fingerprint(F.col("t")).alias("f")).collect()}


def near(spark, a, b):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    one = df.select(*[syncmers.fingerprint(F.col(c)).alias(c) for c in "ab"]).select(
        syncmers.likeness(F.col("a"), F.col("b")).alias("x"), syncmers.likeness(F.col("b"), F.col("a")).alias("y"),
        (syncmers.as_string(F.col("a")) == syncmers.as_string(F.col("b"))).alias("same")).first()
    assert abs(one.x - one.y) < 0.05 and 0 <= one.x <= 1 and one.same == (a == b)
    return one.x


def prose(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 9))) for _ in range(n)]


def test_likeness(spark):
    words = prose(900)
    rows = [(3, " ".join(words)), (2, " ".join(words)), (1, " ".join(words[::-1])), (0, "")]
    got = {r.doc_id: r for r in run(spark, rows)}
    assert got[3].fingerprint == got[2].fingerprint != got[1].fingerprint
    assert got[3].near_next == 1.0 and got[2].near_next < 0.1 and got[0].near_edited == 1.0
    assert 0.3 < got[1].near_edited < 0.7


def test_small_edits_of_a_long_text(spark):
    words = prose(20_000)
    other = words[:9000] + prose(50, 2) + words[9050:]
    x = near(spark, " ".join(words), " ".join(other))
    assert 0.97 < x < 1.0
    assert near(spark, " ".join(words), " ".join([*words[:-1], "changed"])) < 1.0


def test_order_matters(spark):
    paragraphs = [" ".join(prose(60, i)) for i in range(20)]
    assert near(spark, "\n".join(paragraphs), "\n".join(paragraphs[::-1])) < 0.5
    assert near(spark, "\n".join(paragraphs), "\n".join(paragraphs[:10] + paragraphs[11:])) > 0.85


def test_one_character_in_unspaced_text(spark):
    rng = random.Random(3)
    for text in ("".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(2000)), "".join(rng.choices(
            "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/", k=4000))):
        assert 0.9 < near(spark, text, text[:700] + "Q" + text[700:]) < 1.0


def test_count_grows_with_the_text(spark):
    sizes = [10, 100, 1000, 10_000]
    got = fingerprints(spark, [" ".join(prose(n)) for n in sizes])
    kept = [len(got[i].hash) for i in range(4)]
    assert kept[0] < kept[1] < kept[2] < kept[3] and kept[3] > 2 * kept[2]


def test_fingerprint_follows_the_definition(spark):
    for n in (3, 40, 3000):
        text = " ".join(prose(n, n))
        pieces = [p for w in text.split() for p in re.findall(r"\S{0,15}?[aouAOU05]|\S{1,16}", w)]
        h = [r.h for r in spark.createDataFrame(list(enumerate(pieces)), "i int, p string").orderBy("i").select(F.xxhash64("p").alias("h")).collect()]
        runs = [(i, *h[i:i + 4]) for i in range(len(h) - 3) if min(h[i], h[i + 3]) <= min(h[i + 1], h[i + 2])]
        limit = int(min(1.0, 6.0 / math.sqrt(len(h))) * 2.0 ** 40)
        want = [(r.i, r.x) for r in spark.createDataFrame(runs, "i int, a bigint, b bigint, c bigint, d bigint").select(
            "i", F.shiftrightunsigned(F.xxhash64("a", "b", "c", "d"), 24).alias("x")).collect() if r.x < limit] if len(h) > 3 else None
        got = fingerprints(spark, [text])[0]
        assert got.n == len(h)
        if want is not None:
            assert sorted(zip(got.pos, got.hash)) == sorted(want)


def test_likeness_follows_the_definition(spark):
    rng = random.Random(9)
    base = prose(400, 5)
    for _ in range(6):
        at, n = rng.randrange(300), rng.randrange(1, 80)
        other = base[:at] + prose(rng.randrange(90), rng.random()) + base[at + n:]
        a, b = (fingerprints(spark, [" ".join(t)])[0] for t in (base, other))
        limit = min(int(min(1.0, 6.0 / math.sqrt(x.n)) * 2.0 ** 40) for x in (a, b))
        ha, hb = ([h for h in x.hash if h < limit] for x in (a, b))
        moved = sorted(a.pos[a.hash.index(h)] - b.pos[b.hash.index(h)] for h in set(ha) & set(hb))
        slack = 8 + 0.2 * max(a.n, b.n)
        good = sum(abs(o - moved[len(moved) // 2]) <= slack for o in moved)
        assert abs(near(spark, " ".join(base), " ".join(other)) - good / (len({*ha, *hb}) + 1)) < 1e-9


def test_fingerprints_of_documents_hold_every_anchor(spark):
    text = " ".join(prose(3000, 7))
    pieces = [p for w in text.split() for p in re.findall(r"\S{0,15}?[aouAOU05]|\S{1,16}", w)]
    h = [r.h for r in spark.createDataFrame(list(enumerate(pieces)), "i int, p string").orderBy("i").select(F.xxhash64("p").alias("h")).collect()]
    places = [i for i in range(len(h) - 3) if min(h[i], h[i + 3]) <= min(h[i + 1], h[i + 2])]
    (marks,) = [r.fingerprint.split(".")[1:] for r in run(spark, [(1, text), (2, "")]) if r.doc_id == 1]
    at, got = 0, []
    for m in marks:
        at += int(m.split("+")[1], 16)
        got.append(at)
    assert got == places


PLAIN_PIECE = (r"[{0}]|[^\s{0}]{{0,15}}?[aouAOU05]|[^\s{0}]{{1,16}}").format(
    r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}")


def test_pieces_follow_the_plain_pattern(spark):
    rng = random.Random(11)
    alphabets = ["bcdfgh", "bcdfgha", "aou05AOU", "xyz \t\n\x0b\f\r", "b漢ひカกກក", "жяé😀aβ", "b~!-[]^&\\.`@/1469\x00\x1f\x7f\x85\xa0　a",
                 "".join(map(chr, range(1, 256)))]
    texts = ["", "b" * 15 + "a", "b" * 16 + "a", "b" * 14 + "a", "b" * 33, "b" * 15 + "é" + "a", "é" * 15 + "0é", "漢a", "a漢", "b漢"]
    texts += ["".join(rng.choices(a, k=rng.randrange(60))) for a in [*alphabets, "".join(alphabets)] for _ in range(80)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    cut_at = [F.regexp_extract_all("t", F.lit(p), F.lit(0)) for p in (PLAIN_PIECE, syncmers.PIECE)]
    assert df.where(~cut_at[0].eqNullSafe(cut_at[1])).collect() == []


def test_pieces_take_less_time_than_the_plain_pattern(spark):
    df = spark.createDataFrame([(" ".join(prose(30_000, i)),) for i in range(16)], "t string").cache()
    df.count()

    def seconds(pattern):
        begun = time.perf_counter()
        df.select(F.size(F.regexp_extract_all("t", F.lit(pattern), F.lit(0)))).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begun

    plain, ours = (min(seconds(p) for _ in range(4)) for p in (PLAIN_PIECE, syncmers.PIECE))
    assert 1.3 * ours < plain


def test_anchors_meet_as_numbers_in_a_column_of_their_own(spark):
    df = spark.createDataFrame([(i, " ".join(prose(40, i))) for i in range(6)], "doc_id bigint, text string")
    plan = edit_fingerprints(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "AS met_edited" in plan and "AS met_next" in plan
    a, b = (syncmers.fingerprint(F.lit(t), None) for t in ("one two three four", "five six"))
    assert spark.range(1).select(syncmers.meeting(a, b, None).alias("m")).schema["m"].dataType.simpleString() == "array<bigint>"


def test_anchors_meet_alike_as_structs(spark):
    rng = random.Random(4)
    some = prose(300, 2)
    pairs = [(some, some[:200] + prose(90, 3)), (some * 3, some * 2 + prose(10, 5)), (some, some[150:] + some[:150]), (some, []), (["b"], ["b", "c"])]
    pairs += [(rng.choices(some[:8], k=90), rng.choices(some[:8], k=70)) for _ in range(8)]
    df = spark.createDataFrame([(" ".join(a), " ".join(b)) for a, b in pairs], "a string, b string")
    for density in (None, 6.0):
        fps = df.select(*[syncmers.fingerprint(F.col(c), density).alias(c) for c in "ab"])
        a, b = F.col("a"), F.col("b")
        got = fps.withColumn("m", syncmers.meeting(a, b, density)).select(
            syncmers.likeness(a, b, density), syncmers.likeness(a, b, density, F.col("m")),
            syncmers.likeness(a, b, density, F.lit(None).cast("array<bigint>"))).collect()
        assert all(x == y == z for x, y, z in got) and 0 < got[0][0] < 1
