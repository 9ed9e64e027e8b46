"""Document fingerprints from closed syncmers with their positions.

A text is cut into pieces where its characters say so: after certain letters and
digits, at white space, and around every character of scripts that write no
spaces, so an edit moves the cuts of a piece or two and no others.  A run of
``K`` pieces is a closed syncmer when the smallest of its pieces' hashes stands at
its first or last place.  The test looks at the run alone, so what two texts share
gives the same anchors in both, wherever it stands.

A fingerprint holds the digest of the text and its anchors (40 bits of hash, place
among the pieces): all of them with ``density=None``, as ``edit_fingerprints`` takes
them, else a sketch of those whose hash is below a bound that falls with the square
root of the text's length (``density`` times that root at most are expected, all of
them in short texts).  Likeness matches anchors by position: of the common anchors
(of sketches: under the lower of both bounds), those whose places differ by about
the median difference count, against all anchors of both.  The digests count as one
anchor more, so only equal texts are alike by 1.

Everything is built-in expressions over whole texts; no Python runs on the
executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import cut

K = 4
BITS = 40
DENSITY = 6.0
#: Places of common anchors may differ from the median difference by so many pieces, and by this share of the longer text.
SLACK = 8
SLACK_SHARE = 0.2
_UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}"
_ENDS = "aouAOU05"
#: ASCII is told by one look-up, before the slow tests for scripts.
_INNER = "".join(rf"\x{c:02x}" for c in range(0x21, 0x7F) if chr(c) not in _ENDS)
_OTHER = rf"[^\s!-~{_UNSPACED}]"
#: A piece ends after one of ``_ENDS``, or after 16 characters; a character of unspaced scripts is a piece.
PIECE = rf"[[{_INNER}]{_OTHER}]{{1,15}}+[[{_INNER}{_ENDS}]{_OTHER}]?|[{_ENDS}]|[[^\x00-\x7f]&&[{_UNSPACED}]]"
#: Sort keys hold the hash and so many bits of place and side; longer texts take structs.
LOW = 64 - BITS


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def bound(n: Column, density: float | None = DENSITY) -> Column:
    """Anchors of a text of ``n`` pieces are kept below this hash; without a density all are."""
    if density is None:
        return F.lit(1 << BITS)
    return (F.least(F.lit(1.0), F.lit(density) / F.sqrt(F.greatest(n, F.lit(1)))) * float(1 << BITS)).cast("bigint")


def anchors(hashes: Column, density: float | None = DENSITY) -> Column:
    """Anchors of the pieces' hashes in order, below the bound: ``struct<hash, pos>`` of arrays.

    A text of fewer than K pieces has one anchor, its whole piece sequence; a
    text without pieces has none.
    """
    def closed(h: Column) -> Column:
        n = F.size(h)

        def run(i: Column) -> list[Column]:
            return [F.get(h, i + j if j else i) for j in range(K)]

        def edge(i: Column) -> Column:
            first, *inner, last = run(i)
            return F.least(first, last) <= F.least(*inner)

        def mark(i: Column) -> Column:
            return F.shiftrightunsigned(F.xxhash64(*run(i)), 64 - BITS)

        places = F.filter(F.sequence(F.lit(0), n - K), edge)
        if density is not None:
            places = _let(bound(n, density), lambda b: F.filter(places, lambda i: mark(i) < b))
        whole = F.filter(F.array(F.lit(0)), lambda _: n > 0)
        return F.when(n < K, F.struct(F.transform(whole, lambda _: F.shiftrightunsigned(F.xxhash64(h), 64 - BITS)).alias("hash"), whole.alias("pos"))) \
                .otherwise(_let(places, lambda at: F.struct(F.transform(at, mark).alias("hash"), at.alias("pos"))))

    return closed(hashes)


def fingerprint(text: Column, density: float | None = DENSITY) -> Column:
    """``struct<whole, n, hash, pos>``: digest, pieces, and the anchors in order."""
    pieces = F.regexp_extract_all(text, F.lit(PIECE), F.lit(0))
    return _let(F.transform(pieces, lambda p: F.xxhash64(p)), lambda h: _let(anchors(h, density), lambda m: F.struct(
        F.xxhash64(text).alias("whole"), F.size(h).alias("n"), m["hash"].alias("hash"), m["pos"].alias("pos"))))


def as_string(fp: Column) -> Column:
    """Digest, then every anchor with the distance to the one before."""
    gaps = _let(fp["pos"], lambda pos: F.transform(pos, lambda p, i: p - F.coalesce(F.get(pos, i - 1), F.lit(0))))
    marks = F.zip_with(fp["hash"], gaps, lambda h, g: F.concat(F.lpad(F.hex(h), BITS // 4, "0"), F.lit("+"), F.hex(g)))
    return F.lower(F.concat_ws(".", F.lpad(F.hex(fp["whole"]), 16, "0"), marks))


#: The last anchor of ``a`` and the first of ``b`` with a hash stand side by side.
_LOWS = (lambda p: -1 - p, lambda p: p)


def meeting(a: Column, b: Column, density: float | None = DENSITY) -> Column:
    """Anchors of both, sorted by hash, those of ``a`` first and from its end: ``hash`` and
    ``low`` packed in numbers, which sort fast.  Null if a place does not fit."""
    def keys(fp: Column, low) -> Column:
        return F.zip_with(fp["hash"], fp["pos"], lambda h, p: F.coalesce(F.shiftleft(h, LOW) + (low(p) + (1 << LOW - 1)), F.lit(0)))
    return F.when(F.greatest(a["n"], b["n"]) <= 1 << LOW - 1, F.sort_array(F.concat(
        *[keys(_below(fp, a, b, density), low) for fp, low in zip((a, b), _LOWS)])))


def _below(fp: Column, a: Column, b: Column, density: float | None) -> Column:
    """The anchors of ``fp`` that the bounds of both ``a`` and ``b`` keep."""
    if density is None:
        return fp
    # a short text's one anchor is always kept
    limit = F.greatest(F.least(bound(a["n"], density), bound(b["n"], density)), F.when(F.least(a["n"], b["n"]) < K, F.lit(1 << BITS)).otherwise(F.lit(0)))
    return _let(F.struct(limit.alias("limit"), fp["hash"].alias("hash"), fp["pos"].alias("pos")), lambda m: F.struct(
        F.filter(m["hash"], lambda h: h < m["limit"]).alias("hash"),
        F.filter(m["pos"], lambda _, i: F.get(m["hash"], i) < m["limit"]).alias("pos")))


def likeness(a: Column, b: Column, density: float | None = DENSITY, met: Column | None = None) -> Column:
    """0 to 1; 1 for equal texts only.  ``density`` is that of both fingerprints, ``met`` their
    ``meeting``, which sorts fastest as a column of its own.

    Anchors meet by sorting, so long texts cost little more than their length."""
    again = F.lit(-1 << 62)

    def moves(s: Column, of, low) -> Column:
        """By anchor: null for a new hash, the distance of a common one, ``again`` for others."""
        def move(x: Column, y: Column) -> Column:
            return F.when(of(x) == of(y), F.when((low(x) < 0) & (low(y) >= 0), -1 - low(x) - low(y)).otherwise(again))
        return F.transform(s, lambda y, i: move(F.get(s, i - 1), y))

    def packed(s: Column) -> Column:
        return moves(s, lambda v: F.shiftright(v, LOW), lambda v: v.bitwiseAND((1 << LOW) - 1) - (1 << LOW - 1))

    def wide(s: Column) -> Column:
        return moves(s, lambda v: v["hash"], lambda v: v["low"])

    def near(o: Column) -> Column:
        middle = F.lit(SLACK) + F.lit(SLACK_SHARE) * F.greatest(a["n"], b["n"])
        return _let(F.struct(F.get(o, F.floor(F.size(o) / 2).cast("int")).alias("at"), middle.alias("off")),
                    lambda m: F.size(F.filter(o, lambda q: F.abs(q - m["at"]) <= m["off"])))

    def share(d: Column) -> Column:
        old = F.array_compact(d)
        return _let(old, lambda e: _let(F.sort_array(F.array_remove(e, again)), lambda o: near(o) / (F.size(d) - F.size(e) + 1)))

    def structs(fp: Column, low) -> Column:
        return F.zip_with(fp["hash"], fp["pos"], lambda h, p: F.struct(h.alias("hash"), low(p).cast("bigint").alias("low")))

    def moved(s: Column) -> Column:
        slow = F.sort_array(F.concat(*[structs(_below(fp, a, b, density), low) for fp, low in zip((a, b), _LOWS)]))
        return F.when(s.isNotNull(), _let(s, packed)).otherwise(_let(slow, wide))

    all_moves = _let(meeting(a, b, density), moved) if met is None else moved(met)
    return F.when(a["whole"] == b["whole"], 1.0).otherwise(_let(all_moves, share)).cast("double")


def _order_buckets(rows: DataFrame, bucket_rows: int) -> Column:
    """Bucket number of ``id``, ascending with it; -1 for null.  Percentiles
    bound about a hundred stretches, each cut evenly into further buckets."""
    n, low, high, at = rows.agg(F.count("id"), F.min("id"), F.max("id"), F.percentile_approx(
        "id", [i / 100 for i in range(1, 100)], 10_000)).first()
    if not n:
        return F.lit(-1).cast("bigint")
    bounds = sorted({low, *at, min(high + 1, (1 << 63) - 1)})
    per = -(-n // (bucket_rows * len(bounds)))
    lo, hi = (F.array(*[F.lit(float(x)) for x in b]).cast("array<double>") for b in (bounds[:-1], bounds[1:]))
    seg = F.size(F.filter(lo, lambda b: b <= F.col("id").cast("double")))
    width = F.get(hi, seg - 1) - F.get(lo, seg - 1)
    share = F.when(width > 0, (F.col("id").cast("double") - F.get(lo, seg - 1)) / width).otherwise(0.0)
    return F.coalesce((seg * per + F.least(F.floor(share * per), F.lit(per - 1))).cast("bigint"), F.lit(-1))


def with_next(docs: DataFrame, id_col: str, text_col: str, carry: dict[str, Column],
              bucket_rows: int = 2048, broadcast_rows: int = 250_000) -> DataFrame:
    """``id``, ``text``, the ``carry`` columns, and each of these of the next row
    (``next_text`` ...) in descending id order, the first row after the last.

    Ids are numbers; null ids come last, equal ids in descending text order.
    Rows are dealt to order buckets and each bucket is sorted on its own; the
    first row of every bucket closes the gap to the bucket before.  Only bucket
    numbers are put in one order.  Up to ``broadcast_rows`` of them are
    broadcast to find the first rows, more are joined by a shuffle.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    number = _order_buckets(rows, bucket_rows)
    heads = cut(rows.select("id", number.alias("bucket")).groupBy("bucket").agg(F.max("id").alias("id")))
    order = Window.orderBy(F.desc("bucket"))
    after = heads.select("bucket", F.lead("bucket").over(order).alias("next"),
                         F.first("bucket").over(order).alias("top"))
    after = after.select(F.col("bucket").alias("before"), F.coalesce("next", "top").alias("bucket"))
    names = ["text", *carry]
    top_ids = heads.select("bucket", F.col("id").alias("hid"))
    if heads.count() <= broadcast_rows:
        top_ids = F.broadcast(top_ids)
    named = rows.withColumn("bucket", number)
    first = (named.join(top_ids, (named["bucket"] == top_ids["bucket"]) & named["id"].eqNullSafe(top_ids["hid"]))
             .select(named["bucket"], "text").groupBy("bucket").agg(F.max("text").alias("text"))
             .select("bucket", "text", *[c.alias(k) for k, c in carry.items()])
             .join(after, "bucket").select(F.col("before").alias("bucket"), F.struct(*names).alias("head")))
    w = Window.partitionBy("bucket").orderBy(F.col("id").desc_nulls_last(), F.desc("text"))
    # texts are moved, and what is worked out from them is not
    full = rows.select("*", number.alias("bucket")).repartition("bucket").select("*", *[c.alias(k) for k, c in carry.items()])
    led = full.withColumn("follow", F.lead(F.struct(*names)).over(w)).join(first, "bucket")
    return led.select("id", *names, *[F.coalesce(f"follow.{n}", f"head.{n}").alias(f"next_{n}") for n in names])


def edit_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text.

    The edited text has its last floor(n / 3) characters replaced by the first
    as many (or all) of the next document in descending id order; after the
    last comes the first.  Null text counts as empty; an empty text has a
    digest and no anchors.  Null ids come last in order, repeated ids in descending
    text order.  Other columns are ignored; an empty table gives an empty
    result.  Returns id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.
    """
    rows = with_next(docs, id_col, text_col, {"fp": fingerprint(F.col("text"), None)})
    n = F.char_length("text")
    third = F.floor(n / 3).cast("int")
    edited = rows.select("id", "fp", "next_fp", n.cast("bigint").alias("n_chars"), F.concat(
        F.substring("text", F.lit(1), n - third), F.substring("next_text", F.lit(1), third)).alias("edited"))
    made = edited.select("id", "fp", "next_fp", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                         fingerprint(F.col("edited"), None).alias("efp"))
    fp, efp, after = (F.col(c) for c in ("fp", "efp", "next_fp"))
    met = made.select("*", meeting(fp, efp, None).alias("met_edited"), meeting(fp, after, None).alias("met_next"))
    return met.select(F.col("id").alias(id_col), "n_chars", "edited_sha256",
                      as_string(fp).alias("fingerprint"), as_string(efp).alias("edited_fingerprint"),
                      likeness(fp, efp, None, F.col("met_edited")).alias("near_edited"),
                      likeness(fp, after, None, F.col("met_next")).alias("near_next"))
