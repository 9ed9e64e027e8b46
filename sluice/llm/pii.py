"""Personal data: base patterns and bootstrapped contextual extraction.

**Base.**  Emails, IPv4 addresses, payment cards and phone numbers by pattern,
leftmost and non-overlapping per kind; matches that fail their check (part
size, digit count, Luhn) are dropped.

**Bootstrapping.**  Base matches are seeds.  Words that hold a digit or an ``@``
are instances, a run of adjoining words with digits one instance, and the words
around it give lexical patterns (the two words before it; the word before and
the word after).  The bipartite graph of patterns and instances is scored in
rounds: a pattern's confidence in a kind is the mean score of its distinct
instances, an instance's score is that of a seed (1) or the noisy-or of its
confident patterns.  Instances at or above ``accept`` join the seeds, so the next
round finds patterns through them; those of the last round are new identifiers
wherever they occur; base spans stay.

Texts are read once; everything after that works on the identifier-like words.
All of it is built-in expressions, joins and partial aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import cut

KINDS = ("email", "ip", "card", "phone")

# Where a run of characters starts a match, no later start in it can give
# another, so patterns look only at starts of runs (and right after a match),
# and runs are possessive: texts of one endless word stay linear.
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Words with an @ or an IP address stand alone; a + or punctuation ends a run.
_ALONE = r"\S*@|\S*[0-9]\.[0-9]++\.[0-9]++\.[0-9]"
WORDS = (rf"(?<!\S)(?:(?={_ALONE})[^\s0-9@]*+[0-9@]\S*+|[^\s0-9@]*+[0-9]\S*+"
         rf"(?:(?<![,;:!?.])\x20(?!\+|{_ALONE})[^\s0-9@]*+[0-9]\S*+)*+)")
_IP_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _sum(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0), lambda a, x: a + x)


def running_sum(xs: Column, chunk: int = 128) -> Column:
    """Running sums of an array of ints, in chunks so that long arrays stay cheap."""
    def by_chunks(parts: Column) -> Column:
        sums = F.transform(parts, _sum)
        return F.flatten(F.transform(parts, lambda p, c: _let(
            _sum(F.slice(sums, F.lit(1), c)),
            lambda before: F.transform(p, lambda _, i: before + _sum(F.slice(p, F.lit(1), i + 1))))))
    n = F.size(xs)
    starts = F.when(n > 0, F.sequence(F.lit(1), n, F.lit(chunk))).otherwise(F.array().cast("array<int>"))
    return _let(F.transform(starts, lambda s: F.slice(xs, s, F.lit(chunk))), by_chunks)


def matches(text: Column, pattern: str) -> Column:
    """All matches as ``array<struct<start, end, found, before, after>>``:
    code points, end exclusive, and the texts between matches on both sides."""
    def place(found: Column) -> Column:
        def between(gaps: Column) -> Column:
            lengths = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found,
                                 lambda g, m: F.char_length(g) + F.char_length(m))
            return _let(running_sum(lengths), lambda ends: F.transform(found, lambda m, i: F.struct(
                (F.get(ends, i) - F.char_length(m)).alias("start"), F.get(ends, i).alias("end"), m.alias("found"),
                F.get(gaps, i).alias("before"), F.get(gaps, i + 1).alias("after"))))
        return F.when(F.size(found) > 0, _let(F.split(text, pattern, -1), between))
    return F.coalesce(_let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), place),
                      F.array().cast("array<struct<start:int,end:int,found:string,before:string,after:string>>"))


def _luhn(digits: Column) -> Column:
    total = F.aggregate(F.split(F.reverse(digits), ""), F.struct(F.lit(0).alias("s"), F.lit(1).alias("k")),
                        lambda a, x: F.struct(
                            (a["s"] + _let(F.coalesce(F.try_to_number(x, F.lit("9")).cast("int"), F.lit(0)) * a["k"],
                                           lambda v: F.when(v > 9, v - 9).otherwise(v))).alias("s"),
                            (F.lit(3) - a["k"]).alias("k")))
    return total["s"] % 10 == 0


def _holds(kind: str, found: Column) -> Column:
    digits = F.regexp_replace(found, "[^0-9]", "")
    if kind == "ip":
        return found.rlike(rf"^(?:{_IP_PART}(?:\.|$)){{4}}$")
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


_SPAN = "array<struct<kind:int,start:int,end:int>>"


def base_spans(text: Column) -> Column:
    """Base matches by kind as listed, then start: ``array<struct<kind, start, end>>``."""
    def of(i: int, kind: str) -> Column:
        good = F.filter(matches(text, PATTERNS[kind]), lambda m: _holds(kind, m["found"]))
        return F.transform(good, lambda m: F.struct(F.lit(i).alias("kind"), m["start"].alias("start"),
                                                    m["end"].alias("end")))
    return F.when(text.rlike("[0-9@]"), F.concat(*[of(i, k) for i, k in enumerate(KINDS)])) \
            .otherwise(F.array().cast(_SPAN))


def identifier_words(text: Column) -> Column:
    """Words that hold a digit or ``@``, runs of adjoining ones as one, without
    edge punctuation, with the words around them (digits as 9):
    ``array<struct<start, end, word, two, around>>``."""
    def spaced(s: Column) -> Column:
        return F.regexp_replace(s, r"\s+", " ")

    def nines(s: Column) -> Column:
        return F.regexp_replace(F.lower(s), "[0-9]+", "9")

    def core(all_: Column, m: Column, i: Column) -> Column:
        left = F.char_length(F.regexp_extract(m["found"], r"^[^\p{L}\p{N}]*", 0))
        word = F.regexp_replace(m["found"], r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")
        last_one = F.get(all_, i - 1)
        lead = F.concat(F.substring_index(spaced(last_one["before"]), " ", -3), last_one["found"])
        before = F.trim(spaced(F.concat(F.coalesce(lead, F.lit("")), m["before"])))
        behind = F.concat(m["after"], F.coalesce(F.get(all_, i + 1)["found"], F.lit("")))
        after = nines(F.regexp_extract(behind, r"^\s+(\S+)", 1))
        return _let(F.struct(before.alias("b"), after.alias("a")), lambda x: F.struct(
            (m["start"] + left).alias("start"), (m["start"] + left + F.char_length(word)).alias("end"), word.alias("word"),
            F.when(x["b"].contains(" "), F.concat(F.lit("< "), nines(F.substring_index(x["b"], " ", -2)))).alias("two"),
            F.when((x["b"] != "") & (x["a"] != ""), F.concat(nines(F.substring_index(x["b"], " ", -1)), F.lit(" _ "), x["a"])).alias("around")))
    words = _let(matches(text, WORDS), lambda found: F.filter(
        F.transform(found, lambda m, i: core(found, m, i)), lambda w: w["word"].rlike("[0-9@]")))
    return F.when(text.rlike("[0-9@]"), words).otherwise(
        F.array().cast("array<struct<start:int,end:int,word:string,two:string,around:string>>"))


def bootstrap(found: DataFrame, support: int = 3, trust: float = 0.8, accept: float = 0.9) -> DataFrame:
    """Instances accepted beyond the seeds: ``(word, kind)``.

    ``found`` has ``spans`` and ``words`` as made above.  A pattern counts when
    at least ``support`` distinct seeds or accepted instances of the kind stand in
    it and its confidence reaches ``trust``.  Rounds go on until one accepts what
    the round before did: confidence and scores only grow from round to round, so
    what is accepted does, and it is bounded by the words there are.
    """
    one = found.select(F.explode("words").alias("w"), "spans").select(
        "w.word", F.explode(F.array_compact(F.array("w.two", "w.around"))).alias("pattern"),
        F.array_min(F.transform(F.filter("spans", lambda s: (s["start"] < F.col("w.end")) & (s["end"] > F.col("w.start"))),
                                lambda s: s["kind"])).alias("kind"))
    edges = cut(one.groupBy("pattern", "word").agg(F.min("kind").alias("kind")))
    seeds = cut(edges.where("kind is not null").groupBy("word").agg(F.min("kind").alias("kind")))
    score = first = seeds.select("word", F.col("kind").alias("of"), F.lit(1.0).alias("score"))
    before = (0, 0.0)
    while True:
        strong = (edges.select("pattern", "word").join(score, "word").groupBy("pattern", "of")
                  .agg(F.count("*").alias("n"), F.sum("score").alias("s")).where(F.col("n") >= support))
        graph = cut(edges.select("pattern", "word").join(strong, "pattern"))
        sure = (graph.groupBy("pattern", "of").agg((F.first("s") / F.count("*")).alias("sure"))
                .where(F.col("sure") >= trust))
        new = cut(graph.select("pattern", "word", "of").join(sure, ["pattern", "of"])
                  .join(seeds.select("word"), "word", "left_anti").groupBy("word", "of")
                  .agg((1 - F.exp(F.sum(F.log(1.0 - F.least("sure", F.lit(1 - 1e-9)))))).alias("score"))
                  .where(F.col("score") >= accept))
        now = new.agg(F.count("*"), F.coalesce(F.round(F.sum("score"), 6), F.lit(0.0))).first()
        if now[0] == before[0] and abs(now[1] - before[1]) <= 1e-6 * max(1, now[0]):
            break
        before = tuple(now)
        score = first.unionByName(new)
    return new.groupBy("word").agg(F.max_by("of", F.struct("score", -F.col("of"))).alias("kind"))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (),
         **how) -> DataFrame:
    """One row per row of ``docs``: id, the ``keep`` columns, ``base`` and
    ``spans`` (all), arrays of ``struct<kind, start, end>`` ordered by kind as in
    ``KINDS``, then start.

    Null text counts as empty and has no spans; null ids and repeated rows are
    kept; other columns are ignored; an empty table gives an empty result.
    ``how`` goes to ``bootstrap``.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    kept = [F.col(k).alias(f"keep{i}") for i, k in enumerate(keep)]
    found = cut(docs.select(F.col(id_col).alias("id"), *kept, base_spans(text).alias("spans"),
                            identifier_words(text).alias("words")))
    accepted = cut(bootstrap(found.where(F.size("words") > 0), **how))
    out = [F.col("id").alias(id_col), *[F.col(f"keep{i}").alias(k) for i, k in enumerate(keep)]]
    if accepted.isEmpty():
        return found.select(*out, F.col("spans").alias("base"), "spans")

    # Rows with equal words have equal occurrences, so these are looked up by
    # the words; rows without any get keys of their own, spread by id.
    keyed = found.withColumn("key", F.when(F.size("words") > 0, F.sha2(F.to_json("words"), 256))
                             .otherwise(F.concat(F.lit("none "), F.xxhash64("id").cast("string"))))
    added = (keyed.where(F.size("words") > 0).select("key", F.explode("words").alias("w"))
             .select("key", "w.word", "w.start", "w.end").distinct().join(accepted, "word")
             .groupBy("key").agg(F.collect_list(F.struct("kind", "start", "end")).alias("added")))
    extra = F.filter(F.coalesce("added", F.array().cast(_SPAN)), lambda a: ~F.exists(
        "spans", lambda s: (s["start"] < a["end"]) & (s["end"] > a["start"])))
    return (keyed.join(added, "key", "left")
            .select(*out, F.col("spans").alias("base"), F.array_sort(F.concat("spans", extra)).alias("spans")))


def masked(text: Column, spans: Column) -> Column:
    """The text with every span, or run of overlapping ones, replaced by ``<kind>``."""
    names = F.array(*map(F.lit, KINDS))
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                                               s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))
    folded = F.aggregate(order, start, lambda a, s: F.struct(
        F.greatest(a["at"], s["end"]).alias("at"),
        F.when(s["start"] >= a["at"], F.concat(a["done"], F.substring(text, a["at"] + 1, s["start"] - a["at"]),
                                               F.lit("<"), F.get(names, s["kind"]), F.lit(">")))
        .otherwise(a["done"]).alias("done")))
    return _let(folded, lambda a: F.concat(a["done"], F.substring(text, a["at"] + 1, F.char_length(text))))


def mask(docs: DataFrame, text_col: str = "text", broadcast_spans: int = 500_000, **how) -> DataFrame:
    """``docs`` with the spans found in each text masked; all columns stay.

    Null texts stay null.  Spans depend on the text alone, so they are joined
    by its digest: broadcast while texts and spans number ``broadcast_spans`` at
    most, by a shuffle beyond.
    """
    digest = F.sha2(F.col(text_col).cast("binary"), 256)
    found = find(docs.select(F.col(text_col), digest.alias("d")), id_col="d", text_col=text_col, **how)
    some = cut(found.where((F.size("spans") > 0) & F.col("d").isNotNull())
               .groupBy(F.col("d").alias("digest of the text")).agg(F.first("spans").alias("spans of the text")))
    size = some.agg(F.count("*") + F.coalesce(F.sum(F.size("spans of the text")), F.lit(0))).first()[0]
    if size <= broadcast_spans:
        some = F.broadcast(some)
    new = F.when(F.col("spans of the text").isNull(), F.col(text_col)).otherwise(
        masked(F.col(text_col), F.col("spans of the text")))
    return (docs.join(some, digest == F.col("digest of the text"), "left")
            .select(*[new.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]))


def as_string(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def counts(spans: Column) -> list[Column]:
    return [F.size(F.filter(spans, lambda s: s["kind"] == i)).cast("bigint").alias(f"n_{k}")
            for i, k in enumerate(KINDS)]
