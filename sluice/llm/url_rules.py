"""URL filter by association rules.

Labelled URLs become transactions of URL tokens plus their class; Spark's
FP-growth mines the frequent combinations, and those whose rule "tokens imply
bad" reaches the support and confidence asked for, and gains on every shorter
kept rule inside it, stay.  Rules are filed in an inverted index under one of their
tokens; a URL looks up its tokens there and is blocked when it holds all tokens of a
rule found.  Listed host and path rules come first: of those that fit, the
longest decides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import cut

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BAD = "class=bad"


def host(url: Column) -> Column:
    """From after the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens(url: Column) -> Column:
    """Distinct tokens: scheme, every host suffix and label, path words without
    digits, path endings and query keys."""
    labels = F.filter(F.split(host(url), r"\."), lambda x: x != "")
    suffixes = F.transform(labels, lambda _, i: F.concat(F.lit("host="), F.array_join(
        F.slice(labels, i + 1, F.size(labels)), ".")))
    words = F.filter(F.split(F.lower(path(url)), "/"), lambda x: (x != "") & ~x.rlike("[0-9]"))
    ending = F.regexp_extract(path(url), r"\.([A-Za-z0-9]{1,8})/?$", 1)
    query = F.filter(F.split(F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1), "&"), lambda x: x != "")
    named = F.concat(
        F.array(F.concat(F.lit("scheme="), F.lower(F.regexp_extract(url, "^([A-Za-z]+)://", 1)))), suffixes,
        F.transform(labels, lambda x: F.concat(F.lit("label="), x)),
        F.transform(words, lambda x: F.concat(F.lit("path="), x)),
        F.when(ending != "", F.array(F.concat(F.lit("ending="), F.lower(ending)))).otherwise(F.array().cast("array<string>")),
        F.transform(query, lambda x: F.concat(F.lit("key="), F.lower(F.substring_index(x, "=", 1)))))
    return F.when(url.contains("://"), F.array_distinct(named)).otherwise(F.array().cast("array<string>"))


def mine(labelled: DataFrame, url_col: str = "url", bad_col: str = "bad", least_support: float = 0.002,
         least_confidence: float = 0.6, least_rows: int = 5) -> DataFrame:
    """Rules ``(items, support, confidence)`` that imply a bad URL.

    ``labelled`` has a URL and a boolean; rows with a null in either take no
    part.  A rule holds for ``least_support`` of the rows and for ``least_rows`` of
    them, so a small table gives no rules that rest on a row or two.  A rule is dropped when a kept rule over some of its tokens is at
    least as confident.  No labelled rows give no rules.
    """
    rows = cut(labelled.where(F.col(url_col).isNotNull() & F.col(bad_col).isNotNull()).select(
        F.concat(tokens(F.col(url_col)), F.when(F.col(bad_col), F.array(F.lit(BAD)))
                 .otherwise(F.array().cast("array<string>"))).alias("items")).where(F.size("items") > 0))
    empty = labelled.sparkSession.createDataFrame([], "items array<string>, support double, confidence double")
    n = rows.count()
    if n < least_rows:
        return empty
    support = max(least_support, (least_rows - 0.5) / n)
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=least_confidence).fit(rows)
    rules = (model.associationRules.where(F.size("consequent") == 1).where(F.col("consequent")[0] == BAD)
             .select(F.array_sort("antecedent").alias("items"), "support", "confidence"))
    rules = cut(rules)
    # A longer rule must gain on every rule inside it; candidates share a token.
    part = rules.select(F.col("items").alias("i2"), F.col("confidence").alias("c2"), F.explode("items").alias("t"))
    own = rules.select("items", "support", "confidence", F.explode("items").alias("t"))
    beaten = (own.join(part, "t").where((F.size("i2") < F.size("items")) & (F.col("c2") >= F.col("confidence")))
              .where(F.size(F.array_except("i2", "items")) == 0).select("items").distinct())
    return rules.join(beaten, "items", "left_anti")


def listed(h: Column, p: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """``struct(rule, verdict)`` of the longest listed rule (verdict, host, path)
    that fits, null if none.  The list is a parameter of a few entries."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1:], r[0])):
        fits = ((h == rule_host) | h.endswith("." + rule_host)) & p.startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))) \
               .otherwise(out)
    return out


def judge(pages: DataFrame, mined: DataFrame, rules: Sequence[tuple[str, str, str]], id_col: str = "page_id",
          url_col: str = "url", broadcast_rows: int = 100_000) -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule, verdict.

    A null URL, or one without ``://``, has empty host and path, no tokens and is
    allowed.  Null ids and repeated rows are kept; other columns are ignored;
    an empty table gives an empty result.  ``broadcast_rows``: an index up to
    this length is broadcast, a longer one joined by a shuffle.
    """
    url = F.col("url")
    src = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    index = cut(mined.select(F.array_max("items").alias("token"), "items"))
    n = index.count()
    if n:
        held = src.select("url", tokens(url).alias("held")).select("url", "held", F.explode("held").alias("token"))
        hit = (held.join(F.broadcast(index) if n <= broadcast_rows else index, "token")
               .where(F.size(F.array_except("items", "held")) == 0).select("url").distinct().withColumn("hit", F.lit(True)))
        src = src.join(hit, "url", "left")
    else:
        src = src.withColumn("hit", F.lit(False))
    rule = listed(F.col("host"), F.col("path"), rules)
    return (src.select("id", host(url).alias("host"), path(url).alias("path"), "hit")
            .withColumn("listed", rule)
            .select(F.col("id").alias(id_col), "host", "path", F.col("listed.rule").alias("rule"),
                    F.coalesce("listed.verdict", F.when(F.col("hit"), "block").otherwise("allow")).alias("verdict")))
