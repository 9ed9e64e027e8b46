"""URL parts, listed rules and mined rules."""

import random
import re

from pyspark.sql import functions as F

from sluice.llm.url_rules import judge, listed, mine

RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host):])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def by_list(url):
    h, p = parts(url)
    fit = [(len(rh + rp), rh + rp, v) for v, rh, rp in RULES if (h == rh or h.endswith("." + rh)) and p.startswith(rp)]
    return max(fit)[1:] if fit else (None, None)


URLS = [None, "", "no scheme", "https://A.Example.NET/en/x?y=http://z", "http://net/", "http://xnet/", "http://x.net", "s://example.com/de/",
        "a://b://c/d", "http://é.Org/fr/É#f", "http://x.org/fr", "http://sub.example.com/de/1?q#", "://example.net/en/", "http://h\n.net/a\nb"]


def test_parts_and_listed_rules(spark):
    pages = spark.createDataFrame([(i, u, 1) for i, u in enumerate(URLS)] + [(None, URLS[3], 1), (3, URLS[3], 1)],
                                  "page_id bigint, url string, host int")
    none = mine(pages.select("url", F.lit(None).cast("boolean").alias("bad")))
    for r in judge(pages, none, RULES).collect():
        url = URLS[3 if r.page_id is None else r.page_id]
        rule, verdict = by_list(url)
        assert (r.host, r.path, r.rule, r.verdict) == (*parts(url), rule, verdict or "allow")
    assert judge(pages.limit(0), none, RULES).collect() == []


def test_mined_rules_block_what_labels_show(spark):
    rnd = random.Random(1)
    rows = []
    for i in range(800):
        bad = rnd.random() < 0.3
        word = rnd.choice(["casino", "pills"]) if bad and rnd.random() < 0.9 else rnd.choice(["news", "blog", "shop"])
        lang = rnd.choice(["en", "de"])
        rows.append((f"https://{word}.example{i % 40}.org/{lang}/{i}?utm={i}", bad))
    mined = mine(spark.createDataFrame(rows, "url string, bad boolean"), least_support=0.02, least_confidence=0.9)
    rules = mined.collect()
    assert {r["items"][0] for r in rules} >= {"label=casino", "label=pills"}
    assert all(r.confidence >= 0.9 and r.support >= 0.02 for r in rules)
    for r in rules:  # nothing that a shorter rule says as surely
        assert not any(set(s["items"]) < set(r["items"]) and s.confidence >= r.confidence for s in rules)
    held_out = [(i, f"http://{w}.other.org/en/") for i, w in enumerate(["casino", "news", "pills", "blog"])]
    pages = spark.createDataFrame([(i, u) for i, u in held_out], "page_id bigint, url string")
    for n in (0, 10**6):
        got = {r.page_id: r.verdict for r in judge(pages, mined, RULES, broadcast_rows=n).collect()}
        assert got == {0: "block", 1: "allow", 2: "block", 3: "allow"}


def test_longest_rule_wins(spark):
    df = spark.createDataFrame([(u,) for u in URLS if u], "u string")
    got = df.select("u", listed(F.lit("a.example.net"), F.lit("/en/b"), RULES).alias("r")).first().r
    assert (got.rule, got.verdict) == ("example.net/en/", "allow")


def test_no_rule_rests_on_a_few_rows(spark):
    rows = [(f"https://w{i}.example.org/a{i}/", i % 3 == 0) for i in range(90)]
    rows += [("https://four.example.org/x/", True)] * 4
    assert "label=four" not in {t for r in mine(spark.createDataFrame(rows, "url string, bad boolean")).collect() for t in r["items"]}
    rows += [("https://four.example.org/x/", True)]
    assert "label=four" in {t for r in mine(spark.createDataFrame(rows, "url string, bad boolean")).collect() for t in r["items"]}


def test_mined_rules_match_a_plain_miner(spark):
    """Every token set in its rows, on a small table."""
    from itertools import combinations
    from sluice.llm.url_rules import tokens
    rnd = random.Random(4)
    rows = [(f"https://{rnd.choice('abc')}.example.org/{rnd.choice('xy')}{'' if i % 2 else '/z'}?k={i}", rnd.random() < 0.6) for i in range(120)]
    df = spark.createDataFrame(rows, "url string, bad boolean")
    sets = [(frozenset(r.t), r.bad) for r in df.select(tokens(F.col("url")).alias("t"), "bad").collect()]
    n, count = len(sets), {}
    for held, bad in sets:
        for k in range(1, len(held) + 1):
            for c in combinations(sorted(held), k):
                a, b = count.get(c, (0, 0))
                count[c] = (a + 1, b + bad)
    good = {c: b / a for c, (a, b) in count.items() if b >= 5 and b / n >= 0.002 and b / a >= 0.6}
    want = {c for c in good if not any(set(d) < set(c) and good[d] >= good[c] for d in good)}
    assert {tuple(sorted(r["items"])) for r in mine(df).collect()} == want
