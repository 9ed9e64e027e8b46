"""Wrappers, and the main text they give."""

import html
import random
import re

from sluice.llm import html_extract as H

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()


def prose(n, seed):
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) for _ in range(n))


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, u, h, 1) for i, u, h in rows], "page_id bigint, url string, html string, main int")
    return H.extract(df, **kw).collect()


def semantic(s):
    return f"""<html><head><title>t</title><style>p{{x}}</style></head><body><header class="site"><h2>Daily {s}</h2></header>
<div id="cookie-notice">We use cookies</div><nav><ul><li><a>A{s}</a></li><li><a>B</a></li></ul></nav><main><article>
<header><h1>Title &amp; {s}</h1></header><p>{prose(30, s)}  <b>bold</b>
tail<div class="ad-slot">buy now</div><ul><li>one {s}<li>two</ul><form>name <input></form><aside>also</aside></article>
<section class="comments"><article><p>comment {s}</p></article></section></main><div class="sidebar"><p>{prose(60, s + 99)}
</p></div><footer>&copy; x</footer><script>x="<p>no</p>"</script></body></html>"""


def plain(s):
    return (f'<div id="top"><a>Home</a> <a>About</a></div><div class="wrap"><div class="post-body"><h1>T{s}</h1><p>{prose(60, s)}'
            f'<p>{prose(9, s + 1)}<br>more</div><div class="related"><p>see {prose(20, s)}</p></div></div><div id="footer">all</div>')


def test_article_of_a_semantic_template(spark):
    rows = [(s, f"http://a.org/{s}", semantic(s)) for s in range(5)]
    for r in run(spark, rows):
        s = r.page_id
        assert r.text.split("\n") == [f"Title & {s}", f"{prose(30, s)} bold tail", f"one {s}", "two"]
        assert r.n_chars == len(r.text) and r.url == f"http://a.org/{s}"


def test_container_without_article_and_mixed_templates(spark):
    rows = [(s, "http://b.org", plain(s)) for s in range(4)] + [(10 + s, "http://b.org", semantic(s)) for s in range(3)]
    got = {r.page_id: r.text for r in run(spark, rows, broadcast_rows=0)}
    for s in range(4):
        assert got[s] == f"T{s}\n{prose(60, s)}\n{prose(9, s + 1)} more"
    assert got[11].startswith("Title & 1\n")


def test_edge_pages(spark):
    rows = [(1, None, None), (2, "u", ""), (3, "http://x", "plain text &lt;only&gt;"), (None, "http://x", "<p>unclosed <b>x"),
            (5, "http://c", "<article>cut off &amp; <p>tex"), (5, "http://c", "<article>cut off &amp; <p>tex"),
            (6, "http://d", '<div class="ad">z<article><p>in</p></article>'), (7, "http://e", "<" * 3000 + "p>a</p>"),
            (8, "http://f", "<article>" + "<p>w</p>" * 20_000 + "</article>"), (9, "http://g", "<div>" * 3000 + "deep"),
            (10, "http://h", '<p title="a>b">q</p><p title="open>r</p>'), (11, "http://i", "<!-- <p>no</p> --><article>y")]
    got = {}
    for r in run(spark, rows):
        got.setdefault(r.page_id, []).append(r.text)
    assert got[1] == got[2] == [""] and got[3] == ["plain text <only>"] and got[None] == ["unclosed x"]
    assert got[5] == ["cut off &\ntex"] * 2 and got[6] == ["in"] and got[11] == ["y"]
    assert got[8] == ["\n".join("w" * 20_000)] and got[9] == ["deep"]
    assert run(spark, []) == []


def test_wrapper_is_a_union_free_expression():
    pages = ["<ul><li>a</li><li>b</li></ul><p>x</p>", "<ul><li>c</li></ul><h2>new</h2><p>x</p>", "<ul><li>d</li></ul><p>x</p>"]
    w = H.fold(pages[0])
    for p in pages[1:]:
        w = H.align(w, H.fold(p))
    assert H.expression(w) == "<ul>(<li>#</li>)+</ul>(<h2>new</h2>)?<p>x</p>"
    assert H.align(H.fold(pages[2]), H.fold(pages[2]))[0][:3] == ["<ul>", 0, 0]


def test_merging_partial_wrappers_gives_one_per_host(spark):
    rows = [(i, f"http://h{i % 3}/", semantic(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(12)
    got = H.infer_wrappers(df, fan_in=3).collect()
    assert sorted(r.host for r in got) == ["h0", "h1", "h2"]


def test_pages_table_against_its_article_markup(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    source = {r.page_id: r.html for r in df.collect()}
    for r in H.extract(df).collect():
        article = re.search(r"<article>(.*?)(</article>|$)", source[r.page_id], re.S)[1]
        blocks = re.split(r"</?(?:p|h1)\b[^>]*>", article)
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in blocks]
        assert r.text == "\n".join(b for b in blocks if b)


def test_template_text_of_an_article_is_left_out(spark):
    def page(s):
        return (f'<article><h1>T{s}</h1><p>By {prose(2, s)} <b>staff</b></p><p>{prose(40, s)}</p><p>{prose(30, s + 50)}</p>'
                f'<div class="more">Read <i>more</i></div><ul><li>{prose(3, s + 7)}</li><li>Follow us</li></ul></article>')

    rows = [(s, "http://a.org/", page(s)) for s in range(12)] + [(20 + s, "http://copies.org/", page(1)) for s in range(12)]
    for r in run(spark, rows):
        s = r.page_id if r.page_id < 20 else 1
        want = [f"T{s}", f"By {prose(2, s)} staff", prose(40, s), prose(30, s + 50)]
        if r.page_id < 20:
            assert r.text.split("\n") == [*want, prose(3, s + 7)]
        else:  # copies of one page show no template
            assert r.text.split("\n") == [*want, "Read more", prose(3, s + 7), "Follow us"]


def test_hosts_whose_tags_say_nothing_or_mislead(spark):
    def bare(s):
        return (f'<div class="x1"><a href="/">Home</a> <span>Menu of the site</span></div><div class="x2"><h2>T{s}</h2>'
                f'<div class="y">{prose(50, s)}</div><div class="y">{prose(40, s + 1)}</div><div class="z">Share this page</div></div>')

    def teaser(s):
        return (f'<article class="box"><p>Teaser {s}</p></article><div class="x2"><h2>T{s}</h2>'
                f'<p>{prose(90, s)}</p><p>{prose(80, s + 1)}</p></div>')

    got = {r.page_id: r.text for r in run(spark, [(s, "http://a.org", bare(s)) for s in range(9)] + [
        (20 + s, "http://b.org", teaser(s)) for s in range(9)])}
    for s in range(9):
        assert got[s] == f"T{s}\n{prose(50, s)}\n{prose(40, s + 1)}"
        assert got[20 + s] == f"Teaser {s}\nT{s}\n{prose(90, s)}\n{prose(80, s + 1)}"


def test_names_of_bodies_headings_and_paragraphs_do_not_drop_text(spark):
    def page(s, name):
        return (f'<body class="no-sidebar"><div class="page with-banner"><article class="{name}"><h2 id="search-results">T{s}</h2>'
                f'<p class="warning">{prose(30, s)}</p><div class="share">tell {prose(3, s)}</div></article></div></body>')

    names = ["post has-sidebar", "no-comments", "post related", "entry social"]
    rows = [(i, f"http://h{i}.org/", page(i, n)) for i, n in enumerate(names)]
    rows += [(10, "http://c.org/", '<article><p>in</p><article class="comment"><p>reply</p></article></article>')]
    got = {r.page_id: r.text for r in run(spark, rows)}
    assert all(got[i] == f"T{i}\n{prose(30, i)}" for i in range(4)) and got[10] == "in"


def test_links_in_sentences_stay(spark):
    def page(s):
        return (f'<div class="x"><ul><li><a href="/">Home {s}</a></li><li><a href="/n">News {s}</a></li></ul></div>'
                f'<div class="y"><h2>T{s}</h2><p>see <a href="/r">the report {s}</a> for {prose(30, s)}</p>'
                f'<p>{prose(20, s + 1)} <a class="r" href="/q">and <b>more</b> {s}</a></p></div>')

    for r in run(spark, [(s, "http://a.org", page(s)) for s in range(6)] + [(50 + s, f"http://b{s}.org", page(s)) for s in range(2)]):
        s = r.page_id % 50
        assert r.text == f"T{s}\nsee the report {s} for {prose(30, s)}\n{prose(20, s + 1)} and more {s}"


def test_white_space_between_inline_elements():
    page = "<html><body><article><p><b>Hello</b> <i>world</i> and <a>one</a> <a>two</a> end</p>\n<p> <b>x</b>y</p></article></body></html>"
    tokens = list(H.stream(page))
    texts = [" ".join("".join(tokens[i][2] if tokens[i][0] == "#" else " " for i in b).split()) for b in H.blocks(tokens)]
    assert texts == ["Hello world and one two end", "xy"]


def test_names_inside_an_article(spark):
    """A name drops a part of an article only if all of it names furniture."""
    page = ("<html><body><article><h1>Head line of this page</h1><p>First paragraph of the text, long enough.</p>"
            "<div class='share-price-table'><p>Prices rose.</p></div><section class='search-engines'><p>Engines differ.</p></section>"
            "<div class='share-buttons'>Tweet this</div><div class='comment-list'>Nice post</div><div class='related'>More</div></article></body></html>")
    df = spark.createDataFrame([(1, "http://h.example/1", page)], "page_id bigint, url string, html string")
    assert H.extract(df).first().text == (
        "Head line of this page\nFirst paragraph of the text, long enough.\nPrices rose.\nEngines differ.")
