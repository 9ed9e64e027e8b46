"""Main text of web pages by wrappers inferred per host.

A page is a stream of tags and texts.  Repeats in the stream are folded into
groups, and the streams of one host are aligned one after another into a
union-free regular expression: what all pages have stays, what some lack
becomes optional, folded groups become repeated, and texts that differ become
slots.  Every slot knows the path of open elements around it, how much text and
link text it holds over all pages of the host, and on how many pages its
blocks of text recur.  The wrapper's slots are then sorted into main text and
page furniture, once per host: names of elements only say where to look first,
the text that varies says whether it is there, and blocks that recur on nearly
all pages are template.  Each page gives the other blocks of its main slots.

Tasks align their own pages; the partial wrappers of a host (one per task) are
merged in rounds of bounded fan-in, so a host with a third of all pages never
meets in one task.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import cut, slices, small_batches

_MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:"[^"]*"|'[^']*'|[^>"'])*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)""",
    re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_RAW = {t: re.compile(rf"</{t}\b", re.I) for t in
        ("script", "style", "title", "textarea", "noscript", "template", "iframe", "xmp")}
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small "
                    "span strike strong sub sup time tt u var wbr".split())
_HIDDEN = frozenset("head script style title textarea noscript template iframe xmp select option button svg canvas "
                    "object audio video map math datalist".split())
_FURNITURE = frozenset("nav footer aside form menu dialog fieldset".split())
#: Words of class, id and role that name furniture; those of ``_TOP`` do so outside an article only.
_WORDS = frozenset("ad ads adbox adslot advert advertisement advertising adverts alert banner breadcrumb breadcrumbs "
                   "comment commentlist comments complementary consent contentinfo cookie cookies copyright dialog "
                   "disqus feedback footer form gdpr login menu modal nav navbar navigation newsletter notice notices "
                   "overlay pager pagination popup promo promoted promotion recommendations recommended related "
                   "replies reply respond responses search share sharing sidebar signup skip social sponsor sponsored "
                   "sponsors subscribe subscription toolbar tooltip trending warning".split())
_TOP = frozenset("header masthead topbar widget widgets".split())
_BODY = frozenset("article articlebody articlecontent content entry main post postcontent story storybody text".split())
#: Parts of names that add nothing to a word of ``_WORDS``.
_FILLER = frozenset("area bar block bottom box button buttons count container cta footer form group head header icon "
                    "icons inner item items left link links list module outer panel post posts right row section "
                    "side stories story title tools top user widget wrap wrapper".split())
#: Names that say what an element has or lacks, not what it is.
_STATE = re.compile(r"(?<![a-z0-9])(?:has|no|not|non|with|without|hide)[-_][a-z0-9_-]+")
_PROSE = frozenset("p h1 h2 h3 h4 h5 h6".split())
_CLOSES = {"li": ("li", {"ul", "ol", "menu"}), "dt": ("dt dd", {"dl"}), "dd": ("dt dd", {"dl"}),
           "tr": ("tr td th", {"table"}), "td": ("td th", {"tr", "table"}), "th": ("td th", {"tr", "table"}),
           "option": ("option", {"select"})}
_SCOPE = frozenset("article aside body div footer form header main nav section table td th blockquote li".split())


@lru_cache(maxsize=50_000)
def _label(tag: str, attributes: str) -> str:
    found = {m[1].lower(): m[2].strip("\"'") for m in _ATTRIBUTE.finditer(attributes)} if "=" in attributes else {}
    named = [re.sub(r"\d+", "9", " ".join(found[k].lower().split())) for k in ("class", "id", "role", "itemprop")
             if k in found]
    return ".".join([tag, *(n.replace("/", "-").replace(".", "-") for n in named if n)])


def _furniture_in_article(named: list[str]) -> bool:
    """Inside an article a name makes furniture only if all of it does:
    ``share-buttons``, and not ``share-price-table``."""
    parts = [set(filter(None, re.split("[^a-z0-9]+", token))) for n in named for token in _STATE.sub(" ", n).split()]
    return any(p & _WORDS and p <= _WORDS | _FILLER for p in parts)


@lru_cache(maxsize=100_000)
def _kind(path: str) -> tuple[bool, str]:
    """Whether the path lies in page furniture, and its innermost text body
    ("" if none): the path up to an article, a main element or the like."""
    at, body, rank = [], "", 0
    for label in path.split("/"):
        at.append(label)
        tag, *named = label.split(".")
        words = {w for n in named for w in re.split("[^a-z0-9]+", _STATE.sub(" ", n))}
        in_article = rank >= 2
        if tag in _HIDDEN or tag in _FURNITURE or (tag == "header" and not in_article):
            return True, ""
        mine = (3 if tag == "article" or "articlebody" in words else 2 if tag == "main" or "main" in words else
                1 if words & _BODY and tag not in ("html", "body") else 0)
        # Names do not make furniture of a page, of its text body, of headings and paragraphs.
        is_body = tag in ("html", "body", "main") or tag == "article" and rank < 3 or "articlebody" in words
        if not is_body and tag not in _PROSE and (_furniture_in_article(named) if in_article else words & (_WORDS | _TOP)):
            return True, ""
        if mine > rank:
            body, rank = "/".join(at), mine
    return False, f"{rank}:{body}" if rank else ""


def stream(page: str) -> Iterator[tuple[str, str, str]]:
    """``(token, path, text)``: an element's start or end (path ""), or a text.

    White space between inline elements goes to the text that follows in the block."""
    stack: list[tuple[str, str]] = []
    paths = [""]
    at, size, gap = 0, len(page), False

    def pop_to(i: int) -> None:
        del stack[i:]
        del paths[i + 1:]

    while at < size:
        m = _MARKUP.search(page, at)
        start = m.start() if m else size
        if start > at:
            text = page[at:start]
            if text.isspace():
                gap = True
            else:
                yield "#", paths[-1], " " + text if gap else text
                gap = False
        if not m:
            return
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if tag not in _INLINE and tag not in _RAW:
            gap = False
        if m[1]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    pop_to(i)
                    yield f"</{tag}>", "", ""
                    break
                if tag in _INLINE and stack[i][0] in _SCOPE:
                    break
            continue
        if tag in _RAW:
            end = _RAW[tag].search(page, at)
            at = end.start() if end else size
            if end and (close := page.find(">", at)) >= 0:
                at = close + 1
            continue
        if tag not in _INLINE:  # a block ends an open paragraph
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p":
                    pop_to(i)
                    break
                if stack[i][0] in _SCOPE:
                    break
        if tag in _CLOSES:
            names, stop = _CLOSES[tag]
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in stop:
                    break
                if stack[i][0] in names.split():
                    pop_to(i)
                    if tag != "tr" or i == 0 or stack[i - 1][0] not in ("tr",):
                        break
        if tag in ("article", "main"):  # furniture that nothing closes ends here
            for i, (open_tag, _) in enumerate(stack):
                if _kind(paths[i + 1])[0]:
                    rest = page[at:].lower()
                    more = rest.count(f"</{open_tag}>") - len(re.findall(rf"<{open_tag}[\s>]", rest))
                    if more < sum(t == open_tag for t, _ in stack):
                        pop_to(i)
                    break
        label = _label(tag, m[3])
        if tag not in _VOID and not m[3].endswith("/"):
            stack.append((tag, label))
            plain = tag in _INLINE and tag != "a" and "." not in label
            paths.append(paths[-1] if plain else f"{paths[-1]}/{label}" if paths[-1] else label)
        yield f"<{label}>", "", ""


# A wrapper is a list of entries [token, optional, repeated, literal, pages,
# chars, link chars, blocks]; a text's token is "#" and its path, its literal null
# when texts differ, its blocks the pages of each block (a hash) that starts there.
Wrapper = list[list]


def blocks(tokens: list[tuple[str, str, str]]) -> Iterator[list[int]]:
    """Places of the texts (and line breaks between them) of every block."""
    block: list[int] = []
    for i, (token, _, _) in enumerate(tokens):
        if token == "#":
            block.append(i)
        elif token == "<br>" or token.startswith("<br."):
            if block:
                block.append(i)
        elif block and token.strip("</>").split(".")[0] not in _INLINE:
            yield block
            block = []
    if block:
        yield block


def hashed(tokens: list[tuple[str, str, str]], block: list[int]) -> str:
    text = "".join(tokens[i][2] if tokens[i][0] == "#" else " " for i in block)
    return xxhash.xxh3_64_hexdigest(" ".join(text.split()).encode("utf-8", "surrogatepass"))


def fold(page: str, longest: int = 12) -> Wrapper:
    """A page as a wrapper: adjacent repeats of up to ``longest`` tokens become one."""
    out: Wrapper = []
    keys: list[str] = []
    tokens = list(stream(page))
    starts_at = {b[0]: hashed(tokens, b) for b in blocks(tokens)}
    for i, (token, path, text) in enumerate(tokens):
        if token == "#":
            text = " ".join(text.split())
            entry = [f"#{path}", 0, 0, text if len(text) <= 200 else None, 1, len(text),
                     len(text) if "/a" in path and re.search(r"/a(/|\.|$)", path) else 0,
                     {starts_at[i]: 1} if i in starts_at else {}]
        else:
            entry = [token, 0, 0, None, 1, 0, 0, {}]
        out.append(entry)
        keys.append(entry[0])
        n = len(keys)
        for size in range(1, min(longest, n // 2) + 1):
            if keys[-1] == keys[-1 - size] and keys[n - size:] == keys[n - 2 * size:n - size]:
                group = keys[n - size:]
                starts = [k for k in group if k[0] == "<" and k[1] != "/"]
                if not any(k[0] == "#" for k in group) and len(starts) in (0, size) and not any(
                        k.strip("<>").split(".")[0] in _VOID for k in starts):
                    break  # elements nested in their like, not a repeat
                for a, b in zip(out[n - 2 * size:n - size], out[n - size:]):
                    a[2] = 1
                    a[3] = a[3] if a[3] == b[3] else None
                    a[5] += b[5]
                    a[6] += b[6]
                    a[7] |= b[7]
                del out[n - size:]
                del keys[n - size:]
                break
    return out


def recurring(p: list, q: list) -> dict[str, int]:
    """Pages of the blocks of two slots, without blocks that most pages lack."""
    if not p[7] or not q[7]:
        both = p[7] or q[7]
    else:
        both = {t: p[7].get(t, 0) + q[7].get(t, 0) for t in p[7] | q[7]}
    return {t: n for t, n in both.items() if 2 * n >= p[4] + q[4]} if both else {}


def align(a: Wrapper, b: Wrapper) -> Wrapper:
    """One wrapper for the pages of both: tokens of one side only are optional."""
    ka, kb = [e[0] for e in a], [e[0] for e in b]
    if ka == kb:
        blocks = [(0, 0, len(ka))]
    else:
        blocks = SequenceMatcher(None, ka, kb, autojunk=False).get_matching_blocks()
    out: Wrapper = []
    i = j = 0
    for x, y, n in [*blocks, (len(a), len(b), 0)]:
        out += [[e[0], 1, *e[2:]] for e in (*a[i:x], *b[j:y])]
        out += [[p[0], p[1] | q[1], p[2] | q[2], p[3] if p[3] == q[3] else None, p[4] + q[4], p[5] + q[5], p[6] + q[6],
                 recurring(p, q)] for p, q in zip(a[x:x + n], b[y:y + n])]
        i, j = x + n, y + n
    return out


def expression(wrapper: Wrapper) -> str:
    """The wrapper as text: ``(...)?`` optional, ``(...)+`` repeated, ``#`` a slot."""
    out, mark = [], ""
    for token, optional, repeated, literal, *_ in [*wrapper, ["", 0, 0, None]]:
        now = {(0, 0): "", (1, 0): "?", (0, 1): "+", (1, 1): "*"}[optional, repeated]
        if now != mark or not token:
            out += [f"){mark}"] * bool(mark) + ["("] * bool(now)
            mark = now
        out.append(literal if literal is not None else "#" if token.startswith("#") else token)
    return "".join(out)


def block_path(path: str) -> str:
    """The path up to the block element that a text stands in."""
    parts = path.split("/")
    while len(parts) > 1 and parts[-1].split(".")[0] in _INLINE:
        parts.pop()
    return "/".join(parts)


def main_paths(wrapper: Wrapper) -> list[list[str]]:
    """Paths of the slots that hold main text, by template: those in an article,
    those in a main element, and those of the container with most varying text
    outside links.  A page takes the first list that it has text for.

    An article or main element counts as far as the pages bear it out: where its
    slots vary by less than a quarter of what the container does a page, it
    is a teaser or a frame, and the container joins it."""
    slots: dict[str, list[int]] = {}
    seen: dict[str, int] = {}
    for token, _, _, literal, pages, chars, links, _ in wrapper:
        if token.startswith("#"):
            s = slots.setdefault(token[1:], [0, 0, 0])
            s[0] += chars
            s[1] += links
            s[2] += chars if literal is not None and pages > 2 else 0
            seen[token[1:]] = max(seen.get(token[1:], 0), pages)
    kinds = {p: _kind(p) for p in slots}
    free = [p for p in slots if not kinds[p][0]]
    levels = [sorted(p for p in free if kinds[p][1][:1] == rank) for rank in "32"]
    free = [p for p in free if kinds[p][1][:1] not in ("3", "2")]
    rank = "1" if any(kinds[p][1] for p in free) else ""
    weight: dict[str, int] = {}
    block: dict[str, list[int]] = {}  # a link's text counts with the block around it
    for p in free:
        b = block.setdefault(block_path(p), [0, 0, 0])
        b[:] = map(sum, zip(b, slots[p]))
    prose = [p for p in free if block[block_path(p)][0] > 2 * block[block_path(p)][1]]
    for p, (chars, links, fixed) in block.items():
        parts = p.split("/")
        for i in range(1, len(parts)):
            if parts[i - 1].split(".")[0] not in _INLINE | {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol"}:
                c = "/".join(parts[:i])
                weight[c] = weight.get(c, 0) + max(0, chars - 2 * links - fixed)
    if not weight:
        return [*levels, sorted(prose)]
    named = {c: w for c, w in weight.items() if rank and any(kinds[p][1] == f"{rank}:{c}" for p in free)}
    most = max(weight.values())
    named = {c: w for c, w in named.items() if 2 * w >= most}
    # The innermost container that still holds nearly all of it.
    best = max(named or {c: w for c, w in weight.items() if 10 * w >= 9 * most}, key=lambda c: (c.count("/"), weight[c], c))
    inside = sorted(p for p in prose if p == best or p.startswith(best + "/"))

    def varying(paths: list[str]) -> float:
        """Characters a page outside links and literals."""
        return sum(max(0, slots[p][0] - slots[p][1] - slots[p][2]) for p in paths) / max([1, *(seen[p] for p in paths)])

    thin = [bool(paths) and 4 * varying(paths) < varying(inside) for paths in levels]
    return [*(sorted({*paths, *inside}) if t else paths for paths, t in zip(levels, thin)), inside]


def template(wrapper: Wrapper, share: float = 0.9, least: int = 3, least_repeated: int = 8) -> list[list[str]]:
    """Path and hash of the blocks that recur on ``share`` of the pages that have
    the text body they lie in.  ``least`` such pages must bear it out, and
    ``least_repeated`` for a block in a repeated group, whose slot varies."""
    held: dict[str, int] = {}
    for e in wrapper:
        held[e[0]] = max(held.get(e[0], 0), e[4])
    most = max(held.values(), default=0)
    found: dict[tuple[str, str], list[int]] = {}
    for token, _, repeated, _, _, _, _, texts in wrapper:
        for text, n in texts.items():
            f = found.setdefault((token[1:], text), [0, 0])
            f[0] += n
            f[1] |= repeated
    out = []
    for (path, text), (n, repeated) in sorted(found.items()):
        body = _kind(path)[1][2:]
        pages = held.get(f"<{body.rsplit('/', 1)[-1]}>", most) if body else most
        if pages >= (least_repeated if repeated else least) and n >= share * pages:
            out.append([path, text])
    return out


def main_text(page: str, levels: list[frozenset[str]], fixed: frozenset[tuple[str, str]] = frozenset()) -> str:
    """Blocks of the main slots, references decoded, white space made one space.

    ``fixed`` blocks (path and hash) are left out, unless they are most of the
    page's main text: then its pages are copies, which show no template."""
    tokens = list(stream(page))
    held = {path for token, path, _ in tokens if token == "#"}
    main = next((paths for paths in levels if paths & held), frozenset())
    every: list[str] = []
    own: list[str] = []
    for b in blocks(tokens):
        kept = [i for i in b if tokens[i][0] != "#" or tokens[i][1] in main]
        if text := " ".join(html.unescape("".join(tokens[i][2] if tokens[i][0] == "#" else " " for i in kept)).split()):
            every.append(text)
            if not fixed or (tokens[b[0]][1], hashed(tokens, b)) not in fixed:
                own.append(text)
    return "\n".join(own if 2 * sum(map(len, own)) >= sum(map(len, every)) else every)


def _infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One wrapper per host of the task's pages."""
    wrappers: dict[str, Wrapper] = {}
    for batch in slices(batches):
        for host, page in zip(batch.column("host").to_pylist(), batch.column("html")):
            folded = fold(page.as_py() or "")
            old = wrappers.get(host)
            wrappers[host] = align(old, folded) if old is not None else folded
        if len(wrappers) > 2000:  # many hosts: hand them on, merged later
            yield _wrapped(wrappers)
            wrappers = {}
    yield _wrapped(wrappers)


def _wrapped(wrappers: dict[str, Wrapper]) -> pa.RecordBatch:
    part = TaskContext.get().partitionId()
    return pa.RecordBatch.from_arrays(
        [pa.array(wrappers, pa.string()), pa.array([part] * len(wrappers), pa.int64()),
         pa.array([json.dumps(w) for w in wrappers.values()], pa.string())], names=["host", "part", "wrapper"])


def _merge(rows: pd.DataFrame) -> pd.DataFrame:
    out: Wrapper = []
    for i, w in enumerate(sorted(rows["wrapper"])):
        out = align(out, json.loads(w)) if i else json.loads(w)
    return pd.DataFrame({"host": [rows["host"].iloc[0]], "part": [rows["group"].iloc[0]], "wrapper": [json.dumps(out)]})


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def infer_wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html", fan_in: int = 32) -> DataFrame:
    """``(host, wrapper)``: one row per host, the wrapper as JSON entries."""
    schema = "host string, part bigint, wrapper string"
    found = cut(pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
                .mapInArrow(_infer, schema))
    while True:
        most = found.groupBy("host").count().agg(F.max("count")).first()[0] or 0
        if most <= 1:
            return found.select("host", "wrapper")
        groups = -(-most // fan_in)
        found = cut(found.withColumn("group", F.pmod("part", F.lit(groups)))
                    .groupBy("host", "group").applyInPandas(_merge, schema))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str | None, tuple[list[frozenset[str]], frozenset[tuple[str, str]]]] = {}
    for batch in slices(batches):
        texts = []
        for page, main in zip(batch.column("html"), batch.column("main")):
            key = main.as_py()
            if key not in known:
                if len(known) > 10_000:
                    known.clear()
                levels, fixed = json.loads(key or "[[], []]")
                known[key] = [frozenset(paths) for paths in levels], frozenset(map(tuple, fixed))
            texts.append(main_text(page.as_py() or "", *known[key]))
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(texts, pa.string())],
                                         names=["id", "url", "text"])


def _classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        wrappers = map(json.loads, batch.column("wrapper").to_pylist())
        main = [json.dumps([main_paths(w), template(w)]) for w in wrappers]
        yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(main, pa.string())], names=["host", "main"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            broadcast_rows: int = 20_000) -> DataFrame:
    """One row per row of ``pages``: id, url, text, n_chars.

    Null html counts as empty and has empty text.  A null URL, or one without
    ``://``, belongs to the host "".  Null ids and repeated rows are kept; other
    columns are ignored; an empty table gives an empty result.
    ``broadcast_rows``: slot lists (one short row per host) up to this many are
    broadcast, more are joined by a shuffle.
    """
    src = small_batches(pages).select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
                       F.col(html_col).cast("string").alias("html"))
    slots = cut(infer_wrappers(src).mapInArrow(_classify, "host string, main string"))
    if slots.count() <= broadcast_rows:
        slots = F.broadcast(slots)
    kind = src.schema["id"].dataType.simpleString()
    joined = src.withColumn("host", host_of(F.col("url"))).join(slots, "host", "left")
    out = joined.select("id", "url", "html", "main").mapInArrow(_extract, f"id {kind}, url string, text string")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text",
                      F.char_length("text").cast("bigint").alias("n_chars"))
