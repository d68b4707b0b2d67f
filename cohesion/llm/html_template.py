"""Main text of web pages, by removing each site's template.

Every element subtree of a page is hashed (tag, class, id and text below it, white
space aside). Counting the hashes per host in Spark shows which subtrees recur on
many pages of that host: those are its template and are deleted. What remains of the article (``article`` or ``main``; without
one, of the body) is cut into blocks of text. That is the rule for a host of any size: counts only delete.

Inside an article an unmarked element is template if it is on most pages of its host: a sentence that some articles share is text of
theirs. Paragraphs, lists and other text blocks of the article, or of a page without one, are
template only if they recur in the same place; elsewhere a shared passage is text of
its pages. Headings go only with what follows them.

Two rules stand beside the counts. Elements that are furniture by their tag go on
every page, also on a host with too few pages to count, and so do those with a mark:
a word of their class, id or role that menus, footers, sidebars, notices, adverts and
comments have. A mark never drops html, body, article, main or what holds an article
or main. Inside the article, and on text blocks and wrappers of a page without one, it
only makes an element a candidate that the counts decide on. Reader comments differ from page to page, so no count shows them: an
area after the article's text goes if its class or id says so, or if it has parts of one shape, each with an author or a date, under
a heading that names comments.

Null html counts as empty and gives the empty text; a null or malformed url
counts as one host without a name. Pages of a host with equal html are one page,
whatever their urls, and share one result. An empty table gives no rows; extra columns are ignored. Unclosed and stray tags are closed as browsers do for the usual cases.
"""

from __future__ import annotations

import html as entities
import re
from urllib.parse import urlsplit

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, cut
from .near import join_per_key, key_filter, may_hold

#: A subtree is template if it is on at least this many pages of a host, or on log2 of the host's pages if that is more.
MIN_PAGES = 5

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
WORD = re.compile(r"[a-z0-9]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
#: Never text, wherever they are.
DROPPED = frozenset("script style head title template noscript iframe object embed svg math canvas audio video map select option datalist "
                    "button input textarea form nav footer aside dialog menu noframes noembed xmp meter progress".split())
#: Words of a class, id or role that mark furniture.
MARKS = frozenset("ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar navigation menu menubar "
                  "breadcrumb breadcrumbs pagination pager footer sidebar aside rail widget widgets related recommended recommendations notice notices cookie "
                  "cookies consent gdpr alert popup modal overlay newsletter subscribe subscription signup login search share sharing social comment comments "
                  "disqus respond reply replies contentinfo complementary masthead toolbar skip hidden".split())
#: An id is a mark if all its words are marks or one of these; ids are also anchors of real text ("related-work").
PLACES = frozenset("left right top bottom main site page primary secondary global wrap wrapper container box block area bar inner outer col column".split())
#: Words of a class or id that mark reader comments; what holds them; parts that tell of who wrote one and when; how their heading begins.
COMMENTS = frozenset("comment comments commentlist comlist disqus respond replies responses discussion".split())
AREAS = frozenset("section div ol ul dl aside details".split())
SIGNED = frozenset("author user username commenter byline avatar nickname date time timestamp datetime published posted".split())
COMMENT_HEADING = re.compile(r"\s*(?:\d+\s+|no\s+|leave\s+a\s+)?(?:reader\s+|user\s+)?(?:comments?|responses?|replies|reply|discussion)\b", re.I)
CONTENT = ("article", "main")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Never template by themselves: roots, parts of a list or table, and what has no text.
PARTS = frozenset("#root html body article main br hr li dt dd thead tbody tfoot tr td th caption figcaption hgroup summary".split())
#: A marked element in the article is template if its text is on so many pages of the host.
MARKED_PAGES = 2
#: A part with more than this share of a page's text is its text, whatever its marks.
MOST = 2 / 3
BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre table thead tbody tfoot tr td th caption figure figcaption address hgroup details summary "
                   "div section article main header footer nav aside body html center fieldset form hr".split())
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre table thead tbody tfoot tr td th caption figure figcaption address hgroup".split())
ENDS_P = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure div section article main header footer nav aside form address hr details fieldset center".split())
#: An opening tag that closes an open element of these kinds, up to the nearest of the bounds.
CLOSES = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr",), ("table",)),
          "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "option": (("option",), ("select",))}


class Node:
    __slots__ = ("tag", "words", "children", "hidden", "dropped", "marked", "inside", "holds", "leaf", "size", "hash")

    def __init__(self, tag: str, words: tuple = (), hidden: bool = False, marked: bool = False):
        self.tag, self.words, self.children = tag, words, []
        self.hidden = hidden and tag not in ("html", "body")
        self.dropped = tag in DROPPED or self.hidden
        self.marked = marked and tag not in ("html", "body", *CONTENT)
        self.inside = self.holds = self.leaf = False
        self.size = self.hash = 0


def parse(source: str) -> Node:
    """The element tree; children are nodes and strings with references decoded."""
    root = Node("#root")
    stack, at, size = [root], 0, len(source)
    find = TOKEN.search
    while at < size:
        m = find(source, at)
        text = source[at:m.start() if m else size]
        if text:
            stack[-1].children.append(entities.unescape(text))
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if tag not in BLOCKS and stack[i].tag in BLOCKS:
                    break  # a stray end of an inline element does not end the block around it
            continue
        words, hidden, marked = (), False, False
        if m[3]:
            for name, a, b, c in ATTRIBUTE.findall(m[3]):
                if name.lower() == "hidden":
                    hidden = True
                elif name.lower() == "aria-hidden":
                    hidden |= (a or b or c).lower() == "true"
                else:
                    found = tuple(WORD.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", a or b or c).lower()))
                    words += found
                    marked |= not MARKS.isdisjoint(found) and (name.lower() != "id" or all(w in MARKS or w in PLACES or w.isdigit() for w in found))
        if tag in ENDS_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    del stack[i:]
                    break
                if stack[i].tag in BLOCKS:
                    break
        if tag in CLOSES:
            kinds, bounds = CLOSES[tag]
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in kinds:
                    del stack[i:]
                    break
                if stack[i].tag in bounds:
                    break
        node = Node(tag, words, hidden, marked)
        stack[-1].children.append(node)
        if tag in VOID or m[3].endswith("/") and tag not in BLOCKS and tag not in RAW:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(source, at)
            if tag == "noscript" or tag == "template" or end or tag in ("script", "style"):
                at = end.end() if end else size
            continue
        stack.append(node)
    return settle(root)


def settle(root: Node) -> Node:
    """Says of each element whether it is in an article or main, and whether its tag or mark alone drops it."""
    order, todo = [], [root]
    while todo:
        n = todo.pop()
        order.append(n)
        for c in n.children:
            if isinstance(c, Node):
                c.inside = n.inside or n.tag in CONTENT
                todo.append(c)
    for n in reversed(order):
        n.holds = n.tag in CONTENT
        for c in n.children:
            if isinstance(c, str):
                n.size += sum(map(len, c.split()))
            elif not c.dropped or c.tag == "form" and not c.hidden:
                n.size += c.size
                n.holds |= c.holds
    for n in order:
        most = n.size > MOST * root.size
        if n.tag == "form" and not n.hidden:
            n.dropped = not (n.holds or most and not n.inside)  # some sites wrap the whole page in a form
        elif n.marked and not n.dropped:
            n.dropped = not (n.holds or n.inside or n.tag in TEXT_BLOCKS and n.tag not in ("ul", "ol") or most and not root.holds)
    for n in comment_areas(root):
        n.dropped = True
    return root


def below(node: Node) -> list:
    """The elements and strings below an element, in page order, without what is dropped."""
    out, todo = [], list(reversed(node.children))
    while todo:
        n = todo.pop()
        out.append(n)
        if isinstance(n, Node) and not n.dropped:
            todo += reversed(n.children)
    return out


def is_comments(node: Node) -> bool:
    """Whether an element in an article is an area of reader comments, by its mark or its shape."""
    if node.tag not in AREAS:
        return False
    if not COMMENTS.isdisjoint(node.words):
        return True
    parts = [c for c in node.children if isinstance(c, Node) and not c.dropped]
    heading = next((c for c in parts if c.tag in HEADINGS), None)
    if heading is None or not COMMENT_HEADING.match("".join(x for x in below(heading) if isinstance(x, str))):
        return False
    rest = [p for c in parts if c is not heading for p in ([x for x in c.children if isinstance(x, Node)] if c.tag in ("ol", "ul") else [c])]
    signed = [(c.tag, c.words) for c in rest if any(isinstance(x, Node) and (x.tag == "time" or not SIGNED.isdisjoint(x.words)) for x in [c, *below(c)])]
    return bool(signed) and len(set(signed)) == 1


def comment_areas(root: Node) -> list[Node]:
    """The areas of comments of the articles: after text, with no more text after them than before."""
    out = []
    if not root.holds:
        return out
    for top in content(root):
        before, todo = 0, list(reversed(top.children))
        while todo:
            n = todo.pop()
            if isinstance(n, str):
                before += sum(map(len, n.split()))
            elif n.dropped:
                continue
            elif before and top.size - before - n.size <= before and is_comments(n):
                out.append(n)
                before += n.size
            else:
                todo += reversed(n.children)
    return out


def content(root: Node) -> list[Node]:
    """The article or main elements, outermost only; else the whole tree. Comments hold articles of their own in
    some templates, so furniture is not searched."""
    found, todo = [], [root]
    while todo:
        n = todo.pop()
        if n.tag in CONTENT:
            found.append(n)
        else:
            todo += [c for c in reversed(n.children) if isinstance(c, Node) and not c.dropped]
    return found or [root]


def candidates(root: Node, host: str) -> dict[int, int]:
    """id(element) -> hash on that host, of the elements with text that may be template. In the article, and on a page
    without one, a text block's hash holds its place: the tags above it, and how many elements are before or after it.
    Odd hashes are of marked elements in the article."""
    order, todo = [], [(root, 0, 0)]
    while todo:
        n, path, place = todo.pop()
        order.append((n, path, place))
        if n.tag in BLOCKS:
            path = xxhash.xxh64_intdigest(f"{path} {n.tag}")
        below = [c for c in n.children if isinstance(c, Node) and not c.dropped and c.size]
        todo += [(c, path, k + 1 if 2 * k < len(below) else k - len(below)) for k, c in enumerate(below)]
    out = {}
    for n, path, place in reversed(order):
        h = xxhash.xxh64(f"{n.tag} {' '.join(n.words)}")
        leaf = True
        for c in n.children:
            if isinstance(c, str):
                h.update(" ".join(c.split()).encode("utf-8", "replace"))
            elif c.dropped:
                continue
            else:
                h.update(c.hash.to_bytes(8, "little"))
                leaf &= c.leaf and c.tag not in BLOCKS
            h.update(b"\0")
        n.hash, n.leaf = h.intdigest(), leaf
        if not n.size or n.holds or n.tag in PARTS or n.tag == "header" and n.inside:
            continue
        if n.tag in BLOCKS:  # inline elements are pieces of a sentence
            placed = (n.inside or not root.holds) and (n.tag in TEXT_BLOCKS or leaf)
            key = xxhash.xxh64_intdigest(f"{host} {n.hash} {path} {place}" if placed else f"{host} {n.hash}")
            key = key & ~1 | (n.marked and n.inside)
            out[id(n)] = key - (1 << 64) if key >= 1 << 63 else key
    return out


def recurring(root: Node, hashes: dict[int, int], counts: dict[int, int], need: int, inside: int) -> list[tuple[Node, int]]:
    """The outermost elements on ``need`` pages or more, in an article or on a page without one on ``inside`` or more, with how
    many. A heading goes only with the element that follows it."""
    out, todo = [], [root]
    while todo:
        n = todo.pop()
        after = False
        for c in reversed(n.children):
            if not isinstance(c, Node) or not (c.size or c.dropped):
                continue
            gone = c.dropped
            if not gone:
                h = hashes.get(id(c), 0)
                least = MARKED_PAGES if h & 1 else inside if c.inside or not root.holds else need
                gone = counts.get(h, 0) >= least and (after or c.tag not in HEADINGS)
                if gone:
                    out.append((c, counts[h]))
                else:
                    todo.append(c)
            after = gone
    return out


def deleted(root: Node, hashes: dict[int, int], counts: dict[int, int], pages: int, need: int) -> set[int]:
    """id() of the template elements of a page of a host with so many pages. If what recurs is most of the content,
    the page is a near copy of others; then only what recurs on ``need`` pages besides the copies is template. A page
    without an article may be mostly menus, so there it is a copy only if less than half of the host is like it."""
    most = max(need, pages // 2 + 1) if root.holds else need
    found = recurring(root, hashes, counts, need, most)
    parts = sorted((n, c.size) for c, n in found if (c.inside or not root.holds) and not hashes[id(c)] & 1)
    shared, marked = sum(size for _, size in parts), sum(c.size for c, _ in found if hashes[id(c)] & 1)
    if shared > MOST * (sum(n.size for n in content(root)) - marked):
        copies, before = 0, 0
        for copies, size in parts:
            before += size
            if 2 * before >= shared:
                break
        if root.holds or 2 * copies < pages:
            found = recurring(root, hashes, counts, need, max(most, copies + need))
    return {id(c) for c, _ in found}


def blocks(root: Node, gone: set[int] | frozenset = frozenset()) -> list[str]:
    """The text blocks of the content in page order, without furniture and the elements in ``gone``."""
    out, words = [], []

    def flush():
        s = " ".join("".join(words).split())
        if s:
            out.append(s)
        words.clear()

    for node in content(root):
        todo: list = [node]
        while todo:
            n = todo.pop()
            if isinstance(n, str):
                words.append(n)
            elif n is None:
                flush()
            elif n is not node and (n.dropped or id(n) in gone):
                if n.tag in BLOCKS or n.tag == "button":
                    flush()
            elif n.tag == "header" and not n.inside and not n.holds:
                flush()  # the page's header; an article's own header holds its heading
            elif n.tag == "br":
                words.append(" ")
            elif n.tag in BLOCKS or n.tag == "#root":
                flush()
                todo.append(None)
                todo += reversed(n.children)
            else:
                todo += reversed(n.children)
        flush()
    return out


def host_of(url: str | None) -> str:
    try:
        return (urlsplit((url or "").strip()).hostname or "").lower()
    except ValueError:
        return ""


def page_subtrees(pages: DataFrame) -> DataFrame:
    """(key, host, hash array) of every distinct page: its subtrees that may be template, hashed with the host."""
    def make():
        def f(cols):
            return {"key": cols["key"], "host": cols["host"],
                    "hash": [sorted(set(candidates(parse(source), host).values())) for host, source in zip(cols["host"], cols["html"])]}

        return f

    seen = arrow_map(pages.select("key", "host", "html"), "key binary, host string, hash array<long>", make)
    return seen.dropDuplicates(["key"])


def site_templates(seen: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(key, pages, need, template) of the pages of hosts with min_pages pages, from page_subtrees: on how many of the
    host's pages a subtree must be, and the hashes of the page that are on two pages or more, with how many. Counts are combined before the
    shuffle, so a host with a third of the pages moves no more than its distinct subtrees."""
    total = seen.count()
    hosts = (seen.groupBy("host").agg(F.count("*").alias("pages")).where(F.col("pages") >= min_pages)
             .withColumn("need", F.greatest(F.lit(min_pages), F.ceil(F.log2("pages"))).cast("int")))
    known = join_per_key(seen.select("key", "host"), hosts.withColumn("many", F.col("pages")), ["host"], "many", total).drop("host")
    often = cut(seen.select(F.explode("hash").alias("hash")).groupBy("hash").agg(F.count("*").alias("n")).where(f"n >= {MARKED_PAGES}"), "templates")
    found = often.agg(F.sum("n"), F.count("*")).first()
    words = key_filter(often, "hash", int(found[1]))

    def make():
        def f(cols):  # only subtrees that the small filter holds move to meet their counts
            out = {"key": [], "hash": []}
            for key, hashes in zip(cols["key"], cols["hash"]):
                keep = np.array(hashes, np.int64)[may_hold(words, np.array(hashes, np.int64))].tolist()
                out["key"] += [key] * len(keep)
                out["hash"] += keep
            return out

        return f

    each = arrow_map(seen.select("key", "hash"), "key binary, hash long", make)
    marked = (join_per_key(each, often.withColumn("many", F.col("n")), ["hash"], "many", int(found[0] or 0))
              .groupBy("key").agg(F.collect_list(F.struct("hash", "n")).alias("template")))
    return known.join(marked, "key", "left")


def main_text(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """page_id, url, text, n_chars of every row of pages."""
    p = pages.select("page_id", "url", F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    host = F.pandas_udf(lambda urls: urls.map(host_of), "string")
    p = p.withColumn("host", host("url")).withColumn("key", F.unhex(F.md5(F.concat_ws("\0", "host", "html"))))
    marked = site_templates(cut(page_subtrees(p), "pages"), min_pages)
    joined = p.join(marked, "key", "left")

    def make():
        def f(cols):
            out = {"page_id": cols["page_id"], "url": cols["url"], "text": [], "n_chars": []}
            for host, source, n, need, template in zip(cols["host"], cols["html"], cols["pages"], cols["need"], cols["template"]):
                root, gone = parse(source), frozenset()
                if template:
                    gone = deleted(root, candidates(root, host), {x["hash"]: x["n"] for x in template}, n, need)
                text = "\n".join(blocks(root, gone))
                out["text"].append(text)
                out["n_chars"].append(len(text))
            return out

        return f

    return arrow_map(joined.select("page_id", "url", "host", "html", "pages", "need", "template"), "page_id long, url string, text string, n_chars long", make)
