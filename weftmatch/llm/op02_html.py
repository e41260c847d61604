"""Main text of web pages, with the templates of their sites removed.

Every page is parsed to a tree. A first pass hashes the subtree of each block element and counts, for each host, the
distinct pages that have it (copies of one html count once). Two kinds of hashes are counted:

- outside the article (what neither holds nor is in an article or main element): the subtree's text, and its shape (names,
  classes and roles of its elements, runs of equal ones taken as one) together with its place in the page. So a menu or a
  notice is a template because it recurs, even if its words change. On pages without such an element, the shape of
  subtrees whose text is mostly links counts in this way.
- everywhere else: the subtree's text.

The first kind is a template from MANY_PAGES distinct pages on, or SOME_PAGES that are half of the host's; the second, which
may be text of articles, needs both MANY_PAGES and half of the host's distinct pages. A second pass deletes template
subtrees and writes the text of the rest. Near copies of an article on one host share most of their blocks; where the
second kind would take more than half of a page's blocks, they are text of the article and stay.

The article elements are the main text; without any, main elements; without these, the body. No subtree that holds a
main element is deleted. Articles inside an article are reader comments. Names, roles and classes that say what an element is
(nav, footer, class="share-buttons") settle what is no template of its host, as on hosts with few pages.

Defined results: a null html or one without text is the empty text; a null url has the host ''; pages with repeated or
null ids stay rows of their own; unclosed elements end with their parent; other columns of pages are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, prepare, stored

MANY_PAGES, SOME_PAGES, TEMPLATE_SHARE = 10, 3, 0.5
#: Template hashes of all hosts, and of one host, up to which lists by host are broadcast; beyond, lists by page are joined.
BROADCAST_HASHES, HOST_HASHES = 500_000, 1_000

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>""", re.S)
_ATTR = re.compile(r"""([^\s=/"'>]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_TOKEN = re.compile(r"[a-z0-9]+")
_RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BLOCK = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
_DROP = {"head", "nav", "footer", "aside", "form", "template", "object", "svg", "canvas", "button", "select", "option", "datalist", "dialog", "menu", "audio", "video", "applet", "frameset"} | _RAW
#: What ends when such an element begins inside it.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
_SCOPE = {"html", "body", "article", "main", "section", "aside", "div", "table", "td", "th", "ul", "ol", "dl", "nav", "header", "footer", "form", "blockquote"}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar"}
_NOISE = set("""ad ads adbox adslot advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies
disclaimer disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promotion
recommended related replies reply respond share sharing sidebar sidebars signup social sponsor sponsored subscribe toolbar topbar widget widgets""".split())
#: Words that may stand beside these in one name: "share-buttons" is noise, "share-price" and "related-work" are not.
_NEUTRAL = set("""area article articles bar block body bottom box btn button buttons container content footer form global group header holder icons inner
item items left link links list main outer page panel post posts primary right row section side site slot story text title top unit wrap wrapper""".split())


class Node:
    __slots__ = ("tag", "attrs", "children", "hash", "shape", "own", "chars", "linked")

    def __init__(self, tag: str, attrs: str):
        self.tag, self.attrs, self.children, self.hash, self.shape, self.own, self.chars, self.linked = tag, attrs, [], 0, 0, tag, 0, 0


def parse(html: str) -> Node:
    """The tree of a page; text is kept as it stands."""
    root = Node("#page", "")
    stack, at = [root], 0
    opened: Counter[str] = Counter()  # elements on the stack by name: an end tag of none of them costs no look at it
    last = html.rfind(">") + 1  # no tag ends behind it

    def close(upto: int) -> None:
        while len(stack) > upto:
            node = stack.pop()
            opened[node.tag] -= 1
            _hash(node)

    search = _TAG.search
    while m := search(html, at, last):
        if m.start() > at:
            stack[-1].children.append(html[at : m.start()])
        at = m.end()
        if html.startswith("<!--", m.start()) and not html.endswith("-->", m.start(), at):
            at = len(html)  # a comment without an end
        tag = m[2] or m[5]
        if not tag:
            continue
        tag = tag.lower()
        if m[1] or m[4]:
            if not opened[tag]:
                continue
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    close(k)
                    break
                if stack[k].tag in ("td", "th", "table", "article", "main") and tag not in _BLOCK:
                    break
            continue
        node = Node(tag, m[3] or m[6] or "")
        if tag in _RAW:
            end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(html, at)
            at = end.end() if end else len(html)
            continue
        if tag in _CLOSES or tag in _BLOCK:
            ends = _CLOSES.get(tag, set()) | ({"p"} if tag in _BLOCK else set())
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in ends:
                    close(k)
                    if stack[k - 1].tag not in ends:
                        break
                elif stack[k].tag in _SCOPE:
                    break
        stack[-1].children.append(node)
        if tag not in _VOID and not node.attrs.rstrip().endswith("/") or tag in _BLOCK and tag != "hr":
            stack.append(node)
            opened[tag] += 1
    if rest := html[at:].split("<!--", 1)[0]:
        stack[-1].children.append(rest)
    close(0)
    return root


def _text(raw: str) -> str:
    return unescape(raw) if "&" in raw else raw


def _hash(node: Node) -> None:
    """hash: of the element's name and all that is in it; 0 if there is no text. shape: of names, classes and roles."""
    parts, shapes = [], []
    for c in node.children:
        if isinstance(c, Node):
            if c.hash:
                parts.append(f"{c.tag}:{c.hash}")
                node.chars += c.chars
                node.linked += c.linked
                if not shapes or shapes[-1] != c.shape:
                    shapes.append(c.shape)
        elif t := " ".join(_text(c).split()):
            parts.append(t)
            node.chars += len(t)
            if not shapes or shapes[-1]:
                shapes.append(0)
    node.own = node.tag + _marks(node)
    if parts:
        node.hash = xxhash.xxh64_intdigest("\x1f".join([node.tag, *parts])) - 2**63
        node.shape = xxhash.xxh64_intdigest(f"{node.own}>{shapes}")
        if node.tag == "a":
            node.linked = node.chars


_MARKED = re.compile(r"\b(?:class|id|role)\b", re.I)


def _marks(node: Node) -> str:
    """Class, id and role, with every number taken as the same."""
    if not node.attrs or not _MARKED.search(node.attrs):
        return ""
    a = _attributes(node)
    return re.sub(r"[0-9]+", "0", "|".join(" ".join(sorted(a.get(k, "").split())) for k in ("class", "id", "role")))


def _attributes(node: Node) -> dict[str, str]:
    return {k.lower(): unescape(v.strip("\"'")) for k, v in _ATTR.findall(node.attrs)} if node.attrs else {}


def _walk(root: Node) -> Iterator[Node]:
    todo = [root]
    while todo:
        node = todo.pop()
        yield node
        todo += [c for c in reversed(node.children) if isinstance(c, Node)]


def keyed(root: Node, mains: list[Node]) -> Iterator[tuple[Node, tuple[int, ...]]]:
    """Block elements that have text, with the hashes under which they may be templates; those that hold a main element have none.

    Hashes are even for text that may be an article's, odd for what is outside the article.
    """
    inside = set(map(id, mains))
    main = mains[0].tag != "body" and mains[0] is not root
    holds: set[int] = set()
    if main:
        trail: list[Node] = []
        todo: list[Node | None] = [root]
        while todo:
            node = todo.pop()
            if node is None:
                trail.pop()
            elif id(node) in inside:
                holds.update(map(id, trail))
            else:
                trail.append(node)
                todo.append(None)
                todo += [c for c in node.children if isinstance(c, Node)]
    walk: list[tuple[Node, int, bool]] = [(root, 0, not main)]
    while walk:
        node, place, within = walk.pop()
        own = id(node) in inside
        if node.hash and node.tag in _BLOCK and node.tag not in ("html", "body") and not (main and (own or id(node) in holds)):
            at = (xxhash.xxh64_intdigest(f"{place}/{node.shape}") - 2**63) | 1
            if not within:
                yield node, (node.hash | 1, at)
            elif not main and 2 * node.linked >= node.chars:
                yield node, (node.hash & ~1, at)
            else:
                yield node, (node.hash & ~1,)
        if node.children:
            here = xxhash.xxh64_intdigest(f"{place}>{node.own}")
            walk += [(c, here, within or own) for c in reversed(node.children) if isinstance(c, Node)]


def subtrees(root: Node) -> set[int]:
    """The hashes under which subtrees of a page may be templates."""
    return {h for _, hashes in keyed(root, _mains(root)) for h in hashes}


def _is_noise(node: Node, in_main: bool) -> bool:
    if node.tag in _DROP or node.tag == "header" and not in_main or node.tag == "article" and in_main:
        return True
    if not node.attrs:
        return False
    a = _attributes(node)
    if "hidden" in a or a.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", a.get("style", ""), re.I):
        return True
    if a.get("role", "").lower() in _ROLES or node.tag in ("html", "body"):
        return a.get("role", "").lower() in _ROLES
    names = a.get("class", "").lower().split()
    if not (len(node.tag) == 2 and node.tag[0] == "h"):  # ids of headings are made of their text
        names += a.get("id", "").lower().split()
    return any(_names_noise(x) for x in names)


def _names_noise(name: str) -> bool:
    """Whether a class or id is made of words for noise, and neutral ones."""
    words = [w for w in _TOKEN.findall(name) if not w.isdigit()]
    return any(w in _NOISE for w in words) and all(w in _NOISE or w in _NEUTRAL for w in words)


def _mains(root: Node) -> list[Node]:
    """The outermost article elements that aren't noise, else main elements, else the body or the page."""
    for wanted in (lambda n: n.tag == "article", lambda n: n.tag == "main" or "main" in n.attrs and _attributes(n).get("role", "").lower() == "main"):
        found, todo = [], [root]
        while todo:
            node = todo.pop()
            if wanted(node):
                if not (node.attrs and _is_noise(node, False)):
                    found.append(node)
                continue
            if node.tag in _DROP or node.attrs and node.tag != "#page" and {"comment", "comments", "related", "sidebar", "ad", "ads"} & set(_TOKEN.findall(node.attrs.lower())) and _is_noise(node, False):
                continue
            todo += [c for c in reversed(node.children) if isinstance(c, Node)]
        if found:
            return found
    return [next((n for n in _walk(root) if n.tag == "body"), root)]


def _blocks(mains: list[Node], gone: set[int]) -> list[str]:
    """The text of main elements without the subtrees that are gone, and without noise."""
    blocks, line = [], []

    def flush() -> None:
        if text := " ".join("".join(line).split()):
            blocks.append(text)
        line.clear()

    for main in mains:
        inside = main.tag in ("article", "main")
        todo: list[Node | str | None] = [*reversed(main.children)]
        flush()
        while todo:
            node = todo.pop()
            if node is None:
                flush()
            elif isinstance(node, str):
                line.append(_text(node))
            elif node.tag == "br":
                line.append(" ")
            elif id(node) in gone:
                flush()
            elif not _is_noise(node, inside):
                if node.tag in _BLOCK:
                    flush()
                    todo.append(None)
                todo += reversed(node.children)
        flush()
    return blocks


def main_text(html: str, template: frozenset[int] | set[int] = frozenset()) -> tuple[str, int]:
    """The text of the article, one line for each block, and how many subtrees were deleted as templates."""
    root = parse(html)
    mains = _mains(root)
    sure, maybe = [], []
    if template:
        for node, hashes in keyed(root, mains):
            if hit := [h for h in hashes if h in template]:
                (sure if any(h & 1 for h in hit) else maybe).append(node)
    gone = {id(n) for n in sure}
    blocks = _blocks(mains, gone)
    if maybe:
        less = _blocks(mains, gone | {id(n) for n in maybe})
        if 2 * len(less) >= len(blocks):
            blocks = less
        else:
            maybe = []
    return "\n".join(blocks), len(_outermost(root, gone | {id(n) for n in maybe})) if gone or maybe else 0


def _outermost(root: Node, gone: set[int]) -> list[Node]:
    found, todo = [], [root]
    while todo:
        node = todo.pop()
        if id(node) in gone:
            found.append(node)
        else:
            todo += [c for c in node.children if isinstance(c, Node)]
    return found


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z in lower case; '' without ://."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _based(pages: DataFrame) -> DataFrame:
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    return pages.select("page_id", "url", html.alias("html"), host_of(F.col("url")).alias("host"), F.xxhash64(html).alias("page"))


def page_subtrees(pages: DataFrame) -> DataFrame:
    """host, page (a hash of the html), hashes: one row for each distinct page of a host."""
    prepare(pages.sparkSession)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(subtrees(parse(h))) for h in column(batch, "html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.list_(pa.int64()))], ["host", "page", "hashes"])

    return _based(pages).select("host", "html", "page").mapInArrow(hashed, "host string, page long, hashes array<long>").dropDuplicates(["host", "page"])


def site_templates(subtrees_of: DataFrame) -> DataFrame:
    """host, hash: the subtrees that recur across many pages of a host (see the head of this file), of (host, page, hashes)."""
    seen = subtrees_of.select("host", F.explode("hashes").alias("hash")).groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n")).where(f"n >= {SOME_PAGES}")
    hosts = subtrees_of.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    many, half = F.col("n") >= MANY_PAGES, F.col("n") >= TEMPLATE_SHARE * F.col("pages")
    outside = F.col("hash").bitwiseAND(F.lit(1).cast("long")) == 1
    return seen.join(hosts, "host").where((many & half) | (outside & (many | half))).select("host", "hash")


def _templated(pages: DataFrame) -> DataFrame:
    """page_id, url, html, template: the template hashes of each page's host, or those that the page has itself."""
    subtrees_of = stored(page_subtrees(pages), "subtrees")
    templates = stored(site_templates(subtrees_of), "templates")
    base = _based(pages)
    sizes = templates.groupBy("host").agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.max("n"), F.lit(0)).alias("most"), F.coalesce(F.sum("n"), F.lit(0)).alias("all")).first()
    if sizes["all"] <= BROADCAST_HASHES and sizes["most"] <= HOST_HASHES:
        lists = templates.groupBy("host").agg(F.collect_set("hash").alias("template"))  # HOST_HASHES at most
        return base.join(F.broadcast(lists), "host", "left").select("page_id", "url", "html", "template")
    has = subtrees_of.select("host", "page", F.explode("hashes").alias("hash")).join(templates, ["host", "hash"], "left_semi")
    lists = has.groupBy("host", "page").agg(F.collect_set("hash").alias("template"))  # a page's own
    return base.join(lists, ["host", "page"], "left").select("page_id", "url", "html", "template")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_template (subtrees that were deleted as templates of the host)."""
    kind = pages.schema["page_id"].dataType.simpleString()

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [main_text(h, frozenset(t or ())) for h, t in zip(column(batch, "html").to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([t for t, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())], ["page_id", "url", "text", "n_template"])

    return _templated(pages).mapInArrow(extracted, f"page_id {kind}, url string, text string, n_template long")
