"""Main text of web pages by composite text density.

A page becomes a tree of elements. Boilerplate that the markup itself names (menus, headers, footers,
sidebars, notices, adverts, forms, scripts, comments) is cut off first. A name cuts only as a whole
class, id or role, and neither a name nor a form cuts the page's article or main element, what holds
it, or what holds most of the body's characters outside links; there the densities decide. Every node then has a
composite density: its characters per tag, weighed down by the share of characters and tags in
links relative to the whole body. A node's sum is the sum of its children's densities. The node with
the largest sum leads; the smallest density on its path up to the body is the threshold, and every
part of the body that reaches it gives its own node of largest sum. If the leading node lies in an
article or main element, that element is taken, without the blocks in it that hold links only and so
have no density. The blocks of text below the chosen
nodes, in page order, are the text.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is data: everything up to their end tag.
RAW = frozenset("script style noscript template textarea title iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
#: An opening tag of the first kind ends an open element of the second, up to the given borders.
ENDS = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu"})),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "tr": (frozenset({"tr", "td", "th"}), frozenset({"table"})),
    "td": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "th": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "option": (frozenset({"option"}), frozenset({"select"})),
}
#: Elements that hold no article text.
OUT = RAW | frozenset(
    "head nav footer aside form button select input svg canvas object embed audio video map dialog menu label fieldset".split()
)
#: Of these, what may also be wrapped around a whole page.
WRAPPERS = frozenset("form fieldset".split())
#: Names in class, id or role that mark boilerplate: alone, with each other or with qualifiers.
OUT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs footer sidebar aside widget cookie cookies consent notice notices gdpr popup modal overlay "
    "comment comments disqus reply replies respond share sharing social related recommended newsletter subscribe "
    "signup login search pagination pager toolbar masthead contentinfo complementary hidden "
    "feedback discussion discussions legal copyright imprint".split()
)
#: Header-like names count outside an article only: an article's own heading belongs to it.
HEADER_WORDS = frozenset("header topbar".split())
#: Words that add nothing to a name but where or what shape it is: ``user-comments``, ``cookie-bar``.
QUALIFIERS = frozenset(
    "user site page top bottom left right main primary secondary global list box block section container wrapper bar "
    "link links button buttons icons text slot unit message dialog form post posts reader readers visitor visitors".split()
)
#: Of the marks, those of readers' comments: what bears them is not spared for its length.
COMMENTS = frozenset("comment comments disqus reply replies respond feedback discussion discussions".split())
#: Words that say what a page has rather than what an element is.
STATES = frozenset("has no with without show hide allow enable disable open".split())

# A quote opens a value only right after an equals sign; a value without quotes ends at white space.
_VALUE = r"""(?:"[^"]*(?:"|\Z)|'[^']*(?:'|\Z)|[^\s>]*)"""
_TAG = re.compile(rf"<(?:!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*{_VALUE})*+)(?:>|\Z))", re.S)
_ATTRIBUTE = re.compile(rf"([^\s=/]+)(?:\s*=\s*({_VALUE}))?|=", re.S)
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass
class Node:
    tag: str
    out: bool = False
    by_name: bool = False  # out by a name, or as a wrapper, alone
    parent: Node | None = None
    children: list = field(default_factory=list)  # nodes and texts, in order
    chars: int = 0
    tags: int = 0
    link_chars: int = 0
    link_tags: int = 0
    density: float = 0.0
    sum: float = 0.0
    comments: bool = False  # named as readers' comments


def _attributes(text: str) -> Iterator[tuple[str, str]]:
    """Names in lower case and values, one after the other, so that nothing inside a value counts."""
    for m in _ATTRIBUTE.finditer(text):
        if m[1]:
            value = m[2] or ""
            yield m[1].lower(), value.strip(value[0]) if value[:1] in ("'", '"') else value


def _hidden(attributes: str) -> bool:
    return any(n == "hidden" or (n == "aria-hidden" and v.lower() == "true") for n, v in _attributes(attributes))


def _named_out(attributes: str, inside: bool) -> str:
    """The word by which a class, id or role as a whole names boilerplate: ``sidebar``, not ``has-sidebar``.

    Comments count whoever's they are: ``reader-comments``, but not ``no-comments``. Empty if none does.
    """
    marks = OUT_WORDS if inside else OUT_WORDS | HEADER_WORDS
    for name, value in _attributes(attributes):
        for token in value.split() if name in ("class", "id", "role") else ():
            words = _WORD.findall(_CAMEL.sub(" ", token).lower())
            if words and words[-1] == "comments" and words[0] not in STATES:
                return "comments"
            if marks.intersection(words) and set(words) <= marks | QUALIFIERS:
                return next((w for w in words if w in COMMENTS), next(w for w in words if w in marks))
    return ""


def parsed(page: str) -> Node:
    """Tree of a page; tags are matched leniently, as browsers do for paragraphs, items and cells."""
    root = Node("html")
    at, stack = 0, [root]
    open_: Counter[str] = Counter()  # elements of each name below the root

    def close(k: int) -> None:
        """End the element at place ``k`` and all inside it."""
        for node in stack[k:]:
            open_[node.tag] -= 1
        del stack[k:]

    for begin, end, closing, tag, attributes in iter_tags(page):
        if begin > at:
            stack[-1].children.append(page[at:begin])
        at = end
        if tag is None:
            continue
        if closing:
            # an inline end tag does not reach out of a block
            for k in range(len(stack) - 1, 0, -1) if open_[tag] else ():
                if stack[k].tag == tag:
                    close(k)
                    break
                if tag not in BLOCK and stack[k].tag in BLOCK:
                    break
            continue
        if tag in ("html", "body") and open_[tag]:
            continue
        if tag in BLOCK and open_["p"]:  # a block ends an open paragraph, with what is open inside it
            k = _nearest(stack, frozenset({"p"}), BLOCK)
            if k:
                close(k)
        if tag in ENDS:
            kinds, borders = ENDS[tag]
            while any(open_[kind] for kind in kinds) and (k := _nearest(stack, kinds, borders)):
                close(k)
        article = open_["article"] + open_["main"]
        sure = (tag in OUT and tag not in WRAPPERS) or (tag == "header" and not article) or _hidden(attributes)
        name = "" if sure else _named_out(attributes, article > 0)
        by_name = bool(name) or (not sure and tag in WRAPPERS)
        # a page cannot be boilerplate as a whole
        named = tag not in ("html", "body")
        node = Node(tag, named and (sure or by_name), named and by_name, stack[-1], comments=name in COMMENTS)
        stack[-1].children.append(node)
        if tag not in VOID and not attributes.endswith("/"):
            stack.append(node)
            open_[tag] += 1
    if at < len(page):
        stack[-1].children.append(page[at:])
    return root


def iter_tags(page: str) -> Iterator[tuple[int, int, bool, str | None, str]]:
    """(begin, end, closing, name, attributes) of tags; comments and declarations have no name.

    Content of scripts and the like is skipped over to its end tag.
    """
    at = 0
    while True:
        m = _TAG.search(page, at)
        if m is None:
            return
        tag = m[2].lower() if m[2] else None
        yield m.start(), m.end(), bool(m[1]), tag, m[3] or ""
        at = m.end()
        if tag in RAW and not m[1]:
            stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
            if stop is None:
                yield at, len(page), True, tag, ""
                return
            tail = page.find(">", stop.end())
            tail = len(page) if tail < 0 else tail + 1
            yield at, at, False, None, ""
            yield stop.start(), tail, True, tag, ""
            at = tail


def _nearest(stack: list[Node], kinds: frozenset, borders: frozenset) -> int:
    """Place of the innermost open element of ``kinds``, 0 if a border or nothing comes first."""
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag in kinds:
            return k
        if stack[k].tag in borders:
            return 0
    return 0


def _spare(body: Node) -> None:
    """Put back what only a name cut although it is, holds or may be the article.

    The page's article is the article or main element, not inside another one, with most characters
    outside links. Where there is one, names keep cutting what lies elsewhere.
    """
    nodes, todo = [], [(body, False)]
    outer = []
    while todo:
        node, inside = todo.pop()
        nodes.append(node)
        article = node.tag in ("article", "main")
        if article and not inside:
            outer.append(node)
        todo += [(c, inside or article) for c in reversed(node.children) if isinstance(c, Node) and (not c.out or c.by_name)]
    if not any(n.by_name for n in nodes):
        return
    plain: dict[int, int] = {}
    for node in reversed(nodes):
        plain[id(node)] = 0 if node.tag == "a" else sum(
            len("".join(c.split())) if isinstance(c, str) else plain.get(id(c), 0) for c in node.children
        )
    lead = max(outer, key=lambda n: plain[id(n)], default=None)
    above = set()
    if lead is not None and plain[id(lead)]:
        above = {id(n) for n in _upwards(lead)}
        for node in outer:
            node.out = node.out and not node.by_name
    below = {id(lead)} if above else set()
    for node in nodes:  # parents before children
        if id(node.parent) in below:
            below.add(id(node))
        most = not node.comments and 2 * plain[id(node)] > plain[id(body)] and (not above or id(node) in below)
        if node.by_name and (id(node) in above or most):
            node.out = False


def _in_order(top: Node) -> list[Node]:
    """Nodes below and including ``top`` that are not cut off, parents before children."""
    out, todo = [], [top]
    while todo:
        node = todo.pop()
        out.append(node)
        todo += [c for c in reversed(node.children) if isinstance(c, Node) and not c.out]
    return out


def _measure(body: Node) -> list[Node]:
    """Densities and sums of all nodes, from the leaves up."""
    nodes = _in_order(body)
    for node in reversed(nodes):
        for c in node.children:
            if isinstance(c, str):
                node.chars += len("".join(c.split()))
            elif not c.out:
                node.chars += c.chars
                node.tags += c.tags + 1
                node.link_chars += c.link_chars
                node.link_tags += c.link_tags
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.tags + 1
    share = body.link_chars / max(body.chars, 1)
    for node in nodes:
        c, t, lc, lt = node.chars, max(node.tags, 1), node.link_chars, max(node.link_tags, 1)
        if c:
            base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
            node.density = c / t * math.log(c / max(lc, 1) * t / lt + 1e-9) / max(math.log(base), 1e-9) if base > 1 else 0.0
    for node in nodes:
        node.sum = sum(k.density for k in node.children if isinstance(k, Node) and not k.out)
    return nodes


def _upwards(node: Node) -> Iterator[Node]:
    """The node and what holds it, outermost first."""
    path = []
    while node is not None:
        path.append(node)
        node = node.parent
    return iter(path[::-1])


def _chosen(body: Node) -> set[int]:
    """Nodes whose subtrees are the main text."""
    nodes = _measure(body)
    best = max(nodes, key=lambda n: n.sum)
    if best.sum <= 0:
        return {id(body)}
    threshold, node = best.density, best
    while node is not body:
        node = node.parent
        threshold = min(threshold, node.density)
    top: dict[int, Node] = {}
    for node in reversed(nodes):  # largest sum below, the first in page order of equal ones
        top[id(node)] = node
        for c in node.children:
            if isinstance(c, Node) and not c.out and top[id(c)].sum > top[id(node)].sum:
                top[id(node)] = top[id(c)]
    around = next((n for n in _upwards(best) if n.tag in ("article", "main")), None)
    # lists of links have no density: they are menus, also inside an article
    for node in nodes:
        node.out = node.out or (node.tag in BLOCK and node is not body and node.link_tags > 1 and node.link_chars == node.chars > 0)
    found, todo = set() if around is None else {id(around)}, [body]
    while todo:
        node = todo.pop()
        if node.density >= threshold and node.chars:
            found.add(id(top[id(node)]))
        if id(node) not in found:
            todo += [c for c in node.children if isinstance(c, Node) and not c.out]
    return found


def _blocks(body: Node, chosen: set[int]) -> list[str]:
    """Texts of the blocks below chosen nodes, white space folded."""
    out: list[str] = []
    run: list[str] = []

    def close() -> None:
        text = " ".join(html.unescape("".join(run)).split())
        run.clear()
        if text:
            out.append(text)

    todo: list = [(body, id(body) in chosen, False)]
    while todo:
        item, inside, leaving = todo.pop()
        if isinstance(item, str):
            if inside:
                run.append(item)
            continue
        block = item.tag in BLOCK
        if leaving:
            if block:
                close()
            continue
        if item.out:
            if block:
                close()
            continue
        if block:
            close()
        if item.tag == "br" and inside:
            run.append(" ")
        todo.append((item, inside, True))
        todo += [(c, inside or (isinstance(c, Node) and id(c) in chosen), False) for c in reversed(item.children)]
    close()
    return out


def main_text(page: str | None) -> str:
    """Blocks of a page's main text, joined by blank lines; empty if there is none."""
    if not page:
        return ""
    root = parsed(page)
    body = next((n for n in _in_order(root) if n.tag == "body"), root)
    _spare(body)
    return "\n\n".join(_blocks(body, _chosen(body)))


def extracted(pages: DataFrame) -> DataFrame:
    """Main text of every page: page_id, url, text, n_chars.

    ``pages`` has ``page_id``, ``url`` and ``html``; other columns are ignored. Null and empty pages
    and pages without text give an empty text. A page without a body element is taken as a body; an
    unclosed element runs to the end of what holds it. Pages are independent, so repeated rows give
    equal texts, and null ids and addresses are kept. Ties in the sums go to the outer, then the
    first node. Very long and deeply nested pages are read whole. An empty table stays empty.
    """
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                texts = [main_text(p.as_py()) for p in part.column("html")]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("page_id").cast(pa.int64()),
                        part.column("url").cast(pa.string()),
                        pa.array(texts, pa.string()),
                        pa.array([len(t) for t in texts], pa.int64()),
                    ],
                    schema=schema,
                )

    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    return rows.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
