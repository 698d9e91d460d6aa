"""Main text of web pages by tree scoring.

A page is parsed into a tree. What is never article text goes with all it holds: scripts, styles, forms, menus, page
headers and footers, asides, and elements whose class, id or role says advert, notice, sidebar, reader comments and
the like. Each paragraph then gives points for its length and its commas to its parent, half of them to the
grandparent, and less to each ancestor further up. An element's points are discounted by the share of its text that
lies in links. The element with most points is the container; its siblings stay if their points come near or if they
are headings or long paragraphs with few links. All blocks of what stays are the text.

White space inside a block is one space; blocks are joined in page order by an empty line. Null, empty and
text-free pages have an empty text. Parsing keeps no recursion, so depth and length of a page are bounded by memory
only. Unclosed and stray tags are accepted. Repeated rows give equal results. Extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from marketlens.llm.common import slices, table

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<([a-zA-Z][^\s/>]*)[^>]*>|<[!?/][^>]*>",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noframes".split())
BLOCK = frozenset(
    "address article blockquote body caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hr html "
    "li main ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
# Start tags that end an open element: for each, the elements it ends, and those beyond which none is ended.
CLOSES = {
    **{t: (("p",), ("td", "th", "table", "button")) for t in BLOCK - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}},
    "li": (("li", "p"), ("ul", "ol")),
    "dt": (("dt", "dd", "p"), ("dl",)),
    "dd": (("dt", "dd", "p"), ("dl",)),
    "td": (("td", "th"), ("table",)),
    "th": (("td", "th"), ("table",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "tbody": (("tbody", "thead", "tr"), ("table",)),
    "option": (("option",), ("select",)),
}
DROPPED = frozenset(
    "script style noscript template svg math head title iframe noframes object embed canvas audio video map select option button input "
    "textarea form label fieldset legend nav menu header footer aside dialog xmp datalist output progress meter".split()
)
# Words of class and id that mark what is no article text.
BOILERPLATE = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adbox adslot adunit banner banners sponsor sponsored promo promos "
    "promotion cookie cookies consent gdpr notice notices notification notifications alert alerts popup modal overlay newsletter subscribe "
    "subscription signup login paywall sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs header masthead footer "
    "comment comments commenting commentlist discussion disqus replies reply respond responses share sharing social related recommended "
    "recommendations teaser widget widgets toolbar pagination pager tags tagcloud skip hidden".split()
)
# Of these, the words that also mark an <article> or <main> as none.
FOREIGN = frozenset("comment comments reply replies response responses ad ads advert advertisement promo sponsored related teaser".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
COMMAS = re.compile("[,،、，]")


class Node:
    __slots__ = ("tag", "parent", "children", "words", "off", "points", "text", "linked", "holds")

    def __init__(self, tag: str, parent: Node | None, attributes: str = ""):
        self.tag, self.parent, self.children = tag, parent, []
        self.words, self.off = frozenset(), tag in DROPPED
        self.points, self.text, self.linked, self.holds = 0.0, 0, 0, False
        if attributes and not self.off and tag not in ("html", "body"):
            found = {k.lower(): unescape(v.strip("\"'")) for k, v in reversed(ATTRIBUTE.findall(attributes))}
            names = f"{found.get('class', '')} {found.get('id', '')}"
            self.words = frozenset(w.lower() for w in NAME.findall(names))
            style = found.get("style", "").replace(" ", "").lower()
            self.off = (
                "hidden" in found
                or found.get("aria-hidden", "").lower() == "true"
                or found.get("role", "").lower() in ROLES
                or "display:none" in style
                or "visibility:hidden" in style
            )
        if parent is not None:
            parent.children.append(self)


def parse(html: str) -> Node:
    root = Node("#root", None)
    here, at, n = root, 0, len(html)
    depth: dict[str, int] = {}  # open elements by tag

    def close_until(node: Node) -> Node:
        nonlocal here
        while here is not node:
            depth[here.tag] -= 1
            here = here.parent
        depth[node.tag] -= 1
        here = node.parent
        return here

    while at < n:
        m = TOKEN.search(html, at)
        if m is None:
            here.children.append(html[at:])
            break
        if m.start() > at:
            here.children.append(html[at : m.start()])
        at = m.end()
        tag = (m[2] or m[4] or "").lower()
        if not tag:
            continue
        if m[1]:
            if depth.get(tag):
                node = here
                while node.tag != tag:
                    node = node.parent
                close_until(node)
            elif tag in ("p", "br"):
                Node(tag, here)
            continue
        if tag in CLOSES:
            ends, limits = CLOSES[tag]
            while any(depth.get(t) for t in ends):
                node = here
                while node.tag not in ends and node.tag not in limits and node.parent is not None:
                    node = node.parent
                if node.tag not in ends:
                    break
                close_until(node)
        node = Node(tag, here, m[3] or "")
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.IGNORECASE).search(html, at)
            at = end.end() if end else n
        elif tag not in VOID and not (m[3] or "").endswith("/"):
            here = node
            depth[tag] = depth.get(tag, 0) + 1
        elif tag not in VOID and tag in BLOCK:  # "<div/>" opens a div all the same
            here = node
            depth[tag] = depth.get(tag, 0) + 1
    return root


def in_order(root: Node) -> Iterator[Node]:
    stack = [root]
    while stack:
        node = stack.pop()
        yield node
        stack.extend(c for c in reversed(node.children) if isinstance(c, Node) and not c.off)


def drop_boilerplate(root: Node) -> None:
    nodes = list(in_order(root))
    for node in reversed(nodes):
        is_article = node.tag in ("article", "main")
        node.off = node.off or bool(node.words & (FOREIGN if is_article else BOILERPLATE)) and not node.holds
        if (node.holds or is_article) and not node.off and node.parent is not None:
            node.parent.holds = True


def blocks(top: Node, links: bool = False) -> list[tuple[Node, str, int]]:
    """The text blocks below ``top`` in page order: the block's element, its text, how many of its characters are in links."""
    out, parts, linked = [], [], []
    owner = top

    def flush() -> None:
        text = " ".join(unescape("".join(parts)).split())
        if text:
            out.append((owner, text, min(len(text), len(" ".join(unescape(" ".join(linked)).split())))))
        parts.clear()
        linked.clear()

    # (node, block element it is in, whether a link is around it, whether it has been entered)
    stack: list[tuple] = [(top, top, False, False)]
    while stack:
        x, block, link, left = stack.pop()
        if isinstance(x, str):
            if block is not owner:
                flush()
                owner = block
            parts.append(x)
            if link:
                linked.append(x)
            continue
        if left or x.off:
            if left:
                flush()
            continue
        if x.tag == "br":
            parts.append(" ")
            continue
        if x.tag in BLOCK or x is top:
            flush()
            block = owner = x
            stack.append((x, block, link, True))
        link = link or x.tag == "a"
        stack.extend((c, block, link, False) for c in reversed(x.children))
    flush()
    return out


def score(root: Node) -> list[Node]:
    """Gives points to all elements; returns those that have any."""
    touched = {}
    for block, text, linked in blocks(root):
        points = 1 + len(COMMAS.findall(text)) + min(len(text) / 100, 3)
        # A paragraph's points go to what is around it; text that lies in a container itself counts for this container.
        node = block.parent if block.tag in ("p", "pre", "li", "blockquote", "dd", "dt", "td", "th", *HEADING) and block.parent is not None else block
        level, up = 0, node
        while up is not None:
            up.points += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
            level, up = level + 1, up.parent
        up = block
        while up is not None:
            up.text += len(text)
            up.linked += linked
            touched[id(up)] = up
            up = up.parent
    for node in touched.values():
        node.points *= 1 - node.linked / node.text
        if node.tag in ("article", "main"):
            node.points *= 1.5
    return list(touched.values())


def kept_parts(root: Node) -> list[Node]:
    """The best container with the siblings that belong to it, in page order."""
    score(root)
    best = root
    for node in in_order(root):
        if node.tag not in ("#root", "html", "p", *HEADING) and node.text and (best is root or node.points > best.points):
            best = node
    if best.parent is None:
        return [best]
    least = max(0.2 * best.points, 1.0)

    def stays(node: Node) -> bool:
        if node is best:
            return True
        if node.off or not node.text or node.linked > 0.25 * node.text:
            return False
        return node.points >= least or node.tag in HEADING or node.tag == "p" and node.text > 80

    return [c for c in best.parent.children if isinstance(c, Node) and stays(c)]


def main_text(html: str | None) -> str:
    if not html:
        return ""
    root = parse(html)
    drop_boilerplate(root)
    return "\n\n".join(text for part in kept_parts(root) for _, text, _ in blocks(part))


def extracted(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per row: ``key``, ``url``, text, n_chars (code points of the text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, html):
            texts = [main_text(x) for x in batch.column(html).to_pylist()]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(key), batch.column(url), pa.array(texts, pa.string()), sizes], [key, url, "text", "n_chars"])

    kind = pages.schema[key].dataType.simpleString()
    return pages.select(key, url, html).mapInArrow(run, f"`{key}` {kind}, `{url}` string, text string, n_chars long")


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))
