"""Main text of web pages: paragraphs score their ancestors, the best container and its siblings stay."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# Values end at their quote, unquoted ones at white space; what opens a quote and never closes it ends with the tag.
_ATTRS = r"(?>=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*)?|[^>=])*+"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>script|style|textarea|title|noscript|template|iframe|svg|xmp)(?=[\s/>]){_ATTRS}(?:>|\Z).*?(?:</(?P=raw)\s*>|\Z)"
    rf"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>{_ATTRS})(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|[^<]+|<", re.S | re.I)
_NAMED = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*))?")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby "
                   "s samp small span strike strong sub sup time tt u var wbr "
                   "math semantics mi mn mo ms mtext mrow mfrac msqrt mroot msub msup msubsup munder mover munderover".split())
PARAGRAPH = frozenset("p pre td th blockquote li dd dt h1 h2 h3 h4 h5 h6 figcaption".split())
# Never part of a text, whatever they are called.
NEVER = frozenset("nav footer aside form button select option input menu dialog object applet audio video canvas map "
                  "head script style noscript template iframe svg annotation".split())
# Words in class, id or role that mark furniture, and those that mark the text itself.
FURNITURE = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promotion banner nav navbar "
    "navigation menu menubar breadcrumb breadcrumbs pagination pager sidebar sidebars aside complementary footer foot "
    "contentinfo header masthead topbar toolbar cookie cookies consent gdpr notice notices alert popup modal overlay "
    "dialog newsletter subscribe subscription signup login register search searchbox form share sharing social related "
    "recommended recommendations widget widgets teaser skip toc hidden".split())
READERS = frozenset("comment comments commentlist disqus guestbook".split())
TEXT = frozenset("article content main post story entry body text page wrapper container".split())
# A name of one of these and words like those below is the readers' part; of several comments, also with a word for the text.
AROUND = frozenset("user users reader readers visitor visitors body thread threads text content wrapper container".split())
# Furniture that a word for text beside it doesn't excuse, as in "cookie-consent-text".
SURELY = frozenset("cookie cookies consent gdpr newsletter advert adverts advertisement advertising".split())
# These may as well name a section of a text.
TALK = frozenset("reply replies respond discussion reviews".split())
# Words that go with those in a name of furniture, as in "ad-box-2"; other words make it another name.
BESIDE = frozenset("box block bar top bottom left right inner outer site list item items area panel unit slot group link links "
                   "button buttons icon icons global primary secondary col column row section".split())
# An open element of the first kind ends where one of the second begins.
_LISTS = {"li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "option": ({"option"}, {"select"})}

_KNOWN = FURNITURE | READERS | TALK | BESIDE


class Node:
    __slots__ = ("tag", "up", "kids", "size", "linked", "commas", "score", "here", "near", "far", "para", "lost", "named",
                 "in_text", "quoted")

    def __init__(self, tag: str, up: "Node | None") -> None:
        self.tag, self.up, self.kids = tag, up, []
        self.size = self.linked = self.commas = 0
        self.score = self.here = self.near = self.far = 0.0
        self.para = self.named = False
        self.lost = up is not None and up.lost
        self.in_text = up is not None and (up.in_text or up.tag in ("article", "main"))
        self.quoted = up is not None and (up.quoted or up.tag == "blockquote")


def _furniture(tag: str, attrs: str, in_text: bool) -> tuple[bool, bool]:
    """Whether an element is furniture for certain, by tag or as hidden or readers' part, and whether by its name.

    A name counts when all its words belong to furniture. Headings, paragraphs
    and the like within an article are text whatever they are called.
    """
    if tag in NEVER and tag != "form":
        return True, False
    named = tag == "form" or tag == "header" and not in_text
    if not attrs or tag in ("html", "body"):
        return False, named
    parts: set[str] = set()
    names: list[set[str]] = []
    for name, value in _NAMED.findall(attrs):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True, False
        if name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return True, False
        elif name in ("class", "id", "role", "itemprop"):
            for one in value.split():
                own = {p.lower() for p in _NAME_PART.findall(one) if not p.isdigit()}
                names.append(own)
                parts |= own
    if in_text and tag in PARAGRAPH:
        return False, named
    if any(n & READERS and n <= (_KNOWN | AROUND | TEXT if n & READERS != {"comment"} else _KNOWN | AROUND) for n in names):
        return True, False
    if any(n & SURELY and n <= _KNOWN | AROUND for n in names):
        return False, True
    marks = FURNITURE if in_text else FURNITURE | TALK
    marked = any(n & marks and n <= _KNOWN for n in names)
    return False, named or marked and not parts & TEXT and tag not in ("article", "main")


def parse(page: str) -> list[Node]:
    """The page's elements in order, parents first, without those that are furniture for certain."""
    root = Node("#root", None)
    nodes, now = [root], root
    # how many elements of each tag are open: an end tag or list item that has nothing to end walks nowhere
    opened: Counter[str] = Counter()

    def leave(to: Node) -> Node:
        at = now
        while at is not to:
            opened[at.tag] -= 1
            at = at.up
        return to

    for m in _TOKEN.finditer(page):
        tag = m["tag"]
        if tag is None:
            text = m[0]
            if text[0] != "<" or text == "<":
                now.kids.append(text)
            continue
        tag = tag.lower()
        if m["end"]:
            at = now if opened[tag] else root
            while at.up is not None and at.tag != tag:
                if tag in INLINE and at.tag not in INLINE:
                    at = root
                    break
                at = at.up
            if at.up is not None:
                now = leave(at.up)
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                now.kids.append(" " if tag == "br" else Node("hr", now))
            continue
        if tag not in INLINE:
            ends = at = now
            if tag in _LISTS:
                ended, within = _LISTS[tag]
                while at.up is not None and at.tag not in within and any(opened[t] for t in ended):
                    if at.tag in ended:
                        ends = at.up
                    at = at.up
            else:
                while at.up is not None and (at.tag in INLINE or at.tag == "p"):
                    if at.tag == "p":
                        ends = at.up
                    at = at.up
            now = leave(ends)
        node = Node(tag, now)
        if not node.lost and not (tag == "footer" and node.quoted):
            node.lost, node.named = _furniture(tag, m["attrs"], node.in_text)
        if not node.lost:
            now.kids.append(node)
            nodes.append(node)
        opened[tag] += 1
        now = node
    return nodes


def _measure(nodes: list[Node]) -> None:
    """Sizes and points from the leaves up, each element once.

    A paragraph's points count whole for its box, half for the box around it,
    then a sixth, and by a third less with each level further out.
    """
    for n in nodes:
        n.size = n.linked = n.commas = 0
        n.here = n.near = n.far = 0.0
        n.para = False
    for n in reversed(nodes):
        para = False
        for k in n.kids:
            if isinstance(k, str):
                t = len(k.strip())
                n.size += t
                n.commas += k.count(",") if t else 0
            else:
                n.size += k.size
                n.linked += k.linked
                n.commas += k.commas
                n.near += k.here
                n.far += k.near / 6 + k.far * 2 / 3
                para = para or k.para
        if n.tag == "a":
            n.linked = n.size
        n.para = para or n.tag in PARAGRAPH and n.size > 0
        # The innermost paragraphs count, and loose text counts for its own box.
        if n.size and not para:
            points = 1 + n.commas + min(n.size / 100, 3)
            if n.tag in PARAGRAPH:
                if n.up is not None:
                    n.up.here += points
            elif n.tag not in INLINE and any(isinstance(k, str) and k.strip() for k in n.kids):
                n.here += points
        n.score = (n.here + n.near / 2 + n.far) * (1 - n.linked / n.size if n.size else 1)


def _named_gone(nodes: list[Node]) -> list[Node]:
    """Without the elements that are furniture by name, save those that hold the page's text.

    If all articles lie in such elements, or there is none, the elements around
    the best-scoring container stay.
    """
    if not any(n.named for n in nodes):
        return nodes
    inside, article = set(), set()
    for n in nodes:
        if n.named or n.up in inside:
            inside.add(n)
        if n.tag in ("article", "main") or n.up in article:
            article.add(n)
    if article <= inside:
        _measure(nodes)
        boxes = [n for n in nodes if n.tag not in INLINE and n.tag not in PARAGRAPH and n.size and n.score > 0
                 and (n in article or not article)]
        at = max(boxes, key=lambda n: n.score, default=None)
        while at is not None:
            at.named = False
            at = at.up
    gone, left = set(), []
    for n in nodes:
        if n.named or n.up in gone:
            gone.add(n)
        else:
            left.append(n)
    for n in {n.up for n in gone} - gone:
        n.kids = [k for k in n.kids if isinstance(k, str) or k not in gone]
    return left


def _chosen(nodes: list[Node]) -> list[Node]:
    """The best container, widened to the article it lies in, and the siblings that go with it.

    A page with a main part, or with one article, has its container there
    whatever outweighs it, unless that part is links or has no paragraph; of
    what stands beside it, only headings, paragraphs and the like go with it.
    """
    boxes = [n for n in nodes if n.tag not in INLINE and n.tag not in PARAGRAPH and n.size and n.score > 0]
    if not boxes:
        return []
    alone = False
    for tag in ("main", "article"):
        parts = [n for n in nodes if n.tag == tag and n.para and n.score > 0 and n.linked < n.size / 2]
        parts = [n for n in parts if not n.in_text or tag == "main"]
        if len(parts) == 1:
            inside = {parts[0]}
            for n in nodes:
                if n.up in inside:
                    inside.add(n)
            boxes, alone = [n for n in boxes if n in inside], True
            break
    best = max(boxes, key=lambda n: n.score)
    at, article = best, None
    while at is not None:
        if at.tag in ("article", "main") and (article is None or article.tag != "article" or at.tag == "article"):
            article = at
        at = at.up
    if article is not None:
        best = article
    if best.up is None:
        return [best]
    out = []
    for k in best.up.kids:
        if not isinstance(k, Node):
            continue
        share = k.linked / k.size if k.size else 1.0
        if k is best or (k.tag == best.tag == "article" or k.tag not in ("article", "main")) and k.size and (
                not alone and k.score >= max(10, best.score / 5) and share < 0.5
                or k.tag in PARAGRAPH and share < 0.25):
            out.append(k)
    return out


def extract(page: str) -> str:
    """Main text of one page: blocks in page order, one per line."""
    nodes = _named_gone(parse(page))
    _measure(nodes)
    blocks: list[str] = []
    parts: list[str] = []

    def end_block() -> None:
        if parts:
            block = " ".join(html.unescape("".join(parts)).split())
            if block:
                blocks.append(block)
            parts.clear()

    for top in _chosen(nodes):
        todo: list = [top]
        while todo:
            k = todo.pop()
            if k is None:
                end_block()
            elif isinstance(k, str):
                parts.append(k)
            else:
                if k.tag not in INLINE:
                    end_block()
                    todo.append(None)
                todo.extend(reversed(k.kids))
        end_block()
    return "\n".join(blocks)


def main_text(pages: DataFrame, html_col: str = "html", id_cols: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """One row per page: the id columns, text and n_chars (code points).

    NULL, empty and text-free pages give an empty text, an empty table gives an
    empty result. Rows are worked on where they are, without a shuffle; equal
    rows give equal results, a NULL id is kept. Long pages take time in
    proportion to their length. Columns other than the id columns are left out.
    """
    source = pages.select(*id_cols, pages[html_col].cast("string").alias("__html"))
    schema = ", ".join(f"`{n}` {t}" for n, t in source.drop("__html").dtypes) + ", text string, n_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                texts = [extract(p.as_py() or "") for p in part.column(len(id_cols))]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    [*id_cols, "text", "n_chars"])

    return source.mapInArrow(run, schema)
