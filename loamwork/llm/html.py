"""Main text of web pages by tree scoring.

A page becomes a tree of blocks. Each paragraph passes points for its length and its commas to its ancestors, less with
each level; a container's points are discounted by the share of its text that lies in links. The best container and those of
its siblings that read like it are kept. What is never article text (menus, headers, footers, forms, scripts, styles, notices,
adverts, sidebars, reader comments) is cut from the tree first, by element, role or the words of its class and id. A block
stays, to be judged by its score, when another name of its class or id is an article's, or when it holds most of the page's
paragraph text outside links and no article is named elsewhere. An article within an article is a comment on it, as is one whose
class or id says so, unless the page has little else. A header is cut with the title in it, in an article as well; a title that
stands in the article itself is kept.

Null and empty html, and pages without text, give an empty text. Markup that is not closed, or closed out of order, is closed
where its parent or a following block ends it; a comment or a tag that is not closed runs to the end of the page. A line break is
white space, an image in a line is nothing. Repeated rows give repeated results; columns other than page_id,
url and html are ignored. A page is handled by itself, so memory is that of the largest page of a task's batch.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from loamwork.llm.common import query, table

# Element names of HTML.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead "
    "tr ul caption".split()
)
_NOT_TEXT = set("script style noscript template head title iframe object svg math canvas audio video select option datalist textarea button".split())
#: Of these, what stands in them is no markup of the page; their end tags can't be left out.
_OPAQUE = set("script style noscript template title iframe svg math".split())
_NOT_ARTICLE = set("nav footer aside form header menu dialog".split())
_ROLES = set("navigation banner contentinfo complementary search menu menubar toolbar dialog alert alertdialog form".split())
_ENDS_P = _BLOCKS - {"body", "html"}
#: An element of the key's kind ends an open one of these, up to the container that holds them.
_ENDED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}
_UNLIKELY = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|nav\w*|menu\w*|breadcrumbs?|sidebar\w*|side|rail|aside|widget\w*|footer|foot|"
    r"header|masthead|topbar|toolbar|comments?|commentlist|disqus\w*|replies|reply|respond|responses?|discussion|reactions|talkback|guestbook|kommentare?|commentaires?|comentarios?|cookies?|consent|gdpr|notices?|alerts?|"
    r"popup|modal|overlay|newsletter|subscri\w+|signup|login|share|sharing|social|related|recommend\w*|pagination|pager|tags|legal|disclaimer|"
    r"copyright|skip\w*|outbrain|taboola)(?:$|[\s_-])", re.I,
)
_LIKELY = re.compile(r"article|body|content|entry|main|post|story|text|blog", re.I)
_SPACE = re.compile(r"\s+")
_UNCLOSED = re.compile(r"<[!?/a-zA-Z]")
_PARAGRAPHS = {"p", "pre", "td", "blockquote", "li", "dd", "h1", "h2", "h3", "h4", "h5", "h6", "figcaption"}


class _Node:
    __slots__ = ("tag", "parent", "children", "score", "likely", "link", "n_text", "n_link", "cut", "doubted")

    def __init__(self, tag, parent, likely=0, link=False, cut=False):
        self.cut, self.doubted = cut, False
        self.tag, self.parent, self.children, self.score = tag, parent, [], 0.0
        self.likely, self.link, self.n_text, self.n_link = likely, link, 0, 0


class _Tree(HTMLParser):
    """Blocks, inline elements and text. What can't be article text stands in the tree while it is open, so that it is closed
    like all else, but is not among the children of its parent."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = _Node("body", None)
        self.doubted: list[_Node] = []

    def handle_starttag(self, tag, attrs):
        if self.at.tag in _OPAQUE:
            # Only an element of the same name can nest.
            if tag == self.at.tag:
                self.at = _Node(tag, self.at, cut=True)
            return
        if tag in _BLOCKS or tag == "body":
            self._make_room(tag)
        if tag in _VOID:
            if tag in ("br", "hr"):
                self.at.children.append(" ")
            return
        if tag in ("html", "body"):
            return
        names = dict(attrs)
        label = f"{names.get('class') or ''} {names.get('id') or ''}".strip()
        likely = 1 if tag in ("article", "main") or label and _LIKELY.search(label) else 0
        hidden = "hidden" in names or names.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", names.get("style") or "")
        # A page header is cut, an article's own heading group is not told from it by its element.
        unlikely = tag in _NOT_TEXT or tag in _NOT_ARTICLE or (names.get("role") or "").lower() in _ROLES or hidden
        # An article in an article is related to it, as comments are.
        doubted = tag == "article" and self._within_article()
        likely = 0 if doubted else likely
        if not unlikely and not doubted and tag in _BLOCKS | {"span", "a", "ins"} and tag != "main" and label and _UNLIKELY.search(label):
            # A wrapper may be named after what stands beside its article.
            if tag not in _BLOCKS:
                unlikely = True
            else:
                doubted = not any(_LIKELY.search(name) and not _UNLIKELY.search(name) for name in label.split())
                likely = 0 if doubted and tag == "article" else likely
        node = _Node(tag, self.at, likely, tag == "a" and "href" in names, bool(unlikely) or self.at.cut)
        if not node.cut:
            self.at.children.append(node)
            node.doubted = doubted
            if doubted:
                self.doubted.append(node)
        self.at = node

    def handle_startendtag(self, tag, attrs):
        # HTML ignores the slash.
        self.handle_starttag(tag, attrs)

    def _within_article(self):
        node = self.at
        while node is not None and node.tag != "article":
            node = node.parent
        return node is not None

    def _make_room(self, tag):
        """Close what the start of a block ends: an open paragraph with its inline elements, a list item, a table cell, the head."""
        node = self.at
        while node.parent is not None and node.tag != "head":
            node = node.parent
        if node.tag == "head":
            self.at = node.parent
        if tag in _ENDS_P:
            node = self.at
            while node.parent is not None and node.tag not in _BLOCKS:
                node = node.parent
            if node.tag == "p":
                self.at = node.parent
        if tag in _ENDED_BY:
            ended, within = _ENDED_BY[tag]
            node, found = self.at, None
            while node.parent is not None and node.tag not in within:
                if node.tag in ended:
                    found = node
                node = node.parent
            if found is not None:
                self.at = found.parent

    def handle_endtag(self, tag):
        if self.at.tag in _OPAQUE and tag != self.at.tag:
            return
        node = self.at
        while node.parent is not None and node.tag != tag:
            # The end of an inline element does not close blocks around it.
            if tag not in _BLOCKS and node.tag in _BLOCKS:
                return
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        if not self.at.cut:
            self.at.children.append(data)


def _measure(root: _Node) -> list[_Node]:
    """Text and link lengths of all nodes, and the nodes with children before their parents."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(c for c in node.children if isinstance(c, _Node))
    order.reverse()
    for node in order:
        for child in node.children:
            if isinstance(child, _Node):
                node.n_text += child.n_text
                node.n_link += child.n_text if child.link else child.n_link
            else:
                node.n_text += len(_SPACE.sub(" ", child))
    return order


def _own_text(node: _Node) -> str:
    """Text of a block without the blocks in it."""
    parts, stack = [], [iter(node.children)]
    while stack:
        child = next(stack[-1], None)
        if child is None:
            stack.pop()
        elif isinstance(child, str):
            parts.append(child)
        elif child.tag not in _BLOCKS:
            stack.append(iter(child.children))
    return _SPACE.sub(" ", "".join(parts)).strip()


def _density(node: _Node) -> float:
    return node.n_link / node.n_text if node.n_text else 0.0


def _settle(root: _Node) -> None:
    """Cut the doubted blocks that don't hold the page's main text, outer ones first."""
    stack, order = [root], []
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(c for c in node.children if isinstance(c, _Node))
    # Lengths of text in paragraphs, of the part in links, of that in articles by name, of that outside doubted blocks, and of
    # that in articles within doubted blocks. A doubted block is no part of the article around it.
    held: dict[_Node, tuple[int, ...]] = {}
    for node in reversed(order):
        inner = [held[c] for c in node.children if isinstance(c, _Node)]
        text, linked, likely, plain, within = map(sum, zip(*inner)) if inner else (0, 0, 0, 0, 0)
        if node.tag in _BLOCKS:
            own = len(_own_text(node))
            own = own if node.tag in _PARAGRAPHS or own >= 25 else 0
            text, plain = text + own, plain + own
        if node.link:
            linked = sum(len(c) for c in node.children if isinstance(c, str)) + linked
        if node.doubted:
            plain, within = 0, likely
        elif node.likely:
            likely = plain + within
        held[node] = (text, linked, likely, plain, within)
    text, _, likely, _, _ = held[root]
    stack = [root]
    while stack:
        node = stack.pop()
        kept = []
        for child in node.children:
            if isinstance(child, _Node):
                if child.doubted:
                    inside, linked, named, _, _ = held[child]
                    if 2 * inside <= text or 4 * linked > inside or 10 * (likely - named) > inside:
                        continue
                stack.append(child)
            kept.append(child)
        node.children = kept


def _chosen(root: _Node) -> list[_Node]:
    """The best container and the siblings that belong to it, in page order."""
    order = _measure(root)
    candidates = []
    for node in order:
        if node.tag not in _BLOCKS:
            continue
        text = _own_text(node)
        if not text or node.tag not in _PARAGRAPHS and len(text) < 25:
            continue
        points = 1 + text.count(",") + min(len(text) / 100, 3)
        # Text that stands in a container itself counts for the container.
        above, level = (node, 0) if node.tag not in _PARAGRAPHS else (node.parent, 0)
        while above is not None and level < 4:
            if above.score == 0:
                candidates.append(above)
            above.score += points / (1, 2, 6, 9)[level]
            above, level = above.parent, level + 1
    if not candidates:
        return [root]
    for node in candidates:
        node.score *= (1 + 0.25 * node.likely) * (1 - _density(node))
    best = max(candidates, key=lambda n: n.score)
    # An article element, or one container with nearly all that is left, holds all of its sections.
    node = best
    while node.parent is not None:
        node = node.parent
        if node.tag in ("article", "main") or node.score > 0.75 * best.score:
            best = node if node.tag != "body" else best
    if best.parent is None:
        return [best]
    limit, kept = max(3.0, 0.2 * best.score), []
    for child in best.parent.children:
        if not isinstance(child, _Node):
            continue
        text = _own_text(child) if child.tag in ("p", "pre", "blockquote") else ""
        reads = text and _density(child) < 0.25 and (len(text) > 80 or re.search(r"[.!?](\s|$)", text))
        if child is best or child.tag in _BLOCKS and child.score >= limit or reads or child.tag == "h1" and _density(child) < 0.25:
            kept.append(child)
    return kept


def _blocks(node: _Node) -> list[str]:
    """Texts of the blocks below a node, in page order. Text around inner blocks makes blocks of its own."""
    out, run = [], []

    def close():
        text = _SPACE.sub(" ", "".join(run)).strip()
        if text:
            out.append(text)
        run.clear()

    stack = [(iter([node]), False)]
    while stack:
        child = next(stack[-1][0], None)
        if child is None:
            if stack.pop()[1]:
                close()
        elif isinstance(child, str):
            run.append(child)
        else:
            block = child.tag in _BLOCKS
            if block:
                close()
            stack.append((iter(child.children), block))
    close()
    return out


def main_text(html: str | None) -> str:
    """The main text of a page, a line per block."""
    if not html:
        return ""
    tree = _Tree()
    tree.feed(html)
    # What is left is the start of something unclosed; all but text ends with the page.
    if _UNCLOSED.match(tree.rawdata):
        tree.rawdata = ""
    tree.close()
    if tree.doubted:
        _settle(tree.root)
    return "\n".join(t for node in _chosen(tree.root) for t in _blocks(node))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            texts = [main_text(h.as_py()) for h in part.column("html")]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html")
    return rows.mapInArrow(_extract, "page_id bigint, url string, text string, n_chars bigint")


@query("op2_html_text")
def html_text(spark: SparkSession, folder: str) -> DataFrame:
    return extract(table(spark, folder, "pages"))
