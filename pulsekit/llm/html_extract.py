"""Main text of HTML pages by tree scoring.

A page is parsed into a tree without the elements that can't be article text. Paragraphs earn points for length and
commas, discounted by the share of their text in links, and pass them to their ancestors with distance. The container
with most points and those of its siblings that belong to it are the article; its blocks are the text. Each page is
independent, so the plan is one pass over the pages without a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.llm.common import blocks

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset((
    "address article blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr html legend li main ol p pre section summary table tbody td tfoot th thead tr ul").split())
#: Elements whose start ends an open paragraph.
ENDS_P = BLOCK - frozenset("body caption dd dt html legend li tbody td tfoot th thead tr".split()) | frozenset(
    "aside footer menu nav search".split())
#: Start tags that end an open element of these names, as far as one of the limits.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "thead": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}), "option": ({"option"}, {"select"}),
    "body": ({"head"}, {"html"}),
}
#: Elements that are never article text.
DROPPED = frozenset((
    "applet aside audio button canvas dialog embed footer head iframe input label map menu nav noscript object option "
    "script search select style svg template textarea title video").split())
ROLES = frozenset((
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search tablist toolbar").split())
#: Words in class or id that mark what is around an article. "header" counts outside of the article only.
MARKS = frozenset((
    "ad ads adbox adslot adsense adv advert adverts advertisement advertisements advertising banner banners breadcrumb "
    "breadcrumbs comment comments commentlist consent cookie cookies copyright disqus footer gdpr login masthead menu "
    "menubar modal nav navbar navigation newsletter notice notices overlay pager pagination paging popup promo promoted "
    "promotion recommended related replies respond share sharing sidebar sidenav signin signup skip social sponsor "
    "sponsored subscribe subscription toolbar topbar widget widgets").split())
#: Words that say nothing about what a box holds: inside of an article a class or id marks only if all of its other
#: words do.
PLAIN = frozenset((
    "area bar block body box btn button buttons card cards container content group holder inline inner item items link "
    "links list panel post posts section slot small top unit wrap wrapper").split())
COMMENT_MARKS = frozenset(("comment", "comments", "commentlist", "disqus", "respond", "replies"))
_PROTECTED = frozenset(("html", "body", "article", "main"))
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_INVISIBLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_COMMAS = re.compile("[,،、，；;]")
# Quotes count after an equals sign only. A tag, comment or raw element that never ends takes the rest of the page, as
# in browsers; so nothing is scanned twice.
_TAG = re.compile(r"""</?([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|(?=[^"'\s])|\Z))*+)>""")
_ATTR = re.compile(r"""([^\s/>="']++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]++)))?+""")
_COMMENT_END = re.compile(r"--!?>")
_RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*+>", re.I) for tag in _RAW}

MIN_PARAGRAPH = 25
LEVELS = 5
LIST_LINK_SHARE = 0.66


class _Node:
    __slots__ = ("block", "children", "chars", "commas", "link_chars", "links", "own_chars", "own_commas", "own_link_chars", "parent",
                 "score", "skip", "tag", "wrapper")

    def __init__(self, tag: str, parent: _Node | None, skip: bool):
        self.tag, self.parent, self.skip = tag, parent, skip
        self.block = self if parent is None or tag in BLOCK else parent.block
        self.children: list[_Node | str] = []
        self.chars = self.link_chars = self.links = self.commas = 0
        self.own_chars = self.own_commas = self.own_link_chars = 0
        self.score, self.wrapper = 0.0, False

    def link_share(self) -> float:
        return self.link_chars / self.chars if self.chars else 0.0


def _attributes(raw: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, *values in _ATTR.findall(raw) if raw and not raw.isspace() else ():
        value = "".join(values)
        found.setdefault(name.lower(), unescape(value) if "&" in value else value)
    return found


class _Tree:
    """Builds the tree; optional end tags are supplied, unmatched ones ignored, dropped elements keep no text."""

    def __init__(self):
        self.root = _Node("#root", None, False)
        self.nodes = [self.root]
        self.stack = [self.root]
        self.open: Counter[str] = Counter()

    def _pop_to(self, depth: int) -> None:
        for node in self.stack[depth:]:
            self.open[node.tag] -= 1
        del self.stack[depth:]

    def _end(self, names: set[str], limits: set[str]) -> None:
        if not any(self.open[n] for n in names):
            return
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].tag in names:
                self._pop_to(depth)
                return
            if self.stack[depth].tag in limits:
                return

    def _unwanted(self, tag: str, attrs: dict[str, str]) -> bool:
        if tag in DROPPED:
            return True
        inside = self.open["article"] or self.open["main"]
        if tag == "header" and not inside:
            return True
        if not attrs:
            return False
        if "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true":
            return True
        if attrs.get("role", "").lower() in ROLES and tag not in _PROTECTED:
            return True
        if _INVISIBLE.search(attrs.get("style", "")):
            return True
        named = f"{attrs.get('class', '')} {attrs.get('id', '')}"
        words = set(re.split(r"[^a-z0-9]+", _CAMEL.sub(" ", named).lower()))
        if tag in _PROTECTED:
            return tag == "article" and bool(words & COMMENT_MARKS)
        if tag in _HEADINGS:
            return bool(words & COMMENT_MARKS)
        if inside:
            parts = (set(re.split(r"[^a-z0-9]+", _CAMEL.sub(" ", n).lower())) - {""} - PLAIN for n in named.split())
            return any(p and p <= MARKS for p in parts)
        return bool(words & MARKS) or "header" in words

    def start(self, tag: str, attrs: str) -> None:
        if tag in ENDS_P and self.open["p"]:
            self._end({"p"}, {"article", "aside", "button", "caption", "div", "footer", "header", "html", "main", "nav",
                              "object", "section", "table", "td", "th"})
        if tag in ENDS:
            self._end(*ENDS[tag])
        if tag == "a":
            self._end({"a"}, {"td", "th", "table"})
        parent = self.stack[-1]
        if tag == "br":
            if not parent.skip:
                parent.children.append(" ")
            return
        if tag in VOID:
            if tag in BLOCK and not parent.skip:  # a rule parts blocks
                node = _Node(tag, parent, False)
                parent.children.append(node)
                self.nodes.append(node)
            return
        node = _Node(tag, parent, parent.skip or self._unwanted(tag, _attributes(attrs)))
        if not node.skip:
            parent.children.append(node)
            self.nodes.append(node)
            if tag == "a":
                node.links = 1
            elif tag in ("article", "main", "h1") and self.open["form"]:
                for above in self.stack:
                    above.wrapper |= above.tag == "form"
        self.stack.append(node)
        self.open[tag] += 1

    def read(self, html: str) -> None:
        """Text, tags, comments and raw elements in order; a slash at a tag's end has no meaning."""
        at, text_from = 0, 0
        while True:
            at = html.find("<", at)
            if at < 0 or at + 1 == len(html):
                self.text(html[text_from:])
                return
            sign = html[at + 1]
            if not (sign in "!?" or sign == "/" and html[at + 2:at + 3] or sign.isascii() and sign.isalpha()):
                at += 1
                continue
            self.text(html[text_from:at])
            if html.startswith("<!--", at):
                end = _COMMENT_END.search(html, at + 2)  # <!--> is a whole comment
                after = end.end() if end else -1
            elif sign in "!?" or sign == "/" and not (html[at + 2].isascii() and html[at + 2].isalpha()):
                after = html.find(">", at) + 1 or -1
            elif tag := _TAG.match(html, at):
                name, after = tag.group(1).lower(), tag.end()
                if sign == "/":
                    self.end(name)
                elif name in _RAW:
                    end = _RAW_END[name].search(html, after)
                    after = end.end() if end else -1
                else:
                    self.start(name, tag.group(2))
            else:
                after = -1
            if after < 0:
                return
            at = text_from = after

    def end(self, tag: str) -> None:
        if not self.open[tag]:
            return
        block = tag in BLOCK or tag in DROPPED
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].tag == tag:
                self._pop_to(depth)
                return
            if not block and self.stack[depth].tag in BLOCK:
                return

    def text(self, data: str) -> None:
        node = self.stack[-1]
        if node.skip or not data:
            return
        data = unescape(data) if "&" in data else data
        node.children.append(data)
        n = len(data) if data.strip() else 0
        if n:
            commas = len(_COMMAS.findall(data))
            node.chars += n
            node.commas += commas
            linked = bool(self.open["a"])
            if linked:
                node.link_chars += n
            block = node.block
            block.own_chars += n
            block.own_commas += commas
            block.own_link_chars += n if linked else 0


def parse(html: str) -> _Tree:
    tree = _Tree()
    tree.read(html)
    for node in reversed(tree.nodes):  # children come after their parents
        if node.tag == "form" and not node.wrapper:
            node.skip = True
        if node.parent is not None and not node.skip:
            node.parent.chars += node.chars
            node.parent.link_chars += node.link_chars
            node.parent.links += node.links
            node.parent.commas += node.commas
    return tree


def _score(tree: _Tree) -> None:
    """Points of paragraphs go to the parent in full, to its parent by half, then by a third of the level."""
    for node in tree.nodes:
        if node.skip or node.own_chars < MIN_PARAGRAPH or node.tag not in BLOCK:
            continue
        points = (1 + node.own_commas + min(node.own_chars // 100, 3)) * (1 - node.own_link_chars / node.own_chars)
        above = node.parent if node.tag not in ("div", "section", "article", "main", "body") else node
        for level in range(LEVELS):
            if above is None:
                break
            above.score += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
            above = above.parent
    for node in tree.nodes:
        node.score *= 1 - node.link_share()


def _belongs(node: _Node, best: _Node) -> bool:
    """Whether a sibling of the best container is part of the article."""
    if node.skip or not node.chars:
        return False
    if node.tag in _HEADINGS or node.score >= max(10.0, best.score * 0.2):
        return True
    if node.tag == "p":
        return node.link_share() < 0.25 if node.chars > 80 else node.links == 0
    return False


def _container(tree: _Tree) -> list[_Node]:
    _score(tree)
    live = [n for n in tree.nodes if not n.skip and n.chars and n.tag in BLOCK]
    if not live:
        return [tree.root]
    best = max(live, key=lambda n: n.score)
    if not best.score:  # nothing as long as a paragraph: the first article there is, else the page
        return [next((n for tag in ("article", "main", "body") for n in live if n.tag == tag), tree.root)]
    for tag in ("article", "main"):
        above = best
        while above is not None:
            if above.tag == tag:
                best = above
                break
            above = above.parent
        if best.tag == tag:
            break
    if best.parent is None or best.tag in ("body", "html"):
        return [best]
    return [n for n in best.parent.children if isinstance(n, _Node) and (n is best or _belongs(n, best))]


def _is_link_list(node: _Node) -> bool:
    if node.tag in ("div", "section") and any(isinstance(c, _Node) and c.tag == "p" for c in node.children):
        return False  # linked paragraphs
    return (node.tag in ("ul", "ol", "dl", "div", "section", "table") and node.links >= 2
            and node.link_share() > LIST_LINK_SHARE)


def _in_article(node: _Node) -> bool:
    while node is not None and node.tag not in ("article", "main"):
        node = node.parent
    return node is not None


def blocks_of(tops: list[_Node]) -> list[str]:
    """Texts of the blocks in page order, white space turned to single spaces.

    Lists of links go where no article or main element tells the article from what is around it; in one, they are the
    article's own. The tops themselves always stay.
    """
    out: list[str] = []
    held: list[str] = []

    def flush() -> None:
        text = " ".join("".join(held).split())
        if text:
            out.append(text)
        held.clear()

    todo: list = list(reversed(tops))
    kept = {id(n) for n in tops}
    marked = bool(tops) and all(map(_in_article, tops))
    while todo:
        item = todo.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            held.append(item)
        elif not (item.skip or not marked and id(item) not in kept and _is_link_list(item)):
            if item.tag in BLOCK:
                flush()
                todo.append(None)
            todo.extend(reversed(item.children))
    flush()
    return out


def main_text(html: str | None) -> str:
    """The article of a page, blocks joined by an empty line; empty if there is none."""
    return "\n\n".join(blocks_of(_container(parse(html)))) if html else ""


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in blocks(batches, "html"):
        texts = [main_text(html) for html in part.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string())],
                                         names=["page_id", "url", "text"])


def extract_main_text(pages: DataFrame) -> DataFrame:
    """Main text of every page (page_id, url, html; other columns are ignored), one row per input row.

    Returns page_id, url, text, n_chars (code points). A null or empty page, or one without text, has the empty text;
    repeated rows are extracted each; null page_id and url stay null.
    """
    source = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    kind = pages.schema["page_id"].dataType.simpleString()
    return (source.mapInArrow(_extract, f"page_id {kind}, url string, text string")
            .withColumn("n_chars", F.length("text").cast("long")))
