"""The main text of web pages, by the distribution of text over line blocks.

Markup is stripped into lines, one per block of the page. Each line weighs the
characters that may be prose: text of links counts nothing, nor does what stands in menus, headers,
footers, sidebars, notices, adverts, forms and reader comments. The weights of a few
consecutive lines add up to a line block. Where the sums surge above a threshold a stretch of
text begins, and where they dive below another it ends; the lines between are kept. Lines that are all link and border on kept
ones are kept inside an article or main element, where such lines are titles and references rather than menus.

A page is read once from front to back, whatever stands in it: no tag, quote or open element is searched for twice.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class MainTextOptions:
    """window: lines of a block; surge: a block with so many characters outside links begins a stretch, and in a page where none has so
    many the heaviest does; dive: a block with fewer ends it; article: hundredths of the page's weight that an article or main element has
    to hold for text beside it to go."""

    window: int = 3
    surge: int = 25
    dive: int = 1
    article: int = 20


#: Elements whose content is no text of the page.
_SKIPPED = {"script", "style", "noscript", "template", "head", "title", "svg", "math", "iframe", "object", "canvas", "audio", "video", "textarea", "select", "datalist"}
#: Elements that hold no article text.
_ASIDE = {"nav", "footer", "aside", "form", "button", "menu", "dialog", "fieldset", "input"}
#: Words that say so of any element, alone or as a part of a class or id.
_ASIDE_PARTS = {
    "ad", "ads", "adsense", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comments", "consent", "cookie", "cookies",
    "disqus", "footer", "masthead", "modal", "nav", "navbar", "navigation", "newsletter", "overlay", "pager", "pagination", "popup", "promo", "sidebar", "signup",
    "sponsor", "sponsored", "subscribe", "subscription", "toolbar", "topbar",
}
#: Whole classes and ids that say so; as parts of others they name parts of articles too.
_ASIDE_WHOLE = {
    "alert", "alerts", "comment", "form", "header", "login", "menu", "notice", "notices", "rail", "recommended", "related", "related-posts", "related-articles", "replies",
    "respond", "search", "search-form", "share", "sharing", "share-buttons", "side-bar", "site-header", "page-header", "site-menu", "main-menu", "social", "social-links",
    "social-share", "widget", "widgets",
}
#: Elements of running text, which only the first of these lists puts aside once they stand in an article.
_TEXT = {"p", "li", "dd", "dt", "td", "th", "blockquote", "pre", "h1", "h2", "h3", "h4", "h5", "h6", "figcaption", "caption"}
_ASIDE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert"}
#: Elements that do not break a line.
_INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp",
    "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "picture", "source",
}
#: Elements without content.
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: An element that ends when one of its kind, or of the others named, begins.
_ENDED_BY = {"p": None, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}

_NAME = re.compile(r"/?[a-zA-Z][^\s/>]*")
# up to the end of a tag; quotes count after an equals sign only
_REST = re.compile(r"(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+>")
_ATTRIBUTE = re.compile(r"([^\s=/>]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?+")
_PARTS = re.compile(r"[^\s_-]+")


def _is_aside(name: str, attributes: str, in_article: bool) -> bool:
    if name in _ASIDE or name == "header" and not in_article:
        return True
    if name in ("html", "body", "article", "main") or not attributes or attributes.isspace():
        return False
    for key, *values in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values).lower()
        if key in ("class", "id"):
            if any(p in _ASIDE_PARTS for p in _PARTS.findall(value)):
                return True
            if not (in_article and name in _TEXT) and any(x in _ASIDE_WHOLE for x in value.split()):
                return True
        if key == "role" and value in _ASIDE_ROLES or key == "aria-hidden" and value == "true" or key == "hidden":
            return True
    return False


@dataclass
class Line:
    """text of a block, its characters outside links, whether it is part of an aside, whether it is in the article element."""

    text: str
    weight: int
    aside: bool
    article: bool


class _Reader:
    """The lines of one page. Open elements are a stack; the places of each name, and of those that are blocks, are kept beside it."""

    def __init__(self) -> None:
        self.lines: list[Line] = []
        self.pieces: list[tuple[str, bool]] = []  # text, and whether it is a link's
        self.stack: list[tuple[str, bool, bool]] = []  # open elements: name, aside, article
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.links = 0

    @property
    def aside(self) -> bool:
        return bool(self.stack) and self.stack[-1][1]

    @property
    def article(self) -> bool:
        return bool(self.stack) and self.stack[-1][2]

    def text(self, piece: str) -> None:
        self.pieces.append((piece, self.links > 0))

    def end_line(self) -> None:
        if self.pieces:
            text = " ".join(html.unescape("".join(t for t, _ in self.pieces)).split())
            if text:
                plain = text if not any(link for _, link in self.pieces) else " ".join(html.unescape("".join(t for t, link in self.pieces if not link)).split())
                self.lines.append(Line(text, len(plain), self.aside, self.article))
            self.pieces.clear()

    def leave(self, depth: int) -> None:
        """Close the open elements from `depth` on."""
        if self.blocks and self.blocks[-1] >= depth:
            self.end_line()
        while len(self.stack) > depth:
            name = self.stack.pop()[0]
            self.places[name].pop()
            self.links -= name == "a"
        while self.blocks and self.blocks[-1] >= depth:
            self.blocks.pop()

    def last(self, *names: str) -> int:
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=-1)

    def close(self, name: str) -> None:
        depth = self.last(name)
        if depth >= 0:
            # text elements do not close what is around their article
            if name not in _INLINE | {"p"} or depth > self.last("article", "main", "body"):
                self.leave(depth)
        elif name not in _INLINE:
            self.end_line()

    def open(self, name: str, attributes: str) -> None:
        if name not in _INLINE:
            # a block ends an open paragraph, and elements that cannot hold it
            while self.blocks:
                ended_by = _ENDED_BY.get(self.stack[self.blocks[-1]][0], set())
                if ended_by is not None and name not in ended_by:
                    break
                self.leave(self.blocks[-1])
            self.end_line()
        if name in _VOID or attributes.endswith("/"):
            return
        aside = self.aside or _is_aside(name, attributes, self.article)
        self.places.setdefault(name, []).append(len(self.stack))
        if name not in _INLINE:
            self.blocks.append(len(self.stack))
        self.stack.append((name, aside, self.article or name in ("article", "main")))
        self.links += name == "a"


def lines_of(page: str) -> list[Line]:
    """The page's blocks in order, markup stripped, references decoded and white space made single.

    A tag that nothing ends is text, with all that follows.
    """
    reader = _Reader()
    at, size = 0, len(page)
    none_left: set[str] = set()  # skipped elements that no later tag closes
    while at < size:
        begin = page.find("<", at)
        if begin < 0:
            reader.text(page[at:])
            break
        if page.startswith(("<!", "<?"), begin):
            reader.text(page[at:begin])
            opening, closing = ("<!--", "-->") if page.startswith("<!--", begin) else ("<![CDATA[", "]]>") if page.startswith("<![CDATA[", begin) else ("<!", ">")
            end = page.find(closing, begin + len(opening))
            at = end + len(closing) if end >= 0 else size
            continue
        named = _NAME.match(page, begin + 1)
        if named is None:
            reader.text(page[at : begin + 1])
            at = begin + 1
            continue
        rest = _REST.match(page, named.end())
        if rest is None:
            reader.text(page[at:])
            break
        reader.text(page[at:begin])
        at = rest.end()
        name = named[0].lower()
        attributes = page[named.end() : at - 1]
        if name.startswith("/"):
            reader.close(name[1:])
        elif name in _SKIPPED:
            if not attributes.endswith("/") and name not in none_left:
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*+>", re.I).search(page, at)
                if end is None:
                    none_left.add(name)
                at = end.end() if end else size if name in ("script", "style") else at
        elif name == "br":
            reader.text(" ")
        else:
            reader.open(name, attributes)
    reader.end_line()
    return reader.lines


def block_sums(weights: list[int], window: int) -> list[int]:
    """For each line the weight of the block that begins there."""
    n = len(weights)
    blocks = [0] * n
    running = 0
    for k in range(n - 1, -1, -1):
        running += weights[k] - (weights[k + window] if k + window < n else 0)
        blocks[k] = running
    return blocks


def stretches(weights: list[int], options: MainTextOptions) -> list[tuple[int, int]]:
    """[start, end) of the lines between surges and dives of the blocks; a block is a line and those after it."""
    n = len(weights)
    blocks = block_sums(weights, options.window)
    found = []
    k = 0
    while k < n:
        if weights[k] and blocks[k] >= max(options.surge, options.dive):
            end = k
            while end < n and blocks[end] >= options.dive:
                end += 1
            found.append((k, end))
            k = end
        else:
            k += 1
    return found


def kept_lines(lines: list[Line], options: MainTextOptions) -> list[int]:
    """The numbers of the lines of the main text."""
    weights = [0 if x.aside else x.weight for x in lines]
    inside = sum(w for w, x in zip(weights, lines, strict=True) if x.article)
    chosen = [not x.aside for x in lines]
    if 100 * inside >= options.article * sum(weights) and any(x.article and not x.aside for x in lines):
        chosen = [c and x.article for c, x in zip(chosen, lines, strict=True)]
        weights = [w if c else 0 for w, c in zip(weights, chosen, strict=True)]
    # a page without any block that surges still has its heaviest
    heaviest = max(block_sums(weights, options.window), default=0)
    spans = stretches(weights, replace(options, surge=max(1, min(options.surge, heaviest))))
    kept = [False] * len(lines)
    for a, z in spans:
        # inside an article, lines that are all link go with the text that they border on
        while a > 0 and chosen[a - 1] and lines[a - 1].article and not kept[a - 1]:
            a -= 1
        while z < len(lines) and chosen[z] and lines[z].article and not weights[z]:
            z += 1
        for k in range(a, z):
            kept[k] = chosen[k]
    return [k for k, x in enumerate(kept) if x]


def main_text(page: str | None, options: MainTextOptions = MainTextOptions()) -> str:
    """The kept lines, joined by an empty line; empty for a null or empty page, or one without text outside links."""
    lines = lines_of(page or "")
    return "\n\n".join(lines[k].text for k in kept_lines(lines, options))


def main_texts(pages: DataFrame, options: MainTextOptions = MainTextOptions()) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of `pages` (page_id, url, html); repeated rows and nulls are kept as they are, other columns ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py(), options) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
