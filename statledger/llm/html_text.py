"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one for each block, in page order. Lines in page furniture
(menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles, reader comments) weigh 0, others
the length of their text outside links. Sums over a sliding window of lines surge where running text begins
and dive to where it ends; the text between is kept, short lines included. A window needs ``SURGE`` characters.

An ``article`` or ``main`` element is a weight, and windows don't cross its border: inside, any character outside links
makes a surge, and a line of links dives only where links prevail in a whole window; outside, characters
count ``1 / OUTSIDE``, so only long running text is kept beside it.

Defined cases: a null or empty page, and one of furniture alone, give an empty text. A tag or comment that never
closes ends with the page; furniture that never closes ends where an article, main or first heading
begins, furniture that closes holds all up to there. A nested or marked article (reader comment, teaser) is furniture by its
class, id or role like any other element, but for words that mark topics (``category-``, ``tag-``) or parts (``has-``). Equal rows give one result each. Other columns are ignored. Every page is scanned once.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame

from statledger.llm.arrays import pieces

# Lines of a window, characters that make a surge, and share of link text that makes a line a menu.
WINDOW = 3
SURGE = 80
LINK_SHARE = 0.5
# Beside an article or main element so many characters count as one.
OUTSIDE = 4

# Elements by their part in a page.
RAW = frozenset("script style noscript template svg math iframe object textarea title select".split())
FURNITURE = frozenset("nav footer aside form dialog button menu head".split())
BLOCKS = frozenset(
    "p div h1 h2 h3 h4 h5 h6 li ul ol dl dt dd tr table thead tbody tfoot caption section article main "
    "blockquote pre br hr figure figcaption header footer nav aside form fieldset address details summary "
    "body html center dialog menu".split()
)
CELLS = frozenset("td th option label".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
FURNITURE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner menu "
    "nav navbar navigation breadcrumb breadcrumbs sidebar aside footer masthead topbar toolbar "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription "
    "signup login share sharing social related recommended recommendations comment comments commentlist "
    "reply replies respond disqus pagination pager widget skip copyright disclaimer".split()
)
FURNITURE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split()
)

_NAME = re.compile(r"/?([a-zA-Z][a-zA-Z0-9:-]*)")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*))""")
# All up to the end of a tag. Only a value can be quoted, and only the same character ends it.
_ATTRIBUTES = re.compile(r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)|=)*+""")
_RAW_END = {name: re.compile(f"</{name}", re.I) for name in RAW}
_TOPIC = re.compile(r"(?<!\S)(?:category|tag|type|format|has|no|with)-\S+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass
class Line:
    """Text of one block."""

    parts: list[str] = field(default_factory=list)
    link_parts: list[str] = field(default_factory=list)
    scoped: bool = False

    def text(self) -> str:
        return _tidy(self.parts)

    def lengths(self) -> tuple[int, int]:
        """Of the text and of the part of it in links."""
        return len(self.text()), len(_tidy(self.link_parts))


def _tidy(parts: list[str]) -> str:
    return " ".join(entities.unescape("".join(parts)).split())


def _is_furniture(name: str, attributes: str, scoped: bool) -> bool:
    if name in FURNITURE or (name == "header" and not scoped):
        return True
    if "=" not in attributes and "hidden" not in attributes:
        return False
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
    if name in ("main", "body", "html"):
        return False
    if found.get("role", "").lower() in FURNITURE_ROLES or _HIDDEN.search(found.get("style", "")):
        return True
    if found.get("aria-hidden") == "true" or re.search(r"(?<![\w-])hidden(?![\w=-])", _ATTRIBUTE.sub(" ", attributes)):
        return True
    marks = f"{found.get('class', '')} {found.get('id', '')}".lower()
    names = re.split(r"[^a-z0-9]+", _TOPIC.sub("", marks) if name == "article" else marks)
    return not FURNITURE_NAMES.isdisjoint(names)


def _tag_end(page: str, start: int) -> int:
    """The index of the > that closes a tag; one in a quoted value doesn't, if the quote closes."""
    return _ATTRIBUTES.match(page, start).end()


def _closed(page: str) -> set[int]:
    """Where the elements begin that have an end tag, each end tag closing the last open one of its name."""
    found, opened = set(), defaultdict(list)
    at, size = 0, len(page)
    while at < size and (mark := page.find("<", at)) >= 0:
        tag = _NAME.match(page, mark + 1)
        if not tag:
            comment = page.startswith("<!--", mark)
            end = page.find("-->", mark + 4) if comment else mark
            at = size if end < 0 else end + (3 if comment else 1)
            continue
        name = tag[1].lower()
        end = _tag_end(page, tag.end())
        at = end + 1
        if page[mark + 1] == "/":
            if opened[name]:
                found.add(opened[name].pop())
        elif name in RAW:
            stop = _RAW_END[name].search(page, at)
            at = stop.end() if stop else size
        elif page[end - 1] != "/":
            opened[name].append(mark)
    return found


def _lines(page: str) -> list[Line]:
    """The lines of a page in order; furniture leaves an empty line."""
    lines, line = [], Line()
    furniture: list[str] = []  # open elements since furniture began, of the same name
    closed: set[int] | None = None  # where elements begin that close; only found if needed
    began = 0  # where furniture began
    scope = link = 0
    at, size = 0, len(page)

    def broke() -> None:
        nonlocal line
        if line.parts:
            line.scoped = scope > 0
            lines.append(line)
            line = Line()

    def add(text: str) -> None:
        if not furniture:
            line.parts.append(text)
            if link:
                line.link_parts.append(text)

    while at < size:
        mark = page.find("<", at)
        if mark < 0:
            add(page[at:])
            break
        if mark > at:
            add(page[at:mark])
        if page.startswith("<!--", mark):
            end = page.find("-->", mark + 4)
            at = size if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), mark):
            end = page.find(">", mark)
            at = size if end < 0 else end + 1
            continue
        tag = _NAME.match(page, mark + 1)
        if not tag:
            add("<")
            at = mark + 1
            continue
        name, closing = tag[1].lower(), page[mark + 1] == "/"
        end = _tag_end(page, tag.end())
        attributes = page[tag.end() : end]
        at = end + 1
        if name in RAW and not closing:
            stop = _RAW_END[name].search(page, at)
            close = page.find(">", stop.end()) if stop else -1
            at = size if close < 0 else close + 1
            continue
        if name in BLOCKS:
            broke()
        elif name in CELLS:
            add(" ")
        reopens = name in ("article", "main") or (name == "h1" and furniture and furniture[0] != "header")
        if furniture and reopens and not closing and closed is None:
            closed = _closed(page)
        if furniture:
            if reopens and not closing and began not in closed:
                furniture.clear()
            elif name == furniture[0] and not attributes.endswith("/"):
                if closing:
                    furniture.pop()
                    if not furniture:
                        lines.append(Line(scoped=scope > 0))
                    continue
                furniture.append(name)
                continue
            else:
                continue
        if closing:
            if name in ("article", "main") and scope:
                scope -= 1
            elif name == "a":
                link = 0
        elif name not in VOID and not attributes.endswith("/"):
            if _is_furniture(name, attributes, scope > 0):
                broke()
                furniture.append(name)
                began = mark
            elif name in ("article", "main"):
                scope += 1
            elif name == "a":
                link = 1
    broke()
    return lines


def _windows(values: list[int]) -> list[int]:
    """Sums over windows of lines; the one at k ends with line k."""
    return [sum(values[max(0, k - WINDOW + 1) : k + 1]) for k in range(len(values) + WINDOW - 1)]


def _weights(lengths: list[tuple[int, int]], inside: bool, beside: bool) -> list[int]:
    """Of the lines of one part of a page, inside an article or main element, or beside one."""
    if not inside:
        plain = [0 if links > LINK_SHARE * size else size - links for size, links in lengths]
        return [w // OUTSIDE for w in plain] if beside else plain
    n = min(WINDOW, len(lengths))
    texts, links = (_windows([x[i] for x in lengths]) for i in (0, 1))
    menu = [links[k] > LINK_SHARE * texts[k] for k in range(len(lengths))]
    return [
        0 if link > LINK_SHARE * size and any(menu[max(k, n - 1) : k + n]) else size * SURGE
        for k, (size, link) in enumerate(lengths)
    ]


def _kept(lines: list[Line], weights: list[int]) -> Iterator[str]:
    """Texts from each surge to its dive."""
    sums, k = _windows(weights), 0
    while k < len(weights):
        # The window that ends WINDOW - 1 lines further on begins at line k.
        if not weights[k] or max(sums[k : k + WINDOW]) < SURGE:
            k += 1
            continue
        while k < len(weights) and (weights[k] or sums[k + WINDOW - 1] >= SURGE):
            if weights[k]:
                yield lines[k].text()
            k += 1


def main_text(page: str | None) -> str:
    """The lines between each surge of text and its dive, joined by line feeds."""
    lines = _lines(page or "")
    beside = any(line.scoped and line.text() for line in lines)
    kept: list[str] = []
    for inside, part in groupby(lines, key=lambda line: line.scoped):
        own = list(part)
        kept += _kept(own, _weights([line.lengths() for line in own], inside, beside))
    return "\n".join(t for t in kept if t)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "html"):
            texts = [main_text(page) for page in piece.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("page_id"),
                    piece.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )


def extract_pages(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every page."""
    return pages.select("page_id", "url", "html").mapInArrow(
        _extract, "page_id bigint, url string, text string, n_chars bigint"
    )
