"""The leaf blocks of an HTML page: runs of text between block tags, with the elements above them."""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from typing import NamedTuple

#: Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that stand within a line of text; all others begin and end a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em embed font i img ins kbd label mark math meter nobr "
    "object output picture progress q rp rt ruby s samp small source span strike strong sub sup time tt u var wbr".split()
)
#: Elements whose content is no text of the page, up to their end tag.
DROPPED = frozenset("script style textarea title iframe noembed noframes xmp template svg select".split())
#: A start tag of a key ends an open element of these; the search stops at its bounds.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "thead": (("thead", "tbody", "tfoot", "tr"), ("table",)),
    "tbody": (("thead", "tbody", "tfoot", "tr"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot", "tr"), ("table",)),
    "body": (("head",), ()),
}
#: An end tag looks for its element no further up than these; one of a table's part no further than its table.
BARRIERS = frozenset("table td th caption html".split())
TABLE_PARTS = frozenset("table thead tbody tfoot tr td th caption".split())
#: Elements of which a page has one: a second start tag is ignored.
ONCE = frozenset("html head body".split())

# Possessive parts, so that a tag is read once whatever it holds. A quote that is never closed is a plain sign.
TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)?+|["'])*+)>""")
NAMES = re.compile(r"""(?:^|[\s"'/])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
WORD_PARTS = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")
SPACE = re.compile(r"\s+")
COMMENT_END = re.compile(r"--!?>")


class Element(NamedTuple):
    """An open block element: its tag, and the words of its class, id and role."""

    tag: str
    names: tuple[str, ...]


class Path:
    """An open element and what is open around it; ``known`` is room for what a reader of the path makes of it."""

    __slots__ = ("above", "element", "known")

    def __init__(self, element: Element, above: Path | None):
        self.element, self.above, self.known = element, above, None


class Block(NamedTuple):
    """Text of a leaf block with character references decoded and white space joined."""

    text: str
    path: Path | None
    linked: int  # characters within links


def name_words(attributes: str) -> tuple[str, ...]:
    """The words of class, id and role in lower case: ``postBody side-bar2`` has post, body, side, bar."""
    found: list[str] = []
    for match in NAMES.finditer(attributes):
        value = match[2] or match[3] or match[4] or ""
        found += [w.lower() for w in WORD_PARTS.findall(value)[:64]]
    return tuple(dict.fromkeys(found))


def _end_of_raw(page: str, tag: str, at: int) -> int:
    """Where the content of an element of raw text ends: before its end tag, or at the end of the page."""
    pattern = re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE)
    found = pattern.search(page, at)
    return found.start() if found else len(page)


def leaf_blocks(page: str | None) -> list[Block]:
    """All leaf blocks with text, in page order.

    Tags may be left open or stand in the wrong order, as browsers allow: a
    paragraph ends where a block begins, list items and table cells end where the
    next one begins, an end tag without its element is ignored but ends a block.
    Comments, declarations, scripts, styles, titles and the like are no text. A
    tag that the page's end cuts off is none either. A less-than sign that begins
    no tag is text.
    """
    page = page or ""
    out: list[Block] = []
    stack: list[Path] = []
    opened: Counter[str] = Counter()  # open elements by tag
    parts: list[str] = []
    linked: list[str] = []
    link_depth = -1  # elements open where the link began; negative: no link
    at, size = 0, len(page)

    def text(raw: str) -> None:
        if "&" in raw:
            raw = entities.unescape(raw)
        parts.append(raw)
        if link_depth >= 0:
            linked.append(raw)

    def flush() -> None:
        if parts:
            joined = SPACE.sub(" ", "".join(parts)).strip()
            if joined:
                out.append(Block(joined, stack[-1] if stack else None, min(len(joined), len(SPACE.sub(" ", "".join(linked)).strip()))))
            parts.clear()
            linked.clear()

    def cut(length: int) -> None:
        nonlocal link_depth
        opened.subtract(p.element.tag for p in stack[length:])
        del stack[length:]
        if link_depth > length:
            link_depth = -1

    def end_nearest(tags, bounds) -> None:
        """Ends the innermost open element of these tags, and all within it, unless a bound stands between."""
        if any(opened[t] for t in tags):
            for i in range(len(stack) - 1, -1, -1):
                open_tag = stack[i].element.tag
                if open_tag in tags:
                    cut(i)
                    break
                if open_tag in bounds:
                    break

    while at < size:
        sign = page.find("<", at)
        if sign < 0:
            text(page[at:])
            break
        if sign > at:
            text(page[at:sign])
        following = page[sign + 1 : sign + 2]
        if following == "!":
            if page.startswith("<!--", sign):
                if page.startswith((">", "->"), sign + 4):
                    at = page.index(">", sign + 4) + 1
                    continue
                end = COMMENT_END.search(page, sign + 4)
                at = end.end() if end else size
            else:
                end = page.find(">", sign)
                at = end + 1 if end >= 0 else size
            continue
        if following == "?" or (following == "/" and not page[sign + 2 : sign + 3].isalpha()):
            end = page.find(">", sign)
            at = end + 1 if end >= 0 else size
            continue
        if not (following.isascii() and following.isalpha()) and following != "/":
            text("<")
            at = sign + 1
            continue
        match = TAG.match(page, sign)
        if match is None:  # cut off by the end of the page
            break
        at = match.end()
        closing, tag, attributes = match[1], match[2].lower(), match[3]
        if tag in INLINE:
            if tag == "br":
                text(" ")
            elif tag == "a":
                link_depth = -1 if closing else len(stack)
            continue
        if tag in DROPPED:
            if not closing and not (tag == "svg" and attributes.endswith("/")):
                end = _end_of_raw(page, tag, at)
                close = page.find(">", end)
                at = close + 1 if close >= 0 else size
            if tag in ("script", "style", "template", "svg", "select", "textarea"):
                continue  # may stand within a line
            flush()
            continue
        flush()
        if closing:
            end_nearest((tag,), ("table",) if tag in TABLE_PARTS else BARRIERS)
            continue
        if tag in ONCE and opened[tag]:
            continue
        if stack and stack[-1].element.tag == "p":  # no block stands within a paragraph
            cut(len(stack) - 1)
        if tag in CLOSES:
            end_nearest(*CLOSES[tag])
        if tag not in VOID:
            element = Element(tag, name_words(attributes) if "=" in attributes else ())
            stack.append(Path(element, stack[-1] if stack else None))
            opened[tag] += 1
    flush()
    return out
