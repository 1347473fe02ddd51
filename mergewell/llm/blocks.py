"""Leaf blocks of an HTML page: texts between block-level tags with their tag paths."""

from __future__ import annotations

import html
import re
from typing import NamedTuple

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)",
    re.DOTALL)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
NAME_PARTS = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+")

# Fixed values of HTML: elements whose content is no text of the page, those of them that only
# their own end tag ends, elements without content, and elements that begin no line of their own.
HIDDEN = frozenset("script style noscript template textarea select iframe svg".split())
RAW = frozenset("script style textarea iframe".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var object canvas audio video "
    "math maction annotation annotation-xml menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom "
    "mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none "
    "semantics".split())
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDERS = frozenset("table ul ol dl select body html".split())


class Block(NamedTuple):
    path: tuple[str, ...]  # tags from the root on, each followed by the words of its class and id
    text: str
    in_links: float  # part of the letters that stand in links
    label: str | None  # value of the nearest data-label


def _names(attributes: str) -> tuple[tuple[str, ...], str | None]:
    words, label = [], None
    for name, *values in ATTRIBUTE.findall(attributes):
        value = next((v for v in values if v), "")
        if name.lower() in ("class", "id", "role"):
            words += ["." + part.lower() for part in NAME_PARTS.findall(html.unescape(value))]
        elif name.lower() == "data-label":
            label = value
    return tuple(words), label


def blocks_of(page: str | None) -> list[Block]:
    """All blocks with text, in page order; none for a missing page.

    A block ends wherever a tag begins or ends a line of its own.  Character references are
    decoded, white space becomes one blank.  Unclosed and unopened tags are put up with: only
    a RAW element without an end tag goes on to the end of the page.
    """
    out: list[Block] = []
    if not page:
        return out
    open_tags: list[tuple[str, tuple[str, ...], str | None]] = []
    pieces: list[str] = []
    linked, links = 0, 0
    unclosed: set[str] = set()  # hidden tags without an end tag in the rest of the page

    def flush():
        nonlocal linked
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                path = tuple(x for tag, names, _ in open_tags for x in (tag, *names))
                label = next((mark for _, _, mark in reversed(open_tags) if mark is not None), None)
                out.append(Block(path, text, min(1.0, linked / len(text)), label))
            pieces.clear()
        linked = 0

    place, size = 0, len(page)
    while place < size:
        found = TOKEN.search(page, place)
        start = found.start() if found else size
        if start > place:
            pieces.append(page[place:start])
            if links:
                linked += start - place
        if not found:
            break
        place = found.end()
        tag = found[2]
        if tag is None:
            continue
        tag, closing = tag.lower(), bool(found[1])
        if tag == "br":
            pieces.append(" ")
        elif tag in INLINE:
            if tag == "a":
                links = max(0, links - 1) if closing else links + (not found[3].rstrip().endswith("/"))
        elif tag in HIDDEN:
            flush()
            if not closing and not found[3].rstrip().endswith("/") and tag not in unclosed:
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(page, place)
                if end:
                    place = end.end()
                elif tag in RAW:
                    place = size
                else:
                    unclosed.add(tag)
        elif tag in VOID:
            if tag == "hr":
                flush()
        elif closing:
            flush()
            for depth in range(len(open_tags) - 1, -1, -1):
                if open_tags[depth][0] == tag:
                    del open_tags[depth:]
                    links = 0
                    break
        else:
            flush()
            if open_tags and open_tags[-1][0] == "p":
                open_tags.pop()
            ends = CLOSES.get(tag, ())
            for depth in range(len(open_tags) - 1, -1, -1):
                if open_tags[depth][0] in ends:
                    del open_tags[depth:]
                    break
                if open_tags[depth][0] in HOLDERS:
                    break
            names, label = _names(found[3]) if "=" in found[3] else ((), None)
            open_tags.append((tag, names, label))
    flush()
    return out
