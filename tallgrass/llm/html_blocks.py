"""Leaf blocks of a page: runs of text between block-level tags, with the tags above them."""

from __future__ import annotations

import html
import re
from collections import Counter
from typing import NamedTuple

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)>|<[!?/][^>]*>""", re.S)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PARTS = re.compile(r"[a-z]+|[A-Z][a-z]*")

BLOCKS = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup, to the end of the page if it is not ended; nothing of it is text of the page.
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
#: Elements whose content is not shown as text; without an end tag only the tag itself is left out.
HIDDEN = frozenset("svg template".split())
#: A start tag closes an open element of these kinds, down to the element that holds them.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}


class Block(NamedTuple):
    text: str
    #: tags above the text from the root down, each with the words of its class, id and role
    path: tuple[tuple[str, ...], ...]
    #: characters inside links
    linked: int


def element(tag: str, rest: str) -> tuple[str, ...]:
    if "=" not in rest:
        return (tag,)
    found = []
    for m in _NAMED.finditer(rest):
        found += (x.lower() for x in _PARTS.findall(m[1] or m[2] or m[3] or ""))
    return tag, *dict.fromkeys(found)


def blocks(page: str) -> list[Block]:
    """Every run of text of a page in order, white space collapsed, character references decoded; empty ones left out."""
    out: list[Block] = []
    stack: list[tuple[str, ...]] = []
    run: list[str] = []
    path: tuple[tuple[str, ...], ...] = ()
    # open elements beyond the stack, by tag, and how many of them are blocks
    deep: Counter[str] = Counter()
    links = linked = at = inner = 0
    unended: set[str] = set()
    lower = ""

    def flush() -> None:
        nonlocal linked
        if run and (text := " ".join("".join(run).split())):
            out.append(Block(text, path, min(linked, len(text))))
        run.clear()
        linked = 0

    def text(piece: str) -> None:
        nonlocal path, linked
        if "&" in piece:
            piece = html.unescape(piece)
        if not run:
            if not piece.strip():
                return
            path = tuple(x for x in stack if x[0] in BLOCKS)
        run.append(piece)
        if links:
            linked += len(piece)

    # no tag begins behind the last ">": it need not be looked for, from every "<" anew, to the end of the page
    n, search, last = len(page), _TOKEN.search, page.rfind(">")
    while at < n:
        m = search(page, at) if at <= last or "<!--" in page[at:] else None
        if m is None:
            text(page[at:])
            break
        if m.start() > at:
            text(page[at : m.start()])
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        tag, closing, rest = name.lower(), m[1] or m[4], m[3] or m[6] or ""
        block = tag in BLOCKS
        if block:
            flush()
        if closing:
            if tag in ("html", "body"):
                continue
            if deep[tag]:
                deep[tag] -= 1
                inner -= block
            elif block or not inner:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        if not block:
                            del stack[i]
                        else:
                            del stack[i:]
                            deep.clear()
                            inner = 0
                        break
                    if not block and stack[i][0] in BLOCKS:
                        break
            links = sum(x[0] == "a" for x in stack) + deep["a"]
            continue
        if tag == "br":
            if run:
                run.append(" ")
            continue
        if tag in RAW or tag in HIDDEN and not rest.endswith("/") and tag not in unended:
            lower = lower or page.lower()
            lower = lower if len(lower) == n else _ascii_lower(page)
            end = lower.find(f"</{tag}", at)
            close = page.find(">", end) if end >= 0 else -1
            if close >= 0:
                at = close + 1
            elif tag in RAW:
                at = n
            else:
                unended.add(tag)
            continue
        if tag in HIDDEN:
            continue
        if tag in VOID:
            continue
        if block:
            if not inner:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == "p":
                        del stack[i:]
                        deep.clear()
                        break
                    if stack[i][0] in BLOCKS:
                        break
                if tag in CLOSES:
                    ends, holds = CLOSES[tag]
                    low = None
                    for i in range(len(stack) - 1, -1, -1):
                        if stack[i][0] in holds:
                            break
                        if stack[i][0] in ends:
                            low = i
                    if low is not None:
                        del stack[low:]
                        deep.clear()
            links = sum(x[0] == "a" for x in stack) + deep["a"]
        elif tag == "a":
            links = 1
        if len(stack) < 512:
            stack.append(element(tag, rest) if block else (tag,))
        else:
            deep[tag] += 1
            inner += block
    flush()
    return out


def _ascii_lower(page: str) -> str:
    """Lower case of A-Z alone, which leaves every character in its place."""
    return page.translate({i: i + 32 for i in range(65, 91)})
