"""HTML to leaf blocks: runs of text between block boundaries, each with what its ancestors are called.

Malformed input has defined results. A quote belongs to a value only right behind its equals sign; a quoted value that never ends
is read up to the next >. ``<!-->`` and ``<!--->`` are whole comments, any other one ends at ``-->`` or ``--!>``. An svg closed in
place is empty; scripts, styles and the like that never end take the rest of the page, as does a comment or tag that is cut off, while
an svg, select or template that never ends is passed over. Closing tags without an open element are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Container
from typing import NamedTuple

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page; of the first kind it is not even markup.
UNPARSED = frozenset("script style noscript textarea iframe".split())
RAW = UNPARSED | {"template", "svg", "select"}
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html label legend li main menu nav ol option p pre section summary table tbody td tfoot th "
    "thead title tr ul".split()
)
#: Tags whose start ends an open one of the given kinds.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "option": {"option"}}
#: Elements that an open p outside of them does not reach into.
P_SCOPE = frozenset("button caption table td th object template applet marquee".split())
KEEPS_P = BLOCK - {"button", "label", "option", "caption", "legend", "td", "th", "tr", "tbody", "thead", "tfoot", "title", "head", "body", "html"}
#: What follows a tag's name: names and equals signs with their values, quoted or not. No part gives back what it has taken.
_TAG_REST = re.compile(r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)*+>""")
_NAME = re.compile(r"/?([a-zA-Z][^\s/>]*)")
_MARKS = re.compile(r"""(?<![\w-])(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_WORD = re.compile(r"[a-z0-9]+")
#: From behind the two hyphens that open a comment.
_COMMENT_END = re.compile(r"(?<=<!--)-?>|--!?>")


class Block(NamedTuple):
    text: str
    tag: str
    names: frozenset[str]
    link_chars: int


class _Open(NamedTuple):
    """An open element; block_tag and block_names are of the nearest block element, itself included."""

    tag: str
    names: frozenset[str]
    in_link: bool
    block_tag: str
    block_names: frozenset[str]


_ends = {tag: re.compile(rf"</{tag}\b", re.I) for tag in RAW}


def _marks(rest: str) -> set[str]:
    found = set()
    if "=" in rest:
        for m in _MARKS.findall(rest):
            found |= {f"m:{w}" for w in _WORD.findall(m.lower())}
        if found:
            found.add("m:")
    return found


def blocks(page: str, known: Container[str] | None = None) -> list[Block]:
    """Leaf blocks of a page in order; white space of each is one space, character references are decoded. Elements may be nested
    to any depth: with the marks and tags that a model knows (others are left out), the work of an element does not grow with it.

    Any mark, known or not, puts ``m:`` among a block's names.
    """
    out: list[Block] = []
    stack = [_Open("", frozenset(), False, "", frozenset())]
    open_tags: Counter[str] = Counter()
    places: dict[bool, list[int]] = {True: [], False: []}  # in the stack, of open p and of what ends their scope
    parts: list[tuple[str, bool]] = []
    held: list[frozenset[str]] = []

    def end_block() -> None:
        if parts:
            text = " ".join("".join(t for t, _ in parts).split())
            if text:
                links = sum(len(t.strip()) for t, linked in parts if linked)
                out.append(Block(text, stack[-1].block_tag, held[0], links))
            parts.clear()
            held.clear()

    def close(to: int) -> None:
        while len(stack) > to:
            tag = stack.pop().tag
            open_tags[tag] -= 1
            if tag == "p" or tag in P_SCOPE:
                places[tag == "p"].pop()

    pos, n = 0, len(page)
    unended: dict[str, int] = {}

    def add(text: str) -> None:
        if text:
            if not held:
                held.append(stack[-1].block_names)
            parts.append((html.unescape(text), stack[-1].in_link))

    while pos < n:
        at = page.find("<", pos)
        if at < 0:
            add(page[pos:])
            break
        if at > pos:
            add(page[pos:at])
        if page.startswith("<!--", at):
            ending = _COMMENT_END.search(page, at + 4)
            pos = ending.end() if ending else n
            continue
        if page.startswith(("<!", "<?"), at):
            end = page.find(">", at)
            pos = n if end < 0 else end + 1
            continue
        name = _NAME.match(page, at + 1)
        if not name:
            add("<")
            pos = at + 1
            continue
        tag = name[1].lower()
        closing = page[at + 1] == "/"
        rest = _TAG_REST.match(page, name.end())
        stop = rest.end() if rest else page.find(">", name.end()) + 1
        if stop <= 0:  # a tag that the end of the page cuts off
            break
        attributes = page[name.end() : stop - 1]
        pos = stop
        if tag == "br":
            add(" ")
            continue
        if tag in BLOCK:
            end_block()
        if closing:
            if open_tags[tag]:
                close(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag))
            continue
        if tag in RAW:
            if tag == "svg" and attributes.endswith("/"):
                continue
            ending = _ends[tag].search(page, pos) if pos < unended.get(tag, n + 1) else None
            if not ending:
                if tag in UNPARSED:
                    break
                unended[tag] = pos  # no search of the page for each of many
                continue
            end = page.find(">", ending.end())
            pos = n if end < 0 else end + 1
            continue
        if tag in VOID or attributes.endswith("/"):
            continue
        if tag in KEEPS_P and places[True] and places[True][-1] > (places[False] or [0])[-1]:
            close(places[True][-1])
        for other in CLOSES.get(tag, ()):
            if stack[-1].tag == other:
                close(len(stack) - 1)
        own = {f"t:{tag}"} | _marks(attributes) if tag in BLOCK or "=" in attributes else set()
        if known is not None:
            own = {x for x in own if x in known or x == "m:" or x[2:] in BLOCK}
        top = stack[-1]
        names = top.names if own <= top.names else top.names | own
        stack.append(_Open(tag, names, top.in_link or tag == "a", *((tag, names) if tag in BLOCK else (top.block_tag, top.block_names))))
        open_tags[tag] += 1
        if tag == "p" or tag in P_SCOPE:
            places[tag == "p"].append(len(stack) - 1)
    end_block()
    return out
