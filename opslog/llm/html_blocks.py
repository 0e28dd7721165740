"""HTML pages as lists of leaf blocks: text with the tags and names of its ancestors."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</?([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
UNSHOWN = re.compile(r"display\s*:\s*none", re.I)

#: Elements without content, and elements whose content is no text of the page. Of these only
#: scripts and styles run to the end of a page that does not close them; those that can lie
#: within each other end at the first end tag, the others are open if the next one starts first.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template noscript textarea title iframe svg canvas audio video annotation annotation-xml".split())
TO_THE_END = frozenset({"script", "style"})
NESTED = frozenset({"svg", "template", "annotation-xml"})
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr br img "
    "math semantics mrow mi mn mo ms mtext mspace mfrac msqrt mroot mstyle merror mpadded mphantom msub msup "
    "msubsup munder mover munderover mmultiscripts mprescripts mtable mtr mtd".split())
#: What an opening tag closes first, as browsers do.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "p": {"p"}}
FENCES = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"},
          "th": {"tr", "table"}, "option": {"select"}}
#: Closing one of these also ends everything open inside it.
FORMATTING = frozenset("a b big code em font i s small strike strong tt u".split())


@dataclass(frozen=True)
class Block:
    text: str
    tags: tuple[str, ...]
    names: tuple[str, ...]
    linked: float


def blocks(page: str | None) -> list[Block]:
    """Leaf blocks in page order: text between two block borders, white space as one space.

    Comments, scripts, styles, elements for other readers (``noscript``, ``template`` and the
    like) and hidden elements give no text; formulas are part of their block. Broken markup is
    read as far as it goes: a missing end tag ends with its parent, a stray end tag does
    nothing, and of the elements without text only an open script or style takes the rest.
    """
    page = page or ""
    out: list[Block] = []
    tags: list[str] = []
    names: list[tuple[str, ...]] = []
    text: list[str] = []
    linked = [0, 0]
    hidden = 0
    never_closed: set[str] = set()

    def flush() -> None:
        whole = " ".join("".join(text).split())
        text.clear()
        if whole:
            own = [n for group in names for n in group]
            out.append(Block(whole, tuple(tags), tuple(own), min(1.0, linked[1] / max(1, linked[0]))))
        linked[:] = [0, 0]

    def say(raw: str) -> None:
        if hidden or not raw:
            return
        said = html.unescape(raw) if "&" in raw else raw
        text.append(said)
        size = len(said.strip())
        linked[0] += size
        if "a" in tags:
            linked[1] += size

    def close(to: int) -> None:
        nonlocal hidden
        for group in names[to:]:
            hidden -= "\0hidden" in group
        del tags[to:], names[to:]

    at = 0
    while True:
        m = TOKEN.search(page, at)
        if m is None:
            say(page[at:])
            break
        say(page[at:m.start()])
        at = m.end()
        if m.group(1) is not None:
            say(m.group(1))
            continue
        if m.group(2) is None:
            continue
        tag = m.group(2).lower()
        if m.group(0)[1] == "/":
            if tag in INLINE:
                if tag in tags:
                    place = len(tags) - 1 - tags[::-1].index(tag)
                    if all(t in INLINE for t in tags[place:]):
                        close(place)
                continue
            flush()
            if tag in tags:
                close(len(tags) - 1 - tags[::-1].index(tag))
            continue
        if tag in RAW:
            if m.group(3).endswith("/") and tag in ("svg", "iframe"):
                continue
            end = None if tag in never_closed else re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            if end is None:
                never_closed.add(tag)
                if tag in TO_THE_END:
                    at = len(page)
            elif tag in TO_THE_END | NESTED or not re.compile(rf"<{re.escape(tag)}[\s/>]", re.I).search(page, at, end.start()):
                at = end.end()
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag not in INLINE:
            flush()
            while "p" in tags and tags[-1] in FORMATTING | {"p"} and tag != "p":
                # A block inside an open paragraph ends it.
                close(len(tags) - 1)
            closing = CLOSES.get(tag)
            if closing:
                fence = FENCES.get(tag, frozenset())
                for i in range(len(tags) - 1, -1, -1):
                    if tags[i] in closing:
                        close(i)
                        break
                    if tags[i] in fence or (tag == "p" and tags[i] not in FORMATTING):
                        break
        if tag in VOID:
            continue
        attributes = m.group(3)
        found: list[str] = []
        unseen = False
        for name, a, b, c in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), a or b or c
            if name in ("class", "id", "role"):
                found += re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower())
            unseen |= (name == "hidden" or (name == "aria-hidden" and value.strip().lower() == "true")
                       or (name == "style" and UNSHOWN.search(value) is not None))
        if unseen:
            found.append("\0hidden")
            hidden += 1
        tags.append(tag)
        names.append(tuple(found))
    flush()
    return out
