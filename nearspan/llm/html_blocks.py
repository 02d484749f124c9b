"""A page as a sequence of leaf blocks: text, tag path and a few measures of each.

An end tag closes its element however many others are open above it. The tag path that the labeller reads holds the marks
of the first 4 and last 12 open elements, and of a name attribute its first 12 parts.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from dataclasses import dataclass, field

SPACE = re.compile(r"[\x20\x09-\x0D]+")
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>")
ATTRIBUTE = re.compile(r"(class|id|role|itemprop|aria-label|hidden|style)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]*))?", re.I)
NAME_PART = re.compile(r"[a-z]+")

#: Elements whose content is never text of a page.
SKIPPED = frozenset("script style template iframe object svg math canvas audio video title textarea noembed xmp".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr label br img input meta link".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A start tag closes an open element of the named kinds, up to the nearest of the fences.
CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
          "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
FENCES = frozenset("ul ol dl table select body article section div main aside nav header footer form blockquote".split())
#: Block starts that end an open paragraph.
ENDS_P = frozenset("address article aside blockquote center details dialog div dl fieldset figcaption figure footer form "
                   "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split())


@dataclass
class Block:
    text: str
    path: tuple[str, ...]
    linked: float


@dataclass
class _Open:
    name: str
    marks: tuple[str, ...]


@dataclass
class _Reader:
    stack: list[_Open] = field(default_factory=list)
    blocks: list[Block] = field(default_factory=list)
    pieces: list[str] = field(default_factory=list)
    in_link: int = 0
    linked: int = 0
    #: Open elements by name: of the page, and of each stretch of the stack above a fence.
    opened: defaultdict[str, int] = field(default_factory=lambda: defaultdict(int))
    scopes: list[defaultdict[str, int]] = field(default_factory=lambda: [defaultdict(int)])

    def text(self, raw: str) -> None:
        if raw:
            self.pieces.append(raw)
            if self.in_link:
                self.linked += len(raw)

    def end_block(self) -> None:
        if self.pieces:
            joined = "".join(self.pieces)
            clean = SPACE.sub(" ", html.unescape(joined)).strip(" ")
            if clean:
                near = self.stack if len(self.stack) <= 16 else self.stack[:4] + self.stack[-12:]
                path = tuple(m for o in near for m in o.marks)
                self.blocks.append(Block(clean, path, self.linked / len(joined)))
            self.pieces, self.linked = [], 0

    def open(self, name: str, marks: tuple[str, ...]) -> None:
        self.stack.append(_Open(name, marks))
        self.opened[name] += 1
        if name in FENCES:
            self.scopes.append(defaultdict(int))
        else:
            self.scopes[-1][name] += 1

    def close(self, names: tuple[str, ...], fenced: bool) -> None:
        """Close the innermost open element of these names and all inside it; ``fenced``: only above the last fence."""
        counts = self.scopes[-1] if fenced else self.opened
        for n in names:
            if counts[n]:
                break
        else:
            return
        last = None
        while last not in names:
            last = self.stack.pop().name
            self.opened[last] -= 1
            if last in FENCES:
                self.scopes.pop()
            else:
                self.scopes[-1][last] -= 1


def marks_of(name: str, attributes: str) -> tuple[str, ...]:
    out = [f"t:{name}"]
    for key, value in ATTRIBUTE.findall(attributes) if attributes else ():
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "hidden" or key == "style" and "display:none" in value.replace(" ", ""):
            out.append("hidden")
        elif key != "style":
            out += [f"c:{x}" for x in NAME_PART.findall(value)[:12] if len(x) > 1]
    return tuple(out)


def blocks_of(page: str | None) -> list[Block]:
    """Blocks in page order. What follows an unfinished tag or comment is dropped, as browsers do."""
    r, at, n = _Reader(), 0, len(page or "")
    while at < n:
        low = page.find("<", at)
        if low < 0:
            r.text(page[at:])
            break
        r.text(page[at:low])
        if page.startswith("<!--", low):
            end = page.find("-->", low + 4)
            at = n if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), low):
            end = page.find(">", low)
            at = n if end < 0 else end + 1
            continue
        m = TAG.match(page, low)
        if not m:
            nxt = page[low + 1:low + 2]
            if nxt.isalpha() or nxt == "/":
                end = page.find(">", low)
                at = n if end < 0 else end + 1
            else:
                r.text("<")
                at = low + 1
            continue
        at = m.end()
        closing, name, attributes = m[1], m[2].lower(), m[3]
        if closing:
            if name not in INLINE:
                r.end_block()
            elif name == "a":
                r.in_link = max(0, r.in_link - 1)
            r.close((name,), fenced=False)
            continue
        if name in SKIPPED:
            if name not in ("canvas", "math"):
                r.text(" ")
            end = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(page, at)
            at = n if not end else end.end()
            continue
        if name == "br":
            r.text(" ")
        elif name not in INLINE:
            r.end_block()
            if name in ENDS_P:
                r.close(("p",), fenced=True)
            if name in CLOSES:
                r.close(CLOSES[name], fenced=True)
        if name == "a":
            r.in_link = 1
        if name not in VOID and not attributes.endswith("/") and (name not in INLINE or "=" in attributes):
            r.open(name, marks_of(name, attributes) if name not in INLINE else ())
    r.end_block()
    return r.blocks
