"""Html to a flat list of text chunks with their paths, in page order.

A path is the chain of labels from body down to the element that holds the
text; a label is the tag with its role, id and class words (digits masked).
Inline elements without such marks have no label of their own, they only
carry text.  Repeated siblings of one label share a path, so all paragraphs
of an article are one node of the site's tree.
"""

from __future__ import annotations

import html
import re
from typing import NamedTuple

# Names of the html standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rb rp rt s "
                   "samp small span strike strong sub sup time tt u var wbr".split())
#: Elements that may stand inside a line of text without ending it.
QUIET = frozenset("script style template noscript svg math button select object canvas audio video iframe input meta link "
                  "source track param area embed".split())
#: Opening the key closes an open element of the value in the same scope.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
          "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("thead", "tr", "td", "th"),
          "tfoot": ("tbody", "tr", "td", "th"), "body": ("head",)}
SCOPES = frozenset("ul ol dl table select div section article main body aside nav header footer form blockquote".split())

TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:-->|--!>|\Z))|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*)"
    r"(?P<attributes>(?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))?)*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""(?:^|[\s/"'])(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/>"']|$)""", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
INVISIBLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Chunk(NamedTuple):
    block: int
    path: str
    text: str


class Element(NamedTuple):
    tag: str
    path: str
    label: str


def words(value: str) -> list[str]:
    """The lower-case words of a class, id or role value."""
    return [w.lower() for w in WORD.findall(value)]


def label_of(tag: str, attributes: str) -> str:
    """``tag`` or ``tag.word.word``; ``!`` marks what is not shown."""
    if not attributes or "=" not in attributes and "hidden" not in attributes.lower():
        return tag
    marks: set[str] = set()
    shown = ""
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        value, name = a or b or c, name.lower()
        if name == "style":
            shown = "!" if INVISIBLE.search(value) else shown
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            shown = "!"
        elif name in ("class", "id", "role"):
            marks.update(words(html.unescape(value)))
    return shown + ".".join([tag, *sorted(marks)])


def _close(stack: list[Element], tags: tuple[str, ...], stop: frozenset[str]) -> None:
    """Close the outermost open element of ``tags`` above the nearest scope."""
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in tags:
            outer = i
            while outer > 1 and stack[outer - 1].tag in tags:
                outer -= 1
            del stack[outer:]
            return
        if stack[i].tag in stop:
            return


def read_page(page: str) -> tuple[list[Chunk], dict[str, set[str]]]:
    """The chunks in order, and per path the runs of child labels seen."""
    root = Element("", "", "")
    stack, chunks = [root], []
    children: dict[int, list[str]] = {0: []}       # open element (by depth) -> labels of its children
    shapes: dict[str, set[str]] = {}
    block, at, end = 0, 0, len(page)

    def shut(depth: int) -> None:
        for d in range(len(stack) - 1, depth - 1, -1):
            shapes.setdefault(stack[d].path, set()).add("+".join(children.pop(d)))
        del stack[depth:]

    def text(piece: str) -> None:
        if piece and not piece.isspace():
            holder = children[len(stack) - 1]
            if not holder or holder[-1] != "#":
                holder.append("#")
        if piece:
            chunks.append(Chunk(block, stack[-1].path, html.unescape(piece)))

    while at < end:
        m = TOKEN.search(page, at)
        text(page[at:m.start() if m else end])
        if m is None:
            break
        at = m.end()
        tag = m.group("tag")
        if tag is None:                          # comment, doctype, instruction
            continue
        tag = tag.lower()
        breaks = tag not in INLINE and tag not in QUIET
        if breaks:
            block += 1
        if m.group("end"):
            for d in range(len(stack) - 1, 0, -1):
                if stack[d].tag == tag:
                    shut(d)
                    break
                if not breaks and stack[d].tag not in INLINE and stack[d].tag not in QUIET:
                    break                        # a stray inline end does not close blocks
            continue
        label = label_of(tag, m.group("attributes"))
        if breaks:
            # a block starts: an open paragraph ends, inline elements in it too
            for tags, stop in ((("p",), SCOPES), (CLOSES.get(tag, ()), SCOPES)):
                kept = list(stack)
                _close(kept, tags, stop)
                shut(len(kept))
        if tag in VOID:
            if tag == "br":
                text("\n")
            continue
        if tag in INLINE and label == tag:
            continue                             # plain inline: its text belongs to the block
        siblings = children[len(stack) - 1]
        if not siblings or siblings[-1] != label:
            siblings.append(label)               # runs of one label count once
        path = f"{stack[-1].path}/{label}"
        if tag in RAW:
            close = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            shapes.setdefault(path, set()).add("")
            at = close.end() if close else end
            continue
        children[len(stack)] = []
        stack.append(Element(tag, path, label))
    shut(1)
    return chunks, shapes
