"""Visible blocks of an HTML page with the lines they stand on.

One pass over the markup.  A block is the text between two block-level tags (or line
break tags); its pieces remember their line, numbered from 1 and ended by line feeds.
Head, scripts, styles, noscript hints and comments are not visible.
"""

from __future__ import annotations

import html as _html
import re

_TAG = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9]*)([^<>]*)>")
#: What may hide something: its end is looked for from there.
_UNSEEN = re.compile(r"(?i)<!--|<!\w[^>]*>|<(script|style|noscript|head|textarea|iframe)(?![A-Za-z0-9])[^<>]*>")
#: Elements whose content is not shown.
_HIDDEN = frozenset("script style noscript head textarea iframe".split())
_HREF = re.compile(r"(?is)\bhref\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)")
_CLASS = re.compile(r"(?is)\b(?:class|id)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)")
INLINE = frozenset("a abbr acronym b big bdo cite code dfn em font i img ins kbd label q s samp small span strike strong sub sup tt u var nobr wbr center_inline".split())
OUTSIDE = re.compile(r"(?i)^(?:https?:)?//([^/?#:]+)")


class Block:
    __slots__ = ("anchors", "bold_first", "classes", "first_link", "form", "heading", "last_link", "lines", "link_in", "link_out", "tag", "text")

    def __init__(self, tag: str, classes: str) -> None:
        self.tag, self.classes = tag, classes
        self.lines: dict[int, bool] = {}  # numbers of the lines that show text of the block
        self.text = ""
        self.link_in = self.link_out = 0
        self.first_link = self.last_link = False
        self.bold_first = False
        self.form = False
        self.heading = False
        self.anchors = 0


def _shown(page: str) -> str:
    """The page with a mark, which ends blocks and keeps the line feeds, in place of each hidden element; comments leave their line feeds."""
    out: list[str] = []
    at = 0
    while (m := _UNSEEN.search(page, at)) is not None:
        name = m.group(1)
        if name is None:
            end = page.find("-->", m.end()) + 3 if page[m.start() : m.end()] == "<!--" else m.end()
            if end < 3:  # a comment without an end is text
                out.append(page[at : m.end()])
                at = m.end()
                continue
            out += [page[at : m.start()], "\n" * page.count("\n", m.start(), end)]
        else:
            end = _hidden_end(page, m.end(), name.lower())
            if end is None:
                out.append(page[at : m.end()])
                at = m.end()
                continue
            out += [page[at : m.start()], "<hiddenmark", "\n" * page.count("\n", m.start(), end), ">"]
        at = end
    return "".join([*out, page[at:]]) if out else page


def blocks(page: str, own_host: str | None = None) -> list[Block]:
    """The blocks with visible text, in order."""
    out: list[Block] = []
    line = 1
    tag, classes = "body", ""
    link: str | None = None
    bold = large = 0
    heading = form = False
    block: Block | None = None
    pieces: list[str] = []
    parts = _TAG.split(_shown(page))
    for k in range(0, len(parts), 4):
        text = parts[k]
        if text:
            if text.isspace():
                line += text.count("\n")
                if block is not None:
                    pieces.append(" ")
            else:
                # entities never hold line feeds, so lines are those of the source
                if "&" in text:
                    text = _html.unescape(text)
                for i, part in enumerate(text.split("\n") if "\n" in text else (text,)):
                    if i:
                        line += 1
                        if block is not None:
                            pieces.append(" ")
                    n = len(part.strip())
                    if n:
                        if block is None:
                            block = Block(tag, classes)
                            block.heading, block.form = heading, form
                            block.first_link = link == "in"
                            block.bold_first = bold > 0
                            first = True
                        else:
                            first = False
                        block.lines[line] = True
                        if link is not None:
                            block.anchors += first or not block.last_link
                            if link == "in":
                                block.link_in += n
                            else:
                                block.link_out += n
                        block.last_link = link == "in"
                        if large:
                            block.heading = True
                        pieces.append(part)
        if k + 3 >= len(parts):
            break
        closing, name, rest = parts[k + 1] == "/", parts[k + 2].lower(), parts[k + 3]
        if name in INLINE:
            if name == "a":
                if closing:
                    link = None
                else:
                    h = _HREF.search(rest)
                    target = h.group(1).strip("\"'") if h else ""
                    o = OUTSIDE.match(target)
                    link = "out" if o and (own_host is None or not o.group(1).lower().removeprefix("www.").endswith(own_host)) else "in"
            elif name in ("b", "strong"):
                bold = max(0, bold + (-1 if closing else 1))
            elif name == "big" or (name == "font" and (closing or _LARGE.search(rest))):
                large = 0 if closing else 1
            elif name == "span" and not closing and block is None:
                c = _CLASS.search(rest)
                if c and _TITLED.search(c.group(1)):
                    heading = True
        else:
            if block is not None:
                block.text = " ".join("".join(pieces).split())
                out.append(block)
                block, pieces = None, []
            heading = form = False
            if name != "hiddenmark":
                if closing:
                    tag, classes = "body", ""
                else:
                    c = _CLASS.search(rest) if rest else None
                    tag, classes = name, (c.group(1).strip("\"'").lower() if c else "")
                    heading = name in _HEADINGS or (classes != "" and _TITLE.search(classes) is not None)
                    form = name in _FORM
        if "\n" in rest:
            line += rest.count("\n")
    if block is not None:
        block.text = " ".join("".join(pieces).split())
        out.append(block)
    return out


_LARGE = re.compile(r"(?i)size\s*=\s*[\"']?[+4-7]")
_TITLED = re.compile(r"(?i)(?:head(?:line|ing)?|title)s?\b")
_TITLE = re.compile(r"\b(?:headline|title)\b")
_HEADINGS = frozenset(("h1", "h2", "h3"))
_FORM = frozenset(("form", "input", "select", "option", "button"))
_ENDS = {n: re.compile(rf"(?i)</{n}\s*>") for n in _HIDDEN}
_BODY = re.compile(r"(?i)<body\b")


def _hidden_end(page: str, at: int, name: str) -> int | None:
    """Where a hidden element ends; a head without an end stops at the body, others without an end are shown."""
    m = _ENDS[name].search(page, at)
    if m:
        return m.end()
    if name == "head":
        b = _BODY.search(page, at)
        return b.start() if b else None
    return None
