"""Markup functions that splice text: links, attributes, rendered comments.  Plain functions, wrapped into Arrow UDFs."""

from __future__ import annotations

import posixpath
import re
from urllib.parse import unquote, urljoin, urlsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_REF = re.compile(r"""(?is)(<(?:a|img|link|script|iframe|form|area|frame|td|table|body)\b[^>]*?\s(?:href|src|action|background)\s*=\s*)("[^"]*"|'[^']*'|[^\s>"']+)""")
_CSS = re.compile(r"""(?i)(url\(\s*["']?)([^"')]+)(["']?\s*\))""")


def references(page: str) -> list[str]:
    """Distinct references of a page in order: attributes, then style sheets."""
    found = [m.group(2).strip("\"'") for m in _REF.finditer(page)] + [m.group(2) for m in _CSS.finditer(page)]
    return list(dict.fromkeys(x for x in found if x))


def relative(target: str, page: str) -> str:
    """Path of ``target`` as seen from ``page``; query, fragment and a trailing slash stay."""
    path, mark, tail = target, "", ""
    for c in "?#":
        at = path.find(c)
        if at >= 0:
            path, mark, tail = path[:at], path[at], path[at + 1 :] + mark + tail
    base = posixpath.dirname(page) or "/"
    rel = posixpath.relpath(path or "/", base)
    if path.endswith("/") and not rel.endswith("/"):
        rel += "/"
    return ("./" if rel in (".", "./") else rel) + mark + tail


def rewrite(page: str, targets: dict[str, str]) -> str:
    """References replaced by their targets, everything else untouched."""

    def attr(m: re.Match) -> str:
        raw = m.group(2)
        quote = raw[0] if raw[0] in "\"'" else ""
        new = targets.get(raw.strip("\"'"))
        return m.group() if new is None else f"{m.group(1)}{quote or chr(34)}{new}{quote or chr(34)}"

    page = _REF.sub(attr, page)
    return _CSS.sub(lambda m: m.group(1) + targets.get(m.group(2), m.group(2)) + m.group(3), page)


def delink(page: str, dead: set[str]) -> str:
    """Anchors to dead targets unwrapped, images of dead targets removed; the words stay."""

    def anchor(m: re.Match) -> str:
        return m.group(2) if m.group(1).strip("\"'") in dead else m.group()

    page = re.sub(r"(?is)<a\b[^>]*?\shref\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+)[^>]*>(.*?)</a>", anchor, page)
    return re.sub(r"(?is)<img\b[^>]*?\ssrc\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+)[^>]*>", lambda m: "" if m.group(1).strip("\"'") in dead else m.group(), page)


def with_alt(page: str, alts: dict[str, str]) -> str:
    """Alternative texts of images set from a map by source."""
    import html

    def img(m: re.Match) -> str:
        tag = m.group()
        src = re.search(r"(?is)\ssrc\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+)", tag)
        alt = alts.get(src.group(1).strip("\"'")) if src else None
        if alt is None:
            return tag
        bare = re.sub(r"(?is)\salt\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+)", "", tag)
        return re.sub(r"\s*/?>$", lambda e: f' alt="{html.escape(alt)}"' + e.group(), bare, count=1)

    return re.sub(r"(?is)<img\b[^>]*>", img, page)


_CELL = re.compile(r"(?is)<(/?)(tr|td|span|br)\b([^>]*)>")


def _rows(page: str) -> list[tuple[int, int, str, list[tuple[int, int]]]]:
    """(start, end, attributes of the first cell, inner spans of the cells) of every table row without a row inside."""
    out, start, cells, attrs = [], None, [], ""
    open_at = None
    for m in _CELL.finditer(page):
        closing, name = m.group(1) == "/", m.group(2).lower()
        if name == "tr" and not closing:
            start, cells, attrs, open_at = m.start(), [], "", None
        elif name == "td" and start is not None:
            if closing and open_at is not None:
                cells.append((open_at, m.start()))
                open_at = None
            elif not closing:
                open_at = m.end()
                attrs = attrs if cells else m.group(3)
        elif name == "tr" and start is not None:
            out.append((start, m.end(), attrs, cells))
            start = None
    return out


# The labels of a rendered comment, in the order they are printed.
LABELS = ("subject", "date", "name", "comment")


def _label_spans(page: str, lo: int, hi: int) -> dict[str, tuple[int, int]]:
    """Where the value of each label stands inside a cell: behind its span and the colon, up to the next label or a break at the end."""
    marks = []
    spans = [m for m in _CELL.finditer(page, lo, hi) if m.group(2).lower() == "span"]
    for opened, closed in zip(spans, spans[1:], strict=False):
        if opened.group(1) or not closed.group(1):
            continue
        label = page[opened.end() : closed.start()].strip().lower()
        rest = page[closed.end() : hi]
        colon = len(rest) - len(rest.lstrip())
        if label in LABELS and rest[colon : colon + 1] == ":":
            marks.append((label, opened.start(), closed.end() + colon + 1))
    out = {}
    for k, (label, _, begin) in enumerate(marks):
        end = marks[k + 1][1] if k + 1 < len(marks) else hi
        out.setdefault(label, (begin, end))
    return out


def _value(text: str) -> str:
    text = text.strip()
    while text.lower().endswith((">",)) and (m := re.search(r"(?i)<br\s*/?>$", text)):
        text = text[: m.start()].strip()
    return text


def _comments(page: str) -> list[tuple[int, int, dict[str, tuple[int, int]]]]:
    """(start, end with the separator row, label spans) of each rendered comment."""
    rows = _rows(page)
    out = []
    for k, (start, end, _, cells) in enumerate(rows):
        labels = _label_spans(page, *cells[0]) if len(cells) == 1 else {}
        if "subject" not in labels:
            continue
        if k + 1 < len(rows):
            s2, e2, attrs, inner = rows[k + 1]
            blank = len(inner) == 1 and page[inner[0][0] : inner[0][1]].strip() == "&nbsp;"
            if blank and "border:" in attrs and not page[end:s2].strip():
                end = e2
        out.append((start, end, labels))
    return out


def rendered_comments(page: str) -> list[dict[str, str]]:
    """The comments of a rendered page as fields subject, date, name, comment; a missing one is ''."""
    return [{n: _value(page[slice(*labels[n])]) if n in labels else "" for n in LABELS} for _, _, labels in _comments(page)]


def without_comments(page: str, drop) -> tuple[str, int, int]:  # noqa: ANN001 - a predicate on the fields
    """(page, removed, kept): comment rows that the predicate holds for taken out with their separators."""
    out, at, removed, kept = [], 0, 0, 0
    for (start, end, _), fields in zip(_comments(page), rendered_comments(page), strict=True):
        if drop(fields):
            out.append(page[at:start])
            at, removed = end, removed + 1
        else:
            kept += 1
    return "".join([*out, page[at:]]), removed, kept


_MAIL = re.compile(r"(?i)[\w.+-]+@[\w-]+(?:\.[\w-]+)*\.[a-z]{2,}")
_CALL = re.compile(r"\(?\b\d{3}\)?[ .-]*\d{3}[ .-]\d{4}\b")


def scrub_text(text: str) -> str:
    """Addresses, then telephone numbers, replaced by marks."""
    return _CALL.sub("[phone removed]", _MAIL.sub("[email removed]", text))


def name_only(fragment: str) -> str:
    """A name without the link around it and without addresses."""
    bare, depth = [], re.split(r"(?is)(</?a\b[^>]*>)", fragment)
    for piece in depth:
        if not re.match(r"(?is)</?a\b", piece):
            bare.append(piece)
    return _MAIL.sub("[email removed]", "".join(bare))


def anonymised(page: str) -> str:
    """The rendered comments of a page without contact data: names reduced to what was typed, texts and subjects scrubbed."""
    how = {"subject": scrub_text, "name": name_only, "comment": scrub_text}
    edits = sorted((*span, how[label]) for _, _, labels in _comments(page) for label, span in labels.items() if label in how)
    out, at = [], 0
    for lo, hi, f in edits:
        out += [page[at:lo], f(page[lo:hi])]
        at = hi
    return "".join([*out, page[at:]])


_SAYS = re.compile(r"(?is)(?P<date>\d{2}\.\d{2}\.\d{2})(?P<mid>[^<]{0,80}:\s*<span[^>]*>)(?P<name>.*?)(?P<end></span>\s*says:)")


def answers(page: str) -> list[dict[str, str]]:
    """The dated answers of a question page: date, name and text; the text is the first cell of the row after the header's."""
    rows = _rows(page)
    out = []
    for k, (_, _, _, cells) in enumerate(rows[:-1]):
        m = _SAYS.search(page, *cells[0]) if len(cells) == 1 else None
        if m and rows[k + 1][3]:
            out.append({"date": m["date"], "name": m["name"], "text": page[slice(*rows[k + 1][3][0])].strip()})
    return out


def without_answers(page: str, drop) -> tuple[str, int]:  # noqa: ANN001 - a predicate on an answer
    """(page, removed): header and text rows of the answers that the predicate holds for taken out."""
    rows = _rows(page)
    out, at, removed = [], 0, 0
    for k, (start, _, _, cells) in enumerate(rows[:-1]):
        m = _SAYS.search(page, *cells[0]) if len(cells) == 1 else None
        if m and rows[k + 1][3] and drop({"date": m["date"], "name": m["name"], "text": page[slice(*rows[k + 1][3][0])].strip()}):
            out.append(page[at:start])
            at, removed = rows[k + 1][1], removed + 1
    return "".join([*out, page[at:]]), removed


def anonymised_answers(page: str) -> str:
    """Names of a question page reduced to what was typed, and its answers scrubbed; what stands before them stays."""
    at = page.find("answers:</span>")
    if at < 0:
        return page
    tail = _SAYS.sub(lambda m: m["date"] + m["mid"] + name_only(m["name"]) + m["end"], page[at:])
    return page[:at] + scrub_text(tail)


def page_parts(page: str) -> dict[str, str]:
    """Head title, opening of the body, main cell and rest of a page cut at its marks; '' where a mark is missing."""
    title = re.search(r"(?is)<title>(.*?)</title>", page)
    body = re.search(r"(?is)<body[^>]*>(.*?)(?:</body>|$)", page)
    inner = body.group(1) if body else page
    main = re.search(r"(?is)<(td|div)\b[^>]*\b(?:class|id)\s*=\s*[\"']?(?:main_cell|main|content|c|wrap|left)\b[^>]*>", inner)
    if not main:
        return {"title": title.group(1).strip() if title else "", "frame": "", "main": inner, "tail": ""}
    foot = re.search(r"(?is)<div[^>]*id\s*=\s*[\"']?footer", inner)
    end = foot.start() if foot and foot.start() > main.end() else len(inner)
    return {"title": title.group(1).strip() if title else "", "frame": inner[: main.start()], "main": inner[main.end() : end], "tail": inner[end:]}


def _join(base: pd.Series, ref: pd.Series) -> pd.Series:
    def one(b: str | None, r: str | None) -> str | None:
        if b is None or r is None:
            return None
        try:
            return urljoin(b, r)
        except ValueError:
            return None

    return pd.Series([one(b, r) for b, r in zip(base, ref, strict=True)])


def join_url(base: Column, ref: Column) -> Column:
    """A reference resolved against its page; null when it is no reference.  Arrow UDF: no native form."""
    return F.pandas_udf(_join_hinted, "string")(base, ref)


def _join_hinted(base: pd.Series, ref: pd.Series) -> pd.Series:
    return _join(base, ref)


def decoded_path(url: str) -> str:
    return unquote(urlsplit(url).path) or "/"
