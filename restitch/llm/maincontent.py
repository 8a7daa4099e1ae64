"""Problem 7: the article of a page without its boilerplate.

Two passes over the visible blocks of a page.  The first decides what a block shows by
itself: link density, length, stop-word density, and the wording of site text.  Long
running text is main content, link lists and site text are boilerplate, headings and
short blocks stay open.  In the second pass a run of open blocks takes the label
of its nearest decided neighbour, the one before it on a tie, without crossing a heading,
and a heading takes that of what follows it.

The same rules read the pieces of frames, where nothing but a badly cut article is main
content.  Defined results: null, empty and blank html have no lines; lines are numbered
from 1 and end at line feeds; every line that shows text of a main block counts; whole
pages are read; repeated rows are each judged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from restitch.llm.io import field_rows
from restitch.llm.pageblocks import Block, blocks
from restitch.llm.residue import ERROR_SIGNS, SCRIPT_ERRORS, SENTENCE, SLOT_SIGNS, SLOTS, verdict, whole
from restitch.llm.wording import Wording
from restitch.session import spread

#: SITE is boilerplate by its wording: it may stand in the middle of an article, as link lists may not.
GOOD, BAD, SITE, NEAR, HEAD = "good", "bad", "site", "near", "head"
#: Share of a block's characters inside links to the own site from which on it is a list of links.
LINK_DENSITY = 0.3
STOP_DENSITY_LOW = 0.1
LONG_WORDS = 12

# Stop words of the languages in use, and the wording of site text.
STOP_WORDS = set(
    """a an the and or but if of to in on at by for from with as is are was were be been it its this that these those i you he she we they me my your
    his her our their not no so do does did has have had who what when where how there can could would will just than then too very one more most
    still never while after before under between behind upstairs only every nobody somebody somebody's
    der die das und oder aber ein eine einen dem den des im am vom zum ist war nicht mit von zu für auf wir ich sie er es so über nach bis zum
    le la les un une des du de et ou est était pas que qui dans sur pour avec ce cette il elle au aux à depuis malgré très trop
    el los las y o es que por una con del al se su según lo más en muy tan qué
    o os um uma do da dos das e é em que não por com para você já ou
    и в не на что это был была он она мы вы я как с по из у за от до так его её но к
    και το η ο οι των της του δεν να που με είναι για τα την τον αλλά
    في من على هل ما إن لكنها كانت قال قرأ
    है की के का ने में को और यह था थी नहीं से क्या बहुत""".split()
)
SITE_TEXT = Wording(
    r"""
    ^(?:in\s+this\s+issue|new\s+comments|recent\s+comments|related\s+(?:stories|articles|posts|links)|more\s+from\s+this\s+(?:section|author|issue)|more\s+stories|tag\s+cloud|tags|archives?(?:\s+by\s+\w+)?
       |top\s+rated|most\s+(?:read|popular|viewed|commented|e-?mailed)(?:\s+\w+){0,3}|editor'?s?\s+picks?|you\s+(?:may|might)\s+also\s+(?:like|enjoy)|popular(?:\s+now)?|latest\s+(?:news|stories|articles)|categories|sections|navigation|menu|links|search)$
    | ©|&copy;|\bcopyright\b|\ball\s+rights\s+reserved\b | \bwithout\s+(?:the\s+)?(?:prior\s+)?written\s+permission\b | \breproduc(?:ed|tion)\b.{0,60}\b(?:permission|prohibited)\b
    | \bcookies?\b.{0,80}\b(?:policy|visit|accept|browser|settings|readers|signed|inhalte|audience|consent|use[sd]?|site)\b | \b(?:uses?|utilise|verwenden|usa(?:mos)?|utilizamos|использует)\b.{0,30}\bcookies?\b | \bcookies\b
    | \b(?:store|remember)\b.{0,60}\b(?:on|from)\s+your\s+(?:device|computer)\b | \bsmall\s+files\b | \bprivacy\s+(?:policy|terms|settings)\b | \bwe\s+value\s+your\s+privacy\b | \bterms\s+of\s+(?:use|service)\b | \baccept\s+all\b | \bmanage\s+choices\b
    | \bpublished\s+(?:weekly|monthly|daily|quarterly)\b.{0,80}\badvertis | \badvertising\s+rates\b | \bback\s+issues\s+are\s+available\b | \b(?:views|opinions)\s+(?:in|expressed)\b.{0,60}\bnot\s+(?:necessarily\s+)?those\s+of\b
    | \bsubscribe\s+to\s+(?:our|the)\b | \bnewsletter\b | \bunsubscribe\b | ^sign\s+up\b | ^join\s+(?:the|our|\d[\d,.]*)\b.{0,60}\b(?:list|readers|members|letter)\b | \blist\s+is\s+free\b | ^enter\s+your\s+(?:e-?mail|address)
    | ^(?:advertisement|advert|anzeige|publicité|publicidad|реклама|sponsored)\b | ^ad\s*: | \bsponsored\s+by\b | \byour\s+ad\s+here\b | \bwith\s+this\s+coupon\b | \bhalf\s+price\s+with\b | \bbook\s+early\b | \bgo\s+on\s+sale\s+in\b | \bentry\s+free\b.{0,40}\bparking\b
    | \brooms\s+at\s+(?:the\s+)?hotel\b | \bbought\s+and\s+sold\b
    | \bpowered\s+by\b | ^made\s+with\b | ^follow\s+us\b | ^(?:share|print|email|e-mail|rate|bookmark)\s+(?:this|to)\b | ^(?:post\s+a\s+comment|add\s+to\s+favou?rites|back\s+to\s+top|top\s+of\s+page|site\s+map|sitemap|print\s+this\s+page|home)\b.{0,60}$
    | \byou\s+are\s+visitor\b | \bvisitors?\s+since\b | ^last\s+(?:updated|modified|changed)\b | ^(?:previous|next|prev)\s+(?:story|page|article|issue)\b | \b(?:previous|next)\s+(?:story|page|article)\s*(?:/|\||»|&raquo;|$)
    | ^(?:«\s*)?(?:back|prev(?:ious)?|next)\b.{0,40}\b(?:page|next|back)\b.{0,12}$ | ^[\[\]\d\s|«»<>.…·\-]+(?:next|prev(?:ious)?|more|back)?[\s»>]*$ | ^page\s+\d+\s+of\s+\d+ | ^home\s*(?:>|»|/|::) | \blog\s?in\b.{0,20}\bregister\b
    | ^(?:accepter|zustimmen|ablehnen|aceptar|rechazar|принять|j['’]accepte|learn\s+more|mehr\s+erfahren)[.!]?$
    """
)
READ_ON = re.compile(r"(?i)^\W*(?:more|full story|read (?:on|more|the rest|the full\b.*)|continue(?: reading)?|\.\.\.|…|weiter(?:lesen)?|lire la suite|leer más|далее|full article)\W*$")
_ITEMS = re.compile(r"^[^.!?]{0,120}$")
_SEPARATOR = re.compile(r"\s(?:\||·|•|::|/)\s")
_EDGE = ".,;:!?…\"'“”‘’«»()[]¿¡—–"
_DENSE = re.compile(r"[぀-ヿ㐀-鿿฀-๿]")
_END = re.compile(r"[.!?…。！？।؟;:][\"'”’»)\]」』]*$")
_TALK = re.compile(r"^[^\s:][^:.!?]{0,24}: \S.{0,60}$")


_BYLINE = re.compile(r"(?i)^(?:by|words(?:\s+and\s+\w+)?\s*(?:by|:)|(?:photos?|text|story|pictures)(?:\s+and\s+\w+)?\s+by|von|par|por|текст:?)\s+\S+(?:\s+\S+){0,4}$|^\S+(?:\s+\S+){1,3}\s+reports$")
#: Longer blocks are read sentence by sentence.
SITE_WORDS = 45


@lru_cache(maxsize=50_000)
def _wording(text: str) -> str | None:
    """SITE or BAD by the wording of a short block, None when it decides nothing."""
    if SITE_TEXT.search(text):
        return SITE
    if (" | " in text or " / " in text or _SEPARATOR.search(text)) and _ITEMS.match(text) and not _END.search(text[-8:]):
        parts = _SEPARATOR.split(text)
        if len(parts) >= 3 or all(len(p.split()) <= 6 for p in parts):
            return SITE
    if (  # a message
        verdict(text)
        or (any(x in text for x in ERROR_SIGNS) and SCRIPT_ERRORS.search(text) and len(SCRIPT_ERRORS.sub("", text)) < 60)
        or (any(x in text for x in SLOT_SIGNS) and SLOTS.search(text) and len(SLOTS.sub("", text).split()) < 3)
    ):
        return BAD
    return None


@lru_cache(maxsize=50_000)
def _long_wording(text: str) -> str | None:
    """BAD when a long block is a message as a whole, else what the wording of more than half of it says."""
    parts = SENTENCE.split(" ".join(text.split()))
    if whole(" ".join(parts), len(parts)):
        return BAD
    if any(x in text for x in ERROR_SIGNS) and len(SCRIPT_ERRORS.sub("", text)) < 60:
        return BAD
    size = {SITE: 0, BAD: 0, None: 0}
    for x in parts:
        size[_wording(x)] += len(x)
        if size[None] >= 0.5 * len(text):
            return None
    return SITE if size[SITE] >= size[BAD] else BAD


def first_pass(b: Block) -> str:
    text = b.text
    n = len(text)
    if b.form or b.link_in >= LINK_DENSITY * n or b.first_link:
        return BAD
    if text.count(" ") < SITE_WORDS:
        w = _wording(text)
    else:
        w = _long_wording(text)
    if w:
        return w
    if b.last_link and b.link_in:  # a teaser ends in a link to its story
        return BAD
    if b.link_out >= 0.7 * n:
        return NEAR
    return _shape(text, b.heading)


@lru_cache(maxsize=50_000)
def _shape(text: str, heading: bool) -> str:
    """Label by length and stop-word density."""
    gaps = text.count(" ")
    if gaps < 6 and _BYLINE.match(text):
        return HEAD  # goes with the text below it
    words = [w.strip(_EDGE) for w in text.lower().split()]
    size = sum(1 for w in words if w)
    stops = sum(w in STOP_WORDS for w in words) / max(1, size)
    ended = bool(_END.search(text[-8:]))
    if not text.isascii():
        dense = len(_DENSE.findall(text))
        if dense >= 8 and (ended or dense >= 20):
            return HEAD if heading else GOOD
        size += dense // 2
    if heading:
        return HEAD
    if size >= LONG_WORDS and (stops >= STOP_DENSITY_LOW or ended):
        return GOOD
    if ended and size >= 4 and stops >= STOP_DENSITY_LOW and not _TALK.match(text):
        return GOOD
    return NEAR


def second_pass(labels: list[str]) -> list[str]:
    """GOOD or BAD for every block."""
    n = len(labels)
    out = [BAD if x == SITE else x for x in labels]
    for i in range(n - 1, -1, -1):  # a heading goes with what it stands over
        if labels[i] == HEAD:
            k = i + 1
            while k < n and labels[k] in (NEAR, SITE):
                k += 1
            out[i] = out[k] if k < n else BAD
    i = 0
    while i < n:  # runs of open blocks
        if labels[i] != NEAR:
            i += 1
            continue
        k = i
        while k < n and labels[k] == NEAR:
            k += 1
        left, right = (labels[i - 1] if i else None), (labels[k] if k < n else None)
        before, after = (out[i - 1] if i else None), (out[k] if k < n else None)
        if left == HEAD:
            got = before
        elif left is None or (left == SITE and right == GOOD):
            got = after if right != HEAD else BAD
        else:
            got = before
        for j in range(i, k):
            out[j] = got or BAD
        i = k
    return out


def _without_text(bs: list[Block], labels: list[str]) -> list[str]:
    """A page without running text: a message leaves no article at all; else a byline, or a top heading, is its article."""
    if GOOD in labels:
        return labels
    if any(x == BAD and not b.form and (_wording(b.text) if b.text.count(" ") < SITE_WORDS else _long_wording(b.text)) == BAD for b, x in zip(bs, labels, strict=True)):
        return [BAD if x in (NEAR, HEAD) else x for x in labels]
    bylines = [x == HEAD and bool(_BYLINE.match(b.text)) for b, x in zip(bs, labels, strict=True)]
    if any(bylines):
        return [GOOD if y else x for x, y in zip(labels, bylines, strict=True)]
    tops = [x == HEAD and (b.tag in ("h1", "h2") or "headline" in b.classes) for b, x in zip(bs, labels, strict=True)]
    return [GOOD if y else x for x, y in zip(labels, tops, strict=True)]


def article_lines(page: str | None, own_host: str | None = None) -> list[int]:
    """Numbers of the lines that show text of the article."""
    if not isinstance(page, str) or not page.strip():
        return []
    bs = blocks(page, own_host)
    first = [first_pass(b) for b in bs]
    labels = second_pass(_without_text(bs, first))
    return sorted({k for b, lab in zip(bs, labels, strict=True) if lab == GOOD for k in b.lines})


def article_text(page: str | None, own_host: str | None = None) -> str | None:
    """The article's blocks as paragraphs; null for null."""
    if not isinstance(page, str):
        return None
    bs = blocks(page, own_host)
    labels = second_pass(_without_text(bs, [first_pass(b) for b in bs]))
    return "\n\n".join(b.text for b, lab in zip(bs, labels, strict=True) if lab == GOOD)


def own_host_of(url: str | None) -> str | None:
    m = re.match(r"(?i)^(?:https?:)?//(?:www\.)?([^/?#:]+)", url or "")
    return m.group(1).lower() if m else None


def found(pages: DataFrame, frames: DataFrame) -> DataFrame:
    """(tbl, rec_id, field, line_no) of every line of article text in pages and frames."""
    fields = field_rows(pages, "pages", "page_id", ["html"]).unionByName(field_rows(frames, "frames", "frame_id", ["nav", "menu"]))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out: list[tuple] = []
            for tbl, rec, field, text in zip(pdf["tbl"], pdf["rec_id"], pdf["field"], pdf["text"], strict=True):
                out += [(tbl, rec, field, k) for k in article_lines(text)]
            yield pd.DataFrame(out, columns=["tbl", "rec_id", "field", "line_no"])

    rows = spread(fields.where("rec_id is not null"), "rec_id")
    return rows.mapInPandas(run, "tbl string, rec_id bigint, field string, line_no int")


def bodies(pages: DataFrame) -> DataFrame:
    """(page_id, body): the main text of each page."""

    @F.pandas_udf("string")
    def body(html: pd.Series) -> pd.Series:
        return html.map(article_text)

    return spread(pages.select("page_id", "html"), "page_id").select("page_id", body("html").alias("body"))
