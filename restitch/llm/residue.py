"""Problem 4: template residue and error-page text.

Short visible blocks of pages are messages.  A prefix tree of fixed depth (number of
words, first word, second and third word, one of LAST buckets of the last word, then a
list of templates compared word by word) mines the message templates of the whole table.
Every template is classified once: by its wording, or by its statistics, which are the
number of pages that show it and on how many of them it is all there is to read; its
verdict reaches each page that shows a message of it.  Unfilled slots, and script errors
printed into running text, are looked for separately inside all visible text of ordinary
pages.

Plan: pages are parsed into (page, leaf key, message) rows; the distinct masked
messages with their counts (map-side combine) are spread by leaf key and mined in one
pass per task whose memory is bounded by the templates; the few templates with a
verdict join the message rows by leaf key, by broadcast or shuffle as their measured
size asks for.

Defined results: null, empty and blank html are no case; repeated rows are each judged;
whole pages are read.
"""

from __future__ import annotations

import re
import re._parser as parser
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from restitch.llm.pageblocks import blocks
from restitch.llm.wording import Wording
from restitch.session import spread, written

#: Longer blocks reach the templates only by what is told in them: a sentence with a verdict, or filler.
MESSAGE_WORDS = 40
SIMILARITY = 0.7
#: Buckets of the last word in the template tree: they split leaves that very many messages share.
LAST = 64
#: A template stands for a page without an article when at least so many pages of different articles show it and on
#: this share of them it makes up most of the text.
SPREAD, ALONE, MOST = 20, 0.9, 0.6
WILD = "<*>"

# Shapes of slots, server messages, notices and filler.  Dates and rows of page numbers are no filler;
# the filler patterns take digits one by one, so that no text is split in more than one way.
SLOTS = re.compile(
    r"\{\{[^{}\n]{1,60}\}\}|\{%[^%\n]{1,60}%\}|\$\{[A-Za-z_][\w.]{0,40}\}|\{\$[A-Za-z_][\w.\->]{0,40}\}|%%[A-Za-z_]\w{1,40}%%|##[A-Za-z_]\w{1,40}##"
    r"|\[\[[A-Za-z_][\w .]{1,40}\]\]|<%[=@]?[^%\n]{1,60}%>|<\?(?:php|=)[^?\n]{1,80}\?>|\{[a-z_]\w*(?:\.\w+)+(?:\|\w+)*\}|\{[a-z_]\w*\|\w+\}"
    r"|(?<!\w)__[A-Z][A-Z0-9_]+__(?!\w)|\b[A-Z]+(?:_[A-Z]+)*_GOES_HERE\b|\[(?:your|insert|enter|add|put)\b[^\[\]\n]{0,50}\]|\[INSERT\b[^\[\]\n]{0,50}\]"
    r"|\bXXX\b[^\n]{0,40}\bXXX\b|\bcaption TK\b|\((?:photographer|author|caption|credit|name|title|photo)[\w ]{0,30} to come\)|@@[A-Z_]+@@|\{[A-Z][A-Z_]{2,}\}|\$[A-Z][A-Z_]{3,}\$"
)
SCRIPT_ERRORS = re.compile(
    r"(?:Warning|Notice|Fatal error|Parse error|Deprecated|Strict Standards)\s?:\s.{0,200}?(?:\bin\s\S*/\S+|\bon line \d+)"
    r"|You have an error in your SQL syntax|Access denied for user\s+\S+\s*\(using password|mysql_\w+\(\)|\[an error occurred while processing this directive\]"
    r"|(?:VBScript|JScript|ASP) (?:runtime|compilation) error|ODBC (?:\w+ )?(?:Driver|error)|Traceback \(most recent call last\)|java\.lang\.\w+Exception|Unhandled exception|stack trace:",
)
_AGAIN = r"""^([^\W\d]\w{1,11})[\s,.!]+(?=(?:\d[\s,.!]*)*\1)(?:(?:\1|\d)[\s,.!]*){2,}$ | ^(?=.*[^\W\d])(?:(?:asdf|qwer\w*|jkl|xxx(?:x{1,2}(?!x))?|foo|bar|baz|blah|bla|test|text|abc|lorem|dummy|sample|\d)[\s,.;!]*){3,}$"""
_MESSAGES = {
    "server": r"""
        \b[45]\d\d\b.{0,20}\b(?:not\s+found|forbidden|unauthori[sz]ed|internal\s+server\s+error|bad\s+gateway|bad\s+request|service\s+unavailable|gateway\s+time-?out|gone|denied)\b
        | ^error\s*[:#\-]?\s*[45]\d\d\b | ^(?:http\s*(?:/\d\.\d)?\s*)?(?:error|status)\b.{0,10}\b[45]\d\d\b
        | ^(?:file|page|document|object|article|item|record)\s+not\s+found[.!]?$
        | \brequested\s+(?:url|page|document|file|resource)\b.{0,80}\b(?:was\s+)?(?:not\s+found|could\s+not\s+be\s+found|no\s+longer)
        | \b(?:page|story|article|document|file)\s+(?:you\s+)?(?:asked\s+for|requested|are\s+looking\s+for|were\s+looking\s+for|wanted)\b.{0,60}\b(?:not|no\s+longer|gone|moved|missing|removed|deleted)\b
        | ^(?:sorry|oops|whoops|uh-?oh)\b.{0,100}\b(?:page|story|article|file|wandered|lost|went\s+wrong|found|broken|error|unavailable)
        | ^internal\s+server\s+error | \bserver\s+(?:could\s+not|is\s+unable\s+to|was\s+unable\s+to|encountered)\b | ^(?:bad\s+gateway|gateway\s+time-?out|bad\s+request)[.!]?
        | ^service\s+(?:temporarily\s+)?unavailable | ^bandwidth\s+limit\s+exceeded | ^forbidden\b | \bdo(?:n't|\s+not)\s+have\s+permission\s+to\s+access\b | ^access\s+(?:is\s+)?(?:denied|forbidden)
        | \bcould\s+not\s+connect\s+to\b | \b(?:can(?:\s*no|'|’)?t|unable\s+to|failed\s+to)\s+(?:connect|select)\b.{0,40}\b(?:database|server|host|db)\b | ^too\s+many\s+connections | ^database\s+(?:error|connection)\b
        | ^apache(?:/[\d.]+)?.{0,40}\bserver\s+at\b.{0,60}\bport\b | ^no\s+(?:article|story|page|issue|record|entry|such)\b.{0,50}\b(?:exists?|found|number|id|file|article)\b
        | ^(?:if\s+this\s+(?:persists|problem\s+persists|error\s+persists)|please\s+(?:tell|contact|notify)\s+the\s+(?:webmaster|administrator)).{0,60}$
        | ^go\s+back\s+and\s+try\s+another\s+link | ^index\s+of\s+/ | ^the\s+system\s+cannot\s+find\b | ^(?:an\s+)?(?:unexpected|unknown|fatal|application)\s+error\b | ^query\s+failed
        | ^(?:seite|artikel|datei)\s+(?:wurde\s+)?nicht\s+gefunden | ^p[áa]gina\s+n(?:o|ão)\s+encontrada | ^page\s+(?:non\s+trouvée|introuvable) | ^страница\s+не\s+найдена | ^la\s+p[áa]gina\s+.{0,30}no\s+existe
        | ^(?:页面|頁面|网页).{0,6}(?:未找到|不存在|找不到) | ^找不到.{0,6}(?:页面|网页|页|頁) | ページが?(?:は)?見つかりません | ^(?:ошибка|fehler|erreur|error)\s+[45]\d\d
        | \b(?:angeforderte|gewünschte)\s+(?:seite|datei|url|artikel)\b.{0,60}\b(?:nicht|leider)\b | ^(?:la\s+)?page\s+(?:que\s+vous\s+)?(?:demandée?z?|cherchez|recherchée)\b.{0,60}\b(?:pas|plus|introuvable)\b
        | \b(?:página|artículo|artigo)\s+(?:que\s+)?(?:solicitada|solicitado|busca|procura)\b.{0,60}\bn[oã]o?\b | \bзапрошенн\w+\s+(?:страниц|документ|файл)\w*\b.{0,60}\b(?:не|нет)\b
        | ^(?:η\s+)?σελίδα\s+δεν\s+βρέθηκε | ^الصفحة\s+غير\s+موجودة | ^ไม่พบหน้า""",
    "notice": r"""
        \b(?:enable|turn\s+on|switch\s+on|activate|requires?|needs?|allow)\b.{0,40}\b(?:java\s?scripts?|scripts?|scripting|cookies\s+in\s+your\s+browser)\b
        | \b(?:java\s?script|scripts?|scripting)\b.{0,40}\b(?:must\s+be|is|are|has\s+been|have\s+been)?\s*(?:on|enabled|required|disabled|turned\s+off|blocked|needed)\b
        | \bbrowser\b.{0,40}\b(?:does\s+not\s+support|blocks?|is\s+not\s+supported|too\s+old|cannot\s+show)\b | ^checking\s+your\s+browser | ^loading\b.{0,90}\b(?:scripts?|java\s?script|browser)\b
        | ^this\s+(?:account|site|domain|web\s?site|page)\s+(?:has\s+been|is|was)\s+(?:temporarily\s+)?(?:suspended|disabled|closed|deactivated|parked|expired|for\s+sale)
        | \bdown\s+for\s+(?:scheduled\s+)?maintenance\b | ^(?:scheduled\s+|under\s+|site\s+)?maintenance\b.{0,80}$ | ^under\s+construction | ^(?:coming\s+soon|check\s+back\s+soon)[.!]*$ | \bwill\s+be\s+back\s+(?:soon|shortly|online)\b
        | ^(?:please\s+|you\s+(?:must|need\s+to|have\s+to)\s+)(?:sign|log)\s?-?\s?in\b | ^(?:sign|log)\s?-?\s?in\s+(?:to|for)\s+(?:continue|read|view|see|access)\b | \b(?:members|subscribers)\s+only\b | ^(?:your\s+)?session\s+(?:has\s+)?(?:expired|timed\s+out)
        | \byou\s+(?:are|must\s+be)\s+(?:not\s+)?(?:logged|signed)\s+in\b | \bregistered\s+(?:readers|users|members)\b.{0,40}\b(?:only|sign|log)\b
        | ^javascript\s+ist\s+deaktiviert | ^bitte\s+(?:aktivieren|schalten)\b.{0,60}\b(?:javascript|cookies)\b | ^(?:veuillez|merci\s+d['’])\s*activer\b | ^activez\s+javascript | ^(?:active|habilite|ative)\s+(?:el\s+|o\s+)?javascript
        | ^(?:включите|для\s+просмотра).{0,40}javascript | (?:请|請).{0,6}(?:启用|啟用|打开).{0,8}javascript | javascript\s*を?(?:有効|オン) | ^wartungsarbeiten | ^(?:sitio|página)\s+en\s+(?:mantenimiento|construcción) | ^site\s+en\s+(?:maintenance|construction)""",
    "filler": r"""
        \b(?:type|enter|put|insert|paste|write|add)\s+your\s+(?:article\s+)?(?:text|copy|story|content|title|headline)\b | \b(?:headline|copy|text|title|story|content|body|caption|image)\s+goes\s+here\b
        | ^(?:dummy|sample|placeholder|filler|example)\s+(?:text|copy|content)\b | \breplace\s+(?:this\s+)?(?:text\s+)?before\s+(?:going\s+live|publishing|launch)
        | ^(?:texto\s+de\s+(?:prueba|ejemplo|relleno)|hier\s+steht\s+(?:ein\s+)?(?:blindtext|beispieltext)|blindtext|texte\s+(?:de\s+remplissage|d['’]exemple|ici)|texto\s+de\s+exemplo|пример\s+текста|текст\s+для\s+заполнения|здесь\s+будет\s+текст|тестовый\s+текст|рыба\s+текст|测试文本|示例文本|ダミーテキスト|テストテスト)
        | ^(?:this\s+is\s+)?(?:a\s+)?(?:test|dummy)\s+(?:page|article|story)[.!]?$ | ^untitled(?:\s+document)?$ | ^new\s+page\s+\d+$""",
}
MESSAGES = {k: Wording(v + (" | " + _AGAIN if k == "filler" else "")) for k, v in _MESSAGES.items()}
_AGAIN_ONLY = Wording(_AGAIN)
LATIN_FILLER = set(
    """lorem ipsum dolor sit amet consectetur consectetuer adipiscing elit sed eiusmod tempor incididunt labore dolore magna aliqua enim minim veniam
    quis nostrud exercitation ullamco laboris nisi aliquip commodo consequat duis aute irure reprehenderit voluptate velit esse cillum fugiat nulla pariatur
    excepteur sint occaecat cupidatat non proident sunt culpa officia deserunt mollit anim id est laborum nibh erat volutpat vexat finis cetera tempus porta
    mattis ornare vestibulum pellentesque habitant morbi tristique senectus netus malesuada fames turpis egestas nunc quam felis ultra parvo murin talus
    lignum quorem volut praesent vitae eget lectus mauris cursus vulputate sapien ultricies""".split()
)
_WORDS = re.compile(r"[^\W\d_]+")


#: Ends of sentences inside a block.
SENTENCE = re.compile(r"(?<=[.!?…])\s+|(?<=[。！？])\s*")


def latin_filler(text: str) -> bool:
    """Pseudo-Latin: most words of a block, or the sentences that hold more than half of its words, come from the usual filler."""
    words = _WORDS.findall(text.lower())
    known = sum(w in LATIN_FILLER for w in words)
    if len(words) < 6 or known < 0.3 * len(words):
        return False
    if known >= 0.6 * len(words):
        return True
    parts = [_WORDS.findall(x.lower()) for x in SENTENCE.split(text)]
    return sum(len(x) for x in parts if len(x) >= 6 and sum(w in LATIN_FILLER for w in x) >= 0.6 * len(x)) > 0.5 * len(words)


@lru_cache(maxsize=50_000)
def _shape(text: str, rest: int, start: int | None) -> str | None:
    """The class of a text that is its shape and at most ``rest`` characters, or at most ``start`` characters long and starts with it."""
    for kind, rx in MESSAGES.items():
        m = rx.search(text)
        # a message is little more than its shape; a sentence about one is longer
        if m and (len(text) - (m.end() - m.start()) <= rest or m.start() == 0 and (start is None or len(text) <= start)) and not _quoted(text, m):
            return kind
    return None


#: No shape but _AGAIN is longer than this in a text whose words stand one space apart (numbers and marks in a row taken to be 40 at most).
LONGEST = max(parser.parse(r"(?i)" + re.sub(r"\s+", "", v).replace(r"\s+", "[ ]").replace(r"\s*", "[ ]?").replace(r"\d+", r"\d{1,40}").replace(r"[\d.]+", r"[\d.]{1,40}").replace("!]*$", "!]{0,40}$")).getwidth()[1] for v in _MESSAGES.values())


def whole(text: str, sentences: int) -> str | None:
    """The class of a block as a whole; its words stand one space apart."""
    if sentences > 1 and len(text) > LONGEST + 60:  # too long to be little more than another shape
        kind = "filler" if _AGAIN_ONLY.search(text) else None
    else:
        kind = _shape(text, 60, None if sentences == 1 else 200)
    return kind or ("filler" if latin_filler(text) else None)


def told(message: str) -> tuple[str | None, str]:
    """(class, the part that says so) of a block of any length: the whole of it, else its first sentence with a class."""
    text = " ".join(message.split())
    parts = SENTENCE.split(text)
    kind = whole(text, len(parts))
    if kind:
        return kind, text
    if len(parts) > 1:
        for x in parts:
            kind = _shape(x, 60, None)
            if kind == "server" or kind == "notice" and _shape(x, 20, None):  # an article's sentence on the site's state says more
                return kind, x
    return None, text


def verdict(message: str) -> str | None:
    """The class of a message template, None for ordinary text."""
    return told(message)[0]


def _quoted(text: str, m: re.Match) -> bool:
    """The shape is named inside a sentence of an article: words stand before it."""
    before = _WORDS.findall(text[: m.start()])
    return len(before) >= 4 and len(text) > m.end() - m.start() + 4


_WILD_WORDS = re.compile(r"(?<!\S)(?:\S*\d\S*|(?=\S{4,})\S+/\S+)")


def mask(text: str) -> list[str]:
    """Words of a message; those with digits or paths are wild."""
    if "/" in text or any(c in text for c in "0123456789"):
        text = _WILD_WORDS.sub(WILD, text)
    return text.split()


class TemplateTree:
    """Fixed depth: length, first word, second and third word, bucket of the last word, then templates."""

    def __init__(self, similarity: float = SIMILARITY) -> None:
        self.leaves: dict[tuple, list[dict]] = {}
        self.similarity = similarity

    def add(self, words: list[str], example: str, n: int = 1, key: tuple | None = None, alone: int = 0, a0: float | None = None, a1: float | None = None) -> dict:
        leaf = self.leaves.setdefault(key or leaf_key(words), [])
        best, score = None, -1.0
        for t in leaf:
            s = similar(t["words"], words)
            if s > score:
                best, score = t, s
        if best is None or score < self.similarity:
            best = {"words": list(words), "example": example, "n": 0, "alone": 0, "a0": a0, "a1": a1}
            leaf.append(best)
        else:
            best["words"] = [a if a == b else WILD for a, b in zip(best["words"], words, strict=True)]
            best["a0"] = min((x for x in (best["a0"], a0) if x is not None and x == x), default=None)  # noqa: PLR0124
            best["a1"] = max((x for x in (best["a1"], a1) if x is not None and x == x), default=None)  # noqa: PLR0124
        best["n"] += n
        best["alone"] += alone
        return best

    def templates(self) -> Iterator[tuple[tuple, dict]]:
        for key, leaf in self.leaves.items():
            for t in leaf:
                yield key, t


def leaf_key(words: list[str]) -> tuple[int, str, str]:
    """Length, first word, and second with third word: deep enough that a leaf holds few templates."""
    return len(words), words[0] if words else "", " ".join(words[1:3])


def similar(template: list[str], words: list[str]) -> float:
    return sum(a == b or a == WILD for a, b in zip(template, words, strict=True)) / max(1, len(words))


#: Without any of these there is no slot and no script error, which spares the patterns.
SLOT_SIGNS = ("{", "[[", "%%", "##", "<%", "<?", "__", "@@", "_GOES_HERE", "XXX", "caption TK", " to come)", "$", "[")
ERROR_SIGNS = ("/", "line ", "SQL", "Access denied", "mysql_", "directive]", "error", "ODBC", "Traceback", "xception", "stack trace")


@lru_cache(maxsize=50_000)
def _message(text: str) -> tuple[bool, str | None, str, int, str, str]:
    """(slot or script error, the message, masked or None when it is ordinary text, and its leaf key) of a block."""
    slot = (any(x in text for x in SLOT_SIGNS) and bool(SLOTS.search(text))) or (
        any(x in text for x in ERROR_SIGNS) and bool(SCRIPT_ERRORS.search(text))
    )
    if text.count(" ") >= MESSAGE_WORDS:
        kind, text = told(text)
        if kind is None:
            return slot, None, text, 0, "", ""
    words = mask(text) if text.count(" ") < MESSAGE_WORDS else mask(" ".join(text.split()[:12]))
    return (slot, " ".join(words), text, *leaf_key(words))


def page_signals(page: str) -> tuple[bool, list[tuple[str, str, int, str, str, bool]]]:
    """(slot or script error in the visible text, its messages as (example, masked, length, first word, next words, makes up most of the page))."""
    slot = False
    messages = []
    bs = blocks(page)
    total = sum(len(b.text) for b in bs if not b.form and b.link_in + b.link_out <= 0.5 * len(b.text))
    for b in bs:
        s, masked, text, n, w1, w2 = _message(b.text)
        slot = slot or s
        if masked is not None and b.link_in + b.link_out <= 0.5 * len(b.text):
            messages.append((text, masked, n, w1, w2, len(b.text) >= MOST * total))
    return slot, messages


def last_bucket(masked: str) -> int:
    """The bucket of the last word; the same everywhere, so that it may be a key."""
    return zlib.crc32(masked.rpartition(" ")[2].encode()) % LAST


def message_rows(pages: DataFrame) -> DataFrame:
    """(page_id, article_id, slot, n_words, w1, w2, last, masked, example, most); a page without messages has one row with null words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows: list[tuple] = []
            for i, a, page in zip(pdf["page_id"], pdf["article_id"], pdf["html"], strict=True):
                slot, messages = page_signals(page)
                a = None if a != a else a  # noqa: PLR0124 - a missing number
                if slot:
                    rows.append((i, a, True, None, None, None, None, None, None, None))
                rows += [(i, a, False, n, w1, w2, last_bucket(masked), masked, text, most) for text, masked, n, w1, w2, most in dict.fromkeys(messages)]
            out = pd.DataFrame(rows, columns=["page_id", "article_id", "slot", "n_words", "w1", "w2", "last", "masked", "example", "most"])
            yield out.astype({"article_id": "Int64", "n_words": "Int32", "last": "Int32", "most": "boolean"})

    article = F.col("article_id") if "article_id" in pages.columns else F.lit(None)
    rows = spread(pages.select("page_id", article.cast("bigint").alias("article_id"), "html").where("html is not null and page_id is not null"), "page_id")
    return rows.mapInPandas(
        run, "page_id bigint, article_id bigint, slot boolean, n_words int, w1 string, w2 string, last int, masked string, example string, most boolean"
    )


def template_verdict(example: str, n: int, alone: int, spread_out: bool) -> str | None:
    """The class of a template: that of its wording, else 'page' when it stands alone on many pages of different articles."""
    return verdict(example) or ("page" if spread_out and n >= SPREAD and alone >= ALONE * n else None)


def templates(rows: DataFrame) -> DataFrame:
    """(n_words, w1, w2, last, template, n, verdict) mined from message rows; verdict is null for ordinary text."""
    key = ("n_words", "w1", "w2", "last")
    distinct = (
        rows.where("masked is not null").groupBy(*key, "masked")
        .agg(
            F.count(F.lit(1)).alias("n"), F.min("example").alias("example"), F.count_if("most").alias("alone"),
            F.min("article_id").alias("a0"), F.max("article_id").alias("a1"),
        )
        .repartition(*key).sortWithinPartitions(*key, "masked")
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree = TemplateTree()
        last: tuple | None = None

        def out() -> pd.DataFrame:
            got = [(*k, " ".join(t["words"]), t["n"], template_verdict(t["example"], t["n"], t["alone"], t["a0"] != t["a1"])) for k, t in tree.templates()]
            return pd.DataFrame(got, columns=[*key, "template", "n", "verdict"])

        for pdf in batches:
            for n, w1, w2, bucket, masked, count, example, alone, a0, a1 in zip(*(pdf[c] for c in (*key, "masked", "n", "example", "alone", "a0", "a1")), strict=True):
                at = (n, w1, w2, bucket)
                if at != last and len(tree.leaves) > 5000:  # rows are sorted by leaf: finished leaves can go
                    yield out()
                    tree.leaves.clear()
                last = at
                tree.add(masked.split(" "), example, int(count), at, int(alone), a0, a1)
        yield out()

    return distinct.mapInPandas(run, "n_words int, w1 string, w2 string, last int, template string, n bigint, verdict string")


def judged(pages: DataFrame) -> DataFrame:
    """(page_id, verdict): every page with residue and the least of its verdicts by name ('slot' for slots)."""
    rows = written(message_rows(pages))
    bad = templates(rows).where("verdict is not null").select("n_words", "w1", "w2", "last", "template", "verdict")

    @F.pandas_udf("boolean")
    def fits(template: pd.Series, masked: pd.Series) -> pd.Series:
        return pd.Series([similar(t.split(" "), m.split(" ")) >= SIMILARITY for t, m in zip(template, masked, strict=True)], dtype=bool)

    # a template found by its statistics is the verdict only of pages on which it stands alone
    hits = (
        rows.where("masked is not null").join(bad, ["n_words", "w1", "w2", "last"])
        .where((F.col("verdict") != "page") | F.col("most")).where(fits("template", "masked")).select("page_id", "verdict")
    )
    slots = rows.where("slot").select("page_id", F.lit("slot").alias("verdict"))
    return hits.unionByName(slots).groupBy("page_id").agg(F.min("verdict").alias("verdict"))


def found(pages: DataFrame) -> DataFrame:
    return judged(pages).select("page_id")


def content_pages(pages: DataFrame) -> DataFrame:
    """The pages that are left when those with residue are taken out; pages without html stay out, too."""
    return pages.where("html is not null and trim(html) != ''").join(found(pages), "page_id", "left_anti")
