"""Problem 10: sentence boundaries across languages and scripts.

Segmentation rules are ordered pairs of regular expressions, one for the text before a
position and one for the text after it, each marked break or no-break.  At a candidate
position the tables are read in order (the plain one, the language's own, the script's,
the common one) and the first rule that matches decides.  The rules see the whole piece
before and after the position: the first pattern is matched backwards from it.  Tables of
abbreviations are indexed by the letters before the full stop, so that a language's own
table is read only after words that it lists.  Blank lines and the end of the text always
end a sentence.

A text in the Latin script has one language: that of most of its frequent words and
letters; the ``lang`` column only breaks ties, as it is often wrong, and English is taken
where nothing tells.  A text of several scripts has one table per script.

Defined results: null, empty and blank texts have no sentences; whole texts are read,
however long; positions are in Unicode characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from unicodedata import category

import pandas as pd
from pyspark.sql import DataFrame

from restitch.session import spread

# Marks, abbreviations and words that steer the rules.
TERMINATORS = ".!?…。！？؟।॥｡"
CLOSERS = "\"'”’»›)]）」』】》〉"
REPORTING = (
    "said|says|asked|asks|cried|replied|whispered|shouted|answered|added|wrote|laughed|called|told|muttered|yelled|explained"
)
ABBREVIATIONS = {
    "en": {
        "always": "Mr Mrs Ms Dr Prof Rev Hon Sgt Capt Lt Col Gen Gov Sen Rep St Mt Ft Messrs e.g i.e cf viz approx vs ca al".split(),
        "digit": "No Nos Vol Vols Fig Figs p pp Ch Sec Art Nr Jan Feb Mar Apr Jun Jul Aug Sep Sept Oct Nov Dec".split(),
        "lower": "Co Inc Ltd Corp Ave Sq Blvd Rd Apt etc lbs lb oz in ft yd mi dept est U.S U.K U.N a.m p.m Jr Sr Bros".split(),
    },
    "de": {
        "always": "Dr Prof Hr Fr Frl Nr Str bzw z.B d.h u.a vgl ca evtl ggf Abb Bd St".split(),
        "digit": "S Nr Bd Abb Jh".split(),
        "lower": "usw etc usf Chr".split(),
    },
    "fr": {
        "always": "M MM Mme Mlle Mlles Mmes Dr Pr Me Mgr cf env".split(),
        "digit": "n p pp vol fig art".split(),
        "lower": "etc av apr hab".split(),
    },
    "es": {
        "always": "Sr Sra Srta Sres Dr Dra D Dña Prof Ud Uds avda avd Pza pág c/ núm n".split(),
        "digit": "pág págs núm vol art".split(),
        "lower": "etc a.m p.m EE.UU".split(),
    },
    "pt": {
        "always": "Sr Sra Srta Dr Dra Prof Profa Exmo av R D".split(),
        "digit": "n pág vol art".split(),
        "lower": "etc".split(),
    },
    "ru": {
        "always": "ул г д им проф акад просп пер стр корп кв св т н э".split(),
        "digit": "стр с рис гл ст тов".split(),
        "lower": "руб коп др пр тыс млн млрд долл чел гг вв".split(),
    },
    "el": {"always": "κ κα δρ καθ π.χ δηλ σελ αρ".split(), "digit": "σελ αρ".split(), "lower": "κ.λπ κτλ κ.ά".split()},
}
FREQUENT = {
    "en": "the and of a to in is was it you for that on with this be are at by not from have they we his her but or an as had were".split(),
    "de": "der die das und ist nicht ein eine wir dem den im am von mit zu auf für sich er sie es war auch nach bei aus über so noch wie des".split(),
    "fr": "le la les et est des une dans du pas malgré cet était vu un il elle que qui pour sur avec au ce cette par ne se sont nous vous".split(),
    "es": "el la los y es en que por una con del según las un lo se su al no más para como pero está son qué muy".split(),
    "pt": "o a os e é em que um uma com não do da você por minha as dos das no na se ao mais para como mas ele ela muito foi".split(),
}
#: Letters that only one of the languages uses.
OWN_LETTERS = {"de": "äöüß", "fr": "èêëîïûœ«»", "es": "ñ¿¡", "pt": "ãõ"}
#: Words that begin a sentence rather than the second part of a name.
STARTERS = "He|She|It|They|We|You|I|The|A|An|But|And|Or|In|On|At|This|That|These|Those|His|Her|Their|Our|My|There|Then|When|While|After|Before|If|As|What|Who|Why|How|No|Not|So|Yet|For|To|From|With|By|Everyone|Nobody|Some|Most|Many|All"
GERMAN_MONTHS = "Januar|Februar|März|April|Mai|Juni|Juli|August|September|Oktober|November|Dezember"
THAI_ENDINGS = "ครับ|ค่ะ|คะ|ล่ะ|นะ|จ้ะ|จ้า|ไหม"
#: Thai writes spaces between sentences, and also around figures, names and these connectives.
THAI_BEFORE = "และ|หรือ|แต่|ที่|ซึ่ง|เพราะ|ว่า|โดย|กับ|ของ|ใน|คือ|เช่น|ได้แก่|จาก|ถึง|เป็น|นาย|นาง|นางสาว|คุณ|ดร|ฯ|ๆ"
THAI_AFTER = "และ|หรือ|แต่|ซึ่ง|ที่|โดย|กับ|เช่น|ได้แก่|คือ|จึง|ก็|เพราะ|ว่า|ฯ|ๆ"

Rule = tuple[bool, str, str]


def _abbreviation_rules(lang: str) -> list[Rule]:
    a = ABBREVIATIONS[lang]

    def either(words: list[str]) -> str:
        return "|".join(w.replace(".", r"\.\s?").replace("/", r"\/") for w in words)

    start = r"(?<![\p{L}\p{M}\p{N}])"
    return [
        (False, rf"(?i){start}(?:{either(a['digit'])})\.$", r"\s*[\p{N}#]"),
        (False, rf"(?i){start}(?:{either(a['always'])})\.$", r"\s*[\p{L}\p{N}«“\"(]"),
        (False, rf"(?i){start}(?:{either(a['lower'])})\.$", r"\s*[,;:)]"),
    ]


def language_rules() -> dict[str, list[Rule]]:
    """The rule tables.  A rule is (break?, pattern that ends at the position, pattern that starts there)."""
    t: dict[str, list[Rule]] = {lang: _abbreviation_rules(lang) for lang in ABBREVIATIONS}
    start = r"(?<![\p{L}\p{M}\p{N}])"
    t["en"] += [
        # hours: a further word of the same clause follows, or a new sentence
        (False, rf"(?i){start}[ap]\.\s?m\.$", r"\s+(?:to|sharp|without|on|in|and|or|until|till|for|every|daily|at|when|from|by)\b"),
        (False, r"(?i)\p{N}\s?(?:in|lbs?|oz|ft|yd)\.$", r"\s+\p{Ll}"),
        (False, rf"(?i){start}(?:inc|co|ltd|corp|etc)\.$", r"\s+(?:and|or|owns?|is|was|has|had|in|at|of|for|with|on|near|but|which|who)\b"),
        (False, rf"(?i){start}(?:ave|sq|blvd|rd)\.$", r"\s+(?:and|or|near|in|at|by|on|is|was|to|of|next|,)\b"),
        (False, rf"(?i){start}u\.\s?[skn]\.$", rf"\s+(?:\p{{Ll}}|(?!(?:{STARTERS})\b)\p{{Lu}})"),
    ]
    t["de"] += [
        (False, rf"(?<!\p{{L}})\p{{N}}{{1,2}}\.$", rf"\s+(?:{GERMAN_MONTHS})\b"),
        (False, rf"(?i){start}(?:usw|etc|usf)\.$", r"\s+\p{Ll}"),
    ]
    t["fr"] += [(False, rf"(?i){start}etc\.$", r"\s+\p{Ll}")]
    t["es"] += [(False, rf"(?i){start}[ap]\.\s?m\.$", r"\s*(?:[,;)]|\s\p{Ll})")]
    t["pt"] += [(False, rf"(?i){start}etc\.$", r"\s+\p{Ll}")]
    t["ru"] += [(False, rf"(?i){start}(?:руб|коп|др|пр|тыс|млн|млрд|долл|чел|гг|вв)\.$", r"\s+[\p{Ll}\p{N}(]")]
    t["el"] += [(True, r"\p{Greek};[\"'”’»)]*$", r"\s|$")]
    return t


#: Rules of a script, read after those of its languages.
SCRIPT_RULES: dict[str, list[Rule]] = {
    "latin": [
        # a quotation inside a sentence
        (False, rf"[!?.…][{'”’»'}\"']+$", rf"\s+(?i:(?:\p{{L}}+\s+)?(?:{REPORTING})\b|and\b|but\b|or\b)"),
        (False, r"(?i)\b(?:read|reads|said|says|marked|called)\s+['\"‘“]\p{L}+\.['\"’”]$", r"\s+\p{Ll}"),
        (False, r"[!?.…]\s?[»]$", r"\s*,"),
        # an ellipsis that stands between words
        (False, r"\s(?:\.{2,}|…)$", r"\s+\p{Ll}"),
    ],
    "cyrillic": [(False, r"[!?.…]»$", r",?\s+[—–-]\s")],
    "greek": [],
    "han": [
        (False, r"[。！？…][」』”’）】]+$", r"(?:と|って|という|なんて)"),
        (False, r"[。！？…][”’」』]+$", r"[^。！？…\s]{1,12}(?:说|說|问|問|道|喊|叫|答|笑)"),
        (True, r"(?:[。！？｡]|…{1,3})[」』”’）】]*$", r""),
    ],
    "arabic": [(False, r"(?<!\p{L})(?=\p{L})\p{Arabic}\.$", r"\s*\p{L}")],
    "devanagari": [(True, r"[।॥!?][\"'”’»)]*$", r"\s|$|\p{L}")],
    "thai": [
        (True, rf"(?:{THAI_ENDINGS})$", r"\s"),
        (False, rf"(?:{THAI_BEFORE})$", r"\s"),
        (False, r"\p{Thai}$", rf"\s+(?:{THAI_AFTER})"),
        (True, r"\p{Thai}$", r"\s+[\"“‘(]?\p{Thai}"),
        (False, r"\p{Thai}$", r"\s"),
    ],
}

#: Read first, but after words that a language's table lists, initials and figures.
PLAIN: list[Rule] = [(True, r"[.!?]$", r"\s+\p{Lu}")]

COMMON: list[Rule] = [
    # initials
    (False, r"(?<![\p{L}\p{M}\p{N}.])\p{L}\.$", r"\s*[\p{L}\p{N}]"),
    # abbreviations of several letters that many languages borrow
    (False, r"(?i)(?<![\p{L}\p{N}])(?:e\.\s?g|i\.\s?e|z\.\s?b|d\.\s?h|u\.\s?a|p\.\s?ex)\.$", r"\s"),
    # numbers, file names, addresses
    (False, r"\p{N}[.]$", r"\p{N}"),
    # a sentence that follows without a space
    (True, r"[\p{Ll}\p{N})\]\"”’»][.!?…]+[\"'”’»)\]]*$", r"[\"“‘«(]?\p{Lu}[\p{L}'’]*(?:[\s,:;]|$)"),
    (False, r".$", r"[^\s\"'“”‘’«»(\[—–-]"),
    # marks followed by a clause of the same sentence
    (False, r".$", r"\s*[,;:]"),
    (True, r".$", r"\s|$"),
    (True, r".$", r"[\"“‘«(\[—–]"),
]

_SCRIPTS = ("latin", "cyrillic", "greek", "han", "arabic", "devanagari", "thai")


def stems_of(lang: str) -> set[str]:
    """The letters that stand before the full stop in the rules of a language: what its table is indexed by."""
    words = {w.lower() for ws in ABBREVIATIONS.get(lang, {}).values() for w in ws}
    more = {"en": "in lb lbs oz ft yd inc co ltd corp etc ave sq blvd rd", "de": "usw etc usf", "fr": "etc", "pt": "etc"}
    return {w.rsplit(".", 1)[-1].rsplit("/", 1)[-1] for w in words} | set(more.get(lang, "").split())


class Segmenter:
    """Compiled tables; one per worker."""

    def __init__(self) -> None:
        import regex

        self.re = regex

        def compiled(rules: list[Rule]) -> list[tuple]:
            # the left pattern is matched backwards from the position, so that it costs no search
            out = []
            for b, p, a in rules:
                flags = "(?ri)" if p.startswith("(?i)") else "(?r)"
                out.append((b, regex.compile(f"{flags}(?:{p.removeprefix('(?i)').removesuffix('$')})").match, regex.compile(a).match))
            return out

        self.languages = {k: compiled(v) for k, v in language_rules().items()}
        self.scripts = {k: compiled(v) for k, v in SCRIPT_RULES.items()}
        self.common = compiled(COMMON)
        self.plain = compiled(PLAIN)
        self.stems = {k: stems_of(k) for k in ABBREVIATIONS}
        self.frequent: dict[str, list[str]] = {}
        for k, v in FREQUENT.items():
            for w in v:
                self.frequent.setdefault(w, []).append(k)
        closers = regex.escape(CLOSERS)
        terms = regex.escape(TERMINATORS)
        self.candidate = regex.compile(rf"(?:[{terms}]+|(?<=\p{{Greek}});)[{closers}]*")
        self.thai = regex.compile(r"(?<=\p{Thai})(?=\s)")
        self.blank = regex.compile(r"(?:\r\n|[\n\r])[^\S\n\r]*(?:\r\n|[\n\r])\s*")
        self.word = regex.compile(r"[\p{L}\p{M}]+")
        self.presence = {
            "latin": regex.compile(r"\p{Latin}"), "cyrillic": regex.compile(r"\p{Cyrillic}"),
            "greek": regex.compile(r"\p{Greek}"), "han": regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}]"),
            "arabic": regex.compile(r"\p{Arabic}"), "devanagari": regex.compile(r"\p{Devanagari}"),
            "thai": regex.compile(r"\p{Thai}"),
        }
        self.of_script = {"cyrillic": "ru", "greek": "el"}
        self.cascades: dict[tuple, tuple[list, list, frozenset[str], bool]] = {}

    def language(self, text: str, lang: str | None) -> str:
        """The language of a text in the Latin script."""
        low = text.lower()
        score = dict.fromkeys(FREQUENT, 0.0)
        score["en"] += 0.25
        hint = (lang or "").strip().lower()[:2]
        if hint in score:
            score[hint] += 0.5
        for w in self.word.findall(low):
            for k in self.frequent.get(w, ()):
                score[k] += 1
        if not low.isascii():
            for k, letters in OWN_LETTERS.items():
                score[k] += 2 * sum(low.count(c) for c in letters)
        return max(score, key=lambda k: (score[k], k))

    def cascade(self, text: str, lang: str | None) -> tuple[list, list, frozenset[str], bool]:
        """All tables for a text, those without the languages' own, the index of the latter, and whether Thai is in it."""
        scripts = ("latin",) if text.isascii() else tuple(s for s in _SCRIPTS if self.presence[s].search(text))
        key = (scripts, self.language(text, lang) if "latin" in scripts else "")
        if key not in self.cascades:
            own: list = []
            rest: list = []
            stems: set[str] = set()
            for s in scripts:
                k = key[1] if s == "latin" else self.of_script.get(s)
                if k:
                    own += self.languages[k]
                    stems |= self.stems[k]
                rest += self.scripts[s]
            rest += self.common
            self.cascades[key] = own + rest, self.plain + rest, frozenset(stems), "thai" in scripts
        return self.cascades[key]

    def ends(self, text: str | None, lang: str | None = None) -> list[int]:
        """End positions of the sentences of a text."""
        if not text or not text.strip():
            return []
        rules = self.cascade(text, lang)
        ends: set[int] = set()
        at = 0
        for m in self.blank.finditer(text):
            self._part(text, at, m.start(), rules, ends)
            at = m.end()
        self._part(text, at, len(text), rules, ends)
        return sorted(ends)

    def _part(self, text: str, lo: int, hi: int, rules: tuple[list, list, frozenset[str], bool], ends: set[int]) -> None:
        part = text[lo:hi].rstrip()
        if not part.strip():
            return
        size = len(part)
        for m in self.candidate.finditer(part):
            p = m.end()
            if p < size and self._breaks(part, p, rules):
                ends.add(lo + p)
        if rules[3]:
            for m in self.thai.finditer(part):
                p = m.end()
                if p < size and self._breaks(part, p, rules):
                    ends.add(lo + p)
        ends.add(lo + size)

    def _breaks(self, part: str, p: int, rules: tuple[list, list, frozenset[str], bool]) -> bool:
        table = rules[1]
        last = part[p - 1]
        if last == ";":
            table = rules[0]
        elif last == ".":
            i = p - 1
            while i and ((c := part[i - 1]).isalpha() or (c > "\u0300" and category(c)[0] == "M")):
                i -= 1
            if p - 1 - i <= 1 or part[i : p - 1].lower() in rules[2]:
                table = rules[0]
        for decision, left, right in table:
            if right(part, p) and left(part, 0, p):
                return decision
        return False


_segmenter: list[Segmenter] = []


def segmenter() -> Segmenter:
    if not _segmenter:
        _segmenter.append(Segmenter())
    return _segmenter[0]


def sentence_ends(documents: DataFrame) -> DataFrame:
    """(doc_id, end_pos): one row for each sentence of each document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seg = segmenter()
        for pdf in batches:
            ids: list[int] = []
            ends: list[int] = []
            for doc, text, lang in zip(pdf["doc_id"], pdf["text"], pdf["lang"], strict=True):
                found = seg.ends(text if isinstance(text, str) else None, lang if isinstance(lang, str) else None)
                ids += [doc] * len(found)
                ends += found
            yield pd.DataFrame({"doc_id": pd.Series(ids, dtype="int64"), "end_pos": pd.Series(ends, dtype="int32")})

    kept = spread(documents.select("doc_id", "text", "lang").where("text is not null and doc_id is not null"), "doc_id")
    return kept.mapInPandas(run, "doc_id bigint, end_pos int")


def sentences(documents: DataFrame) -> DataFrame:
    """(doc_id, sent_no, start_pos, end_pos, sentence): the sentence units themselves."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seg = segmenter()
        for pdf in batches:
            rows = []
            for doc, text, lang in zip(pdf["doc_id"], pdf["text"], pdf["lang"], strict=True):
                text = text if isinstance(text, str) else ""
                at = 0
                for k, end in enumerate(seg.ends(text, lang if isinstance(lang, str) else None), 1):
                    start = at + len(text[at:end]) - len(text[at:end].lstrip())
                    rows.append((doc, k, start, end, text[start:end]))
                    at = end
            yield pd.DataFrame(rows, columns=["doc_id", "sent_no", "start_pos", "end_pos", "sentence"])

    kept = spread(documents.select("doc_id", "text", "lang").where("text is not null and doc_id is not null"), "doc_id")
    return kept.mapInPandas(run, "doc_id bigint, sent_no int, start_pos int, end_pos int, sentence string")
