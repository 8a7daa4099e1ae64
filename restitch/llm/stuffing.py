"""Problem 5: keyword-stuffed texts and link lists among reader comments.

A record is a sequence of lines: its name, its subject and the lines of its text
(line breaks, <br>, and sentence ends separate lines).  Every line becomes one symbol
per feature: links, repeated words, function words, tag and list marks.  A hidden
Markov model with the states prose, link list, tag list and menu reads the sequence;
its tables are counted from the labelled lines below, which a seeded generator fills
with its own words, with add-one smoothing.  Viterbi decoding labels the lines, and a
record is flagged when its words outside prose are a large enough share of a field, or
stand in one run of at least CARRIED words, as a list carried by a long text does.

Defined results: null and empty fields have no lines; a record without any line is no
case; whole texts are read; repeated rows are judged one by one.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from restitch.session import spread

STATES = ("prose", "links", "tags", "menu")
#: A field is stuffed from this share of words outside prose on, if they are at least FEW_WORDS.
SHARE = 0.38
FEW_WORDS = 3
#: A text carries a list, however long the prose around it, when so many words outside prose follow one another.
CARRIED = 24

# Function words of the languages in use.
FUNCTION_WORDS = set(
    """a an the and or but if of to in on at by for from with as is are was were be been it its this that these those
    i you he she we they me my your his her our their not no so do does did has have had who what when where how there
    can could would will just than then too very one more most still
    über am gegen bis alles alle etwas nichts hier dort der die das und oder aber ein eine einen dem den des im am vom zum ist war nicht mit von zu für auf wir ich sie er es so
    le la les un une des du de et ou est était pas que qui dans sur pour avec ce cette il elle au aux à depuis malgré
    el los las y o es que por una con del al se no su según lo más en muy
    os um uma do da dos das e é em que não por com para você já ou
    и в не на что это был была он она мы вы я как с по из у за от до так его её но к
    και το η ο των της του δεν να που με είναι για τα την τον αλλά
    في من على هل ما إن لكنها كانت
    этот эта эти моя такой слишком после только уже все или если чтобы
    quel quelle très trop elle vraiment déjà vers cet qué ella esta este quién cuando donde sobre sin você minha meu muito ninguém quando onde sem
    है की के का ने में को और यह था थी नहीं से क्या""".split()
)
NUMBER_WORDS = set("zero one two three four five six seven eight nine".split())
CJK_FUNCTION = set("的了是在我你他她它们們这這那很也都就不去看来はがをにのでとへもたい")
SALES_WORDS = set("sale order best buy cheap top price now online offer deals free shop store discount".split())

_LINK = re.compile(
    r"(?i)\[url[^\]]*\]|<a\s[^>]*href[^>]*>|https?://[^\s\"'<>\])]+|\bwww\.[^\s\"'<>\])]+"
    r"|\(\s*[a-z0-9.\-]+\.(?:[a-z]{2,})(?:\.[a-z]{2,})?\s*\)"
)
_MAIL = re.compile(r"[\w.+\-]+\s?(?:@|\(at\)|\[at\]|\bat\b)\s?[\w\-]+(?:\s?(?:\.|\(dot\)|\[dot\]|\bdot\b)\s?[\w\-]+)+")
#: Wrongly decoded characters would cut words into pieces.
_GARBLED = re.compile("(?:[ÂÃâÐÑÅÄ][\u0080-\u00bf€‚ƒ„…†‡ˆ‰Š‹Œ‘’“”•–—˜™š›œžŸŽ]{1,3})+")
_TAGS = re.compile(r"(?s)</?\w+[^>]*>|\[/?url[^\]]*\]", re.I)
_LINES = re.compile(r"(?i)(?:\r\n|\r|\n|<br\s*/?>|</?(?:p|div|li|ul|ol|tr|td|table)\b[^>]*>)+")
_SENTENCES = re.compile(r"(?<=[.!?…])\s+|(?<=[。！？])")
_APART = re.compile(r"(?i)(</a>|\[/url\])\s*(?:<br\s*/?>|[\r\n])+\s*(?=<a\s|\[url)")
_WORD = re.compile(r"#?[^\W_]+(?:[_'’\-][^\W_]+)*", re.U)
_CJK = re.compile(r"[぀-ヿ㐀-鿿]")


def lines_of(text: str) -> list[str]:
    """The lines of a field.  Anchors that follow one another stay one line, as a list of them is one thing."""
    if "</a>" in text or "[/" in text or "</A>" in text:
        text = _APART.sub(r"\1 ", text)
    out = []
    for part in _LINES.split(text):
        for s in _SENTENCES.split(part):
            if s and s.strip():
                out += _pieces(s)
    return out


def _pieces(line: str) -> list[str]:
    """A long line without sentence ends or links in pieces, as keywords may follow prose without a break."""
    words = line.split(" ")
    if len(words) <= 18 or _LINK.search(line) or len(_MARK.findall(line)) > 2:
        return [line]
    return [" ".join(words[i : i + 9]) for i in range(0, len(words), 9)]


def words_of(line: str) -> tuple[list[str], int]:
    """Lower-case words of the visible text, and the number of links."""
    links, shown = 0, line
    if any(c in line for c in "[<(/") or "www" in line.lower():
        links = len(_LINK.findall(line))
        shown = _LINK.sub(" ", line)
    if "@" in shown or " at " in shown or "at)" in shown or "at]" in shown:
        shown = _MAIL.sub(" ", shown)
    if not shown.isascii():
        shown = _GARBLED.sub("e", shown)
    shown = _TAGS.sub(" ", shown)
    words = [w.lower() for w in _WORD.findall(shown)]
    return [w for w in words if w not in NUMBER_WORDS and not w.isdigit()], links


def shown_forms(line: str) -> tuple[str, str]:
    """The line without tags, and without tags and links."""
    marked = "<" in line or "[" in line
    bare = _TAGS.sub(" ", line) if marked else line
    if marked or "(" in line or "/" in line or "www" in line.lower():
        return bare, _TAGS.sub(" ", _LINK.sub(" ", line))
    return bare, bare


_OTHER_SEPARATOR, _COMMA = re.compile(r"[|;/]|\s-\s|\]\s*\["), re.compile(r"[,、，]")


def separators(shown: str) -> int:
    """0 without repeated separators, 1 with commas, 2 with others."""
    if len(_OTHER_SEPARATOR.findall(shown)) >= 2:
        return 2
    return int(len(_COMMA.findall(shown)) >= 2)


def capitals(shown: str) -> int:
    """0 few, 1 some, 2 most words begin with a capital; 3 all letters are capitals."""
    if shown.isupper():
        return 3
    words = big = 0
    for w in shown.split():
        if w[0].isalpha():
            words += 1
            big += w[0].isupper()
    return _level(big / max(words, 1), (0.15, 0.6))


def sentence_shape(bare: str) -> bool:
    """Starts and ends as a sentence does, and is not in capitals throughout."""
    shown = bare.strip()
    first = shown.lstrip("\"'“‘«¡¿([「")[:1]
    if not (first.isupper() or _CJK.match(first)) or shown[-1:] not in tuple(".!?…。！？\"”’»)」"):
        return False
    words = shown.split()
    return bool(_CJK.search(shown)) or sum(w[0].isupper() for w in words) < 0.7 * len(words)


@lru_cache(maxsize=200_000)
def _word(w: str) -> tuple[str, bool, bool, bool, bool]:
    """(plain form, counted over the record, function word, content word, long enough to count) of a word."""
    plain = w.lstrip("#").replace("_", "")
    dense = bool(_CJK.search(w))
    function = w in FUNCTION_WORDS or re.split("['’]", w)[0] in FUNCTION_WORDS
    return (
        plain, w not in FUNCTION_WORDS, function or (dense and not CJK_FUNCTION.isdisjoint(w)), not function and (len(w) > 3 or dense), len(w) > 2 or dense,
    )


class Line:
    """What a line shows by itself."""

    __slots__ = ("content", "counted", "fixed", "function", "links", "long_words", "n", "shape")

    def __init__(self, text: str) -> None:
        words, links = words_of(text)
        self.n, self.links = len(words), links
        n = max(self.n, 1)
        known = [_word(w) for w in words]
        self.counted = tuple(k[0] for k in known if k[1])
        self.content = tuple(k[0] for k in known if k[3])
        self.function = sum(k[2] for k in known) / n
        self.long_words = sum(k[4] for k in known)
        bare, shown = shown_forms(text)
        self.shape = sentence_shape(bare)
        marks = len(_MARK.findall(bare))
        repeat = 1 - len({k[0] for k in known}) / self.n if self.n else 0.0
        self.fixed = (
            2 if links >= 3 else min(links, 1), _level(links / (self.n + links) if self.n + links else 0, (0.15, 0.45)), _level(repeat, (0.15, 0.4)),
            _level(sum(w in SALES_WORDS for w in words) / n, (0.05, 0.2)), _level(sum(w[0] == "#" for w in words) / n, (0.2,)),
            _level(self.n, (2, 7, 12)) * 3 + _level(marks / n, (0.1, 0.3)), separators(shown) * 4 + capitals(shown),
        )


@lru_cache(maxsize=50_000)
def line(text: str) -> Line:
    return Line(text)


def _level(x: float, bounds: tuple[float, ...]) -> int:
    k = 0
    for b in bounds:
        if x >= b:
            k += 1
    return k


def symbols(field: str, ln: Line, record_counts: Counter, line_counts: Counter) -> tuple[int, ...]:
    """One small integer per feature of a line; line_counts: the number of lines of the record that have a word."""
    # words that come back all over the record, however its lines are cut
    again = shared = 0
    for w in ln.content:
        again += record_counts[w] >= 3
        shared += line_counts[w] >= 2
    n = max(ln.n, 1)
    return (
        *ln.fixed, _level(again / n, (0.15, 0.5)),
        # how much the line shares with others, read together with its function words and its shape
        (_level(shared / n, (0.25, 0.6)) * 4 + _level(ln.function, (0.03, 0.26, 0.38))) * 2 + ln.shape,
        # a name or subject that is longer than names and subjects are, and has no function words
        0 if field == "text" else 1 + (ln.long_words >= 4) + (ln.long_words >= 4 and ln.function == 0),
    )


FEATURE_SIZES = (3, 3, 3, 3, 2, 12, 12, 3, 24, 4)
_MARK = re.compile(r"[|;/,\[\]#•·»›]|\s-\s")


def observe(name: str | None, subject: str | None, text: str | None) -> list[tuple[str, int, tuple[int, ...]]]:
    """(field, words, symbols) of each line of a record, in order."""
    raw: list[tuple[str, Line]] = []
    for field, value in (("name", name), ("subject", subject), ("text", text)):
        if isinstance(value, str) and value.strip():
            for s in lines_of(value):
                ln = line(s)
                if ln.n or ln.links:
                    raw.append((field, ln))
    counts, per_line = _counts([x[1] for x in raw])
    return [(f, ln.n + ln.links, symbols(f, ln, counts, per_line)) for f, ln in raw]


def _counts(lines: list[Line]) -> tuple[Counter, Counter]:
    """Occurrences of the record's words, and the number of its lines that have them."""
    every: Counter = Counter()
    per: Counter = Counter()
    for ln in lines:
        every.update(ln.counted)
        per.update(set(ln.counted))
    return every, per


# ---------------------------------------------------------------- labelled lines


def labelled_records(seed: int = 11, size: int = 3000) -> list[list[tuple[str, tuple[int, ...]]]]:
    """Sequences of (state, symbols): prose, link lists, tag lists and menus in our own words."""
    r = random.Random(seed)
    things = "curtain rods,pool tables,used trucks,tooth whitening,fax paper,tent rental,gold coins,cigar box,fence paint,visa help,моющие средства,окна недорого,schuhe günstig,barco alquiler,办公家具,椅子批发,中古 時計".split(",")
    nouns = "evening concert neighbour kitchen corner window letter picture summer river story garden band street ticket singer".split()
    verbs = "liked remembered visited missed heard found enjoyed played followed described".split()
    openers = "I,We,She,He,They,My brother,The singer,Nobody,Our friends".split(",")
    others = [
        "Der Abend war schön und wir blieben lange.", "La soirée était belle et nous avons chanté.",
        "La noche fue larga y el pan era muy bueno.", "Вечер был тихий, и мы долго слушали музыку.",
        "这个晚上很安静，我们去了河边。", "この店はとても静かで、また行きたい。", "O pão da manhã é bom e não é caro.",
        "la la la la la, la la la, what a chorus", "no no no no no", "ha ha ha ha", "wow", "nice photos", "thanks!",
        "my favorites: Green Parrots, The Late Trains, Sad Pilots, Blue Doors, Old Engines",
        "Songs: Hello Again, Night Bus, The Long Road, Paper Sky, Winter Moon", "re: the concert", "a correction",
        "who is The Late Trains?", "question about the Green Door", "see my page",
    ]

    def link(k: int) -> str:
        return f"http://{r.choice(['site', 'buynow', 'cheaper'])}{k}.example/{r.choice(['', 'x.html', '?p=4'])}"

    def listing() -> str:
        """Lists that readers write: songs, bands, things."""
        kind = r.randrange(4)
        if kind == 0:
            return f"For {r.choice(nouns)}, {r.choice(nouns)}, etc., ask the {r.choice(nouns)}."
        names = [f"{r.choice(['The Late', 'Sad', 'Green', 'Old', 'Winter', 'The Little', 'Happy'])} {r.choice(['Pilots', 'Parrots', 'Trains', 'Doors', 'Engines', 'Rivers', 'Songs'])}" for _ in range(r.randint(3, 9))]
        if kind == 1:
            names = [r.choice(["Notes on {}", "Why {} matters", "Walking by the {}", "A night at the {}", "quiet {}"]).format(r.choice(nouns)) for _ in names]
        return r.choice(["my favorites: ", "setlist: ", "played tonight: ", ""]) + ", ".join(names)

    def prose() -> str:
        if r.random() < 0.12:
            return listing()
        if r.random() < 0.4:
            return r.choice(others)
        s = f"{r.choice(openers)} {r.choice(verbs)} the {r.choice(nouns)} and the {r.choice(nouns)} that was in the {r.choice(nouns)}."
        if r.random() < 0.12:
            s = f"I wrote more about it at {link(1)} last {r.choice(nouns)} and you can read it there."
        if r.random() < 0.1:
            s = r.choice(["there are two good pages about it: ", "see ", "two pages: "]) + f'<a href="{link(2)}">here</a> and <a href="{link(3)}">here</a>.'
        return s

    def again() -> list[str]:
        """Lines that differ in a word or two, as people write who repeat themselves."""
        shape = r.choice(
            ["We walked past the {0} and nobody had seen the {1}.", "is the {0} open on sundays?", "my {0} and my {1} are still waiting...", "I would rather have the {0}, thank you!", "Where did you find that {0}?", "no more {0}",
             "the {0} of my aunt was better, really.", "Please bring back the {0}! We miss it.", "“The {0} is late,” he said.", "{0} came first, then the {1}, and then it rained.", "I have a {0}, you have a {1}.", "not a word about the {0}…",
             "Wir haben den {0} gesehen, aber nicht den {1}.", "Warum ist der {0} so teuer?", "Mein {0} hat um 9 Uhr noch geschlafen, usw.", "Am Montag kam der {0} zu spät!",
             "J’ai perdu mon {0} dans la {1}.", "Où est le {0} ? Il est parti.", "« Pas de {0} », a dit ma mère.", "Quelle {0} !", "El {0} de mi hermana no funciona.", "¿Dónde está el {0}?", "¡Otra vez el {0}!", "No me gusta el {0}, pero sí el {1}.",
             "O {0} do meu pai é velho.", "Quem comprou o {0}?", "Мы видели {0} и не видели {1}.", "Где мой {0}? Он был здесь.", "«Нет, {0} мой», — ответил он.", "Утром {0} был дома…", "我的{0}在哪里？", "他们没有{0}。", "私の{0}はどこですか。", "この{0}が好きだ。",
             "Dr. {1} wrote about {0}, {1}, etc. in May.", "Nobody asked for the {0}: we did.", "Two {0}s, one {1}, no ticket.", "does the {0} still work?"])
        return [shape.format(r.choice(nouns), r.choice(nouns)) for _ in range(r.randint(2, 5))]

    def few() -> list[str]:
        return r.sample(things, r.choice([1, 2, 3]))

    def links() -> str:
        f, n = few(), r.randint(3, 12)
        kind = r.randrange(5)
        if kind == 0:
            return " ".join(f"[url={link(i)}]{r.choice(f)}[/url]" for i in range(n))
        if kind == 1:
            return r.choice(["<br>", "\n", " "]).join(f'<a href="{link(i)}">{r.choice(f)}</a>' for i in range(n))
        if kind == 2:
            return "; ".join(f"{r.choice(f)} (shop{i}.example.net)" for i in range(n))
        if kind == 3:
            return " , ".join(link(i) for i in range(n))
        return " ".join(f"{link(i)} {r.choice(f)}" for i in range(n))

    def tags() -> str:
        f, n = few(), r.choice([r.randint(3, 8), r.randint(4, 24)])
        kind = r.randrange(4)
        if kind == 0:
            return " ".join("#" + r.choice(f).replace(" ", r.choice(["", "_"])) for _ in range(n))
        if kind == 1:
            return " ".join(f"[{r.choice(f)}]" for _ in range(n))
        if kind == 2:
            return " ".join(r.choice(f) for _ in range(n))
        words = [w for x in f for w in x.split()]
        return " ".join(r.choice([*words, *words, *sorted(SALES_WORDS)]) for _ in range(n + 6))

    def menu() -> str:
        f, n = few(), r.randint(5, 20)
        kind = r.randrange(2)
        if kind == 0:
            sep = r.choice([" | ", " / ", "; ", ", ", " - "])
            return sep.join(r.choice(f) + r.choice(["", "", " online", " best", " 2007"]) for _ in range(n))
        return " ".join(f"{r.choice(f)} {r.choice(['in', 'near', 'for', '@'])} {r.choice(['Northtown', 'Lakeside', 'Old Port', 'West Hill', 'Mill Bridge', 'Bergen', 'Saint Mary'])}." for _ in range(n))

    makers = {"prose": prose, "links": links, "tags": tags, "menu": menu}
    records = []
    for _ in range(size):
        plan: list[tuple[str, str]] = [("name", "prose"), ("subject", "prose")]
        plan += [("text", "prose")] * r.randint(0, 4)
        same = r.random() < 0.25  # readers repeat themselves, too
        if r.random() < 0.45:
            kind = r.choice(STATES[1:])
            where = r.random()
            if where < 0.3:
                plan[0] = ("name", "tags")
            elif where < 0.6:
                plan[1] = ("subject", r.choice(["tags", "menu"]))
            else:
                plan.append(("text", kind))
        values: dict[str, list[tuple[str, str]]] = {"name": [], "subject": [], "text": []}
        for field, state in plan:
            if same and field == "text" and state == "prose":
                values[field] += [(state, m) for m in again()]
                continue
            made = makers[state]() if field == "text" or state != "prose" else r.choice(
                ["anna", "old friend", "wow", "re: the picture", "nice photos", "karl", "Karl Anders", "who is The Late Trains?", "your review of Sad Pilots",
                 "question about the Green Door", "a question about the North Harbor Hall", "question about the Low Bridge Chapel", "anna (anna@oldpost.example.org)", "karl 2 555 0188", "karl two five five five zero one eight eight", "vraiment belle soirée"])
            if r.random() < 0.1:
                made = r.choice([str.upper, str.title])(made)
            values[field].append((state, made))
        raw = []
        for field in ("name", "subject", "text"):
            for state, made in values[field]:
                for part in lines_of(made):
                    ln = line(part)
                    if ln.n or ln.links:
                        raw.append((state, field, ln))
        counts, per_line = _counts([x[2] for x in raw])
        records.append([(state, symbols(f, ln, counts, per_line)) for state, f, ln in raw])
    return records


class LineModel:
    """Start, transition and emission tables in logarithms, and Viterbi decoding."""

    def __init__(self, records: list[list[tuple[str, tuple[int, ...]]]]) -> None:
        k = len(STATES)
        start, step = np.ones(k), np.ones((k, k))
        emit = [np.ones((k, size)) for size in FEATURE_SIZES]
        for seq in records:
            last = None
            for state, sym in seq:
                s = STATES.index(state)
                if last is None:
                    start[s] += 1
                else:
                    step[last, s] += 1
                for e, v in zip(emit, sym, strict=True):
                    e[s, v] += 1
                last = s
        self.start = np.log(start / start.sum())
        self.step = np.log(step / step.sum(1, keepdims=True))
        self.emit = [np.log(e / e.sum(1, keepdims=True)) for e in emit]
        self.starts, self.steps = [float(x) for x in self.start], [[float(x) for x in row] for row in self.step]
        self.seen: dict[tuple[int, ...], tuple[float, ...]] = {}

    def scores(self, sym: tuple[int, ...]) -> tuple[float, ...]:
        got = self.seen.get(sym)
        if got is None:
            got = self.seen[sym] = tuple(float(x) for x in sum(e[:, v] for e, v in zip(self.emit, sym, strict=True)))
        return got

    def decode(self, seq: list[tuple[int, ...]]) -> list[int]:
        """The likeliest states; plain numbers, as arrays of four states cost more than they save."""
        if not seq:
            return []
        step, k = self.steps, len(STATES)
        v = [a + b for a, b in zip(self.starts, self.scores(seq[0]), strict=True)]
        back = []
        for sym in seq[1:]:
            emit = self.scores(sym)
            new, came = [], []
            for s in range(k):
                best, at = v[0] + step[0][s], 0
                for p in range(1, k):
                    x = v[p] + step[p][s]
                    if x > best:
                        best, at = x, p
                new.append(best + emit[s])
                came.append(at)
            v = new
            back.append(came)
        path = [v.index(max(v))]
        for came in reversed(back):
            path.append(came[path[-1]])
        return path[::-1]


_model: list[LineModel] = []


def line_model() -> LineModel:
    if not _model:
        _model.append(LineModel(labelled_records()))
    return _model[0]


def judge(name: str | None, subject: str | None, text: str | None, model: LineModel | None = None) -> tuple[bool, float, str]:
    """(flagged, share of words outside prose, labels of the lines)."""
    seen = observe(name, subject, text)
    if not seen:
        return False, 0.0, ""
    path = (model or line_model()).decode([s for _, _, s in seen])
    total: Counter = Counter()
    other: Counter = Counter()
    run: Counter = Counter()
    longest = 0
    for (field, n, _), s in zip(seen, path, strict=True):
        total[field] += n
        other[field] += n if s else 0
        run[field] = run[field] + n if s else 0
        longest = max(longest, run[field])
    flagged = any(other[f] >= FEW_WORDS and other[f] >= SHARE * total[f] for f in total) or longest >= CARRIED
    return flagged, sum(other.values()) / sum(total.values()), " ".join(STATES[s] for s in path)


def judged(comments: DataFrame) -> DataFrame:
    """(comment_id, stuffed, other_share, labels), one row per comment."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = line_model()
        for pdf in batches:
            got = [judge(n, s, t, model) for n, s, t in zip(pdf["name"], pdf["subject"], pdf["text"], strict=True)]
            yield pd.DataFrame(
                {"comment_id": pdf["comment_id"], "stuffed": [g[0] for g in got], "other_share": [g[1] for g in got], "labels": [g[2] for g in got]}
            )

    rows = spread(comments.select("comment_id", "name", "subject", "text"), "comment_id")
    return rows.mapInPandas(run, "comment_id bigint, stuffed boolean, other_share double, labels string")


def found(comments: DataFrame) -> DataFrame:
    return judged(comments).where("stuffed").select("comment_id")
