"""Problem 2: text that was decoded with the wrong character encoding.

1. Clauses (pieces of fields between tags, line ends and sentence ends) that hold
   non-ASCII characters are counted over the whole corpus.
2. Near-twins are clauses that are equal once their non-ASCII characters are stripped
   and digits are all read as one.  In each group the most frequent unsuspicious clause
   is the clean one; every other clause of the group is aligned with it character by
   character, the ASCII characters being the anchors, which gives pairs of wrong and
   right character runs.
3. The pairs vote for the transformations that lead from the right to the wrong run:
   bytes of one encoding read as another, once or several times.  Transformations with
   enough votes are learned.
4. A clause whose differing runs are explained by learned transformations is garbled
   (evidence ``twin``).  The learned transformations are then undone on the words of all
   remaining clauses (evidence ``learned``): where the bytes of an encoding are strict
   (UTF-8 and the double-byte ones) the word is garbled; where each character stands for
   another one, it is if the result is a far more frequent word among the different
   clauses of the corpus.  Replacement and control characters are garbled in any case
   (``lost``).  Strict encodings that no pair voted for are tried last (``bytes``).

Only non-ASCII runs are ever restored: a clause keeps every ASCII character of its own,
digits and spelling included, and takes from its twin nothing but the aligned runs.

Defined results: null and empty fields are no case; numeric and named references count
as the characters they stand for, and stay as they are outside restored runs; repeated
rows are each judged; whole texts are read.  What cannot be restored keeps its wrong
characters.
"""

from __future__ import annotations

import html as _html
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from restitch.llm.io import fanned, field_rows, salted_join
from restitch.session import spread, written

#: Pairs of different runs that must vote for a transformation.
VOTES = 2
#: A word of a one-to-one transformation needs so many times the frequency of the garbled word, and so many occurrences.
FACTOR, LEAST = 4, 3
#: A twin needs so many times the frequency of a clause that differs by one-to-one transformations only.
TWIN_FACTOR = 2
#: A transformation is also learned from so many different words of at least so many characters that it turns into frequent words.
LONG, LONG_VOTES = 5, 5
#: ASCII letters of a clause that make a twin by its stripped text credible.
ANCHORS = 8

# Encodings whose bytes are taken for one another.
UTF8_READ_AS = ("cp1252", "latin_1", "cp1250", "cp1251", "mac_roman", "cp437", "cp850", "iso8859_2", "cp1254", "koi8_r", "cp866", "cp932", "gbk")
WIDE_READ_AS = tuple((wide, narrow) for wide in ("cp932", "gbk", "euc_jp", "big5", "euc_kr") for narrow in ("cp1252", "latin_1", "mac_roman"))
ONE_BYTE = (
    ("cp1252", "mac_roman"), ("mac_roman", "cp1252"), ("mac_roman", "latin_1"), ("cp1251", "cp1252"), ("cp1251", "latin_1"), ("koi8_r", "cp1251"), ("cp1251", "koi8_r"),
    ("koi8_r", "cp1252"), ("koi8_r", "latin_1"), ("cp866", "cp1251"), ("cp1251", "cp866"), ("cp866", "cp1252"), ("cp437", "cp1252"), ("cp437", "latin_1"), ("cp850", "cp1252"), ("cp850", "latin_1"),
    ("cp1252", "cp437"), ("cp1252", "cp850"), ("cp1252", "cp1250"), ("cp1250", "cp1252"), ("cp1252", "cp1251"), ("cp1252", "cp1253"), ("cp1253", "cp1252"), ("cp1253", "latin_1"), ("iso8859_7", "latin_1"), ("iso8859_7", "cp1252"),
    ("iso8859_5", "cp1252"), ("mac_cyrillic", "cp1251"), ("cp1251", "mac_roman"), ("cp1256", "cp1252"), ("cp874", "cp1252"),
)
_TAG = re.compile(r"<[^<>]*>")
_CLAUSE = re.compile(r"(?<=[.!?…。！？])\s+|[\r\n\x0b\f]+|(?<=[。！？])|\x00+")
_REFERENCE = re.compile(r"&(?:#\d{2,6}|#[xX][0-9A-Fa-f]{2,5}|[A-Za-z]{2,8}\d?);")
_OTHER = re.compile(r"[^\x00-\x7f]+")
_WORD = re.compile(r"[^\s]*[^\x00-\x7f\s][^\s]*|[^\s]*[\x80-\x9f\xa0][^\s]*")
_ASCII_EDGE = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
CONTROL = re.compile("[\x80-\x9f]")


def with_characters(text: str) -> str:
    """Character references of non-ASCII characters as those characters; markup stays escaped."""
    if "&" not in text:
        return text

    def one(m: re.Match) -> str:
        c = _html.unescape(m.group())
        return c if len(c) == 1 and ord(c) > 127 else m.group()

    return _REFERENCE.sub(one, text)


def clauses(text: str) -> list[str]:
    """The pieces of a field that hold non-ASCII characters."""
    shown = _TAG.sub("\x00", with_characters(text))
    return [c.strip(" \t") for c in _CLAUSE.split(shown) if c and not c.isascii()]


def words(clause: str) -> list[str]:
    """Words with non-ASCII characters, without ASCII punctuation at their ends."""
    out = []
    for w in re.split(r"[ \t]+", clause):
        w = w.strip(_ASCII_EDGE)
        if w and not w.isascii():
            out.append(w)
    return out


def skeleton(clause: str) -> str:
    return re.sub(r"\d", "0", _OTHER.sub("", clause))


def _to_bytes(s: str, enc: str) -> bytes | None:
    """Bytes of a text that was read as ``enc``; bytes that the encoding leaves out were kept as control characters."""
    try:
        return s.encode(enc)
    except UnicodeEncodeError:
        if enc not in ("cp1252", "cp1250", "cp1254", "cp1253"):
            return None
    out = bytearray()
    for c in s:
        try:
            out += c.encode(enc)
        except UnicodeEncodeError:
            if "\x80" <= c <= "\x9f":
                out.append(ord(c))
            else:
                return None
    return bytes(out)


def _plausible(s: str) -> bool:
    """Only characters of scripts in use."""
    for c in s:
        o = ord(c)
        if not (
            o < 0x80 or 0xA0 <= o <= 0x17F or 0x386 <= o <= 0x3CE or 0x401 <= o <= 0x45F or 0x5D0 <= o <= 0x5EA or 0x600 <= o <= 0x6FF or 0x900 <= o <= 0x97F or 0xE00 <= o <= 0xE5B
            or 0x2010 <= o <= 0x203A or o in (0x20AC, 0x2122, 0x2116, 0x2212) or 0x3000 <= o <= 0x30FF or 0x4E00 <= o <= 0x9FFF or 0xAC00 <= o <= 0xD7A3 or 0xFF00 <= o <= 0xFFEF
        ):
            return False
    return True


def _half() -> frozenset[str]:
    """Characters of the upper halves of the one-byte encodings, which a text read wrongly twice passes through."""
    out: set[str] = {chr(i) for i in range(0x80, 0xA0)}
    for enc in UTF8_READ_AS[:11]:
        for i in range(128, 256):
            out.update(bytes([i]).decode(enc, "ignore"))
    return frozenset(out)


HALF = _half()


def undo_utf8(s: str, enc: str) -> str | None:
    """The text whose UTF-8 bytes were read as ``enc``, None when they were not."""
    b = _to_bytes(s, enc)
    if b is None:
        return None
    try:
        r = b.decode("utf-8")
    except UnicodeDecodeError:
        return None
    return r if r != s and (_plausible(r) or all(ord(c) < 128 or c in HALF for c in r)) else None


def undo_wide(s: str, wide: str, narrow: str) -> str | None:
    b = _to_bytes(s, narrow)
    if b is None:
        return None
    try:
        r = b.decode(wide)
    except UnicodeDecodeError:
        return None
    dense = sum(1 for c in r if "぀" <= c <= "ヿ" or "一" <= c <= "鿿" or "가" <= c <= "힣" or "　" <= c <= "〿" or "＀" <= c <= "￯")
    return r if dense >= 2 and dense == sum(1 for c in r if ord(c) > 127) and _plausible(r) else None


def undo_one(s: str, right: str, wrong: str) -> str | None:
    b = _to_bytes(s, wrong)
    if b is None:
        return None
    try:
        r = b.decode(right)
    except UnicodeDecodeError:
        return None
    return r if r != s else None


def runs(s: str) -> list[str]:
    return _OTHER.findall(s)


STRICT = tuple([f"utf8>{x}" for x in UTF8_READ_AS] + [f"{a}>>{b}" for a, b in WIDE_READ_AS])
WEAK = tuple(f"{a}>{b}" for a, b in ONE_BYTE)


def names() -> list[str]:
    return [*STRICT, *WEAK]


def undo(s: str, name: str) -> str | None:
    if ">>" in name:
        return undo_wide(s, *name.split(">>"))
    right, wrong = name.split(">")
    return undo_utf8(s, wrong) if right == "utf8" else undo_one(s, right, wrong)


def chain(s: str, name: str) -> Iterator[str]:
    """What undoing a transformation once, twice and so on gives, until it cannot be undone or comes back."""
    seen = {s}
    now: str | None = s
    while (now := undo(now, name)) is not None and now not in seen:
        seen.add(now)
        yield now


def explained(wrong: str, right: str) -> list[str]:
    """Names of the transformations that turn the right run into the wrong one, applied once or several times."""
    return [name for name in names() if right in chain(wrong, name)]


def lost(s: str) -> bool:
    """Characters that no correct text has: replacement and control characters."""
    return "�" in s or CONTROL.search(s) is not None


def certain(word: str, order: tuple[str, ...] | list[str]) -> tuple[str, str] | None:
    """(repaired word, first transformation undone) when the word is garbled beyond doubt; '' when it cannot be repaired."""
    now, first = word, ""
    seen = {word}
    while (step := _certain_once(now, order)) is not None and step[0] not in seen:
        now, name = step
        first = first or name
        seen.add(now)
    if first and _plausible(now):
        return now, first
    return ("", "lost") if lost(word) or (first and lost(now)) else None


_CYRILLIC_READ = ("cp1251", "koi8_r", "cp866", "mac_roman", "cp932", "gbk")


def _surely(wrong: str, right: str, cyrillic: bool) -> bool:
    """Two letters of a one-byte reading may be a word of their own: they are certain where more than a pair shrinks or a script leaves."""
    return not cyrillic or len(wrong) - len(right) >= 2 or all(not 0x400 <= ord(c) <= 0x4FF for c in right)


def _certain_once(word: str, order: tuple[str, ...] | list[str]) -> tuple[str, str] | None:
    for name in order:
        if not name.startswith("utf8>"):
            continue
        cyrillic = name[5:] in _CYRILLIC_READ
        r = undo(word, name)
        if r is not None and (len(runs(word)) > 1 or _surely(word, r, cyrillic)):
            return r, name
        parts = _OTHER.split(word)
        got = [undo(x, name) if len(x) > 1 else None for x in runs(word)]
        if any(g is not None and _surely(x, g, cyrillic) for g, x in zip(got, runs(word), strict=True)):
            out = parts[0]
            for x, g, p in zip(runs(word), got, parts[1:], strict=True):
                out += (x if g is None else g) + p
            return out, name
    for x in runs(word):
        if len(x) >= 4 and all("\x80" <= c <= "\xff" or c in "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ" for c in x) and sum("\xc0" <= c <= "\xff" for c in x) >= 3 or CONTROL.search(x):
            for name in order:
                if ">>" in name:
                    r = undo(word, name)
                    if r is not None:
                        return r, name
    return None


def suspicious(clause: str) -> bool:
    return any(certain(w, STRICT) is not None for w in words(clause))


def aligned(wrong: str, right: str, learned: frozenset[str] | set[str]) -> tuple[bool, bool, str] | None:
    """(garbled, beyond doubt, restored clause) of a clause and its clean twin; None where the runs do not align.

    The clause is garbled where every run that differs is one the learned transformations
    make of the twin's run, or a lost one; beyond doubt where one of them is strict or lost.
    The ASCII characters are all its own.
    """
    x, y = _aligned(wrong), _aligned(right)
    if len(x) != len(y):
        return None
    out, told, sure, ascii_ = [], 0, False, [c for c in wrong if ord(c) < 128]
    for k, (p, q) in enumerate(zip(x, y, strict=True)):
        run = p
        if p != q:
            how = [n for n in explained(p, q) if n in learned] if p else []
            if lost(p) or how:
                run, told = q, told + 1
                sure = sure or lost(p) or not all(n in WEAK for n in how)
            elif p and q:
                return False, False, wrong  # another text after all
        out.append(run)
        if k < len(ascii_):
            out.append(ascii_[k])
    return told > 0, sure, "".join(out)


# ---------------------------------------------------------------- plan


def fields_of(pages: DataFrame, comments: DataFrame) -> DataFrame:
    return field_rows(pages, "pages", "page_id", ["html"]).unionByName(field_rows(comments, "comments", "comment_id", ["text", "subject"])).where("rec_id is not null")


def clause_rows(pages: DataFrame, comments: DataFrame) -> DataFrame:
    """(tbl, rec_id, field, clause) of all clauses with non-ASCII characters, once per field."""
    fields = fields_of(pages, comments).where(F.col("text").rlike(r"[^\x00-\x7F]|&#?\w+;"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [
                (t, r, f, c)
                for t, r, f, x in zip(pdf["tbl"], pdf["rec_id"], pdf["field"], pdf["text"], strict=True)
                for c in dict.fromkeys(clauses(x))
            ]
            yield pd.DataFrame(out, columns=["tbl", "rec_id", "field", "clause"])

    return spread(fields, "rec_id").mapInPandas(run, "tbl string, rec_id bigint, field string, clause string")


def distinct_clauses(rows: DataFrame) -> DataFrame:
    """(clause, n, skel, anchors, suspect) of each different clause; counted with map-side combine, then spread for the Python stage."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sk = [skeleton(c) for c in pdf["clause"]]
            yield pd.DataFrame(
                {
                    "clause": pdf["clause"], "n": pdf["n"], "skel": sk,
                    "anchors": [sum(ch.isalpha() for ch in s) for s in sk], "suspect": [suspicious(c) for c in pdf["clause"]],
                }
            )

    counted = rows.groupBy("clause").agg(F.count(F.lit(1)).alias("n"))
    return fanned(counted, "clause").mapInPandas(run, "clause string, n bigint, skel string, anchors int, suspect boolean")


def twins(distinct: DataFrame) -> DataFrame:
    """(clause, n, clean, n_clean): each clause with the clean clause of its group; the groups are never paired among themselves.

    The clean clause is the least of an aggregate with map-side combine; clauses of a large
    group meet it in salted pieces.
    """
    usable = distinct.where(F.col("anchors") >= ANCHORS)
    clean = (
        usable.where("not suspect").groupBy("skel").agg(F.min(F.struct((-F.col("n")).alias("neg"), "clause")).alias("b"))
        .select("skel", F.col("b.clause").alias("clean"), (-F.col("b.neg")).alias("n_clean"))
    )
    return salted_join(usable.select("skel", "clause", "n"), clean, ["skel"], "clause").where("clause != clean").select("clause", "n", "clean", "n_clean")


def learned_names(pairs: DataFrame) -> list[str]:
    """Names of the transformations that enough different aligned runs vote for; at most as many rows as there are names."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            seen: set[tuple[str, str]] = set()
            for a, b in zip(pdf["clause"], pdf["clean"], strict=True):
                x, y = _aligned(a), _aligned(b)
                if len(x) == len(y):
                    seen.update((p, q) for p, q in zip(x, y, strict=True) if p != q and p and q)
            yield pd.DataFrame(sorted(seen), columns=["wrong", "right"])

    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([(n,) for p, q in zip(pdf["wrong"], pdf["right"], strict=True) for n in explained(p, q)], columns=["name"])

    runs_ = pairs.mapInPandas(run, "wrong string, right string").distinct()
    votes = runs_.mapInPandas(vote, "name string").groupBy("name").count().where(F.col("count") >= VOTES)
    return sorted(r["name"] for r in votes.collect())


def _aligned(s: str) -> list[str]:
    """The non-ASCII run before each ASCII character and at the end."""
    out, cur = [], ""
    for c in s:
        if ord(c) < 128:
            out.append(cur)
            cur = ""
        else:
            cur += c
    out.append(cur)
    return out


def twin_verdicts(pairs: DataFrame, learned: list[str]) -> DataFrame:
    """(clause, repaired) of the clauses that their twin shows to be garbled."""
    known = frozenset(learned)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for c, n, clean, m in zip(pdf["clause"], pdf["n"], pdf["clean"], pdf["n_clean"], strict=True):
                got = aligned(c, clean, known)
                # where characters stand one for another, which of the two is wrong is told by their frequencies
                if got is not None and got[0] and (got[1] or (m >= LEAST and m >= TWIN_FACTOR * n)):
                    out.append((c, got[2]))
            yield pd.DataFrame(out, columns=["clause", "repaired"])

    return pairs.mapInPandas(run, "clause string, repaired string")


#: Evidence for a garbled field, the strongest first.
EVIDENCE = ("twin", "learned", "lost", "bytes")


def clause_words(distinct: DataFrame) -> DataFrame:
    """(clause, n, word), once per word of a clause."""

    def take(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [(c, int(n), w) for c, n in zip(pdf["clause"], pdf["n"], strict=True) for w in dict.fromkeys(words(c))]
            yield pd.DataFrame(out, columns=["clause", "n", "word"])

    return fanned(distinct.select("clause", "n"), "clause").mapInPandas(take, "clause string, n bigint, word string")


def word_verdicts(clause_word: DataFrame, learned: list[str]) -> DataFrame:
    """(word, repaired, name, rank) of every garbled word; repaired is '' where nothing is known, name is that of a one-to-one transformation.

    A word is frequent by the different clauses that hold it, among which copies count once, or by
    all fields, among which one short clause may be very common; marks and single letters by both.
    """
    vocabulary = clause_word.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("n_all"))
    known = set(learned)
    order = sorted(STRICT, key=lambda n: n not in known)

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for w, n, a in zip(pdf["word"], pdf["n"], pdf["n_all"], strict=True):
                r = certain(w, order)
                if r is not None:
                    how = "lost" if r[1] == "lost" else "learned" if r[1] in known else "bytes"
                    out.append((w, int(n), int(a), r[0], None, EVIDENCE.index(how)))
                if r is None or r[0] == "" or (">>" in r[1] and r[1] not in known):
                    out += [(w, int(n), int(a), x, k, 1) for k in WEAK if (x := undo(w, k))]
            yield pd.DataFrame(out, columns=["word", "n", "n_all", "repaired", "name", "rank"])

    candidates = fanned(vocabulary, "word").mapInPandas(judge, "word string, n bigint, n_all bigint, repaired string, name string, rank int")
    sure = candidates.where("name is null").select("word", "repaired", F.lit(0).cast("bigint").alias("m"), F.lit("").alias("name"), "rank")
    by_clauses = (F.col("m") >= LEAST) & (F.col("m") >= FACTOR * F.col("n"))
    by_fields = (F.col("m_all") >= LEAST) & (F.col("m_all") >= FACTOR * F.col("n_all"))
    maybe = (
        candidates.where("name is not null")
        .join(vocabulary.select(F.col("word").alias("repaired"), F.col("n").alias("m"), F.col("n_all").alias("m_all")), "repaired")
        .where(F.when(F.col("word").rlike(r"(\p{L}.*){2}"), by_clauses | by_fields).otherwise(by_clauses & by_fields))
        .select("word", "repaired", "m", "name", "rank")
    )
    # a transformation without twins, as for texts with no ASCII characters to align, is learned from long words
    voted = maybe.where(F.length("word") >= LONG).groupBy("name").agg(F.count_distinct("word").alias("v")).where(F.col("v") >= LONG_VOTES).select("name")
    maybe = maybe.join(voted, "name", "left_semi").unionByName(maybe.where(F.col("name").isin(learned or [""])))
    best = F.max(F.struct("m", "repaired", "name"))
    return (
        sure.unionByName(maybe).groupBy("word").agg(best.alias("b"), F.min("rank").alias("rank"))
        .select("word", F.col("b.repaired").alias("repaired"), F.col("b.name").alias("name"), "rank")
    )


def mended(clause: str, fixes: dict[str, tuple[str, str, int]]) -> str:
    """The clause with its garbled words replaced in their places.

    Where some words of it come from a one-to-one transformation, its other words that only the
    bytes of an encoding without votes explain (rank 3) come from the same one.
    """
    by_name = Counter(name for _, name, _ in fixes.values() if name)
    out, at = [], 0
    for m in re.finditer(r"[^ \t]+", clause):
        w = m.group()
        core = w.strip(_ASCII_EDGE)
        new, name, rank = fixes.get(core, ("", "", 0)) if core else ("", "", 0)
        if by_name and not name and rank == EVIDENCE.index("bytes"):
            other = undo(core, min(by_name, key=lambda n: (-by_name[n], n)))
            new = other if other and _plausible(other) else new
        if new:
            a = m.start() + len(w) - len(w.lstrip(_ASCII_EDGE))
            out += [clause[at:a], new]
            at = a + len(core)
    return "".join([*out, clause[at:]])


class Garbled:
    """The stages of one corpus, each computed once."""

    def __init__(self, pages: DataFrame, comments: DataFrame) -> None:
        self.fields = fields_of(pages, comments)
        self.rows = written(clause_rows(pages, comments))
        self.distinct = written(distinct_clauses(self.rows))
        self.pairs = twins(self.distinct)
        self.learned = learned_names(self.pairs)
        self.clause_words = clause_words(self.distinct)
        self.words = word_verdicts(self.clause_words, self.learned)
        self.by_twin = twin_verdicts(self.pairs, self.learned)

    def bad_words(self) -> DataFrame:
        """(clause, word, repaired, name, rank) for each garbled word of a clause; a frequent word is met in salted pieces."""
        return salted_join(self.clause_words.drop("n"), self.words, ["word"], "clause")

    def bad_clauses(self) -> DataFrame:
        """(clause, rank): garbled clauses with the strongest evidence, a place of EVIDENCE."""
        return (
            self.bad_words().select("clause", "rank").unionByName(self.by_twin.select("clause", F.lit(0).alias("rank")))
            .groupBy("clause").agg(F.min("rank").alias("rank"))
        )

    def evidence(self) -> DataFrame:
        """(tbl, rec_id, field, evidence) of each garbled field; a clause on many pages is met in salted pieces."""
        hit = salted_join(self.rows, self.bad_clauses(), ["clause"], "rec_id").groupBy("tbl", "rec_id", "field").agg(F.min("rank").alias("rank"))
        how = F.element_at(F.array(*[F.lit(e) for e in EVIDENCE]), F.col("rank") + 1)
        return hit.select("tbl", "rec_id", "field", how.alias("evidence"))

    def found(self) -> DataFrame:
        return self.evidence().select("tbl", "rec_id", "field")

    def repairs(self) -> DataFrame:
        """(clause, repaired, rank): the runs taken from the clean twin, what is left by words."""

        @F.pandas_udf("string")
        def mend(clause: pd.Series, fixes: pd.Series) -> pd.Series:
            return pd.Series([mended(c, {f["word"]: (f["repaired"], f["name"], f["rank"]) for f in fx} if fx is not None else {}) for c, fx in zip(clause, fixes, strict=True)])

        # the words of one clause: bounded by the clause
        per = self.bad_words().groupBy("clause").agg(F.collect_list(F.struct("word", "repaired", "name", "rank")).alias("fixes"), F.min("rank").alias("rank"))
        both = per.join(self.by_twin, "clause", "full_outer")
        return both.select(
            "clause", F.coalesce("repaired", mend("clause", "fixes")).alias("repaired"), F.when(F.col("repaired").isNotNull(), F.lit(0)).otherwise(F.col("rank")).alias("rank")
        )


def found(pages: DataFrame, comments: DataFrame) -> DataFrame:
    """(tbl, rec_id, field) of each garbled field."""
    return Garbled(pages, comments).found()


def evidence_counts(pages: DataFrame, comments: DataFrame) -> DataFrame:
    """(tbl, field, evidence, n): how many fields are found by what."""
    return Garbled(pages, comments).evidence().groupBy("tbl", "field", "evidence").agg(F.count(F.lit(1)).alias("n"))


def _places(text: str) -> tuple[str, list[tuple[int, int]]]:
    """The text with references as characters, tags blanked, and the source span of each character."""
    out: list[str] = []
    spans: list[tuple[int, int]] = []
    at = 0
    for m in _REFERENCE.finditer(text):
        c = _html.unescape(m.group())
        if len(c) == 1 and ord(c) > 127:
            out += text[at : m.start()]
            spans += [(i, i + 1) for i in range(at, m.start())]
            out.append(c)
            spans.append(m.span())
            at = m.end()
    out += text[at:]
    spans += [(i, i + 1) for i in range(at, len(text))]
    shown = "".join(out)
    return _TAG.sub(lambda m: "\x00" * len(m.group()), shown), spans


def rewritten(text: str, fixes: dict[str, str]) -> str:
    """The field with its garbled clauses restored in their places; everything else stays byte for byte."""
    shown, spans = _places(text)
    out, done, at = [], 0, 0
    cuts = [m.span() for m in _CLAUSE.finditer(shown)] + [(len(shown), len(shown))]
    for lo, hi in cuts:
        piece = shown[at:lo]
        clause = piece.strip(" \t")
        new = fixes.get(clause)
        if new is not None and new != clause:
            a = at + len(piece) - len(piece.lstrip(" \t"))
            x, y = spans[a][0], spans[a + len(clause) - 1][1]
            out += [text[done:x], new]
            done = y
        at = hi
    return "".join([*out, text[done:]])


def restored(pages: DataFrame, comments: DataFrame) -> DataFrame:
    """(tbl, rec_id, field, evidence, text): the garbled fields with their clauses restored."""
    g = Garbled(pages, comments)
    # the clauses of one field: bounded by the field
    fixes = salted_join(g.rows, g.repairs(), ["clause"], "rec_id").groupBy("tbl", "rec_id", "field").agg(
        F.collect_list(F.struct("clause", "repaired")).alias("fixes"), F.min("rank").alias("rank")
    )

    @F.pandas_udf("string")
    def apply(text: pd.Series, fx: pd.Series) -> pd.Series:
        return pd.Series([rewritten(t, {f["clause"]: f["repaired"] for f in fs}) for t, fs in zip(text, fx, strict=True)])

    how = F.element_at(F.array(*[F.lit(e) for e in EVIDENCE]), F.col("rank") + 1)
    return g.fields.join(fixes, ["tbl", "rec_id", "field"]).select("tbl", "rec_id", "field", how.alias("evidence"), apply("text", "fixes").alias("text"))
