"""Text expressions.  Native unless said otherwise."""

from __future__ import annotations

import html as _html
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_tags(s: Column) -> Column:
    return F.regexp_replace(s, r"<[^>]+>", " ")


def squeeze(s: Column) -> Column:
    return F.trim(F.regexp_replace(s, r"\s+", " "))


def visible(s: Column) -> Column:
    """Markup removed, white space collapsed; '' for null."""
    return squeeze(strip_tags(F.coalesce(s, F.lit(""))))


def tidy(s: Column) -> Column:
    """White space collapsed, none left before punctuation."""
    return F.regexp_replace(squeeze(s), r"\s+([,.;:!?])(\s|$|[\"”’)])", "$1$2")


def lower_shouting(s: Column) -> Column:
    """Segments between ' — ' in lower case where more than 60 % of the letters are capitals."""

    def one(x: Column) -> Column:
        capitals = F.length(F.regexp_replace(x, r"[^\p{Lu}]", ""))
        letters = F.length(F.regexp_replace(x, r"[^\p{L}]", ""))
        return F.when(capitals > 0.6 * F.greatest(letters, F.lit(1)), F.lower(x)).otherwise(x)

    return F.array_join(F.transform(F.split(s, " — "), one), " — ")


def clip(s: Column, n: int) -> Column:
    """At most n characters, cut at a word and marked with an ellipsis."""
    t = tidy(s)
    head = F.substring(t, 1, n - 1)
    cut = F.when(F.instr(head, " ") > 0, F.regexp_replace(head, r" [^ ]*$", "")).otherwise(head)
    return F.when(F.length(t) <= n, t).otherwise(F.concat(F.regexp_replace(cut, r"[ ,;:—-]+$", ""), F.lit("…")))


def first_sentences(s: Column, n: int) -> Column:
    """Whole sentences from the start until there are about n characters."""
    parts = F.split(s, r"(?<=[.!?…\"”])\s+")
    return F.aggregate(
        parts, F.lit(""),
        lambda acc, x: F.when((acc != "") & (F.length(acc) >= n), acc).otherwise(F.trim(F.concat(acc, F.lit(" "), x))),
    )


def join_sentences(*parts: Column) -> Column:
    """Parts as sentences, without doubled stops; empty parts are left out."""
    kept = F.filter(F.array(*[tidy(F.coalesce(p, F.lit(""))) for p in parts]), lambda x: x != "")
    return F.aggregate(
        kept, F.lit(""),
        lambda acc, x: F.when(acc == "", x).otherwise(
            F.concat(acc, F.when(acc.rlike(r"[.!?…]$"), F.lit(" ")).otherwise(F.lit(". ")), x)
        ),
    )


# Shapes of contact data.
EMAIL = r"[A-Za-z0-9_.+-]+@[A-Za-z0-9_-]+(\.[A-Za-z0-9_-]+)*\.[A-Za-z]{2,}"
PHONE = r"\(?\b[0-9]{3}\)?[ .-]*[0-9]{3}[ .-][0-9]{4}\b"


def scrub(s: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(s, EMAIL, "[email removed]"), PHONE, "[phone removed]")


def words(s: Column) -> Column:
    """Number of words of a text; 0 for null or blank."""
    t = squeeze(F.coalesce(s, F.lit("")))
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, " ")))


def script_text(s: Column) -> Column:
    """JSON that may stand inside a script element."""
    return F.replace(F.replace(s, F.lit("<"), F.lit("\\u003c")), F.lit(">"), F.lit("\\u003e"))


def escape_html(s: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        s = F.replace(s, F.lit(a), F.lit(b))
    return s


def _unescape(s: pd.Series) -> pd.Series:
    return s.map(lambda x: x if x is None or "&" not in x else _html.unescape(x), na_action="ignore")


def unescape(c: Column) -> Column:
    """Character references as characters.  Arrow UDF: the table of names has no native form."""
    return F.pandas_udf(_unescape, "string")(c)


def fold(s: str) -> str:
    return unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode()


def _slugify(s: pd.Series) -> pd.Series:
    return s.map(lambda x: re.sub(r"[^a-z0-9]+", "-", fold(x).lower()).strip("-"), na_action="ignore")


def slugify(c: Column) -> Column:
    """Lower-case ASCII words joined by hyphens.  Arrow UDF: compatibility decomposition has no native form."""
    return F.pandas_udf(_slugify, "string")(c)
