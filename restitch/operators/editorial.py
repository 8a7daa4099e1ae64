"""Texts and records of the published magazine: page texts, names, bylines, contributors, descriptions, galleries."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from restitch.functions.text import clip, join_sentences, lower_shouting, squeeze, strip_tags, tidy, unescape
from restitch.functions.urls import url_path
from restitch.operators.catalog import articles_once
from restitch.operators.mirror import IMG, resolve_path, unquoted
from restitch.session import spread

# Lines that are no text, profanity, words of bylines and what their holders did.
JUNK = (
    r"(?i)^(untitled document|click to enlarge( photos?)?|see previous( photos?| photo essays?)?|back to (intro|top|side [ab] song \d+)|go to side [ab] song \d+"
    r"|(next|previous|prev) movie|what to watch\W*|next|back|more)$"
)
SHOOT = r"(?i)\b(models?|stylists?|styling|hair|make-?up|wardrobe|photographer|assistant|clothing|clothes|location)\s*[:/]"
PAGER = r"(?i)^(<<|>>|«|»|\||next|back|prev(ious)?|page|top|more|\d|\s)+(\s*(page|top|photo|photos))?$"
PROFANE = r"(?i)\b(fuck\w*|shit\w*|bitch\w*|cunt\w*|cocks?|cocksuck\w*|dick|pussy|motherf\w*|asshole\w*|whore\w*|slut\w*)\b"
SNIPPET, NAME_MAX, HEAD_MAX, DESCRIPTION_MAX = 110, 90, 55, 160
ROLE_WORDS = "words text story interview written novella photo photos photographs photography pictures illustration illustrations illustrated drawings art artwork comic comics design edited".split()
DID = {"by": "wrote", "words": "wrote", "novella": "wrote a serial novella", "photos": "took photos", "photos and text": "took photos", "reports": "reported", "illustrations": "drew illustrations", "edited": "edited"}


# ---------------------------------------------------------------- page texts


def text_lines(html: Column) -> Column:
    """The lines of text of a page: block ends are line ends; navigation, pagers, credits of shoots and copyright lines are no text."""
    h = F.regexp_replace(html, r"(?is)<script\b.*?</script>|<style\b.*?</style>", " ")
    h = F.regexp_replace(h, r"(?i)<br\s*/?>|</p>|</td>|</div>|</h\d>", "\n")
    lines = F.transform(F.split(unescape(strip_tags(h)), "\n"), lambda x: tidy(F.regexp_replace(x, " ", " ")))
    letters = lambda x: F.length(F.regexp_replace(x, r"[^\p{L}]", ""))
    kept = F.filter(lines, lambda x: (letters(x) > 2) & ~x.rlike(JUNK) & ~x.contains("©") & ~x.rlike(SHOOT) & ~x.rlike(PAGER))
    return F.transform(kept, lower_shouting)


def joined_lines(lines: Column) -> Column:
    """Lines as running text: one that ends without a stop gets one, unless its last sentence is a long one that goes on."""

    def step(acc: Column, x: Column) -> Column:
        last = F.element_at(F.split(acc, r"\. "), -1)
        stop = F.when(~acc.rlike(r"[.!?…:;\"”’)]$") & (F.length(last) <= 60), ".").otherwise("")
        return F.when(acc == "", x).otherwise(F.concat(acc, stop, F.lit(" "), x))

    return F.aggregate(lines, F.lit(""), step)


def opening(text: Column, n: int = SNIPPET) -> Column:
    """Whole sentences from the start until there are about n characters; a stop may be followed by a closing quote."""
    parts = F.split(text, r"(?<=[.!?…\"”])\s+")
    return F.aggregate(parts, F.lit(""), lambda acc, x: F.when((acc != "") & (F.length(acc) >= n), acc).otherwise(F.trim(F.concat(acc, F.lit(" "), x))))


def page_texts(pages: DataFrame) -> DataFrame:
    """(page_id, n_lines, text, snippet, profane): the text of each page, its opening, and whether the clipped opening swears."""
    rows = pages.where("html is not null").select("page_id", text_lines(F.col("html")).alias("lines"))
    text = joined_lines(F.col("lines"))
    t = rows.select("page_id", F.size("lines").alias("n_lines"), text.alias("text"))
    t = t.withColumn("snippet", F.when(F.length("text") > 60, clip(opening(F.col("text")), DESCRIPTION_MAX)).otherwise(""))
    return t.withColumn("profane", F.col("snippet").rlike(PROFANE))


def clean_alt(alt: Column, own: Column, titles: Column) -> Column:
    """A picture's text fit for a description: watermarks, credits of covers and copyright out, and no leading title (of ``titles``) of another article."""
    parts = F.filter(F.split(alt, " — "), lambda x: (F.trim(x) != "") & ~x.rlike(r"(?i)cover photo|©|\bwww\."))
    other = (F.size(parts) > 1) & F.array_contains(titles, F.lower(F.trim(F.get(parts, F.lit(0))))) & (F.lower(F.trim(F.get(parts, F.lit(0)))) != F.lower(own))
    return lower_shouting(tidy(F.array_join(F.when(other, F.slice(parts, 2, 1000)).otherwise(parts), " — ")))


# ---------------------------------------------------------------- names


def menu_entries(frames: DataFrame) -> DataFrame:
    """(frame_id, issue, ts, pos, section, folder, title): the links of captured menus under the heading above them.

    Headings and links are read in one pass as tokens; the heading is carried forward within a menu.
    """
    token = r"(?is)(<h4[^>]*>.*?</h4>|<span class=\"submenu_title\"[^>]*>.*?</span>|<a\s[^>]*href=\"[^\"]*\"[^>]*>.*?</a>)"
    rows = frames.where("menu is not null").select("frame_id", "issue", "ts", F.posexplode(F.regexp_extract_all("menu", F.lit(token), F.lit(1))).alias("pos", "tok"))
    link = F.col("tok").rlike(r"(?i)^<a\s")
    w = Window.partitionBy("frame_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # one menu
    text = squeeze(strip_tags(F.col("tok")))
    section = F.last(F.when(~link, text), ignorenulls=True).over(w)
    return rows.withColumn("section", section).where(link).select(
        "frame_id", "issue", "ts", "pos", F.coalesce("section", F.lit("")).alias("section"), F.regexp_extract("tok", r'(?i)href="/issues/[^/"]+/([^/"]+)/', 1).alias("folder"), text.alias("title")
    )


def menu_titles(frames: DataFrame) -> DataFrame:
    """(issue, folder, title, section, pos): the first title and section that an issue's menus give an article, earliest capture first."""
    first = F.min(F.struct(F.coalesce("ts", F.lit("9")).alias("ts"), "frame_id", "pos", "title", "section"))
    return menu_entries(frames).where("folder != ''").groupBy("issue", "folder").agg(first.alias("m")).select("issue", "folder", "m.title", "m.section", "m.pos")


def display_names(articles: DataFrame, frames: DataFrame) -> DataFrame:
    """(id, name, section): an article's name as its menu shows it, unless that was cut short; of two spellings the one with fewer capitals."""
    a = articles_once(articles)
    m = menu_titles(frames).select("issue", "folder", F.col("title").alias("menu"), "section")
    menu, title = F.coalesce("menu", F.lit("")), F.coalesce("title", F.lit(""))
    plain = lambda c: F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}_]", "")
    capitals = lambda c: F.length(F.regexp_replace(c, r"[^\p{Lu}]", ""))
    name = (
        F.when((menu == "") | menu.rlike(r"(\.\.\.|…)$"), title).when(plain(menu) == plain(title), F.when(capitals(menu) <= capitals(title), menu).otherwise(title)).otherwise(menu)
    )
    return a.join(m, ["issue", "folder"], "left").select("id", F.regexp_replace(name, r"(?i)^(feature|fashion)\s+-\s+", "").alias("name"), "section")


def issue_records(articles: DataFrame, issues: DataFrame, frames: DataFrame) -> DataFrame:
    """(issue, n, description): the distinct names of an issue in the order of its menu, as one clipped sentence."""
    m = menu_titles(frames)
    names = display_names(articles, frames)
    a = articles_once(articles).select("id", "issue", "folder").where("issue is not null").join(names.select("id", "name"), "id")
    placed = a.join(m.select("issue", "folder", "pos"), ["issue", "folder"], "left").groupBy("issue", "name").agg(F.min(F.struct(F.coalesce("pos", F.lit(1 << 30)).alias("p"), "id")).alias("at"))
    g = placed.groupBy("issue").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(F.struct("at", "name"))).alias("a"))  # the articles of one issue
    label = issues.groupBy("issue").agg(F.min("name").alias("label"))
    text = F.concat(F.lit("issue "), F.col("issue").cast("string"), F.lit(", "), F.coalesce("label", F.lit("untitled")), F.lit(". in this issue: "), F.array_join(F.transform("a", lambda x: x["name"]), ", "), F.lit("."))
    return g.join(label, "issue", "left").select("issue", "n", clip(text, DESCRIPTION_MAX).alias("description"))


def packed_titles(articles: DataFrame, most: int = 66) -> DataFrame:
    """(issue, head, shown, n): the longest row of an issue's titles, in order of id, that fits a head of ``most`` characters."""
    a = articles_once(articles).where("issue is not null and title is not null")
    g = a.groupBy("issue").agg(F.transform(F.array_sort(F.collect_list(F.struct("id", "title"))), lambda x: x["title"]).alias("t"))  # the articles of one issue
    start = F.concat(F.lit("issue "), F.col("issue").cast("string"), F.lit(": "))
    init = F.struct(F.lit("").alias("s"), F.lit(0).alias("k"), F.lit(True).alias("go"))

    def step(acc: Column, x: Column) -> Column:
        more = F.when(acc["s"] == "", x).otherwise(F.concat(acc["s"], F.lit(", "), x))
        fits = acc["go"] & (F.length(F.concat(start, more, F.lit(" and more"))) <= most)
        return F.struct(F.when(fits, more).otherwise(acc["s"]).alias("s"), (acc["k"] + fits.cast("int")).alias("k"), fits.alias("go"))

    r = F.aggregate("t", init, step)
    return g.select("issue", r.alias("r"), F.size("t").alias("n"), start.alias("start")).select(
        "issue", F.concat("start", "r.s", F.when(F.col("r.k") < F.col("n"), " and more").otherwise("")).alias("head"), F.col("r.k").alias("shown"), "n"
    )


def path_label(path: Column) -> Column:
    """A readable name of a part page from its address alone."""
    p = F.lower(F.trim(path, F.lit("/")))
    song = p.rlike(r"^[ab][0-9]+$")
    return (
        F.when(p.rlike(r"^[0-9]+$"), F.concat(F.lit("page "), p)).when(p.rlike(r"^(page|index)[0-9]+(\.[a-z]+)?$"), F.concat(F.lit("page "), F.regexp_extract(p, r"([0-9]+)", 1)))
        .when(song, F.concat(F.lit("side "), F.substring(p, 1, 1), F.lit(", song "), F.regexp_extract(p, r"([0-9]+)", 1)))
        .when(p == "pos", "for").when(p == "neg", "against").when(p.rlike(r"^[a-z]$"), F.concat(F.lit("choice "), p))
        .when(p.rlike(r"^photo[0-9]+$"), F.concat(F.lit("photo "), F.regexp_extract(p, r"([0-9]+)", 1)))
        .otherwise(F.trim(F.regexp_replace(p, r"[^a-z0-9]+", " ")))
    )


def numbered_titles(pages: DataFrame, suffix: str = " | lampmag") -> DataFrame:
    """(page_id, title): titles of pages that are no copies, unique: a repeated one is numbered before the bar.

    Copies of another page's markup keep no title of their own and are left out.  Numbers follow the page
    id; a very common title is numbered in slices whose sizes are summed up first, so no task orders all of it.
    """
    from restitch.operators.pages import first_copies

    own = first_copies(pages).where("canonical is null").select("page_id")
    t = tidy(F.regexp_extract("html", r"(?is)<title>([^<]*)</title>", 1))
    rows = pages.where("html is not null").select("page_id", t.alias("t")).where("t != ''").join(own, "page_id", "left_semi")
    slices = 64
    piece = F.pmod(F.xxhash64("page_id"), F.lit(slices)).cast("int")
    sizes = rows.groupBy("t").agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("lo"), F.max("page_id").alias("hi"))
    # slices are ranges of the id, so that numbers follow it
    cut = F.when(F.col("hi") > F.col("lo"), ((F.col("page_id") - F.col("lo")) * F.lit(slices) / (F.col("hi") - F.col("lo") + 1)).cast("int")).otherwise(0)
    sliced = rows.join(sizes.where("n > 1"), "t").withColumn("slice", cut)
    counts = sliced.groupBy("t", "slice").agg(F.count(F.lit(1)).alias("k"))
    before = F.coalesce(F.sum("k").over(Window.partitionBy("t").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    nr = F.row_number().over(Window.partitionBy("t", "slice").orderBy("page_id"))
    many = sliced.withColumn("nr", nr).join(counts.select("t", "slice", before.alias("before")), ["t", "slice"]).select("page_id", "t", (F.col("nr") + F.col("before")).alias("k"))
    single = rows.join(sizes.where("n = 1").select("t"), "t", "left_semi").select("page_id", "t", F.lit(1).cast("bigint").alias("k"))
    number = F.when(F.col("k") > 1, F.concat(F.lit(" ("), F.col("k").cast("string"), F.lit(")"))).otherwise("")
    del piece
    return many.unionByName(single).select("page_id", F.concat("t", number, F.lit(suffix)).alias("title"))


# ---------------------------------------------------------------- bylines


def _tokens(segment: str) -> list[tuple[str, int, int]]:
    return [(m.group().lower(), m.start(), m.end()) for m in re.finditer(r"[A-Za-z][A-Za-z.'’\-]*|\d+|[:,&]", segment)]


_JOIN = {",", "and", "&"}
_NO_NAME = set("the a an way now all me you us".split())
_NO_CREDIT = set("provided courtesy clothes presented sponsored".split())


def byline(text: str, alias: dict[str, str] | None = None) -> list[tuple[str, str]]:
    """[(role, name)] of a byline such as 'words by A B — photos: C D and E F'.

    A small state machine over the words of each segment: role words joined by commas or 'and' that end
    in 'by' or a colon open a credit, a bare 'by' does so at a segment's start or with a colon; names up
    to the next opening follow.  A name has at most four words, no digits, and no word of a title first.
    """
    alias = alias or {}
    out: list[tuple[str, str]] = []
    for segment in re.split(r"\s+[—|;]\s+", text or ""):
        toks = _tokens(segment)
        opens: list[tuple[int, int, str]] = []  # (first token, first token of the names, role)
        i = 0
        while i < len(toks):
            k = i
            while k < len(toks) and (toks[k][0] in ROLE_WORDS or (k > i and toks[k][0] in _JOIN and k + 1 < len(toks) and toks[k + 1][0] in ROLE_WORDS)):
                k += 1
            marked = k < len(toks) and toks[k][0] in ("by", ":")
            refused = i > 0 and toks[i - 1][0] in _NO_CREDIT or i > 2 and [t[0] for t in toks[i - 3 : i]] == ["brought", "to", "you"]
            if marked and (k > i or toks[k][0] == "by"):
                colon = toks[k][0] == ":" or (k + 1 < len(toks) and toks[k + 1][0] == ":")
                if not refused and (k > i or i == 0 or colon):
                    role = " ".join(segment[toks[i][1] : toks[k][1]].lower().split()) if k > i else "by"
                    opens.append((i, k + 1 + (toks[k][0] == "by" and colon), re.sub(r"\bphoto\b", "photos", role)))
                    i = k + 1
                    continue
            i = max(k, i + 1)
        for n, (_, at, role) in enumerate(opens):
            end = toks[opens[n + 1][0]][1] if n + 1 < len(opens) else len(segment)
            start = toks[at][1] if at < len(toks) else end
            for chunk in re.split(r"\s*(?:,|&|\band\b)\s*", segment[start:end]):
                name = " ".join(chunk.strip(" .,;:-—|").split()).lower()
                words = name.split()
                if 3 <= len(name) <= 42 and len(words) <= 4 and words[0] not in _NO_NAME and not re.search(r"\d|provided|courtesy|www\.", name) and re.match(r"^[a-z][a-z.'’\- ]+$", name):
                    pair = (role, alias.get(name, name))
                    if pair not in out:
                        out.append(pair)
    return out


def byline_rows(pages: DataFrame, alias: dict[str, str] | None = None) -> DataFrame:
    """(page_id, pos, role, name): the credits of each page's first line that is a byline; lines are found natively, only they reach Python."""
    lines = F.transform(F.split(F.regexp_replace("html", r"(?i)<br\s*/?>|</p>|</div>|</h\d>", "\n"), "\n"), lambda x: squeeze(strip_tags(x)))
    cue = r"(?i)(^|\s)(by|words|text|story|interview|written|novella|photos?|photographs|photography|pictures|illustrations?|illustrated|drawings|art|artwork|comics?|design|edited)\s*(:|by\b)|(^by\s)"
    rows = pages.where("html is not null").select("page_id", F.posexplode(F.filter(lines, lambda x: x.rlike(cue) & ~x.rlike(r"[.!?…][\"”’)]*$"))).alias("line", "t"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [(i, int(n), k, role, name) for i, n, t in zip(pdf["page_id"], pdf["line"], pdf["t"], strict=True) for k, (role, name) in enumerate(byline(t, alias))]
            yield pd.DataFrame(out, columns=["page_id", "line", "pos", "role", "name"])

    got = spread(rows, "page_id").mapInPandas(run, "page_id bigint, line int, pos int, role string, name string")
    first = got.groupBy("page_id").agg(F.min("line").alias("line"))
    return got.join(first, ["page_id", "line"]).select("page_id", "pos", "role", "name")


def credit_lines(credits: DataFrame) -> DataFrame:
    """(article_id, line, authors, editors, others) from credits (article_id, role, name): each role once with all its names.

    Writers are by, words, text, story, reports; editors edited; the rest others.
    """
    kind = F.when(F.col("role").rlike(r"\b(by|words|text|story|written|interview|reports)\b"), "authors").when(F.col("role").rlike(r"\bedited\b"), "editors").otherwise("others")
    per = credits.select("article_id", "role", "name", kind.alias("kind")).distinct()
    names = lambda k: F.array_join(F.array_sort(F.collect_set(F.when(F.col("kind") == k, F.col("name")))), ", ").alias(k)  # noqa: E731 - the credits of one article
    phrase = per.groupBy("article_id", "role").agg(F.array_join(F.array_sort(F.collect_list("name")), " and ").alias("names"))
    text = F.concat(F.when(F.col("role") == "by", "").otherwise(F.concat("role", F.lit(" "))), F.lit("by "), F.col("names"))
    line = phrase.groupBy("article_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("role", text.alias("p")))), lambda x: x["p"]), ", ").alias("line"))
    return line.join(per.groupBy("article_id").agg(names("authors"), names("editors"), names("others")), "article_id")


def contributor_pages(credits: DataFrame, names: DataFrame, own_page: int = 3, shown: int = 6) -> DataFrame:
    """(slug, name, works, text): people with works enough for a page, what they did, from when to when, and their first pieces.

    credits (article_id, role, name), names (article_id, issue, title).  Works are ordered by issue and id.
    """
    did = F.create_map(*[F.lit(x) for kv in DID.items() for x in kv])
    c = credits.join(names, "article_id", "left").select("name", "article_id", F.coalesce("issue", F.lit(0)).alias("issue"), F.coalesce("title", F.lit("")).alias("title"), F.coalesce(did[F.col("role")], F.col("role")).alias("did"))
    verbs = F.array_sort(F.collect_set("did"))
    g = c.groupBy("name").agg(
        F.count_distinct("article_id").alias("works"), verbs.alias("did"), F.min("issue").alias("a"), F.max("issue").alias("b"),
        F.array_distinct(F.transform(F.array_sort(F.collect_set(F.struct("issue", "article_id", "title"))), lambda x: x["title"])).alias("titles"),  # the works of one person
    ).where(F.col("works") >= own_page)
    verb = F.when(F.size("did") > 1, F.concat(F.array_join(F.slice("did", 1, F.size("did") - 1), ", "), F.lit(" and "), F.element_at("did", -1))).otherwise(F.element_at("did", 1))
    span = F.when(F.col("a") == F.col("b"), F.concat(F.lit("issue "), F.col("a").cast("string"))).otherwise(F.concat(F.lit("issues "), F.col("a").cast("string"), F.lit(" to "), F.col("b").cast("string")))
    pieces = F.when((F.size("titles") == 1) & (F.col("works") > 1), F.concat(F.lit("the "), F.element_at("titles", 1), F.lit(" column, "), F.col("works").cast("string"), F.lit(" installments"))).otherwise(
        F.concat(F.array_join(F.slice("titles", 1, shown), ", "), F.when(F.size("titles") > shown, " and more").otherwise(""))
    )
    slug = F.regexp_replace(F.regexp_replace(F.lower("name"), "[^a-z0-9]+", "-"), "^-|-$", "")
    return g.select(slug.alias("slug"), "name", "works", clip(F.concat("name", F.lit(" "), verb, F.lit(", "), span, F.lit(": "), pieces, F.lit(".")), DESCRIPTION_MAX).alias("text"))


def surname_order(names: DataFrame) -> DataFrame:
    """(name, nr): names (name) in the order of a printed list: by surname, then the rest, by the collation of Unicode."""
    key = F.concat_ws(" ", F.regexp_extract("name", r"(\S+)$", 1), F.col("name"))
    ranked = names.select("name").distinct().select("name", F.collate(key, "UNICODE_CI").alias("key"))
    return ranked.select("name", F.row_number().over(Window.orderBy("key", "name")).alias("nr"))  # a list of people, one row each


# ---------------------------------------------------------------- descriptions


def page_descriptions(pages: DataFrame, articles: DataFrame, credits: DataFrame) -> DataFrame:
    """(page_id, name, head, description): names and descriptions of article pages by their kind.

    The start page has the article's name with its credit where that fits, a photo page counts k of n, a part
    page has a label from its address.  A description that would swear is replaced by a plain one.
    """
    a = articles_once(articles).select(F.col("id").cast("bigint").alias("article_id"), lower_shouting(tidy(F.coalesce("title", F.lit("")))).alias("title"), "blurb", "issue")
    cred = credit_lines(credits).select("article_id", "line")
    p = pages.where("article_id is not null").select("page_id", "article_id", F.lower(F.coalesce("page_path", F.lit(""))).alias("path"))
    photo = F.col("path").rlike(r"^photo[0-9]+$")
    # the number of photo pages of an article, and a page's place among them, come from distinct paths
    paths = p.where(photo).select("article_id", "path").distinct()
    w = Window.partitionBy("article_id")
    places = paths.select("article_id", "path", F.row_number().over(w.orderBy(F.regexp_extract("path", "([0-9]+)", 1).cast("int"), "path")).alias("k"), F.count(F.lit(1)).over(w).alias("n"))
    rows = p.join(places, ["article_id", "path"], "left").join(a, "article_id", "left").join(cred, "article_id", "left")
    start = F.col("path").isin("", "main", "index", "index.php")
    label = F.when(photo, F.format_string("photo %d of %d", "k", "n")).otherwise(path_label(F.col("path")))
    title = F.coalesce("title", F.lit(""))
    with_credit = F.concat(title, F.lit(", "), F.col("line"))
    head = F.when(start, F.when(F.length(with_credit) <= HEAD_MAX, with_credit).otherwise(title)).otherwise(F.concat(title, F.lit(", "), label))
    where = F.concat(F.when(start, title).otherwise(F.concat(label, F.lit(" of "), title)), F.lit(", issue "), F.coalesce("issue", F.lit(0)).cast("string"), F.lit("."))
    full = clip(join_sentences(F.when(start, F.col("blurb")), where), DESCRIPTION_MAX)
    text = F.when(full.rlike(PROFANE), clip(where, DESCRIPTION_MAX)).otherwise(full)
    return rows.select("page_id", clip(F.when(start, title).otherwise(F.concat(title, F.lit(", "), label)), NAME_MAX).alias("name"), clip(F.coalesce(head, title), HEAD_MAX).alias("head"), text.alias("description"))


# ---------------------------------------------------------------- pictures


def page_pictures(pages: DataFrame) -> DataFrame:
    """(article_id, page_id, pos, src, width, height): the pictures of article pages in order, by the path they are loaded from."""
    tags = F.regexp_extract_all("html", F.lit(r"(?i)(<img\s[^>]*>)"), F.lit(1))
    rows = pages.where("html is not null and article_id is not null and url is not null").select("article_id", "page_id", url_path(F.col("url")).alias("path"), F.posexplode(tags).alias("pos", "tag"))
    number = lambda a: F.expr(f"try_cast(nullif(regexp_extract(tag, '(?i){a}\\\\s*=\\\\s*\"?([0-9]+)', 1), '') as int)")
    src = unquoted(F.regexp_extract("tag", IMG, 1))
    return rows.where(src != "").select("article_id", "page_id", "pos", resolve_path(F.col("path"), src).alias("src"), number("width").alias("width"), number("height").alias("height"))


def lead_pictures(pages: DataFrame, articles: DataFrame, least: int = 60) -> DataFrame:
    """(issue, article_id, src, area): each issue's largest picture at least ``least`` on both sides, the first on a tie."""
    pics = page_pictures(pages).where((F.col("width") >= least) & (F.col("height") >= least))
    best = F.max(F.struct((F.col("width") * F.col("height")).alias("area"), (-F.col("article_id")).alias("na"), (-F.col("page_id")).alias("np"), (-F.col("pos")).alias("nq"), "src"))
    issue = articles_once(articles).select(F.col("id").cast("bigint").alias("article_id"), "issue").where("issue is not null")
    return pics.join(issue, "article_id").groupBy("issue").agg(best.alias("b")).select("issue", (-F.col("b.na")).alias("article_id"), "b.src", "b.area")


def photo_canonicals(pages: DataFrame) -> DataFrame:
    """(page_id, canonical): photo pages of an article that show a picture an earlier photo page of it has; exact copies take no part.

    Both firsts are aggregates, so neither a popular picture nor copies by the million are a hot window.
    """
    from restitch.operators.pages import first_copies

    own = first_copies(pages).where("canonical is null").select("page_id")
    photo = pages.where(F.lower(F.coalesce("page_path", F.lit(""))).rlike(r"^photo[0-9]+$"))
    main = F.max(F.struct(F.coalesce(F.col("width") * F.col("height"), F.lit(0)).alias("area"), (-F.col("pos")).alias("np"), "src"))
    shown = page_pictures(photo).join(own, "page_id", "left_semi").groupBy("article_id", "page_id").agg(main.alias("m")).select("article_id", "page_id", "m.src")
    first = shown.groupBy("article_id", "src").agg(F.min("page_id").alias("first"))
    return shown.join(first, ["article_id", "src"]).where("page_id != first").select("page_id", F.col("first").alias("canonical"))


def galleries(pages: DataFrame, least: int = 2) -> DataFrame:
    """(page_id, folder, thumbs, shown): pages with numbered thumbnails (name, number, 't') whose full-size pictures exist, one of them on the page.

    The full-size name is tried under the thumbnail's extension, then under the usual ones: the tries are
    exploded with their rank and met by one equi-join with all pictures seen.
    """
    pics = page_pictures(pages).select("page_id", "src").distinct()
    thumb = r"(?i)^(.*/)?([^/]*?)([0-9]+)(_?)t(x?)\.(jpe?g|gif|png)$"
    t = pics.where(F.col("src").rlike(thumb)).select("page_id", "src", *[F.regexp_extract("src", thumb, i).alias(n) for i, n in ((1, "folder"), (2, "prefix"), (3, "num"), (6, "ext"))])
    tries = t.select("page_id", "folder", "num", F.posexplode(F.transform(F.array(F.col("ext"), F.lit("jpg"), F.lit("gif"), F.lit("jpeg"), F.lit("png")), lambda e: F.concat("folder", "prefix", "num", F.lit("."), e))).alias("rank", "full"))
    have = pics.select(F.col("src").alias("full")).distinct()
    full = tries.join(have, "full").groupBy("page_id", "folder", "num").agg(F.min(F.struct("rank", "full")).alias("m")).select("page_id", "folder", "num", "m.full")
    on_page = pics.select("page_id", F.col("src").alias("full"), F.lit(1).alias("here"))
    return full.join(on_page, ["page_id", "full"], "left").groupBy("page_id", "folder").agg(F.count_distinct("full").alias("thumbs"), F.count("here").alias("shown")).where((F.col("thumbs") >= least) & (F.col("shown") > 0))


def missing_views(pages: DataFrame) -> DataFrame:
    """(article_id, path, template): views of an article that its pages link to and nobody captured, with the captured view to rebuild them from.

    Views are links to the script with an article and a view number; the template is the last captured one by name.
    """
    link = F.regexp_extract_all("html", F.lit(r'(?i)href="/?(main\.php\?[^"]*)"'), F.lit(1))
    refs = pages.where("html is not null").select(F.explode(F.array_distinct(link)).alias("ref")).distinct()
    q = F.regexp_replace(F.regexp_extract("ref", r"\?(.*)$", 1), "&amp;", "&")
    key = lambda k: F.regexp_extract(F.concat(F.lit("&"), q), rf"&{k}=([^&]*)", 1)
    wanted = refs.select(key("article").alias("a"), key("view").alias("v")).where("a rlike '^[0-9]{1,9}$' and v rlike '^[0-9]+$'").distinct().select(F.col("a").cast("bigint").alias("article_id"), F.concat(F.lit("photo"), F.col("v")).alias("path"))
    have = pages.where("article_id is not null and page_path rlike '^photo[0-9]+$'").select("article_id", F.col("page_path").alias("path")).distinct()
    template = have.groupBy("article_id").agg(F.max("path").alias("template"))
    return wanted.join(have, ["article_id", "path"], "left_anti").join(template, "article_id", "left").select("article_id", "path", "template")


def visible_pages(pages: DataFrame) -> DataFrame:
    """(article_id, pages, empty, comments): per article its pages, those with neither text nor picture, and whether any shows comments."""
    body = F.regexp_replace(F.regexp_replace(F.coalesce("html", F.lit("")), r"(?is)<head\b.*?</head>|<script\b.*?</script>|<style\b.*?</style>", ""), r"&nbsp;|\s", "")
    empty = (F.regexp_replace(body, r"<[^>]*>", "") == "") & ~body.rlike(r"(?i)<img")
    return pages.where("article_id is not null").groupBy("article_id").agg(
        F.count(F.lit(1)).alias("pages"), F.count_if(empty).alias("empty"), F.bool_or(F.coalesce("has_comments", F.coalesce("page_path", F.lit("")) == "")).alias("comments")
    )


def picture_texts(pages: DataFrame, articles: DataFrame, credits: DataFrame, most: int = 280) -> DataFrame:
    """(src, text): what a picture's text says in context: its article, place and credits; of several articles the first writes it."""
    a = articles_once(articles).select(F.col("id").cast("bigint").alias("article_id"), F.coalesce("title", F.lit("")).alias("title"), "blurb")
    first = page_pictures(pages).groupBy("article_id", "src").agg(F.min(F.struct("page_id", "pos")).alias("at"))
    w = Window.partitionBy("article_id")
    placed = first.select("article_id", "src", F.row_number().over(w.orderBy("at", "src")).alias("k"), F.count(F.lit(1)).over(w).alias("n"))
    rows = placed.join(a, "article_id").join(credit_lines(credits).select("article_id", "line"), "article_id", "left")
    head = F.concat("title", F.coalesce(F.concat(F.lit(", "), "line"), F.lit("")))
    text = F.when(F.col("k") == 1, join_sentences(F.concat(head, F.coalesce(F.concat(F.lit(": "), "blurb"), F.lit(""))), F.lit("photo"))).otherwise(
        F.concat(F.col("title"), F.format_string(", photo %d of %d", "k", "n"))
    )
    return rows.groupBy("src").agg(F.min(F.struct("article_id", clip(text, most).alias("text"))).alias("m")).select("src", "m.text")
