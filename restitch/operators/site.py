"""Rules of a single published site as plans with parameters: what is internal, guarded, free of ads, shown from which copy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from restitch.functions.text import squeeze, strip_tags, tidy
from restitch.functions.urls import directory, extension, stem, url_path
from restitch.operators import manifest as M
from restitch.operators.catalog import articles_once
from restitch.operators.editorial import menu_entries, page_pictures
from restitch.operators.pages import first_copies, review
from restitch.session import written

# Sizes of a preview card, and what a listing or a reply page shows.
CARD_WIDTH, LEAST_SIDE, SHEET_IMAGES = 600, 200, 5
LISTING_HEAD = 2048


def internal(pages: DataFrame, hidden: str = r"^/(list|admin|cgi-bin)\b") -> DataFrame:
    """(page_id, reason): pages that are not published: paths kept back, replies to a form, listings of a folder."""
    head = F.substring(F.coalesce("html", F.lit("")), 1, LISTING_HEAD)
    path = url_path(F.coalesce("url", F.lit("")))
    reason = (
        F.when(path.rlike(hidden), "kept back").when(head.rlike(r"(?i)<title>\s*index of /"), "directory listing").when(head.rlike(r"(?i)thank you for (signing up|subscribing|joining)"), "reply")
    )
    return pages.select("page_id", reason.alias("reason")).where("reason is not null")


def guarded(articles: DataFrame, marks: tuple[str, ...] = ("L0V3",)) -> DataFrame:
    """Articles whose titles nobody injected: none starts with a tag or holds a known mark."""
    title = F.trim(F.coalesce("title", F.lit("")))
    bad = title.startswith("<")
    for m in marks:
        bad = bad | title.contains(m)
    return articles.where(~bad)


def with_ads(pages: DataFrame, no_ads: DataFrame) -> DataFrame:
    """(page_id): pages that may show ads: neither they nor the article they belong to are on the list (url), and they are article pages."""
    p = pages.where("url is not null").select("page_id", url_path(F.col("url")).alias("path")).withColumn("article", directory(F.col("path")))
    listed = no_ads.select(F.col("url").alias("path")).distinct()
    return p.where(F.col("path").rlike(r"^/issues/")).join(listed, "path", "left_anti").join(listed.select(F.col("path").alias("article")), "article", "left_anti").select("page_id")


def selected(captures: DataFrame, only: str | None = None, limit: int | None = None) -> DataFrame:
    """The manifest of pages that a pattern matches, at most ``limit`` of them in order of the page: a run over a part, asked for as such."""
    m = M.manifest(captures)
    m = m.where(F.col("page").rlike(only)) if only else m
    if limit is None:
        return m
    return m.join(m.select("page").distinct().orderBy("page").limit(limit), "page", "left_semi")


def page_sources(captures: DataFrame) -> DataFrame:
    """(page, source, rec_id): which copy a page is shown from: an archive's first choice, else the server's file, else nothing."""
    parsed = written(M.prepared(captures))
    p = parsed.select("page").distinct()
    first = M.manifest(captures, parsed).where("rank = 1").select("page", "rec_id")
    by = parsed.select("rec_id", F.coalesce("source", F.lit("")).alias("source"))
    chosen = first.join(by, "rec_id").select("page", F.when(F.col("source") == "server", "server").otherwise("archive").alias("source"), "rec_id")
    return p.join(chosen, "page", "left").select("page", F.coalesce("source", F.lit("none")).alias("source"), "rec_id")


def first_views(variants: DataFrame) -> DataFrame:
    """(article_id, variant_path, page): a gallery page that only the server has (page is null) shows its first captured view, if that is view 1.

    variants (article_id, variant_path, page); views are the paths below it that end in view-N/.
    """
    base = variants.where("page is null").select("article_id", "variant_path")
    view = F.regexp_extract("variant_path", r"^(.*)view-([0-9]+)/$", 2).cast("int")
    seen = variants.where(F.col("page").isNotNull() & F.col("variant_path").rlike(r"view-[0-9]+/$")).select(
        "article_id", F.regexp_extract("variant_path", r"^(.*)view-[0-9]+/$", 1).alias("variant_path"), F.struct(view.alias("n"), "page").alias("v")
    )
    first = seen.groupBy("article_id", "variant_path").agg(F.min("v").alias("v")).where("v.n = 1").select("article_id", "variant_path", F.col("v.page").alias("shown"))
    return variants.join(base.join(first, ["article_id", "variant_path"]), ["article_id", "variant_path"], "left").select("article_id", "variant_path", F.coalesce("page", "shown").alias("page"))


def style_sources(wanted: DataFrame, archived: DataFrame, server: DataFrame) -> DataFrame:
    """(path, css): the archived style sheet of each wanted path, else the server's, else ''; server templates with code are refused."""
    usable = server.where(~F.col("css").rlike(r"(?i)<\?(php|=)")).select("path", F.col("css").alias("s"))
    return wanted.select("path").distinct().join(archived.select("path", F.col("css").alias("a")), "path", "left").join(usable, "path", "left").select("path", F.coalesce("a", "s", F.lit("")).alias("css"))


def stand_ins(captures: DataFrame, pages: DataFrame) -> DataFrame:
    """(src, stand_in): pictures that pages show and nobody captured, with a captured picture of the same name and another extension."""
    shown = page_pictures(pages).select("src").distinct()
    have = M.candidates(captures).select(F.regexp_extract("page", r"^([^?]*)", 1).alias("path")).where(extension(F.col("path")).isin("jpg", "jpeg", "gif", "png", "bmp")).distinct()
    lost = shown.join(have.select(F.col("path").alias("src")), "src", "left_anti")
    by_stem = have.groupBy(stem(F.col("path")).alias("stem")).agg(F.min("path").alias("stand_in"))
    return lost.withColumn("stem", stem(F.col("src"))).join(by_stem, "stem", "left").select("src", "stand_in")


def preview_cards(pages: DataFrame) -> DataFrame:
    """(page_id, card, src): the kind of preview of a page: large with a wide picture, small with another one, none without."""
    pics = page_pictures(pages).where((F.col("width") >= LEAST_SIDE) & (F.col("height") >= LEAST_SIDE))
    best = pics.groupBy("page_id").agg(F.max(F.struct((F.col("width") * F.col("height")).alias("area"), (-F.col("pos")).alias("np"), "src", "width")).alias("b"))
    card = F.when(F.col("b").isNull(), "none").when(F.col("b.width") >= CARD_WIDTH, "large").otherwise("small")
    return pages.where("html is not null").select("page_id").join(best, "page_id", "left").select("page_id", card.alias("card"), F.col("b.src").alias("src"))


def contact_sheet(pages: DataFrame, comments: DataFrame, least: int = SHEET_IMAGES) -> DataFrame:
    """(article_id, tier, images): articles somebody should look at: with many pictures, or of another tier than ok."""
    n = page_pictures(pages).groupBy("article_id").agg(F.count_distinct("src").alias("images"))
    r = review(pages, comments).select("article_id", "tier")
    return r.join(n, "article_id", "left").select("article_id", "tier", F.coalesce("images", F.lit(0)).alias("images")).where((F.col("images") >= least) | (F.col("tier") != "ok"))


def cover_links(frames: DataFrame, articles: DataFrame, pages: DataFrame) -> DataFrame:
    """(issue, folder, id, page_id): the articles that an issue's menu links to, each led to the first of equal pages.

    Two left joins, and one more step where the linked page is a copy of another article's.
    """
    linked = menu_entries(frames).where("folder != ''").select("issue", "folder").distinct()
    a = articles_once(articles).where("folder is not null").select("issue", "folder", F.col("id").cast("bigint").alias("id"))
    start = pages.where("article_id is not null").groupBy(F.col("article_id").alias("id")).agg(F.min("page_id").alias("page_id"))
    copies = first_copies(pages).where("canonical is not null")
    return (
        linked.join(a, ["issue", "folder"], "left").join(start, "id", "left").join(copies, "page_id", "left")
        .select("issue", "folder", "id", F.coalesce("canonical", "page_id").alias("page_id"))
    )


def captions(texts: DataFrame) -> DataFrame:
    """(text, name, age, job): captions of the form 'Name 29 job' taken apart; others are left out."""
    rx = r"^(.+?)\s+(\d{1,3})\s+(.+)$"
    t = tidy(F.col("text"))
    return texts.where(t.rlike(rx)).select("text", F.regexp_extract(t, rx, 1).alias("name"), F.regexp_extract(t, rx, 2).cast("int").alias("age"), F.regexp_extract(t, rx, 3).alias("job"))


def relinked_feed(feed: Column, targets: dict[str, str]) -> Column:
    """A feed whose item links lead to new addresses; the channel's own link and unknown ones stay."""
    for old, new in sorted(targets.items()):
        feed = F.replace(feed, F.lit(f"<link>{old}</link>"), F.lit(f"<link>{new}</link>"))
    return feed


def page_titles_parsed(pages: DataFrame) -> DataFrame:
    """(page_id, kind, place): titles of the forms '<n> hours on <place>' and 'why <place> keeps its <thing>' taken apart."""
    t = squeeze(strip_tags(F.regexp_extract("html", r"(?is)<title>([^<]*)</title>", 1)))
    hours, why = r"(?i)^\w+ hours on (.+)$", r"(?i)^why (.+) keeps its \w+(?: \w+)*$"
    kind = F.when(t.rlike(hours), "hours").when(t.rlike(why), "why")
    place = F.when(t.rlike(hours), F.regexp_extract(t, hours, 1)).otherwise(F.regexp_extract(t, why, 1))
    return pages.where("html is not null").select("page_id", kind.alias("kind"), F.lower(place).alias("place")).where("kind is not null")
