"""The catalog of issues, articles and page variants, and what is published from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from restitch.functions.text import clip, join_sentences, lower_shouting, slugify, tidy
from restitch.functions.urls import url_path


def articles_once(articles: DataFrame) -> DataFrame:
    """One row per article id: of several titles the one with fewer capitals, then the first; nulls filled from the others."""
    title = F.min(F.struct(F.length(F.regexp_replace(F.trim("title"), "[^A-Z]", "")).alias("c"), F.trim("title").alias("t")))
    return articles.groupBy("id").agg(
        title.alias("m"), F.min("folder").alias("folder"), F.min("issue").alias("issue"), F.min("blurb").alias("blurb"), F.count(F.lit(1)).alias("n")
    ).select("id", F.col("m.t").alias("title"), "folder", "issue", "blurb", "n")


def catalog(articles: DataFrame, issues: DataFrame) -> DataFrame:
    """(id, title, folder, issue, issue_name, blurb): an article without an issue has that of its folder's other articles.

    A folder's issue is the one that most of its articles name, the smallest on a tie; an article whose folder
    says nothing has issue 0.
    """
    a = articles_once(articles)
    votes = a.where("issue is not null and folder is not null").groupBy("folder", "issue").agg(F.count(F.lit(1)).alias("k"))
    by_folder = votes.groupBy("folder").agg(F.min(F.struct((-F.col("k")).alias("neg"), "issue")).alias("m")).select("folder", F.col("m.issue").alias("folder_issue"))
    names = issues.groupBy("issue").agg(F.min("name").alias("issue_name"))
    filled = a.join(by_folder, "folder", "left").withColumn("issue", F.coalesce("issue", "folder_issue", F.lit(0)))
    return filled.join(names, "issue", "left").select("id", "title", "folder", "issue", "issue_name", "blurb")


def folders_seen(pages: DataFrame) -> DataFrame:
    """(article_id, folder, n): the folder pair under which an article's pages were captured most often, the first by name on a tie."""
    f = F.regexp_extract(url_path(F.col("url")), r"^/issues/([^/]+/[^/]+)/", 1)
    n = pages.where("url is not null and article_id is not null").select("article_id", f.alias("folder")).where("folder != ''").groupBy("article_id", "folder").agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy("article_id").agg(F.min(F.struct((-F.col("n")).alias("k"), "folder")).alias("m")).select("article_id", "m.folder", (-F.col("m.k")).alias("n"))


def variants(pages: DataFrame) -> DataFrame:
    """(article_id, page_path, seq, previous, next): the page variants of an article in reading order.

    The start page first, then numbered pages by number, then named ones; with links to the neighbours.
    """
    p = pages.where("article_id is not null").select("article_id", F.coalesce("page_path", F.lit("")).alias("page_path")).distinct()
    number = F.coalesce(F.expr("try_cast(nullif(regexp_extract(page_path, '([0-9]+)', 1), '') as int)"), F.lit(1_000_000))
    first = F.when(F.col("page_path").isin("", "main", "index.php"), 0).when(F.col("page_path").rlike("^(page|index)[0-9]"), 1).otherwise(2)
    w = Window.partitionBy("article_id").orderBy(first, number, "page_path")
    return p.select("article_id", "page_path", F.row_number().over(w).alias("seq"), F.lag("page_path").over(w).alias("previous"), F.lead("page_path").over(w).alias("next"))


def slugs(articles: DataFrame) -> DataFrame:
    """(id, slug): unique within the issue; all but the first id of a slug carry their id.

    A slug that already ends in another one's id would clash; as ids are appended once more until
    nothing clashes, and ids differ, two rounds settle every case.
    """
    a = articles_once(articles).select("id", F.coalesce("issue", F.lit(0)).alias("issue"), F.regexp_replace(slugify(F.coalesce("title", F.lit(""))), "^$", "untitled").alias("slug"))
    for _ in range(2):
        nr = F.row_number().over(Window.partitionBy("issue", "slug").orderBy("id"))
        a = a.withColumn("nr", nr).select("id", "issue", F.when(F.col("nr") == 1, F.col("slug")).otherwise(F.concat("slug", F.lit("-"), F.col("id").cast("string"))).alias("slug"))
    return a


def descriptions(articles: DataFrame) -> DataFrame:
    """(id, name, description): the names and descriptions of article pages."""
    a = articles_once(articles)
    return a.select("id", lower_shouting(tidy(F.col("title"))).alias("name"), clip(join_sentences(F.col("title"), F.col("blurb")), 160).alias("description"))


def issue_contents(articles: DataFrame, issues: DataFrame) -> DataFrame:
    """(issue, name, n, titles): the issues with their articles in order of id."""
    c = catalog(articles, issues).where("issue > 0")
    g = c.groupBy("issue").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(F.struct("id", "title"))).alias("a"))
    names = issues.groupBy("issue").agg(F.min("name").alias("name"))
    return g.join(names, "issue", "left").select("issue", "name", "n", F.array_join(F.transform("a", lambda x: x["title"]), " | ").alias("titles"))


def sitemap(pages: DataFrame, base: str = "https://www.lampmag.example") -> DataFrame:
    """(loc, priority, lastmod): one row per published path."""
    p = pages.where("url is not null").select(url_path(F.col("url")).alias("path"), F.substring(F.regexp_replace("ts", "[^0-9]", ""), 1, 8).alias("d"))
    g = p.groupBy("path").agg(F.max(F.when(F.length("d") == 8, F.col("d"))).alias("d"))
    priority = F.when(F.col("path") == "/", "1.0").when(F.col("path").rlike(r"^/issues/[^/]+/?$"), "0.8").when(F.col("path").rlike(r"^/issues/[^/]+/[^/]+/?$"), "0.7").otherwise("0.5")
    day = F.concat_ws("-", F.substring("d", 1, 4), F.substring("d", 5, 2), F.substring("d", 7, 2))
    return g.select(F.concat(F.lit(base), F.col("path")).alias("loc"), priority.alias("priority"), F.when(F.col("d").isNotNull(), day).alias("lastmod"))


def sitemap_xml(entries: DataFrame, limit: int = 50_000) -> DataFrame:
    """(line) of a sitemap; more entries than the format allows are an error, not a cut."""
    from restitch.functions.text import escape_html

    line = F.concat(
        F.lit("<url><loc>"), escape_html(F.col("loc")), F.lit("</loc>"), F.coalesce(F.concat(F.lit("<lastmod>"), F.col("lastmod"), F.lit("</lastmod>")), F.lit("")),
        F.lit("<priority>"), F.col("priority"), F.lit("</priority></url>"),
    )
    n = entries.agg(F.count(F.lit(1)).alias("n"))
    checked = entries.join(F.broadcast(n)).where(F.expr(f"assert_true(n <= {limit}) is null"))
    return checked.select(line.alias("line")).orderBy("line")


def event_views(events: DataFrame) -> DataFrame:
    """(event_type, views, first_view, last_view, readers): per-key count, min and max, null times counted but not compared."""
    return events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("views"), F.min("ts").alias("first_view"), F.max("ts").alias("last_view"), F.count_distinct("user_id").alias("readers")
    )


def frame_issues(frames: DataFrame, issues: DataFrame) -> DataFrame:
    """(issue, name, frames, with_footer, menu_links): the captured frames of each issue."""
    f = frames.groupBy("issue").agg(
        F.count(F.lit(1)).alias("frames"), F.count_if(F.col("footer").isNotNull()).alias("with_footer"),
        F.max(F.regexp_count(F.coalesce("menu", F.lit("")), F.lit(r"(?i)<a\s"))).alias("menu_links"),
    )
    return f.join(issues.groupBy("issue").agg(F.min("name").alias("name")), "issue", "left").select("issue", "name", "frames", "with_footer", "menu_links")


def canonical_colors(issues: DataFrame) -> DataFrame:
    """(issue, color): an issue's dark colour, the most common one of all issues where it has none, the first by name on a tie."""
    n = issues.where("color_dark is not null").groupBy("color_dark").agg(F.count(F.lit(1)).alias("n"))
    common = n.agg(F.min(F.struct((-F.col("n")).alias("k"), "color_dark")).alias("m")).select(F.col("m.color_dark").alias("common"))
    return issues.join(F.broadcast(common)).select("issue", F.coalesce("color_dark", "common").alias("color"))
