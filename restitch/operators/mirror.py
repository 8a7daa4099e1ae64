"""The published mirror: references between pages, old addresses, variants, page maps, injected blocks.

Everything here is a native plan: ranked tries are exploded and met by one equi-join, and
whatever a page lists is a higher-order expression over its own markup.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from restitch.functions.text import escape_html, tidy
from restitch.functions.urls import directory, extension, query_pairs, url_path
from restitch.operators import manifest as M
from restitch.session import written

# Attributes, robots marks, and the limits of the page map format.
HREF = r"(?i)<a\s[^>]*?href\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+)"
IMG = r"(?i)<img\s[^>]*?src\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+)"
NOINDEX = r"(?i)<meta\s[^>]*name\s*=\s*[\"']?robots[^>]*noindex"
REFRESH = r"(?i)<meta\s[^>]*http-equiv\s*=\s*[\"']?refresh"
CANONICAL = r"(?i)<link\s[^>]*rel\s*=\s*[\"']?canonical[\"']?\s[^>]*href\s*=\s*[\"']([^\"']*)"
NO_MAP = r"^/(main\.php|gallery\.php|history/)|/photo[0-9]+$"
HEAD_CHARS, MAX_IMAGES, MAX_URLS = 6000, 1000, 50_000


def unquoted(c: Column) -> Column:
    return F.regexp_replace(c, r"^[\"']|[\"']$", "")


def resolve_path(base: Column, ref: Column) -> Column:
    """Path of a reference seen from the page at path ``base``: dot segments removed, query and fragment left out."""
    bare = F.regexp_replace(ref, r"[?#].*$", "")
    full = F.when(bare == "", base).when(bare.startswith("/"), bare).otherwise(F.concat(directory(base), bare))
    parts = F.filter(F.split(full, "/"), lambda x: ~x.isin("", "."))
    up = F.aggregate(parts, F.lit(""), lambda acc, x: F.when(x == "..", F.regexp_replace(acc, r"/[^/]*$", "")).otherwise(F.concat(acc, F.lit("/"), x)))
    return F.when(full.rlike(r"/(\.{1,2})?$") | (up == ""), F.concat(up, F.lit("/"))).otherwise(up)


def relative_path(target: Column, page: Column) -> Column:
    """Path ``target`` as a reference from the page at path ``page``; './' for the page's own folder."""
    t, p = F.split(target, "/"), F.slice(F.split(page, "/"), 1, F.size(F.split(page, "/")) - 1)
    common = F.aggregate(
        F.sequence(F.lit(1), F.greatest(F.least(F.size(t) - 1, F.size(p)), F.lit(1))), F.lit(0),
        lambda k, i: F.when((k == i - 1) & (F.get(t, i - 1) == F.get(p, i - 1)), i).otherwise(k),
    )
    rest = F.array_join(F.slice(t, common + 1, F.size(t)), "/")
    out = F.concat(F.repeat(F.lit("../"), F.size(p) - common), rest)
    return F.when(out == "", F.lit("./")).otherwise(out)


def page_links(pages: DataFrame) -> DataFrame:
    """(page_id, path, ref, target, rel, known): the distinct internal links of each page.

    target is the path a link leads to, rel the reference to write for it, known whether a captured page
    or the folder of one stands there; folders are known with and without their slash.
    """
    refs = pages.where("html is not null and url is not null").select(
        "page_id", url_path(F.col("url")).alias("path"), F.explode(F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(HREF), F.lit(1)), unquoted))).alias("ref")
    ).where(~F.col("ref").rlike(r"^([A-Za-z][A-Za-z0-9+.-]*:|//|#|$)"))
    rows = refs.withColumn("target", resolve_path(F.col("path"), F.col("ref")))
    have = pages.where("url is not null").select(url_path(F.col("url")).alias("target")).distinct()
    folders = have.select(directory(F.col("target")).alias("target")).distinct()
    keys = have.union(folders).union(folders.select(F.regexp_replace("target", r"/$", ""))).distinct().withColumn("known", F.lit(True))
    return rows.join(keys, "target", "left").select(
        "page_id", "path", "ref", "target", relative_path(F.col("target"), F.col("path")).alias("rel"), F.coalesce("known", F.lit(False)).alias("known")
    )


def link_report(pages: DataFrame) -> DataFrame:
    """(target, links, pages, known): internal targets by how often they are linked."""
    return page_links(pages).groupBy("target", "known").agg(F.count(F.lit(1)).alias("links"), F.count_distinct("page_id").alias("pages"))


def relinked(pages: DataFrame) -> DataFrame:
    """(page_id, html): every double-quoted internal link to a known page written relative to its page, an unknown one unwrapped to '#'.

    The links of one page are few, so its own list is folded over its markup.
    """
    new = F.when(F.col("known"), F.col("rel")).otherwise(F.lit("#"))
    per = page_links(pages).groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("ref", new.alias("new")))).alias("m"))
    html = F.aggregate("m", F.col("html"), lambda h, x: F.replace(h, F.concat(F.lit('href="'), x["ref"], F.lit('"')), F.concat(F.lit('href="'), x["new"], F.lit('"'))))
    return pages.where("html is not null").select("page_id", "html").join(per, "page_id", "left").select("page_id", F.coalesce(html, F.col("html")).alias("html"))


# ---------------------------------------------------------------- old addresses and variants


def article_bases(pages: DataFrame) -> DataFrame:
    """(article_id, base): the first folder, by name, of an article's captured pages."""
    return pages.where("article_id is not null and url is not null").groupBy("article_id").agg(F.min(directory(url_path(F.col("url")))).alias("base"))


def _value(pairs: Column, key: str) -> Column:
    return F.get(F.transform(F.filter(pairs, lambda p: p["k"] == key), lambda p: p["v"]), F.lit(0))


def _text(pairs: Column) -> Column:
    return F.array_join(F.transform(pairs, lambda p: F.concat(p["k"], F.lit("="), p["v"])), "&")


def routes(captures: DataFrame, pages: DataFrame, issues: DataFrame) -> DataFrame:
    """(page, target, how): where each old address leads.

    An article's address leads to the variant of it that was captured, else to the article; an issue's
    to the issue; any other script address to its archived copy, under its own name or one of its old
    aliases, else home; a file to its archived copy with or without its query, else nowhere (null).
    """
    parsed = written(M.prepared(captures))
    old = parsed.select("page").distinct()
    q = query_pairs(F.regexp_extract("page", r"\?(.*)$", 1))
    path = F.regexp_extract("page", r"^([^?]*)", 1)
    rows = old.select("page", path.alias("path"), q.alias("q")).select(
        "page", "path", "q", _value(F.col("q"), "article").alias("article"), _value(F.col("q"), "issue").alias("issue"), F.regexp_extract("page", r"\?(.*)$", 1).alias("query")
    )
    script = F.col("path").isin("/", "/main.php", "/index.php", "/gallery.php")
    variant = _text(F.filter("q", lambda p: (p["k"] != "article") & ~((p["k"] == "page") & p["v"].isin("", "main", "index"))))
    none = F.lit(None).cast("string")
    with_query = lambda head: F.when(script & (F.col("query") != ""), F.concat(F.lit("archive:" + head + "?"), F.col("query")))
    tries = F.array(
        F.when(script & F.col("article").isNotNull(), F.concat(F.lit("article:"), "article", F.lit(":"), variant)),
        F.when(script & F.col("article").isNotNull(), F.concat(F.lit("article:"), "article")),
        F.when(script & F.col("issue").isNotNull(), F.concat(F.lit("issue:"), "issue")),
        F.when(script & (F.col("query") != ""), F.concat(F.lit("archive:"), "page")).otherwise(none),
        with_query("/main.php"), with_query("/"),
        F.when(script, F.lit("home")),
        F.when(~script, F.concat(F.lit("archive:"), "page")), F.when(~script, F.concat(F.lit("archive:"), "path")),
    )
    asked = rows.select("page", F.posexplode(tries).alias("rank", "key")).where("key is not null")
    base = article_bases(pages)
    first = M.manifest(captures, parsed).where("rank = 1 and not demoted").select("page")
    captured = first.where("page like '/main.php?%'").select(query_pairs(F.regexp_extract("page", r"\?(.*)$", 1)).alias("q")).select(
        _value(F.col("q"), "article").alias("a"), _text(F.filter("q", lambda p: (p["k"] != "article") & ~((p["k"] == "page") & p["v"].isin("", "main", "index")))).alias("v")
    ).where("a is not null").distinct()
    art = base.select(F.col("article_id").cast("string").alias("a"), "base")
    keys = (
        art.select(F.concat(F.lit("article:"), "a").alias("key"), F.col("base").alias("target"), F.lit("article").alias("how"))
        .unionByName(captured.where("v != ''").join(art, "a").select(F.concat(F.lit("article:"), "a", F.lit(":"), "v").alias("key"), F.concat("base", F.regexp_replace("v", r"[=&]+", "-"), F.lit("/")).alias("target"), F.lit("variant").alias("how")))
        .unionByName(issues.where("issue is not null").select(F.concat(F.lit("issue:"), F.col("issue").cast("string")).alias("key"), F.concat(F.lit("/issues/"), F.col("issue").cast("string"), F.lit("/")).alias("target"), F.lit("issue").alias("how")))
        .unionByName(first.select(F.concat(F.lit("archive:"), "page").alias("key"), F.concat(F.lit("/archive"), "page").alias("target"), F.lit("archive").alias("how")))
        .unionByName(captures.sparkSession.createDataFrame([("home", "/", "home")], "key string, target string, how string"))
    )
    best = asked.join(keys, "key").groupBy("page").agg(F.min(F.struct("rank", "target", "how")).alias("b"))
    return old.join(best, "page", "left").select("page", F.col("b.target").alias("target"), F.coalesce("b.how", F.lit("none")).alias("how"))


def published_variants(captures: DataFrame) -> DataFrame:
    """(article_id, variant_path, page, seq): the captured parameter combinations of each article in reading order.

    The start page first, numbered pages by number, named ones by name, then by view; of several
    addresses of one combination the first by name is taken.
    """
    q = query_pairs(F.regexp_extract("page", r"\?(.*)$", 1))
    rows = M.manifest(captures).where("rank = 1 and kind = 'html' and page like '/main.php?%'").select("page", q.alias("q")).select(
        "page", _value(F.col("q"), "article").alias("a"), F.coalesce(_value(F.col("q"), "page"), F.lit("main")).alias("p"), F.coalesce(_value(F.col("q"), "view"), F.lit("")).alias("view")
    ).where(F.col("a").rlike("^[0-9]{1,9}$"))
    named = F.when(F.col("p").isin("", "main", "index"), "").otherwise(F.concat(F.lower("p"), F.lit("/")))
    path = F.concat(named, F.when(F.col("view") == "", "").otherwise(F.concat(F.lit("view-"), "view", F.lit("/"))))
    one = rows.groupBy(F.col("a").cast("bigint").alias("article_id"), path.alias("variant_path")).agg(F.min(F.struct("page", "p", "view")).alias("m")).select("article_id", "variant_path", "m.*")
    number = lambda c: F.coalesce(F.expr(f"try_cast(nullif(regexp_extract({c}, '^[a-z]*([0-9]+)$', 1), '') as int)"), F.lit(1_000_000))
    klass = F.when(F.col("p").isin("", "main", "index"), 0).when(F.col("p").rlike(r"^[a-z]*[0-9]+$"), 1).otherwise(2)
    w = Window.partitionBy("article_id").orderBy(klass, number("p"), "p", number("view"), "view")
    return one.select("article_id", "variant_path", "page", F.row_number().over(w).alias("seq"))


def year_index(captures: DataFrame) -> DataFrame:
    """(page, year, versions, first_ts, last_ts): the genuine versions of each page by year, for pages with two at least."""
    v = M.versions(captures)
    return v.groupBy("page", F.substring("ts", 1, 4).alias("year")).agg(F.count(F.lit(1)).alias("versions"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


def history_pages(captures: DataFrame) -> DataFrame:
    """(page, version, out_path, label, previous, next): a dated page for each version, linked to its neighbours."""
    stamp = lambda c: F.regexp_replace(c, r"^(\d{4})(\d{2})(\d{2})(\d{6})$", "$1-$2-$3_$4")
    v = M.versions(captures)
    name = F.regexp_replace(F.regexp_replace("page", r"[^A-Za-z0-9]+", "-"), r"^-+|-+$", "")
    folder = F.concat(F.lit("history/"), F.when(name == "", "front").otherwise(name), F.lit("/"))
    file = lambda c: F.when(c.isNotNull(), F.concat(stamp(c), F.lit(".html")))
    return v.select(
        "page", "version", F.concat(folder, file(F.col("ts"))).alias("out_path"), F.format_string("version %d of %d", "version", "versions").alias("label"),
        file(F.col("previous")).alias("previous"), file(F.col("next")).alias("next"),
    )


def root_aliases(captures: DataFrame, home: str = "/") -> DataFrame:
    """(page, target): addresses of the root with a query, led to the script page of the same query, else home."""
    pages = M.prepared(captures).select("page").distinct()
    roots = pages.where("page like '/?%'").select("page", F.concat(F.lit("/main.php"), F.substring("page", 2, 1 << 20)).alias("main"))
    return roots.join(pages.select(F.col("page").alias("main"), F.lit(True).alias("there")), "main", "left").select("page", F.when(F.col("there"), F.col("main")).otherwise(F.lit(home)).alias("target"))


# ---------------------------------------------------------------- page map


def indexable(pages: DataFrame, base: str) -> DataFrame:
    """(path, page_id, ts, html): the latest capture of each path that is a page of its own for search engines."""
    p = pages.where("url is not null and html is not null and trim(html) != ''").select("page_id", url_path(F.col("url")).alias("path"), F.coalesce("ts", F.lit("")).alias("ts"), "html")
    last = p.groupBy("path").agg(F.max(F.struct("ts", "page_id")).alias("m")).select("m.page_id")  # ids only; markup joins last
    head = F.substring("html", 1, HEAD_CHARS)
    canonical = F.regexp_extract(head, CANONICAL, 1)
    keep = ~head.rlike(NOINDEX) & ~head.rlike(REFRESH) & ~F.col("path").rlike(NO_MAP) & head.rlike(r"(?i)<(html|body|table|div|p)\b") & ((canonical == "") | (canonical == F.concat(F.lit(base), F.col("path"))))
    return p.join(last, "page_id", "left_semi").where(keep)


def priority(path: Column) -> Column:
    return (
        F.when(path == "/", "1.0").when(path.rlike(r"^/issues/[^/]+/?$"), "0.8").when(path.rlike(r"^/issues/[^/]+/[^/]+/$"), "0.6")
        .when(path.startswith("/issues/"), "0.4").otherwise("0.3")
    )


def page_map(pages: DataFrame, base: str = "https://www.lampmag.example") -> DataFrame:
    """(loc, lastmod, priority, n_images, xml): the entries of the page map, with each page's pictures in order.

    The pictures carry the page's title as caption, and what stands before its first dash as their title.
    """
    day = F.regexp_extract(F.regexp_replace("ts", "[^0-9]", ""), r"^(\d{8})", 1)
    title = tidy(F.regexp_extract("html", r"(?is)<title>([^<]*)</title>", 1))
    rows = indexable(pages, base).select(
        "path", F.concat(F.lit(base), F.col("path")).alias("loc"), day.alias("day"), title.alias("title"),
        F.slice(F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(IMG), F.lit(1)), unquoted)), 1, MAX_IMAGES).alias("imgs"),
    )
    lastmod = F.when(F.length("day") == 8, F.concat_ws("-", F.substring("day", 1, 4), F.substring("day", 5, 2), F.substring("day", 7, 2)))
    short = F.substring(F.split_part("title", F.lit(" — "), F.lit(1)), 1, 100)
    caption = F.when(F.col("title") == "", "").otherwise(F.concat(F.lit("<image:title>"), escape_html(short), F.lit("</image:title><image:caption>"), escape_html(F.col("title")), F.lit("</image:caption>")))
    images = F.array_join(F.transform("imgs", lambda s: F.concat(F.lit("<image:image><image:loc>"), escape_html(F.concat(F.lit(base), resolve_path(F.col("path"), s))), F.lit("</image:loc>"), caption, F.lit("</image:image>"))), "")
    xml = F.concat(
        F.lit("<url><loc>"), escape_html(F.col("loc")), F.lit("</loc>"), F.coalesce(F.concat(F.lit("<lastmod>"), lastmod, F.lit("</lastmod>")), F.lit("")),
        F.lit("<priority>"), priority(F.col("path")), F.lit("</priority>"), images, F.lit("</url>"),
    )
    return rows.select("loc", lastmod.alias("lastmod"), priority(F.col("path")).alias("priority"), F.size("imgs").alias("n_images"), xml.alias("xml"))


def map_documents(entries: DataFrame, limit: int = MAX_URLS) -> DataFrame:
    """(part, n, document): whole map documents of at most ``limit`` entries, each in order of its addresses.

    An entry's part is a hash of its address, so no task holds more than one document; their number
    follows from the count of entries with a tenth to spare, and an overfull part is an error, not a cut.
    """
    open_, close = '<?xml version="1.0" encoding="UTF-8"?>\n<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">\n', "\n</urlset>\n"
    total = entries.count()  # one number
    parts = 1 if total <= limit else -(-total * 11 // (10 * limit)) + 1
    rows = entries.select("loc", "xml", F.pmod(F.xxhash64("loc"), F.lit(parts)).cast("int").alias("part"))
    g = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("loc", "xml"))), lambda x: x["xml"]), "\n").alias("body"))
    return g.where(F.expr(f"assert_true(n <= {limit}) is null")).select("part", "n", F.concat(F.lit(open_), "body", F.lit(close)).alias("document"))


# ---------------------------------------------------------------- injected blocks


def with_charset(html: Column) -> Column:
    """All charset declarations dropped and one for UTF-8 set after the head's start."""
    bare = F.regexp_replace(html, r"(?i)<meta\s[^>]*charset[^>]*>", "")
    return F.regexp_replace(bare, r"(?i)(<head>)", '$1<meta charset="utf-8">')


def tagged(pages: DataFrame, mark: str = "archive") -> DataFrame:
    """(page_id, html): pages with a language, one charset, a fenced block in the head and a footer link.

    Older blocks of the same mark are taken out first, so running it again changes nothing.
    """
    start, end = f"<!--{mark}-->", f"<!--/{mark}-->"
    h = F.regexp_replace("html", f"(?s){start}.*?{end}", "")
    h = with_charset(h)
    h = F.regexp_replace(h, r"(?i)<html>", '<html lang="en">')
    h = F.regexp_replace(h, r"(?i)(<head>)", f'$1{start}<link rel="icon" href="/icon.png">{end}')
    h = F.regexp_replace(h, r"(?i)(</body>)", f'{start}<p><a href="/about/">about this archive</a></p>{end}$1')
    return pages.where("html is not null").select("page_id", h.alias("html"))


def forwarded(captures: DataFrame) -> DataFrame:
    """(page, forward): front-page addresses whose query has any key that is no campaign tag."""
    rows = M.prepared(captures).where("path = '/'").select("page").distinct()
    keys = F.transform(query_pairs(F.regexp_extract("page", r"\?(.*)$", 1)), lambda p: p["k"])
    return rows.select("page", F.exists(keys, lambda k: ~k.rlike(r"^(utm_[a-z]+|gclid|fbclid)$")).alias("forward"))


def media_types(captures: DataFrame) -> DataFrame:
    """(ext, mime, n, fits): how the declared types of captures agree with the extensions of their paths."""
    known = F.create_map(*[F.lit(x) for kv in TYPES.items() for x in kv])
    rows = M.prepared(captures).select(extension(F.col("path")).alias("ext"), "mime")
    return rows.groupBy("ext", "mime").agg(F.count(F.lit(1)).alias("n")).withColumn("fits", F.coalesce(known[F.col("ext")] == F.col("mime"), F.lit(False)))


# The media type of each extension.
TYPES = {
    "jpg": "image/jpeg", "jpeg": "image/jpeg", "gif": "image/gif", "png": "image/png", "bmp": "image/bmp", "ico": "image/x-icon", "css": "text/css", "html": "text/html",
    "htm": "text/html", "pdf": "application/pdf", "doc": "application/msword", "txt": "text/plain", "js": "application/javascript", "xml": "text/xml",
    "swf": "application/x-shockwave-flash", "mov": "video/quicktime", "mp3": "audio/mpeg", "wav": "audio/wav",
}
