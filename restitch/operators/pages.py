"""Captured pages: validation, best-first resolution, links, cleaning, audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from restitch.functions.text import squeeze, strip_tags, visible, words
from restitch.functions.urls import is_own_host, url_path
from restitch.operators.mirror import HREF, IMG, unquoted

# Shapes of damaged pages.
HARD = (("defacement", r"(?i)hacked\s+by"), ("parking page", r"(?i)is almost here!|has not yet uploaded their website"))
SOFT = (
    ("php error", r"(?i)<b>(Warning|Fatal error|Parse error|Notice)</b>:"),
    ("mysql error", r"(?i)mysql_\w+\(\)|supplied argument is not a valid MySQL|Can't connect to (local )?MySQL|Access denied for user|Too many connections|Unknown database|Lost connection to MySQL"),
)
LISTING = r"(?i)<title>Index of /"


def _hits(text: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    return F.array_compact(F.array(*[F.when(text.rlike(rx), F.lit(name)) for name, rx in rules]))


def problems(pages: DataFrame) -> DataFrame:
    """(page_id, hard, soft): why a page should not, or only at need, be used; null html is 'missing'."""
    h = F.coalesce("html", F.lit(""))
    hard = F.array_compact(F.concat(_hits(h, HARD), F.array(
        F.when(F.col("html").isNull() | (F.trim(h) == ""), F.lit("missing")), F.when(h.rlike(LISTING) & ~F.coalesce("url", F.lit("")).rlike(r"/(\?.*)?$"), F.lit("directory listing"))
    )))
    return pages.select("page_id", hard.alias("hard"), _hits(h, SOFT).alias("soft"))


def resolution(pages: DataFrame) -> DataFrame:
    """The capture to use of each page: the latest clean one, else the latest with soft problems, else none.

    (article_id, page_path, status, page_id, n, n_rejected): n_rejected captures came before the chosen one.
    """
    p = pages.where("article_id is not null").select("page_id", "article_id", F.coalesce("page_path", F.lit("")).alias("page_path"), "ts").join(problems(pages), "page_id")
    klass = F.when(F.size("hard") > 0, 2).when(F.size("soft") > 0, 1).otherwise(0)
    w = Window.partitionBy("article_id", "page_path").orderBy(F.coalesce("ts", F.lit("")).desc(), "page_id")
    ranked = p.withColumn("pos", F.row_number().over(w)).withColumn("klass", klass)
    best = ranked.groupBy("article_id", "page_path").agg(F.min(F.struct("klass", "pos", "page_id")).alias("b"), F.count(F.lit(1)).alias("n"))
    status = F.when(F.col("b.klass") == 0, "clean").when(F.col("b.klass") == 1, "soft").otherwise("failed")
    return best.select(
        "article_id", "page_path", status.alias("status"), F.when(F.col("b.klass") < 2, F.col("b.page_id")).alias("page_id"), "n",
        F.when(F.col("b.klass") < 2, F.col("b.pos") - 1).otherwise(F.col("n")).alias("n_rejected"),
    )


def links(pages: DataFrame) -> DataFrame:
    """(page_id, href, kind) of every link, however its address is quoted."""
    hrefs = F.transform(F.regexp_extract_all(F.col("html"), F.lit(HREF), F.lit(1)), unquoted)
    rows = pages.where("html is not null").select("page_id", F.explode(hrefs).alias("href"))
    kind = (
        F.when(F.col("href") == "", "empty").when(F.col("href").startswith("#"), "fragment").when(F.col("href").rlike(r"(?i)^mailto:"), "mail")
        .when(F.col("href").rlike(r"(?i)^javascript:"), "script").when(F.col("href").rlike(r"(?i)^(https?:)?//"), "external").otherwise("internal")
    )
    return rows.withColumn("kind", kind)


def link_kinds(pages: DataFrame) -> DataFrame:
    return links(pages).groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("page_id").alias("pages"), F.count_distinct("href").alias("targets"))


def external_hosts(pages: DataFrame, own: str = "lampmag.example") -> DataFrame:
    """(host, n, pages) of links that leave the site."""
    ext = links(pages).where("kind = 'external'").where(~is_own_host(F.col("href"), own))
    host = F.lower(F.regexp_extract("href", r"^(?:[A-Za-z]+:)?//([^/?#:]+)", 1))
    return ext.groupBy(host.alias("host")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("page_id").alias("pages"))


def missing_targets(pages: DataFrame, k: int = 10) -> DataFrame:
    """(target, n, referrers): internal folder links that no captured page answers, with the first k referrers.

    A reference is tried as it is, then with a slash, then in lower case; the tries are exploded
    and met by one equi-join.
    """
    known = pages.where("url is not null").select(F.lower(url_path(F.col("url"))).alias("path")).distinct()
    folders = known.select(F.regexp_extract("path", r"^(.*/)[^/]*$", 1).alias("path")).distinct()
    have = known.union(folders).distinct().withColumn("have", F.lit(True))
    refs = links(pages).where("kind = 'internal'").select("page_id", F.regexp_replace("href", r"[?#].*$", "").alias("target")).where("target != ''").distinct()
    targets = refs.select("target").distinct()
    tries = targets.select("target", F.explode(F.array_distinct(F.array(F.lower("target"), F.concat(F.lower("target"), F.lit("/"))))).alias("path"))
    found = tries.join(have, "path").select("target").distinct()
    lost = refs.join(found, "target", "left_anti")  # distinct page and target
    n = lost.groupBy("target").agg(F.count(F.lit(1)).alias("n"))
    # the first k are taken by rank, which is pruned before the shuffle: a target of every page collects k ids, not all
    w = Window.partitionBy("target").orderBy("page_id")
    first = lost.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k).groupBy("target").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("page_id")), lambda x: x.cast("string")), " ").alias("referrers")
    )
    return n.join(first, "target").select("target", "n", "referrers")


def missing_by_section(pages: DataFrame, k: int = 15) -> DataFrame:
    m = missing_targets(pages).groupBy(F.regexp_extract("target", r"^/?([^/]*)", 1).alias("section")).agg(F.count(F.lit(1)).alias("targets"), F.sum("n").alias("links"))
    return m.orderBy(F.desc("targets"), "section").limit(k)


# Elements that a cleaned page loses, and what must stand in them.
SCRIPT = r"(?is)<script\b[^>]*>.*?</script\s*>"
FORM = r"(?is)<form\b[^>]*>.*?</form\s*>"
ANCHOR = r"(?is)<a\b[^>]*>.*?</a\s*>"
TRACKER = (
    r"(?is)googlesyndication\.com|google_ad_client|google-analytics\.com|_gat\._getTracker|urchinTracker|gaJsHost|pageTracker\.|advertising\.com|<SCR'\s*\+\s*'IPT"
    r"|document\.write\s*\(\s*['\"]<\s*scr|^<script\b[^>]*\bsrc\s*=\s*[\"']?\s*(https?:)?//|adserver/"
)
#: (counter, elements, what an element must hold, what is left of it): in this order.
CLEANING = (
    ("scripts", SCRIPT, TRACKER, ""),
    ("shop_links", ANCHOR, r"(?is)^<a\b[^>]*\b(cafepress|cafeshops)\.", "$1"),
    ("comment_forms", FORM, r"(?is)post a comment|name\s*=\s*[\"']?comment\b", ""),
    ("newsletter_boxes", r"(?is)<div\b[^>]*\bid\s*=\s*[\"']?email_submit\d*[^>]*>.*?</div\s*>", r"", ""),
    ("newsletter_forms", FORM, r"(?is)newsletter|join the list|name\s*=\s*[\"']?em(ail)?\b", ""),
    ("php_errors", r"(?i)(?:<br\s*/?>\s*)?<b>\s*(?:Warning|Fatal error|Parse error|Notice|Deprecated)\s*</b>\s*:[^\n]*?on line\s*<b>\s*\d+\s*</b>(?:\s*<br\s*/?>)?", r"", ""),
    ("offsite_images", r"(?is)<img\b[^>]*\bsrc\s*=\s*[\"']?\s*(?:https?:)?//[^>]*>", r"", ""),
    ("hidden_links", ANCHOR, r"(?is)^<a\b[^>]*\bstyle\s*=\s*[\"'][^\"']*display\s*:\s*none", ""),
    ("linked_comments", r"(?s)<!--.*?-->", r"(?is)<a\s", ""),
    ("ad_links", ANCHOR, r"(?is)^<a\b[^>]*(adserver|adclick)", ""),
    ("ad_boxes", r"(?is)<div\b[^>]*id\s*=\s*[\"']?beacon_\d+[^>]*>.*?</div>|<noscript>.*?</noscript>|<iframe\b[^>]*>.*?</iframe>|<img\b[^>]*>", r"(?is)beacon_|adserver", ""),
)
OWN = r"(?i)src\s*=\s*[\"']?\s*(https?:)?//(www\.)?lampmag\.example"


def _without(d: DataFrame, name: str, element: str, holds: str, left: str) -> DataFrame:
    """d (h, ...) without the elements that hold a mark, but for those of the own host; counts them as ``name``.

    The elements are few and are folded over the markup, so a condition on an element needs no look-around.
    """

    def step(h: Column, x: Column) -> Column:
        return F.replace(h, x, F.regexp_replace(x, r"(?is)^<a\b[^>]*>(.*)</a\s*>$", "$1") if left else F.lit(""))

    hit = F.filter(F.regexp_extract_all("h", F.lit(f"({element})"), F.lit(1)), lambda x: x.rlike(holds) & ~x.rlike(OWN))
    return d.withColumn("hit", hit).withColumn("h", F.aggregate(F.array_distinct("hit"), F.col("h"), step)).withColumn(name, F.size("hit")).drop("hit")


def cleaned(pages: DataFrame) -> DataFrame:
    """(page_id, the number of elements taken out by each step, n_chars); each step reads what the one before it left.

    Each step is a projection of its own over the one before, as its expression reads the markup three times.
    """
    d = pages.where("html is not null").select("page_id", F.col("html").alias("h"))
    for name, element, holds, left in CLEANING:
        d = _without(d, name, element, holds, left)
    return d.select("page_id", *[name for name, *_ in CLEANING], F.length("h").alias("n_chars"))


# Marks of injected code.
SECURITY = (
    ("script", r"(?i)<script\b"), ("iframe", r"(?i)<iframe\b"), ("handler", r"(?i)\son\w+\s*="), ("eval", r"(?i)\beval\s*\("), ("unescape", r"(?i)document\.write\s*\(\s*unescape"),
    ("fromCharCode", r"(?i)String\.fromCharCode"), ("document.write", r"(?i)d(?:ocument)?\.write\s*\("), ("php", r"<\?php"),
)


def security_hits(pages: DataFrame, around: int = 160) -> DataFrame:
    """(label, hits, pages, sample): marks of injected code per label, with the text at the first hit of the first page.

    A script that only hides addresses from harvesters is no hit.
    """
    h = F.regexp_replace("html", r"(?is)<script\b[^>]*>[^<]*hiveware_enkoder.*?</script\s*>", "")
    rows = pages.where("html is not null").select("page_id", h.alias("h")).select("page_id", F.explode(F.array(*[
        F.struct(F.lit(n).alias("label"), F.regexp_count("h", F.lit(rx)).alias("k"), F.regexp_extract("h", f"({rx}[^\\n]{{0,{around}}})", 1).alias("at")) for n, rx in SECURITY
    ])).alias("x")).where("x.k > 0")
    return rows.groupBy("x.label").agg(F.sum("x.k").alias("hits"), F.count_distinct("page_id").alias("pages"), F.min_by("x.at", "page_id").alias("sample"))


def first_copies(pages: DataFrame) -> DataFrame:
    """(page_id, canonical): the first page with the same markup, white space aside; null for the first itself.

    The markup is compared by its digest, and the first of each is an aggregate, so copies of a page by the million are no hot group.
    """
    p = pages.where("html is not null and trim(html) != ''").select("page_id", F.sha2(squeeze(F.col("html")), 256).alias("key"), F.struct(F.coalesce("article_id", F.lit(1 << 60)).alias("a"), F.col("page_id").alias("p")).alias("ord"))
    first = p.groupBy("key").agg(F.min("ord").alias("first"))
    return p.join(first, "key").select("page_id", F.when(F.col("first.p") != F.col("page_id"), F.col("first.p")).alias("canonical"))


def page_images(pages: DataFrame) -> DataFrame:
    """(article_id, src, photo, photos): the pictures of an article numbered by first appearance."""
    rows = pages.where("html is not null and article_id is not null").select(
        "article_id", "page_id", F.posexplode(F.transform(F.regexp_extract_all("html", F.lit(IMG), F.lit(1)), unquoted)).alias("pos", "src")
    ).where("src != ''")
    first = rows.groupBy("article_id", "src").agg(F.min(F.struct("page_id", "pos")).alias("at"))
    w = Window.partitionBy("article_id")
    return first.select("article_id", "src", F.dense_rank().over(w.orderBy("at")).cast("int").alias("photo"), F.count(F.lit(1)).over(w).alias("photos"))


# Grammar of bylines.
BYLINES = (
    ("words", r"(?i)^words: ([a-z][a-z.'\- ]{1,40})$"), ("photos and text", r"(?i)^photos and text by ([a-z][a-z.'\- ]{1,40})$"),
    ("by", r"(?i)^by ([a-z][a-z.'\- ]{1,40})$"), ("reports", r"(?i)^([a-z][a-z.'\- ]{1,40}) reports$"),
)


def credits(pages: DataFrame) -> DataFrame:
    """(article_id, role, name): the distinct credits of each article."""
    lines = pages.where("html is not null and article_id is not null").select("article_id", F.explode(F.split("html", "\n")).alias("line"))
    text = lines.select("article_id", squeeze(strip_tags(F.col("line"))).alias("t")).where(F.length("t").between(4, 60))
    picks = F.array(*[F.struct(F.lit(role).alias("role"), F.lower(F.regexp_extract("t", rx, 1)).alias("name")) for role, rx in BYLINES])
    return text.select("article_id", F.explode(F.filter(picks, lambda x: (x["name"] != "") & (F.size(F.split(x["name"], " ")) <= 4))).alias("c")).select("article_id", "c.role", "c.name").distinct()


def contributors(pages: DataFrame, articles: DataFrame, own_page: int = 3) -> DataFrame:
    """(name, works, roles, first_issue, last_issue, page): whether a contributor has enough works for a page."""
    issue = articles.groupBy(F.col("id").cast("bigint").alias("article_id")).agg(F.min("issue").alias("issue"))
    c = credits(pages).join(issue, "article_id", "left")
    return c.groupBy("name").agg(
        F.count_distinct("article_id").alias("works"), F.array_join(F.array_sort(F.collect_set("role")), ", ").alias("roles"), F.min("issue").alias("first_issue"), F.max("issue").alias("last_issue")
    ).withColumn("page", F.col("works") >= own_page)


# Word families of the content review.
REVIEW = {
    "sexual": r"(?i)\b(?:nude|nudity|naked|topless|porn\w*|strippers?|strip clubs?|burlesque|fetish\w*|bondage|escorts?|hookers?|prostitut\w+|sex|sexual\w*|erotic\w*|penis|vaginal?|breasts?|boobs?|tits|thongs?|masturbat\w+|orgasm\w*|suicide ?girls?|playboy|lap ?dances?)\b",
    "strong": r"(?i)\b(?:fuck\w*|motherf\w*|cunts?|cocks?|cocksuck\w*|pussy|twats?|sluts?|whores?)\b",
    "mild": r"(?i)\b(?:shit\w*|bitch\w*|assholes?|dicks?|bastards?|damn\w*)\b",
    "slur": r"(?i)\b(?:fag\w*|retard\w*|nigg\w*|midgets?|trann\w*|spics?)\b",
}
WORST = r"(?i)\bcunts?\b"


def review_texts(pages: DataFrame, comments: DataFrame) -> DataFrame:
    """(article_id, kind, id, t): the visible texts of an article: its pages, and its comments with subject and name."""
    p = pages.where("article_id is not null and html is not null").select("article_id", F.lit("page").alias("kind"), F.col("page_id").alias("id"), visible(F.concat_ws(" ", "html", "tail")).alias("t"))
    c = comments.where("article_id is not null").select("article_id", F.lit("comment").alias("kind"), F.col("comment_id").alias("id"), visible(F.concat_ws(" ", "subject", "name", "text")).alias("t"))
    return p.unionByName(c)


def review(pages: DataFrame, comments: DataFrame) -> DataFrame:
    """(article_id, n_words, sexual, strong, mild, slur, tier): hits in an article's texts and the tier of their rate per 1000 words.

    A slur or the worst word excludes at once, else 3 strong or 4 sexual words a thousand do.
    """
    t = F.col("t")
    per = review_texts(pages, comments).select("article_id", words(t).alias("w"), t.rlike(WORST).alias("worst"), *[F.regexp_count(t, F.lit(rx)).alias(k) for k, rx in REVIEW.items()])
    s = per.groupBy("article_id").agg(F.sum("w").alias("n_words"), *[F.sum(k).alias(k) for k in REVIEW], F.bool_or("worst").alias("worst"))
    rate = lambda k: F.col(k) * 1000 / F.greatest("n_words", F.lit(1))
    tier = (
        F.when((F.col("slur") > 0) | F.col("worst") | (rate("strong") >= 3) | (rate("sexual") >= 4), "exclude").when((F.col("sexual") > 0) | (F.col("strong") > 0), "review").otherwise("ok")
    )
    return s.withColumn("tier", tier).drop("worst")


def review_order(reviewed: DataFrame) -> DataFrame:
    """(article_id, tier, weight, nr): the articles to look at, worst tier first, then by weighted hits."""
    weight = F.col("sexual") + F.col("strong") + 3 * F.col("slur")
    klass = F.when(F.col("tier") == "exclude", 0).when(F.col("tier") == "review", 1).otherwise(2)
    w = Window.partitionBy("tier").orderBy(weight.desc(), "article_id")
    return reviewed.select("article_id", "tier", weight.alias("weight"), F.row_number().over(w).alias("nr")).orderBy(klass, "nr")


def snippets(pages: DataFrame, comments: DataFrame, k: int = 8, around: int = 60) -> DataFrame:
    """(article_id, nr, category, snippet): the first k hits of an article with the text around them; mild ones are left out.

    Every hit of every text is a candidate, in the order of pages before comments, then id, category and place.
    """
    base = review_texts(pages, comments)
    rows = None
    for i, name in enumerate(("sexual", "strong", "slur")):
        hits = F.regexp_extract_all("t", F.lit(rf"(.{{0,{around}}}{REVIEW[name]}.{{0,{around}}})"), F.lit(1))
        one = base.where(F.col("t").rlike(REVIEW[name])).select("article_id", "kind", "id", F.lit(i).alias("c"), F.lit(name).alias("category"), F.posexplode(hits).alias("pos", "snippet"))
        rows = one if rows is None else rows.union(one)
    w = Window.partitionBy("article_id").orderBy(F.desc("kind"), "id", "c", "pos")
    return rows.withColumn("nr", F.row_number().over(w)).where(F.col("nr") <= k).select("article_id", "nr", "category", F.trim("snippet").alias("snippet"))
