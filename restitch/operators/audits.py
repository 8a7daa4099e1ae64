"""Imports of a server copy, audits of what is published, link checks, and incremental work lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from restitch.functions.text import visible
from restitch.functions.urls import directory, extension
from restitch.operators import manifest as M
from restitch.operators.mirror import TYPES

# Marks of code, addresses, parked domains and spam sites.
SCRIPT_TYPES = ("text/html", "text/css", "application/javascript")
PHP_TAG = r"(?i)<\?(php|=|\s)"
FALSE_ALARMS = ("code inside a file of another kind",)
EMAIL = r"(?i)[\w.+-]+@[\w-]+(?:\.[\w-]+)*\.[a-z]{2,}"
IPV4 = r"\b(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\b"
CODE = r"(?i)(?:eval|assert)\s*\(\s*(?:base64_decode|gzinflate|str_rot13)|hacked\s+by"
PARKED = (
    r"(?i)domain (?:name )?(?:is|may be) for sale|buy this domain|this domain is parked|parked (?:free|domain)|domain parking|related searches|this web page is parked"
    r"|is available for purchase|domain has expired|inquire about this domain"
)
PARK_HOSTS = r"(?i)(?:sedo|hugedomains|afternic|dan\.com|bodis|parkingcrew|above\.com|godaddy|domainmarket|undeveloped|parklogic|namecheap)"
SPAM_SITE = r"(?i)\b(casino|slots?|poker|viagra|cialis|porn|xxx|payday|escort|betting|gambling|sportsbook|baccarat|pharmacy|replica)\b"
BODY_CHARS = 120_000


# ---------------------------------------------------------------- server copy


def server_import(captures: DataFrame) -> DataFrame:
    """(rec_id, path, mime, reason): files of the server copy and why they are not imported; null for those that are.

    Wanted are files that no archive has, or has under another name only, and media whose archived
    copies are all html; of these, hidden paths and unknown extensions are skipped.
    """
    status = M.reconcile(captures)
    html_only = M.html_at_media(captures).select(F.col("page").alias("path"), F.lit(True).alias("html_only"))
    known = F.create_map(*[F.lit(x) for kv in TYPES.items() for x in kv])
    wanted = F.col("status").isin("only on the server", "same content under another name") | (
        (F.col("status") == "archived with different content") & F.coalesce("html_only", F.lit(False))
    )
    mime = known[extension(F.col("path"))]
    reason = (
        F.when(~wanted, "already archived").when(F.col("path").rlike(r"/\."), "hidden path").when(extension(F.col("path")) == "", "no extension")
        .when(mime.isNull(), F.concat(F.lit("unknown ."), extension(F.col("path"))))
    )
    return status.join(html_only, "path", "left").select("rec_id", "path", F.when(reason.isNull(), mime).alias("mime"), reason.alias("reason"))


def import_report(captures: DataFrame) -> DataFrame:
    return server_import(captures).groupBy(F.coalesce("reason", F.lit("imported")).alias("reason")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("path").alias("paths"))


def real_flags(flags: Column, path: Column) -> Column:
    """Strong flags of a file scan without the known false alarms, and without defacement marks in change logs."""
    return F.filter(flags, lambda x: ~x.isin(*FALSE_ALARMS) & ~((x == "defacement marker") & path.endswith("ChangeLog.txt")))


def compared(scan: DataFrame, archive: DataFrame) -> DataFrame:
    """(path, status): scanned files (path, digest, strong) against archived contents (path, digest, chosen).

    An index file also answers for its folder.  Both spellings are exploded, so that one equi-join on the
    path and one on the digest decide; the ordered cascade names the first reason.
    """
    p = F.concat(F.lit("/"), F.regexp_replace("path", "^/+", ""))
    index = F.when(p.rlike(r"/index\.(html?|php)$"), directory(p))
    files = scan.select("path", "digest", p.alias("p"), index.alias("folder"), (F.size(real_flags(F.col("strong"), F.col("path"))) > 0).alias("bad"))
    sides = archive.groupBy("path").agg(F.collect_set("digest").alias("digests"), F.max(F.when(F.col("chosen"), F.col("digest"))).alias("chosen"))  # versions of one path
    spell = files.select("path", "digest", F.explode(F.array_compact(F.array("p", "folder"))).alias("key"))
    met = spell.join(sides.withColumnRenamed("path", "key"), "key").groupBy("path").agg(
        F.max(F.col("digest") == F.col("chosen")).alias("is_chosen"), F.max(F.array_contains("digests", F.col("digest"))).alias("is_known"), F.lit(True).alias("met")
    )
    elsewhere = archive.select("digest").distinct().withColumn("elsewhere", F.lit(True))
    status = (
        F.when(F.col("bad"), "malware (excluded)").when(F.col("is_chosen"), "identical to the rebuilt copy").when(F.col("is_known"), "identical to an archived version")
        .when(F.col("met"), "archived with different content").when(F.col("elsewhere"), "same content under another name").otherwise("only on the server")
    )
    return files.join(met, "path", "left").join(elsewhere, "digest", "left").select("path", status.alias("status"))


# ---------------------------------------------------------------- audits


def findings(comments: DataFrame, private: tuple[str, ...] = ("lampmag.example/private",), allowed: tuple[str, ...] = ()) -> DataFrame:
    """(comment_id, category): what a text must not be published with."""
    t = F.coalesce("text", F.lit(""))
    mails = F.array_except(F.array_distinct(F.transform(F.regexp_extract_all(t, F.lit(f"({EMAIL})"), F.lit(1)), F.lower)), F.array(*[F.lit(a) for a in allowed]).cast("array<string>"))
    hits = F.array_compact(F.array(
        F.when(F.size(mails) > 0, F.lit("email")), F.when(t.rlike(IPV4), F.lit("IPv4")),
        F.when(F.exists(F.array(*[F.lit(x) for x in private]), lambda x: F.contains(t, x)), F.lit("private reference")), F.when(t.rlike(CODE), F.lit("malware")),
    ))
    return comments.where("comment_id is not null").select("comment_id", F.explode(hits).alias("category"))


def findings_report(comments: DataFrame, k: int = 8) -> DataFrame:
    """(category, n, first, more): the first k records of each category and how many more there are.

    The first ones are taken by rank, which is pruned before the shuffle; nothing is collected whole.
    """
    f = findings(comments)
    n = f.groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("category").orderBy("comment_id")
    first = f.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k).groupBy("category").agg(F.array_join(F.transform(F.array_sort(F.collect_list("comment_id")), lambda x: x.cast("string")), ", ").alias("first"))
    return n.join(first, "category").select("category", "n", "first", F.greatest(F.col("n") - k, F.lit(0)).alias("more"))


def subscriber_overlap(comments: DataFrame, subscribers: DataFrame) -> DataFrame:
    """(comment_id, addresses): texts that hold an address of the list (address); the addresses are exploded and semi-joined."""
    a = comments.where("text is not null").select("comment_id", F.explode(F.array_distinct(F.transform(F.regexp_extract_all("text", F.lit(f"({EMAIL})"), F.lit(1)), F.lower))).alias("address"))
    known = subscribers.select(F.lower(F.trim("address")).alias("address")).distinct()
    return a.join(known, "address", "left_semi").groupBy("comment_id").agg(F.count(F.lit(1)).alias("addresses"))


def dump_secrets(lines: DataFrame) -> DataFrame:
    """(kind, value) from configuration and dump lines (value): passwords set, and addresses of the mailing list, plain or in hex."""
    v = F.col("value")
    passwords = lines.select(F.explode(F.regexp_extract_all(v, F.lit(r"\$(?:sql|admin)_password\s*=\s*[\"']([^\"']+)[\"']"), F.lit(1))).alias("value")).select(F.lit("password").alias("kind"), "value")
    rows = lines.where(v.startswith("INSERT INTO `emails` VALUES"))
    plain = rows.select(F.explode(F.regexp_extract_all(v, F.lit(r"'([^']*@[^']*)'"), F.lit(1))).alias("a"))
    hexed = rows.select(F.explode(F.regexp_extract_all(v, F.lit(r"0x([0-9A-Fa-f]+)"), F.lit(1))).alias("h")).select(F.decode(F.unhex("h"), "UTF-8").alias("a")).where("a like '%@%'")
    return passwords.unionByName(plain.union(hexed).select(F.lit("subscriber").alias("kind"), F.lower(F.trim("a")).alias("value"))).distinct()


# ---------------------------------------------------------------- link checks


def link_verdicts(bodies: DataFrame) -> DataFrame:
    """(url, ok, why): answers (url, status, final, body) of link checks; what asks robots to stay away counts as working."""
    body = F.substring(F.coalesce("body", F.lit("")), 1, BODY_CHARS)
    terms = F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(body, F.lit(SPAM_SITE), F.lit(1)), F.lower)))
    host = F.regexp_extract(F.coalesce("final", F.lit("")), r"^[A-Za-z]+://([^/?#:]+)", 1)
    why = (
        F.when(F.col("status").isNull(), "no answer").when(F.col("status").isin(401, 403, 429), F.format_string("HTTP %d (blocks automated checks; assumed working)", "status"))
        .when(F.col("status") >= 400, F.format_string("HTTP %d", "status")).when(host.rlike(PARK_HOSTS) | body.rlike(PARKED), "parked or for-sale domain")
        .when(F.size(terms) >= 3, F.concat(F.lit("now a spam site ("), F.array_join(F.slice(terms, 1, 4), ", "), F.lit(")")))
    )
    ok = why.isNull() | F.coalesce(F.col("status").isin(401, 403, 429), F.lit(False))
    return bodies.select("url", ok.alias("ok"), why.alias("why"))


def checked_comments(comments: DataFrame) -> DataFrame:
    """(why, n): the link rules applied to comment texts as if they were the pages behind the links."""
    rows = comments.where("text is not null").select(F.col("comment_id").cast("string").alias("url"), F.lit(200).alias("status"), F.lit("").alias("final"), visible(F.col("text")).alias("body"))
    return link_verdicts(rows).groupBy(F.coalesce(F.split_part("why", F.lit(" ("), F.lit(1)), F.lit("ok")).alias("why")).agg(F.count(F.lit(1)).alias("n"))


def merged_checks(old: DataFrame, new: DataFrame) -> DataFrame:
    """(url, status, ok, why, retried): stored checks with new ones; an old refusal of robots counts as working, a second time-out is final."""
    blocked = F.col("status").isin(401, 403, 429) & ~F.col("ok")
    kept = old.select("url", "status", (F.col("ok") | F.coalesce(blocked, F.lit(False))).alias("ok"), "why", F.coalesce("retried", F.lit(False)).alias("retried"))
    fresh = new.select("url", "status", "ok", "why").join(old.select("url", F.lit(True).alias("before")), "url", "left").select("url", "status", "ok", "why", F.coalesce("before", F.lit(False)).alias("retried"))
    return fresh.unionByName(kept.join(fresh.select("url"), "url", "left_anti"))


# ---------------------------------------------------------------- incremental work


def stored_resolution(captures: DataFrame) -> DataFrame:
    """(page, n, top): what a resolution of captures rests on: the number of its candidates and its first choice."""
    return M.manifest(captures).groupBy("page").agg(F.count(F.lit(1)).alias("n"), F.max(F.when(F.col("rank") == 1, F.col("digest"))).alias("top"))


def work_list(captures: DataFrame, since: str) -> DataFrame:
    """(page, why): pages to resolve again after captures loaded from ``since`` on: new ones, and those whose candidates changed."""
    before = stored_resolution(captures.where(F.col("loaded_at") < F.lit(since).cast("timestamp")))
    now = stored_resolution(captures)
    why = F.when(F.col("n0").isNull(), "new").when(F.col("top0") != F.col("top"), "other first choice").when(F.col("n0") != F.col("n"), "other candidates")
    return now.join(before.select("page", F.col("n").alias("n0"), F.col("top").alias("top0")), "page", "left").select("page", why.alias("why")).where("why is not null")


def unverified(captures: DataFrame) -> DataFrame:
    """(page, ts, source): fetched records that have no verified copy of the same page and time yet, so are to be fetched again."""
    p = M.prepared(captures).where("ts is not null and source in ('commoncrawl', 'server')")
    done = p.where("verified").select("page", "ts").distinct()
    return p.join(done, ["page", "ts"], "left_anti").select("page", "ts", "source").distinct()


# ---------------------------------------------------------------- listings against what was recovered


def menu_inventory(frames: DataFrame, pages: DataFrame) -> DataFrame:
    """(path, dir, status, last_seen, listings): paths that captured menus list against the pages that were recovered.

    Exact, then without regard to case, then without the extension; a folder counts in part when any recovered
    path lies below it, which the exploded ancestors of all paths answer by one equi-join.
    """
    listed = frames.where("menu is not null").select(F.col("ts"), F.explode(F.array_distinct(F.regexp_extract_all("menu", F.lit(r'(?i)<a\s[^>]*href="(/[^"?#]*)"'), F.lit(1)))).alias("path"))
    seen = listed.groupBy("path").agg(F.max(F.substring("ts", 1, 8)).alias("last_seen"), F.count_distinct(F.substring("ts", 1, 8)).alias("listings"))
    rec = pages.where("url is not null").select(F.regexp_replace(F.regexp_replace("url", r"^(?:[A-Za-z]+:)?//[^/?#]*", ""), r"[?#].*$", "").alias("path")).distinct()
    parts = F.split("path", "/")
    up = F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda i: F.concat(F.array_join(F.slice(parts, 1, i), "/"), F.lit("/")))
    bare = lambda c: F.regexp_replace(c, r"\.[^./]*$", "")
    keys = (
        rec.select(F.col("path").alias("key"), F.lit(0).alias("how"))
        .union(rec.select(F.concat(F.lit("i:"), F.lower("path")), F.lit(1))).union(rec.select(F.concat(F.lit("s:"), bare(F.col("path"))), F.lit(2))).union(rec.select(F.explode(up).alias("u")).select(F.concat(F.lit("d:"), "u"), F.lit(3)))
    ).distinct()
    tries = seen.select("path", F.explode(F.array(F.col("path"), F.concat(F.lit("i:"), F.lower("path")), F.concat(F.lit("s:"), bare(F.col("path"))), F.concat(F.lit("d:"), F.col("path")))).alias("key"))
    best = tries.join(keys, "key").groupBy("path").agg(F.min("how").alias("how"))
    status = F.when(F.col("how").isin(0, 1), "have").when(F.col("how") == 2, "stand-in").when(F.col("how") == 3, "have-part").otherwise("lost")
    return seen.join(best, "path", "left").select("path", F.col("path").endswith("/").alias("dir"), status.alias("status"), "last_seen", "listings")


def inventory_counts(frames: DataFrame, pages: DataFrame) -> DataFrame:
    return menu_inventory(frames, pages).groupBy("dir", "status").agg(F.count(F.lit(1)).alias("n"))
