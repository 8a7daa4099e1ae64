"""Captures of all archives to ranked candidates per page.

Every step is a window or an aggregate on the page or the digest.  Sources are one bag;
the pages are ranked by whether a candidate is a fallback page in disguise, then by time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from restitch.functions.captures import digest32, source_key, time14
from restitch.functions.urls import extension, listing_sort, page_identity, url_path
from restitch.session import spread, written

# Fixed values.
CUTOFF = "20150731999999"
HOME_PAGES = ("/", "/main.php", "/index.php", "/index.php?leave=1")
SKIP_PATH = r"^/(phpad/|robots\.txt$|favicon\.(ico|gif)$)"
MEDIA = ("jpg", "jpeg", "gif", "png", "bmp", "ico", "swf", "pdf", "doc", "css", "js")
SHARED_BY = 3
#: Sources whose records count only when their content was verified against its digest.
FETCHED = ("commoncrawl", "server")


def prepared(captures: DataFrame) -> DataFrame:
    """(rec_id, page, path, ts, digest, mime, status, bytes, source, url, verified) in normal form."""
    # parsing is CPU-bound: a table in one file must not run in one task; a large one is left as it is split
    rows = spread(captures.where("url is not null").select("rec_id", "url", "ts", "digest", "mime", "status", "bytes", "source", "verified"), "rec_id", per_core=1)
    return rows.select(
        "rec_id", page_identity(F.col("url")).alias("page"), url_path(F.col("url")).alias("path"), time14(F.col("ts")).alias("ts"),
        digest32(F.col("digest")).alias("digest"), F.lower(F.trim(F.regexp_replace(F.coalesce("mime", F.lit("unk")), ";.*$", ""))).alias("mime"),
        "status", "bytes", source_key(F.col("source")).alias("source"), "url", "verified",
    )


def skip_reason(p: DataFrame) -> DataFrame:
    """Adds why a capture is no candidate; null for candidates.  The first reason wins."""
    reason = (
        F.when(F.coalesce("status", F.lit("200")) != "200", "status").when(F.col("ts").isNull(), "time").when(F.col("digest").isNull(), "digest")
        .when(F.col("ts") > CUTOFF, "late").when(F.col("mime") == "warc/revisit", "revisit").when(F.col("path").rlike(SKIP_PATH), "path")
        .when(listing_sort(F.col("url")), "listing sort")
        .when(F.col("source").isin(*FETCHED) & ~F.coalesce("verified", F.lit(False)), "unverified")
    )
    return p.withColumn("reason", reason)


def candidates(captures: DataFrame, parsed: DataFrame | None = None) -> DataFrame:
    """Captures that may be published; files of the server copy only fill pages that no archive has.

    The captures are parsed once into a table, as a filter on parsed columns would parse them again;
    a caller that has parsed them already hands the table in.
    """
    kept = skip_reason(written(prepared(captures)) if parsed is None else parsed).where("reason is null").drop("reason")
    real = (F.coalesce("source", F.lit("")) != "server") & ~(
        extension(F.regexp_extract("page", r"^([^?]*)", 1)).isin(*MEDIA) & F.col("mime").startswith("text/html")
    )
    server = F.coalesce("source", F.lit("")) == "server"
    # an anti-join of the few server rows instead of a window over all captures of a page
    return kept.where(~server).unionByName(kept.where(server).join(kept.where(real).select("page").distinct(), "page", "left_anti"))


def latest_per_digest(cands: DataFrame) -> DataFrame:
    """One row per page and digest: the latest capture, the smallest record id on a tie.

    An aggregate with map-side combine, so a front page with a tenth of all captures is no hot window.
    """
    top = F.max(F.struct("ts", (-F.col("rec_id")).alias("neg"), "url", "mime", "bytes", "source"))
    return (
        cands.groupBy("page", "digest").agg(top.alias("t"), F.count(F.lit(1)).alias("n_captures"))
        .select("page", "digest", "t.ts", (-F.col("t.neg")).alias("rec_id"), "t.url", "t.mime", "t.bytes", "t.source", "n_captures")
    )


def owners(cands: DataFrame) -> DataFrame:
    """(digest, n_pages): by how many pages a content is shared."""
    return cands.groupBy("digest").agg(F.count_distinct("page").alias("n_pages"))


def manifest(captures: DataFrame, parsed: DataFrame | None = None) -> DataFrame:
    """(page, kind, rank, demoted, ts, digest, mime, rec_id, n_captures): candidates in the order to try them.

    A page with any capture that is no html keeps only those.  An html candidate is a fallback,
    and demoted, when a home page has the same content or at least SHARED_BY pages do.
    """
    uniq = latest_per_digest(candidates(captures, parsed))
    html = F.col("mime").startswith("text/html")
    # one row per page and digest, so pages are counted without a distinct; both flags of a digest in one aggregate
    fallback = uniq.groupBy("digest").agg(F.count(F.lit(1)).alias("n_pages"), F.bool_or(F.col("page").isin(*HOME_PAGES)).alias("home"))
    fallback = fallback.where((F.col("n_pages") >= SHARED_BY) | F.col("home")).select("digest", F.lit(True).alias("fallback"))
    media = uniq.where(~html).select("page").distinct().withColumn("media", F.lit(True))
    kept = uniq.join(media, "page", "left").where(~html | F.col("media").isNull()).withColumn("kind", F.when(html, "html").otherwise("asset"))
    demoted = (F.col("kind") == "html") & ~F.col("page").isin(*HOME_PAGES) & F.coalesce("fallback", F.lit(False))
    order = Window.partitionBy("page").orderBy("demoted", F.col("ts").desc(), "rec_id")
    return (
        kept.join(fallback, "digest", "left").withColumn("demoted", demoted)
        .withColumn("rank", F.row_number().over(order))
        .select("page", "kind", "rank", "demoted", "ts", "digest", "mime", "rec_id", "n_captures")
    )


def manifest_stats(captures: DataFrame) -> DataFrame:
    """One row per kind: pages, candidates, fallback statistics."""
    m = manifest(captures)
    per = m.groupBy("page", "kind").agg(
        F.count(F.lit(1)).alias("n"), F.max_by("demoted", F.struct("ts", (-F.col("rec_id")).alias("r"))).alias("latest_demoted"), F.bool_and("demoted").alias("all_demoted")
    )
    return per.groupBy("kind").agg(
        F.count(F.lit(1)).alias("pages"), F.sum("n").alias("candidates"),
        F.count_if(F.col("latest_demoted") & ~F.col("all_demoted")).alias("latest_avoided"), F.count_if("all_demoted").alias("only_fallback"),
    )


def first_choice_years(captures: DataFrame) -> DataFrame:
    return manifest(captures).where("rank = 1").groupBy(F.substring("ts", 1, 4).alias("year"), "kind").agg(F.count(F.lit(1)).alias("n"))


def versions(captures: DataFrame) -> DataFrame:
    """Genuine versions of pages with at least two: (page, ts, digest, version, versions, previous, next)."""
    m = manifest(captures).where("not demoted")
    w = Window.partitionBy("page").orderBy("ts", "rec_id")
    n = F.count(F.lit(1)).over(Window.partitionBy("page"))
    return m.select(
        "page", "ts", "digest", F.row_number().over(w).alias("version"), n.alias("versions"), F.lag("ts").over(w).alias("previous"), F.lead("ts").over(w).alias("next")
    ).where("versions >= 2")


def canonical_pages(captures: DataFrame) -> DataFrame:
    """(path, canonical, spellings): of all identities of a path the one with the fewest parameters, then the shortest."""
    ids = candidates(captures).select("page").distinct()
    q = F.regexp_extract("page", r"\?(.*)$", 1)
    return ids.groupBy(F.regexp_extract("page", r"^([^?]*)", 1).alias("path")).agg(
        F.min(F.struct(F.when(q == "", 0).otherwise(F.size(F.split(q, "&"))).alias("a"), F.length("page").alias("b"), "page")).alias("m"),
        F.count(F.lit(1)).alias("spellings"),
    ).select("path", F.col("m.page").alias("canonical"), "spellings")


def skip_report(captures: DataFrame) -> DataFrame:
    return skip_reason(prepared(captures)).groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("page").alias("pages"))


def html_at_media(captures: DataFrame) -> DataFrame:
    """Media pages whose archived captures are all html: (page, n)."""
    p = prepared(captures).where(extension(F.regexp_extract("page", r"^([^?]*)", 1)).isin(*MEDIA) & (F.coalesce("source", F.lit("")) != "server"))
    return p.groupBy("page").agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.col("mime").startswith("text/html")).alias("every")).where("every").select("page", "n")


def reconcile(captures: DataFrame) -> DataFrame:
    """(rec_id, path, status): files of the server copy against what the archives have."""
    parsed = written(prepared(captures))
    p = parsed.where("digest is not null and page not like '%?%'")
    server = p.where("source = 'server'").select("rec_id", F.col("page").alias("path"), "digest")
    archive = p.where("coalesce(source, '') != 'server'")
    chosen = manifest(captures, parsed).where("rank = 1").select(F.col("page").alias("path"), F.col("digest").alias("chosen"))
    by_path = archive.groupBy(F.col("page").alias("path"), "digest").agg(F.lit(True).alias("same"))
    paths = archive.select(F.col("page").alias("path")).distinct().withColumn("known", F.lit(True))
    elsewhere = archive.select("digest").distinct().withColumn("elsewhere", F.lit(True))
    status = (
        F.when(F.col("digest") == F.col("chosen"), "identical to the chosen copy").when(F.col("same"), "identical to an archived version")
        .when(F.col("known"), "archived with different content").when(F.col("elsewhere"), "same content under another name").otherwise("only on the server")
    )
    return (
        server.join(chosen, "path", "left").join(by_path, ["path", "digest"], "left").join(paths, "path", "left").join(elsewhere, "digest", "left")
        .select("rec_id", "path", status.alias("status"))
    )


def reconcile_counts(captures: DataFrame, k: int = 5) -> DataFrame:
    """The k most frequent extensions of each status: (status, ext, n, rank)."""
    n = reconcile(captures).groupBy("status", extension(F.col("path")).alias("ext")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("status").orderBy(F.desc("n"), "ext")
    return n.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def archived_only(captures: DataFrame) -> DataFrame:
    """Paths that archives have and the server copy has neither as a file nor as a folder."""
    p = prepared(captures).where("page not like '%?%' and page not like '%/'").select(F.col("page").alias("path"), "source")
    server = p.where("source = 'server'").select("path").distinct()
    folders = server.select(F.regexp_extract("path", r"^(.*/)", 1).alias("path")).distinct()
    return p.where("coalesce(source, '') != 'server'").select("path").distinct().join(server.union(folders), "path", "left_anti")


def folders_with_parts(captures: DataFrame) -> DataFrame:
    """(folder, n): folders that hold a recovered file at any depth.  Ancestors are exploded: no range join."""
    p = candidates(captures).select(F.regexp_extract("page", r"^([^?]*)", 1).alias("path")).distinct()
    parts = F.split("path", "/")
    depth = F.size(parts)
    up = F.transform(F.sequence(F.lit(1), F.greatest(depth - 1, F.lit(1))), lambda i: F.concat(F.array_join(F.slice(parts, 1, i), "/"), F.lit("/")))
    return p.select(F.explode(up).alias("folder")).groupBy("folder").agg(F.count(F.lit(1)).alias("n"))
