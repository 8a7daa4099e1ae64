"""All queries of the core over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from restitch.functions.text import tidy
from restitch.operators import audits, catalog, comments, editorial, malware, manifest, mirror, pages, publish, site
from restitch.plans import sql, sql_more
from restitch.session import table

Query = Callable[[SparkSession, str], DataFrame]


def _over(f: Callable[..., DataFrame], *names: str) -> Query:
    return lambda spark, d: f(*(table(spark, d, n) for n in names))


def _title_check(p: DataFrame) -> DataFrame:
    t = tidy(F.regexp_extract("html", r"(?is)<title>([^<]*)</title>", 1))
    return p.where("html is not null").select(t.alias("t")).where("t != ''").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("t").alias("titles"))


def _contributor_pages(p: DataFrame, a: DataFrame) -> DataFrame:
    names = catalog.articles_once(a).select(F.col("id").cast("bigint").alias("article_id"), "issue", "title")
    return editorial.contributor_pages(pages.credits(p), names)


def queries() -> dict[str, Query]:
    return {
        "manifest": _over(manifest.manifest, "captures"),
        "manifest_stats": _over(manifest.manifest_stats, "captures"),
        "first_choice_years": _over(manifest.first_choice_years, "captures"),
        "digest_owners": _over(lambda c: manifest.owners(manifest.candidates(c)).where("n_pages >= 2"), "captures"),
        "versions": _over(manifest.versions, "captures"),
        "canonical_pages": _over(manifest.canonical_pages, "captures"),
        "skip_report": _over(manifest.skip_report, "captures"),
        "html_at_media": _over(manifest.html_at_media, "captures"),
        "reconcile": _over(manifest.reconcile, "captures"),
        "reconcile_counts": _over(manifest.reconcile_counts, "captures"),
        "archived_only": _over(manifest.archived_only, "captures"),
        "folders_with_parts": _over(manifest.folders_with_parts, "captures"),
        "page_problems": _over(lambda p: pages.problems(p).select("page_id", F.array_join("hard", ", ").alias("hard"), F.array_join("soft", ", ").alias("soft")), "pages"),
        "resolution": _over(pages.resolution, "pages"),
        "link_kinds": _over(pages.link_kinds, "pages"),
        "external_hosts": _over(pages.external_hosts, "pages"),
        "missing_targets": _over(pages.missing_targets, "pages"),
        "missing_by_section": _over(pages.missing_by_section, "pages"),
        "cleaned": _over(pages.cleaned, "pages"),
        "security_hits": _over(pages.security_hits, "pages"),
        "first_copies": _over(pages.first_copies, "pages"),
        "page_images": _over(pages.page_images, "pages"),
        "credits": _over(pages.credits, "pages"),
        "contributors": _over(pages.contributors, "pages", "articles"),
        "review": _over(pages.review, "pages", "comments"),
        "review_order": _over(lambda p, c: pages.review_order(pages.review(p, c)), "pages", "comments"),
        "snippets": _over(pages.snippets, "pages", "comments"),
        "malware_scan": _over(malware.scan_pages, "pages"),
        "malware_labels": _over(malware.scan_labels, "pages"),
        "comment_spam": _over(comments.classified, "comments"),
        "spam_counts": _over(comments.spam_counts, "comments"),
        "scrubbed": _over(comments.scrubbed, "comments"),
        "threads": _over(comments.threads, "comments"),
        "local_days": _over(comments.local_days, "comments"),
        "email_findings": _over(comments.email_findings, "comments"),
        "articles_once": _over(catalog.articles_once, "articles"),
        "catalog": _over(catalog.catalog, "articles", "issues"),
        "folders_seen": _over(catalog.folders_seen, "pages"),
        "variants": _over(catalog.variants, "pages"),
        "slugs": _over(catalog.slugs, "articles"),
        "unique_titles": _over(editorial.numbered_titles, "pages"),
        "unique_titles_check": _over(_title_check, "pages"),
        "descriptions": _over(catalog.descriptions, "articles"),
        "issue_contents": _over(catalog.issue_contents, "articles", "issues"),
        "sitemap": _over(catalog.sitemap, "pages"),
        "output_paths": _over(lambda c: publish.output_paths(manifest.manifest(c).where("rank = 1").select("page", "kind")), "captures"),
        "page_references": _over(lambda p: publish.page_references(p).groupBy("ref").agg(F.count(F.lit(1)).alias("pages")), "pages"),
        "redirects": _over(publish.redirects, "pages"),
        "article_records": _over(lambda a: publish.article_records(catalog.articles_once(a), "https://www.lampmag.example"), "articles"),
        "event_views": _over(catalog.event_views, "events"),
        "frame_issues": _over(catalog.frame_issues, "frames", "issues"),
        "issue_colors": _over(catalog.canonical_colors, "issues"),
        "internal_pages": _over(site.internal, "pages"),
        "page_sources": _over(site.page_sources, "captures"),
        "stand_ins": _over(site.stand_ins, "captures", "pages"),
        "preview_cards": _over(site.preview_cards, "pages"),
        "contact_sheet": _over(site.contact_sheet, "pages", "comments"),
        "cover_links": _over(site.cover_links, "frames", "articles", "pages"),
        "title_places": _over(site.page_titles_parsed, "pages"),
        "link_report": _over(mirror.link_report, "pages"),
        "relative_links": _over(lambda p: mirror.page_links(p).where("known").groupBy("ref", "path", "rel").agg(F.count(F.lit(1)).alias("n")), "pages"),
        "relinked": _over(mirror.relinked, "pages"),
        "routes": _over(mirror.routes, "captures", "pages", "issues"),
        "published_variants": _over(mirror.published_variants, "captures"),
        "year_index": _over(mirror.year_index, "captures"),
        "history_pages": _over(mirror.history_pages, "captures"),
        "root_aliases": _over(mirror.root_aliases, "captures"),
        "page_map": _over(mirror.page_map, "pages"),
        "map_documents": _over(lambda p: mirror.map_documents(mirror.page_map(p)), "pages"),
        "tagged": _over(mirror.tagged, "pages"),
        "forwarded": _over(mirror.forwarded, "captures"),
        "media_types": _over(mirror.media_types, "captures"),
        "server_import": _over(audits.server_import, "captures"),
        "import_report": _over(audits.import_report, "captures"),
        "findings": _over(audits.findings_report, "comments"),
        "checked_comments": _over(audits.checked_comments, "comments"),
        "work_list": _over(lambda c: audits.work_list(c, "2012-01-01"), "captures"),
        "unverified": _over(audits.unverified, "captures"),
        "menu_inventory": _over(audits.menu_inventory, "frames", "pages"),
        "menu_titles": _over(editorial.menu_titles, "frames"),
        "display_names": _over(editorial.display_names, "articles", "frames"),
        "issue_records": _over(editorial.issue_records, "articles", "issues", "frames"),
        "packed_titles": _over(editorial.packed_titles, "articles"),
        "page_texts": _over(editorial.page_texts, "pages"),
        "bylines": _over(editorial.byline_rows, "pages"),
        "credit_lines": _over(lambda p: editorial.credit_lines(pages.credits(p)), "pages"),
        "contributor_pages": _over(_contributor_pages, "pages", "articles"),
        "people": _over(lambda p: editorial.surname_order(pages.credits(p)), "pages"),
        "page_descriptions": _over(lambda p, a: editorial.page_descriptions(p, a, pages.credits(p)), "pages", "articles"),
        "lead_pictures": _over(editorial.lead_pictures, "pages", "articles"),
        "photo_canonicals": _over(editorial.photo_canonicals, "pages"),
        "galleries": _over(editorial.galleries, "pages"),
        "missing_views": _over(editorial.missing_views, "pages"),
        "visible_pages": _over(editorial.visible_pages, "pages"),
        "picture_texts": _over(lambda p, a: editorial.picture_texts(p, a, pages.credits(p)), "pages", "articles"),
    }


def _label_sql() -> str:
    """The rules are the same patterns for both engines; what differs is who reads them."""
    rows = " UNION ALL ".join(
        "SELECT '{}' AS label, count(*) AS pages FROM pages WHERE html IS NOT NULL AND regexp_matches(html, '(?is){}')".format(k, rx.replace("'", "''"))
        for k, rx in {**malware.STRONG, **malware.WEAK}.items()
    )
    return f"SELECT * FROM ({rows}) WHERE pages > 0"


def oracle_sql() -> dict[str, str]:
    return {**sql.queries(), **sql_more.queries(sql._REC), "malware_labels": _label_sql()}
