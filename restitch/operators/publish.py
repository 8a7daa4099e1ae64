"""From resolved pages to a published mirror: output paths, references, redirects, records for search engines."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from restitch.functions.markup import delink, references, rewrite
from restitch.functions.text import script_text
from restitch.functions.urls import directory, url_path
from restitch.session import spread

# Fixed values.
INDEX_FILES = ("index.html", "index.php", "index.htm")
LONGEST_NAME, KEPT_NAME = 80, 60


def output_paths(identities: DataFrame) -> DataFrame:
    """(page, out_path): the file of each page (page, kind), unique without regard to case.

    A folder gets an index file; parameters become part of the name; a name that is too long keeps its
    beginning and gets eight digits of its SHA-1.  Of equal names the one with the fewest parameters,
    then the first, keeps the name; the others get -2, -3.
    """
    path, query = F.regexp_extract("page", r"^/?([^?]*)", 1), F.regexp_extract("page", r"\?(.*)$", 1)
    base = F.when((path == "") | path.endswith("/"), F.concat(path, F.lit("index.html"))).otherwise(path)
    slug = F.regexp_replace(F.regexp_replace(query, r"[=]", "_"), r"[^A-Za-z0-9_.-]+", "-")
    short = F.when(F.length(slug) > LONGEST_NAME, F.concat(F.substring(slug, 1, KEPT_NAME), F.lit("-"), F.substring(F.sha1(query), 1, 8))).otherwise(slug)
    stem, ext = F.regexp_replace(base, r"\.[^./]*$", ""), F.regexp_extract(base, r"(\.[^./]*)$", 1)
    html_ext = F.when((F.col("kind") == "html") & ~F.lower(ext).isin(".html", ".htm"), F.lit(".html")).otherwise(ext)
    name = F.concat(stem, F.when(short == "", F.lit("")).otherwise(F.concat(F.lit("-"), short)), html_ext)
    rows = identities.select("page", name.alias("name"), F.when(query == "", 0).otherwise(F.size(F.split(query, "&"))).alias("n"))
    nr = F.row_number().over(Window.partitionBy(F.lower("name")).orderBy("n", F.length("page"), "page"))
    numbered = F.concat(F.regexp_replace("name", r"\.[^./]*$", ""), F.lit("-"), nr.cast("string"), F.regexp_extract("name", r"(\.[^./]*)$", 1))
    return rows.select("page", F.when(nr == 1, F.col("name")).otherwise(numbered).alias("out_path"))


def page_references(pages: DataFrame) -> DataFrame:
    """(page_id, ref): the distinct references of each page's markup and style sheets."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [(i, r) for i, h in zip(pdf["page_id"], pdf["html"], strict=True) for r in references(h)]
            yield pd.DataFrame(out, columns=["page_id", "ref"])

    return spread(pages.where("html is not null").select("page_id", "html"), "page_id").mapInPandas(run, "page_id bigint, ref string")


def resolved(refs: DataFrame, keys: DataFrame, renames: DataFrame | None = None) -> DataFrame:
    """(ref, target): each reference met by the first of its tries that exists among keys (path).

    The tries are the path itself, its renamed form, with a slash, with each index file, and without regard to
    case; they are exploded with their rank, so the cascade is one equi-join and a minimum.
    """
    p = url_path(F.col("ref"))
    tries = F.array(p, F.concat(p, F.lit("/")), *[F.concat(F.regexp_replace(p, r"/?$", "/"), F.lit(i)) for i in INDEX_FILES])
    rows = refs.select("ref").distinct().select("ref", F.posexplode(tries).alias("rank", "path"))
    if renames is not None:
        more = refs.select("ref").distinct().select("ref", p.alias("old")).join(renames, "old").select("ref", F.lit(0).alias("rank"), F.col("new").alias("path"))
        rows = rows.unionByName(more)
    exact = rows.join(keys.select("path", F.col("path").alias("target")).distinct(), "path").select("ref", "rank", "target")
    loose = (
        rows.withColumn("lpath", F.lower("path")).join(keys.select(F.lower("path").alias("lpath"), F.col("path").alias("target")).distinct(), "lpath").select("ref", (F.col("rank") + 100).alias("rank"), "target")
    )
    return exact.unionByName(loose).groupBy("ref").agg(F.min(F.struct("rank", "target")).alias("m")).select("ref", "m.target")


def renamed_files(files: DataFrame) -> DataFrame:
    """(old, new): names that differ by a leading zero of their number, in folders where all such pairs have equal content.

    files has (path, digest).  Both spellings are met by an equi-join on folder and name; a folder
    counts as renamed when it has such pairs and none of them differs.
    """
    f = files.select(
        "path", "digest", directory(F.col("path")).alias("folder"), F.regexp_extract("path", r"([^/]*)$", 1).alias("name")
    )
    zero = F.regexp_replace("name", r"^(\D*?)0+([1-9]\d*.*)$", "$1$2")
    alt = F.when(F.col("name").rlike(r"^\D*0+[1-9]"), zero).when(F.col("name").rlike(r"^\D*[1-9]"), F.regexp_replace("name", r"^(\D*)([1-9].*)$", "$10$2"))
    a = f.withColumn("alt", F.when(F.col("name").rlike(r"^\D*\d"), alt)).where("alt is not null")
    pairs = a.join(f.select("folder", F.col("name").alias("alt"), F.col("digest").alias("d2")), ["folder", "alt"])
    good = pairs.groupBy("folder").agg(F.bool_and(F.col("digest") == F.col("d2")).alias("same")).where("same").select("folder")
    have = f.select("folder", F.col("name").alias("alt"), F.lit(True).alias("there")).distinct()
    return a.join(good, "folder").join(have, ["folder", "alt"], "left").where("there is null").select(F.concat("folder", "alt").alias("old"), F.col("path").alias("new"))


def rewritten(pages: DataFrame, targets: DataFrame) -> DataFrame:
    """(page_id, html): references of each page replaced by its own map from targets (page_id, ref, target)."""
    maps = targets.where("target is not null").groupBy("page_id").agg(F.map_from_entries(F.collect_list(F.struct("ref", "target"))).alias("m"))
    rows = pages.select("page_id", "html").join(maps, "page_id", "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [rewrite(h, dict(m)) if isinstance(h, str) and m is not None else h for h, m in zip(pdf["html"], pdf["m"], strict=True)]
            yield pd.DataFrame({"page_id": pdf["page_id"], "html": out})

    return rows.mapInPandas(run, "page_id bigint, html string")


def without_dead_links(pages: DataFrame, status: DataFrame) -> DataFrame:
    """(page_id, html): links that status (url, ok) knows to be dead unwrapped; unchecked ones stay."""
    dead = status.where("not ok").select(F.col("url").alias("ref")).distinct()
    per = page_references(pages).join(dead, "ref", "left_semi").groupBy("page_id").agg(F.collect_set("ref").alias("dead"))
    rows = pages.select("page_id", "html").join(per, "page_id", "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [delink(h, set(d)) if isinstance(h, str) and d is not None else h for h, d in zip(pdf["html"], pdf["dead"], strict=True)]
            yield pd.DataFrame({"page_id": pdf["page_id"], "html": out})

    return rows.mapInPandas(run, "page_id bigint, html string")


def unchecked_links(links: DataFrame, checked: DataFrame, retry: bool = False) -> DataFrame:
    """(url): links to check: those never checked, and with retry those that failed."""
    new = links.select("url").distinct().join(checked.select("url"), "url", "left_anti")
    return new.union(checked.where("not ok").select("url")).distinct() if retry else new


def failure_reasons(checked: DataFrame) -> DataFrame:
    """(why, n): failed checks by reason, what follows a bracket left out."""
    return checked.where("not ok").groupBy(F.trim(F.split_part(F.coalesce("why", F.lit("")), F.lit(" ("), F.lit(1))).alias("why")).agg(F.count(F.lit(1)).alias("n"))


def canonical_targets(copies: DataFrame, first: DataFrame) -> DataFrame:
    """(path, target): the canonical page of each archived copy (path, target), followed one step to the first of equal pages (page, canonical)."""
    one = copies.groupBy("path").agg(F.min("target").alias("target"), F.count_distinct("target").alias("n")).where("n = 1").select("path", "target")
    return one.join(first.select(F.col("page").alias("target"), "canonical"), "target", "left").select("path", F.coalesce("canonical", "target").alias("target"))


def redirects(pages: DataFrame) -> DataFrame:
    """(article_id, variants, base): where old addresses of an article lead, as a JSON map from page variant to path."""
    rows = pages.where("article_id is not null and url is not null").groupBy("article_id", F.coalesce("page_path", F.lit("")).alias("v")).agg(F.min(url_path(F.col("url"))).alias("p"))
    g = rows.groupBy("article_id").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("v", "p"))))).alias("variants"), F.min("p").alias("base"))
    return g


def article_records(articles: DataFrame, base: str) -> DataFrame:
    """(id, record): a linked-data record of each article (id, title, blurb, issue) that may stand inside a script element."""
    rec = F.to_json(F.struct(
        F.lit("https://schema.org").alias("@context"), F.lit("Article").alias("@type"), F.concat(F.lit(base + "/a/"), F.col("id").cast("string")).alias("@id"),
        F.col("title").alias("headline"), F.col("blurb").alias("description"), F.col("issue").cast("string").alias("issueNumber"),
    ))
    return articles.select("id", script_text(rec).alias("record"))


def redacted_copy(files: DataFrame, scan: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """(path, text): text files (path, text) that the scan (path, verdict) does not call malicious, secrets replaced."""
    text = F.col("text")
    for rx, mark in patterns.items():
        text = F.regexp_replace(text, rx, mark)
    return files.join(scan.where("verdict = 'malicious'").select("path"), "path", "left_anti").select("path", text.alias("text"))


def write_files(out: DataFrame, folder: str) -> int:
    """One file per row (out_path, content) below a mounted folder; returns the number of files.  A table of the rows is the better sink at scale."""
    import os

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content in zip(pdf["out_path"], pdf["content"], strict=True):
                full = os.path.normpath(os.path.join(folder, path))
                if not full.startswith(os.path.join(folder, "")):
                    raise ValueError(f"outside the folder: {path}")
                os.makedirs(os.path.dirname(full), exist_ok=True)
                part = f"{full}.part"
                with open(part, "wb") as f:
                    f.write(bytes(content))
                os.replace(part, full)
            yield pd.DataFrame({"n": [len(pdf)]})

    return out.select("out_path", "content").mapInPandas(run, "n bigint").agg(F.sum("n")).first()[0] or 0
