"""Reader comments: spam rules, exclusions, contact data, threads, local times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from restitch.functions.text import scrub, strip_tags, visible, words

# The wording of spam.
BOT_ERA = 1143849600  # 2006-04-01 UTC
SPAM_TERMS = (
    r"(?i)\b(viagra|cialis|levitra|phentermine|xanax|valium|tramadol|ambien|soma|propecia|casino|poker|bingo|blackjack|roulette|porn\w*|hentai|x{3}|escort|scort|incest"
    r"|ringtones?|payday|mortgage|replica|cheap\s+\w+\s+online|buy\s+\w+\s+online)\b"
)
COMMERCIAL = r"(?i)\b(weight\s*loss|diet|pills?|loans?|insurance|forex|rolex|watches|handbags|jewelry|pharmacy|meds|seo)\b"
PHARMA = (
    r"(?i)\b(viagra|cialis|levitra|tadalafil|sildenafil|phentermine|tramadol|xanax|valium|ambien|propecia|meridia|adipex|hydrocodone|vicodin|oxycontin|soma|ultram|fioricet"
    r"|carisoprodol|desyrel|diazepam|alprazolam)\b"
)
TEASER = r"(?i)^((view|see|watch|play|check|visit|click)(\s+\S+){0,2}|nice|cool|great|good|thanks?)$"
ANCHOR = r"(?i)<a\s[^>]*href\s*=\s*[\"']?\s*(https?://|www\.)"
BBCODE = r"(?i)\[url\s*[=\]]"
BARE_LINK = r"(https?://|www\.)\S"
CJK = r"[\x{3000}-\x{9fff}\x{ac00}-\x{d7af}]"
CJK_ENTITY = r"&#(1[2-9][0-9]{3}|[2-5][0-9]{4}|6[0-5][0-9]{3});"
DOMAIN = r"(?i)[a-z0-9_-]+\.[a-z]{2,}"


def _v(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def _every() -> Column:
    return F.concat_ws(" ", _v("subject"), _v("name"), _v("link"), _v("text"))


def _links() -> Column:
    return F.regexp_count(_v("text"), F.lit(ANCHOR)) + F.regexp_count(_v("text"), F.lit(BBCODE)) + F.regexp_count(visible(F.col("text")), F.lit(BARE_LINK))


def _many_cjk() -> Column:
    return F.regexp_count(_every(), F.lit(CJK)) + F.regexp_count(_every(), F.lit(CJK_ENTITY)) >= 4


def is_spam() -> Column:
    """Rules for undated comments, null fields counting as empty."""
    shown, links = visible(F.col("text")), _links()
    linked_name = _v("link").rlike(DOMAIN)
    return (
        strip_tags(_every()).rlike(SPAM_TERMS) | _every().rlike(BBCODE) | _many_cjk() | ((links > 0) & (words(shown) <= 4))
        | (((links > 0) | linked_name) & _every().rlike(COMMERCIAL)) | (linked_name & F.regexp_replace(shown, r"^[ .!]+|[ .!]+$", "").rlike(TEASER))
        | (links >= 2) | ((links >= 1) & linked_name)
    )


def is_hard_spam() -> Column:
    """The stronger signals that count at any time."""
    shown = visible(F.col("text"))
    drugs = F.size(F.array_distinct(F.transform(F.regexp_extract_all(shown, F.lit(PHARMA), F.lit(1)), F.lower)))
    return strip_tags(_v("name")).rlike(PHARMA) | (drugs >= 2) | ((drugs > 0) & (_links() > 0)) | _every().rlike(BBCODE) | _many_cjk()


def classified(comments: DataFrame) -> DataFrame:
    """(comment_id, article_id, source, dated, spam, hard, keep): dated ones are kept before the era of bots unless hard spam."""
    dated = F.coalesce("insert_date", F.lit(0)) > 0
    c = comments.select("comment_id", "article_id", "source", dated.alias("dated"), F.coalesce("insert_date", F.lit(0)).alias("at"), is_spam().alias("spam"), is_hard_spam().alias("hard"))
    keep = F.when(F.col("dated"), (F.col("at") < BOT_ERA) & ~F.col("hard")).otherwise(~F.col("spam"))
    return c.withColumn("keep", keep).drop("at")


def without(comments: DataFrame, exclusions: DataFrame) -> DataFrame:
    """Comments that no row (name, starts) of the curated exclusions matches."""
    e = exclusions.select(F.col("name").alias("x_name"), F.col("starts").alias("x_starts"))
    hit = (visible(F.col("name")) == F.col("x_name")) & F.startswith(visible(F.col("text")), F.col("x_starts"))
    return comments.join(e, hit, "left_anti")


def spam_counts(comments: DataFrame) -> DataFrame:
    return classified(comments).groupBy(F.coalesce(F.lower("source"), F.lit("")).alias("source")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("spam").alias("spam"), F.count_if("hard").alias("hard"), F.count_if("keep").alias("kept")
    )


def scrubbed(comments: DataFrame) -> DataFrame:
    """(comment_id, text, n_email, n_phone): contact data typed into comments removed."""
    from restitch.functions.text import EMAIL, PHONE

    return comments.where("text is not null").select(
        "comment_id", scrub(F.col("text")).alias("text"), F.regexp_count("text", F.lit(EMAIL)).alias("n_email"),
        F.regexp_count(F.regexp_replace("text", EMAIL, ""), F.lit(PHONE)).alias("n_phone"),
    )


def threads(comments: DataFrame) -> DataFrame:
    """(article_id, n, dated, readers, first_at, last_at): one row per article that has comments."""
    at = F.when(F.col("insert_date") > 0, F.col("insert_date"))
    return comments.where("article_id is not null").groupBy("article_id").agg(
        F.count(F.lit(1)).alias("n"), F.count(at).alias("dated"), F.count_distinct(F.lower(F.trim("name"))).alias("readers"), F.min(at).alias("first_at"), F.max(at).alias("last_at")
    )


def local_days(comments: DataFrame, zone: str = "America/Chicago") -> DataFrame:
    """(day, n) of the dated comments in the magazine's time zone."""
    day = F.date_format(F.from_utc_timestamp(F.timestamp_seconds("insert_date"), zone), "yyyy-MM-dd")
    return comments.where("insert_date > 0").groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("n"))


def email_findings(comments: DataFrame, allowed: tuple[str, ...] = (), k: int = 8) -> DataFrame:
    """(domain, addresses, n, sample): addresses in texts but for the allowed ones, by domain; the first k of each as a sample."""
    from restitch.functions.text import EMAIL

    rows = comments.where("text is not null").select("comment_id", F.explode(F.regexp_extract_all("text", F.lit(f"({EMAIL})"), F.lit(1))).alias("a")).select("comment_id", F.lower("a").alias("a"))
    rows = rows.where(~F.col("a").isin(list(allowed) or [""]))
    per = rows.groupBy("a").agg(F.count(F.lit(1)).alias("k")).withColumn("domain", F.regexp_extract("a", "@(.*)$", 1))
    # the first k addresses by rank, pruned before the shuffle, so a domain of very many addresses collects k
    w = Window.partitionBy("domain").orderBy("a")
    first = per.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k).groupBy("domain").agg(F.array_join(F.array_sort(F.collect_list("a")), " ").alias("sample"))
    return per.groupBy("domain").agg(F.count(F.lit(1)).alias("addresses"), F.sum("k").alias("n")).join(first, "domain").select("domain", "addresses", "n", "sample")


def secrets_found(comments: DataFrame, secrets: list[str]) -> DataFrame:
    """(comment_id, n): comments that hold any of the literal secrets; the list is part of the expression, no join."""
    hits = F.filter(F.array(*[F.lit(s) for s in secrets]), lambda s: F.contains(F.lower(F.coalesce("text", F.lit(""))), F.lower(s)))
    return comments.select("comment_id", F.size(hits).alias("n")).where("n > 0")
