"""The queries of the training-data problems, p1 to p10, over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from restitch.llm import garbled, maincontent, mixing, pii, residue, sentences, stuffing, survivors, tokens, toxic
from restitch.session import table

Query = Callable[[SparkSession, str], DataFrame]


def _over(f: Callable[..., DataFrame], *names: str) -> Query:
    return lambda spark, d: f(*(table(spark, d, n) for n in names))


def queries() -> dict[str, Query]:
    return {
        "p1_found": _over(survivors.found, "captures", "sources"),
        "p1_survivors": _over(survivors.survivors, "captures", "sources"),
        "p2_found": _over(garbled.found, "pages", "comments"),
        "p2_restored": _over(garbled.restored, "pages", "comments"),
        "p2_evidence": _over(garbled.evidence_counts, "pages", "comments"),
        "p3_found": _over(toxic.found, "pages", "comments"),
        "p3_scores": _over(toxic.scored, "pages", "comments"),
        "p3_rates": _over(toxic.rates, "pages", "comments"),
        "p4_found": _over(residue.found, "pages"),
        "p4_content": _over(lambda p: residue.content_pages(p).select("page_id", "html"), "pages"),
        "p5_found": _over(stuffing.found, "comments"),
        "p5_labels": _over(stuffing.judged, "comments"),
        "p6_found": _over(pii.found, "comments"),
        "p6_redacted": _over(pii.redacted, "comments"),
        "p7_found": _over(maincontent.found, "pages", "frames"),
        "p7_bodies": _over(maincontent.bodies, "pages"),
        "p8_ids": _over(tokens.encode, "documents"),
        "p9_mix": _over(lambda d, t: mixing.Mix(d, t).mixed(), "documents", "mix_targets"),
        "p9_shares": _over(lambda d, t: mixing.Mix(d, t).shares(), "documents", "mix_targets"),
        "p10_found": _over(sentences.sentence_ends, "documents"),
        "p10_sentences": _over(sentences.sentences, "documents"),
    }


_P1_ROWS = r"""
WITH norm AS (
  SELECT rec_id, lower(trim(source)) AS skey, filled, page, ts14,
    CASE WHEN regexp_full_match(bare, '[0-9A-Fa-f]{40}') THEN (
           SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> s) & 31)::INT + 1, 1), '' ORDER BY i, s DESC)
           FROM (SELECT i, TRY_CAST('0x' || substr(bare, 5 * i + 1, 5) AS BIGINT) AS v FROM range(8) r(i)), (VALUES (15), (10), (5), (0)) q(s))
         WHEN regexp_full_match(upper(bare), '[A-Z2-7]{32}') THEN upper(bare) END AS digest
  FROM (
    SELECT rec_id, source, regexp_replace(trim(digest), '^sha1:', '', 'i') AS bare,
      (mime IS NOT NULL)::INT + (status IS NOT NULL)::INT + (bytes IS NOT NULL)::INT + (verified IS NOT NULL)::INT + (error IS NOT NULL)::INT + (loaded_at IS NOT NULL)::INT AS filled,
      CASE WHEN regexp_full_match(regexp_replace(trim(ts), '[-:TZ /.]', '', 'g'), '[0-9]{14}')
            AND try_strptime(regexp_replace(trim(ts), '[-:TZ /.]', '', 'g'), '%Y%m%d%H%M%S') IS NOT NULL
           THEN regexp_replace(trim(ts), '[-:TZ /.]', '', 'g') END AS ts14,
      CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN pairs = '' THEN '' ELSE '?' || pairs END AS page
    FROM (
      SELECT *, regexp_extract(regexp_replace(url, '^([A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*', ''), '^([^?#]*)', 1) AS path,
        coalesce(array_to_string(list_transform(list_sort(list_filter(list_transform(
            list_filter(string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&'), lambda x: x <> ''),
            lambda x: {'k': regexp_replace(regexp_extract(x, '^([^=]*)', 1), '^(amp;)+', ''), 'v': regexp_extract(x, '^[^=]*=(.*)$', 1)}),
            lambda p: p.k <> '' AND lower(p.k) <> 'phpsessid')), lambda p: p.k || '=' || p.v), '&'), '') AS pairs
      FROM captures WHERE url IS NOT NULL))
), known AS (SELECT lower(trim(source)) AS skey, source, trust FROM sources
), r AS (
  SELECT n.rec_id, page, ts14, digest, filled, k.source, coalesce(k.trust, -1) AS trust FROM norm n LEFT JOIN known k USING (skey)
), twins AS (SELECT page, ts14, min(digest) AS twin FROM r WHERE digest IS NOT NULL AND ts14 IS NOT NULL GROUP BY 1, 2
), g AS (
  SELECT r.*, coalesce(digest, twin, '@' || r.ts14, '#' || rec_id) AS gkey FROM r LEFT JOIN twins t ON r.page = t.page AND r.ts14 = t.ts14
), v AS (
  SELECT page, gkey, count(*) AS n, min(rec_id) AS first_rec, max(ts14) AS ts, max(digest) AS digest,
    arg_max(source, (trust, source)) FILTER (source IS NOT NULL) AS source
  FROM g GROUP BY 1, 2
)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": _P1_ROWS + "SELECT first_rec, ts, digest, source FROM v WHERE n >= 2",
        "p1_survivors": _P1_ROWS + """, best AS (
  SELECT page, gkey, rec_id FROM g QUALIFY row_number() OVER (PARTITION BY page, gkey ORDER BY
    filled + 4 * (digest IS NOT NULL)::INT + 2 * (ts14 IS NOT NULL)::INT + 2 * (source IS NOT NULL)::INT DESC, trust DESC, ts14 DESC NULLS LAST, rec_id) = 1)
SELECT v.page, n, first_rec, best.rec_id, ts, digest, source FROM v JOIN best ON v.page = best.page AND v.gkey = best.gkey""",
    }
