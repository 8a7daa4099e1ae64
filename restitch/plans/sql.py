"""SQL of the core queries for an independent engine, over the same tables."""

from __future__ import annotations

from restitch.operators import comments as C
from restitch.operators import pages as P
from restitch.operators.manifest import CUTOFF, HOME_PAGES, MEDIA, SHARED_BY, SKIP_PATH

_Q = lambda s: "'" + s.replace("'", "''") + "'"
_IN = lambda xs: "(" + ", ".join(map(_Q, xs)) + ")"
HTML_HREF = r"""(?i)<a\s[^>]*?href\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""
HTML_IMG = r"""(?i)<img\s[^>]*?src\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""
_UNQUOTED = lambda x: f"""regexp_replace(regexp_replace({x}, '^["'']', ''), '["'']$', '')"""

PREPARED = rf"""
WITH raw AS (
  SELECT *, regexp_extract(regexp_replace(url, '^([A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*', ''), '^([^?#]*)', 1) AS path0,
    coalesce(array_to_string(list_transform(list_sort(list_filter(list_transform(
      list_filter(string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&'), lambda x: x <> ''),
      lambda x: {{'k': regexp_replace(regexp_extract(x, '^([^=]*)', 1), '^(amp;)+', ''), 'v': regexp_extract(x, '^[^=]*=(.*)$', 1)}}),
      lambda p: p.k <> '' AND lower(p.k) <> 'phpsessid')), lambda p: p.k || '=' || p.v), '&'), '') AS pairs,
    regexp_replace(trim(ts), '[-:TZ /.]', '', 'g') AS t0, regexp_replace(trim(digest), '^sha1:', '', 'i') AS bare
  FROM captures WHERE url IS NOT NULL
), prep AS (
  SELECT rec_id, url, status, bytes, verified, CASE WHEN path0 = '' THEN '/' ELSE path0 END AS path,
    (CASE WHEN path0 = '' THEN '/' ELSE path0 END) || CASE WHEN pairs = '' THEN '' ELSE '?' || pairs END AS page,
    CASE WHEN regexp_full_match(t0, '[0-9]{{14}}') AND try_strptime(t0, '%Y%m%d%H%M%S') IS NOT NULL THEN t0 END AS ts,
    CASE WHEN regexp_full_match(bare, '[0-9A-Fa-f]{{40}}') THEN (
           SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> s) & 31)::INT + 1, 1), '' ORDER BY i, s DESC)
           FROM (SELECT i, TRY_CAST('0x' || substr(bare, 5 * i + 1, 5) AS BIGINT) AS v FROM range(8) r(i)), (VALUES (15), (10), (5), (0)) q(s))
         WHEN regexp_full_match(upper(bare), '[A-Z2-7]{{32}}') THEN upper(bare) END AS digest,
    lower(trim(regexp_replace(coalesce(mime, 'unk'), ';.*$', ''))) AS mime, nullif(lower(trim(source)), '') AS source
  FROM raw
), reasoned AS (
  SELECT *, CASE WHEN coalesce(status, '200') <> '200' THEN 'status' WHEN ts IS NULL THEN 'time' WHEN digest IS NULL THEN 'digest' WHEN ts > '{CUTOFF}' THEN 'late'
    WHEN mime = 'warc/revisit' THEN 'revisit' WHEN regexp_matches(path, {_Q(SKIP_PATH)}) THEN 'path'
    WHEN regexp_matches(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '^[CO]=[A-Z](;|$)') THEN 'listing sort'
    WHEN source IN ('commoncrawl', 'server') AND NOT coalesce(verified, false) THEN 'unverified' END AS reason,
    lower(regexp_extract(regexp_extract(page, '^([^?]*)', 1), '[^/.][^/]*\.([^/.]*)$', 1)) AS ext
  FROM prep
), cand AS (
  SELECT * FROM (SELECT *, max((coalesce(source, '') <> 'server' AND NOT (ext IN {_IN(MEDIA)} AND mime LIKE 'text/html%'))::INT) OVER (PARTITION BY page) AS published
    FROM reasoned WHERE reason IS NULL) WHERE published = 0 OR coalesce(source, '') <> 'server'
), uniq AS (
  SELECT *, count(*) OVER (PARTITION BY page, digest) AS n_captures FROM cand
  QUALIFY row_number() OVER (PARTITION BY page, digest ORDER BY ts DESC, rec_id) = 1
), shared AS (SELECT digest FROM cand GROUP BY 1 HAVING count(DISTINCT page) >= {SHARED_BY}
), home AS (SELECT DISTINCT digest FROM cand WHERE page IN {_IN(HOME_PAGES)}
), kinds AS (
  SELECT * FROM (SELECT *, max((mime NOT LIKE 'text/html%')::INT) OVER (PARTITION BY page) AS other FROM uniq) WHERE other = 0 OR mime NOT LIKE 'text/html%'
), flagged AS (
  SELECT *, CASE WHEN other = 1 THEN 'asset' ELSE 'html' END AS kind,
    other = 0 AND page NOT IN {_IN(HOME_PAGES)} AND (digest IN (SELECT digest FROM shared) OR digest IN (SELECT digest FROM home)) AS demoted FROM kinds
), manifest AS (
  SELECT page, kind, row_number() OVER (PARTITION BY page ORDER BY demoted, ts DESC, rec_id) AS rank, demoted, ts, digest, mime, rec_id, n_captures FROM flagged
)
"""

_REC = PREPARED + """, rec AS (
  SELECT s.rec_id, s.page AS path, CASE
    WHEN s.digest = m.digest THEN 'identical to the chosen copy'
    WHEN EXISTS (SELECT 1 FROM prep a WHERE a.page = s.page AND a.digest = s.digest AND coalesce(a.source, '') <> 'server' AND a.page NOT LIKE '%?%') THEN 'identical to an archived version'
    WHEN EXISTS (SELECT 1 FROM prep a WHERE a.page = s.page AND a.digest IS NOT NULL AND coalesce(a.source, '') <> 'server' AND a.page NOT LIKE '%?%') THEN 'archived with different content'
    WHEN EXISTS (SELECT 1 FROM prep a WHERE a.digest = s.digest AND coalesce(a.source, '') <> 'server' AND a.page NOT LIKE '%?%') THEN 'same content under another name'
    ELSE 'only on the server' END AS status
  FROM prep s LEFT JOIN manifest m ON m.page = s.page AND m.rank = 1 WHERE s.source = 'server' AND s.digest IS NOT NULL AND s.page NOT LIKE '%?%')
"""

# ------------------------------------------------------------------ pages


def _hits(rules: tuple[tuple[str, str], ...]) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN regexp_matches(h, {_Q(rx)}) THEN {_Q(n)} END" for n, rx in rules) + "], lambda x: x IS NOT NULL)"


PROBLEMS = f"""
WITH p AS (SELECT *, coalesce(html, '') AS h FROM pages), problems AS (
  SELECT page_id, list_concat({_hits(P.HARD)}, list_filter([CASE WHEN html IS NULL OR trim(h) = '' THEN 'missing' END,
    CASE WHEN regexp_matches(h, {_Q(P.LISTING)}) AND NOT regexp_matches(coalesce(url, ''), '/(\\?.*)?$') THEN 'directory listing' END], lambda x: x IS NOT NULL)) AS hard,
    {_hits(P.SOFT)} AS soft FROM p)
"""

LINKS = f"""
WITH links AS (SELECT page_id, href, CASE WHEN href = '' THEN 'empty' WHEN href LIKE '#%' THEN 'fragment' WHEN regexp_matches(href, '(?i)^mailto:') THEN 'mail'
    WHEN regexp_matches(href, '(?i)^javascript:') THEN 'script' WHEN regexp_matches(href, '(?i)^(https?:)?//') THEN 'external' ELSE 'internal' END AS kind
  FROM (SELECT page_id, {_UNQUOTED(f"unnest(regexp_extract_all(html, {_Q(HTML_HREF)}, 1))")} AS href FROM pages WHERE html IS NOT NULL))
"""

_PATH = "CASE WHEN {p} = '' THEN '/' ELSE {p} END"
_URLPATH = _PATH.format(p="regexp_extract(regexp_replace(url, '^([A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*', ''), '^([^?#]*)', 1)")

MISSING = LINKS + f""", known AS (SELECT DISTINCT lower({_URLPATH}) AS path FROM pages WHERE url IS NOT NULL
), have AS (SELECT path FROM known UNION SELECT regexp_extract(path, '^(.*/)[^/]*$', 1) FROM known
), refs AS (SELECT DISTINCT page_id, regexp_replace(href, '[?#].*$', '') AS target FROM links WHERE kind = 'internal'
), missing AS (SELECT target, count(DISTINCT page_id) AS n, array_to_string(list_sort(list(DISTINCT page_id))[1:10], ' ') AS referrers FROM refs
  WHERE target <> '' AND lower(target) NOT IN (SELECT path FROM have) AND lower(target) || '/' NOT IN (SELECT path FROM have) GROUP BY 1)
"""

BYLINES = f"""
WITH lines AS (SELECT article_id, trim(regexp_replace(regexp_replace(unnest(string_split(html, chr(10))), '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')) AS t
    FROM pages WHERE html IS NOT NULL AND article_id IS NOT NULL
), credits AS (SELECT DISTINCT article_id, c.role AS role, c.name AS name FROM (SELECT article_id, unnest([{", ".join(
    "{'role': " + _Q(r) + ", 'name': lower(regexp_extract(t, " + _Q(rx) + ", 1))}" for r, rx in P.BYLINES)}]) AS c FROM lines WHERE length(t) BETWEEN 4 AND 60)
  WHERE c.name <> '' AND len(string_split(c.name, ' ')) <= 4)
"""

# ------------------------------------------------------------------ comments

_V = lambda c: f"coalesce({c}, '')"
_STRIP = lambda s: f"regexp_replace({s}, '<[^>]+>', ' ', 'g')"
_VISIBLE = lambda c: f"trim(regexp_replace({_STRIP(_V(c))}, '\\s+', ' ', 'g'))"
_COUNT = lambda s, rx: f"len(regexp_extract_all({s}, {_Q(rx)}))"
_CJK = r"[\x{3000}-\x{9fff}\x{ac00}-\x{d7af}]"

SPAM = f"""
WITH base AS (
  SELECT *, {_VISIBLE('text')} AS shown, concat_ws(' ', {_V('subject')}, {_V('name')}, {_V('link')}, {_V('text')}) AS every FROM comments
), m AS (
  SELECT *, {_COUNT(_V('text'), C.ANCHOR)} + {_COUNT(_V('text'), C.BBCODE)} + {_COUNT('shown', C.BARE_LINK)} AS links, regexp_matches({_V('link')}, {_Q(C.DOMAIN)}) AS linked,
    {_COUNT('every', _CJK)} + {_COUNT('every', C.CJK_ENTITY)} >= 4 AS cjk, regexp_matches(every, {_Q(C.BBCODE)}) AS bb,
    CASE WHEN shown = '' THEN 0 ELSE len(string_split(shown, ' ')) END AS n_words,
    len(list_distinct(list_transform(regexp_extract_all(shown, {_Q(C.PHARMA)}, 1), lambda x: lower(x)))) AS drugs
  FROM base
), classified AS (
  SELECT comment_id, article_id, source, coalesce(insert_date, 0) > 0 AS dated, coalesce(insert_date, 0) AS at_,
    regexp_matches({_STRIP('every')}, {_Q(C.SPAM_TERMS)}) OR bb OR cjk OR (links > 0 AND n_words <= 4) OR ((links > 0 OR linked) AND regexp_matches(every, {_Q(C.COMMERCIAL)}))
      OR (linked AND regexp_matches(trim(shown, ' .!'), {_Q(C.TEASER)})) OR links >= 2 OR (links >= 1 AND linked) AS spam,
    regexp_matches({_STRIP(_V('name'))}, {_Q(C.PHARMA)}) OR drugs >= 2 OR (drugs > 0 AND links > 0) OR bb OR cjk AS hard FROM m
), kept AS (SELECT comment_id, article_id, source, dated, spam, hard, CASE WHEN dated THEN at_ < {C.BOT_ERA} AND NOT hard ELSE NOT spam END AS keep FROM classified)
"""

ARTICLES = """
WITH once AS (
  SELECT id, min({'c': length(regexp_replace(trim(title), '[^A-Z]', '', 'g')), 't': trim(title)}).t AS title, min(folder) AS folder, min(issue) AS issue, min(blurb) AS blurb, count(*) AS n
  FROM articles GROUP BY id
), names AS (SELECT issue, min(name) AS issue_name FROM issues GROUP BY 1)
"""

_SCRIPT, _FORM, _ANCHOR = r"(?is)<script\b[^>]*>.*?</script\s*>", r"(?is)<form\b[^>]*>.*?</form\s*>", r"(?is)<a\b[^>]*>.*?</a\s*>"
_CLEAN_STEPS = (
    ("scripts", _SCRIPT, r"""(?is)googlesyndication\.com|google_ad_client|google-analytics\.com|_gat\._getTracker|urchinTracker|gaJsHost|pageTracker\.|advertising\.com|<SCR'\s*\+\s*'IPT|document\.write\s*\(\s*['"]<\s*scr|^<script\b[^>]*\bsrc\s*=\s*["']?\s*(https?:)?//|adserver/"""),
    ("shop_links", _ANCHOR, r"(?is)^<a\b[^>]*\b(cafepress|cafeshops)\."),
    ("comment_forms", _FORM, r"""(?is)post a comment|name\s*=\s*["']?comment\b"""),
    ("newsletter_boxes", r"""(?is)<div\b[^>]*\bid\s*=\s*["']?email_submit\d*[^>]*>.*?</div\s*>""", ""),
    ("newsletter_forms", _FORM, r"""(?is)newsletter|join the list|name\s*=\s*["']?em(ail)?\b"""),
    ("php_errors", r"(?i)(?:<br\s*/?>\s*)?<b>\s*(?:Warning|Fatal error|Parse error|Notice|Deprecated)\s*</b>\s*:[^\n]*?on line\s*<b>\s*\d+\s*</b>(?:\s*<br\s*/?>)?", ""),
    ("offsite_images", r"""(?is)<img\b[^>]*\bsrc\s*=\s*["']?\s*(?:https?:)?//[^>]*>""", ""),
    ("hidden_links", _ANCHOR, r"""(?is)^<a\b[^>]*\bstyle\s*=\s*["'][^"']*display\s*:\s*none"""),
    ("linked_comments", r"(?s)<!--.*?-->", r"(?is)<a\s"),
    ("ad_links", _ANCHOR, r"(?is)^<a\b[^>]*(adserver|adclick)"),
    ("ad_boxes", r"""(?is)<div\b[^>]*id\s*=\s*["']?beacon_\d+[^>]*>.*?</div>|<noscript>.*?</noscript>|<iframe\b[^>]*>.*?</iframe>|<img\b[^>]*>""", r"(?is)beacon_|adserver"),
)
_OWN = r"""(?i)src\s*=\s*["']?\s*(https?:)?//(www\.)?lampmag\.example"""
REVIEW = {
    "sexual": r"(?i)\b(?:nude|nudity|naked|topless|porn\w*|strippers?|strip clubs?|burlesque|fetish\w*|bondage|escorts?|hookers?|prostitut\w+|sex|sexual\w*|erotic\w*|penis|vaginal?|breasts?|boobs?|tits|thongs?|masturbat\w+|orgasm\w*|suicide ?girls?|playboy|lap ?dances?)\b",
    "strong": r"(?i)\b(?:fuck\w*|motherf\w*|cunts?|cocks?|cocksuck\w*|pussy|twats?|sluts?|whores?)\b",
    "mild": r"(?i)\b(?:shit\w*|bitch\w*|assholes?|dicks?|bastards?|damn\w*)\b",
    "slur": r"(?i)\b(?:fag\w*|retard\w*|nigg\w*|midgets?|trann\w*|spics?)\b",
}


def _cleaned() -> str:
    inner = "SELECT page_id, html AS h0 FROM pages WHERE html IS NOT NULL"
    for i, (name, element, holds) in enumerate(_CLEAN_STEPS):
        new = r"regexp_replace(x, '(?is)^<a\b[^>]*>(.*)</a\s*>$', '\1')" if name == "shop_links" else "''"
        inner = f"SELECT *, list_filter(regexp_extract_all(h{i}, {_Q(element)}), lambda x: regexp_matches(x, {_Q(holds)}) AND NOT regexp_matches(x, {_Q(_OWN)})) AS c{i} FROM ({inner})"
        inner = f"SELECT *, list_reduce(list_prepend(h{i}, list_distinct(c{i})), lambda h, x: replace(h, x, {new})) AS h{i + 1} FROM ({inner})"
    cols = ", ".join(f"len(c{i})::INT AS {name}" for i, (name, *_) in enumerate(_CLEAN_STEPS))
    return f"SELECT page_id, {cols}, length(h{len(_CLEAN_STEPS)}) AS n_chars FROM ({inner})"


_TEXTS = f"""WITH v AS (
  SELECT article_id, 'page' AS kind, page_id AS id, trim(regexp_replace(regexp_replace(concat_ws(' ', html, tail), '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')) AS t FROM pages WHERE article_id IS NOT NULL AND html IS NOT NULL
  UNION ALL SELECT article_id, 'comment', comment_id, trim(regexp_replace(regexp_replace(concat_ws(' ', subject, name, text), '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')) FROM comments WHERE article_id IS NOT NULL
)"""
_REVIEWED = _TEXTS + f""", s AS (SELECT article_id, sum(CASE WHEN t = '' THEN 0 ELSE len(string_split(t, ' ')) END)::BIGINT AS n_words,
  {', '.join(f"sum(len(regexp_extract_all(t, {_Q(rx)})))::BIGINT AS {k}" for k, rx in REVIEW.items())}, bool_or(regexp_matches(t, '(?i)\\bcunts?\\b')) AS worst FROM v GROUP BY 1
), rv AS (SELECT * EXCLUDE (worst), CASE WHEN slur > 0 OR worst OR strong * 1000.0 / greatest(n_words, 1) >= 3 OR sexual * 1000.0 / greatest(n_words, 1) >= 4 THEN 'exclude' WHEN sexual > 0 OR strong > 0 THEN 'review' ELSE 'ok' END AS tier FROM s)
"""


EMAIL = r"[A-Za-z0-9_.+-]+@[A-Za-z0-9_-]+(?:\.[A-Za-z0-9_-]+)*\.[A-Za-z]{2,}"
PHONE = r"\(?\b[0-9]{3}\)?[ .-]*[0-9]{3}[ .-][0-9]{4}\b"

_TIDY = lambda s: f"regexp_replace(trim(regexp_replace({s}, '\\s+', ' ', 'g')), '\\s+([,.;:!?])(\\s|$|[\"”’)])', '\\1\\2', 'g')"


def queries() -> dict[str, str]:
    return {
        "manifest": PREPARED + "SELECT * FROM manifest",
        "manifest_stats": PREPARED + """SELECT kind, count(*) AS pages, sum(n)::BIGINT AS candidates, count(*) FILTER (latest_demoted AND NOT all_demoted) AS latest_avoided, count(*) FILTER (all_demoted) AS only_fallback
          FROM (SELECT page, kind, count(*) AS n, first(demoted ORDER BY ts DESC, rec_id) AS latest_demoted, bool_and(demoted) AS all_demoted FROM manifest GROUP BY 1, 2) GROUP BY 1""",
        "first_choice_years": PREPARED + "SELECT substr(ts, 1, 4) AS year, kind, count(*) AS n FROM manifest WHERE rank = 1 GROUP BY 1, 2",
        "digest_owners": PREPARED + "SELECT digest, count(DISTINCT page) AS n_pages FROM cand GROUP BY 1 HAVING count(DISTINCT page) >= 2",
        "versions": PREPARED + """SELECT * FROM (SELECT page, ts, digest, row_number() OVER w AS version, count(*) OVER (PARTITION BY page) AS versions, lag(ts) OVER w AS previous, lead(ts) OVER w AS next
          FROM manifest WHERE NOT demoted WINDOW w AS (PARTITION BY page ORDER BY ts, rec_id)) WHERE versions >= 2""",
        "canonical_pages": PREPARED + """SELECT path, page AS canonical, spellings FROM (SELECT *, count(*) OVER (PARTITION BY path) AS spellings, row_number() OVER (PARTITION BY path ORDER BY
          CASE WHEN q = '' THEN 0 ELSE len(string_split(q, '&')) END, length(page), page) AS rn FROM (SELECT DISTINCT page, regexp_extract(page, '^([^?]*)', 1) AS path, regexp_extract(page, '\\?(.*)$', 1) AS q FROM cand)) WHERE rn = 1""",
        "skip_report": PREPARED + "SELECT coalesce(reason, 'kept') AS reason, count(*) AS n, count(DISTINCT page) AS pages FROM reasoned GROUP BY 1",
        "html_at_media": PREPARED + f"SELECT page, count(*) AS n FROM reasoned WHERE ext IN {_IN(MEDIA)} AND coalesce(source, '') <> 'server' GROUP BY 1 HAVING bool_and(mime LIKE 'text/html%')",
        "reconcile": _REC + "SELECT * FROM rec",
        "reconcile_counts": _REC + """SELECT status, ext, n, rank FROM (SELECT status, ext, n, row_number() OVER (PARTITION BY status ORDER BY n DESC, ext) AS rank FROM (
          SELECT status, lower(regexp_extract(path, '[^/.][^/]*\\.([^/.]*)$', 1)) AS ext, count(*) AS n FROM rec GROUP BY 1, 2)) WHERE rank <= 5""",
        "archived_only": PREPARED + """SELECT DISTINCT page AS path FROM prep WHERE page NOT LIKE '%?%' AND page NOT LIKE '%/' AND coalesce(source, '') <> 'server' AND page NOT IN (
          SELECT page FROM prep WHERE source = 'server' AND page NOT LIKE '%?%' AND page NOT LIKE '%/' UNION SELECT regexp_extract(page, '^(.*/)', 1) FROM prep WHERE source = 'server' AND page NOT LIKE '%?%' AND page NOT LIKE '%/')""",
        "folders_with_parts": PREPARED + """SELECT folder, count(*) AS n FROM (SELECT path, array_to_string(parts[1:i], '/') || '/' AS folder FROM (SELECT path, parts, unnest(range(1, greatest(len(parts) - 1, 1) + 1)) AS i FROM (
          SELECT DISTINCT regexp_extract(page, '^([^?]*)', 1) AS path, string_split(regexp_extract(page, '^([^?]*)', 1), '/') AS parts FROM cand))) GROUP BY 1""",
        "page_problems": PROBLEMS + "SELECT page_id, array_to_string(hard, ', ') AS hard, array_to_string(soft, ', ') AS soft FROM problems",
        "resolution": PROBLEMS + """, ranked AS (SELECT p.article_id, coalesce(p.page_path, '') AS page_path, p.page_id, CASE WHEN len(hard) > 0 THEN 2 WHEN len(soft) > 0 THEN 1 ELSE 0 END AS klass,
            row_number() OVER (PARTITION BY p.article_id, coalesce(p.page_path, '') ORDER BY coalesce(p.ts, '') DESC, p.page_id) AS pos FROM p JOIN problems USING (page_id) WHERE article_id IS NOT NULL
          ), best AS (SELECT *, count(*) OVER (PARTITION BY article_id, page_path) AS n FROM ranked QUALIFY row_number() OVER (PARTITION BY article_id, page_path ORDER BY klass, pos) = 1)
          SELECT article_id, page_path, CASE klass WHEN 0 THEN 'clean' WHEN 1 THEN 'soft' ELSE 'failed' END AS status, CASE WHEN klass < 2 THEN page_id END AS page_id, n, CASE WHEN klass < 2 THEN pos - 1 ELSE n END AS n_rejected FROM best""",
        "link_kinds": LINKS + "SELECT kind, count(*) AS n, count(DISTINCT page_id) AS pages, count(DISTINCT href) AS targets FROM links GROUP BY 1",
        "external_hosts": LINKS + """SELECT lower(regexp_extract(href, '^(?:[A-Za-z]+:)?//([^/?#:]+)', 1)) AS host, count(*) AS n, count(DISTINCT page_id) AS pages FROM links WHERE kind = 'external'
          AND regexp_replace(lower(regexp_extract(href, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)', 1)), '^www\\.', '') <> 'lampmag.example' GROUP BY 1""",
        "missing_targets": MISSING + "SELECT * FROM missing",
        "missing_by_section": MISSING + "SELECT regexp_extract(target, '^/?([^/]*)', 1) AS section, count(*) AS targets, sum(n)::BIGINT AS links FROM missing GROUP BY 1 ORDER BY targets DESC, section LIMIT 15",
        "cleaned": _cleaned(),
        "security_hits": "WITH b AS (SELECT page_id, regexp_replace(html, '(?is)<script\\b[^>]*>[^<]*hiveware_enkoder.*?</script\\s*>', '', 'g') AS h FROM pages WHERE html IS NOT NULL) SELECT label, sum(k)::BIGINT AS hits, count(DISTINCT page_id) AS pages, arg_min(at_, page_id) AS sample FROM (" + " UNION ALL ".join(
            f"SELECT page_id, {_Q(n)} AS label, {_COUNT('h', rx)} AS k, regexp_extract(h, {_Q('(' + rx + '[^' + chr(92) + 'n]{0,160})')}, 1) AS at_ FROM b" for n, rx in P.SECURITY) + ") WHERE k > 0 GROUP BY 1",
        "first_copies": """SELECT page_id, CASE WHEN f <> page_id THEN f END AS canonical FROM (SELECT page_id, first_value(page_id) OVER (PARTITION BY trim(regexp_replace(html, '\\s+', ' ', 'g')) ORDER BY coalesce(article_id, 1::BIGINT << 60), page_id) AS f
          FROM pages WHERE html IS NOT NULL AND trim(html) <> '')""",
        "page_images": f"""SELECT article_id, src, dense_rank() OVER (PARTITION BY article_id ORDER BY at_)::INT AS photo, count(*) OVER (PARTITION BY article_id) AS photos FROM (
          SELECT article_id, src, min({{'p': page_id, 'i': pos}}) AS at_ FROM (SELECT article_id, page_id, {_UNQUOTED("unnest(srcs)")} AS src, unnest(range(len(srcs))) AS pos FROM (
            SELECT article_id, page_id, regexp_extract_all(html, {_Q(HTML_IMG)}, 1) AS srcs FROM pages WHERE html IS NOT NULL AND article_id IS NOT NULL)) WHERE src <> '' GROUP BY 1, 2)""",
        "credits": BYLINES + "SELECT * FROM credits",
        "contributors": BYLINES + """SELECT name, count(DISTINCT article_id) AS works, array_to_string(list_sort(list(DISTINCT role)), ', ') AS roles, min(issue) AS first_issue, max(issue) AS last_issue, count(DISTINCT article_id) >= 3 AS page
          FROM credits LEFT JOIN (SELECT id::BIGINT AS article_id, min(issue) AS issue FROM articles GROUP BY 1) USING (article_id) GROUP BY 1""",
        "review": _REVIEWED + "SELECT * FROM rv",
        "review_order": _REVIEWED + "SELECT article_id, tier, sexual + strong + 3 * slur AS weight, row_number() OVER (PARTITION BY tier ORDER BY sexual + strong + 3 * slur DESC, article_id)::INT AS nr FROM rv",
        "snippets": _TEXTS + f""", h AS (
          {" UNION ALL ".join(f"SELECT article_id, kind, id, {i} AS c, {_Q(k)} AS category, unnest(x) AS snippet, generate_subscripts(x, 1) AS pos FROM (SELECT article_id, kind, id, regexp_extract_all(t, {_Q('(.{0,60}' + REVIEW[k] + '.{0,60})')}, 1) AS x FROM v)" for i, k in enumerate(("sexual", "strong", "slur")))})
          SELECT article_id, nr, category, trim(snippet) AS snippet FROM (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY kind DESC, id, c, pos) AS nr FROM h) WHERE nr <= 8""",
        "comment_spam": SPAM + "SELECT * FROM kept",
        "spam_counts": SPAM + "SELECT coalesce(lower(source), '') AS source, count(*) AS n, count(*) FILTER (spam) AS spam, count(*) FILTER (hard) AS hard, count(*) FILTER (keep) AS kept FROM kept GROUP BY 1",
        "scrubbed": f"""SELECT comment_id, regexp_replace(e, {_Q(PHONE)}, '[phone removed]', 'g') AS text, len(regexp_extract_all(text, {_Q(EMAIL)})) AS n_email, len(regexp_extract_all(regexp_replace(text, {_Q(EMAIL)}, '', 'g'), {_Q(PHONE)})) AS n_phone
          FROM (SELECT *, regexp_replace(text, {_Q(EMAIL)}, '[email removed]', 'g') AS e FROM comments WHERE text IS NOT NULL)""",
        "threads": """SELECT article_id, count(*) AS n, count(*) FILTER (insert_date > 0) AS dated, count(DISTINCT lower(trim(name))) AS readers, min(insert_date) FILTER (insert_date > 0) AS first_at, max(insert_date) FILTER (insert_date > 0) AS last_at
          FROM comments WHERE article_id IS NOT NULL GROUP BY 1""",
        "email_findings": f"""SELECT regexp_extract(a, '@(.*)$', 1) AS domain, count(DISTINCT a) AS addresses, count(*) AS n, array_to_string(list_sort(list(DISTINCT a))[1:8], ' ') AS sample
          FROM (SELECT lower(unnest(regexp_extract_all(text, {_Q(EMAIL)}))) AS a FROM comments WHERE text IS NOT NULL) GROUP BY 1""",
        "articles_once": ARTICLES + "SELECT * FROM once",
        "catalog": ARTICLES + """, votes AS (SELECT folder, issue, count(*) AS k FROM once WHERE issue IS NOT NULL AND folder IS NOT NULL GROUP BY 1, 2
), byf AS (SELECT folder, arg_min(issue, (-k, issue)) AS fi FROM votes GROUP BY 1), filled AS (SELECT o.id, o.title, o.folder, coalesce(o.issue, fi, 0) AS issue, o.blurb FROM once o LEFT JOIN byf ON o.folder = byf.folder)
SELECT id, title, f.folder, f.issue, issue_name, blurb FROM filled f LEFT JOIN names ON f.issue = names.issue""",
        "folders_seen": f"""WITH f AS (SELECT article_id, regexp_extract({_URLPATH}, '^/issues/([^/]+/[^/]+)/', 1) AS folder FROM pages WHERE url IS NOT NULL AND article_id IS NOT NULL)
          SELECT article_id, folder, n FROM (SELECT article_id, folder, count(*) AS n FROM f WHERE folder <> '' GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY article_id ORDER BY n DESC, folder) = 1""",
        "variants": """WITH v AS (SELECT DISTINCT article_id, coalesce(page_path, '') AS page_path FROM pages WHERE article_id IS NOT NULL), o AS (SELECT *, CASE WHEN page_path IN ('', 'main', 'index.php') THEN 0 WHEN regexp_matches(page_path, '^(page|index)[0-9]') THEN 1 ELSE 2 END AS a,
          coalesce(try_cast(nullif(regexp_extract(page_path, '([0-9]+)', 1), '') AS INT), 1000000) AS b FROM v)
          SELECT article_id, page_path, row_number() OVER w AS seq, lag(page_path) OVER w AS previous, lead(page_path) OVER w AS next FROM o WINDOW w AS (PARTITION BY article_id ORDER BY a, b, page_path)""",
        "issue_contents": ARTICLES + """, votes AS (SELECT folder, issue, count(*) AS k FROM once WHERE issue IS NOT NULL AND folder IS NOT NULL GROUP BY 1, 2
), byf AS (SELECT folder, arg_min(issue, (-k, issue)) AS fi FROM votes GROUP BY 1), filled AS (SELECT o.id, o.title, coalesce(o.issue, fi, 0) AS issue FROM once o LEFT JOIN byf ON o.folder = byf.folder)
SELECT o.issue, n.issue_name AS name, count(*) AS n, string_agg(title, ' | ' ORDER BY id) AS titles FROM filled o LEFT JOIN names n ON o.issue = n.issue WHERE o.issue > 0 GROUP BY 1, 2""",
        "sitemap": f"""SELECT 'https://www.lampmag.example' || path AS loc, CASE WHEN path = '/' THEN '1.0' WHEN regexp_matches(path, '^/issues/[^/]+/?$') THEN '0.8' WHEN regexp_matches(path, '^/issues/[^/]+/[^/]+/?$') THEN '0.7' ELSE '0.5' END AS priority,
          CASE WHEN d IS NOT NULL THEN substr(d, 1, 4) || '-' || substr(d, 5, 2) || '-' || substr(d, 7, 2) END AS lastmod
          FROM (SELECT path, max(d) FILTER (length(d) = 8) AS d FROM (SELECT {_URLPATH} AS path, substr(regexp_replace(ts, '[^0-9]', '', 'g'), 1, 8) AS d FROM pages WHERE url IS NOT NULL) GROUP BY 1)""",
        "output_paths": PREPARED + """, b AS (SELECT page, kind, regexp_extract(page, '^/?([^?]*)', 1) AS path, regexp_extract(page, '\\?(.*)$', 1) AS query FROM manifest WHERE rank = 1
          ), c AS (SELECT *, CASE WHEN path = '' OR path LIKE '%/' THEN path || 'index.html' ELSE path END AS base, regexp_replace(replace(query, '=', '_'), '[^A-Za-z0-9_.-]+', '-', 'g') AS slug FROM b
          ), d AS (SELECT *, CASE WHEN length(slug) > 80 THEN substr(slug, 1, 60) || '-' || substr(sha1(query), 1, 8) ELSE slug END AS short, regexp_extract(base, '(\\.[^./]*)$', 1) AS ext FROM c
          ), e AS (SELECT page, query, regexp_replace(base, '\\.[^./]*$', '') || CASE WHEN short = '' THEN '' ELSE '-' || short END || CASE WHEN kind = 'html' AND lower(ext) NOT IN ('.html', '.htm') THEN '.html' ELSE ext END AS name FROM d
          ), f AS (SELECT *, row_number() OVER (PARTITION BY lower(name) ORDER BY CASE WHEN query = '' THEN 0 ELSE len(string_split(query, '&')) END, length(page), page) AS nr FROM e)
          SELECT page, CASE WHEN nr = 1 THEN name ELSE regexp_replace(name, '\\.[^./]*$', '') || '-' || nr || regexp_extract(name, '(\\.[^./]*)$', 1) END AS out_path FROM f""",
        "event_views": "SELECT event_type, count(*) AS views, min(ts) AS first_view, max(ts) AS last_view, count(DISTINCT user_id) AS readers FROM events GROUP BY 1",
        "frame_issues": """SELECT f.issue, name, frames, with_footer, menu_links FROM (SELECT issue, count(*) AS frames, count(footer) AS with_footer, max(len(regexp_extract_all(coalesce(menu, ''), '(?i)<a\\s'))) AS menu_links FROM frames GROUP BY 1) f
          LEFT JOIN (SELECT issue, min(name) AS name FROM issues GROUP BY 1) i ON f.issue = i.issue""",
        "issue_colors": """SELECT issue, coalesce(color_dark, (SELECT color_dark FROM issues WHERE color_dark IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, color_dark LIMIT 1)) AS color FROM issues""",
        "unique_titles_check": f"""SELECT count(*) AS n, count(DISTINCT title) AS titles FROM (SELECT {_TIDY("regexp_extract(html, '(?is)<title>([^<]*)</title>', 1)")} AS title FROM pages WHERE html IS NOT NULL) WHERE title <> ''""",
    }
