"""SQL of the further core queries, with the fixed values written out, so that it does not share them with the operators."""

from __future__ import annotations

from restitch.plans.sql import _REVIEWED, PREPARED

HREF = r"""(?i)<a\s[^>]*?href\s*=\s*("[^"]*"|''[^'']*''|[^\s>"'']+)"""
IMG = r"""(?i)<img\s[^>]*?src\s*=\s*("[^"]*"|''[^'']*''|[^\s>"'']+)"""


def unq(x: str) -> str:
    return f"""regexp_replace(regexp_replace({x}, '^["'']', ''), '["'']$', '')"""


def path(u: str) -> str:
    p = f"regexp_extract(regexp_replace({u}, '^([A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*', ''), '^([^?#]*)', 1)"
    return f"(CASE WHEN {p} = '' THEN '/' ELSE {p} END)"


def squeeze(x: str) -> str:
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '<[^>]+>', ' ', 'g')"


def tidy(x: str) -> str:
    return rf"""regexp_replace({squeeze(x)}, '\s+([,.;:!?])(\s|$|["”’)])', '\1\2', 'g')"""


def clip(x: str, n: int) -> str:
    t = tidy(x)
    h = f"substr({t}, 1, {n - 1})"
    return f"(CASE WHEN length({t}) <= {n} THEN {t} ELSE regexp_replace(CASE WHEN instr({h}, ' ') > 0 THEN regexp_replace({h}, ' [^ ]*$', '') ELSE {h} END, '[ ,;:—-]+$', '') || '…' END)"


def shout(x: str) -> str:
    return rf"array_to_string(list_transform(string_split({x}, ' — '), lambda s: CASE WHEN length(regexp_replace(s, '[^\p{{Lu}}]', '', 'g')) > 0.6 * greatest(length(regexp_replace(s, '[^\p{{L}}]', '', 'g')), 1) THEN lower(s) ELSE s END), ' — ')"


def sentences2(a: str, b: str) -> str:
    a, b = tidy(f"coalesce({a}, '')"), tidy(f"coalesce({b}, '')")
    return f"(CASE WHEN {a} = '' THEN {b} WHEN {b} = '' THEN {a} ELSE {a} || CASE WHEN regexp_matches({a}, '[.!?…]$') THEN ' ' ELSE '. ' END || {b} END)"


def esc(x: str) -> str:
    return f"""replace(replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;')"""


def resolved(base: str, ref: str) -> str:
    bare = f"regexp_replace({ref}, '[?#].*$', '')"
    full = f"(CASE WHEN {bare} = '' THEN {base} WHEN {bare} LIKE '/%' THEN {bare} ELSE regexp_extract({base}, '^(.*/)', 1) || {bare} END)"
    up = f"list_reduce(list_prepend('', list_filter(string_split({full}, '/'), lambda x: x NOT IN ('', '.'))), lambda acc, x: CASE WHEN x = '..' THEN regexp_replace(acc, '/[^/]*$', '') ELSE acc || '/' || x END)"
    return rf"(CASE WHEN regexp_matches({full}, '/(\.{{1,2}})?$') OR {up} = '' THEN {up} || '/' ELSE {up} END)"


ARTICLES = """arts AS (
  SELECT id, arg_min(t, (length(regexp_replace(t, '[^A-Z]', '', 'g')), t)) AS title, min(folder) AS folder, min(issue) AS issue, min(blurb) AS blurb
  FROM (SELECT *, trim(title) AS t FROM articles) GROUP BY id
)"""

LINKS = rf"""pl AS (
  SELECT page_id, path, ref, {resolved('path', 'ref')} AS target FROM (
    SELECT page_id, path, unnest(list_distinct(list_transform(regexp_extract_all(html, '{HREF}', 1), lambda x: {unq('x')}))) AS ref
    FROM (SELECT *, {path('url')} AS path FROM pages WHERE html IS NOT NULL AND url IS NOT NULL))
  WHERE NOT regexp_matches(ref, '^([A-Za-z][A-Za-z0-9+.-]*:|//|#|$)')
), have AS (SELECT DISTINCT {path('url')} AS t FROM pages WHERE url IS NOT NULL
), keys AS (SELECT t FROM have UNION SELECT regexp_extract(t, '^(.*/)', 1) FROM have UNION SELECT regexp_replace(regexp_extract(t, '^(.*/)', 1), '/$', '') FROM have
), lk AS (SELECT page_id, path, ref, target, target IN (SELECT t FROM keys) AS known FROM pl)"""

REL = """(SELECT CASE WHEN r = '' THEN './' ELSE r END FROM (SELECT repeat('../', (len(p) - c)::INT) || array_to_string(t[c + 1:], '/') AS r FROM (
  SELECT t, p, list_reduce(list_prepend(0::BIGINT, range(1, greatest(least(len(t) - 1, len(p)), 1) + 1)), lambda k, i: CASE WHEN k = i - 1 AND t[i] = p[i] THEN i ELSE k END) AS c
  FROM (SELECT string_split(target, '/') AS t, string_split(path, '/')[:-2] AS p))))"""

PAIRS = r"""list_transform(list_filter(string_split(regexp_extract(page, '\?(.*)$', 1), '&'), lambda x: x <> ''), lambda x: {'k': regexp_extract(x, '^([^=]*)', 1), 'v': regexp_extract(x, '^[^=]*=(.*)$', 1)})"""


def val(k: str) -> str:
    return f"list_filter(q, lambda p: p.k = '{k}')[1].v"


VARIANT = "array_to_string(list_transform(list_filter(q, lambda p: p.k <> 'article' AND NOT (p.k = 'page' AND p.v IN ('', 'main', 'index'))), lambda p: p.k || '=' || p.v), '&')"

ROUTES = PREPARED + rf""", base AS (SELECT article_id::VARCHAR AS a, min(regexp_extract({path('url')}, '^(.*/)', 1)) AS base FROM pages WHERE article_id IS NOT NULL AND url IS NOT NULL GROUP BY 1
), f AS (SELECT page, {PAIRS} AS q FROM manifest WHERE rank = 1 AND NOT demoted
), cap AS (SELECT DISTINCT {val('article')} AS a, {VARIANT} AS v FROM f WHERE page LIKE '/main.php?%'
), ks AS (
  SELECT 'article:' || a AS key, base AS target, 'article' AS how FROM base
  UNION ALL SELECT 'article:' || a || ':' || v, base || regexp_replace(v, '[=&]+', '-', 'g') || '/', 'variant' FROM cap JOIN base USING (a) WHERE v <> ''
  UNION ALL SELECT 'issue:' || issue, '/issues/' || issue || '/', 'issue' FROM issues WHERE issue IS NOT NULL
  UNION ALL SELECT 'archive:' || page, '/archive' || page, 'archive' FROM f
  UNION ALL SELECT 'home', '/', 'home'
), old AS (SELECT DISTINCT page, regexp_extract(page, '^([^?]*)', 1) AS path, regexp_extract(page, '\?(.*)$', 1) AS query, {PAIRS} AS q FROM prep
), o2 AS (SELECT *, path IN ('/', '/main.php', '/index.php', '/gallery.php') AS script, {val('article')} AS article, {val('issue')} AS issue, {VARIANT} AS variant FROM old
), asked AS (
  SELECT page, 0 AS rank, 'article:' || article || ':' || variant AS key FROM o2 WHERE script
  UNION ALL SELECT page, 1, 'article:' || article FROM o2 WHERE script
  UNION ALL SELECT page, 2, 'issue:' || issue FROM o2 WHERE script
  UNION ALL SELECT page, 3, 'archive:' || page FROM o2 WHERE script AND query <> ''
  UNION ALL SELECT page, 4, 'archive:/main.php?' || query FROM o2 WHERE script AND query <> ''
  UNION ALL SELECT page, 5, 'archive:/?' || query FROM o2 WHERE script AND query <> ''
  UNION ALL SELECT page, 6, 'home' FROM o2 WHERE script
  UNION ALL SELECT page, 7, 'archive:' || page FROM o2 WHERE NOT script
  UNION ALL SELECT page, 8, 'archive:' || path FROM o2 WHERE NOT script
), best AS (SELECT page, target, how FROM asked JOIN ks USING (key) QUALIFY row_number() OVER (PARTITION BY page ORDER BY rank, target, how) = 1)
SELECT o.page, b.target, coalesce(b.how, 'none') AS how FROM (SELECT DISTINCT page FROM old) o LEFT JOIN best b USING (page)"""

VERSIONS = PREPARED + """, vers AS (
  SELECT * FROM (SELECT page, ts, row_number() OVER w AS version, count(*) OVER (PARTITION BY page) AS versions, lag(ts) OVER w AS previous, lead(ts) OVER w AS nxt
    FROM manifest WHERE NOT demoted WINDOW w AS (PARTITION BY page ORDER BY ts, rec_id)) WHERE versions >= 2
)
"""

_STAMP = r"regexp_replace({}, '^(\d{{4}})(\d{{2}})(\d{{2}})(\d{{6}})$', '\1-\2-\3_\4')"

MENU = r"""tok AS (
  SELECT frame_id, issue, ts, unnest(t) AS tok, generate_subscripts(t, 1) - 1 AS pos FROM (
    SELECT *, regexp_extract_all(menu, '(?is)(<h4[^>]*>.*?</h4>|<span class="submenu_title"[^>]*>.*?</span>|<a\s[^>]*href="[^"]*"[^>]*>.*?</a>)', 1) AS t FROM frames WHERE menu IS NOT NULL)
), me AS (
  SELECT *, coalesce(last_value(CASE WHEN NOT link THEN text END IGNORE NULLS) OVER (PARTITION BY frame_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '') AS section
  FROM (SELECT *, regexp_matches(tok, '(?i)^<a\s') AS link, """ + squeeze(strip("tok")) + r""" AS text, regexp_extract(tok, '(?i)href="/issues/[^/"]+/([^/"]+)/', 1) AS folder FROM tok)
), mt AS (
  SELECT issue, folder, text AS title, section, pos FROM me WHERE link AND folder <> ''
  QUALIFY row_number() OVER (PARTITION BY issue, folder ORDER BY coalesce(ts, '9'), frame_id, pos, text, section) = 1
)"""

NAMES = ARTICLES + ", " + MENU + r""", dn AS (
  SELECT id, a.issue, a.folder, regexp_replace(CASE
    WHEN coalesce(m.title, '') = '' OR regexp_matches(m.title, '(\.\.\.|…)$') THEN coalesce(a.title, '')
    WHEN regexp_replace(lower(m.title), '[^\p{L}\p{N}_]', '', 'g') = regexp_replace(lower(coalesce(a.title, '')), '[^\p{L}\p{N}_]', '', 'g')
      THEN CASE WHEN length(regexp_replace(m.title, '[^\p{Lu}]', '', 'g')) <= length(regexp_replace(coalesce(a.title, ''), '[^\p{Lu}]', '', 'g')) THEN m.title ELSE coalesce(a.title, '') END
    ELSE m.title END, '(?i)^(feature|fashion)\s+-\s+', '') AS name, m.section, m.pos
  FROM arts a LEFT JOIN mt m ON a.issue = m.issue AND a.folder = m.folder
)"""

FIRSTS = r"""copies AS (
  SELECT page_id, first_value(page_id) OVER (PARTITION BY k ORDER BY coalesce(article_id, 1152921504606846976), page_id) AS first
  FROM (SELECT page_id, article_id, trim(regexp_replace(html, '\s+', ' ', 'g')) AS k FROM pages WHERE html IS NOT NULL AND trim(html) <> '')
), own AS (SELECT page_id FROM copies WHERE first = page_id)"""

CREDITS = r"""cl AS (
  SELECT article_id, trim(regexp_replace(regexp_replace(line, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) AS t
  FROM (SELECT article_id, unnest(string_split(html, chr(10))) AS line FROM pages WHERE html IS NOT NULL AND article_id IS NOT NULL)
), cr AS (
  SELECT DISTINCT article_id, role, name FROM (
    SELECT article_id, 'words' AS role, lower(regexp_extract(t, '(?i)^words: ([a-z][a-z.''\- ]{1,40})$', 1)) AS name FROM cl WHERE length(t) BETWEEN 4 AND 60
    UNION ALL SELECT article_id, 'photos and text', lower(regexp_extract(t, '(?i)^photos and text by ([a-z][a-z.''\- ]{1,40})$', 1)) FROM cl WHERE length(t) BETWEEN 4 AND 60
    UNION ALL SELECT article_id, 'by', lower(regexp_extract(t, '(?i)^by ([a-z][a-z.''\- ]{1,40})$', 1)) FROM cl WHERE length(t) BETWEEN 4 AND 60
    UNION ALL SELECT article_id, 'reports', lower(regexp_extract(t, '(?i)^([a-z][a-z.''\- ]{1,40}) reports$', 1)) FROM cl WHERE length(t) BETWEEN 4 AND 60
  ) WHERE name <> '' AND len(string_split(name, ' ')) <= 4
), kinds2 AS (SELECT *, CASE WHEN role IN ('by', 'words', 'photos and text', 'reports') THEN 'authors' WHEN role = 'edited' THEN 'editors' ELSE 'others' END AS kind FROM cr
), phr AS (SELECT article_id, role, CASE WHEN role = 'by' THEN '' ELSE role || ' ' END || 'by ' || string_agg(name, ' and ' ORDER BY name) AS p FROM cr GROUP BY 1, 2
), cline AS (SELECT article_id, string_agg(p, ', ' ORDER BY role, p) AS line FROM phr GROUP BY 1)"""

PICS = rf"""pic AS (
  SELECT article_id, page_id, page_path, pos, {resolved('path', 'src')} AS src, width, height FROM (
    SELECT article_id, page_id, page_path, path, pos, {unq(f"regexp_extract(tag, '{IMG}', 1)")} AS src,
      TRY_CAST(nullif(regexp_extract(tag, '(?i)width\s*=\s*"?([0-9]+)', 1), '') AS INT) AS width, TRY_CAST(nullif(regexp_extract(tag, '(?i)height\s*=\s*"?([0-9]+)', 1), '') AS INT) AS height
    FROM (SELECT article_id, page_id, page_path, path, unnest(t) AS tag, generate_subscripts(t, 1) - 1 AS pos FROM (
      SELECT *, {path('url')} AS path, regexp_extract_all(html, '(?i)(<img\s[^>]*>)', 1) AS t FROM pages WHERE html IS NOT NULL AND article_id IS NOT NULL AND url IS NOT NULL)))
  WHERE src <> ''
)"""

_LABEL = r"""(CASE WHEN regexp_matches(pp, '^[0-9]+$') THEN 'page ' || pp WHEN regexp_matches(pp, '^(page|index)[0-9]+(\.[a-z]+)?$') THEN 'page ' || regexp_extract(pp, '([0-9]+)', 1)
  WHEN regexp_matches(pp, '^[ab][0-9]+$') THEN 'side ' || substr(pp, 1, 1) || ', song ' || regexp_extract(pp, '([0-9]+)', 1) WHEN pp = 'pos' THEN 'for' WHEN pp = 'neg' THEN 'against'
  WHEN regexp_matches(pp, '^[a-z]$') THEN 'choice ' || pp ELSE trim(regexp_replace(pp, '[^a-z0-9]+', ' ', 'g')) END)"""
PROFANE = r"(?i)\b(fuck\w*|shit\w*|bitch\w*|cunt\w*|cocks?|cocksuck\w*|dick|pussy|motherf\w*|asshole\w*|whore\w*|slut\w*)\b"
_TITLE = tidy(r"regexp_extract(html, '(?is)<title>([^<]*)</title>', 1)")
_EMAIL = r"(?i)([\w.+-]+@[\w-]+(?:\.[\w-]+)*\.[a-z]{2,})"
_IPV4 = r"\b(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\b"
_TYPES = "{'jpg': 'image/jpeg', 'jpeg': 'image/jpeg', 'gif': 'image/gif', 'png': 'image/png', 'bmp': 'image/bmp', 'ico': 'image/x-icon', 'css': 'text/css', 'html': 'text/html', 'htm': 'text/html', 'pdf': 'application/pdf', 'doc': 'application/msword', 'txt': 'text/plain', 'js': 'application/javascript', 'xml': 'text/xml', 'swf': 'application/x-shockwave-flash', 'mov': 'video/quicktime', 'mp3': 'audio/mpeg', 'wav': 'audio/wav'}"
_MAP = "MAP " + _TYPES


def _resolution(where: str, name: str) -> str:
    """The resolution CTEs over a part of the captures, with names of their own."""
    body = PREPARED.strip().removeprefix("WITH ").replace("FROM captures WHERE url IS NOT NULL", f"FROM captures WHERE url IS NOT NULL AND {where}")
    return f"{name} AS (WITH {body} SELECT page, count(*) AS n, max(CASE WHEN rank = 1 THEN digest END) AS top FROM manifest GROUP BY 1)"


_SCRIPT_PART = "extn"


def _import(rec: str) -> str:
    return rec + rf""", ho AS (
  SELECT page AS path FROM prep WHERE lower(regexp_extract(regexp_extract(page, '^([^?]*)', 1), '[^/.][^/]*\.([^/.]*)$', 1)) IN ('jpg', 'jpeg', 'gif', 'png', 'bmp', 'ico', 'swf', 'pdf', 'doc', 'css', 'js')
    AND coalesce(source, '') <> 'server' GROUP BY 1 HAVING bool_and(mime LIKE 'text/html%')
), si AS (
  SELECT rec_id, path, CASE
    WHEN NOT (status IN ('only on the server', 'same content under another name') OR (status = 'archived with different content' AND path IN (SELECT path FROM ho))) THEN 'already archived'
    WHEN regexp_matches(path, '/\.') THEN 'hidden path' WHEN ext = '' THEN 'no extension' WHEN {_MAP}[ext] IS NULL THEN 'unknown .' || ext END AS reason, {_MAP}[ext] AS mime
  FROM (SELECT *, lower(regexp_extract(path, '[^/.][^/]*\.([^/.]*)$', 1)) AS ext FROM rec)
)
"""


def queries(rec: str) -> dict[str, str]:
    """rec: the SQL prefix that defines prep and the reconciled server files."""
    links = "WITH " + LINKS
    photo_rows = f"""WITH {ARTICLES}, {CREDITS}, pg AS (SELECT page_id, article_id, lower(coalesce(page_path, '')) AS path FROM pages WHERE article_id IS NOT NULL
), pn AS (SELECT article_id, path, row_number() OVER (PARTITION BY article_id ORDER BY regexp_extract(path, '([0-9]+)', 1)::INT, path) AS k, count(*) OVER (PARTITION BY article_id) AS n
  FROM (SELECT DISTINCT article_id, path FROM pg WHERE regexp_matches(path, '^photo[0-9]+$'))
), j AS (
  SELECT page_id, pg.path IN ('', 'main', 'index', 'index.php') AS start, CASE WHEN regexp_matches(pg.path, '^photo[0-9]+$') THEN 'photo ' || k || ' of ' || n ELSE {_LABEL.replace('pp', "trim(pg.path, '/')")} END AS label,
    coalesce({shout(tidy("coalesce(a.title, '')"))}, '') AS title, blurb, coalesce(issue, 0) AS issue, line
  FROM pg LEFT JOIN pn ON pg.article_id = pn.article_id AND pg.path = pn.path LEFT JOIN arts a ON a.id = pg.article_id LEFT JOIN cline c ON c.article_id = pg.article_id
), k AS (SELECT *, CASE WHEN start THEN title ELSE title || ', ' || label END AS nm, CASE WHEN start AND line IS NOT NULL AND length(title || ', ' || line) <= 55 THEN title || ', ' || line WHEN start THEN title ELSE title || ', ' || label END AS hd,
  CASE WHEN start THEN title ELSE label || ' of ' || title END || ', issue ' || issue || '.' AS loc FROM j
), d AS (SELECT *, {clip(sentences2("CASE WHEN start THEN blurb END", "loc"), 160)} AS full_text FROM k)
SELECT page_id, {clip('nm', 90)} AS name, {clip('hd', 55)} AS head, CASE WHEN regexp_matches(full_text, '{PROFANE}') THEN {clip('loc', 160)} ELSE full_text END AS description FROM d"""
    return {
        "link_report": links + " SELECT target, known, count(*) AS links, count(DISTINCT page_id) AS pages FROM lk GROUP BY 1, 2",
        "relative_links": links + f" SELECT ref, path, {REL} AS rel, count(*) AS n FROM lk WHERE known GROUP BY 1, 2, 3",
        "routes": ROUTES,
"published_variants": PREPARED + rf""", v0 AS (SELECT page, {PAIRS} AS q FROM manifest WHERE rank = 1 AND kind = 'html' AND page LIKE '/main.php?%'
), v1 AS (SELECT page, {val('article')} AS a, coalesce({val('page')}, 'main') AS p, coalesce({val('view')}, '') AS vw FROM v0
), v2 AS (SELECT a::BIGINT AS article_id, CASE WHEN p IN ('', 'main', 'index') THEN '' ELSE lower(p) || '/' END || CASE WHEN vw = '' THEN '' ELSE 'view-' || vw || '/' END AS variant_path, page, p, vw FROM v1 WHERE regexp_matches(a, '^[0-9]{{1,9}}$')
  QUALIFY row_number() OVER (PARTITION BY article_id, variant_path ORDER BY page, p, vw) = 1)
SELECT article_id, variant_path, page, row_number() OVER (PARTITION BY article_id ORDER BY CASE WHEN p IN ('', 'main', 'index') THEN 0 WHEN regexp_matches(p, '^[a-z]*[0-9]+$') THEN 1 ELSE 2 END,
  coalesce(TRY_CAST(nullif(regexp_extract(p, '^[a-z]*([0-9]+)$', 1), '') AS INT), 1000000), p, coalesce(TRY_CAST(nullif(regexp_extract(vw, '^[a-z]*([0-9]+)$', 1), '') AS INT), 1000000), vw)::INT AS seq FROM v2""",
        "year_index": VERSIONS + "SELECT page, substr(ts, 1, 4) AS year, count(*) AS versions, min(ts) AS first_ts, max(ts) AS last_ts FROM vers GROUP BY 1, 2",
        "history_pages": VERSIONS + rf"""SELECT page, version::INT AS version, 'history/' || CASE WHEN nm = '' THEN 'front' ELSE nm END || '/' || {_STAMP.format('ts')} || '.html' AS out_path, 'version ' || version || ' of ' || versions AS label,
  {_STAMP.format('previous')} || '.html' AS previous, {_STAMP.format('nxt')} || '.html' AS next
FROM (SELECT *, regexp_replace(regexp_replace(page, '[^A-Za-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS nm FROM vers)""",
        "root_aliases": PREPARED + "SELECT page, CASE WHEN '/main.php' || substr(page, 2) IN (SELECT page FROM prep) THEN '/main.php' || substr(page, 2) ELSE '/' END AS target FROM (SELECT DISTINCT page FROM prep) WHERE page LIKE '/?%'",
        "page_map": rf"""WITH p AS (SELECT page_id, {path('url')} AS path, coalesce(ts, '') AS ts, html, substr(html, 1, 6000) AS head FROM pages WHERE url IS NOT NULL AND html IS NOT NULL AND trim(html) <> ''
), l AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY path ORDER BY ts DESC, page_id DESC) = 1
), k AS (SELECT *, 'https://www.lampmag.example' || path AS loc, regexp_extract(regexp_replace(ts, '[^0-9]', '', 'g'), '^(\d{{8}})', 1) AS day, {_TITLE} AS title,
    list_transform(regexp_extract_all(html, '{IMG}', 1), lambda x: {unq('x')}) AS i0 FROM l
  WHERE NOT regexp_matches(head, '(?i)<meta\s[^>]*name\s*=\s*["'']?robots[^>]*noindex') AND NOT regexp_matches(head, '(?i)<meta\s[^>]*http-equiv\s*=\s*["'']?refresh')
    AND NOT regexp_matches(path, '^/(main\.php|gallery\.php|history/)|/photo[0-9]+$') AND regexp_matches(head, '(?i)<(html|body|table|div|p)\b')
    AND regexp_extract(head, '(?i)<link\s[^>]*rel\s*=\s*["'']?canonical["'']?\s[^>]*href\s*=\s*["'']([^"'']*)', 1) IN ('', 'https://www.lampmag.example' || path)
), m AS (SELECT *, CASE WHEN length(day) = 8 THEN substr(day, 1, 4) || '-' || substr(day, 5, 2) || '-' || substr(day, 7, 2) END AS lastmod,
    CASE WHEN path = '/' THEN '1.0' WHEN regexp_matches(path, '^/issues/[^/]+/?$') THEN '0.8' WHEN regexp_matches(path, '^/issues/[^/]+/[^/]+/$') THEN '0.6' WHEN path LIKE '/issues/%' THEN '0.4' ELSE '0.3' END AS priority,
    list_filter(i0, lambda x, i: list_position(i0, x) = i)[:1000] AS imgs,
    CASE WHEN title = '' THEN '' ELSE '<image:title>' || {esc("substr(split_part(title, ' — ', 1), 1, 100)")} || '</image:title><image:caption>' || {esc('title')} || '</image:caption>' END AS caption FROM k)
SELECT loc, lastmod, priority, len(imgs)::INT AS n_images, '<url><loc>' || {esc('loc')} || '</loc>' || coalesce('<lastmod>' || lastmod || '</lastmod>', '') || '<priority>' || priority || '</priority>'
  || coalesce(array_to_string(list_transform(imgs, lambda s: '<image:image><image:loc>' || {esc("'https://www.lampmag.example' || " + resolved('path', 's'))} || '</image:loc>' || caption || '</image:image>'), ''), '') || '</url>' AS xml FROM m""",
        "tagged": r"""SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--archive-->.*?<!--/archive-->', '', 'g'), '(?i)<meta\s[^>]*charset[^>]*>', '', 'g'),
  '(?i)(<head>)', '\1<meta charset="utf-8">', 'g'), '(?i)<html>', '<html lang="en">', 'g'), '(?i)(<head>)', '\1<!--archive--><link rel="icon" href="/icon.png"><!--/archive-->', 'g'),
  '(?i)(</body>)', '<!--archive--><p><a href="/about/">about this archive</a></p><!--/archive-->\1', 'g') AS html FROM pages WHERE html IS NOT NULL""",
        "forwarded": PREPARED + rf"SELECT page, len(list_filter({PAIRS}, lambda p: NOT regexp_matches(p.k, '^(utm_[a-z]+|gclid|fbclid)$'))) > 0 AS forward FROM (SELECT DISTINCT page FROM prep WHERE path = '/')",
        "media_types": PREPARED + rf"SELECT ext, mime, count(*) AS n, coalesce({_MAP}[ext] = mime, false) AS fits FROM (SELECT mime, lower(regexp_extract(path, '[^/.][^/]*\.([^/.]*)$', 1)) AS ext FROM prep) GROUP BY ext, mime",
        "server_import": _import(rec) + "SELECT rec_id, path, CASE WHEN reason IS NULL THEN mime END AS mime, reason FROM si",
        "import_report": _import(rec) + "SELECT coalesce(reason, 'imported') AS reason, count(*) AS n, count(DISTINCT path) AS paths FROM si GROUP BY 1",
        "findings": rf"""WITH t AS (SELECT comment_id, coalesce(text, '') AS t FROM comments WHERE comment_id IS NOT NULL), f AS (
  SELECT comment_id, 'email' AS category FROM t WHERE regexp_matches(t, '{_EMAIL}') UNION ALL SELECT comment_id, 'IPv4' FROM t WHERE regexp_matches(t, '{_IPV4}')
  UNION ALL SELECT comment_id, 'private reference' FROM t WHERE contains(t, 'lampmag.example/private')
  UNION ALL SELECT comment_id, 'malware' FROM t WHERE regexp_matches(t, '(?i)(?:eval|assert)\s*\(\s*(?:base64_decode|gzinflate|str_rot13)|hacked\s+by')
), r AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY comment_id) AS rn FROM f)
SELECT category, count(*) AS n, string_agg(comment_id::VARCHAR, ', ' ORDER BY comment_id) FILTER (rn <= 8) AS first, greatest(count(*) - 8, 0) AS more FROM r GROUP BY 1""",
        "checked_comments": rf"""WITH t AS (SELECT substr({squeeze(strip('text'))}, 1, 120000) AS b FROM comments WHERE text IS NOT NULL
), w AS (SELECT CASE WHEN regexp_matches(b, '(?i)domain (?:name )?(?:is|may be) for sale|buy this domain|this domain is parked|parked (?:free|domain)|domain parking|related searches|this web page is parked|is available for purchase|domain has expired|inquire about this domain')
    THEN 'parked or for-sale domain' WHEN len(list_distinct(list_transform(regexp_extract_all(b, '(?i)\b(casino|slots?|poker|viagra|cialis|porn|xxx|payday|escort|betting|gambling|sportsbook|baccarat|pharmacy|replica)\b', 1), lambda x: lower(x)))) >= 3 THEN 'now a spam site' ELSE 'ok' END AS why FROM t)
SELECT why, count(*) AS n FROM w GROUP BY 1""",
        "work_list": f"""WITH {_resolution('true', 'now_r')}, {_resolution("loaded_at < TIMESTAMP '2012-01-01'", 'old_r')}
SELECT page, why FROM (SELECT n.page, CASE WHEN o.page IS NULL THEN 'new' WHEN o.top <> n.top THEN 'other first choice' WHEN o.n <> n.n THEN 'other candidates' END AS why FROM now_r n LEFT JOIN old_r o USING (page)) WHERE why IS NOT NULL""",
        "unverified": PREPARED + """SELECT DISTINCT page, ts, source FROM prep p WHERE ts IS NOT NULL AND source IN ('commoncrawl', 'server')
  AND NOT EXISTS (SELECT 1 FROM prep d WHERE d.page = p.page AND d.ts = p.ts AND d.verified AND d.source IN ('commoncrawl', 'server'))""",
        "menu_inventory": r"""WITH l AS (SELECT ts, unnest(list_distinct(regexp_extract_all(menu, '(?i)<a\s[^>]*href="(/[^"?#]*)"', 1))) AS path FROM frames WHERE menu IS NOT NULL
), s AS (SELECT path, max(substr(ts, 1, 8)) AS last_seen, count(DISTINCT substr(ts, 1, 8)) AS listings FROM l GROUP BY 1
), rec AS (SELECT DISTINCT regexp_replace(regexp_replace(url, '^(?:[A-Za-z]+:)?//[^/?#]*', ''), '[?#].*$', '') AS path FROM pages WHERE url IS NOT NULL)
SELECT path, path LIKE '%/' AS dir, CASE WHEN path IN (SELECT path FROM rec) OR lower(path) IN (SELECT lower(path) FROM rec) THEN 'have' WHEN regexp_replace(path, '\.[^./]*$', '') IN (SELECT regexp_replace(path, '\.[^./]*$', '') FROM rec) THEN 'stand-in'
  WHEN path LIKE '%/' AND EXISTS (SELECT 1 FROM rec WHERE starts_with(rec.path, s.path)) THEN 'have-part' ELSE 'lost' END AS status, last_seen, listings FROM s""",
        "menu_titles": "WITH " + MENU + " SELECT issue, folder, title, section, pos::INT AS pos FROM mt",
        "display_names": "WITH " + NAMES + " SELECT id, name, section FROM dn",
        "issue_records": "WITH " + NAMES + f""", pl AS (SELECT issue, name, min((coalesce(pos, 1073741824), id)) AS place FROM dn WHERE issue IS NOT NULL GROUP BY 1, 2
), g AS (SELECT issue, count(*) AS n, string_agg(name, ', ' ORDER BY place, name) AS names FROM pl GROUP BY 1
), x AS (SELECT g.issue, n, 'issue ' || g.issue || ', ' || coalesce(label, 'untitled') || '. in this issue: ' || names || '.' AS t FROM g LEFT JOIN (SELECT issue, min(name) AS label FROM issues GROUP BY 1) i USING (issue))
SELECT issue, n, {clip('t', 160)} AS description FROM x""",
        "packed_titles": f"""WITH {ARTICLES}, g AS (SELECT issue, list(title ORDER BY id, title) AS t, 'issue ' || issue || ': ' AS st FROM arts WHERE issue IS NOT NULL AND title IS NOT NULL GROUP BY 1
), k AS (SELECT *, list_filter(range(0, len(t) + 1), lambda k: k = 0 OR length(st || array_to_string(t[1:k], ', ') || ' and more') <= 66) AS ok FROM g)
SELECT issue, st || array_to_string(t[1:list_max(ok)], ', ') || CASE WHEN list_max(ok) < len(t) THEN ' and more' ELSE '' END AS head, list_max(ok)::INT AS shown, len(t)::INT AS n FROM k""",
        "unique_titles": "WITH " + FIRSTS + f""", t AS (SELECT page_id, {_TITLE} AS t FROM pages WHERE html IS NOT NULL AND page_id IN (SELECT page_id FROM own)
), r AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY page_id) AS k FROM t WHERE t <> '')
SELECT page_id, t || CASE WHEN k > 1 THEN ' (' || k || ')' ELSE '' END || ' | lampmag' AS title FROM r""",
        "credit_lines": "WITH " + CREDITS + """ SELECT c.article_id, line, coalesce(string_agg(DISTINCT name, ', ' ORDER BY name) FILTER (kind = 'authors'), '') AS authors,
  coalesce(string_agg(DISTINCT name, ', ' ORDER BY name) FILTER (kind = 'editors'), '') AS editors, coalesce(string_agg(DISTINCT name, ', ' ORDER BY name) FILTER (kind = 'others'), '') AS others
FROM kinds2 c JOIN cline USING (article_id) GROUP BY 1, 2""",
        "contributor_pages": f"""WITH {ARTICLES}, {CREDITS}, c AS (SELECT name, article_id, coalesce(issue, 0) AS issue, coalesce(title, '') AS title,
    CASE role WHEN 'by' THEN 'wrote' WHEN 'words' THEN 'wrote' WHEN 'photos and text' THEN 'took photos' WHEN 'reports' THEN 'reported' ELSE role END AS did FROM cr LEFT JOIN arts a ON a.id = cr.article_id
), g AS (SELECT name, count(DISTINCT article_id) AS works, list_sort(list(DISTINCT did)) AS did, min(issue) AS a, max(issue) AS b, list_sort(list(DISTINCT {{'i': issue, 'a': article_id, 't': title}})) AS w FROM c GROUP BY 1 HAVING works >= 3
), h AS (SELECT *, list_filter(list_transform(w, lambda x: x.t), lambda x, i: list_position(list_transform(w, lambda y: y.t), x) = i) AS ts FROM g
), k AS (SELECT *, name || ' ' || CASE WHEN len(did) > 1 THEN array_to_string(did[:-2], ', ') || ' and ' || did[-1] ELSE did[1] END || ', ' || CASE WHEN a = b THEN 'issue ' || a ELSE 'issues ' || a || ' to ' || b END || ': '
    || CASE WHEN len(ts) = 1 THEN 'the ' || ts[1] || ' column, ' || works || ' installments' ELSE array_to_string(ts[:6], ', ') || CASE WHEN len(ts) > 6 THEN ' and more' ELSE '' END END || '.' AS t FROM h)
SELECT regexp_replace(regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g') AS slug, name, works, {clip('t', 160)} AS text FROM k""",
        "page_descriptions": photo_rows,
        "lead_pictures": f"""WITH {ARTICLES}, {PICS} SELECT issue, article_id, src, (width * height)::INT AS area FROM pic p JOIN arts a ON a.id = p.article_id WHERE issue IS NOT NULL AND width >= 60 AND height >= 60
QUALIFY row_number() OVER (PARTITION BY issue ORDER BY width * height DESC, article_id, page_id, pos, src DESC) = 1""",
        "photo_canonicals": f"""WITH {FIRSTS}, {PICS}, s AS (SELECT article_id, page_id, src FROM pic WHERE regexp_matches(lower(coalesce(page_path, '')), '^photo[0-9]+$') AND page_id IN (SELECT page_id FROM own)
  QUALIFY row_number() OVER (PARTITION BY article_id, page_id ORDER BY coalesce(width * height, 0) DESC, pos, src DESC) = 1
), r AS (SELECT page_id, min(page_id) OVER (PARTITION BY article_id, src) AS canonical FROM s)
SELECT page_id, canonical FROM r WHERE page_id <> canonical""",
        "galleries": f"""WITH {PICS}, d AS (SELECT DISTINCT page_id, src FROM pic
), t AS (SELECT page_id, regexp_extract(src, '(?i)^(.*/)?([^/]*?)([0-9]+)(_?)t(x?)\\.(jpe?g|gif|png)$', ['folder', 'prefix', 'num', 'sep', 'x', 'ext']) AS m FROM d WHERE regexp_matches(src, '(?i)^(.*/)?([^/]*?)([0-9]+)(_?)t(x?)\\.(jpe?g|gif|png)$')
), y AS (SELECT page_id, m.folder AS folder, m.num AS num, unnest([m.ext, 'jpg', 'gif', 'jpeg', 'png']) AS e, unnest([0, 1, 2, 3, 4]) AS rank, m.prefix AS prefix FROM t
), fl AS (SELECT page_id, folder, num, folder || prefix || num || '.' || e AS full_src FROM y WHERE folder || prefix || num || '.' || e IN (SELECT src FROM d) QUALIFY row_number() OVER (PARTITION BY page_id, folder, num ORDER BY rank) = 1)
SELECT fl.page_id, folder, count(DISTINCT full_src) AS thumbs, count(d.src) AS shown FROM fl LEFT JOIN d ON d.page_id = fl.page_id AND d.src = full_src GROUP BY 1, 2 HAVING count(DISTINCT full_src) >= 2 AND count(d.src) > 0""",
        "missing_views": r"""WITH l AS (SELECT DISTINCT unnest(regexp_extract_all(html, '(?i)href="/?(main\.php\?[^"]*)"', 1)) AS ref FROM pages WHERE html IS NOT NULL
), q AS (SELECT '&' || replace(regexp_extract(ref, '\?(.*)$', 1), '&amp;', '&') AS q FROM l
), w AS (SELECT DISTINCT regexp_extract(q, '&article=([^&]*)', 1) AS a, regexp_extract(q, '&view=([^&]*)', 1) AS v FROM q
), x AS (SELECT a::BIGINT AS article_id, 'photo' || v AS path FROM w WHERE regexp_matches(a, '^[0-9]{1,9}$') AND regexp_matches(v, '^[0-9]+$')
), h AS (SELECT DISTINCT article_id, page_path AS path FROM pages WHERE article_id IS NOT NULL AND regexp_matches(page_path, '^photo[0-9]+$'))
SELECT x.article_id, x.path, t.template FROM x LEFT JOIN (SELECT article_id, max(path) AS template FROM h GROUP BY 1) t USING (article_id) WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.article_id = x.article_id AND h.path = x.path)""",
        "visible_pages": r"""WITH b AS (SELECT article_id, page_path, has_comments, regexp_replace(regexp_replace(coalesce(html, ''), '(?is)<head\b.*?</head>|<script\b.*?</script>|<style\b.*?</style>', '', 'g'), '&nbsp;|\s', '', 'g') AS b FROM pages WHERE article_id IS NOT NULL)
SELECT article_id, count(*) AS pages, count(*) FILTER (regexp_replace(b, '<[^>]*>', '', 'g') = '' AND NOT regexp_matches(b, '(?i)<img')) AS empty, bool_or(coalesce(has_comments, coalesce(page_path, '') = '')) AS comments FROM b GROUP BY 1""",
        "picture_texts": f"""WITH {ARTICLES}, {CREDITS}, {PICS}, f AS (SELECT article_id, src, min((page_id, pos)) AS place FROM pic GROUP BY 1, 2
), pl AS (SELECT article_id, src, row_number() OVER (PARTITION BY article_id ORDER BY place, src) AS k, count(*) OVER (PARTITION BY article_id) AS n FROM f
), x AS (SELECT pl.*, coalesce(title, '') AS title, coalesce(title, '') || coalesce(', ' || line, '') || coalesce(': ' || blurb, '') AS hd FROM pl JOIN arts a ON a.id = pl.article_id LEFT JOIN cline c ON c.article_id = pl.article_id
), y AS (SELECT src, article_id, CASE WHEN k = 1 THEN {sentences2('hd', "'photo'")} ELSE title || ', photo ' || k || ' of ' || n END AS t FROM x)
SELECT src, {clip('t', 280)} AS text FROM y QUALIFY row_number() OVER (PARTITION BY src ORDER BY article_id) = 1""",
        "internal_pages": rf"""WITH b AS (SELECT page_id, {path("coalesce(url, '')")} AS path, substr(coalesce(html, ''), 1, 2048) AS h FROM pages
), r AS (SELECT page_id, CASE WHEN regexp_matches(path, '^/(list|admin|cgi-bin)\b') THEN 'kept back' WHEN regexp_matches(h, '(?i)<title>\s*index of /') THEN 'directory listing' WHEN regexp_matches(h, '(?i)thank you for (signing up|subscribing|joining)') THEN 'reply' END AS reason FROM b)
SELECT * FROM r WHERE reason IS NOT NULL""",
        "page_sources": PREPARED + """SELECT p.page, CASE WHEN m.rec_id IS NULL THEN 'none' WHEN s.source = 'server' THEN 'server' ELSE 'archive' END AS source, m.rec_id
FROM (SELECT DISTINCT page FROM prep) p LEFT JOIN (SELECT page, rec_id FROM manifest WHERE rank = 1) m USING (page) LEFT JOIN prep s ON s.rec_id = m.rec_id""",
        "stand_ins": PREPARED + f""", {PICS}, sh AS (SELECT DISTINCT src FROM pic), hv AS (SELECT DISTINCT regexp_extract(page, '^([^?]*)', 1) AS p FROM cand
), h2 AS (SELECT p, regexp_replace(p, '([^/.])\\.[^/.]*$', '\\1') AS stem FROM hv WHERE lower(regexp_extract(p, '[^/.][^/]*\\.([^/.]*)$', 1)) IN ('jpg', 'jpeg', 'gif', 'png', 'bmp'))
SELECT src, (SELECT min(p) FROM h2 WHERE stem = regexp_replace(src, '([^/.])\\.[^/.]*$', '\\1')) AS stand_in FROM sh WHERE src NOT IN (SELECT p FROM h2)""",
        "preview_cards": f"""WITH {PICS}, b AS (SELECT page_id, src, width FROM pic WHERE width >= 200 AND height >= 200 QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY width * height DESC, pos) = 1)
SELECT p.page_id, CASE WHEN b.page_id IS NULL THEN 'none' WHEN width >= 600 THEN 'large' ELSE 'small' END AS card, src FROM pages p LEFT JOIN b USING (page_id) WHERE html IS NOT NULL""",
        "contact_sheet": _REVIEWED + f""", {PICS}, n AS (SELECT article_id, count(DISTINCT src) AS images FROM pic GROUP BY 1)
SELECT article_id, tier, coalesce(images, 0) AS images FROM rv LEFT JOIN n USING (article_id) WHERE coalesce(images, 0) >= 5 OR tier <> 'ok'""",
        "cover_links": "WITH " + MENU + ", " + ARTICLES + ", " + FIRSTS + """, l AS (SELECT DISTINCT issue, folder FROM me WHERE link AND folder <> ''
), st AS (SELECT article_id AS id, min(page_id) AS page_id FROM pages WHERE article_id IS NOT NULL GROUP BY 1)
SELECT l.issue, l.folder, a.id::BIGINT AS id, coalesce(c.first, st.page_id) AS page_id FROM l LEFT JOIN arts a ON a.issue = l.issue AND a.folder = l.folder LEFT JOIN st ON st.id = a.id LEFT JOIN copies c ON c.page_id = st.page_id""",
        "title_places": rf"""WITH t AS (SELECT page_id, {squeeze(strip("regexp_extract(html, '(?is)<title>([^<]*)</title>', 1)"))} AS t FROM pages WHERE html IS NOT NULL)
SELECT page_id, 'hours' AS kind, lower(regexp_extract(t, '(?i)^\w+ hours on (.+)$', 1)) AS place FROM t WHERE regexp_matches(t, '(?i)^\w+ hours on (.+)$')
UNION ALL SELECT page_id, 'why', lower(regexp_extract(t, '(?i)^why (.+) keeps its \w+(?: \w+)*$', 1)) FROM t WHERE regexp_matches(t, '(?i)^why (.+) keeps its \w+(?: \w+)*$')""",
        "slugs": f"""WITH {ARTICLES}, s AS (SELECT id, coalesce(issue, 0) AS issue, coalesce(nullif(regexp_replace(regexp_replace(lower(regexp_replace(strip_accents(coalesce(title, '')), '[^\\x00-\\x7F]', '', 'g')), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'untitled') AS s FROM arts
), r AS (SELECT *, row_number() OVER (PARTITION BY issue, s ORDER BY id) AS nr FROM s)
SELECT id, issue, CASE WHEN nr = 1 THEN s ELSE s || '-' || id END AS slug FROM r""",
        "descriptions": f"""WITH {ARTICLES} SELECT id, {shout(tidy('title'))} AS name, {clip(sentences2('title', 'blurb'), 160)} AS description FROM arts""",
        "redirects": rf"""WITH r AS (SELECT article_id, coalesce(page_path, '') AS v, min({path('url')}) AS p FROM pages WHERE article_id IS NOT NULL AND url IS NOT NULL GROUP BY 1, 2)
SELECT article_id, '{{' || string_agg(to_json(v)::VARCHAR || ':' || to_json(p)::VARCHAR, ',' ORDER BY v) || '}}' AS variants, min(p) AS base FROM r GROUP BY 1""",
        "article_records": rf"""WITH {ARTICLES} SELECT id, replace(replace('{{"@context":"https://schema.org","@type":"Article","@id":"https://www.lampmag.example/a/' || id || '"' || coalesce(',"headline":' || to_json(title)::VARCHAR, '') || coalesce(',"description":' || to_json(blurb)::VARCHAR, '')
  || coalesce(',"issueNumber":"' || issue || '"', '') || '}}', '<', '<'), '>', '>') AS record FROM arts""",
        "local_days": "SELECT strftime(timezone('America/Chicago', to_timestamp(insert_date)), '%Y-%m-%d') AS day, count(*) AS n FROM comments WHERE insert_date > 0 GROUP BY 1",
    }
