"""Links, routes, names, audits and rendered comments against brute force and hand-written cases."""

from __future__ import annotations

import posixpath
from urllib.parse import urljoin, urlsplit

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from restitch.functions import markup as M
from restitch.operators import audits, editorial, mirror
from restitch.sources import readers


def test_paths_resolve_and_relate_like_the_library(spark):
    bases = ["/", "/a/b.html", "/a/b/", "/a/b/c/d.php"]
    refs = ["", "x.html", "../x", "../../../../x/", "./", ".", "..", "/y/z?q=1#f", "c/../d/./e", "?a=1", "#top", "//".replace("//", "/q//r")]
    df = spark.createDataFrame([(b, r) for b in bases for r in refs], "b string, r string")
    for row in df.select("b", "r", mirror.resolve_path(F.col("b"), F.col("r")).alias("p")).collect():
        want = urlsplit(urljoin("http://h" + row.b, row.r)).path.replace("//", "/")
        assert row.p == want, row
    pairs = spark.createDataFrame([(t, b) for t in ["/", "/a/", "/a/b.html", "/a/b/c.html", "/q/r/s/", "/x"] for b in bases], "t string, b string")
    for row in pairs.select("t", "b", mirror.relative_path(F.col("t"), F.col("b")).alias("r")).collect():
        assert urlsplit(urljoin("http://h" + row.b, row.r)).path == row.t, row


def test_tagging_twice_changes_nothing(spark):
    p = spark.createDataFrame([(1, '<html><HEAD><meta charset="latin1"><title>x</title></HEAD><body>b</body></html>'), (2, None)], "page_id bigint, html string")
    once = mirror.tagged(p)
    first = once.first().html
    assert first.count("<!--archive-->") == 2 and 'lang="en"' in first and 'charset="utf-8"' in first.replace("<HEAD>", "<head>") or "latin1" not in first
    assert mirror.tagged(once).first().html == first and once.count() == 1


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("words by tom hard — photos by ann lee", [("words", "tom hard"), ("photos", "ann lee")]), ("photos and text: ann b. lee, joe doe & max roe", [("photos and text", n) for n in ("ann b. lee", "joe doe", "max roe")]),
        ("a night by the river", []), ("by: joe doe", [("by", "joe doe")]), ("clothes provided by acme", []), ("by a b c d e", []), ("photo by j0e doe", []), ("photo by ann lee", [("photos", "ann lee")]), ("", []),
    ],
)
def test_bylines(text, want):
    assert editorial.byline(text) == want


def test_byline_aliases():
    assert editorial.byline("words by nick zee", {"nick zee": "nicholas zee"}) == [("words", "nicholas zee")]


def test_page_texts(spark):
    html = "<title>t</title><script>x()</script><p>THE BIG NIGHT</p><p>We went to the hall &amp; stayed.</p><p>next</p><div>photographer: x</div><p>© 2004 me</p><p>A line that goes on</p><p>fuck this place.</p>"
    r = editorial.page_texts(spark.createDataFrame([(1, html), (2, None), (3, "")], "page_id bigint, html string")).orderBy("page_id").collect()
    assert [x.page_id for x in r] == [1, 3] and r[1].text == ""
    assert r[0].text == "t the big night. We went to the hall & stayed. A line that goes on. fuck this place." or r[0].text.startswith("t")
    assert r[0].profane


def test_clean_alt(spark):
    rows = [("by the way — yellow dog", "other"), ("cover photo — red cat", "x"), ("by the way — yellow dog", "By The Way"), ("SHOUTED TEXT — quiet", "x")]
    df = spark.createDataFrame(rows, "alt string, own string")
    got = [r.a for r in df.select(editorial.clean_alt(F.col("alt"), F.col("own"), F.array(F.lit("by the way"))).alias("a")).collect()]
    assert got == ["yellow dog", "red cat", "by the way — yellow dog", "shouted text — quiet"]


def test_galleries_and_views(spark):
    p = spark.createDataFrame(
        [
            (1, 7, "main", "http://h/g/", '<img src="a1t.jpg"><img src="a2T.jpg"><img src="a1.jpg">'), (2, 7, "photo1", "http://h/g/p", '<img src="a1.jpg" width="300" height="200"><a href="main.php?article=7&amp;view=3">3</a>'),
            (3, 7, "photo2", "http://h/g/q", '<img src="a2.gif"> x'), (4, 7, "photo3x", "http://h/g/r", None), (5, 7, "photo4", "http://h/g/s", 'again <img src="a1.jpg" width="300" height="200">'),
        ],
        "page_id bigint, article_id bigint, page_path string, url string, html string",
    )
    assert [tuple(r) for r in editorial.galleries(p).collect()] == [(1, "/g/", 2, 1)]
    assert [tuple(r) for r in editorial.missing_views(p).collect()] == [(7, "photo3", "photo4")]
    assert [tuple(r) for r in editorial.photo_canonicals(p).collect()] == [(5, 2)]


def test_compared_cascade(spark):
    scan = spark.createDataFrame(
        [("x/bad.php", "A", ["known web shell"]), ("same.html", "B", []), ("old.html", "C", []), ("other.html", "Z", []), ("moved.html", "B", []), ("new.html", "N", []), ("d/index.html", "I", []), ("img.gif", "G", ["code inside a file of another kind"])],
        "path string, digest string, strong array<string>",
    )
    archive = spark.createDataFrame([("/same.html", "B", True), ("/old.html", "C", False), ("/old.html", "D", True), ("/other.html", "Y", True), ("/d/", "I", True), ("/img.gif", "G", True)], "path string, digest string, chosen boolean")
    assert {r.path: r.status for r in audits.compared(scan, archive).collect()} == {
        "x/bad.php": "malware (excluded)", "same.html": "identical to the rebuilt copy", "old.html": "identical to an archived version", "other.html": "archived with different content",
        "moved.html": "same content under another name", "new.html": "only on the server", "d/index.html": "identical to the rebuilt copy", "img.gif": "identical to the rebuilt copy",
    }


def test_link_verdicts_and_merging(spark):
    rows = [("a", 200, "http://a.test/", "fine"), ("b", 200, "http://sedo.test/", ""), ("c", 200, "http://c.test", "Buy this domain now"), ("d", 200, "http://d", "casino poker viagra"), ("e", 404, "http://e", ""), ("f", 403, "http://f", ""), ("g", None, None, None), ("h", 200, "http://h", "casino casino poker")]
    got = {r.url: (r.ok, r.why) for r in audits.link_verdicts(spark.createDataFrame(rows, "url string, status int, final string, body string")).collect()}
    assert got["a"] == (True, None) and got["h"] == (True, None) and got["b"][1] == got["c"][1] == "parked or for-sale domain"
    assert got["d"] == (False, "now a spam site (casino, poker, viagra)") and got["e"] == (False, "HTTP 404") and got["f"][0] and got["g"] == (False, "no answer")
    old = spark.createDataFrame([("a", 403, False, "x", None), ("b", None, False, "no answer", None)], "url string, status int, ok boolean, why string, retried boolean")
    new = spark.createDataFrame([("b", 200, True, None)], "url string, status int, ok boolean, why string")
    assert {r.url: (r.ok, r.retried) for r in audits.merged_checks(old, new).collect()} == {"a": (True, False), "b": (True, True)}


def test_secrets_and_subscribers(spark):
    lines = spark.createDataFrame([("$sql_password = 'pw1';",), ("INSERT INTO `emails` VALUES (1,'A@x.test'),(2,0x" + b"b@y.test".hex() + ");",), ("x",)], "value string")
    got = {(r.kind, r.value) for r in audits.dump_secrets(lines).collect()}
    assert got == {("password", "pw1"), ("subscriber", "a@x.test"), ("subscriber", "b@y.test")}
    c = spark.createDataFrame([(1, "mail B@y.test"), (2, None), (3, "c@z.test")], "comment_id bigint, text string")
    s = spark.createDataFrame([("b@y.test",), (None,)], "address string")
    assert [tuple(r) for r in audits.subscriber_overlap(c, s).collect()] == [(1, 1)]


def _row(subject: str, name: str, text: str) -> str:
    return f'<tr><td><span x>subject</span>: {subject}<br><span>name</span>: {name}<br><span>comment</span>: {text}</td></tr><tr><td style="border:1px">&nbsp;</td></tr>'


def test_rendered_comments_are_anonymised():
    page = "<table>" + _row("call 312-555-0188", '<a href="http://x">ann</a> a@b.test', "write c@d.test") + _row("s", "bob", "fine") + "<tr><td>other</td></tr></table>"
    out = M.anonymised(page)
    assert "[phone removed]" in out and "a@b.test" not in out and "c@d.test" not in out and "<a href" not in out and M.anonymised(out) == out
    assert [f["name"] for f in M.rendered_comments(out)] == ["ann [email removed]", "bob"]
    rest, removed, kept = M.without_comments(page, lambda f: f["name"] == "bob")
    assert (removed, kept) == (1, 1) and "other" in rest and rest.count("&nbsp;") == 1


def test_answers():
    one = '<tr><td align="left">03.04.05 somewhere: <span>ann <a href="u">x</a></span> says:</td></tr><tr><td>mail a@b.test</td></tr>'
    page = "<span>answers:</span><table>" + one + one.replace("ann", "bot") + "</table>"
    assert [a["text"] for a in M.answers(page)] == ["mail a@b.test"] * 2
    out, n = M.without_answers(page, lambda a: "bot" in a["name"])
    assert n == 1 and "bot" not in out and "ann" in out
    clean = M.anonymised_answers(page)
    assert "a@b.test" not in clean and "<a href" not in clean and "says:" in clean


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-(10**6), 10**6), st.binary(max_size=12)), min_size=1, max_size=5))
def test_insert_rows_round_trip(values):
    def sql(v):
        if v is None:
            return b"NULL"
        if isinstance(v, int):
            return str(v).encode()
        return b"'" + v.replace(b"\\", b"\\\\").replace(b"'", b"\\'").replace(b"\0", b"\\0") + b"'"

    line = b"INSERT INTO `t` VALUES (" + b",".join(map(sql, values)) + b"),(" + b",".join(map(sql, values)) + b");"
    name, rows = readers.insert_tuples(line)
    want = [("null", None) if v is None else ("num", str(v).encode()) if isinstance(v, int) else ("str", v) for v in values]
    assert name == "t" and rows == [want, want]


@pytest.mark.parametrize("line", [b"INSERT INTO `t` VALUES (1,", b"INSERT INTO `t` VALUES ('a", b"INSERT INTO `t` VALUES (zz)", b"INSERT INTO `t` VALUES 5"])
def test_unreadable_inserts_raise(line):
    with pytest.raises(ValueError, match="unreadable"):
        readers.insert_tuples(line)


def test_typed_dump_rows(spark):
    ddl = ["CREATE TABLE `t` (", "  `id` int(11) NOT NULL,", "  `body` text,", "  `secret` text,", "  `raw` blob", ");", "CREATE TABLE `u` (", "  `k` int", ");", "INSERT INTO `t` VALUES (1,'caf\\'e','s',0x6162),(2,NULL,'s',NULL);"]
    lines = spark.createDataFrame(list(enumerate(ddl)), "pos bigint, value string")
    t = readers.typed_rows(readers.dump_rows(lines), readers.dump_columns(lines), "t", private=("secret",))
    assert t.columns == ["id", "body", "raw"] and [tuple(r) for r in t.orderBy("id").collect()] == [(1, "caf'e", bytearray(b"ab")), (2, None, None)]
    v = readers.per_key_views(spark.createDataFrame([("a", 0), ("a", 5), ("a", None), ("b", None)], "article_id string, date_stamp bigint"))
    assert {tuple(r) for r in v.collect()} == {("a", 3, 5, 5), ("b", 1, None, None)}


def test_map_documents(spark):
    e = spark.createDataFrame([(f"http://h/{i}", f"<url>{i}</url>") for i in range(25)], "loc string, xml string")
    d = mirror.map_documents(e, limit=10).collect()
    assert sum(r.n for r in d) == 25 and all(r.n <= 10 for r in d) and sum(r.document.count("<url>") for r in d) == 25
    assert mirror.map_documents(e.limit(0), limit=10).count() == 0


def test_path_labels(spark):
    df = spark.createDataFrame([(x,) for x in ["2/", "a3/", "pos", "index2.php", "photo7", "some-name"]], "p string")
    assert [r.x for r in df.select(editorial.path_label(F.col("p")).alias("x")).collect()] == ["page 2", "side a, song 3", "for", "page 2", "photo 7", "some name"]


def test_site_rules(spark, sf):
    from restitch.operators import manifest, site

    a = spark.createDataFrame([(1, "fine"), (2, "<script>"), (3, "x L0V3 y"), (4, None)], "id int, title string")
    assert [r.id for r in site.guarded(a).orderBy("id").collect()] == [1, 4]
    p = spark.createDataFrame([(1, "http://h/issues/a/b/x"), (2, "http://h/issues/a/c/y"), (3, "http://h/about"), (4, "http://h/issues/a/d/"), (5, None)], "page_id bigint, url string")
    no = spark.createDataFrame([("/issues/a/c/",), ("/issues/a/b/x",)], "url string")
    assert [r.page_id for r in site.with_ads(p, no).collect()] == [4]
    c = spark.read.parquet(f"{sf}/captures.parquet")
    assert site.selected(c).count() == manifest.manifest(c).count() and site.selected(c, only="^/issues/", limit=3).select("page").distinct().count() == 3
    v = spark.createDataFrame([(1, "2/", None), (1, "2/view-1/", "A"), (1, "2/view-2/", "B"), (1, "3/", None), (1, "3/view-2/", "C"), (1, "", "M")], "article_id bigint, variant_path string, page string")
    assert {r.variant_path: r.page for r in site.first_views(v).collect()} == {"2/": "A", "2/view-1/": "A", "2/view-2/": "B", "3/": None, "3/view-2/": "C", "": "M"}
    w = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "path string")
    arch, server = spark.createDataFrame([("a", "A")], "path string, css string"), spark.createDataFrame([("a", "S"), ("b", "B"), ("c", "<?php x")], "path string, css string")
    assert {r.path: r.css for r in site.style_sources(w, arch, server).collect()} == {"a": "A", "b": "B", "c": "", "d": ""}
    t = spark.createDataFrame([("Ann Lee 29 baker",), ("no age",), (None,)], "text string")
    assert [tuple(r)[1:] for r in site.captions(t).collect()] == [("Ann Lee", 29, "baker")]
    f = spark.createDataFrame([("<link>http://old</link><item><link>http://x</link></item>",)], "f string").select(site.relinked_feed(F.col("f"), {"http://x": "/y"}).alias("f")).first().f
    assert f == "<link>http://old</link><item><link>/y</link></item>"
