"""Publication: output paths, reference resolution, rewriting, link checks, images."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from restitch.functions import markup as M
from restitch.functions.bytesx import png
from restitch.functions.images import decode_png, difference
from restitch.operators import publish as P


def test_output_paths_are_unique(spark):
    long = "/g.php?" + "&".join(f"key{i}=value{i}" for i in range(20))
    pages = [("/", "html"), ("/a/", "html"), ("/g.php?b=1", "html"), ("/G.php?b=1", "html"), ("/i.jpg", "asset"), (long, "html")]
    got = {r.page: r.out_path for r in P.output_paths(spark.createDataFrame(pages, "page string, kind string")).collect()}
    assert got["/"] == "index.html" and got["/a/"] == "a/index.html" and got["/i.jpg"] == "i.jpg"
    assert {got["/g.php?b=1"], got["/G.php?b=1"]} == {"G-b_1.html", "g-b_1-2.html"}
    assert len(got[long]) < 90 and len({v.lower() for v in got.values()}) == len(pages)


def test_reference_cascade(spark):
    keys = spark.createDataFrame([("/a/index.html",), ("/b.HTML",), ("/c/",), ("/p_1.jpg",), ("/d",)], "path string")
    refs = spark.createDataFrame([("/a",), ("/B.html",), ("/c",), ("/d?x=1",), ("/zz",), ("/p_01.jpg",)], "ref string")
    renames = spark.createDataFrame([("/p_01.jpg", "/p_1.jpg")], "old string, new string")
    got = {r.ref: r.target for r in P.resolved(refs, keys, renames).collect()}
    assert got == {"/a": "/a/index.html", "/B.html": "/b.HTML", "/c": "/c/", "/d?x=1": "/d", "/p_01.jpg": "/p_1.jpg"}


def test_renamed_files_need_equal_pairs(spark):
    files = [("/x/1.jpg", "A"), ("/x/01.jpg", "A"), ("/x/2.jpg", "B"), ("/y/1.jpg", "A"), ("/y/01.jpg", "Z"), ("/y/3.jpg", "Q"), ("/z/5.jpg", "E")]
    got = {(r.old, r.new) for r in P.renamed_files(spark.createDataFrame(files, "path string, digest string")).collect()}
    assert got == {("/x/02.jpg", "/x/2.jpg")}


def test_rewriting_and_dead_links(spark):
    html = '<a href="/x">x</a><img src=\'/i.gif\' alt=q><a href=http://dead.example>gone</a><style>b{background:url(/b.png)}</style>'
    assert M.references(html) == ["/x", "/i.gif", "http://dead.example", "/b.png"]
    out = M.rewrite(html, {"/x": "x.html", "/b.png": "b2.png"})
    assert '<a href="x.html">' in out and "url(b2.png)" in out and "'/i.gif'" in out
    pages = spark.createDataFrame([(1, html), (2, None), (3, "plain")], "page_id bigint, html string")
    status = spark.createDataFrame([("http://dead.example", False), ("/x", True)], "url string, ok boolean")
    got = {r.page_id: r.html for r in P.without_dead_links(pages, status).collect()}
    assert "dead.example" not in got[1] and "gone" in got[1] and '<a href="/x">x</a>' in got[1] and got[2] is None and got[3] == "plain"
    t = spark.createDataFrame([(1, "/x", "x.html"), (1, "/i.gif", None)], "page_id bigint, ref string, target string")
    got = {r.page_id: r.html for r in P.rewritten(pages, t).collect()}
    assert 'href="x.html"' in got[1] and got[3] == "plain"
    assert M.with_alt('<img src="/i.gif" alt="old"><img src="/j.gif">', {"/i.gif": 'a "b"'}) == '<img src="/i.gif" alt="a &quot;b&quot;"><img src="/j.gif">'


def test_paths_and_urls(spark):
    assert M.relative("/a/b.html?x=1#f", "/a/c/d.html") == "../b.html?x=1#f" and M.relative("/a/", "/a/c.html") == "./" and M.relative("/x/", "/a/c.html") == "../x/"
    df = spark.createDataFrame([("http://a.example/x/y.html", "../z?q=1"), ("http://a.example/x", None), ("http://[bad", "z")], "b string, r string")
    assert [r[0] for r in df.select(M.join_url(F.col("b"), F.col("r"))).collect()] == ["http://a.example/z?q=1", None, None]


def test_rendered_comments():
    row = "<tr><td><span>subject</span>: {}<br><span>date</span>: 01.02.2004<br><span>name</span>: {}<br><span>comment</span>: {}</td></tr>"
    page = "<table>" + row.format("hi", "ann", "fine") + row.format("buy", "bot", "pills") + "</table>"
    assert [c["name"] for c in M.rendered_comments(page)] == ["ann", "bot"] and M.rendered_comments(page)[0]["comment"] == "fine"
    out, removed, kept = M.without_comments(page, lambda f: "pills" in f["comment"])
    assert (removed, kept) == (1, 1) and "bot" not in out and "ann" in out
    parts = M.page_parts('<title>t</title><body><p>nav</p><td class="main_cell">text</td><div id="footer">f</div></body>')
    assert parts["title"] == "t" and parts["main"].startswith("text") and "nav" in parts["frame"] and "footer" in parts["tail"]


def test_link_checks(spark):
    checked = spark.createDataFrame([("a", True, None), ("b", False, "timeout (30 s)"), ("c", False, "timeout (60 s)"), ("d", False, None)], "url string, ok boolean, why string")
    links = spark.createDataFrame([("a",), ("b",), ("e",), ("e",)], "url string")
    assert {r.url for r in P.unchecked_links(links, checked).collect()} == {"e"} and {r.url for r in P.unchecked_links(links, checked, retry=True).collect()} == {"b", "c", "d", "e"}
    assert {(r.why, r.n) for r in P.failure_reasons(checked).collect()} == {("timeout", 2), ("", 1)}
    copies = spark.createDataFrame([("/o1", "/n1"), ("/o2", "/n2"), ("/o2", "/n3")], "path string, target string")
    first = spark.createDataFrame([("/n1", "/n0"), ("/n0", None)], "page string, canonical string")
    assert [tuple(r) for r in P.canonical_targets(copies, first).collect()] == [("/o1", "/n0")]


def test_records_copies_and_files(spark, tmp_path):
    a = spark.createDataFrame([(1, "</script>x", None, 3)], "id int, title string, blurb string, issue int")
    rec = P.article_records(a, "https://m.example").first().record
    assert "<" not in rec and '"@id":"https://m.example/a/1"' in rec
    files = spark.createDataFrame([("a", "pw=abc x"), ("b", "bad")], "path string, text string")
    scan = spark.createDataFrame([("b", "malicious")], "path string, verdict string")
    assert [tuple(r) for r in P.redacted_copy(files, scan, {r"pw=\w+": "pw=[removed]"}).collect()] == [("a", "pw=[removed] x")]
    out = spark.createDataFrame([("x/y.html", b"1"), ("z.css", b"2")], "out_path string, content binary")
    assert P.write_files(out, str(tmp_path)) == 2 and (tmp_path / "x" / "y.html").read_bytes() == b"1"


def test_png_round_trip_and_difference():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 255, size=(5, 7, 3), dtype=np.uint8)
    assert (decode_png(png(7, 5, a.tobytes())) == a).all()
    b = a.copy()
    b[0, 0] = 255 - b[0, 0]
    d = difference(a, b)
    assert d in (0.0, 1 / 35) and difference(a, a) == 0 and difference(a, a[:4]) == 7 / 35
