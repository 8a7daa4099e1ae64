"""Operators on small hand-written fixtures: sources, sinks, scans, empty and null input, streaming."""

from __future__ import annotations

import datetime
import io
import json
import re
import tarfile

from pyspark.sql import functions as F

from restitch.functions.bytesx import digest_of
from restitch.operators import catalog, comments, editorial, malware, manifest, pages
from restitch.sources import readers, sinks
from restitch.streaming import captures as stream

CAPTURES = "rec_id bigint, url string, ts string, mime string, status string, digest string, bytes bigint, source string, verified boolean, error string, loaded_at timestamp"


def cap(rec, url, ts, digest, mime="text/html", status="200", source="wayback"):
    return (rec, url, ts, mime, status, digest, 10, source, True, None, None)


D = [digest_of(bytes([i])) for i in range(9)]


def test_manifest_ranks_and_demotes(spark):
    rows = [
        cap(1, "http://a.example/", "20040101000000", D[0]), cap(2, "http://a.example/p?b=1&a=2", "20050101000000", D[0]), cap(3, "http://a.example/p?a=2&b=1", "20040601000000", D[1]),
        cap(4, "http://a.example/q", "20040101000000", D[2], source="server"), cap(5, "http://a.example/q", "20030101000000", D[3]), cap(6, "http://a.example/r", "20040101000000", D[4], source="server"),
        cap(7, "http://a.example/i.jpg", "20040101000000", D[5]), cap(8, "http://a.example/i.jpg", "20030101000000", D[6], mime="image/jpeg"), cap(9, None, "20030101000000", D[6]),
        cap(10, "http://a.example/late", "20160101000000", D[7]), cap(11, "http://a.example/gone", "20040101000000", D[7], status="404"), cap(12, "http://a.example/x", "bad", D[7]),
    ]
    df = spark.createDataFrame(rows, CAPTURES)
    got = {(r.page, r["rank"]): r for r in manifest.manifest(df).collect()}
    assert got["/p?a=2&b=1", 1].digest == D[1] and got["/p?a=2&b=1", 2].demoted  # the home page's content under another address
    assert ("/q", 1) in got and got["/q", 1].digest == D[3] and ("/q", 2) not in got  # a published copy wins over the server's
    assert got["/r", 1].digest == D[4] and got["/i.jpg", 1].kind == "asset" and ("/i.jpg", 2) not in got
    assert {k[0] for k in got} == {"/", "/p?a=2&b=1", "/q", "/r", "/i.jpg"}
    empty = spark.createDataFrame([], CAPTURES)
    for f in (manifest.manifest, manifest.versions, manifest.reconcile, manifest.archived_only, manifest.manifest_stats):
        assert f(empty).count() == 0


def test_resolution_prefers_clean_then_soft(spark):
    schema = "page_id bigint, article_id bigint, page_path string, url string, ts string, html string"
    rows = [
        (1, 7, "a", "http://x/a", "2", "<b>Warning</b>: x"), (2, 7, "a", "http://x/a", "1", "fine"), (3, 7, "b", "http://x/b", "2", "hacked by z"), (4, 7, "b", "http://x/b", "1", "Too many connections"),
        (5, 7, None, "http://x/c", None, None), (6, None, "z", None, None, "fine"),
    ]
    got = {r.page_path: (r.status, r.page_id, r.n_rejected) for r in pages.resolution(spark.createDataFrame(rows, schema)).collect()}
    assert got == {"a": ("clean", 2, 1), "b": ("soft", 4, 1), "": ("failed", None, 1)}


def test_comment_rules(spark):
    schema = "comment_id bigint, article_id bigint, insert_date bigint, name string, link string, subject string, text string, source string"
    base = dict(article_id=1, name="x", link=None, subject=None, source="dump")
    rows = [
        dict(comment_id=1, insert_date=1143849599, text="hello there", **base), dict(comment_id=2, insert_date=1143849600, text="hello there", **base), dict(comment_id=3, insert_date=None, text="play poker", **base),
        dict(comment_id=4, insert_date=0, text=None, **base), dict(comment_id=5, insert_date=1, text="viagra and cialis", **base), dict(comment_id=6, insert_date=1, text="viagra jokes", **base),
        dict(comment_id=7, insert_date=None, text="日本語だ", **base), dict(comment_id=8, insert_date=None, text="日本語", **base), dict(comment_id=9, insert_date=None, text='see <a href="http://q.example">it</a> there', **base),
    ]
    df = spark.createDataFrame([tuple(r[c.split()[0]] for c in schema.split(", ")) for r in rows], schema)
    got = {r.comment_id: (r.spam, r.hard, r.keep) for r in comments.classified(df).collect()}
    assert [k for k, v in got.items() if v[2]] == [1, 4, 6, 8]
    assert got[5][1] and got[7] == (True, True, False) and got[9][0]
    ex = spark.createDataFrame([("x", "hello")], "name string, starts string")
    assert {r.comment_id for r in comments.without(df, ex).collect()} == {3, 4, 5, 6, 7, 8, 9}
    assert [tuple(r) for r in comments.secrets_found(df, ["POKER", "zzz"]).collect()] == [(3, 1)]


def test_malware_findings_and_planted_copies(spark):
    bad = b"<?php eval(base64_decode('x')); ?>"
    assert malware.findings("a.php", bad)[0] == ["evaluates unpacked data"] and malware.findings("a.jpg", b"\0<?php x")[0] == ["code inside a file of another kind"]
    hidden = rb'<?php $x="\x65\x76\x61\x6c(gzinflate(1))"; ?>'
    assert "evaluates unpacked data" in malware.findings("h.php", hidden)[0] and malware.findings("ok.txt", b"plain") == ([], [])
    assert malware.revealed(b"chr(101).chr(118) . 'al'") == b'"eval\'' and malware.revealed(rb"\145\x76 a") == b"ev a"
    assert malware.findings("x.html", b"<script src='//evil.test/a.js'></script>")[1] == ["script from elsewhere"]
    assert malware.findings("x.txt", b"plain", "2014-01-02 00:00")[1] == ["modified late (2014-01-02)"]
    old, new = datetime.datetime(2010, 1, 1), datetime.datetime(2013, 5, 1)
    files = [
        ("d/1.php", b"same", new), ("d/2.php", b"same", new), ("e/3.php", b"same", new), ("a/1.php", b"old", old), ("a/2.php", b"old", old), ("a/3.php", b"old", old),
        ("f.php", b"mail (", old), ("g.css", b"", None), ("n.txt", None, None), ("x.php.suspected", b"q", old),
    ]
    got = {r.path: r.verdict for r in malware.scanned(spark.createDataFrame(files, "path string, content binary, modified timestamp")).collect()}
    assert got == {
        "d/1.php": "malicious", "d/2.php": "malicious", "e/3.php": "malicious", "a/1.php": "clean", "a/2.php": "clean", "a/3.php": "clean",
        "f.php": "review", "g.css": "clean", "n.txt": "clean", "x.php.suspected": "malicious",
    }
    assert malware.byte_entropy(b"") == 0.0 and malware.byte_entropy(b"aabb") == 1.0
    for name, rx in {**malware.STRONG, **malware.WEAK}.items():
        for text in ("eval(base64_decode(", "system($_GET", "$a($_POST[", "$_GET[a](", "preg_replace('/a/e',", "c99shell", "hacked by", "mail (", "<iframe ", "location='http://", "AddHandler", "a" * 400):
            if re.search(rx, text, re.I):
                assert re.search(malware.SIGNS, text), name


def test_index_and_record_sources(spark, tmp_path):
    (tmp_path / "cdx.json").write_text(json.dumps([["h"] * 6, ["2004", "http://a", "200", "text/html", "D", "-"], ["2005", "http://b", "404", "x", "E", "7"]]))
    assert [r.original for r in readers.read_cdx(spark, str(tmp_path / "cdx.json")).collect()] == ["http://a", "http://b"]
    (tmp_path / "cc.txt").write_text('junk\n{"url": "http://a", "status": "200", "offset": "5"}\n')
    r = readers.read_index_lines(spark, str(tmp_path / "cc.txt")).collect()
    assert len(r) == 1 and (r[0].url, r[0].offset, r[0].mime) == ("http://a", "5", None)
    (tmp_path / "rec.json").write_text(json.dumps({"k": {"url": "u", "ts": "1", "verified": True, "bytes": 4}}))
    r = readers.read_records(spark, str(tmp_path / "rec.json")).first()
    assert (r.key, r.url, r.verified, r.bytes) == ("k", "u", True, 4)
    blobs = tmp_path / "blobs"
    (blobs / "sub").mkdir(parents=True)
    (blobs / "ABC").write_bytes(b"12")
    assert [(r.digest, bytes(r.content)) for r in readers.read_blobs(spark, str(blobs / "ABC")).collect()] == [("ABC", b"12")]
    (blobs / "sub" / "p.html").write_text("x")
    assert {r.path for r in readers.read_files(spark, str(blobs)).collect()} == {"ABC", "sub/p.html"}


def test_dump_source(spark):
    lines = [
        "CREATE TABLE `t` (", "  `id` int(11) NOT NULL,", "  `body` text,", "  `raw` blob,", ") ENGINE=x;",
        r"INSERT INTO `t` VALUES (1,'it\'s (ok), \n',_binary 'ab'),(-2.5e1,NULL,0x6162);", "INSERT INTO `u` VALUES ();", "",
    ]
    df = spark.createDataFrame(list(enumerate(lines)), "pos bigint, value string")
    assert [(r.tbl, r.name, r.type) for r in readers.dump_columns(df).orderBy("pos").collect()] == [("t", "id", "int"), ("t", "body", "text"), ("t", "raw", "blob")]
    rows = [(r.tbl, [(v.kind, None if v.val is None else bytes(v.val)) for v in r.vals]) for r in readers.dump_rows(df).collect()]
    assert rows == [("t", [("num", b"1"), ("str", b"it's (ok), \n"), ("str", b"ab")]), ("t", [("num", b"-2.5e1"), ("null", None), ("bin", b"ab")]), ("u", [])]
    assert readers.typed_value("num", b"-2.5e1", "int") == -25.0 and readers.typed_value("bin", b"ab", "text") == "ab" and readers.typed_value("bin", b"ab", "blob") == b"ab"
    prof = {r.tbl: (r.inserts, r["rows"]) for r in readers.dump_profile(df).collect()}
    assert prof == {"t": (1, 2), "u": (1, 1)}


def test_listings_and_inventory(spark):
    html = '<title>Index of /d</title><a href="?C=N">n</a><a href="/up">p</a> <a href="a%20b.txt">a b</a> 02-Jan-2004 10:00  5K <a href="sub/">sub/</a> 03-Jan-2004 10:00   - <a href="x.txt">x</a> 04-Jan-2004 10:00  7 '
    e = readers.listing_entries(spark.createDataFrame([("20040105000000", html), ("20040106000000", "<p>no</p>")], "ts string, html string"))
    rows = {r.path: (r.dir, r.modified, r.size) for r in e.collect()}
    assert rows == {"/d/a b.txt": (False, "02-Jan-2004 10:00", "5K"), "/d/sub/": (True, "03-Jan-2004 10:00", "-"), "/d/x.txt": (False, "04-Jan-2004 10:00", "7")}
    rec = spark.createDataFrame([("/D/A B.txt",), ("/d/sub/deep/f",)], "path string")
    got = {r.path: r.status for r in readers.inventory(e, rec).collect()}
    assert got == {"/d/a b.txt": "have", "/d/sub/": "have-part", "/d/x.txt": "lost"}


def test_tar_members(spark):
    buf = io.BytesIO()
    with tarfile.open(fileobj=buf, mode="w") as t:
        for name, kind, mode in (("ok.txt", tarfile.REGTYPE, 0o644), ("../up", tarfile.REGTYPE, 0o644), ("s", tarfile.SYMTYPE, 0o777), ("u", tarfile.REGTYPE, 0o4755)):
            i = tarfile.TarInfo(name)
            i.type, i.mode, i.linkname = kind, mode, "q" if kind == tarfile.SYMTYPE else ""
            t.addfile(i)
    got = {r.name: list(r.unsafe) for r in readers.tar_members(spark.createDataFrame([("a.tar", buf.getvalue())], "path string, content binary")).collect()}
    assert got == {"ok.txt": [], "../up": ["escapes"], "s": ["link"], "u": ["setuid"]}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("b", 2), ("a", 1)], "k string, n int")
    assert json.loads(sinks.as_document(df, "k").first().value) == {"a": {"n": 1}, "b": {"n": 2}}
    assert [r.value for r in sinks.as_lines(df, "%-3s%3d", "k", "n").collect()] == ["a    1", "b    2"]
    blobs = spark.createDataFrame([("A", b"1"), ("A", b"1"), ("B", b"2")], "digest string, content binary")
    assert sinks.append_new_blobs(blobs, str(tmp_path / "b")) == 2 and sinks.append_new_blobs(blobs, str(tmp_path / "b")) == 0
    page = spark.createDataFrame([("<html><head><title>x</title>",)], "h string")
    once = page.select(sinks.fenced(F.col("h"), "tags", F.lit("<meta>")).alias("h"))
    assert once.first().h == "<html><head><!-- tags --><meta><!-- /tags -->\n<title>x</title>"
    assert once.select(sinks.fenced(F.col("h"), "tags", F.lit("<meta>")).alias("h")).first().h == once.first().h
    entries = spark.createDataFrame([("http://a/?x=1&y=2", "1.0", None)], "loc string, priority string, lastmod string")
    assert catalog.sitemap_xml(entries).first().line == "<url><loc>http://a/?x=1&amp;y=2</loc><priority>1.0</priority></url>"


def test_titles_and_slugs_are_unique(spark, sf):
    t = editorial.numbered_titles(spark.read.parquet(f"{sf}/pages.parquet"))
    assert t.count() == t.select("title").distinct().count()
    s = catalog.slugs(spark.read.parquet(f"{sf}/articles.parquet"))
    assert s.count() == s.select("issue", "slug").distinct().count()


def test_streams(spark, sf, tmp_path):
    src = spark.read.parquet(f"{sf}/captures.parquet")
    src.repartition(3).write.parquet(str(tmp_path / "in"))
    s = stream.deduplicated(stream.capture_stream(spark, str(tmp_path / "in"), src.schema), delay="8000 days")
    q = s.writeStream.format("memory").queryName("dedup").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    out = spark.table("dedup")
    assert out.count() == out.select("page", "digest", "ts").distinct().count() > 100
    com = spark.read.parquet(f"{sf}/comments.parquet")
    com.write.parquet(str(tmp_path / "com"))
    q = stream.flagged_comments(spark.readStream.schema(com.schema).parquet(str(tmp_path / "com"))).writeStream.format("memory").queryName("flags").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("flags").count() == com.count()
    for _ in range(2):
        stream.upsert_latest(out, str(tmp_path / "state"), str(tmp_path / "staging"))
    state = spark.read.parquet(str(tmp_path / "state"))
    assert state.count() == state.select("page", "digest").distinct().count()
