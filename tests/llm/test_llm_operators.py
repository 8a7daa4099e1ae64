"""The training-data operators: brute force, round trips, sample sentences, and awkward input."""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from restitch.llm import garbled, lexicon, maincontent, mixing, pii, residue, sentences, stuffing, survivors, tokens, toxic
from restitch.llm.pageblocks import blocks

CAPTURES = "rec_id bigint, url string, ts string, mime string, status string, digest string, bytes bigint, source string, verified boolean, error string, loaded_at timestamp"
PAGES = "page_id bigint, source string, html string"
COMMENTS = "comment_id bigint, source string, name string, subject string, text string"
DOCS = "doc_id bigint, text string, lang string, source string"
LONG = "The band played on. " * 5000


def digest(i):
    return base64.b32encode(hashlib.sha1(bytes([i])).digest()).decode()


# ---------------------------------------------------------------- 1


def cap(rec, url, ts, d, source="wayback", mime="text/html"):
    return (rec, url, ts, mime, "200", d, 1, source, None, None, None)


SOURCES = [("server", 60, None), ("wayback", 50, None), ("mirror", 50, None), (None, 5, None)]


def test_survivors_against_brute_force(spark):
    a, b = digest(1), digest(2)
    rows = [
        cap(5, "http://x/p?b=1&a=2", "20040101000000", a, "WAYBACK "), cap(3, "https://y:80/p?a=2&amp;amp;b=1", "2005-01-01T00:00:00Z", "sha1:" + a.lower(), None), cap(9, "http://x/p?a=2&b=1", "2005", "-", "server"),
        cap(10, "http://x/p?a=2&b=1&PHPSESSID=1", "20050101000000", a[:9], "server"), cap(11, "http://x/q", "20060101000000", None), cap(12, "http://x/q", "20060101000000", ""), cap(13, "http://x/q", None, None),
        cap(14, "http://x/q", None, None), cap(15, None, "20060101000000", b), cap(16, "http://x/r", "20061301000000", b, "nowhere"), cap(17, "http://x/r", None, hashlib.sha1(bytes([2])).hexdigest(), "mirror"),
        cap(17, "http://x/r", None, b, "wayback"),
    ]
    df = spark.createDataFrame(rows, CAPTURES).withColumn("page", F.lit("clash")).withColumn("trust", F.lit(1)).withColumn("n", F.lit(0))
    src = spark.createDataFrame(SOURCES, "source string, trust int, note string")
    got = sorted(map(tuple, survivors.found(df, src).collect()), key=lambda r: r[0])
    assert got == [(3, "20050101000000", a, "server"), (11, "20060101000000", None, "wayback"), (16, None, b, "wayback")]
    best = {r.first_rec: (r.rec_id, r.n) for r in survivors.survivors(df, src).collect()}
    assert best[3] == (5, 3) or best[3] == (10, 3) or best[3] == (3, 3)
    assert best[13] == (13, 1) and best[14] == (14, 1)
    empty = spark.createDataFrame([], CAPTURES)
    assert survivors.found(empty, src).count() == 0
    assert survivors.found(df, src.limit(0)).count() == 3


def test_survivors_do_not_depend_on_order(spark, sf):
    c, s = spark.read.parquet(f"{sf}/captures.parquet"), spark.read.parquet(f"{sf}/sources.parquet")
    one = sorted(map(tuple, survivors.survivors(c, s).collect()), key=repr)
    two = sorted(map(tuple, survivors.survivors(c.orderBy(F.desc("rec_id")).repartition(7), s).collect()), key=repr)
    assert one == two and one


# ---------------------------------------------------------------- 2


@pytest.mark.parametrize("name", ["utf8>cp1252", "utf8>latin_1", "utf8>cp1251", "utf8>mac_roman", "utf8>cp437"])
def test_strict_transformations_round_trip(name):
    wrong = name[5:]
    for w in ("café", "naïve", "«déjà", "coração", "Grüße", "“warm”"):
        b = w.encode()
        try:
            g = b.decode(wrong)
        except UnicodeDecodeError:
            continue
        assert garbled.certain(g, garbled.STRICT)[0] == w
        assert garbled.certain(w, garbled.STRICT) is None


def test_correct_text_of_many_languages_is_not_certain():
    for w in "Пётр тёплый ёлка Žižek naïve CAFÉ… déjà— «Él» Ωραίο Łódź ÅNGSTRÖM smörgåsbord 日本語 漢字 ไทย हिन्दी العربية 한국어 œuvre ÷ ½ £5 °C".split():
        assert garbled.certain(w, garbled.STRICT) is None, w


def test_twins_lend_only_their_runs():
    """Digits, spelling and other ASCII characters stay those of the garbled clause."""
    got = garbled.aligned("the cafÃ© opens on 5 May for 12 euro", "the café opens on 7 May for 30 euro", {"utf8>cp1252"})
    assert got == (True, True, "the café opens on 5 May for 12 euro")
    assert garbled.aligned("the café is naïve", "the cafè is naïve", {"utf8>cp1252"})[0] is False
    text = "<p>caf&#195;&#169; &amp; &eacute;clair</p>\r\n<p>été &lt; 5</p>"
    assert garbled.rewritten(text, {"cafÃ© &amp; éclair": "café &amp; éclair"}) == "<p>café &amp; éclair</p>\r\n<p>été &lt; 5</p>"
    assert garbled.rewritten(text, {}) == text


def test_deep_and_one_to_one_transformations():
    deep = "é"
    for _ in range(6):
        deep = deep.encode().decode("latin_1")
    assert garbled.certain(f"caf{deep}", garbled.STRICT)[0] == "café"
    assert "cp1251>latin_1" in garbled.explained("журнал".encode("cp1251").decode("latin_1"), "журнал")
    fixes = {"Ïî÷åìó": ("Почему", "cp1251>latin_1", 1), "ñòðàííûé": ("増調牆渾", "", 3)}
    assert garbled.mended("Ïî÷åìó ñòðàííûé?", fixes) == "Почему странный?"


def test_garbled_fields_are_found_and_restored(spark):
    clean = [(i, None, None, "a naïve question", "the café on the corner is better") for i in range(1, 9)]
    bad = [
        (100, None, None, "a naÃ¯ve question", "fine"), (101, None, None, None, "the cafÈ on the corner is better"), (102, None, None, "", "the caf� on the corner is better"),
        (103, None, None, "naïve", "we don\x92t know"), (104, None, None, None, None), (105, None, None, "вопрос о концерте", "«Он слишком тихий»"), (106, None, None, None, "caf&#195;&#169; &amp; tea"), (107, None, None, "a naÔve question", None),  # a second vote for the encoding of 101
    ]
    c = spark.createDataFrame(clean + bad, COMMENTS).withColumn("clause", F.lit("x")).withColumn("n", F.lit(1))
    p = spark.createDataFrame([(1, None, "<p>the cafÃƒÂ© on the corner is better</p>"), (2, None, None), (3, None, "plain"), (4, None, "<p>café</p>\r\n" * 3000)], PAGES)
    got = {tuple(r) for r in garbled.found(p, c).collect()}
    assert got == {("comments", 100, "subject"), ("comments", 101, "text"), ("comments", 102, "text"), ("comments", 103, "text"), ("comments", 106, "text"), ("comments", 107, "subject"), ("pages", 1, "html")}
    text = {(r.rec_id, r.field): r.text for r in garbled.restored(p, c).collect()}
    assert text[100, "subject"] == "a naïve question" and text[101, "text"] == "the café on the corner is better" == text[102, "text"]
    assert text[1, "html"] == "<p>the café on the corner is better</p>" and text[106, "text"] == "café &amp; tea"
    assert garbled.found(p.limit(0), c.limit(0)).count() == 0


# ---------------------------------------------------------------- 3


def test_toxic_spans_and_scores(spark):
    toxic_ = ["You stupid piece of trash, go kill yourself", "f.u.c.k you and your warm radio, a$$h0le", "foreigners are vermin and everybody knows it", "YOU ARE SUCH A BRAINLESS CLOWN!!!", "du bist ein dummes Arschloch", "ты тупая мразь"]
    fine = ["The band killed it last night", "I felt like an idiot when I lost my keys", "We talked with refugees who run a bakery", "a nude portrait hangs in the hall", "", LONG, "cock-a-leekie soup with rye toast"]
    rows = [(i, "s", None, None, t) for i, t in enumerate(toxic_ + fine)] + [(99, None, None, None, None)]
    c = spark.createDataFrame(rows, COMMENTS).withColumn("tbl", F.lit(1)).withColumn("rec_id", F.lit(5))
    p = spark.createDataFrame([(1, "s", "<p>eat shit, asshole!</p>"), (2, "s", "<p>plain</p><script>var t='eat shit, asshole'</script>"), (3, None, None)], PAGES)
    got = {(r.tbl, r.rec_id): r for r in toxic.scored(p, c).collect()}
    assert {k for k, r in got.items() if r.score >= toxic.DOCUMENT_SCORE} == {("comments", i) for i in range(len(toxic_))} | {("pages", 1)}
    assert got["comments", 99].score == 0 and len(got) == len(rows) + 3
    s = got["comments", 2].spans[0]
    assert toxic_[2][s.start_pos : s.end_pos].startswith("foreigners")
    rates = {(r.tbl, r.source): r for r in toxic.rates(p, c).collect()}
    assert rates["pages", "s"].rate == 0.5 and rates["pages", ""].n == 1


def test_sentences_held_out_of_training():
    """Sentences in six languages that are no training lines: nine of ten abusive ones are found, few harmless ones."""
    from tests.llm import heldout

    lines = {re.sub(r"[«»{}]", "", x).strip().lower() for x in (toxic.ABUSIVE + toxic.HARMLESS + toxic.toxic_more.ABUSIVE + toxic.toxic_more.HARMLESS).split("\n")}
    assert not lines & {x.lower() for x in heldout.ABUSIVE + heldout.HARMLESS}
    scorer = toxic.Scorer(toxic.tagger())
    bad = [g[0] >= toxic.DOCUMENT_SCORE for g in scorer.score(heldout.ABUSIVE)]
    good = [g[0] >= toxic.DOCUMENT_SCORE for g in scorer.score(heldout.HARMLESS)]
    assert sum(bad) >= 0.9 * len(bad) and sum(good) <= 2, (sum(bad), sum(good))


def test_marginals_equal_enumeration():
    import itertools

    import numpy as np

    t = toxic.Tagger()
    rng = np.random.default_rng(1)
    t.w = rng.normal(size=1 << toxic.BITS).astype(np.float32)
    t.step = rng.normal(size=(2, 2))
    h = np.array([[toxic.word_hash(w) for w in "a b c d".split()]], dtype=np.uint64)
    f = toxic.features(h)
    got = t.marginals(f, np.ones((1, 4), dtype=bool))[0]
    e = t.w[f].sum(-1)[0] + t.bias
    weight, total = np.zeros(4), 0.0
    for y in itertools.product((0, 1), repeat=4):
        s = np.exp(sum(e[i] for i in range(4) if y[i]) + sum(t.step[a, b] for a, b in zip(y, y[1:], strict=False)))
        total += s
        weight += s * np.array(y)
    assert np.allclose(got, weight / total, atol=1e-6)


# ---------------------------------------------------------------- 4 and 7

PAGE = """<html>
<head><title>Notes on soup</title><script>var t="{{x}}"</script></head>
<body>
<div id="navBar">
<a href="/a/">a</a> |
<a href="/b/">b</a> |
</div>
<noscript>Please enable JavaScript.</noscript>
<h1>Notes on soup</h1>
<div><i>by anna keller</i></div>
<p>The soup was warm and the room
was full of people who liked it.</p>
<ul>
<li>pea soup, the Old Room</li>
</ul>
<p><b>Another story</b> It was late and we left. <a href="/c/">more</a></p>
<div>Copyright 2004. All rights reserved.</div>
</body>
</html>"""


def test_main_content_lines():
    assert maincontent.article_lines(PAGE) == [9, 10, 11, 12, 14]
    assert maincontent.article_lines(PAGE.replace("\n", "\r\n")) == [9, 10, 11, 12, 14]
    for nothing in (None, "", "   ", "<html></html>", "<p>404 Not Found</p>", "<script>var a = 'The soup was warm and the room was full.'</script>"):
        assert maincontent.article_lines(nothing) == []
    assert maincontent.article_text(PAGE).startswith("Notes on soup\n\nby anna keller\n\nThe soup")


def test_main_content_tables(spark):
    p = spark.createDataFrame([(1, None, PAGE), (1, None, PAGE), (2, None, None), (3, None, "<p>" + LONG + "</p>")], PAGES).withColumn("field", F.lit("q"))
    f = spark.createDataFrame([(7, "<p>The room was full and the soup was warm.</p>", None)], "frame_id bigint, nav string, menu string")
    got = Counter(tuple(r) for r in maincontent.found(p, f).collect())
    assert got["pages", 1, "html", 9] == 2 and got["pages", 3, "html", 1] == 1 and got["frames", 7, "nav", 1] == 1 and len(got) == 7
    assert maincontent.found(p.limit(0), f.limit(0)).count() == 0


def test_residue(spark):
    body = "<p>The soup was warm and the room was full of people who liked it.</p>"
    rows = [
        (1, body), (2, body + "<p>Hello {{ user.name }}, welcome</p>"), (3, "<h1>404 Not Found</h1>"), (4, "<p>This account has been suspended.</p>"), (5, body + "<p>The sign said Page Not Found, which is a bookshop.</p>"),
        (6, body + "<noscript>Please enable JavaScript</noscript><script>'{{x}}'</script>"), (7, "<p>Lorem ipsum dolor sit amet lorem dolor ipsum</p>"), (8, None), (9, ""), (10, "<p>blah blah blah blah</p>"), (11, body + "<p>He signs his letters [sic].</p>"),
        (12, body + "Warning: foo() failed in /home/x/a.php on line 7<br>"), (13, "<p>" + LONG + "</p>"), (3, "<h1>404 Not Found</h1>"),
    ]
    p = spark.createDataFrame([(a, None, b) for a, b in rows], PAGES).withColumn("verdict", F.lit("x"))
    assert {r.page_id for r in residue.found(p).collect()} == {2, 3, 4, 7, 10, 12}
    assert {r.page_id for r in residue.content_pages(p).collect()} == {1, 5, 6, 11, 13}
    assert residue.found(p.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("The page you requested could not be displayed.", "server"), ("The article you requested is not available.", "server"), ("Unable to select db", "server"), ("455 unauthorized", "server"), ("Status: 451", "server"),
        ("Bitte schalten Sie Cookies ein", "notice"), ("Sitio en construcción", "notice"), ("Текст для заполнения", "filler"), ("hey heyhey", "filler"), ("hello 1 hello 2 hello 3", "filler"), ("test 1 test 2", "filler"), ("test123", "filler"),
        ("July 4, 2004", None), ("2004", None), ("12.03.2004", None), ("Page 1 2 3 4 5", None), ("10 11 12", None), ("x" * 400 + "y", None), ("word " + "1" * 400 + "x", None),
    ],
)
def test_messages_without_common_signs(text, want):
    assert residue.verdict(text) == want


PROSE = "The band played on until the lamps went out and nobody in the long room wanted to be the first one to leave it, so the bar stayed open. " * 2
LATIN = "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore et dolore magna aliqua. Ut enim ad minim veniam, quis nostrud exercitation ullamco laboris nisi ut aliquip ex ea commodo consequat. "


@pytest.mark.parametrize(
    ("block", "want"),
    [
        ("blah blah " * 30, True), ("text text " * 30, True), ("word. word, " * 40, True), ("Blindtext " * 45, True), (LATIN * 2, True),
        (PROSE[:138] + LATIN * 2, True), ("Dear readers of our small magazine, we are as surprised as you. The page you requested could not be found on this server. " + PROSE[:138], True),
        ("This account has been suspended. " + "If you are its owner, write to the people who run the machines and ask them for what you still owe to them. " * 3, True),
        ("This site has been temporarily suspended because its owner owes money to the people who run the machines, and as long as it is not paid, which we hope will not take longer than the rest of this month or the next one, all the pages stay closed to readers", True),
        (PROSE, False), (PROSE + LATIN[:60], False), (PROSE[:138] + "The site was down for maintenance around noon, so the band sold tickets by hand. " + PROSE[:138], False),
    ],
)
def test_blocks_of_any_length(block, want):
    assert block.count(" ") >= residue.MESSAGE_WORDS
    _, messages = residue.page_signals(f"<html><body><p>{block}</p></body></html>")
    assert any(residue.verdict(m[0]) for m in messages) == want


@pytest.mark.parametrize(
    "block",
    [
        "Copyright 2004 by the magazine. All rights reserved. " + "No part of this site may be printed elsewhere without the written permission of the editors. " * 4,
        "We use cookies on this site. By continuing you accept cookies on your computer. " * 4, "blah blah " * 30,
    ],
)
def test_long_site_text_is_no_article(block):
    page = f"<html><body>\n<p>{PROSE}</p>\n<p>{block}</p>\n<p>{PROSE}</p>\n</body></html>"
    assert block.count(" ") >= maincontent.SITE_WORDS
    assert maincontent.article_lines(page) == [2, 4]


_WHOLE = {k: re.compile("(?ix)" + "|".join(p.pattern.removeprefix("(?ix)") for p in w.parts)) for k, w in residue.MESSAGES.items()}


@settings(max_examples=400, deadline=None)
@given(st.sampled_from(sorted(residue._MESSAGES)).flatmap(lambda k: st.from_regex(r"(?ix)" + residue._MESSAGES[k])), st.sampled_from(["", "sorry, ", "page "]))
def test_indexed_wordings_equal_whole_patterns(text, before):
    text = before + " ".join(text.split())
    for k, w in residue.MESSAGES.items():
        a, b = w.search(text), _WHOLE[k].search(text)
        assert (a and a.span()) == (b and b.span())


def test_template_statistics(spark):
    """A text that is all there is on pages of many articles is no article, in whatever language; the same text beside an article is none."""
    alone = "<html><body><p>Kérjük, térjen vissza később, dolgozunk</p></body></html>"
    pages = [(i, i, alone) for i in range(1, 31)] + [(i, i, f"<html><body><p>{PROSE} {i}</p><p>Kérjük, térjen vissza később, dolgozunk</p></body></html>") for i in range(31, 33)]
    same = [(i, 7, "<html><body><p>Tiny caption of one picture, shown again and again</p></body></html>") for i in range(40, 70)]  # one article, delivered again
    p = spark.createDataFrame(pages + same + [(99, None, None)], "page_id bigint, article_id bigint, html string")
    assert {r.page_id for r in residue.found(p).collect()} == set(range(1, 31))
    assert residue.verdict("Die angeforderte Seite konnte leider nicht geladen werden.") == "server"


def test_each_shape_of_a_script_error_has_a_sign():
    errors = [
        "Warning: main(x.php) failed in /www/x.php", "Notice: x on line 12", "You have an error in your SQL syntax", "Access denied for user 'web'@'localhost' (using password: YES)", "mysql_connect()",
        "[an error occurred while processing this directive]", "VBScript runtime error", "JScript compilation error", "ODBC Driver", "ODBC error", "Traceback (most recent call last)", "java.lang.NullException", "Unhandled exception", "stack trace:",
    ]
    for e in errors:
        assert residue.SCRIPT_ERRORS.search(e) and residue._message(f"The band {e} played on.")[0]


def test_template_tree_merges_by_position():
    t = residue.TemplateTree()
    for w in ("Error 1 in module alpha", "Error 2 in module alpha", "Error 3 in module beta"):
        t.add(residue.mask(w), w)
    (only,) = [x["words"] for _, x in t.templates()]
    assert only == ["Error", "<*>", "in", "module", "<*>"]


def test_blocks_keep_lines():
    b = blocks("a<br>b &amp;\nc\n<!-- x\n -->\n<p>d <b>e</b>\n f</p>")
    assert [(x.text, sorted(x.lines)) for x in b] == [("a", [1]), ("b & c", [1, 2]), ("d e f", [5, 6])]


# ---------------------------------------------------------------- 5


def test_stuffing(spark):
    spam = [
        ("anna", "hi", "garden chairs garden chairs tax advice garden chairs garden chairs tax advice garden chairs"), ("fast cars cheap rugs fast cars cheap rugs", None, "nice"),
        ("x", "red shoes | red shoes | blue shoes | red shoes | red shoes", "see my page"), ("x", None, "[url=http://a.test]loan[/url] [url=http://b.test]loan[/url] [url=http://c.test]loan[/url]"),
        ("x", None, "#redshoes #red_shoes #redshoes #redshoes #red_shoes #redshoes"),
    ]
    fine = [
        ("anna", "wow", "I liked the show and I will come again."), (None, None, None), ("", "", ""), ("x", "songs", "my favorites: Blue Doors, Old Trains, Sad Pilots, Winter Moon"), ("x", None, "la la la la la, what a chorus"),
        ("x", None, "two good pages: <a href='http://a.test'>here</a> and <a href='http://b.test'>here</a>."), ("x", None, LONG),
    ]
    rows = [(i, None, *r) for i, r in enumerate(spam + fine)]
    c = spark.createDataFrame(rows, COMMENTS).withColumn("stuffed", F.lit(True))
    assert {r.comment_id for r in stuffing.found(c).collect()} == set(range(len(spam)))
    assert stuffing.judged(c).count() == len(rows) and stuffing.found(c.limit(0)).count() == 0


def test_shares_decide_and_carried_lists_are_found():
    prose = "I went to the river with my brother and we talked about the old house until it was dark. " * 12
    few = "curtain rods, pool tables, used trucks, tent rental"
    many = ", ".join(["curtain rods", "pool tables", "used trucks", "tent rental", "gold coins", "cigar box"] * 6)
    assert not stuffing.judge("anna", "a walk", prose + few)[0]
    assert stuffing.judge("anna", "a walk", prose + "\n" + many)[0] and stuffing.judge("anna", "a walk", many)[0]


def test_decoding_equals_enumeration():
    import itertools

    model = stuffing.line_model()
    seq = [s for _, _, s in stuffing.observe("anna", "cheap tents", "We met in the evening. buy tents tents tents online tents")]
    def score(path):
        total = model.start[path[0]] + model.scores(seq[0])[path[0]]
        for a, b, sym in zip(path, path[1:], seq[1:], strict=False):
            total += model.step[a, b] + model.scores(sym)[b]
        return total
    best = max(itertools.product(range(4), repeat=len(seq)), key=score)
    assert abs(score(model.decode(seq)) - score(best)) < 1e-9


# ---------------------------------------------------------------- 6


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("write me at a.b+c@d.example.org please", [("email", "a.b+c@d.example.org")]), ("mail to a_1 [at] site [dot] mail [dot] test now", [("email", "a_1 [at] site [dot] mail [dot] test")]),
        ("joe at post dot example dot com or (312)555 0188", [("email", "joe at post dot example dot com"), ("phone", "(312)555 0188")]), ("call three one two five five five zero one eight eight ok", [("phone", "three one two five five five zero one eight eight")]),
        ("my SSN is 912-34-5678!", [("id_number", "912-34-5678")]), ("passport no. X1234567.", [("id_number", "X1234567")]), ("at 12 Larch Street, Apt. 3B, Eastbank, IL 00012 today", [("address", "12 Larch Street, Apt. 3B, Eastbank, IL 00012")]),
        ("Lindenweg 5, 06000 Altbrück", [("address", "Lindenweg 5, 06000 Altbrück")]), ("I am Anna B. Keller-Stone here", [("person", "Anna B. Keller-Stone")]), ("ask Dr. Ruth Garrow", [("person", "Ruth Garrow")]),
        ("аnnа@post.example wrote", [("email", "аnnа@post.example")]), ("ring ３１２-５５５-０１８８", [("phone", "３１２-５５５-０１８８")]),
        ("Dr. Garrow and J. R. Stone, order no. 3125550, ISBN 0-000-55501-9, 312-555, meet @ the Cellar at 8", []), ("follow @lampmag, track 3 is 10.25.40 long, on Larch Street", []), ("", []), (None, []),
    ],
)
def test_personal_information(text, want):
    got = pii.spans(text)
    assert [(k, text[s:e]) for s, e, k in got] == want


@settings(max_examples=80, deadline=None)
@given(st.text(max_size=120))
def test_redaction_keeps_the_rest(text):
    got = pii.spans(text)
    rest, at = "", 0
    for s, e, _ in got:
        assert 0 <= at <= s < e <= len(text)
        rest += text[at:s]
        at = e
    out = pii.redact(text)
    for mark in pii.PLACEHOLDER.values():
        if mark not in text:
            out = out.replace(mark, "")
    if not any(m in text for m in pii.PLACEHOLDER.values()):
        assert out == rest + text[at:]


def test_personal_information_tables(spark):
    rows = [(1, None, "Anna Keller", None, "a@b.example.org and a@c.example.org"), (2, None, None, "x@y.example.org", None), (3, None, "Owen", None, LONG + "a@b.example.org")]
    c = spark.createDataFrame(rows, COMMENTS).withColumn("kind", F.lit("k")).withColumn("field", F.lit("f"))
    assert {tuple(r) for r in pii.found(c).collect()} == {(1, "name", "person"), (1, "text", "email"), (3, "text", "email")}
    assert {r.comment_id: (r.name, r.text) for r in pii.redacted(c).collect()}[1] == ("[NAME]", "[EMAIL] and [EMAIL]")
    assert pii.found(c.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("I met Stephen Marsh there", "Stephen Marsh"), ("photo by Ana Ruiz", "Ana Ruiz"), ("with Raymond Ostrow", "Raymond Ostrow"), ("so says Giulia Ferrante", "Giulia Ferrante"), ("then Björn Halvorsen left", "Björn Halvorsen"),
        ("hi, my name is Quillon Marsh.", "Quillon Marsh"), ("MY NAME IS TAVISH OSTROW", "TAVISH OSTROW"), ("Regards,\nXanthe B. Orrin", "Xanthe B. Orrin"), ("me llamo Itziar Belasko", "Itziar Belasko"),
        ("my name is not important", None), ("regards, The Editors", None), ("Quillon Marsh is a swamp", None),
    ],
)
def test_full_names_beyond_the_tables(text, want):
    assert [text[s:e] for s, e, k in pii.spans(text) if k == "person"] == ([want] if want else [])


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("меня зовут Иван Петров", "Иван Петров"), ("Мария Сергеевна Иванова пришла", "Мария Сергеевна Иванова"), ("вчера Анна Кузнецова пела", "Анна Кузнецова"), ("улица Липовая, Верхний Берег", None),
        ("με λένε Γιώργος Παπαδόπουλος", "Γιώργος Παπαδόπουλος"), ("Χθες η Νέα Υόρκη", None), ("我叫王小明。", "王小明"), ("王小明先生很好", "王小明"), ("田中太郎さんが歌った", "田中太郎"), ("اسمي خالد العمري", "خالد العمري"),
        ("our photographer Lindiwe Khumalo said so", "Lindiwe Khumalo"), ("see you\n-- Obafemi Adeyo", "Obafemi Adeyo"), ("Mr. Wei Zhang left", "Wei Zhang"), ("by Zbyszek Wojnowski", "Zbyszek Wojnowski"), ("Silver Magnets and Dirty Wolves", None),
    ],
)
def test_full_names_by_shape_and_context(text, want):
    assert [text[s:e] for s, e, k in pii.spans(text) if k == "person"] == ([want] if want else [])


def test_each_cue_has_a_sign():
    for cue in pii._CUE.replace("(?:ß|ss)", "ß").replace("['’]", "'").replace(",?", ",").replace("\\w+", "one").replace("o?\\s?", "o ").split("|"):
        assert any(x in cue.lower() for x in pii._CUE_SIGNS), cue


def test_streets_named_after_places():
    assert pii.redact("we met at 12 Rose Hill, Leeds today") == "we met at [ADDRESS] today"
    assert pii.redact("in 12 Ferry Hill bars") == "in 12 Ferry Hill bars"


def test_disguises_become_marks():
    t = pii.normalise("write to anna ( at ) oldpost [dot] example now")
    assert t.text == "write to anna@oldpost.example now" and t.back(9, 29) == (9, 42)


def test_given_names_that_had_been_cut():
    cut = """albert amanda amelia ana angela antonio benjamin beth carol chris erik ethan frances francis gerald jeff judy keith lewis magda miriam nathan
        ralph raymond rose ryan sophie stephen steven teresa theresa veronica virginia wendy yuri yvonne""".split()
    for name in cut:
        assert pii.redact(f"I saw {name.title()} Ostrow") == "I saw [NAME]"


@pytest.mark.parametrize("at", ["@", " @ ", " at ", " AT ", " arroba ", "(at)", " ( at ) ", "[ät]", " [ ÄT ] ", "{arroba}", " < at > ", "(@)"])
@pytest.mark.parametrize("dot", [".", " dot ", " punkt ", " punto ", " point ", " ponto ", "(dot)", " [ . ] ", "{punto}", " < DOT > "])
def test_disguised_addresses_of_all_shapes(at, dot):
    address = f"karl{at}oldpost{dot}example"
    # a spaced "at" with a plain or bracketed dot only is an address where the pattern says so
    wanted = ["email"] if list(pii._emails(pii.normalise(address))) else []
    assert [k for _, _, k in pii.spans(address)] == wanted


@pytest.mark.parametrize("address", ["anna ( at ) oldpost.example", "luisa arroba correo punto com", "karl [ät] oldpost.example"])
def test_disguised_addresses_that_were_lost(address):
    assert pii.redact(f"write to {address} soon") == "write to [EMAIL] soon"


# ---------------------------------------------------------------- 8 and 9


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.binary(min_size=1, max_size=8), st.lists(st.integers(0, 60000), min_size=1, max_size=4), max_size=40), st.lists(st.binary(max_size=8), max_size=20))
def test_lexicon_is_a_map(entries, others):
    lex = lexicon.Lexicon(lexicon.to_bytes(lexicon.compile_words(entries)))
    words = [*entries, *others]
    for w, p in zip(words, lex.positions(words), strict=True):
        assert (lex.ids_at(p) if p >= 0 else None) == entries.get(w)


def test_lexicon_shares_suffixes():
    words = [a + b"ing" for a in (b"walk", b"talk", b"sing", b"ring")]
    arrays = lexicon.compile_words({w: [1] for w in words})
    assert len(arrays["final"]) < sum(map(len, words)) / 2


needs_files = pytest.mark.skipif(not os.path.exists(tokens.TOKENIZER_DIR), reason="no vocabulary files")


@needs_files
def test_token_ids_equal_the_public_tokenizer(spark, sf):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(f"{tokens.TOKENIZER_DIR}/byte_bpe_50k.json")
    tok.encode_special_tokens = True
    extra = [(-1, None), (-2, ""), (-3, " \n\t "), (-4, "<|endoftext|> a"), (-5, "x" * 3000), (-6, "é́\U0001f3b7‍ ﷽"), (-7, LONG), (-1, None)]
    d = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id bigint, text string")).withColumn("ids", F.lit("clash"))
    for size in (50, tokens.LEXICON_WORDS):
        got = Counter((r.doc_id, tuple(r.ids)) for r in tokens.encode(d, lexicon_words=size).collect())
        want = Counter((r.doc_id, tuple(tok.encode(r.text or "", add_special_tokens=False).ids)) for r in d.collect())
        assert got == want
    assert tokens.encode(d.limit(0)).count() == 0


def test_long_merges_equal_short_ones():
    import random

    r = random.Random(2)
    ranks = {bytes([c]): i for i, c in enumerate(b"abcd")}
    while len(ranks) < 60:
        a, b = r.choice(list(ranks)), r.choice(list(ranks))
        if len(a + b) < 7:
            ranks.setdefault(a + b, len(ranks))
    for _ in range(200):
        w = bytes(r.choice(b"abcd") for _ in range(r.randrange(2, 60)))
        parts = [w[i : i + 1] for i in range(len(w))]
        assert w in ranks or tokens._merge_long(parts, ranks) == tokens.merge_by_rank(w, ranks)


def test_poisson_thresholds_of_large_means():
    t = mixing.thresholds(2000.0, 2100)
    assert t == sorted(t) and t[0] < 1e-300 and abs(t[2000] - 0.5) < 0.02 and t[-1] > 0.98
    assert mixing.solve([(0.5, 10)], 5000, 10 * 4000.0) > 3900


def test_poisson_inverse():
    import math

    for mean in (0.3, 1.7, 4.0):
        n = 20000
        got = Counter(mixing.copies((i + 0.5) / n, mean, 50) for i in range(n))
        for k in range(8):
            assert abs(got[k] / n - math.exp(-mean) * mean**k / math.factorial(k)) < 1e-3
    assert mixing.copies(0.999999, 5.0, 3) == 3 and mixing.copies(0.0, math.inf, 4) == 4 and mixing.copies(0.999, 0.0, 4) == 0


@needs_files
def test_mix_meets_shares_and_caps(spark):
    docs = [(i, "word " * (1 + i % 9), None, "big" if i % 10 else "small") for i in range(4000)] + [(9001, None, None, "big"), (9002, "", None, "small"), (9003, "word", None, None), (9004, "word", None, "other")]
    d = spark.createDataFrame(docs, DOCS).withColumn("n_tokens", F.lit("clash")).withColumn("u", F.lit(1))
    t = spark.createDataFrame([("big", 0.7, 1), ("small", 0.3, 4), ("absent", 0.0, 2), (None, 0.1, 1)], "source string, target_share double, max_repeats int")
    mix = mixing.Mix(d, t)
    shares = {r.source: r for r in mix.shares().collect()}
    assert abs(shares["big"].actual_share - 0.7) < 0.01 and abs(shares["small"].actual_share - 0.3) < 0.01 and shares["absent"].actual_share == 0
    rows = mix.mixed().collect()
    per = Counter(r.doc_id for r in rows)
    caps = {"big": 1, "small": 4}
    assert all(per[r.doc_id] <= caps[r.source] for r in rows) and not {9001, 9002, 9003, 9004} & set(per)
    assert [r.shuffle_key for r in rows] == sorted(r.shuffle_key for r in rows) and len({(r.doc_id, r["copy"]) for r in rows}) == len(rows)
    again = mixing.Mix(d.repartition(5), t).mixed().collect()
    assert rows == again
    assert mixing.Mix(d.limit(0), t).mixed().count() == 0


# ---------------------------------------------------------------- 10


@pytest.mark.parametrize(
    ("text", "lang", "want"),
    [
        ("Dr. Stone came at 9 p.m. sharp. He left.", "en", ["Dr. Stone came at 9 p.m. sharp.", "He left."]), ('"Is it so?" she asked. "Stay out!" We left.', "en", ['"Is it so?" she asked.', '"Stay out!"', "We left."]),
        ("A heading\n\nIt costs $4.50 in\ntown. cut off", "en", ["A heading", "It costs $4.50 in\ntown.", "cut off"]), ("Vol. 3, No. 4 is out.Next one is due!", "en", ["Vol. 3, No. 4 is out.", "Next one is due!"]),
        ("Er kam am 3. Mai, z. B. mit Dr. Berg. Schön!", "de", ["Er kam am 3. Mai, z. B. mit Dr. Berg.", "Schön!"]), ("« C’est beau », dit-elle. Quel bruit ! Oui.", "fr", ["« C’est beau », dit-elle.", "Quel bruit !", "Oui."]),
        ("Llegó a las 9 p. m.. ¿Por qué?", "es", ["Llegó a las 9 p. m..", "¿Por qué?"]), ("Билет стоит 4 руб. и т. д. сегодня. «Да», — сказал он.", "ru", ["Билет стоит 4 руб. и т. д. сегодня.", "«Да», — сказал он."]),
        ("“真好！”她说。门票是4.5元，另算。我等了很久……他没来。", "zh", ["“真好！”她说。", "门票是4.5元，另算。", "我等了很久……", "他没来。"]), ("「好きだ。」と言った。本当？", "ja", ["「好きだ。」と言った。", "本当？"]),
        ("यह सुंदर है। क्या सच?", "hi", ["यह सुंदर है।", "क्या सच?"]), ("หนังสวยดีค่ะ บัตร 45 บาทครับ", "th", ["หนังสวยดีค่ะ", "บัตร 45 บาทครับ"]), ("Γιατί τόσο; Ήταν ωραίο.", "el", ["Γιατί τόσο;", "Ήταν ωραίο."]), ("هل كانت؟ قال د. سليم نعم.", "ar", ["هل كانت؟", "قال د. سليم نعم."]),
        ("", "en", []), ("  \n\n ", None, []), (None, "en", []),
    ],
)
def test_sentences(text, lang, want):
    ends = sentences.Segmenter().ends(text, lang)
    out, at = [], 0
    for e in ends:
        out.append(text[at:e].strip())
        at = e
    assert out == want


def test_sentence_tables(spark):
    d = spark.createDataFrame([(1, "One. Two.", "en", None), (2, None, None, None), (3, " ", None, None), (4, LONG, None, None), (1, "One. Two.", "en", None)], DOCS).withColumn("end_pos", F.lit("x"))
    got = defaultdict(list)
    for r in sentences.sentence_ends(d).collect():
        got[r.doc_id].append(r.end_pos)
    assert sorted(got[1]) == [4, 4, 9, 9] and len(got[4]) == 5000 and set(got) == {1, 4}
    assert {r.sentence for r in sentences.sentences(d).where("doc_id = 1").collect()} == {"One.", "Two."}
    assert sentences.sentence_ends(d.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("He arrived at 5 p.m. She left.", ["He arrived at 5 p.m.", "She left."]),
        ("The U.S. Army came. It stayed.", ["The U.S. Army came.", "It stayed."]),
        ("He lives in the U.S. She does not.", ["He lives in the U.S.", "She does not."]),
        ("You can trust me. The rest is easy.", ["You can trust me.", "The rest is easy."]),
        *[(f"He waited {'.' * n} and went on.", [f"He waited {'.' * n} and went on."]) for n in (3, 30, 60, 400)],
        ("สวัสดี วันนี้อากาศดี ฉันไปตลาด", ["สวัสดี", "วันนี้อากาศดี", "ฉันไปตลาด"]),
        ("เขาไปตลาด และ ซื้อขนม 45 บาท", ["เขาไปตลาด และ ซื้อขนม 45 บาท"]),
        ("M. Durand est vu ici. Mme Petit aussi.", ["M. Durand est vu ici.", "Mme Petit aussi."]),
        ("Der 3. Mai war schön. Wir blieben.", ["Der 3. Mai war schön.", "Wir blieben."]),
    ],
)
def test_one_language_decides(text, want):
    seg = sentences.segmenter()
    at, got = 0, []
    for end in seg.ends(text):
        got.append(text[at:end].strip())
        at = end
    assert got == want


@pytest.mark.parametrize("measure", ["12in.", "10lbs.", "1lb.", "6ft.", "12oz.", "3yd.", "½in.", "12 in.", "6 FT."])
def test_measures_joined_to_their_number(measure):
    text = f"The {measure} record came out. We bought it."
    assert [text[:e].split()[-1] for e in sentences.segmenter().ends(text, "en")] == ["out.", "it."]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["12in.", "6ft.", "the", "The", "a.m.", "5p.m.", "Nr.", "3.", "2nd.", "No.", "x.", "out.", "etc.", "St.", "S.12.", "end!"]), min_size=1, max_size=8).map(" ".join))
def test_shorter_tables_decide_like_the_full_ones(text):
    seg = sentences.segmenter()
    full = seg.cascade(text, "en")[0]
    for p in (m.end() for m in seg.candidate.finditer(text)):
        if p < len(text):
            want = next((d for d, left, right in full if right(text, p) and left(text, 0, p)), False)
            assert seg._breaks(text, p, seg.cascade(text, "en")) == want


def test_toxic_words_across_a_block_edge(monkeypatch):
    import numpy as np

    scorer = toxic.Scorer(toxic.Tagger())
    lengths = []

    def marginals(feats, mask):
        lengths.extend(mask.sum(1).tolist())
        p = np.zeros(mask.shape)
        p[:, 63:65] = 0.5  # neither half would do
        return p * mask

    monkeypatch.setattr(scorer.model, "marginals", marginals)
    long, longer = " ".join(["word"] * 100), " ".join(["word"] * 200_000)
    (score, spans), (_, other) = scorer.score([long, longer])
    assert lengths == [100, 200_000] and score > 0
    assert [long[a:b] for a, b, _ in spans] == ["word word"] == [longer[a:b] for a, b, _ in other]
