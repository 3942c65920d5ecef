"""Page operators on odd rows, an empty table and clashing columns."""

import hashlib
import os

import pytest

from changeloom.llm import html, urls, warc
from helpers import CLASHING

LONG = "<p>" + "long text here " * 20_000 + "</p>"
PAGES = [
    (1, "http://a.example.org/es/1?x=1", "<html><body><nav>menu</nav><article><h1>T</h1><p>One &amp; two<p>x</article></body>"),
    (2, "http://a.example.org/en/12#y", None), (3, None, "<p>text without url</p>"), (4, "no scheme", ""),
    (5, "https://WWW.Example.COM/fr/", "plain text only"), (6, "https://com/de/1", "<p>" + "same page " * 30),
    (7, "https://b.com", "<p>" + "same page " * 30), (7, "https://b.com", "<p>" + "same page " * 30),
    (8, "ftp://x.net:21/a b\n?q", "<p>" + "same page " * 30), (None, "https://c.org/", "<p>null id"),
    (9, "https://long.org/", LONG), (10, "https://d.org/é/日本", "<p>é 日本 🙂 &eacute;"), (11, "://", "<broken <p a='x>"),
    (12, "https://organ/es/", "x"), (13, "http://example.org/en/1", "y"), (14, "http://example.org", "z"),
]


def pages(spark, rows=PAGES):
    schema = "page_id bigint, url string, html string, " + ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame([(*r, *["x"] * len(CLASHING)) for r in rows], schema)


def page(body, wrap="<html><head><title>t</title></head><body>{}</body></html>"):
    return html.extract(wrap.format(body), [])[0]


@pytest.mark.parametrize("body, text", [
    ("<p>a  b\n c<br>d</p><p>e</p>", "a b c d\n\ne"),
    ("<p>x &lt;y&gt; &eacute;&#233;&nbsp;z</p>", "x <y> éé z"),
    ("<nav><p>menu</p></nav><header>head</header><article><p>main text</p></article><footer>foot</footer>", "main text"),
    ("<article><h1>Title</h1><p>one</p><aside>side</aside><form>f<input></form><p>two</p>"
     "<div class='comments'><p>a comment</p></div></article>", "Title\n\none\n\ntwo"),
    ("<div class='cookie-notice'>We use cookies</div><div id='content'><p>article text</p></div>"
     "<div class='side-bar sidebar'><p>more</p></div>", "article text"),
    ("<p>a<script>var x='<p>no</p>'</script>b<style>p{}</style><!-- <p>no</p> -->c", "abc"),
    ("<ul><li>one<li>two</ul>", "one\n\ntwo"), ("<p><b>bold</p><p>next</b> text", "bold\n\nnext text"), ("", ""),
    ("text &amp without end", "text & without end"),
])
def test_extract(body, text):
    assert page(body) == text


@pytest.mark.parametrize("tag", [
    "<svg class='i'/>", "<math/>", "<object data='x'/>", "<video-js id=a></video-js>", "<audio-player></audio-player>",
    "<title-block></title-block>", "<select-menu></select-menu>", "<video src=x>", "<iframe src=x>",
    "<svg><title/><text>no</text></svg>", "<video><p>no</video>", "<select><option>no</select>", "<title>no</title>"])
def test_embedded_elements_end_where_they_end(tag):
    assert page(f"<article><p>one</p>{tag}<p>two</p></article>") == "one\n\ntwo"


@pytest.mark.parametrize("before, after, kept", [
    ("<div class='entry-top'><h1>T</h1><p>lead</p></div>", "", "T\n\nlead\n\n{}"), ("<p>lead</p>", "", "lead\n\n{}"),
    ("<h1>T</h1>", "", "T\n\n{}"), ("", "<p>end</p>", "{}\n\nend"), ("", "<div class=entry-content>end</div>", "{}\n\nend"),
    ("", "<div class=box><h2>Popular</h2><p>x</p></div>", "{}"), ("<div class=top><a href=x>Site</a></div>", "", "{}")])
@pytest.mark.parametrize("wrap", ["{}", "<div class=entry>{}</div>", "<div class=entry><div>{}</div></div>"])
def test_long_bodies_keep_what_stands_beside_them(before, after, kept, wrap):
    long = "running text of the article " * 60
    got = page(wrap.format(f"{before}<div class=entry-content><p>{long}</p></div>{after}"))
    assert got == kept.format(long.strip())


PROSE = "Some running text of an article that goes on for a while, " * 7


@pytest.mark.parametrize("source, text", [
    ("<body><form action=x><div class=content><h1>T</h1><p>{}</p></div></form>", "T\n\n{}"),
    ("<html><head><title>x</title><p>{}", "{}"), ("<html><head><title>x</title><div>{}</div>", "{}"),
    ("<body><div id=page class='with-sidebar'><div class=post><h2>T</h2><p>{}</p></div></div></body>", "T\n\n{}"),
    ("<body><div class='layout sidebar-right'><div class=text><p>{}</p></div></div></body>", "{}"),
    ("<article><p>a</p><p class='notice-period'>{}</p></article>", "a\n\n{}"),
    ("<article><p>a</p><section class='related-work'><p>{}</p></section></article>", "a\n\n{}"),
    ("<article><p>a</p><div class='share-price'>{}</div></article>", "a\n\n{}"),
    ("<article><div id='research-header-text'><p>{}</p></div></article>", "{}"),
    ("<article><button>x<p>{}</p></article>", "x\n\n{}"),
    ("<article><header><h1>Title</h1><p>lead</p></header><p>{}</p><footer>foot</footer></article>", "Title\n\nlead\n\n{}"),
    # marked boxes beside the article go, long ones too, also within a form around the page
    ("<div class=text><p>{0}</p></div><div class=sidebar><p>{0}</p></div>", "{0}"),
    ("<form><div class=text><p>{0}</p></div><div class='related-posts'><p>{0}</p></div></form>", "{0}"),
    ("<div class=text><p>short</p></div><div id=comments><p>{0}</p><p>{0}</p></div>", "short"),
    ("<div class=cookie-notice><p>{0}</p></div>", ""), ("<form><label>name</label><button>send</button></form>", ""),
    ("<header><h1>Site</h1></header><article><p>{0}</p></article>", "{0}"),
    ("<article><p>{0}</p><div class='post-comments'><p>{0}</p></div></article>", "{0}")])
def test_no_word_or_wrapper_loses_the_article(source, text):
    assert html.extract(source.format(PROSE), [])[0] == text.format(PROSE.strip())


def test_generated_pages_give_their_article():
    """Known articles between clutter, in wrappers of many kinds."""
    import random
    rng, right = random.Random(8), 0
    clutter = ["<nav><a href=x>Home</a> <a href=y>News</a></nav>", "<div class='ad-box'><p>Buy now and save</p></div>",
               "<aside><h2>Popular</h2><p>Other story here</p></aside>", "<div id=sidebar><p>About this site and more</p></div>",
               "<footer><p>Copyright somebody</p></footer>", "<form class=search><input><button>go</button></form>",
               "<div class='share-buttons'><a href=x>Share</a></div>", "<div class='comments'><p>Nice article, thanks!</p></div>",
               "<script>var a='<p>x</p>'</script>", "<div class='cookie-banner'><p>We use cookies here</p></div>"]
    wrappers = ["{}", "<div class=wrapper>{}</div>", "<form method=post>{}</form>", "<div class='layout sidebar-left'>{}</div>",
                "<div id=main class='page with-sidebar'>{}</div>", "<table><tr><td>{}</td></tr></table>"]
    bodies = ["<article>{}</article>", "<main>{}</main>", "<div class=post-body>{}</div>", "<div id=content><section>{}</section></div>"]
    for _ in range(300):
        blocks = [f"Block {k} " + "with words of the text " * rng.randint(2, 12) for k in range(rng.randint(2, 9))]
        inner = "<h1>Headline</h1>" + "".join(f"<p>{b}</p>" if rng.random() < .8 else f"<ul><li>{b}</ul>" for b in blocks)
        around = rng.sample(clutter, rng.randint(0, 6))
        cut = rng.randint(0, len(around))
        body = "".join(around[:cut]) + rng.choice(bodies).format(inner) + "".join(around[cut:])
        got = html.extract(f"<html><head><title>t</title></head><body>{rng.choice(wrappers).format(body)}</body></html>", [])[0]
        right += got == "\n\n".join(["Headline", *(b.strip() for b in blocks)])
    assert right >= 297


def test_hosts_vote_for_a_container(spark):
    """A short page follows its host, although its side column is longer."""
    def site(main, side):
        return (f"<body><div class='wrap'><div class='post p12'>{main}</div>"
                f"<div class='col two'>{side}</div></div></body>")
    long, side = "".join(f"<p>{'running text of the article ' * 4}</p>" for _ in range(9)), "<p>side</p>"
    rows = [(k, "http://h.org/1", site(long, side)) for k in range(5)]
    rows += [(9, "http://h.org/2", site("<p>short but real text</p>", "<p>other words on the side</p>"))]
    got = {r.page_id: r for r in html.main_text(pages(spark, rows)).collect()}
    assert got[9].text == "short but real text" and got[9].path.endswith("div.p0.post")
    assert got[0].text.count("\n\n") == 8


def test_pages_of_another_shape_keep_their_article(spark):
    """Several containers of the winning path, and a page in which it is a minor box."""
    text = lambda w, n=9: "".join(f"<p>{(w + ' text of the article ') * 4}</p>" for _ in range(n))      # noqa: E731
    site = "<body><div class=wrap>{}</div></body>"
    rows = [(k, "http://h.org/1", site.format(f"<div class=post>{text('running')}</div>")) for k in range(5)]
    rows += [(8, "http://h.org/2", site.format("".join(f"<div class=post>{text(w)}</div>" for w in ("one", "two", "three")))),
             (9, "http://h.org/3", site.format(f"<div class=long>{text('main', 6)}</div><div class=post>{text('box', 4)}</div>"))]
    got = {r.page_id: r.text for r in html.main_text(pages(spark, rows)).collect()}
    assert [w for w in ("one", "two", "three") if w in got[8]] == ["one", "two", "three"] and got[8].count("\n\n") == 26
    assert got[9].count("main text") == 24 and got[0].count("\n\n") == 8
    both = "<div class=post><p>a b c d e</p></div><div class=post><p>f g h i j</p></div><div class=post><p>x</p></div>"
    assert html.extract(both, [">div.post"])[0] == "a b c d e\n\nf g h i j\n\nx"


def test_main_text_of_odd_pages(spark):
    got = html.main_text(pages(spark)).collect()
    assert len(got) == len(PAGES)
    by = {r.page_id: r for r in got}
    assert by[1].text == "T\n\nOne & two\n\nx" and by[2].text == "" and by[2].n_chars == 0
    assert by[9].n_chars == len("long text here " * 20_000) - 1 and by[10].text == "é 日本 🙂 é"
    assert html.main_text(pages(spark, [])).collect() == []


def test_deep_and_broken_pages():
    assert html.extract("<div>" * 5000 + "x" + "</b></p>" * 5000, [])[0] == "x"
    assert html.extract("<b>" * 5000 + "x", [])[0] == "x"
    assert "a" in html.extract("<p>a" + "<i x=\"" * 300, [])[0]


def brute(url, rules=urls.RULES):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, "allow")))


@pytest.mark.parametrize("parts", [1, 3, 50])
def test_urls_equal_brute_force(spark, parts):
    rows = PAGES + [(1000 + k, f"http://{'abc'[k % 3]}.{'example' if k % 2 else 'x'}.{('org', 'com', 'net')[k % 3]}"
                     f"/{('es', 'fr', 'en', 'de')[k % 4]}/{k % 13}", "") for k in range(300)]
    got = urls.judge_urls(pages(spark, rows), urls.rule_table(spark), parts=parts).collect()
    assert sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got), key=str) == sorted(
        ((i, *brute(u)) for i, u, _ in rows), key=str)
    assert urls.judge_urls(pages(spark, []), urls.rule_table(spark)).collect() == []


def test_urls_with_nested_rules(spark):
    rules = [("com", "/", "block"), ("example.com", "/", "allow"), ("a.example.com", "/x/", "block"),
             ("a.example.com", "/x/y", "allow"), ("b.example.com", "/", "block"), ("exam", "/", "block")]
    rows = [(k, f"http://{h}{p}", "") for k, (h, p) in enumerate(
        (h, p) for h in ("com", "z.com", "example.com", "a.example.com", "q.a.example.com", "b.example.com", "exam", "an.exam")
        for p in ("/", "/x/", "/x/y/z", ""))]
    table = urls.rule_table(spark, rules)
    for parts in (1, 7):
        got = urls.judge_urls(pages(spark, rows), table, parts=parts).collect()
        assert {(r.page_id, r.rule, r.verdict) for r in got} == {(i, *brute(u, rules)[2:]) for i, u, _ in rows}


def read_all(folder):
    return {n: open(os.path.join(folder, n), "rb").read() for n in os.listdir(folder) if n.endswith(".gz")}


def test_warc_round_trip_is_whole_and_deterministic(spark, tmp_path):
    texts = []
    for k, df in enumerate((pages(spark), pages(spark).repartition(4, "html"))):
        folder = f"file://{tmp_path}/w{k}"
        manifest = warc.write_warc(df, folder, shard_bytes=2000, file_bytes=300).collect()
        assert sum(m.records for m in manifest) == len(PAGES) and len(manifest) > 3
        files = read_all(f"{tmp_path}/w{k}")
        assert {m.name: (m.bytes, m.sha256) for m in manifest} == {
            n: (len(b), hashlib.sha256(b).hexdigest()) for n, b in files.items()}
        assert not [n for n in os.listdir(f"{tmp_path}/w{k}") if n.endswith(".tmp")]
        texts.append(files)
        got = warc.read_warc(spark, folder).collect()
        assert len(got) == len(PAGES)
        responses = [r for r in got if r.record_type == "response"]
        payloads = {hashlib.sha256((h or "").encode()).hexdigest(): (h or "").encode() for _, _, h in PAGES}
        for r in got:
            assert r.payload_bytes == len(payloads[r.payload_digest])
            assert (r.page_id, r.url) in {(i, u) for i, u, _ in PAGES}
        same = [r for r in got if payloads[r.payload_digest] == ("<p>" + "same page " * 30).encode()]
        assert sorted((r.page_id, r.record_type, r.refers_to) for r in same) == [
            (6, "response", None), (7, "revisit", 6), (7, "revisit", 6), (8, "revisit", 6)]
        assert len(responses) == len(PAGES) - 3
    assert texts[0] == texts[1]


def test_warc_empty_table(spark, tmp_path):
    folder = f"file://{tmp_path}/e"
    assert warc.write_warc(pages(spark, []), folder).collect() == []
    assert warc.read_warc(spark, folder).collect() == []


def test_gzip_members_are_readable_by_others(spark, tmp_path):
    import gzip
    folder = f"file://{tmp_path}/g"
    warc.write_warc(pages(spark), folder).collect()
    data = b"".join(gzip.decompress(b) for b in read_all(f"{tmp_path}/g").values())
    assert data.count(b"WARC/1.1\r\n") == len(PAGES) + len(read_all(f"{tmp_path}/g"))
