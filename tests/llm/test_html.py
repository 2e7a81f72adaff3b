import pytest

from cohortflow.llm import html

PAGE = ('<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><ul><li>menu</ul></nav>'
        '<div class="cookie-notice">We use cookies</div>{body}<aside>side</aside><footer>&copy; foot</footer></body></html>')


@pytest.mark.parametrize("source,blocks", [
    ("", []), ("a < b <p>c", ["a < b", "c"]), ("<p>cut <a href='x", ["cut"]), ("<p>x &amp;amp; y&nbsp;&eacute;</p>", ["x &amp; y é"]),
    ("<article><h1>H</h1><p><b>one\n two<br>three<p>four</article>", ["H", "one two three", "four"]),
    ("<main><p>a<script>var t='</p>'</script>b</p><!-- x <p>no</p> --><form><p>f</form><p>c</main><p>out", ["ab", "c"]),
    ("<ul><li>a<li>b</ul><table><tr><td>x<td>y<tr><td>z</table>", ["a", "b", "x", "y", "z"]),
    ('<article><p>k</p><section id="comments"><p>bad</section><div class="share-bar">s</div><div role="navigation">n</div><p hidden>h</article>', ["k"]),
    ('<article><header><h1>Head</h1></header><p>t</p><footer>f</footer></article>', ["Head", "t"]),
    ('<div id="page-header">Site</div><article><div class="entry-header"><h1>Head</h1></div><p>t</p></article>', ["Head", "t"]),
    ('<div class="site header">Site</div><p>t</p><div class="ad-slot">x</div><div class="add">y</div>', ["t", "y"]),
    ('<div class="layout has-sidebar"><p>t</p><div class="site-sidebar"><p>s</p></div></div>', ["t"]),
    ('<div class="content with-sidebar"><article><p>t</p></article></div>', ["t"]),
    ('<div id="page" class="no-menu"><p>t</p></div><div class="search-result"><p>r</p></div>', ["t", "r"]),
    ('<div class="sidebar"><main><p>t</p></main><div class="sidebar"><p>s</p></div></div>', ["t"]),
    ('<div class="menu"><p>a longer paragraph</p><div class="nav2 menu-item-17">m</div></div><p>t</p>', ["a longer paragraph", "t"]),
    ('<div class="no-header"><p>t</p></div><div class="header"><article><p>u</p></article></div>', ["u"]),
    ('<article><p>t</p></article><div id="comments"><article class="comment"><p>long comment</p></article></div>', ["t"]),
    ('<p>a longer paragraph</p><h2 id="how-to-share-files">How</h2><div class="ad-300x250 x">m</div><div class="post-comments"><p>c</p></div>', ["a longer paragraph", "How"]),
    ("<p>one<div>two</p>three</div>", ["one", "two", "three"]), ("</p></div>text</b>", ["text"]),
])
def test_blocks(source, blocks):
    assert html.Page(source).blocks() == blocks


def test_page_frame_goes():
    assert html.Page(PAGE.replace("{body}", "<article><p>text</p></article>")).blocks() == ["text"]
    assert html.Page(PAGE.replace("{body}", "<p>text</p>")).blocks() == ["text"]


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "clash", None) for i, u, h in rows], "page_id long, url string, html string, host string, text string")


def test_template_subtrees_of_a_host_go(spark):
    box = '<div class="box"><p>read this too</p><p>and that</p></div>'
    rows = [(i, f"http://User@A.example:80/p{i}", f"<div><p>story {i}</p>{box}</div>") for i in range(12)]
    rows += [(100 + i, f"https://b.example/{i}", f"<p>tale {i}</p>{box}") for i in range(3)]  # too few to count
    rows += [(200 + i, f"http://c.example/{i}", f"<article><p>same quote</p><p>own {i}</p>{box}</article>") for i in range(12)]
    rows += [(300, None, f"<p>x</p>{box}"), (301, "no host", None), (302, "http://a.example/z", ""), (5, "http://a.example/p5", rows[5][2])]
    got = {}
    for r in html.extract(pages(spark, rows)).collect():
        got.setdefault(r["page_id"], set()).add(r["main_text"])
        assert r["host"] == "clash"
    for i in range(12):
        assert got[i] == {f"story {i}"}
        assert got[200 + i] == {f"same quote\n\nown {i}"}  # in an article recurring paragraphs stay
    assert got[101] == {"tale 1\n\nread this too\n\nand that"} and got[300] == {"x\n\nread this too\n\nand that"}
    assert got[301] == got[302] == {""}


def test_templates_of_a_large_host_need_no_share(spark):
    box = '<div class="box"><p>five pages have this</p></div>'
    rows = [(i, f"http://a.example/{i}", f"<div><p>story {i}</p>{box if i < 5 else ''}<section><p>all</p></section></div>") for i in range(400)]
    rows += [(1000 + i, f"http://b.example/{i}", f"<article><p>own {i}</p>{box if i < 5 else ''}</article>") for i in range(400)]
    rows += [(2000 + i, None, f"<p>x</p>{box}") for i in range(6)]
    got = {r["page_id"]: r["main_text"] for r in html.extract(pages(spark, rows)).collect()}
    assert {got[i] == f"story {i}" for i in range(400)} == {True}
    # in an article the share holds, and pages without host have no templates
    assert got[1000] == "own 0\n\nfive pages have this" and got[1009] == "own 9" and got[2000] == "x\n\nfive pages have this"


def test_pages_without_host_meet_in_no_single_task(spark):
    from pyspark.sql import functions as F

    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        rows = [(i, None, f"<p>text {i}</p>") for i in range(400)]
        got = html.extract(pages(spark, rows)).select("main_text", F.spark_partition_id().alias("task")).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert {r["main_text"] for r in got} == {f"text {i}" for i in range(400)}
    assert max(sum(r["task"] == t for r in got) for t in {r["task"] for r in got}) < 150


def test_query_and_empty_table(spark, tmp_path):
    rows = [(1, "http://a.b/c", PAGE.replace("{body}", "<article><p>é 日本 text</p></article>")), (None, None, None), (1, "http://a.b/c", "")]
    pages(spark, rows).write.parquet(f"{tmp_path}/pages.parquet")
    got = html.op10_html_text(spark, str(tmp_path))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r["text"], r["n_chars"]) for r in got.collect()) == [("", 0), ("", 0), ("é 日本 text", 9)]
    assert html.extract(pages(spark, [])).count() == 0


def test_hash_ignores_link_targets_only():
    a, b, c = (html.Page(x).hashes()[1] for x in ('<p class="k"><a href="/1">t</a></p>', '<p class="k"><a href="/2">t</a></p>', '<p class="k"><a href="/1">u</a></p>'))
    assert a == b != c


@pytest.mark.parametrize("source,blocks", [
    ("<article><h1>T</h1><div class='post-content share-container'>the text of it, all of it</div><div class='share-bar'>s</div></article>", ["T", "the text of it, all of it"]),
    ("<main><div class='search-page'>found: the text</div></main>", ["found: the text"]),
    ("<main><div class='alert-content'><p>the text</p></div><div class='alert'>x</div></main>", ["the text"]),
    ("<article><p>short</p><div id='comments'>a comment that is longer than the article itself, by far</div></article>", ["short"]),
    ("<div><p>the story, which stands in no article</p><p>goes on</p></div><article class='card teaser'><p>teaser</p></article>", ["the story, which stands in no article", "goes on", "teaser"]),
    ("<article><p>a long enough article text</p></article><div><p>see also</p></div>", ["a long enough article text"]),
    ("<div><b>x<span>y</b>z</div></span></b><p>t", ["xyz", "t"]),
])
def test_main_text_is_not_lost(source, blocks):
    assert html.Page(source).blocks() == blocks


def texts(spark, rows):
    return {r["page_id"]: r["main_text"] for r in html.extract(pages(spark, rows)).collect()}


def test_copies_are_no_template(spark):
    story = "<div><h1>Title</h1><p>one paragraph</p><p>and another</p></div>"
    menu = "<section><p>of this site</p></section>"
    rows = [(i, "http://a.example/same", f"<body>{story}</body>") for i in range(8)]  # one row eight times
    rows += [(100 + i, f"http://b.example/x?utm={i}", f"<head><link href='{i}'><title>{i}</title></head><body>{story}</body>") for i in range(8)]
    rows += [(200 + i, f"http://c.example/{i}", f"<body>{story}<p>{i}</p></body>") for i in range(8)]  # copies with small differences
    rows += [(300 + i, f"http://d.example/{i}", f"<body><p>own story {i % 6}</p>{menu}</body>") for i in range(12)]
    got = texts(spark, rows)
    whole = "Title\n\none paragraph\n\nand another"
    assert {got[i] for i in range(8)} == {got[100 + i] for i in range(8)} == {whole}
    assert [got[200 + i] for i in range(8)] == [f"{whole}\n\n{i}" for i in range(8)]
    assert [got[300 + i] for i in range(12)] == [f"own story {i % 6}" for i in range(12)]


def test_time_grows_with_the_length_of_hostile_pages():
    import time
    n = 100_000
    pages = ["<span>" * n + "</b>" * n, "<b><div>" + "<span>" * n + "</b>" * n, "<p><span>" + "<ul><b>" * n, "<span>" * n + "<p>x" * n, "<table>" + "<tr><td>x" * n, "<i>" * n + "</p>" * n]
    for source in pages:
        start = time.process_time()
        html.Page(source).blocks()
        assert time.process_time() - start < 20 * (2 if len(source) > 10**6 else 1)


def plain_tree(source):
    """Elements of a well-formed page as nested tuples, by the standard library's parser."""
    from html.parser import HTMLParser

    class Tree(HTMLParser):
        def __init__(self):
            super().__init__()
            self.open = [("#root", [], [])]
            self.all = []

        def handle_starttag(self, tag, attrs):
            self.open.append((tag, sorted(attrs), []))

        def handle_data(self, data):
            if data.strip():
                self.open[-1][2].append(data.strip())

        def handle_endtag(self, tag):
            name, attrs, inner = self.open.pop()
            assert name == tag
            texts = [x for x in inner if isinstance(x, str)]
            node = (name, tuple(attrs), tuple(texts), tuple(x for x in inner if not isinstance(x, str)))
            self.open[-1][2].append(node)
            self.all.append(node)

    t = Tree()
    t.feed(source)
    return t.all


def test_templates_against_a_plain_count(spark):
    import random
    rng = random.Random(7)
    part = lambda d: f"<{(g := rng.choice(['div', 'section', 'b']))} class='c{rng.randrange(3)}'>{'x' + str(rng.randrange(4)) if d == 0 else part(d - 1) + part(0)}</{g}>"
    rows = [(i, f"http://{'abc'[i % 3]}.example/{i}", f"<body>{part(rng.randrange(3))}{part(rng.randrange(2))}</body>") for i in range(400)]
    rows += [(1000 + i, *rows[i][1:]) for i in range(20)]
    found = {}
    for _, url, source in rows:
        nodes = plain_tree(source)
        for node in set(nodes):
            found.setdefault((url[7], node), []).append(nodes[-1])
    size = {s: sum(url[7] == s for _, url, _ in rows) for s in "abc"}
    want = sorted((s, len(b) >= 0.05 * size[s]) for (s, _), b in found.items() if len(set(b)) >= 5)
    frame = pages(spark, rows).selectExpr("html", "substr(url, 8, 1) AS site_name", "xxhash64(substr(url, 8, 1)) AS site", "page_id AS key").repartition(4)
    names = {r[0]: r[1] for r in frame.select("site", "site_name").distinct().collect()}
    assert sorted((names[r.site], r.often) for r in html.templates(frame).collect()) == want and len(want) > 20
