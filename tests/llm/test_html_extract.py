import html
import re

import pytest

from pagewright.llm import html_extract as H


@pytest.mark.parametrize("page,want", [
    ("", []),
    ("plain &amp; text", ["plain & text"]),
    ("<p>unclosed <b>x<p>y", ["unclosed x", "y"]),
    ("<article>a<br>b &lt;p&gt; \n c&nbsp;d</article>", ["a b <p> c d"]),
    ("<body><nav><p>menu</p></nav><article><h1>T</h1><p>a<script>if (a < b) '</p><p>'</script>b</p></article><p>after</p></body>",
     ["T", "ab"]),
    ("<main><header>h</header><p>a<ul><li>one<li>two</ul><section class='comments'><p>c</p></section></main><footer>f</footer>",
     ["a", "one", "two"]),
    ("<div id=content><p>x<div class='ad box'>no</div><p>y</div><div class=sidebar>s</div>", ["x", "y"]),
    ("<div><p>x</p></div><form><label>l</label></form><div class='cookie-notice'>n</div>", ["x"]),
    ("<article>one</article><article>two</article>", ["one", "two"]),
    ("<!-- c --><p>a<!-- never closed <p>b", ["a"]),
    ("<title>t</title><p title='a>b'>c</p>", ["c"]),
    ("<p>a</b></i>c</p></p>d", ["ac", "d"]),
    ("<SCRIPT>x</SCRIPT ><P>Q</P>", ["Q"]),
    ("<style>never ends", []),
    ("a < b and <3", ["a < b and <3"]),
])
def test_blocks(page, want):
    assert H.blocks(page) == want


def test_deep_pages_don_t_recurse():
    assert H.blocks("<div>" * 5000 + "x" + "</div>" * 5000) == ["x"]


def site(body, n, host="a.example"):
    return [(i, f"http://{host}/{i}", body.replace("@", f"text {i} " * (20 + i))) for i in range(n)]


def test_template_classes(spark):
    pages = spark.createDataFrame(site("<html><body><div class=top>Site</div><div class=box><p>@</p><p>@</p></div></body>", 6),
                                  "page_id long, url string, html string")
    t = {(r.depth, r.times // r.pages, r.slot): r for r in H.templates(pages).collect()}
    once = {(r.v1, r.v2) for r in t.values() if r.times == r.pages}
    twice = {(r.v1, r.v2) for r in t.values() if r.times == 2 * r.pages}
    assert len(once) == 1 and len(twice) == 1 and once != twice  # equal vectors, equal classes
    assert t[(3, 2, False)].size == 2  # p opens and closes twice a page


def test_vectors_are_exact_over_tasks(spark):
    """Class sums equal those of one dictionary over all pages, however pages are dealt."""
    rows = site("<body><div><p>@</p></div></body>", 9) + site("<body><div><i>@</i></div><div></div></body>", 7, "b.example")
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    a, b = (sorted(map(tuple, H.tokens(df.repartition(n)).collect())) for n in (1, 7))
    assert a == b and len(a) > 6


def test_a_main_slot_is_deduced_without_names(spark):
    body = "<body><div class=xa><a>Home</a></div><div class=xb><p>@</p><div class=xc><p>tiny</p></div></div><div class=xd>end</div></body>"
    pages = spark.createDataFrame(site(body, 5), "page_id long, url string, html string")
    got = {r.page_id: r.text for r in H.extract(pages, ["page_id"]).collect()}
    assert got[0] == ("text 0 " * 20).strip() + "\ntiny" and "Home" not in got[4] and "end" not in got[4]


def test_a_page_without_the_template_is_judged_alone(spark):
    rows = site("<body><article><p>@</p></article><p>no</p></body>", 5) + [(9, "http://a.example/x", "<body><p>other</p></body>")]
    got = {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), ["page_id"]).collect()}
    assert got[9] == "other" and got[1] == ("text 1 " * 21).strip()


def texts(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: r.text for r in H.extract(df, ["page_id"]).collect()}


def test_text_of_the_template_is_left_out_without_names(spark):
    body = ("<body><div class=qa><p>Lesen Sie auch unsere Hinweise</p></div><p class=qb>Stets gleich</p><div class=qc><p>@</p><p>@</p></div>"
            "<div class=qd>Diskussion der Leser</div></body>")
    got = texts(spark, site(body, 6))
    assert all(got[i] == "\n".join([("text %d " % i * (20 + i)).strip()] * 2) for i in range(6))
    # the same text in two pages only isn't a template, and a page of nothing else keeps it
    assert "Hinweise" in texts(spark, site(body, 2))[0]
    same = [(i, "http://b.example/", f"<body><script>{i}</script><div><p>same</p></div></body>") for i in range(5)]
    assert set(texts(spark, same).values()) == {"same"}


def test_small_named_slots_don_t_hide_the_article(spark):
    for name in ("entry-meta", "post-date"):
        got = texts(spark, site(f"<body><div class={name}>on day @</div><div class=txt><p>@</p><p>@</p><p>@</p><p>@</p></div></body>", 4))
        assert all(t.count("\n") == 4 and t.count(f"text {i} ") >= 4 * 19 for i, t in got.items()), name
    assert H.blocks("<div class=post-date>today</div><div class=txt><p>a long text of many words</p></div>") == [
        "today", "a long text of many words"]


def test_varying_text_beside_the_largest_container_stays(spark):
    body = "<body><div class=top>Site</div><div class=lead>lead @</div><div class=txt><p>@</p><p>@</p><p>@</p><p>@</p></div></body>"
    got = texts(spark, site(body, 5))
    assert all(t.startswith(f"lead text {i}") and "Site" not in t and t.count("\n") == 4 for i, t in got.items())
    # one very long page doesn't decide for the others
    rows = site("<body><div class=xa><p>@</p></div><div class=xb><p>@</p></div></body>", 4)
    rows.append((9, "http://a.example/9", "<body><div class=xa><p>short</p></div><div class=xb><p>" + "long " * 50_000 + "</p></div></body>"))
    assert all(t.count("\n") == 1 for t in texts(spark, rows).values())


def test_copies_of_a_page_keep_their_text(spark):
    rows = [(i, "http://a.example/", "<body><nav>n</nav><article><p>same</p></article></body>") for i in range(20)]
    got = H.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), ["page_id"]).collect()
    assert len(got) == 20 and {r.text for r in got} == {"same"}


def test_odd_rows(spark):
    rows = [(1, None, None), (2, "not a url", ""), (None, "http://h/", "<p>x</p>"), (None, "http://h/", "<p>x</p>"), (3, "//H:80/a", "<p>y</p>")]
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "page_id long, url string, html string, text string, slots string")
    got = H.extract(df, ["page_id", "url", "slots"])
    assert sorted((str(r.page_id), r.text) for r in got.collect()) == [("1", ""), ("2", ""), ("3", "y"), ("None", "x"), ("None", "x")]
    assert H.extract(df.limit(0), ["page_id"]).count() == 0


def test_hosts_are_the_same_in_both_languages(spark):
    urls = ["http://A.b:80/x", "//u:p@h/", "ftp://h?x", "x", "", None, "http://h#f", "https:/one"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r.h for r in df.select(H._host("url").alias("h")).collect()] == [H.host_of(u) for u in urls]


def test_query_matches_the_article(spark, sf):
    """The given pages hold their text in an article of headings, paragraphs and line breaks."""
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = H.op10_html_extract(spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        article = re.search("<article>(.*?)</article>", pages[r.page_id], re.S)[1].replace("<br>", " ")
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("<h1>|</h1>|<p>|</p>", article)]
        assert r.text == "\n".join(filter(None, parts)) and r.n_chars == len(r.text)
