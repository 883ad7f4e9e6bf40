"""Scalar helpers against Python's own semantics on inline rows."""

import hashlib
import html.entities
import os
import random
import re

from pyspark.sql import functions as F

from pagewright.functions import hashing as H
from pagewright.functions import paths as P
from pagewright.functions import text as T

PATHS = ["doc.pdf", "a/b/doc.PDF", ".pdf", "a/.pdf", "x.y.pdf", "/lead.pdf",
         "2. Type/245 kV (2017)/a b.pdf", "x.", "..pdf", ".a.pdf"]


def py_split(path):
    return tuple(path.rsplit("/", 1)) if "/" in path else ("", path)


def py_page_path(path, n):
    parent, f = py_split(path)
    base = os.path.splitext(f)[0]
    folder = f"{parent}/{base}" if parent else base
    return f"{folder}/{base}-page-{n:05}.png"


def test_split_and_page_paths(spark):
    df = spark.createDataFrame([(p,) for p in PATHS], "path string")
    got = df.select("path", P.parent_dir("path").alias("parent"), P.file_name("path").alias("f"),
                    P.strip_extension(P.file_name("path")).alias("stem"),
                    P.page_object_path("path", F.lit(7)).alias("pp")).collect()
    for r in got:
        assert (r.parent, r.f) == py_split(r.path)
        assert r.stem == os.path.splitext(r.f)[0]
        assert r.pp == py_page_path(r.path, 7)


def test_page_number_padding(spark):
    ns = [1, 99999, 100000, 123456]
    df = spark.createDataFrame([(n,) for n in ns], "n int")
    got = [r[0] for r in df.select(P.page_id(F.lit("d"), "n")).collect()]
    assert got == [f"d_{n:05d}" for n in ns]


def test_hashes_equal_hashlib(spark):
    rows = [("hello wörld", "a/b.pdf"), ("", "x.pdf"), ("한글", "한글.pdf")]
    df = spark.createDataFrame(rows, "content string, path string")
    got = df.select(H.content_hash("content").alias("c"), H.doc_hash("content", "path").alias("d"),
                    H.file_hash("content", "md5").alias("m"), H.file_hash("content", "sha1").alias("s1"),
                    H.file_hash("content", "sha512").alias("s5")).collect()
    for (content, path), r in zip(rows, got):
        b = content.encode()
        assert r.c == hashlib.sha256(b).hexdigest()
        assert r.d == hashlib.sha256(b + path.encode()).hexdigest()
        assert r.m == hashlib.md5(b).hexdigest()
        assert r.s1 == hashlib.sha1(b).hexdigest()
        assert r.s5 == hashlib.sha512(b).hexdigest()


def test_binary_content_hash(spark):
    data = bytes(range(256))
    df = spark.createDataFrame([(bytearray(data), "p.pdf")], "content binary, path string")
    r = df.select(H.content_hash("content").alias("c"), H.doc_hash("content", "path").alias("d")).first()
    assert r.c == hashlib.sha256(data).hexdigest()
    assert r.d == hashlib.sha256(data + b"p.pdf").hexdigest()


def test_path_description_hits_misses_empty(spark):
    path = "2. Type Test Reports//300SR/unknown.pdf"
    got = spark.createDataFrame([(path,)], "p string").select(P.path_description("p")).first()[0]
    want = "\n".join(P.DESCRIPTIONS.get(k, "") for k in path.split("/"))
    assert got == want


def test_path_description_table_matches_map(spark):
    path = "IEC/x/IEEE/y.pdf"
    desc = spark.createDataFrame(list(P.DESCRIPTIONS.items()), "path_key string, description string")
    df = spark.createDataFrame([(path,)], "path string")
    got = P.path_description_join(df, "path", desc).first()["description"]
    assert got == "\n".join(P.DESCRIPTIONS.get(k, "") for k in path.split("/"))


def test_combined_text_and_blank(spark):
    cases = [(None, None), ("", ""), ("\t\n", "\n "), ("　", None), (" ", ""), ("a", None),
             (None, "\x1c")]
    df = spark.createDataFrame(cases, "s string, e string")
    got = df.select(T.combined_text("s", "e").alias("c"), T.is_blank(T.combined_text("s", "e")).alias("b")).collect()
    for (s, e), r in zip(cases, got):
        c = (s or "") + "\n\n" + (e or "")
        assert r.c == c
        assert r.b == (not c.strip())


def test_html_to_markdown_rules(spark):
    html = ("<html><head><title>T</title></head><body><nav>menu</nav><!-- c -->"
            "<h2>Title&amp;Co</h2><p>Intro ..... text ____ here</p>"
            "<ul><li>one</li><li>two</li></ul>"
            "<table><caption>Cap</caption><tr><th>A</th><th>B</th></tr><tr><td>1</td><td>2</td></tr></table>"
            "<img src='x' alt=\"Chart\"><img src='y'><footer>f</footer>&lt;ok&gt;</body></html>")
    out = spark.createDataFrame([(html,)], "h string").select(T.html_to_markdown("h")).first()[0]
    assert "menu" not in out and "T\n" not in out and " c " not in out
    assert "## Title&Co" in out
    assert "Intro text here" in out
    assert "- one\n- two" in out
    assert "<table>" in out and "</table>" in out and "| A | B |" in out and "| 1 | 2 |" in out
    assert "<image>Chart</image>" in out and "<image></image>" in out
    assert "<ok>" in out
    assert "\n\n\n" not in out and out == out.strip()


def test_finalize_fences_and_null(spark):
    df = spark.createDataFrame([("```markdown\nx\n```",), (None,)], "t string")
    got = [r[0] for r in df.select(T.finalize(F.col("t"))).collect()]
    assert got == ["x\n", ""]


def test_random_paths_follow_python_semantics(spark):
    import random
    rnd = random.Random(3)
    alphabet = ["a", "b", ".", ".", "/", " ", "é", "x.pdf", "..", "_"]
    paths = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 12))) for _ in range(400)]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    got = df.select("path", P.parent_dir("path").alias("parent"), P.file_name("path").alias("f"),
                    P.strip_extension(P.file_name("path")).alias("stem")).collect()
    for r in got:
        assert (r.parent, r.f) == py_split(r.path), r.path
        assert r.stem == (os.path.splitext(r.f)[0] or r.f), r.path


def py_strip_hidden(page):
    """A stack of open elements over the tags, letter ranges instead of pieces."""
    tag = re.compile(r"<!--.*?-->|<(script|style)(?:\s[^>]*)?>.*?</\1\s*>|<(/?)(head|nav|footer)(?:\s[^>]*)?>", re.I | re.S)
    drop, stack = bytearray(len(page)), []
    for m in tag.finditer(page):
        drop[m.start():m.end()] = b"\1" * (m.end() - m.start())
        if m[3] and not m[2]:
            stack.append((m[3].lower(), m.start()))
        elif m[3]:
            at = max((k for k, (name, _) in enumerate(stack) if name == m[3].lower()), default=None)
            if at is not None:
                drop[stack[at][1]:m.end()] = b"\1" * (m.end() - stack[at][1])
                del stack[at:]
    return "".join(c for c, d in zip(page, drop) if not d)


def hidden_pages(n):
    rng = random.Random(7)
    bits = ["<nav>", "</nav>", "<NAV class='a'>", "<footer>", "</footer >", "<head>", "</head>", "<!-- <nav> -->", "<!-- note -->",
            "<script>var a = '</nav>';</script>", "<style>p{}</style>", "text ", "more, ", "<p>", "</p>", "<header>", "a < b "]
    return ["".join(rng.choices(bits, k=rng.randrange(1, 16))) for _ in range(n)]


def test_hidden_elements_inside_each_other(spark):
    pages = hidden_pages(1500) + ["<nav>a<nav>b</nav>c</nav>d", "", None]
    df = spark.createDataFrame(list(enumerate(pages)), "i int, h string")
    got = df.select("i", "h", T._strip_stacked(F.col("h")).alias("s"), T.strip_hidden(F.col("h")).alias("t"),
                    F.col("h").rlike(T._STACKED).alias("stacked")).collect()
    assert sum(bool(r.stacked) for r in got) > 500
    for r in got:
        if r.h is None:
            assert r.s is None and r.t is None
            continue
        assert r.s == py_strip_hidden(r.h), r.h
        if r.stacked:
            assert r.t == r.s


def test_pages_without_nesting_are_the_same_both_ways(spark, sf):
    df = spark.read.parquet(f"{sf}/pages.parquet").select("html").dropDuplicates()
    got = df.select(T._strip_stacked(F.col("html")).alias("s"), T._strip_flat(F.col("html")).alias("t")).collect()
    assert got and all(r.s == r.t for r in got)


def test_character_references(spark):
    names = [n for n in html.entities.html5 if n.endswith(";")]
    texts = [f"a &{n} b" for n in names] + [f"&#{k};x&#x{k:X};" for k in (9, 65, 128, 151, 233, 8364, 0x1F600, 0x10FFFF - 2)]
    texts += ["&#38;amp; &amp;lt; &bogus; &amp &copy", "&#0;&#xD800;&#9999999;", "plain & simple", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(T.decode_references(F.col("t"))).collect()]
    for t, g in zip(texts[:-4], got):
        want = html.unescape(t)
        assert g == want or "FFFD" in t, t
    assert got[-4:] == ["&amp; &lt; &bogus; &amp &copy", "\ufffd\ufffd\ufffd", "plain & simple", ""]
    page = spark.createDataFrame([("<p>caf&eacute; &#x2014; &amp;eacute; &#60;b&#62;</p>",)], "h string")
    assert page.select(T.html_to_markdown("h")).first()[0] == "caf\u00e9 \u2014 &eacute; <b>"


def test_nested_tables_and_hidden_blocks_in_a_page(spark):
    page = ("<head><title>t</title></head><nav>menu<nav>sub</nav>still menu</nav><table><tr><td>a<table><tr><td>b</td></tr>"
            "</table></td><td>c</td></tr></table><footer><footer>x</footer>y</footer>")
    got = spark.createDataFrame([(page,)], "h string").select(T.html_to_markdown("h")).first()[0]
    assert got.count("<table>") == got.count("</table>") == 2 and "menu" not in got and "y" not in got
    assert got.index("a") < got.index("b") < got.index("c")
