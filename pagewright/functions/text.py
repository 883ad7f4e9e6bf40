"""Text rules as native column expressions (H10-H12, T1-T6, extract chain).

Every rule is a ``regexp_replace``/``replace`` on a column, so the whole
HTML-to-Markdown conversion runs inside whole-stage codegen with no Python
worker. Two cases that a regular expression can't do, hidden elements inside
each other and character references beyond the common ones, are array
expressions, evaluated only for the texts that have them. Group references use Java syntax (``$1``); newlines are real
characters in the replacement, never an escaped ``\\n`` in SQL text.
"""

from __future__ import annotations

import json
from html import entities

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import FAILED, SUCCESS

NL = "\n"
# Table and image markers survive the tag stripper as control characters
# and are turned back into <table>/<image> tags at the end.
LT, GT = "\x01", "\x02"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def combined_text(summary: Column | str, extracted: Column | str) -> Column:
    """Summary, a blank line, extracted text; NULL parts read as ``""``."""
    return F.concat(F.coalesce(_c(summary), F.lit("")), F.lit("\n\n"),
                    F.coalesce(_c(extracted), F.lit("")))


def is_blank(text: Column | str) -> Column:
    """Nothing but (Unicode) whitespace; NULL is blank."""
    t = _c(text)
    return t.isNull() | ~t.rlike(r"(?U)[^\s\x1c-\x1f]")


def status_from_error(error: Column | str) -> Column:
    """No error means SUCCESS."""
    return F.when(_c(error).isNull(), F.lit(SUCCESS)).otherwise(F.lit(FAILED))


# Elements whose text is not part of a page, in the order of removal.
HIDDEN = ("script", "style", "nav", "footer")


_BLOCKS = "head|nav|footer"
# Texts that take the element stack: two opening or closing tags of one element, or such a tag in a comment.
_STACKED = (rf"(?is)<({_BLOCKS})[\s>].*<\1[\s>]|</({_BLOCKS})\s*>.*</\2\s*>"
            rf"|<!--[^>]*</?(?:{_BLOCKS}|script|style)[\s>]")
_HIDDEN_TAG = (r"(?is)<!--.*?-->|<(script|style)(?:\s[^>]*)?>.*?</\1\s*>"
               rf"|</?(?:{_BLOCKS})(?:\s[^>]*)?>")


def _strip_stacked(t: Column) -> Column:
    """The text outside hidden elements, by a stack of the open ones.

    A closing tag ends the last open element of its name and all that were
    opened in it. Elements that nothing closes are not hidden, as in the rules
    for the other texts; tags in comments, scripts and styles don't count.
    """
    tags = F.transform(F.regexp_extract_all(t, F.lit(_HIDDEN_TAG), F.lit(0)), lambda x, i: F.struct(
        F.lower(F.regexp_extract(x, "^</?([A-Za-z]*)", 1)).alias("name"), x.startswith("</").alias("ends"), i.alias("at")))
    tags = F.filter(tags, lambda g: g["name"].isin(*_BLOCKS.split("|")))
    empty = F.struct(F.array().cast("array<struct<name:string,at:int>>").alias("open"),
                     F.array().cast("array<struct<a:int,z:int>>").alias("cut"))

    def step(s, g):
        began = F.array_max(F.transform(F.filter(s["open"], lambda o: o["name"] == g["name"]), lambda o: o["at"]))
        opened = F.concat(s["open"], F.array(F.struct(g["name"].alias("name"), g["at"].alias("at"))))
        closed = F.transform(F.array(began), lambda b: F.struct(
            F.filter(s["open"], lambda o: o["at"] < b).alias("open"),
            F.concat(F.filter(s["cut"], lambda c: c["a"] < b), F.array(F.struct(b.alias("a"), g["at"].alias("z")))).alias("cut")))[0]
        return (F.when(~g["ends"], F.struct(opened.alias("open"), s["cut"].alias("cut")))
                .when(began.isNotNull(), closed).otherwise(s))

    # an array of one row, so that the lambda reads the cuts instead of making them for every text
    parts = F.array(F.struct(F.split(t, _HIDDEN_TAG, -1).alias("texts"), F.aggregate(tags, empty, step)["cut"].alias("cut")))
    return F.transform(parts, lambda p: F.array_join(F.filter(
        p["texts"], lambda _, j: ~F.exists(p["cut"], lambda c: (c["a"] < j) & (j <= c["z"]))), ""))[0]


def strip_hidden(t: Column) -> Column:
    """Drop head/script/style/nav/footer elements, also inside each other, and comments."""
    return F.when(t.rlike(_STACKED), _strip_stacked(t)).otherwise(_strip_flat(t))


def _strip_flat(t: Column) -> Column:
    t = F.regexp_replace(t, r"(?is)<head(\s[^>]*)?>.*?</head\s*>", "")
    for name in HIDDEN:  # one pass per element: a block ends with its own closing tag
        t = F.regexp_replace(t, rf"(?is)<{name}(\s[^>]*)?>.*?</{name}\s*>", "")
    return F.regexp_replace(t, r"(?s)<!--.*?-->", "")


def tables_to_blocks(t: Column) -> Column:
    """``<table>`` blocks with one ``| a | b |`` line per row."""
    t = F.regexp_replace(t, r"(?is)<table(\s[^>]*)?>", NL + LT + "table" + GT + NL)
    t = F.regexp_replace(t, r"(?is)</table\s*>", NL + LT + "/table" + GT + NL)
    t = F.regexp_replace(t, r"(?is)<caption(\s[^>]*)?>(.*?)</caption\s*>", "$2" + NL)
    t = F.regexp_replace(t, r"(?is)<tr(\s[^>]*)?>", NL + "|")
    t = F.regexp_replace(t, r"(?is)</t[hd]\s*>", " |")
    t = F.regexp_replace(t, r"(?is)<t[hd](\s[^>]*)?>", " ")
    return F.regexp_replace(t, r"(?is)</tr\s*>", "")


def images_to_blocks(t: Column) -> Column:
    """T4: ``<image>`` block holding the alt text or caption, else empty."""
    blk = lambda inner: NL + LT + "image" + GT + inner + LT + "/image" + GT + NL
    t = F.regexp_replace(t, r"(?is)<figcaption(\s[^>]*)?>(.*?)</figcaption\s*>", blk("$2"))
    t = F.regexp_replace(t, r"(?is)<img\s[^>]*alt=\"([^\"]*)\"[^>]*>", blk("$1"))
    t = F.regexp_replace(t, r"(?is)<img\s[^>]*alt='([^']*)'[^>]*>", blk("$1"))
    return F.regexp_replace(t, r"(?is)<img(\s[^>]*)?>", blk(""))


def strip_filler(t: Column) -> Column:
    """Drop runs of 3+ filler characters, ``&amp;`` counting as one."""
    return F.regexp_replace(t, r"(?:&amp;|[._#*$%&]){3,}", "")


def markdown_blocks(t: Column) -> Column:
    """T5: list items and headings to Markdown, block tags to newlines."""
    t = F.regexp_replace(t, r"(?i)<li(\s[^>]*)?>", NL + "- ")
    for n in range(1, 7):
        t = F.regexp_replace(t, rf"(?i)<h{n}(\s[^>]*)?>", NL + "#" * n + " ")
    return F.regexp_replace(t, r"(?i)</?(p|h[1-6]|div|ul|ol|article|section|br)(\s[^>]*)?/?>", NL)


# Common entities decoded after tags are removed; &amp; goes last
# or with the others, so that no text is decoded twice.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#34;", '"'), ("&#39;", "'"), ("&#x27;", "'"), ("&apos;", "'"),
            ("&nbsp;", " "), ("&#160;", " "), ("&copy;", "\u00a9"), ("&middot;", "\u00b7"), ("&ndash;", "\u2013"),
            ("&mdash;", "\u2014"), ("&hellip;", "\u2026"), ("&lsquo;", "\u2018"), ("&rsquo;", "\u2019"),
            ("&ldquo;", "\u201c"), ("&rdquo;", "\u201d"), ("&laquo;", "\u00ab"), ("&raquo;", "\u00bb"),
            ("&euro;", "\u20ac"), ("&amp;", "&"))
_REFERENCE = r"(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]{1,31});"
_UNCOMMON = f"&(?!(?:{'|'.join(k[1:-1] for k, _ in ENTITIES)});)" + _REFERENCE
# The standard's names, and what it reads the C1 controls as.
_NAMED = {k[:-1]: v for k, v in entities.html5.items() if k.endswith(";")}
_C1 = "".join(map(chr, range(0x80, 0xA0)))
_C1_READ = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(0x80, 0xA0))


def decode_references(t: Column) -> Column:
    """Every named or numeric character reference, ``&amp;`` included, once; unknown names stay."""
    names = F.from_json(F.lit(json.dumps(_NAMED)), "map<string,string>")

    def char(x):
        code = F.coalesce(F.conv(F.nullif(F.regexp_extract(x, "^&#[xX]([0-9a-fA-F]+)", 1), F.lit("")), 16, 10),
                          F.nullif(F.regexp_extract(x, "^&#([0-9]+)", 1), F.lit(""))).cast("int")
        valid = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        point = F.when(valid, code).otherwise(F.lit(0xFFFD))
        text = F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")
        named = F.try_element_at(names, F.regexp_extract(x, "^&(.*);$", 1))
        return F.when(code.isNotNull(), F.translate(text, _C1, _C1_READ)).otherwise(F.coalesce(named, x))

    read = F.transform(F.regexp_extract_all(t, F.lit("&" + _REFERENCE), F.lit(0)), char)
    return F.array_join(F.zip_with(F.split(t, "&" + _REFERENCE, -1), read, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")


def strip_tags(t: Column, page: Column) -> Column:
    """``t`` without tags, references decoded; ``page`` is the text from which ``t`` was made."""
    t = F.regexp_replace(t, r"(?s)<[^>]+>", "")
    for k, v in ENTITIES[:-1]:
        t = F.replace(t, F.lit(k), F.lit(v))
    t = F.replace(F.replace(t, F.lit(LT), F.lit("<")), F.lit(GT), F.lit(">"))
    # asked of the page: a condition on ``t`` would evaluate the rules before it once more
    return F.when(page.rlike(_UNCOMMON), decode_references(t)).otherwise(F.replace(t, F.lit("&amp;"), F.lit("&")))


def collapse_whitespace(t: Column) -> Column:
    """One space for blank runs, at most one empty line, trimmed."""
    t = F.regexp_replace(t, r"[ \t\r\f]+", " ")
    t = F.regexp_replace(t, r" ?\n ?", NL)
    t = F.regexp_replace(t, r"\n{3,}", NL + NL)
    return F.regexp_replace(t, r"^\s+|\s+$", "")


def finalize(t: Column) -> Column:
    """No code fence lines; a blank page is ``""``."""
    return F.coalesce(F.regexp_replace(t, r"(?m)^```[^\n]*\n?", ""), F.lit(""))


def html_to_markdown(html: Column | str) -> Column:
    """P3 default: the fixed chain of SURVEY 2.9.1 on one HTML column.

    The markup rules only change text that holds ``<``, ``&`` or a marker
    character; for plain
    text the same result comes from the filler and whitespace rules alone,
    so those rows skip the markup passes.
    """
    h = _c(html)
    t = strip_hidden(h)
    t = tables_to_blocks(t)
    t = images_to_blocks(t)
    t = strip_filler(t)
    t = markdown_blocks(t)
    t = strip_tags(t, h)
    marked = h.contains("<") | h.contains("&") | h.contains(LT) | h.contains(GT)
    t = F.when(marked, t).otherwise(F.regexp_replace(h, r"[._#*$%&]{3,}", ""))
    return finalize(collapse_whitespace(t))
