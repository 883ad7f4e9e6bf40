"""Main text of web pages by template deduction.

A page's tokens are its opening and closing tags, told apart by where they
stand (the path of element names, classes and ids; digits count as one). Over
the pages of a host each token has an occurrence vector: how often it is in
each page. Tokens with equal vectors form an equivalence class; vectors are
compared by two sums of hashes of (page, count), which tasks add up before
anything is shuffled, so no page list is ever gathered. A class is valid if it
is in at least half of the host's pages and its tokens close as they open.
Valid classes nest by their paths into the host's template.

A line of text is a token too, told apart by its letters and the element that
holds it. It is template if it is in the class of that element (the element says
the same wherever it stands), in three different pages at least. All other text
varies. The main text of a page is its ``article`` or ``main`` elements, else the
containers named like one, if they hold three quarters of the page's varying
text; else it is all varying text, with the containers that hold it. Menus,
headers, footers, sidebars, notices, adverts, forms, comments, scripts and
styles are left out. In a page without varying text, all text counts as such.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_schema, slices, table, text_column, written

#: Share of a host's pages that a template token is in, and of a page's varying text that named slots hold.
FREQUENT, MAIN_SHARE = 0.5, 0.75
#: Pages of different content that a line of the template is in.
DIFFERENT = 3
#: (host, token) sums a task keeps before passing them on.
KEPT_TOKENS = 200_000

# Element names by what they do.
RAW = ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section select summary "
    "table tbody td tfoot th thead tr ul".split())
LEFT_OUT = frozenset(
    "head nav header footer aside form button select textarea input label fieldset script style noscript template svg math "
    "canvas iframe object audio video dialog menu search noembed noframes xmp title".split())
#: An opening tag ends open elements of these names (up to the nearest container).
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",)}
CONTAINERS = frozenset("article aside body div footer form header html main nav ol section table td th ul dl select".split())
#: Words in a class, id or role that mark what isn't main text, and what is.
_NOT_MAIN = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|sponsor(?:ed)?|promo(?:tion)?|banner|nav|navbar|navigation|menu|"
    r"breadcrumbs?|header|masthead|footer|foot|sidebar|side|aside|widget|notice|cookies?|consent|gdpr|alert|popup|modal|"
    r"comments?|comment-list|disqus|respond|replies|reply|share|sharing|social|related|recommended|subscribe|newsletter|"
    r"signup|login|search|pagination|pager|contentinfo|complementary)(?:$|[\s_-])", re.I)
_MAIN = re.compile(r"(?:^|[\s_-])(?:article|main|content|post|entry|story|maincontent)(?:$|[\s_-])", re.I)

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTR = re.compile(r"(?:^|[\s\"'/])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_HOST = re.compile(r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)")


class Element:
    __slots__ = ("name", "path", "depth", "out", "main", "sign", "rank", "holder", "outer")

    def __init__(self, name: str, parent: Element | None, attrs: str):
        marks = [(m[1].lower(), m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(attrs)] if attrs else []
        self.name = name
        self.sign = name + "".join(f" {k}={re.sub('[0-9]+', '0', v)}" for k, v in sorted(marks))
        self.path = xxhash.xxh64_intdigest(self.sign.encode("utf-8", "replace"), parent.path if parent else 0) >> 1
        self.depth = parent.depth + 1 if parent else 0
        words = " ".join(v for _, v in marks)
        self.out = bool(parent and parent.out) or name in LEFT_OUT or (
            name not in ("html", "body", "article", "main") and bool(_NOT_MAIN.search(words)))
        #: 2: article or main, 1: named like one, 0: another container, -1: none
        self.main = (2 if name in ("article", "main") or "main" in words.split() else -1 if name not in CONTAINERS
                     else 1 if _MAIN.search(words) else 0)
        self.rank = max(self.main, parent.rank if parent else -1)
        #: path of the nearest block, and the next container around this element
        self.holder = self.path if name in BLOCK or not parent else parent.holder
        self.outer = parent and parent.box()

    def box(self) -> Element | None:
        """The nearest container, the page itself apart."""
        return self if self.name in CONTAINERS and self.name not in ("html", "body") else self.outer


def events(page: str) -> Iterator[tuple]:
    """``("open", element)``, ``("close", element, explicit)``, ``("break",)`` and ``("text", raw, stack)``
    in page order. Elements that end without a closing tag are closed where HTML does."""
    stack: list[Element] = []
    at, n = 0, len(page)

    def pop_to(i: int, explicit: bool):
        while len(stack) > i:
            e = stack.pop()
            yield "close", e, explicit and len(stack) == i

    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            yield "text", page[at:], stack
            break
        if m.start() > at:
            yield "text", page[at:m.start()], stack
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            if name == "br":
                yield "break", None
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].name == name:
                    yield from pop_to(i, True)
                    break
            else:
                if name == "p":
                    yield "break", "p"
            continue
        if name in VOID:
            yield "break", name
            continue
        ends = CLOSES.get(name, ())
        for i in range(len(stack) - 1, -1, -1):
            if stack[i].name in ends or stack[i].name == "p" and name in BLOCK:
                yield from pop_to(i, False)
                break
            if stack[i].name in CONTAINERS:
                break
        e = Element(name, stack[-1] if stack else None, m[3])
        stack.append(e)
        yield "open", e
        if name in RAW:
            end = re.compile(f"</{name}(?=[\\s/>])|\\Z", re.I).search(page, at)
            at = end.start()  # its text is no markup; the closing tag follows
    yield from pop_to(0, False)


def lines(page: str) -> Iterator[tuple[str, int, Element | None]]:
    """Text, token and innermost element of each block outside of what is left out: references decoded, white
    space as one space, trimmed, none empty."""
    parts: list[str] = []
    first, begun = None, False  # element of the first letters

    def line():
        nonlocal begun
        begun = False
        text = " ".join("".join(map(html.unescape, parts)).split())
        parts.clear()
        if text:
            yield text, xxhash.xxh64_intdigest(text.encode("utf-8", "replace"), first.holder if first else 0) >> 1, first

    for kind, *args in events(page):
        if kind == "text":
            raw, stack = args
            if stack and stack[-1].out:
                continue
            if not begun and not raw.isspace():
                first, begun = stack[-1] if stack else None, True
            parts.append(raw)
        elif kind == "break" and args[0] not in BLOCK:
            if parts:
                parts.append(" ")
        elif kind == "break" or args[0].name in BLOCK:
            yield from line()
    yield from line()


def blocks(page: str, fixed: set[int] | None = None) -> list[str]:
    """Lines of the main text.

    ``fixed`` are the tokens of the host's template lines. Without a host, the
    page's own ``article`` or ``main`` elements are its main text, else what is
    named like one if it holds most, else the whole page.
    """
    found = [(text, token, e, e.rank if e else -1) for text, token, e in lines(page)]
    varying = [x for x in found if x[1] not in (fixed or ())] or found
    size = sum(len(x[0]) for x in varying)
    for rank in (2, 1):
        share = sum(len(x[0]) for x in varying if x[3] >= rank)
        if share and (share >= MAIN_SHARE * size or fixed is None and rank == 2):
            return [x[0] for x in found if x[3] >= rank]
    if len(varying) == len(found):
        return [x[0] for x in found]
    tokens = {x[1] for x in varying}
    boxes = {id(x[2].box()) for x in varying if x[2] and x[2].box()}

    def held(e: Element | None) -> bool:
        box = e.box() if e else None
        while box is not None and id(box) not in boxes:
            box = box.outer
        return box is not None

    return [x[0] for x in found if x[1] in tokens or held(x[2])]


def host_of(url: str | None) -> str:
    m = _HOST.match(url or "")
    return m[1].lower() if m else ""


def page_tokens(page: str) -> dict[tuple[int, bool], list]:
    """Per (path, closing tag): occurrences, letters of the subtree outside of what is left out,
    depth, rank as a main element, whether it is left out, and None; or, per line that all elements of
    its path have in this page, with the path that holds it."""
    found: dict[tuple[int, bool], list] = {}
    for kind, *args in events(page):
        if kind == "open":
            e = args[0]
            t = found.get((e.path, False))
            if t is None:
                t = found[(e.path, False)] = [0, 0, e.depth, e.main, e.out, None]
            t[0] += 1
        elif kind == "close" and args[1]:
            t = found.setdefault((args[0].path, True), [0, 0, args[0].depth, args[0].main, args[0].out, None])
            t[0] += 1
        elif kind == "text":
            raw, stack = args
            if stack and not stack[-1].out:
                size = len(raw) - raw.count(" ")
                for path in {e.path for e in stack}:
                    found[(path, False)][1] += size
    times = Counter((token, e.holder, len(text)) for text, token, e in lines(page) if e)
    for (token, holder, size), n in times.items():
        if n == found[(holder, False)][0]:  # others are in another class than their element
            found[(token, False)] = [n, n * size, found[(holder, False)][2], -1, False, holder]
    return found


def tokens(pages: DataFrame) -> DataFrame:
    """``host, path, closing, v1, v2, pages, times, letters, depth, main, out, holder, contents``: a row per token
    of a host. Lines have the path that holds them as ``holder`` and hashes of up to ``DIFFERENT`` contents of
    pages that have them.

    ``v1, v2`` stand for the occurrence vector. Pages are told apart by
    page_id and content, so repeated rows count like one more equal page.
    """
    full = T.StructType([T.StructField("host", T.StringType()), T.StructField("path", T.LongType()),
                         T.StructField("closing", T.BooleanType()), T.StructField("v1", T.LongType()),
                         T.StructField("v2", T.LongType()), T.StructField("pages", T.LongType()),
                         T.StructField("times", T.LongType()), T.StructField("letters", T.LongType()),
                         T.StructField("depth", T.LongType()), T.StructField("main", T.LongType()),
                         T.StructField("out", T.BooleanType()), T.StructField("holder", T.LongType()),
                         T.StructField("contents", T.ArrayType(T.LongType()))])
    arrow = arrow_schema(full)
    half = (1 << 62) - 1  # sums wrap here, in tasks and in Spark alike

    def run(batches):
        sums: dict[tuple, list] = {}

        def flush():
            rows = [(*k, *v) for k, v in sums.items()]
            sums.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), arrow)], schema=arrow)

        for b in slices(batches):
            for i, url, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), text_column(b, "html")):
                host = host_of(url)
                key = xxhash.xxh64_intdigest(page.encode("utf-8", "replace"), (i or 0) & ((1 << 64) - 1))
                content = xxhash.xxh64_intdigest(page.encode("utf-8", "replace")) >> 1
                for (path, closing), (n, letters, depth, main, out, holder) in page_tokens(page).items():
                    h = xxhash.xxh64_intdigest(n.to_bytes(8, "little"), key)
                    t = sums.setdefault((host, path, closing), [0, 0, 0, 0, 0, depth, main, out, holder, []])
                    t[0] = (t[0] + (h & half)) & half
                    t[1] = (t[1] + (h >> 2)) & half
                    t[2] += 1
                    t[3] += n
                    t[4] += letters
                    if holder is not None and content not in t[9]:
                        t[9] = sorted([*t[9], content])[:DIFFERENT]
            if len(sums) > KEPT_TOKENS:
                yield flush()
        if sums:
            yield flush()

    part = pages.select("page_id", "url", "html").mapInArrow(run, full)
    add = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    return (part.groupBy("host", "path", "closing")
            .agg(add("v1").alias("v1"), add("v2").alias("v2"), F.sum("pages").alias("pages"), F.sum("times").alias("times"),
                 F.sum("letters").alias("letters"), F.min("depth").alias("depth"), F.max("main").alias("main"),
                 F.max("out").alias("out"), F.max("holder").alias("holder"),
                 F.slice(F.sort_array(F.array_distinct(F.flatten(F.collect_list("contents")))), 1, DIFFERENT).alias("contents"))
            .withColumns({c: F.pmod(F.col(c), F.lit(half + 1).cast("decimal(38,0)")).cast("long") for c in ("v1", "v2")}))


def templates(pages: DataFrame, t: DataFrame | None = None) -> DataFrame:
    """The template tokens of each host, with their class and whether they are a slot.

    A class has the ``size`` of its token set. Valid are classes in half of the
    host's pages or more in which every closing tag has its opening tag (an
    element may have no closing tag at all). ``t`` are the tokens, if there are any yet.
    """
    t = (written(tokens(pages), "tokens") if t is None else t).filter("holder is null")
    page_count = (pages.select(_host("url").alias("host")).groupBy("host").agg(F.count(F.lit(1)).alias("host_pages")))
    both = (t.groupBy("host", "path").agg(
        *(F.max(F.when(~F.col("closing"), F.col(c))).alias(c) for c in ("v1", "v2", "pages", "times", "letters", "depth")),
        F.max("main").alias("main"), F.max("out").alias("out"),
        *(F.max(F.when(F.col("closing"), F.col(c))).alias(f"close_{c}") for c in ("v1", "v2"))))
    matched = F.col("close_v1").isNull() | ((F.col("close_v1") == F.col("v1")) & (F.col("close_v2") == F.col("v2")))
    valid = both.filter(matched).join(page_count, "host").filter(F.col("pages") >= FREQUENT * F.col("host_pages"))
    size = valid.groupBy("host", "v1", "v2").agg(F.sum(F.when(F.col("close_v1").isNull(), 1).otherwise(2)).alias("size"))
    return valid.join(size, ["host", "v1", "v2"]).withColumn("slot", (F.col("times") == F.col("pages")) & ~F.col("out"))


def _host(url: str):
    return F.lower(F.coalesce(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def fixed_lines(pages: DataFrame) -> DataFrame:
    """``host, fixed``: tokens of the lines in each host's template; hosts without any have no row."""
    t = written(tokens(pages), "tokens")  # a row per token of a host, read by every step below
    text = (t.filter("holder is not null").filter(F.size("contents") >= DIFFERENT)
            .select("host", F.col("path").alias("token"), F.col("holder").alias("path"), "v1", "v2"))
    return (text.join(templates(pages, t).select("host", "path", "v1", "v2"), ["host", "path", "v1", "v2"])
            .groupBy("host").agg(F.array_sort(F.collect_list("token")).alias("fixed")))


def extract(pages: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and ``text`` of each row of ``pages`` (``page_id, url, html``).

    Null html is empty and gives an empty text; a null url, or one without a
    host, belongs to the host "". Repeated rows come back repeated.
    """
    # a written table has a known size, by which Spark chooses to send it or to shuffle the pages
    fixed = written(fixed_lines(pages).toDF("__host", "__fixed"), "fixed")
    cols = list(dict.fromkeys([*keep, "html"]))
    rows = (pages.select(*cols, _host("url").alias("__h")).join(fixed, F.col("__h") == F.col("__host"), "left")
            .select(*cols, "__fixed"))
    full = T.StructType([rows.schema[c] for c in keep] + [T.StructField("text", T.StringType())])
    arrow = arrow_schema(full)

    def run(batches):
        for b in slices(batches):
            found = ["\n".join(blocks(page, set(f or ()))) for page, f in
                     zip(text_column(b, "html"), b.column(b.schema.get_field_index("__fixed")).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index(c)) for c in keep]
                                             + [pa.array(found, pa.string())], schema=arrow)

    return rows.mapInArrow(run, full)


def op10_html_extract(spark, sf_dir):
    """Query: the main text of every page."""
    return extract(table(spark, sf_dir, "pages"), ["page_id", "url"]).withColumn("n_chars", F.length("text").cast("long"))
