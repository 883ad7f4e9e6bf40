"""Secret scans through nested encodings.

The text itself is scanned first; those findings are the base. Then a work
list unwraps layers until nothing new appears: URL escapes and Unicode escapes
of a whole layer, base64 runs inside it (also wrapped over lines, and at any
place of a run), and compressed data in any decoded layer. A
layer whose content was seen before at the same place is not unwrapped again
(cycles end); equal content at another place is. Each
layer keeps where its letters came from, so a finding in it is reported at the
place in the original text that encodes it. Escapes more than ``STEPS`` deep are
undone in one pass, so that a long chain of them takes time with its length.
Compressed data is read window by window, whatever it unpacks to.
"""

from __future__ import annotations

import binascii
import bz2
import hashlib
import html
import lzma
import re
import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_schema, slices, table, text_column

#: Kinds in the order in which findings at one place are listed.
KINDS = ("assign", "access", "hex")
#: Unpacked bytes scanned at a time, and how far the next ones overlap them.
WINDOW, OVERLAP = 8 << 20, 1 << 20
#: Escapes of escapes that are layers of their own; all deeper ones are one layer.
STEPS = 8

_KEY = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in "password|passwd|secret|token|api_?key")
_ASSIGN = re.compile(f"({_KEY})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile("AKIA[A-Z0-9]+")
_HEX = re.compile("[0-9a-f]{24,}")  # a run of 24 letters or more is the whole leftmost match

_URL = re.compile("(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}"
                     r"|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};)+")
_ONE_ESCAPE = re.compile(r"\\u\{([0-9A-Fa-f]+)\}|\\[uUx]([0-9A-Fa-f]+)|(&#[^;]+;)")
_BASE64 = re.compile("[A-Za-z0-9+/_-]{16,}={0,2}")
_WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:(?:\r?\n|(?:\\r)?\\n)[ \t]*+[A-Za-z0-9+/_-]++)+")
_BREAK = re.compile(r"(?:\r?\n|(?:\\r)?\\n)[ \t]*")
#: What a layer must have to hold another one.
_MORE = re.compile(r"[A-Za-z0-9+/_-]{16}|%[0-9A-Fa-f]{2}|\\[uUxn]|&#|[A-Za-z0-9+/_-]\r?\n[ \t]*[A-Za-z0-9+/_-]")
_LATIN = re.compile("[\x00-\xff]+")
#: Compressed data by its first bytes.
_PACKED = re.compile(rb"\x1f\x8b\x08|BZh[1-9](?:1AY&SY|\x17rE8P\x90)|\xfd7zXZ\x00|x[\x01\x5e\x9c\xda]")
_FORMATS = ((b"\x1f\x8b", lambda: _Zlib(31)), (b"BZh", bz2.BZ2Decompressor),
            (b"\xfd7zXZ", lzma.LZMADecompressor), (b"x", lambda: _Zlib(15)))
#: Bytes read or unpacked at a time.
PIECE = 1 << 16
#: Letters of the longest start of compressed data.
_MAGIC = 10
#: A letter that no pattern and no encoding goes across.
_NEUTRAL = re.compile(rb"[^A-Za-z0-9+/_.=:\"'\x20\t\r\n%\\\\&#;{}-]")
_BLANKS = re.compile(rb"\x20{65,}|\t{65,}")
#: One escape, and the letters of the longest.
_NESTED, _LONGEST = re.compile(r"%[0-9A-Fa-f]{2}|" + _ESCAPE.pattern[3:-2]), 10


def findings(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` in code points: leftmost, non-overlapping per kind."""
    out = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        out += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return out


class Layer:
    """A decoded text; ``start[i]``, ``end[i]`` delimit what encodes letter i in the original (None: itself).
    All letters of a ``flat`` one (compressed content) have one place, written as 0, 0."""

    def __init__(self, text: str, start=None, end=None, path: str = "", flat: bool = False):
        self.text, self.start, self.end, self.path, self.flat = text, start, end, path, flat

    def origin(self, a: int, z: int) -> tuple[int, int]:
        if self.flat:
            return 0, 0
        return (a, z) if self.start is None else (int(self.start[a:z].min()), int(self.end[a:z].max()))

    def places(self) -> tuple[np.ndarray, np.ndarray]:
        if self.start is None:
            at = np.arange(len(self.text), dtype=np.int64)
            return at, at + 1
        return self.start, self.end

    def key(self) -> bytes:
        """Equal for equal letters from equal places."""
        h = hashlib.sha256(self.text.encode("utf-8", "surrogatepass"))
        for at in () if self.flat else self.places():
            h.update(np.ascontiguousarray(at, np.int64))
        return h.digest()


def _replaced(layer: Layer, pattern: re.Pattern, decode, step: str) -> Layer | None:
    """The layer with every match of ``pattern`` decoded to ``(text, first, last letter of the match per letter)``."""
    matches = [(m, got) for m in pattern.finditer(layer.text) if (got := decode(m.group())) is not None]
    if not matches:
        return None
    if layer.flat:
        return Layer(pattern.sub(lambda m: decode(m.group())[0], layer.text), path=f"{layer.path}/{step}", flat=True)
    start, end = layer.places()
    text, s, e, at = [], [], [], 0
    for m, (new, a, z) in matches:
        text += [layer.text[at:m.start()], new]
        s += [start[at:m.start()], start[m.start() + np.array(a, np.int64)]]
        e += [end[at:m.start()], end[m.start() + np.array(z, np.int64) - 1]]
        at = m.end()
    text.append(layer.text[at:])
    return Layer("".join(text), np.concatenate([*s, start[at:]]), np.concatenate([*e, end[at:]]), f"{layer.path}/{step}")


def _url(run: str):
    raw = bytes.fromhex(run.replace("%", ""))
    try:
        new = raw.decode("utf-8")
    except UnicodeDecodeError:
        new = raw.decode("latin-1")
        return new, range(0, 3 * len(raw), 3), range(3, 3 * len(raw) + 1, 3)
    ends = 3 * np.cumsum([len(c.encode()) for c in new])
    return new, np.concatenate(([0], ends[:-1])), ends


def _unicode(run: str):
    units, a, z = [], [], []
    for m in _ONE_ESCAPE.finditer(run):
        if m[3]:
            c = html.unescape(m[3])
            point = ord(c) if len(c) == 1 else 0xFFFD
        else:
            point = int(m[1] or m[2], 16)
        if point > 0x10FFFF:
            point = 0xFFFD
        if units and 0xDC00 <= point < 0xE000 and 0xD800 <= units[-1] < 0xDC00:
            units[-1] = 0x10000 + ((units[-1] - 0xD800) << 10) + point - 0xDC00
            z[-1] = m.end()
            continue
        units.append(point)
        a.append(m.start())
        z.append(m.end())
    return "".join(chr(0xFFFD if 0xD800 <= u < 0xE000 else u) for u in units), a, z


def _bytes(run: str):
    raw = bytes.fromhex(run.replace("%", ""))
    return raw.decode("latin-1"), range(0, 3 * len(raw), 3), range(3, 3 * len(raw) + 1, 3)


class _Zlib:
    """zlib with the interface of the other decompressors; damaged data is read to the damage before the error."""

    def __init__(self, bits: int):
        self._d, self.needs_input, self._damaged = zlib.decompressobj(bits), True, False

    def decompress(self, data: bytes, most: int) -> bytes:
        if self._damaged:
            raise zlib.error("damaged")
        data = self._d.unconsumed_tail + data
        before = self._d.copy()
        try:
            out = self._d.decompress(data, most)
        except zlib.error:
            self._damaged, out = True, b""
            while most:  # shorter and shorter steps up to the damage
                now = before.copy()
                try:
                    got = now.decompress(data, most)
                except zlib.error:
                    most //= 2
                    continue
                if not got:
                    break
                out, before, data = out + got, now, now.unconsumed_tail
            self.needs_input = False
            return out
        self.needs_input = len(out) < most and not self._d.unconsumed_tail
        return out

    eof = property(lambda self: self._d.eof)
    unused_data = property(lambda self: self._d.unused_data)


class Packed:
    """zlib, gzip, bzip2 or xz data at ``at`` of ``source`` (bytes, or the ``Packed`` whose content holds
    it) with the members that follow it at once. The content is not kept but unpacked anew for each reader.

    Data that ends early or is damaged gives what there is of it (bzip2 and xz up to
    ``PIECE`` bytes before the damage). After the content was read, ``end`` is the
    place after the last whole member (``at`` if there is none) and ``short`` tells whether the source ended first.
    """

    def __init__(self, source: bytes | Packed, at: int):
        self.source, self.at, self.end, self.short = source, at, at, False
        h, self.size = hashlib.sha256(), 0
        for piece in self.pieces():
            h.update(piece)
            self.size += len(piece)
        self.digest = h.digest()

    def _input(self):
        if isinstance(self.source, bytes):
            for i in range(self.at, len(self.source), PIECE):
                yield self.source[i:i + PIECE]
            return
        skip = self.at
        for piece in self.source.pieces():
            if skip < len(piece):
                yield piece[skip:]
            skip = max(0, skip - len(piece))

    def pieces(self):
        """The content, at most ``PIECE`` bytes at a time."""
        feed = self._input()
        data = next(feed, b"")
        while len(data) < _MAGIC and (more := next(feed, b"")):
            data += more
        magic, make = next(f for f in _FORMATS if data.startswith(f[0]))
        d, read, self.end, self.short = make(), len(data), self.at, False
        while True:
            try:
                out = d.decompress(data, PIECE)
            except (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError):
                return
            if out:
                yield out
            data = b""
            if d.eof:
                data = d.unused_data
                while len(data) < len(magic) and (more := next(feed, b"")):
                    data, read = data + more, read + len(more)
                self.end = self.at + read - len(data)
                if magic == b"x" or not data.startswith(magic):
                    return
                d = make()
            elif d.needs_input:
                data = next(feed, b"")
                read += len(data)
                if not data:
                    self.short = True
                    return

    def windows(self):
        """``(compressed data in it, text)`` of the content, ``WINDOW`` bytes at a time. The text begins with the end of
        the window before, from a neutral letter on if there is one; long runs of blanks are cut short before
        that, since findings may go across any number of them."""
        pieces, carry, offset, until, head = self.pieces(), b"", 0, 0, 0
        buffer, size, last = [], 0, False
        while not last:
            piece = next(pieces, None)
            if piece is not None:
                buffer.append(piece)
                size += len(piece)
                if size < WINDOW:
                    continue
            last, raw = piece is None, b"".join(buffer)
            streams, rest = _streams(raw, None if last else self, offset, until)
            until = max([until, *(offset + z for _, z, _ in streams)])
            text = carry + rest[head:]
            if offset or not last:
                text = _BLANKS.sub(lambda m: m[0][:64], text)
            yield [one for *_, one in streams], _readable(text)
            m = _NEUTRAL.search(text, max(0, len(text) - OVERLAP), max(0, len(text) - OVERLAP // 2))
            carry = text[m.end() if m else -OVERLAP:]
            head = min(_MAGIC, len(raw))
            buffer, size, offset = [raw[len(raw) - head:]], head, offset + len(raw) - head


def _streams(raw: bytes, whole: Packed | None = None, offset: int = 0,
             until: int = 0) -> tuple[list[tuple[int, int, Packed]], bytes]:
    """``(first, last, data)`` of compressed data anywhere in ``raw``, and ``raw`` with zeros for what was unpacked
    to its end (it may be stored as it is).

    If ``raw`` is not the end of the content of ``whole``, in which it begins at ``offset``, data that goes on after
    ``raw`` is read from there. Data that began earlier goes up to ``until``.
    """
    out, at, rest = [], max(0, until - offset), raw
    if at:
        rest = bytearray(raw)
        rest[:at] = bytes(min(at, len(raw)))
    while m := _PACKED.search(raw, at):
        one, a = Packed(raw, m.start()), m.start()
        z = one.end
        if one.short and whole is not None:
            one = Packed(whole, offset + a)
            z = one.end - offset
        if one.size:
            out.append((a, z if z > a else len(raw), one))
            if z > a:
                rest = rest if isinstance(rest, bytearray) else bytearray(raw)
                rest[a:z] = bytes(min(z, len(raw)) - a)
        at = max(z, a + 2)
    return out, bytes(rest)


def _readable(raw: bytes) -> str:
    """The bytes as text: UTF-8, or else a letter per byte; control characters stay."""
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        return raw.decode("latin-1")


def _runs(text: str):
    """``(letters, places)`` of the base64 runs: within a line, and joined where a line break or ``\\n`` wraps them."""
    for m in _BASE64.finditer(text):
        yield m.group().rstrip("="), [m.span()]
    if "\n" in text or "\\n" in text:
        for m in _WRAPPED.finditer(text):
            ends = [m.start(), *(x for b in _BREAK.finditer(m.group()) for x in (m.start() + b.start(), m.start() + b.end())), m.end()]
            spans = list(zip(ends[::2], ends[1::2]))
            if sum(z - a for a, z in spans) >= 16:
                yield "".join(text[a:z] for a, z in spans), spans


def _base64(layer: Layer) -> tuple[list[Layer], list[tuple]]:
    """Layers in the base64 runs of a layer, and compressed data ``(first, last, path, data)``. A run may hold
    other letters before the encoded ones, so each of the four alignments is decoded."""
    out, packed = [], []
    for letters, spans in _runs(layer.text):
        plain, where = letters.replace("-", "+").replace("_", "/"), None
        for k in range(4):
            n = len(plain) - k
            n -= n % 4 == 1
            raw = binascii.a2b_base64(plain[k:k + n] + "=" * (-n % 4))
            streams, raw = _streams(raw)
            text = _readable(raw)
            more = findings(text) or _MORE.search(text)
            if not streams and not more:
                continue
            if layer.flat:
                packed += [(0, 0, f"{layer.path}/base64/inflate", c) for _, _, c in streams]
                out += [Layer(text, path=f"{layer.path}/base64", flat=True)] if more else []
                continue
            if where is None:
                where = np.concatenate([np.arange(a, z) for a, z in spans])
                start, end = (p[where] for p in layer.places())

            def letter_of(first, last):  # letters of the run that encode bytes first to last
                return k + first * 4 // 3, k + np.minimum((last * 4 + 2) // 3, n) - 1

            for i, j, content in streams:
                a, z = letter_of(i, j)
                packed.append((int(start[a:z + 1].min()), int(end[a:z + 1].max()), f"{layer.path}/base64/inflate", content))
            if more:
                wide = len(text) < len(raw)  # letters of more than one byte
                at = np.concatenate(([0], np.cumsum([len(c.encode()) for c in text]))) if wide else np.arange(len(raw) + 1)
                a, z = letter_of(at[:-1], at[1:])
                out.append(Layer(text, start[a], end[z], f"{layer.path}/base64"))
    return out, packed


def _packed_letters(layer: Layer) -> list[tuple]:
    """Compressed data ``(first, last, path, data)`` in a layer whose letters stand for bytes."""
    out = []
    for m in _LATIN.finditer(layer.text):
        streams, _ = _streams(m.group().encode("latin-1"))
        out += [(*layer.origin(m.start() + i, m.start() + j), f"{layer.path}/inflate", c) for i, j, c in streams]
    return out


def _undone(layer: Layer) -> Layer:
    """The layer with its escapes, and all that these make, undone in one pass; a byte is a letter."""
    letters, first, last = [], [], []
    openers: list[int] = []  # places of the letters in ``letters`` that may begin an escape
    start, end = (None, None) if layer.flat else (p.tolist() for p in layer.places())
    for i, c in enumerate(layer.text):
        a, z = (0, 0) if start is None else (start[i], end[i])
        while True:
            letters.append(c)
            first.append(a)
            last.append(z)
            if c in "%\\&":
                openers.append(len(letters) - 1)
                break
            if not openers or len(letters) - openers[-1] > _LONGEST or not _NESTED.fullmatch("".join(letters[openers[-1]:])):
                break
            at = openers.pop()
            escape = "".join(letters[at:])
            c = chr(int(escape[1:], 16)) if escape[0] == "%" else _unicode(escape)[0]
            a, z = min(first[at:]), max(last[at:])
            del letters[at:], first[at:], last[at:]
    places = () if layer.flat else (np.array(first, np.int64), np.array(last, np.int64))
    return Layer("".join(letters), *places, path=f"{layer.path}/nested", flat=layer.flat)


def _unwrap(root: Layer) -> tuple[dict, list[tuple]]:
    """Findings in a layer and all layers inside it, with the path of the layer reached first, and the compressed
    data met (not read)."""
    every = {(kind, *root.origin(a, z)): root.path for kind, a, z in reversed(findings(root.text))}
    work, packed = deque([root]), []
    seen = set()  # layers by content and place: equal blobs at two places are two layers
    while work:
        layer = work.popleft()
        inner, got = _base64(layer)
        packed += got
        in_bytes = []  # layers whose letters may be compressed bytes
        steps = layer.path.split("/")[-STEPS:]
        if len(steps) == STEPS and {"url", "unicode"}.issuperset(steps):
            if _URL.search(layer.text) or _ESCAPE.search(layer.text):
                inner.append(_undone(layer))
                in_bytes.append(inner[-1])
        else:
            if "%" in layer.text:
                inner.append(_replaced(layer, _URL, _url, "url"))
                if inner[-1] is not None and _PACKED.search(
                        _URL.sub(lambda m: _bytes(m.group())[0], layer.text).encode("latin-1", "replace")):
                    in_bytes.append(_replaced(layer, _URL, _bytes, "url"))
            if "\\" in layer.text or "&#" in layer.text:
                inner.append(_replaced(layer, _ESCAPE, _unicode, "unicode"))
                in_bytes += [inner[-1]] if inner[-1] is not None else []
        for new in in_bytes:
            packed += _packed_letters(new)
        for new in inner:
            if new is None or (key := new.key()) in seen:
                continue
            seen.add(key)
            work.append(new)
            for kind, a, z in findings(new.text):
                every.setdefault((kind, *new.origin(a, z)), new.path)
    return every, packed


def _inside(packed: Packed, kinds: dict):
    """Fills ``kinds`` with the kinds found in a content and the path of the layer; yields the compressed data met."""
    for streams, text in packed.windows():
        found, inner = _unwrap(Layer(text, flat=True))
        for (kind, *_), path in found.items():
            kinds.setdefault(kind, path)
        yield from [(0, 0, "/inflate", one) for one in streams] + inner


def _explored(found: list[tuple], contents: dict) -> list[tuple]:
    """``found`` with a digest for the data; ``contents`` gets, by digest, the kinds in each content and the data
    inside it. A content is read to its end before the next one beside it is begun."""
    out: list[tuple] = []
    open_ = [(out, iter(found))]
    while open_:
        inside, more = open_[-1]
        if (item := next(more, None)) is None:
            open_.pop()
            continue
        a, z, path, one = item
        inside.append((a, z, path, one.digest))
        if one.digest not in contents:
            contents[one.digest] = ({}, [])
            kinds, deeper = contents[one.digest]
            open_.append((deeper, _inside(one, kinds)))
    return out


def scan(text: str) -> tuple[list, list]:
    """Base findings, and all findings ``(kind, start, end, path of the layer)``.

    Findings of one kind and place count once, at the layer reached first. What
    is in compressed data has the place of all of it; equal contents are
    unwrapped once and count wherever they stand.
    """
    base = findings(text)
    every, packed = _unwrap(Layer(text))
    contents: dict[bytes, tuple] = {}
    roots = _explored(packed, contents)
    reached: dict[bytes, list] = {}
    for a, z, path, digest in roots:
        if digest not in reached:
            reached[digest], seen, at = [], {digest}, deque([("", digest)])
            while at:
                before, d = at.popleft()
                reached[digest] += [(kind, before + p) for kind, p in contents[d][0].items()]
                for _, _, p, inner in contents[d][1]:
                    if inner not in seen:
                        seen.add(inner)
                        at.append((before + p, inner))
        for kind, p in reached[digest]:
            every.setdefault((kind, a, z), path + p)
    order = lambda f: (f[1], KINDS.index(f[0]), f[2])
    return sorted(base, key=order), [(*f, every[f]) for f in sorted(every, key=order)]


def masked(text: str, spans: list, mark: str = "[SECRET]") -> str:
    """``text`` with the union of the spans replaced."""
    out, at = [], 0
    for _, a, z, *_ in spans:
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, z)
    return "".join([*out, text[at:]])


_SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                      T.StructField("end", T.LongType())])
_DEEP = T.StructType([*_SPAN.fields, T.StructField("layer", T.StringType())])


def secrets(docs: DataFrame, keep: list[str], mask: bool = False) -> DataFrame:
    """``keep`` with ``base`` and ``spans`` (arrays of kind, start, end and, for spans, layer).

    One output row per input row, repeated rows included. Null and empty texts
    have no findings. With ``mask`` also ``masked``, the text with all spans
    replaced (null stays null). Columns not kept may have any name; a kept one
    with the name of a result is an error.
    """
    if clash := {"base", "spans", *["masked"] * mask}.intersection(keep):
        raise ValueError(f"kept columns with the name of a result: {sorted(clash)}")
    full = T.StructType([docs.schema[c] for c in keep]
                        + [T.StructField("base", T.ArrayType(_SPAN)), T.StructField("spans", T.ArrayType(_DEEP))]
                        + [T.StructField("masked", T.StringType())] * mask)
    arrow = arrow_schema(full)

    def run(batches):
        for b in slices(batches):
            texts = text_column(b, "text")
            found = [scan(t) for t in texts]
            cols = [b.column(b.schema.get_field_index(k)) for k in keep]
            cols.append(pa.array([[dict(zip(("kind", "start", "end"), f)) for f in x[0]] for x in found],
                                 arrow.field("base").type))
            cols.append(pa.array([[dict(zip(("kind", "start", "end", "layer"), f)) for f in x[1]] for x in found],
                                 arrow.field("spans").type))
            if mask:
                null = b.column(b.schema.get_field_index("text")).is_null().to_pylist()
                cols.append(pa.array([None if n else masked(t, x[1]) for t, x, n in zip(texts, found, null)], pa.string()))
            yield pa.RecordBatch.from_arrays(cols, schema=arrow)

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, full)


def _listed(col: str):
    return F.concat_ws(",", F.transform(col, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                   s["end"].cast("string"))))


def _count(col: str, kind: str):
    return F.size(F.filter(col, lambda s: s["kind"] == kind)).cast("long")


def op1_secrets(spark, sf_dir):
    """Query: counts and digest of the base findings and the list of all findings of every document."""
    found = secrets(table(spark, sf_dir, "documents"), ["doc_id"])
    n = [_count("base", k).alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *n, F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("spans").alias("spans"))
