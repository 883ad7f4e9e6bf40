"""Quality rules: counts of each text, and its divergence from language references.

A document is compared to a reference of every language (a value of ``lang``)
by the Jensen-Shannon distance of two histograms: its character classes, and
the most common words of that language with one bin for all others. It is kept
if it passes the base rules and one language explains both. Short texts scatter
by chance, so the bound on a squared distance grows by ``bins / (8 n ln 2)``,
its expectation for n draws, and texts below a minimum length aren't compared.

References are the mean histograms over all documents long enough that pass
the base rules; every document weighs the same. The words of these documents
are counted exactly: tasks add them up in parts of bounded size, one shuffle
adds up the parts.

Any number of languages works alike: their common words are a table, and what
a task or the driver holds is the references of ``LANGUAGES`` of them. With
more, documents are compared with one block of languages after the other, and
the best of each text is kept.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_schema, no_clash, slices, table, text_column, written

COMMON_WORDS = 64
#: Distinct (lang, word) counts a task keeps before passing them on.
KEPT_WORDS = 200_000
#: Shorter texts aren't compared; nor do they enter the references.
MIN_WORDS, MIN_CHARS = 50, 200
#: Largest distances of kept texts, apart from chance.
MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE = 0.25, 0.25
#: Languages (values of ``lang`` with a reference) whose references are held at a time, about.
LANGUAGES = 500

_WORD = re.compile("[^\\x20\\x09-\\x0D]+")
#: Characters counted as symbols, and the character classes by example.
SYMBOLS = "#*$%&|<>"
CLASSES = ("vowel", "consonant", "capital", "space", "break", "stop", "symbol", "digit", "other-ascii", "letter", "other")


def _class_table() -> np.ndarray:
    """Class of each code point up to 0xFFFF; those above count as the last one's class (other)."""
    out = np.full(0x10000, CLASSES.index("other"), np.uint8)
    for p in range(0x10000 - 1):
        c = chr(p)
        out[p] = CLASSES.index(
            "vowel" if c in "aeiou" else "consonant" if "a" <= c <= "z" else "capital" if "A" <= c <= "Z"
            else "space" if c == " " else "break" if c in "\t\n\v\f\r" else "stop" if c in ".,;:!?"
            else "symbol" if c in SYMBOLS else "digit" if "0" <= c <= "9" else "other-ascii" if p < 128
            else "letter" if c.isalpha() else "other")
    return out


_CLASS = _class_table()


def character_classes(text: str) -> np.ndarray:
    out = np.zeros(len(CLASSES), np.int64)
    for i in range(0, len(text), 1 << 20):
        p = np.frombuffer(text[i:i + (1 << 20)].encode("utf-32-le"), np.uint32)
        out += np.bincount(_CLASS[np.minimum(p, 0xFFFF)], minlength=len(CLASSES))
    return out


def repeated_words(words: list[str], width: int = 5) -> int:
    """Words that stand in a window of ``width`` words found twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    ids = {w: i for i, w in enumerate(dict.fromkeys(words))}
    one = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
    key, size = one[:n], len(ids)
    for k in range(1, width):
        if size >= (1 << 62) // len(ids):  # number the windows so far, so that pairs fit in 64 bits
            distinct, key = np.unique(key, return_inverse=True)
            size = len(distinct)
        key, size = key * len(ids) + one[k:k + n], size * len(ids)
    _, at, found = np.unique(key, return_inverse=True, return_counts=True)
    again = found[at] > 1
    if not again.any():
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    edge[:n] += again
    edge[width:width + n] -= again
    return int((np.cumsum(edge)[:-1] > 0).sum())


def counts(text: str, words: list[str]) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``."""
    lines, again = set(), 0
    for line in text.split("\n"):
        if line in lines:
            again += 1
        elif _WORD.search(line):
            lines.add(line)
    return (len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), again, repeated_words(words))


def base_fails(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 10 or 100 * n_repeat_words > 20 * n_words


def _bare(words: list[str]) -> list[str]:
    return [w.strip(".,;:!?\"'()") for w in map(str.lower, words)]


def _enters(text: str, words: list[str]) -> bool:
    """Whether a text of these words is long enough for a reference and passes the base rules."""
    return len(words) >= MIN_WORDS and len(text) >= MIN_CHARS and not base_fails(len(words), repeated_words(words))


def common_words(docs: DataFrame) -> DataFrame:
    """``lang, w``: the ``COMMON_WORDS`` most common words of each language, in the documents that enter its reference."""

    def run(batches):
        seen: dict[str, Counter] = {}

        def flush():
            rows = [(lang, w, n) for lang, c in seen.items() for w, n in c.items()]
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in
                                               zip(zip(*rows), (pa.string(), pa.string(), pa.int64()))], ["lang", "w", "n"])

        for b in slices(batches):
            for text, lang in zip(text_column(b, "text"), b.column(1).to_pylist()):
                words = _WORD.findall(text)
                if _enters(text, words):
                    seen.setdefault(lang, Counter()).update(_bare(words))
            if sum(map(len, seen.values())) > KEPT_WORDS:
                yield flush()
        if seen:
            yield flush()

    found = (docs.select("text", "lang").filter("lang is not null").mapInArrow(run, "lang string, w string, n long")
             .groupBy("lang", "w").agg(F.sum("n").alias("n")))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "w")
    return found.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= COMMON_WORDS).select("lang", "w")


def common_candidates(common: DataFrame) -> list[str]:
    """The different words of ``lang, w`` rows, which are a block of languages at most."""
    return sorted(r.w for r in common.select("w").distinct().collect())


def features(docs: DataFrame, candidates: list[str], keep: list[str]) -> DataFrame:
    """``keep``, the base counts, ``classes`` (characters per class) and ``wid, wn`` (candidate words and their counts)."""
    ints, longs = T.ArrayType(T.IntegerType()), T.LongType()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    full = T.StructType([docs.schema[c] for c in keep] + [T.StructField(n, longs) for n in names]
                        + [T.StructField("classes", ints), T.StructField("wid", ints), T.StructField("wn", ints)])
    arrow = arrow_schema(full)
    number = docs.sparkSession.sparkContext.broadcast({w: i for i, w in enumerate(candidates)})

    def run(batches):
        ids = number.value
        for b in slices(batches):
            base, classes, wid, wn = [], [], [], []
            for text in text_column(b, "text"):
                words = _WORD.findall(text)
                base.append(counts(text, words))
                classes.append(character_classes(text))
                c = Counter(map(ids.get, _bare(words)))
                c.pop(None, None)
                wid.append(list(c))
                wn.append(list(c.values()))
            cols = [b.column(b.schema.get_field_index(k)) for k in keep]
            cols += [pa.array(x, pa.int64()) for x in zip(*base)]
            cols += [pa.array(x, arrow.field(n).type) for x, n in ((classes, "classes"), (wid, "wid"), (wn, "wn"))]
            yield pa.RecordBatch.from_arrays(cols, schema=arrow)

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, full)


def references(feats: DataFrame, candidates: int) -> dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per language: mean class histogram, the ids of its common words, their mean shares and that of all others."""
    good = (feats.filter("lang is not null").filter((F.col("n_words") >= MIN_WORDS)
                                                    & (F.aggregate("classes", F.lit(0), lambda a, x: a + x) >= MIN_CHARS)
                                                    & (100 * F.col("n_repeat_words") <= 20 * F.col("n_words"))))
    k = len(CLASSES)

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            cols = {n: b.column(b.schema.get_field_index(n)) for n in b.schema.names}
            ends, wid = cols["wid"].offsets.to_numpy(), cols["wid"].flatten().to_numpy(zero_copy_only=False)
            wn, n = cols["wn"].flatten().to_numpy(zero_copy_only=False), cols["n_words"].to_numpy(zero_copy_only=False)
            ends = ends - ends[0]
            cls = cols["classes"].flatten().to_numpy(zero_copy_only=False).reshape(-1, k).astype(float)
            cls /= cls.sum(1, keepdims=True)
            for i, lang in enumerate(cols["lang"].to_pylist()):
                s = sums.setdefault(lang, np.zeros(1 + k + 2 * candidates))
                s[0] += 1
                s[1:1 + k] += cls[i]
                at, v = 1 + k + wid[ends[i]:ends[i + 1]], wn[ends[i]:ends[i + 1]]
                s[at] += v / n[i]
                s[at + candidates] += v
        for lang, s in sums.items():
            at = np.flatnonzero(s)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at), pa.array(s[at])], ["lang", "at", "s"])

    total = (good.select("lang", "n_words", "classes", "wid", "wn").mapInArrow(run, "lang string, at long, s double")
             .groupBy("lang", "at").agg(F.sum("s").alias("s")))
    sums: dict[str, np.ndarray] = {}
    for lang, at, s in total.collect():  # a few numbers per language and candidate
        sums.setdefault(lang, np.zeros(1 + k + 2 * candidates))[at] = s
    out = {}
    for lang, s in sorted(sums.items()):
        exact = s[1 + k + candidates:]
        ids = np.lexsort((np.arange(candidates), -exact))[:COMMON_WORDS]
        ids = ids[exact[ids] > 0]  # words of other languages are no bins of this one
        share = s[1 + k:1 + k + candidates][ids] / s[0]
        out[lang] = (s[1:1 + k] / s[0], ids, np.append(share, max(0.0, 1 - share.sum())))
    return out


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Squared Jensen-Shannon distance (base 2) of each row of ``p`` to ``q``."""
    m = (p + q) / 2

    def kl(a):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(a > 0, a * np.log2(a / m), 0.0).sum(1)

    return np.maximum(0.0, (kl(p) + kl(np.broadcast_to(q, p.shape))) / 2)


def compare(feats: DataFrame, refs: dict, keep: list[str]) -> DataFrame:
    """``keep, base_failed, kept, language, char_distance, word_distance``: the language that explains a text best;
    ``worst``: the larger of its distances by their bounds, 1 or less if it explains both.

    Texts below the minimum length, or without any reference, have null
    language and distances and are kept if the base rules pass.
    """
    full = T.StructType([feats.schema[c] for c in keep] + [
        T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()),
        T.StructField("language", T.StringType()), T.StructField("char_distance", T.DoubleType()),
        T.StructField("word_distance", T.DoubleType()), T.StructField("worst", T.DoubleType())])
    arrow = arrow_schema(full)
    k = len(CLASSES)

    def run(batches):
        for b in batches:
            cols = {n: b.column(b.schema.get_field_index(n)) for n in b.schema.names}
            rows = b.num_rows
            n = cols["n_words"].to_numpy(zero_copy_only=False)
            failed = (n < 10) | (100 * cols["n_repeat_words"].to_numpy(zero_copy_only=False) > 20 * n)
            cls = cols["classes"].flatten().to_numpy(zero_copy_only=False).reshape(-1, k).astype(float)
            chars = cls.sum(1)
            cls /= np.maximum(chars, 1)[:, None]
            ends = cols["wid"].offsets.to_numpy()
            of = np.repeat(np.arange(rows), np.diff(ends))
            wid, wn = (cols[c].flatten().to_numpy(zero_copy_only=False) for c in ("wid", "wn"))
            best, lang = np.full(rows, np.inf), np.full(rows, None, object)
            dist = np.full((2, rows), np.nan)
            for name, (ref_cls, ids, ref_word) in refs.items():
                place = np.full(max(int(wid.max(initial=0)), int(ids.max(initial=0))) + 1, -1)
                place[ids] = np.arange(len(ids))
                at = place[wid]
                hist = np.zeros((rows, len(ref_word)))
                np.add.at(hist, (of[at >= 0], at[at >= 0]), wn[at >= 0])
                hist[:, -1] = n - hist.sum(1)
                hist /= np.maximum(n, 1)[:, None]
                c, w = divergence(cls, ref_cls), divergence(hist, ref_word)
                slack = 8 * math.log(2)
                worst = np.maximum(c / (MAX_CHAR_DISTANCE ** 2 + k / (slack * np.maximum(chars, 1))),
                                   w / (MAX_WORD_DISTANCE ** 2 + len(ref_word) / (slack * np.maximum(n, 1))))
                better = worst < best
                best[better], lang[better] = worst[better], name
                dist[0, better], dist[1, better] = np.sqrt(c[better]), np.sqrt(w[better])
            judged = (n >= MIN_WORDS) & (chars >= MIN_CHARS) & np.isfinite(best)
            out = [cols[c] for c in keep] + [pa.array(failed), pa.array(~failed & (~judged | (best <= 1)))]
            out += [pa.array(np.where(judged, lang, None), pa.string()), *(pa.array(d, mask=~judged) for d in (*dist, best))]
            yield pa.RecordBatch.from_arrays(out, schema=arrow)

    return feats.mapInArrow(run, full)


def quality(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep``, the base counts and the verdict of each row of ``docs`` (``text, lang``).

    Null texts are empty and fail the base rules; a null ``lang`` is judged by
    the other documents' references. Repeated rows come back repeated. Columns
    outside ``keep`` are ignored; one in ``keep`` that has the name of a result
    or of a step to it is an error.
    """
    no_clash(keep, ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "classes", "wid", "wn", "base_failed",
                    "kept", "language", "char_distance", "word_distance", "worst", "best", "__t1", "__t2"))
    docs = docs.select(*dict.fromkeys([*keep, "text", "lang"]))
    counted = [*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    common = written(common_words(docs), "common-words")
    blocks = -(-common.select("lang").distinct().count() // LANGUAGES)
    if blocks <= 1:
        candidates = common_candidates(common)
        feats = written(features(docs, candidates, list(dict.fromkeys([*keep, "lang"]))), "features")
        return compare(feats, references(feats, len(candidates)), counted).drop("worst")

    # distances depend on the text alone: the best language of each text, over all blocks
    key = {"__t1": F.xxhash64("text"), "__t2": F.xxhash64(F.lit(1), "text")}
    block = F.pmod(F.xxhash64("lang"), F.lit(blocks))
    found = None
    for i in range(blocks):
        candidates = common_candidates(common.filter(block == i))
        feats = written(features(docs.withColumns(key), candidates, list(dict.fromkeys([*keep, "lang", *key]))), "features")
        part = (compare(feats, references(feats.filter(block == i), len(candidates)), [*key]).filter("language is not null")
                .select(*key, F.struct("worst", "language", "char_distance", "word_distance").alias("best")))
        found = part if found is None else found.union(part)
    best = written(found.groupBy(*key).agg(F.min("best").alias("best")), "best-languages")
    base = compare(feats, {}, [*counted, *key]).select(*counted, *key, "base_failed")
    fits = F.coalesce(F.col("best.worst") <= 1, F.lit(True))
    return base.join(best, [*key], "left").select(
        *counted, "base_failed", (~F.col("base_failed") & fits).alias("kept"), "best.language", "best.char_distance",
        "best.word_distance")


def op5_quality_rules(spark, sf_dir):
    """Query: base counts and verdict of every document."""
    return quality(table(spark, sf_dir, "documents"), ["doc_id"])
