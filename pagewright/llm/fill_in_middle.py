"""Fill-in-the-middle: texts cut into prefix, middle and suffix at unit borders.

A unit is a run of letters A-Z, a-z or one other character. One ``fullmatch``
of ``(unit)*`` retains every repetition of its group, so the ends of the group
are the borders: their number is n, and both cuts are two of them.

Cuts, form and order come from a hash of seed and document id, so a row's
result depends on nothing but the row. A text is ``plain`` (unchanged) if it
is empty, holds a marker or is drawn to be; else ``psm`` (prefix, suffix,
middle) or ``spm`` (suffix, prefix, middle). Markers can't overlap each other
and don't occur in a text that is cut, so :func:`restore` finds them again.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, row_per_input, table, text_column

UNITS = regex.compile(r"([A-Za-z]+|[^A-Za-z])*")
#: The markers of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 texts, those that are cut, and of 100 of these, those in the order suffix, prefix, middle.
CUT, SPM = 90, 20

RESULT = T.StructType([
    T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
    T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
    T.StructField("output", T.StringType())])


def draws(doc_id, seed: int) -> list[int]:
    """Four numbers of 32 bits from the SHA-256 of ``seed:doc_id`` (a null id is empty)."""
    hexed = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(hexed[i:i + 8], 16) for i in range(0, 32, 8)]


def cut(text: str, doc_id, seed: int = 1, cut_share: int = CUT, spm_share: int = SPM) -> tuple:
    """``n, form, prefix_chars, middle_chars, output`` of one text."""
    ends = UNITS.fullmatch(text).ends(1)
    n = len(ends)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not n or h3 % 100 >= cut_share or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (ends[k - 1] if k else 0 for k in (first, second))
    before, middle, after = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm_share:
        return n, "spm", a, b - a, f"{SUFFIX}{after}{PREFIX}{before}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{before}{SUFFIX}{after}{MIDDLE}{middle}"


def fill_in_middle(docs: DataFrame, keep: list[str], seed: int = 1, cut_share: int = CUT,
                   spm_share: int = SPM) -> DataFrame:
    """``keep``, ``n``, ``form``, ``prefix_chars``, ``middle_chars`` (null if plain) and ``output`` of each row.

    ``docs`` has ``doc_id`` and ``text``; a null text is empty, a null id draws
    like an empty one. Rows that repeat an id draw alike. Whole texts are cut;
    a text's borders take about 140 bytes a unit while it is cut. Columns
    outside ``keep`` are ignored; one in ``keep`` that has a result's name is
    an error.
    """
    clash = set(keep) & set(RESULT.fieldNames())
    if clash:
        raise ValueError(f"kept columns have names of results: {sorted(clash)}")

    def of(batch):
        rows = [cut(t, i, seed, cut_share, spm_share) for t, i in zip(text_column(batch, "text"), column(batch, "doc_id"))]
        return {f.name: pa.array([r[k] for r in rows], pa.string() if k in (1, 4) else pa.int64())
                for k, f in enumerate(RESULT)}

    return row_per_input(docs.select(*dict.fromkeys([*keep, "doc_id", "text"])), of, RESULT, keep)


def restore(output: Column, form: Column) -> Column:
    """The text from ``output`` and ``form`` alone."""
    def between(start: Column, end: Column | None = None) -> Column:
        return F.substring(output, start, F.length(output) if end is None else end - start)

    def after(marker: str, start: int | Column) -> Column:
        return F.call_function("locate", F.lit(marker), output, F.lit(start) if isinstance(start, int) else start)

    second = F.when(form == "spm", after(PREFIX, 1)).otherwise(after(SUFFIX, 1))
    third = after(MIDDLE, second)
    one, two, three = between(F.lit(4), second), between(second + 3, third), between(third + 3)
    return (F.when(form == "plain", output).when(form == "spm", F.concat(two, three, one))
            .otherwise(F.concat(one, three, two)))


def op12_fill_in_middle(spark, sf_dir):
    """Query: every document's form and cuts, digests of the output and of the text restored from it."""
    rows = fill_in_middle(table(spark, sf_dir, "documents"), ["doc_id"])
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


OP12_SQL = """
with d as (select doc_id, coalesce(text, '') t, sha256('1:' || doc_id) h from documents),
u as (select *, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') units from d),
k as (select *, len(units) n, list_transform(range(4), lambda i: ('0x' || h[8 * i + 1:8 * i + 8])::bigint) r from u),
c as (select *, least(r[1] % (n + 1), r[2] % (n + 1)) lo, greatest(r[1] % (n + 1), r[2] % (n + 1)) hi,
  case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or r[3] % 100 >= 90 then 'plain'
    when r[4] % 100 < 20 then 'spm' else 'psm' end form from k),
s as (select *, array_to_string(units[1:lo], '') p, array_to_string(units[lo + 1:hi], '') m,
  array_to_string(units[hi + 1:], '') s from c)
select doc_id, n::bigint n, form,
  case when form <> 'plain' then length(p) end::bigint prefix_chars,
  case when form <> 'plain' then length(m) end::bigint middle_chars,
  sha256(case form when 'plain' then t when 'spm' then '<S>' || s || '<P>' || p || '<M>' || m
    else '<P>' || p || '<S>' || s || '<M>' || m end) output_sha256,
  sha256(t) restored_sha256
from s
"""
