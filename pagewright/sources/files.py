"""File listing and scanning.

Two inputs are accepted: a directory tree read with Spark's ``binaryFile``
source, or a caller's manifest DataFrame ``path, content``. The file source
skips zero-length files and names starting with ``_`` or ``.``; such files
can only be scanned through a manifest. Files beyond the source's 2 GiB are
hashed chunk by chunk by the tasks themselves (:mod:`.storage`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import content_hash, doc_hash
from . import storage

PDF_GLOB = "*.[pP][dD][fF]"


def is_pdf(path) -> F.Column:
    return F.lower(path).endswith(".pdf")


def list_files(manifest: DataFrame, prefix: str = "") -> DataFrame:
    """S1 on a manifest: paths under ``prefix`` ending in ``.pdf`` (any case)."""
    p = F.col("path")
    cond = is_pdf(p)
    if prefix:
        cond = cond & p.startswith(prefix)
    return manifest.filter(cond).select("path")


def read_tree(spark: SparkSession, root: str, glob: str = PDF_GLOB, skip_bad: bool = False) -> DataFrame:
    """S1/S2 on storage: ``path`` (relative to ``root``), ``length``,
    ``modificationTime`` and lazily read ``content``.

    ``binaryFile`` reads the bytes only when ``content`` is selected, and
    checks ``length``/``modificationTime`` filters before it opens a file.
    A file that is too long or can't be read fails the job; with ``skip_bad``
    an unreadable one has no row, which callers must tell from a deletion.
    """
    raw = (spark.read.format("binaryFile")
           .option("recursiveFileLookup", "true")
           .option("pathGlobFilter", glob)
           .option("ignoreCorruptFiles", skip_bad).option("ignoreMissingFiles", skip_bad)
           .load(root))
    # the source reports unescaped URIs such as file:/dir/a b.pdf
    rel = F.regexp_extract("path", r"^.*?\Q" + root.rstrip("/") + r"\E/(.*)$", 1)
    return raw.withColumn("path", rel)


def _limit(spark: SparkSession, max_bytes: int | None = None) -> int:
    """Bytes of the longest file that ``binaryFile`` gives as a row."""
    own = int(spark.conf.get("spark.sql.sources.binaryFile.maxLength", str(2**31 - 1)))
    return min(own, max_bytes) if max_bytes else own


def _hashed(listing: DataFrame, files: DataFrame, root: str, max_bytes: int | None) -> DataFrame:
    """Every row of ``listing`` with the hashes of its content, or the error:
    longer than ``max_bytes``, or listed but not readable.

    ``files`` has the contents that fit a row; longer files are read by tasks
    in chunks.
    """
    limit = _limit(listing.sparkSession)
    large = F.col("length") > limit
    wanted = F.lit(True) if max_bytes is None else F.col("length") <= max_bytes
    none = F.lit(None).cast("string")
    read = files.select("path", content_hash("content").alias("content_hash"),
                        doc_hash("content", "path").alias("doc_id"), none.alias("read_error"))
    read = read.unionByName(storage.hash_files(listing.filter(large & wanted), root))
    error = (F.when(~wanted, F.format_string("file larger than %d bytes", F.lit(max_bytes)))
             .when(F.col("content_hash").isNull(), F.coalesce("read_error", F.lit("unreadable"))))
    return listing.join(read, "path", "left").select(
        "path", "content_hash", "doc_id", "length", "modificationTime", error.alias("error"))


def scan_tree(spark: SparkSession, root: str, max_bytes: int | None = None,
              glob: str = PDF_GLOB) -> DataFrame:
    """S4 on storage: ``path, content_hash, doc_id, length, modificationTime, error``.

    One row per listed file. Files up to the session's binaryFile limit are
    rows of that source, longer ones are hashed in chunks. A file above
    ``max_bytes`` is not read, a file that fails to read stops nothing; both
    have an ``error`` and NULL hashes.
    """
    listing = read_tree(spark, root, glob).select("path", "length", "modificationTime")
    readable = read_tree(spark, root, glob, skip_bad=True).filter(F.col("length") <= _limit(spark, max_bytes))
    return _hashed(listing, readable, root, max_bytes)


def scan_manifest(files: DataFrame) -> DataFrame:
    """Both hashes in one pass; the bytes are dropped right after.

    ``files``: ``path, content`` (+ optional ``length``). Rows whose content
    is NULL (unreadable) are left out; see :func:`scan_errors_of`.
    """
    ok = files.filter(F.col("content").isNotNull())
    length = F.col("length") if "length" in files.columns else F.length("content").cast("long")
    return ok.select("path", content_hash("content").alias("content_hash"),
                     doc_hash("content", "path").alias("doc_id"), length.alias("length"))


def scan_with_errors(files: DataFrame) -> DataFrame:
    """S4 in one pass over the bytes: scan rows plus an ``error`` column that
    is set (and the hashes NULL) for rows whose content could not be read."""
    length = F.col("length") if "length" in files.columns else F.length("content").cast("long")
    ok = F.col("content").isNotNull()
    return files.select("path",
                        F.when(ok, content_hash("content")).alias("content_hash"),
                        F.when(ok, doc_hash("content", "path")).alias("doc_id"),
                        length.alias("length"),
                        F.when(~ok, F.lit("unreadable")).alias("error"))


def scan_errors_of(files: DataFrame) -> DataFrame:
    """Manifest rows that could not be read, kept apart so they do not look deleted."""
    return files.filter(F.col("content").isNull()).select(
        "path", F.lit("unreadable").alias("error"))


def read_contents(spark: SparkSession, root: str, paths: DataFrame, max_bytes: int | None = None,
                  glob: str = PDF_GLOB) -> DataFrame:
    """``path, content`` for those of the relative ``paths`` that are below ``root``.

    The tree is listed without bytes and joined with ``paths``. Ranges of
    lengths and modification times that cover the wanted files are pushed
    into the reader, which opens no file outside them; the rest is a
    semi-join. Files beyond the binaryFile limit are left out, see
    :func:`.storage.read_chunks`.
    """
    listing = read_tree(spark, root, glob).select("path", "length", "modificationTime")
    wanted = (listing.filter(F.col("length") <= _limit(spark, max_bytes))
              .join(paths.select("path").distinct(), "path", "left_semi"))
    return _read_wanted(spark, root, wanted, glob)


#: Ranges that a read pushes down, and the equal steps of time from which they are put together.
RANGES, STEPS = 32, 4096


def cover(wanted: DataFrame, ranges: int = RANGES, steps: int = STEPS) -> list[tuple]:
    """At most ``ranges`` disjoint spans of time that hold all of ``wanted``:
    (first and last modificationTime, least and greatest length) each.

    The whole span is cut into ``steps``; the files of a step are summed up
    by Spark, and neighbours with the smallest gaps between them are merged
    until few enough are left.
    """
    lo, hi = wanted.agg(F.min("modificationTime"), F.max("modificationTime")).first()
    if lo is None:
        return []
    micros = F.unix_micros(F.col("modificationTime")) - F.unix_micros(F.lit(lo))
    width = int((hi - lo).total_seconds() * 1e6) // steps + 1
    found = (wanted.groupBy(F.floor(micros / width).alias("step"))
             .agg(F.min("modificationTime"), F.max("modificationTime"), F.min("length"), F.max("length"))
             .orderBy("step").collect())
    spans = [tuple(r)[1:] for r in found]
    gaps = sorted((spans[i][0] - spans[i - 1][1] for i in range(1, len(spans))), reverse=True)[:ranges - 1]
    out: list[tuple] = []
    left = len(gaps)
    for s in spans:
        if out and (not left or s[0] - out[-1][1] < gaps[-1]):
            t = out[-1]
            out[-1] = (t[0], s[1], min(t[2], s[2]), max(t[3], s[3]))
        else:
            left -= bool(out)
            out.append(s)
    return out


def _read_wanted(spark: SparkSession, root: str, wanted: DataFrame, glob: str) -> DataFrame:
    near = None
    for first, last, short, long in cover(wanted):
        one = (F.col("modificationTime").between(F.lit(first), F.lit(last))) & F.col("length").between(short, long)
        near = one if near is None else near | one
    if near is None:
        return spark.createDataFrame([], "path string, content binary")
    rows = read_tree(spark, root, glob, skip_bad=True).filter(near)
    return rows.join(wanted.select("path"), "path", "left_semi").select("path", "content")


def scan_tree_incremental(spark: SparkSession, root: str, previous: DataFrame | None,
                          max_bytes: int | None = None, glob: str = PDF_GLOB) -> DataFrame:
    """S4 without re-reading unchanged files.

    The tree is listed without its bytes. A file whose (path, length,
    modificationTime) equals an error-free row of the ``previous`` scan keeps
    that row's hashes; the others are read and hashed. Output as
    :func:`scan_tree`: keep it as the next run's ``previous``.
    """
    listing = read_tree(spark, root, glob).select("path", "length", "modificationTime")
    cols = ["path", "content_hash", "doc_id", "length", "modificationTime"]
    none = F.lit(None).cast("string")
    if previous is None:
        kept = listing.limit(0).select("path", none.alias("content_hash"), none.alias("doc_id"),
                                       "length", "modificationTime")
    else:
        kept = listing.join(previous.filter(F.col("content_hash").isNotNull()).select(*cols),
                            ["path", "length", "modificationTime"], "inner").select(*cols)
    todo = listing.join(kept.select("path"), "path", "left_anti")
    fresh = _read_wanted(spark, root, todo.filter(F.col("length") <= _limit(spark, max_bytes)), glob)
    return kept.withColumn("error", none).unionByName(_hashed(todo, fresh, root, max_bytes))
