"""Files opened inside tasks: hashed, cut into byte ranges and copied chunk by chunk.

Spark's ``binaryFile`` source gives one row per file and so ends at 2 GiB.
Here a task opens the file itself (pyarrow's file systems: local and mounted
folders, S3, GCS, HDFS) and holds one chunk of it at a time. A file is one
row of work; Spark spreads the rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of a file that a task holds at a time.
CHUNK = 4 << 20


def store_of(root: str):
    """(file system, folder on it) of a path or URI; ``file:/x`` as Spark writes it counts, too."""
    if re.match(r"file:/+", root):
        return pafs.LocalFileSystem(), re.sub(r"^file:/+", "/", root).rstrip("/")
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]+://", root):
        fs, path = pafs.FileSystem.from_uri(root)
        return fs, path.rstrip("/")
    return pafs.LocalFileSystem(), root.rstrip("/")


def inside(path: str) -> str:
    """``path`` itself if it stays below the folder it is joined to, else an error."""
    if not path or path.startswith("/") or "\\" in path or any(p in ("", ".", "..") for p in path.split("/")):
        raise ValueError(f"not a path below a folder: {path!r}")
    return path


def pieces(fs, path: str, chunk: int = CHUNK) -> Iterator[bytes]:
    """The bytes of a file, ``chunk`` at a time."""
    with fs.open_input_stream(path, buffer_size=0) as f:
        while data := f.read(chunk):
            yield data


def digests(fs, path: str, name: str, chunk: int = CHUNK) -> tuple[str, str, int]:
    """(H1 content hash, H2 document hash, length) of a file, read once in order."""
    h, n = hashlib.sha256(), 0
    for data in pieces(fs, path, chunk):
        h.update(data)
        n += len(data)
    content = h.hexdigest()
    h.update(name.encode())
    return content, h.hexdigest(), n


def hash_files(listing: DataFrame, root: str, chunk: int = CHUNK) -> DataFrame:
    """``path, content_hash, doc_id, read_error`` of the files ``path, length`` below ``root``.

    One file is one row of a task, of any length. A file that can't be opened,
    or whose length isn't the listed one (it is being written), has an error
    and no hashes.
    """

    def run(batches):
        fs, base = store_of(root)
        for b in batches:
            out = []
            for path, length in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                try:
                    content, doc, n = digests(fs, f"{base}/{inside(path)}", path, chunk)
                    out.append((path, content, doc, None) if n == length else
                               (path, None, None, f"changed while it was read: {n} bytes instead of {length}"))
                except Exception as e:  # noqa: BLE001 - errors become values
                    out.append((path, None, None, f"{type(e).__name__}: {e}"))
                if len(out) >= 100:
                    yield _batch(out)
                    out = []
            if out:
                yield _batch(out)

    def _batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)],
                                          ["path", "content_hash", "doc_id", "read_error"])

    spread = listing.select("path", "length").repartition(4 * listing.sparkSession.sparkContext.defaultParallelism)
    return spread.mapInArrow(run, "path string, content_hash string, doc_id string, read_error string")


def read_chunks(listing: DataFrame, root: str, chunk: int = CHUNK) -> DataFrame:
    """``path, chunk, offset, content``: the byte ranges of the files ``path, length``.

    Ranges of one file are rows of their own, so many tasks read a large file,
    and a task holds a range at a time. An empty file has one empty range.
    A failing read fails the job: a range can't be left out.
    """

    def run(batches):
        fs, base = store_of(root)
        for b in batches:
            for path, number, length in zip(*(b.column(i).to_pylist() for i in range(3))):
                offset = number * chunk
                with fs.open_input_file(f"{base}/{inside(path)}") as f:
                    data = f.read_at(min(chunk, length - offset), offset)
                if len(data) != min(chunk, length - offset):
                    raise OSError(f"{path} is shorter than listed")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path]), pa.array([number], pa.int64()), pa.array([offset], pa.int64()),
                     pa.array([data], pa.binary())], ["path", "chunk", "offset", "content"])

    last = F.greatest(F.ceil(F.col("length") / chunk) - 1, F.lit(0)).cast("long")
    ranges = (listing.select("path", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("chunk"), "length")
              .repartition(4 * listing.sparkSession.sparkContext.defaultParallelism))
    return ranges.mapInArrow(run, "path string, chunk long, offset long, content binary")


def copy_file(source, source_path: str, target, target_path: str, part: str, expected: str | None,
              chunk: int = CHUNK) -> int:
    """Copy through ``part``, which takes the target's place only when it is whole; bytes written.

    Nothing is written if the target has the ``expected`` content hash
    already; a copy with another one is given up and the target stays.
    """
    if expected and target.get_file_info(target_path).type == pafs.FileType.File:
        if digests(target, target_path, "", chunk)[0] == expected:
            return 0
    target.create_dir(target_path.rpartition("/")[0], recursive=True)
    h, n = hashlib.sha256(), 0
    try:
        with target.open_output_stream(part) as out:
            for data in pieces(source, source_path, chunk):
                h.update(data)
                out.write(data)
                n += len(data)
        if expected and h.hexdigest() != expected:
            raise OSError("the source has changed since the plan was made")
        target.move(part, target_path)
    except Exception:
        if target.get_file_info(part).type == pafs.FileType.File:
            target.delete_file(part)
        raise
    return n
