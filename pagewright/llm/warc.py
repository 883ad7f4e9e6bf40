"""WARC archives: written from pages, read back as rows of chunks.

Writing: pages with equal payloads become one response record and revisit
records that refer to it. Spark's text writer puts the records down (a record
ends with two line breaks, which is the writer's separator), so archives lie
wherever Spark can write. Each archive is padded to whole blocks by a last
``metadata`` record.

Reading: archives come in blocks of fixed size, in order, one archive per
task. A small state machine follows the records through the blocks and yields
a row per chunk of a payload with the bytes and SHA-1 digest so far; neither a
record nor an archive is ever in memory as a whole. A record's last chunk has
the digest of its payload.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import byte_column, column, fresh_path, slices, table, written

#: Archives are whole numbers of blocks; a chunk row has ``CHUNK`` bytes of payload at most.
BLOCK, CHUNK = 1 << 18, 1 << 16
#: Bits of a digest that the bitmap of shared payloads tells apart (8 MiB).
DIGEST_BITS = 26
DATE = "2026-01-01T00:00:00Z"
#: Profile of revisits and the two ends of a record.
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"
_ID = "urn:x-page-id:"

CHUNKS = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("record_type", T.StringType()),
    T.StructField("url", T.StringType()), T.StructField("refers_to", T.LongType()),
    T.StructField("declared_bytes", T.LongType()), T.StructField("declared_digest", T.StringType()),
    T.StructField("chunk", T.LongType()), T.StructField("bytes_so_far", T.LongType()),
    T.StructField("digest_so_far", T.StringType()), T.StructField("last", T.BooleanType()),
    T.StructField("data", T.BinaryType())])


def shared_payloads(rows: DataFrame) -> DataFrame:
    """``same, first``: the digest of each payload that several rows hold, and its largest page_id (written)."""
    return written(rows.filter("counts").groupBy("sha1")
                   .agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
                   .select(F.col("sha1").alias("same"), "first"), "shared-payloads")


def digest_bits(shared: DataFrame) -> np.ndarray:
    """A bitmap of ``1 << DIGEST_BITS`` bits, whatever the number of digests: the first bits of those in ``shared``."""
    at = F.shiftright(F.conv(F.substring("same", 1, 8), 16, 10).cast("long"), 32 - DIGEST_BITS)
    words = (shared.select(at.alias("at")).groupBy(F.shiftright("at", 3).alias("byte"))
             .agg(F.expr("bit_or(shiftleft(1, int(at % 8)))").alias("bits")).toArrow())
    out = np.zeros(1 << (DIGEST_BITS - 3), np.uint8)
    out[words.column("byte").to_numpy()] = words.column("bits").to_numpy()
    return out


def roles(pages: DataFrame, least_bytes: int = 0) -> tuple[DataFrame, DataFrame]:
    """``page_id, url, payload, sha1, refers_to`` of pages that share no payload, and of the others.

    ``refers_to`` is null for responses, else the page_id of the response. Of
    equal payloads of ``least_bytes`` or more, that with the largest page_id
    is the response (so are rows that repeat that id); null ids never are,
    unless all are null. Smaller payloads are all responses.

    Payloads whose digest isn't in the bitmap of shared ones stay where they
    are. The others, and the few that it can't tell, are joined with their
    response; their payload travels as Zstandard.
    """
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.sha1(html).alias("sha1"),
                        (F.octet_length(html) >= least_bytes).alias("counts"))
    shared = shared_payloads(rows)
    bits = rows.sparkSession.sparkContext.broadcast(digest_bits(shared))

    def may_share(part: bool):
        def run(batches):
            for b in slices(batches):
                first = np.array([int(x[:8], 16) >> (32 - DIGEST_BITS) for x in column(b, "sha1")], np.int64)
                hit = (bits.value[first >> 3] >> (first & 7).astype(np.uint8)) & 1 == 1
                b = b.filter(pa.array(hit == part))
                raw = byte_column(b, "html")
                if part:
                    raw = list(map(zstandard.ZstdCompressor().compress, raw))
                at = b.schema.get_field_index("html")
                yield pa.RecordBatch.from_arrays([pa.array(raw, pa.binary()) if i == at else c for i, c in enumerate(b.columns)],
                                                 ["page_id", "url", "payload", "sha1", "counts"])
        return rows.mapInArrow(run, T.StructType([rows.schema["page_id"], rows.schema["url"],
                                                  T.StructField("payload", T.BinaryType()), *rows.schema.fields[3:]]))

    alone = may_share(False).withColumn("refers_to", F.lit(None).cast(rows.schema["page_id"].dataType)).drop("counts")
    both = may_share(True).join(shared, (F.col("sha1") == F.col("same")) & F.col("counts"), "left")
    return alone, both.select("page_id", "url", "payload", "sha1",
                              F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))


def _head(kind: str, page_id, url, digest: str, refers_to, length: int) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{_ID}{'' if page_id is None else page_id}>",
             f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{_ID}{refers_to}>", f"WARC-Profile: {REVISIT}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {length}"]
    return "\r\n".join(lines).encode() + END


def record(page_id, url, payload: bytes, sha1_hex: str, refers_to) -> bytes:
    """One record without its end. A revisit has the HTTP head of its payload only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}".encode() + END
    digest = base64.b32encode(bytes.fromhex(sha1_hex)).decode()
    body = http if refers_to is not None else http + payload
    return _head("response" if refers_to is None else "revisit", page_id, url, digest, refers_to, len(body)) + body


def padding(written: int) -> bytes:
    """A metadata record without its end that fills ``written`` bytes to whole blocks."""
    head = f"WARC/1.1\r\nWARC-Type: metadata\r\nWARC-Record-ID: <urn:x-padding:{written}>\r\nWARC-Date: {DATE}\r\n" \
           "Content-Type: text/plain\r\nContent-Length: "
    fixed = len(head) + 10 + 2 * len(END)
    size = -(written + fixed) % BLOCK
    return f"{head}{size:010d}".encode() + END + b" " * size


def write(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Archives of ``pages`` (``page_id, url, html``; null html is empty) under ``path``, one per task."""

    def archived(packed: bool):
        def run(batches):
            done = 0
            unpack = zstandard.ZstdDecompressor().decompress if packed else bytes
            for b in slices(batches):
                out = [record(i, url, unpack(payload), sha1, first)
                       for i, url, payload, sha1, first in zip(*(b.column(c).to_pylist() for c in range(5)))]
                done += sum(map(len, out)) + len(END) * len(out)
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()).cast(pa.string())], ["value"])
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([padding(done).decode()])], ["value"])
        return run

    alone, shared = roles(pages, least_bytes)
    (alone.mapInArrow(archived(False), "value string").union(shared.mapInArrow(archived(True), "value string")).write
     .option("lineSep", END.decode()).option("compression", "none").option("maxRecordsPerFile", 0).text(path))


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def _page(uri: str | None) -> int | None:
    number = (uri or "").strip("<>").removeprefix(_ID)
    return int(number) if number.lstrip("-").isdigit() else None


class Stream:
    """Bytes of consecutive blocks, taken piece by piece."""

    def __init__(self, blocks: Iterable[bytes]):
        self.blocks, self.held = iter(blocks), b""

    def more(self) -> bool:
        block = next(self.blocks, None)
        if block is None:
            return False
        self.held += bytes(block)
        return True

    def until(self, mark: bytes, most: int) -> bytes | None:
        """The bytes before ``mark``, which is passed; None if ``most`` bytes or the stream end without it."""
        while (at := self.held.find(mark, 0, most + len(mark))) < 0:
            if len(self.held) >= most + len(mark) or not self.more():
                return None
        out, self.held = self.held[:at], self.held[at + len(mark):]
        return out

    def pieces(self, n: int, size: int) -> Iterator[bytes]:
        """The next ``n`` bytes in pieces of ``size`` (the last may be shorter)."""
        while n > 0:
            want = min(n, size)
            while len(self.held) < want:
                if not self.more():
                    raise ValueError("archive ends inside a record")
            yield self.held[:want]
            self.held = self.held[want:]
            n -= want


def chunks(blocks: Iterable[bytes], data: bool = True) -> Iterator[tuple]:
    """Rows of ``CHUNKS`` for the records of one archive, in order; other record types are passed over."""
    s = Stream(blocks)
    while s.held or s.more():
        head = s.until(END, 1 << 20)
        if head is None or not head.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        f = _fields(head)
        left, kind = int(f["content-length"]), f.get("warc-type", "")
        if kind in ("response", "revisit"):
            before = s.until(END, left)
            if before is None:
                raise ValueError("no HTTP head in a response")
            http = _fields(before)
            left -= len(before) + len(END)
            same = (_page(f.get("warc-record-id")), kind, f.get("warc-target-uri"), _page(f.get("warc-refers-to")),
                    int(http.get("content-length", left)), f.get("warc-payload-digest", "").removeprefix("sha1:") or None)
            sha1, done, number = hashlib.sha1(), 0, 0
            for piece in s.pieces(left, CHUNK):
                sha1.update(piece)
                done += len(piece)
                yield (*same, number, done, base64.b32encode(sha1.digest()).decode(), done == left, piece if data else None)
                number += 1
            if not left:
                yield (*same, 0, 0, base64.b32encode(sha1.digest()).decode(), True, b"" if data else None)
        else:
            for _ in s.pieces(left, CHUNK):
                pass
        if s.until(END, 0) is None:
            raise ValueError("a record doesn't end with two line breaks")


def read_chunks(spark: SparkSession, path: str, data: bool = True) -> DataFrame:
    """A row of ``CHUNKS`` per chunk of each response and revisit below ``path``.

    ``data=False`` leaves the payload bytes out. An archive is read by one
    task; it must be a whole number of ``BLOCK`` bytes, as :func:`write` makes it.
    """
    conf = {"org.apache.spark.input.FixedLengthBinaryInputFormat.recordLength": str(BLOCK),
            "mapreduce.input.fileinputformat.split.minsize": str(1 << 50)}  # never split an archive
    blocks = spark.sparkContext.newAPIHadoopFile(
        path, "org.apache.spark.input.FixedLengthBinaryInputFormat", "org.apache.hadoop.io.LongWritable",
        "org.apache.hadoop.io.BytesWritable", conf=conf)
    rows = blocks.mapPartitions(lambda it: chunks((b for _, b in it), data))
    return spark.createDataFrame(rows, CHUNKS, verifySchema=False)


def payloads(rows: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to, intact`` per record.

    A response's figures are those of the bytes read, and ``intact`` says that
    the declared ones agree; a revisit has the declared figures.
    """
    own = F.col("record_type") == "response"
    return rows.filter("last").select(
        "page_id", F.when(own, F.col("bytes_so_far")).otherwise(F.col("declared_bytes")).alias("payload_bytes"),
        F.when(own, F.col("digest_so_far")).otherwise(F.col("declared_digest")).alias("payload_digest"),
        "record_type", "refers_to",
        (~own | ((F.col("bytes_so_far") == F.col("declared_bytes"))
                 & F.col("digest_so_far").eqNullSafe(F.col("declared_digest")))).alias("intact"))


def op4_warc(spark, sf_dir):
    """Query: every page written to archives and read back."""
    path = fresh_path(spark, "archives")
    write(table(spark, sf_dir, "pages"), path)
    return payloads(read_chunks(spark, path, data=False))


#: Base 32 of a hexadecimal digest is its bits in fives, 32 digits for SHA-1.
OP4_SQL = """
with p as (select page_id, coalesce(html, '') h, sha1(coalesce(html, '')) d from pages),
r as (select d, max(page_id) f from p group by d),
b as (select p.page_id, p.d, strlen(p.h) n, r.f,
  array_to_string(list_transform(range(40), lambda i: lpad(bin(('0x' || p.d[i + 1])::int), 4, '0')), '') bits
  from p join r using (d))
select page_id, n::bigint payload_bytes,
  array_to_string(list_transform(range(32),
    lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[(('0b' || bits[5 * i + 1:5 * i + 5])::int + 1)]), '') payload_digest,
  case when page_id = f then 'response' else 'revisit' end record_type,
  case when page_id <> f then f end refers_to, true intact
from b
"""
