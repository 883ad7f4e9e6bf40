"""Content and identity hashes as native column expressions (H1-H3)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SHA2_BITS = {"sha224": 224, "sha256": 256, "sha384": 384, "sha512": 512}


def _as_bytes(c: Column | str) -> Column:
    # string -> UTF-8 bytes; binary stays as it is
    return F.col(c).cast("binary") if isinstance(c, str) else c.cast("binary")


def file_hash(content: Column | str, algo: str = "sha256",
              extra: Column | str | None = None) -> Column:
    """Hex digest of ``content`` followed by the UTF-8 bytes of ``extra``."""
    data = _as_bytes(content)
    if extra is not None:
        extra_c = F.col(extra) if isinstance(extra, str) else extra
        # an empty extra adds nothing, as with no extra at all
        data = F.concat(data, F.encode(F.coalesce(extra_c, F.lit("")), "UTF-8"))
    algo = algo.lower().replace("-", "")
    if algo == "md5":
        return F.md5(data)
    if algo == "sha1":
        return F.sha1(data)
    if algo in _SHA2_BITS:
        return F.sha2(data, _SHA2_BITS[algo])
    raise ValueError(f"unsupported hash algorithm: {algo}")


def content_hash(content: Column | str) -> Column:
    """H1: sha256 of the bytes alone; equal content gives an equal hash."""
    return file_hash(content, "sha256")


def doc_hash(content: Column | str, path: Column | str) -> Column:
    """H2: sha256 of the bytes followed by the path, no separator."""
    return file_hash(content, "sha256", extra=path)
