"""Spark session and shared-folder helpers."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Settings every job in this package relies on. AQE re-plans joins from
# runtime sizes (a broadcast only happens below the threshold it measured,
# sort-merge otherwise) and splits skewed shuffle partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # one row per file in binaryFile scans; scans report longer files as errors
    "spark.sql.sources.binaryFile.maxLength": str(2**31 - 1),
}


def build_session(master: str | None = None, app: str = "pagewright",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where it is unset: ``fallback`` if given (tests), else, on a local master
    only, a folder of the session's warehouse. On a cluster an unset folder
    is an error, since executors don't see each other's local files.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if d:
        return d
    if fallback is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; name a folder that every executor sees")
        fallback = os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "pagewright-checkpoints")
    spark.sparkContext.setCheckpointDir(fallback)
    return spark.sparkContext.getCheckpointDir()


def work_path(spark: SparkSession, *parts: str, fallback: str | None = None) -> str:
    """A folder for written stage tables below the checkpoint dir."""
    base = checkpoint_dir(spark, fallback)
    return os.path.join(base, "pagewright", *parts)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a stage table that this library wrote."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _store(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, wherever Spark can write; readers see the old text or the new, never a part."""
    fs, p = _store(spark, path)
    part = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p.getParent(), f"_{p.getName()}.{uuid.uuid4().hex}")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(part, p):  # stores that don't rename onto a file
        fs.delete(p, False)
        if not fs.rename(part, p):
            raise OSError(f"cannot write {path}")


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, None if it isn't there."""
    fs, p = _store(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    """Remove one small file, if it is there."""
    fs, p = _store(spark, path)
    fs.delete(p, False)


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Give a folder another name; its parent is made if needed, an existing target is an error."""
    fs, p = _store(spark, path)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(to)
    fs.mkdirs(target.getParent())
    if fs.exists(target) or not fs.rename(p, target):
        raise OSError(f"cannot rename {path} to {to}")


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of small files, none if it isn't there."""
    fs, p = _store(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def new_run_id() -> str:
    return uuid.uuid4().hex[:12]


_temporary: list[str] = []


def write_through(df, name: str):
    """Write ``df`` once as Parquet below the shared checkpoint folder and
    read it back: cuts the lineage and lets several readers share one
    computation (``DataFrame.checkpoint`` would compute an unpersisted plan
    twice, once to count and once to write). :func:`drop_temporary` removes
    what was written, once nothing lazy reads it any more."""
    spark = df.sparkSession
    folder = work_path(spark, "tmp", uuid.uuid4().hex)
    _temporary.append(folder)
    path = os.path.join(folder, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def temporary_count() -> int:
    return len(_temporary)


def drop_temporary(spark: SparkSession, since: int = 0) -> None:
    """Remove the tables of :func:`write_through`, those from number ``since`` on."""
    while len(_temporary) > since:
        delete_path(spark, _temporary.pop())
