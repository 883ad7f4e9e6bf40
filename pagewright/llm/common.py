"""Helpers shared by the operators: Arrow batches, shared folders, stage tables."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import checkpoint_dir

#: Rows of one Arrow slice given to a per-batch function: long texts are
#: turned into Python objects a slice at a time.
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder for a stage table in the cluster's shared folder."""
    return os.path.join(checkpoint_dir(spark), "pagewright-llm", uuid.uuid4().hex, name)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts the lineage, survives lost executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches in slices of about ``SLICE_BYTES``, one row at least."""
    for b in batches:
        n = max(1, min(b.num_rows, b.num_rows * SLICE_BYTES // max(1, b.nbytes)))
        for i in range(0, b.num_rows, n):
            yield b.slice(i, n)


def no_clash(keep: Iterable[str], results: Iterable[str]) -> None:
    """A clear error if a kept column has the name (in any case, as Spark reads names) of a result or a step to it."""
    if clash := sorted(set(map(str.lower, keep)) & set(map(str.lower, results))):
        raise ValueError(f"kept columns have names of results: {clash}")


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def byte_column(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A text column as UTF-8 bytes, null as empty."""
    c = batch.column(batch.schema.get_field_index(name)).cast(pa.binary())
    return [x or b"" for x in c.to_pylist()]


def text_column(batch: pa.RecordBatch, name: str) -> list[str]:
    """A text column, null as empty."""
    return [x or "" for x in column(batch, name)]


def per_slice(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: T.StructType) -> DataFrame:
    """``fn`` turns each slice into columns of ``schema``; nothing is kept between slices."""
    names, arrow = schema.fieldNames(), arrow_schema(schema)

    def run(batches):
        for b in slices(batches):
            out = fn(b)
            yield pa.RecordBatch.from_arrays([pa.array(out[n], arrow.field(n).type) for n in names], schema=arrow)

    return df.mapInArrow(run, schema)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def row_per_input(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: T.StructType,
                  keep: list[str]) -> DataFrame:
    """Like :func:`per_slice` for functions that return one value per row; ``keep`` columns pass through."""
    full = T.StructType([df.schema[c] for c in keep] + schema.fields)

    def with_kept(b):
        return {c: b.column(b.schema.get_field_index(c)) for c in keep} | fn(b)

    names, arrow = full.fieldNames(), arrow_schema(full)

    def run(batches):
        for b in slices(batches):
            out = with_kept(b)
            cols = [out[n] if isinstance(out[n], pa.Array) else pa.array(out[n], arrow.field(n).type) for n in names]
            yield pa.RecordBatch.from_arrays(cols, schema=arrow)

    return df.mapInArrow(run, full)
