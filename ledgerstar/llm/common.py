"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerstar.sources.tables import shared_folder

SMALL_TABLE_BYTES = 64 << 20


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and go on from the written table, which cuts the lineage."""
    path = fresh_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def rows_of(batches: Iterable[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    """Rows of Arrow batches, one at a time, as tuples of Python values."""
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns))


def in_batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 4096, width: int = 16 << 20):
    """Arrow batches of at most `size` rows or about `width` bytes of strings and binaries."""
    held: list[tuple] = []
    weight = 0
    for row in rows:
        held.append(row)
        weight += sum(len(v) for v in row if isinstance(v, (str, bytes, list)))
        if len(held) >= size or weight >= width:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t.type) for c, t in zip(zip(*held), schema)], schema=schema
            )
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t.type) for c, t in zip(zip(*held), schema)], schema=schema
        )


def bounded_rows(df: DataFrame, limit_bytes: int, what: str) -> list:
    """Collect a table whose size is checked first; an error names what is too large."""
    widths = [
        F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)).cast("long") + 16
        for c in df.columns
    ]
    held = df.agg(F.sum(sum(widths, F.lit(0)))).first()[0] or 0
    if held > limit_bytes:
        raise ValueError(f"{what} holds {held} bytes; at most {limit_bytes} can be broadcast")
    return df.collect()
