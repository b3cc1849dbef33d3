"""Landed text rows to typed staging rows, in one projection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerstar.functions import dates, geo, numbers, text
from ledgerstar.schemas import (
    COLUMN_ALIASES,
    HASH_COLUMNS,
    IDENTIFIER_COLUMNS,
    NAME_COLUMNS,
    STAGING_TYPES,
)


def conform_names(raw: DataFrame) -> DataFrame:
    """Snake-case headers, then the alias map."""
    named = raw.toDF(*[text.column_name(c) for c in raw.columns])
    return named.withColumnsRenamed(COLUMN_ALIASES)


def add_coordinates(raw: DataFrame) -> DataFrame:
    """Read both coordinates from store_location unless the source has both."""
    if {"latitude", "longitude"} <= set(raw.columns):
        return raw
    if "store_location" not in raw.columns:
        return raw.drop("latitude", "longitude")
    place = F.col("store_location")
    return raw.withColumns(
        {
            "latitude": geo.latitude(place).cast("string"),
            "longitude": geo.longitude(place).cast("string"),
        }
    )


def conform_columns(raw: DataFrame) -> DataFrame:
    """Every staging column in order; absent ones are null, extra ones go."""
    have = set(raw.columns)
    return raw.select(
        *[
            F.col(c) if c in have else F.lit(None).cast("string").alias(c)
            for c in STAGING_TYPES
        ]
    )


TEXT_COLUMNS = [
    n for n, kind in STAGING_TYPES.items() if kind == "string" and n != "source_row_hash"
]


def _cleaned(name: str, kind: str) -> Column:
    c = F.col(name)
    if name == "date":
        return dates.parse_date(c)
    if kind == "int":
        return numbers.parse_whole(c)
    if kind.startswith("decimal"):
        return numbers.parse_number(c, kind)
    if name not in TEXT_COLUMNS:
        return c
    words = text.blank_to_null(F.col("squeezed")[TEXT_COLUMNS.index(name)])
    if name == "zip_code":
        return text.five_digits(c, words)
    if name in IDENTIFIER_COLUMNS:
        return F.upper(words)
    if name in NAME_COLUMNS:
        return text.title(words)
    return words


def clean_sales(raw: DataFrame, load_time: Column | None = None) -> DataFrame:
    """Staging rows from landed rows.

    ``raw`` carries source_file, source_position and staging_key next to the text columns (see
    sources.landing.read_raw; rows that come from no file have no position). The hash covers the text as landed, so it is taken
    before any value is cleaned.

    The rule all text columns share runs as one function over an array of them.
    Written out per column, the generated method grows past what the JVM compiles
    and the whole job takes almost twice as long.
    """
    landed = conform_columns(add_coordinates(conform_names(raw)))
    stamp = F.current_timestamp() if load_time is None else load_time
    prepared = landed.withColumns(
        {
            "source_row_hash": text.row_hash(*[F.col(c) for c in HASH_COLUMNS]),
            "load_timestamp": stamp,
            "squeezed": F.transform(F.array(*TEXT_COLUMNS), text.squeeze),
        }
    )
    return prepared.select(
        *[_cleaned(n, kind).cast(kind).alias(n) for n, kind in STAGING_TYPES.items()]
    )


def clean_extracts(frames: list[DataFrame], load_time: Column | None = None) -> DataFrame:
    """Staging rows of extracts whose headers differ: each is conformed by its own columns.

    Staging keys are given anew over all of them, as those of two frames may be the same.
    """
    rows = reduce(DataFrame.unionByName, [clean_sales(f, load_time) for f in frames])
    return rows.withColumn("staging_key", F.monotonically_increasing_id())


def landed_order() -> tuple[Column, Column]:
    """What orders staged rows of one day: their file's name, then their place in it.

    Rows that come from no file are ordered by staging key.
    """
    placed = F.col("source_position").isNotNull()
    return F.when(placed, F.col("source_file")).otherwise(""), F.coalesce("source_position", "staging_key")


_RUN_BITS = 16


def number_lines(landed: DataFrame, name: str) -> DataFrame:
    """The place of each row among the rows of its file, from 1, whatever a file holds.

    Rows are numbered within runs of 2**16 places, and the sizes of the runs before are added,
    so only one row per run meets in the running total of a file. `landed` is read twice and has
    to be a written table.
    """
    file, place = landed_order()
    runs = landed.withColumns({"of_file": file, "run": F.shiftright(place, _RUN_BITS)})
    keys = ["of_file", "run"]
    before = Window.partitionBy("of_file").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    sizes = runs.groupBy(*keys).agg(F.count(F.lit(1)).alias("held")).select(
        *keys, F.coalesce(F.sum("held").over(before), F.lit(0)).alias("ahead")
    )
    numbered = runs.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(place)))
    line = (F.col("ahead") + F.col("rank")).cast("bigint").alias(name)
    return numbered.join(sizes, keys).select(*landed.columns, line)
