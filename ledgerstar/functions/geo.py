"""Coordinates out of free text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ledgerstar.functions.numbers import COORDINATE

# Fixed pattern: "(longitude[,] latitude)" with optional sign and decimals.
POINT = (
    r"(?U)\((-?[0-9]+(?:\.[0-9]+)?)[\s\x1c-\x1f]*,?[\s\x1c-\x1f]+"
    r"(-?[0-9]+(?:\.[0-9]+)?)\)"
)


def _part(c: Column, group: int) -> Column:
    return F.nullif(F.regexp_extract(c, POINT, group), F.lit("")).try_cast(COORDINATE)


def longitude(c: Column) -> Column:
    return _part(c, 1)


def latitude(c: Column) -> Column:
    return _part(c, 2)
