"""Number parsing and guarded arithmetic as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ledgerstar.functions.text import WHITE_SPACE

MEASURE = "decimal(18,4)"
COORDINATE = "decimal(18,8)"
RATIO = "decimal(38,6)"
PERCENT = "decimal(9,2)"


def parse_number(c: Column, type_: str = MEASURE) -> Column:
    """Drop dollar signs and thousands commas, then parse; anything else is null.

    The cast ignores ASCII blanks around the number by itself, so the dearer trim of
    Unicode blanks only runs where it fails.
    """
    bare = F.replace(F.replace(c, F.lit("$"), F.lit("")), F.lit(","), F.lit(""))
    return F.coalesce(bare.try_cast(type_), F.trim(bare, F.lit(WHITE_SPACE)).try_cast(type_))


def parse_whole(c: Column) -> Column:
    return parse_number(c).try_cast("int")


def or_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0).cast(MEASURE))


def ratio(top: Column, bottom: Column) -> Column:
    """top / bottom at six decimals, null when bottom is zero."""
    return (top / F.nullif(bottom, F.lit(0).cast("int"))).cast(RATIO)


def percent(top: Column, bottom: Column) -> Column:
    return ratio(top * F.lit(100), bottom).cast(PERCENT)
