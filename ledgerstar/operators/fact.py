"""The line-grain sales fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerstar.functions.dates import date_key, month_of
from ledgerstar.functions.numbers import MEASURE, or_zero
from ledgerstar.functions.text import natural_key
from ledgerstar.operators.dimensions import HASHED, packaging_key, text_key
from ledgerstar.schemas import DIMENSION_KEYS, NATURAL_KEYS

SIGNED_MEASURES = ["sale_dollars", "bottles_sold", "volume_sold_liters"]

def _natural() -> dict[str, Column]:
    return {
        "store_number": natural_key(F.col("store_number")),
        "item_number": natural_key(F.col("item_number")),
        "category_number": natural_key(F.col("category")),
        "vendor_number": natural_key(F.col("vendor_number")),
        "pack": F.coalesce(F.col("pack"), F.lit(0)),
        "bottle_volume_ml": F.coalesce(F.col("bottle_volume_ml"), F.lit(0)),
    }


def is_eligible() -> Column:
    """None of the three measures is below zero; null counts as zero."""
    first, *others = [or_zero(F.col(c)) >= 0 for c in SIGNED_MEASURES]
    for other in others:
        first = first & other
    return first


def has_negative() -> Column:
    """Some measure is below zero; null is not."""
    first, *others = [F.col(c) < 0 for c in SIGNED_MEASURES]
    for other in others:
        first = first | other
    return first


def line_margin() -> Column:
    """(retail - cost) * bottles at four decimals."""
    unit = or_zero(F.col("state_bottle_retail")) - or_zero(F.col("state_bottle_cost"))
    return (unit * or_zero(F.col("bottles_sold"))).cast(MEASURE)


def _measures() -> list[Column]:
    return [
        F.col("invoice_and_item_number").alias("invoice_number"),
        F.col("source_row_hash"),
        F.lit(1).alias("sales_line_count"),
        or_zero(F.col("bottles_sold")).alias("bottles_sold"),
        or_zero(F.col("sale_dollars")).alias("sale_dollars"),
        or_zero(F.col("volume_sold_liters")).alias("volume_sold_liters"),
        or_zero(F.col("volume_sold_gallons")).alias("volume_sold_gallons"),
        or_zero(F.col("state_bottle_cost")).alias("state_bottle_cost"),
        or_zero(F.col("state_bottle_retail")).alias("state_bottle_retail"),
        line_margin().alias("margin_amount"),
        F.col("load_timestamp"),
    ]


def _hashed_keys() -> list[Column]:
    natural = _natural()
    return [
        text_key(natural["store_number"]).alias("store_key"),
        text_key(natural["item_number"]).alias("product_key"),
        text_key(natural["category_number"]).alias("category_key"),
        text_key(natural["vendor_number"]).alias("vendor_key"),
        packaging_key(natural["pack"], natural["bottle_volume_ml"]).alias("packaging_key"),
    ]


def _loadable(staging: DataFrame) -> DataFrame:
    """An inner join to the calendar drops undated rows; so does this filter."""
    return staging.where(is_eligible() & F.col("date").isNotNull())


# The fact is written by month, so that a period filter reads the months it needs.
FACT_PARTITION = "sale_month"


def fact_sales(staging: DataFrame, clashes: DataFrame | None = None) -> DataFrame:
    """Fact rows for dimensions built from the same staging rows.

    Each natural key of an eligible row has its member by construction, so the six
    inner joins reduce to computing the keys: a map-only plan, no shuffle, indifferent to
    skew. quality.join_failures proves it on the result. `clashes` (dimensions.clashes,
    written before) names the few members whose key is not their hash; they are looked up
    by hash and natural key. Its size is that of hash clashes among members, which Catalyst
    sees in the written table and broadcasts; where it is empty the lookup is dropped.
    """
    day = date_key(F.col("date"))
    lines = _loadable(staging).select(
        F.col("staging_key").alias("sales_key"),
        day.alias("date_key"),
        *_hashed_keys(),
        *_measures(),
        month_of(day).alias(FACT_PARTITION),
        *([] if clashes is None else [c.alias(f"nk_{n}") for n, c in _natural().items()]),
    )
    if clashes is None:
        return lines
    columns = [c for c in lines.columns if not c.startswith("nk_")]
    for name in HASHED:
        key, natural = DIMENSION_KEYS[name], f"nk_{NATURAL_KEYS[name][0]}"
        others = clashes.where(F.col("table_name") == name).select("taken", "natural", "surrogate")
        same = (F.col(key) == F.col("taken")) & (F.col(natural) == F.col("natural"))
        lines = lines.join(others, same, "left").withColumn(key, F.coalesce("surrogate", key)).drop(*others.columns)
    return lines.select(columns)


def fact_sales_joined(staging: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Fact rows whose keys are looked up in the dimensions (densely numbered keys).

    No hints: Catalyst broadcasts the dimensions whose size it knows to be small and
    sort-merges the others, where adaptive execution splits hot keys.
    """
    lines = _loadable(staging).select(
        F.col("staging_key").alias("sales_key"),
        "date",
        *[c.alias(f"nk_{n}") for n, c in _natural().items()],
        *_measures(),
    )
    lines = lines.join(dims["dim_date"].select("date_key", "date"), "date")
    for name, natural in NATURAL_KEYS.items():
        members = dims[name].select(
            DIMENSION_KEYS[name], *[F.col(n).alias(f"nk_{n}") for n in natural]
        )
        lines = lines.join(members, [f"nk_{n}" for n in natural])
    measures = [c for c in lines.columns if c not in DIMENSION_KEYS.values()]
    measures = [c for c in measures if not c.startswith("nk_") and c not in ("date", "sales_key")]
    return lines.select(
        "sales_key", *DIMENSION_KEYS.values(), *measures,
        month_of(F.col("date_key")).alias(FACT_PARTITION),
    )
