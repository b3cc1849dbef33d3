"""Read-only profile queries over a loaded warehouse."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerstar.functions.numbers import or_zero, percent
from ledgerstar.operators.cleaning import landed_order
from ledgerstar.operators.fact import has_negative, is_eligible, line_margin
from ledgerstar.operators.rollup import (
    LINE_MEASURES,
    count_if,
    count_rows,
    distinct_count,
    fold,
    one_row,
    top,
    totals,
)
from ledgerstar.plans import views
from ledgerstar.plans.star import Star
from ledgerstar.schemas import DIMENSION_KEYS


def stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _mapped() -> Column:
    return F.col("latitude").isNotNull() & F.col("longitude").isNotNull()


def _labelled(df: DataFrame, table: str, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name)).select(F.lit(table).alias("table_name"), name)


def layer_counts(star: Star) -> DataFrame:
    """Source files, staged rows, and rows of the star."""
    files = star.staging.select("source_file").where(F.col("source_file").isNotNull()).distinct()
    star_rows = stack(
        [count_rows(star.fact, "n")]
        + [count_rows(star.dimension(n), "n") for n in DIMENSION_KEYS]
    ).agg(F.sum("n").alias("observed_count"))

    def layer(df: DataFrame, name: str, what: str) -> DataFrame:
        return df.select(
            F.lit(name).alias("layer_name"), F.lit(what).alias("object_name"), "observed_count"
        )

    return stack(
        [
            layer(count_rows(files, "observed_count"), "1 Bronze", "source files"),
            layer(count_rows(star.staging, "observed_count"), "2 Silver", "staging"),
            layer(star_rows, "3 Gold", "dimensions + fact"),
        ]
    )


def file_profile(star: Star, k: int = 20) -> DataFrame:
    per_file = star.staging.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        count_if(F.col("source_row_hash").isNull()).alias("null_hash_rows"),
        count_if(_mapped()).alias("rows_with_gps"),
    )
    return per_file.orderBy(F.col("source_file").asc_nulls_first()).limit(k)


def staging_profile(star: Star) -> DataFrame:
    staging = star.staging
    counts = staging.agg(
        F.count(F.lit(1)).alias("staging_rows"),
        count_if(F.col("date").isNull()).alias("null_date_rows"),
        count_if(F.col("invoice_and_item_number").isNull()).alias("null_invoice_rows"),
        count_if(F.col("store_number").isNull()).alias("null_store_number_rows"),
        count_if(F.col("item_number").isNull()).alias("null_item_number_rows"),
        count_if(has_negative()).alias("negative_measure_rows"),
        count_if(_mapped()).alias("rows_with_gps"),
    )
    # Half the bytes to shuffle: the digest instead of its hex spelling.
    digests = staging.select(F.unhex("source_row_hash").alias("digest"))
    row = one_row(counts, distinct_count(digests, [], "digest", "distinct_hashes"))
    return row.select(
        "staging_rows",
        "distinct_hashes",
        (F.col("staging_rows") - F.col("distinct_hashes")).alias("duplicate_hash_candidates"),
        "null_date_rows", "null_invoice_rows", "null_store_number_rows",
        "null_item_number_rows", "negative_measure_rows", "rows_with_gps",
    )


def latest_rows(star: Star, k: int = 10) -> DataFrame:
    df = star.staging.select(
        "staging_key", "source_file", "invoice_and_item_number", "date", "store_number",
        "store_name", "city", "county", "item_number", "item_description", "pack",
        "bottle_volume_ml", "state_bottle_cost", "state_bottle_retail", "bottles_sold",
        "sale_dollars", line_margin().alias("margin_amount_if_loaded"), "source_row_hash",
    )
    return df.orderBy(
        F.col("date").desc_nulls_last(), *[c.desc() for c in landed_order()], "source_row_hash"
    ).limit(k)


def reconciliation(star: Star) -> DataFrame:
    silver = star.staging.agg(
        F.count(F.lit(1)).alias("silver_all_rows"),
        count_if(is_eligible()).alias("silver_rows_eligible_for_fact"),
        F.sum(F.when(is_eligible(), or_zero(F.col("sale_dollars"))).otherwise(0)).alias("silver"),
        count_if(has_negative()).alias("silver_rows_excluded_by_negative_measure_filter"),
    )
    gold = star.fact.agg(
        F.count(F.lit(1)).alias("gold_fact_rows_after_load"),
        F.sum("sale_dollars").alias("gold"),
        F.sum("margin_amount").alias("margin"),
        F.sum("sales_line_count").alias("sales_line_count"),
    )
    apart = F.abs(F.coalesce("silver", F.lit(0)) - F.coalesce("gold", F.lit(0)))
    rows_apart = F.col("silver_rows_eligible_for_fact") - F.col("gold_fact_rows_after_load")

    # The wide type: 100 TB of sales may not fit eighteen digits.
    def amount(c: Column, name: str) -> Column:
        return c.cast("decimal(38,4)").alias(name)

    return one_row(silver, gold).select(
        "silver_all_rows",
        "silver_rows_eligible_for_fact",
        "gold_fact_rows_after_load",
        rows_apart.alias("row_difference"),
        "silver_rows_excluded_by_negative_measure_filter",
        amount(F.col("silver"), "silver_eligible_sales"),
        amount(F.col("gold"), "gold_fact_sales"),
        amount(apart, "sales_difference"),
        amount(F.col("margin"), "gold_total_margin"),
        "sales_line_count",
    )


def dimension_counts(star: Star) -> DataFrame:
    return stack(
        [_labelled(star.dimension(n), f"dw.{n}", "row_count") for n in DIMENSION_KEYS]
    )


def calendar_coverage(star: Star) -> DataFrame:
    span = F.datediff(F.max("date"), F.min("date")) + 1
    rows = F.count(F.lit(1))
    return star.dim_date.agg(
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        rows.alias("dim_date_rows"),
        span.alias("expected_calendar_days"),
        (span - rows).alias("missing_calendar_days"),
    )


def missing_days(star: Star) -> DataFrame:
    """The days calendar_coverage counts, as rows."""
    ends = star.dim_date.agg(F.min("date").alias("first"), F.max("date").alias("last"))
    days = ends.where(F.col("first").isNotNull()).select(
        F.explode(F.sequence("first", "last")).alias("date")
    )
    return days.join(star.dim_date, "date", "left_anti").orderBy("date")


def unknown_members(star: Star) -> DataFrame:
    natural = {
        "dim_store": "store_number",
        "dim_product": "item_number",
        "dim_category": "category_number",
        "dim_vendor": "vendor_number",
    }
    return stack(
        [
            _labelled(
                star.dimension(n).where(F.col(key) == "UNKNOWN"), f"dw.{n}", "unknown_rows"
            )
            for n, key in natural.items()
        ]
    )


def packaging_groups(star: Star) -> DataFrame:
    volume = "bottle_volume_ml"
    return (
        star.dim_packaging.groupBy("volume_group")
        .agg(
            F.count(F.lit(1)).alias("packaging_variants"),
            F.min(volume).alias("min_bottle_volume_ml"),
            F.max(volume).alias("max_bottle_volume_ml"),
        )
        .orderBy("volume_group")
    )


def dimension_sample(star: Star, name: str, by: list[str], k: int = 5) -> DataFrame:
    """First members in the order of by (surrogate or natural key)."""
    return star.dimension(name).orderBy(*by).limit(k)


def fact_profile(star: Star) -> DataFrame:
    stamps = star.fact.agg(
        F.count(F.lit(1)).alias("fact_rows"),
        F.min("load_timestamp").alias("first_fact_load_timestamp"),
        F.max("load_timestamp").alias("last_fact_load_timestamp"),
    )
    invoices = distinct_count(star.fact, [], "invoice_number", "invoice_count")
    df = one_row(stamps, totals(star.fact), invoices)
    return df.select(
        "fact_rows", "invoice_count", "sales_line_count", "total_bottles_sold", "total_sales",
        "total_margin",
        percent(F.col("total_margin"), F.col("total_sales")).alias("margin_percent"),
        "total_volume_liters", "first_fact_load_timestamp", "last_fact_load_timestamp",
    )


def null_keys(star: Star) -> DataFrame:
    return star.fact.agg(
        *[count_if(F.col(k).isNull()).alias(f"null_{k}") for k in DIMENSION_KEYS.values()]
    )


def sales_by_year(star: Star) -> DataFrame:
    days = star.dim_date.select("date_key", "year")
    lines = star.fact.select("date_key", *LINE_MEASURES, "invoice_number", "sales_key").join(
        F.broadcast(days), "date_key"  # one row per calendar day
    )
    sums = lines.groupBy("year").agg(
        F.count("sales_key").alias("sales_line_count"),
        F.sum("sale_dollars").alias("total_sales"),
        F.sum("margin_amount").alias("total_margin"),
    )
    df = fold(["year"], sums, distinct_count(lines, ["year"], "invoice_number", "invoice_count"))
    return df.select(
        "year", "sales_line_count", "invoice_count", "total_sales", "total_margin"
    ).orderBy("year")


def _desc(*names: str) -> list[Column]:
    return [F.col(n).desc_nulls_last() for n in names]


def _asc(*names: str) -> list[Column]:
    return [F.col(n).asc_nulls_first() for n in names]


_STORE = ("store_number", "store_name", "city", "county")
# For each view: the sample's sort order, then the columns that settle equal rows.
SAMPLE_ORDER = {
    "sales_overview": lambda: _desc("date") + _asc("invoice_number", "item_number", "vendor_number", "sale_dollars", "margin_amount"),
    "sales_by_day_type": lambda: _desc("year", "month") + _asc("day_type"),
    "sales_by_month": lambda: _desc("year", "month"),
    "category_sales_over_time": lambda: _desc("year", "month", "total_sales") + _asc("category_name"),
    "sales_by_category": lambda: _desc("total_sales") + _asc("category_name"),
    "sales_by_store": lambda: _desc("total_sales") + _asc(*_STORE),
    "sales_by_vendor": lambda: _desc("total_sales") + _asc("vendor_name"),
    "sales_by_packaging": lambda: _desc("total_sales") + _asc("pack", "bottle_volume_ml"),
    "sales_by_geography": lambda: _desc("total_sales") + _asc("state_name", "county", "city"),
    "sales_map_points": lambda: _desc("total_sales") + _asc(*_STORE),
    "top_products": lambda: _desc("total_sales") + _asc("item_number", "category_name", "vendor_name"),
    "margin_analysis": lambda: _desc("total_margin") + _asc("category_name", "vendor_name", "item_description"),
    "volume_vs_revenue": lambda: _desc("total_sales") + _asc("state_name", "county"),
    "avg_sales_per_store_by_month_region": lambda: _desc("year", "month", "avg_sales_per_store") + _asc("state_name", "county"),
    "kpi_summary": lambda: _desc("total_sales"),
    "etl_status": lambda: _desc("status_generated_at"),
}
SAMPLE_COLUMNS = {
    "sales_overview": [
        "date", "store_number", "store_name", "city", "county", "item_number",
        "item_description", "category_name", "vendor_name", "sale_dollars", "margin_amount",
    ],
    "avg_sales_per_store_by_month_region": [
        *views.PERIOD, "state_name", "county", "store_count", "avg_sales_per_store",
        "avg_bottles_per_store", "avg_volume_liters_per_store", "avg_margin_per_store",
    ],
}


def view_sample(star: Star, name: str, k: int = 5) -> DataFrame:
    """First rows of a view: latest month or largest total first, by view."""
    df = views.VIEWS[name](star)
    return df.orderBy(*SAMPLE_ORDER[name]()).limit(k).select(*SAMPLE_COLUMNS.get(name, df.columns))


def dirty_rows(star: Star, k: int = 5) -> DataFrame:
    """Staged rows without a category name or with coordinates inside the location."""
    odd = star.staging.where(
        F.col("category_name").isNull() | F.col("store_location").like("POINT%")
    )
    df = odd.select(
        "invoice_and_item_number", "date", "store_location", "category_name",
        "state_bottle_cost", "sale_dollars",
    )
    return df.orderBy(*landed_order(), "source_row_hash").limit(k)
