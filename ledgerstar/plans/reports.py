"""The frames behind the twelve business questions.

Rankings add natural keys as further sort columns, so equal values always give the
same rows. Distinct counts over longer periods are counted again from the fact; with
as_reference=True the monthly counts are added up instead, as the replaced reports
did.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerstar.functions.dates import period_columns
from ledgerstar.functions.numbers import ratio
from ledgerstar.operators.fact import FACT_PARTITION
from ledgerstar.operators.rollup import LINE_MEASURES, distinct_count, fold, regroup, top, totals
from ledgerstar.plans import views
from ledgerstar.plans.star import Star

SUMS = views.SUMS
# Sales below which a rate is not ranked.
MIN_STORE_SALES = 50000
MIN_PRODUCT_SALES = 5000
HIGH_VOLUME_QUANTILE = 0.75


def _desc(name: str) -> Column:
    return F.col(name).desc_nulls_last()


def _with_margin_percent(df: DataFrame) -> DataFrame:
    rate = ratio(F.col("total_margin") * F.lit(100), F.col("total_sales"))
    return df.withColumn("margin_percent", rate)


# Header


def kpi_header(star: Star) -> DataFrame:
    return views.kpi_summary(star).select(
        "total_sales", "total_margin", "avg_margin_percent", "sales_line_count",
        "invoice_count", "store_count", "product_count", "avg_invoice_value",
    )


def dataset_status(star: Star, manifest: DataFrame | None = None) -> DataFrame:
    status = views.etl_status(star).select(
        "fact_row_count", "dim_store_count", "dim_product_count", "min_date", "max_date",
        "last_fact_load_timestamp",
    )
    if manifest is None:
        return status
    extract = manifest.select(
        "start_date", "end_date", "file_count", "total_rows", "generated_at_utc"
    )
    # Both sides are one row: matched on a constant key.
    one = F.lit(1).alias("one")
    return extract.select("*", one).join(status.select("*", one), "one").drop("one")


# 1: sales over time


def monthly(star: Star) -> DataFrame:
    return views.sales_by_month(star).select(
        "year_month", *SUMS, "invoice_count", "store_count"
    ).orderBy("year_month")


def _longer_period(star: Star, keys: list[str], as_reference: bool) -> DataFrame:
    if as_reference:
        months = views.sales_by_month(star)
        return regroup(
            months.select(*keys, *SUMS, "sales_line_count", "invoice_count", "store_count"), *keys
        )
    named = period_columns(F.col(FACT_PARTITION))
    lines = star.fact.select(
        *[named[k].alias(k) for k in keys], *LINE_MEASURES, "invoice_number", "store_key"
    )
    return fold(
        keys,
        totals(lines, *keys),
        distinct_count(lines, keys, "invoice_number", "invoice_count"),
        distinct_count(lines, keys, "store_key", "store_count"),
    )


def quarterly(star: Star, as_reference: bool = False) -> DataFrame:
    label = F.concat(F.col("year"), F.lit(" Q"), F.col("quarter"))
    df = _longer_period(star, ["year", "quarter"], as_reference)
    return df.withColumn("year_quarter", label).orderBy("year", "quarter")


def yearly(star: Star, as_reference: bool = False) -> DataFrame:
    return _longer_period(star, ["year"], as_reference).orderBy("year")


# 2: categories


def _categories(star: Star) -> DataFrame:
    return _with_margin_percent(views.sales_by_category(star)).select(
        "category_name", "total_sales", "total_margin", "margin_percent",
        "total_bottles_sold", "total_volume_liters", "sales_share_percent",
    )


def categories(star: Star) -> DataFrame:
    return _categories(star).orderBy(_desc("total_sales"), "category_name")


def top_categories(star: Star, by: str = "total_sales", k: int = 15) -> DataFrame:
    """by is total_sales, total_margin or margin_percent."""
    return top(_categories(star), k, _desc(by), "category_name")


# 3: stores


def _stores(star: Star) -> DataFrame:
    return _with_margin_percent(views.sales_by_store(star)).select(
        "store_number", "store_name", "city", "county", "total_sales", "total_margin",
        "margin_percent", "invoice_count",
    )


def top_stores(star: Star, by: str = "total_sales", k: int = 15) -> DataFrame:
    return top(_stores(star), k, _desc(by), "store_number")


def top_store_rates(star: Star, k: int = 15, min_sales: int = MIN_STORE_SALES) -> DataFrame:
    """Best margin percent among stores with enough sales."""
    sold = _stores(star).where(F.col("total_sales") >= min_sales)
    return top(sold, k, _desc("margin_percent"), "store_number")


# 4: places


def counties(star: Star) -> DataFrame:
    df = views.sales_by_geography(star).drop("state_name", "city")
    return regroup(df, "county").orderBy(_desc("total_sales"), "county")


def cities(star: Star) -> DataFrame:
    """City totals with the counties each city name occurs in."""
    df = views.sales_by_geography(star)
    measures = [*SUMS, "sales_line_count", "store_count"]
    return (
        df.groupBy("city")
        .agg(
            *[F.sum(c).alias(c) for c in measures],
            # One value per county of the city, not per sale.
            F.concat_ws(", ", F.array_sort(F.collect_set("county"))).alias("county"),
        )
        .orderBy(_desc("total_sales"), "city")
    )


def city_map(star: Star) -> DataFrame:
    points = views.map_totals(star)
    df = points.groupBy("city", "county").agg(
        F.sum("latitude").alias("latitude"),
        F.sum("longitude").alias("longitude"),
        F.count(F.lit(1)).alias("points"),
        F.sum("total_sales").alias("total_sales"),
        F.sum("total_volume_liters").alias("total_volume_liters"),
        # One row per store_number, so rows count stores.
        F.count("store_number").alias("store_count"),
    )
    return df.select(
        "city", "county",
        ratio(F.col("latitude"), F.col("points")).alias("latitude"),
        ratio(F.col("longitude"), F.col("points")).alias("longitude"),
        "total_sales", "total_volume_liters", "store_count",
        F.log1p(F.col("total_sales").cast("double")).alias("log_sales"),
    )


# 5: vendors


def _vendors(star: Star) -> DataFrame:
    return views.sales_by_vendor(star).select(
        "vendor_name", "total_sales", "total_margin", "total_bottles_sold", "sales_share_percent"
    )


def vendors(star: Star) -> DataFrame:
    return _vendors(star).orderBy(_desc("total_sales"), "vendor_name")


def top_vendors(star: Star, k: int = 15) -> DataFrame:
    return top(_vendors(star), k, _desc("total_sales"), "vendor_name")


# 6: products


def top_products(star: Star, by: str = "total_sales", k: int = 15) -> DataFrame:
    shown = F.coalesce("item_description", F.lit("None"))
    label = F.concat(shown, F.lit(" ("), F.col("item_number"), F.lit(")"))
    df = views.top_products(star).select(
        "item_number", "item_description", "category_name", "vendor_name", "total_sales",
        "total_bottles_sold", "total_margin", label.alias("product_label"),
    )
    return top(df, k, _desc(by), "item_number", "category_name", "vendor_name")


# 7: margins


def top_margins(
    star: Star, by: str = "avg_unit_margin", k: int = 20, min_sales: int = MIN_PRODUCT_SALES
) -> DataFrame:
    df = views.margin_analysis(star).select(
        "category_name", "item_description", "vendor_name", "avg_unit_margin", "total_margin",
        "total_sales",
    )
    ranked = df.dropna(subset=["avg_unit_margin", "total_margin", "total_sales"]).where(
        F.col("total_sales") >= min_sales
    )
    return top(ranked, k, _desc(by), "category_name", "vendor_name", "item_description")


# 8: category mix over time


def category_mix(star: Star, k: int = 10) -> DataFrame:
    """Months of the k largest categories with each one's percent among them."""
    df = views.category_months(star).where(F.col("category_name").isNotNull())
    largest = regroup(df.select("category_name", "total_sales"), "category_name")
    keep = top(largest, k, _desc("total_sales"), "category_name").select("category_name")
    # keep has k rows; the window then spans at most k rows per month.
    month = Window.partitionBy("year_month")
    share = ratio(F.col("total_sales") * F.lit(100), F.sum("total_sales").over(month))
    return (
        df.join(F.broadcast(keep), "category_name", "left_semi")
        .select(
            "year_month", "category_name", "total_sales", "total_margin",
            share.alias("month_percent"),
        )
        .orderBy("year_month", "category_name")
    )


# 9: volume against price


def volume_scatter(star: Star) -> DataFrame:
    return views.volume_vs_revenue(star)


def high_volume_low_price(
    star: Star, k: int = 20, quantile: float = HIGH_VOLUME_QUANTILE
) -> DataFrame:
    """Counties in the top volume quartile, cheapest litre first.

    The exact percentile keeps one number per county in its buffer, never sales.
    """
    df = views.volume_vs_revenue(star)
    volume = F.col("total_volume_liters").cast("double")
    threshold = df.agg(F.percentile(volume, quantile)).scalar()
    high = df.where(volume >= threshold).select(
        "county", "total_volume_liters", "sales_per_liter", "total_sales", "store_count"
    )
    return top(high, k, F.col("sales_per_liter").asc_nulls_last(), "county")


# 10: store averages by county


def county_store_averages(star: Star, k: int = 8) -> DataFrame:
    """Months of the k counties whose monthly store averages are highest on average."""
    df = views.avg_sales_per_store_by_month_region(star).where(F.col("county").isNotNull())
    means = df.groupBy("county").agg(F.avg("avg_sales_per_store").alias("mean"))
    keep = top(means, k, _desc("mean"), "county").select("county")
    return (
        df.join(F.broadcast(keep), "county", "left_semi")  # k rows
        .select("year_month", "state_name", "county", "avg_sales_per_store", "store_count")
        .orderBy("year_month", "county", "state_name")
    )


# 11: weekend against weekday


def day_types(star: Star, as_reference: bool = False) -> DataFrame:
    if as_reference:
        df = views.sales_by_day_type(star).select(
            "day_type", *SUMS, "sales_line_count", "invoice_count"
        )
        return regroup(df, "day_type").orderBy("day_type")
    days = star.dim_date.select(
        "date_key",
        F.when(F.col("is_weekend") == 1, "Weekend").otherwise("Weekday").alias("day_type"),
    )
    lines = star.fact.select("date_key", *LINE_MEASURES, "invoice_number").join(
        F.broadcast(days), "date_key"  # one row per calendar day
    )
    keys = ["day_type"]
    return fold(
        keys,
        totals(lines, *keys),
        distinct_count(lines, keys, "invoice_number", "invoice_count"),
    ).orderBy("day_type")


# 12: packaging


def _packaging(star: Star) -> DataFrame:
    return views.packaging_totals(star).select(
        "volume_group", "bottle_volume_ml", "pack", "total_sales", "total_bottles_sold",
        "total_margin",
    )


def packaging(star: Star) -> DataFrame:
    return _packaging(star).orderBy(_desc("total_sales"), "pack", "bottle_volume_ml")


def packaging_tree(star: Star, k: int = 30) -> DataFrame:
    """Sales of the k largest variants per group and volume, with the group totals."""
    largest = top(_packaging(star), k, _desc("total_sales"), "pack", "bottle_volume_ml")
    levels = largest.rollup("volume_group", "bottle_volume_ml").agg(
        F.grouping_id().alias("level"), F.sum("total_sales").alias("total_sales")
    )
    return levels.where(F.col("level") < 3).select(
        "volume_group", "bottle_volume_ml", "total_sales"
    )
