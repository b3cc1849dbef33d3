"""The sixteen semantic aggregates.

Common shape: add up the fact per surrogate key first, then join the dimension to
that much smaller result and add up again per attribute. Only distinct counts whose
attribute is not unique per key, and the line-grain overview, join fact lines.
Dimension joins carry no hint: Catalyst broadcasts by known size and sort-merges
otherwise. The one hint is for the calendar, whose size DateType bounds.

Names group as they are spelled. The views by category, vendor and product take a collation,
such as CASELESS, that puts spellings together; natural keys are in capitals from staging on,
so their hashes agree with it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ledgerstar.functions.dates import period_columns
from ledgerstar.functions.numbers import percent, ratio
from ledgerstar.operators.fact import FACT_PARTITION
from ledgerstar.operators.rollup import (
    LINE_MEASURES,
    count_rows,
    distinct_count,
    fold,
    one_row,
    regroup,
    totals,
)
from ledgerstar.plans.star import Star
from ledgerstar.schemas import DIMENSION_KEYS

PERIOD = ["year", "quarter", "month", "year_month"]
SUMS = ["total_sales", "total_bottles_sold", "total_volume_liters", "total_margin"]
MONTH = FACT_PARTITION
CASELESS = "UTF8_LCASE"


def _dated(star: Star, *columns: str, labels: tuple[str, ...] = ()) -> DataFrame:
    """Fact lines with their month (and calendar labels).

    The calendar has at most one row per day of DateType's range, a few million
    two-integer rows at worst and thousands in practice, so the broadcast is bounded.
    """
    lines = star.fact.select("date_key", MONTH, *columns)
    if not labels:
        return lines
    return lines.join(F.broadcast(star.dim_date.select("date_key", *labels)), "date_key")


def _with_period(df: DataFrame) -> DataFrame:
    """Replace the month by its calendar columns.

    They are functions of the month the fact is stored by, so a filter on them reaches the
    scan through the aggregates and leaves other months unread.
    """
    return df.withColumns(period_columns(F.col(MONTH))).drop(MONTH)


def _share_of_all(df: DataFrame) -> Column:
    """Percent of the sales of all groups; the total adds up the groups, computed once.

    Its subquery has the same aggregate below it, whose exchange is run once for both.
    """
    everything = df.agg(F.sum("total_sales"))
    return percent(F.col("total_sales"), everything.scalar())


def sales_overview(star: Star) -> DataFrame:
    lines = star.fact
    for name, key in DIMENSION_KEYS.items():
        lines = lines.join(star.dimension(name), key)
    # The columns of the overview in order.
    return lines.select(
        "date", "day", "month", "month_name_en", "month_name_pl", "day_name_en",
        "day_name_pl", "is_weekend", "quarter", "year", "year_month",
        "store_number", "store_name", "address", "city", "county", "state_name",
        "zip_code", "latitude", "longitude",
        "item_number", "item_description",
        "pack", "bottle_volume_ml", "volume_group",
        "category_number", "category_name", "vendor_number", "vendor_name",
        "invoice_number", "sales_line_count", "bottles_sold", "sale_dollars",
        "volume_sold_liters", "volume_sold_gallons", "state_bottle_cost",
        "state_bottle_retail", "margin_amount",
    )


def sales_by_day_type(star: Star) -> DataFrame:
    keys = [MONTH, "is_weekend"]
    lines = _dated(star, *LINE_MEASURES, "invoice_number", labels=("is_weekend",))
    folded = fold(
        keys,
        totals(lines, *keys),
        distinct_count(lines, keys, "invoice_number", "invoice_count"),
    )
    day_type = F.when(F.col("is_weekend") == 1, "Weekend").otherwise("Weekday")
    return _with_period(folded).select(
        *PERIOD, "is_weekend", day_type.alias("day_type"), *SUMS,
        "sales_line_count", "invoice_count",
    )


def sales_by_month(star: Star) -> DataFrame:
    lines = _dated(star, *LINE_MEASURES, "invoice_number", "store_key")
    folded = fold(
        [MONTH],
        totals(lines, MONTH),
        distinct_count(lines, [MONTH], "invoice_number", "invoice_count"),
        distinct_count(lines, [MONTH], "store_key", "store_count"),
    )
    return _with_period(folded).select(
        *PERIOD, *SUMS, "sales_line_count", "invoice_count", "store_count"
    )


def category_sales_over_time(star: Star) -> DataFrame:
    lines = _dated(star, *LINE_MEASURES, "invoice_number", "store_key", "category_key")
    names = star.dim_category.select("category_key", "category_name")
    keys = [MONTH, "category_name"]
    # Store pairs shrink to one row per period, category and store before the join;
    # invoices do not shrink, so their lines are joined as they are.
    stores = lines.select(MONTH, "category_key", "store_key").distinct()
    folded = fold(
        keys,
        regroup(
            totals(lines, MONTH, "category_key").join(names, "category_key").drop("category_key"),
            *keys,
        ),
        distinct_count(
            lines.select(MONTH, "category_key", "invoice_number").join(names, "category_key"),
            keys, "invoice_number", "invoice_count",
        ),
        distinct_count(stores.join(names, "category_key"), keys, "store_key", "store_count"),
    )
    return _with_period(folded).select(
        *PERIOD, "category_name", *SUMS, "sales_line_count", "invoice_count", "store_count"
    )


def _by_attribute(star: Star, name: str, *attributes: str, collation: str | None = None) -> DataFrame:
    """Totals per dimension attribute, through totals per surrogate key."""
    key = DIMENSION_KEYS[name]
    members = star.dimension(name).select(key, *attributes)
    return regroup(totals(star.fact, key).join(members, key).drop(key), *attributes, collation=collation)


def category_months(star: Star) -> DataFrame:
    """The additive totals of category_sales_over_time, without its distinct counts."""
    sums = totals(_dated(star, *LINE_MEASURES, "category_key"), MONTH, "category_key")
    names = star.dim_category.select("category_key", "category_name")
    named = regroup(sums.join(names, "category_key").drop("category_key"), MONTH, "category_name")
    return _with_period(named).select(*PERIOD, "category_name", *SUMS, "sales_line_count")


def sales_by_category(star: Star, collation: str | None = None) -> DataFrame:
    df = _by_attribute(star, "dim_category", "category_name", collation=collation)
    return df.select(
        "category_name", *SUMS, "sales_line_count",
        ratio(F.col("total_margin"), F.col("total_bottles_sold")).alias("avg_margin_per_bottle"),
        _share_of_all(df).alias("sales_share_percent"),
    )


def _per_member(star: Star, key: str) -> DataFrame:
    """Totals and invoice count per surrogate key."""
    return fold(
        [key],
        totals(star.fact, key),
        distinct_count(star.fact, [key], "invoice_number", "invoice_count"),
    )


def sales_by_store(star: Star) -> DataFrame:
    # store_number is unique per store_key, so the key groups are the store groups.
    return _per_member(star, "store_key").join(star.dim_store, "store_key").select(
        "store_number", "store_name", "city", "county", *SUMS,
        "sales_line_count", "invoice_count",
    )


def sales_by_vendor(star: Star, collation: str | None = None) -> DataFrame:
    df = _by_attribute(star, "dim_vendor", "vendor_name", collation=collation)
    return df.select(
        "vendor_name", "total_sales", "total_bottles_sold", "total_margin", "sales_line_count",
        _share_of_all(df).alias("sales_share_percent"),
    )


def sales_by_packaging(star: Star) -> DataFrame:
    # Pack and volume are unique per packaging_key.
    df = _per_member(star, "packaging_key").join(star.dim_packaging, "packaging_key")
    return df.select(
        "pack", "bottle_volume_ml", "volume_group", *SUMS, "sales_line_count", "invoice_count",
        _share_of_all(df).alias("sales_share_percent"),
    )


def _by_place(star: Star, *attributes: str) -> DataFrame:
    """Totals per place; each store is one row by then, so counting rows counts stores."""
    stores = totals(star.fact, "store_key").withColumn("store_count", F.lit(1).cast("bigint"))
    places = star.dim_store.select("store_key", *attributes)
    return regroup(stores.join(places, "store_key").drop("store_key"), *attributes)


def sales_by_geography(star: Star) -> DataFrame:
    place = ["state_name", "county", "city"]
    return _by_place(star, *place).select(*place, *SUMS, "sales_line_count", "store_count")


def _mapped(star: Star, stores: DataFrame) -> DataFrame:
    mapped = star.dim_store.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    return stores.join(mapped, "store_key").select(
        "store_number", "store_name", "state_name", "county", "city", "zip_code",
        "latitude", "longitude", *[c for c in stores.columns if c != "store_key"],
    )


def sales_map_points(star: Star) -> DataFrame:
    return _mapped(star, _per_member(star, "store_key")).select(
        "store_number", "store_name", "state_name", "county", "city", "zip_code",
        "latitude", "longitude", *SUMS, "sales_line_count", "invoice_count",
    )


def map_totals(star: Star) -> DataFrame:
    """The map points without their invoice counts, which cost a shuffle of invoices."""
    return _mapped(star, totals(star.fact, "store_key"))


def packaging_totals(star: Star) -> DataFrame:
    """The additive totals of sales_by_packaging."""
    return totals(star.fact, "packaging_key").join(star.dim_packaging, "packaging_key")


def _product_lines(star: Star, per_key: DataFrame) -> DataFrame:
    """Name the product, category and vendor of rows aggregated by their keys."""
    for name in ("dim_product", "dim_category", "dim_vendor"):
        per_key = per_key.join(star.dimension(name), DIMENSION_KEYS[name])
    return per_key


_PRODUCT_KEYS = ["product_key", "category_key", "vendor_key"]


def top_products(star: Star, collation: str | None = None) -> DataFrame:
    keys = ["item_number", "item_description", "category_name", "vendor_name"]
    out = ["total_sales", "total_bottles_sold", "total_margin", "sales_line_count"]
    named = _product_lines(star, totals(star.fact, *_PRODUCT_KEYS))
    return regroup(named.select(*keys, *out), *keys, collation=collation)


def margin_analysis(star: Star, collation: str | None = None) -> DataFrame:
    keys = ["category_name", "vendor_name", "item_description"]
    cost, retail = F.col("state_bottle_cost"), F.col("state_bottle_retail")
    per_key = star.fact.groupBy(*_PRODUCT_KEYS).agg(
        F.sum(cost).alias("cost"),
        F.sum(retail).alias("retail"),
        F.sum(retail - cost).alias("unit_margin"),
        F.count(cost).alias("cost_lines"),
        F.count(retail).alias("retail_lines"),
        F.count(retail - cost).alias("unit_margin_lines"),
        F.sum("margin_amount").alias("total_margin"),
        F.sum("sale_dollars").alias("total_sales"),
    )
    named = _product_lines(star, per_key).drop("item_number", "category_number", "vendor_number")
    sums = regroup(named.drop(*_PRODUCT_KEYS), *keys, collation=collation)

    def mean(of: str, name: str) -> Column:
        return ratio(F.col(of), F.col(f"{of}_lines")).alias(name)

    return sums.select(
        *keys,
        mean("cost", "state_bottle_cost"),
        mean("retail", "state_bottle_retail"),
        mean("unit_margin", "avg_unit_margin"),
        "total_margin",
        "total_sales",
    )


def volume_vs_revenue(star: Star) -> DataFrame:
    df = _by_place(star, "state_name", "county")
    return df.select(
        "state_name", "county", "total_volume_liters", "total_sales",
        ratio(F.col("total_sales"), F.col("total_volume_liters")).alias("sales_per_liter"),
        "store_count",
    )


def avg_sales_per_store_by_month_region(star: Star) -> DataFrame:
    keys = [MONTH, "state_name", "county"]
    lines = _dated(star, *LINE_MEASURES, "store_key")
    per_store = totals(lines, MONTH, "store_key").drop("sales_line_count")
    places = star.dim_store.select("store_key", "state_name", "county")
    df = regroup(
        per_store.withColumn("store_count", F.lit(1).cast("bigint"))
        .join(places, "store_key")
        .drop("store_key"),
        *keys,
    )
    stores = F.col("store_count")
    return _with_period(df).select(
        *PERIOD, "state_name", "county", "store_count", *SUMS,
        ratio(F.col("total_sales"), stores).alias("avg_sales_per_store"),
        ratio(F.col("total_bottles_sold"), stores).alias("avg_bottles_per_store"),
        ratio(F.col("total_volume_liters"), stores).alias("avg_volume_liters_per_store"),
        ratio(F.col("total_margin"), stores).alias("avg_margin_per_store"),
    )


def kpi_summary(star: Star) -> DataFrame:
    df = fold(
        [],
        totals(star.fact),
        distinct_count(star.fact, [], "invoice_number", "invoice_count"),
        distinct_count(star.fact, [], "store_key", "store_count"),
        distinct_count(star.fact, [], "product_key", "product_count"),
        distinct_count(star.fact, [], "category_key", "category_count"),
        distinct_count(star.fact, [], "vendor_key", "vendor_count"),
    )
    sales, invoices = F.col("total_sales"), F.col("invoice_count")
    return df.select(
        "total_sales", "total_margin", "sales_line_count", "total_bottles_sold",
        "total_volume_liters", "invoice_count", "store_count", "product_count",
        "category_count", "vendor_count",
        ratio(sales, invoices).alias("avg_invoice_value"),
        ratio(F.col("total_bottles_sold"), invoices).alias("avg_bottles_per_invoice"),
        percent(F.col("total_margin"), sales).alias("avg_margin_percent"),
        ratio(sales, F.col("store_count")).alias("sales_per_store"),
        ratio(sales, F.col("total_volume_liters")).alias("sales_per_liter"),
    )


def etl_status(star: Star, as_of: Column | None = None) -> DataFrame:
    generated = F.current_timestamp() if as_of is None else as_of

    def sized(df: DataFrame, name: str, *more: Column) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias(name), *more)

    date = F.col("date")
    return one_row(
        sized(
            star.staging, "staging_row_count",
            F.max("load_timestamp").alias("last_staging_load_timestamp"),
        ),
        sized(
            star.fact, "fact_row_count",
            F.max("load_timestamp").alias("last_fact_load_timestamp"),
        ),
        sized(
            star.dim_date, "dim_date_count",
            F.min(date).alias("min_date"), F.max(date).alias("max_date"),
        ),
        *[
            count_rows(star.dimension(n), f"{n}_count")
            for n in DIMENSION_KEYS
            if n != "dim_date"
        ],
    ).select(
        generated.alias("status_generated_at"),
        "staging_row_count", "fact_row_count",
        *[f"{n}_count" for n in DIMENSION_KEYS],
        "min_date", "max_date", "last_staging_load_timestamp", "last_fact_load_timestamp",
    )


VIEWS: dict[str, Callable[[Star], DataFrame]] = {
    f.__name__: f
    for f in (
        sales_overview, sales_by_day_type, sales_by_month, category_sales_over_time,
        sales_by_category, sales_by_store, sales_by_vendor, sales_by_packaging,
        sales_by_geography, sales_map_points, top_products, margin_analysis,
        volume_vs_revenue, avg_sales_per_store_by_month_region, kpi_summary, etl_status,
    )
}


def register_views(star: Star) -> None:
    """Make every view available to spark.sql as vw_<name>."""
    for name, view in VIEWS.items():
        view(star).createOrReplaceTempView(f"vw_{name}")
