"""Distinct counts by mergeable sketches, an option beside the exact ones.

One pass over the fact gives a row per month, or per month and further keys, with the additive
totals and one HyperLogLog sketch for every counted column. Quarters, years and the whole are
sums and unions of these rows, so none of them reads the fact again. A sketch with 2**lg_k
buckets is off by about 0.83 / sqrt(2**lg_k) of the count (one standard error); small counts
are next to exact.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ledgerstar.functions.dates import period_columns
from ledgerstar.functions.numbers import percent, ratio
from ledgerstar.operators.rollup import TOTALS
from ledgerstar.plans.star import Star
from ledgerstar.plans.views import MONTH

LG_K = 14
# What V15 counts, and the fact columns behind it.
COUNTED = {
    "invoice_count": "invoice_number",
    "store_count": "store_key",
    "product_count": "product_key",
    "category_count": "category_key",
    "vendor_count": "vendor_key",
}
GRAINS = {"month": ["year", "quarter", "month", "year_month"], "quarter": ["year", "quarter"], "year": ["year"], "all": []}


def standard_error(lg_k: int = LG_K) -> float:
    return 0.83 / math.sqrt(1 << lg_k)


def monthly_sketches(star: Star, *keys: str, lg_k: int = LG_K) -> DataFrame:
    """Totals and sketches per month and key; a small table to keep beside the fact.

    Sketches are built inside each task, so a task sends one row for every month and key.
    """
    sketches = [F.hll_sketch_agg(c, lg_k).alias(n) for n, c in COUNTED.items() if c not in keys]
    sums = [F.sum(c).alias(n) for n, c in TOTALS.items()]
    return star.fact.groupBy(MONTH, *keys).agg(*sums, *sketches)


def merged(sketches: DataFrame, grain: str = "all", *keys: str) -> DataFrame:
    """Totals and approximate counts per period of the grain and key."""
    counts = [n for n in COUNTED if n in sketches.columns]
    by = [*GRAINS[grain], *keys]
    return sketches.withColumns(period_columns(F.col(MONTH))).groupBy(*by).agg(
        *[F.sum(n).alias(n) for n in TOTALS],
        *[F.hll_sketch_estimate(F.hll_union_agg(n)).alias(n) for n in counts],
    )


def approximate_kpis(sketches: DataFrame, grain: str = "all") -> DataFrame:
    """The columns of views.kpi_summary per period, its counts estimated."""
    df = merged(sketches, grain)
    sales, invoices = F.col("total_sales"), F.col("invoice_count")

    def rate(top: Column, bottom: str, name: str) -> Column:
        return ratio(top, F.col(bottom)).alias(name)

    return df.select(
        *GRAINS[grain], "total_sales", "total_margin", "sales_line_count", "total_bottles_sold",
        "total_volume_liters", *COUNTED,
        rate(sales, "invoice_count", "avg_invoice_value"),
        ratio(F.col("total_bottles_sold"), invoices).alias("avg_bottles_per_invoice"),
        percent(F.col("total_margin"), sales).alias("avg_margin_percent"),
        rate(sales, "store_count", "sales_per_store"),
        rate(sales, "total_volume_liters", "sales_per_liter"),
    )
