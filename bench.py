"""Time the load and the headline queries; prints one JSON line.

The load (staging, dimensions, fact) is timed as its own entries, and the views and
reports then read the loaded tables, as they do in use.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINES = [
    "v1_sales_overview", "v3_sales_by_month", "v4_category_sales_over_time",
    "v5_sales_by_category", "v6_sales_by_store", "v11_top_products", "v12_margin_analysis",
    "v14_avg_sales_per_store_by_month_region", "v15_kpi_summary", "r4_cities",
    "r8_category_mix", "r9_table", "m3_staging_profile", "m16_check_list", "d2_dim_store",
    "x1_fact_sales",
]


def session() -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )


def main() -> None:
    from parity.catalog import QUERIES
    from parity.workspace import open_workspace

    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    took: dict[str, float] = {}

    def timed(name: str, work) -> None:
        start = time.perf_counter()
        work()
        took[name] = round(time.perf_counter() - start, 3)

    workspace = open_workspace(spark, FOLDER)
    timed("load_staging", lambda: workspace.staging)
    timed("load_dimensions", lambda: workspace.dimension("dim_date"))
    timed("load_fact", lambda: workspace.fact)
    for name in HEADLINES:
        query = QUERIES[name]
        timed(
            name, lambda: query(spark, FOLDER).write.format("noop").mode("overwrite").save()
        )
    print(
        json.dumps(
            {
                "metric": "load plus headline queries",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
