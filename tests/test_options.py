"""Options beside the views: sketched counts, kept results, names without case."""

import pytest
from pyspark.sql import functions as F

from ledgerstar.plans import load, sketches, views
from ledgerstar.plans.kept import ViewKeeper
from ledgerstar.sources import tables
from tests.test_warehouse import ROWS, _raw




def test_merged_sketches_estimate_distinct_counts(spark, make_star):
    star = make_star([
        {"date": f"2023-{1 + i % 12:02d}-03", "store_number": str(i % 40), "item_number": f"I{i % 90}",
         "invoice_and_item_number": f"INV-{i % 700}"} for i in range(2000)
    ])
    months = sketches.monthly_sketches(star)
    exact = {n: star.fact.select(c).distinct().count() for n, c in sketches.COUNTED.items()}
    whole = sketches.approximate_kpis(months).first()
    plain = views.kpi_summary(star).first()
    for n, count in exact.items():
        assert abs(whole[n] - count) <= 1 + 4 * sketches.standard_error() * count
        assert plain[n] == count
    assert whole.total_sales == plain.total_sales and whole.sales_line_count == plain.sales_line_count
    quarters = sketches.merged(months, "quarter").collect()
    assert sorted((r.year, r.quarter) for r in quarters) == [(2023, q) for q in (1, 2, 3, 4)]
    assert sum(r.sales_line_count for r in quarters) == 2000
    per_store = sketches.monthly_sketches(star, "store_key")
    assert "store_count" not in per_store.columns
    stores = sketches.merged(per_store, "year", "store_key").collect()
    assert len(stores) == 40 and all(r.invoice_count <= 75 for r in stores)


def test_unions_do_not_read_the_fact(spark, make_star, tmp_path):
    star = make_star([{"date": "2023-01-03"}, {"date": "2023-04-03", "store_number": "2"}])
    months = tables.store(sketches.monthly_sketches(star), str(tmp_path / "sketches"))
    df = sketches.approximate_kpis(months, "year")
    assert df.first().store_count == 2
    assert all("sketches" in f for f in df.inputFiles())


def test_the_error_of_large_counts_is_bounded(spark):
    lines = spark.range(300_000).select(
        F.lit(202301).alias("m"), F.col("id").alias("a"), (F.col("id") % 70_000).alias("b"),
    )
    got = lines.groupBy("m").agg(
        *[F.hll_sketch_estimate(F.hll_sketch_agg(c, sketches.LG_K)).alias(c) for c in "ab"]
    ).first()
    for c, n in (("a", 300_000), ("b", 70_000)):
        assert abs(got[c] - n) <= 4 * sketches.standard_error() * n


# ---- kept views

def persisted(spark):
    return spark.sparkContext._jsc.getPersistentRDDs().size()


@pytest.fixture
def warehouse(spark, tmp_path):
    root = str(tmp_path / "wh")
    load.load_warehouse(spark, _raw(spark, ROWS), root, F.lit("S"))
    return root


def test_a_kept_view_is_read_again_without_a_scan(spark, warehouse):
    before = persisted(spark)
    now = [0.0]
    with ViewKeeper(spark, warehouse, seconds=300, clock=lambda: now[0]) as keeper:
        first = keeper.read("sales_by_store")
        assert first.count() == 2 and keeper.names() == ["sales_by_store"]
        again = keeper.read("sales_by_store")
        assert again is first and persisted(spark) == before + 1
        assert "InMemoryTableScan" in again._jdf.queryExecution().executedPlan().toString()
        now[0] = 299.0
        assert keeper.read("sales_by_store") is first
        now[0] = 300.0
        assert keeper.read("sales_by_store") is not first
        keeper.read("sales_by_vendor").count()
        now[0] = 601.0
        keeper.read("sales_by_month").count()
        assert keeper.names() == ["sales_by_month"] and persisted(spark) == before + 1
    assert persisted(spark) == before and keeper.names() == []


def test_a_new_version_is_seen_at_once(spark, warehouse):
    before = persisted(spark)
    keeper = ViewKeeper(spark, warehouse)
    old = keeper.read("sales_by_store")
    assert old.count() == 2
    load.load_warehouse(spark, _raw(spark, ROWS[:1]), warehouse, F.lit("S"))
    assert keeper.read("sales_by_store").count() == 1
    assert old.count() == 2  # who holds the old result computes it again from its version
    keeper.release()
    assert persisted(spark) == before


# ---- names without case

def test_names_without_case_share_a_group(make_star):
    star = make_star([
        {"vendor_number": "V1", "vendor_name": "Straße", "category": "C1", "category_name": "Vodka", "item_description": "x"},
        {"vendor_number": "V2", "vendor_name": "STRASSE", "category": "C2", "category_name": "VODKA", "item_number": "I2", "item_description": "X"},
        {"vendor_number": "V3", "vendor_name": "straße", "category": "C3", "category_name": None, "item_number": "I3", "item_description": "x "},
        {"vendor_number": "V4", "vendor_name": "STRASSE", "category": "C4", "category_name": None, "item_number": "I4", "item_description": "x"},
    ])
    plain = {r.vendor_name: r.sales_line_count for r in views.sales_by_vendor(star).collect()}
    assert plain == {"Straße": 1, "STRASSE": 2, "straße": 1}
    merged = {r.vendor_name: r.sales_line_count for r in views.sales_by_vendor(star, views.CASELESS).collect()}
    assert merged == {"Straße": 2, "STRASSE": 2}
    categories = views.sales_by_category(star, views.CASELESS).collect()
    assert {r.category_name: r.sales_line_count for r in categories} == {"VODKA": 2, None: 2}
    assert sum(r.sales_share_percent for r in categories) == 100
    for view in (views.top_products, views.margin_analysis):
        assert view(star, views.CASELESS).columns == view(star).columns
    assert views.margin_analysis(star).count() == 4


def test_natural_keys_agree_with_the_collation(spark, tmp_path):
    rows = [("a-1", "2023-01-01", "s1", "i7", "$5", "1", "f.csv", 1), ("a-2", "2023-01-02", "S1", "I7", "$6", "2", "f.csv", 2)]
    star = load.load_warehouse(spark, _raw(spark, rows), str(tmp_path / "wh"), F.lit("S"))
    assert star.dim_store.count() == 1 and star.dim_product.count() == 1
    assert star.fact.select("store_key").distinct().count() == 1
