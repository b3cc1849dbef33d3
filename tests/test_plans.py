"""Plan shapes that have to survive a large input."""

import pytest

from ledgerstar.operators import dimensions
from ledgerstar.operators.fact import fact_sales
from ledgerstar.plans import quality, reports, views
from parity.workspace import open_workspace
from tests.conftest import SF


@pytest.fixture(scope="module")
def wh(spark):
    return open_workspace(spark, SF)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_is_computed_without_shuffle_or_join(wh):
    text = plan(fact_sales(wh.staging))
    assert "Exchange" not in text and "Join" not in text
    assert "IsNotNull(date)" in text


def test_dimensions_combine_staged_rows_without_sorting_them(wh):
    for build in (lambda: dimensions.dim_store(wh.staging, wh.state), lambda: dimensions.dim_product(wh.staging)):
        text = plan(build())
        below_first_exchange = text.rsplit("Exchange hashpartitioning", 1)[1]
        assert "HashAggregate" in below_first_exchange and "partial_max(" in below_first_exchange
        assert "Sort" not in below_first_exchange
        assert "Window" not in text


def test_a_sound_load_never_shuffles_fact_lines(spark, wh):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    wh.fact, wh.dim_store  # written before the setting changes
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        checked = quality.join_failures(wh)
        assert checked.first()[0] == 0
        text = plan(checked)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Join" not in text and "hashpartitioning" not in text


@pytest.mark.parametrize("name", list(views.VIEWS))
def test_views_hold_no_cross_join(wh, name):
    text = plan(views.VIEWS[name](wh))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Expand" not in text


def test_views_read_only_their_columns(wh):
    text = plan(views.sales_by_vendor(wh))
    assert "invoice_number" not in text and "source_row_hash" not in text


def test_rankings_keep_k_rows_per_task(wh):
    assert "TakeOrderedAndProject" in plan(reports.top_stores(wh))


def test_no_python_in_any_view(wh):
    for view in views.VIEWS.values():
        assert "Python" not in plan(view(wh))


def test_reports_build_no_unused_branches(wh):
    for report in (reports.category_mix, reports.city_map, reports.packaging):
        assert "invoice_number" not in plan(report(wh))


@pytest.mark.parametrize(
    "view", ["sales_by_month", "sales_by_day_type", "category_sales_over_time", "avg_sales_per_store_by_month_region"]
)
def test_a_month_filter_prunes_every_fact_branch(wh, view):
    scans = [
        line for line in plan(getattr(views, view)(wh).where("year_month = '1996-03'")).splitlines()
        if "FileScan" in line and "sale_month" in line
    ]
    assert scans
    for line in scans:
        assert "sale_month" in line.split("PartitionFilters: [")[1].split("], PushedFilters")[0]
