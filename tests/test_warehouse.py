"""Dimensions, fact, checks and the whole load on small hand-made rows."""

import os
import random
import subprocess
import sys
import time
from datetime import timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerstar.operators import dimensions, fact
from ledgerstar.operators.fact import fact_sales, fact_sales_joined
from ledgerstar.plans import load, quality, reports, summary, views
from ledgerstar.plans.star import Star
from ledgerstar.schemas import DIMENSION_KEYS, NATURAL_KEYS
from ledgerstar.sources import tables
from ledgerstar.sources.versions import Conflict


def values(star, only=None):
    return {r.check_name: r.check_value for r in quality.quality_checks(star, only).collect()}


def test_latest_row_wins_and_undated_rows_lose(make_staging):
    staging = make_staging(
        [
            {"store_name": "old", "date": "2022-12-31", "staging_key": 9},
            {"store_name": "first", "date": "2023-01-01", "staging_key": 1},
            {"store_name": "second", "date": "2023-01-01", "staging_key": 2},
            {"store_name": "undated", "date": None, "staging_key": 99},
        ]
    )
    assert dimensions.dim_store(staging, F.lit("S")).first().store_name == "second"


def test_undated_rows_still_rank_by_key(make_staging):
    staging = make_staging(
        [{"store_name": n, "date": None, "staging_key": k} for n, k in (("a", 5), ("b", 3))]
    )
    assert dimensions.dim_store(staging, F.lit("S")).first().store_name == "a"


def test_dates_before_1970_rank_above_undated(make_staging):
    staging = make_staging(
        [{"store_name": "a", "date": None}, {"store_name": "b", "date": "0001-01-02"}]
    )
    assert dimensions.dim_store(staging, F.lit("S")).first().store_name == "b"


def test_empty_and_null_keys_share_unknown(make_staging):
    staging = make_staging([{"store_number": ""}, {"store_number": None}, {"store_number": "1"}])
    rows = dimensions.dim_store(staging, F.lit("S")).collect()
    assert sorted(r.store_number for r in rows) == ["1", "UNKNOWN"]


def test_latest_version_matches_brute_force_with_a_hot_key(make_staging):
    rng = random.Random(3)
    rows = []
    for i in range(600):
        hot = rng.random() < 0.4
        rows.append(
            {
                "vendor_number": "hot" if hot else f"v{rng.randint(0, 40)}",
                "vendor_name": f"n{rng.randint(0, 9)}" if rng.random() < 0.9 else None,
                "date": rng.choice([None, "2023-01-01", "2023-01-02", "1969-05-05"]),
                "staging_key": i,
            }
        )
    best = {}
    for r in rows:
        rank = (r["date"] or "", r["staging_key"])
        if r["vendor_number"] not in best or rank > best[r["vendor_number"]][0]:
            best[r["vendor_number"]] = (rank, r["vendor_name"])
    got = dimensions.dim_vendor(make_staging(rows)).collect()
    assert {r.vendor_number: r.vendor_name for r in got} == {k: v[1] for k, v in best.items()}


def test_volume_bands(make_staging):
    bands = {
        None: "unknown", 0: "unknown", 375: "small", 500: "standard", 999: "standard",
        1000: "large", 1749: "large", 1750: "extra_large", -1: "small",
    }
    staging = make_staging([{"bottle_volume_ml": v, "pack": None} for v in bands])
    got = {r.bottle_volume_ml: r.volume_group for r in dimensions.dim_packaging(staging).collect()}
    assert got == {v or 0: g for v, g in bands.items()}


def test_packaging_keys_never_clash(make_staging):
    pairs = [(p, v) for p in (-2, -1, 0, 1, 2**31 - 1, -(2**31)) for v in (-1, 0, 1, 2**31 - 1)]
    staging = make_staging([{"pack": p, "bottle_volume_ml": v} for p, v in pairs])
    dim = dimensions.dim_packaging(staging)
    assert dim.select("packaging_key").distinct().count() == len(pairs)


def test_dense_keys_are_gapless(make_staging):
    staging = make_staging([{"item_number": f"I{i}"} for i in range(700)])
    dim = dimensions.dense_keys(dimensions.dim_product(staging), "dim_product")
    assert sorted(r.product_key for r in dim.collect()) == list(range(1, 701))


def test_negative_rows_stay_out_and_nulls_become_zero(make_star):
    star = make_star(
        [
            {"sale_dollars": -1},
            {"bottles_sold": -1},
            {"volume_sold_liters": -1},
            {"sale_dollars": None, "bottles_sold": None, "volume_sold_liters": None},
            {"state_bottle_cost": None, "bottles_sold": 3},
        ]
    )
    rows = star.fact.orderBy("sales_key").collect()
    assert [r.sales_key for r in rows] == [3, 4]
    assert (rows[0].sale_dollars, rows[0].margin_amount) == (0, 0)
    assert rows[1].margin_amount == Decimal(24)
    checks = values(star)
    assert checks["raw_negative_measure_rows_excluded_from_fact"] == 3
    assert checks["eligible_staging_row_count"] == 2


def test_members_of_excluded_rows_exist(make_star):
    star = make_star([{"store_number": "gone", "sale_dollars": -5}, {}])
    assert {r.store_number for r in star.dim_store.collect()} == {"gone", "1"}


def test_looked_up_keys_give_the_same_fact(make_staging):
    rng = random.Random(5)
    staging = make_staging(
        [
            {
                "store_number": rng.choice(["", None, "1", "2"]),
                "item_number": f"I{rng.randint(0, 5)}",
                "vendor_number": rng.choice([None, "V"]),
                "pack": rng.choice([None, 1, 6]),
                "date": rng.choice([None, "2023-01-01", "2023-02-01"]),
                "sale_dollars": rng.choice([-1, 1, 2]),
            }
            for _ in range(80)
        ]
    )
    dims = {n: dimensions.build(n, staging, F.lit("S")) for n in DIMENSION_KEYS}
    dense = {n: dimensions.dense_keys(d, n) if n in NATURAL_KEYS else d for n, d in dims.items()}

    def named(fact, members):
        star = Star(staging=staging, fact=fact, **members)
        return sorted(map(str, views.sales_overview(star).collect()))

    assert named(fact_sales(staging), dims) == named(fact_sales_joined(staging, dense), dense)


def test_an_eligible_undated_row_fails_the_gate(make_star):
    star = make_star([{}, {"date": None}])
    assert values(star)["eligible_staging_fact_row_count_difference"] == 1
    with pytest.raises(ValueError, match="eligible_staging_fact_row_count_difference must equal 0"):
        quality.assert_quality(quality.quality_checks(star))


def test_gate_names_every_violation(make_star):
    star = make_star([{"sale_dollars": -1}])
    with pytest.raises(ValueError) as failed:
        quality.assert_quality(quality.quality_checks(star))
    assert "eligible_staging_row_count must be greater than 0" in str(failed.value)
    assert "fact_row_count must be greater than 0" in str(failed.value)


def altered(star, **tables_):
    parts = {n: getattr(star, n) for n in ("staging", "fact", *DIMENSION_KEYS)}
    return Star(**{**parts, **tables_})


def test_null_and_orphan_keys_are_counted_once_per_row(make_star):
    star = make_star([{}, {"store_number": "2"}, {"store_number": "3", "item_number": "I3"}])
    missing_two = altered(
        star,
        dim_store=star.dim_store.where("store_number = '1'"),
        dim_product=star.dim_product.where("item_number = 'I1'"),
    )
    assert values(missing_two)["fact_dimension_join_failures"] == 2
    nulled = altered(
        star,
        fact=star.fact.withColumn("vendor_key", F.when(F.col("sales_key") > 0, F.col("vendor_key"))),
    )
    checks = values(nulled)
    assert (checks["null_foreign_keys"], checks["fact_dimension_join_failures"]) == (1, 1)
    assert summary.null_keys(nulled).first().null_vendor_key == 1


@pytest.mark.parametrize("check, name", quality.DUPLICATES.items())
def test_repeated_natural_keys(make_star, check, name):
    star = make_star([{}])
    twice = altered(star, **{name: star.dimension(name).union(star.dimension(name))})
    assert values(twice, [check]) == {check: 1}


def test_negative_fact_and_sales_difference(make_star):
    star = make_star([{}, {}])
    off = altered(star, fact=star.fact.withColumn("sale_dollars", F.lit(-4).cast("decimal(18,4)")))
    checks = values(off)
    assert checks["negative_measures"] == 2
    assert checks["eligible_staging_vs_fact_sales_difference"] == 40


def test_zero_bottles_give_no_margin_per_bottle(make_star):
    row = views.sales_by_category(make_star([{"bottles_sold": 0}])).first()
    assert row.avg_margin_per_bottle is None
    assert row.sales_share_percent == 100


def test_views_of_an_empty_star(make_star):
    star = make_star([{"sale_dollars": -1}])
    row = views.kpi_summary(star).first()
    assert (row.total_sales, row.invoice_count, row.avg_invoice_value) == (None, 0, None)
    assert views.sales_by_month(star).count() == 0


def test_totals_agree_between_views(make_star):
    rng = random.Random(11)
    star = make_star(
        [
            {
                "store_number": f"{rng.randint(0, 6)}", "county": f"c{rng.randint(0, 2)}",
                "category": f"C{rng.randint(0, 4)}", "category_name": rng.choice(["x", "y", None]),
                "vendor_number": f"V{rng.randint(0, 4)}", "vendor_name": rng.choice(["x", "y"]),
                "item_number": f"I{rng.randint(0, 9)}", "item_description": "d",
                "date": f"2023-0{rng.randint(1, 3)}-1{rng.randint(0, 9)}",
                "sale_dollars": rng.randint(0, 90), "invoice_and_item_number": f"N{rng.randint(0, 30)}",
            }
            for _ in range(150)
        ]
    )
    total = views.kpi_summary(star).first().total_sales
    exempt = {"sales_overview", "etl_status", "kpi_summary", "sales_map_points"}
    for name, view in views.VIEWS.items():
        if name not in exempt:
            assert view(star).agg(F.sum("total_sales")).first()[0] == total, name
    shares = views.sales_by_vendor(star).agg(F.sum("sales_share_percent")).first()[0]
    assert abs(shares - 100) < Decimal("0.05")
    mix = reports.category_mix(star, k=10).groupBy("year_month").agg(F.sum("month_percent"))
    assert all(abs(r[1] - 100) < Decimal("0.001") for r in mix.collect())


def test_high_volume_threshold_is_the_exact_quartile(make_star):
    litres = {"a": 1, "b": 2, "c": 3, "d": 10}
    star = make_star(
        [
            {"store_number": c, "county": c, "volume_sold_liters": v}
            for c, v in litres.items()
        ]
    )
    assert [r.county for r in reports.high_volume_low_price(star).collect()] == ["d"]


def test_city_lists_its_counties(make_star):
    star = make_star(
        [
            {"store_number": str(i), "city": "Same", "county": c}
            for i, c in enumerate(["Polk", "Adair", "Polk", None])
        ]
    )
    row = reports.cities(star).first()
    assert (row.county, row.store_count) == ("Adair, Polk", 4)


def test_missing_days(make_star):
    star = make_star([{"date": "2023-01-01"}, {"date": "2023-01-04"}])
    assert summary.calendar_coverage(star).first().missing_calendar_days == 2
    assert [str(r.date) for r in summary.missing_days(star).collect()] == ["2023-01-02", "2023-01-03"]


def _raw(spark, rows):
    names = "invoice_line_no, date, store, itemno, sale_dollars, sale_bottles, source_file, staging_key"
    return spark.createDataFrame(
        rows, ", ".join(f"{n.strip()} {'bigint' if 'key' in n else 'string'}" for n in names.split(","))
    )


ROWS = [
    ("a-1", "2023-01-01", "1", "7", "$5.00", "1", "f.csv", 1),
    ("a-2", "2023-01-02", "", "8", "$6.00", "2", "f.csv", 2),
]


def test_load_publishes_only_checked_versions(spark, tmp_path):
    root = str(tmp_path / "wh")
    assert tables.current_version(spark, root) is None
    with pytest.raises(FileNotFoundError):
        tables.read_star(spark, root)
    load.load_warehouse(spark, _raw(spark, ROWS), root, F.lit("S"))
    first = tables.current_version(spark, root)
    undated = [("a-3", "soon", "1", "7", "$1", "1", "f.csv", 3)]
    with pytest.raises(ValueError):
        load.load_warehouse(spark, _raw(spark, ROWS + undated), root, F.lit("S"))
    assert tables.current_version(spark, root) == first
    load.load_warehouse(spark, _raw(spark, ROWS[:1]), root, F.lit("S"))
    assert tables.current_version(spark, root) != first
    assert tables.read_star(spark, root).fact.count() == 1
    assert tables.read_star(spark, root, first).fact.count() == 2


def test_members_that_hash_alike_get_a_second_key(spark, tmp_path, monkeypatch):
    rows = [
        (f"a-{i}", "2023-01-01", str(i % 12), f"I{i % 7}", "$2", "1", "f.csv", i) for i in range(100)
    ]
    plain = load.load_warehouse(spark, _raw(spark, rows), str(tmp_path / "plain"), F.lit("S"))

    def alike(natural):
        """Most members of every dimension share one hash."""
        c = F.col(natural) if isinstance(natural, str) else natural
        return F.when(c.rlike("[0-5]$"), F.lit(7)).otherwise(F.xxhash64(c)).cast("bigint")

    for module in (dimensions, fact):
        monkeypatch.setattr(module, "text_key", alike)
    root = str(tmp_path / "wh")
    star = load.load_warehouse(spark, _raw(spark, rows), root, F.lit("S"))
    for name, key, natural in (("dim_store", "store_key", "store_number"), ("dim_product", "product_key", "item_number")):
        before, after = ({r[natural]: r[key] for r in s.dimension(name).collect()} for s in (plain, star))
        assert len(set(after.values())) == len(after) and 7 in after.values()
        assert {n: k for n, k in after.items() if not n[-1] <= "5"} == {n: k for n, k in before.items() if not n[-1] <= "5"}
    listed = spark.read.parquet(tables.version_path(root, tables.current_version(spark, root), "key_clashes"))
    assert {r.table_name for r in listed.collect()} >= {"dim_store", "dim_product"}

    def named(star):
        return sorted(map(str, views.sales_overview(star).collect()))

    assert named(star) == named(plain) == named(tables.read_star(spark, root))
    plan = fact.fact_sales(star.staging, listed)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
    views.register_views(star)
    got = spark.sql("select store_number, total_sales from vw_sales_by_store").collect()
    assert sum(r[1] for r in got) == 200 and len(got) == 12


def test_two_second_keys_alike_stop_the_load(spark, tmp_path, monkeypatch):
    same = lambda *natural: F.lit(1).cast("bigint")
    monkeypatch.setattr(dimensions, "text_key", same)
    monkeypatch.setattr(dimensions, "second_key", lambda natural, place: F.lit(2).cast("bigint"))
    third = ("a-3", "2023-01-02", "3", "9", "$6.00", "2", "f.csv", 3)
    with pytest.raises(ValueError, match="same key"):
        load.load_warehouse(spark, _raw(spark, [*ROWS, third]), str(tmp_path / "wh"), F.lit("S"))
    assert tables.current_version(spark, str(tmp_path / "wh")) is None


def test_checks_are_measured_while_writing(spark, tmp_path, monkeypatch):
    rows = ROWS + [("a-3", "2023-01-05", "3", "7", "$-1", "1", "g.csv", 3), ("a-4", "2023-02-05", "3", "7", "", "1", "g.csv", 4)]

    with monkeypatch.context() as patch:
        for name in ("staging_measures", "fact_measures"):
            taken = getattr(quality, name)
            # once for the write; a scan would ask again
            asked = iter([taken()])
            patch.setattr(quality, name, lambda asked=asked: next(asked))
        root = str(tmp_path / "wh")
        load.load_warehouse(spark, _raw(spark, rows), root, F.lit("S"))
    star = tables.read_star(spark, root)
    assert sorted(map(tuple, load.version_checks(spark, root).collect())) == sorted(map(tuple, quality.quality_checks(star).collect()))


_RERUN = """
import sys
from pyspark import TaskContext
from pyspark.sql import Observation, SparkSession, functions as F
from ledgerstar.sources import tables
spark = (SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())

def once(batches):
    yield from batches
    if TaskContext.get().attemptNumber() == 0 and TaskContext.get().partitionId() % 2:
        raise RuntimeError("lost on the first try")

rows = spark.range(0, 4000, 1, 8).withColumn("m", F.col("id") % 3)
for by in (None, "m"):
    seen = Observation("o")
    failing = rows.mapInArrow(once, "id long, m long")
    if by is None:
        tables.write_table(failing, f"{sys.argv[1]}/{by}", by, (seen, [F.count(F.lit(1)).alias("n"), F.sum("id").alias("s")]))
    else:
        dealt = failing.hint("rebalance", F.col(by)).mapInArrow(once, "id long, m long")
        tables.write_table(dealt, f"{sys.argv[1]}/{by}", None, (seen, [F.count(F.lit(1)).alias("n"), F.sum("id").alias("s")]))
    assert seen.get == {"n": 4000, "s": sum(range(4000))}, seen.get
    assert spark.read.parquet(f"{sys.argv[1]}/{by}").count() == 4000
print("counted once")
"""


def test_a_task_run_again_is_measured_once(tmp_path):
    run = subprocess.run(
        [sys.executable, "-c", _RERUN, str(tmp_path)], capture_output=True, text=True, timeout=300,
        cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
    )
    assert "counted once" in run.stdout, run.stderr[-2000:]


def test_of_two_loads_at_once_one_is_published(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "wh")
    real = quality.assert_quality

    def meanwhile(checks):
        monkeypatch.setattr(quality, "assert_quality", real)
        load.load_warehouse(spark, _raw(spark, ROWS[:1]), root, F.lit("S"))
        return real(checks)

    monkeypatch.setattr(quality, "assert_quality", meanwhile)
    with pytest.raises(Conflict):
        load.load_warehouse(spark, _raw(spark, ROWS), root, F.lit("S"))
    assert tables.read_star(spark, root).fact.count() == 1


def test_old_and_failed_versions_are_removed(spark, tmp_path):
    root = str(tmp_path / "wh")
    load.load_warehouse(spark, _raw(spark, ROWS), root, F.lit("S"))
    old = tables.read_star(spark, root)
    with pytest.raises(ValueError):
        load.load_warehouse(spark, _raw(spark, [("a", "soon", "1", "7", "$1", "1", "f.csv", 3)]), root, F.lit("S"))
    load.load_warehouse(spark, _raw(spark, ROWS[:1]), root, F.lit("S"))
    assert tables.remove_old_versions(spark, root, timedelta(hours=1)) == []
    assert old.fact.count() == 2
    time.sleep(1.1)
    assert len(tables.remove_old_versions(spark, root, timedelta(seconds=0))) == 2
    assert tables.read_star(spark, root).fact.count() == 1


def test_a_large_table_is_written_by_value_without_being_dealt(spark, tmp_path, monkeypatch):
    rows = spark.range(0, 1200, 1, 4).withColumn("m", F.col("id") % 3)
    monkeypatch.setattr(tables, "DIRECT_ROWS", 1200)
    held = {n: tables.store(rows, str(tmp_path / str(n)), "m", rows=n) for n in (1199, 1200)}
    files = {n: len(list((tmp_path / str(n)).rglob("*.parquet"))) for n in held}
    assert files == {1199: 3, 1200: 12}
    assert sorted(held[1199].collect()) == sorted(held[1200].collect()) and held[1200].count() == 1200


def test_a_load_deals_the_fact_by_month_only_while_it_is_small(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "DIRECT_ROWS", 1)
    direct = load.load_warehouse(spark, _raw(spark, ROWS).repartition(2), str(tmp_path / "direct"), F.lit("S"))
    monkeypatch.undo()
    dealt = load.load_warehouse(spark, _raw(spark, ROWS).repartition(2), str(tmp_path / "dealt"), F.lit("S"))
    columns = [c for c in dealt.fact.columns if c != "load_timestamp"]
    assert sorted(direct.fact.select(columns).collect()) == sorted(dealt.fact.select(columns).collect())
    assert values(direct) == values(dealt)


def test_candidates_of_the_latest_row_give_the_same_dimensions(make_staging):
    rng = random.Random(5)
    rows = [
        {
            "store_number": rng.choice([None, "", "1", "2", "3", "4"]), "store_name": f"n{rng.randrange(4)}",
            "item_number": f"I{rng.randrange(30)}", "item_description": f"d{i}", "vendor_number": rng.choice([None, "7", "8"]),
            "vendor_name": f"v{rng.randrange(5)}", "category": f"C{rng.randrange(3)}", "category_name": f"c{i}",
            "date": rng.choice([None, "2023-01-01", f"2023-01-{rng.randrange(2, 28):02d}"]), "staging_key": rng.choice([None, i]),
        }
        for i in range(400)
    ]
    staging = make_staging(rows)
    for name in DIMENSION_KEYS:
        plain, narrowed = (dimensions.build(name, staging, F.lit("S"), many).collect() for many in (False, True))
        assert sorted(map(str, plain)) == sorted(map(str, narrowed))


def test_a_later_row_without_a_place_leaves_the_candidates_as_they_were(make_staging):
    rows = [{"store_name": "placed", "date": "2023-01-01"}, {"store_name": "no place", "date": "2023-02-01", "staging_key": None}]
    for many in (False, True):
        assert dimensions.build("dim_store", make_staging(rows), F.lit("S"), many).first().store_name == "placed"


def test_few_rows_that_cannot_be_the_latest_are_left(make_staging):
    staging = make_staging([{"item_number": f"I{i % 20}", "date": f"2023-{1 + i % 9:02d}-01"} for i in range(900)])
    left = dimensions.latest_candidates(staging, F.col("item_number"))
    assert left.columns == staging.columns
    assert sorted({(r["item_number"], r["date"].month) for r in left.collect()}) == sorted(
        (f"I{i}", 9) for i in range(20)
    )
