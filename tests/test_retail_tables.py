"""Landed rows from order tables: numbering of copies, and the shape of the joins."""

import datetime

from ledgerstar.sources import retail_tables
from ledgerstar.sources.retail_tables import raw_sales

TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string",
    "part": "p_partkey bigint, p_name string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_returnflag string",
}
DAY = datetime.datetime(2020, 1, 2)


def landed(spark, folder, lines, orders=((1, 5),), parts=(7, 8), suppliers=(3,)):
    rows = {
        "region": [(0, "ASIA")],
        "nation": [(2, "INDIA", 0)],
        "customer": [(5, "Customer#5", 2, "FURNITURE"), (6, "Customer#6", 2, "FURNITURE")],
        "supplier": [(s, f"Supplier#{s}") for s in suppliers],
        "part": [(p, f"part {p}", "LARGE", 2, 900.0) for p in parts],
        "orders": [(o, c, DAY, "5-LOW") for o, c in orders],
        "lineitem": [(o, p, s, n, 1.0, 10.0, "N") for o, p, s, n in lines],
    }
    for name, schema in TABLES.items():
        spark.createDataFrame(rows[name], schema).write.parquet(f"{folder}/{name}.parquet")
    return raw_sales(spark, str(folder))


def copies(raw):
    """(item, store, copy of the line), sorted."""
    return sorted((r["Itemno"], r["Store"], r["staging_key"] % 64) for r in raw.collect())


def test_copies_of_a_line_and_of_its_order_are_told_apart(spark, tmp_path):
    raw = landed(spark, tmp_path, [(1, 8, 3, 1), (1, 7, 3, 1), (1, 7, 3, 1)], orders=[(1, 5), (1, 6)])
    numbers = sorted(n for _, _, n in copies(raw))
    assert numbers == [1, 2, 3, 4, 5, 6]
    assert {n for item, _, n in copies(raw) if item == "it8"} == {5, 6}


def test_a_line_without_its_part_is_counted_and_dropped(spark, tmp_path):
    raw = landed(spark, tmp_path, [(1, None, 3, 1), (1, 7, None, 1), (1, 8, 3, 1)])
    assert copies(raw) == [("it8", "5", 3)]


def test_copies_of_a_part_share_the_number_of_the_line(spark, tmp_path):
    raw = landed(spark, tmp_path, [(1, 7, 3, 1), (1, 8, 3, 1)], parts=[7, 7, 8])
    assert copies(raw) == [("it7", "5", 1), ("it7", "5", 1), ("it8", "5", 2)]


def test_no_line_is_sorted_or_shuffled_after_it_has_met_its_order(spark, tmp_path):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = landed(spark, tmp_path, [(1, 7, 3, 1)])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    above, found, _ = text.partition("SortMergeJoin [l_orderkey")
    assert found
    assert not any(step in above for step in ("Window", "Sort ", "Exchange", "Join"))
    assert text.count("ShuffledHashJoin") == 2


def test_few_suppliers_are_looked_up_without_dealing_lines_by_supplier(spark, tmp_path, monkeypatch):
    lines = [(1, 7, 3, 1), (1, 7, None, 1), (1, 8, 3, 1), (1, None, 3, 2), (1, 8, 4, 2)]
    few = landed(spark, tmp_path / "few", lines, suppliers=[3, 3, 4])
    assert "hashpartitioning(l_suppkey" not in few._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(retail_tables, "_FEW", 2)
    many = landed(spark, tmp_path / "many", lines, suppliers=[3, 3, 4])
    assert "hashpartitioning(l_suppkey" in many._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, few.collect())) == sorted(map(str, many.collect()))
    assert copies(few) == [("it7", "5", 2), ("it7", "5", 2), ("it8", "5", 2), ("it8", "5", 3), ("it8", "5", 3)]
