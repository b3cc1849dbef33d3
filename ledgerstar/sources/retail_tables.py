"""Landed sales text derived from order, line, customer, part and supplier tables.

Gives the engine a large input in the shape of its CSV parts: every value is text,
with the blanks, dollar signs, double spaces and missing coordinates that cleaning
has to deal with. One row per order line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F


# So many suppliers are sent to every task whole (about 64 bytes each); lines are then not dealt by supplier.
_FEW = 1_000_000


def _text(c: Column) -> Column:
    return c.cast("string")


def _padded(c: Column, width: int) -> Column:
    return F.lpad(_text(c), width, "0")


def _may_broadcast(spark: SparkSession) -> bool:
    """A session whose threshold is below zero wants no broadcasts."""
    return spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold() >= 0


def _joined(spark: SparkSession, folder: str) -> DataFrame:
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    # Every shuffle of lines carries as little as it can: lines meet suppliers and parts
    # while they are narrow, are numbered, and only then meet the wide order side. Nothing is
    # sorted after that join. Nations and regions are fixed lists.
    places = table("nation").join(
        table("region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    buyers = table("customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    orders = table("orders").join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    # Order and line number repeat in the source, and so may orders; the copies of a line
    # are told apart. Lines are counted by row, so copies of a part or supplier share a number.
    same_order = Window.partitionBy("o_orderkey")
    orders = orders.withColumns({
        "order_copy": F.row_number().over(same_order.orderBy("o_custkey", "o_orderdate", "o_orderpriority")),
        "order_copies": F.count(F.lit(1)).over(same_order),
    })
    same_line = Window.partitionBy("l_orderkey", "l_linenumber").orderBy(
        "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "line_row"
    )
    # Suppliers and parts are a small share of the lines: their side is hashed, so lines
    # are not sorted for them. A line that misses one is still counted, and goes afterwards.
    # Where suppliers are few (counted from the footers), numbered lines look them up in place.
    suppliers = table("supplier").withColumn("has_supplier", F.lit(True))
    parts = table("part").withColumn("has_part", F.lit(True)).hint("shuffle_hash")
    few = _may_broadcast(spark) and suppliers.count() <= _FEW
    lines = (
        table("lineitem")
        .withColumns({"line_row": F.monotonically_increasing_id(), "returned": F.col("l_returnflag") == "R"})
        .drop("l_returnflag")
    )
    met = F.col("l_suppkey") == F.col("s_suppkey")
    if not few:
        lines = lines.join(suppliers.hint("shuffle_hash"), met, "left")
    lines = (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
        .repartition("l_orderkey")
        .withColumn("line_number", F.dense_rank().over(same_line))
        .where("has_part")
    )
    lines = lines.join(F.broadcast(suppliers), met) if few else lines.where("has_supplier")
    # Lines and orders are the two large sides at any scale: always shuffle and merge
    # them. File sizes would let a small copy be broadcast and then run the whole chain in
    # the few tasks of one file. The order of the numbering serves the merge as well.
    copy = (F.col("line_number") - 1) * F.col("order_copies") + F.col("order_copy")
    joined = lines.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.withColumn("line_copy", copy)


def raw_sales(spark: SparkSession, folder: str) -> DataFrame:
    nation, buyer = F.col("c_nationkey"), F.col("c_custkey")
    volume = F.col("p_size") * 50
    litres = (
        (F.col("l_quantity").cast("bigint") * volume).cast("decimal(15,0)")
        * F.lit(0.001).cast("decimal(4,3)")
    ).cast("decimal(18,3)")
    retail = F.col("p_retailprice").cast("decimal(18,2)")
    sign = F.when(F.col("returned"), -1).otherwise(1)
    dollars = (F.col("l_extendedprice").cast("decimal(18,2)") * sign).cast("decimal(18,2)")
    invoice = F.concat(F.lit("inv-"), "l_orderkey", F.lit("-"), "l_linenumber")
    point = F.concat(
        F.lit("POINT (-"), nation + 90, F.lit("."), _padded(buyer % 1000, 3), F.lit(" "),
        nation + 30, F.lit("."), _padded(buyer % 997, 3), F.lit(")"),
    )
    thousands = F.concat(
        (volume / 1000).cast("int"), F.lit(","), _padded(volume % 1000, 3)
    )
    columns = {
        "Invoice Line No": F.when(
            F.col("l_linenumber") % 3 == 0, F.concat(F.lit("  "), invoice, F.lit(" "))
        ).otherwise(invoice),
        "Date": F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T00:00:00.000")),
        "Store": F.when(buyer % 97 == 0, "").otherwise(_text(buyer)),
        "Name": F.regexp_replace("c_name", "#", "  #"),
        "Address": F.concat(F.lit(" "), "o_orderpriority"),
        "City": F.concat(F.upper("n_name"), F.lit("-"), F.lower("c_mktsegment")),
        "Zipcode": F.when(
            buyer % 10 == 0, F.concat(F.lit("ZIP  "), buyer % 1000)
        ).otherwise(
            F.concat(F.lit(" "), _padded(buyer % 100000, 5), F.lit("-"), _padded(nation, 4))
        ),
        "Store Location": F.concat(
            "r_name", F.lit(":  "), F.when(nation % 5 == 0, "unmapped").otherwise(point)
        ),
        "County Number": _text(nation),
        "County": F.concat(F.lower("n_name"), F.lit(" ")),
        "Category": F.lower("p_type"),
        "Category Name": F.when(F.col("p_type") == "PROMO", "").otherwise(
            F.concat("p_type", F.lit("  goods"))
        ),
        "Vendor No": _text(F.col("l_suppkey")),
        "Vendor Name": F.col("s_name"),
        "Itemno": F.concat(F.lit("it"), "l_partkey"),
        "Im Desc": F.regexp_replace("p_name", " ", "  "),
        "Pack": F.concat(F.col("p_size") % 12, F.lit(".0")),
        "Bottle Volume ML": F.when(F.col("p_size") == 50, "")
        .when(volume >= 1000, thousands)
        .otherwise(_text(volume)),
        "State Bottle Cost": F.concat(F.lit("$"), retail - F.col("p_size")),
        "State Bottle Retail": F.concat(F.lit("$"), retail),
        "Sale Bottles": _text(F.col("l_quantity").cast("bigint")),
        "Sale Dollars": F.concat(F.lit("$"), dollars),
        "Sale Liters": _text(litres),
        "Sale Gallons": _text((litres * F.lit(0.264172).cast("decimal(7,6)")).cast("decimal(18,4)")),
    }
    return _joined(spark, folder).select(
        *[c.alias(n) for n, c in columns.items()],
        F.concat(
            F.lit("sales_"), F.year("o_orderdate"), F.lit("_part_"),
            _padded(F.col("l_orderkey") % 8, 3), F.lit(".csv"),
        ).alias("source_file"),
        # The line's number in the source, and which copy of the line it is.
        (
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 64 + F.col("line_copy")
        ).alias("staging_key"),
    )


def state_of(location: Column) -> Column:
    """The region in front of the colon stands for the state."""
    return F.split_part(location, F.lit(":"), F.lit(1))
