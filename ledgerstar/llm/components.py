"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerstar.llm.common import stored


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """One step over (a, b): neighbours of a node move to the least of them and the node."""
    both = edges if small else edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least")).select(
        "a", F.least("a", "least").alias("least")
    )
    least = stored(least, "star-least")
    moved = both.join(least, "a").filter(F.lit(True) if small else F.col("b") > F.col("a")).select(
        F.col("b").alias("a"), F.col("least").alias("b")
    )
    if small:
        moved = moved.unionByName(least.select("a", F.col("least").alias("b")))
    return moved.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is the least node of a component.

    An edge table is written after each round, and rounds end when one changes nothing; a
    node with very many neighbours meets the aggregate first and a join that can be split.
    """
    held = stored(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    sign = _signature(held)
    while sign[0]:
        held = stored(_star(stored(_star(held, small=False), "large-star"), small=True), "small-star")
        last, sign = sign, _signature(held)
        if sign == last:
            break
    return held.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        held.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _signature(edges: DataFrame) -> tuple:
    """Count and two order-free digests of the edges."""
    return tuple(
        edges.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")),
            F.sum(F.xxhash64("b", "a").cast("decimal(20,0)")),
        ).first()
    )
