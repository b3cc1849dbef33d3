"""Aggregation shapes shared by the views, reports, checks and summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Output name of each additive total and the fact column behind it.
TOTALS = {
    "total_sales": "sale_dollars",
    "total_bottles_sold": "bottles_sold",
    "total_volume_liters": "volume_sold_liters",
    "total_margin": "margin_amount",
    "sales_line_count": "sales_line_count",
}
LINE_MEASURES = list(TOTALS.values())


def totals(lines: DataFrame, *keys: str) -> DataFrame:
    """The five additive totals of fact lines."""
    return lines.groupBy(*keys).agg(*[F.sum(c).alias(n) for n, c in TOTALS.items()])


def regroup(df: DataFrame, *keys: str, collation: str | None = None) -> DataFrame:
    """Add up every column that is not a key (totals of totals).

    With a collation, keys that it takes for equal are one group, shown by the least of its
    spellings.
    """
    rest = [c for c in df.columns if c not in keys]
    sums = [F.sum(c).alias(c) for c in rest]
    if collation is None:
        return df.groupBy(*keys).agg(*sums)
    same = [F.collate(F.col(k), collation).alias(f"same_{k}") for k in keys]
    return df.groupBy(*same).agg(*[F.min(k).alias(k) for k in keys], *sums).select(*keys, *rest)


def distinct_count(df: DataFrame, keys: list[str], what: str, name: str) -> DataFrame:
    """COUNT(DISTINCT what) per key group; nulls do not count.

    Kept apart from the sums on purpose: a combined aggregate would shuffle every
    running sum with every distinct value, and two distinct counts would expand each
    row three times. Here only (keys, what) is shuffled, spread over both, so one
    large group does not land in one task.
    """
    values = df.where(F.col(what).isNotNull()).select(*keys, what).distinct()
    return values.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def fold(keys: list[str], *parts: DataFrame) -> DataFrame:
    """Put aggregates over the same keys side by side.

    A union and one more sum rather than joins: null keys meet, and absent counts
    become zero. Each part must have at most one row per key group.
    """
    counts = [c for p in parts[1:] for c in p.columns if c not in keys]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    folded = regroup(stacked, *keys)
    return folded.withColumns({c: F.coalesce(c, F.lit(0)) for c in counts})


def one_row(*parts: DataFrame) -> DataFrame:
    """Put one-row frames side by side without a cross join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def count_rows(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def top(df: DataFrame, k: int, by: Column, *ties: str) -> DataFrame:
    """First k rows; the tie columns make the choice repeatable."""
    return df.orderBy(by, *[F.col(t).asc_nulls_first() for t in ties]).limit(k)
