"""Whole refresh: staging, dimensions, fact, checks, publication."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from ledgerstar.operators import dimensions
from ledgerstar.operators.cleaning import clean_sales
from ledgerstar.operators.fact import FACT_PARTITION, fact_sales
from ledgerstar.plans import quality
from ledgerstar.plans.star import Star
from ledgerstar.schemas import DIMENSION_KEYS
from ledgerstar.sources.tables import store, store_all, version_log
from ledgerstar.sources.versions import new_version


# From so many staged rows on, rows that cannot be the latest of their key are left out before the shuffle.
MANY_ROWS = 10_000_000


def load_dimensions(
    staging: DataFrame, state_name: Column, path_of: Callable[[str], str]
) -> tuple[dict[str, DataFrame], DataFrame]:
    """All six dimensions, and the table of members that have a second hash as their key."""
    many = staging.count() >= MANY_ROWS
    built = {n: dimensions.build(n, staging, state_name, many) for n in DIMENSION_KEYS}
    dims = store_all(built, path_of)
    taken = store(dimensions.clashes(dims), path_of("key_clashes"))
    if not taken.isEmpty():
        _assert_unique(dims)
    return dims, taken


def _assert_unique(dims: dict[str, DataFrame]) -> None:
    """A second hash may be taken as well, in one of 2**64 cases; the load must not go on then."""
    found = [dimensions.key_clashes(dims[n], DIMENSION_KEYS[n]).select("count") for n in dimensions.HASHED]
    if not reduce(DataFrame.unionByName, found).isEmpty():
        raise ValueError("two members of a dimension have the same key")


def load_warehouse(
    spark: SparkSession,
    raw: DataFrame,
    root: str,
    state_name: Column,
    load_time: Column | None = None,
) -> Star:
    """Load landed rows into a new version, check it and publish it.

    A failed check raises and leaves the published version in place; so does another load
    that was published meanwhile. What the checks need of staging and of the fact is measured
    in the tasks that write them. The results of the checks are kept with the published
    version (`version_checks`).
    """
    log = version_log(spark, root)
    after, version = log.last_number(), new_version()

    def path_of(table: str) -> str:
        return f"{log.path(version)}/{table}"

    staged, lines = Observation("staging"), Observation("fact")
    staging = store(
        clean_sales(raw, load_time), path_of("staging"), measures=(staged, quality.staging_measures())
    )
    dims, taken = load_dimensions(staging, state_name, path_of)
    fact = store(
        fact_sales(staging, taken), path_of("fact"), by=FACT_PARTITION, measures=(lines, quality.fact_measures()),
        rows=staged.get["staging_row_count"],
    )
    star = Star(staging=staging, fact=fact, **dims)
    checks = quality.assert_quality(quality.quality_checks(star, measured={**staged.get, **lines.get}))
    log.publish(version, after, {"checks": [[r.check_name, str(r.check_value), r.result] for r in checks]})
    return star


def version_checks(spark: SparkSession, root: str) -> DataFrame:
    """sort_order, check_name, check_value, result of the published version, without reading it."""
    newest = version_log(spark, root).newest()
    if newest is None:
        raise FileNotFoundError(f"no published warehouse under {root}")
    rows = [(i, n, Decimal(v), r) for i, (n, v, r) in enumerate(newest.facts["checks"], start=1)]
    return spark.createDataFrame(
        rows, f"sort_order int, check_name string, check_value {quality.CHECK_VALUE}, result string"
    )
