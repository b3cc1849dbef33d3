"""The fourteen checks and the gate behind every load."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Row, functions as F

from ledgerstar.functions.numbers import or_zero
from ledgerstar.operators.fact import SIGNED_MEASURES, has_negative, is_eligible
from ledgerstar.operators.rollup import count_if, count_rows, one_row
from ledgerstar.plans.star import Star
from ledgerstar.schemas import DIMENSION_KEYS, NATURAL_KEYS

CHECK_VALUE = "decimal(38,4)"
SALES_TOLERANCE = 0.01

# Check names in report order, and how each one is judged.
CHECKS = {
    "staging_row_count": "positive",
    "eligible_staging_row_count": "positive",
    "fact_row_count": "positive",
    "eligible_staging_fact_row_count_difference": "zero",
    "null_foreign_keys": "zero",
    "negative_measures": "zero",
    "duplicate_store_numbers": "zero",
    "duplicate_product_numbers": "zero",
    "duplicate_category_numbers": "zero",
    "duplicate_vendor_numbers": "zero",
    "duplicate_packaging_keys": "zero",
    "fact_dimension_join_failures": "zero",
    "raw_negative_measure_rows_excluded_from_fact": "info",
    "eligible_staging_vs_fact_sales_difference": "tolerance",
}
DUPLICATES = {
    "duplicate_store_numbers": "dim_store",
    "duplicate_product_numbers": "dim_product",
    "duplicate_category_numbers": "dim_category",
    "duplicate_vendor_numbers": "dim_vendor",
    "duplicate_packaging_keys": "dim_packaging",
}


def staging_measures() -> list[Column]:
    """What the checks need of the staging rows; also taken while staging is written."""
    eligible_sales = F.when(is_eligible(), or_zero(F.col("sale_dollars")))
    return [
        F.count(F.lit(1)).alias("staging_row_count"),
        count_if(is_eligible()).alias("eligible_staging_row_count"),
        count_if(has_negative()).alias("raw_negative_measure_rows_excluded_from_fact"),
        F.sum(eligible_sales).alias("eligible_sales"),
    ]


def _any(conditions: list[Column]) -> Column:
    return reduce(or_, conditions)


def fact_measures() -> list[Column]:
    """What the checks need of the fact lines; also taken while the fact is written."""
    null_key = _any([F.col(k).isNull() for k in DIMENSION_KEYS.values()])
    negative = _any([F.col(c) < 0 for c in SIGNED_MEASURES])
    return [
        F.count(F.lit(1)).alias("fact_row_count"),
        count_if(null_key).alias("null_foreign_keys"),
        count_if(negative).alias("negative_measures"),
        F.sum("sale_dollars").alias("fact_sales"),
    ]


def _staging_pass(star: Star) -> DataFrame:
    return star.staging.agg(*staging_measures())


def _fact_pass(star: Star) -> DataFrame:
    return star.fact.agg(*fact_measures())


def _measured(star: Star, values: dict) -> DataFrame:
    """Measures taken while writing, as the one row that the two passes would give."""
    kind = {"eligible_sales": "decimal(38,4)", "fact_sales": "decimal(38,4)"}
    return star.staging.sparkSession.range(1).select(
        *[F.lit(v).cast(kind.get(n, "bigint")).alias(n) for n, v in values.items()]
    )


def duplicate_keys(star: Star, name: str) -> DataFrame:
    """Natural keys that occur more than once."""
    return star.dimension(name).groupBy(*NATURAL_KEYS[name]).count().where(F.col("count") > 1)


def orphan_keys(star: Star, name: str) -> DataFrame:
    """Distinct fact keys that a dimension does not have; keys shrink inside each task."""
    key = DIMENSION_KEYS[name]
    members = star.dimension(name).select(key)
    held = star.fact.select(key).where(F.col(key).isNotNull()).distinct()
    return held.join(members, key, "left_anti")


def missing_members(star: Star) -> list[str]:
    """Dimensions that lack a key of the fact: one pass over the keys, reduced inside each task."""
    def keys(lines: DataFrame, named: dict[str, str]) -> DataFrame:
        pairs = [F.struct(F.lit(n).alias("name"), F.col(k).cast("bigint").alias("key")) for n, k in named.items()]
        return lines.select(F.explode(F.array(*pairs)).alias("p")).select("p.name", "p.key").where("key is not null")

    held = keys(star.fact, DIMENSION_KEYS).distinct()
    members = [keys(star.dimension(n), {n: k}) for n, k in DIMENSION_KEYS.items()]
    orphans = held.join(reduce(DataFrame.unionByName, members), ["name", "key"], "left_anti")
    return [r.name for r in orphans.select("name").distinct().collect()]


def join_failures(star: Star) -> DataFrame:
    """Number of fact rows that miss at least one dimension (a null key misses).

    Distinct keys are compared first. Only dimensions that miss some are then looked up
    line by line, so the lines of a sound load are never shuffled. Both ways give the
    same number.
    """
    lines = star.fact.select(*DIMENSION_KEYS.values())
    misses = [F.col(k).isNull() for k in DIMENSION_KEYS.values()]
    for name in missing_members(star):
        key, flag = DIMENSION_KEYS[name], f"no_{name}"
        orphans = orphan_keys(star, name).withColumn(flag, F.lit(True))
        lines = lines.join(orphans, key, "left")
        misses.append(F.col(flag).isNotNull())
    return lines.agg(count_if(_any(misses)).alias("fact_dimension_join_failures"))


# The passes each check reads; a duplicate check reads its dimension only.
_PASSES: dict[str, list[Callable[[Star], DataFrame]]] = {
    "staging_row_count": [_staging_pass],
    "eligible_staging_row_count": [_staging_pass],
    "fact_row_count": [_fact_pass],
    "eligible_staging_fact_row_count_difference": [_staging_pass, _fact_pass],
    "null_foreign_keys": [_fact_pass],
    "negative_measures": [_fact_pass],
    **{c: [lambda star, c=c: count_rows(duplicate_keys(star, DUPLICATES[c]), c)] for c in DUPLICATES},
    "fact_dimension_join_failures": [join_failures],
    "raw_negative_measure_rows_excluded_from_fact": [_staging_pass],
    "eligible_staging_vs_fact_sales_difference": [_staging_pass, _fact_pass],
}


def check_values(star: Star, names: list[str], measured: dict | None = None) -> DataFrame:
    """The named checks as one row: at most one pass over staging and one over the fact.

    With the measures taken while both were written there is none.
    """
    passes = list(dict.fromkeys(p for n in names for p in _PASSES[n]))
    if measured is not None:
        passes = [p for p in passes if p not in (_staging_pass, _fact_pass)]
    row = one_row(*([] if measured is None else [_measured(star, measured)]), *[p(star) for p in passes])

    def apart(left: str, right: str) -> Column:
        return F.abs(F.coalesce(left, F.lit(0)) - F.coalesce(right, F.lit(0)))

    differences = {
        "eligible_staging_fact_row_count_difference":
            ("eligible_staging_row_count", "fact_row_count"),
        "eligible_staging_vs_fact_sales_difference": ("eligible_sales", "fact_sales"),
    }
    return row.select(
        *[apart(*differences[n]).alias(n) if n in differences else F.col(n) for n in names]
    )


def _verdict(value: Column, rule: str) -> Column:
    passed = {
        "positive": value > 0,
        "zero": value == 0,
        "tolerance": value <= F.lit(SALES_TOLERANCE).cast(CHECK_VALUE),
    }.get(rule)
    if passed is None:
        return F.lit("INFO")
    return F.when(passed, "PASS").otherwise("FAIL")


def quality_checks(
    star: Star, only: list[str] | None = None, measured: dict | None = None
) -> DataFrame:
    """(sort_order, check_name, check_value, result), one row per check."""
    names = [n for n in CHECKS if only is None or n in only]
    results = []
    for order, (name, rule) in enumerate(CHECKS.items(), start=1):
        if name not in names:
            continue
        value = F.col(name).cast(CHECK_VALUE)
        results.append(
            F.struct(
                F.lit(order).alias("sort_order"),
                F.lit(name).alias("check_name"),
                value.alias("check_value"),
                _verdict(value, rule).alias("result"),
            )
        )
    return check_values(star, names, measured).select(F.inline(F.array(*results))).orderBy("sort_order")


# What the gate says about a failed check.
_MESSAGES: dict[str, Callable[[str], str]] = {
    "positive": lambda name: f"{name} must be greater than 0",
    "zero": lambda name: f"{name} must equal 0",
    "tolerance": lambda name: f"{name} must be <= {SALES_TOLERANCE}",
}


def assert_quality(checks: DataFrame) -> list[Row]:
    """The checks (at most fourteen rows), or one ValueError that names every violation."""
    rows = {r.check_name: r for r in checks.collect()}
    errors = [_MESSAGES[CHECKS[n]](n) for n, r in rows.items() if r.result == "FAIL"]
    eligible, loaded = (
        rows[n].check_value for n in ("eligible_staging_row_count", "fact_row_count")
    )
    if eligible != loaded:
        errors.append("eligible_staging_row_count must equal fact_row_count")
    if errors:
        raise ValueError("Quality checks failed: " + "; ".join(errors))
    return list(rows.values())
