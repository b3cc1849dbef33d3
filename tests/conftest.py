from __future__ import annotations

import datetime
import tempfile
from decimal import Decimal

import pytest
from pyspark import SparkConf
from pyspark.sql import SparkSession, functions as F

from ledgerstar.operators import dimensions
from ledgerstar.operators.fact import fact_sales
from ledgerstar.plans.star import Star
from ledgerstar.schemas import DIMENSION_KEYS, STAGING_TYPES

SF = "/root/testdata/sf0.001"
STAGING_SCHEMA = ", ".join(f"{n} {t}" for n, t in STAGING_TYPES.items())


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
    )
    if not SparkConf().get("spark.checkpoint.dir"):
        builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="ledgerstar-"))
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def typed(name: str, value):
    kind = STAGING_TYPES[name]
    if value is None:
        return None
    if kind.startswith("decimal"):
        return Decimal(str(value))
    if kind == "date":
        return datetime.date.fromisoformat(value)
    return value


@pytest.fixture(scope="session")
def make_staging(spark):
    """Staging rows from dicts; absent measures and keys get plain defaults."""

    defaults = {
        "load_timestamp": datetime.datetime(2024, 1, 1),
        "source_file": "a.csv",
        "date": "2023-01-03",
        "store_number": "1",
        "item_number": "I1",
        "category": "C1",
        "vendor_number": "V1",
        "pack": 6,
        "bottle_volume_ml": 750,
        "state_bottle_cost": 5,
        "state_bottle_retail": 8,
        "bottles_sold": 2,
        "sale_dollars": 16,
        "volume_sold_liters": 1.5,
        "volume_sold_gallons": 0.4,
    }

    def make(rows: list[dict]):
        full = []
        for i, row in enumerate(rows):
            merged = {
                "staging_key": i, "invoice_and_item_number": f"INV-{i}", "source_row_hash": f"h{i}",
                **defaults, **row,
            }
            full.append(tuple(typed(n, merged.get(n)) for n in STAGING_TYPES))
        return spark.createDataFrame(full, STAGING_SCHEMA).coalesce(2).cache()

    return make


@pytest.fixture(scope="session")
def make_star(make_staging):
    def make(rows: list[dict]) -> Star:
        staging = make_staging(rows)
        dims = {
            n: dimensions.build(n, staging, F.lit("Here")).cache() for n in DIMENSION_KEYS
        }
        return Star(staging=staging, fact=fact_sales(staging).cache(), **dims)

    return make
