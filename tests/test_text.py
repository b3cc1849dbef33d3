"""Cleaning rules on hand-made values and against Python's own string functions."""

import datetime
import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerstar.functions import dates, geo, numbers, text
from ledgerstar.schemas import HASH_COLUMNS

NBSP = "\xa0"


def column(spark, values, expression):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, v string").select("i", expression(F.col("v")).alias("r"))
    return [r.r for r in df.orderBy("i").collect()]


@pytest.mark.parametrize(
    "header, name",
    [
        ("Sale (Dollars)", "sale_dollars"),
        (" Invoice/Item Number ", "invoice_item_number"),
        ("__x__", "x"),
    ],
)
def test_column_name(header, name):
    assert text.column_name(header) == name


def test_clean_text(spark):
    values = [f"{NBSP}x   y", "  ", "a\t\n b", None, "\x1cz\x1f", "　 "]
    assert column(spark, values, text.clean_text) == ["x y", None, "a b", None, "z", None]


def test_identifier(spark):
    assert column(spark, [" inv-1  a ", ""], text.identifier) == ["INV-1 A", None]


def test_proper_name(spark):
    cases = {
        "DES  MOINES": "Des Moines",
        "o'brien": "O'Brien",
        "st.charles": "St.Charles",
        "van buren 2nd": "Van Buren 2Nd",
        "ß eins": "Ss Eins",
        "  ": None,
    }
    assert column(spark, cases, text.proper_name) == list(cases.values())


def test_zip_code(spark):
    cases = {
        "50314-1234": "50314",
        "50314.0": "50314",
        "IA 503": "IA 503",
        "712-2": "712-2",
        " 5 0 3 1 4 ": "50314",
        "  ": None,
    }
    assert column(spark, cases, text.zip_code) == list(cases.values())


def test_text_rules_follow_python_strings(spark):
    rng = random.Random(7)
    alphabet = "aBcZéÄñ 09.-'#\t\n" + NBSP + " ДжΩ\x1d,$"
    values = ["".join(rng.choices(alphabet, k=rng.randint(0, 25))) for _ in range(400)]

    def squeeze(v):
        return re.sub(r"\s+", " ", v.strip()) or None

    assert column(spark, values, text.clean_text) == [squeeze(v) for v in values]
    titled = [squeeze(v) and squeeze(v).title() for v in values]
    assert column(spark, values, text.proper_name) == titled
    upper = [squeeze(v) and squeeze(v).upper() for v in values]
    assert column(spark, values, text.identifier) == upper


def test_coordinates(spark):
    values = [
        "POINT (-93.61378 41.60575)",
        "POINT (-93.6, 41.6)",
        "1 Main St (a) (-90 42)",
        "(41,2)",
        None,
    ]
    lon = [Decimal("-93.61378"), Decimal("-93.6"), Decimal(-90), None, None]
    lat = [Decimal("41.60575"), Decimal("41.6"), Decimal(42), None, None]
    assert column(spark, values, geo.longitude) == lon
    assert column(spark, values, geo.latitude) == lat


def test_dates(spark):
    cases = {
        "2023-01-01T00:00:00.000": datetime.date(2023, 1, 1),
        "2023-01-01": datetime.date(2023, 1, 1),
        "2023-01-01T23:30:00": datetime.date(2023, 1, 1),
        "1/31/2023": datetime.date(2023, 1, 31),
        "2023-01-01 tail": None,
        "bad": None,
        "": None,
    }
    assert column(spark, cases, dates.parse_date) == list(cases.values())


def test_numbers(spark):
    cases = {
        "$1,234.50": Decimal("1234.5"),
        "1e3": Decimal(1000),
        f"{NBSP}7 ": Decimal(7),
        f"1{NBSP}2": None,
        "(5.00)": None,
        "$-3.25": Decimal("-3.25"),
        "": None,
    }
    assert column(spark, cases, numbers.parse_number) == list(cases.values())
    assert column(spark, ["12.0", "x", "1,750"], numbers.parse_whole) == [12, None, 1750]


def test_row_hash_covers_landed_text(spark):
    values = {
        "invoice_and_item_number": "A", "date": None, "store_number": "", "item_number": "7",
        "sale_dollars": "$1", "bottles_sold": "2", "source_file": "f.csv",
    }
    import hashlib

    plain = "|".join(values[c] or "" for c in HASH_COLUMNS)
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{c} string" for c in values))
    got = df.select(text.row_hash(*[F.col(c) for c in HASH_COLUMNS])).first()[0]
    assert got == hashlib.sha256(plain.encode()).hexdigest()


def test_county_key_and_fips(spark):
    assert column(spark, ["Polk County", "Van-Buren", "County", "  ", None], text.county_key) == [
        "polk", "van buren", None, None, None,
    ]
    codes = ["77", "19153", "1000", "x1", " 5 ", "077", "0", "9" * 40]
    assert column(spark, codes, lambda c: text.county_fips(c, "19")) == [
        "19077", "19153", None, None, "19005", "19077", None, None,
    ]


def test_calendar(spark):
    df = spark.sql("select date'2023-01-03' as d").select(*dates.calendar_columns(F.col("d")))
    row = df.first().asDict()
    assert row["date_key"] == 20230103
    assert row["day_of_week"] == 3
    assert (row["day_name_en"], row["day_name_pl"]) == ("Tuesday", "wtorek")
    assert (row["month_name_en"], row["month_name_pl"]) == ("January", "styczen")
    assert (row["is_weekend"], row["year_month"], row["quarter"]) == (0, "2023-01", 1)


def test_ratio_guards_zero(spark):
    df = spark.sql("select cast(1 as decimal(18,4)) a, cast(0 as decimal(18,4)) z, 3 as n")
    row = df.select(
        numbers.ratio(F.col("a"), F.col("z")).alias("none"),
        numbers.ratio(F.col("a"), F.col("n")).alias("third"),
        numbers.percent(F.col("a"), F.col("n")).alias("pct"),
    ).first()
    assert (row.none, row.third, row.pct) == (None, Decimal("0.333333"), Decimal("33.33"))
