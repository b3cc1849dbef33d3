"""The six dimensions, each from all staged rows.

Surrogate keys are a function of the natural key (64-bit hash), so the fact can be keyed
without shuffling. Where several members hash alike, the least one has the hash as its key
and each other one a second hash; ``clashes`` lists those others, next to none, for the fact
to look up. All other members keep their keys, whatever clashes elsewhere.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerstar.functions import dates
from ledgerstar.functions.text import natural_key
from ledgerstar.operators.cleaning import landed_order
from ledgerstar.schemas import DIMENSION_KEYS, NATURAL_KEYS

_NUMBERING_BUCKETS = 256
# One day spans all values of a long, and one place the part of the row hash that fits.
_KEY_SPAN = 1 << 64
_TIE_SPAN = 10**11
# The packed packaging key and the calendar key cannot clash.
HASHED = [n for n in NATURAL_KEYS if n != "dim_packaging"]
# Staged columns of the natural keys of dimensions that take the latest row of each.
_STAGED = {"dim_store": "store_number", "dim_product": "item_number", "dim_category": "category", "dim_vendor": "vendor_number"}
# Marks of latest days: at most so many rows of four longs each, 64 million bits.
_MARK_ROWS = 1 << 18
_MARK_WORDS = 4


def _day() -> Column:
    """Days from the first one DateType knows, from 1; 0 for no date."""
    return F.coalesce(F.datediff("date", F.lit("0001-01-01").cast("date")), F.lit(-1)) + 1


def latest_candidates(staging: DataFrame, key: Column) -> DataFrame:
    """The rows that hold the latest day of their key, and some others; rows without a place count only among themselves.

    The latest day of each key comes from keys and days alone, which are hashed, so this shuffle is narrow. Each
    pair (key, latest day) sets one of 64 million bits, which every task gets; rows whose bit is not set
    cannot be the latest of their key and go before their attributes are shuffled. With more keys
    than bits more rows stay, up to all of them.
    """
    day = F.when(landed_order()[1].isNotNull(), _day())
    days = staging.groupBy(text_key(key).alias("of_key")).agg(F.max(day).alias("on_day"))

    def mark(of_key: Column, on_day: Column) -> Column:
        hashed = F.xxhash64(of_key, on_day)
        return F.struct(
            hashed.bitwiseAND(F.lit(_MARK_ROWS - 1)).alias("row"),
            F.shiftrightunsigned(hashed, 62).cast("int").alias("word"),
            F.shiftrightunsigned(hashed, 56).bitwiseAND(F.lit(63)).cast("int").alias("bit"),
        )

    marks = days.select(mark(F.col("of_key"), F.col("on_day")).alias("m")).select("m.*")
    words = [
        F.coalesce(F.bit_or(F.when(F.col("word") == w, F.expr("shiftleft(1L, bit)"))), F.lit(0)).alias(f"word{w}")
        for w in range(_MARK_WORDS)
    ]
    # never more than _MARK_ROWS rows, whatever the data
    held = marks.groupBy("row").agg(*words).withColumnRenamed("row", "mark_row")
    seen = staging.withColumn("mark", mark(text_key(key), day)).join(
        F.broadcast(held), F.col("mark.row") == F.col("mark_row")
    )
    word = F.array(*[f"word{w}" for w in range(_MARK_WORDS)])[F.col("mark.word")]
    return seen.where(F.bit_get(word, F.col("mark.bit")) == 1).select(*staging.columns)


def latest_version(staging: DataFrame, key: Column, key_name: str, attributes: dict) -> DataFrame:
    """surrogate, natural key and the attributes of its most recent row.

    Most recent means latest date, then last in the landed order (file, place in it), then
    largest row hash; a null date is the smallest. The rows are first reduced to one per key,
    version and file, with the largest (day, place, hash) packed into one decimal: a hash
    aggregate that needs no sort and sends a few rows per key and task, however many rows a
    key holds. The few versions are then dealt by the hash of the key, where the latest of each key is taken and
    keys that hash alike meet without another shuffle.
    """
    names = list(attributes)
    file, place_in_file = landed_order()
    day = _day()
    whole = "decimal(38,0)"
    moment = (
        day.cast("decimal(7,0)") * F.lit(str(_KEY_SPAN)).cast("decimal(20,0)")
        + place_in_file.cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")
    ).cast("decimal(27,0)")
    tie = F.pmod(F.xxhash64("source_row_hash"), F.lit(_TIE_SPAN))
    seen = (moment * F.lit(str(_TIE_SPAN)).cast("decimal(12,0)")).cast(whole) + tie.cast("decimal(11,0)")
    rows = staging.select(
        key.alias(key_name), *[c.alias(n) for n, c in attributes.items()], file.alias("of_file"),
        seen.cast(whole).alias("seen"),
    )
    versions = rows.groupBy(key_name, *names, "of_file").agg(F.max("seen").alias("seen"))
    seen_on = F.expr(f"seen div cast('{_KEY_SPAN * _TIE_SPAN}' as decimal(38,0))")
    dealt = versions.withColumn("hashed", text_key(key_name)).repartition("hashed")
    newest = dealt.groupBy("hashed", key_name).agg(F.max_by(F.struct(*names), F.struct(seen_on, "of_file", "seen")).alias("newest"))
    # next to always one member to a hash
    alike = newest.groupBy("hashed").agg(F.array_sort(F.collect_list(F.struct(key_name, "newest"))).alias("members"))
    members = alike.select("hashed", F.posexplode("members").alias("place", "member"))
    return members.select(
        F.when(F.col("place") == 0, F.col("hashed")).otherwise(second_key(f"member.{key_name}", "place")).alias("surrogate"),
        f"member.{key_name}", "member.newest.*",
    )


def text_key(*natural: str) -> Column:
    return F.xxhash64(*natural)


def second_key(natural: str, place: str) -> Column:
    """Key of a member whose hash a lesser one has taken."""
    return F.xxhash64(natural, F.lit("taken"), place)


def packaging_key(pack: Column, volume: Column) -> Column:
    """Both integers side by side in one long; unlike a hash this cannot clash."""
    return F.shiftleft(pack.cast("bigint"), 32).bitwiseOR(
        volume.cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF))
    )


def dim_date(staging: DataFrame) -> DataFrame:
    """Only days that occur in staging; gaps are reported by summary.calendar_coverage."""
    days = staging.where(F.col("date").isNotNull()).select("date").distinct()
    return days.select(*dates.calendar_columns(F.col("date")))


def dim_store(staging: DataFrame, state_name: Column) -> DataFrame:
    latest = latest_version(
        staging,
        natural_key(F.col("store_number")),
        "store_number",
        {
            "store_name": F.col("store_name"),
            "address": F.col("address"),
            "city": F.col("city"),
            "zip_code": F.col("zip_code"),
            "county": F.col("county"),
            "state_name": state_name,
            "source_store_location": F.col("store_location"),
            "latitude": F.col("latitude"),
            "longitude": F.col("longitude"),
        },
    )
    return latest.select(
        F.col("surrogate").alias("store_key"),
        "store_number",
        "store_name",
        F.lit(None).cast("string").alias("store_type"),
        "address",
        "city",
        "zip_code",
        "county",
        "state_name",
        "source_store_location",
        "latitude",
        "longitude",
    )


def _named_member(staging: DataFrame, source: str, key: str, natural: str, label: str) -> DataFrame:
    latest = latest_version(staging, natural_key(F.col(source)), natural, {label: F.col(label)})
    return latest.select(F.col("surrogate").alias(key), natural, label)


def dim_product(staging: DataFrame) -> DataFrame:
    return _named_member(staging, "item_number", "product_key", "item_number", "item_description")


def dim_category(staging: DataFrame) -> DataFrame:
    return _named_member(staging, "category", "category_key", "category_number", "category_name")


def dim_vendor(staging: DataFrame) -> DataFrame:
    return _named_member(staging, "vendor_number", "vendor_key", "vendor_number", "vendor_name")


def volume_group(volume: Column) -> Column:
    return (
        F.when(volume == 0, "unknown")
        .when(volume < 500, "small")
        .when(volume < 1000, "standard")
        .when(volume < 1750, "large")
        .otherwise("extra_large")
    )


def dim_packaging(staging: DataFrame) -> DataFrame:
    variants = staging.select(
        F.coalesce("pack", F.lit(0)).alias("pack"),
        F.coalesce("bottle_volume_ml", F.lit(0)).alias("bottle_volume_ml"),
    ).distinct()
    return variants.select(
        packaging_key(F.col("pack"), F.col("bottle_volume_ml")).alias("packaging_key"),
        "pack",
        "bottle_volume_ml",
        volume_group(F.col("bottle_volume_ml")).alias("volume_group"),
    )


def build(name: str, staging: DataFrame, state_name: Column, many: bool = False) -> DataFrame:
    """One dimension; of many rows only those that may be the latest of their key are shuffled."""
    if many and name in _STAGED:
        staging = latest_candidates(staging, natural_key(F.col(_STAGED[name])))
    if name == "dim_store":
        return dim_store(staging, state_name)
    return {
        "dim_date": dim_date,
        "dim_product": dim_product,
        "dim_category": dim_category,
        "dim_vendor": dim_vendor,
        "dim_packaging": dim_packaging,
    }[name](staging)


def clashes(dims: dict[str, DataFrame]) -> DataFrame:
    """table_name, taken, natural, surrogate: the members whose hash another one has as its key."""
    found = []
    for name in HASHED:
        natural, key = NATURAL_KEYS[name][0], DIMENSION_KEYS[name]
        hashed = text_key(natural)
        found.append(
            dims[name].where(F.col(key) != hashed).select(
                F.lit(name).alias("table_name"), hashed.alias("taken"), F.col(natural).alias("natural"),
                F.col(key).alias("surrogate"),
            )
        )
    return reduce(DataFrame.unionByName, found)


def key_clashes(dim: DataFrame, key: str) -> DataFrame:
    """Surrogate keys shared by more than one member."""
    return dim.groupBy(key).count().where(F.col("count") > 1)


def dense_keys(dim: DataFrame, name: str) -> DataFrame:
    """Replace the key by 1..n without sorting the members in one task.

    Members are spread by a hash of the natural key, numbered inside each bucket and
    shifted by the sizes of the buckets before; only one row per bucket meets in the
    running total.
    """
    natural = NATURAL_KEYS[name]
    spread = dim.withColumn("bucket", F.pmod(F.xxhash64(*natural), F.lit(_NUMBERING_BUCKETS)))
    sizes = spread.groupBy("bucket").agg(F.count(F.lit(1)).alias("members"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        "bucket", F.coalesce(F.sum("members").over(before), F.lit(0)).alias("shift")
    )
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy(*natural))
    # shifts has at most _NUMBERING_BUCKETS rows, whatever the data.
    numbered = spread.withColumn("rank", rank).join(F.broadcast(shifts), "bucket")
    key = DIMENSION_KEYS[name]
    return numbered.withColumn(key, F.col("shift") + F.col("rank")).select(*dim.columns)
