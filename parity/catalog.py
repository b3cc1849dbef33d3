"""Every registered query next to the DuckDB statement it is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import DecimalType

from ledgerstar.functions import dates, flags, geo, numbers, text
from ledgerstar.operators import cleaning, dimensions
from ledgerstar.operators.fact import FACT_PARTITION, fact_sales, fact_sales_joined, is_eligible, line_margin
from ledgerstar.operators.rollup import count_if, count_rows
from ledgerstar.plans import quality, reports, summary, views
from ledgerstar.plans.kept import ViewKeeper
from ledgerstar.plans.load import version_checks
from ledgerstar.plans.sketches import COUNTED, merged, monthly_sketches, standard_error
from ledgerstar.plans.star import Star
from ledgerstar.schemas import DIMENSION_KEYS, NATURAL_KEYS
from ledgerstar.sources import landing
from ledgerstar.sources.parts import open_parts
from ledgerstar.sources.tables import store, write_table
from parity import oracle_base as ob
from parity.workspace import LOAD_TIME, ODD_NAMES, PART_ROWS, Workspace, open_workspace

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, which both engines print alike."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, DecimalType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def add(name: str, build: Callable[[Workspace], DataFrame], sql: str | None = None) -> None:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return comparable(build(open_workspace(spark, folder)))

    QUERIES[name] = run
    if sql is not None:
        ORACLES[name] = sql


def doubles(names: str) -> str:
    """Select list that casts each name to double."""
    return ", ".join(f"cast({n} as double) as {n}" for n in names.split())


def table(w: Workspace, name: str) -> DataFrame:
    return w.spark.read.parquet(f"{w.folder}/{name}.parquet")


# Sources and sinks

_RAW = ["invoice_and_item_number", "date", "store_number", "sale_dollars", "bottles_sold"]
_RAW_SQL = """
  select case when l_linenumber % 3 = 0 then '  ' || invoice || ' ' else invoice end
      as invoice_and_item_number,
    landed_date as date,
    case when o_custkey % 97 = 0 then '' else cast(o_custkey as varchar) end as store_number,
    '$' || dollars as sale_dollars, cast(bottles as varchar) as bottles_sold
  from src"""


_PACKED = "*.csv.gz"


def _read_parts(w: Workspace, folder: str) -> DataFrame:
    files = landing.find_raw_files(w.spark, folder, pattern=_PACKED)
    return landing.read_raw(w.spark, files)


def _src(select: str) -> str:
    return f"with {ob.SOURCE.strip()} {select}"


add(
    "s1_csv_scan",
    lambda w: cleaning.conform_names(_read_parts(w, w.parts)).select(*_RAW),
    _src(_RAW_SQL),
)


def _manifest(w: Workspace) -> DataFrame:
    files = landing.find_raw_files(w.spark, w.parts, pattern=_PACKED)
    return landing.extract_manifest(w.spark, files, "1995-01-01", "2001-12-31", PART_ROWS)


def _written_manifest(w: Workspace) -> str:
    path = w.fresh("manifest")
    landing.write_manifest(_manifest(w), path)
    return path


_MANIFEST_SQL = _src(
    f"""select '1995-01-01' as start_date, '2001-12-31' as end_date,
    cast({PART_ROWS} as integer) as "limit", true as files_match, count(*) as total_rows from src"""
)


def _manifest_facts(manifest: DataFrame) -> DataFrame:
    return manifest.select(
        "start_date", "end_date", "limit",
        (F.col("file_count") == F.size("files")).alias("files_match"), "total_rows",
    )


def _selected_rows(w: Workspace) -> DataFrame:
    files = landing.find_raw_files(w.spark, w.parts, _written_manifest(w), _PACKED)
    return count_rows(landing.read_raw(w.spark, files), "row_count")


add("s2_file_selection", _selected_rows, _src("select count(*) as row_count from src"))
add(
    "s3_date_slice",
    lambda w: landing.slice_raw(
        cleaning.conform_names(w.raw()), "1996-03-01", "1997-06-30", must_match=False
    ).select(*_RAW),
    _src(f"select * from ({_RAW_SQL}) where left(date, 10) between '1996-03-01' and '1997-06-30'"),
)
# The same days from a set of parts, of which only those with such days are opened.
add(
    "s3_pruned_slice",
    lambda w: cleaning.conform_names(
        open_parts(w.spark, _set_root(w)).slice("1996-03-01", "1996-03-31")
    ).select(*_RAW),
    _src(f"select * from ({_RAW_SQL}) where left(date, 10) between '1996-03-01' and '1996-03-31'"),
)


def _set_root(w: Workspace) -> str:
    return w.part_set.folder.split("/sets/")[0]


def _rechunked(w: Workspace) -> DataFrame:
    limit = 1000
    path = w.fresh("rechunked")
    landing.write_parts(_read_parts(w, w.parts).drop("source_file", "staging_key"), path, limit, packed=True)
    sizes = landing.rows_per_file(_read_parts(w, path))
    return sizes.agg(
        F.sum("rows").alias("row_count"), (F.max("rows") <= limit).alias("within_limit")
    )


add(
    "s4_rechunk",
    _rechunked,
    _src("select count(*) as row_count, true as within_limit from src"),
)
add("s5_manifest", lambda w: _manifest_facts(_manifest(w)), _MANIFEST_SQL)


def _file_rows(w: Workspace) -> DataFrame:
    """The manifest table of parts whose folders name their source files."""
    parts = landing.file_manifest(w.spark, w.named_parts, pattern="*.csv")
    return parts.withColumn("source_file", F.regexp_extract(landing.decoded("file"), "of_file=([^/]*)/", 1)).drop("file")


add(
    "s5_rows_per_file",
    _file_rows,
    _src(
        """select source_file, count(*) as rows, count(*) as dated_rows,
        min(left(landed_date, 10)) as first_day, max(left(landed_date, 10)) as last_day
        from src group by source_file"""
    ),
)
add(
    "s5_set_summary",
    lambda w: open_parts(w.spark, _set_root(w)).summary.join(
        w.part_set.manifest.agg(
            F.sum("dated_rows").alias("dated_rows"), F.min("first_day").alias("first_day"),
            F.max("last_day").alias("last_day"), (F.max("rows") <= PART_ROWS).alias("within_limit"),
        )
    ).drop("generated_at_utc", "file_count"),
    _src(
        f"""select '1990-01-01' as start_date, '2010-12-31' as end_date, {PART_ROWS} as "limit",
        count(*) as total_rows, count(*) as dated_rows, min(left(landed_date, 10)) as first_day,
        max(left(landed_date, 10)) as last_day, true as within_limit from src"""
    ),
)

_STAGING_TEXT = (
    "source_file invoice_and_item_number store_number store_name address city zip_code "
    "store_location county_number county category category_name vendor_number vendor_name "
    "item_number item_description source_row_hash"
)
_STAGING_NUMBERS = (
    "proof state_bottle_cost state_bottle_retail bottles_sold sale_dollars volume_sold_liters "
    "volume_sold_gallons latitude longitude"
)


def _stg(select: str) -> str:
    return ob.with_tables(select, level="staging")


_STAGING_SQL = _stg(
    f"""select staging_key, load_timestamp, date, pack, bottle_volume_ml,
    {", ".join(_STAGING_TEXT.split())}, {doubles(_STAGING_NUMBERS)} from stg"""
)
add("s6_staging_scan", lambda w: w.staging.drop("source_position"), _STAGING_SQL)

_FACT_MEASURES = (
    "bottles_sold sale_dollars volume_sold_liters volume_sold_gallons state_bottle_cost "
    "state_bottle_retail margin_amount"
)
_FACT_SQL = ob.with_tables(
    f"""select sales_key, cast(strftime(date, '%Y%m%d') as integer) as date_key, invoice_number,
    source_row_hash, sales_line_count, {doubles(_FACT_MEASURES)}, load_timestamp from fact""",
    level="fact",
)
_SURROGATES = [k for k in DIMENSION_KEYS.values() if k != "date_key"]
add("s7_warehouse_scan", lambda w: w.fact.drop(*_SURROGATES, FACT_PARTITION), _FACT_SQL)


def _view_sql(name: str) -> str:
    cols = {
        "sales_overview": (
            "date day month month_name_en month_name_pl day_name_en day_name_pl is_weekend "
            "quarter year year_month store_number store_name address city county state_name "
            "zip_code item_number item_description pack bottle_volume_ml volume_group "
            "category_number category_name vendor_number vendor_name invoice_number "
            "sales_line_count",
            "latitude longitude " + _FACT_MEASURES,
        ),
    }
    if name in cols:
        plain, amounts = cols[name]
        return ob.with_tables(
            f"select {', '.join(plain.split())}, {doubles(amounts)} from {name}", name
        )
    return ob.with_tables(f"select {_amounts(name)} from {name}", name)


_AMOUNTS = {
    "total_sales", "total_bottles_sold", "total_volume_liters", "total_margin",
}


def _amounts(name: str, extra: str = "") -> str:
    """All columns, with the decimal ones replaced by doubles."""
    have = [a for a in sorted(_AMOUNTS) if f"as {a}" in ob.VIEWS[name]]
    if name == "sales_map_points":
        have += ["latitude", "longitude"]
    if not have:
        return "*"
    return "* replace (" + ", ".join(f"cast({a} as double) as {a}" for a in have) + ")"


def _view_scan(w: Workspace) -> DataFrame:
    views.sales_by_day_type(w).createOrReplaceTempView("vw_sales_by_day_type")
    return flags.normalize_weekend(w.spark.table("vw_sales_by_day_type"))


add("s8_view_scan", _view_scan, _view_sql("sales_by_day_type"))


def _kept_view(w: Workspace) -> DataFrame:
    """The second read of a kept view."""
    keeper = ViewKeeper(w.spark, w.warehouse)
    keeper.read("sales_by_month").count()
    return keeper.read("sales_by_month")


add("s8_kept_view", _kept_view, _view_sql("sales_by_month"))


def _refreshed(w: Workspace) -> DataFrame:
    path = w.fresh("staging")
    write_table(cleaning.clean_sales(w.raw()), path)
    return count_rows(w.spark.read.parquet(path), "row_count")


add("k1_staging_refresh", _refreshed, _src("select count(*) as row_count from src"))
_COUNTS_SQL = " union all ".join(
    f"select 'dw.{n}' as table_name, count(*) as row_count from {n}" for n in DIMENSION_KEYS
)
add(
    "k2_full_refresh",
    lambda w: summary.dimension_counts(w.published).unionByName(
        count_rows(w.published.fact, "row_count").withColumn("table_name", F.lit("dw.fact"))
    ),
    ob.with_tables(
        _COUNTS_SQL + " union all select 'dw.fact' as table_name, count(*) as row_count from fact"
    ),
)


add(
    "k1_duplicate_sales_keys",
    lambda w: count_rows(
        w.fact.groupBy("sales_key").count().where(F.col("count") > 1), "duplicates"
    ),
    ob.with_tables(
        "select count(*) as duplicates from (select sales_key from fact group by 1 having count(*) > 1)"
    ),
)


def _published_parts(w: Workspace) -> DataFrame:
    path = w.fresh("published-parts")
    landing.write_parts(w.raw().drop("source_file", "staging_key"), path, PART_ROWS, packed=True)
    return count_rows(_read_parts(w, path), "row_count")


add("k3_part_publish", _published_parts, _src("select count(*) as row_count from src"))
add(
    "k3_replaced_parts",
    lambda w: cleaning.conform_names(open_parts(w.spark, _set_root(w)).rows()).select(*_RAW),
    _src(_RAW_SQL),
)


def _exported(w: Workspace) -> DataFrame:
    path = w.fresh("export")
    report = reports.vendors(w)
    landing.write_csv(report, path)
    return w.spark.read.schema(report.schema).options(**landing.CSV_OPTIONS).csv(path)


_VENDOR_COLUMNS = """vendor_name, cast(total_sales as double) as total_sales,
    cast(total_margin as double) as total_margin,
    cast(total_bottles_sold as double) as total_bottles_sold, sales_share_percent"""
_VENDORS_SQL = ob.with_tables(f"select {_VENDOR_COLUMNS} from sales_by_vendor", "sales_by_vendor")
add("k4_csv_export", _exported, _VENDORS_SQL)
add(
    "k5_manifest_sink",
    lambda w: _manifest_facts(landing.read_manifest(w.spark, _written_manifest(w))),
    _MANIFEST_SQL,
)

# Cleaning

_SPACES = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}"
    r"\x{205f}\x{3000}]+"
)


def _clean_sql(column: str) -> str:
    return f"nullif(trim(regexp_replace({column}, '{_SPACES}', ' ', 'g')), '')"


_HEADERS = ["Invoice Line No", "Store", "Sale Dollars"]


def _header_names(w: Workspace) -> DataFrame:
    raw = w.raw().select(*_HEADERS)
    return raw.toDF(*[text.column_name(c) for c in raw.columns])


add(
    "t1_column_names",
    _header_names,
    _src(
        f"""select invoice_and_item_number as invoice_line_no, store_number as store,
        sale_dollars from ({_RAW_SQL})"""
    ),
)
add(
    "t2_column_aliases",
    lambda w: cleaning.conform_names(w.raw().select(*_HEADERS)),
    _src(f"select invoice_and_item_number, store_number, sale_dollars from ({_RAW_SQL})"),
)
add(
    "t3_lineage",
    lambda w: w.staging.groupBy("source_file", "load_timestamp").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("staging_key").alias("first_key"),
        F.max("staging_key").alias("last_key"),
    ),
    _stg(
        """select source_file, load_timestamp, count(*) as row_count,
        min(staging_key) as first_key, max(staging_key) as last_key from stg group by 1, 2"""
    ),
)


def _odd_landing(w: Workspace) -> DataFrame:
    """Rows of files with odd names and two headers, cleaned, with their place among the rows of their file."""
    staged = cleaning.clean_extracts(landing.read_extracts(w.spark, [w.odd_parts]), F.lit(LOAD_TIME).cast("timestamp"))
    shown = ["invoice_and_item_number", "date", "store_number", "sale_dollars", "bottles_sold", "latitude", "longitude"]
    landed = store(staged.select("staging_key", "source_file", "source_position", *shown), w.fresh("odd-staging"))
    return cleaning.number_lines(landed, "line").select("source_file", "line", *shown)


_ODD_NAMES = "case l_orderkey % 4 " + " ".join(f"when {i} then '{n}'" for i, n in enumerate(ODD_NAMES)) + " end"
add(
    "t3_odd_names_and_headers",
    _odd_landing,
    _stg(
        f"""select source_file, row_number() over (partition by source_file order by staging_key) as line,
        invoice_and_item_number, date, store_number, cast(sale_dollars as double) as sale_dollars,
        cast(bottles_sold as double) as bottles_sold, cast(latitude as double) as latitude,
        cast(longitude as double) as longitude
        from (select * replace ({_ODD_NAMES} as source_file) from (
          select stg.*, cast(split_part(invoice_and_item_number, '-', 2) as bigint) as l_orderkey from stg))"""
    ),
)
add(
    "t4_coordinates",
    lambda w: w.raw().select(
        geo.longitude(F.col("Store Location")).alias("longitude"),
        geo.latitude(F.col("Store Location")).alias("latitude"),
    ),
    _stg("select cast(longitude as double) as longitude, cast(latitude as double) as latitude from stg"),
)
_CONFORMED = ["staging_key", "store_number", "sale_dollars", "proof", "latitude", "pack"]
add(
    "t5_conformance",
    lambda w: cleaning.conform_columns(
        cleaning.conform_names(w.raw().select(*_HEADERS, "staging_key"))
    ).select(*_CONFORMED),
    _src(
        """select line_key as staging_key,
        case when o_custkey % 97 = 0 then '' else cast(o_custkey as varchar) end as store_number,
        '$' || dollars as sale_dollars, cast(null as varchar) as proof,
        cast(null as varchar) as latitude, cast(null as varchar) as pack from src"""
    ),
)
_HASHED = ["staging_key", "invoice_and_item_number", "source_row_hash"]
add(
    "t6_row_hash",
    lambda w: w.staging.select(*_HASHED),
    _stg(f"select {', '.join(_HASHED)} from stg"),
)
add(
    "t7_identifier",
    lambda w: table(w, "pages").select(
        "page_id", text.identifier(F.concat(F.lit(" \t"), "url", F.lit("\xa0"))).alias("identifier")
    ),
    f"select page_id, upper({_clean_sql('url')}) as identifier from pages",
)
add(
    "t8_proper_name",
    lambda w: table(w, "documents").select("doc_id", text.proper_name(F.col("text")).alias("name")),
    f"select doc_id, {ob.title(_clean_sql('text'))} as name from documents",
)
add(
    "t9_clean_text",
    lambda w: table(w, "documents").select("doc_id", text.clean_text(F.col("text")).alias("cleaned")),
    f"select doc_id, {_clean_sql('text')} as cleaned from documents",
)
add(
    "t10_zip_code",
    lambda w: table(w, "customer").select(
        "c_custkey",
        text.zip_code(F.col("c_name")).alias("name_digits"),
        text.zip_code(F.concat(F.lit(" IA "), F.col("c_custkey") % 120000)).alias("zip_code"),
    ),
    """select c_custkey, left(regexp_extract(c_name, '[0-9]+'), 5) as name_digits,
    case when c_custkey % 120000 >= 10000 then left(cast(c_custkey % 120000 as varchar), 5)
      else 'IA ' || (c_custkey % 120000) end as zip_code from customer""",
)


def _messy_dates(w: Workspace) -> DataFrame:
    day = F.col("o_orderdate")
    kind = F.col("o_orderkey") % 5
    written = (
        F.when(kind == 0, F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss.SSS"))
        .when(kind == 1, F.date_format(day, "yyyy-MM-dd"))
        .when(kind == 2, F.date_format(day, "MM/dd/yyyy"))
        .when(kind == 3, F.concat(F.lit("about "), F.date_format(day, "yyyy-MM-dd")))
        .otherwise("")
    )
    return table(w, "orders").select("o_orderkey", dates.parse_date(written).alias("date"))


add(
    "t11_date",
    _messy_dates,
    """select o_orderkey, case when o_orderkey % 5 in (0, 1, 2) then cast(o_orderdate as date) end
    as date from orders""",
)


def _messy_amounts(w: Workspace) -> DataFrame:
    amount = F.col("o_totalprice").cast("decimal(18,2)")
    kind = F.col("o_orderkey") % 5
    written = (
        F.when(kind == 0, F.concat(F.lit(" $"), F.format_number(amount, 2)))
        .when(kind == 1, F.concat(amount, F.lit(" ")))
        .when(kind == 2, F.concat(F.lit("("), amount, F.lit(")")))
        .when(kind == 3, F.concat(F.lit("$-"), amount))
        .otherwise("n/a")
    )
    return table(w, "orders").select("o_orderkey", numbers.parse_number(written).alias("amount"))


add(
    "t12_number",
    _messy_amounts,
    """select o_orderkey, case o_orderkey % 5
      when 0 then cast(cast(o_totalprice as decimal(18,2)) as double)
      when 1 then cast(cast(o_totalprice as decimal(18,2)) as double)
      when 3 then -cast(cast(o_totalprice as decimal(18,2)) as double) end as amount
    from orders""",
)
_NULLABLE = _STAGING_TEXT.split()
add(
    "t13_empty_to_null",
    lambda w: w.staging.agg(
        *[count_if(F.col(c).isNull()).alias(f"null_{c}") for c in _NULLABLE],
        *[count_if(F.col(c) == "").alias(f"empty_{c}") for c in _NULLABLE],
    ),
    _stg(
        "select "
        + ", ".join(f"count(*) filter ({c} is null) as null_{c}" for c in _NULLABLE)
        + ", "
        + ", ".join(f"cast(0 as bigint) as empty_{c}" for c in _NULLABLE)
        + " from stg"
    ),
)
add(
    "t14_staging_types",
    lambda w: cleaning.clean_sales(w.raw(), F.lit(LOAD_TIME).cast("timestamp")).drop("source_position"),
    _STAGING_SQL,
)

# Dimensions and fact

_DIM_COLUMNS = {
    "dim_date": "*",
    "dim_store": "* replace (cast(latitude as double) as latitude, cast(longitude as double) as longitude)",
}
for _i, _name in enumerate(DIMENSION_KEYS, start=1):
    _key = [] if _name == "dim_date" else [DIMENSION_KEYS[_name]]
    add(
        f"d{_i}_{_name}",
        lambda w, n=_name, k=_key: dimensions.build(n, w.staging, w.state).drop(*k),
        ob.with_tables(f"select {_DIM_COLUMNS.get(_name, '*')} from {_name}", level="dims"),
    )


def _numbered(w: Workspace) -> DataFrame:
    parts = []
    for name in NATURAL_KEYS:
        key = DIMENSION_KEYS[name]
        parts.append(
            dimensions.dense_keys(w.dimension(name), name).agg(
                F.count(F.lit(1)).alias("members"),
                F.min(key).alias("lowest"),
                F.max(key).alias("highest"),
                F.countDistinct(key).alias("keys"),
            ).withColumn("table_name", F.lit(name))
        )
    return summary.stack(parts)


add(
    "d7_surrogate_keys",
    _numbered,
    ob.with_tables(
        " union all ".join(
            f"select '{n}' as table_name, count(*) as members, cast(1 as bigint) as lowest, "
            f"count(*) as highest, count(*) as keys from {n}"
            for n in NATURAL_KEYS
        ),
        level="dims",
    ),
)
_UNKNOWN_SQL = ob.with_tables(
    " union all ".join(
        f"select 'dw.{n}' as table_name, count(*) as unknown_rows from {n} where {k} = 'UNKNOWN'"
        for n, k in (
            ("dim_store", "store_number"), ("dim_product", "item_number"),
            ("dim_category", "category_number"), ("dim_vendor", "vendor_number"),
        )
    ),
    level="dims",
)
add(
    "d8_unknown_member",
    lambda w: w.dim_store.where("store_number = 'UNKNOWN'").drop("store_key"),
    ob.with_tables(
        f"select {_DIM_COLUMNS['dim_store']} from dim_store where store_number = 'UNKNOWN'",
        level="dims",
    ),
)


def _beyond_fact(w: Workspace) -> DataFrame:
    """Members whose rows were all excluded from the fact."""
    return summary.stack(
        [
            w.dimension(n)
            .join(w.fact.select(k).distinct(), k, "left_anti")
            .agg(F.count(F.lit(1)).alias("members_without_sales"))
            .withColumn("table_name", F.lit(n))
            for n, k in DIMENSION_KEYS.items()
        ]
    )


def _beyond_sql(name: str) -> str:
    natural = NATURAL_KEYS.get(name, ["date"])
    match = " and ".join(f"f.{c} = d.{c}" for c in natural)
    return (
        f"select '{name}' as table_name, count(*) as members_without_sales from {name} d "
        f"where not exists (select 1 from fact f where {match})"
    )


add(
    "d9_members_without_sales",
    _beyond_fact,
    ob.with_tables(" union all ".join(_beyond_sql(n) for n in DIMENSION_KEYS)),
)
add("d10_dimension_counts", summary.dimension_counts, ob.with_tables(_COUNTS_SQL, level="dims"))

add("x1_fact_sales", lambda w: fact_sales(w.staging).drop(*_SURROGATES, FACT_PARTITION), _FACT_SQL)


def _joined_fact(w: Workspace) -> DataFrame:
    dims = {
        n: dimensions.dense_keys(w.dimension(n), n) if n in NATURAL_KEYS else w.dimension(n)
        for n in DIMENSION_KEYS
    }
    return fact_sales_joined(w.staging, dims).drop(*_SURROGATES, FACT_PARTITION)


add("x1_fact_sales_joined", _joined_fact, _FACT_SQL)
_ELIGIBLE_COLUMNS = "invoice_and_item_number, date, store_number"
add(
    "x2_eligible_rows",
    lambda w: w.staging.where(is_eligible()).select(
        "invoice_and_item_number", "date", "store_number", "sale_dollars"
    ),
    _stg(
        f"""select {_ELIGIBLE_COLUMNS}, cast(sale_dollars as double) as sale_dollars
        from stg where {ob.ELIGIBLE}"""
    ),
)
add(
    "x3_margin",
    lambda w: w.staging.select("staging_key", line_margin().alias("margin_amount")),
    _stg(f"select staging_key, cast({ob.MARGIN} as double) as margin_amount from stg"),
)

# Semantic views


def _view(name: str) -> Callable[[Workspace], DataFrame]:
    if name == "etl_status":
        return lambda w: views.etl_status(w, F.lit(LOAD_TIME).cast("timestamp"))
    return views.VIEWS[name]


for _i, _name in enumerate(views.VIEWS, start=1):
    add(f"v{_i}_{_name}", _view(_name), _view_sql(_name))


def _estimated(grain: str, keys: str) -> Query:
    """Sketched counts beside exact ones: whether each is within four standard errors, and the sums."""
    def run(w: Workspace) -> DataFrame:
        by = keys.split()
        sketched = merged(monthly_sketches(w), grain)
        lines = w.fact.join(w.dim_date.select("date_key", *by), "date_key") if by else w.fact
        exact = lines.groupBy(*by).agg(*[F.countDistinct(c).alias(f"exact_{n}") for n, c in COUNTED.items()])
        both = sketched.join(exact, by) if by else sketched.join(exact)
        apart = [F.abs(F.col(n) - F.col(f"exact_{n}")) <= F.ceil(4 * standard_error() * F.col(f"exact_{n}")) for n in COUNTED]
        return both.select(
            *by, "total_sales", "total_margin", "sales_line_count", *[F.col(f"exact_{n}").alias(n) for n in COUNTED],
            *[c.alias(f"near_{n}") for c, n in zip(apart, COUNTED)],
        )

    return run


_COUNTED_SQL = {
    "invoice_count": "invoice_number", "store_count": "store_number", "product_count": "item_number",
    "category_count": "category_number", "vendor_count": "vendor_number",
}
for _grain, _keys in (("quarter", "year quarter"), ("year", "year"), ("all", "")):
    _by = "".join(f"{k}, " for k in _keys.split())
    add(
        f"v15_sketched_{_grain}",
        _estimated(_grain, _keys),
        ob.with_tables(
            f"select {_by}cast(sum(sale_dollars) as double) as total_sales, "
            "cast(sum(margin_amount) as double) as total_margin, count(*) as sales_line_count, "
            + ", ".join(f"count(distinct {c}) as {n}, true as near_{n}" for n, c in _COUNTED_SQL.items())
            + " from flat" + (f" group by {_by[:-2]}" if _by else "")
        ),
    )


def _mixed_case(w: Workspace) -> Star:
    """The star with names that several members share in different spellings."""
    def spelt(name: str, key: str) -> Column:
        few = F.concat(F.lit("Name "), F.length(name) % 3, F.lit(" of "), F.substring(F.md5(key), 1, 1))
        return F.when(F.substring(F.md5(key), 2, 1) < "8", F.upper(few)).otherwise(few)

    def named(dim: str, name: str, key: str) -> DataFrame:
        return w.dimension(dim).withColumn(name, spelt(name, key))

    others = {n: w.dimension(n) for n in DIMENSION_KEYS}
    return Star(staging=w.staging, fact=w.fact, **others | {
        "dim_category": named("dim_category", "category_name", "category_number"),
        "dim_vendor": named("dim_vendor", "vendor_name", "vendor_number"),
        "dim_product": named("dim_product", "item_description", "item_number"),
    })


def _spelt_sql(view: str, names: list[str]) -> str:
    """The view over lower-cased names, each group shown by its least spelling."""
    spelt = {
        n: f"(case when substr(md5({k}), 2, 1) < '8' then upper(w_{n}) else w_{n} end)"
        for n, k in (("category_name", "category_number"), ("vendor_name", "vendor_number"), ("item_description", "item_number"))
    }
    wide = ", ".join(
        f"'Name ' || (length({n}) % 3) || ' of ' || substr(md5({k}), 1, 1) as w_{n}"
        for n, k in (("category_name", "category_number"), ("vendor_name", "vendor_number"), ("item_description", "item_number"))
    )
    renamed = ", ".join(f"{v} as {n}" for n, v in spelt.items())
    flat = (
        f"mixed as materialized (select * replace ({renamed}) from (select *, {wide} from flat)), "
        f"folded as materialized (select * replace ({', '.join(f'lower({n}) as {n}' for n in names)}), "
        f"{', '.join(f'{n} as spelt_{n}' for n in names)} from mixed)"
    )
    body = ob.VIEWS[view].replace("from flat", "from folded")
    shown = ", ".join(f"min(spelt_{n}) as shown_{n}" for n in names)
    body = body.replace("select ", f"select {shown}, ", 1)
    columns = _amounts(view)
    extra = columns[len("* replace ("):-1] + ", " if columns != "*" else ""
    return ob.with_tables(
        f"select * exclude ({', '.join(f'shown_{n}' for n in names)}) "
        f"replace ({extra}{', '.join(f'shown_{n} as {n}' for n in names)}) from ({body})"
    ).replace("\nselect * exclude", f",\n{flat}\nselect * exclude", 1)


for _name, _names in (
    ("sales_by_category", ["category_name"]), ("sales_by_vendor", ["vendor_name"]),
    ("top_products", ["item_description", "category_name", "vendor_name"]),
    ("margin_analysis", ["category_name", "vendor_name", "item_description"]),
):
    add(
        f"hz1_{_name}_caseless",
        lambda w, n=_name: views.VIEWS[n](_mixed_case(w), collation=views.CASELESS),
        _spelt_sql(_name, _names),
    )

# Reports


def _from_view(select: str, view: str, *more: str) -> str:
    return ob.with_tables(select, view, *more)


_D = doubles
add(
    "r0_kpi_header",
    reports.kpi_header,
    _from_view(
        f"""select {_D("total_sales total_margin")}, avg_margin_percent, sales_line_count,
        invoice_count, store_count, product_count, avg_invoice_value from kpi_summary""",
        "kpi_summary",
    ),
)
add(
    "r0_dataset_status",
    lambda w: reports.dataset_status(w, _manifest(w)).drop("generated_at_utc", "file_count"),
    _from_view(
        """select '1995-01-01' as start_date, '2001-12-31' as end_date,
        staging_row_count as total_rows, fact_row_count, dim_store_count, dim_product_count,
        min_date, max_date, last_fact_load_timestamp from etl_status""",
        "etl_status",
    ),
)
_SUMS = "total_sales total_bottles_sold total_volume_liters total_margin"
add(
    "r1_monthly",
    reports.monthly,
    _from_view(
        f"select year_month, {_D(_SUMS)}, invoice_count, store_count from sales_by_month",
        "sales_by_month",
    ),
)


def _longer_sql(keys: str, exact: bool) -> str:
    label = ", year || ' Q' || quarter as year_quarter" if "quarter" in keys else ""
    if exact:
        return ob.with_tables(
            f"select {keys}{label}, {_D(_SUMS)}, sales_line_count, invoice_count, store_count "
            f"from (select {keys}, {ob.SBLMC}, {ob._I}, {ob._ST} from flat group by {keys})"
        )
    sums = ", ".join(f"cast(sum({s}) as double) as {s}" for s in _SUMS.split())
    counts = ", ".join(
        f"cast(sum({c}) as bigint) as {c}"
        for c in ("sales_line_count", "invoice_count", "store_count")
    )
    return _from_view(
        f"select {keys}{label}, {sums}, {counts} from sales_by_month group by {keys}",
        "sales_by_month",
    )


for _keys, _report in (("year, quarter", reports.quarterly), ("year", reports.yearly)):
    add(f"r1_{_report.__name__}", _report, _longer_sql(_keys, exact=True))
    add(
        f"r1_{_report.__name__}_summed",
        lambda w, r=_report: r(w, as_reference=True),
        _longer_sql(_keys, exact=False),
    )

_MARGIN_PERCENT = f"{ob.ratio('100 * total_margin', 'total_sales')} as margin_percent"
_CATEGORY_COLUMNS = f"""category_name, {_D("total_sales total_margin")}, {_MARGIN_PERCENT},
    {_D("total_bottles_sold total_volume_liters")}, sales_share_percent"""


def _top_sql(columns: str, view: str, by: str, ties: str, k: int, where: str = "true") -> str:
    return _from_view(
        f"""select * from (select {columns} from {view} where {where})
        order by {by} desc nulls last, {ties} limit {k}""",
        view,
    )


def _nulls_first(*names: str) -> str:
    return ", ".join(f"{n} asc nulls first" for n in names)


add(
    "r2_categories",
    reports.categories,
    _from_view(f"select {_CATEGORY_COLUMNS} from sales_by_category", "sales_by_category"),
)
for _by in ("total_sales", "total_margin", "margin_percent"):
    add(
        f"r2_top_by_{_by}",
        lambda w, by=_by: reports.top_categories(w, by),
        _top_sql(_CATEGORY_COLUMNS, "sales_by_category", _by, _nulls_first("category_name"), 15),
    )
_STORE_COLUMNS = f"""store_number, store_name, city, county, {_D("total_sales total_margin")},
    {_MARGIN_PERCENT}, invoice_count"""
for _name, _by, _k in (
    ("r3_top_by_sales", "total_sales", 15),
    ("r3_top_by_margin", "total_margin", 15),
    ("r3_table", "total_sales", 50),
):
    add(
        _name,
        lambda w, by=_by, k=_k: reports.top_stores(w, by, k),
        _top_sql(_STORE_COLUMNS, "sales_by_store", _by, _nulls_first("store_number"), _k),
    )
add(
    "r3_top_by_rate",
    reports.top_store_rates,
    _top_sql(
        _STORE_COLUMNS, "sales_by_store", "margin_percent", _nulls_first("store_number"), 15,
        f"total_sales >= {reports.MIN_STORE_SALES}",
    ),
)


def _sum_sql(*names: str) -> str:
    return ", ".join(
        f"cast(sum({n}) as {'bigint' if n.endswith('count') else 'double'}) as {n}" for n in names
    )


_PLACE_SUMS = _sum_sql(*_SUMS.split(), "sales_line_count", "store_count")
add(
    "r4_counties",
    reports.counties,
    _from_view(
        f"select county, {_PLACE_SUMS} from sales_by_geography group by county",
        "sales_by_geography",
    ),
)
add(
    "r4_cities",
    reports.cities,
    _from_view(
        f"""select city, {_PLACE_SUMS},
        coalesce(string_agg(distinct county, ', ' order by county), '') as county
        from sales_by_geography group by city""",
        "sales_by_geography",
    ),
)


def _city_map(w: Workspace) -> DataFrame:
    return reports.city_map(w).withColumn("log_sales", F.round("log_sales", 6))


add(
    "r4_city_map",
    _city_map,
    _from_view(
        f"""select city, county, {ob.ratio("sum(latitude)", "count(*)")} as latitude,
        -{ob.ratio("sum(-longitude)", "count(*)").replace("case when", "(case when", 1)})
          as longitude,
        {_sum_sql("total_sales", "total_volume_liters")},
        count(distinct store_number) as store_count,
        round(ln(1 + cast(sum(total_sales) as double)), 6) as log_sales
        from sales_map_points group by city, county""",
        "sales_map_points",
    ),
)
add("r5_vendors", reports.vendors, _VENDORS_SQL)
for _k in (15, 20):
    add(
        f"r5_top_{_k}",
        lambda w, k=_k: reports.top_vendors(w, k),
        _top_sql(_VENDOR_COLUMNS, "sales_by_vendor", "total_sales", _nulls_first("vendor_name"), _k),
    )
_PRODUCT_COLUMNS = f"""item_number, item_description, category_name, vendor_name,
    {_D("total_sales total_bottles_sold total_margin")},
    coalesce(item_description, 'None') || ' (' || item_number || ')' as product_label"""
for _name, _by, _k in (
    ("r6_top_by_bottles", "total_bottles_sold", 15),
    ("r6_top_by_sales", "total_sales", 15),
    ("r6_table", "total_sales", 50),
):
    add(
        _name,
        lambda w, by=_by, k=_k: reports.top_products(w, by, k),
        _top_sql(
            _PRODUCT_COLUMNS, "top_products", _by,
            _nulls_first("item_number", "category_name", "vendor_name"), _k,
        ),
    )
_MARGIN_COLUMNS = f"""category_name, item_description, vendor_name, avg_unit_margin,
    {_D("total_margin total_sales")}"""
for _by in ("avg_unit_margin", "total_margin"):
    add(
        f"r7_top_by_{_by}",
        lambda w, by=_by: reports.top_margins(w, by),
        _top_sql(
            _MARGIN_COLUMNS, "margin_analysis", _by,
            _nulls_first("category_name", "vendor_name", "item_description"), 20,
            "avg_unit_margin is not null and total_margin is not null and total_sales is not null "
            f"and total_sales >= {reports.MIN_PRODUCT_SALES}",
        ),
    )
for _k, _name in ((3, "r8_category_mix"), (10, "r8_category_mix_of_ten")):
    add(
        _name,
        lambda w, k=_k: reports.category_mix(w, k=k),
        _from_view(
            f"""select year_month, category_name, {_D("total_sales total_margin")},
            {ob.ratio("100 * total_sales", "month_sales")} as month_percent from (
              select *, sum(total_sales) over (partition by year_month) as month_sales
              from category_sales_over_time where category_name in (
                select category_name from sales_by_category where category_name is not null
                order by total_sales desc, category_name limit {_k}))""",
            "category_sales_over_time", "sales_by_category",
        ),
    )
_VOLUME_SQL = f"""state_name, county, {_D("total_volume_liters total_sales")}, sales_per_liter,
    store_count"""
add(
    "r9_scatter",
    reports.volume_scatter,
    _from_view(f"select {_VOLUME_SQL} from volume_vs_revenue", "volume_vs_revenue"),
)
for _name, _k in (("r9_chart", 15), ("r9_table", 20)):
    add(
        _name,
        lambda w, k=_k: reports.high_volume_low_price(w, k),
        _from_view(
            f"""select county, {_D("total_volume_liters total_sales")}, sales_per_liter,
            store_count from volume_vs_revenue
            where cast(total_volume_liters as double) >= (select
              quantile_cont(cast(total_volume_liters as double), 0.75) from volume_vs_revenue)
            order by sales_per_liter asc nulls last, county limit {_k}""",
            "volume_vs_revenue",
        ),
    )
add(
    "r10_store_averages",
    reports.county_store_averages,
    _from_view(
        """select year_month, state_name, county, avg_sales_per_store, store_count
        from avg_sales_per_store_by_month_region where county in (
          select county from avg_sales_per_store_by_month_region where county is not null
          group by county order by avg(avg_sales_per_store) desc, county limit 8)""",
        "avg_sales_per_store_by_month_region",
    ),
)
_DAY_TYPE_SUMS = _sum_sql(*_SUMS.split(), "sales_line_count", "invoice_count")
add(
    "r11_day_types",
    reports.day_types,
    ob.with_tables(
        f"""select day_type, {_D(_SUMS)}, sales_line_count, invoice_count from (
          select case when is_weekend = 1 then 'Weekend' else 'Weekday' end as day_type,
            {ob.SBLMC}, {ob._I} from flat group by 1)"""
    ),
)
add(
    "r11_day_types_summed",
    lambda w: reports.day_types(w, as_reference=True),
    _from_view(
        f"select day_type, {_DAY_TYPE_SUMS} from sales_by_day_type group by day_type",
        "sales_by_day_type",
    ),
)
_PACK_COLUMNS = f"""volume_group, bottle_volume_ml, pack,
    {_D("total_sales total_bottles_sold total_margin")}"""
add(
    "r12_packaging",
    reports.packaging,
    _from_view(f"select {_PACK_COLUMNS} from sales_by_packaging", "sales_by_packaging"),
)
add(
    "r12_packaging_tree",
    reports.packaging_tree,
    _from_view(
        """select volume_group, bottle_volume_ml, cast(sum(total_sales) as double) as total_sales
        from (select * from sales_by_packaging
          order by total_sales desc, pack, bottle_volume_ml limit 30)
        group by grouping sets ((volume_group, bottle_volume_ml), (volume_group))""",
        "sales_by_packaging",
    ),
)

# Quality checks

_DUPLICATES_SQL = {
    check: f"select count(*) from (select 1 from {dim} group by {', '.join(NATURAL_KEYS[dim])} "
    "having count(*) > 1)"
    for check, dim in quality.DUPLICATES.items()
}
_CHECK_SQL = {
    "staging_row_count": "select count(*) from stg",
    "eligible_staging_row_count": f"select count(*) from stg where {ob.ELIGIBLE}",
    "fact_row_count": "select count(*) from fact",
    "eligible_staging_fact_row_count_difference":
        f"select abs((select count(*) from stg where {ob.ELIGIBLE}) - (select count(*) from fact))",
    "null_foreign_keys":
        "select count(*) from fact where date is null or store_number is null or "
        "item_number is null or category_number is null or vendor_number is null or pack is null",
    "negative_measures": f"select count(*) from fact where {ob.NEGATIVE}",
    **_DUPLICATES_SQL,
    "fact_dimension_join_failures":
        "select count(*) from fact f left join dim_date d on d.date = f.date "
        "left join dim_store s on s.store_number = f.store_number "
        "left join dim_product p on p.item_number = f.item_number "
        "left join dim_category c on c.category_number = f.category_number "
        "left join dim_vendor v on v.vendor_number = f.vendor_number "
        "left join dim_packaging k on k.pack = f.pack and k.bottle_volume_ml = f.bottle_volume_ml "
        "where d.date is null or s.store_number is null or p.item_number is null "
        "or c.category_number is null or v.vendor_number is null or k.pack is null",
    "raw_negative_measure_rows_excluded_from_fact":
        f"select count(*) from stg where {ob.NEGATIVE}",
    "eligible_staging_vs_fact_sales_difference":
        f"select abs((select sum(coalesce(sale_dollars, 0)) from stg where {ob.ELIGIBLE}) "
        "- (select sum(sale_dollars) from fact))",
}
_VERDICT_SQL = {
    "positive": "case when check_value > 0 then 'PASS' else 'FAIL' end",
    "zero": "case when check_value = 0 then 'PASS' else 'FAIL' end",
    "tolerance": "case when check_value <= 0.01 then 'PASS' else 'FAIL' end",
    "info": "'INFO'",
}


def _check_sql(name: str, order: int) -> str:
    rule = quality.CHECKS[name]
    return (
        f"select cast({order} as integer) as sort_order, '{name}' as check_name, check_value, "
        f"{_VERDICT_SQL[rule]} as result "
        f"from (select cast(({_CHECK_SQL[name]}) as double) as check_value)"
    )


_ALL_CHECKS = [_check_sql(n, i) for i, n in enumerate(quality.CHECKS, start=1)]
for _i, _name in enumerate(quality.CHECKS, start=1):
    add(
        f"q{_i}_{_name}",
        lambda w, n=_name: quality.quality_checks(w, [n]),
        ob.with_tables(_ALL_CHECKS[_i - 1]),
    )
_CHECKS_SQL = ob.with_tables(" union all ".join(_ALL_CHECKS))


def _gated(w: Workspace) -> DataFrame:
    checks = quality.quality_checks(w)
    quality.assert_quality(checks)
    return checks


add("qg_quality_gate", _gated, _CHECKS_SQL)
add("x4_refresh_warehouse", lambda w: quality.quality_checks(w.published), _CHECKS_SQL)
# The same checks, measured while the tables were written.
add("x4_measured_checks", lambda w: version_checks(w.spark, w.warehouse), _CHECKS_SQL)

# Helper transforms


def _spelled_weekends(w: Workspace) -> DataFrame:
    """The calendar's flag in the spellings drivers and people use."""
    kind = F.col("date_key") % 4
    flag = F.col("is_weekend")
    spelled = (
        F.when(kind == 0, flag.cast("string"))
        .when(kind == 1, F.when(flag == 1, " True ").otherwise("False"))
        .when(kind == 2, F.when(flag == 1, "WEEKEND").otherwise("week day"))
        .otherwise("?")
    )
    return w.dim_date.select("date", spelled.alias("is_weekend"))


_FLAG_SQL = "case when cast(strftime(date, '%Y%m%d') as integer) % 4 <> 3 then is_weekend end"
add(
    "h1_weekend_flag",
    lambda w: _spelled_weekends(w).select("date", flags.weekend_flag(_spelled_weekends(w)).alias("is_weekend")),
    ob.with_tables(f"select date, {_FLAG_SQL} as is_weekend from dim_date", level="dims"),
)
add(
    "h2_normalize_frame",
    lambda w: flags.normalize_weekend(views.sales_by_day_type(w)),
    _view_sql("sales_by_day_type"),
)
add(
    "h3_day_type",
    lambda w: flags.with_day_type(_spelled_weekends(w)),
    ob.with_tables(
        f"""select date, {_FLAG_SQL} as is_weekend, case {_FLAG_SQL} when 1 then 'Weekend'
        when 0 then 'Dzień roboczy' else 'Nieznany typ dnia' end as day_type from dim_date""",
        level="dims",
    ),
)


def _daily(w: Workspace) -> DataFrame:
    days = w.dim_date.groupBy("year_month", "is_weekend").agg(F.count(F.lit(1)).alias("day_count"))
    df = views.sales_by_day_type(w).join(days, ["year_month", "is_weekend"])
    daily = flags.with_daily_metrics(df)
    return daily.select("year_month", "day_type", "day_count", *flags.DAILY_METRICS)


add(
    "h4_daily_metrics",
    _daily,
    ob.with_tables(
        "select year_month, day_type, day_count, "
        + ", ".join(
            f"cast({total} as double) / day_count as {name}"
            for name, total in flags.DAILY_METRICS.items()
        )
        + """ from sales_by_day_type join (select year_month, is_weekend, count(*) as day_count
          from dim_date group by year_month, is_weekend) using (year_month, is_weekend)""",
        "sales_by_day_type",
    ),
)
add(
    "h5_county_key",
    lambda w: table(w, "supplier").select(
        "s_suppkey",
        text.county_key(F.concat(F.lit(" "), "s_name", F.lit(" COUNTY"))).alias("county_key"),
    ),
    """select s_suppkey, replace(lower(s_name), '#', ' ') as county_key from supplier""",
)
add(
    "h6_county_fips",
    lambda w: table(w, "customer").select(
        "c_custkey",
        text.county_fips((F.col("c_custkey") % 1100).cast("string"), "19").alias("short"),
        text.county_fips((F.col("c_custkey") % 30000).cast("string"), "19").alias("long"),
    ),
    """select c_custkey,
    case when c_custkey % 1100 between 1 and 999
      then '19' || lpad(cast(c_custkey % 1100 as varchar), 3, '0') end as short,
    case when c_custkey % 30000 between 19000 and 19999 then cast(c_custkey % 30000 as varchar)
      when c_custkey % 30000 between 1 and 999
      then '19' || lpad(cast(c_custkey % 30000 as varchar), 3, '0') end as long
    from customer""",
)

# Warehouse summary

_DIM_SUM = " + ".join(f"(select count(*) from {n})" for n in ["fact", *DIMENSION_KEYS])
add(
    "m1_layer_counts",
    summary.layer_counts,
    ob.with_tables(
        f"""select '1 Bronze' as layer_name, 'source files' as object_name,
          count(distinct source_file) as observed_count from stg
        union all select '2 Silver', 'staging', count(*) from stg
        union all select '3 Gold', 'dimensions + fact', {_DIM_SUM}"""
    ),
)
add(
    "m2_file_profile",
    summary.file_profile,
    _stg(
        """select source_file, count(*) as row_count, min(date) as min_date,
        max(date) as max_date, count(*) filter (source_row_hash is null) as null_hash_rows,
        count(*) filter (latitude is not null and longitude is not null) as rows_with_gps
        from stg group by source_file order by source_file limit 20"""
    ),
)
add(
    "m3_staging_profile",
    summary.staging_profile,
    _stg(
        f"""select count(*) as staging_rows, count(distinct source_row_hash) as distinct_hashes,
        count(*) - count(distinct source_row_hash) as duplicate_hash_candidates,
        count(*) filter (date is null) as null_date_rows,
        count(*) filter (invoice_and_item_number is null) as null_invoice_rows,
        count(*) filter (store_number is null) as null_store_number_rows,
        count(*) filter (item_number is null) as null_item_number_rows,
        count(*) filter ({ob.NEGATIVE}) as negative_measure_rows,
        count(*) filter (latitude is not null and longitude is not null) as rows_with_gps
        from stg"""
    ),
)
add(
    "m4_latest_rows",
    summary.latest_rows,
    _stg(
        f"""select staging_key, source_file, invoice_and_item_number, date, store_number,
        store_name, city, county, item_number, item_description, pack, bottle_volume_ml,
        {_D("state_bottle_cost state_bottle_retail bottles_sold sale_dollars")},
        cast({ob.MARGIN} as double) as margin_amount_if_loaded, source_row_hash
        from stg order by date desc nulls last, staging_key desc, source_row_hash limit 10"""
    ),
)
add(
    "m5_reconciliation",
    summary.reconciliation,
    ob.with_tables(
        f"""select *, abs(silver_eligible_sales - gold_fact_sales) as sales_difference,
          silver_rows_eligible_for_fact - gold_fact_rows_after_load as row_difference
        from (select count(*) as silver_all_rows,
            count(*) filter ({ob.ELIGIBLE}) as silver_rows_eligible_for_fact,
            count(*) filter ({ob.NEGATIVE}) as silver_rows_excluded_by_negative_measure_filter,
            cast(sum(coalesce(sale_dollars, 0)) filter ({ob.ELIGIBLE}) as double)
              as silver_eligible_sales from stg) s,
          (select count(*) as gold_fact_rows_after_load,
            cast(sum(sale_dollars) as double) as gold_fact_sales,
            cast(sum(margin_amount) as double) as gold_total_margin,
            cast(sum(sales_line_count) as bigint) as sales_line_count from fact) g"""
    ),
)
add("m6_dimension_counts", summary.dimension_counts, ob.with_tables(_COUNTS_SQL, level="dims"))
add(
    "m7_calendar_coverage",
    summary.calendar_coverage,
    ob.with_tables(
        """select min(date) as min_date, max(date) as max_date, count(*) as dim_date_rows,
        cast(max(date) - min(date) + 1 as integer) as expected_calendar_days,
        max(date) - min(date) + 1 - count(*) as missing_calendar_days from dim_date""",
        level="dims",
    ),
)
add("m8_unknown_members", summary.unknown_members, _UNKNOWN_SQL)
add(
    "m9_missing_days",
    summary.missing_days,
    ob.with_tables(
        """select cast(day as date) as date from (select unnest(generate_series(
          (select min(date) from dim_date), (select max(date) from dim_date),
          interval 1 day)) as day) where cast(day as date) not in (select date from dim_date)""",
        level="dims",
    ),
)
add(
    "m10_packaging_groups",
    summary.packaging_groups,
    ob.with_tables(
        """select volume_group, count(*) as packaging_variants,
        min(bottle_volume_ml) as min_bottle_volume_ml,
        max(bottle_volume_ml) as max_bottle_volume_ml from dim_packaging group by volume_group""",
        level="dims",
    ),
)
for _name, _natural in NATURAL_KEYS.items():
    add(
        f"m11_{_name}_sample",
        lambda w, n=_name, by=_natural: summary.dimension_sample(w, n, by).drop(DIMENSION_KEYS[n]),
        ob.with_tables(
            f"select {_DIM_COLUMNS.get(_name, '*')} from {_name} "
            f"order by {', '.join(_natural)} limit 5",
            level="dims",
        ),
    )
add(
    "m12_fact_profile",
    summary.fact_profile,
    ob.with_tables(
        f"""select count(*) as fact_rows, {ob._I}, {ob._C},
        cast(sum(bottles_sold) as double) as total_bottles_sold,
        cast(sum(sale_dollars) as double) as total_sales,
        cast(sum(margin_amount) as double) as total_margin,
        {ob.percent("sum(margin_amount)", "sum(sale_dollars)")} as margin_percent,
        cast(sum(volume_sold_liters) as double) as total_volume_liters,
        min(load_timestamp) as first_fact_load_timestamp,
        max(load_timestamp) as last_fact_load_timestamp from fact""",
        level="fact",
    ),
)
add(
    "m13_null_keys",
    summary.null_keys,
    ob.with_tables(
        """select count(*) filter (date is null) as null_date_key,
        count(*) filter (store_number is null) as null_store_key,
        count(*) filter (item_number is null) as null_product_key,
        count(*) filter (category_number is null) as null_category_key,
        count(*) filter (vendor_number is null) as null_vendor_key,
        count(*) filter (pack is null) as null_packaging_key from fact""",
        level="fact",
    ),
)
add(
    "m14_sales_by_year",
    summary.sales_by_year,
    ob.with_tables(
        f"""select year, count(*) as sales_line_count, {ob._I},
        cast(sum(sale_dollars) as double) as total_sales,
        cast(sum(margin_amount) as double) as total_margin from flat group by year"""
    ),
)


def _sample(name: str) -> Callable[[Workspace], DataFrame]:
    if name == "etl_status":
        return _view(name)
    return lambda w: summary.view_sample(w, name)


_SAMPLE_SQL = {
    "sales_overview": "date desc, " + _nulls_first(
        "invoice_number", "item_number", "vendor_number", "sale_dollars", "margin_amount"),
    "sales_by_day_type": "year desc, month desc, day_type",
    "sales_by_month": "year desc, month desc",
    "category_sales_over_time":
        "year desc, month desc, total_sales desc, " + _nulls_first("category_name"),
    "sales_by_category": "total_sales desc, " + _nulls_first("category_name"),
    "sales_by_store":
        "total_sales desc, " + _nulls_first("store_number", "store_name", "city", "county"),
    "sales_by_vendor": "total_sales desc, " + _nulls_first("vendor_name"),
    "sales_by_packaging": "total_sales desc, pack, bottle_volume_ml",
    "sales_by_geography": "total_sales desc, " + _nulls_first("state_name", "county", "city"),
    "sales_map_points":
        "total_sales desc, " + _nulls_first("store_number", "store_name", "city", "county"),
    "top_products":
        "total_sales desc, " + _nulls_first("item_number", "category_name", "vendor_name"),
    "margin_analysis":
        "total_margin desc, " + _nulls_first("category_name", "vendor_name", "item_description"),
    "volume_vs_revenue": "total_sales desc, " + _nulls_first("state_name", "county"),
    "avg_sales_per_store_by_month_region":
        "year desc, month desc, avg_sales_per_store desc, " + _nulls_first("state_name", "county"),
    "kpi_summary": "total_sales desc",
    "etl_status": "status_generated_at desc",
}


def _sample_columns(name: str) -> str:
    if name == "sales_overview":
        return f"""date, store_number, store_name, city, county, item_number, item_description,
            category_name, vendor_name, {_D("sale_dollars margin_amount")}"""
    if name in summary.SAMPLE_COLUMNS:
        return ", ".join(summary.SAMPLE_COLUMNS[name])
    return _amounts(name)


for _i, _name in enumerate(views.VIEWS, start=1):
    add(
        f"m15_{_name}_sample",
        _sample(_name),
        ob.with_tables(
            f"select {_sample_columns(_name)} from (select * from {_name} "
            f"order by {_SAMPLE_SQL[_name]} limit 5)",
            _name,
        ),
    )
add("m16_check_list", quality.quality_checks, _CHECKS_SQL)
add(
    "m17_dirty_rows",
    summary.dirty_rows,
    _stg(
        f"""select invoice_and_item_number, date, store_location, category_name,
        {_D("state_bottle_cost sale_dollars")} from stg
        where category_name is null or store_location like 'POINT%'
        order by staging_key, source_row_hash limit 5"""
    ),
)
