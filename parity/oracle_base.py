"""DuckDB text of the staging rows, the star and the views.

Written from typed expressions over the given tables, not from the landed text, so
it does not repeat the cleaning it is compared with. Amounts stay decimals until the
last select; ratios are rounded half up in whole numbers, which is exact.
"""

from __future__ import annotations


def ratio(top: str, bottom: str, scale: int = 6) -> str:
    """top / bottom of two non-negative four-digit decimals, half up at scale."""
    n = f"cast(cast(({top}) * 100000000 as decimal(38,0)) as hugeint) * {10**scale}"
    d = f"cast(cast(({bottom}) * 100000000 as decimal(38,0)) as hugeint)"
    value = f"(2 * {n} + {d}) // (2 * {d})"
    return f"case when ({bottom}) <> 0 then cast({value} as double) / {10**scale} end"


def percent(top: str, bottom: str) -> str:
    """100 * top / bottom at six digits, then at two, both half up."""
    n = f"cast(cast(({top}) * 10000 as decimal(38,0)) as hugeint) * 100000000"
    d = f"cast(cast(({bottom}) * 10000 as decimal(38,0)) as hugeint)"
    six = f"((2 * {n} + {d}) // (2 * {d}))"
    return f"case when ({bottom}) <> 0 then cast(({six} + 5000) // 10000 as double) / 100 end"


# A German sharp s has no capital here; title case writes it Ss.
TITLE = (
    "array_to_string(list_transform(regexp_extract_all(lower({0}), "
    "'[\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}]+|[^\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}]+'), "
    "lambda w : replace(upper(w[1:1]), 'ẞ', 'Ss') || w[2:]), '')"
)


def title(text: str) -> str:
    return TITLE.format(text)


SOURCE = """
src as materialized (
  select *,
    cast(p_size as bigint) * 50 as volume,
    cast(l_quantity as bigint) as bottles,
    cast(p_retailprice as decimal(18,2)) as retail,
    cast(cast(l_extendedprice as decimal(18,2))
      * (case when l_returnflag = 'R' then -1 else 1 end) as decimal(18,2)) as dollars,
    'sales_' || year(o_orderdate) || '_part_' || lpad(cast(l_orderkey % 8 as varchar), 3, '0')
      || '.csv' as source_file,
    (l_orderkey * 8 + l_linenumber) * 64 + row_number() over (
      partition by l_orderkey, l_linenumber
      order by l_partkey, l_suppkey, l_quantity, l_extendedprice) as line_key,
    'inv-' || l_orderkey || '-' || l_linenumber as invoice,
    strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00.000' as landed_date
  from lineitem
  join orders on l_orderkey = o_orderkey
  join customer on o_custkey = c_custkey
  join nation on c_nationkey = n_nationkey
  join region on n_regionkey = r_regionkey
  join part on l_partkey = p_partkey
  join supplier on l_suppkey = s_suppkey
)"""

STAGING = f"""
stg as materialized (
  select
    line_key as staging_key,
    source_file,
    timestamp '2024-01-01 00:00:00' as load_timestamp,
    'INV-' || l_orderkey || '-' || l_linenumber as invoice_and_item_number,
    cast(o_orderdate as date) as date,
    case when o_custkey % 97 <> 0 then cast(o_custkey as varchar) end as store_number,
    replace(c_name, '#', ' #') as store_name,
    o_orderpriority as address,
    {title("n_name || '-' || c_mktsegment")} as city,
    case when c_custkey % 10 = 0 then 'ZIP ' || (c_custkey % 1000)
      else lpad(cast(c_custkey % 100000 as varchar), 5, '0') end as zip_code,
    r_name || ': ' || case when n_nationkey % 5 = 0 then 'unmapped'
      else 'POINT (-' || (n_nationkey + 90) || '.' || lpad(cast(c_custkey % 1000 as varchar), 3, '0')
        || ' ' || (n_nationkey + 30) || '.' || lpad(cast(c_custkey % 997 as varchar), 3, '0') || ')'
      end as store_location,
    cast(n_nationkey as varchar) as county_number,
    {title("n_name")} as county,
    p_type as category,
    case when p_type <> 'PROMO' then p_type || ' goods' end as category_name,
    cast(l_suppkey as varchar) as vendor_number,
    s_name as vendor_name,
    'IT' || l_partkey as item_number,
    p_name as item_description,
    cast(p_size % 12 as integer) as pack,
    case when p_size <> 50 then cast(volume as integer) end as bottle_volume_ml,
    cast(null as decimal(18,4)) as proof,
    cast(retail - p_size as decimal(18,4)) as state_bottle_cost,
    cast(retail as decimal(18,4)) as state_bottle_retail,
    cast(bottles as decimal(18,4)) as bottles_sold,
    cast(dollars as decimal(18,4)) as sale_dollars,
    cast(cast(bottles * volume as decimal(15,0)) / 1000 as decimal(18,4)) as volume_sold_liters,
    cast(cast(cast(bottles * volume as decimal(15,0)) * 0.001 as decimal(18,3))
      * cast(0.264172 as decimal(7,6)) as decimal(18,4)) as volume_sold_gallons,
    case when n_nationkey % 5 <> 0 then
      cast((n_nationkey + 30) || '.' || lpad(cast(c_custkey % 997 as varchar), 3, '0')
        as decimal(18,8)) end as latitude,
    case when n_nationkey % 5 <> 0 then
      cast('-' || (n_nationkey + 90) || '.' || lpad(cast(c_custkey % 1000 as varchar), 3, '0')
        as decimal(18,8)) end as longitude,
    sha256(concat_ws('|',
      case when l_linenumber % 3 = 0 then '  ' || invoice || ' ' else invoice end,
      landed_date,
      case when o_custkey % 97 = 0 then '' else cast(o_custkey as varchar) end,
      'it' || l_partkey,
      '$' || dollars,
      cast(bottles as varchar),
      source_file)) as source_row_hash,
    r_name as state_name
  from src
)"""


def _dimension(name: str, natural: str, source: str, columns: str) -> str:
    return f"""
{name} as materialized (
  select nk as {natural}, {columns} from (
    select *, row_number() over (partition by nk
      order by date desc nulls last, staging_key desc) as rn
    from (select *, coalesce(nullif({source}, ''), 'UNKNOWN') as nk from stg) keyed
  ) ranked where rn = 1
)"""


DAY_PL = (
    "case dayofweek(date) when 0 then 'niedziela' when 1 then 'poniedzialek' "
    "when 2 then 'wtorek' when 3 then 'sroda' when 4 then 'czwartek' when 5 then 'piatek' "
    "else 'sobota' end"
)
MONTH_PL = (
    "case month(date) when 1 then 'styczen' when 2 then 'luty' when 3 then 'marzec' "
    "when 4 then 'kwiecien' when 5 then 'maj' when 6 then 'czerwiec' when 7 then 'lipiec' "
    "when 8 then 'sierpien' when 9 then 'wrzesien' when 10 then 'pazdziernik' "
    "when 11 then 'listopad' else 'grudzien' end"
)

DIMENSIONS = {
    "dim_date": f"""
dim_date as materialized (
  select cast(strftime(date, '%Y%m%d') as integer) as date_key, date,
    cast(day(date) as integer) as day, cast(month(date) as integer) as month,
    strftime(date, '%B') as month_name_en, cast(quarter(date) as integer) as quarter,
    cast(year(date) as integer) as year, cast(dayofweek(date) + 1 as integer) as day_of_week,
    strftime(date, '%A') as day_name_en, {DAY_PL} as day_name_pl,
    case when dayofweek(date) in (0, 6) then 1 else 0 end as is_weekend,
    strftime(date, '%Y-%m') as year_month, {MONTH_PL} as month_name_pl
  from (select distinct date from stg where date is not null)
)""",
    "dim_store": _dimension(
        "dim_store", "store_number", "store_number",
        "store_name, cast(null as varchar) as store_type, address, city, zip_code, county, "
        "state_name, store_location as source_store_location, latitude, longitude",
    ),
    "dim_product": _dimension("dim_product", "item_number", "item_number", "item_description"),
    "dim_category": _dimension("dim_category", "category_number", "category", "category_name"),
    "dim_vendor": _dimension("dim_vendor", "vendor_number", "vendor_number", "vendor_name"),
    "dim_packaging": """
dim_packaging as materialized (
  select pack, bottle_volume_ml,
    case when bottle_volume_ml = 0 then 'unknown' when bottle_volume_ml < 500 then 'small'
      when bottle_volume_ml < 1000 then 'standard' when bottle_volume_ml < 1750 then 'large'
      else 'extra_large' end as volume_group
  from (select distinct coalesce(pack, 0) as pack,
      coalesce(bottle_volume_ml, 0) as bottle_volume_ml from stg)
)""",
}

ELIGIBLE = (
    "coalesce(sale_dollars, 0) >= 0 and coalesce(bottles_sold, 0) >= 0 "
    "and coalesce(volume_sold_liters, 0) >= 0"
)
NEGATIVE = "sale_dollars < 0 or bottles_sold < 0 or volume_sold_liters < 0"
MARGIN = (
    "cast((coalesce(state_bottle_retail, 0) - coalesce(state_bottle_cost, 0)) "
    "* cast(coalesce(bottles_sold, 0) as decimal(12,2)) as decimal(18,4))"
)

# The natural keys stand for the surrogate keys.
FACT = f"""
fact as materialized (
  select staging_key as sales_key, date,
    coalesce(store_number, 'UNKNOWN') as store_number,
    coalesce(item_number, 'UNKNOWN') as item_number,
    coalesce(category, 'UNKNOWN') as category_number,
    coalesce(vendor_number, 'UNKNOWN') as vendor_number,
    coalesce(pack, 0) as pack, coalesce(bottle_volume_ml, 0) as bottle_volume_ml,
    invoice_and_item_number as invoice_number, source_row_hash, 1 as sales_line_count,
    coalesce(bottles_sold, 0) as bottles_sold, coalesce(sale_dollars, 0) as sale_dollars,
    coalesce(volume_sold_liters, 0) as volume_sold_liters,
    coalesce(volume_sold_gallons, 0) as volume_sold_gallons,
    coalesce(state_bottle_cost, 0) as state_bottle_cost,
    coalesce(state_bottle_retail, 0) as state_bottle_retail,
    {MARGIN} as margin_amount, load_timestamp
  from stg where {ELIGIBLE} and date is not null
)"""

FLAT = """
flat as materialized (
  select f.*, d.* exclude (date), s.* exclude (store_number), p.* exclude (item_number),
    c.* exclude (category_number), v.* exclude (vendor_number),
    k.* exclude (pack, bottle_volume_ml)
  from fact f join dim_date d on d.date = f.date
  join dim_store s on s.store_number = f.store_number
  join dim_product p on p.item_number = f.item_number
  join dim_category c on c.category_number = f.category_number
  join dim_vendor v on v.vendor_number = f.vendor_number
  join dim_packaging k on k.pack = f.pack and k.bottle_volume_ml = f.bottle_volume_ml
)"""

_S = "sum(sale_dollars) as total_sales"
_B = "sum(bottles_sold) as total_bottles_sold"
_L = "sum(volume_sold_liters) as total_volume_liters"
_M = "sum(margin_amount) as total_margin"
_C = "cast(sum(sales_line_count) as bigint) as sales_line_count"
_I = "count(distinct invoice_number) as invoice_count"
_ST = "count(distinct store_number) as store_count"
SBLM = f"{_S}, {_B}, {_L}, {_M}"
SBLMC = f"{SBLM}, {_C}"
_SHARE = percent("sum(sale_dollars)", "(select sum(sale_dollars) from fact)")
_PERIOD = "year, quarter, month, year_month"

VIEWS = {
    "sales_overview": """
      select date, day, month, month_name_en, month_name_pl, day_name_en, day_name_pl,
        is_weekend, quarter, year, year_month, store_number, store_name, address, city, county,
        state_name, zip_code, latitude, longitude, item_number, item_description, pack,
        bottle_volume_ml, volume_group, category_number, category_name, vendor_number,
        vendor_name, invoice_number, sales_line_count, bottles_sold, sale_dollars,
        volume_sold_liters, volume_sold_gallons, state_bottle_cost, state_bottle_retail,
        margin_amount from flat""",
    "sales_by_day_type": f"""
      select {_PERIOD}, is_weekend,
        case when is_weekend = 1 then 'Weekend' else 'Weekday' end as day_type,
        {SBLMC}, {_I} from flat group by {_PERIOD}, is_weekend""",
    "sales_by_month": f"select {_PERIOD}, {SBLMC}, {_I}, {_ST} from flat group by {_PERIOD}",
    "category_sales_over_time": f"""
      select {_PERIOD}, category_name, {SBLMC}, {_I}, {_ST} from flat
      group by {_PERIOD}, category_name""",
    "sales_by_category": f"""
      select category_name, {SBLMC},
        {ratio("sum(margin_amount)", "sum(bottles_sold)")} as avg_margin_per_bottle,
        {_SHARE} as sales_share_percent from flat group by category_name""",
    "sales_by_store": f"""
      select store_number, store_name, city, county, {SBLMC}, {_I} from flat
      group by store_number, store_name, city, county""",
    "sales_by_vendor": f"""
      select vendor_name, {_S}, {_B}, {_M}, {_C}, {_SHARE} as sales_share_percent from flat
      group by vendor_name""",
    "sales_by_packaging": f"""
      select pack, bottle_volume_ml, volume_group, {SBLMC}, {_I},
        {_SHARE} as sales_share_percent from flat group by pack, bottle_volume_ml, volume_group""",
    "sales_by_geography": f"""
      select state_name, county, city, {SBLMC}, {_ST} from flat
      group by state_name, county, city""",
    "sales_map_points": f"""
      select store_number, store_name, state_name, county, city, zip_code, latitude, longitude,
        {SBLMC}, {_I} from flat where latitude is not null and longitude is not null
      group by store_number, store_name, state_name, county, city, zip_code, latitude,
        longitude""",
    "top_products": f"""
      select item_number, item_description, category_name, vendor_name, {_S}, {_B}, {_M}, {_C}
      from flat group by item_number, item_description, category_name, vendor_name""",
    "margin_analysis": f"""
      select category_name, vendor_name, item_description,
        {ratio("sum(state_bottle_cost)", "count(*)")} as state_bottle_cost,
        {ratio("sum(state_bottle_retail)", "count(*)")} as state_bottle_retail,
        {ratio("sum(state_bottle_retail - state_bottle_cost)", "count(*)")} as avg_unit_margin,
        {_M}, {_S} from flat group by category_name, vendor_name, item_description""",
    "volume_vs_revenue": f"""
      select state_name, county, {_L}, {_S},
        {ratio("sum(sale_dollars)", "sum(volume_sold_liters)")} as sales_per_liter, {_ST}
      from flat group by state_name, county""",
    "avg_sales_per_store_by_month_region": f"""
      select {_PERIOD}, state_name, county, {_ST}, {SBLM},
        {ratio("sum(sale_dollars)", "count(distinct store_number)")} as avg_sales_per_store,
        {ratio("sum(bottles_sold)", "count(distinct store_number)")} as avg_bottles_per_store,
        {ratio("sum(volume_sold_liters)", "count(distinct store_number)")}
          as avg_volume_liters_per_store,
        {ratio("sum(margin_amount)", "count(distinct store_number)")} as avg_margin_per_store
      from flat group by {_PERIOD}, state_name, county""",
    "kpi_summary": f"""
      select {_S}, {_M}, {_C}, {_B}, {_L}, {_I}, {_ST},
        count(distinct item_number) as product_count,
        count(distinct category_number) as category_count,
        count(distinct vendor_number) as vendor_count,
        {ratio("sum(sale_dollars)", "count(distinct invoice_number)")} as avg_invoice_value,
        {ratio("sum(bottles_sold)", "count(distinct invoice_number)")} as avg_bottles_per_invoice,
        {percent("sum(margin_amount)", "sum(sale_dollars)")} as avg_margin_percent,
        {ratio("sum(sale_dollars)", "count(distinct store_number)")} as sales_per_store,
        {ratio("sum(sale_dollars)", "sum(volume_sold_liters)")} as sales_per_liter
      from fact""",
    "etl_status": """
      select timestamp '2024-01-01 00:00:00' as status_generated_at,
        (select count(*) from stg) as staging_row_count,
        (select count(*) from fact) as fact_row_count,
        (select count(*) from dim_date) as dim_date_count,
        (select count(*) from dim_store) as dim_store_count,
        (select count(*) from dim_product) as dim_product_count,
        (select count(*) from dim_category) as dim_category_count,
        (select count(*) from dim_vendor) as dim_vendor_count,
        (select count(*) from dim_packaging) as dim_packaging_count,
        (select min(date) from dim_date) as min_date,
        (select max(date) from dim_date) as max_date,
        (select max(load_timestamp) from stg) as last_staging_load_timestamp,
        (select max(load_timestamp) from fact) as last_fact_load_timestamp""",
}


def with_tables(select: str, *views: str, level: str = "flat") -> str:
    """A whole statement: the common tables up to level, the named views, the select."""
    parts = [SOURCE, STAGING]
    if level in ("dims", "flat"):
        parts += DIMENSIONS.values()
    if level in ("fact", "flat"):
        parts.append(FACT)
    if level == "flat":
        parts.append(FLAT)
    parts += [f"{v} as ({VIEWS[v]})" for v in views]
    return "with " + ",\n".join(p.strip() for p in parts) + "\n" + select
