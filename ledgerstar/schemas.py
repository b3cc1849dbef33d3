"""Column lists and types of the staging table and the star."""

from __future__ import annotations

from ledgerstar.functions.numbers import COORDINATE, MEASURE

# Source spellings and the staging columns they stand for.
COLUMN_ALIASES = {
    "invoice_line_no": "invoice_and_item_number",
    "store": "store_number",
    "name": "store_name",
    "zipcode": "zip_code",
    "vendor_no": "vendor_number",
    "itemno": "item_number",
    "im_desc": "item_description",
    "sale_bottles": "bottles_sold",
    "sale_liters": "volume_sold_liters",
    "sale_gallons": "volume_sold_gallons",
}

# Staging columns in table order with their types; source_position is our own.
STAGING_TYPES = {
    "staging_key": "bigint",
    "source_file": "string",
    "source_position": "bigint",
    "load_timestamp": "timestamp",
    "invoice_and_item_number": "string",
    "date": "date",
    "store_number": "string",
    "store_name": "string",
    "address": "string",
    "city": "string",
    "zip_code": "string",
    "store_location": "string",
    "county_number": "string",
    "county": "string",
    "category": "string",
    "category_name": "string",
    "vendor_number": "string",
    "vendor_name": "string",
    "item_number": "string",
    "item_description": "string",
    "pack": "int",
    "bottle_volume_ml": "int",
    "proof": MEASURE,
    "state_bottle_cost": MEASURE,
    "state_bottle_retail": MEASURE,
    "bottles_sold": MEASURE,
    "sale_dollars": MEASURE,
    "volume_sold_liters": MEASURE,
    "volume_sold_gallons": MEASURE,
    "latitude": COORDINATE,
    "longitude": COORDINATE,
    "source_row_hash": "string",
}

# The columns the row hash covers, in order.
HASH_COLUMNS = [
    "invoice_and_item_number",
    "date",
    "store_number",
    "item_number",
    "sale_dollars",
    "bottles_sold",
    "source_file",
]

# Columns cleaned as identifiers and as names.
IDENTIFIER_COLUMNS = [
    "invoice_and_item_number",
    "store_number",
    "county_number",
    "category",
    "vendor_number",
    "item_number",
]
NAME_COLUMNS = ["city", "county"]

DIMENSION_KEYS = {
    "dim_date": "date_key",
    "dim_store": "store_key",
    "dim_product": "product_key",
    "dim_category": "category_key",
    "dim_vendor": "vendor_key",
    "dim_packaging": "packaging_key",
}

# Natural keys; dim_date needs none because its key is the date itself.
NATURAL_KEYS = {
    "dim_store": ["store_number"],
    "dim_product": ["item_number"],
    "dim_category": ["category_number"],
    "dim_vendor": ["vendor_number"],
    "dim_packaging": ["pack", "bottle_volume_ml"],
}
