"""Schemas and fixed domain values. Nothing is inferred from data."""

from __future__ import annotations

ITEMS_TYPE = "array<struct<sku:string,quantity:int>>"
TRANSACTION_TYPE = (
    "struct<transaction_id:string,supermarket_id:string,transaction_date:string,"
    f"items:{ITEMS_TYPE}>"
)
ENVELOPE_TYPE = "struct<log:string>"

CSV_TRANSACTIONS = "transaction_id string, supermarket_id string, transaction_date string, items string"
CSV_HEADER = "transaction_id,supermarket_id,transaction_date,items"
# Where the text of a CSV row that does not fit the header is kept.
CSV_BROKEN = "_broken"
CSV_SKUS = "`sku` string, `name of article` string, `price` string"
CSV_SUPERMARKETS = "supermarket_id string, supermarket_name string"

# Every fact row is stored in one layout, <path>/table=<name>/origin=/stream_id=/batch_id=.
PARTITION_COLUMNS = ["table", "origin", "stream_id", "batch_id"]
_LOAD = "origin string, stream_id string, batch_id bigint"
_LINEAGE = f"source_file string, arrived_at timestamp, {_LOAD}"
FACT_SCHEMAS = {
    "headers": "tx_key binary, transaction_id string, supermarket_id string, "
    f"transaction_date timestamp_ntz, flags array<string>, {_LINEAGE}",
    "details": "tx_key binary, position int, transaction_id string, sku string, quantity int, "
    f"transaction_date timestamp_ntz, {_LOAD}",
    "rejects": f"raw string, reason string, {_LINEAGE}",
}
FACT_COLUMNS = {
    "headers": ["transaction_id", "supermarket_id", "transaction_date"],
    "details": ["transaction_id", "sku", "quantity"],
    "rejects": ["raw", "reason"],
}

# The domain of the data.
TRANSACTION_PREFIX, TRANSACTION_DIGITS = "TX", 7
STORE_PREFIX, STORE_DIGITS = "STORE", 4
SKU_PREFIX, SKU_DIGITS = "SKU", 5
MIN_QUANTITY, MAX_QUANTITY = 1, 5
MIN_BASKET, MAX_BASKET = 1, 20
OPENING_HOUR, CLOSING_HOUR = 9, 21
SUNDAY = 6
STORE_ZONE = "Europe/Madrid"
DATE_SHAPE = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\z"

# Reasons a line is refused; each refused line has exactly one.
REJECT_REASONS = ["bad_line", "no_log", "not_json", "not_object", "no_id", "null_id", "bad_row", "bad_file"]
# Notes on a kept record; a record may carry several.
FLAGS = ["bad_date", "bad_items", "null_item", "bad_quantity"]
