from basketflow.functions.columns import (
    business_key,
    format_local_time,
    from_cents,
    in_cents,
    in_opening_hours,
    money,
    parse_local_time,
    sku_key,
    store_key,
    transaction_key,
    wide_cents,
    zone_time,
)

__all__ = [
    "business_key",
    "format_local_time",
    "from_cents",
    "in_cents",
    "in_opening_hours",
    "money",
    "parse_local_time",
    "sku_key",
    "store_key",
    "transaction_key",
    "wide_cents",
    "zone_time",
]
