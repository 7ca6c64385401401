from basketflow.sinks.tables import (
    append_load,
    fact_rows,
    overwrite_historical,
    write_batch,
    write_skus_csv,
    write_supermarkets_csv,
    write_transactions_csv,
)

__all__ = [
    "append_load",
    "fact_rows",
    "overwrite_historical",
    "write_batch",
    "write_skus_csv",
    "write_supermarkets_csv",
    "write_transactions_csv",
]
