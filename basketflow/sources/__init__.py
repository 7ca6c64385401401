from basketflow.sources.readers import (
    read_fact,
    read_log_lines,
    read_skus,
    read_supermarkets,
    read_transactions_csv,
    stream_log_lines,
)

__all__ = [
    "read_fact",
    "read_log_lines",
    "read_skus",
    "read_supermarkets",
    "read_transactions_csv",
    "stream_log_lines",
]
