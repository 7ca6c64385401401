"""The four tables under names that SQL can use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.plans.reports import once
from basketflow.sources import read_fact

# Documented table and column names beside the ones in use.
PUBLIC_NAMES = {
    "supermarkets": ("supermarkets", {"supermarket_id": "store_id", "supermarket_name": "store_name"}),
    "skus": ("skus", {"sku": "sku_id", "article_name": "product_name", "price": "price"}),
    "headers": (
        "transactions",
        {
            "tx_key": "tx_key",
            "transaction_id": "transaction_id",
            "supermarket_id": "store_id",
            "transaction_date": "transaction_datetime",
        },
    ),
    "details": (
        "transaction_items",
        {"tx_key": "tx_key", "transaction_id": "transaction_id", "sku": "sku_id", "quantity": "quantity"},
    ),
}


def register(tables: dict[str, DataFrame], prefix: str = "") -> None:
    for name, rows in tables.items():
        rows.createOrReplaceTempView(f"{prefix}{name}")


def with_public_names(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """``supermarkets``, ``skus``, ``transactions`` and ``transaction_items``."""
    return {
        public: tables[name].select([F.col(old).alias(new) for old, new in columns.items() if old in tables[name].columns])
        for name, (public, columns) in PUBLIC_NAMES.items()
        if name in tables
    }


def load_tables(spark: SparkSession, facts_path: str, skus: DataFrame, supermarkets: DataFrame) -> dict[str, DataFrame]:
    """The tables of a fact folder and its two dimensions; historical and live rows together.

    Ids occur again after a till restarts, so both fact tables carry ``tx_key``: join on it. Each record
    is there once, however often it was delivered.
    """
    headers, details = (read_fact(spark, facts_path, name, stored=True) for name in ("headers", "details"))
    return {
        "headers": once(headers, "tx_key", "transaction_id", "supermarket_id", "transaction_date"),
        "details": once(details, "tx_key", "transaction_id", "sku", "quantity"),
        "skus": skus,
        "supermarkets": supermarkets,
    }
