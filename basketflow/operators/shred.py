"""Records to the relational header and detail rows, and back to nested text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketflow.functions import parse_local_time
from basketflow.operators.decode import accepted


def headers(records: DataFrame) -> DataFrame:
    """One row per kept record; a date that cannot be read becomes null."""
    return accepted(records).select(
        F.col("tx.transaction_id").alias("transaction_id"),
        F.col("tx.supermarket_id").alias("supermarket_id"),
        parse_local_time(F.col("tx.transaction_date")).alias("transaction_date"),
    )


def items(records: DataFrame, field: str) -> DataFrame:
    """One row per item with a field of its record; a record without items yields none and a null element
    is dropped.

    The outer generator with a test on its output gives the same rows as the inner one, without
    the second parse that the optimizer's inferred size test would bring.
    """
    return (
        accepted(records)
        .select(F.col(f"tx.{field}").alias(field), F.explode_outer("tx.items").alias("item"))
        .where(F.col("item").isNotNull())
        .select(field, F.col("item.sku").alias("sku"), F.col("item.quantity").alias("quantity"))
    )


def details(records: DataFrame) -> DataFrame:
    """One row per item with the id of its transaction."""
    return items(records, "transaction_id")


def to_log_line(tx: Column) -> Column:
    """The envelope a log router puts around one printed transaction."""
    return F.to_json(F.struct(F.to_json(tx).alias("log")))
