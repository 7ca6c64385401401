"""Checks and profiles of the fact tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketflow import schemas
from basketflow.functions import in_opening_hours


def without_parent(children: DataFrame, parents: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose key no parent has; a null key has no parent.

    Rows with a null key get a random one, which no parent has either; as nulls they would all
    be shuffled to one task.
    """
    keys = parents.select(F.col(parent_key or key).alias("_key"))
    keyed = children.withColumn("_key", F.coalesce(F.col(key), F.expr("concat('none ', uuid())")))
    return keyed.join(keys, "_key", "left_anti").drop("_key")


def headers_without_items(headers: DataFrame, details: DataFrame) -> DataFrame:
    """Headers no detail refers to. Details are reduced to their keys before the shuffle."""
    return without_parent(headers, details.select("transaction_id").distinct(), "transaction_id")


def reject_counts(records: DataFrame) -> DataFrame:
    """Refused lines by reason."""
    return records.where(F.col("reason").isNotNull()).groupBy("reason").agg(F.count("*").alias("lines"))


def flag_counts(records: DataFrame) -> DataFrame:
    """Kept records by flag."""
    return (
        records.where(F.col("reason").isNull())
        .select(F.explode_outer("flags").alias("flag"))
        .where(F.col("flag").isNotNull())
        .groupBy("flag")
        .agg(F.count("*").alias("records"))
    )


def open_hours_sales(headers: DataFrame) -> DataFrame:
    return headers.where(in_opening_hours(F.col("transaction_date")))


def out_of_hours_by_store(headers: DataFrame) -> DataFrame:
    """Transactions outside opening hours, by store; a null date is neither in nor out."""
    return (
        headers.where(~in_opening_hours(F.col("transaction_date")))
        .groupBy("supermarket_id")
        .agg(F.count("*").alias("transactions"))
    )


def quantity_profile(details: DataFrame) -> DataFrame:
    """Lines and share of all lines by quantity. The total is a scalar subquery over no columns."""
    total = details.select(F.count(F.lit(1))).scalar()
    return (
        details.groupBy("quantity")
        .agg(F.count("*").alias("lines"))
        .withColumn("share", F.col("lines").cast("double") / total.cast("double"))
    )


def basket_sizes(headers: DataFrame, details: DataFrame) -> DataFrame:
    """Items in each header's basket, 0 for an empty one."""
    sizes = details.groupBy("transaction_id").agg(F.count("*").alias("items"))
    return headers.select("transaction_id").join(sizes, "transaction_id", "left").select(
        "transaction_id", F.coalesce("items", F.lit(0).cast("bigint")).alias("items")
    )


def basket_size_profile(headers: DataFrame, details: DataFrame) -> DataFrame:
    return basket_sizes(headers, details).groupBy("items").agg(F.count("*").alias("transactions"))


def _broken(rule: Column) -> Column:
    """A value that is missing breaks its rule too."""
    return F.count_if(~F.coalesce(rule, F.lit(False)))


def _key_shape(column: str, prefix: str, digits: int) -> Column:
    return F.col(column).rlike(f"^{prefix}[0-9]{{{digits},}}\\z")


def _as_rows(checks: DataFrame) -> DataFrame:
    return checks.unpivot([], checks.columns, "rule", "violations")


def _detail_rules() -> dict[str, Column]:
    return {
        "quantity_range": F.col("quantity").between(schemas.MIN_QUANTITY, schemas.MAX_QUANTITY),
        "sku_format": _key_shape("sku", schemas.SKU_PREFIX, schemas.SKU_DIGITS),
        "detail_transaction_format": _key_shape("transaction_id", schemas.TRANSACTION_PREFIX, schemas.TRANSACTION_DIGITS),
    }


def _header_rules() -> dict[str, Column]:
    return {
        "store_format": _key_shape("supermarket_id", schemas.STORE_PREFIX, schemas.STORE_DIGITS),
        "header_transaction_format": _key_shape("transaction_id", schemas.TRANSACTION_PREFIX, schemas.TRANSACTION_DIGITS),
    }


def load_checks() -> dict[str, Column]:
    """Counts over the tagged rows of a load: rows of each table, refused lines by reason, records by flag, and rows
    that break a rule. Each is an aggregate, so that they can be observed while the rows are written."""
    def of(table: str, rule: Column) -> Column:
        return F.count_if((F.col("table") == table) & rule)

    def broken(rule: Column) -> Column:
        return ~F.coalesce(rule, F.lit(False))

    return {
        **{table: of(table, F.lit(True)) for table in schemas.FACT_SCHEMAS},
        **{reason: of("rejects", F.col("reason") == reason) for reason in schemas.REJECT_REASONS},
        **{flag: of("headers", F.array_contains("flags", flag)) for flag in schemas.FLAGS},
        **{name: of("details", broken(rule)) for name, rule in _detail_rules().items()},
        **{name: of("headers", broken(rule)) for name, rule in _header_rules().items()},
    }


def domain_violations(headers: DataFrame, details: DataFrame) -> DataFrame:
    """One row per rule with the number of rows that break it."""
    of_details = details.agg(*[_broken(rule).alias(name) for name, rule in _detail_rules().items()])
    of_headers = headers.agg(*[_broken(rule).alias(name) for name, rule in _header_rules().items()])
    of_baskets = basket_sizes(headers, details).agg(
        _broken(F.col("items").between(schemas.MIN_BASKET, schemas.MAX_BASKET)).alias("basket_size")
    )
    return _as_rows(of_details).unionByName(_as_rows(of_headers)).unionByName(_as_rows(of_baskets))
