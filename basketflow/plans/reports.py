"""Sales reports over the four tables.

Joins carry no broadcast hint. Catalyst broadcasts a dimension when its size is below
``spark.sql.autoBroadcastJoinThreshold``, AQE when the size it measured is; a larger one is
joined by sort-merge, where AQE splits a hot key.

``on`` names the column that links details to headers: ``transaction_id``, or ``tx_key`` for
stored facts, where ids may occur again. Under ``tx_key`` a record counts once, however often it was
delivered and stored: a header is known by its key, an item by key and position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.functions import from_cents, in_cents, wide_cents


def in_dates(rows: DataFrame, since: str | None, until: str | None) -> DataFrame:
    """Rows from ``since`` up to, not including, ``until``; reaches the Parquet scan."""
    if since:
        rows = rows.where(F.col("transaction_date") >= F.lit(since).cast("timestamp_ntz"))
    if until:
        rows = rows.where(F.col("transaction_date") < F.lit(until).cast("timestamp_ntz"))
    return rows


def once(rows: DataFrame, on: str, *columns: str) -> DataFrame:
    """Each record or item of stored facts once. Copies are equal in all columns that a record's text decides.
    Under ``tx_key`` they fall together in the set of its record's rows, within the task first, and lie where a join on the
    key needs them; a record's rows are those of one line of text."""
    wanted = [c for c in dict.fromkeys([on, "position", *columns]) if c in rows.columns]
    if on != "tx_key":
        return rows.select([c for c in wanted if c != "position"])
    kept = [c for c in wanted if c != on]
    sets = rows.groupBy(on).agg(F.collect_set(F.struct(*kept)).alias("rows"))
    return sets.select(on, F.explode("rows").alias("row")).select(on, "row.*")


def _records_once(headers: DataFrame) -> DataFrame:
    """Each record's header once. Copies are equal, so any one will do; grouping by the key alone leaves the rows
    where a join on it needs them."""
    columns = ["transaction_id", "transaction_date", "supermarket_id"]
    return headers.groupBy("tx_key").agg(*[F.first(name).alias(name) for name in columns])


def _items_once(details: DataFrame) -> DataFrame:
    """Each item of each record once, in place by ``tx_key``."""
    return once(details, "tx_key", "sku", "quantity").drop("position")


def sales_by_day(headers: DataFrame, details: DataFrame) -> DataFrame:
    """Transactions and units by ``day``, over stored facts read with their ``day``, which ``read_fact`` may have cut to a
    set of days."""
    columns = ["day", "transaction_id", "transaction_date"]
    records = headers.groupBy("tx_key").agg(*[F.first(name).alias(name) for name in columns])
    units = _items_once(details).groupBy("tx_key").agg(F.sum("quantity").alias("units"))
    sales = records.join(units, "tx_key", "left").groupBy(*columns).agg(F.sum("units").alias("units"))
    return sales.groupBy("day").agg(F.count("*").alias("transactions"), F.coalesce(F.sum("units"), F.lit(0)).alias("units"))


def header_lines(headers: DataFrame, details: DataFrame, on: str = "transaction_id") -> DataFrame:
    """Each detail with its header."""
    if on == "tx_key":
        headers = once(headers, on, "transaction_id", "supermarket_id", "transaction_date")
        details = once(details, on, "sku", "quantity")
    own = [column for column in details.columns if column == on or column not in headers.columns]
    return headers.join(details.select(own), on)


def line_revenue(details: DataFrame, skus: DataFrame) -> DataFrame:
    """Each detail with its price and what it brought in: quantity times the current price."""
    return details.join(skus.select("sku", "price"), "sku").select(
        "transaction_id", "sku", "quantity", "price", (F.col("quantity") * F.col("price")).alias("revenue")
    )


def sales_by_store(
    headers: DataFrame,
    details: DataFrame,
    skus: DataFrame,
    supermarkets: DataFrame,
    *,
    since: str | None = None,
    until: str | None = None,
    on: str = "transaction_id",
) -> DataFrame:
    """Transactions, units and sales by store.

    Money is summed in whole cents up to the transaction, as 64-bit integers: a decimal product is
    an object per line. The sums over transactions are decimals, so they cannot overflow.

    Details are summed by transaction before they meet their headers: the items of a basket lie
    together, so this shrinks them on the map side, and a transaction with very many items becomes
    one row. The grouping by transaction and store needs no shuffle after a join on the id; it
    counts each transaction of a store once. Under ``tx_key`` a transaction is an id and a date.

    Stored details carry the date of their header, so their scan is cut to the dates as well. They are shuffled by key
    once: copies of an item fall together in the set of its record's items, within the task first, and the join finds its
    rows in place. The key, 32 bytes that do not compress, ends there; where prices are too many to be sent, what goes on
    to them and to the sums are the sale's own columns.
    """
    if "transaction_date" in details.columns:
        details = in_dates(details, since, until)
    prices = skus.select("sku", in_cents(F.col("price")).alias("cents"))
    sale = ["transaction_id", "supermarket_id"] if on == "transaction_id" else ["transaction_id", "transaction_date", "supermarket_id"]
    if on == "tx_key":
        lines = _records_once(in_dates(headers, since, until)).join(_items_once(details), on).drop(on)
        by_sale = (
            lines.join(prices, "sku")
            .groupBy(*sale)
            .agg(F.sum("quantity").alias("units"), F.sum(F.col("quantity") * F.col("cents")).alias("cents"))
            .withColumn("cents", wide_cents("cents"))
        )
    else:
        by_transaction = (
            once(details, on, "sku", "quantity")
            .join(prices, "sku")
            .groupBy(on)
            .agg(F.sum("quantity").alias("units"), F.sum(F.col("quantity") * F.col("cents")).alias("cents"))
        )
        by_sale = (
            once(in_dates(headers, since, until), on, *sale)
            .join(by_transaction, on)
            .groupBy(*sale)
            .agg(F.sum("units").alias("units"), F.sum(wide_cents("cents")).alias("cents"))
        )
    by_store = (
        by_sale
        .groupBy("supermarket_id")
        .agg(
            F.count("*").alias("transactions"),
            F.sum("units").alias("units"),
            F.sum("cents").alias("cents"),
        )
    )
    return by_store.join(supermarkets.select("supermarket_id", "supermarket_name"), "supermarket_id").select(
        "supermarket_id", "supermarket_name", "transactions", "units", from_cents("cents").cast("double").alias("sales")
    )


def _sku_totals(details: DataFrame, skus: DataFrame) -> DataFrame:
    """Units and sales by SKU. Prices are joined to the sums, one row per SKU, not to the lines."""
    units = details.groupBy("sku").agg(F.sum("quantity").alias("units"))
    return units.join(skus, "sku").select(
        "sku", "article_name", "units", (F.col("units") * F.col("price")).alias("sales")
    )


def top_skus_by_units(details: DataFrame, skus: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` SKUs that sold most pieces; ties go to the lower SKU."""
    totals = _sku_totals(details, skus).select("sku", "article_name", "units")
    return totals.orderBy(F.desc_nulls_last("units"), "sku").limit(k)


def top_skus_by_sales(details: DataFrame, skus: DataFrame, k: int = 10) -> DataFrame:
    totals = _sku_totals(details, skus).select("sku", "article_name", "sales")
    top = totals.orderBy(F.desc_nulls_last("sales"), "sku").limit(k)
    return top.withColumn("sales", F.col("sales").cast("double"))
