"""Raw rows to records.

A record has the columns ``tx`` (the transaction as a struct), ``tx_key`` (its identity),
``reason`` (why the row is refused; null if it is kept), ``flags`` (notes on a kept one), ``raw``
(the text of a refused row), ``source_file`` and ``arrived_at``. Batch and stream use the same
functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketflow import schemas
from basketflow.functions import parse_local_time


def _key_of(text: Column) -> Column:
    """Identity of a record, carried into both fact tables to link them.

    Tills hand out transaction ids again after a restart, so the id alone would mix up sales. The
    key covers the text of the whole record: a redelivered copy has the same one, and a record
    that differs in anything keeps its own.
    """
    return F.unhex(F.sha2(text, 256))


def _parse_once(parsed: Column) -> Column:
    """Keep one parse in the plan.

    Filters on a projected ``from_json`` are pushed below it as a second copy of the parse. A
    one-element generator is a boundary they do not cross; the outer form also keeps the
    optimizer from adding a size test, which would be a third copy.
    """
    return F.explode_outer(F.array(parsed))


def _alone(text: Column) -> Column:
    """The text as the first of two array elements.

    Spark's JSON functions stop after the first value and ignore what follows, so a line holding
    two records would lose the second. Here anything beside one value breaks the array or its
    length.
    """
    return F.concat(F.lit("["), text, F.lit(",null]"))


def _parse_alone(text: str, kind: str) -> Column:
    return F.from_json(_alone(F.col(text)), f"array<{kind}>", {"allowSingleQuotes": "false"})


def _only_element(parsed: str) -> Column:
    return F.when(F.size(parsed) == 2, F.get(parsed, F.lit(0)))


def _variant_alone(text: str) -> Column:
    array = _alone(F.col(text))
    value = F.try_variant_get(F.try_parse_json(array), "$[0]", "variant")
    return F.when(F.json_array_length(array) == 2, value)


def _is_object(variant: Column) -> Column:
    return F.coalesce(F.schema_of_variant(variant).like("OBJECT%"), F.lit(False))


def _reject_reason() -> Column:
    """Needs a full parse of its own, so it is evaluated for refused rows only."""
    outer, inner = _variant_alone("value"), _variant_alone("log")
    return (
        F.when(~_is_object(outer), "bad_line")
        .when(F.col("log").isNull() | (F.col("log") == ""), "no_log")
        .when(inner.isNull(), "not_json")
        .when(~_is_object(inner), "not_object")
        .when(~F.schema_of_variant(inner).like("%transaction_id%"), "no_id")
        .otherwise("null_id")
    )


def _flags(items_text: Column) -> Column:
    items = F.col("tx.items")
    date_lost = parse_local_time(F.col("tx.transaction_date")).isNull()
    # get_json_object and a null CSV field both give null when nothing was sent.
    items_lost = items.isNull() & items_text.isNotNull()
    null_item = F.exists(items, lambda item: item.isNull())
    quantity_lost = F.exists(items, lambda item: item.isNotNull() & item["quantity"].isNull())
    return F.array_compact(
        F.array(
            F.when(date_lost, "bad_date"),
            F.when(items_lost, "bad_items"),
            F.when(null_item, "null_item"),
            F.when(quantity_lost, "bad_quantity"),
        )
    )


def decode_lines(lines: DataFrame) -> DataFrame:
    """Log lines (``value``, ``source_file``, ``arrived_at``) to records.

    Each line is a JSON object whose ``log`` value is itself JSON text. ``from_json`` can give a
    struct of nulls, not null, for text it cannot read, so the test is on the transaction id. A file that
    could not be read comes as one row with the reason in ``unreadable``.
    """
    if "unreadable" not in lines.columns:
        lines = lines.withColumn("unreadable", F.lit(None).cast("string"))
    opened = lines.withColumn("envelopes", _parse_alone("value", schemas.ENVELOPE_TYPE)).withColumn(
        "log", _only_element("envelopes")["log"]
    )
    parsed = opened.select(
        "*", _parse_once(_parse_alone("log", schemas.TRANSACTION_TYPE)).alias("transactions")
    ).withColumn("tx", _only_element("transactions"))
    refused = F.col("tx.transaction_id").isNull()
    items_text = F.get_json_object("log", "$.items")
    return parsed.select(
        "tx",
        F.when(~refused, _key_of(F.col("log"))).alias("tx_key"),
        F.when(F.col("unreadable").isNotNull(), "bad_file").when(refused, _reject_reason()).alias("reason"),
        F.when(~refused, _flags(items_text)).alias("flags"),
        F.coalesce("unreadable", F.when(refused, F.col("value"))).alias("raw"),
        "source_file",
        "arrived_at",
    )


def _bare_item() -> Column:
    """An object that is the whole field stands for a list of one."""
    alone = F.json_array_length(_alone(F.col("items"))) == 2
    bare = F.ltrim("items").startswith("{") & alone
    return F.when(bare, F.from_json(F.concat(F.lit("["), "items", F.lit("]")), schemas.ITEMS_TYPE))


def decode_csv_rows(rows: DataFrame) -> DataFrame:
    """CSV rows (the four text columns, ``source_file``, ``arrived_at``) to records.

    A row with more or fewer fields than the header is refused. An item list with anything beside it
    cannot be read and is flagged, as in a log line.
    """
    if schemas.CSV_BROKEN not in rows.columns:
        rows = rows.withColumn(schemas.CSV_BROKEN, F.lit(None).cast("string"))
    broken = F.col(schemas.CSV_BROKEN)
    parsed = rows.select(
        "*", _parse_once(_parse_alone("items", schemas.ITEMS_TYPE)).alias("item_lists")
    ).withColumn("parsed_items", F.coalesce(_only_element("item_lists"), _bare_item()))
    tx = F.struct(
        F.when(broken.isNull(), F.col("transaction_id")).alias("transaction_id"),
        "supermarket_id",
        "transaction_date",
        F.col("parsed_items").alias("items"),
    )
    text = F.to_json(F.struct("transaction_id", "supermarket_id", "transaction_date", "items"))
    refused = broken.isNotNull() | F.col("transaction_id").isNull()
    return parsed.withColumn("tx", tx).withColumn("text", F.coalesce(broken, text)).select(
        "tx",
        F.when(~refused, _key_of(F.col("text"))).alias("tx_key"),
        F.when(broken.isNotNull(), "bad_row").when(refused, "null_id").alias("reason"),
        F.when(~refused, _flags(F.col("items"))).alias("flags"),
        F.when(refused, F.col("text")).alias("raw"),
        "source_file",
        "arrived_at",
    )


def accepted(records: DataFrame) -> DataFrame:
    return records.where(F.col("tx.transaction_id").isNotNull())


def rejected(records: DataFrame) -> DataFrame:
    return records.where(F.col("tx.transaction_id").isNull())
