import datetime

import pytest
from pyspark.sql import functions as F

from basketflow import functions as B


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize("number", [0, 1, 42, 9999999, 10000000, 123456789012, -5])
def test_keys_widen_like_python_formatting(spark, number):
    n = F.lit(number).cast("bigint")
    assert one(spark, B.transaction_key(n)) == f"TX{number:07d}"
    assert one(spark, B.store_key(n)) == f"STORE{number:04d}"
    assert one(spark, B.sku_key(n)) == f"SKU{number:05d}"


def test_key_of_null_is_null(spark):
    assert one(spark, B.sku_key(F.lit(None).cast("bigint"))) is None


@pytest.mark.parametrize(
    ("text", "open_"),
    [
        ("2024-04-08 08:59:59", False),  # Monday
        ("2024-04-08 09:00:00", True),
        ("2024-04-13 20:59:59", True),  # Saturday
        ("2024-04-13 21:00:00", False),
        ("2024-04-14 12:00:00", False),  # Sunday
    ],
)
def test_opening_hours(spark, text, open_):
    assert one(spark, B.in_opening_hours(F.lit(text).cast("timestamp_ntz"))) is open_


def test_store_zone(spark):
    for utc, local in [("2024-01-15 12:00:00", 13), ("2024-07-15 12:00:00", 14)]:
        assert one(spark, B.zone_time(F.lit(utc).cast("timestamp_ntz"))).hour == local


@pytest.mark.parametrize("text", ["2024-04-10 19:22:28", "2024-03-31 02:30:00", "0001-01-01 00:00:00"])
def test_time_text_round_trip(spark, text):
    assert one(spark, B.format_local_time(B.parse_local_time(F.lit(text)))) == text


def test_time_text_drops_fractions(spark):
    ts = F.lit(datetime.datetime(2024, 4, 10, 19, 22, 28, 500000)).cast("timestamp_ntz")
    assert one(spark, B.format_local_time(ts)) == "2024-04-10 19:22:28"


def test_money(spark):
    assert str(one(spark, B.money(F.lit("9.995")))) == "10.00"
    assert str(one(spark, B.money(F.lit("3.1")))) == "3.10"
    assert one(spark, B.money(F.lit("free"))) is None
    assert str(one(spark, B.from_cents(B.wide_cents(B.in_cents(B.money(F.lit("12.34"))))))) == "12.34"
