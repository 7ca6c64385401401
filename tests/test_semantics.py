"""One case per kind of input line: is there a header, which details, which reason or flags."""

import datetime
import json

import pytest
from conftest import as_lines, log_line, sale
from pyspark.sql import functions as F

from basketflow import schemas
from basketflow.operators import audit
from basketflow.operators.decode import accepted, decode_csv_rows, decode_lines, rejected
from basketflow.operators.shred import details, headers
from basketflow.sources import read_transactions_csv

WHEN = datetime.datetime(2024, 4, 10, 19, 22, 28)
ITEM = ("SKU00001", 1)


def tx(**changes):
    record = sale(1)
    record.update(changes)
    return {key: value for key, value in record.items() if value != "absent"}


REFUSED = [
    ("Till number four is starting", "bad_line", False),
    ("", "bad_line", False),
    ("notjson", "bad_line", False),
    ("[1]", "bad_line", False),
    ("5", "bad_line", False),
    ('{"log": "{\\"transaction_id\\": \\"TX1\\"}"', "bad_line", False),
    ('{"log": ""}', "no_log", False),
    ('{"log": null}', "no_log", False),
    ('{"other": 1}', "no_log", False),
    (log_line(sale(1)) + " more", "bad_line", False),
    (log_line(sale(1)) + "}", "bad_line", False),
    (log_line(sale(1)) + "]", "bad_line", False),
    (log_line(sale(1)) + log_line(sale(2)), "bad_line", False),
    (log_line(sale(1)) + "," + log_line(sale(2)), "bad_line", False),
    ("{'log': 'x'}", "bad_line", False),
    ("Till number four is starting", "not_json", True),
    (json.dumps(sale(1)) + " more", "not_json", True),
    (json.dumps(sale(1)) + json.dumps(sale(2)), "not_json", True),
    (json.dumps(sale(1)) + "," + json.dumps(sale(2)), "not_json", True),
    (json.dumps(sale(1)).replace('"', "'"), "not_json", True),
    ("All tills are closed now", "not_json", True),
    (json.dumps(sale(1))[:-1], "not_json", True),
    (json.dumps([sale(1)]), "not_object", True),
    ("5", "not_object", True),
    ('"text"', "not_object", True),
    ('{"x": 1}', "no_id", True),
    ('{"transaction_id": null}', "null_id", True),
]


@pytest.fixture(scope="module")
def refused(spark):
    lines = [log_line(text) if wrapped else text for text, _, wrapped in REFUSED]
    frame = as_lines(spark, lines)
    return lines, {r.raw: r.reason for r in rejected(decode_lines(frame)).collect()}, frame


def test_refused_lines(refused):
    lines, reasons, frame = refused
    assert reasons == {line: reason for line, (_, reason, _) in zip(lines, REFUSED, strict=True)}
    records = decode_lines(frame)
    assert headers(records).count() == 0
    assert details(records).count() == 0


def test_every_reason_and_flag_has_a_case():
    assert {reason for _, reason, _ in REFUSED} == set(schemas.REJECT_REASONS) - {"bad_row", "bad_file"}  # rows of CSV files, and files
    assert {flag for *_, flags in KEPT.values() for flag in flags} == set(schemas.FLAGS)


def test_refused_lines_have_no_key_or_flags(refused):
    rows = decode_lines(refused[2]).select("tx_key", "flags").collect()
    assert all(r.tx_key is None and r.flags is None for r in rows)


KEPT = {
    "two items with one SKU": (tx(items=[{"sku": "S", "quantity": 1}, {"sku": "S", "quantity": 2}]),
                               WHEN, [("S", 1), ("S", 2)], []),
    "date that is no date": (tx(transaction_date="bad"), None, [ITEM], ["bad_date"]),
    "date without time": (tx(transaction_date="2024-04-10"), None, [ITEM], ["bad_date"]),
    "date with T": (tx(transaction_date="2024-04-10T19:22:28"), None, [ITEM], ["bad_date"]),
    "date with zone": (tx(transaction_date="2024-04-10 19:22:28Z"), None, [ITEM], ["bad_date"]),
    "day that does not exist": (tx(transaction_date="2024-02-30 10:00:00"), None, [ITEM], ["bad_date"]),
    "no date": (tx(transaction_date="absent"), None, [ITEM], ["bad_date"]),
    "hour skipped by a clock change": (tx(transaction_date="2024-03-31 02:30:00"),
                                       datetime.datetime(2024, 3, 31, 2, 30), [ITEM], []),
    "quantity as text": (tx(items=[{"sku": "S", "quantity": "3"}]), WHEN, [("S", None)], ["bad_quantity"]),
    "fractional quantity": (tx(items=[{"sku": "S", "quantity": 1.5}]), WHEN, [("S", None)], ["bad_quantity"]),
    "huge quantity": (tx(items=[{"sku": "S", "quantity": 99999999999}]), WHEN, [("S", None)], ["bad_quantity"]),
    "one bad quantity of two": (tx(items=[{"sku": "A", "quantity": "x"}, {"sku": "B", "quantity": 2}]),
                                WHEN, [("A", None), ("B", 2)], ["bad_quantity"]),
    "no items": (tx(items="absent"), WHEN, [], []),
    "empty items": (tx(items=[]), WHEN, [], []),
    "null items": (tx(items=None), WHEN, [], []),
    "items as text": (tx(items="nothing"), WHEN, [], ["bad_items"]),
    "null among items": (tx(items=[None, {"sku": "S", "quantity": 1}]), WHEN, [("S", 1)], ["null_item"]),
    "only a null item": (tx(items=[None]), WHEN, [], ["null_item"]),
    "a bare object as items": (tx(items={"sku": "S", "quantity": 1}), WHEN, [], ["bad_items"]),
    "item without SKU": (tx(items=[{"quantity": 1}]), WHEN, [(None, 1)], []),
    "blanks around": ("  " + json.dumps(sale(1)) + " ", WHEN, [ITEM], []),
    "the last of two equal names": (json.dumps(sale(9))[:-1] + ', "transaction_id": "TX0000001"}', WHEN, [ITEM], []),
    "more fields than known": (tx(cashier="A"), WHEN, [ITEM], []),
}


@pytest.mark.parametrize("case", KEPT)
def test_kept_line(spark, case):
    record, date, items, flags = KEPT[case]
    records = decode_lines(as_lines(spark, [log_line(record)]))
    header = headers(records).collect()
    assert [tuple(r) for r in header] == [("TX0000001", "STORE0001", date)]
    found = [(r.transaction_id, r.sku, r.quantity) for r in details(records).collect()]
    assert sorted(found, key=repr) == sorted([("TX0000001", *item) for item in items], key=repr)
    assert accepted(records).first().flags == flags


def test_log_given_as_an_object_is_taken(spark):
    records = decode_lines(as_lines(spark, [json.dumps({"log": sale(1)})]))
    assert headers(records).count() == 1


@pytest.mark.parametrize("zone", ["Europe/Madrid", "America/New_York", "UTC"])
def test_dates_do_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        records = decode_lines(as_lines(spark, [log_line(tx(transaction_date="2024-03-31 02:30:00"))]))
        text = headers(records).select(F.col("transaction_date").cast("string").alias("t")).first().t
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert text == "2024-03-31 02:30:00"


def test_lines_break_at_line_feeds_only(spark, tmp_path):
    from basketflow.sources import read_log_lines

    line = json.dumps({"log": json.dumps(sale(1, store="STORE "), ensure_ascii=False)}, ensure_ascii=False)
    (tmp_path / "a.log").write_text(line + "\r\n" + log_line(sale(2)) + "\n", encoding="utf-8")
    records = decode_lines(read_log_lines(spark, str(tmp_path)))
    assert {r.supermarket_id for r in headers(records).collect()} == {"STORE ", "STORE0001"}


def csv_rows(spark, rows):
    return spark.createDataFrame(
        rows, "transaction_id string, supermarket_id string, transaction_date string, items string"
    ).select("*", F.lit("test").alias("source_file"), F.current_timestamp().alias("arrived_at"))


def test_csv_rows(spark):
    good = '[{"sku": "S", "quantity": 2}]'
    records = decode_csv_rows(
        csv_rows(
            spark,
            [
                ("TX1", "A", "2024-04-10 19:22:28", good),
                ("TX2", "A", "2024-04-10 19:22:28", "[{broken"),
                ("TX3", "A", "10/04/2024", "[]"),
                ("TX4", "A", "2024-04-10 19:22:28", None),
                ("TX5", "A", "2024-04-10 19:22:28", '{"sku": "T", "quantity": 1}'),
                ("TX6", "A", "2024-04-10 19:22:28", good + good),
                (None, "A", "2024-04-10 19:22:28", good),
            ],
        )
    )
    assert {r.transaction_id: r.transaction_date for r in headers(records).collect()} == {
        "TX1": WHEN, "TX2": WHEN, "TX3": None, "TX4": WHEN, "TX5": WHEN, "TX6": WHEN}
    # A bare object stands for a list of one when it is the whole field.
    assert {tuple(r) for r in details(records).collect()} == {("TX1", "S", 2), ("TX5", "T", 1)}
    flags = {r.tx.transaction_id: r.flags for r in accepted(records).collect()}
    assert flags == {"TX1": [], "TX2": ["bad_items"], "TX3": ["bad_date"], "TX4": [], "TX5": [], "TX6": ["bad_items"]}
    refused = rejected(records).collect()
    assert [r.reason for r in refused] == ["null_id"]
    assert json.loads(refused[0].raw)["items"] == good


def test_broken_csv_rows(spark, tmp_path):
    """A row that does not fit the header is refused whole; a line break inside a field needs ``multi_line``."""
    text = (
        "transaction_id,supermarket_id,transaction_date,items\n"
        'TX1,A,2024-04-10 19:22:28,"[{""sku"": ""S"", ""quantity"": 2}]",more\n'
        "TX2,A\n"
        'TX3,A,2024-04-10 19:22:28,"[{""sku"": ""S"",\n""quantity"": 2}]"\n'
    )
    (tmp_path / "a.csv").write_text(text, encoding="utf-8")
    records = decode_csv_rows(read_transactions_csv(spark, str(tmp_path)))
    assert sorted(r.reason for r in rejected(records).collect()) == ["bad_row"] * 3
    assert [(r.tx.transaction_id, r.flags) for r in accepted(records).collect()] == [("TX3", ["bad_items"])]
    whole = decode_csv_rows(read_transactions_csv(spark, str(tmp_path), multi_line=True))
    assert [tuple(r) for r in details(whole).collect()] == [("TX3", "S", 2)]
    assert rejected(whole).count() == 2


def test_counts(spark):
    lines = [log_line(tx(transaction_date="bad")), log_line("prose"), log_line("prose"), "prose"]
    records = decode_lines(as_lines(spark, lines))
    assert {tuple(r) for r in audit.reject_counts(records).collect()} == {("not_json", 2), ("bad_line", 1)}
    assert {tuple(r) for r in audit.flag_counts(records).collect()} == {("bad_date", 1)}
