"""What the plans must and must not hold."""

import random

import re

import pytest
from conftest import SMALL, plan_of, write_lines, log_line, sale
from pyspark.sql import functions as F

from basketflow.catalogue import inputs
from basketflow.catalogue.queries import QUERIES
from basketflow.operators import audit
from basketflow.operators.decode import decode_lines
from basketflow.operators.dedupe import drop_already_loaded, drop_copies
from basketflow.operators.numbering import number_rows
from basketflow.operators.shred import details, headers
from basketflow.plans import reports
from basketflow.sinks import append_load, fact_rows
from basketflow.sources import read_fact, read_log_lines


@pytest.fixture(scope="module")
def records(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("logs"))
    write_lines(folder, [log_line(sale(1)), "banner"])
    return decode_lines(read_log_lines(spark, folder))


LAZY = ["join_header_detail", "line_revenue", "sales_by_store", "orphan_details", "quantity_profile",
        "basket_size_profile", "domain_violations", "open_hours_filter", "format_keys", "local_time"]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    assert "Python" not in plan and "Arrow" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("shape", [headers, details, fact_rows, drop_copies])
def test_each_line_is_parsed_once(records, shape):
    """One parse of the envelope and one of the transaction; refused lines get their reason apart."""
    plan = plan_of(shape(records))
    assert plan.count("from_json(") == 2


@pytest.mark.parametrize("shape", [headers, details, fact_rows])
def test_shredding_does_not_shuffle(records, shape):
    plan = plan_of(shape(records))
    assert "Exchange" not in plan and "Sort" not in plan


def test_dropping_copies_combines_before_the_shuffle(records):
    plan = plan_of(drop_copies(records))
    assert plan.count("HashAggregate") == 2 and "SortAggregate" not in plan
    assert plan.count("Exchange") == 1


def test_sales_are_summed_before_the_shuffle(spark):
    """Without broadcasts there is one shuffle for each join side and none between the join on the
    transaction and the sums by store."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plan_of(
            reports.sales_by_store(
                inputs.headers(spark, SMALL), inputs.details(spark, SMALL),
                inputs.skus(spark, SMALL), inputs.supermarkets(spark, SMALL),
            )
        )
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    # orders, customers, headers, details, sums by transaction, SKUs, sums by store, stores
    assert plan.count("Exchange hashpartitioning") == 8
    assert plan.count("partial_sum") == 6


def test_dimensions_are_broadcast_only_below_the_threshold(spark):
    def joins(threshold):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            return plan_of(QUERIES["line_revenue"](spark, SMALL))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

    assert "BroadcastHashJoin" in joins("10m")
    assert "BroadcastHashJoin" not in joins("100b")


SKEW_SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.files.maxPartitionBytes": "20k",
    "spark.sql.files.openCostInBytes": "1k",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.mark.parametrize(
    ("name", "hot"),
    [
        ("join_header_detail", "l_orderkey"),
        ("orphan_details", "l_orderkey"),
        ("line_revenue", "l_partkey"),
        ("sales_by_store", "l_partkey"),
    ],
)
def test_a_hot_key_is_split_when_nothing_is_broadcast(spark, tmp_path, name, hot):
    """Half of the details are on one order or one SKU; with the thresholds scaled down to the
    test the adaptive plan divides that partition, and the result stays the same."""
    for table in ("lineitem", "orders", "customer", "part", "nation"):
        rows = inputs.table(spark, SMALL, table)
        if table == "lineitem":
            rows = rows.withColumn(hot, F.when(F.col("l_linenumber") % 2 == 0, 1499 if hot == "l_orderkey" else 7)
                                   .otherwise(F.col(hot)).cast("bigint"))
        # Several files, as a split needs several map tasks.
        rows.repartition(8).write.parquet(str(tmp_path / f"{table}.parquet"))
    expected = sorted(map(tuple, QUERIES[name](spark, str(tmp_path)).collect()))
    before = {key: spark.conf.get(key, None) for key in SKEW_SETTINGS}
    for key, value in SKEW_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        result = QUERIES[name](spark, str(tmp_path))
        assert sorted(map(tuple, result.collect())) == expected
        plan = plan_of(result)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert "BroadcastHashJoin" not in plan
    assert "skew=true" in plan


def test_top_k_keeps_k_rows_per_task(spark):
    assert "TakeOrderedAndProject" in plan_of(QUERIES["top_skus_by_units"](spark, SMALL))


def test_dated_report_cuts_both_scans(spark):
    plan = plan_of(QUERIES["sales_by_store_dated"](spark, SMALL))
    scans = [line for line in plan.splitlines() if "FileScan" in line and "_merged" in line]
    assert len(scans) == 2 and all("GreaterThanOrEqual(transaction_date" in scan for scan in scans)
    assert all(re.search(r"PartitionFilters: \[[^]]*day#\d+ >= 1997-01-01[^]]*day#\d+ < 1998", scan) for scan in scans)


def test_late_copies_do_not_shuffle_the_history(spark, records, tmp_path):
    append_load(records, str(tmp_path), "first")
    stored = read_fact(spark, str(tmp_path), "headers", stored=True)
    new = drop_already_loaded(records, stored)
    assert new.where("tx is not null and reason is null").count() == 0
    history = [line for line in plan_of(new).splitlines() if "BroadcastHashJoin" in line and "LeftSemi" in line]
    assert len(history) == 1


def test_baskets_are_bounded(spark, skewed_dir):
    """An order with a third of all lineitems is not collected into one list."""
    sizes = inputs.transactions(spark, skewed_dir).select(F.size("items").alias("n"))
    assert sizes.agg(F.max("n").alias("n")).first().n < 60
    assert sizes.agg(F.sum("n").alias("n")).first().n == inputs.details(spark, skewed_dir).count()


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_numbers_equal_a_sorted_list(spark, partitions):
    draw = random.Random(5)
    rows = [(draw.choice([1, 1, 1, draw.randint(0, 50)]), n) for n in range(3000)]
    draw.shuffle(rows)
    frame = spark.createDataFrame(rows, "day int, id int").repartition(5)
    numbered = number_rows(frame, ["day", "id"], "n", partitions).collect()
    assert {(r.day, r.id): r.n for r in numbered} == {row: n for n, row in enumerate(sorted(rows), 1)}


def test_numbering_of_nothing(spark):
    assert number_rows(spark.range(0), ["id"]).count() == 0


def test_orphans_with_null_keys_are_kept(spark):
    children = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), (None, 4)], "transaction_id string, n int")
    parents = spark.createDataFrame([("a",), (None,)], "transaction_id string")
    found = audit.without_parent(children, parents, "transaction_id")
    assert found.columns == ["transaction_id", "n"]
    assert sorted(r.n for r in found.collect()) == [2, 3, 4]
