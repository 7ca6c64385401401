"""How the raw input is made from the driver's tables."""

from conftest import SMALL, plan_of
from pyspark.sql import functions as F

from basketflow.catalogue import inputs, queries
from basketflow.files import Files
from basketflow.session import temporary_settings
from basketflow.sources import read_fact
from basketflow.workspace import new_folder


def test_lineitems_are_read_and_shuffled_once(spark):
    with temporary_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": -1}):
        plan = plan_of(inputs.transactions(spark, SMALL))
    assert plan.count("lineitem.parquet") == 1
    # Orders and customers meet by customer; then orders and lineitems by order.
    assert plan.count("Exchange hashpartitioning(") == 4


def test_an_order_comes_in_its_parts(spark, tmp_path, monkeypatch):
    """Also parts that no item falls into, and none for lineitems without an order."""
    monkeypatch.setattr(inputs, "RECORD_ITEMS", 2)
    spark.range(1, 4).selectExpr("id as o_orderkey", "1L as o_custkey", "timestamp_ntz '1997-01-01 00:00:00' as o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(1, 2).selectExpr("id as c_custkey", "2 as c_nationkey").write.parquet(f"{tmp_path}/customer.parquet")
    keys = [1] * 31 + [2] + [None] * 5
    items = spark.createDataFrame([(key, n, 1.0) for n, key in enumerate(keys)], "l_orderkey long, l_partkey long, l_quantity double")
    items.coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    sent = inputs.transactions(spark, str(tmp_path)).withColumn("order", F.substring("transaction_id", 3, 7).cast("int") - 1)
    found = {}
    for row in sent.collect():
        found.setdefault(row.order, []).append((row.part or 0, [item.sku for item in row["items"]]))
    assert sorted(part for part, _ in found[1]) == list(range(16))
    assert any(not skus for _, skus in found[1])
    assert sorted(sku for _, skus in found[1] for sku in skus) == [f"SKU{n + 1:05d}" for n in range(31)]
    assert found[2] == [(0, ["SKU00032"])] and found[3] == [(0, [])]


def test_log_files_are_compressed(spark):
    incoming = new_folder(spark, "incoming")
    inputs.deliver(spark, spark.read.text(inputs.log_folder(spark, SMALL)), incoming)
    for folder in (inputs.log_folder(spark, SMALL), inputs.redelivered_log_folder(spark, SMALL), incoming):
        files = [name for name in Files(spark, folder).names(folder) if name.startswith("part-")]
        assert files and all(name.endswith(".gz") for name in files)
    lines = inputs.transaction_lines(spark, SMALL).count() + inputs.junk_lines(spark, SMALL).count()
    assert spark.read.text(incoming).count() == lines


def test_loads_of_the_orphan_audit_are_decoded_once(spark, monkeypatch):
    stored, settled = [], queries.settled
    monkeypatch.setattr(queries, "settled", lambda records: stored.append(1) or settled(records))
    queries.orphans_by_load(spark, SMALL)
    assert len(stored) == 1


def test_shares_are_written_in_one_pass(spark, tmp_path):
    """Each line is in the files of its part; a part without lines leaves an empty folder."""
    sent = [f"TX{number:07d}" for number in (0, 1, 3, 4, 4)] + ["banner"]
    lines = spark.createDataFrame([(line,) for line in sent], "value string").repartition(2)
    landed = []
    for number, share in enumerate(inputs.shares(spark, lines, 3)):
        inputs.land(spark, share, f"{tmp_path}/{number}")
        landed.append(sorted(row.value for row in spark.read.text(f"{tmp_path}/{number}").collect()))
        inputs.land(spark, share, f"{tmp_path}/{number}")
    assert landed == [["TX0000000", "TX0000003", "banner"], ["TX0000001", "TX0000004", "TX0000004"], []]
    assert all(name.endswith(".gz") for name in Files(spark, str(tmp_path)).names(f"{tmp_path}/1"))


def test_lines_are_read_once_for_all_shares(spark, monkeypatch):
    read, shares = [], inputs.shares
    monkeypatch.setattr(inputs, "shares", lambda spark, lines, parts: read.append(parts) or shares(spark, lines, parts))
    monkeypatch.setattr(inputs, "deliver", None)
    assert queries.stream_sales_by_store(spark, SMALL).count() == 25
    assert read == [3]


def test_a_long_load_takes_bounded_batches(spark, monkeypatch):
    monkeypatch.setattr(queries, "BATCH_BYTES", 10_000)
    monkeypatch.setattr(inputs, "redelivered_log_folder", None)
    monkeypatch.setattr(queries, "_stored_contents", lambda spark, folder: read_fact(spark, folder, "headers", stored=True))
    headers = queries.stream_dedupe(spark, SMALL)
    assert headers.count() == inputs.transactions(spark, SMALL).count()
    assert headers.select(F.max("batch_id")).first()[0] > 1


def test_state_is_dealt_by_the_size_of_the_logs(spark, tmp_path, monkeypatch):
    (tmp_path / "a.gz").write_bytes(b"0" * 1000)
    assert queries._state_partitions(spark, str(tmp_path)) == 4
    monkeypatch.setattr(queries, "STATE_BYTES", 100)
    assert queries._state_partitions(spark, str(tmp_path)) == 12
