"""Live load: replay, restart, redelivery, lateness, archive."""

import collections
import json
import math
import os
import random
import threading
import time
import uuid

import pytest
from conftest import as_lines, log_line, plan_of, sale, write_lines
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from basketflow.files import Files
from basketflow.operators.decode import decode_lines
from basketflow.operators.dedupe import drop_already_loaded
from basketflow.sinks import generations, merge, sketches, stored_copies
from basketflow.sinks.merge import merge_batches
from basketflow.sources import read_fact
from basketflow.streaming import ingest, live_sales, read_live_sales, start_ingest, start_live_sales
from basketflow.streaming.archive import close_archive
from basketflow.streaming.clock import ClockError, clock_guard


class Feed:
    def __init__(self, spark, root):
        self.spark, self.root = spark, str(root)
        self.incoming, self.facts, self.progress = (os.path.join(self.root, n) for n in ("in", "facts", "progress"))
        os.makedirs(self.incoming)

    def deliver(self, *lines):
        return write_lines(self.incoming, lines)

    def load(self, **options):
        options.setdefault("lanes", 2)
        query = start_ingest(self.spark, self.incoming, self.facts, self.progress, **options)
        query.awaitTermination()
        return query

    def count(self, table):
        return read_fact(self.spark, self.facts, table).count()

    def ids(self):
        return sorted(r.transaction_id for r in read_fact(self.spark, self.facts, "headers").collect())


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def crash_mix(feed):
    """Four files: 4 sales, each sent twice, 4 lines of junk; one old date, one bad date."""
    dates = ["2024-04-10 10:00:00", "2020-01-01 10:00:00", "bad", "2024-04-10 11:00:00"]
    sales = [log_line(sale(n, items=[("A", 1), ("B", 2)], date=date)) for n, date in enumerate(dates)]
    feed.deliver(sales[0], "banner", sales[1])
    feed.deliver(log_line("banner"), sales[2])
    feed.deliver(sales[0], sales[3], "banner")
    feed.deliver(sales[1], sales[2], sales[3], log_line("banner"))


@pytest.mark.parametrize("lanes", [1, 4])
def test_load(feed, lanes):
    crash_mix(feed)
    feed.load(lanes=lanes, max_files=1)
    assert (feed.count("headers"), feed.count("details"), feed.count("rejects")) == (4, 8, 4)


def test_failure_after_some_batches_and_restart(feed):
    crash_mix(feed)

    def fail_late(_batch, batch_id):
        if batch_id == 2:
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        feed.load(max_files=1, before_write=fail_late)
    feed.load(max_files=1)
    assert (feed.count("headers"), feed.count("details"), feed.count("rejects")) == (4, 8, 4)


def test_batch_written_but_not_committed_is_replaced(feed):
    """The crash comes after the write; the batch runs again and must not double its rows."""
    feed.deliver(log_line(sale(1)), "banner")
    feed.load()
    commits = os.path.join(feed.progress, "commits")
    written = [name for name in os.listdir(commits) if name.strip(".").split(".")[0].isdigit()]
    for name in written:
        os.rename(os.path.join(commits, name), os.path.join(feed.root, name))
    feed.deliver(log_line(sale(2)))
    feed.load()
    assert feed.ids() == ["TX0000001", "TX0000002"]
    assert feed.count("rejects") == 1


def test_second_stream_on_the_same_tables_keeps_the_rows_of_the_first(feed):
    feed.deliver(log_line(sale(1)))
    feed.load()
    other = os.path.join(feed.root, "other")
    write_lines(other, [log_line(sale(2))])
    start_ingest(feed.spark, other, feed.facts, feed.progress + "2").awaitTermination()
    assert feed.ids() == ["TX0000001", "TX0000002"]


def test_redelivery_under_another_name_in_a_later_run(feed):
    feed.deliver(log_line(sale(1)), "banner")
    feed.load()
    feed.deliver(log_line(sale(1)), log_line(sale(2)), "banner")
    feed.load()
    assert feed.ids() == ["TX0000001", "TX0000002"]
    assert feed.count("rejects") == 2


def test_copy_after_the_horizon_is_left_to_the_batch_check(feed):
    """State lives only as long as the horizon; a check against the stored keys finds later copies."""
    copy = log_line(sale(1))
    feed.deliver(copy)
    feed.load(horizon="1 second")
    for number in (2, 3, 4):
        time.sleep(2)
        feed.deliver(log_line(sale(number)))
        feed.load(horizon="1 second")
    stored = read_fact(feed.spark, feed.facts, "headers", stored=True)
    arrived = decode_lines(as_lines(feed.spark, [copy, log_line(sale(5))]))
    new = drop_already_loaded(arrived, stored).select("tx.transaction_id").collect()
    assert [r.transaction_id for r in new] == ["TX0000005"]
    feed.deliver(copy)
    feed.load(horizon="1 second")
    assert feed.ids().count("TX0000001") == 2


def test_late_sale_is_kept(feed):
    feed.deliver(log_line(sale(2, date="2024-04-10 10:00:00")))
    feed.load()
    feed.deliver(log_line(sale(1, date="2023-04-10 10:00:00")))
    feed.load()
    feed.deliver(log_line(sale(3, date="bad")))
    feed.load()
    assert feed.ids() == ["TX0000001", "TX0000002", "TX0000003"]


def test_without_dedupe_every_delivery_is_appended(feed):
    feed.deliver(log_line(sale(1)), log_line(sale(1)))
    feed.load(horizon=None)
    assert feed.ids() == ["TX0000001", "TX0000001"]


def test_copies_as_a_third_of_all_lines(feed):
    lines = [log_line(sale(n)) for n in range(200)] + [log_line(sale(7))] * 100
    random.Random(1).shuffle(lines)
    for part in range(4):
        feed.deliver(*lines[part::4])
    feed.load(lanes=8, max_files=2)
    assert feed.ids() == [f"TX{n:07d}" for n in range(200)]


def test_processed_files_are_archived(feed):
    archive = os.path.join(feed.root, "archive")
    for n in range(3):
        feed.deliver(log_line(sale(n)))
        feed.load(archive_dir=archive)
    # A file is moved during a run after the one that committed it.
    left = len(os.listdir(feed.incoming))
    moved = sum(len(files) for _, _, files in os.walk(archive))
    assert moved >= 1
    assert left + moved == 3
    assert feed.ids() == [f"TX{n:07d}" for n in range(3)]


def test_stream_that_keeps_running(feed):
    query = start_ingest(feed.spark, feed.incoming, feed.facts, feed.progress, lanes=2,
                         trigger={"processingTime": "0 seconds"})
    try:
        for n in range(3):
            feed.deliver(log_line(sale(n)), log_line(sale(0)))
            query.processAllAvailable()
            assert feed.ids() == [f"TX{m:07d}" for m in range(n + 1)]
    finally:
        query.stop()


def test_state_partitions(feed):
    feed.deliver(log_line(sale(1)))
    feed.load(state_partitions=2)
    operators = [os.path.join(feed.progress, "state", name) for name in ("0", "1")]
    assert [sorted(n for n in os.listdir(o) if n.isdigit()) for o in operators] == [["0", "1"], ["0", "1"]]
    assert feed.spark.conf.get("spark.sql.shuffle.partitions") == "4"


def test_batches_bounded_by_size(feed):
    crash_mix(feed)
    query = feed.load(max_bytes=200)
    assert query.lastProgress["batchId"] >= 3
    assert (feed.count("headers"), feed.count("details"), feed.count("rejects")) == (4, 8, 4)


def parquet_files(folder):
    return [name for _, _, names in os.walk(folder) for name in names if name.endswith(".parquet")]


def test_a_batch_has_few_files(feed):
    """Without a number of files there is one for each task and table."""
    for part in range(12):
        feed.deliver(*[log_line(sale(100 * part + n)) for n in range(20)], "banner")
    feed.load(horizon=None, files=1)
    assert len(parquet_files(feed.facts)) == 3
    assert (feed.count("headers"), feed.count("rejects")) == (240, 12)
    other = os.path.join(feed.root, "loose")
    start_ingest(feed.spark, feed.incoming, other, feed.progress + "2", horizon="1 hour", lanes=1).awaitTermination()
    assert len(parquet_files(other)) > 3


def test_merged_batches(feed):
    for n in range(4):
        feed.deliver(log_line(sale(n)), "banner")
        query = feed.load(horizon=None)
    home = os.path.join(feed.facts, "table=headers", "origin=realtime", f"stream_id={query.id}")
    assert len(os.listdir(home)) == 4
    merged = merge_batches(feed.spark, feed.facts, feed.progress, query.id)
    assert merged.folders == 4 and merged.size > 0
    assert read_fact(feed.spark, feed.facts, "headers").select(F.input_file_name()).distinct().count() == 1
    again = merge_batches(feed.spark, feed.facts, feed.progress, query.id, keep_seconds=0)
    assert again.folders == 0 and not os.listdir(home)
    feed.deliver(log_line(sale(4)))
    feed.load(horizon=None)
    assert feed.ids() == [f"TX{n:07d}" for n in range(5)]
    assert (feed.count("details"), feed.count("rejects")) == (5, 4)
    stored = read_fact(feed.spark, feed.facts, "headers", stored=True)
    assert sorted(r.batch_id for r in stored.collect()) == [0, 1, 2, 3, 4]


def test_a_merge_that_broke_off_is_as_if_it_had_not_been(feed, monkeypatch):
    for n in range(4):
        feed.deliver(log_line(sale(n)))
        query = feed.load(horizon=None)
    for step in ("write_unit", "publish"):
        with monkeypatch.context() as broken:
            where = merge if step == "write_unit" else merge.generations
            original = getattr(where, step)

            def lost(*args, original=original, step=step, **options):
                if step == "write_unit":
                    original(*args, **options)
                raise RuntimeError("lost")

            broken.setattr(where, step, lost)
            with pytest.raises(RuntimeError, match="lost"):
                merge_batches(feed.spark, feed.facts, feed.progress, query.id)
        assert feed.ids() == [f"TX{n:07d}" for n in range(4)]
    assert merge_batches(feed.spark, feed.facts, feed.progress, query.id).folders == 4
    merge_batches(feed.spark, feed.facts, feed.progress, query.id, keep_seconds=0)
    assert len(os.listdir(os.path.join(feed.facts, "_merged"))) == 1
    assert len(os.listdir(os.path.join(feed.facts, "_sketches"))) == 1
    assert feed.ids() == [f"TX{n:07d}" for n in range(4)]


def test_of_two_merges_at_a_time_one_wins(feed, monkeypatch):
    for n in range(4):
        feed.deliver(log_line(sale(n)))
        query = feed.load(horizon=None)
    original = merge.write_unit

    def slow(*args, **options):
        unit = original(*args, **options)
        monkeypatch.setattr(merge, "write_unit", original)
        merge_batches(feed.spark, feed.facts, feed.progress, query.id)
        return unit

    monkeypatch.setattr(merge, "write_unit", slow)
    with pytest.raises(generations.GenerationTaken):
        merge_batches(feed.spark, feed.facts, feed.progress, query.id)
    assert feed.ids() == [f"TX{n:07d}" for n in range(4)]


def test_readers_see_every_row_while_merges_go_on(feed):
    """A reader in a loop, through merges and the removal of what they replaced."""
    seen, stop, done = [], threading.Event(), []

    def read():
        while not stop.is_set():
            least = len(done)
            seen.append((least, feed.count("details")))

    reader = threading.Thread(target=read)
    for n in range(12):
        feed.deliver(log_line(sale(n)))
        query = feed.load(horizon=None)
        done.append(n)
        if n == 0:
            reader.start()
        if n % 2:
            # Replaced folders outlive one generation; the reader here is never older than that.
            merge_batches(feed.spark, feed.facts, feed.progress, query.id, fan=2, base_bytes=1, keep_seconds=1)
    stop.set()
    reader.join()
    assert len(seen) > 5
    assert all(least <= count <= 12 for least, count in seen)
    assert feed.count("details") == 12


def test_each_byte_is_rewritten_a_logarithm_of_times():
    """Loads of one size, a merge after each: what 200 merges write, by the size of all."""
    sizes, written, most = [], 0, 0
    for _ in range(200):
        sizes.append(100)
        for a, b in reversed(merge.runs_to_merge(sizes, 100, 4)):
            written += sum(sizes[a:b])
            sizes[a:b] = [sum(sizes[a:b])]
        most = max(most, len(sizes))
    assert sum(sizes) == 20_000 and most <= 16
    assert written <= 20_000 * math.log(200, 4)
    # A small load between large ones goes with them once a tier is full.
    assert merge.runs_to_merge([1000, 10, 1000, 10, 1000, 1000], 100, 4) == [(0, 6)]
    assert merge.runs_to_merge([], 100, 4) == [] and merge.runs_to_merge([5, 5, 5], 100, 4) == []


def test_bytes_rewritten_over_twenty_merges(feed):
    """Of the stream's own files: far below what merging all of it each time would read."""
    read, total = 0, 0
    for n in range(20):
        feed.deliver(*[log_line(sale(100 * n + k)) for k in range(20)])
        query = feed.load(horizon=None)
        total += sum(p.size for p in merge._parts(feed.spark, feed.facts, "realtime", query.id, n) if not p.run)
        read += merge_batches(feed.spark, feed.facts, feed.progress, query.id, fan=4, base_bytes=20_000, keep_seconds=0).size
    loads = total / 20
    assert 0 < read < loads * 20 * 3 < loads * 20 * 21 / 2
    assert feed.count("headers") == 400
    assert len(generations.current(feed.spark, feed.facts).units) <= 6


def test_files_of_a_unit_cover_narrow_spans_of_dates(feed):
    """Loads whose dates are mixed; afterwards no two files overlap."""
    for n in range(4):
        feed.deliver(*[log_line(sale(100 * n + k, date=f"2024-{k % 12 + 1:02d}-10 10:00:{k:02d}")) for k in range(48)])
        query = feed.load(horizon=None)
    merge_batches(feed.spark, feed.facts, feed.progress, query.id, file_bytes=2000)
    by_file = read_fact(feed.spark, feed.facts, "headers", stored=True).groupBy(F.input_file_name()).agg(F.min("transaction_date").alias("low"), F.max("transaction_date").alias("high"))
    spans = sorted((r.low, r.high) for r in by_file.collect())
    assert len(spans) > 3 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_sketches_leave_out_loads_without_the_keys(feed, monkeypatch):
    """Each batch reads only the loads that may hold its keys, and finds every copy in loads and units."""
    asked = []
    original = stored_copies.loads_to_read
    monkeypatch.setattr(stored_copies, "loads_to_read", lambda *a: asked.append(original(*a)) or asked[-1])
    for n in range(4):
        feed.deliver(*[log_line(sale(100 * n + k)) for k in range(50)], "banner")
        query = feed.load(horizon=None, check_stored=True)
    assert asked == [[], [], [], []]
    feed.deliver(*[log_line(sale(200 + k)) for k in range(3)], log_line(sale(999)))
    feed.load(horizon=None, check_stored=True)
    assert [p.low for p in asked[-1]] == [2]
    merge_batches(feed.spark, feed.facts, feed.progress, query.id, fan=5, keep_seconds=0)
    feed.deliver(log_line(sale(1)), log_line(sale(1000)))
    feed.load(horizon=None, check_stored=True)
    assert [p.name[:4] for p in asked[-1]] == ["run~"]
    feed.deliver(log_line(sale(1000)), log_line(sale(1001)))
    feed.load(horizon=None, check_stored=True)
    assert [p.low for p in asked[-1]] == [5]
    assert feed.count("headers") == 203 and len(set(feed.ids())) == 203
    # A load without a sketch is read.
    sketches.drop_sketch(feed.spark, feed.facts, asked[-1][0].name)
    feed.deliver(log_line(sale(2000)))
    feed.load(horizon=None, check_stored=True)
    assert [p.low for p in asked[-1]] == [5]


def test_a_batch_that_runs_again_does_not_find_itself(feed):
    feed.deliver(log_line(sale(1)), "banner")
    feed.load(check_stored=True)
    commits = os.path.join(feed.progress, "commits")
    for name in [name for name in os.listdir(commits) if name.strip(".").split(".")[0].isdigit()]:
        os.rename(os.path.join(commits, name), os.path.join(feed.root, name))
    feed.load(check_stored=True)
    assert feed.ids() == ["TX0000001"] and feed.count("rejects") == 1


def test_a_checked_batch_is_decided_once(feed, monkeypatch):
    """What follows reads stored rows: the stream's plan is not in it."""
    plans = []
    original = stored_copies.drop_stored_copies
    monkeypatch.setattr(ingest, "drop_stored_copies", lambda batch, *a: plans.append(plan_of(batch)) or original(batch, *a))
    feed.deliver(log_line(sale(1)))
    feed.load(check_stored=True)
    assert len(plans) == 1 and "FileScan parquet" in plans[0] and "from_json" not in plans[0] and "Dedup" not in plans[0]


@given(st.sets(st.binary(min_size=1, max_size=8), max_size=200), st.sets(st.binary(min_size=1, max_size=8), max_size=20))
@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_a_sketch_never_denies_a_key(spark, tmp_path, keys, others):
    facts = str(tmp_path / uuid.uuid4().hex)
    rows = spark.createDataFrame([(bytearray(k),) for k in keys] + [(None,)], "tx_key binary")
    sketches.write_sketch(spark, facts, "a", rows)
    for key in [*list(keys)[:3], *others]:
        held = sketches.units_that_may_hold(spark, facts, spark.createDataFrame([(bytearray(key),)], "tx_key binary"))
        assert held == ({"a"} if key in keys else set())


def test_large_sketches(spark, tmp_path):
    """Several segments: all keys are found, and of as many others next to none."""
    keys = spark.range(3000).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("tx_key"))
    assert sketches.segments_for(3000) == 16
    words = sketches.segments_of(keys, 16).collect()
    assert len(words) == 16 and all(len(r.words) == 128 for r in words)
    sketches.write_sketch(spark, str(tmp_path), "a", keys)
    found = 0
    for number in (0, 17, 2999, *range(5000, 5020)):
        one = spark.range(number, number + 1).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("tx_key"))
        found += len(sketches.units_that_may_hold(spark, str(tmp_path), one))
    assert found == 3


def test_files_dated_long_before_are_loaded(feed):
    feed.deliver(log_line(sale(1)))
    feed.load(horizon=None)
    old = feed.deliver(log_line(sale(2)))
    os.utime(old, (time.time() - 400 * 86400,) * 2)
    feed.deliver(log_line(sale(3)))
    feed.load(horizon=None)
    assert feed.ids() == ["TX0000001", "TX0000002", "TX0000003"]


def test_clock_behind_the_watermark_stops_the_load(feed):
    """The stream would drop what arrives before its watermark; nothing is written instead."""
    feed.deliver(log_line(sale(1)))
    feed.load()
    assert clock_guard(feed.spark, feed.progress, "1 hour", now=lambda: time.time() - 3000)
    with pytest.raises(ClockError):
        clock_guard(feed.spark, feed.progress, "1 hour", now=lambda: time.time() - 4000)
    times = iter([time.time(), time.time() - 7200])
    check = clock_guard(feed.spark, feed.progress, "1 hour", now=lambda: next(times))
    with pytest.raises(ClockError):
        check()


def test_copies_of_stored_records_can_be_refused(feed):
    for _ in range(3):
        feed.deliver(log_line(sale(1)), log_line(sale(2)))
        feed.load(horizon=None, check_stored=True)
    assert feed.ids() == ["TX0000001", "TX0000001", "TX0000002", "TX0000002"][::2]


@pytest.mark.parametrize("horizon", [None, "1 hour"])
def test_live_sales_follow_the_feed(feed, horizon):
    skus = feed.spark.createDataFrame([("A", "2.50"), ("B", "0.10")], "sku string, price string").selectExpr(
        "sku", "cast(price as decimal(10,2)) as price")
    report = os.path.join(feed.root, "report")

    def refresh():
        start_live_sales(feed.spark, feed.incoming, report, feed.progress, horizon=horizon, lanes=2,
                         max_files=1).awaitTermination()
        return shown(skus)

    def shown(skus):
        return {r.supermarket_id: (r.units, str(r.sales)) for r in read_live_sales(feed.spark, report, skus).collect()}

    feed.deliver(log_line(sale(1, items=[("A", 2), ("B", 1), ("unknown", 9)])), "banner")
    assert refresh() == {"STORE0001": (3, "5.10")}
    feed.deliver(log_line(sale(2, items=[("B", 3)])))
    feed.deliver(log_line(sale(3, items=[("A", 1)], store="STORE0002")))
    assert refresh() == {"STORE0001": (6, "5.40"), "STORE0002": (1, "2.50")}
    # Current prices, as in the batch report.
    assert shown(skus.selectExpr("sku", "cast(price * 2 as decimal(10,2)) as price"))["STORE0002"] == (1, "5.00")
    # A new checkpoint starts to count again, and its report is the one shown.
    feed.progress += "-new"
    feed.deliver(log_line(sale(4, items=[("A", 10)])))
    assert refresh() == {"STORE0001": (16, "30.40"), "STORE0002": (1, "2.50")}


line = st.one_of(
    st.builds(lambda n, items: log_line(sale(n, items=items)), st.integers(0, 5),
              st.lists(st.tuples(st.sampled_from("AB"), st.integers(1, 5)), max_size=3)),
    st.builds(lambda n: json.dumps({"log": json.dumps({**sale(n), "items": [None, {"sku": "A", "quantity": 1}]})}),
              st.integers(0, 5)),
    st.sampled_from(["banner", log_line("banner"), '{"log": ""}', "[]", log_line("{}")]),
)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(lines=st.lists(line, min_size=1, max_size=30))
def test_no_line_is_lost(spark, tmp_path_factory, lines):
    """Lines = kept records + refused lines + dropped copies; details = their non-null items."""
    feed = Feed(spark, tmp_path_factory.mktemp("feed"))
    feed.deliver(*lines[::2])
    feed.deliver(*lines[1::2])
    feed.load(max_files=1)

    def transaction(text):
        try:
            record = json.loads(json.loads(text)["log"])
            return record if record.get("transaction_id") else None
        except (ValueError, TypeError, KeyError):
            return None

    kept = {text: transaction(text) for text in lines if transaction(text)}
    counts = collections.Counter("kept" if transaction(text) else "refused" for text in lines)
    assert feed.count("headers") == len(kept)
    assert feed.count("rejects") == counts["refused"]
    assert feed.count("details") == sum(1 for r in kept.values() for item in r["items"] if item)
    assert len(lines) == len(kept) + counts["refused"] + (counts["kept"] - len(kept))


def live(feed, **options):
    query = start_live_sales(feed.spark, feed.incoming, os.path.join(feed.root, "report"), feed.progress + "-live", lanes=2, **options)
    query.awaitTermination()
    return query


def test_a_refresh_writes_only_what_changed(feed):
    report = os.path.join(feed.root, "report")
    feed.deliver(*[log_line(sale(n, items=[("A", 1), ("B", 2)], store=f"STORE{n:04d}")) for n in range(5)])
    query = live(feed)
    feed.deliver(log_line(sale(10, items=[("B", 3)], store="STORE0002")))
    live(feed)
    change = feed.spark.read.parquet(generations.load_folder(report, "totals", "live", query.id, 1)).collect()
    assert [(r.supermarket_id, r.sku, r.units) for r in change] == [("STORE0002", "B", 5)]
    units = {(r.supermarket_id, r.sku): r.units for r in live_sales.read_live_totals(feed.spark, report).collect()}
    assert len(units) == 10 and units["STORE0002", "B"] == 5 and units["STORE0003", "B"] == 2


def test_refreshes_are_folded_and_a_new_query_replaces_the_report(feed):
    report = os.path.join(feed.root, "report")
    for n in range(9):
        feed.deliver(log_line(sale(n, items=[("A", 1)])))
        query = live(feed, fan=3, keep_seconds=0)
        rows = live_sales.read_live_totals(feed.spark, report).collect()
        assert [(r.sku, r.units) for r in rows] == [("A", n + 1)]
    units = generations.current(feed.spark, report).units
    assert units and sum(u.high - u.low + 1 for u in units) >= 6
    assert len(os.listdir(os.path.join(report, "table=totals", "origin=live", f"stream_id={query.id}"))) <= 6
    feed.progress += "-new"
    live(feed)
    assert [(r.sku, r.units) for r in live_sales.read_live_totals(feed.spark, report).collect()] == [("A", 9)]
    assert live_sales.read_live_totals(feed.spark, os.path.join(feed.root, "none")).count() == 0


def test_closing_pass_empties_the_input(feed, monkeypatch):
    """Also after it broke off half-way; files that no batch has read stay."""
    archive = os.path.join(feed.root, "archive")
    for n in range(3):
        feed.deliver(log_line(sale(n)))
        feed.deliver(f"banner {n} ä")
        feed.load(archive_dir=archive)
    assert os.listdir(feed.incoming)
    new = feed.deliver(log_line(sale(9)))
    original, calls = Files.move, []

    def lost(self, path, to):
        calls.append(path)
        if len(calls) > 1:
            raise OSError("lost")
        return original(self, path, to)

    with monkeypatch.context() as broken:
        broken.setattr(Files, "move", lost)
        with pytest.raises(OSError, match="lost"):
            close_archive(feed.spark, feed.incoming, feed.progress, archive, threads=1)
    assert close_archive(feed.spark, feed.incoming, feed.progress, archive) == 1
    assert [os.path.join(feed.incoming, f) for f in os.listdir(feed.incoming) if f.endswith(".log")] == [new]
    moved = feed.spark.read.option("recursiveFileLookup", True).text(archive).collect()
    assert len(moved) == 6
    feed.load(archive_dir=archive)
    assert feed.count("headers") == 4
    assert close_archive(feed.spark, feed.incoming, feed.progress, archive) == 1


def test_refused_lines_take_no_place_in_the_live_state(spark, tmp_path):
    write_lines(f"{tmp_path}/in", [log_line(sale(1)), "banner", "another banner"])
    query = start_live_sales(spark, f"{tmp_path}/in", f"{tmp_path}/report", f"{tmp_path}/progress", lanes=2)
    query.awaitTermination()
    assert {operator["numRowsTotal"] for operator in query.lastProgress["stateOperators"]} == {1}


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {name for folder in folders for _, _, names in os.walk(folder.toString()) for name in names if name.startswith("shuffle_")}


@pytest.mark.parametrize("start", [Feed.load, live])
def test_what_a_batch_shuffled_goes_with_it(feed, start):
    crash_mix(feed)
    before = shuffle_files(feed.spark)
    start(feed, max_files=1)
    for _ in range(100):
        left = shuffle_files(feed.spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left


@pytest.mark.parametrize("start", [Feed.load, live])
def test_state_is_on_disk(feed, start):
    feed.deliver(log_line(sale(1)))
    start(feed)
    states = [name for folder, _, names in os.walk(feed.root) for name in names if f"{os.sep}state{os.sep}" in folder]
    assert any(name.endswith(".zip") for name in states) and not any(name.endswith(".delta") for name in states)


def test_state_begun_in_the_heap_goes_on(feed, monkeypatch):
    provider = "spark.sql.streaming.stateStore.providerClass"
    with monkeypatch.context() as before:
        before.setattr(ingest, "stream_settings", lambda *args: {"spark.sql.shuffle.partitions": 2})
        feed.deliver(log_line(sale(1)))
        feed.load()
    feed.deliver(log_line(sale(1)), log_line(sale(2)))
    feed.load()
    assert feed.ids() == ["TX0000001", "TX0000002"]
    assert feed.spark.conf.get(provider, "unset") == "unset"


def test_copies_are_dropped_without_counting_the_state(feed):
    for _ in range(2):
        feed.deliver(log_line(sale(1)), log_line(sale(2)))
        feed.load(count_state=False)
    assert feed.ids() == ["TX0000001", "TX0000002"]
