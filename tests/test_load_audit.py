"""Broken files, checks within the write, and the audit of open items."""

import gzip
import os

import pytest
from conftest import as_lines, log_line, plan_of, sale, write_lines

from basketflow.operators.audit import domain_violations
from basketflow.operators.decode import decode_lines
from basketflow.sinks import append_load, fact_rows, generations, orphans, sketches, write_batch
from basketflow.sinks.merge import merge_batches
from basketflow.sources import read_fact, read_log_lines
from basketflow.streaming import start_ingest
from basketflow.streaming.checks import read_checks


def packed(folder, name, lines, cut=None, damage=False):
    data = bytearray(gzip.compress("".join(line + "\n" for line in lines).encode()))
    if damage:
        data[len(data) // 2] ^= 0xFF
    with open(os.path.join(folder, "." + name), "wb") as out:
        out.write(data[:cut])
    os.rename(os.path.join(folder, "." + name), os.path.join(folder, name))


def load(spark, root, **options):
    query = start_ingest(spark, f"{root}/in", f"{root}/facts", f"{root}/progress", lanes=2, **options)
    query.awaitTermination()
    return query


def ids(spark, root):
    return sorted(r.transaction_id for r in read_fact(spark, f"{root}/facts", "headers").collect())


def test_a_broken_file_is_set_aside_and_its_good_copy_loads(spark, tmp_path):
    root, folder = str(tmp_path), f"{tmp_path}/in"
    os.makedirs(folder)
    lines = [log_line(sale(n, items=[(f"SKU{k:05d}", 1) for k in range(50)])) for n in range(100)]
    write_lines(folder, [log_line(sale(500))])
    write_lines(folder, [log_line(sale(501))], name="z")
    write_lines(folder, [log_line(sale(502))], name="notgz")
    packed(folder, "good.log.gz", [log_line(sale(503)), "banner", "", "ä"])
    packed(folder, "cut.log.gz", lines, cut=-20)
    packed(folder, "damaged.log.gz", lines, damage=True)
    packed(folder, "short.log.gz", lines, cut=3)
    with open(f"{folder}/prose.log.gz", "w") as out:
        out.write("not compressed")
    load(spark, root, set_aside_broken=True)
    assert ids(spark, root) == [f"TX{n:07d}" for n in (500, 501, 502, 503)]
    bad = read_fact(spark, f"{root}/facts", "rejects", stored=True).where("reason = 'bad_file'").collect()
    assert sorted(os.path.basename(r.source_file) for r in bad) == ["cut.log.gz", "damaged.log.gz", "prose.log.gz", "short.log.gz"]
    assert all("Error" in r.raw or "BadGzipFile" in r.raw for r in bad)
    packed(folder, "again.log.gz", lines)
    load(spark, root, set_aside_broken=True)
    assert len(ids(spark, root)) == 104
    batch = decode_lines(read_log_lines(spark, folder, set_aside_broken=True))
    assert batch.where("reason = 'bad_file'").count() == 4 and batch.where("reason is null").count() == 104


def test_long_files_come_in_batches(spark, tmp_path):
    packed(str(tmp_path), "long.gz", (f"line {n}" for n in range(25_003)))
    rows = read_log_lines(spark, str(tmp_path), set_aside_broken=True)
    assert rows.select("value").distinct().count() == 25_003


def test_checks_are_those_of_the_tables_and_read_nothing_again(spark, tmp_path):
    root = str(tmp_path)
    for n in range(2):
        write_lines(f"{root}/in", [
            log_line(sale(10 * n, items=[("SKU00001", 9), ("x", 1)])), log_line(sale(10 * n + 1, store="shop", date="bad")),
            log_line({**sale(10 * n + 2), "items": [None]}), "banner", log_line("banner"),
        ])
        query = load(spark, root, checks=True, horizon=None)
    facts = f"{root}/facts"
    stored = {r.rule: r.rows for r in read_checks(spark, facts).groupBy("rule").sum("rows").withColumnRenamed("sum(rows)", "rows").collect()}
    rules = domain_violations(read_fact(spark, facts, "headers"), read_fact(spark, facts, "details")).where("rule <> 'basket_size'")
    assert {r.rule: stored[r.rule] for r in rules.collect()} == {r.rule: r.violations for r in rules.collect()}
    assert (stored["headers"], stored["details"], stored["rejects"], stored["bad_date"], stored["null_item"], stored["not_json"]) == (6, 6, 4, 2, 2, 2)
    by_batch = read_checks(spark, facts).where("rule = 'headers'").collect()
    assert sorted((r.stream_id, r.batch_id, r.rows) for r in by_batch) == [(query.id, 0, 3), (query.id, 1, 3)]
    from basketflow.streaming.checks import observed

    rows = fact_rows(decode_lines(as_lines(spark, ["x"])))
    assert plan_of(observed(rows)[0]).count("Scan") == plan_of(rows).count("Scan")
    assert read_checks(spark, f"{root}/none").count() == 0


def open_ids(rows):
    return sorted((r.transaction_id, r.sku) for r in rows.collect())


def test_open_items_from_load_to_load(spark, tmp_path, monkeypatch):
    facts, state = f"{tmp_path}/facts", f"{tmp_path}/state"
    rows = fact_rows(decode_lines(as_lines(spark, [log_line(sale(n)) for n in range(9)])))

    def store(number, items, heads, sketch=True):
        chosen = rows.where(f"(table = 'details' and cast(substr(transaction_id, 3) as int) in ({items})) or (table = 'headers' and cast(substr(transaction_id, 3) as int) in ({heads}))")
        write_batch(chosen, facts, "realtime", "s", number)
        unit = generations.Unit("realtime", "s", number, number, "", 0)
        headers = generations.read_parts(spark, facts, "headers", [unit])
        if sketch and headers is not None:
            sketches.write_sketch(spark, facts, unit.name, headers)

    assert orphans.open_items(spark, state).count() == 0
    store(0, "0, 1, 2", "0, 5")
    assert open_ids(orphans.audit_new_loads(spark, facts, state)) == [("TX0000001", "SKU00001"), ("TX0000002", "SKU00001")]
    store(1, "3, 5", "1, 6", sketch=False)
    read = []
    original = generations.read_parts
    monkeypatch.setattr(orphans.generations, "read_parts", lambda s, f, t, parts: read.append((t, [p.low for p in parts])) or original(s, f, t, parts))
    assert open_ids(orphans.audit_new_loads(spark, facts, state)) == [("TX0000002", "SKU00001"), ("TX0000003", "SKU00001")]
    assert read == [("details", [1]), ("headers", [1]), ("headers", [0])]
    store(2, "7", "2")
    read.clear()
    assert open_ids(orphans.audit_new_loads(spark, facts, state)) == [("TX0000003", "SKU00001"), ("TX0000007", "SKU00001")]
    assert read == [("details", [2]), ("headers", [2]), ("headers", [1])]  # the one without a sketch
    read.clear()
    assert orphans.audit_new_loads(spark, facts, state).count() == 2 and not read
    # Merged loads are known; a unit with a new load beside known ones gives its new rows only.
    store(3, "6", "3")
    os.makedirs(f"{tmp_path}/progress/commits")
    open(f"{tmp_path}/progress/commits/9", "w").close()
    assert merge_batches(spark, facts, f"{tmp_path}/progress", "s").folders == 4
    assert open_ids(orphans.audit_new_loads(spark, facts, state)) == [("TX0000007", "SKU00001")]


def test_a_step_that_broke_off_is_run_again(spark, tmp_path, monkeypatch):
    facts, state = f"{tmp_path}/facts", f"{tmp_path}/state"
    append_load(decode_lines(as_lines(spark, [log_line(sale(1))])), facts, "a")
    write_batch(fact_rows(decode_lines(as_lines(spark, [log_line(sale(2))]))).where("table = 'details'"), facts, "realtime", "b", 0)
    with monkeypatch.context() as broken:
        broken.setattr(orphans.Files, "move", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            orphans.audit_new_loads(spark, facts, state)
    assert orphans.open_items(spark, state).count() == 0
    assert open_ids(orphans.audit_new_loads(spark, facts, state)) == [("TX0000002", "SKU00001")]
