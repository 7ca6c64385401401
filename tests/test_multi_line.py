"""CSV files with line breaks in fields, cut into splits of any size."""

import random

import pyarrow as pa
import pytest

from basketflow import schemas
from basketflow.session import temporary_settings
from basketflow.sources import read_transactions_csv
from basketflow.sources.multi_line import _glued


def field(draw):
    kind = draw.randrange(6)
    text = draw.choice(["a", "b,c", 'say "x"', "two\nlines", "\n", "", "é漢\n\n😀", "r\r\nn", '"', '""\n"'])
    return f"plain{draw.randint(0, 99)}" if kind < 3 else '"' + text.replace('"', '""') + '"'


def one_task(spark, path):
    reader = spark.read.schema(f"{schemas.CSV_TRANSACTIONS}, {schemas.CSV_BROKEN} string").option("header", True)
    rows = reader.option("quote", '"').option("escape", '"').option("multiLine", True).option("columnNameOfCorruptRecord", schemas.CSV_BROKEN).csv(path)
    return sorted(map(repr, rows.select("transaction_id", "supermarket_id", "transaction_date", "items").collect()))


def many_tasks(spark, path, size):
    with temporary_settings(spark, {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": 0}):
        rows = read_transactions_csv(spark, path, multi_line=True)
        tasks = rows.rdd.getNumPartitions()
        return sorted(map(repr, rows.select("transaction_id", "supermarket_id", "transaction_date", "items").collect())), tasks


@pytest.mark.parametrize("seed,size,end", [(1, 40, "\n"), (2, 300, "\n"), (3, 7, "\n"), (4, 10**6, "\n"), (5, 100, "\r\n")])
def test_equal_to_the_reader_of_one_task(spark, tmp_path, seed, size, end):
    draw = random.Random(seed)
    for number in range(3):
        rows = [",".join(field(draw) for _ in range(4)) for _ in range(draw.randint(0, 60))]
        if number == 1:
            rows.insert(draw.randint(0, len(rows)), '1,2,3,"' + "long\n" * 200 + '"')
            rows.append("")
        lines = [schemas.CSV_HEADER, *rows]
        (tmp_path / f"{number}.csv").write_bytes((end.join(lines) + (end if draw.random() < 0.5 else "")).encode())
    ours, tasks = many_tasks(spark, str(tmp_path), size)
    theirs = one_task(spark, str(tmp_path))
    if end == "\r\n":  # the reader of one task takes the carriage return out of fields too
        ours, theirs = (sorted(r.replace("\\r\\n", "\\n") for r in rows) for rows in (ours, theirs))
    assert ours == theirs
    assert size >= 10**6 or tasks > 3


def test_broken_and_unfinished_records(spark, tmp_path):
    (tmp_path / "a.csv").write_text(schemas.CSV_HEADER + '\n1,2\n1,2,3,"x\ny",5\n1,2,3,"never closed\nto the end\n')
    rows = read_transactions_csv(spark, str(tmp_path), multi_line=True).collect()
    broken = sorted(r[schemas.CSV_BROKEN] or "" for r in rows)
    assert len(rows) == 3 and broken[-2:] == ["1,2", '1,2,3,"x\ny",5']
    assert all(r.source_file.endswith("a.csv") for r in rows)


def test_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    (tmp_path / "b.csv").write_text(schemas.CSV_HEADER)
    assert read_transactions_csv(spark, str(tmp_path), multi_line=True).count() == 0


def test_records_of_many_lines_come_in_whole_columns():
    """Two lines a record; those at the ends of the batches cross them."""
    lines = [f'{n},"a' if n % 2 else 'b"' for n in range(1, 2002)]
    batches = [
        pa.record_batch({
            "value": lines[at : at + 667], "source_file": ["f"] * len(lines[at : at + 667]), "block": pa.array([0] * len(lines[at : at + 667]), pa.int64()),
            "odd": [True] * len(lines[at : at + 667]), "inside": [False] * len(lines[at : at + 667]),
        })
        for at in range(0, len(lines), 667)
    ]
    out = list(_glued(iter(batches)))
    rows = [row for batch in out for row in batch.to_pylist()]
    assert sorted(r["value"] for r in rows) == sorted([f'{n},"a\nb"' for n in range(1, 2000, 2)] + ['2001,"a'])
    assert [(r["head"], r["tail"]) for r in rows if r["head"] or r["tail"]] == [(False, True)]
    assert len(out) < 10
