import json
import os
import sys
import uuid

import duckdb
import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("basketflow-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def skewed_dir(tmp_path_factory):
    """The small tables with a third of the rows on one order, SKU, customer, day and text."""
    folder = str(tmp_path_factory.mktemp("skewed"))
    changed = {
        "lineitem": "select * from lineitem union all select * replace (7 as l_orderkey, 3 as l_partkey, "
        "2.0 as l_quantity) from lineitem where l_orderkey % 2 = 0",
        "orders": "select * replace (case when o_orderkey % 3 = 0 then 11 else o_custkey end as o_custkey, "
        "case when o_orderkey % 3 = 1 then timestamp '1997-05-05' else o_orderdate end as o_orderdate) from orders",
        "conversations": "select * replace (case when conv_id % 3 = 0 then 'same text' else text end as text) "
        "from conversations",
    }
    db = database(SMALL)
    for name in TABLES:
        query = changed.get(name, f"select * from {name}")
        db.execute(f"copy ({query}) to '{folder}/{name}.parquet' (format parquet)")
    return folder


def database(sf_dir):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return db


def log_line(tx):
    """A transaction (or any text) in the router's envelope."""
    return json.dumps({"log": tx if isinstance(tx, str) else json.dumps(tx)})


def sale(number, items=(("SKU00001", 1),), date="2024-04-10 19:22:28", store="STORE0001"):
    return {
        "transaction_id": f"TX{number:07d}",
        "supermarket_id": store,
        "transaction_date": date,
        "items": [{"sku": sku, "quantity": quantity} for sku, quantity in items],
    }


def write_lines(folder, lines, name=None):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name or f"{uuid.uuid4().hex}.log")
    with open(path + ".tmp", "w", encoding="utf-8") as out:
        out.writelines(line + "\n" for line in lines)
    os.rename(path + ".tmp", path)
    return path


def as_lines(spark, lines):
    return spark.createDataFrame([(line,) for line in lines], "value string").select(
        "value", F.lit("test").alias("source_file"), F.current_timestamp().alias("arrived_at")
    )


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
