"""What the operators of this package share: reading tables, free column names, exact sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.workspace import new_folder

#: Words end at ASCII white space only.
SPACES = r"[\x20\x09-\x0D]+"
TEXTS_IN_BATCH = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """The text of a row; a null text counts as an empty one."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """A column name close to ``name`` that ``df`` does not use, whatever its extra columns are."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def words_of(text: Column) -> Column:
    """The words of a text as an array; none for an empty text."""
    return F.filter(F.split(text, SPACES), lambda word: word != "")


def small_batches(spark: SparkSession) -> None:
    """Fewer texts in an Arrow batch than Spark's default, which is meant for short rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= TEXTS_IN_BATCH:
        spark.conf.set(key, TEXTS_IN_BATCH)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage, survives lost executors."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
