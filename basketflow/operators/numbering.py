"""Dense numbers in sort order without a global window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketflow.functions import transaction_key
from basketflow.workspace import new_folder

# monotonically_increasing_id holds the partition above these bits and the row's place below.
_PLACE_BITS = 33


def number_rows(
    rows: DataFrame, order_by: list[str], column: str = "row_number", partitions: int | None = None, folder: str | None = None
) -> DataFrame:
    """Number rows 1, 2, 3 ... in the order of ``order_by``, which must be unique.

    ``row_number`` over the whole table would sort it in one task. Here the rows are range
    partitioned and sorted, each partition is counted, and a row's number is its place in the
    partition plus the count of all earlier ones. The unique order means a date shared by a third
    of the rows is still split over partitions.

    The sorted rows are stored first: the range bounds come from sampling, and the counts and
    the numbers must see the same bounds, also after an executor is lost. The result reads that
    copy, in ``folder`` if given; whoever stores the result may delete it then.
    """
    spark = rows.sparkSession
    count = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = folder or new_folder(spark, "sorted")
    (
        rows.repartitionByRange(count, *order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_place", F.monotonically_increasing_id())
        .write.parquet(folder)
    )
    placed = spark.read.parquet(folder).withColumn("_part", F.shiftright("_place", _PLACE_BITS))
    # One row per partition, at most `count` of them: small enough for one task and to broadcast.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_part").count().select(
        "_part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_start")
    )
    place = F.col("_place").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(column, F.col("_start") + place + 1)
        .drop("_part", "_place", "_start")
    )


def assign_transaction_ids(
    rows: DataFrame, order_by: list[str], partitions: int | None = None, folder: str | None = None
) -> DataFrame:
    """Give rows transaction ids that ascend in ``order_by``; the rest as in ``number_rows``."""
    numbered = number_rows(rows, order_by, "_number", partitions, folder)
    return numbered.withColumn("transaction_id", transaction_key(F.col("_number"))).drop("_number")
