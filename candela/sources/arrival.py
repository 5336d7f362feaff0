"""When a row arrived: the order that decides between several rows of one key.

The order is (time, place, block, row): a file's modification time and path, the
split within it and the row within the split; or a message's time, its topic
partition and its offset. It depends on the source only, not on how tasks run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ARRIVAL = "_arrival"


def arrival(time: Column, place: Column, block: Column, row: Column) -> Column:
    return F.struct(time.cast("timestamp").alias("time"), place.cast("string").alias("place"),
                    block.cast("long").alias("block"), row.cast("long").alias("row")).alias(ARRIVAL)


def of_files(rows: DataFrame) -> DataFrame:
    """Rows that ``spark.read`` has just read from files, with their arrival.

    A split is read by one task in order, so the row numbers of a task order the
    rows of a split.
    """
    source = "_metadata.file_"
    return rows.select("*", arrival(F.col(source + "modification_time"), F.col(source + "path"), F.col(source + "block_start"),
                                    F.monotonically_increasing_id()))


def of_rows(rows: DataFrame) -> DataFrame:
    """Rows of any other source in the order of their partitions. Store them before they are read twice."""
    none = F.lit(None)
    return rows.select("*", arrival(none, none, none, F.monotonically_increasing_id()))


def ensured(rows: DataFrame) -> DataFrame:
    return rows if ARRIVAL in rows.columns else of_rows(rows)
