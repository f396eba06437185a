"""Tables in the order of a key, read by range.

``write_sorted`` deals rows to files by ranges of the order columns and sorts
inside each file, so files follow each other and a value of the first column
lies in few of them. A second small table, a row for each file, holds what the
first column spans there (its "zones"); ``read_range`` picks files by it, and
inside these the footers' statistics skip what is outside.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata.operators.chunked import range_partitions

ROWS, ZONES = "rows", "zones"
#: More files than these are not named one by one; the filter alone remains.
MOST_FILES = 10_000


def write_sorted(df: DataFrame, path: str, order: Sequence[str], partitions: int | None = None) -> None:
    """Writes ``df`` in the order of the columns ``order`` (NULLs first)."""
    spark, first = df.sparkSession, F.col(order[0])
    rows = f"{path}/{ROWS}"
    df.repartitionByRange(partitions or range_partitions(df), *order).sortWithinPartitions(*order).write.parquet(rows)
    written = spark.read.schema(df.schema).parquet(rows)
    written.groupBy(F.col("_metadata.file_name").alias("arquivo")).agg(
        F.min(first).alias("menor"), F.max(first).alias("maior"), F.count_if(first.isNull()).alias("nulos"),
        F.count("*").alias("linhas")).write.parquet(f"{path}/{ZONES}")


def zones(spark: SparkSession, path: str) -> DataFrame:
    """``(arquivo, menor, maior, nulos, linhas)`` of every file."""
    return spark.read.parquet(f"{path}/{ZONES}")


def read_range(spark: SparkSession, path: str, column: str, low, high) -> DataFrame:
    """Rows with ``low <= column <= high``, ``column`` being the first that the
    table is ordered by; other files are not opened."""
    inside = zones(spark, path).filter((F.col("maior") >= F.lit(low)) & (F.col("menor") <= F.lit(high)))
    names = [r.arquivo for r in inside.select("arquivo").limit(MOST_FILES + 1).collect()]
    rows = f"{path}/{ROWS}"
    table = spark.read.parquet(rows)
    if not names:
        return table.limit(0)
    if len(names) <= MOST_FILES:
        table = spark.read.schema(table.schema).parquet(*[f"{rows}/{n}" for n in names])
    return table.filter(F.col(column).between(low, high))
