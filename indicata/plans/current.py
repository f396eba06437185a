"""The newest version of every observation, kept up to date by each ingest.

Bronze only grows, so reading all of it to find the newest rows costs more with
every run. This table holds the winner of each (series, date), partitioned by
year. An ingest merges its batch into the years that the batch touches and
replaces those partitions in one step; other years are neither read nor
written. The result equals de-duplicating all of bronze, as the greatest of
(ingestion time, batch file, place) is the greatest of the winners so far and
the new rows.

A mark, set before bronze is appended and taken away after the merge, tells
that a run died in between; the next one then rebuilds the table from bronze.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from indicata.operators.dedup import latest_per_key
from indicata.schemas import BRONZE_SEQ
from indicata.sources import published, store

KEYS, VERSION = ("serie", "data"), ("_ingested_at", "_seq")
PARTITION = ("ano",)
#: Rows that a task sorts, as long as the shuffle needs no sort of its own:
#: beyond so many partitions (Spark's default) a map task gathers its rows.
TASK_ROWS, MOST_TASKS = 500_000, 200


def newest(rows: DataFrame) -> DataFrame:
    """The winners. Rows are dealt out by key before they are sorted: a task
    that reads 128 MB of a well compressed table would sort tens of millions of
    rows in memory. ``rows`` is counted first, so it should be a written table."""
    n = min(max(1, -(-rows.count() // TASK_ROWS)), MOST_TASKS)
    return latest_per_key(rows.repartition(n, *KEYS), KEYS, VERSION[:1], VERSION[1:])


def _mark(path: str) -> str:
    return f"{path}/_pending"


def begin(spark: SparkSession, path: str) -> None:
    """Before bronze gets the batch."""
    published.write_small(spark, _mark(path), "")


def finish(spark: SparkSession, path: str) -> None:
    published.delete(spark, _mark(path))


def is_current(spark: SparkSession, path: str) -> bool:
    """Whether the table exists and no run died between bronze and merge."""
    return published.current(spark, path) is not None and not store.exists(spark, _mark(path))


def merge(batch: DataFrame, path: str) -> list[str]:
    """Merges bronze rows into the years they touch; names these partitions.
    ``batch`` is read twice, so it should be a written table."""
    spark = batch.sparkSession
    batch = store.conform(batch, BRONZE_SEQ)
    touched = published.specs(batch, PARTITION)
    if not touched:
        return []
    if published.current(spark, path) is None:
        published.publish(newest(batch), path, PARTITION)
        return touched
    rows = store.read_table(spark, path, BRONZE_SEQ, only=touched).unionByName(batch)
    published.publish(newest(rows), path, PARTITION, replace=touched)
    return touched


def rebuild(bronze: DataFrame, path: str) -> None:
    """The table from all of bronze."""
    published.publish(newest(store.conform(bronze, BRONZE_SEQ)), path, PARTITION)


def read(spark: SparkSession, path: str) -> DataFrame:
    return store.read_table(spark, path, BRONZE_SEQ)
