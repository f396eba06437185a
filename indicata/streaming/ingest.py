"""Incremental bronze ingestion with Structured Streaming.

Landed payload files are picked up once each (the file source keeps the
list of processed files in the checkpoint), parsed with the same column
expressions as the batch path and written in ``foreachBatch``.
``trigger(availableNow=True)`` processes everything landed so far and
stops, so the same code serves scheduled runs and a continuous stream.

A micro-batch that is replayed after a failure replaces what it wrote: all
its rows, observations and others, go in one write to the partition of its
batch number. Readers pick observations or quarantine by ``motivo``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from indicata.schemas import BRONZE_SEQ, QUARANTINE
from indicata.sources import payload as P
from indicata.sources import store

# One table for a stream: bronze columns, the texts and reason, the batch.
STREAMED = T.StructType(
    BRONZE_SEQ.fields
    + [f for f in QUARANTINE.fields if f.name not in BRONZE_SEQ.fieldNames()]
    + [T.StructField("lote", T.LongType())])


def landed_stream(spark: SparkSession, landing_kind_dir: str, max_files: int | None = None) -> DataFrame:
    """Stream of landed items from ``<dir>/<serie>/<batch>.json``, a file as one text."""
    reader = spark.readStream.option("wholetext", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    files = reader.text(landing_kind_dir + "/*/")
    return P.landed_items(files.select(F.col("value").alias("payload"),
                                       F.col("_metadata.file_path").alias("_file")))


def start_ingest(spark: SparkSession, landing_kind_dir: str, kind: str, table_path: str,
                 checkpoint: str, source: str = "landing", available_now: bool = True) -> StreamingQuery:
    """Start the stream; each micro-batch is stamped with its own ingestion time."""
    parsed = P.parse_observations(landed_stream(spark, landing_kind_dir), strict=False)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        run_ts = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        rows = store.add_audit_columns(batch.filter(~F.col("motivo").eqNullSafe(P.EMPTY)), run_ts, source, kind).withColumn(
            "lote", F.lit(batch_id).cast("long"))
        store.overwrite_partitions(rows, table_path, STREAMED, partition_by=("kind", "lote"))

    w = parsed.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def observations(spark: SparkSession, table_path: str) -> DataFrame:
    """Bronze rows of a streamed table."""
    return store.conform(store.read_table(spark, table_path, STREAMED).filter("motivo IS NULL"), BRONZE_SEQ)


def quarantine(spark: SparkSession, table_path: str) -> DataFrame:
    """Rows of a streamed table that are no observations."""
    return store.conform(store.read_table(spark, table_path, STREAMED).filter("motivo IS NOT NULL"),
                         QUARANTINE)
