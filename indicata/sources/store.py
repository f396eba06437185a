"""Sinks: bronze append, silver partition overwrite, full overwrite, run log.

Parquet / JSON by path (``sources.tables`` has tables by name). Every write
resolves columns by name through ``DataFrame.to(schema)`` first, so a
column order or type drift fails before any file is written. Tables that are
replaced go through ``sources.published``: a write that fails leaves the old
table as it was.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicata.functions.calendar import ntz_literal
from indicata.schemas import CONTROL_RECORD
from indicata.sources import published
from indicata.sources.published import exists  # noqa: F401 - part of this module's interface


class SchemaMismatch(ValueError):
    """A DataFrame lacks columns that the target contract requires."""


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Reorder by name, drop extra columns, cast; a missing column raises.

    ``DataFrame.to`` alone would fill a missing nullable column with NULL,
    which would hide an upstream drift, so missing names are checked first.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise SchemaMismatch(f"missing columns: {missing}")
    return df.to(schema)


def add_audit_columns(df: DataFrame, run_ts: dt.datetime, source: str, kind: str | None = None) -> DataFrame:
    """Ingestion time (a run parameter, so reruns repeat), source, kind and year."""
    cols = {
        "_ingested_at": ntz_literal(run_ts),
        "_source": F.lit(source),
        "ano": F.year("data"),
    }
    if kind is not None:
        cols["kind"] = F.lit(kind)
    return df.withColumns(cols)


def clustered(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of one output partition together before a partitioned write, so
    files number about as many as partitions, not tasks times partitions. A
    rebalance, not a plain repartition: a large partition is split over tasks."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def append_bronze(df: DataFrame, path: str, schema: T.StructType,
                  partition_by: Sequence[str] = ("kind", "ano")) -> None:
    """Append-only bronze write, Hive-style partitions, Snappy Parquet."""
    with published.unsorted_writes(df.sparkSession):
        (clustered(conform(df, schema), partition_by).write.mode("append").partitionBy(*partition_by)
            .option("compression", "snappy").parquet(path))


def overwrite_partitions(df: DataFrame, path: str, schema: T.StructType,
                         partition_by: Sequence[str] = ("ano", "mes")) -> None:
    """Replace only the partitions present in ``df``, in place (dynamic
    overwrite), for tables that a stream extends batch by batch.

    Set per write: the session default (static) would erase every other
    partition. A partition whose rows all vanished is not cleared, and never
    point this at a path that the same job is reading: ``replace_partitions``
    has neither limit.
    """
    with published.unsorted_writes(df.sparkSession):
        (clustered(conform(df, schema), partition_by).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partition_by).parquet(path))


def replace_partitions(df: DataFrame, path: str, schema: T.StructType, replace: Iterable[str],
                       partition_by: Sequence[str] = ("ano", "mes")) -> None:
    """Replace the named partitions of a published table by the rows of ``df``
    in one step; a named partition without rows is gone. ``df`` may read it."""
    published.publish(conform(df, schema), path, partition_by, replace=replace)


def overwrite_all(df: DataFrame, path: str, schema: T.StructType | None = None,
                  partition_by: Sequence[str] = (), check: Callable[[DataFrame], None] | None = None) -> None:
    """Full replace of a table in one step (see ``sources.published``); the
    old table stays when the write fails or ``check`` refuses the new one."""
    out = conform(df, schema) if schema is not None else df
    published.publish(out, path, partition_by, check=check)


def has_table(spark: SparkSession, path: str) -> bool:
    """Whether a table was published at ``path``, or plain files lie there."""
    return published.current(spark, path) is not None \
        or (exists(spark, path) and not exists(spark, f"{path}/{published.DATA}"))


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               only: Iterable[str] | None = None) -> DataFrame:
    """A table by path, published or plain; ``only`` names the partitions to
    read of a published one."""
    state = published.current(spark, path)
    if state is not None:
        return published.read(spark, path, schema, only, state)
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def control_records(runs: DataFrame) -> DataFrame:
    """Run records from ``(table_name, process_name, source, layer, row_count,
    started_at, finished_at, status, metadata)``; duration = end - start."""
    micros = F.timestamp_diff("MICROSECOND", F.col("started_at"), F.col("finished_at"))
    return conform(runs.withColumn("duration_seconds", micros / F.lit(1_000_000.0)), CONTROL_RECORD)


# Runs that keep a folder of their own before the log is compacted.
COMPACT_AT = 50
# Microsecond timestamps in the JSON log (the default keeps milliseconds).
_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _runs(path: str) -> str:
    return f"{path}/runs"


def append_control(records: DataFrame, path: str, run_id: str | None = None, compact_at: int = COMPACT_AT) -> None:
    """Append the records of one run, as JSON lines in a folder of the run.

    A run id that comes again replaces its records, so a retried step does not
    double them, and runs that end together do not touch each other's files.
    With ``compact_at`` runs on their own they are moved into one table.
    """
    run_id = run_id or uuid.uuid4().hex
    if not re.fullmatch(r"[\w-]+", run_id):
        raise ValueError(f"no run id: {run_id!r}")
    (conform(records, CONTROL_RECORD).hint("rebalance").write.mode("overwrite")
        .option("timestampNTZFormat", _TS_FORMAT).json(f"{_runs(path)}/{run_id}"))
    spark = records.sparkSession
    if len(published.folders(spark, _runs(path))) >= compact_at:
        compact_control(spark, path)


def _control(spark: SparkSession, path: str, runs: Sequence[str]) -> DataFrame:
    """All records with their run; a run's own folder goes before the table."""
    schema = T.StructType([*CONTROL_RECORD.fields, T.StructField("_run", T.StringType())])
    out = spark.createDataFrame([], schema)
    if published.current(spark, f"{path}/base") is not None:
        out = read_table(spark, f"{path}/base", schema)
        if runs:
            out = out.filter(~F.col("_run").isin(*runs))
    if runs:
        own = spark.read.schema(CONTROL_RECORD).option("timestampNTZFormat", _TS_FORMAT) \
            .json([f"{_runs(path)}/{r}" for r in runs])
        out = out.unionByName(own.withColumn("_run", F.element_at(F.split("_metadata.file_path", "/"), -2)))
    return out


def compact_control(spark: SparkSession, path: str) -> None:
    """Move the runs' folders into the table. A crash in between doubles
    nothing: a run's folder counts instead of its rows in the table."""
    runs = published.folders(spark, _runs(path))
    published.publish(_control(spark, path, runs).hint("rebalance"), f"{path}/base")
    published.vacuum(spark, f"{path}/base")
    for r in runs:
        published.delete(spark, f"{_runs(path)}/{r}")


def read_control(spark: SparkSession, path: str) -> DataFrame:
    """Every run's records."""
    return _control(spark, path, published.folders(spark, _runs(path))).drop("_run")
