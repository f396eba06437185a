"""Tables by name in the session's catalog.

``ensure_table`` creates a table with its contract (columns, partition columns,
properties) if it is absent and holds an existing one against the contract;
``append_table`` refuses rows or a table that drifted from it. Reading is by
name, so queries need no path.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from indicata.sources.store import SchemaMismatch, clustered, conform


class TableDrift(SchemaMismatch):
    """A table in the catalog is not what its contract says."""


def quoted(name: str) -> str:
    """``database.table`` with each part quoted; anything else is refused."""
    if not re.fullmatch(r"\w+(\.\w+){0,2}", name):
        raise ValueError(f"no table name: {name!r}")
    return ".".join(f"`{part}`" for part in name.split("."))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def drift(spark: SparkSession, name: str, schema: T.StructType, partition_by: Sequence[str] = ()) -> list[str]:
    """How the table differs from its contract (nothing: it does not); the
    order of columns does not matter, that of partition columns does."""
    have = {f.name: f.dataType.simpleString() for f in spark.table(name).schema.fields}
    want = {f.name: f.dataType.simpleString() for f in schema.fields}
    found = [f"no column {c}" for c in want if c not in have]
    found += [f"unknown column {c}" for c in have if c not in want]
    found += [f"{c} is {have[c]}, not {t}" for c, t in want.items() if have.get(c, t) != t]
    parts = partition_columns(spark, name)
    if parts != list(partition_by):
        found.append(f"partitioned by {parts}, not {list(partition_by)}")
    return found


def _refuse_drift(spark: SparkSession, name: str, schema: T.StructType, partition_by: Sequence[str]) -> None:
    found = drift(spark, name, schema, partition_by)
    if found:
        raise TableDrift(f"{name}: " + "; ".join(found))


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, partition_by: Sequence[str] = (),
                 properties: Mapping[str, str] | None = None, location: str | None = None) -> bool:
    """Creates the table if it is absent; whether it did. A table that exists
    is left as it is and must fit the contract."""
    name = quoted(name)
    absent = not spark.catalog.tableExists(name)
    if absent:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        text = f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"
        if partition_by:
            text += " PARTITIONED BY (" + ", ".join(f"`{c}`" for c in partition_by) + ")"
        if location:
            text += f" LOCATION {_text(location)}"
        if properties:
            text += " TBLPROPERTIES (" + ", ".join(f"{_text(k)} = {_text(v)}" for k, v in properties.items()) + ")"
        spark.sql(text)
    _refuse_drift(spark, name, schema, partition_by)
    return absent


def append_table(df: DataFrame, name: str, schema: T.StructType, partition_by: Sequence[str] = ()) -> None:
    """Appends rows by column name; a table or rows that drifted are refused
    before anything is written."""
    spark = df.sparkSession
    _refuse_drift(spark, name, schema, partition_by)
    rows = conform(conform(df, schema), spark.table(name).schema)  # partition columns last, as the table has them
    clustered(rows, partition_by).write.insertInto(name)


def read_by_name(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {quoted(name)}").collect()}
