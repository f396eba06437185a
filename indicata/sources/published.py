"""Tables that are replaced in one step.

Spark's own overwrite deletes the old files before the new ones are there, so
a write that fails half way leaves no table. Here a table is a folder with its
data in one sub-folder for each write and a small file, ``_current.json``, that
names the folders which make up the table now:

    <path>/_current.json
    <path>/data/_version=00000003-1f2e3d4c/ano=2024/mes=3/part-*.parquet

A write goes to a fresh folder, is checked there if a check is given, and only
then is the file replaced, by one rename. Until that moment, and after any
failure, readers get the old table; a reader that has planned its scan keeps
its files, as they are deleted by ``vacuum`` only when a later write has
replaced them. Partitions are carried over by name, so a write that replaces
some of them moves no data of the others, and a partition that the new result
lacks goes in the same step. One writer at a time is assumed: a write that
finds another's result at its end raises and changes nothing.

The folders named are as many as partitions (years and months of the history),
whatever the number of rows. Partition values are numbers or plain words.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CURRENT, DATA, VERSION = "_current.json", "data", "_version"
#: Files that a task of a partitioned write keeps open.
OPEN_FILES = 8
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


class PublishConflict(RuntimeError):
    """Another write replaced the table meanwhile."""


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, asked of the file system that holds it."""
    p, fs = _fs(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def folders(spark: SparkSession, path: str, depth: int = 1) -> list[str]:
    """Names of the folders ``depth`` levels below ``path``, relative to it;
    folders that Spark would not read are left out."""
    if depth == 0:
        return [""]
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())
    names = [n for n in names if "=" in n or not n.startswith(("_", "."))]
    return [f"{n}/{below}".rstrip("/") for n in names for below in folders(spark, f"{path}/{n}", depth - 1)]


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file and puts it in place by a rename that replaces."""
    fs_package = spark._jvm.org.apache.hadoop.fs
    beside, fs = _fs(spark, f"{path}.{uuid.uuid4().hex[:8]}")
    out = fs.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    p, _ = _fs(spark, path)
    how = spark._sc._gateway.new_array(getattr(fs_package, "Options$Rename"), 1)
    how[0] = getattr(fs_package, "Options$Rename").OVERWRITE
    fs_package.FileContext.getFileContext(p.toUri(), spark._jsc.hadoopConfiguration()).rename(beside, p, how)


def read_small(spark: SparkSession, path: str) -> str | None:
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def current(spark: SparkSession, path: str) -> dict | None:
    """What the table is now, or None where nothing was published."""
    text = read_small(spark, f"{path}/{CURRENT}")
    return None if text is None else json.loads(text)


def read(spark: SparkSession, path: str, schema: T.StructType | None = None,
         only: Iterable[str] | None = None, state: dict | None = None) -> DataFrame:
    """The published table, or those partitions of it that ``only`` names
    (``"ano=2024"``, ``"ano=2024/mes=3"``); others are not even listed."""
    state = state or current(spark, path)
    schema = schema or T.StructType.fromJson(state["schema"])
    dirs = state["dirs"]
    if only is not None:
        wanted = set(only)
        dirs = {spec: d for spec, d in dirs.items() if spec in wanted}
    if not dirs:
        return spark.createDataFrame([], schema)
    base = f"{path}/{DATA}"
    whole = T.StructType([*schema.fields, T.StructField(VERSION, T.StringType())])
    return spark.read.schema(whole).option("basePath", base) \
        .parquet(*[f"{base}/{d}" for d in sorted(dirs.values())]).select(*schema.fieldNames())


@contextmanager
def unsorted_writes(spark: SparkSession):
    """Partitioned writes keep the files of a task's partitions open (up to
    OPEN_FILES, further ones are sorted) instead of sorting all its rows first:
    a task of well compressed rows would hold tens of millions in memory."""
    before = spark.conf.get(_WRITERS, "0")
    if before == "0":
        spark.conf.set(_WRITERS, str(OPEN_FILES))
    try:
        yield
    finally:
        spark.conf.set(_WRITERS, before)


def publish(df: DataFrame, path: str, partition_by: Sequence[str] = (), replace: Iterable[str] | None = None,
            check: Callable[[DataFrame], None] | None = None) -> dict:
    """Replaces the table, or only the partitions that ``replace`` names.

    Without ``replace`` the rows of ``df`` are the whole table. With it they
    are what those partitions hold from now on: a named partition without rows
    is gone, rows of any other partition are an error. ``df`` may read the
    table it replaces. ``check`` gets the table as readers would see it and
    raises to refuse it.
    """
    spark, schema = df.sparkSession, df.schema
    before = current(spark, path)
    number = before["number"] + 1 if before else 1
    version = f"{VERSION}={number:08d}-{uuid.uuid4().hex[:8]}"
    folder = f"{path}/{DATA}/{version}"
    try:
        if partition_by:
            with unsorted_writes(spark):
                df.hint("rebalance", *partition_by).write.partitionBy(*partition_by).parquet(folder)
        else:
            df.write.parquet(folder)
        fresh = {spec: f"{version}/{spec}".rstrip("/") for spec in folders(spark, folder, len(partition_by))}
        kept = {}
        if replace is not None:
            scope = set(replace)
            outside = sorted(set(fresh) - scope)
            if outside:
                raise ValueError(f"rows outside the partitions to replace: {outside[:5]}")
            kept = {spec: d for spec, d in (before["dirs"] if before else {}).items() if spec not in scope}
        state = {"number": number, "schema": json.loads(schema.json()), "partition_by": list(partition_by),
                 "dirs": kept | fresh, "previous": sorted(before["dirs"].values()) if before else []}
        if check is not None:
            check(read(spark, path, state=state))
        if current(spark, path) != before:
            raise PublishConflict(f"{path} was replaced while this write ran")
        write_small(spark, f"{path}/{CURRENT}", json.dumps(state))
    except BaseException:
        delete(spark, folder)
        raise
    return state


def vacuum(spark: SparkSession, path: str) -> list[str]:
    """Deletes what neither the table nor the one before it holds; returns it.

    Writes still under way have a greater number and are left alone.
    """
    state = current(spark, path)
    if state is None:
        return []
    named = [*state["dirs"].values(), *state["previous"]]
    gone = []
    for version in folders(spark, f"{path}/{DATA}"):
        held = [d for d in named if d.split("/")[0] == version]
        if int(version.split("=")[1].split("-")[0]) > state["number"]:
            continue
        if not held:
            gone.append(version)
        elif state["partition_by"]:
            inside = folders(spark, f"{path}/{DATA}/{version}", len(state["partition_by"]))
            gone += [d for d in (f"{version}/{spec}" for spec in inside) if d not in held]
    for d in gone:
        delete(spark, f"{path}/{DATA}/{d}")
    return gone


def partitions(spark: SparkSession, path: str) -> list[str]:
    """Names of the partitions that the table holds."""
    state = current(spark, path)
    return sorted(state["dirs"]) if state else []


def specs(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Partition names of the rows of ``df``: as many as partitions."""
    named = F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in columns])
    return sorted(r.s for r in df.select(named.alias("s")).distinct().collect())
