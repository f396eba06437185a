"""Tables replaced in one step: failing writes, refused results, vanished partitions."""

import json

import pytest
from pyspark.sql import functions as F

from indicata.sources import published as P
from indicata.sources import store

SCHEMA = "serie string, valor double, ano int, mes int"


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def failing(spark, n=200):
    """Rows whose last part raises while it is written."""
    df = spark.range(n, numPartitions=4).select(
        F.lit("s").alias("serie"), F.col("id").cast("double").alias("valor"), F.lit(2024).alias("ano"),
        (F.col("id") % 12).cast("int").alias("mes"))
    return df.withColumn("valor", F.when(F.col("valor") < n - 1, F.col("valor"))
                         .otherwise(F.raise_error(F.lit("disk gone")).cast("double")))


@pytest.mark.parametrize("partition_by", [(), ("ano", "mes")])
def test_a_write_that_fails_half_way_leaves_the_table(spark, tmp_path, partition_by):
    path = str(tmp_path / "t")
    old = frame(spark, ("a", 1.0, 2024, 1), ("b", 2.0, 2024, 2))
    store.overwrite_all(old, path, partition_by=partition_by)
    reader = store.read_table(spark, path)
    for _ in range(2):
        with pytest.raises(Exception, match="disk gone"):
            store.overwrite_all(failing(spark), path, partition_by=partition_by)
    assert rows_of(store.read_table(spark, path)) == rows_of(old) == rows_of(reader)
    assert len(P.folders(spark, f"{path}/{P.DATA}")) == 1  # nothing of the failed writes is left
    new = frame(spark, ("c", 3.0, 2025, 1))
    store.overwrite_all(new, path, partition_by=partition_by)
    assert rows_of(store.read_table(spark, path)) == rows_of(new)


def test_a_crash_before_the_switch_leaves_the_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    store.overwrite_all(frame(spark, ("a", 1.0, 2024, 1)), path)
    def crash(*_):
        raise KeyboardInterrupt
    with monkeypatch.context() as m:
        m.setattr(P, "write_small", crash)
        m.setattr(P, "delete", lambda *_: None)  # as when the driver dies
        with pytest.raises(KeyboardInterrupt):
            store.overwrite_all(frame(spark, ("b", 2.0, 2024, 2)), path)
    assert rows_of(store.read_table(spark, path)) == [("a", 1.0, 2024, 1)]
    store.overwrite_all(frame(spark, ("c", 3.0, 2024, 2)), path)
    assert len(P.vacuum(spark, path)) == 1  # what the crash left
    assert rows_of(store.read_table(spark, path)) == [("c", 3.0, 2024, 2)]


def test_a_running_reader_keeps_its_files(spark, tmp_path):
    path = str(tmp_path / "t")
    store.overwrite_all(frame(spark, ("a", 1.0, 2024, 1)), path)
    reader = store.read_table(spark, path)
    store.overwrite_all(frame(spark, ("b", 2.0, 2024, 1)), path)
    assert P.vacuum(spark, path) == []  # the table before this one stays
    assert rows_of(reader) == [("a", 1.0, 2024, 1)]
    store.overwrite_all(frame(spark, ("c", 3.0, 2024, 1)), path)
    assert len(P.vacuum(spark, path)) == 1


def test_a_refused_result_is_not_published(spark, tmp_path):
    path = str(tmp_path / "t")
    def nothing_negative(df):
        if df.filter("valor < 0").count():
            raise ValueError("refused")
    store.overwrite_all(frame(spark, ("a", 1.0, 2024, 1)), path, check=nothing_negative)
    with pytest.raises(ValueError, match="refused"):
        store.overwrite_all(frame(spark, ("a", -1.0, 2024, 1)), path, check=nothing_negative)
    assert rows_of(store.read_table(spark, path)) == [("a", 1.0, 2024, 1)]


def test_partitions_are_replaced_and_vanish_in_one_step(spark, tmp_path):
    path, by = str(tmp_path / "t"), ("ano", "mes")
    schema = frame(spark).schema
    store.overwrite_all(frame(spark, ("a", 1.0, 2024, 1), ("a", 2.0, 2024, 2), ("a", 3.0, 2024, 3)), path, schema, by)
    january = P.current(spark, path)["dirs"]["ano=2024/mes=1"]
    # the new rows come from the table itself; February has none any more
    doubled = store.read_table(spark, path, schema).filter("mes = 3").withColumn("valor", F.col("valor") * 2)
    store.replace_partitions(doubled, path, schema, ["ano=2024/mes=2", "ano=2024/mes=3", "ano=2024/mes=4"], by)
    assert rows_of(store.read_table(spark, path, schema)) == [("a", 1.0, 2024, 1), ("a", 6.0, 2024, 3)]
    assert P.partitions(spark, path) == ["ano=2024/mes=1", "ano=2024/mes=3"]
    assert P.current(spark, path)["dirs"]["ano=2024/mes=1"] == january  # not written again
    with pytest.raises(ValueError, match="outside"):
        store.replace_partitions(frame(spark, ("a", 9.0, 2024, 1)), path, schema, ["ano=2024/mes=2"], by)
    store.replace_partitions(frame(spark), path, schema, P.partitions(spark, path), by)
    assert rows_of(store.read_table(spark, path, schema)) == []


def test_only_named_partitions_are_listed(spark, tmp_path):
    path, by = str(tmp_path / "t"), ("ano",)
    schema = frame(spark).schema
    store.overwrite_all(frame(spark, ("a", 1.0, 2023, 1), ("a", 2.0, 2024, 2), ("a", 3.0, 2025, 3)), path, schema, by)
    some = store.read_table(spark, path, schema, only=["ano=2024", "ano=1900"])
    assert rows_of(some) == [("a", 2.0, 2024, 2)] and len(some.inputFiles()) == 1
    assert P.specs(frame(spark, ("a", 1.0, 2023, 1), ("b", 1.0, 2023, 1)), ("ano", "mes")) == ["ano=2023/mes=1"]


def test_vacuum_deletes_replaced_partitions_only(spark, tmp_path):
    path, by = str(tmp_path / "t"), ("ano",)
    schema = frame(spark).schema
    store.overwrite_all(frame(spark, ("a", 1.0, 2023, 1), ("a", 2.0, 2024, 2)), path, schema, by)
    for v in (5.0, 6.0):
        store.replace_partitions(frame(spark, ("a", v, 2024, 2)), path, schema, ["ano=2024"], by)
    gone = P.vacuum(spark, path)
    assert len(gone) == 1 and gone[0].endswith("/ano=2024")
    assert rows_of(store.read_table(spark, path, schema)) == [("a", 1.0, 2023, 1), ("a", 6.0, 2024, 2)]


def test_two_writers_conflict(spark, tmp_path):
    path = str(tmp_path / "t")
    store.overwrite_all(frame(spark, ("a", 1.0, 2024, 1)), path)
    def other(_):
        P.write_small(spark, f"{path}/{P.CURRENT}", json.dumps(P.current(spark, path) | {"number": 7}))
    with pytest.raises(P.PublishConflict):
        store.overwrite_all(frame(spark, ("b", 2.0, 2024, 1)), path, check=other)
    assert rows_of(store.read_table(spark, path)) == [("a", 1.0, 2024, 1)]


def test_an_empty_table_keeps_its_schema(spark, tmp_path):
    for n, by in enumerate([(), ("ano",)]):
        path = str(tmp_path / f"t{n}")
        store.overwrite_all(frame(spark), path, partition_by=by)
        got = store.read_table(spark, path)
        assert got.count() == 0 and got.columns == ["serie", "valor", "ano", "mes"]


def test_a_partitioned_write_sorts_no_rows(spark, tmp_path):
    """A task keeps the files of its partitions open instead of sorting all its rows;
    beyond so many files the rows are right as well."""
    from indicata.sources import published
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    df = spark.range(1000).selectExpr("id", "cast(id % 30 as int) as ano")
    published.publish(df, str(tmp_path / "t"), ("ano",))
    assert spark.conf.get(key) == before
    runs = spark._jsparkSession.sharedState().statusStore().executionsList()
    plans = [runs.apply(i).physicalPlanDescription() for i in range(runs.size())]
    plan = [p for p in plans if str(tmp_path) in p and "InsertIntoHadoopFsRelationCommand" in p][-1]
    assert "Sort" not in plan
    got = published.read(spark, str(tmp_path / "t")).collect()
    assert sorted((r.id, r.ano) for r in got) == [(i, i % 30) for i in range(1000)]
