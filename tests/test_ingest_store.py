"""Payload parsing, strict/permissive dates, lookback, sinks."""

import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from indicata.schemas import BRONZE, SILVER_PLAIN
from indicata.sources import payload as P
from indicata.sources import store

D = dt.date


def texts(spark, payloads):
    return spark.createDataFrame([(i, json.dumps(p)) for i, p in enumerate(payloads)], "id int, payload string")


def test_payload_parses_to_date_and_double(spark):
    df = texts(spark, [[{"data": "03/09/2021", "valor": "7.75"}, {"data": "04/09/2021", "valor": " -8e-1 "}]])
    out = P.parse_observations(P.explode_payload(df))
    assert dict(out.dtypes)["valor"] == "double" and dict(out.dtypes)["data"] == "date"
    assert [(r.posicao, r.data, r.valor) for r in out.orderBy("posicao").collect()] == [
        (0, D(2021, 9, 3), 7.75), (1, D(2021, 9, 4), -0.8)]


@pytest.mark.parametrize("text", ["N/D", "NaN", "Infinity", "inf", "1.5d", "2f", "", "1,5", "1e999", "0x10"])
def test_anything_but_a_plain_decimal_is_null(spark, text):
    df = texts(spark, [[{"data": "03/09/2021", "valor": text}]])
    assert P.parse_observations(P.explode_payload(df)).first().valor is None


def test_unreadable_payloads_are_rows_or_raise(spark):
    payloads = [None, "<html>", '[{"data": "03/09/2021", "valor": "1"}', '[{"data": "03/09/2021", "valor": "1"}]', "[]"]
    df = spark.createDataFrame(list(enumerate(payloads)), "id int, payload string")
    parsed = P.parse_observations(P.explode_payload(df), strict=False)
    good, bad = P.split_quarantine(parsed)
    assert [r.id for r in good.collect()] == [3]
    assert sorted((r.id, r.motivo) for r in bad.collect()) == [(i, P.UNREADABLE) for i in (0, 1, 2)]
    for i in (0, 1, 2):
        with pytest.raises(PySparkException):
            P.parse_observations(P.explode_payload(df.filter(f"id = {i}")), strict=True).collect()


def test_bad_date_strict_raises_permissive_quarantines(spark):
    df = texts(spark, [[{"data": "31/02/2024", "valor": "1"}, {"data": "01/03/2024", "valor": "2"}]])
    with pytest.raises(PySparkException):
        P.parse_observations(P.explode_payload(df), strict=True).collect()
    good, bad = P.split_quarantine(P.parse_observations(P.explode_payload(df), strict=False))
    assert (good.count(), bad.count()) == (1, 1)


def test_read_landed_files(spark, tmp_path):
    for serie, rows in {"a": [("01/01/2024", "1.5")], "b": [("02/01/2024", "2.5"), ("03/01/2024", "N/D")]}.items():
        d = tmp_path / serie
        d.mkdir()
        (d / "batch.json").write_text(json.dumps([{"data": x, "valor": y} for x, y in rows]))
    out = P.parse_observations(P.read_landed(spark, str(tmp_path)))
    got = sorted((r.serie, r.data, r.valor) for r in out.collect())
    assert got == [("a", D(2024, 1, 1), 1.5), ("b", D(2024, 1, 2), 2.5), ("b", D(2024, 1, 3), None)]


def test_lookback_window(spark):
    df = spark.createDataFrame([(D(2024, 1, 1),), (D(2024, 12, 31),), (D(2025, 1, 1),)], "d date")
    assert sorted(r.d for r in P.lookback(df, "d", 365).collect()) == [D(2024, 12, 31), D(2025, 1, 1)]


def test_bronze_append_is_cumulative_and_by_name(spark, tmp_path):
    path = str(tmp_path / "bronze")
    batch = spark.createDataFrame([("s", D(2024, 1, 1), 1.0)], "serie string, data date, valor double")
    for hour in (10, 11):
        rows = store.add_audit_columns(batch, dt.datetime(2024, 1, 1, hour), "api", "rate")
        store.append_bronze(rows.select(*reversed(rows.columns)), path, BRONZE)
    back = store.read_table(spark, path, BRONZE)
    assert back.count() == 2
    assert {r._ingested_at.hour for r in back.collect()} == {10, 11}


def test_conform_rejects_missing_column(spark):
    df = spark.createDataFrame([("s", D(2024, 1, 1))], "serie string, data date")
    with pytest.raises(store.SchemaMismatch):
        store.conform(df, SILVER_PLAIN)


def test_dynamic_overwrite_keeps_other_partitions(spark, tmp_path):
    from indicata.schemas import SILVER_INFLATION
    from indicata.plans import silver as S
    path = str(tmp_path / "silver")
    src = spark.createDataFrame([("s", D(2024, m, 1), float(m)) for m in (1, 2, 3)],
                                "serie string, data date, valor double")
    silver = S.silver_inflation(src, dedup=False)
    store.overwrite_partitions(silver, path, SILVER_INFLATION)
    store.overwrite_partitions(silver.filter(F.col("mes") == 2).withColumn("valor", F.lit(20.0)), path,
                               SILVER_INFLATION)
    got = sorted((r.mes, r.valor) for r in store.read_table(spark, path, SILVER_INFLATION).collect())
    assert got == [(1, 1.0), (2, 20.0), (3, 3.0)]


def test_control_record_duration_and_roundtrip(spark, tmp_path):
    runs = spark.createDataFrame(
        [("t", "ingest", "api", "bronze", 5, dt.datetime(2024, 1, 1, 0, 0, 0, 250000),
          dt.datetime(2024, 1, 1, 0, 1, 30, 500000), "success", {"k": "v"})],
        "table_name string, process_name string, source string, layer string, row_count long, "
        "started_at timestamp_ntz, finished_at timestamp_ntz, status string, metadata map<string,string>")
    path = str(tmp_path / "control")
    store.append_control(store.control_records(runs), path)
    store.append_control(store.control_records(runs), path)
    back = store.read_control(spark, path)
    assert back.count() == 2
    r = back.first()
    assert r.duration_seconds == 90.25 and r.metadata == {"k": "v"}
    assert r.started_at == dt.datetime(2024, 1, 1, 0, 0, 0, 250000)


def test_lookback_adds_year_bounds_for_partition_pruning(spark, tmp_path):
    path = str(tmp_path / "by_year")
    df = spark.createDataFrame([(D(2020, 5, 1), 2020), (D(2024, 12, 31), 2024), (D(2025, 1, 1), 2025)],
                               "data date, ano int")
    df.write.partitionBy("ano").parquet(path)
    back = spark.read.parquet(path)
    out = P.lookback(back, "data", 365)
    assert sorted(r.data for r in out.collect()) == [D(2024, 12, 31), D(2025, 1, 1)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ano" in plan


def test_partitioned_writes_leave_few_files(spark, tmp_path):
    from indicata.schemas import SILVER_FX
    from indicata.plans import silver as S
    days = spark.range(2000).select(
        (F.col("id") % 5).cast("string").alias("serie"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 700).cast("int")).alias("data"),
        (F.col("id") + 1.0).alias("valor")).repartition(8)
    path = tmp_path / "fx"
    silver = S.silver_fx(days.dropDuplicates(["serie", "data"]), dedup=False).repartition(8)
    rows = silver.count()
    store.overwrite_partitions(silver, str(path), SILVER_FX)
    folders = [d for d in path.glob("ano=*/mes=*")]
    assert len(list(path.rglob("*.parquet"))) <= 2 * len(folders)
    assert store.read_table(spark, str(path), SILVER_FX).count() == rows


def test_a_cluster_without_a_shared_folder_is_an_error():
    from indicata.session import ensure_checkpoint_dir

    class Conf(dict):
        def set(self, k, v):
            self[k] = v

    class Session:
        conf = Conf({"spark.master": "spark://host:7077"})
        sparkContext = property(lambda self: (_ for _ in ()).throw(RuntimeError()))

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_newest_rows_are_dealt_out_before_they_are_sorted(spark, monkeypatch):
    """No task sorts all that it reads of a file: tasks are as many as the rows ask for."""
    import datetime as dt

    from indicata.plans import current
    monkeypatch.setattr(current, "TASK_ROWS", 10)
    day = dt.date(2024, 1, 1)
    rows = [(str(i % 40), day, float(i), dt.datetime(2024, 1, 1 + i // 40), "0") for i in range(100)]
    df = spark.createDataFrame(rows, "serie string, data date, valor double, _ingested_at timestamp_ntz, _seq string")
    out = current.newest(df)
    assert out.rdd.getNumPartitions() == 10
    assert sorted(r.valor for r in out.collect()) == sorted([*map(float, range(80, 100)), *map(float, range(60, 80))])
