"""Tables by name, sorted tables, samples, run log, split reader, counts."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from indicata.operators import layout
from indicata.operators import profiles as PR
from indicata.operators.sampling import bottom_k
from indicata.schemas import SILVER_INFLATION
from indicata.sources import payload as P
from indicata.sources import published, store, tables

# ---------------------------------------------------------------- tables by name


@pytest.fixture
def name(spark, tmp_path):
    n = "t_" + tmp_path.name.replace("-", "_").replace("[", "_").replace("]", "_")
    yield n
    spark.sql(f"DROP TABLE IF EXISTS {n}")


def inflation(spark, mes, valor):
    return spark.createDataFrame([("ipca", dt.date(2024, mes, 1), valor, None, valor, valor, "x", 2024, mes, 1)],
                                 SILVER_INFLATION)


def test_a_table_is_created_once_and_appended_by_name(spark, tmp_path, name):
    by, props = ("ano", "mes"), {"camada": "silver", "dono's": "a\\b"}
    make = lambda: tables.ensure_table(spark, name, SILVER_INFLATION, by, props, str(tmp_path / "rows"))
    assert make() is True and make() is False
    assert tables.partition_columns(spark, name) == ["ano", "mes"]
    assert {k: v for k, v in tables.properties(spark, name).items() if k in props} == props
    for mes in (1, 2):
        rows = inflation(spark, mes, float(mes))
        tables.append_table(rows.select(*reversed(rows.columns)), name, SILVER_INFLATION, by)
    assert sorted((r.mes, r.valor) for r in tables.read_by_name(spark, name).collect()) == [(1, 1.0), (2, 2.0)]
    january = tables.read_by_name(spark, name).filter("mes = 1")
    assert len(january.inputFiles()) >= 1 and january.count() == 1


def test_drift_is_refused_before_a_write(spark, tmp_path, name):
    by = ("ano", "mes")
    tables.ensure_table(spark, name, SILVER_INFLATION, by, location=str(tmp_path / "rows"))
    rows = inflation(spark, 1, 1.0)
    with pytest.raises(store.SchemaMismatch, match="pressao"):
        tables.append_table(rows.drop("pressao"), name, SILVER_INFLATION, by)
    other = type(SILVER_INFLATION)([f for f in SILVER_INFLATION.fields if f.name != "pressao"])
    with pytest.raises(tables.TableDrift, match="unknown column pressao"):
        tables.append_table(rows, name, other, by)
    with pytest.raises(tables.TableDrift, match="partitioned by"):
        tables.ensure_table(spark, name, SILVER_INFLATION, ("ano",))
    assert spark.table(name).count() == 0
    with pytest.raises(ValueError, match="no table name"):
        tables.ensure_table(spark, "x; DROP TABLE y", SILVER_INFLATION)


# ---------------------------------------------------------------- sorted tables

def test_a_range_reads_the_files_that_hold_it(spark, tmp_path):
    df = spark.range(2000).select((F.col("id") * 7919 % 2000).alias("k"), F.col("id").alias("v"))
    df = df.unionByName(spark.createDataFrame([(None, -1)], df.schema))
    path = str(tmp_path / "sorted")
    layout.write_sorted(df, path, ("k",), partitions=8)
    zones = sorted(layout.zones(spark, path).collect(), key=lambda z: z.arquivo)
    assert sum(z.linhas for z in zones) == 2001 and sum(z.nulos for z in zones) == 1 and len(zones) == 8
    assert all(a.maior <= b.menor for a, b in zip(zones, zones[1:]))
    some = layout.read_range(spark, path, "k", 300, 420)
    assert sorted(r.k for r in some.collect()) == list(range(300, 421))
    assert 1 <= len(some.inputFiles()) <= 2 and len(spark.read.parquet(f"{path}/rows").inputFiles()) == 8
    assert layout.read_range(spark, path, "k", 5000, 6000).count() == 0


# ---------------------------------------------------------------- samples

def test_a_sample_is_the_same_for_any_partitioning(spark):
    df = spark.range(5000).select("id", (F.col("id") % 100 < 98).alias("g"))
    one, many = bottom_k(df.coalesce(1), 25, ("id",)), bottom_k(df.repartition(13), 25, ("id",))
    assert sorted(one.collect()) == sorted(many.collect()) and one.count() == 25
    by = bottom_k(df.repartition(5), 30, ("id",), by=("g",))
    assert sorted(r["count"] for r in by.groupBy("g").count().collect()) == [30, 30]
    # the sample of a union is that of the parts' samples
    parts = bottom_k(df.filter("id < 900"), 25, ("id",)).unionByName(bottom_k(df.filter("id >= 900"), 25, ("id",)))
    assert sorted(bottom_k(parts, 25, ("id",)).collect()) == sorted(one.collect())
    plan = by._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


# ---------------------------------------------------------------- run log

def record(spark, *rows):
    runs = spark.createDataFrame(
        [(t, "ingest", "s", "bronze", n, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 0, 1, 5), "success",
          {"k": t}) for t, n in rows],
        "table_name string, process_name string, source string, layer string, row_count long, "
        "started_at timestamp_ntz, finished_at timestamp_ntz, status string, metadata map<string,string>")
    return store.control_records(runs)


def test_many_runs_leave_few_files(spark, tmp_path):
    path = str(tmp_path / "control")
    for n in range(23):
        store.append_control(record(spark, (f"t{n}", n), ("both", n)), path, f"run-{n}", compact_at=5)
        if n in (3, 20):  # a retried step
            store.append_control(record(spark, (f"t{n}", n), ("both", n)), path, f"run-{n}", compact_at=5)
    assert len(published.folders(spark, f"{path}/runs")) < 5
    log = store.read_control(spark, path)
    assert sorted(r.row_count for r in log.filter("table_name = 'both'").collect()) == list(range(23))
    assert {r.duration_seconds for r in log.collect()} == {1.000005} and log.count() == 46
    files = [f for f in (tmp_path / "control").rglob("*") if f.is_file() and f.name.startswith("part-")]
    assert len(files) <= 12


def test_a_crash_while_compacting_doubles_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "control")
    for n in range(3):
        store.append_control(record(spark, (f"t{n}", n)), path, f"run-{n}")
    with monkeypatch.context() as m:
        m.setattr(published, "delete", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            store.compact_control(spark, path)
    assert store.read_control(spark, path).count() == 3
    store.compact_control(spark, path)
    assert store.read_control(spark, path).count() == 3 and published.folders(spark, f"{path}/runs") == []
    with pytest.raises(ValueError):
        store.append_control(record(spark, ("t", 1)), path, "../x")


# ---------------------------------------------------------------- split reader

def items_of(df):
    return sorted((tuple(r[c] for c in ("serie", "arquivo", "data_texto", "valor_texto", "motivo", "_seq"))
                   for r in df.collect()), key=repr)


TRICKY = {
    "a/plain.json": json.dumps([{"data": f"{1 + i % 28:02d}/01/2024", "valor": str(i)} for i in range(700)]),
    "a/spaced.json": "\n [ " + " ,\n\t".join(f'{{ "data" : "01/02/2024",\n "valor" : "{i}" }}' for i in range(90)) + "\n]\n",
    "a/numbers.json": '[{"data":"01/02/2024","valor":1.50},{"valor":null,"data":"02/02/2024","x":true},{}]',
    "b/brace-in-text.json": '[{"data":"01/02/2024","valor":"}"},{"data":"a}b{","valor":"1"}]',
    "b/nested.json": '[{"data":"01/02/2024","valor":"1","extra":{"y":[1,2]}},{"data":"02/02/2024","valor":"2"}]',
    "b/escapes.json": '[{"data":"01/02/2024","valor":"\\"1\\" \\u00e9 \\\\"},{"data":"é😀","valor":"2"}]',
    "c/cut.json": '[{"data":"01/02/2024","valor":"1"},{"data":"02/02/20',
    "c/no-end.json": '[{"data":"01/02/2024","valor":"1"}',
    "c/two-arrays.json": '[{"data":"01/02/2024","valor":"1"}][{"data":"01/02/2024","valor":"2"}]',
    "c/no-comma.json": '[{"data":"01/02/2024","valor":"1"} {"data":"01/02/2024","valor":"2"}]',
    "c/html.json": "<html>} {</html>", "d/empty.json": "[]", "d/spaces.json": " [ \n ] ", "d/nothing.json": "",
    "d/object.json": '{"data":"01/02/2024","valor":"1"}', "d/bad-escape.json": '[{"data":"\\q","valor":"1"}]',
    "d/control.json": '[{"data":"a\nb","valor":"1"}]', "d/bom.json": "﻿[]", "d/zero.json": '[{"data":"x","valor":01}]',
    "serie=e/plain.json": '[{"data":"01/02/2024","valor":"1"}]',
}


def test_split_files_give_the_same_rows(spark, tmp_path):
    for file, text in TRICKY.items():
        (tmp_path / file).parent.mkdir(exist_ok=True)
        (tmp_path / file).write_text(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
        whole = items_of(P.read_landed(spark, str(tmp_path)))
        for above in (-1, 0, 60, 1000):
            assert items_of(P.read_landed(spark, str(tmp_path), split_above=above)) == whole, above
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_one_file_feeds_many_tasks(spark, tmp_path):
    (tmp_path / "s").mkdir()
    rows = [{"data": f"{1 + i % 28:02d}/0{1 + i % 9}/2020", "valor": str(i)} for i in range(40_000)]
    (tmp_path / "s" / "big.json").write_text(json.dumps(rows))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128k")
        got = P.read_landed(spark, str(tmp_path), split_above=1 << 20)
        ranges = [f for f in got.inputFiles()]
        assert len(ranges) > 1  # pieces of several tasks
        found = got.orderBy("_seq").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r._seq for r in found] == [f"big.json#{i:010d}" for i in range(40_000)]
    assert [r.valor_texto for r in found] == [str(i) for i in range(40_000)]


# ---------------------------------------------------------------- counts

def test_counts_read_no_column(spark, tmp_path):
    import re
    df = spark.range(1000).select("id", F.lit("x").alias("t"))
    store.overwrite_all(df, str(tmp_path / "a"))
    store.overwrite_all(df.limit(0), str(tmp_path / "b"))
    got = PR.row_counts({"a": ("bronze", store.read_table(spark, str(tmp_path / "a"))),
                         "b": ("silver", store.read_table(spark, str(tmp_path / "b")))})
    assert sorted(tuple(r) for r in got.collect()) == [("a", "bronze", 1000), ("b", "silver", 0)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert set(re.findall(r"ReadSchema: struct<([^>]*)>", plan)) == {""}


def test_sorted_silver_is_computed_once(spark, monkeypatch):
    """Dealing rows out by ranges reads its input twice; silver is a written table by then."""
    from indicata.plans import registry
    from tests.conftest import SF_SMALL
    made = []
    number = registry.global_row_number
    monkeypatch.setattr(registry, "global_row_number",
                        lambda df, *a: made.append(df._jdf.queryExecution().optimizedPlan().toString()) or number(df, *a))
    got = registry.silver_rate_sorted(spark, SF_SMALL).orderBy("ordem").collect()
    assert "Window" not in made[0] and "Aggregate" not in made[0]
    keys = [(r.serie, r.data) for r in got]
    assert keys == sorted(keys) and [r.ordem for r in got] == list(range(len(got)))
