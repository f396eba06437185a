"""End-to-end runs: batch pipeline over landed files, and the streaming ingest."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from indicata.plans import current as CS
from indicata.plans import pipeline as PL
from indicata.plans.pipeline import run_pipeline
from indicata.schemas import BRONZE_SEQ as BRONZE
from indicata.sources import published, store
from indicata.streaming.ingest import observations, quarantine, start_ingest
from tests.e2e_fixture import FIXTURE, GOLD

KIND_DIR = {"rate": "rate", "fx": "fx", "inflation": "inflation", "level": "plain", "ratio": "plain"}
RUN = dt.datetime(2024, 5, 1)


def land(root, fixture=FIXTURE, batch="b1"):
    for kind, (name, values) in fixture.items():
        d = root / KIND_DIR[kind] / name
        d.mkdir(parents=True, exist_ok=True)
        items = [{"data": dt.date.fromisoformat(x).strftime("%d/%m/%Y"), "valor": repr(v)} for x, v in values]
        (d / f"{batch}.json").write_text(json.dumps(items))


def month(gold, iso):
    return gold.filter(F.col("mes_ref") == F.lit(iso).cast("date")).first()


def log(records):
    return {(r.table_name, r.metadata.get("serie")): r for r in records.collect()}


def test_pipeline_builds_gold_and_checks(spark, tmp_path):
    landing, out = tmp_path / "landing", tmp_path / "out"
    land(landing)
    res = run_pipeline(spark, str(landing), str(out), RUN, check_month="2024-03-01")
    gold = res["gold"]
    assert gold.count() == 2
    for row in gold.collect():
        for col, value in GOLD[row.mes_ref.isoformat()].items():
            assert row[col] == pytest.approx(value, abs=1e-9), col
    assert all(r.aprovado for r in res["quality"].collect())
    assert all(r.aprovado for r in res["report"].collect())
    status = {(r.kind, r.serie): r.status for r in res["status"].collect()}
    assert status[("rate", "selic")] == "ok" and set(status.values()) == {"ok"} and len(status) == 5
    records = log(res["run"])
    assert len(records) == 5 + 4 + 1  # series, silver tables, gold
    spans = {(r.started_at, r.finished_at) for r in records.values()}
    assert len(spans) >= 8 and all(a <= b for a, b in spans)


def test_rerun_with_revision_keeps_newest(spark, tmp_path):
    landing, out = tmp_path / "landing", tmp_path / "out"
    land(landing)
    run_pipeline(spark, str(landing), str(out), RUN)
    landing2 = tmp_path / "landing2"
    land(landing2, {"rate": ("selic", [("2024-04-02", 0.07)])})
    res = run_pipeline(spark, str(landing2), str(out), RUN + dt.timedelta(days=1))
    assert month(res["gold"], "2024-04-01").selic_media_mes == pytest.approx(0.07)
    assert month(res["gold"], "2024-03-01").selic_media_mes == pytest.approx(0.04)


def test_no_row_is_lost_on_the_way_in(spark, tmp_path):
    landing, out = tmp_path / "landing", tmp_path / "out"
    land(landing)
    selic = landing / "rate" / "selic"
    (selic / "b2.json").write_text(json.dumps([{"data": "31/02/2024", "valor": "1"},
                                               {"data": "08/03/2024", "valor": "NaN"}]))
    (selic / "b3.json").write_text("<html>gateway error</html>")
    res = run_pipeline(spark, str(landing), str(out), RUN)
    bad = sorted((r.arquivo, r.motivo, r.data_texto) for r in PL.read_quarantine(spark, str(out)).collect())
    assert bad == [("b2.json", "data inválida", "31/02/2024"), ("b3.json", "payload ilegível", None)]
    kept = PL.read_bronze(spark, str(out)).filter("serie = 'selic'")
    assert kept.count() == 4 and kept.filter("valor IS NULL").count() == 1
    record = log(res["run"])[("bronze.rate", "selic")]
    assert (record.row_count, record.metadata["quarantined"], record.status) == (4, "2", "success")


def test_strict_stops_the_series_not_the_kind(spark, tmp_path):
    landing, out = tmp_path / "landing", tmp_path / "out"
    land(landing)
    other = landing / "fx" / "euro"
    other.mkdir()
    (other / "b1.json").write_text("not json")
    res = run_pipeline(spark, str(landing), str(out), RUN, strict=True)
    records = log(res["run"])
    assert records[("bronze.fx", "euro")].status == "error"
    assert "payload" in records[("bronze.fx", "euro")].metadata["error"]
    assert records[("bronze.fx", "dollar")].status == "success"
    status = {r.serie: r.status for r in res["status"].collect()}
    assert status["euro"] == "error" and status["dollar"] == "ok"
    # the next run is judged by its own records
    landing2 = tmp_path / "landing2"
    land(landing2)
    again = run_pipeline(spark, str(landing2), str(out), RUN + dt.timedelta(days=1), strict=True)
    assert again["run"].filter("status = 'error'").count() == 0
    assert again["control"].filter("status = 'error'").count() == 1


def test_gold_reads_only_series_with_a_role(spark, tmp_path):
    landing, out = tmp_path / "landing", tmp_path / "out"
    land(landing)
    land(landing, {"rate": ("outra", [("2024-03-04", 9.0)]), "inflation": ("outro", [("2024-03-01", 7.0)])})
    gold = run_pipeline(spark, str(landing), str(out), RUN)["gold"]
    march = month(gold, "2024-03-01")
    assert march.selic_media_mes == pytest.approx(0.04) and march.ipca_acumulado_mes == pytest.approx(0.4)


def test_first_run_with_nothing_but_an_empty_batch(spark, tmp_path):
    landing, out = tmp_path / "landing", tmp_path / "out"
    (landing / "rate" / "selic").mkdir(parents=True)
    (landing / "rate" / "selic" / "empty.json").write_text("[]")
    res = run_pipeline(spark, str(landing), str(out), RUN)
    assert {r.status for r in res["run"].collect()} == {"no_data"}
    assert ("bronze.rate", "selic") in log(res["run"])
    assert res["gold"] is None


def test_gold_that_fails_its_checks_is_not_published(spark, tmp_path):
    landing, out = tmp_path / "landing", tmp_path / "out"
    land(landing)
    before = run_pipeline(spark, str(landing), str(out), RUN)["gold"].collect()
    gate = PL.gold_gate
    try:
        PL.gold_gate = lambda gold: gate(gold.unionByName(gold))  # every month twice
        res = run_pipeline(spark, str(landing), str(out), RUN + dt.timedelta(days=1))
    finally:
        PL.gold_gate = gate
    record = log(res["run"])[("gold", None)]
    assert record.status == "error" and "mes_ref repetido = 2" in record.metadata["error"]
    assert sorted(res["gold"].collect()) == sorted(before)


def test_winner_inside_a_run_does_not_depend_on_file_sizes(spark, tmp_path):
    for turn, padding in enumerate(([400, 1], [1, 400])):
        landing, out = tmp_path / f"landing{turn}", tmp_path / f"out{turn}"
        land(landing)
        for name, value, n in zip(("2024-03-a.json", "2024-03-b.json"), ("0.11", "0.12"), padding, strict=True):
            filler = [{"data": f"{1 + i % 28:02d}/0{1 + i % 2}/2020", "valor": "0.5"} for i in range(n)]
            (landing / "rate" / "selic" / name).write_text(
                json.dumps([*filler, {"data": "20/03/2024", "valor": value}]))
        run_pipeline(spark, str(landing), str(out), RUN)
        silver = PL.read_silver(spark, str(out), "rate")
        assert silver.filter("data = DATE '2024-03-20'").first().valor == 0.12


def test_duplicate_date_in_one_file_and_missing_landing(spark, tmp_path):
    landing, out = tmp_path / "landing", tmp_path / "out"
    land(landing, dict(FIXTURE) | {"rate": ("selic", [("2024-03-04", 0.04), ("2024-03-04", 0.045)])})
    res = run_pipeline(spark, str(landing), str(out), RUN)
    assert month(res["gold"], "2024-03-01").selic_max_mes == pytest.approx(0.045)  # the later item
    with pytest.raises(FileNotFoundError):
        run_pipeline(spark, str(tmp_path / "missing"), str(out), RUN)


def test_streaming_ingest_processes_each_file_once(spark, tmp_path):
    landing = tmp_path / "landing"
    land(landing)
    table, ckpt = str(tmp_path / "streamed"), str(tmp_path / "ckpt")
    start_ingest(spark, str(landing / "rate"), "rate", table, ckpt).awaitTermination(120)
    assert observations(spark, table).count() == 3
    bad = landing / "rate" / "selic" / "b2.json"
    bad.write_text(json.dumps([{"data": "31/02/2024", "valor": "1"}, {"data": "03/04/2024", "valor": "0.06"}]))
    start_ingest(spark, str(landing / "rate"), "rate", table, ckpt).awaitTermination(120)
    assert observations(spark, table).count() == 4
    assert [r.motivo for r in quarantine(spark, table).collect()] == ["data inválida"]
    # a fresh checkpoint replays batch 0: it replaces what batch 0 wrote
    start_ingest(spark, str(landing / "rate"), "rate", table, str(tmp_path / "ckpt2")).awaitTermination(120)
    assert observations(spark, table).count() == 4 + 1  # batch 0 holds all four, batch 1 its one


def test_a_month_that_loses_its_rows_is_gone(spark, tmp_path):
    landing, out = tmp_path / "landing", tmp_path / "out"
    land(landing, {"rate": FIXTURE["rate"]})
    run_pipeline(spark, str(landing), str(out), RUN)
    months = lambda: sorted(r.mes for r in PL.read_silver(spark, str(out), "rate").select("mes").distinct().collect())
    assert months() == [3, 4]
    landing2 = tmp_path / "landing2"
    land(landing2, {"rate": ("selic", [("2024-04-02", -1.0)])})  # April's only row becomes invalid
    run_pipeline(spark, str(landing2), str(out), RUN + dt.timedelta(days=1))
    assert months() == [3]
    assert published.partitions(spark, str(out / "silver" / "rate")) == ["ano=2024/mes=3"]


def test_ingest_merges_only_the_years_it_touches(spark, tmp_path):
    landing, out = tmp_path / "landing", tmp_path / "out"
    land(landing, {"rate": ("selic", [(f"{y}-03-04", 0.01 * (y - 2000)) for y in range(2018, 2025)])})
    PL.ingest_kind(spark, str(landing), str(out), "rate", RUN)
    state = str(out / "current" / "rate")
    before = published.current(spark, state)["dirs"]
    landing2 = tmp_path / "landing2"
    land(landing2, {"rate": ("selic", [("2020-03-04", 9.0), ("2020-03-05", 8.0)])})
    read = []
    plain = store.read_table
    store.read_table = lambda *a, **k: read.append(plain(*a, **k)) or read[-1]
    try:
        PL.ingest_kind(spark, str(landing2), str(out), "rate", RUN + dt.timedelta(days=1))
    finally:
        store.read_table = plain
    merged = [f for df in read for f in df.inputFiles() if "/current/" in f]
    assert merged and all("ano=2020" in f for f in merged)
    after = published.current(spark, state)["dirs"]
    assert [y for y in after if after[y] != before[y]] == ["ano=2020"]
    columns = ["serie", "data", "valor", "_seq"]
    full = CS.newest(PL.read_bronze(spark, str(out))).select(columns).collect()
    assert sorted(full) == sorted(CS.read(spark, state).select(columns).collect()) and len(full) == 8


def test_a_run_that_died_before_its_merge_is_made_good(spark, tmp_path):
    landing, out = tmp_path / "landing", tmp_path / "out"
    land(landing, {"rate": FIXTURE["rate"]})
    run_pipeline(spark, str(landing), str(out), RUN)
    landing2 = tmp_path / "landing2"
    land(landing2, {"rate": ("selic", [("2024-03-04", 0.5)])})
    merge = CS.merge
    def die(*_):
        raise OSError("driver lost")
    try:
        CS.merge = die
        res = run_pipeline(spark, str(landing2), str(out), RUN + dt.timedelta(days=1))
    finally:
        CS.merge = merge
    assert log(res["run"])[("bronze.rate", None)].status == "error"
    # silver of the same run is built from bronze again, and so are later ones
    silver = PL.read_silver(spark, str(out), "rate")
    assert silver.filter("data = DATE '2024-03-04'").first().valor == 0.5


def test_a_failing_series_keeps_its_old_silver(spark, tmp_path, monkeypatch):
    landing, out = tmp_path / "landing", tmp_path / "out"
    land(landing)
    land(landing, {"fx": ("euro", [("2024-03-04", 5.5)])})
    run_pipeline(spark, str(landing), str(out), RUN)
    landing2 = tmp_path / "landing2"
    land(landing2, {"fx": ("euro", [("2024-03-05", 6.6)])})
    land(landing2, {"fx": ("dollar", [("2024-03-05", 7.7)])})
    build = PL.S.SILVER_BUILDERS["fx"]
    def fragile(bronze, **kw):
        value = F.when(F.col("serie") == "euro", F.raise_error(F.lit("no euro today")).cast("double"))
        return build(bronze.withColumn("valor", value.otherwise(F.col("valor"))), **kw)
    monkeypatch.setitem(PL.S.SILVER_BUILDERS, "fx", fragile)
    res = run_pipeline(spark, str(landing2), str(out), RUN + dt.timedelta(days=1))
    silver = PL.read_silver(spark, str(out), "fx")
    assert [r.valor for r in silver.filter("serie = 'euro'").collect()] == [5.5]
    assert silver.filter("serie = 'dollar' AND valor = 7.7").count() == 1
    records = [r for r in res["run"].collect() if r.table_name == "silver.fx"]
    assert sorted((r.metadata.get("serie"), r.status) for r in records if r.metadata.get("serie")) == [("euro", "error")]
    assert [r.status for r in records if not r.metadata.get("serie")] == ["success"]
    assert {r.serie: r.status for r in res["status"].collect()}["euro"] == "error"


def test_a_series_outside_the_window_has_a_record(spark, tmp_path):
    landing, out = tmp_path / "landing", tmp_path / "out"
    land(landing)
    land(landing, {"rate": ("antiga", [("2010-01-04", 9.0), ("2010-01-05", 9.0)])})
    res = run_pipeline(spark, str(landing), str(out), RUN, days=365)
    record = log(res["run"])[("bronze.rate", "antiga")]
    assert (record.row_count, record.status, record.metadata["quarantined"]) == (0, "no_data", "0")
    status = {r.serie: r.status for r in res["status"].collect()}
    assert status["antiga"] == "no_data" and status["selic"] == "ok"
    assert PL.read_bronze(spark, str(out)).filter("serie = 'antiga'").count() == 0


def test_a_bad_row_is_quarantined_once(spark, tmp_path):
    landing, out = tmp_path / "landing", tmp_path / "out"
    land(landing)
    bad = landing / "rate" / "selic" / "b2.json"
    bad.write_text(json.dumps([{"data": "31/02/2024", "valor": "1"}] * 2))
    ingest = lambda day: PL.ingest_kind(spark, str(landing), str(out), "rate", RUN + dt.timedelta(days=day))
    for day in range(3):
        ingest(day)
    assert PL.read_quarantine(spark, str(out)).count() == 2
    bad.write_text(json.dumps([{"data": "31/02/2024", "valor": "1"}, {"data": "32/02/2024", "valor": "1"}]))
    ingest(3)
    assert PL.read_quarantine(spark, str(out)).count() == 3


def test_cli_gold_asks_the_gate(spark, tmp_path, capsys, monkeypatch):
    from indicata import cli
    landing, out = tmp_path / "landing", tmp_path / "out"
    land(landing)
    before = run_pipeline(spark, str(landing), str(out), RUN)["gold"].collect()
    assert cli.main(["gold", "--out", str(out)]) == 0
    assert "gold: 2 rows" in capsys.readouterr().out
    gate = PL.gold_gate
    monkeypatch.setattr(PL, "gold_gate", lambda gold: gate(gold.unionByName(gold)))
    assert cli.main(["gold", "--out", str(out)]) == 1
    assert "gold refused" in capsys.readouterr().out
    assert sorted(store.read_table(spark, str(out / "gold")).collect()) == sorted(before)


def test_identical_rerun_leaves_silver_and_gold_unchanged(spark, tmp_path):
    landing, out = tmp_path / "landing", tmp_path / "out"
    land(landing)
    first = run_pipeline(spark, str(landing), str(out), RUN)["gold"].collect()
    fx1 = PL.read_silver(spark, str(out), "fx").collect()
    second = run_pipeline(spark, str(landing), str(out), RUN + dt.timedelta(days=1))["gold"].collect()
    assert sorted(first) == sorted(second)
    assert sorted(fx1) == sorted(PL.read_silver(spark, str(out), "fx").collect())
    assert store.read_table(spark, str(out / "bronze"), BRONZE).count() == 2 * 12  # both batches kept


def test_cli_steps_and_lookback_days(spark, tmp_path, capsys):
    from indicata import cli
    landing, out = tmp_path / "landing", tmp_path / "out"
    land(landing)
    base = ["ingest", "--landing", str(landing), "--out", str(out)]
    assert cli.main([*base, "--kind", "rate", "--days", "36500"]) == 0
    assert cli.main([*base, "--kind", "fx"]) == 0  # the default window holds nothing so old
    printed = capsys.readouterr().out
    assert "bronze.rate.selic: 3 rows" in printed and "bronze.fx.dollar: 0 rows" in printed
    assert cli.main([*base, "--serie", "nowhere"]) == 1
    assert cli.main([*base, "--serie", "dollar", "--days", "0"]) == 0
    assert "bronze.fx.dollar: 3 rows" in capsys.readouterr().out
    assert cli.main(["silver", "--out", str(out), "--kind", "rate"]) == 0
    assert "silver.rate: 3 rows" in capsys.readouterr().out


def test_catalog_roles_and_codes(spark):
    from indicata.sources.catalog import series_catalog, series_for_role, with_catalog
    assert series_for_role("level") == ["pib"] and series_for_role("ratio") == ["inadimplencia"]
    df = spark.createDataFrame([("selic", 1), ("unknown", 2)], "serie string, n int")
    got = {r.serie: (r.code, r.kind) for r in with_catalog(df, series_catalog(spark)).collect()}
    assert got == {"selic": (11, "rate"), "unknown": (None, None)}


def test_cli_run_as_a_module(tmp_path):
    import subprocess
    import sys
    from pathlib import Path
    landing, out = tmp_path / "landing", tmp_path / "out"
    land(landing)
    repo = Path(__file__).resolve().parents[1]
    run = lambda *more: subprocess.run(
        [sys.executable, "-m", "indicata.cli", "run", "--landing", str(landing), "--out", str(out),
         "--days", "0", *more], cwd=repo, capture_output=True, text=True, timeout=600)
    (landing / "fx" / "dollar" / "b2.json").write_text("broken")
    assert run("--strict").returncode == 1
    (landing / "fx" / "dollar" / "b2.json").write_text("[]")
    done = run("--check-month", "2024-03-01")  # a clean run after a failed one
    assert done.returncode == 0, done.stdout[-500:] + done.stderr[-2000:]
    assert (out / "gold").is_dir() and (out / "control").is_dir()
