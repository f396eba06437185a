"""Bronze -> silver -> gold as one batch job over landed payload files.

``run_pipeline`` is the data work of the reference's orchestration: ingest
every landed series (one Spark job per kind, not per series), append bronze,
put what is no observation into quarantine, rebuild silver partitions per
kind, check and rebuild gold, and append one run record per series and
layer. It returns the per-series status table, the quality report and the run
log as DataFrames.

Landing layout: ``<landing>/<kind>/<serie>/<batch>.json`` where kind is
one of ``rate``, ``fx``, ``inflation``, ``plain``; the plain kind holds the
monthly level series (``pib``) and ratio series (``inadimplencia``).
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections.abc import Callable, Sequence
from functools import partial
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from indicata.functions.calendar import ntz_literal
from indicata.operators import gold as G
from indicata.operators import monthly as M
from indicata.operators import quality as Q
from indicata.plans import current as CS
from indicata.plans import silver as S
from indicata.schemas import BRONZE_SEQ as BRONZE
from indicata.schemas import QUARANTINE, SILVER_FX, SILVER_INFLATION, SILVER_PLAIN, SILVER_RATE
from indicata.session import scratch_path
from indicata.sources import payload as P
from indicata.sources import published, store
from indicata.sources.catalog import series_for_role

KINDS = ("rate", "fx", "inflation", "plain")
SILVER_SCHEMAS = {"rate": SILVER_RATE, "fx": SILVER_FX, "inflation": SILVER_INFLATION,
                  "plain": SILVER_PLAIN}
GOLD_REQUIRED = ("selic_media_mes", "ipca_acumulado_mes", "dollar_medio_mes", "pib_valor_mes",
                 "inadimplencia_media_mes", "juros_real_estimado")
SOURCE = "landing"
RECORD = ("table_name string, process_name string, source string, layer string, row_count long, "
          "started_at timestamp_ntz, finished_at timestamp_ntz, status string, metadata map<string,string>")


class SilverResult(NamedTuple):
    """Rows written, the error of the kind, its time, and errors by series."""

    rows: int | None
    error: str | None
    span: tuple
    apart: dict[str, str]


class GoldResult(NamedTuple):
    """Rows published, the results of the gate, what went wrong."""

    rows: int
    quality: DataFrame | None
    error: str | None


class NothingToPublish(Exception):
    """Gold has no rows."""


def _p(base: str, *parts: str) -> str:
    return base.rstrip("/") + "/" + "/".join(parts) if "://" in base else os.path.join(base, *parts)


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def ingest_kind(spark: SparkSession, landing: str, out: str, kind: str, run_ts: dt.datetime,
                strict: bool = False, days: int | None = None,
                series: Sequence[str] | None = None) -> DataFrame:
    """Parse one kind, append bronze and quarantine, merge the current state;
    per series ``(serie, linhas, quarentena, status, erro)``.

    The landed files are read and parsed once, into a staged table. A row that
    is no observation goes to ``<out>/quarantine`` with its texts, file and
    reason, once, however often its file is read. ``strict`` stops a series
    that has such rows: none of its rows of this run reach bronze and its
    status is ``error``; other series go on. ``days`` keeps observations of the
    last ``days`` days before the run date; a series whose files hold nothing
    in that window is reported as ``no_data``, like one that landed ``[]``.
    """
    parsed = P.parse_observations(P.read_landed(spark, _p(landing, kind)), strict=False)
    if series is not None:
        parsed = parsed.filter(F.col("serie").isin(*series))
    if days is not None:
        first = (run_ts - dt.timedelta(days=days)).date()
        inside = F.col("data").between(F.lit(first), F.lit(run_ts.date()))
        # A file's first row stays as a sign that its series landed something.
        kept = F.col("motivo").isNotNull() | inside
        parsed = parsed.filter(kept | P.first_of_file("_seq")).withColumn(
            "motivo", F.when(kept, F.col("motivo")).otherwise(P.EMPTY))
    staged_path = scratch_path(spark, f"landed-{kind}")
    parsed.write.parquet(staged_path)
    staged = spark.read.schema(parsed.schema).parquet(staged_path)

    counts = staged.groupBy("serie").agg(
        F.count_if(F.col("motivo").isNull()).alias("linhas"),
        F.count_if(F.col("motivo") != P.EMPTY).alias("quarentena"),
        F.min(F.when(F.col("motivo") != P.EMPTY, F.concat_ws(": ", "motivo", "arquivo", "data_texto")))
        .alias("exemplo"))
    failed = (F.col("quarentena") > 0) & F.lit(strict)
    report = counts.select(
        "serie", F.when(failed, F.lit(0)).otherwise(F.col("linhas")).cast("long").alias("linhas"),
        "quarentena",
        F.when(failed, "error").when(F.col("linhas") > 0, "success").otherwise("no_data").alias("status"),
        F.when(failed, F.col("exemplo")).alias("erro"))

    good, bad = P.split_quarantine(staged)
    if strict:
        stopped = report.filter("status = 'error'").select("serie")
        good = good.join(stopped, "serie", "left_anti")
    bronze = store.add_audit_columns(good, run_ts, SOURCE, kind)
    state = _p(out, "current", kind)
    known = CS.is_current(spark, state) or not store.exists(spark, _p(out, "bronze", f"kind={kind}"))
    CS.begin(spark, state)
    store.append_bronze(bronze, _p(out, "bronze"), BRONZE)
    if known:
        CS.merge(bronze, state)
    else:
        CS.rebuild(read_bronze(spark, out).filter(F.col("kind") == kind), state)
    CS.finish(spark, state)
    rejected = store.conform(bad.withColumns({"kind": F.lit(kind), "_ingested_at": ntz_literal(run_ts)}), QUARANTINE)
    place = ("serie", "arquivo", "_seq", "motivo", "data_texto", "valor_texto")
    seen = read_quarantine(spark, out).filter(F.col("kind") == kind).select(
        *[F.col(c).alias(f"_{c}") for c in place])
    again = F.lit(True)
    for c in place:
        again = again & F.col(c).eqNullSafe(F.col(f"_{c}"))
    rejected.join(seen, again, "left_anti").write.mode("append").partitionBy("kind") \
        .parquet(_p(out, "quarantine"))
    return report


def _isolated(fn, *args, **kwargs):
    """Run one kind's step; a failure becomes a status instead of aborting the run."""
    try:
        return fn(*args, **kwargs), None
    except Exception as exc:  # noqa: BLE001 - reported in the run log
        return None, f"{type(exc).__name__}: {exc}"


def read_bronze(spark: SparkSession, out: str) -> DataFrame:
    """The bronze table, empty before its first row was written."""
    path = _p(out, "bronze")
    return store.read_table(spark, path, BRONZE) if store.exists(spark, path) \
        else spark.createDataFrame([], BRONZE)


def read_quarantine(spark: SparkSession, out: str) -> DataFrame:
    path = _p(out, "quarantine")
    return store.read_table(spark, path, QUARANTINE) if store.exists(spark, path) \
        else spark.createDataFrame([], QUARANTINE)


def failing_series(rows: DataFrame, build: Callable[[DataFrame], DataFrame], most: int = 16) -> list[str]:
    """Series on whose rows alone ``build`` raises.

    Halves of the series, by a hash of their names, are tried until those that
    fail hold one series each: about log2(series) trials for each failing one.
    More than ``most`` failing parts are no fault of single series: it raises.
    """
    def part(depth: int, n: int) -> DataFrame:
        return rows.filter(F.pmod(F.xxhash64("serie"), F.lit(1 << depth)) == n)

    found, todo = [], [(0, 0)]
    while todo:
        depth, n = todo.pop()
        some = part(depth, n)
        error = _isolated(lambda df: build(df).write.format("noop").mode("overwrite").save(), some)[1]
        if error is None:
            continue
        names = [r.serie for r in some.select("serie").distinct().limit(2).collect()]
        if len(names) < 2:
            found += names
        else:
            todo += [(depth + 1, n), (depth + 1, n + (1 << depth))]
        if len(found) + len(todo) > most:
            raise RuntimeError(f"too many series fail: {error}")
    return sorted(found)


def build_silver(spark: SparkSession, out: str, kinds=KINDS,
                 rebuild: bool = False) -> dict[str, SilverResult]:
    """Build silver for each kind from the newest version of its observations.

    The current state is read, not bronze; it is rebuilt from bronze with
    ``rebuild``, where it does not exist yet and where a run died before its
    merge. The result replaces the table in one step: a month that has no rows
    any more is gone, and a step that fails leaves the old table. A series
    whose rows make the step fail keeps its old rows while the others go on.
    """
    def one(kind):
        state, path = _p(out, "current", kind), _p(out, "silver", kind)
        bronze = _p(out, "bronze", f"kind={kind}")
        if store.exists(spark, bronze) and (rebuild or not CS.is_current(spark, state)):
            CS.rebuild(read_bronze(spark, out).filter(F.col("kind") == kind), state)
            CS.finish(spark, state)
        rows = CS.read(spark, state) if CS.is_current(spark, state) else spark.createDataFrame([], BRONZE)
        schema, by = SILVER_SCHEMAS[kind], () if kind == "plain" else ("ano", "mes")
        build = partial(S.SILVER_BUILDERS[kind], dedup=False)

        def write(silver):
            obs = Observation(f"silver_{kind}")
            store.overwrite_all(silver.observe(obs, F.count(F.lit(1)).alias("rows")), path, schema, by)
            return int(obs.get["rows"])

        done, error = _isolated(lambda: write(build(rows)))
        if error is None:
            return done, {}
        apart = failing_series(rows, build)
        if not apart:
            raise RuntimeError(error)
        inside = F.col("serie").isin(*apart)
        old = read_silver(spark, out, kind).filter(inside)
        return write(store.conform(build(rows.filter(~inside)), schema).unionByName(old)), dict.fromkeys(apart, error)

    done = {}
    for kind in kinds:
        start = _now()
        result, err = _isolated(one, kind)
        rows, apart = result or (None, {})
        published.vacuum(spark, _p(out, "silver", kind))
        done[kind] = SilverResult(rows, err, (start, _now()), apart)
    return done


def read_silver(spark: SparkSession, out: str, kind: str) -> DataFrame:
    path = _p(out, "silver", kind)
    return store.read_table(spark, path, SILVER_SCHEMAS[kind]) if store.has_table(spark, path) \
        else spark.createDataFrame([], SILVER_SCHEMAS[kind])


def publish_gold(spark: SparkSession, out: str) -> GoldResult:
    """Builds gold and replaces the published table if it passes ``gold_gate``.

    A refused or failed gold is reported in ``error`` and the old table stays;
    a gold without rows replaces nothing.
    """
    path, quality, rows = _p(out, "gold"), None, 0

    def gate(gold: DataFrame) -> None:
        nonlocal quality, rows
        checks = gold_gate(gold)
        told = checks.orderBy("checagem").collect()  # a row per check
        quality, rows = spark.createDataFrame(told, checks.schema), gold.count()
        refused = [f"{r.checagem} = {r.valor}" for r in told if not r.aprovado]
        if refused:
            raise ValueError("gold refused: " + "; ".join(refused))
        if not rows:
            raise NothingToPublish

    try:
        store.overwrite_all(build_gold(spark, out), path, check=gate)
    except NothingToPublish:
        return GoldResult(0, quality, None)
    except Exception as exc:  # noqa: BLE001 - reported
        return GoldResult(0, quality, f"{type(exc).__name__}: {exc}")
    published.vacuum(spark, path)
    return GoldResult(rows, quality, None)


def build_gold(spark: SparkSession, out: str) -> DataFrame:
    """The wide table of the catalog's five series; each part reads only the
    series that play its role, so other series of a kind never mix in."""
    def role(kind, name):
        return read_silver(spark, out, kind).filter(F.col("serie").isin(*series_for_role(name)))
    return G.gold_wide(
        M.monthly_rate(role("rate", "rate")), M.monthly_inflation(role("inflation", "inflation")),
        M.monthly_fx(role("fx", "fx")), M.monthly_level(role("plain", "level")),
        M.monthly_ratio(role("plain", "ratio")))


def gold_gate(gold: DataFrame) -> DataFrame:
    """Checks that gold must pass before it replaces the published table."""
    nulls = Q.not_null(gold, ("mes_ref", "selic_media_mes", "selic_anualizada_mes")) \
        .select(F.concat_ws(" ", F.lit("nulos"), "coluna").alias("checagem"),
                F.col("nulos").cast("long").alias("valor"), "aprovado")
    once = Q.unique(gold, ("mes_ref",), "gold") \
        .select(F.lit("mes_ref repetido").alias("checagem"),
                F.col("duplicadas").cast("long").alias("valor"), "aprovado")
    return nulls.unionByName(once)


def series_status(bronze: DataFrame, silver_by_kind: dict[str, DataFrame],
                  landed: DataFrame | None = None) -> DataFrame:
    """Per (kind, serie): bronze rows, bronze NULL values, silver rows and a
    status: ``error`` (marked in ``landed (kind, serie, falhou)``), ``ok``,
    ``orphan`` (silver rows without bronze rows) or ``no_data``. A series that
    is in ``landed`` only is listed too.

    Built as one union of per-layer counts folded with conditional sums, not
    a join: a join would add an inferred NOT NULL filter to one side, making
    the two scans of the same bronze different, so Spark could not reuse
    one shuffle for both. Join ``indicata.sources.catalog.with_catalog`` to
    add source codes.
    """
    zero = F.lit(0)
    parts = [bronze.select("kind", "serie", F.lit(1).alias("_b"),
                           F.col("valor").isNull().cast("int").alias("_bn"), zero.alias("_s"),
                           zero.alias("_f"))]
    for kind, silver in silver_by_kind.items():
        parts.append(silver.select(F.lit(kind).alias("kind"), "serie", zero.alias("_b"),
                                   zero.alias("_bn"), F.lit(1).alias("_s"), zero.alias("_f")))
    if landed is not None:
        parts.append(landed.select("kind", "serie", zero.alias("_b"), zero.alias("_bn"),
                                   zero.alias("_s"), F.col("falhou").alias("_f")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    out = u.groupBy("kind", "serie").agg(
        F.sum("_b").cast("long").alias("bronze_linhas"),
        F.sum("_bn").cast("long").alias("bronze_nulos"),
        F.sum("_s").cast("long").alias("silver_linhas"), F.max("_f").alias("_f"))
    b, s = F.col("bronze_linhas") > 0, F.col("silver_linhas") > 0
    return out.withColumn("status", F.when(F.col("_f") > 0, "error").when(b & s, "ok")
                          .when(s, "orphan").otherwise("no_data")).drop("_f")


def run_pipeline(spark: SparkSession, landing: str, out: str, run_ts: dt.datetime,
                 check_month: str | None = None, strict: bool = False, rebuild: bool = False,
                 days: int | None = None, series: Sequence[str] | None = None) -> dict:
    """Full run; returns ``status``, ``quality``, ``report``, ``gold``,
    ``control`` (all runs), ``run`` (this run's records), ``run_id``.

    Series are reported on their own, with the time their step took: a bad
    row in strict mode and rows that make silver fail stop their series only.
    Gold is rebuilt from every series that plays a role and replaces the
    published table only when it passes ``gold_gate``; a refused or failed
    gold is an ``error`` record and the old table stays.
    """
    if not store.exists(spark, landing):
        raise FileNotFoundError(f"landing path does not exist: {landing}")
    run_id = uuid.uuid4().hex
    logs = []

    def note(table, process, source, layer, rows, span, status, **meta):
        meta = {"run_id": run_id} | {k: v for k, v in meta.items() if v is not None}
        logs.append(spark.createDataFrame(
            [(table, process, source, layer, rows, *span, status, meta)], RECORD))

    landed = spark.createDataFrame([], "kind string, serie string, falhou int")
    for kind in KINDS:
        start = _now()
        if not store.exists(spark, _p(landing, kind)):
            note(f"bronze.{kind}", "ingest", SOURCE, "bronze", 0, (start, start), "no_data")
            continue
        report, err = _isolated(ingest_kind, spark, landing, out, kind, run_ts, strict, days, series)
        span = (start, _now())
        if err is not None:
            note(f"bronze.{kind}", "ingest", SOURCE, "bronze", 0, span, "error", error=err)
            continue
        landed = landed.unionByName(report.select(
            F.lit(kind).alias("kind"), "serie", (F.col("status") == "error").cast("int").alias("falhou")))
        logs.append(report.select(
            F.lit(f"bronze.{kind}").alias("table_name"), F.lit("ingest").alias("process_name"),
            F.lit(SOURCE).alias("source"), F.lit("bronze").alias("layer"),
            F.col("linhas").alias("row_count"), ntz_literal(span[0]).alias("started_at"),
            ntz_literal(span[1]).alias("finished_at"), "status",
            F.map_filter(F.create_map(
                F.lit("run_id"), F.lit(run_id), F.lit("serie"), F.col("serie"),
                F.lit("quarantined"), F.col("quarentena").cast("string"),
                F.lit("error"), F.col("erro")), lambda _, v: v.isNotNull()).alias("metadata")))

    silver = build_silver(spark, out, rebuild=rebuild)
    for kind, (rows, err, span, apart) in silver.items():
        note(f"silver.{kind}", "silver", "bronze", "silver", rows or 0, span,
             "error" if err else "success" if rows else "no_data", error=err)
        for serie, why in apart.items():
            note(f"silver.{kind}", "silver", "bronze", "silver", 0, span, "error", serie=serie, error=why)
        if apart:
            landed = landed.unionByName(spark.createDataFrame([(kind, s, 1) for s in apart], landed.schema))

    start, gold_path = _now(), _p(out, "gold")
    rows, quality, err = publish_gold(spark, out)
    note("gold", "gold", "silver", "gold", rows, (start, _now()),
         "error" if err else "success" if rows else "no_data", error=err)

    records = logs[0]
    for log in logs[1:]:
        records = records.unionByName(log)
    store.append_control(store.control_records(records), _p(out, "control"), run_id)
    control = store.read_control(spark, _p(out, "control"))
    gold = store.read_table(spark, gold_path) if store.has_table(spark, gold_path) else None
    return {
        "run_id": run_id, "control": control,
        "run": control.filter(F.col("metadata")["run_id"] == run_id),
        "status": series_status(read_bronze(spark, out),
                                {k: read_silver(spark, out, k) for k in KINDS}, landed),
        "gold": gold, "quality": quality,
        "report": Q.gold_report(gold, check_month, GOLD_REQUIRED)
        if gold is not None and check_month else None,
    }
