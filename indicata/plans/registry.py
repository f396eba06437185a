"""Registered queries: ``name -> f(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables (through the analogs in
``indicata.sources.testdata``) and runs over them whole. Each has an
equivalent SQL text in ``indicata.plans.oracle`` unless noted.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicata.functions import calendar as C
from indicata.functions.formatting import format_reference
from indicata.functions.labels import (RATE_LEVEL_BANDS, fx_trend, inflation_pressure, rate_level,
                                       scaled_bands)
from indicata.functions.numeric import annualize, comparison_rounding, rounded
from indicata.operators import dashboard as D
from indicata.operators import gold as G
from indicata.operators import layout
from indicata.operators import metrics as MT
from indicata.operators import monthly as M
from indicata.operators import profiles as PR
from indicata.operators import quality as Q
from indicata.operators import windows as W
from indicata.operators.chunked import chunked_window, global_row_number, long_extremes, running
from indicata.operators.dedup import latest_per_key
from indicata.operators.sampling import bottom_k
from indicata.plans import current as CS
from indicata.plans import landed as LD
from indicata.plans import pipeline as PL
from indicata.plans import silver as S
from indicata.schemas import BRONZE, GOLD_COLUMNS, SILVER_INFLATION, SILVER_PLAIN, with_key_type
from indicata.session import scratch_path
from indicata.sources import payload as PAY
from indicata.sources import published, store, tables
from indicata.sources import testdata as td

Query = Callable[[SparkSession, str], DataFrame]

# The rate analog is a daily % near 0.025; its level thresholds are the
# reference's divided by the same scale, so all four labels occur.
RATE_BANDS = scaled_bands(RATE_LEVEL_BANDS, td.RATE_SCALE)


# ---------------------------------------------------------------- silver
def silver_rate(spark, sf, days=None):
    return S.silver_rate(td.rate_bronze(spark, sf, days), tie_break=(), bands=RATE_BANDS)


def silver_fx(spark, sf, days=None):
    return S.silver_fx(td.fx_bronze(spark, sf, days), tie_break=())


def silver_inflation(spark, sf, days=None):
    return S.silver_inflation(td.inflation_bronze(spark, sf, days), tie_break=())


def silver_level(spark, sf, months=None):
    return S.silver_plain(td.level_bronze(spark, sf, months), tie_break=())


def silver_ratio(spark, sf, months=None):
    return S.silver_plain(td.ratio_bronze(spark, sf, months), tie_break=())


def silver_plain_monthly(spark, sf):
    return S.silver_plain(td.plain_series(spark, sf), tie_break=())


# ---------------------------------------------------------------- monthly / gold
def monthly_rate(spark, sf):
    return M.monthly_rate(silver_rate(spark, sf))


def monthly_inflation(spark, sf):
    return M.monthly_inflation(silver_inflation(spark, sf))


def monthly_fx(spark, sf):
    return M.monthly_fx(silver_fx(spark, sf))


def monthly_level(spark, sf):
    return M.monthly_level(silver_level(spark, sf))


def monthly_ratio(spark, sf):
    return M.monthly_ratio(silver_ratio(spark, sf))


def _days(spark, sf):
    """The (supplier, day) sums as a written table, in buckets of suppliers:
    line items are read once, and de-duplication, roll-up and windows of the
    three silver tables find the rows of a supplier together, without a shuffle."""
    path = scratch_path(spark, "supplier-days")
    name = "supplier_days_" + path[-12:]
    n = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 10_000)  # Spark allows 100,000 buckets
    td.supplier_days(spark, sf).repartition(n, "serie").write.bucketBy(n, "serie").sortBy("serie", "data") \
        .option("path", path).saveAsTable(name)
    return spark.table(name)


def _gold(spark, sf, keys=()):
    days = _days(spark, sf)
    return G.gold_wide(
        M.monthly_rate(silver_rate(spark, sf, days), keys),
        M.monthly_inflation(silver_inflation(spark, sf, days), keys),
        M.monthly_fx(silver_fx(spark, sf, days), keys),
        M.monthly_plain(S.silver_plain(td.plain_series(spark, sf), tie_break=()),
                        {"level": "pib_valor_mes", "ratio": "inadimplencia_media_mes"}), keys=keys)


def gold_wide_monthly(spark, sf):
    return _gold(spark, sf)


def gold_by_series(spark, sf):
    return _gold(spark, sf, ("serie",))


def _published(spark, sf, gold=gold_wide_monthly):
    """Gold as a reader finds it: written once, then read."""
    path = scratch_path(spark, "gold-published")
    store.overwrite_all(gold(spark, sf), path)
    return store.read_table(spark, path)


def dedup_latest(spark, sf):
    return latest_per_key(td.event_bronze(spark, sf), ("serie", "data"), ("_ingested_at",), ("_seq",))


# ---------------------------------------------------------------- single operators
def _valid(kind: str, spark, sf):
    bronze = {"rate": td.rate_bronze, "fx": td.fx_bronze, "inflation": td.inflation_bronze}[kind]
    check = {"rate": S.valid_rate, "fx": S.valid_fx, "inflation": S.valid_inflation}[kind]
    return check(S.deduplicate(bronze(spark, sf))).select("serie", "data", "valor")


def _w():
    return W.series_window(("serie",))


def filter_valid_observations(spark, sf):
    return _valid("rate", spark, sf)


def change_abs(spark, sf):
    return _valid("fx", spark, sf).withColumn("variacao_abs", W.change("valor", _w()))


def change_pct(spark, sf):
    return _valid("fx", spark, sf).withColumn("variacao_pct", W.pct_change("valor", _w()))


def moving_avg_30(spark, sf):
    return _valid("rate", spark, sf).withColumn("media_movel_30d", W.moving_avg("valor", _w(), 30))


def volatility_30(spark, sf):
    return _valid("rate", spark, sf).withColumn("volatilidade_30d", W.moving_stddev("valor", _w(), 30))


def moving_extremes_30(spark, sf):
    return _valid("fx", spark, sf).withColumns({
        "max_30d": W.moving_max("valor", _w(), 30), "min_30d": W.moving_min("valor", _w(), 30)})


def rolling_sum_12(spark, sf):
    return _valid("inflation", spark, sf).withColumn("acumulado_12m", W.rolling_sum("valor", _w(), 12))


def ytd_sum(spark, sf):
    df = _valid("inflation", spark, sf).withColumn("ano", F.year("data"))
    return df.withColumn("acumulado_ano", W.ytd(F.sum, "valor", ("serie",)))


def ytd_avg(spark, sf):
    df = _valid("rate", spark, sf).withColumn("ano", F.year("data"))
    return df.withColumn("acumulado_ano", W.ytd(F.avg, "valor", ("serie",)))


def annualize_rate(spark, sf):
    return _valid("rate", spark, sf).withColumn("taxa_anualizada", annualize("valor"))


def classify_rate_level(spark, sf):
    return _valid("rate", spark, sf).withColumn("nivel_taxa", rate_level("valor", RATE_BANDS))


def classify_pressure(spark, sf):
    return _valid("inflation", spark, sf).withColumn("pressao", inflation_pressure("valor"))


def classify_trend(spark, sf):
    df = change_abs(spark, sf)
    return df.withColumn("tendencia", fx_trend("variacao_abs"))


def calendar_parts(spark, sf):
    o = td.table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("data"))
    return C.with_calendar_parts(o, weekday=True)


def real_rate_fisher(spark, sf):
    return _published(spark, sf, gold_by_series).select(
        "serie", "mes_ref", "selic_anualizada_mes", "ipca_12m", "juros_real_estimado")


LAST_INFLATION = "1999-01-01"


def gold_left_join_two(spark, sf):
    """Inflation ends before the rate does, so the last months stay unmatched."""
    days = _days(spark, sf)
    known = M.monthly_inflation(silver_inflation(spark, sf, days)).filter(
        F.col("mes_ref") < F.lit(LAST_INFLATION).cast("date"))
    return G.gold_left_join_two(M.monthly_rate(silver_rate(spark, sf, days)), known)


GOLD_LOOKUP_MONTH = "1996-01-01"


def gold_point_lookup(spark, sf):
    """Lookup on the computed table: Catalyst moves the month filter below the
    aggregates (not below the inflation window, which needs history)."""
    return G.point_lookup(gold_wide_monthly(spark, sf), GOLD_LOOKUP_MONTH)


def gold_table_lookup(spark, sf):
    """Lookup on the materialized table: the month reaches the Parquet reader."""
    return G.point_lookup(_published(spark, sf), GOLD_LOOKUP_MONTH)


# ---------------------------------------------------------------- metrics
METRICS = GOLD_COLUMNS[1:]


def _gold_long(spark, sf, by_series: bool = True):
    if by_series:
        return MT.to_long(_published(spark, sf, gold_by_series), ("serie",), METRICS), ("serie",)
    return MT.to_long(_published(spark, sf), (), METRICS), ()


def metric_valid_rows(spark, sf):
    long, _ = _gold_long(spark, sf)
    return MT.valid_metric_rows(long)


def latest_metric(spark, sf):
    long, keys = _gold_long(spark, sf)
    out = MT.latest_metric(long, keys)
    return out.withColumn("referencia", format_reference("mes_ref"))


def latest_metric_change(spark, sf):
    long, keys = _gold_long(spark, sf)
    return MT.latest_metric_change(long, keys)


LAST_MONTHS = 12


def last_n_months(spark, sf):
    return MT.last_n(_published(spark, sf, gold_by_series), LAST_MONTHS, ("serie",))


NEWEST_ROWS = 20


def newest_n(spark, sf):
    o = td.table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return MT.newest_rows(o, NEWEST_ROWS, ("o_orderdate", "o_orderkey"))


UNION_SPLIT = "1998-01-01"


def union_batches(spark, sf):
    o = td.table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    split = F.lit(UNION_SPLIT).cast("timestamp_ntz")
    first = o.filter(F.col("o_orderdate") < split).withColumn("lote", F.lit(1))
    second = o.filter(F.col("o_orderdate") >= split).withColumn("lote", F.lit(2))
    return first.unionByName(second)


SAMPLE = 20


def sample_rows(spark, sf):
    """A sample of the orders, the same for any files and tasks."""
    o = td.table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return bottom_k(o, SAMPLE, ("o_orderkey",))


def sample_by_group(spark, sf):
    """The same of each order status; a status may hold nearly all rows."""
    o = td.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return bottom_k(o, SAMPLE, ("o_orderkey",), by=("o_orderstatus",))


def missing_by_column(spark, sf):
    return MT.missing_by_column(_published(spark, sf))


def latest_reference(spark, sf):
    return MT.latest_reference(_published(spark, sf))


def format_reference_query(spark, sf):
    long, keys = _gold_long(spark, sf, by_series=False)
    return MT.latest_metric(long, keys).select("metric", format_reference("mes_ref").alias("referencia"))


def format_metric_label(spark, sf):
    long, keys = _gold_long(spark, sf, by_series=False)
    return D.metric_cards(MT.latest_metric_change(long, keys))


def insight_sentences(spark, sf):
    long, keys = _gold_long(spark, sf, by_series=False)
    return D.insight_sentences(MT.latest_metric_change(long, keys))


# ---------------------------------------------------------------- profiles
def profile_rate(spark, sf):
    return PR.profile_rate(silver_rate(spark, sf), ("serie",))


def profile_inflation(spark, sf):
    return PR.profile_inflation(silver_inflation(spark, sf), ("serie",))


def profile_fx(spark, sf):
    return PR.profile_fx(silver_fx(spark, sf), ("serie",))


def profile_rate_global(spark, sf):
    """One-row profile over every series, as the original manual check."""
    return PR.profile_rate(silver_rate(spark, sf))


def profile_inflation_global(spark, sf):
    return PR.profile_inflation(silver_inflation(spark, sf))


def profile_fx_global(spark, sf):
    return PR.profile_fx(silver_fx(spark, sf))


def profile_bronze(spark, sf):
    return PR.profile_bronze(td.rate_bronze(spark, sf), ("serie",))


def label_distribution_rate(spark, sf):
    return PR.label_distribution(silver_rate(spark, sf), "nivel_taxa", mean_name="taxa_media")


def label_distribution_inflation(spark, sf):
    return PR.label_distribution(silver_inflation(spark, sf), "pressao", mean_name="ipca_medio")


def label_distribution_fx(spark, sf):
    return PR.label_distribution(silver_fx(spark, sf), "tendencia", mean_name="dolar_medio")


def distinct_years(spark, sf):
    o = td.table(spark, sf, "orders")
    return PR.distinct_values(o, F.year("o_orderdate").alias("ano"))


def row_counts_by_layer(spark, sf):
    """Rows of each written table, from the footers of its files."""
    def written(name, df):
        path = scratch_path(spark, name.replace(".", "-"))
        store.overwrite_all(df, path)
        return store.read_table(spark, path)

    days = _days(spark, sf)
    bronze = {"rate": td.rate_bronze(spark, sf, days), "fx": td.fx_bronze(spark, sf, days),
              "inflation": td.inflation_bronze(spark, sf, days)}
    bronze = {k: written(f"bronze.{k}", df) for k, df in bronze.items()}
    silver = {"rate": written("silver.rate", S.silver_rate(bronze["rate"], tie_break=(), bands=RATE_BANDS)),
              "fx": written("silver.fx", S.silver_fx(bronze["fx"], tie_break=())),
              "inflation": written("silver.inflation", S.silver_inflation(bronze["inflation"], tie_break=())),
              "plain": written("silver.plain", silver_plain_monthly(spark, sf))}
    gold = written("gold.wide", G.gold_wide(
        M.monthly_rate(silver["rate"]), M.monthly_inflation(silver["inflation"]), M.monthly_fx(silver["fx"]),
        M.monthly_plain(silver["plain"], {"level": "pib_valor_mes", "ratio": "inadimplencia_media_mes"})))
    tables = {f"bronze.{k}": ("bronze", df) for k, df in bronze.items()}
    tables |= {f"silver.{k}": ("silver", df) for k, df in silver.items()}
    return PR.row_counts(tables | {"gold.wide": ("gold", gold)})


# ---------------------------------------------------------------- ingestion and sinks
BAD_VALUE_EVERY = 50   # line items whose order key is a multiple: value text 'N/D'
BAD_DATE_EVERY = 97    # line items whose order key is a multiple: impossible date 31/02
LOOKBACK_DAYS = 365
_LONG_KEY = T.LongType()
BRONZE_T = with_key_type(BRONZE, _LONG_KEY)
SILVER_INFLATION_T = with_key_type(SILVER_INFLATION, _LONG_KEY)


def _payload_lines(spark, sf):
    li = td.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity")
    bad_value = (F.col("l_orderkey") % BAD_VALUE_EVERY) == 0
    value_text = F.when(bad_value, F.lit("N/D")).otherwise(F.col("l_quantity").cast("string"))
    return li, value_text


def ingest_json_payload(spark, sf):
    li, value_text = _payload_lines(spark, sf)
    item = F.struct(F.date_format("l_shipdate", PAY.DATE_PATTERN).alias("data"), value_text.alias("valor"))
    texts = li.select("l_orderkey", "l_linenumber", F.to_json(F.array(item)).alias("payload"))
    return PAY.parse_observations(PAY.explode_payload(texts), strict=True).drop("posicao")


def ingest_parse_coerce(spark, sf):
    li, value_text = _payload_lines(spark, sf)
    bad_date = (F.col("l_orderkey") % BAD_DATE_EVERY) == 0
    date_text = F.when(bad_date, F.concat(F.lit("31/02/"), F.year("l_shipdate").cast("string"))) \
                 .otherwise(F.date_format("l_shipdate", PAY.DATE_PATTERN))
    texts = li.select("l_orderkey", "l_linenumber", date_text.alias("data_texto"),
                      value_text.alias("valor_texto"))
    parsed = PAY.parse_observations(texts, strict=False)
    return parsed.select("l_orderkey", "l_linenumber", "data", "valor", F.col("motivo").isNull().alias("valido"))


def ingest_lookback_window(spark, sf):
    o = td.table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return PAY.lookback(o, "o_orderdate", LOOKBACK_DAYS)


def _rate_bronze_rows(spark, sf):
    return td.rate_bronze(spark, sf).withColumns({"kind": F.lit("rate"), "ano": F.year("data")})


def bronze_append_audit(spark, sf):
    """Two appends (first batch, then the revision batch), read back. The rows
    are staged once; each append stamps its own audit columns."""
    staged = scratch_path(spark, "bronze-batches")
    td.rate_bronze(spark, sf).withColumnRenamed("_ingested_at", "lote").drop("_source").write.parquet(staged)
    rows = spark.read.parquet(staged)
    path = scratch_path(spark, "bronze")
    for batch in (td.FIRST_BATCH, td.REVISION_BATCH):
        part = rows.filter(F.col("lote") == C.ntz_literal(batch)).drop("lote")
        store.append_bronze(store.add_audit_columns(part, batch, td.SOURCE, "rate"), path, BRONZE_T)
    return store.read_table(spark, path, BRONZE_T)


def schema_conform(spark, sf):
    """Columns in another order and ``ano`` as BIGINT, reconciled to the bronze contract."""
    rows = _rate_bronze_rows(spark, sf)
    drifted = rows.select("ano", "valor", "_source", "data", "serie", "_ingested_at", "kind") \
                  .withColumn("ano", F.col("ano").cast("bigint"))
    return store.conform(drifted, BRONZE_T)


REWRITE_YEAR = 1996


def silver_partition_overwrite(spark, sf):
    """Write silver inflation, then replace the partitions of one year by rows
    that come from the table itself."""
    path = scratch_path(spark, "silver-inflation")
    by = ("ano", "mes")
    store.overwrite_all(silver_inflation(spark, sf), path, SILVER_INFLATION_T, by)
    year = [p for p in published.partitions(spark, path) if p.startswith(f"ano={REWRITE_YEAR}/")]
    revised = store.read_table(spark, path, SILVER_INFLATION_T, only=year) \
        .withColumn("valor", rounded(F.col("valor") * F.lit(2.0), 4))
    store.replace_partitions(revised, path, SILVER_INFLATION_T, year, by)
    return store.read_table(spark, path, SILVER_INFLATION_T)


VANISHING_MONTH = 7


def silver_vanished_partitions(spark, sf):
    """Silver inflation of one year written anew without one month: that
    month's partition is gone, the other years' files are left as they are."""
    path, by = scratch_path(spark, "silver-inflation"), ("ano", "mes")
    store.overwrite_all(silver_inflation(spark, sf), path, SILVER_INFLATION_T, by)
    year = [p for p in published.partitions(spark, path) if p.startswith(f"ano={REWRITE_YEAR}/")]
    rest = store.read_table(spark, path, SILVER_INFLATION_T, only=year).filter(F.col("mes") != VANISHING_MONTH)
    store.replace_partitions(rest, path, SILVER_INFLATION_T, year, by)
    return store.read_table(spark, path, SILVER_INFLATION_T)


def incremental_current_state(spark, sf):
    """The first batch and then its revisions, each appended and merged into
    the years it touches; equal to de-duplicating everything."""
    rows = td.rate_bronze(spark, sf).withColumns({
        "serie": F.col("serie").cast("string"), "kind": F.lit("rate"), "ano": F.year("data"), "_seq": F.lit("0")})
    staged, path = scratch_path(spark, "bronze-batches"), scratch_path(spark, "current")
    rows.write.parquet(staged)
    rows = spark.read.schema(rows.schema).parquet(staged)
    for batch in (td.FIRST_BATCH, td.REVISION_BATCH):
        CS.merge(rows.filter(F.col("_ingested_at") == C.ntz_literal(batch)), path)
    return CS.read(spark, path).select(F.col("serie").cast("long").alias("serie"), "data", "valor", "_ingested_at")


def bronze_table_by_name(spark, sf):
    """A table created if absent, appended twice (the second batch with its
    columns in another order) and read by its name."""
    path = scratch_path(spark, "bronze-named")
    name = "bronze_" + path[-12:]
    rows = _rate_bronze_rows(spark, sf)
    for batch in (td.FIRST_BATCH, td.REVISION_BATCH):
        tables.ensure_table(spark, name, BRONZE_T, ("kind", "ano"), {"camada": "bronze"}, location=path)
        part = rows.filter(F.col("_ingested_at") == C.ntz_literal(batch))
        tables.append_table(part.select(*reversed(part.columns)), name, BRONZE_T, ("kind", "ano"))
    return tables.read_by_name(spark, name)


def _silver_written(spark, sf):
    """Silver rate as a written table: dealing rows out by ranges reads its
    input twice, once to find the ranges, and would compute all of silver twice."""
    path = scratch_path(spark, "silver-rate")
    store.overwrite_all(silver_rate(spark, sf), path)
    return store.read_table(spark, path)


RANGE_OF_SERIES = (3, 5)


def silver_rate_range(spark, sf):
    """Silver rate written in the order of series and day; one range of series
    is read, from the files that hold it."""
    path = scratch_path(spark, "silver-rate-sorted")
    layout.write_sorted(_silver_written(spark, sf), path, ("serie", "data"))
    return layout.read_range(spark, path, "serie", *RANGE_OF_SERIES).select("serie", "data", "valor", "media_movel_30d")


def silver_full_overwrite(spark, sf):
    """Two full overwrites of the plain monthly table; the second one wins."""
    path = scratch_path(spark, "silver-plain")
    store.overwrite_all(silver_level(spark, sf), path, SILVER_PLAIN)
    store.overwrite_all(silver_plain_monthly(spark, sf), path, SILVER_PLAIN)
    return store.read_table(spark, path, SILVER_PLAIN)


def gold_materialize(spark, sf):
    return _published(spark, sf)


def control_log_summary(spark, sf):
    """One run record per (event type, day) of the events table; a run for each
    event type, the first one logged twice, and the log compacted on the way."""
    ev = td.table(spark, sf, "events")
    runs = (ev.groupBy(F.col("event_type").alias("table_name"), F.to_date("ts").alias("dia"))
              .agg(F.count(F.lit(1)).alias("row_count"), F.min("ts").alias("started_at"),
                   F.max("ts").alias("finished_at"))
              .withColumns({
                  "process_name": F.lit("ingest"), "source": F.lit("events"), "layer": F.lit("bronze"),
                  "status": F.when(F.col("row_count") > 0, "success").otherwise("no_data"),
                  "metadata": F.create_map(F.lit("dia"), F.date_format("dia", "yyyy-MM-dd")),
              }))
    path, staged = scratch_path(spark, "control"), scratch_path(spark, "control-records")
    records = store.control_records(runs)
    records.write.parquet(staged)
    records = spark.read.schema(records.schema).parquet(staged)
    first = F.col("table_name") == records.agg(F.min("table_name")).first()[0]
    store.append_control(records.filter(first), path, "run-1")
    store.append_control(records.filter(~first), path, "run-2", compact_at=2)
    store.append_control(records.filter(first), path, "run-1")
    log = store.read_control(spark, path)
    return log.withColumn("dia", F.col("metadata")["dia"]).drop("metadata")


# ---------------------------------------------------------------- quality and pipeline
QUALITY_MONTH = "1996-01-01"


def quality_not_null(spark, sf):
    """On gold, and on raw bronze, whose values have NULLs, so that it can fail."""
    return Q.not_null(_rate_bronze_rows(spark, sf), ("serie", "data", "valor")).unionByName(
        Q.not_null(gold_wide_monthly(spark, sf), ("mes_ref", "selic_media_mes", "selic_anualizada_mes")))


def quality_unique(spark, sf):
    """Raw bronze repeats (serie, data) for every revised day; with the
    ingestion time the key is unique; de-duplicated silver and gold are."""
    days = _days(spark, sf)
    raw = td.rate_bronze(spark, sf, days)
    silver = {"rate": silver_rate(spark, sf, days), "fx": silver_fx(spark, sf, days),
              "inflation": silver_inflation(spark, sf, days)}
    gold = G.gold_wide(
        M.monthly_rate(silver["rate"]), M.monthly_inflation(silver["inflation"]), M.monthly_fx(silver["fx"]),
        M.monthly_plain(silver_plain_monthly(spark, sf), {"level": "pib_valor_mes", "ratio": "inadimplencia_media_mes"}))
    out = Q.unique(raw, ("serie", "data"), "bronze.rate") \
        .unionByName(Q.unique(raw, ("serie", "data", "_ingested_at"), "bronze.rate")) \
        .unionByName(Q.unique(gold, ("mes_ref",), "gold.wide"))
    for kind, df in silver.items():
        out = out.unionByName(Q.unique(df, ("serie", "data"), f"silver.{kind}"))
    return out


def _written(df, write):
    """Write ``df`` and return how many rows went in, counted by the write."""
    obs = Observation()
    write(df.observe(obs, F.count(F.lit(1)).alias("linhas")))
    return int(obs.get["linhas"])


def quality_reconcile_counts(spark, sf):
    """Rows written against rows read back; a first part only of one table."""
    bronze_path, silver_path = scratch_path(spark, "bronze-reconcile"), scratch_path(spark, "silver-reconcile")
    rows = _written(_rate_bronze_rows(spark, sf), lambda df: store.append_bronze(df, bronze_path, BRONZE_T))
    bronze = store.read_table(spark, bronze_path, BRONZE_T)
    first = bronze.filter(F.col("_ingested_at") == C.ntz_literal(td.FIRST_BATCH))
    put = _written(silver_inflation(spark, sf), lambda df: store.overwrite_all(
        df, silver_path, SILVER_INFLATION_T, ("ano", "mes")))
    return Q.reconcile({"bronze.rate": (rows, bronze), "bronze.rate.first": (rows, first),
                        "silver.inflation": (put, store.read_table(spark, silver_path, SILVER_INFLATION_T))})


def quality_reconcile_at_least(spark, sf):
    """The rule for tables that only grow: no fewer rows than expected."""
    bronze = td.rate_bronze(spark, sf)
    silver = silver_rate(spark, sf)
    return Q.reconcile({"bronze covers silver": (silver, bronze), "silver covers bronze": (bronze, silver)},
                       at_least=True)


def quality_report(spark, sf):
    return Q.gold_report(_published(spark, sf), QUALITY_MONTH, PL.GOLD_REQUIRED)


def pipeline_run_status(spark, sf):
    kinds = {"rate": (td.rate_bronze, silver_rate), "fx": (td.fx_bronze, silver_fx),
             "inflation": (td.inflation_bronze, silver_inflation)}
    bronze = None
    silver = {}
    for kind, (b, s) in kinds.items():
        part = b(spark, sf).withColumn("kind", F.lit(kind))
        bronze = part if bronze is None else bronze.unionByName(part)
        silver[kind] = s(spark, sf)
    return PL.series_status(bronze, silver)


CHUNK_ROWS = 2048
HALO = 29


def chunked_window_single_series(spark, sf):
    """The events table as one series ordered by (ts, event_id), 30-row frames."""
    ev = td.table(spark, sf, "events").select("event_id", "ts", "value")

    def compute(w):
        v = F.col("value")
        return {"variacao": W.change(v, w), "media_movel_30d": W.moving_avg(v, w, 30),
                "max_30d": W.moving_max(v, w, 30), "min_30d": W.moving_min(v, w, 30),
                "volatilidade_30d": W.moving_stddev(v, w, 30)}

    return chunked_window(ev, ("ts", "event_id"), compute, halo=HALO, chunk_rows=CHUNK_ROWS)


def chunked_window_by_series(spark, sf):
    """Every user of the events is a series; some rows have no user."""
    ev = td.table(spark, sf, "events").select(
        F.when(F.col("event_id") % 10 != 0, F.col("user_id")).alias("serie"), "event_id", "ts", "value")

    def compute(w):
        return {"variacao": W.change("value", w), "soma_12": W.rolling_sum("value", w, 12)}

    return chunked_window(ev, ("ts", "event_id"), compute, halo=11, chunk_rows=64, keys=("serie",))


def running_single_series(spark, sf):
    """Running sum, average, count and extremes over the events as one series."""
    ev = td.table(spark, sf, "events").select("event_id", "ts", "value")
    out = running(ev, ("ts", "event_id"), {
        "soma": ("sum", "value"), "media": ("avg", "value"), "n": ("count", "value"), "menor": ("min", "value"),
        "maior": ("max", "value")}, chunk_rows=CHUNK_ROWS)
    return out.withColumns({"soma": rounded("soma", W.DIGITS_VALUE), "media": rounded("media", W.DIGITS_VALUE)})


def running_year_to_date(spark, sf):
    """Year-to-date sum and average of the same series: every year starts anew."""
    ev = td.table(spark, sf, "events").select("event_id", "ts", "value", F.year("ts").alias("ano"))
    out = running(ev, ("ts", "event_id"), {"acumulado_ano": ("sum", "value"), "media_ano": ("avg", "value")},
                  keys=("ano",), chunk_rows=CHUNK_ROWS)
    return out.withColumns({c: rounded(c, W.DIGITS_VALUE) for c in ("acumulado_ano", "media_ano")})


LONG_FRAME = 10_000


def moving_extremes_long(spark, sf):
    """Extremes of the last 10,000 events of the one series."""
    ev = td.table(spark, sf, "events").select("event_id", "ts", "value")
    return long_extremes(ev, ("ts", "event_id"), "value", LONG_FRAME, names=("maximo", "minimo"))


def product_rounding(spark, sf):
    """The product's own rounding (no comparison): averages of up to four whole
    quantities are halves, thirds and quarters, so ties at a digit are exact."""
    li = td.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_quantity")
    return li.withColumns({
        "media": W.moving_avg("l_quantity", w, 4, digits=1), "variacao": W.change("l_quantity", w),
        "soma": W.rolling_sum("l_quantity", w, 12), "dezena": rounded(F.col("l_quantity") / 4, -1)})


def silver_rate_sorted(spark, sf):
    """Silver in the order of series and day, each row with its place."""
    rows = _silver_written(spark, sf).select("serie", "data", "valor")
    return global_row_number(rows, ("serie", "data")).select("serie", "data", "valor", F.col("_rn").alias("ordem"))


def gold_sorted(spark, sf):
    """Gold in the order of months, each row with its place."""
    return global_row_number(_published(spark, sf), ("mes_ref",)).select(
        "mes_ref", "selic_media_mes", F.col("_rn").alias("ordem"))


def comparing(query: Query) -> Query:
    """The query with values rounded so that an SQL engine can repeat them."""
    def run(spark, sf):
        with comparison_rounding():
            return query(spark, sf)
    return run


_REGISTERED: dict[str, Query] = {
    "dedup_latest": dedup_latest,
    "silver_rate": silver_rate,
    "silver_fx": silver_fx,
    "silver_inflation": silver_inflation,
    "silver_plain_monthly": silver_plain_monthly,
    "monthly_rate": monthly_rate,
    "monthly_inflation": monthly_inflation,
    "monthly_fx": monthly_fx,
    "monthly_level": monthly_level,
    "monthly_ratio": monthly_ratio,
    "gold_wide_monthly": gold_wide_monthly,
    "gold_by_series": gold_by_series,
    "filter_valid_observations": filter_valid_observations,
    "change_abs": change_abs,
    "change_pct": change_pct,
    "moving_avg_30": moving_avg_30,
    "volatility_30": volatility_30,
    "moving_extremes_30": moving_extremes_30,
    "rolling_sum_12": rolling_sum_12,
    "ytd_sum": ytd_sum,
    "ytd_avg": ytd_avg,
    "annualize_rate": annualize_rate,
    "classify_rate_level": classify_rate_level,
    "classify_pressure": classify_pressure,
    "classify_trend": classify_trend,
    "calendar_parts": calendar_parts,
    "real_rate_fisher": real_rate_fisher,
    "gold_left_join_two": gold_left_join_two,
    "gold_point_lookup": gold_point_lookup,
    "gold_table_lookup": gold_table_lookup,
    "metric_valid_rows": metric_valid_rows,
    "latest_metric": latest_metric,
    "latest_metric_change": latest_metric_change,
    "last_n_months": last_n_months,
    "newest_n": newest_n,
    "union_batches": union_batches,
    "sample_rows": sample_rows,
    "missing_by_column": missing_by_column,
    "latest_reference": latest_reference,
    "format_reference": format_reference_query,
    "format_metric_label": format_metric_label,
    "insight_sentences": insight_sentences,
    "profile_rate": profile_rate,
    "profile_inflation": profile_inflation,
    "profile_fx": profile_fx,
    "profile_bronze": profile_bronze,
    "profile_rate_global": profile_rate_global,
    "profile_inflation_global": profile_inflation_global,
    "profile_fx_global": profile_fx_global,
    "label_distribution_rate": label_distribution_rate,
    "label_distribution_inflation": label_distribution_inflation,
    "label_distribution_fx": label_distribution_fx,
    "distinct_years": distinct_years,
    "row_counts_by_layer": row_counts_by_layer,
    "ingest_json_payload": ingest_json_payload,
    "ingest_parse_coerce": ingest_parse_coerce,
    "ingest_lookback_window": ingest_lookback_window,
    "bronze_append_audit": bronze_append_audit,
    "schema_conform": schema_conform,
    "silver_partition_overwrite": silver_partition_overwrite,
    "silver_full_overwrite": silver_full_overwrite,
    "gold_materialize": gold_materialize,
    "control_log_summary": control_log_summary,
    "quality_not_null": quality_not_null,
    "quality_unique": quality_unique,
    "quality_reconcile_counts": quality_reconcile_counts,
    "quality_reconcile_at_least": quality_reconcile_at_least,
    "quality_report": quality_report,
    "pipeline_run_status": pipeline_run_status,
    "chunked_window_single_series": chunked_window_single_series,
    "chunked_window_by_series": chunked_window_by_series,
    "silver_rate_sorted": silver_rate_sorted,
    "gold_sorted": gold_sorted,
    "sample_by_group": sample_by_group,
    "silver_vanished_partitions": silver_vanished_partitions,
    "incremental_current_state": incremental_current_state,
    "bronze_table_by_name": bronze_table_by_name,
    "silver_rate_range": silver_rate_range,
    "running_single_series": running_single_series,
    "running_year_to_date": running_year_to_date,
    "moving_extremes_long": moving_extremes_long,
    "ingest_split_files": LD.ingest_split_files,
    "ingest_landed_files": LD.ingest_landed_files,
    "ingest_fixed_winner": LD.ingest_fixed_winner,
    "pipeline_landed_run": LD.pipeline_landed_run,
}

# These round as the product does.
_AS_IS: dict[str, Query] = {"product_rounding": product_rounding}

QUERIES: dict[str, Query] = {name: comparing(q) for name, q in _REGISTERED.items()} | _AS_IS
