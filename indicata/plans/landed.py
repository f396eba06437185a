"""Queries over landed payload files, made from the driver's tables by Spark.

The files are written to a scratch folder of the shared storage in the layout
of a real landing, with several items a file and planted defects; the queries
then run the same readers and the same pipeline as a production run.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata.operators.dedup import latest_per_key
from indicata.plans import pipeline as PL
from indicata.session import scratch_path
from indicata.sources import payload as PAY
from indicata.sources import store
from indicata.sources import testdata as td

BAD_VALUE_EVERY = 50   # order keys that are a multiple: value text 'N/D'
BAD_DATE_EVERY = 97    # order keys that are a multiple: impossible date 31/02
BROKEN_MONTH = "1996-03"  # files of this month are cut off in the middle
RUN_TS = dt.datetime(2024, 1, 1)
WINDOW_DAYS = 12_000  # back to 1991: all orders are inside


def _items(date_text: Column, value_text: Column, *order: str) -> Column:
    """JSON array of a group's items, in ``order``."""
    item = F.struct(*order, date_text.alias("data"), value_text.alias("valor"))
    return F.to_json(F.transform(F.sort_array(F.collect_list(item)), lambda x: F.struct(
        x["data"].alias("data"), x["valor"].alias("valor"))))


def _land(files: DataFrame, path: str) -> None:
    """``files (serie, payload)``: a file each, in the folder of its series."""
    files.write.option("maxRecordsPerFile", 1).partitionBy("serie").mode("append").text(path)


def ingest_split_files(spark: SparkSession, sf: str) -> DataFrame:
    """The same files, each read in byte ranges; those cut off in the middle
    are found out and read whole."""
    return ingest_landed_files(spark, sf, split_above=0)


def ingest_landed_files(spark: SparkSession, sf: str, split_above: int = PAY.SPLIT_ABOVE) -> DataFrame:
    """A file per (order status, month), many items each; some values are no
    numbers, some dates impossible, the files of one month cut off."""
    month = F.date_format("o_orderdate", "yyyy-MM")
    bad_date = F.col("o_orderkey") % BAD_DATE_EVERY == 0
    date_text = F.when(bad_date, F.concat(F.lit("31/02/"), F.year("o_orderdate").cast("string"))) \
        .otherwise(F.date_format("o_orderdate", PAY.DATE_PATTERN))
    value_text = F.when(F.col("o_orderkey") % BAD_VALUE_EVERY == 0, F.lit("N/D")) \
        .otherwise(F.col("o_totalprice").cast("string"))
    files = td.table(spark, sf, "orders").withColumns({"dt_text": date_text, "v_text": value_text}) \
        .groupBy(F.col("o_orderstatus").alias("serie"), month.alias("mes")) \
        .agg(_items(F.col("dt_text"), F.col("v_text"), "o_orderkey").alias("payload"))
    files = files.withColumn("payload", F.when(
        F.col("mes") == BROKEN_MONTH, F.expr("substr(payload, 1, length(payload) - 5)")).otherwise(F.col("payload")))
    path = scratch_path(spark, "landed-orders")
    _land(files.select("serie", "payload"), path)
    parsed = PAY.parse_observations(PAY.read_landed(spark, path, split_above), strict=False)
    return parsed.select("serie", "data", "valor", "data_texto", "motivo")


def ingest_fixed_winner(spark: SparkSession, sf: str) -> DataFrame:
    """One run, one timestamp, a file per return flag: of equal (supplier,
    month) the last item of the last file wins, for any file sizes."""
    li = td.table(spark, sf, "lineitem").withColumns({
        "dt_text": F.date_format(F.trunc("l_shipdate", "month"), PAY.DATE_PATTERN),
        "v_text": F.col("l_quantity").cast("string")})
    files = li.groupBy("l_suppkey", "l_returnflag").agg(
        _items(F.col("dt_text"), F.col("v_text"), "l_orderkey", "l_linenumber", "l_quantity").alias("payload")) \
        .select("payload", F.concat(F.lit("/landing/rate/"), F.col("l_suppkey").cast("string"), F.lit("/"),
                                    "l_returnflag", F.lit(".json")).alias("_file"))
    parsed = PAY.parse_observations(PAY.landed_items(files), strict=True)
    bronze = store.add_audit_columns(parsed, RUN_TS, "landing")
    newest = latest_per_key(bronze, ("serie", "data"), ("_ingested_at",), ("_seq",))
    return newest.select(F.col("serie").cast("long").alias("serie"), "data", "valor")


def pipeline_landed_run(spark: SparkSession, sf: str) -> DataFrame:
    """``run_pipeline`` on files landed for the catalog's series and four
    more: one of the rate kind that gold must not mix in, one that fails in
    strict mode, one that landed an empty array, one whose only row lies before
    the window. Returns the run records."""
    o = td.table(spark, sf, "orders")
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "pipeline")

    def land(kind: str, serie: Column, day: Column, value: Column) -> None:
        rows = o.groupBy(serie.alias("serie"), day.alias("dia")).agg(value.alias("v"))
        files = rows.groupBy("serie", F.year("dia").alias("ano")).agg(_items(
            F.date_format("dia", PAY.DATE_PATTERN), F.col("v").cast("string"), "dia").alias("payload"))
        _land(files.select("serie", "payload"), PL._p(landing, kind))

    day, month = F.to_date("o_orderdate"), F.trunc("o_orderdate", "month")
    rate = F.when(F.col("o_orderstatus") == "F", "selic").otherwise("outra")
    land("rate", rate, day, F.round(F.count("*") / 100, 4))
    land("fx", F.lit("dollar"), day, F.round(F.avg("o_totalprice") / 100_000, 4))
    land("inflation", F.lit("ipca"), month, F.round(F.count("*") / 1000, 4))
    land("plain", F.lit("pib"), month, F.round(F.sum("o_totalprice"), 2))
    land("plain", F.lit("inadimplencia"), month, F.round(F.count_if(F.col("o_orderstatus") == "P") / 10, 4))
    broken = o.groupBy(F.lit("ruim").alias("serie")).agg(F.concat(
        F.lit('[{"data": "31/02/2000", "valor": "'), F.count("*").cast("string"), F.lit('"}]')).alias("payload"))
    _land(broken, PL._p(landing, "fx"))
    _land(o.groupBy(F.lit("vazia").alias("serie")).agg(F.lit("[]").alias("payload")), PL._p(landing, "plain"))
    old = o.groupBy(F.lit("antiga").alias("serie")).agg(F.concat(
        F.lit('[{"data": "01/02/1980", "valor": "'), F.count("*").cast("string"), F.lit('"}]')).alias("payload"))
    _land(old, PL._p(landing, "rate"))
    run = PL.run_pipeline(spark, landing, out, RUN_TS, strict=True, days=WINDOW_DAYS)["run"]
    return run.select("table_name", F.col("metadata")["serie"].alias("serie"), "layer", "row_count", "status",
                      F.col("metadata")["quarantined"].cast("long").alias("quarentena"))
